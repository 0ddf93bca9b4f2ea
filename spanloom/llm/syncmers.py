"""Document fingerprints of closed syncmers, in DataFrame operations only.

A text is a sequence of words. A run of ``K`` words is an anchor if, of the runs of ``S`` words inside it,
the one with the smallest hash is the first or the last. Whether a run is an anchor depends on its own
words only, so texts that share a passage share the anchors inside it wherever it stands.

Defined results: a null text counts as empty; a text of 1 to ``K - 1`` words has one anchor, its whole
sequence; one without words has none; two texts without anchors are alike (1.0), one without and one with
anchors are not (0.0); rows whose doc_id is null come before all others; repeated ids follow one another
in the order of a hash of their texts; the only document is its own next one; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 5, 2
SPACE = r"[\x20\x09-\x0D]+"
SKETCH = 128
#: Rows of a stretch of the id order, and the most stretches there are; their first ids are what a driver sees.
STRETCH, STRETCHES = 2000, 65536


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _at(values: Column, i: Column, by: int) -> Column:
    return F.get(values, i + by if by else i)


def anchors(text: Column) -> Column:
    """array<struct<place, hash>> of the anchors of a text: the word where each starts, and the hash of its words."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")

    def chosen(h: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*[_at(h, i, j) for j in range(S)]))

        def edges(g: Column) -> Column:
            last = K - S
            at_edge = lambda i: F.least(_at(g, i, 0), _at(g, i, last)) <= F.least(*[_at(g, i, j) for j in range(1, last)])
            places = F.filter(F.sequence(F.lit(0), F.size(h) - K), at_edge)
            return F.transform(places, lambda i: F.struct(i.alias("place"), F.xxhash64(*[_at(h, i, j) for j in range(K)]).alias("hash")))

        whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(h).alias("hash")))
        none = F.filter(whole, lambda _: F.lit(False))
        return F.when(F.size(h) >= K, _let(inner, edges)).when(F.size(h) > 0, whole).otherwise(none)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), chosen)


def sketch(found: Column) -> Column:
    """The hashes (32 bits) that a fingerprint lists, in the order of their first places."""
    hashes = F.array_distinct(F.transform(found, lambda a: F.shiftrightunsigned(a["hash"], 32)))
    least = lambda every: _let(F.element_at(F.array_sort(every), SKETCH), lambda most: F.filter(every, lambda x: x <= most))
    return _let(hashes, lambda every: F.when(F.size(every) > SKETCH, least(every)).otherwise(every))


def fingerprint(listed: Column) -> Column:
    """The string of a sketch: eight hexadecimal digits for each anchor."""
    return F.array_join(F.transform(listed, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _rising(places: Column) -> Column:
    """The least ends of rising subsequences of each length, by patience: as many as the longest one has members."""

    def put(ends: Column, at: Column) -> Column:
        below = F.size(F.filter(ends, lambda x: x < at))
        rest = F.slice(ends, below + 2, F.lit(SKETCH))
        return F.when(F.coalesce(F.get(ends, F.size(ends) - 1) < at, F.lit(True)), F.array_append(ends, at)).otherwise(F.concat(F.slice(ends, F.lit(1), below), F.array(at), rest))

    return F.aggregate(places, F.array().cast("array<long>"), lambda ends, at: put(ends, at.cast("long")))


def likeness(a: Column, b: Column) -> Column:
    """Share of the anchors of two sketches that both have in one order: the longest run of common anchors that stand in the same
    order in both (not side by side), over all anchors of either. It is the same whichever comes first."""
    largest = lambda x: F.when(F.size(x) >= SKETCH, F.array_max(x)).otherwise(F.lit(1 << 32))

    def upto(limit: Column) -> Column:
        return F.struct(*[F.filter(x, lambda h: h <= limit).alias(name) for x, name in ((a, "p"), (b, "q"))])

    def matched(both: Column) -> Column:
        places = F.filter(F.transform(both["p"], lambda h: F.array_position(both["q"], h)), lambda at: at > 0)

        def share(places: Column) -> Column:
            every = F.size(both["p"]) + F.size(both["q"]) - F.size(places)
            return F.when(every == 0, 1.0).otherwise(F.size(_rising(places)) / every)

        return _let(places, share)

    return _let(_let(F.least(largest(a), largest(b)), upto), matched)


def _stretch_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the id, by a search in two levels."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(x).cast("long") for x in bounds[step - 1 :: step]]) if bounds[step - 1 :: step] else F.array().cast("array<long>")
    fine = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.array().cast("array<long>")

    def inside(k: Column) -> Column:
        return k * step + F.size(F.filter(F.slice(fine, k * step + 1, F.lit(step)), lambda x: x <= doc_id))

    return F.coalesce(_let(F.size(F.filter(coarse, lambda x: x <= doc_id)), inside), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, turn, next_text, stretch): each document with the text of the next one by ascending doc_id.

    Ids are cut into stretches at approximate quantiles. The first document of each stretch also visits the
    stretch before it, as a guest at its end; so one shuffle of the texts brings neighbours together.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id").where("doc_id is not null")
    count = ids.count()
    parts = max(1, min(-(-count // STRETCH), STRETCHES))
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * parts + 1000)).first()[0] or [])) if shares and count else []
    stretch = _stretch_of(F.col("doc_id"), bounds)
    heads = sorted(ids.groupBy(stretch.alias("stretch")).agg(F.min("doc_id").alias("doc_id")).collect())
    guests = [(b.doc_id, a.stretch) for a, b in zip([heads[-1], *heads[:-1]], heads, strict=True)] if heads else []
    visits = spark.createDataFrame(guests, "doc_id long, visit int")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), stretch.alias("own"))
    rows = rows.join(F.broadcast(visits), "doc_id", "left")
    places = F.array(F.struct(F.col("own").alias("stretch"), F.lit(False).alias("guest")), F.struct(F.col("visit").alias("stretch"), F.lit(True).alias("guest")))
    rows = rows.withColumn("place", F.explode(F.filter(places, lambda p: p["stretch"].isNotNull())))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("turn"), "place.stretch", "place.guest")
    return rows.withColumn("next_text", F.coalesce(F.lead("text").over(_order()), F.col("text")))


def _order() -> Window:
    return Window.partitionBy("stretch").orderBy("guest", F.col("doc_id").asc_nulls_first(), "turn")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they and the next document's are."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_next(docs).select("doc_id", "stretch", "guest", "turn", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.select("doc_id", "stretch", "guest", "turn", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       sketch(anchors(F.col("text"))).alias("own"), sketch(anchors(F.when(~F.col("guest"), F.col("edited")))).alias("new"))
    rows = rows.withColumn("next", F.coalesce(F.lead("own").over(_order()), F.col("own"))).where(~F.col("guest"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("new")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
