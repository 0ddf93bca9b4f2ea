"""Removal of passages that repeat across documents, by MinHash banding of paragraphs.

Paragraphs are cut by content: a paragraph ends with a word whose hash is the least of the ``NEAR`` words on
either side, where words with ``.``, ``!``, ``?`` or a line's end behind them come before all others. The cut
depends on the words around it only, so a passage that was pasted into the middle of a line has the same
paragraphs inside it wherever it stands. Text that repeats itself is cut by its periods.

Paragraphs with equal words are one node. Nodes are filed under ``BANDS`` bands of ``ROWS`` minima of
five-word shingles (two alike at 0.8 meet with a probability of 98 %), tied to the least node of each
collision, checked by exact Jaccard similarity, and put into classes by connected components; the members
of a collision that are in different classes then are compared with one another. Of a class that spans
documents the smallest document keeps its paragraph. The others' paragraphs make runs, and a run goes on,
word by word on either side, as far as the words are those around the keeper's paragraphs. A run that has
``RUN`` words with that is a repetition and is removed whole.

Defined results: null and empty texts have no paragraphs; paragraphs that repeat within one document only
are left alone; texts of any length are cut whole; rows with the same id and text share their spans; rows
without an id keep their text; extra columns are kept by ``without_repeats`` and ignored otherwise; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spanloom.llm import texts
from spanloom.llm.shared import bucket_components, bucket_links, buckets, kept, marked, marks, released, scratch, settled, shuffles_dropped

SHINGLE = 5
ALIKE = 0.8
BANDS, ROWS = 4, 2
#: Words of a paragraph that is compared beyond equality, of paragraphs that begin a run, and of a repetition, at least.
LEAST_WORDS, SEED, RUN = 8, 8, 32
#: Words on either side of a run that may belong to it; more would hold a paragraph of their own.
REACH = 32
#: Words on either side that a paragraph's last word is compared with.
NEAR = 7


class Paragraphs:
    """The paragraphs of some texts: first word, word after the last, and an order-true hash of the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        self.starts, ends, self.firsts = texts.word_bounds(data, offsets)
        n = len(self.starts)
        self.words = texts.word_hashes(texts.LOWER[data], self.starts, ends)
        if not n:
            self.first = self.end = np.zeros(0, np.int64)
            self.hash = self.words
            return
        closing = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8)) | (np.append(data, np.uint8(10))[ends] == 10)
        finals = self.firsts[1:][np.diff(self.firsts) > 0] - 1
        closing[finals] = True  # whatever follows in memory
        before = np.concatenate([np.zeros(1, np.uint64), self.words[:-1]])
        before[self.firsts[:-1][np.diff(self.firsts) > 0]] = 0
        value = texts.mix(self.words * np.uint64(3) + before) >> np.uint64(1) | np.where(closing, np.uint64(0), np.uint64(1 << 63))
        cut = self._least(value)
        cut[finals] = True
        self.end = np.flatnonzero(cut) + 1
        self.first = np.concatenate([[0], self.end[:-1]])
        self.hash = texts.run_hashes(self.words, self.first, self.end)

    def _least(self, value: np.ndarray) -> np.ndarray:
        """Whether each word's value is below those of the words before it and not above those behind it, in its text."""
        texts_before = np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))
        at = np.arange(len(value)) + NEAR * (texts_before + 1)  # with room between texts
        held = np.full(at[-1] + NEAR + 1, np.uint64(2**64 - 1))
        held[at] = value
        two = np.minimum(held[:-1], held[1:])
        four = np.minimum(two[:-2], two[2:])
        seven = np.minimum(four[:-3], four[3:])  # of NEAR words, from each place on
        return self._thinned((value <= seven[at - NEAR]) & (value <= seven[at + 1]), value)

    def _thinned(self, cut: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Cuts without most of those that text which repeats itself has, once in each of its short periods.

        Of cuts of equal value that follow one another within ``NEAR`` words some are left, all as many words apart, so that paragraphs have
        ``LEAST_WORDS`` or more. Within such text all paragraphs are the same wherever its counting begins.
        """
        at = np.flatnonzero(cut)
        if not len(at):
            return cut
        gap = np.diff(at, prepend=at[0] - NEAR - 1)
        again = (gap <= NEAR) & (value[at] == np.append(value[at[:1]] + np.uint64(1), value[at[:-1]]))
        number = np.arange(len(at))
        since = number - np.maximum.accumulate(np.where(again, 0, number))
        cut[at[again & (since % -(-LEAST_WORDS // gap) > 0)]] = False
        return cut

    def shingled(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word the hash of the shingle from there on, and whether it lies within the paragraph."""
        n = len(self.words)
        rolled = np.zeros(n, dtype=np.uint64)
        for j in range(SHINGLE):
            part = np.zeros(n, dtype=np.uint64)
            part[: n - j] = self.words[j:]
            rolled = texts.mix(rolled * np.uint64(3) + part)
        inside = np.arange(n) + SHINGLE <= np.repeat(self.end, self.end - self.first)
        return rolled, inside


def _band_batches(batches):
    for batch in batches:
        for part in texts.slices(batch):
            found = Paragraphs(*texts.flat(part.column("text")))
            _, some = np.unique(found.hash, return_index=True)
            some = some[(found.end - found.first)[some] >= LEAST_WORDS]
            if not len(some):
                continue
            rolled, inside = found.shingled()
            keys = []
            for band in range(BANDS):
                key = np.full(len(some), band + 1, dtype=np.uint64)
                for row in range(ROWS):
                    salt = np.uint64((band * ROWS + row + 1) * 0x9E3779B97F4A7C15 % 2**64)
                    value = np.where(inside, texts.mix(rolled ^ salt), np.uint64(2**64 - 1))
                    key = texts.mix(key * np.uint64(3) + np.minimum.reduceat(value, found.first)[some])
                keys.append(key)
            node = np.tile(found.hash[some], BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(node.view(np.int64))], names=["key", "node"])


def _set_batches(batches, wanted):
    """Node and distinct shingles of paragraphs whose hash is marked."""
    bits = np.frombuffer(wanted.value, dtype=np.uint64)
    for batch in batches:
        for part in texts.slices(batch):
            found = Paragraphs(*texts.flat(part.column("text")))
            if not len(found.hash):
                continue
            _, some = np.unique(found.hash, return_index=True)
            some = some[marked(found.hash[some], bits)]
            rolled, inside = found.shingled()
            sets = []
            for i in some:
                own = rolled[found.first[i] : found.end[i]][inside[found.first[i] : found.end[i]]]
                sets.append(np.unique(own).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found.hash[some].view(np.int64)), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


def _owner_batches(batches):
    """Each paragraph of a slice once, with the least and the greatest document that has it."""
    for batch in batches:
        for part in texts.slices(batch):
            found = Paragraphs(*texts.flat(part.column("text")))
            doc = part.column("doc_id").to_numpy()[np.searchsorted(found.firsts, found.first, side="right") - 1]
            order = np.argsort(found.hash)
            node, doc = found.hash[order], doc[order]
            begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
            low, high = (f.reduceat(doc, begin) if len(begin) else doc for f in (np.minimum, np.maximum))
            yield pa.RecordBatch.from_arrays([pa.array(node[begin].view(np.int64)), pa.array(low), pa.array(high)], names=["node", "low", "high"])


def _place_batches(batches, wanted):
    """Where paragraphs stand whose hash is marked."""
    bits = np.frombuffer(wanted.value, dtype=np.uint64)
    for batch in batches:
        for part in texts.slices(batch):
            data, offsets = texts.flat(part.column("text"))
            found = Paragraphs(data, offsets)
            some = np.flatnonzero(marked(found.hash, bits))
            doc = np.searchsorted(found.firsts, found.first[some], side="right") - 1
            first, end = found.first[some], found.end[some]
            place = first - found.firsts[doc]
            begin = np.where(place == 0, 0, np.append(found.starts, 0)[first] - offsets[doc])
            close = np.where(end == found.firsts[doc + 1], offsets[doc + 1], np.append(found.starts, 0)[end]) - offsets[doc]
            own = [part.column(c).take(pa.array(doc)) for c in ("doc_id", "mark")]
            numbers = [pa.array(x.astype(np.int64)) for x in (place, end - first, begin, close, found.hash[some].view(np.int64))]
            yield pa.RecordBatch.from_arrays([*own, *numbers], names=["doc_id", "mark", "first_word", "words", "begin", "close", "node"])


def _alike_sets(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of the left side have that Jaccard similarity or more with which of the right."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    known, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = [np.repeat(np.arange(len(n)), n) for n in sizes]
    cut = int(sizes[0].sum())
    column = place[:cut], place[cut:]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(known), 4096):
        ones = []
        for r, c, side in zip(row, column, (left, right), strict=True):
            own = (c >= at) & (c < at + 4096)
            part = np.zeros((len(side), min(4096, len(known) - at)), dtype=np.float32)
            part[r[own], c[own] - at] = 1
            ones.append(part)
        shared += ones[0] @ ones[1].T
    return shared >= threshold * (sizes[0][:, None] + sizes[1][None, :] - shared.astype(np.float64))


def alike(docs: DataFrame, threshold: float = ALIKE) -> DataFrame:
    """(a, b): links between unequal paragraphs whose shingle sets have that Jaccard similarity or more."""
    return bucket_links(*_met(docs, threshold), partial(_alike_sets, threshold=threshold))


def _met(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The buckets (key, node) of paragraphs, links (a, b) of those alike with the least ones of their buckets, and their shingles (node, shingles)."""
    body = docs.select("text")
    met = buckets(body.mapInArrow(_band_batches, "key long, node long"))
    nodes = settled(met.select("node").distinct())
    wanted = docs.sparkSession.sparkContext.broadcast(marks(nodes))
    sets = body.mapInArrow(partial(_set_batches, wanted=wanted), "node long, shingles array<long>")
    sets = settled(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")))
    pairs = met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    both = pairs.join(sets.selectExpr("node AS a", "shingles AS p"), "a").join(sets.selectExpr("node AS b", "shingles AS q"), "b")
    shared = F.size(F.array_intersect("p", "q"))
    links = both.where(shared >= threshold * (F.size("p") + F.size("q") - shared)).select("a", "b")
    return met.select("key", "node"), links, sets


def _around_batches(batches, wanted):
    """The words before and after paragraphs whose hash is marked, nearest first, with the byte where each begins or closes."""
    bits = np.frombuffer(wanted.value, dtype=np.uint64)
    for batch in batches:
        for part in texts.slices(batch):
            data, offsets = texts.flat(part.column("text"))
            found = Paragraphs(data, offsets)
            some = np.flatnonzero(marked(found.hash, bits))
            doc = np.searchsorted(found.firsts, found.first[some], side="right") - 1
            low, high, size = found.firsts[doc], found.firsts[doc + 1], np.diff(offsets)[doc]
            first, end = found.first[some], found.end[some]
            words, starts = (found.words >> np.uint64(32)).astype(np.uint32).view(np.int32), np.append(found.starts, 0)
            before, begins = _side(words, starts, offsets[doc], first - 1, -1, np.minimum(REACH, first - low), low, 0)
            after, closes = _side(words, starts[1:], offsets[doc], end, 1, np.minimum(REACH, high - end), high - 1, size)
            columns = [part.column(c).take(pa.array(doc)) for c in ("doc_id", "mark")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(first - low), before, begins, after, closes], names=["doc_id", "mark", "first_word", "before", "begins", "after", "closes"])


def _side(words: np.ndarray, bytes_at: np.ndarray, text_at: np.ndarray, near: np.ndarray, step: int, n: np.ndarray, last: np.ndarray, border) -> list[pa.Array]:
    """For each place ``n`` words from ``near`` on, and a byte in the text for each: ``border`` at the text's ``last`` one. As bytes of 32-bit numbers."""
    row = np.repeat(np.arange(len(n)), n)
    firsts = np.concatenate([[0], np.cumsum(n)])
    at = near[row] + step * (np.arange(firsts[-1]) - firsts[row])
    place = np.where(at == last[row], np.broadcast_to(border, len(n))[row], bytes_at[at] - text_at[row])
    ends = pa.py_buffer((4 * firsts).astype(np.int32))
    return [pa.Array.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(np.ascontiguousarray(x.astype(np.int32)))]) for x in (words[at], place)]


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lists of at most ``REACH`` 32-bit numbers, as bytes, as the rows of a matrix, and how long each is; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] // 4
    held = np.frombuffer(column.buffers()[2], dtype=np.int32) if column.buffers()[2] is not None else np.zeros(0, np.int32)
    size, at = np.diff(ends), np.arange(REACH)
    out = np.zeros((len(column), REACH), dtype=np.int32)
    if len(held):
        out = held[np.minimum(ends[:-1, None] + at, len(held) - 1)]
    return out, size


def _reach_batches(batches, own: str, kept: str, places: str, into: str, keep: list[str]):
    """How many leading words the lists ``own`` and ``kept`` share, as ``into``, and the byte of the last of them."""
    for batch in batches:
        (a, n), (b, m), (place, _) = (_rows_of(batch.column(c)) for c in (own, kept, places))
        alike = (a == b) & (np.arange(REACH) < np.minimum(n, m)[:, None])
        shared = np.where(alike.all(axis=1), REACH, alike.argmin(axis=1)).astype(np.int64)
        byte = place[np.arange(len(place)), np.maximum(shared - 1, 0)].astype(np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(shared), pa.array(byte)], names=[*keep, into, f"{into}_byte"])


def _reached(rows: DataFrame, own: str, kept: str, places: str, into: str) -> DataFrame:
    """``rows`` with ``into`` and ``into``_byte of ``_reach_batches`` in place of the lists."""
    keep = rows.drop(own, kept, places)
    schema = StructType([*keep.schema.fields, StructField(into, LongType()), StructField(f"{into}_byte", LongType())])
    return rows.mapInArrow(partial(_reach_batches, own=own, kept=kept, places=places, into=into, keep=keep.columns), schema)


def _runs(rows: DataFrame) -> DataFrame:
    """Paragraphs that follow one another, have the same keeper, and go or stay together."""
    order = Window.partitionBy("doc_id", "mark").orderBy("first_word")
    joined = (F.col("first_word") == F.lag(F.col("first_word") + F.col("words")).over(order)) & (F.col("first_doc_id") == F.lag("first_doc_id").over(order))
    rows = rows.withColumn("fresh", F.when(joined, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(order))
    first, last = (lambda c, take=take: take(c, "first_word") for take in (F.min_by, F.max_by))
    runs = rows.groupBy("doc_id", "mark", "run", "first_doc_id", "removed").agg(
        F.min("first_word").alias("first_word"), F.sum("words").alias("words"), F.min("begin").alias("begin"), F.max("close").alias("close"), F.max("first_word").alias("last_word"),
        first("class_id").alias("class_id"), last("class_id").alias("last_class"), first("node").alias("first_node"), last("node").alias("last_node"))
    return runs.where(F.col("words") >= SEED).drop("run")


def repeated(docs: DataFrame, threshold: float = ALIKE) -> DataFrame:
    """(doc_id, mark, first_word, words, begin, close, class_id, first_doc_id, removed) of repeated runs.

    ``begin`` and ``close`` are offsets in the text's UTF-8 bytes, ``mark`` a hash of the text, ``class_id`` the
    least paragraph hash of the class that the run begins with.
    """
    with scratch():
        return kept(_repeated(docs, threshold))


def _repeated(docs: DataFrame, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    body = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    with scratch():
        found = kept(bucket_components(*_met(docs, threshold), partial(_alike_sets, threshold=threshold)))
    shuffles_dropped(spark)
    owners = body.where("doc_id is not null").select("doc_id", "text").mapInArrow(_owner_batches, "node long, low long, high long")
    classes = owners.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high")).join(found, "node", "left")
    # what is alone and in one document repeats nowhere
    classes = classes.where("component is not null or low <> high")
    classes = settled(classes.withColumn("class_id", F.coalesce("component", "node")).drop("component"))
    spans = classes.groupBy("class_id").agg(F.min("low").alias("first_doc_id"), F.max("high").alias("last")).where("first_doc_id <> last")
    wanted = settled(classes.join(spans, "class_id").select("node", "class_id", "first_doc_id"))
    released(found), released(classes)
    shuffles_dropped(spark)
    share = spark.sparkContext.broadcast
    places = body.where("doc_id is not null").mapInArrow(partial(_place_batches, wanted=share(marks(wanted))), "doc_id long, mark long, first_word long, words long, begin long, close long, node long")
    rows = settled(places.join(wanted, "node").withColumn("removed", F.col("doc_id") != F.col("first_doc_id")))
    keepers = settled(rows.where("not removed").groupBy("class_id").agg(F.min(F.struct("first_word", "mark", "doc_id", "node")).alias("k")).select("class_id", "k.*"))
    # one shuffle by document serves repeated rows, runs and their sums
    runs = settled(_runs(rows.repartition("doc_id", "mark").dropDuplicates(["doc_id", "mark", "first_word"])))
    released(wanted), released(rows)
    del rows, places
    shuffles_dropped(spark)
    gone = runs.where("removed")
    edges = gone.select(F.explode(F.array("class_id", "last_class")).alias("class_id")).distinct()
    nodes = gone.select(F.explode(F.array("first_node", "last_node")).alias("node")).unionByName(keepers.join(edges, "class_id").select("node"))
    schema = "doc_id long, mark long, first_word long, before binary, begins binary, after binary, closes binary"
    around = settled(body.mapInArrow(partial(_around_batches, wanted=share(marks(nodes))), schema))
    near = around.join(keepers.drop("node"), ["doc_id", "mark", "first_word"]).select("class_id", "before", "after")
    near = settled(near.groupBy("class_id").agg(F.first("before").alias("before"), F.first("after").alias("after")))
    place = ["doc_id", "mark", "first_word"]
    left = gone.join(around.select(*place, "before", "begins"), place, "left").join(near.select("class_id", F.col("before").alias("kept_before")), "class_id", "left")
    left = _reached(left, "before", "kept_before", "begins", "back")
    right = left.join(around.select("doc_id", "mark", F.col("first_word").alias("last_word"), "after", "closes"), ["doc_id", "mark", "last_word"], "left")
    right = right.join(near.select(F.col("class_id").alias("last_class"), F.col("after").alias("kept_after")), "last_class", "left")
    right = _reached(right, "after", "kept_after", "closes", "on")
    # repeated rows have their surroundings twice; by where a run began, as two runs may have grown back to one word
    grown = right.dropDuplicates(["doc_id", "mark", "first_word"]).select(
        "doc_id", "mark", (F.col("first_word") - F.col("back")).alias("first_word"), (F.col("words") + F.col("back") + F.col("on")).alias("words"),
        F.when(F.col("back") > 0, F.col("back_byte")).otherwise(F.col("begin")).alias("begin"),
        F.when(F.col("on") > 0, F.col("on_byte")).otherwise(F.col("close")).alias("close"), "class_id", "first_doc_id", "removed")
    return grown.unionByName(runs.where("not removed").select(*grown.columns)).where(F.col("words") >= RUN)


def _cut_batches(batches, names):
    for batch in batches:
        text, stays = [], []
        for whole, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
            if spans:
                raw, at, kept = whole.encode(), 0, []
                for begin, close in sorted((s["begin"], s["close"]) for s in spans):
                    kept.append(raw[at:begin])
                    at = max(at, close)
                whole = b"".join([*kept, raw[at:]]).decode()
            text.append(whole)
            stays.append(not spans or bool(whole.split()))
        columns = [pa.array(text, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stays))


def without_repeats(docs: DataFrame, threshold: float = ALIKE) -> DataFrame:
    """The documents without the paragraphs that an earlier document has; one that loses all its words goes.

    A column ``n_chars`` is set to the new length.
    """
    spans = repeated(docs, threshold).where("removed").groupBy(F.col("doc_id").alias("__d"), F.col("mark").alias("__m"))
    spans = spans.agg(F.array_distinct(F.collect_list(F.struct("begin", "close"))).alias("__spans"))
    rows = docs.join(spans, (F.col("doc_id") == F.col("__d")) & (F.xxhash64("text") == F.col("__m")), "left")
    names = docs.columns
    kept = rows.select(*names, "__spans").mapInArrow(partial(_cut_batches, names=names), docs.schema)
    if "n_chars" in names:
        kept = kept.withColumn("n_chars", F.coalesce(F.char_length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))
    return kept
