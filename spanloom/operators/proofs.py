"""Proofs over tables: freshness, nothing lost, equal sets, fingerprints, manifests, row rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.sources.staging import staged

FRESH = 36 * 3600 * times.SECOND


def freshness(sources: DataFrame, now_us: Column, most_us: int = FRESH) -> DataFrame:
    """Sources (key, checked_us, continuous) with ``reasons`` why they may not be used, and ``fresh``."""
    age = now_us - F.col("checked_us")
    reasons = F.array_compact(F.array(
        F.when(F.col("checked_us").isNull(), "missing"), F.when(age < 0, "from the future"), F.when(age > most_us, "too old"),
        F.when(~F.coalesce("continuous", F.lit(False)), "not continuous")))
    return sources.withColumns({"age_us": age, "reasons": reasons, "fresh": F.size(reasons) == 0})


def fresh_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("sources"), F.count("checked_us").alias("bound"), F.count_if("fresh").alias("fresh"))


def lost(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the old table that the new one lacks, as a multiset."""
    return old.exceptAll(new.select(*old.columns))


def unequal_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two sets has alone, with ``side``."""
    return a.subtract(b).withColumn("side", F.lit("a")).unionByName(b.subtract(a).withColumn("side", F.lit("b")))


def row_text(rows: DataFrame) -> Column:
    """A row's columns by name as text that other engines can make, too: `name=bytes:value;`, or `name=;` for a null.

    Numbers with a fraction count to six decimals where they are below 9e12, instants in microseconds (local times as in UTC sessions), booleans as 0 and 1,
    elements of a list by commas (null: empty).
    """
    def said(value: Column, kind) -> Column:
        name = kind.typeName()
        if name in ("float", "double"):
            return F.when(F.abs(value) < 9e12, F.floor(value.cast("double") * 1_000_000 + 0.5).cast("string")).otherwise(value.cast("string"))
        if name in ("timestamp", "timestamp_ntz"):
            return F.unix_micros(value.cast("timestamp")).cast("string")
        if name == "boolean":
            return value.cast("int").cast("string")
        if name == "array":
            return F.array_join(F.transform(value, lambda x: said(x, kind.elementType)), ",", "")
        return value.cast("string")

    each = []
    for field in sorted(rows.schema.fields, key=lambda f: f.name):
        value = said(F.col(f"`{field.name}`"), field.dataType)
        each.append(F.coalesce(F.concat(F.lit(f"{field.name}="), F.octet_length(value).cast("string"), F.lit(":"), value, F.lit(";")), F.lit(f"{field.name}=;")))
    return F.concat(*each)


#: Row hashes that a leaf of a digest tree holds about, and the children of each node above.
LEAF, FAN = 256, 16


def tree_depth(n: int) -> int:
    """Levels under the root of the tree over ``n`` rows: the fewest with which leaves hold ``LEAF`` rows or less on average."""
    depth = 0
    while n > LEAF * FAN**depth:
        depth += 1
    return depth


def row_hashes(rows: DataFrame, keys: list[str], text: Column | None = None) -> DataFrame:
    """(keys, h, n): the SHA-256 of each distinct row, and how often it occurs. ``text`` is the row's; else its JSON with nulls."""
    own = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}) if text is None else text
    return rows.select(*keys, F.sha2(own, 256).alias("h")).groupBy(*keys, "h").agg(F.count("*").alias("n"))


def digest_tree(hashed: DataFrame, keys: list[str], depth: int, keep: Callable[[DataFrame], DataFrame] = lambda level: level) -> list[DataFrame]:
    """Levels from the root down: (keys, prefix, n, digest, hash_sum), one node for each prefix of the row hashes of the level's length.

    A leaf's digest is that of its `hash:times;`, in order, a node's that of its children's `prefix:digest;`. Equal rows are
    one entry, so a leaf has about ``LEAF`` entries at the depth of ``tree_depth``, whatever the rows are, and a node ``FAN``.
    Each level is made from what ``keep`` makes of the one below it, such as a written table. Hashes move as bytes, texts are made where they meet.
    """
    def digest(name: Column, value: str, said: Callable[[Column], Column]) -> Column:
        held = F.array_sort(F.collect_list(F.struct(name.alias("name"), F.col(value).alias("value"))))
        return F.sha2(F.array_join(F.transform(held, lambda x: F.concat(said(x["name"]), F.lit(":"), x["value"], F.lit(";"))), ""), 256).alias("digest")

    number = F.conv(F.substring("h", 1, 12), 16, 10).cast("decimal(38,0)") * F.col("n")
    level = hashed.groupBy(*keys, F.substring("h", 1, depth).alias("prefix")).agg(F.sum("n").alias("n"), digest(F.unhex("h"), "n", lambda h: F.lower(F.hex(h))), F.sum(number).cast("decimal(38,0)").alias("hash_sum"))
    levels = [level := keep(level)]
    for length in range(depth - 1, -1, -1):
        level = level.groupBy(*keys, F.substring("prefix", 1, length).alias("up")).agg(F.sum("n").alias("n"), digest(F.col("prefix"), "digest", lambda prefix: prefix), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"))
        level = keep(level.withColumnRenamed("up", "prefix"))
        levels.append(level)
    return levels[::-1]


def _largest(rows: DataFrame, keys: list[str], counted: Column | None = None) -> int:
    n = F.count("*") if counted is None else counted
    return rows.groupBy(*keys).agg(n.alias("n")).agg(F.max("n")).first()[0] or 0


def fingerprint(rows: DataFrame, keys: list[str], text: Column | None = None) -> DataFrame:
    """Per key: rows, the root of a digest tree over the row hashes (of ``text``, see ``row_hashes``), and an order-free sum of them.

    The tree's depth follows the rows of the largest key.
    """
    root = digest_tree(row_hashes(rows, keys, text), keys, tree_depth(_largest(rows, keys)))[0]
    return root.select(*keys, "n", "digest", F.col("hash_sum").cast("string").alias("hash_sum"))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name, number of rows, and a SHA-256 of it (the root of its digest tree) that no order of rows changes."""
    out = None
    for name, rows in sorted(tables.items()):
        hashed = row_hashes(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), row_text(rows).alias("__text")), [], F.col("__text"))
        root = digest_tree(hashed, [], tree_depth(_largest(rows, [])))[0]
        one = root.select(F.lit(name).alias("name"), "n", F.col("digest").alias("sha256"))
        out = one if out is None else out.unionByName(one)
    return out


def changed_ranges(before: list[DataFrame], after: list[DataFrame], keys: list[str]) -> DataFrame:
    """(keys, prefix): the leaves in which two digest trees of one depth differ.

    From the root down only children of nodes that differ are compared, so that little is read where little has changed.
    """
    names, found = [*keys, "prefix"], None
    for a, b in zip(before, after, strict=True):
        if found is not None:
            length = F.char_length("prefix") - 1
            near = lambda x, found=found: x.withColumn("up", F.substring("prefix", F.lit(1), length)).join(found.withColumnsRenamed({n: f"u_{n}" for n in names}), _up(keys), "left_semi").drop("up")
            a, b = near(a), near(b)
        both = a.select(*names, "digest", F.lit(1).alias("side")).unionByName(b.select(*names, "digest", F.lit(2).alias("side")))
        apart = both.groupBy(*names).agg(F.count_distinct("digest").alias("kinds"), F.count("*").alias("sides")).where("kinds > 1 OR sides = 1")
        found = staged(apart.select(*names))
        if found.isEmpty():
            break
    return found


def _up(keys: list[str]) -> Column:
    same = F.col("up") == F.col("u_prefix")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"u_{k}"))
    return same


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str], text: Callable[[DataFrame], Column] = row_text) -> DataFrame:
    """(keys, h, before, after): hashes of rows that two snapshots do not have equally often; found by the ranges in which their digest trees differ."""
    def hashed(rows: DataFrame) -> DataFrame:
        own = rows.select(*keys, F.unhex(F.sha2(text(rows), 256)).alias("b")).groupBy(*keys, "b").agg(F.count("*").alias("n"))
        return staged(own).withColumn("h", F.lower(F.hex("b")))

    a, b = hashed(before), hashed(after)
    depth = tree_depth(max(_largest(a, keys, F.sum("n")), _largest(b, keys, F.sum("n"))))
    ranges = changed_ranges(digest_tree(a, keys, depth, staged), digest_tree(b, keys, depth, staged), keys)
    # keys and prefix as one text that is never null, so that the grouping meets the rows where the join has put them
    place = lambda prefix: F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], prefix.alias("prefix"))).alias("place")
    none = F.lit(0).cast("long")
    side = lambda x, n, m: x.select(*keys, "b", n.alias("before"), m.alias("after"), place(F.substring("h", 1, depth)))
    both = side(a, F.col("n"), none).unionByName(side(b, none, F.col("n")))
    near = both.join(ranges.select(place(F.col("prefix"))), "place", "left_semi")
    found = near.groupBy("place", *keys, "b").agg(F.sum("before").alias("before"), F.sum("after").alias("after")).where("before <> after")
    return found.select(*keys, F.lower(F.hex("b")).alias("h"), "before", "after")


def declared_counts(rows: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """Keys whose declared number of rows is not what the table has, or which have none."""
    found = rows.groupBy(key).agg(F.count("*").alias("found"))
    both = declared.join(found, key, "full").na.fill(0, ["declared", "found"])
    return both.where("declared <> found or found = 0")


def incomplete_index(daily: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected (keys, n) that the daily index lacks, has twice, or has with another number."""
    found = daily.groupBy(*keys).agg(F.count("*").alias("times"), F.max("n").alias("have"))
    return expected.join(found, keys, "left").where("times is null or times <> 1 or not (have <=> n)")


def moved_back(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value fell or vanished between two states."""
    new = after.select(key, F.col(value).alias("after"))
    return before.select(key, F.col(value).alias("before")).join(new, key, "left").where("after is null or after < before")


def terminal_changes(before: DataFrame, after: DataFrame, key: str, terminal: list[str]) -> DataFrame:
    """Terminal states that changed or vanished."""
    new = after.select(key, F.col("state").alias("now"))
    return before.where(F.col("state").isin(terminal)).join(new, key, "left").where("now is null or now <> state")


def parts_unequal(rows: DataFrame, total: str, parts: list[str], slack: int = 0) -> DataFrame:
    return rows.where(F.abs(F.col(total) - sum((F.col(p) for p in parts), F.lit(0))) > slack)


def total_breaks(rows: DataFrame, key: list[str], total: str, parts: list[str], longest: Column, slack: int = 0) -> DataFrame:
    """(key, reason) of totals that are not the sum of their parts, or are more than their window is long; ``slack`` is allowed in both."""
    apart = F.abs(F.col(total) - sum((F.col(p) for p in parts), F.lit(0))) > slack
    reasons = F.array_compact(F.array(F.when(apart, "parts and total differ"), F.when(F.col(total) > longest + slack, "longer than its window")))
    return rows.select(*key, F.explode(reasons).alias("reason"))


def progress_breaks(rows: DataFrame) -> DataFrame:
    """Rows (terminal, processed, total) that are not 0 <= terminal <= processed <= total, or where one is missing."""
    return rows.where("NOT coalesce(0 <= terminal AND terminal <= processed AND processed <= total, false)")


#: What an open-interval snapshot says of a source.
OPEN, CLOSED = "open_at_source_capture", "no_open_at_source_capture"


def open_snapshot_breaks(rows: DataFrame, now_us: Column, skew_us: int = 120 * times.SECOND, oldest_us: int = 8 * 3600 * times.SECOND, zone: str = times.ZONE) -> DataFrame:
    """(key, reason): what a second look at an open-interval snapshot finds before it is used.

    ``rows``: key, state, date, capture_us, start_us, and of the day's period from_day, through_day, closed_us, provisional_us, combined_us.
    """
    today, age = times.local_day(now_us, zone), now_us - F.col("capture_us")
    is_open, has_start = F.col("state") == OPEN, F.col("start_us").isNotNull()
    sums = [F.col(c) for c in ("closed_us", "provisional_us", "combined_us")]
    negative = F.coalesce(sums[0] < 0, F.lit(True)) | F.coalesce(sums[1] < 0, F.lit(True)) | F.coalesce(sums[2] < 0, F.lit(True))
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("state").isin(OPEN, CLOSED), F.lit(False)), "unknown state"), F.when(~F.col("date").eqNullSafe(today), "another day"),
        F.when(F.coalesce((age < -skew_us) | (age > oldest_us) | (times.local_day(F.col("capture_us"), zone) != today), F.lit(True)), "capture not of now"),
        F.when(F.coalesce(is_open, F.lit(False)) != has_start, "state and start disagree"), F.when(F.col("start_us") >= F.col("capture_us"), "starts after its capture"),
        F.when(~(F.col("from_day").eqNullSafe(today) & F.col("through_day").eqNullSafe(today)), "period is not today"), F.when(negative, "sums missing or negative"),
        F.when(F.abs(sums[0] + sums[1] - sums[2]) >= times.SECOND // 100, "sums differ"), F.when(~F.coalesce(is_open, F.lit(False)) & (sums[1] != 0), "provisional time without an open interval")))
    return rows.select("key", F.explode(reasons).alias("reason"))


def conflicting_messages(messages: DataFrame, key: str, id_: str, content: list[str]) -> DataFrame:
    """(key, id, versions): messages of one id that pages of a source tell in different ways."""
    told = messages.groupBy(key, id_).agg(F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in content])).alias("versions"))
    return told.where("versions > 1")


def orphans(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Children without exactly one parent of equal keys."""
    found = parents.groupBy(*keys).agg(F.count("*").alias("parents"))
    return children.join(found, keys, "left").where("coalesce(parents, 0) <> 1")


def list_changes(frozen: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys whose ordered id list changed, or holds an id twice."""
    new = now.select(key, F.col("ids").alias("now_ids"))
    return frozen.join(new, key, "left").where("not (ids <=> now_ids) or size(ids) <> size(array_distinct(ids))")


def generations(rows: DataFrame, last: int) -> DataFrame:
    """Outputs whose generation is not newer than the last one or not that of the others."""
    top = rows.agg(F.max("generation").alias("top"))  # one row
    return rows.join(F.broadcast(top)).where((F.col("generation") <= last) | (F.col("generation") != F.col("top")))


def snapshot_violations(rows: DataFrame, now_us: Column) -> DataFrame:
    """(event_id, reason) of snapshot rows that break a rule: ends, order, lengths and times after the snapshot."""
    reasons = F.array_compact(F.array(
        F.when(F.col("start_us").isNull(), "no start"), F.when(F.col("end_us") <= F.col("start_us"), "ends before it starts"),
        F.when(F.col("start_us") > now_us, "starts after the snapshot"), F.when(F.col("end_us") > now_us, "ends after the snapshot"),
        F.when(F.col("length_us") != F.col("end_us") - F.col("start_us"), "wrong length")))
    return rows.select("event_id", F.explode(reasons).alias("reason"))


def page_counts(pages: DataFrame, messages: DataFrame, key: str, total: str) -> DataFrame:
    """Sources whose declared number of pages, or whose pages' declared messages, are not what there is.

    ``pages`` (key, page, total, declared) with the number of all pages and of a page's messages; ``messages`` (key, page).
    """
    held = messages.groupBy(key, "page").agg(F.count("*").alias("found"))
    both = pages.join(held, [key, "page"], "left").na.fill(0, ["found"])
    one = both.groupBy(key).agg(F.max(total).alias("total"), F.count_distinct("page").alias("pages"), F.count_if(F.col("declared") != F.col("found")).alias("wrong_pages"))
    return one.where("total <> pages or wrong_pages > 0")
