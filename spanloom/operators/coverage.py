"""How well one source covers another: overlap metrics, audits, simultaneous coverage, reliable starts, name matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import intervals
from spanloom.sources.staging import staged


def overlap_metrics(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Microseconds of a, b, both, either, and of one alone, with shares, and how many intervals a and either have; from one sweep."""
    rows = intervals.both(a.select(*keys, "start_us", "end_us"), b.select(*keys, "start_us", "end_us"))
    begins = {"a_intervals": F.col("a") > 0, "either_intervals": (F.col("a") > 0) | (F.col("b") > 0)}
    live = intervals.beginnings(rows, keys, {"a": F.col("side") == "a", "b": F.col("side") == "b"}, begins)
    length = F.col("end_us") - F.col("start_us")
    when = lambda c: F.sum(F.when(F.expr(c), length).otherwise(0))
    sums = live.groupBy(*keys).agg(
        when("a > 0").alias("a_us"), when("b > 0").alias("b_us"), when("a > 0 and b > 0").alias("both_us"),
        when("a > 0 or b > 0").alias("either_us"), when("a > 0 and b = 0").alias("a_only_us"), when("a = 0 and b > 0").alias("b_only_us"),
        *[F.count_if(n).alias(n) for n in begins],
    )
    return sums.withColumns({
        "coverage_pct": times.ratio(F.col("both_us"), F.col("a_us"), 100), "precision_pct": times.ratio(F.col("both_us"), F.col("b_us"), 100),
        "jaccard_pct": times.ratio(F.col("both_us"), F.col("either_us"), 100), "bias_pct": times.ratio(F.col("b_us") - F.col("a_us"), F.col("a_us"), 100),
        "increase_pct": times.ratio(F.col("either_us") - F.col("a_us"), F.col("a_us"), 100), "b_only_share_pct": times.ratio(F.col("b_only_us"), F.col("either_us"), 100),
    })


def in_periods(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """Intervals clipped to each of a few named periods (period, low_us, high_us)."""
    every = rows.join(F.broadcast(periods), F.expr("start_us < high_us and end_us > low_us"))
    return intervals.clipped(every, F.col("low_us"), F.col("high_us")).drop("low_us", "high_us")


def full_coverage(rows: DataFrame, group: str, member: str, sizes: DataFrame, explicit: Column) -> DataFrame:
    """Per group: time with any alert, with an explicit one of the whole group, and with full coverage.

    Rows where ``explicit`` holds are alerts of the group itself, the others of one member. Full coverage is an
    explicit alert, or alerts of all members at once; episodes are unions of any alert.
    """
    whole, parts = rows.where(explicit), rows.where(~explicit)
    united = staged(intervals.islands(parts, [group, member]))  # read twice
    alone = united.select(group, "start_us", "end_us", F.lit(False).alias("own"))
    every = whole.select(group, "start_us", "end_us", F.lit(True).alias("own")).unionByName(alone)
    own, active = F.col("own_n") > 0, F.col("active_n") > 0
    episodes = intervals.runs(every, [group], {"own_n": F.col("own"), "active_n": ~F.col("own")}, own | active,
                              {"explicit_us": own, "full_us": own | (F.col("active_n") == F.col("members"))}, sizes=sizes)
    out = episodes.groupBy(group).agg(F.sum(F.col("end_us") - F.col("start_us")).alias("any_us"), F.count("*").alias("episodes"), F.sum("explicit_us").alias("explicit_us"),
                                      F.sum("full_us").alias("full_us"), F.count_if(F.col("full_us") > 0).alias("full_episodes"))
    seen = united.select(group, member).distinct().groupBy(group).agg(F.count(member).alias("members_seen"))
    out = out.join(seen, group, "left").na.fill(0, ["members_seen"])
    share = lambda c, of: times.ratio(F.col(c), F.col(of), 100)
    return out.withColumns({"explicit_pct": share("explicit_us", "any_us"), "full_pct": share("full_us", "any_us"), "full_episodes_pct": share("full_episodes", "episodes")})


def by_share(rows: DataFrame, share: str = "full_pct") -> DataFrame:
    """Rows by falling share; those without one come last."""
    return rows.orderBy(F.col(share).desc_nulls_last(), *[c for c in rows.columns[:1]])


def largest_gap(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The longest time between consecutive distinct starts."""
    starts = rows.select(*keys, "start_us", F.col("start_us").alias("end_us")).distinct()
    dealt = intervals.bucketed(starts, keys, F.col("start_us"))
    return intervals.behind(dealt, keys).groupBy(*keys).agg(F.max(F.col("start_us") - F.col("past_us")).alias("largest_gap_us"))


def source_audit(fine: DataFrame, coarse: DataFrame, keys: list[str]) -> DataFrame:
    """Per key of the preferred source: counts, first and last event, largest gap, metrics, events the other lacks."""
    base = fine.groupBy(*keys).agg(F.count("*").alias("events"), F.min("start_us").alias("first_us"), F.max("start_us").alias("last_us"))
    alone = intervals.overlapping(fine, coarse, keys, "left_anti").groupBy(*keys).agg(F.count("*").alias("alone"))
    metrics = overlap_metrics(fine, coarse, keys).select(*keys, "a_us", "b_us", "both_us", "a_only_us", "b_only_us")
    out = base.join(largest_gap(fine, keys), keys, "left").join(alone, keys, "left").join(metrics, keys, "left")
    return out.na.fill(0, ["alone"])


def preferred_level(dim: DataFrame) -> DataFrame:
    """Each region's series: its own where there is one, else its raion's, else its oblast's."""
    level = F.when(F.col("hromada").isNotNull(), "hromada").when(F.col("raion").isNotNull(), "raion").otherwise("oblast")
    return dim.withColumn("level", level).withColumn("series", F.coalesce("hromada", "raion", "oblast"))


def stable_start(rows: DataFrame, keys: list[str], gap_us: int = 90 * times.DAY, tail: int = 20, reach_us: int = 45 * times.DAY) -> DataFrame:
    """Where a key's series becomes reliable.

    The start after the last gap of ``gap_us`` or more that has ``tail`` starts from there on, in a series
    that reaches within ``reach_us`` of the newest end of all; else the first start. Distinct starts count.
    ``gap_before_us`` is the gap before that start, null where there is none.
    """
    newest = rows.agg(F.max("end_us").alias("newest_us"))
    order = Window.partitionBy(*keys).orderBy("start_us")
    starts = rows.select(*keys, "start_us").distinct()
    starts = starts.withColumn("gap_us", F.col("start_us") - F.lag("start_us").over(order))
    back = Window.partitionBy(*keys).orderBy(F.desc("start_us"))  # from the end, so that the frame only grows
    starts = starts.withColumn("left_n", F.row_number().over(back))
    starts = starts.withColumn("last_us", F.max("start_us").over(Window.partitionBy(*keys)))
    starts = starts.join(F.broadcast(newest))
    good = (F.col("gap_us") >= gap_us) & (F.col("left_n") >= tail) & (F.col("last_us") >= F.col("newest_us") - reach_us)
    chosen = starts.groupBy(*keys).agg(F.coalesce(F.max(F.when(good, F.col("start_us"))), F.min("start_us")).alias("stable_us"),
                                       F.min("start_us").alias("first_us"), F.max("start_us").alias("last_observed_us"))
    after = starts.join(chosen, keys).where("start_us >= stable_us").groupBy(*keys, "stable_us", "first_us", "last_observed_us")
    at = F.col("start_us") == F.col("stable_us")
    return after.agg(F.max(F.when(at, F.col("gap_us"))).alias("gap_before_us"), F.count("*").alias("tail_events"), F.max(F.when(~at, F.col("gap_us"))).alias("tail_gap_us"))


#: The states of a place's own series, worst last.
ACTIVITY = ["no_states_match", "current_exact_city_candidate", "sparse_or_intermittent_2026", "historical_2025_only", "no_2025_2026_exact_city_events"]


def activity(places: DataFrame, rows: DataFrame, keys: list[str], before_us: tuple[int, int], now_us: tuple[int, int], recent_us: int = 90 * times.DAY) -> DataFrame:
    """Starts of each place's series in the earlier and the current year and within ``recent_us`` of the newest end, with a status.

    ``places`` (keys, matched) are all that are asked for; ``before_us`` and ``now_us`` are the years' bounds.
    """
    newest = rows.agg(F.max("end_us").alias("newest_us"))
    within = lambda bounds: F.count_if((F.col("start_us") >= bounds[0]) & (F.col("start_us") < bounds[1]))
    counted = rows.join(F.broadcast(newest)).groupBy(*keys).agg(
        within(before_us).alias("before_n"), within(now_us).alias("now_n"), F.count_if(F.col("start_us") >= F.col("newest_us") - recent_us).alias("recent_n"))
    out = places.join(counted, keys, "left").na.fill(0, ["before_n", "now_n", "recent_n"])
    status = F.when(~F.col("matched"), ACTIVITY[0]).when((F.col("now_n") >= 10) & (F.col("recent_n") >= 2), ACTIVITY[1])
    return out.withColumn("status", status.when(F.col("now_n") > 0, ACTIVITY[2]).when(F.col("before_n") > 0, ACTIVITY[3]).otherwise(ACTIVITY[4]))


#: What a city's own community is called before its name, and the scores of the two ways to match.
CITY_MARK, EXACT, INSIDE = "м. ", 100, 50


#: Letters of the pieces that candidates are indexed by.
GRAM = 3


def _pieces(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` letters of a text; none of a shorter one."""
    last = F.char_length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def may_contain(names: DataFrame, candidates: DataFrame, within: list[str], size: int = GRAM) -> DataFrame:
    """(within, name, candidate): candidates of a name's group that hold the name's rarest piece, in any case.

    A candidate that holds the name holds all its pieces, so one is enough to look up, and the rarest gives the fewest.
    A name shorter than ``size`` is a piece itself. Blank names are in every candidate and are left to the caller.
    """
    held = candidates.select(*within, "candidate", F.explode(F.array_distinct(F.concat(*[_pieces(F.lower("candidate"), n) for n in range(1, size + 1)]))).alias("piece"))
    asked = names.where("name <> ''").select(*within, "name", F.lower("name").alias("low"))
    asked = asked.withColumn("piece", F.explode(F.when(F.char_length("low") < size, F.array("low")).otherwise(_pieces(F.col("low"), size))))
    often = held.groupBy(*within, "piece").agg(F.count("*").alias("n"))
    # a piece that no candidate has is the rarest of all
    rarest = asked.join(often, [*within, "piece"], "left").groupBy(*within, "name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
    return rarest.where("r.n > 0").select(*within, "name", F.col("r.piece").alias("piece")).join(held, [*within, "piece"]).select(*within, "name", "candidate")


def best_match(names: DataFrame, candidates: DataFrame, within: list[str], mark: str = CITY_MARK) -> DataFrame:
    """For each (within, name) the candidate of the same group whose name fits best; of equals, the last in order.

    A candidate that is the mark and the name, or goes on with a space, scores ``EXACT``; one that holds the
    name anywhere, in any case, ``INSIDE``. Exact ones are met by an equi-join on the candidates' leading words; names
    without one are looked up by their rarest piece of ``GRAM`` letters. A blank name is in every candidate.
    """
    left = names.select(*within, "name").distinct()
    right = candidates.select(*within, F.col("name").alias("candidate")).distinct()
    parts = F.split("candidate", " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), " "))
    headed = right.select(*within, "candidate", F.explode(heads).alias("head"))
    exact = left.withColumn("head", F.concat(F.lit(mark), "name")).join(headed, [*within, "head"]).select(*within, "name", "candidate", F.lit(EXACT).alias("score"))
    rest = left.join(exact, [*within, "name"], "left_anti")
    inside = may_contain(rest, right, within).where(F.lower("candidate").contains(F.lower("name")))
    blank = rest.where("name = ''").join(right.groupBy(*within).agg(F.max("candidate").alias("candidate")), within).select(*within, "name", "candidate")
    scored = exact.unionByName(inside.unionByName(blank).select("*", F.lit(INSIDE).alias("score")))
    return scored.groupBy(*within, "name").agg(F.max(F.struct("score", "candidate")).alias("best")).select(*within, "name", "best.candidate", "best.score")


def first_alias(names: DataFrame, aliases: DataFrame, key: Column) -> DataFrame:
    """Regions by the first alias that a node answers to; ``aliases`` (region, alias, rank) is a dimension."""
    met = names.withColumn("alias", key).join(aliases, "alias")
    return met.groupBy("region").agg(F.min_by("node", "rank").alias("node"))
