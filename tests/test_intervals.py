"""The interval algebra against a point-by-point brute force, and its invariances."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import calendar, coverage, intervals, snapshot

SCHEMA = "event_id long, k string, start_us long, end_us long"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def got(df):
    return sorted((r.k, r.start_us, r.end_us) for r in df.collect())


def brute(sets, keep, top=60):
    """Union intervals of the points where ``keep`` holds of the sets that cover them."""
    out, start = [], None
    for t in range(top + 1):
        on = t < top and keep([any(a <= t < b for a, b in s) for s in sets])
        if on and start is None:
            start = t
        if not on and start is not None:
            out.append((start, t))
            start = None
    return out


def some(rng, n):
    return [(a, min(59, a + rng.randint(-1, 12))) for a in (rng.randint(0, 50) for _ in range(n))]


CASES = {"empty": [], "one": [("a", 1, 5)], "touch": [("a", 1, 5), ("a", 5, 8)], "nested": [("a", 1, 9), ("a", 2, 3)], "equal": [("a", 1, 5)] * 3,
         "gap": [("a", 1, 5), ("a", 6, 8)], "not positive": [("a", 5, 5), ("a", 7, 6)]}
WANT = {"empty": [], "one": [("a", 1, 5)], "touch": [("a", 1, 8)], "nested": [("a", 1, 9)], "equal": [("a", 1, 5)], "gap": [("a", 1, 5), ("a", 6, 8)], "not positive": []}


@pytest.mark.parametrize("name", CASES)
def test_islands_edges(spark, name):
    assert got(intervals.islands(frame(spark, CASES[name]), ["k"])) == WANT[name]


def test_sweep_is_brute_force_and_order_does_not_matter(spark):
    rng = random.Random(3)
    a = [(str(k), *x) for k in range(12) for x in some(rng, 6)]
    b = [(str(k), *x) for k in range(12) for x in some(rng, 5)]
    rng.shuffle(a)
    fa, fb = frame(spark, a), frame(spark, b)
    rules = {"intersection": lambda x: x[0] and x[1], "difference": lambda x: x[0] and not x[1], "union": lambda x: x[0] or x[1]}
    for name, keep in rules.items():
        want = sorted((str(k), *x) for k in range(12) for x in brute([[r[1:] for r in s if r[0] == str(k)] for s in (a, b)], keep))
        assert got(getattr(intervals, name)(fa, fb, ["k"])) == want, name
    once = intervals.islands(fa, ["k"])
    assert got(intervals.islands(once.withColumn("event_id", F.lit(1)), ["k"])) == got(once) == got(intervals.islands(fa, ["k"], bucket_us=7))
    size = lambda d: d.agg(F.sum(F.col("end_us") - F.col("start_us"))).first()[0]
    assert size(intervals.union(fa, fb, ["k"])) == size(once) + size(intervals.islands(fb, ["k"])) - size(intervals.intersection(fa, fb, ["k"]))


def test_overlap_semi_and_anti(spark):
    rng = random.Random(5)
    a, b = [("x", *x) for x in some(rng, 40)], [("x", *x) for x in some(rng, 4)]
    a = [x for x in a if x[2] > x[1]]
    left, right = frame(spark, a), frame(spark, b)
    hit = {i for i, x in enumerate(a) if any(x[1] < y[2] and x[2] > y[1] and y[2] > y[1] for y in b)}
    assert {r.event_id for r in intervals.overlapping(left, right, ["k"], bucket_us=8).collect()} == hit
    assert {r.event_id for r in intervals.overlapping(left, right, ["k"], "left_anti", bucket_us=8).collect()} == set(range(len(a))) - hit


def test_all_active_needs_every_member(spark):
    rows = spark.createDataFrame([("g", "a", 0, 10), ("g", "b", 5, 20), ("h", "a", 0, 10)], "k string, m string, start_us long, end_us long")
    sizes = spark.createDataFrame([("g", 2), ("h", 2)], "k string, members long")
    assert got(intervals.all_active(rows, ["k"], "m", sizes)) == [("g", 5, 10)]


def us(text, zone="UTC"):
    return round(dt.datetime.fromisoformat(text).replace(tzinfo=ZoneInfo(zone)).timestamp() * 1e6)


def test_days_split_at_local_midnight_and_conserve_time(spark):
    rows = frame(spark, [("a", us("2026-03-28T20:00"), us("2026-03-30T10:00")), ("a", us("2026-10-24T20:00"), us("2026-10-26T10:00")), ("b", us("2026-05-01T20:00"), us("2026-05-01T21:00"))])
    parts = intervals.by_local_day(rows).collect()
    assert sum(p.end_us - p.start_us for p in parts) == sum(r.end_us - r.start_us for r in rows.collect())
    hours = {str(p.day): (p.end_us - p.start_us) / 3.6e9 for p in parts}
    assert hours["2026-03-29"] == 23 and hours["2026-10-25"] == 25 and hours["2026-05-01"] == 1  # ends exactly at midnight
    assert "2026-05-02" not in hours


def test_overlap_counts_once(spark):
    rows = frame(spark, [("a", us("2026-09-09T07:00"), us("2026-09-09T09:00")), ("a", us("2026-09-09T08:00"), us("2026-09-09T10:00"))])
    assert calendar.covered_daily(rows, ["k"]).first().alert_us == 3 * 3600 * times.SECOND


def test_local_text_to_instants(spark):
    rows = spark.createDataFrame([("2026-10-25T03:30:00",), ("2026-03-29T03:30:00",), ("2026-09-09T23:23:00",), ("x",), ("2026-09-09T00:00:00Z",)], "t string")
    found = [r[0] for r in rows.select(times.iso(times.local_to_us(F.col("t")))).collect()]
    assert found == ["2026-10-25T00:30:00Z", "2026-03-29T01:30:00Z", "2026-09-09T20:23:00Z", None, "2026-09-09T00:00:00Z"]
    odd = spark.createDataFrame([("2026-01-01T00:00:00.123456789Z",), ("2026-01-01T02:00:00+02:00",), ("2026-01-01 00:00:00",)], "t string")
    assert [r[0] for r in odd.select(times.utc_to_us(F.col("t"))).collect()] == [us("2026-01-01T00:00:00.123456"), us("2026-01-01T00:00"), us("2026-01-01T00:00")]


def test_episode_ids_and_fragments(spark):
    base = us("2026-01-01T00:00")
    rows = frame(spark, [("sumy", base, base + 10_000_000), ("sumy", base + 5_000_000, base + 20_000_000), ("sumy", base + 30_000_000, base + 40_000_000)])
    import hashlib

    want = {hashlib.sha256(f"sumy|2026-01-01T00:00:{a:02}Z|2026-01-01T00:00:{b:02}Z".encode()).hexdigest()[:24] for a, b in ((0, 20), (30, 40))}
    assert {r.episode_id for r in snapshot.episodes(rows, "k").collect()} == want
    assert [r.superseded_by is None for r in snapshot.superseded(rows, "k").orderBy("event_id").collect()] == [False, False, True]


def test_stable_start(spark):
    day = times.DAY
    old = [("a", i * day, i * day + 1) for i in range(5)]
    new = [("a", (200 + i) * day, (200 + i) * day + 1) for i in range(30)]
    found = coverage.stable_start(frame(spark, old + new), ["k"]).first()
    assert (found.stable_us, found.tail_events, found.tail_gap_us) == (200 * day, 30, day)
    assert coverage.stable_start(frame(spark, old + new[:5]), ["k"]).first().stable_us == 0


def test_calendar_rules(spark):
    start = us("2024-01-01T00:00") - 2 * 3600 * times.SECOND  # local midnight
    rows = frame(spark, [("a", start + d * times.DAY, start + d * times.DAY + 600 * times.SECOND) for d in range(45)])
    days = calendar.daily(rows, ["k"])
    assert days.count() == 45
    months = calendar.monthly(days, ["k"]).collect()
    assert [(str(m.period), m.alerts_per_day, m.mean_minutes) for m in months] == [("2024-01-01", 1.0, 10.0)]
    assert calendar.after_first_day(calendar.monthly(days, ["k"]), days, ["k"]).count() == 0  # it begins on the first day
    assert calendar.rolling(days, ["k"]).count() == 45 - 1 - 6
    head = calendar.headline(calendar.last_days(days, ["k"]), ["k"]).first()
    assert head.alerts == 28 and str(head.busiest_day) == "2024-01-18"  # the first of equal days


def test_full_coverage_joins_explicit_and_all_members(spark):
    rows = [("g", "raion", "r1", 0, 10), ("g", "raion", "r2", 5, 20), ("g", "oblast", "", 30, 40), ("h", "raion", "r3", 0, 4)]
    df = spark.createDataFrame(rows, "g string, level string, m string, start_us long, end_us long")
    sizes = spark.createDataFrame([("g", 2), ("h", 2)], "g string, members long")
    found = coverage.full_coverage(df, "g", "m", sizes, F.col("level") == "oblast")
    by = {r.g: r for r in found.collect()}
    g, h = by["g"], by["h"]
    assert (g.any_us, g.explicit_us, g.full_us, g.episodes, g.full_episodes, g.members_seen) == (30, 10, 15, 2, 2, 2)
    assert (h.any_us, h.explicit_us, h.full_us, h.full_episodes, h.members_seen) == (4, 0, 0, 0, 1)
    assert (g.full_pct, g.explicit_pct, g.full_episodes_pct) == (50.0, pytest.approx(100 / 3), 100.0)
    assert [r.g for r in coverage.by_share(found).collect()] == ["g", "h"]


def test_last_complete_day(spark):
    rows = spark.createDataFrame([(us("2024-01-10T23:00"),), (us("2024-01-10T21:59"),)], "t long")  # 01:00 and 23:59 local
    assert [str(r[0]) for r in rows.select(times.last_complete_day(F.col("t"))).collect()] == ["2024-01-10", "2024-01-09"]


def test_overlaps_of_any_length_and_order(spark):
    rng = random.Random(8)
    a = [(str(k), *x) for k in range(6) for x in some(rng, 9)] + [(None, 3, 9), ("q", 5, 5), ("0", 7, 6), ("0", -(10**15), 10**15)]
    b = [(str(k), *x) for k in range(5) for x in some(rng, 2)] + [(None, 8, 9), ("q", 4, 6)]
    hit = {i for i, x in enumerate(a) if any(x[0] == y[0] and x[1] < y[2] and x[2] > y[1] and y[2] > y[1] for y in b)}
    for bucket in (4, 10**18):
        found = intervals.overlapping(frame(spark, a), frame(spark, b), ["k"], bucket_us=bucket)
        assert {r.event_id for r in found.collect()} == hit and found.columns == ["event_id", "k", "start_us", "end_us"]
    assert {r.event_id for r in intervals.overlapping(frame(spark, a), frame(spark, b), ["k"], "left_anti", 4).collect()} == set(range(len(a))) - hit


def test_covered_time_and_places_in_unions(spark):
    rng = random.Random(9)
    a = [(str(k), *x) for k in range(5) for x in some(rng, 8)] + [(None, 3, 9), (None, 9, 10)]
    asked = [(k, t) for k in [*map(str, range(6)), None] for t in range(-1, 62, 3)]
    want = {(k, t): len({p for x in a if x[0] == k for p in range(x[1], x[2]) if p < t}) for k, t in asked}
    probes = spark.createDataFrame(asked, "k string, at_us long")
    for bucket in (5, 1000):
        assert {(r.k, r.at_us): r.covered_us for r in intervals.covered_until(frame(spark, a), probes, ["k"], bucket).collect()} == want
        united = {(k, x, y) for k, x, y in [*[(str(k), *i) for k in range(5) for i in brute([[r[1:] for r in a if r[0] == str(k)]], any)], (None, 3, 10)]}
        for r in intervals.located(frame(spark, a), ["k"], bucket).collect():
            assert (r.k, r.low_us, r.high_us) in united and r.low_us <= r.start_us < r.end_us <= r.high_us
        assert {(r.k, r.start_us, r.end_us) for r in intervals.islands(frame(spark, a), ["k"], bucket).collect()} == united


def test_one_key_is_spread_over_tasks(spark):
    """Two million intervals of one key: in no stage does a task read more than twice what the median task does."""
    day = times.DAY
    rows = spark.range(2_000_000, numPartitions=4).select(F.lit("k").alias("k"), (F.col("id") * (day // 500)).alias("start_us"), ((F.col("id") + F.col("id") % 2) * (day // 500) + 1000).alias("end_us"))
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext.setJobGroup("hot", "one key")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = intervals.islands(rows, ["k"]).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == 1_000_001
    seen = 0
    for job in spark.sparkContext.statusTracker().getJobIdsForGroup("hot"):
        for stage in spark.sparkContext.statusTracker().getJobInfo(job).stageIds:
            try:
                tasks = store.taskList(stage, 0, 1000)
            except Exception:  # a stage that was skipped has none
                continue
            read = sorted(tasks.apply(i).taskMetrics().get().shuffleReadMetrics().recordsRead() for i in range(tasks.size()))
            if sum(read) > 100_000:
                seen += 1
                assert read[-1] <= 2 * read[len(read) // 2], read
    assert seen


def test_names_inside_candidates_are_looked_up_by_pieces(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("абвгдежз ") for _ in range(n))
    cands = [(g, word(rng.randint(6, 20)).strip().upper()) for g in range(2) for _ in range(300)]
    names = [(g, c[i : i + rng.randint(1, 7)].lower()) for g, c in cands[::7] for i in (0, 3)] + [(0, ""), (1, "яяяя"), (0, "м")]
    left = spark.createDataFrame(names, "g long, name string").distinct()
    right = spark.createDataFrame(cands, "g long, name string")
    found = {(r.g, r.name): (r.candidate, r.score) for r in coverage.best_match(left, right, ["g"]).collect()}
    want = {}
    for g, n in set(names):
        hits = [(100 if c == f"м. {n}" or c.startswith(f"м. {n} ") else 50, c) for h, c in cands if h == g and (n in c.lower() or c == f"м. {n}")]
        if hits:
            want[g, n] = max(hits)[::-1]
    assert found == want and (0, "") in found
    longer = left.where("char_length(name) >= 3")
    pairs = coverage.may_contain(longer, right.withColumnRenamed("name", "candidate"), ["g"]).count()
    assert pairs <= 0.02 * longer.count() * 300, (pairs, longer.count())


def test_order_of_published_rows(spark):
    rows = [("b", 2), (None, 5), ("a", None), ("a", 1), ("b", None)]
    found = calendar.in_order(spark.createDataFrame(rows, "k string, n long").repartition(3), ["k", "n"])
    assert [tuple(r) for r in found.collect()] == [(None, 5), ("a", None), ("a", 1), ("b", None), ("b", 2)]
    shares = spark.createDataFrame([("x", 1.0), ("y", None), ("z", 7.5)], "g string, full_pct double").repartition(3)
    assert [r.g for r in coverage.by_share(shares).collect()] == ["z", "x", "y"]


def test_months_without_days_are_those_of_the_daily_table(spark):
    import random

    from spanloom.functions import times
    from spanloom.operators import calendar

    rng = random.Random(6)
    rows = []
    for k in ("a", "b", None, "c"):
        for _ in range(40):
            start = rng.randrange(1_640_000_000, 1_720_000_000) * 1_000_000
            rows.append((k, start, start + rng.choice([0, -5, 3600, 86_400 * 3, 86_400 * 70]) * 1_000_000))
    rows += [("gap", 1_600_000_000_000_000, 1_600_000_100_000_000), ("gap", 1_700_000_000_000_000, 1_700_000_100_000_000), ("one", 1_711_836_000_000_000, 1_711_836_000_000_001)]
    df = spark.createDataFrame(rows, "k string, start_us long, end_us long")
    daily = calendar.daily(df, ["k"])
    want = calendar._summed(daily.withColumn("period", times.month(F.col("day"))), ["k", "period"])
    found = calendar.covered_months(df, ["k"])
    order = lambda x: sorted(map(str, map(tuple, x.select(*want.columns).collect())))
    assert order(found) == order(want)
    for skip in (False, True):
        a, b = calendar.monthly(daily, ["k"], skip), calendar.complete_months(df, ["k"], skip)
        assert sorted(map(str, map(tuple, a.collect()))) == sorted(map(str, map(tuple, b.select(*a.columns).collect())))
