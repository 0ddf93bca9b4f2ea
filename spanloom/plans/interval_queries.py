"""Queries of the interval and calendar operators, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import calendar, coverage, intervals
from spanloom.plans import views
from spanloom.plans.views import NOW_US, ORDER_SPANS_SQL, RATES_SQL, SPANS_SQL, alerts, daily_sql, islands_sql, order_spans, sweep_sql

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


@query(f"WITH {SPANS_SQL} SELECT DISTINCT k, raion, oblast, level, start_us, end_us FROM alerts")
def spans_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(spark, sf_dir).drop("event_id").dropDuplicates()


@query(f"WITH {SPANS_SQL}, {islands_sql('u', 'alerts', 'k')} SELECT * FROM u")
def union_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.islands(alerts(spark, sf_dir), ["k"])


@query(f"WITH {ORDER_SPANS_SQL}, {islands_sql('u', 'order_spans', 'k')} SELECT * FROM u")
def union_islands_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heavy case: long intervals, united first within quarters of a year."""
    return intervals.islands(order_spans(spark, sf_dir), ["k"], bucket_us=90 * times.DAY)


@query(f"WITH {SPANS_SQL}, {daily_sql('d', 'alerts', 'k')} SELECT k, day, alerts_started, length_us, alert_us FROM d")
def daily_alert_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.daily(alerts(spark, sf_dir), ["k"])


@query(f"WITH {SPANS_SQL} SELECT oblast, {views.local_day_sql('start_us')} AS day, count(*) AS alerts_started, sum(end_us - start_us)::BIGINT AS length_us FROM alerts GROUP BY ALL")
def start_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.started_daily(alerts(spark, sf_dir), ["oblast"])


_SUMS = "sum(alerts_started)::BIGINT AS alerts_started, sum(length_us)::BIGINT AS length_us, sum(alert_us)::BIGINT AS alert_us, count(*) AS days"


@query(f"""WITH {ORDER_SPANS_SQL}, {daily_sql('d', 'order_spans', 'k')},
p AS (SELECT k, date_trunc('month', day)::DATE AS period, {_SUMS} FROM d GROUP BY ALL),
f AS (SELECT k, min(day) AS first_day FROM d GROUP BY k)
SELECT p.*, {RATES_SQL.format(days='day(last_day(period))')} FROM p JOIN f USING (k) WHERE days = day(last_day(period)) AND period > first_day""")
def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.complete_months(order_spans(spark, sf_dir), ["k"], skip_first=True)


@query(f"""WITH {SPANS_SQL}, {daily_sql('d', 'alerts', 'oblast')},
p AS (SELECT oblast, date_trunc('week', day)::DATE AS period, {_SUMS} FROM d GROUP BY ALL)
SELECT p.*, {RATES_SQL.format(days='7')} FROM p WHERE days = 7""")
def weekly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.weekly(calendar.daily(alerts(spark, sf_dir), ["oblast"]), ["oblast"])


_LAST28 = f"""{daily_sql('d', 'alerts', 'k')}, e AS (SELECT k, max(day) AS end_day FROM d GROUP BY k),
l AS (SELECT d.*, floor(alert_us / 60000000.0::DOUBLE * 1000 + 0.5) / 1000 AS alert_minutes FROM d JOIN e USING (k) WHERE day > end_day - 28)"""


@query(f"WITH {SPANS_SQL}, {_LAST28} SELECT k, day, alerts_started, length_us, alert_us, alert_minutes FROM l")
def last28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.last_days(calendar.daily(alerts(spark, sf_dir), ["k"]), ["k"])


@query(f"""WITH {SPANS_SQL}, {_LAST28}
SELECT k, sum(alerts_started)::BIGINT AS alerts, floor(sum(alert_us)::DOUBLE / 3600000000::DOUBLE * 1000 + 0.5) / 1000 AS alert_hours,
  arg_max(day, (alerts_started, -epoch(day))) AS busiest_day, arg_max(day, (alert_us, -epoch(day))) AS longest_day,
  CASE WHEN sum(alerts_started) <> 0 THEN floor(sum(length_us)::DOUBLE / (sum(alerts_started) * 60000000)::DOUBLE * 1000 + 0.5) / 1000 END AS mean_minutes
FROM l GROUP BY k""")
def kpi28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.headline(last28(spark, sf_dir), ["k"])


@query(f"""WITH {SPANS_SQL}, {daily_sql('d', 'alerts', 'k')}, n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY day) AS turn FROM d),
w AS (SELECT k, day, CAST(sum(alerts_started) OVER z AS BIGINT) AS alerts_started, CAST(sum(length_us) OVER z AS BIGINT) AS length_us, CAST(sum(alert_us) OVER z AS BIGINT) AS alert_us, count(*) OVER z AS held
  FROM n WHERE turn > 1 WINDOW z AS (PARTITION BY k ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT k, day, alerts_started, length_us, alert_us, {RATES_SQL.format(days='7')} FROM w WHERE held = 7""")
def rolling7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.rolling(calendar.daily(alerts(spark, sf_dir), ["k"]), ["k"])


@query(f"""WITH {SPANS_SQL}, {daily_sql('d', 'alerts', 'oblast')}
SELECT day, {', '.join(f"any_value(alert_us) FILTER (oblast = {i}) AS alert_us_{i}" for i in range(5))} FROM d GROUP BY day HAVING count(DISTINCT oblast) = 5""")
def compare_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.compared(calendar.daily(alerts(spark, sf_dir), ["oblast"]), "day", "oblast", list(range(5)), "alert_us")


_HALF = 1_705_276_800_000_000


@query(f"""WITH {SPANS_SQL}, base AS (SELECT k, start_us, end_us FROM alerts WHERE start_us < {_HALF}),
live AS (SELECT k, start_us, end_us FROM alerts WHERE start_us >= {_HALF - 86_400_000_000})
SELECT *, false AS appended FROM base UNION ALL SELECT *, true FROM live WHERE start_us > (SELECT max(start_us) FROM base)""")
def append_after_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).select("k", "start_us", "end_us")
    return calendar.appended(rows.where(F.col("start_us") < _HALF), rows.where(F.col("start_us") >= _HALF - times.DAY))


def _swept(keep: str) -> str:
    return f"WITH {SPANS_SQL}, {sweep_sql('s', 'fine', 'mid', 'raion')}, kept AS (SELECT raion, start_us, end_us FROM s WHERE {keep}), {islands_sql('u', 'kept', 'raion')} SELECT * FROM u"


def _fine_mid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return alerts(spark, sf_dir, "hromada"), alerts(spark, sf_dir, "raion")


@query(_swept("a > 0 AND b > 0"))
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.intersection(*_fine_mid(spark, sf_dir), ["raion"])


@query(_swept("a > 0 AND b = 0"))
def interval_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.difference(*_fine_mid(spark, sf_dir), ["raion"])


@query(_swept("a > 0 OR b > 0"))
def interval_union2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.union(*_fine_mid(spark, sf_dir), ["raion"])


def _metrics_sql(source: str, keys: str) -> str:
    part = lambda c, n: f"coalesce(sum(end_us - start_us) FILTER ({c}), 0)::BIGINT AS {n}"
    share = lambda x, y, n: f"CASE WHEN {y} <> 0 THEN ({x})::DOUBLE * 100.0::DOUBLE / {y}::DOUBLE END AS {n}"
    count = lambda c, p, n: f"count(*) FILTER (({c}) AND NOT ({p})) AS {n}"
    any_before = "coalesce(pa, 0) > 0 OR coalesce(pb, 0) > 0"
    return f"""z AS (SELECT *, lag(a) OVER w AS pa, lag(b) OVER w AS pb FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY start_us)),
q AS (SELECT {keys}, {part('a > 0', 'a_us')}, {part('b > 0', 'b_us')}, {part('a > 0 AND b > 0', 'both_us')}, {part('a > 0 OR b > 0', 'either_us')},
  {part('a > 0 AND b = 0', 'a_only_us')}, {part('a = 0 AND b > 0', 'b_only_us')}, {count('a > 0', 'coalesce(pa, 0) > 0', 'a_intervals')}, {count('a > 0 OR b > 0', any_before, 'either_intervals')} FROM z GROUP BY {keys})
SELECT *, {share('both_us', 'a_us', 'coverage_pct')}, {share('both_us', 'b_us', 'precision_pct')}, {share('both_us', 'either_us', 'jaccard_pct')},
  {share('b_us - a_us', 'a_us', 'bias_pct')}, {share('either_us - a_us', 'a_us', 'increase_pct')}, {share('b_only_us', 'either_us', 'b_only_share_pct')} FROM q"""


@query(f"WITH {SPANS_SQL}, {sweep_sql('s', 'fine', 'mid', 'raion')}, {_metrics_sql('s', 'raion')}")
def proxy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.overlap_metrics(*_fine_mid(spark, sf_dir), ["raion"])


_PERIODS = [("first", 1_704_067_200_000_000, _HALF), ("second", _HALF, 1_707_000_000_000_000)]


@query(f"""WITH {SPANS_SQL}, periods(period, low_us, high_us) AS (VALUES {', '.join(map(str, _PERIODS))}),
cut AS (SELECT raion, level, period, greatest(start_us, low_us) AS start_us, least(end_us, high_us) AS end_us FROM alerts, periods WHERE start_us < high_us AND end_us > low_us),
fine2 AS (SELECT * FROM cut WHERE level = 'hromada'), mid2 AS (SELECT * FROM cut WHERE level = 'raion'),
{sweep_sql('s', 'fine2', 'mid2', 'raion, period')}, {_metrics_sql('s', 'raion, period')}""")
def proxy_metrics_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = spark.createDataFrame(_PERIODS, "period string, low_us long, high_us long")
    fine, mid = (coverage.in_periods(x, periods) for x in _fine_mid(spark, sf_dir))
    return coverage.overlap_metrics(fine, mid, ["raion", "period"])


_PARTS = "SELECT raion, oblast, level, start_us, end_us FROM alerts WHERE level IN ('raion', 'oblast')"


@query(f"""WITH {SPANS_SQL}, l AS ({_PARTS}), {islands_sql('e', 'l', 'oblast')}, o AS (SELECT * FROM l WHERE level = 'oblast'), {islands_sql('w', 'o', 'oblast')},
r AS (SELECT * FROM l WHERE level = 'raion'), {islands_sql('m', 'r', 'oblast, raion')},
t AS (SELECT oblast, start_us AS t, 1 AS x FROM m UNION ALL SELECT oblast, end_us, -1 FROM m), g AS (SELECT oblast, t, sum(x) AS x FROM t GROUP BY ALL),
v AS (SELECT oblast, t AS start_us, lead(t) OVER z AS end_us, sum(x) OVER z AS active FROM g WINDOW z AS (PARTITION BY oblast ORDER BY t)),
size AS (SELECT CAST(n_regionkey AS BIGINT) AS oblast, count(*) AS members FROM nation GROUP BY 1),
f AS (SELECT v.oblast, start_us, end_us FROM v JOIN size USING (oblast) WHERE end_us IS NOT NULL AND active = members UNION ALL SELECT oblast, start_us, end_us FROM w), {islands_sql('u', 'f', 'oblast')},
a AS (SELECT oblast, sum(end_us - start_us)::BIGINT AS any_us, count(*) AS episodes FROM e GROUP BY oblast),
x AS (SELECT oblast, sum(end_us - start_us)::BIGINT AS explicit_us FROM w GROUP BY oblast), b AS (SELECT oblast, sum(end_us - start_us)::BIGINT AS full_us FROM u GROUP BY oblast),
c AS (SELECT oblast, count(*) AS full_episodes FROM e WHERE EXISTS (SELECT 1 FROM u WHERE u.oblast = e.oblast AND u.start_us < e.end_us AND u.end_us > e.start_us) GROUP BY oblast),
d AS (SELECT oblast, count(DISTINCT raion) AS members_seen FROM r GROUP BY oblast)
SELECT oblast, any_us, episodes, coalesce(explicit_us, 0) AS explicit_us, coalesce(full_us, 0) AS full_us, coalesce(full_episodes, 0) AS full_episodes, coalesce(members_seen, 0) AS members_seen,
  CASE WHEN any_us <> 0 THEN coalesce(explicit_us, 0)::DOUBLE * 100.0::DOUBLE / any_us::DOUBLE END AS explicit_pct, CASE WHEN any_us <> 0 THEN coalesce(full_us, 0)::DOUBLE * 100.0::DOUBLE / any_us::DOUBLE END AS full_pct,
  CASE WHEN episodes <> 0 THEN coalesce(full_episodes, 0)::DOUBLE * 100.0::DOUBLE / episodes::DOUBLE END AS full_episodes_pct
FROM a LEFT JOIN x USING (oblast) LEFT JOIN b USING (oblast) LEFT JOIN c USING (oblast) LEFT JOIN d USING (oblast)""")
def full_coverage_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raions of an oblast, or an alert of the oblast itself. Highest share first."""
    sizes = views.table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("long").alias("oblast")).agg(F.count("*").alias("members"))
    rows = alerts(spark, sf_dir, "raion", "oblast")
    return coverage.by_share(coverage.full_coverage(rows, "oblast", "raion", sizes, F.col("level") == "oblast"))


_ALONE = "NOT EXISTS (SELECT 1 FROM coarse c WHERE c.oblast = m.oblast AND c.start_us < m.end_us AND c.end_us > m.start_us)"


@query(f"WITH {SPANS_SQL} SELECT * FROM mid m WHERE {_ALONE}")
def events_without_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlapping(alerts(spark, sf_dir, "raion"), alerts(spark, sf_dir, "oblast"), ["oblast"], "left_anti")


@query(f"""WITH {SPANS_SQL}, {sweep_sql('s', 'mid', 'coarse', 'oblast')},
x AS (SELECT oblast, coalesce(sum(end_us - start_us) FILTER (a > 0), 0)::BIGINT AS a_us, coalesce(sum(end_us - start_us) FILTER (b > 0), 0)::BIGINT AS b_us,
  coalesce(sum(end_us - start_us) FILTER (a > 0 AND b > 0), 0)::BIGINT AS both_us, coalesce(sum(end_us - start_us) FILTER (a > 0 AND b = 0), 0)::BIGINT AS a_only_us,
  coalesce(sum(end_us - start_us) FILTER (a = 0 AND b > 0), 0)::BIGINT AS b_only_us FROM s GROUP BY oblast),
g AS (SELECT oblast, start_us - lag(start_us) OVER (PARTITION BY oblast ORDER BY start_us) AS gap FROM (SELECT DISTINCT oblast, start_us FROM mid)),
n AS (SELECT oblast, count(*) AS alone FROM mid m WHERE {_ALONE} GROUP BY oblast)
SELECT m.oblast, count(*) AS events, min(start_us) AS first_us, max(start_us) AS last_us, (SELECT max(gap) FROM g WHERE g.oblast = m.oblast) AS largest_gap_us,
  coalesce(any_value(alone), 0) AS alone, any_value(a_us) AS a_us, any_value(b_us) AS b_us, any_value(both_us) AS both_us, any_value(a_only_us) AS a_only_us,
  any_value(b_only_us) AS b_only_us
FROM mid m JOIN x ON x.oblast = m.oblast LEFT JOIN n ON n.oblast = m.oblast GROUP BY m.oblast""")
def source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.source_audit(alerts(spark, sf_dir, "raion"), alerts(spark, sf_dir, "oblast"), ["oblast"])


_GAP, _TAIL, _REACH = 60 * times.DAY, 3, 400 * times.DAY


@query(f"""WITH d AS (SELECT DISTINCT o_custkey AS k, epoch_us(o_orderdate) AS start_us FROM orders),
x AS (SELECT *, start_us - lag(start_us) OVER (PARTITION BY k ORDER BY start_us) AS gap, count(*) OVER (PARTITION BY k ORDER BY start_us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_n,
  max(start_us) OVER (PARTITION BY k) AS last_us FROM d),
c AS (SELECT k, coalesce(max(start_us) FILTER (gap >= {_GAP} AND left_n >= {_TAIL} AND last_us >= (SELECT max(start_us) FROM d) - {_REACH}), min(start_us)) AS stable_us, min(start_us) AS first_us, max(start_us) AS last_observed_us FROM x GROUP BY k)
SELECT k, stable_us, first_us, last_observed_us, coalesce(max(gap) FILTER (start_us = stable_us), 0) AS gap_before_us, count(*) AS tail_events, coalesce(max(gap) FILTER (start_us > stable_us), 0) AS tail_gap_us
FROM x JOIN c USING (k) WHERE start_us >= stable_us GROUP BY k, stable_us, first_us, last_observed_us""")
def stable_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = times.micros(F.col("o_orderdate"))
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), start.alias("start_us"), start.alias("end_us"))
    return coverage.stable_start(rows, ["k"], gap_us=_GAP, tail=_TAIL, reach_us=_REACH).na.fill(0, ["tail_gap_us", "gap_before_us"])


_YEARS = ((NOW_US - 20 * times.DAY, NOW_US - 5 * times.DAY), (NOW_US - 5 * times.DAY, NOW_US + 60 * times.DAY))


@query(f"""WITH {SPANS_SQL}, n AS (SELECT max(end_us) AS newest FROM fine), p AS (SELECT DISTINCT k, k % 7 <> 0 AS matched FROM spans),
c AS (SELECT k, count(*) FILTER (start_us >= {_YEARS[0][0]} AND start_us < {_YEARS[0][1]}) AS before_n, count(*) FILTER (start_us >= {_YEARS[1][0]} AND start_us < {_YEARS[1][1]}) AS now_n,
  count(*) FILTER (start_us >= newest - {3 * times.DAY}) AS recent_n FROM fine, n GROUP BY k),
x AS (SELECT k, matched, coalesce(before_n, 0) AS before_n, coalesce(now_n, 0) AS now_n, coalesce(recent_n, 0) AS recent_n FROM p LEFT JOIN c USING (k))
SELECT *, CASE WHEN NOT matched THEN 'no_states_match' WHEN now_n >= 10 AND recent_n >= 2 THEN 'current_exact_city_candidate' WHEN now_n > 0 THEN 'sparse_or_intermittent_2026'
  WHEN before_n > 0 THEN 'historical_2025_only' ELSE 'no_2025_2026_exact_city_events' END AS status FROM x""")
def activity_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as places, those with a key divisible by seven without a match; two stretches of the month as the years."""
    places = views.spans(spark, sf_dir).select("k", (F.col("k") % 7 != 0).alias("matched")).distinct()
    return coverage.activity(places, alerts(spark, sf_dir, "hromada"), ["k"], *_YEARS, recent_us=3 * times.DAY)
