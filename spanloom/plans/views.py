"""The driver's tables seen as interval tables, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times

LEVELS = {"click": "hromada", "view": "raion", "error": "oblast", "purchase": "other", "signup": "clear"}
ALERTS = ("hromada", "raion", "oblast")
#: 2024-01-25 12:00 UTC, the instant that queries are as of.
NOW_US = 1_706_184_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, k, raion, oblast, level, start_us, end_us): users as keys, nations as raions, regions as oblasts."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("raion"), F.col("n_regionkey").cast("long").alias("oblast"))
    level = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])[F.col("event_type")]
    start = times.micros(F.col("ts"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("k"), (F.col("user_id") % 25).alias("raion"), level.alias("level"), start.alias("start_us"),
        (start + F.round(F.col("value") * 60).cast("long") * times.SECOND).alias("end_us"),
    )
    return rows.join(nation, "raion").select("event_id", "k", "raion", "oblast", "level", "start_us", "end_us")


def alerts(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Spans of positive length of the given levels, or of all that are alerts."""
    return spans(spark, sf_dir).where(F.col("level").isin(list(levels or ALERTS)) & (F.col("end_us") > F.col("start_us")))


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, start_us, end_us): from order to shipment, per supplier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", times.micros(F.col("o_orderdate")).alias("start_us"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("k"), times.micros(F.col("l_shipdate")).alias("end_us"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where("end_us > start_us").select("k", "start_us", "end_us")


SPANS_SQL = """spans AS (
  SELECT event_id, user_id AS k, user_id % 25 AS raion, CAST(n_regionkey AS BIGINT) AS oblast,
         CASE event_type WHEN 'click' THEN 'hromada' WHEN 'view' THEN 'raion' WHEN 'error' THEN 'oblast'
                         WHEN 'purchase' THEN 'other' WHEN 'signup' THEN 'clear' END AS level,
         epoch_us(ts) AS start_us, epoch_us(ts) + CAST(round(value * 60) AS BIGINT) * 1000000 AS end_us
  FROM events JOIN nation ON n_nationkey = user_id % 25),
alerts AS (SELECT * FROM spans WHERE level IN ('hromada', 'raion', 'oblast') AND end_us > start_us),
fine AS (SELECT * FROM alerts WHERE level = 'hromada'), mid AS (SELECT * FROM alerts WHERE level = 'raion'),
coarse AS (SELECT * FROM alerts WHERE level = 'oblast')"""

ORDER_SPANS_SQL = """order_spans AS (
  SELECT l_suppkey AS k, epoch_us(o_orderdate) AS start_us, epoch_us(l_shipdate) AS end_us
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)"""


def local_day_sql(us: str) -> str:
    return f"CAST((make_timestamp({us}) AT TIME ZONE 'UTC') AT TIME ZONE '{times.ZONE}' AS DATE)"


def midnight_sql(day: str) -> str:
    return f"epoch_us(CAST({day} AS TIMESTAMP) AT TIME ZONE '{times.ZONE}')"


def islands_sql(name: str, source: str, keys: str) -> str:
    """CTEs that end in ``name`` (keys, start_us, end_us), the union of ``source``'s intervals."""
    return f"""{name}_p AS (
  SELECT *, max(end_us) OVER (PARTITION BY {keys} ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM {source}),
{name}_g AS (
  SELECT *, sum(CASE WHEN past IS NULL OR start_us > past THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS g FROM {name}_p),
{name} AS (SELECT {keys}, min(start_us) AS start_us, max(end_us) AS end_us FROM {name}_g GROUP BY {keys}, g)"""


def daily_sql(name: str, source: str, keys: str) -> str:
    """CTEs that end in ``name``: dense days with alerts_started, length_us and alert_us."""
    join = " AND ".join(f"s.{k} = d.{k}" for k in keys.split(", "))
    cover = " AND ".join(f"c.{k} = d.{k}" for k in keys.split(", "))
    return f"""{islands_sql(f'{name}_i', source, keys)},
{name}_x AS (SELECT *, unnest(generate_series({local_day_sql('start_us')}, {local_day_sql('end_us - 1')}, INTERVAL 1 DAY))::DATE AS day FROM {name}_i),
{name}_c AS (
  SELECT {keys}, day, sum(least(end_us, {midnight_sql('day + 1')}) - greatest(start_us, {midnight_sql('day')}))::BIGINT AS alert_us FROM {name}_x GROUP BY {keys}, day),
{name}_s AS (SELECT {keys}, {local_day_sql('start_us')} AS day, count(*) AS alerts_started, sum(end_us - start_us)::BIGINT AS length_us FROM {source} GROUP BY {keys}, 2),
{name}_d AS (
  SELECT {keys}, unnest(generate_series(min({local_day_sql('start_us')}), max({local_day_sql('end_us - 1')}), INTERVAL 1 DAY))::DATE AS day FROM {source} GROUP BY {keys}),
{name} AS (
  SELECT d.*, coalesce(alerts_started, 0) AS alerts_started, coalesce(length_us, 0) AS length_us, coalesce(alert_us, 0) AS alert_us
  FROM {name}_d d LEFT JOIN {name}_s s ON {join} AND s.day = d.day LEFT JOIN {name}_c c ON {cover} AND c.day = d.day)"""


def sweep_sql(name: str, a: str, b: str, keys: str) -> str:
    """CTEs that end in ``name`` (keys, start_us, end_us, a, b): stretches with the numbers of active intervals."""
    return f"""{name}_m AS (
  SELECT {keys}, start_us AS t, 1 AS x, 0 AS y FROM {a} UNION ALL SELECT {keys}, end_us, -1, 0 FROM {a}
  UNION ALL SELECT {keys}, start_us, 0, 1 FROM {b} UNION ALL SELECT {keys}, end_us, 0, -1 FROM {b}),
{name}_t AS (SELECT {keys}, t, sum(x) AS x, sum(y) AS y FROM {name}_m GROUP BY {keys}, t),
{name}_w AS (
  SELECT {keys}, t AS start_us, lead(t) OVER (PARTITION BY {keys} ORDER BY t) AS end_us,
         sum(x) OVER (PARTITION BY {keys} ORDER BY t) AS a, sum(y) OVER (PARTITION BY {keys} ORDER BY t) AS b FROM {name}_t),
{name} AS (SELECT * FROM {name}_w WHERE end_us IS NOT NULL)"""


RATES_SQL = """floor(alerts_started::DOUBLE / ({days})::DOUBLE * 1000 + 0.5) / 1000 AS alerts_per_day,
  floor(alert_us::DOUBLE / (({days}) * 3600000000)::DOUBLE * 1000 + 0.5) / 1000 AS alert_hours_per_day,
  CASE WHEN alerts_started <> 0 THEN floor(length_us::DOUBLE / (alerts_started * 60000000)::DOUBLE * 1000 + 0.5) / 1000 END AS mean_minutes"""
