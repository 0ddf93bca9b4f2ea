"""Queries of the ledger, observation, ingest, proof, snapshot and text operators, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times, words
from spanloom.operators import coverage, ingest, ledger, observations, proofs, snapshot
from spanloom.plans import views
from spanloom.plans.views import NOW_US, SPANS_SQL, alerts, islands_sql, spans, table
from spanloom.sources import histories, pages

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


@query("""WITH p AS (SELECT n_nationkey AS g, n_name AS name FROM nation), c AS (
  SELECT s_nationkey AS g, 'м. NATION_' || (s_suppkey % 40) || CASE WHEN s_suppkey % 3 = 0 THEN ' міська' ELSE '' END AS name FROM supplier
  UNION SELECT c_nationkey, 'old Nation_' || (c_custkey % 40) || ' west' FROM customer UNION SELECT c_nationkey, 'м. NATION_' || (c_custkey % 40) || 'x' FROM customer),
m AS (SELECT p.g, p.name, c.name AS candidate, CASE WHEN c.name = 'м. ' || p.name OR starts_with(c.name, 'м. ' || p.name || ' ') THEN 100 WHEN contains(lower(c.name), lower(p.name)) THEN 50 END AS score FROM p JOIN c USING (g))
SELECT CAST(g AS BIGINT) AS g, name, (arg_max(candidate, (score, candidate))) AS candidate, max(score) AS score FROM m WHERE score IS NOT NULL GROUP BY g, name""")
def best_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("g"), F.col("n_name").alias("name"))
    made = lambda t, g, key, head, tail: table(spark, sf_dir, t).select(F.col(g).cast("long").alias("g"), F.concat(F.lit(head), F.col(key) % 40, tail).alias("name"))
    candidates = made("supplier", "s_nationkey", "s_suppkey", "м. NATION_", F.when(F.col("s_suppkey") % 3 == 0, " міська").otherwise(""))
    candidates = candidates.union(made("customer", "c_nationkey", "c_custkey", "old Nation_", F.lit(" west"))).union(made("customer", "c_nationkey", "c_custkey", "м. NATION_", F.lit("x")))
    return coverage.best_match(names, candidates.distinct(), ["g"])


@query("""WITH b AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS deaths FROM orders GROUP BY 1),
d AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS delta FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT month, coalesce(deaths, 0) AS deaths, coalesce(delta, 0) AS delta, coalesce(deaths, 0) + coalesce(delta, 0) AS total FROM b FULL JOIN d USING (month)""")
def month_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("deaths"))
    status = F.when(F.col("l_returnflag") == "R", "confirmed").otherwise("pending")
    revisions = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), status.alias("status"), F.lit(1).cast("long").alias("deaths_delta"))
    return ledger.monthly_counts(baseline, revisions)


@query("""WITH b AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS deaths FROM orders GROUP BY 1),
d AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, -count(*) AS delta FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT month, coalesce(deaths, 0) AS deaths, coalesce(delta, 0) AS delta, coalesce(deaths, 0) + coalesce(delta, 0) AS total FROM b FULL JOIN d USING (month) WHERE coalesce(deaths, 0) + coalesce(delta, 0) < 0""")
def negative_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that revisions downwards make negative, which may not be published."""
    baseline = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("deaths"))
    status = F.when(F.col("l_returnflag") == "R", "confirmed").otherwise("pending")
    revisions = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), status.alias("status"), F.lit(-1).cast("long").alias("deaths_delta"))
    return ledger.negative_totals(ledger.monthly_counts(baseline, revisions))


_EFFECT = """SELECT l_orderkey AS incident, coalesce(arg_max(CAST(l_quantity AS BIGINT), (l_linenumber, l_quantity, l_partkey)) FILTER (l_returnflag <> 'R'), 0)
  + coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0)::BIGINT - 2 AS effect FROM {0} GROUP BY l_orderkey"""


@query(f"""WITH old AS (SELECT * FROM lineitem WHERE l_linenumber <= 3), a AS ({_EFFECT.format('lineitem')}), b AS ({_EFFECT.format('old')})
SELECT incident, coalesce(b.effect, 0) AS before, coalesce(a.effect, 0) AS after, coalesce(a.effect, 0) - coalesce(b.effect, 0) AS change FROM a FULL JOIN b USING (incident)""")
def effective_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("incident"), F.when(F.col("l_returnflag") == "R", "delta").otherwise("cumulative").alias("count_kind"),
        F.col("l_quantity").cast("long").alias("n"), F.lit(2).alias("credited"), "l_linenumber", "l_quantity", "l_partkey")
    order = [F.col("l_linenumber"), F.col("l_quantity"), F.col("l_partkey")]
    after = ledger.effective(rows, ["incident"], order)
    before = ledger.effective(rows.where("l_linenumber <= 3"), ["incident"], order)
    return ledger.effect_of(before, after, ["incident"])


@query("""WITH c AS (SELECT o_orderkey AS record_id, 'c' || o_orderkey AS candidate_id, year(o_orderdate)::BIGINT AS y FROM orders),
l AS (SELECT l_orderkey AS record_id, min(year(l_shipdate))::BIGINT AS y, CASE WHEN l_orderkey % 3 = 0 THEN ['c' || l_orderkey] ELSE ['x'] END AS ids FROM lineitem GROUP BY l_orderkey)
SELECT c.candidate_id, c.record_id, c.y, CASE WHEN l.record_id IS NULL THEN 'insert' WHEN c.y IS DISTINCT FROM l.y THEN 'conflict' WHEN list_contains(ids, c.candidate_id) THEN 'none' ELSE 'link' END AS action,
  CASE WHEN l.record_id IS NULL OR (c.y = l.y AND list_contains(ids, c.candidate_id)) THEN c.candidate_id WHEN c.y = l.y THEN c.candidate_id || '|x' END AS candidate_ids
FROM c LEFT JOIN l USING (record_id)""")
def promote_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.concat(F.lit("c"), "o_orderkey").alias("candidate_id"), F.year("o_orderdate").cast("long").alias("y"))
    ids = F.array(F.when(F.col("record_id") % 3 == 0, F.concat(F.lit("c"), "record_id")).otherwise("x"))
    old = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("record_id")).agg(F.min(F.year("l_shipdate")).cast("long").alias("y"))
    return ledger.promoted(candidates, old.withColumn("candidate_ids", ids), ["y"]).withColumn("candidate_ids", F.array_join("candidate_ids", "|"))


@query("""WITH d AS (SELECT doc_id AS id, source AS city, md5(text) AS url, sha256(lower(text)) AS title, CAST(n_chars % 40 AS VARCHAR) AS day FROM documents),
u AS (SELECT city, min(id) OVER (PARTITION BY city, url) AS a, id AS b FROM d WHERE url IS NOT NULL), t AS (SELECT city, min(id) OVER (PARTITION BY city, title) AS a, id AS b FROM d WHERE title IS NOT NULL),
m AS (SELECT * FROM u WHERE a <> b UNION SELECT * FROM t WHERE a <> b), y AS (SELECT city, min(id) OVER (PARTITION BY city, day) AS a, id AS b FROM d)
SELECT city, a, b, 'media' AS kind FROM m UNION ALL SELECT city, a, b, 'day' FROM (SELECT * FROM y WHERE a <> b EXCEPT SELECT * FROM m)""")
def duplicate_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("city"), F.md5(F.col("text").cast("binary")).alias("url"),
                                                    F.sha2(F.lower("text").cast("binary"), 256).alias("title"), (F.col("n_chars") % 40).cast("string").alias("day"))
    return ledger.duplicate_warnings(rows, "city", "url", "title", "day")


_OBSERVED = """SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_quantity AS q, l_extendedprice AS e, l_returnflag AS f,
  row_number() OVER w AS turn, first_value(l_returnflag) OVER w AS f0, first_value(l_quantity) OVER w AS q0 FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag)"""


@query(f"""WITH x AS ({_OBSERVED}) SELECT o, n, p, s, e, CASE WHEN turn = 1 THEN 'FIRST' WHEN f <> f0 THEN 'CONFLICT' WHEN q = q0 THEN 'EXACT' ELSE 'EQUIVALENT' END AS class FROM x""")
def observation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations.canonical(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_quantity"])
    rows = observations.classed(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"])
    return rows.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("e"), "class")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return observations.dangling(table(spark, sf_dir, "orders").select("o_orderkey"), lines, ["o_orderkey"])


@query("""SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), '|') AS episodes FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) GROUP BY l_orderkey""")
def referring_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    twice = observations.repeated_keys(rows, ["l_orderkey", "l_linenumber"])
    return observations.referring(rows, twice, ["l_orderkey"], "l_suppkey").withColumn("episodes", F.array_join("episodes", "|"))


_POLLS = """p AS (SELECT k AS region, start_us // 3600000000 AS hour, level, end_us, event_id AS fetched_us, event_id % 7 AS slice FROM spans),
store AS (SELECT * FROM p WHERE slice < 5), polled AS (SELECT * FROM p WHERE slice >= 3)"""


@query(f"""WITH {SPANS_SQL}, {_POLLS}, x AS (SELECT * FROM store UNION ALL SELECT * FROM polled)
SELECT region, hour, level, arg_max(end_us, (fetched_us, end_us)) AS end_us, max(fetched_us) AS fetched_us, min(fetched_us) AS first_fetched_us FROM x GROUP BY region, hour, level""")
def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir).select(F.col("k").alias("region"), F.floor(F.col("start_us") / 3_600_000_000).alias("hour"), "level", "end_us", F.col("event_id").alias("fetched_us"), (F.col("event_id") % 7).alias("slice"))
    return ingest.upserted(rows.where("slice < 5").drop("slice"), rows.where("slice >= 3").drop("slice"), ["region", "hour", "level"])


_CUT = NOW_US - 2 * times.DAY


_POLLED = f"SELECT k AS region, start_us, end_us, CASE WHEN level IN ('hromada', 'raion', 'oblast') THEN 'Air' ELSE 'OTHER' END AS kind FROM spans WHERE start_us >= {_CUT} AND NOT (k % 6 = 0)"


@query(f"""WITH {SPANS_SQL}, t AS (SELECT DISTINCT k AS region, {_CUT} + k * 600000000 AS cutoff_us FROM spans), h AS (SELECT DISTINCT k AS region FROM spans WHERE k % 12 <> 0),
p AS (SELECT region, min(start_us) AS oldest_us, max(end_us) FILTER (kind = 'Air' AND end_us > start_us) AS latest_us, count(*) AS history_n, count(*) FILTER (kind = 'Air' AND end_us > start_us) AS completed_n FROM ({_POLLED}) GROUP BY region)
SELECT region, cutoff_us, coalesce(oldest_us, -1) AS oldest_us, coalesce(latest_us, -1) AS latest_us, coalesce(history_n, 0) AS history_n, coalesce(completed_n, 0) AS completed_n, coalesce(history_n, 0) >= 25 AS limit_hit, coalesce(oldest_us <= cutoff_us, false) AS continuous,
  CASE WHEN h.region IS NULL THEN 'region_missing_from_history_payload' WHEN oldest_us <= cutoff_us THEN 'history_overlaps_upstream' ELSE 'history_window_does_not_reach_upstream' END AS reason
FROM t LEFT JOIN h USING (region) LEFT JOIN p USING (region)""")
def continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth user has no rows in the poll: half of these answered with an empty history, half not at all."""
    rows = spans(spark, sf_dir).withColumnRenamed("k", "region")
    targets = rows.select("region", (F.col("region") * 600_000_000 + _CUT).alias("cutoff_us")).distinct()
    kind = F.when(F.col("level").isin("hromada", "raion", "oblast"), "Air").otherwise("OTHER")
    polled = rows.where((F.col("start_us") >= _CUT) & (F.col("region") % 6 != 0)).withColumn("kind", kind)
    return ingest.continuity(targets, polled, rows.where("region % 12 <> 0").select("region")).na.fill(-1, ["oldest_us", "latest_us"])


def _targets(rows: DataFrame) -> DataFrame:
    return rows.select("region", (F.col("region") * 600_000_000 + _CUT).alias("cutoff_us")).distinct()


@query(f"""WITH {SPANS_SQL}, s AS (SELECT k AS region, {_CUT} + k * 600000000 AS cutoff_us FROM alerts GROUP BY k HAVING coalesce(min(start_us) FILTER (start_us >= {_CUT}) <= {_CUT} + k * 600000000, false)),
r AS (SELECT k AS region, start_us, end_us FROM alerts WHERE start_us < {_CUT} UNION ALL SELECT region, start_us, end_us FROM s JOIN alerts ON k = region WHERE start_us >= {_CUT} AND end_us > cutoff_us),
{islands_sql('u', 'r', 'region')} SELECT * FROM u""")
def bridged_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).withColumnRenamed("k", "region")
    return ingest.bridged_union(rows.where(F.col("start_us") < _CUT), rows.where(F.col("start_us") >= _CUT), ingest.continuity(_targets(rows), rows.where(F.col("start_us") >= _CUT)))


@query(f"""WITH {SPANS_SQL}, m AS (SELECT DISTINCT raion, start_us AS ts, CASE level WHEN 'oblast' THEN 'start' ELSE 'end' END AS kind FROM spans WHERE level IN ('oblast', 'clear')),
x AS (SELECT *, lag(kind) OVER w AS before, (min(CASE WHEN kind = 'end' THEN ts END) OVER (PARTITION BY raion ORDER BY ts, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS end_us FROM m WINDOW w AS (PARTITION BY raion ORDER BY ts, kind))
SELECT raion, ts AS start_us, end_us FROM x WHERE kind = 'start' AND coalesce(before, 'end') = 'end' AND end_us > ts""")
def pair_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = spans(spark, sf_dir).where("level in ('oblast', 'clear')")
    marks = marks.select("raion", F.col("start_us").alias("ts_us"), F.when(F.col("level") == "oblast", "start").otherwise("end").alias("kind"))
    return ingest.paired(marks, ["raion"])


_KNOWN = f"known AS (SELECT k, start_us, CASE WHEN end_us <= {NOW_US} THEN end_us END AS end_us FROM alerts WHERE start_us <= {NOW_US})"


@query(f"""WITH {SPANS_SQL}, {_KNOWN}, o AS (SELECT k, count(*) AS open_n, max(start_us) AS start_us FROM known WHERE end_us IS NULL GROUP BY k), l AS (SELECT k, max(start_us) AS last_us FROM known GROUP BY k)
SELECT k, open_n, start_us, last_us, {NOW_US} - start_us AS age_us, open_n = 1 AND start_us = last_us AND {NOW_US} - start_us <= 129600000000 AS valid FROM o JOIN l USING (k)""")
def open_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(NOW_US)
    return snapshot.open_intervals(snapshot.cut_at(alerts(spark, sf_dir).select("k", "start_us", "end_us"), now), ["k"], now)


_DAY0 = f"(SELECT {views.local_day_sql(str(NOW_US))} AS d)"
@query()
def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = snapshot.cut_at(alerts(spark, sf_dir).select("k", "start_us", "end_us"), F.lit(NOW_US)).where("end_us is not null")
    return snapshot.period_totals(closed, ["k"], snapshot.periods(spark, NOW_US))


SQL["period_totals"] = f"""WITH {SPANS_SQL}, {_KNOWN}, closed AS (SELECT * FROM known WHERE end_us IS NOT NULL), {islands_sql('u', 'closed', 'k')},
d0 AS {_DAY0}, p AS ({' UNION ALL '.join(f"SELECT '{n}' AS period, {views.midnight_sql(x)} AS low_us FROM d0" for n, x in [
    ("day", "d"), ("week", "date_trunc('week', d)"), ("month", "date_trunc('month', d)"), ("quarter", "date_trunc('quarter', d)"), *[(f"last{n}", f"d - {n - 1}") for n in (7, 28, 30, 90, 180)]])}
  UNION ALL SELECT 'all', -4611686018427387904)
SELECT k, period, sum(least(end_us, {NOW_US}) - greatest(start_us, low_us))::BIGINT AS closed_us FROM u, p WHERE end_us > low_us AND start_us < {NOW_US} GROUP BY k, period"""


@query()
def provisional_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = snapshot.cut_at(alerts(spark, sf_dir).select("k", "start_us", "end_us"), F.lit(NOW_US))
    return snapshot.provisional_totals(known.where("end_us is not null"), known.where("end_us is null"), ["k"], snapshot.periods(spark, NOW_US), F.lit(NOW_US))


_TOTALS = "SELECT k, period, sum(least(end_us, {0}) - greatest(start_us, low_us))::BIGINT AS {2} FROM {1}, p WHERE end_us > low_us AND start_us < {0} GROUP BY k, period"
SQL["provisional_totals"] = SQL["period_totals"].partition("SELECT k, period, sum(least")[0] + f""", every AS (SELECT k, start_us, coalesce(end_us, {NOW_US}) AS end_us FROM known WHERE start_us < {NOW_US}), {islands_sql('v', 'every', 'k')},
a AS ({_TOTALS.format(NOW_US, 'u', 'closed_us')}), b AS ({_TOTALS.format(NOW_US, 'v', 'provisional_us')}) SELECT k, period, coalesce(closed_us, 0) AS closed_us, provisional_us FROM b LEFT JOIN a USING (k, period)"""


@query(f"""WITH {SPANS_SQL}, s AS (SELECT k, max(end_us) AS checked_us, count(*) > 30 AS continuous FROM alerts WHERE start_us < {NOW_US} GROUP BY k)
SELECT k, checked_us, continuous, {NOW_US} - checked_us AS age_us, concat_ws('|', CASE WHEN {NOW_US} < checked_us THEN 'from the future' END, CASE WHEN {NOW_US} - checked_us > 129600000000 THEN 'too old' END,
  CASE WHEN NOT continuous THEN 'not continuous' END) AS reasons, checked_us BETWEEN {NOW_US} - 129600000000 AND {NOW_US} AND continuous AS fresh FROM s""")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).where(F.col("start_us") < NOW_US).groupBy("k").agg(F.max("end_us").alias("checked_us"), (F.count("*") > 30).alias("continuous"))
    return proofs.freshness(rows, F.lit(NOW_US)).withColumn("reasons", F.array_join("reasons", "|"))


@query(f"""WITH {SPANS_SQL}, h AS (SELECT event_id, end_us, unnest([0, 24, 72, 168]) AS hours FROM alerts)
SELECT event_id, end_us, hours FROM h WHERE end_us + hours * 3600000000 <= {NOW_US} AND NOT (hours = 0 AND event_id % 2 = 0)""")
def due_followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir)
    done = rows.where("event_id % 2 = 0").select("event_id", F.lit(0).alias("hours"))
    return snapshot.due(rows, F.lit(NOW_US), done)


_ISO = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {0} % 1000000 > 0 THEN '.' || lpad(CAST({0} % 1000000 AS VARCHAR), 6, '0') ELSE '' END || 'Z'"
_EPISODE = f"left(sha256(CAST(raion AS VARCHAR) || '|' || {_ISO.format('start_us')} || '|' || {_ISO.format('end_us')}), 24)"


@query(f"WITH {SPANS_SQL}, {islands_sql('u', 'alerts', 'raion')} SELECT *, {_EPISODE} AS episode_id FROM u")
def episode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.episodes(alerts(spark, sf_dir), "raion")


@query(f"""WITH {SPANS_SQL}, {islands_sql('u', 'alerts', 'raion')} SELECT event_id, a.raion, a.start_us, a.end_us,
  CASE WHEN a.start_us <> u.start_us OR a.end_us <> u.end_us THEN {_EPISODE.replace('raion', 'u.raion').replace('start_us', 'u.start_us').replace('end_us', 'u.end_us')} END AS superseded_by
FROM alerts a JOIN u ON u.raion = a.raion AND a.start_us >= u.start_us AND a.end_us <= u.end_us""")
def superseded_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.superseded(alerts(spark, sf_dir).select("event_id", "raion", "start_us", "end_us"), "raion")


@query(f"WITH {SPANS_SQL} (SELECT k, start_us, end_us FROM alerts WHERE event_id % 10 < 7) EXCEPT ALL (SELECT k, start_us, end_us FROM alerts WHERE event_id % 10 >= 3)")
def interval_superset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir)
    part = lambda c: rows.where(c).select("k", "start_us", "end_us")
    return proofs.lost(part("event_id % 10 < 7"), part("event_id % 10 >= 3"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'")
def multiset_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return proofs.lost(rows.select("l_orderkey", "l_linenumber"), rows.where("l_returnflag <> 'R'"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
SELECT k, 'a' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT k, 'b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def unequal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an urgent order against those with a pending one."""
    orders = table(spark, sf_dir, "orders")
    return proofs.unequal_sets(*(orders.where(c).select(F.col("o_custkey").alias("k")).distinct() for c in ("o_orderpriority = '1-URGENT'", "o_orderstatus = 'P'")))


def _text_sql(columns: str) -> str:
    """The text of a row as in ``proofs.row_text``; ``columns`` are name:kind, kind one of t (as text), d (with a fraction), u (instant), l (list of d)."""
    said = {"t": "CAST({c} AS VARCHAR)", "d": "CAST(CAST(floor({c} * 1000000 + 0.5) AS BIGINT) AS VARCHAR)", "u": "CAST(epoch_us({c}) AS VARCHAR)",
            "l": "array_to_string(list_transform({c}, lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS VARCHAR)), ',')"}
    each = []
    for name, kind in sorted(c.split(":") for c in columns.split()):
        value = said[kind].format(c=name)
        each.append(f"coalesce('{name}=' || strlen({value}) || ':' || {value} || ';', '{name}=;')")
    return " || ".join(each)


def _tree_sql(name: str, source: str, keys: str, text: str, deepest: int = 8) -> str:
    """CTEs that end in ``name`` (keys, n, digest, hash_sum), the roots of the digest trees of ``source``'s rows."""
    by = f"{keys}, " if keys else ""
    one = f"SELECT {by}count(*) AS n FROM {source} GROUP BY {keys}" if keys else f"SELECT count(*) AS n FROM {source}"
    depth = f"(SELECT greatest(0, CAST(ceil(log(max(n) / {proofs.LEAF}.0) / log({proofs.FAN}.0) - 1e-12) AS BIGINT)) FROM ({one}))"
    parts = [f"{name}_h AS (SELECT {by}h, count(*) AS n, {depth} AS depth FROM (SELECT {by}sha256({text}) AS h FROM {source}) GROUP BY {by}h)"]
    leaf = f"SELECT {by}left(h, depth) AS prefix, sum(n)::BIGINT AS n, sha256(string_agg(h || ':' || n || ';', '' ORDER BY h)) AS digest, sum(('0x' || left(h, 12))::BIGINT::HUGEINT * n) AS hash_sum FROM {name}_h WHERE depth = {{l}} GROUP BY {by}left(h, depth)"
    for level in range(deepest, -1, -1):
        up = f" UNION ALL SELECT {by}left(prefix, {level}), sum(n)::BIGINT, sha256(string_agg(prefix || ':' || digest || ';', '' ORDER BY prefix)), sum(hash_sum) FROM {name}_{level + 1} GROUP BY {by}left(prefix, {level})" if level < deepest else ""
        parts.append(f"{name}_{level} AS ({leaf.format(l=level)}{up})")
    return ", ".join([*parts, f"{name} AS (SELECT {by}n, digest, CAST(hash_sum AS VARCHAR) AS hash_sum FROM {name}_0)"])


@query(f"""WITH {SPANS_SQL}, {islands_sql('u', 'alerts', 'raion')}, e AS (SELECT CAST(raion AS VARCHAR) AS city, {_EPISODE} AS episode_id, start_us, end_us FROM u),
{_tree_sql('t', 'e', 'city', _text_sql('city:t episode_id:t start_us:t end_us:t'))} SELECT * FROM t""")
def corpus_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.episodes(alerts(spark, sf_dir), "raion").select(F.col("raion").cast("string").alias("city"), "episode_id", "start_us", "end_us")
    return proofs.fingerprint(rows, ["city"], proofs.row_text(rows))


_TABLES = {
    "region": "r_regionkey:t r_name:t", "nation": "n_nationkey:t n_name:t n_regionkey:t", "customer": "c_custkey:t c_name:t c_nationkey:t c_acctbal:d c_mktsegment:t",
    "supplier": "s_suppkey:t s_name:t s_nationkey:t s_acctbal:d", "part": "p_partkey:t p_name:t p_brand:t p_type:t p_size:t p_retailprice:d",
    "orders": "o_orderkey:t o_custkey:t o_orderstatus:t o_totalprice:d o_orderdate:u o_orderpriority:t",
    "lineitem": "l_orderkey:t l_partkey:t l_suppkey:t l_linenumber:t l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag:t l_linestatus:t l_shipdate:u",
    "events": "event_id:t ts:u user_id:t event_type:t value:d props:t", "documents": "doc_id:t text:t lang:t source:t n_chars:t", "embeddings": "vec_id:t embedding:l label:t",
    "pages": "page_id:t url:t html:t", "benchmark": "item_id:t text:t", "labels": "doc_id:t quality:t toxic:t", "conversations": "conv_id:t turn:t role:t text:t",
}


@query("WITH " + ", ".join(_tree_sql(f"t_{n}", n, "", _text_sql(c)) for n, c in _TABLES.items()) + " " + " UNION ALL ".join(f"SELECT '{n}' AS name, n, digest AS sha256 FROM t_{n}" for n in _TABLES))
def table_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs.manifest({n: table(spark, sf_dir, n) for n in _TABLES})


@query(f"""WITH a AS (SELECT *, sha256({_text_sql(_TABLES['orders'])}) AS h FROM orders),
c AS (SELECT * REPLACE (CASE WHEN o_totalprice < 20000 THEN 'X' ELSE o_orderpriority END AS o_orderpriority) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R' AND l_discount = 0.1)),
d AS (SELECT *, sha256({_text_sql(_TABLES['orders'])}) AS h FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE o_totalprice > 400000))
SELECT o_orderstatus, h, coalesce(x, 0) AS before, coalesce(y, 0) AS after FROM (SELECT o_orderstatus, h, count(*) AS x FROM a GROUP BY ALL) FULL JOIN (SELECT o_orderstatus, h, count(*) AS y FROM d GROUP BY ALL) USING (o_orderstatus, h) WHERE x IS DISTINCT FROM y""")
def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a later snapshot of the orders has lost, changed or doubled, found by digest trees."""
    before = table(spark, sf_dir, "orders")
    gone = table(spark, sf_dir, "lineitem").where("l_quantity = 50 AND l_returnflag = 'R' AND l_discount = 0.1D").select(F.col("l_orderkey").alias("o_orderkey"))
    after = before.join(gone, "o_orderkey", "left_anti").select(before.columns)
    after = after.withColumn("o_orderpriority", F.when(F.col("o_totalprice") < 20000, "X").otherwise(F.col("o_orderpriority")))
    after = after.unionByName(after.where("o_totalprice > 400000"))
    return proofs.changed_rows(before, after, ["o_orderstatus"])


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'error'""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'error'")
    return rows.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(f"""WITH {SPANS_SQL} SELECT CAST(raion AS VARCHAR) AS region, start_us // 1000 AS start_ms, end_us // 1000 AS end_ms FROM spans WHERE level = 'hromada' AND end_us > start_us""")
def json_history_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region histories as nested JSON text, and back to rows."""
    rows = alerts(spark, sf_dir).where("level in ('hromada', 'raion')")
    kind = F.when(F.col("level") == "hromada", "air").otherwise("OTHER")
    one = F.struct(kind.alias("alertType"), times.iso(F.col("start_us")).alias("startDate"), times.iso(F.col("end_us")).alias("endDate"), F.col("raion").cast("string").alias("regionId"))
    text = rows.groupBy("raion", "k", F.floor(F.col("event_id") / 2000)).agg(F.collect_list(one).alias("alarms")).select(
        F.to_json(F.struct(F.col("raion").cast("string").alias("regionId"), F.concat(F.lit("R"), "raion").alias("regionName"), "alarms")).alias("body"))
    found = histories.alarms(text.select("body"), "body").where("upper(alert_type) = 'AIR'")
    return found.select(F.col("region_id").alias("region"), F.floor(F.col("start_us") / 1000).alias("start_ms"), F.floor(F.col("end_us") / 1000).alias("end_ms"))


@query("""SELECT 'state' AS level, CAST(r_regionkey AS VARCHAR) AS id, r_name AS name, NULL AS parent FROM region UNION ALL
SELECT 'district', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR) FROM nation UNION ALL SELECT 'community', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""")
def region_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested hierarchies of region, nation and suppliers as JSON text, one for each nation and thousand of suppliers, flattened again."""
    community = F.struct(F.col("s_suppkey").cast("string").alias("communityId"), F.col("s_name").alias("communityName"))
    communities = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n"), F.floor(F.col("s_suppkey") / 1000).alias("part")).agg(F.collect_list(community).alias("communities"))
    districts = table(spark, sf_dir, "nation").join(communities, F.col("n_nationkey") == F.col("n"), "left")
    district = F.struct(F.col("n_nationkey").cast("string").alias("districtId"), F.col("n_name").alias("districtName"), "communities")
    rows = table(spark, sf_dir, "region").join(districts, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    districts = F.when(F.col("n_nationkey").isNotNull(), F.array(district))
    state = F.struct(F.col("r_regionkey").cast("string").alias("stateId"), F.col("r_name").alias("stateName"), districts.alias("districts"))
    states = rows.select(F.to_json(F.struct(F.array(state).alias("states"))).alias("body"))
    return histories.hierarchy(states, "body")


def _plain_sql(html: str) -> str:
    """Text of HTML as in ``words.plain_text``."""
    text = f"regexp_replace(regexp_replace({html}, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{sign}')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


_ANCHOR = r"""'(?is)<a\b[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'"""


@query(rf"""WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, trim(unnest(regexp_extract_all(html, {_ANCHOR}, 1))) AS href, unnest(regexp_extract_all(html, {_ANCHOR}, 2)) AS t FROM pages),
w AS (SELECT page_id, t, CASE WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN root || href ELSE href END AS u FROM a),
b AS (SELECT page_id, t, regexp_replace(u, '#.*$', '') AS url FROM w WHERE regexp_matches(u, '(?i)^https?://[^/\s]'))
SELECT DISTINCT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, url, {_plain_sql('t')} AS title FROM b""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.links(table(spark, sf_dir, "pages"))


@query(rf"""WITH x AS (SELECT page_id, {_plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, {_plain_sql('html')} AS text FROM pages)
SELECT page_id, title, length(text) AS n_chars, sha256(text) AS digest FROM x""")
def page_text_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.articles(table(spark, sf_dir, "pages"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports of an attack: the number of dead is the key modulo 250, told in one of four ways."""
    key = F.col("o_orderkey")
    dead = key % 250
    how = [F.concat(F.lit("Унаслідок атаки у Києві "), dead, F.lit(" людей загинуло")), F.concat(F.lit("Столицю накрив обстріл, відомо про "), dead, F.lit(" загиблих")),
           F.concat(F.lit("Загиблих щонайменше "), dead, F.lit(" після удару")), F.concat(F.lit("Поранено "), dead, F.lit(" людей у КИЄВІ, дрон"))]
    text = F.when(key % 4 == 0, how[0]).when(key % 4 == 1, how[1]).when(key % 4 == 2, how[2]).otherwise(how[3])
    month = F.element_at(F.array(*map(F.lit, words.MONTHS)), F.month("o_orderdate"))
    told = F.concat(text, F.lit(", "), F.dayofmonth("o_orderdate"), F.lit(" "), month, F.when(key % 3 == 0, F.concat(F.lit(" "), F.year("o_orderdate"), F.lit(" року"))).otherwise(""), F.lit("."))
    return table(spark, sf_dir, "orders").select("o_orderkey", told.alias("text"))


@query("SELECT o_orderkey, CAST(o_orderkey % 250 AS VARCHAR) AS numbers FROM orders WHERE o_orderkey % 4 < 3 AND o_orderkey % 250 BETWEEN 1 AND 200")
def extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # through a generator, as a filter over a plain column would have the patterns looked for twice
    rows = _reports(spark, sf_dir).select("o_orderkey", F.explode(F.array(words.counts_near(F.col("text")))).alias("n")).where(F.size("n") > 0)
    return rows.select("o_orderkey", F.array_join(F.transform("n", lambda x: x.cast("string")), "|").alias("numbers"))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 3 = 0 AND year(o_orderdate) BETWEEN 2000 AND 2099 AS told FROM orders)
SELECT o_orderkey, CASE WHEN told THEN strftime(d, '%Y-%m-%d') ELSE '2026-' || strftime(d, '%m-%d') END AS dates FROM o WHERE told OR strftime(d, '%m-%d') <> '02-29'""")
def extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and months named in reports; where no year of this century is named it is 2026, in which 29 February is no date."""
    rows = _reports(spark, sf_dir).select("o_orderkey", words.dates_in(F.col("text"), F.lit(2026)).alias("d")).where(F.size("d") > 0)
    return rows.select("o_orderkey", F.array_join(F.transform("d", lambda x: x.cast("string")), "|").alias("dates"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 < 2")
def relevant_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third way names no place and the fourth no dead."""
    return _reports(spark, sf_dir).where(words.relevant(F.col("text"))).select("o_orderkey")


_STATUS = "CASE role WHEN 'user' THEN 'needs_review' WHEN 'assistant' THEN 'hold' ELSE 'confirmed' END"


@query(f"""WITH x AS (SELECT conv_id, turn, {_STATUS} AS s, lag({_STATUS}) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations)
SELECT conv_id, turn, p AS status, s AS to_status, (p || '>' || s) IN ('needs_review>confirmed', 'needs_review>rejected', 'needs_review>hold', 'hold>needs_review') AS accepted FROM x WHERE p IS NOT NULL""")
def turn_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a decision on the state that the turn before left."""
    status = F.when(F.col("role") == "user", "needs_review").when(F.col("role") == "assistant", "hold").otherwise("confirmed")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", status.alias("s"))
    rows = rows.selectExpr("*", "lag(s) OVER (PARTITION BY conv_id ORDER BY turn) AS p").where("p is not null")
    ids = F.concat_ws(":", "conv_id", "turn")
    candidates = rows.select(ids.alias("candidate_id"), F.lit("x").alias("city_key"), F.col("p").alias("status"))
    decisions = rows.select(ids.alias("candidate_id"), F.lit("x").alias("city_key"), F.col("s").alias("to_status"), F.col("turn").alias("at"))
    done = ledger.reviewed(candidates, decisions)
    part = F.split("candidate_id", ":")
    return done.select(part[0].cast("long").alias("conv_id"), F.col("at").alias("turn"), "status", "to_status", "accepted")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' THEN 'hold' WHEN o_orderstatus = 'F' THEN 'confirmed' ELSE 'needs_review' END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' THEN 2 ELSE 1 END AS steps FROM orders""")
def review_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders are put on hold; what is confirmed already stays, as that transition is not allowed."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "confirmed").otherwise("needs_review")
    first = F.array(F.struct(F.lit(0).cast("long").alias("at"), F.lit("new").alias("from"), status.alias("to")))
    candidates = orders.select(F.col("o_orderkey").cast("string").alias("candidate_id"), F.lit("x").alias("city_key"), status.alias("status"), first.alias("review_history"))
    decisions = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("candidate_id"), F.lit("x").alias("city_key"), F.lit("hold").alias("to_status"), F.lit(1).cast("long").alias("at"))
    done = ledger.reviewed_history(candidates, ledger.reviewed(candidates, decisions))
    return done.select(F.col("candidate_id").cast("long").alias("o_orderkey"), "status", F.size("review_history").alias("steps"))


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'open' END AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "failed").otherwise("open")
    return ledger.by_status(table(spark, sf_dir, "orders").select(status.alias("status")))


@query("""SELECT s.l_orderkey, s.l_suppkey FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) s
LEFT JOIN (SELECT l_orderkey, l_suppkey, count(*) AS parents FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL) p USING (l_orderkey, l_suppkey) WHERE coalesce(parents, 0) <> 1""")
def orphan_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    return proofs.orphans(rows.select(*keys).distinct(), rows.where("l_linenumber <= 4"), keys).select(*keys)


@query(f"""WITH {SPANS_SQL}, g AS (SELECT raion, date_trunc('day', make_timestamp(start_us))::DATE AS day, count(*) AS n FROM alerts GROUP BY ALL)
SELECT raion, day, n FROM g WHERE n <= 10""")
def incomplete_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).groupBy("raion", F.to_date(times.instant(F.col("start_us"))).alias("day")).agg(F.count("*").alias("n"))
    return proofs.incomplete_index(rows.where("n > 10"), rows, ["raion", "day"]).select("raion", "day", "n")


@query("""WITH p AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS VARCHAR) AS source, min(epoch_us(o_orderdate)) AS first_us, min(epoch_us(o_orderdate) + 86400000000 * 200) AS check_us, max(epoch_us(o_orderdate) + 86400000000 * 200) AS export_us, count(*) AS completed FROM orders GROUP BY ALL),
c AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS VARCHAR) AS source, max(epoch_us(o_orderdate)) AS checked_us FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
SELECT key, source, check_us, export_us, first_us, completed, coalesce(checked_us, -1) AS checked_us, coalesce(first_us <= checked_us AND checked_us <= check_us, false) AS continuous,
  CASE WHEN checked_us IS NULL OR (first_us <= checked_us AND checked_us <= check_us) THEN check_us ELSE checked_us END AS next_us FROM p LEFT JOIN c USING (key, source)""")
def capture_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = times.micros(F.col("o_orderdate"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.year("o_orderdate").cast("string").alias("source"), start.alias("start_us"), (start + 200 * times.DAY).alias("captured_us"), "o_orderpriority")
    before = rows.where("o_orderpriority = '1-URGENT'").groupBy("key", "source").agg(F.max("start_us").alias("checked_us"))
    return ingest.receipts(rows, before).na.fill(-1, ["checked_us"])


@query("""WITH p AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS VARCHAR) AS source, min(epoch_us(o_orderdate)) AS first_us, min(epoch_us(o_orderdate) + 86400000000 * 200) AS check_us,
  bool_or(o_orderstatus = 'P') AS changed, bool_or(o_orderpriority = '5-LOW') AS back FROM orders GROUP BY ALL),
c AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS VARCHAR) AS source, max(epoch_us(o_orderdate)) AS checked_us FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
x AS (SELECT key, source, changed, back, coalesce(first_us <= checked_us AND checked_us <= check_us, false) AS continuous FROM p LEFT JOIN c USING (key, source))
SELECT key, source, 'body changed' AS reason FROM x WHERE changed UNION ALL SELECT key, source, 'captured before its request' FROM x WHERE back
UNION ALL SELECT key, source, 'other clock' FROM x WHERE key % 10 = 0 UNION ALL SELECT key, source, 'other continuity' FROM x WHERE key % 7 = 0 AND NOT continuous""")
def receipt_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of customers' orders by year, some with another clock or called continuous, against the pages."""
    start = times.micros(F.col("o_orderdate"))
    captured = start + 200 * times.DAY
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.year("o_orderdate").cast("string").alias("source"), start.alias("start_us"), captured.alias("captured_us"), "o_orderpriority",
        (captured + F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(-1)).alias("started_us"), (F.col("o_orderstatus") != "P").alias("intact"))
    before = rows.where("o_orderpriority = '1-URGENT'").groupBy("key", "source").agg(F.max("start_us").alias("checked_us"))
    told = ingest.receipts(rows, before).select(
        "key", "source", (F.col("check_us") + F.when(F.col("key") % 10 == 0, 1).otherwise(0)).alias("check_us"), (F.col("continuous") | (F.col("key") % 7 == 0)).alias("continuous"), "next_us")
    return ingest.receipt_violations(told, rows, before)
