"""Queries of single rules and small operators, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times, words
from spanloom.operators import calendar, coverage, ingest, intervals, ledger, proofs, snapshot
from spanloom.plans import views
from spanloom.plans.views import NOW_US, SPANS_SQL, alerts, islands_sql, spans, table

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return add


_LOW, _HIGH = NOW_US - 7 * times.DAY, NOW_US - 2 * times.DAY


@query(f"""WITH {SPANS_SQL}, c AS (SELECT k, greatest(start_us, {_LOW}) AS start_us, least(end_us, {_HIGH}) AS end_us FROM alerts WHERE start_us < {_HIGH} AND end_us > {_LOW}),
{islands_sql('u', 'c', 'k')} SELECT k, sum(end_us - start_us)::BIGINT AS us FROM u GROUP BY k""")
def window_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.clipped(alerts(spark, sf_dir), F.lit(_LOW), F.lit(_HIGH))
    return intervals.total_us(intervals.islands(rows, ["k"]), ["k"])


@query(f"""WITH {SPANS_SQL}, {islands_sql('m', 'alerts', 'oblast, level')}, t AS (SELECT oblast, start_us AS t, 1 AS x FROM m UNION ALL SELECT oblast, end_us, -1 FROM m),
g AS (SELECT oblast, t, sum(x) AS x FROM t GROUP BY ALL), w AS (SELECT oblast, t AS start_us, lead(t) OVER z AS end_us, sum(x) OVER z AS n FROM g WINDOW z AS (PARTITION BY oblast ORDER BY t)),
f AS (SELECT oblast, start_us, end_us FROM w WHERE n = 3 AND end_us IS NOT NULL), {islands_sql('u', 'f', 'oblast')} SELECT * FROM u""")
def all_levels_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = spans(spark, sf_dir).select("oblast").distinct().withColumn("members", F.lit(3))
    return intervals.all_active(alerts(spark, sf_dir), ["oblast"], "level", sizes)


@query(f"""WITH {SPANS_SQL}, d AS (SELECT DISTINCT k, start_us FROM alerts), g AS (SELECT k, start_us - lag(start_us) OVER (PARTITION BY k ORDER BY start_us) AS gap FROM d)
SELECT k, coalesce(max(gap), 0) AS largest_gap_us FROM g GROUP BY k""")
def largest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.largest_gap(alerts(spark, sf_dir), ["k"]).na.fill(0, ["largest_gap_us"])


@query(f"WITH {SPANS_SQL} SELECT k, min(start_us) AS first_us, max(end_us) AS last_us, count(*) AS n FROM alerts GROUP BY k")
def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(spark, sf_dir).groupBy("k").agg(F.min("start_us").alias("first_us"), F.max("end_us").alias("last_us"), F.count("*").alias("n"))


@query("""SELECT c_custkey AS id, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'h' || c_custkey END, CASE WHEN c_custkey % 3 = 1 THEN 'r' || c_nationkey END, 'o') AS series,
  CASE c_custkey % 3 WHEN 0 THEN 'hromada' WHEN 1 THEN 'raion' ELSE 'oblast' END AS level FROM customer""")
def preferred_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("h"), "c_custkey")).alias("hromada"),
        F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("r"), "c_nationkey")).alias("raion"), F.lit("o").alias("oblast"))
    return coverage.preferred_level(dim).select("id", "series", "level")


@query("""WITH a AS (SELECT n_regionkey AS region, lower(n_name) AS alias, n_nationkey AS rank FROM nation), m AS (SELECT region, s_suppkey AS node, rank FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN a ON a.alias = lower(n_name))
SELECT CAST(region AS BIGINT) AS region, min(node) FILTER (rank = (SELECT min(rank) FROM m x WHERE x.region = m.region)) AS node FROM m GROUP BY region""")
def first_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    aliases = nation.select(F.col("n_regionkey").cast("long").alias("region"), words.name_key(F.col("n_name")).alias("alias"), F.col("n_nationkey").alias("rank"))
    named = table(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    one = named.groupBy("n_name").agg(F.min("s_suppkey").alias("node"))
    return coverage.first_alias(one, aliases, words.name_key(F.col("n_name")))


@query("""WITH a AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS deaths FROM orders GROUP BY 1), b AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, count(DISTINCT l_orderkey) AS expected FROM lineitem GROUP BY 1)
SELECT year, coalesce(deaths, -1) AS deaths, coalesce(expected, -1) AS expected FROM a FULL JOIN b USING (year) WHERE deaths IS DISTINCT FROM expected""")
def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month against shipped orders by year; the last year of shipments has no orders."""
    monthly = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("deaths"))
    expected = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").cast("string").alias("year")).agg(F.count_distinct("l_orderkey").alias("expected"))
    return ledger.control_totals(monthly, expected).na.fill(-1, ["deaths", "expected"])


@query("""WITH r AS (SELECT l_orderkey || '-' || (l_linenumber // 2) AS record_id, l_returnflag AS f, l_linenumber AS n, l_linestatus AS s FROM lineitem), x AS (SELECT *, count(*) OVER (PARTITION BY record_id) > 1 AS twice FROM r)
SELECT record_id, 'id twice' AS reason, count(*) AS n FROM x WHERE twice GROUP BY ALL UNION ALL SELECT record_id, 'bad status', count(*) FROM x WHERE f = 'N' GROUP BY ALL
UNION ALL SELECT record_id, 'bad count', count(*) FROM x WHERE n = 7 GROUP BY ALL UNION ALL SELECT record_id, 'bad date', count(*) FROM x WHERE n = 5 AND s = 'F' GROUP BY ALL""")
def revision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as revisions: a status that there isn't, two that there are (in any case), blank and unreadable counts, a day that there isn't."""
    status = F.when(F.col("l_returnflag") == "N", "pending").when(F.col("l_returnflag") == "A", " Needs_Review").otherwise("confirmed")
    day = F.when((F.col("l_linenumber") == 5) & (F.col("l_linestatus") == "F"), "2024-02-30").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", F.floor(F.col("l_linenumber") / 2)).alias("record_id"), status.alias("status"), day.alias("attack_date"),
        F.when(F.col("l_linenumber") == 7, "x").when(F.col("l_linenumber") == 6, " ").otherwise("1").alias("deaths_delta"))
    return ledger.counted_violations(rows)


@query("""SELECT 'o' || o_orderkey AS candidate_id, strftime(o_orderdate, '%Y-%m-%d') AS updated_at FROM orders WHERE o_orderstatus = 'P' ORDER BY updated_at DESC, candidate_id LIMIT 30""")
def inbox_top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("candidate_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
                                                  F.when(F.col("o_orderstatus") == "P", "needs_review").otherwise("confirmed").alias("status"))
    return ledger.inbox(queue).select("candidate_id", "updated_at")


@query("""SELECT o_orderkey, concat_ws('|', CASE WHEN o_orderkey % 5 = 0 THEN 'no id' END, CASE WHEN o_totalprice < 100000 THEN 'bad count' END, CASE WHEN o_orderkey % 7 = 0 THEN 'no source' END,
  CASE WHEN o_orderstatus = 'O' THEN 'bad address' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'bad incident' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'bad kind' END,
  CASE WHEN o_orderkey % 3 = 0 THEN 'bad credit' END, CASE WHEN o_orderkey % 11 = 0 THEN 'no identity' END, CASE WHEN o_orderkey % 13 = 0 THEN 'no credit proof' END) AS reasons FROM orders""")
def confirmation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 5 == 0, "  ").otherwise(F.concat(F.lit("rec "), key)).alias("record_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("attack_date"),
        F.when(F.col("o_totalprice") >= 100000, "1").otherwise("0").alias("deaths_delta"), F.when(key % 7 != 0, "paper").alias("source_name"),
        F.when(F.col("o_orderstatus") == "O", "ftp://x").otherwise("HTTPS://example.org/a").alias("source_url"),
        F.when(F.col("o_orderpriority") == "5-LOW", "incident:short").otherwise(F.concat(F.lit("incident:2024-05-01_"), key)).alias("incident_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "total").otherwise("Delta").alias("count_kind"), F.when(key % 3 == 0, "01").otherwise("0").alias("baseline_credited"),
        F.when(key % 11 == 0, "git:main:x").otherwise(F.concat(F.lit("git:" + "a" * 40 + ":x/"), key)).alias("identity_proof"),
        F.when(key % 13 == 0, "sha256:0").otherwise(F.concat(F.lit("sha256:"), F.sha2(key.cast("string"), 256))).alias("credited_proof"))
    return ledger.confirmation_reasons(rows).select("o_orderkey", F.array_join("reasons", "|").alias("reasons"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def outside_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "customer").where("c_mktsegment in ('BUILDING', 'MACHINERY')").select("c_mktsegment")
    return ledger.outside_set(table(spark, sf_dir, "customer"), dim, "c_mktsegment").select("c_custkey", "c_mktsegment")


@query("""WITH o AS (SELECT c_nationkey AS region, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1), p AS (SELECT s_nationkey AS region, count(*) AS n, max(s_acctbal) AS top FROM supplier GROUP BY 1 HAVING max(s_acctbal) > 8000)
SELECT CAST(region AS BIGINT) AS region, coalesce(p.n, o.n) AS n, coalesce(p.top, o.top) AS top, p.region IS NOT NULL AS continuous FROM o FULL JOIN p USING (region)""")
def region_status_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' customers as the old state, their suppliers as a poll that leaves out nations whose best balance is low."""
    one = lambda t, k, b: table(spark, sf_dir, t).groupBy(F.col(k).cast("long").alias("region")).agg(F.count("*").alias("n"), F.max(b).alias("top"))
    return ingest.status_kept(one("customer", "c_nationkey", "c_acctbal"), one("supplier", "s_nationkey", "s_acctbal").where("top > 8000"), ["n", "top"])


@query("SELECT count(*) AS required, count(*) FILTER (has) AS covered, count(*) FILTER (NOT has) AS uncovered FROM (SELECT n_nationkey IN (SELECT s_nationkey FROM supplier) AS has FROM nation)")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("region"))
    return ingest.coverage(required, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("region")))


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderstatus = 'P') > count(*) * 0.3::DOUBLE AS systemic FROM orders")
def campaign_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "failed").otherwise("open")
    return snapshot.progress(table(spark, sf_dir, "orders").select(state.alias("state")), 0.3)


@query(f"""WITH {SPANS_SQL}, s AS (SELECT k, max(end_us) AS checked_us FROM alerts WHERE start_us < {NOW_US} GROUP BY k)
SELECT count(*) AS sources, count(checked_us) AS bound, count(*) FILTER (checked_us BETWEEN {NOW_US} - 129600000000 AND {NOW_US}) AS fresh FROM s""")
def fresh_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).where(F.col("start_us") < NOW_US).groupBy("k").agg(F.max("end_us").alias("checked_us")).withColumn("continuous", F.lit(True))
    return proofs.fresh_counts(proofs.freshness(rows, F.lit(NOW_US)))


@query("""WITH d AS (SELECT o_orderkey AS key, CAST(o_orderkey % 5 AS BIGINT) AS declared FROM orders), f AS (SELECT l_orderkey AS key, count(*) AS found FROM lineitem GROUP BY 1)
SELECT key, coalesce(declared, 0) AS declared, coalesce(found, 0) AS found FROM d FULL JOIN f USING (key) WHERE coalesce(declared, 0) <> coalesce(found, 0) OR coalesce(found, 0) = 0""")
def declared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 5).alias("declared"))
    return proofs.declared_counts(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key"), declared, "key")


@query(f"""WITH {SPANS_SQL}, a AS (SELECT k, count(*) AS n FROM alerts WHERE event_id % 2 = 0 GROUP BY k), b AS (SELECT k, count(*) AS n FROM alerts WHERE event_id % 2 = 1 GROUP BY k)
SELECT a.k, a.n AS before, coalesce(b.n, -1) AS after FROM a LEFT JOIN b USING (k) WHERE b.n IS NULL OR b.n < a.n""")
def progress_moved_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda c: alerts(spark, sf_dir).where(c).groupBy("k").agg(F.count("*").alias("n"))
    return proofs.moved_back(one("event_id % 2 = 0"), one("event_id % 2 = 1"), "k", "n").na.fill(-1, ["after"])


@query("""SELECT o_orderkey AS key, o_orderstatus AS state, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS now FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0""")
def terminal_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("state"))
    after = before.withColumn("state", F.when(F.col("key") % 7 == 0, "X").otherwise(F.col("state")))
    return proofs.terminal_changes(before, after, "key", ["F"])


@query(f"""WITH {SPANS_SQL}, known AS (SELECT k, start_us, CASE WHEN end_us <= {NOW_US} THEN end_us END AS end_us FROM alerts WHERE start_us <= {NOW_US}),
o AS (SELECT k, max(start_us) AS start_us FROM known WHERE end_us IS NULL GROUP BY k), c AS (SELECT k, max(end_us) AS last_end_us FROM known WHERE end_us IS NOT NULL GROUP BY k)
SELECT * FROM o JOIN c USING (k) WHERE start_us < last_end_us""")
def open_over_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = snapshot.cut_at(alerts(spark, sf_dir).select("k", "start_us", "end_us"), F.lit(NOW_US))
    opened = snapshot.open_intervals(known, ["k"], F.lit(NOW_US)).select("k", "start_us")
    return snapshot.overlapping_open(opened, known.where("end_us is not null"), ["k"])


@query(f"WITH {SPANS_SQL} SELECT event_id, end_us FROM alerts WHERE end_us >= {NOW_US}")
def eligible_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.eligible(alerts(spark, sf_dir), F.lit(NOW_US)).select("event_id", "end_us")


@query("""WITH f AS (SELECT l_orderkey AS key, list(l_suppkey ORDER BY l_suppkey) AS ids FROM lineitem GROUP BY 1)
SELECT key FROM f WHERE len(ids) <> len(list_distinct(ids)) OR key % 11 = 0""")
def changed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    frozen = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.array_sort(F.collect_list("l_suppkey")).alias("ids"))
    now = frozen.withColumn("ids", F.when(F.col("key") % 11 == 0, F.reverse(F.array_append("ids", F.lit(-1).cast("long")))).otherwise(F.col("ids")))
    return proofs.list_changes(frozen, now, "key").select("key")


@query("SELECT n_nationkey, n_regionkey FROM nation WHERE n_regionkey <= 1 OR n_regionkey <> (SELECT max(n_regionkey) FROM nation)")
def stale_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").withColumn("generation", F.col("n_regionkey"))
    return proofs.generations(rows, 1).select("n_nationkey", "n_regionkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE abs(l_partkey - (l_suppkey + l_linenumber)) > 5")
def unequal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs.parts_unequal(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey", "l_linenumber"], 5).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""WITH {SPANS_SQL}, n AS (SELECT k AS region, level AS name FROM spans GROUP BY ALL HAVING count(*) >= 14)
SELECT event_id, k AS region, level AS name FROM spans LEFT JOIN n ON region = k AND name = level WHERE name IS NOT NULL OR event_id % 9 < 2""")
def accepted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in other cases and spacing count as the same; a blank or missing one, and the region's own, are accepted."""
    own, key = F.col("level"), F.col("event_id")
    name = F.when(key % 9 == 0, F.when(key % 2 == 0, "  ")).when(key % 9 == 1, F.col("k").cast("string")).otherwise(F.concat(F.lit(" "), F.initcap("level")))
    rows = spans(spark, sf_dir).select("event_id", F.col("k").alias("region"), own.alias("level"), name.alias("name"))
    aliases = rows.groupBy("region", F.col("level").alias("name")).count().where("count >= 14")
    return ingest.accepted_names(rows, aliases).select("event_id", "region", F.col("level").alias("name"))


@query(f"""WITH {SPANS_SQL}, {views.daily_sql('d', 'alerts', 'k')}, p AS (SELECT k, date_trunc('week', day)::DATE AS period, count(*) AS days, sum(alerts_started)::BIGINT AS alerts_started FROM d GROUP BY ALL),
f AS (SELECT k, min(day) AS first_day FROM d GROUP BY k) SELECT k, period, alerts_started FROM p JOIN f USING (k) WHERE days = 7 AND period > first_day""")
def trimmed_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.weekly(calendar.daily(alerts(spark, sf_dir), ["k"]), ["k"], skip_first=True).select("k", "period", "alerts_started")


@query("SELECT o_orderkey, o_custkey, CAST(epoch_us(o_orderdate) AS BIGINT) AS at_us FROM orders ORDER BY at_us, o_custkey, o_orderkey")
def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", times.micros(F.col("o_orderdate")).alias("at_us"))
    return calendar.in_order(rows, ["at_us", "o_custkey", "o_orderkey"])


@query(f"""WITH {SPANS_SQL} SELECT k, {views.local_day_sql('max(end_us)')} - 1 AS day FROM alerts GROUP BY k""")
def last_whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(spark, sf_dir).groupBy("k").agg(F.max("end_us").alias("newest_us")).select("k", times.last_complete_day(F.col("newest_us")).alias("day"))


@query("""SELECT c_custkey, 'user ' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ' token: ***, x' ELSE ' tokens: ' || c_name END AS text FROM customer""")
def masked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.concat(F.lit("user "), key, F.when(key % 2 == 0, F.concat(F.lit(" token: "), "c_name", F.lit(", x"))).otherwise(F.concat(F.lit(" tokens: "), "c_name")))
    return table(spark, sf_dir, "customer").select("c_custkey", words.masked(text).alias("text"))


@query(f"""WITH {SPANS_SQL}, c AS (SELECT event_id, start_us, start_us + CAST(event_id % 13 AS BIGINT) * 3600000000 - 60000000 AS captured_us FROM alerts),
d AS (SELECT event_id, concat_ws('|', CASE WHEN {NOW_US} - captured_us < -120000000 THEN 'captured in the future' END, CASE WHEN {NOW_US} - captured_us > 28800000000 THEN 'capture too old' END,
  CASE WHEN {views.local_day_sql('captured_us')} <> {views.local_day_sql(str(NOW_US))} THEN 'captured on another day' END, CASE WHEN start_us > captured_us + 120000000 THEN 'starts after its capture' END) AS reasons FROM c)
SELECT event_id, reasons, reasons = '' AS usable FROM d""")
def usable_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(spark, sf_dir).select("event_id", "start_us", (F.col("start_us") + F.col("event_id") % 13 * snapshot.HOUR - 60 * times.SECOND).alias("captured_us"))
    return snapshot.usable_open(rows, F.lit(NOW_US)).select("event_id", F.array_join("reasons", "|").alias("reasons"), "usable")


@query(f"""WITH {SPANS_SQL}, r AS (SELECT event_id, start_us, end_us, (end_us - start_us) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS length_us FROM spans)
SELECT event_id, unnest(list_filter([CASE WHEN end_us <= start_us THEN 'ends before it starts' END, CASE WHEN start_us > {NOW_US} THEN 'starts after the snapshot' END,
  CASE WHEN end_us > {NOW_US} THEN 'ends after the snapshot' END, CASE WHEN length_us <> end_us - start_us THEN 'wrong length' END], lambda x: x IS NOT NULL)) AS reason FROM r""")
def snapshot_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(spark, sf_dir).withColumn("length_us", F.col("end_us") - F.col("start_us") + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    return proofs.snapshot_violations(rows, F.lit(NOW_US))


@query("""WITH p AS (SELECT o_custkey AS key, o_orderkey AS page, (o_orderkey % 6) + 1 AS declared, (SELECT count(*) FROM orders x WHERE x.o_custkey = o.o_custkey) - CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END AS total FROM orders o),
f AS (SELECT l_orderkey AS page, count(*) AS found FROM lineitem GROUP BY 1), b AS (SELECT p.*, coalesce(found, 0) AS found FROM p LEFT JOIN f USING (page))
SELECT key, max(total) AS total, count(DISTINCT page) AS pages, count(*) FILTER (declared <> found) AS wrong_pages FROM b GROUP BY key HAVING max(total) <> count(DISTINCT page) OR count(*) FILTER (declared <> found) > 0""")
def page_count_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sources, their orders as pages, line items as messages."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("page"), (F.col("o_orderkey") % 6 + 1).alias("declared"))
    total = orders.groupBy("key").agg((F.count("*") - F.when(F.col("key") % 4 == 0, 1).otherwise(0)).alias("total"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page")).join(orders.select("key", "page"), "page")
    return proofs.page_counts(orders.join(total, "key"), lines, "key", "total")


@query(f"""WITH {SPANS_SQL}, r AS (SELECT event_id, end_us - start_us AS whole, (end_us - start_us) // 3 AS a, (end_us - start_us) - (end_us - start_us) // 3 + CASE WHEN event_id % 8 = 0 THEN 5 ELSE 0 END AS b FROM spans)
SELECT event_id, 'parts and total differ' AS reason FROM r WHERE event_id % 8 = 0 UNION ALL SELECT event_id, 'longer than its window' FROM r WHERE whole > 3600000002""")
def window_totals_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of events against their two parts and an hour's window, two microseconds allowed."""
    whole = F.col("end_us") - F.col("start_us")
    a = F.expr("(end_us - start_us) div 3")
    rows = spans(spark, sf_dir).select("event_id", whole.alias("whole"), a.alias("a"), (whole - a + F.when(F.col("event_id") % 8 == 0, 5).otherwise(0)).alias("b"))
    return proofs.total_breaks(rows, ["event_id"], "whole", ["a", "b"], F.lit(3600 * times.SECOND), 2)


@query("""SELECT o_orderkey, o_custkey AS terminal, o_orderkey % 4000 AS processed, CAST(floor(o_totalprice) AS BIGINT) // 100 AS total FROM orders WHERE NOT (o_custkey <= o_orderkey % 4000 AND o_orderkey % 4000 <= CAST(floor(o_totalprice) AS BIGINT) // 100)""")
def progress_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress that is not bounded by what there is."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("terminal"), (F.col("o_orderkey") % 4000).alias("processed"), F.expr("CAST(floor(o_totalprice) AS BIGINT) div 100").alias("total"))
    return proofs.progress_breaks(rows)


@query(f"""WITH {SPANS_SQL}, r AS (SELECT event_id AS key, event_id % 12 AS f, {NOW_US} - (event_id % 10) * 3600000000 AS capture_us, end_us - start_us AS us, start_us FROM spans),
s AS (SELECT *, CASE WHEN f = 0 THEN 'other' WHEN f < 7 THEN 'open_at_source_capture' ELSE 'no_open_at_source_capture' END AS state, CASE WHEN f < 6 OR f = 8 THEN start_us END AS open_us,
  us AS closed_us, CASE WHEN f < 7 OR f = 9 THEN 1000000 ELSE 0 END AS provisional_us, us + CASE WHEN f < 7 OR f = 9 THEN 1000000 ELSE 0 END + CASE WHEN f = 10 THEN 10000 WHEN f = 11 THEN 9999 ELSE 0 END AS combined_us FROM r)
SELECT key, unnest(list_filter([CASE WHEN f = 0 THEN 'unknown state' END, CASE WHEN f = 3 THEN 'another day' END, CASE WHEN capture_us < {NOW_US} - 8 * 3600000000 THEN 'capture not of now' END,
  CASE WHEN (state = 'open_at_source_capture') <> (open_us IS NOT NULL) THEN 'state and start disagree' END, CASE WHEN open_us >= capture_us THEN 'starts after its capture' END, CASE WHEN f = 4 THEN 'period is not today' END,
  CASE WHEN closed_us < 0 OR combined_us < 0 THEN 'sums missing or negative' END, CASE WHEN f = 10 THEN 'sums differ' END, CASE WHEN state <> 'open_at_source_capture' AND provisional_us <> 0 THEN 'provisional time without an open interval' END], lambda x: x IS NOT NULL)) AS reason FROM s""")
def open_snapshot_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of open intervals in which every rule is broken by some rows."""
    f, today = F.col("event_id") % 12, times.local_day(F.lit(NOW_US))
    state = F.when(f == 0, "other").when(f < 7, proofs.OPEN).otherwise(proofs.CLOSED)
    us, provisional = F.col("end_us") - F.col("start_us"), F.when((f < 7) | (f == 9), times.SECOND).otherwise(0)
    rows = spans(spark, sf_dir).select(
        F.col("event_id").alias("key"), state.alias("state"), F.when(f == 3, F.date_sub(today, 1)).otherwise(today).alias("date"), (F.lit(NOW_US) - F.col("event_id") % 10 * snapshot.HOUR).alias("capture_us"),
        F.when((f < 6) | (f == 8), F.col("start_us")).alias("start_us"), F.when(f == 4, F.date_sub(today, 1)).otherwise(today).alias("from_day"), today.alias("through_day"), us.alias("closed_us"), provisional.alias("provisional_us"),
        (us + provisional + F.when(f == 10, 10_000).when(f == 11, 9_999).otherwise(0)).alias("combined_us"))
    return proofs.open_snapshot_breaks(rows, F.lit(NOW_US))


@query("SELECT l_suppkey AS source, l_partkey AS message, count(DISTINCT l_returnflag || '|' || CAST(l_linenumber AS VARCHAR)) AS versions FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag || '|' || CAST(l_linenumber AS VARCHAR)) > 1")
def conflicting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as messages of a supplier about a part: those that are told in different ways."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("message"), "l_returnflag", "l_linenumber")
    return proofs.conflicting_messages(rows, "source", "message", ["l_returnflag", "l_linenumber"])
