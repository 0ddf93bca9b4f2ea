"""Queries of sources and sinks: files made from the driver's tables in the shared folder and read back, each with its DuckDB SQL.

Files of one JSON value each hold at most ``PER_FILE`` rows, so that no task writes or reads more of them at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.operators import calendar, ledger
from spanloom.plans.table_queries import _reports
from spanloom.plans.views import SPANS_SQL, alerts, daily_sql, local_day_sql, spans, table
from spanloom.sources import captures, histories, pages, sinks
from spanloom.sources.staging import new_path
from spanloom.streaming import polls

QUERIES, SQL = {}, {}
PER_FILE = 2000


def query(sql: str):
    def add(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return add


def _arrays(rows: DataFrame, item: Column, number: str, head: str = "", tail: str = "") -> str:
    """Write files of one JSON array each, of the items of ``PER_FILE`` consecutive numbers; returns the folder."""
    path = new_path(rows.sparkSession)
    text = rows.groupBy(F.floor(F.col(number) / PER_FILE).alias("file")).agg(F.to_json(F.collect_list(item)).alias("value"))
    text.select("file", F.concat(F.lit(head), "value", F.lit(tail)).alias("value")).repartition("file").write.partitionBy("file").text(path)
    return f"{path}/*"


def _local(us: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(times.instant(us), times.ZONE), "yyyy-MM-dd HH:mm:ss")


@query(f"""WITH {SPANS_SQL} SELECT start_us // 1000000 * 1000000 AS start_us, end_us // 1000000 * 1000000 AS end_us, 'official_json' AS source FROM spans
WHERE level IN ('hromada', 'raion') AND event_id % 10 <> 3 AND end_us // 1000000 > start_us // 1000000""")
def municipal_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local clock times in JSON arrays; rows of another type, unreadable ones and those of no length are left out."""
    rows = spans(spark, sf_dir)
    kind = F.when(F.col("level").isin("hromada", "raion"), "AIR").otherwise("OTHER")
    start = F.when(F.col("event_id") % 10 == 3, "soon").otherwise(_local(F.col("start_us")))
    path = _arrays(rows, F.struct(kind.alias("type"), start.alias("dateTimeStart"), _local(F.col("end_us")).alias("dateTimeEnd")), "event_id")
    return histories.municipal(spark, path, "AIR")


@query(f"""WITH {SPANS_SQL} SELECT start_us, CASE WHEN event_id % 7 = 2 THEN -1 ELSE end_us END AS end_us, event_id % 5 <> 1 AND event_id % 7 <> 2 AS zoned FROM spans
WHERE event_id % 5 = 1 OR event_id % 7 = 2 OR end_us <= start_us""")
def committed_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What breaks the rules of a committed event file: a clock without zone, a missing end, a length that is not positive."""
    iso = lambda us: times.iso(F.col(us))
    start = F.when(F.col("event_id") % 5 == 1, F.regexp_replace(iso("start_us"), "Z$", "")).otherwise(iso("start_us"))
    end = F.when(F.col("event_id") % 7 != 2, iso("end_us"))
    path = _arrays(spans(spark, sf_dir), F.struct(start.alias("start"), end.alias("end"), F.lit("official").alias("source")), "event_id")
    return histories.violations(histories.committed(spark, path)).drop("source").na.fill(-1, ["end_us"])


@query(f"""WITH {SPANS_SQL} SELECT 'raion' AS asked, start_us, 'primary' AS mode FROM spans WHERE level = 'raion' UNION ALL SELECT 'none', start_us, 'fallback' FROM spans WHERE level = 'oblast'""")
def source_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A primary source where it has rows, and the fallback where it has none."""
    rows = spans(spark, sf_dir)
    coarse = rows.where("level = 'oblast'")
    found = [histories.primary_or_fallback(rows.where(F.col("level") == level), coarse).select(F.lit(level).alias("asked"), "start_us", "mode") for level in ("raion", "none")]
    return found[0].unionByName(found[1])


def _national(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written as the national CSV and read again: oblasts, raions and hromadas by name."""
    rows = spans(spark, sf_dir)
    name = lambda head, c: F.concat(F.lit(head), F.col(c).cast("string"))
    end = F.when(F.col("event_id") % 9 != 4, times.iso(F.col("end_us")))
    rows = rows.select(name("Область, \"", "oblast").alias("oblast"), F.when(F.col("level") != "oblast", name("R", "raion")).alias("raion"), F.when(F.col("level") == "hromada", name("H", "k")).alias("hromada"), "level",
                       times.iso(F.col("start_us")).alias("started_at"), end.alias("finished_at"))
    path = new_path(spark)
    sinks.delimited(rows, path, ["oblast", "raion", "hromada", "level", "started_at", "finished_at"])
    return histories.national(spark, path)


_NATIONAL_SQL = """n AS (SELECT 'Область, "' || oblast AS oblast, CASE WHEN level <> 'oblast' THEN 'R' || raion END AS raion, CASE WHEN level = 'hromada' THEN 'H' || k END AS hromada, level, start_us, end_us
  FROM spans WHERE event_id % 9 <> 4 AND end_us > start_us)"""


@query(f"WITH {SPANS_SQL}, {_NATIONAL_SQL} SELECT * FROM n")
def national_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimited file with quotes and commas in it, and back."""
    return _national(spark, sf_dir)


_FROM_US = 1_705_500_000_000_000


@query(f"""WITH {SPANS_SQL}, {_NATIONAL_SQL}, d AS (SELECT 'hromada' AS level, NULL AS oblast, NULL AS raion, 'H' || c_custkey AS hromada, c_name AS key, CASE WHEN c_nationkey < 12 THEN {_FROM_US} END AS valid_from_us FROM customer
  UNION ALL SELECT 'raion', 'Область, "' || n_regionkey, 'R' || n_nationkey, NULL, n_name, {_FROM_US} FROM nation UNION ALL SELECT 'oblast', 'Область, "' || r_regionkey, NULL, NULL, r_name, NULL FROM region)
SELECT DISTINCT n.level, d.key, start_us, end_us FROM n JOIN d ON n.level = d.level AND (d.oblast IS NULL OR d.oblast = n.oblast) AND (d.raion IS NULL OR d.raion = n.raion) AND (d.hromada IS NULL OR d.hromada = n.hromada)
WHERE d.valid_from_us IS NULL OR start_us >= d.valid_from_us""")
def wanted_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the wanted hromadas, raions and oblasts, some from a day on, in one join."""
    none = F.lit(None).cast("string")
    named = lambda head, c: F.concat(F.lit(head), F.col(c).cast("string"))
    make = lambda rows, level, oblast, raion, hromada, key, since: rows.select(F.lit(level).alias("level"), oblast.alias("oblast"), raion.alias("raion"), hromada.alias("hromada"), F.col(key).alias("key"), since.cast("long").alias("valid_from_us"))
    whole = make(table(spark, sf_dir, "customer"), "hromada", none, none, named("H", "c_custkey"), "c_name", F.when(F.col("c_nationkey") < 12, _FROM_US))
    whole = whole.unionByName(make(table(spark, sf_dir, "nation"), "raion", named("Область, \"", "n_regionkey"), named("R", "n_nationkey"), none, "n_name", F.lit(_FROM_US)))
    whole = whole.unionByName(make(table(spark, sf_dir, "region"), "oblast", named("Область, \"", "r_regionkey"), none, none, "r_name", F.lit(None)))
    return histories.by_region(_national(spark, sf_dir), whole)


@query(f"WITH {SPANS_SQL} SELECT 'Name ' || (k % 40) AS name, CAST(min(CASE WHEN k % 3 = 0 THEN 'f' ELSE CAST(k AS VARCHAR) END) AS VARCHAR) AS region_id, count(*) AS alarms FROM alerts GROUP BY 1")
def named_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of regions that share names, some without an id, grouped by name."""
    alarm = F.struct(F.lit("AIR").alias("alertType"), times.iso(F.col("start_us")).alias("startDate"), times.iso(F.col("end_us")).alias("endDate"))
    rows = alerts(spark, sf_dir).groupBy("k", F.floor(F.col("event_id") / PER_FILE).alias("part")).agg(F.collect_list(alarm).alias("alarms"))
    region = F.struct(F.when(F.col("k") % 3 != 0, F.col("k").cast("string")).alias("regionId"), F.concat(F.lit(" Name "), F.col("k") % 40).alias("regionName"), "alarms")
    return histories.groups_by_name(histories.alarms(rows.select(F.to_json(region).alias("body")), "body", F.lit("f")))


@query(f"""WITH {SPANS_SQL}, h AS (SELECT CAST(k AS VARCHAR) AS key, start_us, end_us FROM alerts WHERE level <> 'oblast' AND k % 11 <> 5),
o AS (SELECT DISTINCT 'c' || o_custkey AS key, CAST(o_orderdate + INTERVAL 30 YEAR AS DATE) AS d FROM orders WHERE o_custkey % 6 <> 1)
SELECT DISTINCT key, start_us, end_us FROM h UNION SELECT key, epoch_us((d + INTERVAL 485 MINUTE) AT TIME ZONE 'Europe/Kyiv'), epoch_us((d + INTERVAL 607 MINUTE) AT TIME ZONE 'Europe/Kyiv') FROM o""")
def replayed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of two kinds of source, written as bundles, read, checked by their hashes and replayed into completed pairs.

    Histories are JSON, one page for each week of a key; pages are HTML with local clock times, one for each customer and year. Bodies of some
    keys were changed after their capture, and don't count.
    """
    alarm = F.struct(F.lit("air").alias("alertType"), times.iso(F.col("start_us")).alias("startDate"), times.iso(F.col("end_us")).alias("endDate"))
    rows = alerts(spark, sf_dir).where("level <> 'oblast'").groupBy("k", F.floor(F.col("start_us") / (7 * times.DAY)).alias("week")).agg(F.collect_list(alarm).alias("alarms"))
    body = F.to_json(F.struct(F.col("k").cast("string").alias("regionId"), F.concat(F.lit("R"), "k").alias("regionName"), "alarms"))
    nested = rows.select(F.lit("history").alias("source_key"), F.col("k").cast("string").alias("city"), F.col("week").cast("string").alias("url"), body.alias("body"), (F.col("k") % 11 == 5).alias("bad"))
    day = F.date_format(F.add_months("o_orderdate", 360), "dd.MM.yy")  # pages have years of this century
    told = F.concat(F.lit("<li><b>08:05 "), day, F.lit("</b> Повітряна тривога</li><li><b>10:07 "), day, F.lit("</b> Відбій тривоги</li>"))
    html = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.array_join(F.collect_set(told), "").alias("rows"))
    html = html.select(F.lit("page").alias("source_key"), F.concat(F.lit("c"), "o_custkey").alias("city"), F.col("year").cast("string").alias("url"), F.concat(F.lit("<ul>"), "rows", F.lit("</ul>")).alias("body"), (F.col("o_custkey") % 6 == 1).alias("bad"))
    seen = nested.unionByName(html).select("*", F.lit("2024-02-01T00:00:00Z").alias("started_at"), F.lit("2024-02-01T00:00:05Z").alias("captured_at"))
    bundles = captures.bundled(seen.withColumn("body", F.col("body").cast("binary")), ["source_key", "city", "bad"])
    changed = F.transform("pages", lambda p: F.when(F.col("bad"), p.withField("body_sha256", F.lit("0"))).otherwise(p))
    path = new_path(spark)
    captures.write(bundles.withColumn("pages", changed).drop("bad"), path)
    return histories.replayed(histories.capture_pages(captures.read(spark, path, ["history", "page"])).where("intact"))


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1), w AS (SELECT CASE WHEN month LIKE '%-07' THEN replace(month, '-07', '-7') ELSE month END AS month, CASE WHEN month LIKE '%-11' THEN NULL WHEN month LIKE '%-12' THEN -n ELSE n END AS n FROM m UNION ALL SELECT month, n FROM m WHERE month LIKE '1995-0%' AND month NOT LIKE '%-07')
SELECT month, 'bad month' AS reason FROM w WHERE NOT regexp_matches(month, '^\\d{4}-(0[1-9]|1[0-2])$') UNION ALL SELECT month, 'bad count' FROM w WHERE coalesce(n < 0, true)
UNION ALL SELECT month, 'month twice' FROM w WHERE month IN (SELECT month FROM w GROUP BY 1 HAVING count(*) > 1)""")
def ledger_file_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A baseline file with months that are none, counts that are none or negative, and months told twice."""
    rows = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").cast("string").alias("deaths"))
    end = F.substring("month", 6, 2)
    twice = rows.where(F.col("month").startswith("1995-0") & (end != "07"))
    odd = rows.select(F.regexp_replace("month", "-07$", "-7").alias("month"), F.when(end == "11", "x").when(end == "12", F.concat(F.lit("-"), "deaths")).otherwise(F.col("deaths")).alias("deaths"))
    path = new_path(spark)
    sinks.delimited(odd.unionByName(twice).select("*", F.lit("").alias("coverage_through"), F.lit("a \"note\", with commas").alias("note")), path, histories.BASELINE)
    return ledger.baseline_violations(histories.baseline_file(spark, path))


@query("SELECT 'p' || page_id AS candidate_id, CASE WHEN page_id % 2 = 0 THEN 'sumy' ELSE 'kyiv' END AS city_key, url, 'needs_review' AS last FROM pages WHERE page_id % 10 <> 7")
def queued_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review queue as JSON arrays, with histories; entries without an id are left out."""
    step = lambda a, b: F.struct(F.lit("t").alias("at"), F.lit(a).alias("from"), F.lit(b).alias("to"))
    item = F.struct(F.when(F.col("page_id") % 10 != 7, F.concat(F.lit("p"), "page_id")).alias("candidate_id"), F.when(F.col("page_id") % 2 == 0, "sumy").otherwise("kyiv").alias("city_key"), "url",
                    F.array(step("new", "hold"), step("hold", "needs_review")).alias("review_history"))
    queue = histories.review_queue(spark, _arrays(table(spark, sf_dir, "pages"), item, "page_id"))
    return queue.select("candidate_id", "city_key", "url", F.element_at("review_history.to", -1).alias("last"))


@query("SELECT 'o' || l_orderkey AS episode_id, CAST(l_partkey AS VARCHAR) AS observation_id, count(*) AS times FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) NOT IN (SELECT (l_orderkey, l_linenumber, l_partkey) FROM lineitem WHERE l_quantity <= 25 OR l_linenumber % 2 = 1) GROUP BY ALL")
def batch_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files of observations and episodes that refer to them: references to what their own batch has not observed."""
    part = table(spark, sf_dir, "lineitem").withColumn("batch", F.floor(F.col("l_orderkey") / PER_FILE))
    seen = part.where("l_quantity <= 25 OR l_linenumber % 2 = 1").groupBy("batch").agg(F.collect_list(F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("observation_id"))).alias("observations"))
    told = part.groupBy("batch", "l_orderkey").agg(F.collect_list(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")).alias("ids"))
    told = told.groupBy("batch").agg(F.collect_list(F.struct(F.concat(F.lit("o"), "l_orderkey").alias("episode_id"), F.col("ids").alias("source_observation_ids"))).alias("episode_results"))
    path = new_path(spark)
    rows = told.join(seen, "batch", "left").select(F.to_json(F.struct("observations", "episode_results")).alias("value"))
    rows.write.option("maxRecordsPerFile", 1).text(path)  # a file for each batch, without a folder and a move of its own
    name = F.substring_index("path", "/", -1).alias("file")
    observed, referred = (x.select(name, *[c for c in ("episode_id", "observation_id") if c in x.columns]) for x in histories.observation_batches(spark, path))
    lost = referred.join(observed, ["file", "observation_id"], "left_anti")
    return lost.groupBy("episode_id", F.substring_index("observation_id", "-", -1).alias("observation_id")).agg(F.count("*").alias("times"))


@query("SELECT page_id // 50 AS feed_id, 'Page ' || page_id || ' & more' AS title, regexp_replace(url, '#.*$', '') AS link FROM pages WHERE regexp_matches(url, '(?i)^https?://[^/\\s]')")
def feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS documents of fifty pages each, and their items."""
    item = F.concat(F.lit("<item><title> Page "), F.col("page_id"), F.lit(" &amp; more </title><link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("#top</link></item>"))
    rows = table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 50).alias("feed_id")).agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"))
    return pages.feed_items(rows.select("feed_id", F.concat(F.lit("<rss><channel><title>all</title>"), "items", F.lit("</channel></rss>")).alias("body"))).where("link is not null")


@query(f"""WITH {SPANS_SQL}, c AS (SELECT 'c' || k AS city, count(*) AS n FROM alerts GROUP BY k) SELECT city, n + (CASE WHEN city LIKE '%7' THEN 1 ELSE 0 END) AS declared, n AS found FROM c WHERE city LIKE '%7'""")
def declared_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of cities and their episodes, some of which declare one more than there are."""
    one = F.struct(F.concat(F.lit("c"), "k").alias("city_key"), times.iso(F.col("start_us")).alias("start_at"), times.iso(F.col("end_us")).alias("end_at"), F.lit("closed").alias("episode_state"))
    rows = alerts(spark, sf_dir).groupBy("k").agg(F.collect_list(one).alias("episodes"))
    block = F.struct((F.size("episodes") + F.when(F.col("k").cast("string").endswith("7"), 1).otherwise(0)).alias("count"), "episodes")
    body = rows.select(F.to_json(F.struct(F.create_map(F.concat(F.lit("c"), "k"), block).alias("cities"))).alias("body"))
    found = histories.corpus(body, "body").groupBy("city").agg(F.max("declared").alias("declared"), F.count("start_at").alias("found"))
    return found.where("declared <> found")


@query(f"""WITH {SPANS_SQL}, {daily_sql('d', 'alerts', 'oblast')} SELECT 'daily' AS grain, oblast, CAST(day AS VARCHAR) AS day, alerts_started AS n FROM d UNION ALL SELECT 'started', oblast, CAST({local_day_sql('start_us')} AS VARCHAR), count(*) FROM alerts GROUP BY ALL""")
def published_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grains of a publication as one JSON document, and back."""
    rows = alerts(spark, sf_dir)
    grains = {"daily": calendar.daily(rows, ["oblast"]), "started": calendar.started_daily(rows, ["oblast"])}
    text = sinks.document({name: (grain.select("oblast", "day", "alerts_started"), ["oblast", "day"]) for name, grain in grains.items()})
    item = "array<struct<oblast:long,day:string,alerts_started:long>>"
    read = text.select(F.from_json("document", f"daily {item}, started {item}").alias("d"))
    each = [read.select(F.lit(name).alias("grain"), F.explode(f"d.{name}").alias("r")) for name in grains]
    return each[0].unionByName(each[1]).select("grain", "r.oblast", "r.day", F.col("r.alerts_started").alias("n"))


@query(f"""WITH {SPANS_SQL} SELECT start_us, end_us, floor((end_us - start_us) / 60000000.0::DOUBLE * 1000 + 0.5) / 1000 AS duration_minutes, level AS source FROM alerts""")
def event_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event file with published minutes, and back."""
    path = new_path(spark)
    sinks.event_file(alerts(spark, sf_dir).withColumn("source", F.col("level")), path)
    rows = spark.read.schema("start string, end string, duration_minutes double, source string").json(path)
    return rows.select(times.utc_to_us(F.col("start")).alias("start_us"), times.utc_to_us(F.col("end")).alias("end_us"), "duration_minutes", "source")


@query("""SELECT o_custkey AS key, max(epoch_us(o_orderdate)) AS fetched_us, min(epoch_us(o_orderdate)) AS first_fetched_us FROM orders GROUP BY 1""")
def merged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches merged into a table by key, one of them told twice: each version is committed once."""
    store = sinks.KeyedTable(spark, new_path(spark), ["key"], buckets=16)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), times.micros(F.col("o_orderdate")).alias("fetched_us"), "o_orderstatus")
    for epoch, status in enumerate(["F", "O", "O", "P"]):
        polls.upsert_into(store, ["key"])(rows.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), min(epoch, 1) if epoch < 3 else 2)
    return store.current()


@query("""SELECT 'child' AS kind, l_orderkey AS k, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY 2 UNION ALL SELECT 'waiting', l_orderkey, count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' GROUP BY 2""")
def late_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which lines come a batch before their orders; lines of pending orders wait on."""
    source = new_path(spark)
    schema = "kind string, k long, at_us long, n long"
    lines = table(spark, sf_dir, "lineitem").select(F.lit("child").alias("kind"), F.col("l_orderkey").alias("k"), times.micros(F.col("l_shipdate")).alias("at_us"), F.col("l_linenumber").cast("long").alias("n"))
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.lit("parent").alias("kind"), F.col("o_orderkey").alias("k"), times.micros(F.col("o_orderdate")).alias("at_us"), F.lit(0).cast("long").alias("n"))
    store = sinks.KeyedTable(spark, new_path(spark), ["k"], buckets=16)
    checkpoint = new_path(spark)
    for part in (lines, orders):
        part.write.mode("append").parquet(source)
        run = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(polls.parents_first(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
    return store.current().where("kind <> 'parent'").groupBy("kind", "k").agg(F.count("*").alias("n"))


@query("SELECT event_id, epoch_us(ts) AS us FROM events WHERE event_id % 6 <> 5 UNION ALL SELECT event_id, -1 FROM events WHERE event_id % 6 = 5")
def odd_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock texts in UTC: with nine digits of a fraction, with an offset, with a blank, without zone; and texts that are none."""
    rows = table(spark, sf_dir, "events")
    us, form = times.micros(F.col("ts")), F.col("event_id") % 6
    plain = lambda c: F.date_format(times.instant(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(form == 0, F.concat(plain(us), F.lit("789Z"))).when(form == 1, F.concat(plain(us + 2 * 3600 * times.SECOND), F.lit("+02:00"))).when(form == 2, F.translate(plain(us), "T", " "))
            .when(form == 3, F.concat(plain(us - 3600 * times.SECOND), F.lit("123-01:00"))).when(form == 4, plain(us)).otherwise(F.concat(F.lit("2024-13-"), F.col("event_id"))))
    return rows.select("event_id", F.coalesce(times.utc_to_us(text), F.lit(-1)).alias("us"))


@query("SELECT page_id, page_id % 5 = 0 AS known FROM pages WHERE page_id % 5 = 0 OR page_id % 3 <> 0")
def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose digest is not the stored one, or which are not stored yet."""
    found = pages.articles(table(spark, sf_dir, "pages"))
    known = found.where("page_id % 5 = 0 OR page_id % 3 = 0").select("page_id", F.when(F.col("page_id") % 5 == 0, "old").otherwise(F.col("digest")).alias("digest"))
    return pages.changed(found, known).join(known.select("page_id", F.lit(True).alias("k")), "page_id", "left").select("page_id", F.coalesce("k", F.lit(False)).alias("known"))


@query("""SELECT o_orderkey // 20 AS page_id, 'news.example' AS host, 'https://news.example/a/' || o_orderkey AS url FROM orders WHERE o_orderkey % 4 < 2 AND o_orderkey % 3 <> 2""")
def relevant_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages of reports whose text names a place, an attack and its victims, of one host."""
    href = F.when(F.col("o_orderkey") % 3 == 2, F.lit("https://other.example/")).when(F.col("o_orderkey") % 3 == 1, F.lit("//news.example/a/")).otherwise(F.lit("/a/"))
    anchor = F.concat(F.lit('<li><a class="x" href="'), href, F.col("o_orderkey"), F.lit('#c"><b>'), "text", F.lit("</b></a>"))
    rows = _reports(spark, sf_dir).groupBy(F.floor(F.col("o_orderkey") / 20).alias("page_id")).agg(F.array_join(F.collect_list(anchor), "\n").alias("html")).withColumn("url", F.lit("https://news.example/index.html"))
    return pages.links(rows, ["news.example"], relevant=True).drop("title")
