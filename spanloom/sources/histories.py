"""Captured alert data as tables: municipal and national files, region histories, hierarchies, replayed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import times
from spanloom.sources import trees

MUNICIPAL = "type string, dateTimeStart string, dateTimeEnd string"
COMMITTED = "start string, end string, duration_minutes double, source string"
NATIONAL = "oblast string, raion string, hromada string, level string, started_at string, finished_at string"
ALARM = "struct<alertType:string,startDate:string,endDate:string,isContinue:boolean,regionId:string,regionName:string>"
HISTORY = f"struct<regionId:string,regionName:string,alarms:array<{ALARM}>>"


def municipal(spark: SparkSession, path: str, kind: str, zone: str = times.ZONE) -> DataFrame:
    """Lenient scan of a JSON array of local times: rows of another type, unreadable or not positive are left out."""
    rows = spark.read.schema(MUNICIPAL).option("multiLine", True).json(path).where(F.col("type") == kind)
    rows = rows.select(times.local_to_us(F.col("dateTimeStart"), zone).alias("start_us"), times.local_to_us(F.col("dateTimeEnd"), zone).alias("end_us"))
    return rows.where("end_us > start_us").withColumn("source", F.lit("official_json"))


def committed(spark: SparkSession, path: str) -> DataFrame:
    """Strict scan of a committed event file; ``violations`` of it must be empty."""
    rows = spark.read.schema(COMMITTED).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(times.utc_to_us(F.col("start")).alias("start_us"), times.utc_to_us(F.col("end")).alias("end_us"), "source",
                       (times.has_zone(F.col("start")) & times.has_zone(F.col("end"))).alias("zoned"))


def violations(rows: DataFrame) -> DataFrame:
    return rows.where("start_us is null or end_us is null or end_us <= start_us or not zoned")


def primary_or_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary source's rows, or the fallback's where it has none, with ``mode``."""
    if primary.isEmpty():
        return fallback.withColumn("mode", F.lit("fallback"))
    return primary.withColumn("mode", F.lit("primary"))


def national(spark: SparkSession, path: str) -> DataFrame:
    """The national CSV (a byte order mark is skipped) with instants; unreadable and non-positive rows are left out."""
    rows = spark.read.schema(NATIONAL).option("header", True).option("enforceSchema", False).option("encoding", "UTF-8").csv(path)
    rows = rows.withColumns({"start_us": times.utc_to_us(F.col("started_at")), "end_us": times.utc_to_us(F.col("finished_at"))})
    return rows.where("end_us > start_us").drop("started_at", "finished_at")


def by_region(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct events of the wanted regions, from ``dim`` (level, oblast, raion, hromada, key, valid_from_us); a null
    column of it does not matter for the match.

    An event asks with each choice of its columns left out, so that the join is one of equal keys.
    """
    places = ("oblast", "raion", "hromada")
    asked = F.array(*[F.struct(*[(F.col(c) if kept >> i & 1 else F.lit(None).cast("string")).alias(f"d_{c}") for i, c in enumerate(places)]) for kept in range(8)])
    events = rows.withColumn("asked", F.explode(F.array_distinct(asked))).select("*", "asked.*")
    events = events.select("level", "start_us", "end_us", F.to_json(F.struct(*[f"d_{c}" for c in places])).alias("place"))
    wanted = dim.select("level", "key", "valid_from_us", F.to_json(F.struct(*[F.col(c).alias(f"d_{c}") for c in places])).alias("place"))
    met = events.alias("e").join(wanted.alias("d"), ["level", "place"])
    met = met.where(F.coalesce(F.col("e.start_us") >= F.col("d.valid_from_us"), F.lit(True)))
    return met.select("level", F.col("d.key").alias("key"), "e.start_us", "e.end_us").dropDuplicates()


def alarms(bodies: DataFrame, body: str, default_id: Column | None = None, default_name: Column | None = None) -> DataFrame:
    """Alarm rows of region histories: JSON text of one object or a list of them. Regions whose alarms are no list go.

    A region without an id takes the fallback's, and only without one that of the alarm.
    """
    default_id, default_name = (F.lit(None) if c is None else c for c in (default_id, default_name))
    text = F.trim(F.col(body))
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    rows = bodies.select(F.explode(F.from_json(listed, f"array<{HISTORY}>")).alias("r")).where("r.alarms is not null")
    rows = rows.select(F.col("r.regionId").alias("i"), F.col("r.regionName").alias("n"), F.explode("r.alarms").alias("a"))
    return rows.select(
        F.coalesce(F.col("i"), default_id, F.col("a.regionId")).alias("region_id"), F.coalesce(F.col("n"), default_name).alias("region_name"),
        F.col("a.regionName").alias("name"), F.col("a.alertType").alias("alert_type"), times.utc_to_us(F.col("a.startDate")).alias("start_us"),
        times.utc_to_us(F.col("a.endDate")).alias("end_us"), F.coalesce("a.isContinue", F.lit(False)).alias("open"))


def hierarchy(bodies: DataFrame, body: str) -> DataFrame:
    """Distinct nodes (level, id, name, parent) of nested states, districts and communities, at whatever depth they are."""
    return trees.nodes(bodies, body, trees.HIERARCHY).drop("kind")


def groups_by_name(rows: DataFrame) -> DataFrame:
    """(name, region_id, alarms) from ``alarms``: regions of one name are one group, under the id of the first of them that has one."""
    named = rows.withColumn("name", F.trim("region_name")).where("name <> ''")
    return named.groupBy("name").agg(F.min("region_id").alias("region_id"), F.count("*").alias("alarms"))


def corpus(bodies: DataFrame, body: str) -> DataFrame:
    """(city, start_at, end_at, state, declared) of a JSON document of cities to episodes with declared counts."""
    schema = "cities map<string,struct<count:long,episodes:array<struct<city_key:string,start_at:string,end_at:string,episode_state:string>>>>"
    rows = bodies.select(F.explode(F.from_json(body, schema)["cities"]).alias("city", "c"))
    return rows.select("city", F.col("c.count").alias("declared"), F.explode_outer("c.episodes").alias("e")).select("city", "declared", "e.*")


def observation_batches(spark: SparkSession, paths: str) -> tuple[DataFrame, DataFrame]:
    """Observations and references of batch files, each with the file's path."""
    schema = "observations array<struct<observation_id:string,city_key:string,title:string,url:string>>, episode_results array<struct<episode_id:string,source_observation_ids:array<string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(paths).select("*", F.col("_metadata.file_path").alias("path"))
    seen = rows.select("path", F.posexplode("observations").alias("position", "o")).select("path", "position", "o.*")
    told = rows.select("path", F.explode("episode_results").alias("r")).select("path", "r.episode_id", F.explode("r.source_observation_ids").alias("observation_id"))
    return seen, told


def capture_pages(rows: DataFrame) -> DataFrame:
    """Captured response bodies with their digests; ``intact`` where the declared one is right."""
    body = F.unbase64("body_base64")
    return rows.withColumn("body", body).withColumn("intact", F.sha2(body, 256) == F.col("body_sha256"))


def replayed(pages: DataFrame) -> DataFrame:
    """Completed pairs of captured pages, by kind of source: nested histories, or history pages in HTML."""
    from spanloom.operators import ingest
    from spanloom.sources import pages as html

    nested = alarms(pages.where("source_key = 'history'").select(F.col("body").cast("string").alias("t")), "t").where("upper(alert_type) = 'AIR' and end_us > start_us")
    marks = html.history_marks(pages.where("source_key = 'page'").select(F.col("city").alias("key"), F.col("body").cast("string").alias("html")))
    return nested.select(F.col("region_id").alias("key"), "start_us", "end_us").unionByName(ingest.paired(marks, ["key"])).distinct()


def _table_file(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("header", True).option("enforceSchema", False).option("encoding", "UTF-8").csv(path)
    return rows.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in columns])


#: Columns of the baseline, of revisions, and what incidents add to them.
BASELINE = ["month", "deaths", "coverage_through", "note"]
REVISIONS = ["record_id", "observed_at", "attack_date", "deaths_delta", "status", "source_name", "source_url", "note"]
INCIDENTS = ["city_key", "candidate_ids", "incident_id", "count_kind", "baseline_credited", "identity_proof", "credited_proof"]


def baseline_file(spark: SparkSession, path: str) -> DataFrame:
    """The monthly baseline: text trimmed, the count a number or null."""
    return _table_file(spark, path, BASELINE).withColumn("deaths", F.col("deaths").try_cast("int"))


def revision_file(spark: SparkSession, path: str, incidents: bool = False) -> DataFrame:
    """Revisions in the old layout, or with ``incidents`` in that of incidents; all columns text, as rules read them."""
    return _table_file(spark, path, [*REVISIONS, *(INCIDENTS if incidents else [])])


QUEUE = """candidate_id string, city_key string, status string, url string, title string, snippet string, source string, published_at string,
review_disposition struct<decision:string,reviewer:string,reason:string>, review_history array<struct<at:string,from:string,to:string>>"""


def review_queue(spark: SparkSession, path: str) -> DataFrame:
    """The candidates of a review queue, a JSON array."""
    return spark.read.schema(QUEUE).option("multiLine", True).json(path).where("candidate_id is not null")
