"""Pages and feeds as tables: links, articles, feed items, history marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import times, words


def links(pages: DataFrame, hosts: list[str] | None = None, relevant: bool = False) -> DataFrame:
    """Distinct (page_id, host, url, title) of a page's anchors, absolute, http(s) only, without fragments; with ``relevant`` only those
    whose text names a place, an attack and its victims."""
    anchor = r'(?is)<a\b[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'
    rows = pages.withColumn("hrefs", F.regexp_extract_all("html", F.lit(anchor), F.lit(1))).withColumn("titles", F.regexp_extract_all("html", F.lit(anchor), F.lit(2)))
    root = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1).alias("root")

    def told(a: Column) -> Column:
        href = F.trim(a["hrefs"])
        whole = F.when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat("root", href)).otherwise(href)
        return F.struct(words.bare_url(whole).alias("url"), words.plain_text(a["titles"]).alias("title"))

    # through a generator, as filters over plain columns would have texts made again for each mention
    rows = rows.select("page_id", root, F.arrays_zip("hrefs", "titles").alias("anchors")).select("page_id", F.explode(F.transform("anchors", told)).alias("a"))
    host = F.lower(F.regexp_extract(F.col("a.url"), r"^https?://([^/?#:]+)", 1))
    rows = rows.select("page_id", host.alias("host"), "a.url", "a.title").where("url is not null")
    if relevant:
        rows = rows.where(words.relevant(F.col("title")))
    return (rows if hosts is None else rows.where(F.col("host").isin(hosts))).dropDuplicates()


def articles(pages: DataFrame) -> DataFrame:
    """(page_id, title, n_chars, digest) of the text of each page."""
    title = words.plain_text(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    rows = pages.select("page_id", title.alias("title"), words.plain_text(F.col("html")).alias("text"))
    return rows.select("page_id", "title", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


def changed(articles: DataFrame, known: DataFrame) -> DataFrame:
    """Articles whose digest is not the stored one."""
    return articles.join(known.select("page_id", F.col("digest").alias("old")), "page_id", "left").where("not (digest <=> old)").drop("old")


def feed_items(feeds: DataFrame) -> DataFrame:
    """(feed_id, title, link) of the items of captured RSS documents."""
    item = F.explode(F.arrays_zip(F.xpath("body", F.lit("//item/title/text()")).alias("title"), F.xpath("body", F.lit("//item/link/text()")).alias("link")))
    return feeds.select("feed_id", item.alias("i")).select("feed_id", F.trim("i.title").alias("title"), words.bare_url(F.trim("i.link")).alias("link"))


def history_marks(pages: DataFrame, zone: str = times.ZONE) -> DataFrame:
    """(key, ts_us, kind) of the rows of history pages: a time and date, and a text that says start or all-clear."""
    row = r"(?s)(\d{1,2}:\d\d\s+\d\d\.\d\d\.\d\d(?:(?!\d{1,2}:\d\d\s+\d\d\.\d\d\.\d\d).)*)"
    rows = pages.select("key", F.explode(F.regexp_extract_all(words.plain_text(F.col("html")), F.lit(row), F.lit(1))).alias("r"))
    stamp = F.try_to_timestamp(F.regexp_extract("r", r"^(\d{1,2}:\d\d\s+\d\d\.\d\d\.\d\d)", 1), F.lit("H:mm dd.MM.yy"))
    text = F.lower("r")
    kind = F.when(text.contains("відбій"), "end").when(text.contains("тривога"), "start")
    out = rows.select("key", F.unix_micros(F.to_utc_timestamp(stamp, zone)).alias("ts_us"), kind.alias("kind"))
    return out.where("ts_us is not null and kind is not null").dropDuplicates()
