"""Queries over JSON documents and captured bodies made from the driver's tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.plans.views import table
from spanloom.sources import trees

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def _node(id_: Column, name: Column, kind: str, below: Column) -> Column:
    """JSON text of a region node; ``below`` is that of its children, by commas."""
    return F.concat(F.lit('{"regionId":"'), id_, F.lit('","regionName":"'), name, F.lit(f'","regionType":"{kind}","regionChildIds":['), below, F.lit("]}"))


def order_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(body): a tree of up to eight levels for each order: region, nation, customer, year, month, order, lines, parts.

    Years and months are left out for finished orders, parts for small lines, so levels are uneven.
    """
    said = lambda head, *parts: F.concat(F.lit(head), *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    none, dash = F.lit(""), F.lit("-")
    lines = table(spark, sf_dir, "lineitem")
    part = F.when(F.col("l_quantity") > 25, _node(said("p", "l_partkey"), said("Part ", "l_partkey"), "Part", none)).otherwise(none)
    line = _node(said("l", "l_orderkey", dash, "l_linenumber"), said("Line ", "l_linenumber"), "Line", part)
    lines = lines.groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), ",").alias("lines"))  # an order has few lines
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    year, month = F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "yyyy-MM")
    order = _node(said("o", "o_orderkey"), said("Order ", "o_orderkey"), "Order", F.col("lines"))
    dated = _node(said("y", "c_custkey", dash, year), year, "Year", _node(said("m", "c_custkey", dash, month), month, "Month", order))
    customer = _node(said("c", "c_custkey"), F.col("c_name"), "Customer", F.when(F.col("o_orderstatus") == "F", order).otherwise(dated))
    nation = _node(said("n", "n_nationkey"), F.col("n_name"), "Nation", customer)
    return rows.select(F.concat(F.lit('{"states":['), _node(said("r", "r_regionkey"), F.col("r_name"), "Region", nation), F.lit("]}")).alias("body"))


@query("""WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_custkey AS c, c_name, n_nationkey AS n, n_name, r_regionkey AS r, r_name, o_orderstatus = 'F' AS flat, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%Y-%m') AS m
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
e AS (SELECT DISTINCT * FROM (SELECT 'r' || r AS id, r_name AS name, 'Region' AS kind, NULL AS parent FROM o UNION ALL SELECT 'n' || n, n_name, 'Nation', 'r' || r FROM o UNION ALL SELECT 'c' || c, c_name, 'Customer', 'n' || n FROM o
  UNION ALL SELECT 'y' || c || '-' || y, y, 'Year', 'c' || c FROM o WHERE NOT flat UNION ALL SELECT 'm' || c || '-' || m, m, 'Month', 'y' || c || '-' || y FROM o WHERE NOT flat
  UNION ALL SELECT 'o' || k, 'Order ' || k, 'Order', CASE WHEN flat THEN 'c' || c ELSE 'm' || c || '-' || m END FROM o
  UNION ALL SELECT 'l' || l_orderkey || '-' || l_linenumber, 'Line ' || l_linenumber, 'Line', 'o' || l_orderkey FROM lineitem UNION ALL SELECT 'p' || l_partkey, 'Part ' || l_partkey, 'Part', 'l' || l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_quantity > 25)),
t AS (SELECT * FROM e WHERE parent IS NULL UNION SELECT e.* FROM e JOIN t ON e.parent = t.id)
SELECT 'region' AS level, id, name, min(kind) AS kind, min(parent) AS parent FROM t GROUP BY id, name""")
def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region nodes from trees of eight uneven levels, one for each order."""
    return trees.nodes(order_trees(spark, sf_dir), "body")


def order_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(k, body): a nested document for each order, and a later version in which each priority has been changed in its own way."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("mode")).alias("of"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    # lines come last: they are moved once, and both versions stay dealt by their key
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    at, urgency = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
    home = lambda nation: F.struct(F.col("c_mktsegment").alias("segment"), nation.alias("nation"))
    body = lambda status, customer, held: F.to_json(F.struct(F.struct(status.alias("status"), customer.alias("customer")).alias("order"), held.alias("lines")))
    status, nation = F.col("o_orderstatus"), F.col("c_nationkey").cast("string")
    whole = body(status, home(nation), F.col("lines"))
    after = (F.when(urgency == "1", body(status, home(F.lit(None).cast("string")), F.col("lines")))  # a value three levels down is gone
             .when(urgency == "2", body(status, F.col("c_mktsegment"), F.col("lines")))  # an object has become a text
             .when(urgency == "3", body(status, home(nation), F.slice("lines", F.lit(2), F.size("lines"))))  # the first line is gone
             .when(urgency == "4", body(F.lit("changed"), home(nation), F.concat("lines", F.slice("lines", 1, 1))))  # allowed: a correction, and one line more
             .otherwise(whole))
    later = rows.where((urgency != "5") | (F.col("o_orderstatus") != "F"))  # documents that are gone
    return rows.select(at.alias("k"), whole.alias("body")), later.select(at.alias("k"), after.alias("body"))


@query("""WITH RECURSIVE l AS (SELECT l_orderkey AS k, list({'n': l_linenumber, 'of': {'part': l_partkey, 'mode': l_returnflag}} ORDER BY l_linenumber, l_partkey, l_returnflag) AS lines FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey AS k, o_orderstatus AS s, left(o_orderpriority, 1) AS u, c_mktsegment AS g, CAST(c_nationkey AS VARCHAR) AS n, to_json(lines) AS lines, to_json(lines[2:]) AS fewer, to_json(list_concat(lines, lines[1:1])) AS more
  FROM orders JOIN l ON o_orderkey = l.k JOIN customer ON o_custkey = c_custkey),
d AS (SELECT k, json_object('order', json_object('status', s, 'customer', json_object('segment', g, 'nation', n)), 'lines', lines) AS a,
  CASE u WHEN '1' THEN json_object('order', json_object('status', s, 'customer', json_object('segment', g)), 'lines', lines) WHEN '2' THEN json_object('order', json_object('status', s, 'customer', g), 'lines', lines)
    WHEN '3' THEN json_object('order', json_object('status', s, 'customer', json_object('segment', g, 'nation', n)), 'lines', fewer) WHEN '4' THEN json_object('order', json_object('status', 'changed', 'customer', json_object('segment', g, 'nation', n)), 'lines', more)
    WHEN '5' THEN CASE WHEN s <> 'F' THEN json_object('order', json_object('status', s, 'customer', json_object('segment', g, 'nation', n)), 'lines', lines) END END AS b FROM r),
w AS (SELECT k, '' AS path, a, b, 0 AS depth FROM d UNION ALL SELECT k, path || '/' || f, json_extract(a, '$.' || f), json_extract(b, '$.' || f), depth + 1 FROM (SELECT *, unnest(json_keys(a)) AS f FROM w WHERE json_type(a) = 'OBJECT' AND json_type(b) = 'OBJECT')),
x AS (SELECT k, path, CAST(e AS VARCHAR) AS e, 1 AS n FROM (SELECT k, path, unnest(from_json(a, '["JSON"]')) AS e FROM w WHERE json_type(a) = 'ARRAY' AND json_type(b) = 'ARRAY') UNION ALL
  SELECT k, path, CAST(e AS VARCHAR), -1 FROM (SELECT k, path, unnest(from_json(b, '["JSON"]')) AS e FROM w WHERE json_type(a) = 'ARRAY' AND json_type(b) = 'ARRAY'))
SELECT k, path, CASE WHEN b IS NULL AND depth = 0 THEN 'document' WHEN b IS NULL OR json_type(b) = 'NULL' THEN 'member' ELSE 'shape' END AS lost, CAST(1 AS BIGINT) AS n FROM w
WHERE b IS NULL OR json_type(b) = 'NULL' OR (json_type(a) IN ('OBJECT', 'ARRAY') AND json_type(a) <> json_type(b))
UNION ALL SELECT k, path, 'element', CAST(sum(n) AS BIGINT) FROM (SELECT k, path, e, sum(n) AS n FROM x GROUP BY ALL HAVING sum(n) > 0) GROUP BY k, path""")
def lost_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a later version of nested documents has lost, at any depth."""
    lost = trees.not_retained(*order_documents(spark, sf_dir), "k", "body", null_keys=False)
    return lost.select(F.col("key").alias("k"), F.concat_ws("", F.transform("path", lambda p: F.concat(F.lit("/"), p))).alias("path"), "lost", "n")
