"""Aggregations, sorting, set union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import scalars as S
from tidemark.operators import aggregates as A
from tidemark.plans.registry import Tables, query
from tidemark.sources.files import footer_report, union_tagged


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("agg_count_meta", """
SELECT 'lineitem' AS "table", count(*) AS n FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events""")
def agg_count_meta(t: Tables) -> DataFrame:
    counted = footer_report(t.spark, f"{t.path}/{{lineitem,orders,events}}.parquet")
    per_file = counted.groupBy("table", "file").agg(F.max("rows").alias("n"))
    return per_file.groupBy("table").agg(F.sum("n").alias("n"))


@query("agg_basic", """
SELECT event_type, count(*) AS c, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s,
       min(value) AS mn, max(value) AS mx FROM events GROUP BY event_type""")
def agg_basic(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("c"), A.exact_sum("value").alias("s"),
        F.min("value").alias("mn"), F.max("value").alias("mx"),
    )


@query("agg_multi_key", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_multi_key(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
           FROM {lineitem} GROUP BY 1, 2""",
        lineitem=t.lineitem,
    )


@query("agg_p90", """
SELECT event_type, round(quantile_cont(value, 0.9), 4) AS p90 FROM events GROUP BY event_type""")
def agg_p90(t: Tables) -> DataFrame:
    exact = A.exact_percentile(t.events, ["event_type"], {"p90": "value"})
    return exact.select("event_type", F.round("p90", 4).alias("p90"))


@query("agg_latest", """
SELECT user_id, arg_max(value, event_id) AS last_value, arg_max(event_type, event_id) AS last_type
FROM events GROUP BY user_id""")
def agg_latest(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(
        A.latest("value", "ts", "event_id").alias("last_value"),
        A.latest("event_type", "ts", "event_id").alias("last_type"),
    )


@query("agg_group_array", """
SELECT l_orderkey, (nth - 1) // 4 AS part, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY nth) AS parts
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey,
      l_extendedprice) AS nth FROM lineitem)
GROUP BY 1, 2""")
def agg_group_array(t: Tables) -> DataFrame:
    order = ["l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    lines = t.lineitem.select("l_orderkey", *order)
    arrays = A.group_array(lines, ["l_orderkey"], "l_partkey", order, "parts", rows_per_part=4)
    return arrays.withColumn("parts", F.array_join("parts", ","))


@query("agg_ratio", """
SELECT l_returnflag, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
       / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 2) AS ratio
FROM lineitem GROUP BY l_returnflag""")
def agg_ratio(t: Tables) -> DataFrame:
    ratio = S.ratio(A.exact_sum("l_extendedprice"), A.exact_sum("l_quantity"))
    return t.lineitem.groupBy("l_returnflag").agg(ratio.alias("ratio"))


@query("agg_per_shard", "SELECT user_id % 8 AS shard, count(*) AS n FROM events GROUP BY 1")
def agg_per_shard(t: Tables) -> DataFrame:
    return t.events.groupBy((F.col("user_id") % 8).alias("shard")).agg(F.count("*").alias("n"))


@query("topk_parts", """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 20""")
def topk_parts(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "l_partkey").limit(20)


@query("union_tagged", """
SELECT '0x' || (1 + user_id % 3) AS node, event_type, min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n
FROM events GROUP BY 1, 2""")
def tagged_nodes(t: Tables) -> DataFrame:
    nodes = {f"0x{i + 1}": t.events.where(F.col("user_id") % 3 == i) for i in range(3)}
    return union_tagged(nodes).groupBy("node", "event_type").agg(
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("n")
    )
