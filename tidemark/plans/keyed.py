"""Keyed tables, retention, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import keyed, retention
from tidemark.operators.latest import latest_by_key
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path

_VERSIONS = """
WITH d AS (SELECT o_orderkey, o_custkey, o_totalprice, 0 AS ver FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 1 FROM orders WHERE o_orderkey % 10 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ver DESC) AS rn FROM d)"""


def _base(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(0).alias("ver"))


def _newer(t: Tables) -> DataFrame:
    raised = (F.col("o_totalprice") + 1).alias("o_totalprice")
    return t.orders.where("o_orderkey % 10 = 0").select(
        "o_orderkey", "o_custkey", raised, F.lit(1).alias("ver")
    )


def _table(t: Tables) -> keyed.KeyedTable:
    path = scratch_path(t.spark, "keyed")
    table = keyed.KeyedTable(t.spark, path, _base(t).schema, ["o_orderkey"], ["ver"], buckets=8)
    table.upsert(_base(t))
    table.upsert(_newer(t))
    return table


@query("keyed_upsert", f"{_VERSIONS} SELECT o_orderkey, o_custkey, o_totalprice, ver FROM k WHERE rn = 1")
def keyed_upsert(t: Tables) -> DataFrame:
    return _table(t).read()


@query("keyed_versioned", f"{_VERSIONS} SELECT o_orderkey, o_totalprice, ver FROM k WHERE rn = 1")
def keyed_versioned(t: Tables) -> DataFrame:
    # the newer versions arrive first; the version decides, not the arrival
    rows = _newer(t).withColumn("seq", F.lit(1)).unionByName(_base(t).withColumn("seq", F.lit(2)))
    return latest_by_key(rows, ["o_orderkey"], ["ver", "seq"]).select("o_orderkey", "o_totalprice", "ver")


@query("keyed_arrival", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice - 5 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def keyed_arrival(t: Tables) -> DataFrame:
    """Without a version column the row that came last wins, also one with smaller values."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    table = keyed.KeyedTable(t.spark, scratch_path(t.spark, "keyed"), rows.schema, ["o_orderkey"], buckets=8)
    table.upsert(rows)
    for change in (100, -5):
        table.upsert(rows.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + change))
    return table.read()


@query("keyed_partial", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice, 3 AS ver
FROM orders""")
def keyed_partial(t: Tables) -> DataFrame:
    """A change that lacks columns, the version too, replaces the row and leaves the others NULL."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(3).alias("ver"))
    table = keyed.KeyedTable(t.spark, scratch_path(t.spark, "keyed"), rows.schema, ["o_orderkey"], ["ver"], buckets=8)
    table.upsert(rows)
    table.upsert(t.orders.where("o_orderkey % 7 = 0").select("o_orderkey", (F.col("o_totalprice") + 2).alias("o_totalprice")))
    return table.read()


@query("keyed_delete", f"""
{_VERSIONS} SELECT o_orderkey, o_custkey, o_totalprice, ver FROM k WHERE rn = 1
AND NOT (o_orderkey BETWEEN 1000 AND 1015) AND o_custkey <> 18""")
def keyed_delete(t: Tables) -> DataFrame:
    table = _table(t)
    table.delete(F.col("o_orderkey").between(1000, 1015) | (F.col("o_custkey") == 18))
    return table.read()


@query("keyed_ttl", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 365 DAY""")
def keyed_ttl(t: Tables) -> DataFrame:
    as_of = F.lit("1998-12-01").cast("timestamp_ntz")
    return keyed.unexpired(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "365 DAYS", as_of)


@query("keyed_compact", f"{_VERSIONS} SELECT o_orderkey, o_custkey, o_totalprice, ver FROM k WHERE rn = 1")
def keyed_compact(t: Tables) -> DataFrame:
    table = _table(t)
    table.compact()
    return table.read()


@query("retention_drop", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY AS DATE) GROUP BY 1""")
def retention_drop(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "by-day")
    daily = t.events.select("event_id", "ts", F.to_date("ts").alias("day"))
    retention.write_layout(daily, path, ["day"], ["event_id"])
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    kept = retention.drop_expired_partitions(t.spark.read.parquet(path), "day", "10 DAYS", as_of)
    return kept.groupBy("day").agg(F.count("*").alias("n"))


AGE_RULES = [("3 DAYS", "warm"), ("7 DAYS", "cold")]


@query("tier_of_age", """
SELECT event_id, CASE WHEN ts + INTERVAL 7 DAY <= TIMESTAMP '2024-01-31' THEN 'cold'
  WHEN ts + INTERVAL 3 DAY <= TIMESTAMP '2024-01-31' THEN 'warm' ELSE 'hot' END AS tier FROM events""")
def tier_of_age(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    return t.events.select(
        "event_id", retention.tier_of_age(F.col("ts"), as_of, AGE_RULES).alias("tier")
    )


@query("tier_move", """
SELECT tier, count(*) AS n, CAST(count(DISTINCT day) AS BIGINT) AS days FROM (
  SELECT CAST(ts AS DATE) AS day,
    CASE WHEN CAST(ts AS DATE) + INTERVAL 7 DAY <= TIMESTAMP '2024-01-31' THEN 'cold'
         WHEN CAST(ts AS DATE) + INTERVAL 3 DAY <= TIMESTAMP '2024-01-31' THEN 'warm' ELSE 'hot' END AS tier
  FROM events WHERE CAST(ts AS DATE) + INTERVAL 20 DAY > TIMESTAMP '2024-01-31') GROUP BY tier""")
def tier_move(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tiers")
    roots = {name: f"{path}/{name}" for name in ("hot", "warm", "cold")}
    daily = t.events.select("event_id", F.to_date("ts").alias("day"))
    table = retention.TieredTable(t.spark, roots, daily.schema, "day", ["event_id"])
    late = F.col("event_id") % 20 == 0  # arrives when its day has already moved
    for part in (daily.where(~late), daily.where(late)):
        table.append(part)
        table.apply("2024-01-31 00:00:00", AGE_RULES, "20 DAYS")
    held = [
        table.read(tier).groupBy(F.lit(tier).alias("tier"), "day").agg(F.count("*").alias("n"))
        for tier in roots
    ]
    days = held[0].unionByName(held[1]).unionByName(held[2])
    return days.groupBy("tier").agg(F.sum("n").alias("n"), F.count("*").alias("days"))
