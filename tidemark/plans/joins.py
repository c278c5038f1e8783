"""Lookup and latest-value joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.json import json_encode, json_path
from tidemark.operators import latest, lookup
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.streaming.shared import RefreshedSide
from tidemark.streaming.views import View, run_to_end, stream_table


@query("join_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_lookup(t: Tables) -> DataFrame:
    probe = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    dim = t.part.select("p_partkey", "p_name", "p_brand")
    return lookup.lookup_join(probe, dim, "l_partkey", "p_partkey").drop("p_partkey")


@query("join_keyed_table", """
WITH v AS (SELECT p_partkey, p_name, 0 AS version FROM part
           UNION ALL SELECT p_partkey, 'new ' || p_name, 1 FROM part WHERE p_size > 25)
SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem
JOIN (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY version DESC) AS rn FROM v)
  ON l_partkey = p_partkey AND rn = 1""")
def join_keyed_table(t: Tables) -> DataFrame:
    base = t.part.select("p_partkey", "p_name", F.lit(0).alias("version"))
    renamed = F.concat(F.lit("new "), "p_name").alias("p_name")
    newer = t.part.where("p_size > 25").select("p_partkey", renamed, F.lit(1).alias("version"))
    joined = lookup.keyed_lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
        base.unionByName(newer), "l_partkey", "p_partkey", ["version"],
    )
    return joined.drop("p_partkey", "version")


@query("dict_get", """
SELECT event_id, user_id, c_name AS customer FROM events LEFT JOIN customer ON c_custkey = user_id * 12""")
def dict_get(t: Tables) -> DataFrame:
    probe = t.events.select("event_id", "user_id", (F.col("user_id") * 12).alias("_c"))
    return lookup.dict_get(probe, t.customer, "_c", "c_custkey", "c_name", "customer").drop("_c")


@query("join_two_tier", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_partkey % 4 = 0 THEN 'cached ' || p_name ELSE p_name END AS p_name
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_two_tier(t: Tables) -> DataFrame:
    remote = t.part.select("p_partkey", "p_name")
    cached = F.concat(F.lit("cached "), "p_name").alias("p_name")
    cache = remote.where("p_partkey % 4 = 0").select("p_partkey", cached)
    probe = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup.two_tier_lookup(
        probe, cache, lookup.fetch_from_table(remote, "p_partkey"), "l_partkey", "p_partkey"
    ).drop("p_partkey")


_LATEST_JOIN = """
WITH s AS (SELECT CASE WHEN user_id % 10 = 9 THEN NULL ELSE user_id END AS p, event_id % 3 AS side,
                  value AS v, event_id FROM events),
 r AS (SELECT *, row_number() OVER (PARTITION BY p, side ORDER BY event_id DESC) AS rn FROM s),
 a AS (SELECT p, v FROM r WHERE side = 0 AND rn = 1), b AS (SELECT p, v FROM r WHERE side = 1 AND rn = 1),
 c AS (SELECT p, v FROM r WHERE side = 2 AND rn = 1)
SELECT coalesce(a.p, b.p, c.p) AS p, a.v AS va, b.v AS vb, c.v AS vc
FROM a FULL JOIN b ON a.p = b.p FULL JOIN c ON coalesce(a.p, b.p) = c.p"""


def _sides(events: DataFrame) -> dict[str, DataFrame]:
    keyed = events.withColumn("p", F.when(F.col("user_id") % 10 != 9, F.col("user_id")))
    return {
        name: keyed.where(F.col("event_id") % 3 == side).select(
            "p", F.col("event_id").alias("seq"), F.col("value").alias(f"v{name}")
        )
        for side, name in enumerate("abc")
    }


@query("join_full_latest", _LATEST_JOIN)
def join_full_latest(t: Tables) -> DataFrame:
    return latest.full_latest_join(_sides(t.events), "p", "seq")


@query("join_full_latest_stream", _LATEST_JOIN)
def join_full_latest_stream(t: Tables) -> DataFrame:
    stream = stream_table(t.spark, t.file("events"), t.events.schema)
    keyed = latest.full_latest_join(_sides(stream), "p", "seq", flatten=False)
    held = F.coalesce(*[F.when(F.col(name).isNotNull(), F.lit(name)) for name in "abc"])
    log = run_to_end(keyed.select("p", "a", "b", "c", F.when(F.col("p").isNull(), held).alias("side")), "update")
    last = latest.latest_by_key(log, ["p", "side"], ["batch_id"])
    return last.select("p", "a.va", "b.vb", "c.vc")


@query("join_refreshed_stream", """
SELECT event_id, user_id, c_name AS customer FROM events JOIN customer ON c_custkey = user_id * 12""")
def join_refreshed_stream(t: Tables) -> DataFrame:
    """A stream joined with a side that is loaded anew now and then; each micro-batch is tied to the load it saw."""
    path = scratch_path(t.spark, "refreshed")
    side = RefreshedSide(t.spark, lambda: t.customer.select("c_custkey", F.col("c_name").alias("customer")), f"{path}/side", 60)
    schema = t.events.schema

    def build() -> DataFrame:
        return stream_table(t.spark, t.file("events"), schema).select("event_id", "user_id", (F.col("user_id") * 12).alias("_c"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        joined = lookup.lookup_join(batch, side.at(batch_id), "_c", "c_custkey").drop("_c", "c_custkey")
        joined.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")

    View(t.spark, None, build, on_batch, f"{path}/checkpoint").start().wait()
    return t.spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out").drop("batch_id")


_LATEST_JOIN_JSON = """
WITH s AS (SELECT CASE WHEN user_id % 10 = 9 THEN NULL ELSE user_id END AS p, event_id % 3 AS side,
                  event_type AS c, value AS v, event_id FROM events),
 r AS (SELECT *, row_number() OVER (PARTITION BY p, side ORDER BY event_id DESC) AS rn FROM s),
 x AS (SELECT * FROM r WHERE side = 0 AND rn = 1), y AS (SELECT * FROM r WHERE side = 1 AND rn = 1),
 z AS (SELECT * FROM r WHERE side = 2 AND rn = 1)
SELECT coalesce(x.p, y.p, z.p) AS p, x.c AS c1, x.v AS c2, y.c AS c3, y.v AS c4, z.c AS c5, z.v AS c6
FROM x FULL JOIN y ON x.p = y.p FULL JOIN z ON coalesce(x.p, y.p) = z.p"""


def _json_sides(events: DataFrame) -> dict[str, DataFrame]:
    """Three sides of raw JSON texts, together all events; keys and values are read from the texts."""
    key = F.when(F.col("user_id") % 10 != 9, F.col("user_id")).alias("p")
    sides = {}
    for side, name in enumerate("abc"):
        first, second = f"c{2 * side + 1}", f"c{2 * side + 2}"
        fields = key, F.col("event_type").alias(first), F.col("value").alias(second)
        raw = events.where(F.col("event_id") % 3 == side).select(F.col("event_id").alias("seq"), json_encode(*fields).alias("raw"))
        sides[name] = raw.select(json_path("raw", "p", "bigint").alias("p"), "seq", json_path("raw", first).alias(first),
                                 json_path("raw", second, "double").alias(second))
    return sides


@query("join_full_latest_json", _LATEST_JOIN_JSON)
def join_full_latest_json(t: Tables) -> DataFrame:
    return latest.full_latest_join(_json_sides(t.events), "p", "seq")


@query("join_full_latest_json_stream", _LATEST_JOIN_JSON)
def join_full_latest_json_stream(t: Tables) -> DataFrame:
    stream = stream_table(t.spark, t.file("events"), t.events.schema)
    keyed = latest.full_latest_join(_json_sides(stream), "p", "seq", flatten=False)
    held = F.coalesce(*[F.when(F.col(name).isNotNull(), F.lit(name)) for name in "abc"])
    log = run_to_end(keyed.select("p", "a", "b", "c", F.when(F.col("p").isNull(), held).alias("side")), "update")
    last = latest.latest_by_key(log, ["p", "side"], ["batch_id"])
    return last.select("p", "a.*", "b.*", "c.*")


@query("merge_columns", """
WITH r AS (SELECT user_id AS p, event_id % 3 AS side, event_type AS c, value AS v,
  row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) AS rn FROM events)
SELECT p, max(c) FILTER (side = 0) AS c1, max(v) FILTER (side = 0) AS c2, max(c) FILTER (side = 1) AS c3,
  max(v) FILTER (side = 1) AS c4, max(c) FILTER (side = 2) AS c5, max(v) FILTER (side = 2) AS c6
FROM r WHERE rn = 1 GROUP BY p""")
def merge_columns(t: Tables) -> DataFrame:
    side = F.col("event_id") % 3
    wide = t.events.select(
        F.col("user_id").alias("p"), F.col("event_id").alias("seq"),
        *[F.when(side == i // 2, F.col(c)).alias(f"c{i + 1}")
          for i, c in enumerate(["event_type", "value"] * 3)],
    )
    return latest.merge_columns(wide, ["p"], "seq", [f"c{i}" for i in range(1, 7)])
