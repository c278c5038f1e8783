"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sinks import custom, files, messages
from tidemark.sources.files import open_path
from tidemark.streaming.views import snapshot_into


@query("sink_append", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def sink_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "append")
    bad = F.col("event_type").eqNullSafe("error")
    t.events.where(bad).write.mode("append").parquet(path)
    t.events.where(~bad).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("sink_json_rows", """
SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
       AS value FROM events""")
def sink_json_rows(t: Tables) -> DataFrame:
    return messages.json_rows(t.events.select("event_id", "user_id", "event_type"))


@query("sink_message_frame", """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS value,
       'events' AS source, true AS placed FROM events""")
def sink_message_frame(t: Tables) -> DataFrame:
    frame = messages.message_frame(
        t.events.select("event_id", "user_id"), "user_id", {"source": "events"}, partitions=8
    )
    return frame.select(
        "key", "value",
        F.col("headers")[0]["value"].cast("string").alias("source"),
        F.col("partition").between(0, 7).alias("placed"),
    )


@query("sink_python", "SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events")
def sink_python(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "python-sink")

    def write(folder: str, columns) -> None:
        import json
        import uuid

        system, inner = open_path(folder)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{uuid.uuid4().hex}.json") as file:
            file.write("\n".join(json.dumps({"event_id": v}) for v in columns["event_id"]).encode())

    sink = custom.SinkFunctions(write=write, init=lambda config: config["folder"], batch_rows=5000)
    custom.register_sink(t.spark, "tidemark_json_files", sink)
    events = t.events.select("event_id")
    events.write.format("tidemark_json_files").option("config", f'{{"folder": "{path}"}}').mode("append").save()
    written = t.spark.read.schema("event_id BIGINT").json(path)
    return written.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("sink_rest_body", """
SELECT event_id // 1000 AS batch,
       '{"columns":["event_id","event_type"],"data":[' ||
       string_agg('["' || event_id || '","' || event_type || '"]', ',' ORDER BY event_id) || ']}' AS body
FROM events GROUP BY 1""")
def sink_rest_body(t: Tables) -> DataFrame:
    return messages.rest_bodies(
        t.events, F.expr("event_id div 1000"), "event_id", ["event_id", "event_type"]
    )


@query("sink_sql_insert", """
SELECT 'INSERT INTO orders (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate) VALUES (' ||
       o_orderkey || ', ' || o_custkey || ', ''' || o_orderstatus || ''', ' || o_totalprice || ', ''' ||
       o_orderdate || ''');' AS statement
FROM orders""")
def sink_sql_insert(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return files.sql_inserts(rows, "orders")


@query("sink_split", "SELECT count(*) AS n, true AS split FROM lineitem")
def sink_split(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "split")
    files.write_csv(t.lineitem.select("l_orderkey", "l_linenumber"), path, rows_per_file=2500)
    written = t.spark.read.schema("l_orderkey BIGINT, l_linenumber INT").csv(path)
    per_file = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n"), (F.max("n") <= 2500).alias("split"))


@query("sink_copy", "SELECT count(*) AS source_rows, count(*) AS copy_rows, true AS same FROM orders")
def sink_copy(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "copy")
    files.write_parquet(t.orders, path)
    return files.reconcile(t.orders, t.spark.read.parquet(path))


@query("snapshot_append", """
SELECT a.as_of, r.r_name, count(*) AS suppliers, round(avg(s.s_acctbal) / 10, 1) AS balance
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
CROSS JOIN (VALUES ('2024-01-01T00-00-00'), ('2024-01-01T00-00-05')) a(as_of)
GROUP BY a.as_of, r.r_name""")
def snapshot_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "snapshots")
    now = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.count("*").alias("suppliers"), F.round(F.avg("s_acctbal") / 10, 1).alias("balance"))
    )
    # the second run of the first moment replaces it
    for moment in ("2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:05"):
        snapshot_into(now, path, moment)
    schema = "r_name STRING, suppliers BIGINT, balance DOUBLE, as_of STRING"
    return t.spark.read.schema(schema).parquet(path)
