"""Sources, formats and generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.plans.logs import ORACLE_RECORD, SPARK_RECORD
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sinks import files as out
from tidemark.sources import files, kafka, logs
from tidemark.sources.tail import log_tail
from tidemark.streaming.views import View, run_to_end, stream_table

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
PLAIN_EVENTS = f"SELECT {', '.join(EVENT_COLUMNS)} FROM events"


@query("src_message_meta", """
SELECT CAST(event_id AS VARCHAR) AS message_key, event_type AS header_type,
       CAST(user_id AS VARCHAR) AS header_user, ts AS event_time,
       CAST(user_id % 8 AS INTEGER) AS shard, props AS raw
FROM events""")
def src_message_meta(t: Tables) -> DataFrame:
    def header(name: str, column: str):
        return F.struct(F.lit(name).alias("key"), F.col(column).cast("string").cast("binary").alias("value"))

    messages = t.events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.array(header("type", "event_type"), header("user", "user_id")).alias("headers"),
        F.col("ts").alias("timestamp"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
    )
    return kafka.message_meta(messages).select(
        "message_key",
        F.col("message_headers")["type"].alias("header_type"),
        F.col("message_headers")["user"].alias("header_user"),
        "event_time", "shard", F.col("value").cast("string").alias("raw"),
    )


@query("src_shard_subset", """
SELECT 'job' || ((user_id % 64) // 16) AS job, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY 1""")
def src_shard_subset(t: Tables) -> DataFrame:
    jobs = {
        f"job{i}": kafka.shard_subset(t.events, "user_id", 64, kafka.parse_partitions(f"{16 * i}..{16 * i + 15}"))
        .select("event_id")
        for i in range(4)
    }
    return files.union_tagged(jobs, "job").groupBy("job").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query("src_log_records", f"""
WITH logs AS (SELECT ts, event_type, {ORACLE_RECORD} AS raw FROM events)
SELECT ts AS event_time, regexp_extract(raw, '\\}} <(\\w+)>', 1) AS level,
       regexp_extract(raw, '\\}} <\\w+> (.*)', 1) ||
       CASE WHEN event_type = 'error' THEN chr(10) || '  at frame 1' || chr(10) || '  at frame 2' ELSE '' END
       AS message
FROM logs""")
def src_log_records(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "logs")
    trace = F.when(F.col("event_type") == "error", "\n  at frame 1\n  at frame 2").otherwise("")
    t.events.select(F.concat(F.expr(SPARK_RECORD), trace)).write.text(path)
    records = logs.log_records(logs.log_files(t.spark, f"{path}/*.txt"))
    return logs.with_log_columns(records).select("event_time", "level", "message")


@query("src_json_table", PLAIN_EVENTS)
def src_json_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    out.write_ndjson(t.events.select(*EVENT_COLUMNS), path)
    return files.read_ndjson(t.spark, path, EVENT_SCHEMA)


@query("scan_snapshot", PLAIN_EVENTS)
def scan_snapshot(t: Tables) -> DataFrame:
    return t.events.select(*EVENT_COLUMNS)


@query("scan_stream", PLAIN_EVENTS)
def scan_stream(t: Tables) -> DataFrame:
    stream = stream_table(t.spark, t.file("events"), t.events.schema)
    return run_to_end(stream.select(*EVENT_COLUMNS)).drop("batch_id")


@query("scan_time_bound", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00'")
def scan_time_bound(t: Tables) -> DataFrame:
    return t.events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")).select("event_id", "ts")


# the events' own columns and text that delimited files find hard: breaks, quotes, backslashes, empty, NULL
_HARD_SQL = """
SELECT *, CASE event_id % 6 WHEN 0 THEN 'two' || chr(10) || 'lines' WHEN 1 THEN 'a "quote", and a comma' || chr(9)
  WHEN 2 THEN 'back\\n\\slash' || chr(13) WHEN 3 THEN '' WHEN 4 THEN NULL ELSE ' spaces ' END AS note FROM (""" + PLAIN_EVENTS + ")"


def _hard_events(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 6
    note = (F.when(kind == 0, "two\nlines").when(kind == 1, 'a "quote", and a comma\t').when(kind == 2, "back\\n\\slash\r")
            .when(kind == 3, "").when(kind == 5, " spaces "))
    return t.events.select(*EVENT_COLUMNS, note.alias("note"))


def _round_trip_text(t: Tables, sep: str, header: bool, compression: str = "none") -> DataFrame:
    path = scratch_path(t.spark, "text")
    out.write_csv(_hard_events(t), path, header, sep, compression)
    return files.read_csv(t.spark, path, f"{EVENT_SCHEMA}, note STRING", header, sep, escapes=True)


@query("fmt_csv", _HARD_SQL)
def fmt_csv(t: Tables) -> DataFrame:
    return _round_trip_text(t, ",", header=True)


@query("fmt_tsv", _HARD_SQL)
def fmt_tsv(t: Tables) -> DataFrame:
    return _round_trip_text(t, "\t", header=False)


@query("fmt_csv_gzip", _HARD_SQL)
def fmt_csv_gzip(t: Tables) -> DataFrame:
    return _round_trip_text(t, ",", header=False, compression="gzip")


@query("fmt_ndjson", "SELECT event_id, ts, props FROM events")
def fmt_ndjson(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ndjson")
    out.write_ndjson(t.events.select("event_id", "ts", "props"), path, "gzip")
    return files.read_ndjson(t.spark, path, "event_id BIGINT, ts TIMESTAMP_NTZ, props STRING")


@query("fmt_error_budget", """
SELECT count(*) FILTER (event_id % 97 <> 0) AS good, count(*) FILTER (event_id % 97 = 0) AS bad,
       CAST(sum(event_id) FILTER (event_id % 97 <> 0) AS BIGINT) AS good_ids
FROM events""")
def fmt_error_budget(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "broken")
    broken = F.when(F.col("event_id") % 97 == 0, F.lit("not a number,")).otherwise(
        F.concat_ws(",", "event_id", "event_type")
    )
    t.events.select(broken).write.text(path)
    schema = files.with_corrupt(T._parse_datatype_string("event_id BIGINT, event_type STRING"))
    good, bad = files.error_budget(files.read_csv(t.spark, path, schema), ratio=0.05)
    counts = good.agg(F.count("*").alias("good"), F.sum("event_id").alias("good_ids"))
    return counts.withColumn("bad", bad.agg(F.count("*")).scalar()).select("good", "bad", "good_ids")


@query("fmt_import_budget", """
SELECT count(*) FILTER (event_id % 97 <> 0) AS good, count(*) FILTER (event_id % 97 = 0) AS bad,
       CAST(sum(event_id) FILTER (event_id % 97 <> 0) AS BIGINT) AS good_ids
FROM events""")
def fmt_import_budget(t: Tables) -> DataFrame:
    """The same import in one pass: written as it is counted, kept only within the budget."""
    path = scratch_path(t.spark, "import")
    broken = F.when(F.col("event_id") % 97 == 0, F.lit("not a number,")).otherwise(F.concat_ws(",", "event_id", "event_type"))
    t.events.select(broken).write.text(f"{path}/in")
    schema = files.with_corrupt(T._parse_datatype_string("event_id BIGINT, event_type STRING"))
    files.import_within_budget(files.read_csv(t.spark, f"{path}/in", schema), f"{path}/rows", f"{path}/rejects", ratio=0.05)
    good, bad = (t.spark.read.schema(schema).parquet(f"{path}/{name}") for name in ("rows", "rejects"))
    both = good.select("event_id").unionByName(bad.select(F.lit(None).cast("bigint").alias("event_id")))
    return both.agg(F.count("event_id").alias("good"), F.count_if(F.col("event_id").isNull()).alias("bad"),
                    F.sum("event_id").alias("good_ids"))


@query("src_log_tail", f"""
WITH logs AS (SELECT ts, event_type, {ORACLE_RECORD} AS raw FROM events)
SELECT raw FROM logs""")
def src_log_tail(t: Tables) -> DataFrame:
    """Log files read as a stream that is stopped, finds more files when it is started again, and gives each record once."""
    path = scratch_path(t.spark, "tail")
    out_path, checkpoint = f"{path}/out", f"{path}/checkpoint"
    tail = View(t.spark, None, lambda: log_tail(t.spark, f"{path}/logs", "*.txt", idle_seconds=0).select("raw"), out_path, checkpoint)
    lines = t.events.select((F.col("event_id") % 2 == 0).alias("late"), F.expr(SPARK_RECORD).alias("raw"))
    for late in (False, True):
        lines.where(F.col("late") == late).select("raw").write.mode("append").text(f"{path}/logs")
        tail.start().wait()
    return t.spark.read.schema("raw STRING").parquet(out_path)


@query("fmt_parquet_orc", PLAIN_EVENTS)
def fmt_parquet_orc(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "columnar")
    out.write_parquet(t.events.select(*EVENT_COLUMNS), f"{path}/parquet")
    out.write_orc(t.spark.read.parquet(f"{path}/parquet"), f"{path}/orc")
    return t.spark.read.orc(f"{path}/orc")


@query("fmt_arrow", PLAIN_EVENTS)
def fmt_arrow(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "arrow")
    events = t.events.select(*EVENT_COLUMNS)
    files.write_arrow(events, path)
    return files.read_arrow(t.spark, f"{path}/*.arrow", events.schema)


@query("fmt_values", """
SELECT v.label, count(*) AS n FROM events e
JOIN (VALUES ('error', 'bad'), ('view', 'seen'), ('click', 'seen'), ('purchase', 'paid'), ('signup', 'new'))
  v(event_type, label) ON e.event_type = v.event_type
GROUP BY v.label""")
def fmt_values(t: Tables) -> DataFrame:
    labels = files.read_values(
        t.spark, "event_type, label",
        "('error', 'bad'), ('view', 'seen'), ('click', 'seen'), ('purchase', 'paid'), ('signup', 'new')",
    )
    return t.events.join(labels, "event_type").groupBy("label").agg(F.count("*").alias("n"))


@query("fmt_lines", "SELECT props AS raw FROM events")
def fmt_lines(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    t.events.select("props").write.text(path)
    return files.read_lines(t.spark, path)


@query("json_variant", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_variant(t: Tables) -> DataFrame:
    document = F.try_parse_json("props")
    return t.events.select("event_id", F.try_variant_get(document, "$.k", "int").alias("k"))
