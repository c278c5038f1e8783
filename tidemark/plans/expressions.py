"""Projections, filters, scalar functions, JSON, NULL arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import json as J, scalars as S
from tidemark.operators.rename import rename_chain
from tidemark.plans.logs import ORACLE_LOGS, log_rows
from tidemark.plans.registry import Tables, query


@query("proj_basic", "SELECT event_id AS id, event_type AS kind, value FROM events")
def proj_basic(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")


@query("proj_except", "SELECT * EXCLUDE (props, ts) FROM events")
def proj_except(t: Tables) -> DataFrame:
    return t.events.drop("props", "ts")


@query("proj_cast", """
SELECT event_id, CAST(value AS FLOAT) AS value_f, CAST(event_id AS VARCHAR) AS id_text,
       TRY_CAST(event_type AS INTEGER) AS bad, CAST(ts AS DATE) AS day FROM events""")
def proj_cast(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.col("value").cast("float").alias("value_f"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("event_type").try_cast("int").alias("bad"),
        F.col("ts").cast("date").alias("day"),
    )


@query("proj_defaults", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS kind,
       'otel_trace' AS sourcetype FROM events""")
def proj_defaults(t: Tables) -> DataFrame:
    partial = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return S.with_defaults(partial, {"kind": F.lit("unknown"), "sourcetype": F.lit("otel_trace")})


@query("proj_alias_reuse", """
SELECT user_id, min(ts) AS start_ts, max(ts) AS end_ts,
       (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS span_ms
FROM events GROUP BY user_id""")
def proj_alias_reuse(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT user_id, min(ts) AS start_ts, max(ts) AS end_ts,
                  timestampdiff(MILLISECOND, start_ts, end_ts) AS span_ms
           FROM {events} GROUP BY user_id""",
        events=t.events,
    )


@query("filter_point", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 1006")
def filter_point(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey = 1006").select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_range", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey BETWEEN 100 AND 200 AND o_orderstatus <> 'F'""")
def filter_range(t: Tables) -> DataFrame:
    kept = F.col("o_custkey").between(100, 200) & (F.col("o_orderstatus") != "F")
    return t.orders.where(kept).select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%'")
def filter_like(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("%red%")).select("p_partkey", "p_name")


@query("filter_position", f"""
WITH {ORACLE_LOGS} SELECT seq, node FROM logs WHERE instr(raw, 'Backpressure peer node') > 0""")
def filter_position(t: Tables) -> DataFrame:
    return log_rows(t.events).where(S.contains_text("raw", "Backpressure peer node")).select("seq", "node")


@query("filter_in_param", "SELECT event_id, user_id FROM events WHERE user_id IN (1, 2, 3)")
def filter_in_param(t: Tables) -> DataFrame:
    ids = [1, 2, 3]
    return t.events.where(F.col("user_id").isin(ids)).select("event_id", "user_id")


@query("filter_lookback", """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR AND ts > TIMESTAMP '2024-01-02 00:00:00'""")
def filter_lookback(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    since = F.lit("2024-01-02").cast("timestamp_ntz")
    recent = F.col("ts") >= as_of - F.expr("INTERVAL 36 HOURS")
    return t.events.where(recent & (F.col("ts") > since)).select("event_id", "ts")


@query("param_query", "SELECT event_type AS picked, count(*) AS n FROM events WHERE value >= 20 GROUP BY 1")
def param_query(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT IDENTIFIER(:col) AS picked, count(*) AS n FROM {source} "
        "WHERE value >= :low GROUP BY IDENTIFIER(:col)",
        args={"col": "event_type", "low": 20.0},
        source=t.events,
    )


@query("fn_concat_mod", """
SELECT event_id, 'dev_' || CAST(event_id % 1000 AS VARCHAR) AS device FROM events""")
def fn_concat_mod(t: Tables) -> DataFrame:
    device = F.concat(F.lit("dev_"), F.pmod("event_id", F.lit(1000)).cast("string"))
    return t.events.select("event_id", device.alias("device"))


@query("fn_to_number", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       TRY_CAST(event_type AS BIGINT) AS bad FROM events""")
def fn_to_number(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        S.to_number(J.json_path("props", "k")).alias("k"),
        S.to_number("event_type").alias("bad"),
    )


@query("fn_extract", f"""
WITH {ORACLE_LOGS} SELECT seq, regexp_extract(raw, 'shard=(\\d+)', 1) AS shard,
  regexp_extract(raw, 'epoch=(\\d+)', 1) AS epoch FROM logs""")
def fn_extract(t: Tables) -> DataFrame:
    return log_rows(t.events).select(
        "seq", S.extract("raw", r"shard=(\d+)").alias("shard"), S.extract("raw", r"epoch=(\d+)").alias("epoch")
    )


@query("fn_to_time", "SELECT event_id AS seq, ts AS event_time, CAST(NULL AS TIMESTAMP) AS bad FROM events")
def fn_to_time(t: Tables) -> DataFrame:
    return log_rows(t.events).select(
        "seq",
        S.to_time(S.extract("raw", S.LOG_TIME_PATTERN)).alias("event_time"),
        S.to_time(S.extract("raw", "no such text (x)")).alias("bad"),
    )


@query("fn_time_trunc", """
SELECT event_id, date_trunc('hour', ts) AS hour_start, CAST(hour(ts) AS INTEGER) AS hour_no,
       CAST(ts AS DATE) AS day FROM events""")
def fn_time_trunc(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", S.start_of_hour("ts").alias("hour_start"), F.hour("ts").alias("hour_no"),
        F.to_date("ts").alias("day"),
    )


@query("fn_interval", """
SELECT event_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS warm_at, ts - INTERVAL 5 MINUTE AS since
FROM events""")
def fn_interval(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        (S.start_of_hour("ts") + F.expr("INTERVAL 1 HOUR")).alias("warm_at"),
        (F.col("ts") - F.expr("INTERVAL 5 MINUTES")).alias("since"),
    )


@query("fn_date_diff_ms", """
SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000 AS ms FROM events""")
def fn_date_diff_ms(t: Tables) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return t.events.select("event_id", S.date_diff_ms(start, F.col("ts")).alias("ms"))


_PAIRS = "'{\"key1\":\"' || event_type || '\",\"key2\":' || event_id || '}'"
_RAW_PAIRS = "'{\"key1\":\"' || event_type || '\", \"key2\" : ' || event_id || '.50, \"key3\": {\"a\": [1e2, ' || user_id || ']}}'"


@query("json_pairs_raw", """
SELECT event_id, 'key1' AS key, '"' || event_type || '"' AS raw FROM events
UNION ALL SELECT event_id, 'key2', event_id || '.50' FROM events
UNION ALL SELECT event_id, 'key3', '{"a": [1e2, ' || user_id || ']}' FROM events""")
def json_pairs_raw(t: Tables) -> DataFrame:
    pairs = t.events.select("event_id", F.explode(J.json_pairs_raw(F.expr(_RAW_PAIRS))).alias("p"))
    return pairs.select("event_id", "p.key", "p.raw")


@query("json_to_map", """
SELECT event_id, event_type AS key1, CAST(event_id AS VARCHAR) AS key2 FROM events""")
def json_to_map(t: Tables) -> DataFrame:
    mapped = t.events.select("event_id", J.json_to_map(F.expr(_PAIRS)).alias("m"))
    return mapped.select("event_id", F.col("m")["key1"].alias("key1"), F.col("m")["key2"].alias("key2"))


@query("json_path", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS FLOAT) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""")
def json_path(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", J.json_path("props", "k", "float").alias("k"),
        J.json_path("props", "missing").alias("missing"),
    )


@query("json_encode", """
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","parent":null}' AS event
FROM events""")
def json_encode(t: Tables) -> DataFrame:
    parent = F.lit(None).cast("string").alias("parent")
    return t.events.select(J.json_encode("event_id", "event_type", parent).alias("event"))


@query("fn_array_concat", """
SELECT event_id, event_type || '>' || user_id AS joined, 2 AS size, length(event_type) = 0 AS no_text
FROM events""")
def fn_array_concat(t: Tables) -> DataFrame:
    both = F.concat(F.array("event_type"), F.array(F.col("user_id").cast("string")))
    return t.events.select("event_id", both.alias("both"), "event_type").select(
        "event_id", F.array_join("both", ">").alias("joined"), F.size("both").alias("size"),
        (F.length("event_type") == 0).alias("no_text"),
    )


@query("fn_map_literal", "SELECT event_id, 'smoke_test' AS test_id, '1' AS idx, 3 AS third FROM events")
def fn_map_literal(t: Tables) -> DataFrame:
    headers = S.map_literal({"test_id": "smoke_test", "idx": "1"})
    return t.events.select(
        "event_id", headers["test_id"].alias("test_id"), headers["idx"].alias("idx"),
        F.array(F.lit(1), F.lit(2), F.lit(3))[2].alias("third"),
    )


@query("fn_readable_size", """
SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.2f B', round(b, 2))
  WHEN b < 1048576 THEN printf('%.2f KiB', round(b / 1024.0::DOUBLE, 2))
  WHEN b < 1073741824 THEN printf('%.2f MiB', round(b / 1048576.0::DOUBLE, 2))
  WHEN b < 1099511627776 THEN printf('%.2f GiB', round(b / 1073741824.0::DOUBLE, 2))
  ELSE printf('%.2f TiB', round(b / 1099511627776.0::DOUBLE, 2)) END AS size
FROM (SELECT o_orderkey, CAST(o_orderkey * o_orderkey * o_custkey AS DOUBLE) AS b FROM orders)""")
def fn_readable_size(t: Tables) -> DataFrame:
    size = S.product_as_double("o_orderkey", "o_orderkey", "o_custkey")
    return t.orders.select("o_orderkey", S.readable_size(size).alias("size"))


@query("fn_shard_of", """
SELECT user_id, count(*) AS n, 1 AS shards, true AS in_range FROM events GROUP BY user_id""")
def fn_shard_of(t: Tables) -> DataFrame:
    placed = t.events.select("user_id", S.shard_of("user_id", 8).alias("shard"))
    first, last = F.min("shard"), F.max("shard")
    return placed.groupBy("user_id").agg(
        F.count("*").alias("n"), (last - first + 1).cast("int").alias("shards"),
        ((first >= 0) & (last < 8)).alias("in_range"),
    )


@query("fn_job_label", "SELECT 'job_7' AS node, event_id FROM events")
def fn_job_label(t: Tables) -> DataFrame:
    return t.events.select(S.job_label("job_7").alias("node"), "event_id")


def _operands(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("a"),
        F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("b"),
        F.when(F.col("event_id") % 2 != 0, F.lit(40).cast("bigint")).alias("c"),
    )


_OPERANDS = """WITH o AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_id END AS a,
  CASE WHEN event_id % 5 <> 0 THEN user_id END AS b,
  CASE WHEN event_id % 2 <> 0 THEN CAST(40 AS BIGINT) END AS c FROM events)"""


@query("udf_null_arith", _OPERANDS + """
SELECT event_id,
  CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE coalesce(a, 0) + coalesce(b, 0) END AS plus,
  CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE coalesce(a, 0) - coalesce(b, 0) END AS minus FROM o""")
def udf_null_arith(t: Tables) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _operands(t).select(
        "event_id", S.null_plus(a, b).alias("plus"), S.null_minus(a, b).alias("minus")
    )


@query("udf_null_extrema", _OPERANDS + """
SELECT event_id, CAST(least(a, b) AS DOUBLE) AS low2, CAST(greatest(a, b) AS DOUBLE) AS high2,
  CAST(least(a, b, c) AS DOUBLE) AS low3, CAST(greatest(a, b, c) AS DOUBLE) AS high3 FROM o""")
def udf_null_extrema(t: Tables) -> DataFrame:
    S.register_sql_functions(t.spark)
    return _operands(t).selectExpr(
        "event_id", "null_least(a, b) AS low2", "null_greatest(a, b) AS high2",
        "null_least3(a, b, c) AS low3", "null_greatest3(a, b, c) AS high3",
    )


@query("udf_nullable_add", _OPERANDS + """
SELECT event_id, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a + b END AS total FROM o""")
def udf_nullable_add(t: Tables) -> DataFrame:
    return _operands(t).select("event_id", S.nullable_add(F.col("a"), F.col("b")).alias("total"))


@query("rename_chain", """
WITH RECURSIVE changes AS (
  SELECT 'f' || o_custkey AS path,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'f' || (o_orderkey % 1500) END AS old_path,
         o_orderdate AS t FROM orders WHERE o_orderpriority <> '1-URGENT'),
edges AS (SELECT path, old_path FROM
  (SELECT *, row_number() OVER (PARTITION BY path ORDER BY t, old_path) AS rn FROM changes)
  WHERE rn = 1 AND old_path <> ''),
chain AS (
  SELECT 'f' || c_custkey AS path, 'f' || c_custkey AS at_name, 'f' || c_custkey AS history, 1 AS n FROM customer
  UNION ALL
  SELECT c.path, e.old_path, c.history || '<' || e.old_path, c.n + 1
  FROM chain c JOIN edges e ON c.at_name = e.path WHERE c.n < 6)
SELECT path, arg_max(history, n) AS history, CAST(max(n) AS INTEGER) AS names FROM chain GROUP BY path""")
def rename_history(t: Tables) -> DataFrame:
    old = F.concat(F.lit("f"), F.col("o_orderkey") % 1500)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changes = t.orders.select(
        F.concat(F.lit("f"), "o_custkey").alias("path"),
        F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(old).alias("old_path"),
        F.when(urgent, "Modify").otherwise("Rename").alias("change_type"),
        F.col("o_orderdate").alias("time"),
    )
    names = t.customer.select(F.concat(F.lit("f"), "c_custkey").alias("path"))
    return rename_chain(names, changes).select(
        "path", F.array_join("history", "<").alias("history"), F.size("history").alias("names")
    )
