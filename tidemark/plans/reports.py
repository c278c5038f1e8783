"""Operational reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import reports as R
from tidemark.operators.retention import tier_of_age, write_layout
from tidemark.plans.keyed import AGE_RULES
from tidemark.plans.logs import ORACLE_LOGS, log_rows
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.sources.files import footer_report
from tidemark.sources.logs import with_log_columns

# The correctness check runs on this folder; the sizes are read from the footers of its files.
_FOOTERS = """(SELECT regexp_extract(file_name, '([^/]+)\\.parquet$', 1) AS "table",
  replace(path_in_schema, ', ', '.') AS "column", total_compressed_size AS c, total_uncompressed_size AS u
  FROM parquet_metadata('/root/testdata/sf0.01/*.parquet'))"""


def _size(expr: str) -> str:
    return (f"CASE WHEN {expr} < 1024 THEN printf('%.2f B', {expr}::DOUBLE) "
            f"WHEN {expr} < 1048576 THEN printf('%.2f KiB', round({expr} / 1024::DOUBLE, 2)) "
            f"ELSE printf('%.2f MiB', round({expr} / 1048576::DOUBLE, 2)) END")


def _logs(t: Tables) -> DataFrame:
    return with_log_columns(log_rows(t.events))


@query("rep_compression_table", f"""
SELECT "table", {_size('sum(c)')} AS compressed, {_size('sum(u)')} AS uncompressed,
       round(sum(u)::DOUBLE / sum(c)::DOUBLE, 2) AS ratio FROM {_FOOTERS} GROUP BY 1""")
def rep_compression_table(t: Tables) -> DataFrame:
    return R.compression(footer_report(t.spark, f"{t.path}/*.parquet"), ["table"])


@query("rep_compression_column", f"""
SELECT "table", "column", {_size('sum(c)')} AS compressed, {_size('sum(u)')} AS uncompressed,
       round(sum(u)::DOUBLE / sum(c)::DOUBLE, 2) AS ratio FROM {_FOOTERS} GROUP BY 1, 2""")
def rep_compression_column(t: Tables) -> DataFrame:
    return R.compression(footer_report(t.spark, f"{t.path}/*.parquet"), ["table", "column"])


def _by_day(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parts")
    daily = t.events.select("event_id", "value", F.to_date("ts").alias("day"))
    write_layout(daily, path, ["day"], ["event_id"])
    return t.spark.read.parquet(path)


@query("rep_parts", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS "partition", count(*) AS "rows", true AS has_parts
FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def rep_parts(t: Tables) -> DataFrame:
    report = R.parts_per_partition(_by_day(t), "day", order="rows")
    return report.select("partition", "rows", (F.col("parts") >= 1).alias("has_parts"))


@query("rep_tier_sizes", """
SELECT CASE WHEN CAST(ts AS DATE) + INTERVAL 7 DAY <= TIMESTAMP '2024-01-31' THEN 'cold'
  WHEN CAST(ts AS DATE) + INTERVAL 3 DAY <= TIMESTAMP '2024-01-31' THEN 'warm' ELSE 'hot' END AS tier,
  count(*) AS "rows", true AS has_parts FROM events GROUP BY 1""")
def rep_tier_sizes(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    tier = tier_of_age(F.col("day").cast("timestamp_ntz"), as_of, AGE_RULES)
    report = R.tier_sizes(_by_day(t), "day", tier)
    return report.select("tier", "rows", (F.col("parts") >= 1).alias("has_parts"))


@query("rep_socket_p90", f"""
WITH {ORACLE_LOGS}, m AS (SELECT regexp_extract(raw, ' (client.\\w+-\\d+)', 1) AS client,
  CAST(regexp_extract(raw, 'send_bytes/s=(\\d+)', 1) AS BIGINT) AS b,
  CAST(regexp_extract(raw, 'send_requests/s=(\\d+)', 1) AS BIGINT) AS r
  FROM logs WHERE instr(raw, 'total_send_requests=') > 0)
SELECT client, CAST(floor(round(quantile_cont(b, 0.9), 6)) AS BIGINT) AS send_bytes_s_p90,
       CAST(floor(round(quantile_cont(r, 0.9), 6)) AS BIGINT) AS send_requests_s_p90 FROM m GROUP BY client""")
def rep_socket_p90(t: Tables) -> DataFrame:
    return R.peer_p90(R.client_metrics(_logs(t)), "client", ["send_bytes_s", "send_requests_s"])


@query("rep_server_p90", f"""
WITH {ORACLE_LOGS}, m AS (SELECT regexp_extract(raw, '(\\w+-server-*\\d*):', 1) AS server,
  CAST(regexp_extract(raw, 'receive_bytes/s=(\\d+)', 1) AS BIGINT) AS b,
  CAST(regexp_extract(raw, 'receive_requests/s=(\\d+)', 1) AS BIGINT) AS r
  FROM logs WHERE instr(raw, 'unauthenticated_connections=') > 0)
SELECT server, CAST(floor(round(quantile_cont(b, 0.9), 6)) AS BIGINT) AS receive_bytes_s_p90,
       CAST(floor(round(quantile_cont(r, 0.9), 6)) AS BIGINT) AS receive_requests_s_p90 FROM m GROUP BY server""")
def rep_server_p90(t: Tables) -> DataFrame:
    return R.peer_p90(R.server_metrics(_logs(t)), "server", ["receive_bytes_s", "receive_requests_s"])


_BACKPRESSURE = f"""
WITH {ORACLE_LOGS}, b AS (SELECT node, regexp_extract(raw, '> (\\w+\\..*): Backpressure peer node', 1) AS stream,
  regexp_extract(raw, ': Backpressure peer node=(0x\\d+)', 1) AS peer_node, event_time
  FROM logs WHERE instr(raw, 'Backpressure peer node') > 0)"""


@query("rep_backpressure", f"""
{_BACKPRESSURE} SELECT node, stream, peer_node, min(event_time) AS min_ts, max(event_time) AS max_ts,
  count(*) AS count FROM b GROUP BY node, stream, peer_node""")
def rep_backpressure(t: Tables) -> DataFrame:
    return R.backpressure(_logs(t)).orderBy("node", "count")


@query("rep_backpressure_total", f"""
{_BACKPRESSURE} SELECT node, peer_node, count(*) AS count FROM b GROUP BY node, peer_node""")
def rep_backpressure_total(t: Tables) -> DataFrame:
    return R.backpressure_total(_logs(t)).orderBy("node", "peer_node")


@query("rep_queue_full", f"""
WITH {ORACLE_LOGS} SELECT regexp_extract(raw, 'shard=(\\d+)', 1) AS shard, count(*) AS n
FROM logs WHERE instr(raw, 'Raft recv queue is full') > 0 GROUP BY 1""")
def rep_queue_full(t: Tables) -> DataFrame:
    return R.queue_full(_logs(t))


@query("rep_leader_distribution", f"""
WITH {ORACLE_LOGS}, e AS (SELECT node, seq, regexp_extract(raw, '> (.*.r):', 1) AS stream_shard,
  CAST(regexp_extract(raw, 'epoch=(\\d+)', 1) AS BIGINT) AS epoch
  FROM logs WHERE instr(raw, 'became leader') > 0 AND event_time > TIMESTAMP '2024-01-05 03:22:00'),
p AS (SELECT stream_shard, node, arg_max(epoch, seq) AS latest_epoch FROM e GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY stream_shard ORDER BY latest_epoch DESC, node DESC) AS rn FROM p)
SELECT node, count(*) AS leader_count FROM o WHERE rn = 1 GROUP BY node""")
def rep_leader_distribution(t: Tables) -> DataFrame:
    return R.leader_distribution(_logs(t), F.lit("2024-01-05 03:22:00").cast("timestamp_ntz"))


@query("rep_error_windows", f"""
WITH {ORACLE_LOGS} SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, count(*) AS network_errors
FROM logs WHERE kind = 'Error' AND raw LIKE '% client.d%' AND event_time >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY
GROUP BY 1""")
def rep_error_windows(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    return R.error_windows(_logs(t), as_of, "7 DAYS", "1 hour")


@query("agg_token_freq", f"""
WITH {ORACLE_LOGS} SELECT regexp_extract(raw, 'error=(\\w+)', 1) AS token, count(*) AS n
FROM logs WHERE instr(raw, '<Error> client') > 0 GROUP BY 1""")
def agg_token_freq(t: Tables) -> DataFrame:
    return R.token_frequency(_logs(t))
