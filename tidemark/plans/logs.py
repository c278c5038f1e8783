"""Log lines rendered from ``events``, the input of the log reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# One expression for Spark and for the reference SQL; a record starts with its time and thread.
BODY = """
CASE event_type
WHEN 'view' THEN '<Information> client.data-' || (user_id % 5) ||
  ' connections=' || (user_id % 7) || ' failed_connections=' || (user_id % 3) ||
  ' total_failed_read=0 total_dropped_responses=1 total_send_requests=' || event_id ||
  ' total_failed_send_requests=2 total_enqueued_bytes=3 total_send_bytes=' || (event_id * 11) ||
  ' total_failed_send_bytes=4 total_receive_responses=5 total_receive_bytes=6' ||
  ' send_requests/s=' || (event_id % 50) || ' send_bytes/s=' || (event_id * 37 % 1000) ||
  ' receive_responses/s=7 receive_bytes/s=8'
WHEN 'click' THEN '<Information> db.stream' || (user_id % 4) ||
  ': Backpressure peer node=0x' || (1 + user_id % 3)
WHEN 'error' THEN '<Error> client.d-' || (user_id % 6) || ': failed error=' ||
  CASE event_id % 4 WHEN 0 THEN 'ECANCELED' WHEN 1 THEN 'EPIPE' WHEN 2 THEN 'EBADF' ELSE 'ECANCELED' END
WHEN 'purchase' THEN '<Information> tcp-server-' || (user_id % 3) ||
  ': current_connections=' || (user_id % 9) || ' total_connections=10 total_receive_requests=' || event_id ||
  ' total_receive_bytes=12 total_send_responses=13 total_enqueued_bytes=14 total_send_bytes=15' ||
  ' receive_requests/s=' || (event_id % 40) || ' receive_bytes/s=' || (event_id * 29 % 900) ||
  ' send_responses/s=16 send_bytes/s=17 unauthenticated_connections=0'
WHEN 'signup' THEN CASE event_id % 2
  WHEN 0 THEN '<Warning> raft: Raft recv queue is full shard=' || (user_id % 8)
  ELSE '<Information> db.stream' || (user_id % 4) || '.' || (event_id % 3) ||
    '.r: became leader epoch=' || (event_id - event_id % 100) END
END
"""
_RECORD = "{time} || ' [ ' || user_id || ' ] {{q' || event_id || '}} ' || " + f"({BODY})"
SPARK_RECORD = _RECORD.format(time="date_format(ts, 'yyyy.MM.dd HH:mm:ss.SSSSSS')")
ORACLE_RECORD = _RECORD.format(time="strftime(ts, '%Y.%m.%d %H:%M:%S.%f')")

ORACLE_LOGS = f"""logs AS (
  SELECT event_id AS seq, ts AS event_time, '0x' || (1 + user_id % 3) AS node, {ORACLE_RECORD} AS raw,
         CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Other' END AS kind
  FROM events)"""


def log_rows(events: DataFrame) -> DataFrame:
    """Rows (seq, node, raw): one log record per event."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.expr("'0x' || (1 + user_id % 3)").alias("node"),
        F.expr(SPARK_RECORD).alias("raw"),
    )
