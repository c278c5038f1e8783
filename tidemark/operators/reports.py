"""Operational reports over log rows (``node``, ``raw``, ``event_time``, ``seq``) and file footers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import contains_text, extract, ratio, readable_size, to_number
from tidemark.operators.aggregates import exact_percentile, latest
from tidemark.operators.emit import tick_of

# Counters found in client and server metric lines.
CLIENT_NAME = r" (client.\w+-\d+)"
CLIENT_COUNTERS = (
    "connections", "failed_connections", "total_failed_read", "total_dropped_responses",
    "total_send_requests", "total_failed_send_requests", "total_enqueued_bytes", "total_send_bytes",
    "total_failed_send_bytes", "total_receive_responses", "total_receive_bytes", "send_requests/s",
    "send_bytes/s", "receive_responses/s", "receive_bytes/s",
)
SERVER_NAME = r"(\w+-server-*\d*):"
SERVER_COUNTERS = (
    "current_connections", "total_connections", "total_receive_requests", "total_receive_bytes",
    "total_send_responses", "total_enqueued_bytes", "total_send_bytes", "receive_requests/s",
    "receive_bytes/s", "send_responses/s", "send_bytes/s",
)
BACKPRESSURE = "Backpressure peer node"
BACKPRESSURE_STREAM = r"> (\w+\..*): Backpressure peer node"
BACKPRESSURE_PEER = r": Backpressure peer node=(0x\d+)"


def counter_name(counter: str) -> str:
    return counter.replace("/s", "_s")


def counters(logs: DataFrame, name: str, pattern: str, names: tuple[str, ...], marker: str) -> DataFrame:
    """Metric lines as typed columns, one per counter."""
    found = logs.where(contains_text("raw", marker))
    values = {counter_name(c): to_number(extract("raw", rf"{c}=(\d+)")) for c in names}
    return found.select(extract("raw", pattern).alias(name), *[v.alias(n) for n, v in values.items()])


def client_metrics(logs: DataFrame) -> DataFrame:
    return counters(logs, "client", CLIENT_NAME, CLIENT_COUNTERS, "total_send_requests=")


def server_metrics(logs: DataFrame) -> DataFrame:
    return counters(logs, "server", SERVER_NAME, SERVER_COUNTERS, "unauthenticated_connections=")


def peer_p90(metrics: DataFrame, peer: str, columns: list[str]) -> DataFrame:
    """Whole-number 90th percentiles per peer, sorted by them."""
    p90 = exact_percentile(metrics, [peer], {f"{c}_p90": c for c in columns})
    whole = [F.floor(F.round(f"{c}_p90", 6)).alias(f"{c}_p90") for c in columns]
    return p90.select(peer, *whole).orderBy(*[f"{c}_p90" for c in columns])


def backpressure(logs: DataFrame, marker: str = BACKPRESSURE) -> DataFrame:
    """First and last time and number of hits per node, stream and peer."""
    return (
        logs.where(contains_text("raw", marker))
        .groupBy(
            "node",
            extract("raw", BACKPRESSURE_STREAM).alias("stream"),
            extract("raw", BACKPRESSURE_PEER).alias("peer_node"),
        )
        .agg(F.min("event_time").alias("min_ts"), F.max("event_time").alias("max_ts"),
             F.count("*").alias("count"))
    )


def backpressure_total(logs: DataFrame, marker: str = BACKPRESSURE) -> DataFrame:
    return backpressure(logs, marker).groupBy("node", "peer_node").agg(F.sum("count").alias("count"))


def queue_full(logs: DataFrame) -> DataFrame:
    full = logs.where(contains_text("raw", "Raft recv queue is full"))
    return full.groupBy(extract("raw", r"shard=(\d+)").alias("shard")).agg(F.count("*").alias("n"))


def leader_distribution(logs: DataFrame, since: Column) -> DataFrame:
    """Shards owned per node: latest epoch per node and shard, then the newest owner of a shard."""
    elected = logs.where(contains_text("raw", "became leader") & (F.col("event_time") > since)).select(
        "node", "event_time", "seq",
        extract("raw", r"> (.*.r):").alias("stream_shard"),
        to_number(extract("raw", r"epoch=(\d+)")).alias("epoch"),
    )
    per_node = elected.groupBy("stream_shard", "node").agg(
        latest("epoch", "event_time", "seq").alias("latest_epoch")
    )
    owners = per_node.groupBy("stream_shard").agg(latest("node", "latest_epoch", "node").alias("node"))
    return owners.groupBy("node").agg(F.count("*").alias("leader_count"))


def error_windows(
    logs: DataFrame, as_of: Column, lookback: str = "5 MINUTES", window: str = "5 seconds"
) -> DataFrame:
    recent = F.col("event_time") >= as_of - F.expr(f"INTERVAL {lookback}")
    errors = logs.where((F.col("level") == "Error") & F.col("raw").like("% client.d%") & recent)
    return errors.groupBy(tick_of("event_time", window).alias("window_start")).agg(
        F.count("*").alias("network_errors")
    )


def token_frequency(logs: DataFrame, marker: str = "<Error> client", pattern: str = r"error=(\w+)") -> DataFrame:
    tokens = logs.where(contains_text("raw", marker)).select(extract("raw", pattern).alias("token"))
    return tokens.where("token <> ''").groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


def compression(footers: DataFrame, by: Mapping[str, str] | list[str]) -> DataFrame:
    """Readable sizes and compression ratio per table, or per table and column."""
    stored, plain = F.sum("compressed"), F.sum("uncompressed")
    return footers.groupBy(*by).agg(
        readable_size(stored).alias("compressed"),
        readable_size(plain).alias("uncompressed"),
        ratio(plain, stored).alias("ratio"),
    )


def file_list(table: DataFrame) -> DataFrame:
    """Path and size of the files a frame reads, from file metadata columns only."""
    return table.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).groupBy("file").agg(F.max("size").alias("size"), F.count("*").alias("rows"))


def parts_per_partition(table: DataFrame, column: str, top: int = 20, order: str = "parts") -> DataFrame:
    """Files, rows and size per partition folder: the ``top`` ones with most ``parts`` or ``rows``."""
    folder = F.regexp_extract("file", rf"/{column}=([^/]+)/", 1)
    return (
        file_list(table).groupBy(folder.alias("partition"))
        .agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"),
             readable_size(F.sum("size")).alias("size"))
        .orderBy(F.desc(order), F.desc("rows"), "partition")
        .limit(top)
    )


def tier_sizes(table: DataFrame, column: str, tier: Column) -> DataFrame:
    """Files, rows and size per tier; ``tier`` is an expression over ``day``, the partition value."""
    day = F.regexp_extract("file", rf"/{column}=([^/]+)/", 1).cast("date")
    return (
        file_list(table).withColumn("day", day).groupBy(tier.alias("tier"))
        .agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"),
             readable_size(F.sum("size")).alias("size"))
    )
