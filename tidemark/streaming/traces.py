"""Traces on a stream: the events of a key, gathered until no more can come, as one ordered group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def trace_groups_stream(
    df: DataFrame, key: str, start: str, end: str, seq: str, timeout_us: int, event: Column,
    maxspan_ms: int | None = None, lateness: str = "0 seconds", events_per_part: int = 100_000,
) -> DataFrame:
    """Expired groups with their events as an ordered array, in append mode; columns as of ``operators.expire.trace_groups``.

    Rows may come in any order within ``lateness``; a later one is dropped by the watermark unless it falls into a group that
    is still open, or could have been. A group leaves when the watermark
    passes its last end by the timeout. A group of more than ``events_per_part`` events comes in numbered parts. With
    ``maxspan_ms`` only groups of a longer span are given. Rows without an end are left out. The events of an open
    group are kept as one value in Spark's session window and written anew when more come, so a group that never closes keeps
    growing: bound it by a span where sources may do that.
    """
    # events are put in order when the group leaves, by end and sequence
    one = F.struct(F.unix_micros(end).alias("end_us"), F.coalesce(F.col(seq).cast("long"), F.lit(0)).alias("seq"), event.alias("item"))
    narrow = df.where(F.col(end).isNotNull()).withWatermark(end, lateness).select(
        F.col(key).alias("key"), F.col(end), F.unix_micros(F.coalesce(start, end)).alias("start_us"), one.alias("one"))
    # the key that is given is an aggregate: a filter on it stays above the watermark, which passes by the rows of all keys
    groups = narrow.groupBy("key", F.session_window(end, f"{timeout_us} microseconds")).agg(
        F.any_value("key").alias("of"), F.min("start_us").alias("start_us"), F.max("one.end_us").alias("end_us"), F.count("*").alias("n"), F.collect_list("one").alias("held"))
    span = F.expr("(end_us - start_us) div 1000")
    if maxspan_ms is not None:
        groups = groups.where(span > maxspan_ms)
    ordered = groups.select("of", "start_us", "end_us", "n", F.transform(F.array_sort("held"), lambda e: e["item"]).alias("held"))
    last = (F.col("n") - 1) / events_per_part
    parts = ordered.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last))).alias("part"))
    return parts.select(
        F.col("of").alias(key), "part", F.timestamp_micros("start_us").alias("start_ts"), F.timestamp_micros("end_us").alias("end_ts"),
        span.alias("span_ms"), "n", F.slice("held", (F.col("part") * events_per_part + 1).cast("int"), F.lit(events_per_part)).alias("trace_events"))
