"""Streaming forms of the emit policies.

Aggregates are combined in the map task before they reach the keyed state, so a hot key costs one
row per task and micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.sources.paths import exists


def on_update(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Use output mode ``update``: per micro-batch the new aggregate of each changed key.

    A batched policy is the same frame with a processing-time trigger.
    """
    return df.groupBy(*keys).agg(*aggregates)


def periodic(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Use output mode ``complete``: the whole result at each trigger."""
    return df.groupBy(*keys).agg(*aggregates)


def rate_writer(root: str, total: str, seconds: int) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for a one-row total: writes it with the previous emission ``prev`` and ``eps``.

    Each emission has its own folder under ``root``, named by batch, from which the next one takes
    ``prev``; a replayed batch writes the same row again.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, f"{root}/batch_id={batch_id - 1}"
        prev = F.lit(0).cast("bigint")
        if exists(spark, before):
            prev = spark.read.parquet(before).select(F.col(total)).scalar()
        emitted = batch.select(F.col(total), F.coalesce(prev, F.lit(0)).alias("prev"))
        rate = F.expr(f"({total} - prev) div {seconds}").alias("eps")
        emitted.select(total, "prev", rate).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/batch_id={batch_id}"
        )

    return on_batch


def expire_stream(
    df: DataFrame, keys: Sequence[str], start: str, end: str, timeout: str,
    aggregates: Sequence[Column] = (), maxspan_ms: int | None = None, lateness: str = "0 seconds",
) -> DataFrame:
    """Expired groups in append mode: a group leaves when the watermark passes its timeout."""
    sessions = (
        df.withWatermark(end, lateness)
        .groupBy(*keys, F.session_window(end, timeout))
        .agg(
            F.min(start).alias("start_ts"), F.max(end).alias("end_ts"), F.count("*").alias("n"),
            *aggregates,
        )
        .drop("session_window")
    )
    span = F.timestamp_diff("MILLISECOND", F.col("start_ts"), F.col("end_ts"))
    sessions = sessions.withColumn("span_ms", span)
    return sessions if maxspan_ms is None else sessions.where(F.col("span_ms") > maxspan_ms)


class _AlertBatches(StatefulProcessor):
    """Open batch per alert key; closes when full, at the first late row, or by event-time timer."""

    def __init__(self, ts: str, seq: str, size: int, timeout_ms: int) -> None:
        self.ts, self.seq, self.size, self.timeout_ms = ts, seq, size, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "batch BIGINT, n BIGINT, first_us BIGINT")

    def _row(self, key, batch: int, n: int, first: int, close: int) -> dict:
        return {"key": key[0], "batch": batch, "n": n,
                "first_ts": pd.Timestamp(first, unit="us"), "close_ts": pd.Timestamp(close, unit="us")}

    def _arm(self, first: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if first is not None:
            self.handle.registerTimer(-(-(first + self.timeout_ms * 1000) // 1000) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.open.get() if self.open.exists() else (0, 0, 0)
        batch, n, first = (int(v) for v in state)
        pdf = pd.concat(list(rows)).sort_values([self.ts, self.seq])
        out, timeout = [], self.timeout_ms * 1000
        for at in pdf[self.ts].astype("datetime64[us]").astype("int64"):
            if n and at > first + timeout:
                out.append(self._row(key, batch, n, first, first + timeout))
                batch, n = batch + 1, 0
            first = at if n == 0 else first
            n += 1
            if n == self.size:
                out.append(self._row(key, batch, n, first, at))
                batch, n = batch + 1, 0
        self.open.update((batch, n, int(first)))
        self._arm(int(first) if n else None)
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, n, first = (int(v) for v in self.open.get())
        if n:
            self.open.update((batch + 1, 0, 0))
            yield pd.DataFrame([self._row(key, batch, n, first, first + self.timeout_ms * 1000)])

    def close(self) -> None:
        pass


def alert_stream(
    df: DataFrame, key: str, ts: str, seq: str, size: int, timeout_ms: int, lateness: str = "0 seconds"
) -> DataFrame:
    """Alert batches per key in append mode; rows must come in event-time order across micro-batches."""
    field = next(f for f in df.schema if f.name == key)
    schema = T.StructType([
        T.StructField("key", field.dataType), T.StructField("batch", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("first_ts", T.TimestampType()),
        T.StructField("close_ts", T.TimestampType()),
    ])
    return (
        df.withWatermark(ts, lateness)
        .groupBy(key)
        .transformWithStateInPandas(
            statefulProcessor=_AlertBatches(ts, seq, size, timeout_ms),
            outputStructType=schema, outputMode="Append", timeMode="EventTime",
        )
    )


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, within: str) -> DataFrame:
    """Repeats of a key within the watermark delay are dropped."""
    return df.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))
