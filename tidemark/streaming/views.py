"""Continuous queries into a target, and their life: start, pause, resume, recover, drop."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import scratch_path
from tidemark.sources.paths import remove

Sink = str | Callable[[DataFrame, int], None] | None


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
    latest_first: bool = False,
) -> DataFrame:
    """An unbounded read of a Parquet table; the trailing pattern also takes a single file."""
    reader = spark.readStream.schema(schema).option("latestFirst", str(latest_first).lower())
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def trigger_of(every: str | None) -> dict:
    """``None`` runs through what is there and stops, otherwise a period such as '5 seconds'."""
    return {"availableNow": True} if every is None else {"processingTime": every}


@dataclass
class View:
    """A continuous query. ``sink`` is a Parquet path, a ``foreachBatch`` function or None to discard."""

    spark: SparkSession
    name: str | None
    build: Callable[[], DataFrame]
    sink: Sink
    checkpoint: str
    mode: str = "append"
    every: str | None = None
    query: StreamingQuery | None = None

    def start(self) -> "View":
        writer = (
            self.build().writeStream.outputMode(self.mode)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger_of(self.every))
        )
        if self.name:
            writer = writer.queryName(self.name)
        if callable(self.sink):
            self.query = writer.foreachBatch(self.sink).start()
        elif self.sink is None:
            self.query = writer.format("noop").start()
        else:
            self.query = writer.format("parquet").option("path", self.sink).start()
        return self

    def wait(self) -> "View":
        self.query.awaitTermination()
        return self

    def pause(self) -> None:
        """Stop after the work in hand; the checkpoint keeps the position."""
        if self.query is not None and self.query.isActive:
            self.query.stop()

    abort = pause

    def resume(self) -> "View":
        return self.start()

    def recover(self, checkpoint: str) -> "View":
        """Start again from the beginning with a new checkpoint, giving up the old state."""
        self.pause()
        self.checkpoint = checkpoint
        return self.start()

    def drop(self) -> None:
        """Stop and delete the checkpoint and a file target."""
        self.pause()
        folders = [self.checkpoint] + ([self.sink] if isinstance(self.sink, str) else [])
        for folder in folders:
            remove(self.spark, folder)


def run_to_end(df: DataFrame, mode: str = "append", name: str = "run") -> DataFrame:
    """Run a stream over all that is there now; the emissions, numbered by ``batch_id``."""
    spark = df.sparkSession
    out = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    View(spark, None, lambda: df, write, scratch_path(spark, f"{name}-checkpoint"), mode).start().wait()
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).option("basePath", out).parquet(out)


def snapshot_into(df: DataFrame, target: str, as_of: str) -> None:
    """Append a snapshot to a history table; repeating a run replaces that snapshot only."""
    df.write.mode("overwrite").parquet(f"{target}/as_of={as_of.replace(':', '-').replace(' ', 'T')}")


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, from the progress reports kept by Spark."""
    return sum(
        op.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for op in progress.stateOperators
    )
