"""Session settings and shared storage locations."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.paths import remove

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot probe key is worth one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Python workers hold a few batches at a time: bound them by bytes, as ten thousand long texts are many
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # pre-merge session fragments in the map task before they are shuffled
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


# the folders that are made within ``settle``
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options this library relies on; cluster sizing is left to the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, with its scheme: ``spark.checkpoint.dir``. Only where all runs in one
    process on one machine may it be unset; then it is a private one. A cluster without it is an error,
    as each executor would write to a disk of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that outlives a lost executor. As Parquet it can be read by column, and
    its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, "durable")
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(build: Callable[[], DataFrame]) -> DataFrame:
    """Build a frame, write it, and remove the tables that ``durable`` made on the way: only the result's own folder is left.

    What ``build`` returns must not be used by frames made elsewhere; their files would be gone.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        frame = build()
    finally:
        _MADE.reset(token)
    result = durable(frame)
    for path in made:
        remove(frame.sparkSession, path)
    return result


def discard(spark: SparkSession, frames: Iterable[DataFrame]) -> None:
    """Remove the folders of frames that ``durable`` gave, when nothing reads them any more."""
    root = f"{shared_dir(spark)}/tidemark/durable-"
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            if "/tidemark/durable-" in folder:
                remove(spark, f"{root}{folder.rsplit('/tidemark/durable-', 1)[1]}")
