"""Many continuous aggregations over one source, read once, and lookup sides that a replay sees unchanged."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.ordered import Running
from tidemark.session import durable, discard
from tidemark.sources.paths import exists, folders, remove


@dataclass(frozen=True)
class Aggregation:
    """A continuous aggregation: mergeable ``columns`` per ``keys`` of the rows for which ``where`` holds."""

    name: str
    keys: Sequence[str]
    columns: dict[str, Running]
    where: Column | None = None

    def partial(self, rows: DataFrame) -> DataFrame:
        rows = rows if self.where is None else rows.where(self.where)
        return rows.groupBy(*self.keys).agg(*[run.aggregate().alias(n) for n, run in self.columns.items()])

    def merged(self, before: DataFrame, news: DataFrame) -> DataFrame:
        both = before.unionByName(news)
        return both.groupBy(*self.keys).agg(*[run.merge(F.col(n)).alias(n) for n, run in self.columns.items()])


@dataclass
class SharedViews:
    """Aggregations over one source, each with a target of its own below ``root``.

    As ``foreachBatch`` of a stream: the micro-batch is read from the source once and held as a table in the shared folder, from
    which each aggregation reads its columns; each then writes its whole result as a version named by the batch. A version
    counts when its folder is complete. A replayed batch starts again from the version before and gives
    the same. ``keep`` versions stay for readers that are still at work.
    """

    spark: SparkSession
    root: str
    views: Sequence[Aggregation]
    keep: int = 2
    reads: list[int] = field(default_factory=list)  # batches that were taken from the source

    def _versions(self, name: str) -> list[int]:
        found = [int(f.split("=", 1)[1]) for f in folders(self.spark, f"{self.root}/{name}") if f.startswith("batch_id=")]
        return sorted(n for n in found if exists(self.spark, f"{self.root}/{name}/batch_id={n}/_SUCCESS"))

    def read(self, name: str) -> DataFrame:
        """The newest complete version."""
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"{self.root}/{name} has no version yet")
        return self.spark.read.parquet(f"{self.root}/{name}/batch_id={versions[-1]}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if all(batch_id in self._versions(view.name) for view in self.views):
            return
        rows = durable(batch)
        self.reads.append(batch_id)
        for view in self.views:
            versions = self._versions(view.name)
            target = f"{self.root}/{view.name}/batch_id={batch_id}"
            if batch_id in versions:
                continue
            earlier = [n for n in versions if n < batch_id]
            result = view.partial(rows)
            if earlier:
                before = self.spark.read.schema(result.schema).parquet(f"{self.root}/{view.name}/batch_id={earlier[-1]}")
                result = view.merged(before, result)
            result.write.mode("overwrite").parquet(target)
            for old in earlier[:-self.keep]:
                remove(self.spark, f"{self.root}/{view.name}/batch_id={old}")
        discard(self.spark, [rows])


@dataclass
class RefreshedSide:
    """A lookup side for ``foreachBatch`` jobs that is loaded anew when older than ``lifetime`` seconds (None: never).

    What a batch saw is written down: each load is a table below ``root``, and each batch number names the one it used before
    it is used. A batch that is replayed, also after a restart, sees the same side. Loads that no batch of the last ``keep``
    names are removed.
    """

    spark: SparkSession
    load: Callable[[], DataFrame]
    root: str
    lifetime: float | None
    clock: Callable[[], float] = time.time
    keep: int = 10

    def _used(self) -> dict[int, str]:
        path = f"{self.root}/used"
        if not exists(self.spark, path):
            return {}
        rows = self.spark.read.schema("batch_id BIGINT, side STRING").json(path)
        return {r.batch_id: r.side for r in rows.collect()}  # a row for each of the last batches

    def _loads(self) -> list[str]:
        found = [f for f in folders(self.spark, self.root) if f.startswith("side=")]
        return sorted((f for f in found if exists(self.spark, f"{self.root}/{f}/_SUCCESS")), key=lambda f: int(f.split("=")[1].split("-")[0]))

    def at(self, batch_id: int) -> DataFrame:
        """The side as the batch sees it."""
        used = self._used()
        side = used.get(batch_id)
        if side is None:
            loads, now = self._loads(), int(self.clock() * 1000)
            side = loads[-1] if loads else None
            if side is None or self.lifetime is not None and now - int(side.split("=")[1].split("-")[0]) >= 1000 * self.lifetime:
                side = f"side={now}-{batch_id}"
                self.load().write.mode("overwrite").parquet(f"{self.root}/{side}")
            record = self.spark.createDataFrame([(batch_id, side)], "batch_id BIGINT, side STRING")
            record.coalesce(1).write.mode("overwrite").json(f"{self.root}/used/batch={batch_id}")
            self._forget({**used, batch_id: side})
        return self.spark.read.parquet(f"{self.root}/{side}")

    def _forget(self, used: dict[int, str]) -> None:
        old = sorted(used)[:-self.keep]
        for batch_id in old:
            remove(self.spark, f"{self.root}/used/batch={batch_id}")
        wanted = {side for batch_id, side in used.items() if batch_id not in old}
        for side in self._loads():
            if side not in wanted:
                remove(self.spark, f"{self.root}/{side}")
