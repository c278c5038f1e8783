"""Mutable keyed tables on Parquet: upsert, versions, delete, expiry, compaction.

The operators are plain frame functions. ``KeyedTable`` keeps the result on shared storage: rows are
hashed into buckets. A change only writes its own rows, as a delta of the buckets they fall into; readers
merge a bucket's base with its later deltas, and a bucket with many deltas is rewritten. A commit record
names each folder that counts, so a half-written change is never seen. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.scalars import shard_of
from tidemark.operators.latest import latest_by_key
from tidemark.sources.paths import exists, files_below, remove

BUCKET = "_bucket"
ARRIVAL = "_arrival"  # number of the change that brought a row; decides among rows of equal order
_INPUT, _CONTENT = "_input", "_content"  # decide among rows of one change
_COMMITS = "version BIGINT, bucket INT, folder STRING, delta BOOLEAN"


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key of both; columns the delta lacks become NULL."""
    return latest_by_key(base.unionByName(delta, allowMissingColumns=True), keys, order)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop the rows for which the predicate is true; an unknown predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(gone.select(*keys), list(keys), "left_anti")


def unexpired(df: DataFrame, ts: str, ttl: str, as_of: Column) -> DataFrame:
    """Rows younger than ``ttl`` (interval text) at ``as_of``."""
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {ttl}"))


class KeyedTable:
    """A keyed table under ``path``.

    ``order`` decides which version of a key wins, and the later change where it is equal or not given. Within one change the
    column named as ``input_order`` decides among rows of equal order, and where that is equal or not given, a hash
    of the row's content: the same row wins however the change is partitioned.
    A change that lacks columns makes them NULL; one that lacks an order column takes the stored row's
    place in that order, so it wins as the later one.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = (),
        buckets: int = 64,
        bloom_columns: Sequence[str] = (),
        most_deltas: int = 8,
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.bloom_columns, self.most_deltas = list(bloom_columns), most_deltas
        self.stored = T.StructType([*schema.fields, T.StructField(ARRIVAL, T.LongType())])

    def _commits(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/_commits"):
            return self.spark.createDataFrame([], _COMMITS)
        return self.spark.read.schema(_COMMITS).json(f"{self.path}/_commits")

    def _current(self) -> tuple[int, dict[int, list[str]]]:
        """Newest version, and of each bucket its base folder and later deltas in order; a row for each
        folder and bucket that counts comes to the driver."""
        commits = self._commits().distinct()
        bases = commits.where("NOT delta").groupBy("bucket").agg(F.max("version").alias("base"))
        counted = commits.join(bases, "bucket", "left").where("base IS NULL OR version >= base")
        held: dict[int, list[str]] = {}
        version = commits.agg(F.max("version")).first()[0] or 0
        for row in counted.orderBy("version").collect():
            if row.folder:
                held.setdefault(row.bucket, []).append(row.folder)
            else:
                held.setdefault(row.bucket, [])
        return version, held

    def _files(self, held: dict[int, list[str]]) -> DataFrame:
        paths = [f"{self.path}/{folder}/{BUCKET}={b}" for b, folders in sorted(held.items()) for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*paths)

    def _merged(self, held: dict[int, list[str]]) -> DataFrame:
        """Rows as they stand, with their arrival; buckets without deltas are only read."""
        alone = {b: folders for b, folders in held.items() if len(folders) < 2}
        mixed = {b: folders for b, folders in held.items() if len(folders) > 1}
        rows = self._files(alone)
        if mixed:
            rows = rows.unionByName(latest_by_key(self._files(mixed), self.keys, [*self.order, ARRIVAL]))
        return rows

    def read(self) -> DataFrame:
        return self._merged(self._current()[1]).drop(ARRIVAL)

    def _hash(self) -> Column:
        return shard_of(F.struct(*self.keys), self.buckets).cast("int")

    def _write(self, rows: DataFrame, version: int) -> tuple[str, set[int]]:
        """Write rows with their arrival into a new folder; its name and the buckets that got rows."""
        folder = f"v={version}-{uuid.uuid4().hex}"
        # range partitioning by (bucket, key): few files per bucket, keys sorted and clustered in
        # files for min/max pruning, and a large bucket spread over several tasks
        placed = (
            rows.select(*self.stored.fieldNames())
            .withColumn(BUCKET, self._hash())
            .repartitionByRange(BUCKET, *self.keys)
            .sortWithinPartitions(BUCKET, *self.keys)
        )
        seen = Observation()
        writer = placed.observe(seen, F.collect_set(BUCKET).alias("written")).write.partitionBy(BUCKET)
        for column in self.bloom_columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(f"{self.path}/{folder}")
        return folder, set(seen.get["written"])

    def _record(self, records: list[tuple[int, int, str | None, bool]]) -> None:
        if not records:
            return
        names = ("version", "bucket", "folder", "delta")
        types = pa.schema([("version", pa.int64()), ("bucket", pa.int32()), ("folder", pa.string()), ("delta", pa.bool_())])
        commit = pa.Table.from_pylist([dict(zip(names, r)) for r in records], types)
        self.spark.createDataFrame(commit).coalesce(1).write.mode("append").json(f"{self.path}/_commits")

    def _rewrite(self, rows: DataFrame, buckets: Sequence[int], version: int) -> None:
        """Make rows the whole content of the buckets."""
        folder, written = self._write(rows, version)
        self._record([(version, b, folder if b in written else None, False) for b in buckets])

    def upsert(self, delta: DataFrame, input_order: str | None = None) -> None:
        """Merge rows. ``input_order`` names a column of the change, such as an offset, that need not be stored. The change is computed once and only its own rows are written; the table is read
        only where the change lacks an order column."""
        version, held = self._current()
        version += 1
        missing = [f for f in self.schema if f.name not in delta.columns]
        full = delta.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else delta
        fields = self.schema.fieldNames()
        full = full.select(*fields, (F.col(input_order) if input_order else F.lit(0)).alias(_INPUT))
        unordered = [c for c in self.order if c in {f.name for f in missing}]
        if unordered and held:
            stored = self._merged(held).select(*self.keys, *[F.col(c).alias(f"_stored_{c}") for c in unordered])
            full = full.drop(*unordered).join(stored, self.keys, "left").withColumnsRenamed(
                {f"_stored_{c}": c for c in unordered})
        rows = full.withColumn(ARRIVAL, F.lit(version).cast("bigint"))
        rows = rows.withColumn(_CONTENT, F.xxhash64(F.to_json(F.struct(*fields))))
        folder, written = self._write(latest_by_key(rows, self.keys, [*self.order, ARRIVAL, _INPUT, _CONTENT]), version)
        self._record([(version, b, folder, b in held) for b in sorted(written)])
        full_ones = {b: folders for b, folders in held.items() if b in written and len(folders) >= self.most_deltas}
        if full_ones:
            self.compact(buckets=sorted(full_ones))

    def delete(self, predicate: Column) -> None:
        """Delete the rows a predicate selects; buckets without such rows are left alone."""
        version, held = self._current()
        touched = [r[0] for r in self._merged(held).where(predicate).select(self._hash().alias("b")).distinct().collect()]
        if touched:
            kept = delete_where(self._merged({b: held[b] for b in touched}), predicate)
            self._rewrite(kept, touched, version + 1)

    def compact(self, ttl: str | None = None, ts: str | None = None, as_of: Column | None = None,
                buckets: Sequence[int] | None = None) -> None:
        """Rewrite the buckets (all by default) as one base each, without expired rows when a ``ttl`` is given."""
        version, held = self._current()
        chosen = {b: folders for b, folders in held.items() if buckets is None or b in buckets}
        rows = self._merged(chosen)
        if ttl is not None:
            rows = unexpired(rows, ts, ttl, as_of)
        self._rewrite(rows, sorted(chosen), version + 1)

    def vacuum(self) -> None:
        """Remove the folders that do not count any more, and their commit records; run it when no reader
        holds an older version."""
        version, held = self._current()
        commits = self._commits()
        old = files_below(self.spark, f"{self.path}/_commits")
        live = {folder for folders in held.values() for folder in folders}
        dead = [r.folder for r in commits.where("folder IS NOT NULL").select("folder").distinct().collect()
                if r.folder not in live]
        numbers = {r.folder: r.version for r in commits.where("folder IS NOT NULL").select("folder", "version").distinct().collect()}
        # what counts is written anew before the old records go; a record that is there twice counts once
        self._record([(numbers[folder], b, folder, k > 0) for b, folders in held.items() for k, folder in enumerate(folders)]
                     + [(version, b, None, False) for b, folders in held.items() if not folders])
        for path in old:
            remove(self.spark, path)
        for folder in dead:
            remove(self.spark, f"{self.path}/{folder}")

    def sink(self):
        """A ``foreachBatch`` function; replaying a batch gives the same table."""
        return lambda batch, _batch_id: self.upsert(batch)


def point_read(table: DataFrame, **equals: object) -> DataFrame:
    return table.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in equals.items()]))


def range_read(table: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return table.where(F.col(column).between(low, high))
