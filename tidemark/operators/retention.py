"""Age rules over date-partitioned tables: tier labels, whole-partition expiry, tier moves."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.paths import files_below, folders, remove


def tier_of_age(ts: Column, as_of: Column, rules: Sequence[tuple[str, str]], first: str = "hot") -> Column:
    """Tier name of a time: ``rules`` are (interval text, tier) from young to old."""
    tier = F.lit(first)
    for interval, name in rules:
        tier = F.when(ts + F.expr(f"INTERVAL {interval}") <= as_of, F.lit(name)).otherwise(tier)
    return tier


def drop_expired_partitions(df: DataFrame, day: str, keep: str, as_of: Column) -> DataFrame:
    """Rows of the days not older than ``keep``; on a day-partitioned table this prunes folders."""
    return df.where(F.col(day) >= F.to_date(as_of - F.expr(f"INTERVAL {keep}")))


def write_layout(
    df: DataFrame, path: str, partition: Sequence[str], sort: Sequence[str], mode: str = "append"
) -> None:
    """Write partitioned by ``partition`` and sorted inside files.

    Range partitioning on (partition, sort) keeps files few and spreads a large partition over
    several tasks.
    """
    df.repartitionByRange(*partition, *sort).sortWithinPartitions(*partition, *sort).write.mode(
        mode
    ).partitionBy(*partition).parquet(path)


MOVED_FROM = "moved_from"


class TieredTable:
    """A day-partitioned table whose old days move from one root path to the next.

    A moved file becomes a folder of its own in the target day, named by the file it came from. A rerun
    after a crash replaces that folder, rows that arrive late for a moved day come from other files and
    join it, and readers leave out a file whose copy is already in a later tier. So no row is lost and
    none is seen twice, whenever a move is cut short.
    """

    def __init__(
        self, spark: SparkSession, roots: dict[str, str], schema: T.StructType, day: str, sort: Sequence[str]
    ) -> None:
        self.spark, self.roots, self.schema = spark, {n: r.rstrip("/") for n, r in roots.items()}, schema
        self.day, self.sort = day, list(sort)

    def append(self, df: DataFrame) -> None:
        write_layout(df, next(iter(self.roots.values())), [self.day], self.sort)

    def read(self, tier: str | None = None) -> DataFrame:
        frames = [self._read(name) for name in self.roots if tier in (None, name)]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def _read(self, tier: str) -> DataFrame:
        if not self.days(tier):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(self.roots[tier])
        copied = self._copied(tier)
        if copied:
            rows = rows.where(~self._origin(F.col("_metadata.file_path")).isin(copied))
        return rows.select(*self.schema.fieldNames())

    def days(self, tier: str) -> list[str]:
        """Partition days of a tier, from its folder names."""
        names = folders(self.spark, self.roots[tier])
        return [n.partition("=")[2] for n in names if n.startswith(f"{self.day}=")]

    def _files(self, tier: str, day: str) -> list[str]:
        return files_below(self.spark, f"{self.roots[tier]}/{self.day}={day}")

    def _origin(self, path: Column) -> Column:
        """Name of a file's copy: a digest of its place below the root."""
        return F.md5(F.regexp_extract(path, f"/({self.day}=[^/]*/.*)$", 1))

    def _digests(self, paths: Sequence[str]) -> dict[str, str]:
        places = {p: re.search(f"/({self.day}=[^/]*/.*)$", p).group(1) for p in paths}
        return {hashlib.md5(place.encode()).hexdigest(): path for path, place in places.items()}

    def _copied(self, tier: str) -> list[str]:
        """Digests of the tier's files that a later tier holds a copy of; mostly none."""
        names, found = list(self.roots), []
        for later in names[names.index(tier) + 1:]:
            for day in set(self.days(tier)) & set(self.days(later)):
                held = folders(self.spark, f"{self.roots[later]}/{self.day}={day}")
                known = {n.partition("=")[2] for n in held if n.startswith(f"{MOVED_FROM}=")}
                found += [d for d in self._digests(self._files(tier, day)) if d in known]
        return found

    def apply(self, as_of: str, rules: Sequence[tuple[str, str]], delete_after: str | None = None) -> None:
        """Move the days that outgrew their tier and delete those past ``delete_after``.

        Days with the same way to go are copied by one job; then exactly the files that were copied are
        removed, so that rows appended meanwhile stay for the next time.
        """
        names = list(self.roots)
        held = [(tier, day) for tier in names for day in self.days(tier)]
        if not held:
            return
        at, start = F.lit(as_of).cast("timestamp_ntz"), F.col("day").cast("timestamp_ntz")
        gone = F.lit(False)
        if delete_after is not None:
            gone = start + F.expr(f"INTERVAL {delete_after}") <= at
        fate = F.when(gone, "").otherwise(tier_of_age(start, at, rules, names[0]))
        plan = self.spark.createDataFrame(held, "tier STRING, day STRING").withColumn("fate", fate)
        moves: dict[tuple[str, str], list[str]] = {}
        for tier, day, target in plan.collect():
            if target == "" or names.index(target) > names.index(tier):
                moves.setdefault((tier, target), []).append(day)
        for (tier, target), days in moves.items():
            files = {day: self._files(tier, day) for day in days}
            if target:
                self._copy(tier, target, [f for day in days for f in files[day]])
            self._clear(tier, files)

    def _copy(self, tier: str, target: str, files: Sequence[str]) -> None:
        if not files:
            return
        rows = self.spark.read.schema(self.schema).option("basePath", self.roots[tier]).parquet(*files)
        rows = rows.select(*self.schema.fieldNames(), self._origin(F.col("_metadata.file_path")).alias(MOVED_FROM))
        keys = [self.day, MOVED_FROM]
        rows.repartitionByRange(*keys, *self.sort).sortWithinPartitions(*keys, *self.sort).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(self.roots[target])

    def _clear(self, tier: str, files: dict[str, list[str]]) -> None:
        for day, paths in files.items():
            for path in paths:
                remove(self.spark, path)
            if not self._files(tier, day):
                remove(self.spark, f"{self.roots[tier]}/{self.day}={day}")
