"""Rename history: follow old names, at most a fixed number of steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rename_edges(changes: DataFrame) -> DataFrame:
    """The earliest rename or add of each path, as (path, old_path); '' stands for no old name."""
    kept = changes.where(F.col("change_type").isin("Rename", "Add"))
    first = F.min(F.struct("time", "old_path"))
    old = F.col("_first.old_path")
    return kept.groupBy("path").agg(first.alias("_first")).select(
        "path", F.when(old != "", old).alias("old_path")
    )


def rename_chain(names: DataFrame, changes: DataFrame, max_names: int = 6) -> DataFrame:
    """Add ``history``: the name followed by its older names, ``max_names`` entries at most.

    ``max_names`` - 1 joins with the deduplicated edges; edges have one row per path, so a step never
    multiplies rows, and a cycle ends at the limit. A finished chain looks for a name of its own that no
    path can have, so that the many finished ones do not meet under one NULL key.
    """
    edges = rename_edges(changes).where(F.col("old_path").isNotNull())
    chain = names.select(
        "path",
        F.when(F.col("path") == "", F.array().cast("array<string>"))
        .otherwise(F.array("path"))
        .alias("history"),
        F.when(F.col("path") != "", F.col("path")).alias("_at"),
    )
    for _ in range(max_names - 1):
        step = edges.select(F.col("path").alias("_from"), F.col("old_path").alias("_old"))
        sought = F.coalesce("_at", F.concat(F.lit("\0"), F.xxhash64("path").cast("string")))
        chain = chain.join(step, sought == F.col("_from"), "left").select(
            "path",
            F.when(F.col("_old").isNull(), F.col("history"))
            .otherwise(F.concat("history", F.array("_old")))
            .alias("history"),
            F.col("_old").alias("_at"),
        )
    return chain.drop("_at")
