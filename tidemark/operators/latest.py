"""Latest-value joins and column merges over tagged sides.

One side's latest row per key is a mergeable aggregate (``max_by``), so the full latest join of any
number of sides is a union and one grouped aggregation: one shuffle of pre-aggregated rows, no join,
and the same expression runs on streams in update mode.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SIDE = "_side"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``; rows shrink to one per key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def tag_sides(sides: Mapping[str, DataFrame], key: str, seq: str) -> DataFrame:
    """Union of the sides; each keeps its value columns in a struct named after the side."""

    def tagged(name: str, df: DataFrame) -> DataFrame:
        values = [c for c in df.columns if c not in (key, seq)]
        return df.select(
            F.col(key), F.col(seq), F.lit(name).alias(SIDE), F.struct(*values).alias(name)
        )

    frames = [tagged(name, df) for name, df in sides.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _latest_side(name: str, seq: str) -> Column:
    on_side = F.col(SIDE) == name
    return F.max_by(F.col(name), F.when(on_side, F.col(seq))).alias(name)


def full_latest_join(
    sides: Mapping[str, DataFrame], key: str, seq: str, flatten: bool = True
) -> DataFrame:
    """Full outer join of each side's latest row per key; on a stream use update mode.

    A NULL key matches nothing: it is kept, one row per side.
    """
    tagged = tag_sides(sides, key, seq)
    apart = F.when(F.col(key).isNull(), F.col(SIDE)).alias("_apart")
    if not flatten:
        return tagged.groupBy(key, apart).agg(*[_latest_side(n, seq) for n in sides]).drop("_apart")
    # column by column, so that columns of fixed width are aggregated by hash, without sorting the rows
    values = [
        F.max_by(F.col(f"{name}.{c}"), F.when(F.col(SIDE) == name, F.col(seq))).alias(c)
        for name, df in sides.items()
        for c in df.columns
        if c not in (key, seq)
    ]
    return tagged.groupBy(key, apart).agg(*values).drop("_apart")


def merge_columns(df: DataFrame, keys: Sequence[str], seq: str, columns: Sequence[str]) -> DataFrame:
    """One row per key with the last non-NULL value of each column."""
    return df.groupBy(*keys).agg(
        *[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c)
            for c in columns
        ]
    )
