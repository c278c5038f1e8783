"""Ordered, per-key computation that does not put a hot key into one task.

A window over ``partitionBy(key).orderBy(...)`` sends every row of a key to one task. Here keys of
more than about ``rows_per_chunk`` rows are found first and cut into contiguous chunks of their
order; the chunk number joins the partition key, and what earlier chunks contribute is added back as
a carry of one row per chunk. Results do not depend on where the cuts fall, so those come from small
samples. Without hot keys the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import durable

ROWS_PER_CHUNK = 2_000_000
MAX_CHUNKS = 1 << 16
SAMPLES_PER_CHUNK = 32
PROBES_PER_CHUNK = 200
BROADCAST_ENTRIES = 1_000_000
CHUNK = "_chunk"
HOT = "_hot"
WHOLE = "_whole"
_RATE_SCALE = 1 << 30


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """Keys of more than about ``threshold`` rows, with their estimated count in ``_rows``.

    Counted on a sample in which a key at the threshold has some 200 rows, so that a table of many
    small keys is not shuffled to find that none is large. Small thresholds count every row.
    """
    fraction = min(1.0, PROBES_PER_CHUNK / threshold)
    seen = df.select(*keys)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    rows = F.count("*") / F.lit(fraction)
    return seen.groupBy(*keys).agg(rows.alias("_rows")).where(F.col("_rows") > threshold)


@dataclass(frozen=True)
class Chunked:
    """Rows with their chunk number; ``split`` tells whether any key has more than one chunk."""

    df: DataFrame
    split: bool
    small: bool = True  # the chunks are few enough for one row of each to be broadcast

    def one_per_chunk(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df


def cut_into_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    largest: int | None = None,
) -> Chunked:
    """Add a chunk number that grows with ``order`` inside each key; 0 for keys that are not hot.

    ``order`` must be unique inside a key (end it with a sequence column). Cut points are order
    statistics of a hash-selected subset of a hot key, so a rerun task picks the same ones. ``largest``
    is the number of rows of the largest key, where that is known: hot keys are then looked for only if there are any.
    """
    hot = None if largest is not None and largest <= rows_per_chunk else hot_keys(df, keys, rows_per_chunk)
    if hot is None or hot.isEmpty():
        return Chunked(df.withColumns({CHUNK: F.lit(0), HOT: F.lit(False)}), split=False)

    chunks = F.least(F.ceil(F.col("_rows") / rows_per_chunk), F.lit(MAX_CHUNKS)).cast("int")
    hot = durable(hot.withColumn("_chunks", chunks)).withColumn(
        "_rate", F.least(F.lit(1.0), F.col("_chunks") * SAMPLES_PER_CHUNK / F.col("_rows"))
    )
    position = F.struct(*order)
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    if hot.count() <= BROADCAST_ENTRIES:
        hot = F.broadcast(hot)
    picked = null_safe_join(narrow, hot, keys, "inner").where(
        F.pmod(F.xxhash64(*order), F.lit(_RATE_SCALE)) < F.col("_rate") * _RATE_SCALE
    )
    cuts = (
        picked.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(position)).alias("_s"), F.max("_chunks").alias("_n"))
        .select(
            *keys,
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.col("_n") - 1, F.lit(1))),
                    lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_n")).cast("int")),
                )
            ).alias("_cuts"),
        )
    )
    cuts = durable(cuts)
    size = F.size("_cuts")
    entries, longest = cuts.agg(F.sum(size + 1), F.max(size)).first()
    small = (entries or 0) <= BROADCAST_ENTRIES
    located = null_safe_join(df, F.broadcast(cuts) if small else cuts, keys, "left")
    # binary search: number of cut points at or below the row's position
    steps = F.array(*[F.lit(1 << s) for s in reversed(range((longest or 1).bit_length()))])

    def search(at: Column) -> Column:
        return F.aggregate(
            steps,
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= size) & (F.get(F.col("_cuts"), low + step - 1) <= at), low + step
            ).otherwise(low),
        )

    found = F.transform(F.array(position), search)[0]  # binds the position once per row
    is_hot = F.col("_cuts").isNotNull()
    numbered = located.withColumns({CHUNK: F.when(is_hot, found).otherwise(0), HOT: is_hot})
    return Chunked(numbered.drop("_cuts"), split=True, small=small)


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is sum, count, min or max of ``expr`` over the rows so far."""

    kind: str
    expr: Column
    exclusive: bool = False  # leave the current row out

    def aggregate(self) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](self.expr)

    def merge(self, value: Column) -> Column:
        return {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[self.kind](value)

    def combine(self, carry: Column, local: Column) -> Column:
        if self.kind == "min":
            return F.least(carry, local)
        if self.kind == "max":
            return F.greatest(carry, local)
        both = F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
        return F.when(carry.isNotNull() | local.isNotNull(), both)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Running],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    largest: int | None = None,
) -> DataFrame:
    """Add running aggregates per key in ``order``; ``keys`` may be empty for the whole table."""
    return running_steps(df, keys, order, [columns], rows_per_chunk, largest)


def running_steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[dict[str, Running]],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    largest: int | None = None,
) -> DataFrame:
    """Running aggregates in several steps over rows cut once: a step may use the columns of those before it."""
    if not keys:
        whole = df.withColumn(WHOLE, F.lit(0))
        return running_steps(whole, [WHOLE], order, steps, rows_per_chunk, largest).drop(WHOLE)
    chunked = cut_into_chunks(df, keys, order, rows_per_chunk, largest)
    rows = chunked.df
    for columns in steps:
        rows = _running_step(replace(chunked, df=rows), keys, order, columns)
    return rows.drop(CHUNK, HOT)


def _running_step(
    chunked: Chunked, keys: Sequence[str], order: Sequence[str], columns: dict[str, Running]
) -> DataFrame:
    rows, cells = chunked.df, [*keys, CHUNK]
    window = Window.partitionBy(*cells).orderBy(*order)

    def local(run: Running) -> Column:
        end = -1 if run.exclusive else 0
        return run.aggregate().over(window.rowsBetween(Window.unboundedPreceding, end))

    if not chunked.split:
        return rows.withColumns({n: local(r) for n, r in columns.items()})

    totals = rows.where(HOT).groupBy(*cells).agg(
        *[r.aggregate().alias(f"_t_{n}") for n, r in columns.items()]
    )
    # one row per chunk of a key, at most MAX_CHUNKS + 1 rows in a window group
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *cells, *[r.merge(F.col(f"_t_{n}")).over(earlier).alias(f"_c_{n}") for n, r in columns.items()]
    )
    rows = rows.withColumns({f"_l_{n}": local(r) for n, r in columns.items()})
    joined = null_safe_join(rows, chunked.one_per_chunk(carry), cells, "left")
    return joined.withColumns(
        {n: r.combine(F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, r in columns.items()}
    ).drop(*[f"_{p}_{n}" for n in columns for p in ("c", "l")])


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    default: object = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """``lag(value, 1, default)`` in ``order``, safe for hot keys and for a whole table."""
    if not keys:
        whole = df.withColumn(WHOLE, F.lit(0))
        return previous(whole, [WHOLE], order, value, name, default, rows_per_chunk).drop(WHOLE)
    chunked = cut_into_chunks(df, keys, order, rows_per_chunk)
    cells = [*keys, CHUNK]
    window = Window.partitionBy(*cells).orderBy(*order)
    # a struct tells "no row before" from "NULL in the row before"
    rows = chunked.df.withColumn("_lag", F.lag(F.struct(value), 1).over(window))
    before, extra = F.col("_lag"), ["_lag"]
    if chunked.split:
        last = chunked.df.where(HOT).groupBy(*cells).agg(
            F.max_by(F.struct(value), F.struct(*order)).alias("_last")
        )
        by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
        carry = last.select(*cells, F.lag("_last").over(by_chunk).alias("_carry"))
        rows = null_safe_join(rows, chunked.one_per_chunk(carry), cells, "left")
        before, extra = F.coalesce("_lag", "_carry"), ["_lag", "_carry"]
    filled = F.when(before.isNull(), F.lit(default)).otherwise(before.getField(value))
    return rows.withColumn(name, filled).drop(CHUNK, HOT, *extra)
