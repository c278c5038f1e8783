"""Batch forms of the emit policies: what a continuous aggregation would have sent out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import ROWS_PER_CHUNK, Running, previous, running
from tidemark.session import durable


TICKS = 4096  # ticks that one row is spread to at a time


def tick_of(ts: Column | str, period: str) -> Column:
    """Start of the period a time falls in."""
    return F.window(ts, period).getField("start")


def emit_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Running],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """On update, per event: the aggregate of the key after each row."""
    return running(df, keys, order, columns, rows_per_chunk)


def _per_tick(df: DataFrame, keys: Sequence[str], ts: str, period: str,
              columns: dict[str, Running]) -> DataFrame:
    return df.groupBy(*keys, tick_of(ts, period).alias("tick")).agg(
        *[run.aggregate().alias(n) for n, run in columns.items()]
    )


def _over_ticks(columns: dict[str, Running]) -> dict[str, Running]:
    kinds = {"count": "sum"}
    return {n: Running(kinds.get(r.kind, r.kind), F.col(f"_{n}")) for n, r in columns.items()}


def emit_on_update_batched(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    period: str,
    columns: dict[str, Running],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """On update with batch: per key and period with news, the aggregate so far.

    Rows shrink to one per (key, period) before the running step.
    """
    ticks = _per_tick(df, keys, ts, period, columns).withColumnsRenamed({n: f"_{n}" for n in columns})
    ticks = durable(ticks)  # read again to look for hot keys
    done = running(ticks, keys, ["tick"], _over_ticks(columns), rows_per_chunk)
    return done.select(*keys, "tick", *columns)


def emit_periodic(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    period: str,
    columns: dict[str, Running],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Periodic: the whole result at every tick, also at ticks without news.

    Each aggregate is repeated for the ticks up to the key's next change or the end of the data. A long gap is cut into
    stretches of ``TICKS`` ticks, which are dealt over the tasks, so that no row holds an array of a whole gap.
    """
    changes = emit_on_update_batched(df, keys, ts, period, columns, rows_per_chunk)
    step = F.expr(f"INTERVAL {period}")
    backwards = changes.withColumn("_back", -F.unix_micros(F.col("tick").cast("timestamp")))
    following = previous(backwards, keys, ["_back"], "tick", "_next", rows_per_chunk=rows_per_chunk)
    end = df.agg(F.max(tick_of(ts, period))).scalar()
    until = F.coalesce(F.col("_next") - step, end)
    stretches = following.select(
        *keys, F.explode(F.sequence("tick", until, step * TICKS)).alias("_from"), until.alias("_until"), *columns
    ).repartition(*keys, "_from")
    upto = F.least("_until", F.col("_from") + step * (TICKS - 1))
    return stretches.select(*keys, F.explode(F.sequence("_from", upto, step)).alias("tick"), *columns)


def emission_rate(
    emissions: DataFrame,
    total: str,
    seconds: int,
    order: str = "tick",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Difference to the previous emission, as ``prev`` and whole events per second ``eps``."""
    with_prev = previous(emissions, [], [order], total, "prev", 0, rows_per_chunk)
    return with_prev.withColumn("eps", F.expr(f"({total} - prev) div {seconds}"))
