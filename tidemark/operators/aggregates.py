"""Aggregates over keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.lookup import broadcast_if_small
from tidemark.operators.ordered import ROWS_PER_CHUNK, WHOLE, Running, null_safe_join, running
from tidemark.session import durable

SKETCH = 10_000  # accuracy of the sketches that bound exact percentiles: rank errors are below one part in so many


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    """Sum of decimal-valued doubles that does not depend on the order of the rows."""
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(column.cast(f"decimal(18,{scale})")).cast("double")


def latest(value: Column | str, *order: Column | str) -> Column:
    """The value of the row that is last in ``order``; with one order column of fixed width and such a value it is
    aggregated by hash, without a sort."""
    return F.max_by(value, order[0] if len(order) == 1 else F.struct(*order))


def p90(value: Column | str, accuracy: int = 10_000) -> Column:
    """Approximate 90th percentile from a mergeable sketch of bounded size."""
    return F.percentile_approx(value, F.lit(0.9), F.lit(accuracy))


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, str],
    fraction: float = 0.9,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Interpolated percentiles per key: ``values`` maps output name to input column. Exact, in two passes.

    The first pass makes a mergeable sketch of bounded size for each key; its rank error is bounded, so the wanted ranks
    lie between two values it gives. The second pass counts what lies below and above, and only the
    values in between are counted one by one: some thousandths of the rows, and no row per distinct value of the rest.
    Ranks come from a chunked running sum, so a key never has to fit in one task. A key without a value gives
    NULL. Ranks outside the bounds would be an error, and raise one.
    """
    if not keys:
        whole = df.withColumn(WHOLE, F.lit(0))
        return exact_percentile(whole, [WHOLE], values, fraction, rows_per_chunk).drop(WHOLE)
    near = 2 / SKETCH
    around = F.array(F.lit(max(fraction - near, 0.0)), F.lit(min(fraction + near, 1.0)))
    columns = {n: F.col(c).cast("double") for n, c in values.items()}
    bounds = broadcast_if_small(durable(df.groupBy(*keys).agg(
        *[F.percentile_approx(v, around, F.lit(SKETCH)).alias(f"_b_{n}") for n, v in columns.items()])))
    bounded = null_safe_join(df.select(*keys, *[v.alias(f"_v_{n}") for n, v in columns.items()]), bounds, keys, "left")
    cell = F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"_v_{n}").alias("v"), F.col(f"_b_{n}")[0].alias("low"), F.col(f"_b_{n}")[1].alias("high"))
        for n in values])).alias("_cell")
    side = F.when(F.col("_cell.v") < F.col("_cell.low"), 0).when(F.col("_cell.v") > F.col("_cell.high"), 2).otherwise(1)
    long = bounded.select(*keys, cell).select(*keys, F.col("_cell.name").alias("_name"), side.alias("_side"), F.col("_cell.v").alias("_each"))
    groups = [*keys, "_name"]
    inside = F.when(F.col("_side") == 1, F.col("_each"))
    # a NULL value keeps its key in the result and takes no rank; of what lies outside, the nearest value is kept
    counts = long.groupBy(*groups, "_side", inside.alias("_inside")).agg(
        F.count("_each").alias("_n"), F.max("_each").alias("_most"), F.min("_each").alias("_least"))
    nearest = F.when(F.col("_side") == 0, F.col("_most")).otherwise(F.col("_least"))
    counts = durable(counts.withColumn("_v", nearest))  # read again for hot keys and for the totals
    ranked = running(counts, groups, ["_side", "_inside"], {"_upto": Running("sum", F.col("_n"))}, rows_per_chunk)
    totals = broadcast_if_small(counts.groupBy(*groups).agg(F.sum("_n").alias("_total")))
    rank = F.lit(fraction) * (F.col("_total") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    located = null_safe_join(ranked, totals, groups, "inner")

    def percentile(name: str) -> Column:
        mine = F.col("_name") == name
        low_value = F.min(F.when(mine & (F.col("_upto") > low), F.col("_v")))
        high_value = F.min(F.when(mine & (F.col("_upto") > high), F.col("_v")))
        part = F.max(F.when(mine, rank - low))
        # below, only the last value is known, and above only the first
        missed = F.max(F.when(mine & (F.col("_side") == 0), F.col("_upto") > low + 1).when(
            mine & (F.col("_side") == 2), F.col("_upto") - F.col("_n") < high).otherwise(F.lit(False)))
        found = low_value + (high_value - low_value) * part
        return F.when(missed, F.raise_error(F.lit("a percentile lies outside its bounds")).cast("double")).otherwise(found)

    return located.groupBy(*keys).agg(*[percentile(n).alias(n) for n in values])


def group_array(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    name: str,
    rows_per_part: int = 100_000,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    largest: int | None = None,
) -> DataFrame:
    """Values of a key as arrays in ``order``, at most ``rows_per_part`` in one, numbered by ``part``.

    Most keys have part 0 only; the parts of a large key are built by different tasks. ``largest``, if known, is the number of rows of the
    largest key.
    """
    cells = [*keys, "part"]
    nth = {"_nth": Running("count", F.lit(1))}
    # without hot keys the arrays are built where the rows were numbered, with no further shuffle
    rows = running(df, keys, order, nth, rows_per_chunk, largest).withColumn(
        "part", F.expr(f"(_nth - 1) div {rows_per_part}")
    )
    element = F.struct(F.struct(*order).alias("at"), F.col(value).alias("value"))
    ordered = F.sort_array(F.collect_list(element))
    return rows.groupBy(*cells).agg(F.transform(ordered, lambda e: e["value"]).alias(name))
