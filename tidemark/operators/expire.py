"""Key expiry: close a key's group when no row came for ``timeout``.

Batch form. Rows of a key inside one slice of ``timeout`` length are never further apart than the
timeout, so they are one fragment of one group. Fragments are a plain aggregation by (key, slice),
which spreads a hot key over its slices; only the fragments, a few numbers each, are put in order
per key to find the gaps, by the chunked running aggregates of ``ordered``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.aggregates import group_array
from tidemark.operators.lookup import broadcast_if_small
from tidemark.operators.ordered import CHUNK, HOT, ROWS_PER_CHUNK, Running, cut_into_chunks, null_safe_join, running_steps
from tidemark.session import durable

SLICE = "_slice"


def _micros(ts: Column | str) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def _sliced(df: DataFrame, by: str, timeout_us: int) -> DataFrame:
    at = _micros(by)
    return df.where(F.col(by).isNotNull()).withColumns(
        {"_at": at, SLICE: F.floor(at / F.lit(timeout_us)).cast("bigint")}
    )


def numbered_fragments(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    timeout_us: int,
    aggregates: dict[str, Column] | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """One row per (key, slice) with the number of the group it belongs to, as ``_group``."""
    fragments = _sliced(df, by, timeout_us).groupBy(*keys, SLICE).agg(
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        *[e.alias(n) for n, e in (aggregates or {}).items()],
    )
    fragments = durable(fragments)  # read again to look for hot keys
    # slices are disjoint and ordered: the latest row before a fragment is in an earlier fragment
    seen = {"_before": Running("max", F.col("_last"), exclusive=True)}
    opens = F.when(F.col("_before").isNull() | (F.col("_first") - F.col("_before") > timeout_us), 1).otherwise(0)
    return running_steps(fragments, keys, [SLICE], [seen, {"_group": Running("sum", opens)}], rows_per_chunk)


def expire_groups(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    timeout_us: int,
    maxspan_ms: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Groups of each key with ``start_ts``, ``end_ts``, ``span_ms`` and row count ``n``.

    Groups are told apart by ``end``. With ``maxspan_ms`` only groups of a longer span are kept.
    """
    merged = numbered_fragments(
        df, keys, end, timeout_us,
        {"_start": F.min(start), "_end": F.max(end), "_n": F.count("*")}, rows_per_chunk,
    )
    groups = merged.groupBy(*keys, "_group").agg(
        F.min("_start").alias("start_ts"), F.max("_end").alias("end_ts"), F.sum("_n").alias("n")
    )
    span = F.timestamp_diff("MILLISECOND", F.col("start_ts"), F.col("end_ts"))
    groups = groups.withColumn("span_ms", span)
    if maxspan_ms is not None:
        groups = groups.where(F.col("span_ms") > maxspan_ms)
    return groups.select(*keys, "start_ts", "end_ts", "span_ms", "n")


# -- groups that also close when their span outgrows a limit ----------------------------------------

def _next_group(at: np.ndarray, timeout_us: int, maxspan_us: int) -> np.ndarray:
    """For a group that opens at row i, the row that opens the next one."""
    rows = np.arange(len(at))
    after_gap = np.append(np.where(np.diff(at) > timeout_us, rows[1:], len(at)), len(at))
    after_gap = np.minimum.accumulate(after_gap[::-1])[::-1]
    return np.minimum(np.searchsorted(at, at + maxspan_us, side="right"), after_gap)


def _span_summary(at: np.ndarray, timeout_us: int, maxspan_us: int) -> dict[str, list[int]]:
    """What a chunk does to the group that is open before it.

    The first group to open inside can only open at one of the first rows, up to the first gap or the row beyond the span of the
    first one. For each of those: the time at which the chunk's last group opened, and the groups opened; equal
    neighbours are one, as ``upto`` the last such row.
    """
    following, end = _next_group(at, timeout_us, maxspan_us), len(at)
    entries = min(int(following[0]) + 1, end)
    # from the back, so that each row takes over what its successor leaves
    last, begun = np.arange(end), np.ones(end, dtype=np.int64)
    for row in range(end - 1, -1, -1):
        if following[row] < end:
            last[row], begun[row] = last[following[row]], begun[following[row]] + 1
    changes = np.append(np.flatnonzero((np.diff(last[:entries]) != 0) | (np.diff(begun[:entries]) != 0)), entries - 1)
    gap = int(np.argmax(np.diff(at) > timeout_us)) + 1 if (np.diff(at) > timeout_us).any() else end
    return {"upto": changes.tolist(), "times": at[:entries].tolist(), "opened": at[last[changes]].tolist(),
            "begun": begun[changes].tolist(), "ends": [int(at[0]), int(at[-1]), gap, end]}


def greedy_spans(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, timeout_us: int, maxspan_us: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add the group number ``_group`` (from 0 per key) in order of (``ts``, ``seq``): a row more than the timeout after the one
    before it, or more than ``maxspan_us`` after the row that opened the group, opens the next group.

    Where a group opens depends on the one before, as with alert batches: each chunk of a hot key is summarised by what it does to any
    group open before it, the summaries are chained per key as a stream, and all chunks are numbered side by side.
    """
    timed = df.withColumn("_at", _micros(ts))
    chunked = cut_into_chunks(timed, keys, ["_at", seq], rows_per_chunk)
    rows, cells = chunked.df, [*keys, CHUNK]
    entry, base = F.lit(0).cast("long"), F.lit(0).cast("long")
    if chunked.split:
        entered = _span_entries(rows.where(HOT), keys, seq, timeout_us, maxspan_us)
        rows = null_safe_join(rows, chunked.one_per_chunk(entered), cells, "left")
        entry, base = F.coalesce("_entry", entry), F.coalesce("_base", base)
    nth = F.row_number().over(Window.partitionBy(*cells).orderBy("_at", seq))
    ordered = rows.select(*df.columns, "_at", CHUNK, nth.alias("_nth"), entry.alias("_entry"), base.alias("_base")
                          ).sortWithinPartitions(*cells, "_at", seq)
    out = T.StructType([*df.schema, T.StructField("_group", T.LongType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # taken: rows left that belong to the group open before the chunk; fresh: the next row opens a group
        group, first, before, taken, fresh = -1, 0, 0, 0, True
        for pdf in batches:
            at, nth, numbers = pdf["_at"].to_numpy(), pdf["_nth"].to_numpy(), np.empty(len(pdf), dtype=np.int64)
            starts = np.flatnonzero(nth == 1)
            for begin, end in zip([0, *starts.tolist()], [*starts.tolist(), len(pdf)]):
                if begin == end:
                    continue
                k, part = begin, at[begin:end]
                if nth[begin] == 1:
                    group, taken, fresh = int(pdf["_base"].iat[begin]) - 1, int(pdf["_entry"].iat[begin]), True
                step = min(taken, end - k)
                numbers[k:k + step] = group
                taken, k = taken - step, k + step
                if k < end and not fresh:  # the group open before this Arrow batch goes on
                    gaps = np.flatnonzero(np.diff(part, prepend=before) > timeout_us)
                    after = int(np.searchsorted(part, first + maxspan_us, side="right"))
                    k = begin + min(after, int(gaps[0]) if len(gaps) else len(part))
                    numbers[begin:k] = group
                following = _next_group(part, timeout_us, maxspan_us)
                while k < end:  # a step for each group
                    upto = begin + int(following[k - begin])
                    group, first, fresh = group + 1, int(at[k]), False
                    numbers[k:upto] = group
                    k = upto
                before = int(at[end - 1])
            yield pdf.assign(_group=numbers)[[f.name for f in out]]

    return ordered.mapInPandas(assign, out)


def _span_entries(rows: DataFrame, keys: Sequence[str], seq: str, timeout_us: int, maxspan_us: int) -> DataFrame:
    """Per chunk of a hot key: the row at which its first new group opens, and that group's number."""
    cells = [*keys, CHUNK]
    key_fields = [f for f in rows.schema if f.name in cells]
    parts = ("upto", "times", "opened", "begun", "ends")
    summary_schema = T.StructType([*key_fields, *[T.StructField(n, T.ArrayType(T.LongType())) for n in parts]])
    entry_schema = T.StructType([*key_fields, T.StructField("_entry", T.LongType()), T.StructField("_base", T.LongType())])

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_at", seq])
        made = _span_summary(pdf["_at"].to_numpy(), timeout_us, maxspan_us)
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in cells}, **{n: [v] for n, v in made.items()}})[
            [f.name for f in summary_schema]]

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, first, before, begun = None, 0, 0, 0
        for pdf in batches:
            entries, bases = [], []
            # a null key may be read as a NaN, which is not equal to itself
            owners = list(zip(*[[None if v is None or v != v else v for v in pdf[k].tolist()] for k in keys]))
            for key, chunk in zip(owners, pdf[list(parts)].itertuples(index=False)):
                begins, last, gap, size = (int(x) for x in chunk.ends)
                if key != held:
                    held, begun, entry = key, 0, 0
                elif begins - before > timeout_us:
                    entry = 0
                else:
                    entry = min(int(np.searchsorted(chunk.times, first + maxspan_us, side="right")), gap)
                    entry = entry if entry < len(chunk.times) else size
                entries.append(entry)
                bases.append(begun)
                before = last
                if entry < size:
                    place = int(np.searchsorted(chunk.upto, entry))
                    first, begun = int(chunk.opened[place]), begun + int(chunk.begun[place])
            yield pdf.assign(_entry=entries, _base=bases)[[f.name for f in entry_schema]]

    narrow = rows.select(*dict.fromkeys([*cells, "_at", seq]))
    summaries = narrow.groupBy(*cells).applyInPandas(summarise, summary_schema)
    # a key's summaries pass one by one, so memory is bounded by that of a chunk
    return summaries.repartition(*keys).sortWithinPartitions(*cells).mapInPandas(chain, entry_schema)


def close_on_maxspan(
    df: DataFrame, keys: Sequence[str], start: str, end: str, seq: str, timeout_us: int, maxspan_us: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Groups as of ``expire_groups`` that also close early: a row whose ``end`` is more than ``maxspan_us`` after that of the row
    that opened the group opens the next one. Columns ``start_ts``, ``end_ts``, ``span_ms``, ``n``. ``seq`` tells rows of equal times
    apart. Rows without an end are left out.
    """
    timed = df.where(F.col(end).isNotNull()).select(*keys, start, end, seq)
    grouped = greedy_spans(timed, keys, end, seq, timeout_us, maxspan_us, rows_per_chunk)
    groups = grouped.groupBy(*keys, "_group").agg(
        F.min(start).alias("start_ts"), F.max(end).alias("end_ts"), F.count("*").alias("n"))
    span = F.timestamp_diff("MILLISECOND", F.col("start_ts"), F.col("end_ts"))
    return groups.select(*keys, "start_ts", "end_ts", span.alias("span_ms"), "n")


def trace_groups(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    timeout_us: int,
    event: Column,
    order: Sequence[str],
    maxspan_ms: int | None = None,
    events_per_part: int = 100_000,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Expired groups with their events as an ordered array ``trace_events``.

    A group of more than ``events_per_part`` events comes as several rows, numbered by ``part``, so
    that no array grows without bound; ``n`` is the size of the whole group.
    """
    fragments = numbered_fragments(
        df, keys, end, timeout_us,
        {"_start": F.min(start), "_end": F.max(end), "_n": F.count("*")}, rows_per_chunk,
    )
    cells = [*keys, "_group"]
    groups = fragments.groupBy(*cells).agg(
        F.min("_start").alias("start_ts"), F.max("_end").alias("end_ts"), F.sum("_n").alias("n")
    )
    groups = groups.withColumn(
        "span_ms", F.timestamp_diff("MILLISECOND", F.col("start_ts"), F.col("end_ts"))
    )
    if maxspan_ms is not None:
        groups = groups.where(F.col("span_ms") > maxspan_ms)
    # when only a few groups are wanted, all other rows are dropped before any shuffle
    kept = durable(null_safe_join(fragments.select(*cells, SLICE), groups, cells, "inner"))
    largest = kept.agg(F.max("n")).first()[0] or 0
    kept = broadcast_if_small(kept)
    facts = ["start_ts", "end_ts", "span_ms", "n"]
    placed = null_safe_join(_sliced(df, end, timeout_us), kept, [*keys, SLICE], "inner").select(
        *cells, *facts, *[c for c in order if c not in cells], event.alias("_event")
    )
    arrays = group_array(placed, [*cells, *facts], "_event", order, "trace_events", events_per_part,
                         rows_per_chunk, largest)
    return arrays.select(*keys, "part", *facts, "trace_events")
