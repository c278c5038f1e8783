"""Alerts: batches of up to ``size`` rows or ``timeout`` after the first row, then a rate limit.

Batching is greedy: where a batch starts depends on where the one before ended. A key's rows are cut
into chunks. The first new batch inside a chunk can only start at one of its first ``size`` rows, so
each chunk is summarised as "entered at row o, it is left in this state" for those few o, the
summaries are chained per key, and every chunk is then batched on its own from its known entry.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.operators.ordered import (
    CHUNK, HOT, ROWS_PER_CHUNK, WHOLE, cut_into_chunks, null_safe_join,
)


def _next_start(at: np.ndarray, size: int, timeout: int) -> np.ndarray:
    """For a batch starting at row i, the row after its last one."""
    by_time = np.searchsorted(at, at + timeout, side="right")
    return np.minimum(np.arange(len(at)) + size, by_time)


def _summary(at: np.ndarray, size: int, timeout: int) -> tuple[list, list, list, list]:
    """First rows of the chunk and, per entry row, the open batch at its end and batches begun."""
    following = _next_start(at, size, timeout)
    end = len(at)
    left: dict[int, tuple[int, int]] = {}  # row -> (start of the last batch, batches begun)
    for entry in range(min(size, end)):
        path, row = [], entry
        while row not in left and following[row] < end:
            path.append(row)
            row = int(following[row])
        last, begun = left.setdefault(row, (row, 1))
        for row in reversed(path):
            begun += 1
            left[row] = (last, begun)
    entries = [left[e] for e in range(min(size, end))]
    return (
        at[:size].tolist(),
        [end - last for last, _ in entries],
        [int(at[last]) for last, _ in entries],
        [begun for _, begun in entries],
    )


def greedy_batches(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    size: int,
    timeout_us: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add the batch number ``batch`` (from 0 per key) to each row, in order of (``ts``, ``seq``)."""
    if not keys:
        whole = df.withColumn(WHOLE, F.lit(0))
        batched = greedy_batches(whole, [WHOLE], ts, seq, size, timeout_us, rows_per_chunk)
        return batched.drop(WHOLE)
    timed = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    chunked = cut_into_chunks(timed, keys, ["_at", seq], rows_per_chunk)
    rows, cells = chunked.df, [*keys, CHUNK]
    entry, base = F.lit(0).cast("long"), F.lit(0).cast("long")
    if chunked.split:
        entered = _chunk_entries(rows.where(HOT), keys, seq, size, timeout_us)
        rows = null_safe_join(rows, chunked.one_per_chunk(entered), cells, "left")
        entry, base = F.coalesce("_entry", entry), F.coalesce("_base", base)

    # the window brings a chunk into one task in order and marks its first row
    nth = F.row_number().over(Window.partitionBy(*cells).orderBy("_at", seq))
    ordered = rows.select(
        *df.columns, "_at", CHUNK, nth.alias("_nth"), entry.alias("_entry"), base.alias("_base")
    ).sortWithinPartitions(*cells, "_at", seq)
    out = T.StructType([*df.schema, T.StructField("batch", T.LongType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, held, first, taken = -1, size, 0, 0
        for pdf in batches:
            at, nth, numbers = pdf["_at"].to_numpy(), pdf["_nth"].to_numpy(), np.empty(len(pdf), dtype=np.int64)
            starts = np.flatnonzero(nth == 1)
            for begin, end in zip([0, *starts.tolist()], [*starts.tolist(), len(pdf)]):
                if begin == end:
                    continue
                k, part = begin, at[begin:end]
                if nth[begin] == 1:
                    batch, held, taken = int(pdf["_base"].iat[begin]) - 1, size, int(pdf["_entry"].iat[begin])
                step = min(taken, end - k)
                numbers[k:k + step] = batch
                taken, k = taken - step, k + step
                if k < end and held < size:  # the batch open before this Arrow batch goes on
                    fits = int(np.searchsorted(part, first + timeout_us, side="right")) - (k - begin)
                    step = max(min(size - held, fits), 0)
                    numbers[k:k + step] = batch
                    held, k = held + step, k + step
                following = _next_start(part, size, timeout_us)
                while k < end:  # a step for each batch
                    upto = begin + int(following[k - begin])
                    batch, first, held = batch + 1, int(at[k]), upto - k
                    numbers[k:upto] = batch
                    k = upto
            yield pdf.assign(batch=numbers)[[f.name for f in out]]

    return ordered.mapInPandas(assign, out)


def _chunk_entries(
    rows: DataFrame, keys: Sequence[str], seq: str, size: int, timeout_us: int
) -> DataFrame:
    """Per chunk of a hot key: the row at which its first new batch starts, and that batch's number."""
    cells = [*keys, CHUNK]
    key_fields = [f for f in rows.schema if f.name in cells]
    summary_schema = T.StructType([
        *key_fields, T.StructField("size", T.LongType()),
        *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("head", "open", "first", "begun")],
    ])
    entry_schema = T.StructType(
        [*key_fields, T.StructField("_entry", T.LongType()), T.StructField("_base", T.LongType())]
    )

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_at", seq])
        head, held, first, begun = _summary(pdf["_at"].to_numpy(), size, timeout_us)
        row = {c: [pdf[c].iloc[0]] for c in cells}
        return pd.DataFrame(
            {**row, "size": [len(pdf)], "head": [head], "open": [held], "first": [first], "begun": [begun]}
        )[[f.name for f in summary_schema]]

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK)
        held, first, begun = size, 0, 0
        entries, bases = [], []
        for chunk in pdf.itertuples():
            fits = int(np.searchsorted(np.asarray(chunk.head), first + timeout_us, side="right"))
            entry = min(size - held, fits)
            entries.append(entry)
            bases.append(begun)
            if entry == chunk.size:  # the open batch takes the whole chunk
                held += entry
            else:
                held, first = int(chunk.open[entry]), int(chunk.first[entry])
                begun += int(chunk.begun[entry])
        return pdf.assign(_entry=entries, _base=bases)[[f.name for f in entry_schema]]

    narrow = rows.select(*dict.fromkeys([*cells, "_at", seq]))
    summaries = narrow.groupBy(*cells).applyInPandas(summarise, summary_schema)
    return summaries.groupBy(*keys).applyInPandas(chain, entry_schema)


def alert_batches(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    size: int,
    timeout_us: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """One row per batch: row count, first time and the time it closes.

    A full batch closes at its last row, another one ``timeout_us`` after its first row.
    """
    rows = greedy_batches(df, keys, ts, seq, size, timeout_us, rows_per_chunk)
    batches = rows.groupBy(*keys, "batch").agg(
        F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("_last")
    )
    expired = F.col("first_ts") + F.expr(f"make_dt_interval(0, 0, 0, {timeout_us / 1e6:.6f})")
    closed = F.when(F.col("n") >= size, F.col("_last")).otherwise(expired)
    return batches.withColumn("close_ts", closed).drop("_last")


def rate_limit(batches: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The first batch to close in each period, with the number of batches held back after it."""
    first = F.min(F.struct("close_ts", "batch", "n", "first_ts"))
    return (
        batches.groupBy(*keys, F.window("close_ts", period).alias("_p"))
        .agg(first.alias("_b"), (F.count("*") - 1).alias("suppressed"))
        .select(*keys, "_b.batch", "_b.n", "_b.first_ts", "_b.close_ts", "suppressed")
    )


def alert_payload(batched: DataFrame, batch: Sequence[str], cluster: str, node: str) -> DataFrame:
    """One JSON text per batch: cluster -> sorted list of its nodes; a list is at most a batch long."""
    nodes = F.sort_array(F.collect_list(F.col(node).cast("string"))).alias("nodes")
    by_cluster = batched.groupBy(*batch, F.col(cluster).cast("string").alias("_cluster")).agg(nodes)
    entries = F.sort_array(F.collect_list(F.struct("_cluster", "nodes")))
    offline = F.map_from_entries(entries).alias("cluster_offline_nodes")
    return by_cluster.groupBy(*batch).agg(F.to_json(F.struct(offline)).alias("payload"))
