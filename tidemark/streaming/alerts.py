"""Streaming alerts that carry their rows, keep to a rate, and call something once.

The state of a key is the open batch with its rows, and the period of its last alert; it is kept by buckets of keys. A closed batch leaves as
one row with the rows as JSON texts; what is made of them is left to column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.sources.paths import exists


# what is kept of a bucket's keys, side by side: number, first time and rows of the open batch, the period of the last alert,
# batches held back since
_OPEN = ("keys ARRAY<STRING>, batch ARRAY<BIGINT>, first_us ARRAY<BIGINT>, period ARRAY<BIGINT>, suppressed ARRAY<BIGINT>, "
         "items ARRAY<ARRAY<STRING>>")
_ALERTS_A_FRAME = 10_000


def _acting_batches(size: int, timeout_us: int, period_us: int | None) -> Callable[..., Iterator[pd.DataFrame]]:
    """Open batches of a bucket's keys with their rows. One closes when full, before the first row beyond its time, or by
    timeout; the first to close in a period is allowed."""

    def timer(first: int) -> int:
        return -(-(first + timeout_us) // 1000) + 1

    def alert(key: str | None, kept: list, close: int) -> tuple:
        """The row for the open batch, which is then the next one."""
        batch, first, last, held_back, items = kept
        allowed, suppressed = True, 0
        if period_us is not None:
            period = close // period_us
            allowed = last is None or period > last
            suppressed, last, held_back = (held_back, period, 0) if allowed else (0, last, held_back + 1)
        kept[:] = batch + 1, 0, last, held_back, []
        return key, batch, len(items), first, close, items, allowed, suppressed

    def add(key: str | None, kept: list, at: np.ndarray, items: list[str]) -> Iterator[tuple]:
        k = 0
        while k < len(at):  # a step for each batch, not for each row
            if not kept[4]:
                kept[1] = int(at[k])
            fits = min(k + size - len(kept[4]), int(np.searchsorted(at, kept[1] + timeout_us, side="right")))
            kept[4] += items[k:fits]
            k = fits
            if len(kept[4]) == size:
                yield alert(key, kept, int(at[k - 1]))
            elif k < len(at):
                yield alert(key, kept, kept[1] + timeout_us)

    def close(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[tuple]:
        held = {key: [batch, first, last, held_back, list(items)] for key, batch, first, last, held_back, items
                in zip(*state.get)} if state.exists else {}
        if not state.hasTimedOut:
            parts = list(rows)
            at, seq, keys, items = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("at_us", "seq", "key", "item"))
            codes, names = pd.factorize(keys, use_na_sentinel=False)
            order = np.lexsort((seq, at, codes))
            at, items, codes = at[order], items[order], codes[order]
            begins = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for a, b in zip(begins, begins[1:]):
                name = names[codes[a]]
                key = name if isinstance(name, str) else None
                yield from add(key, held.setdefault(key, [0, 0, None, 0, []]), at[a:b], items[a:b].tolist())
        watermark = state.getCurrentWatermarkMs()
        for key, kept in held.items():
            if kept[4] and timer(kept[1]) < watermark:
                yield alert(key, kept, kept[1] + timeout_us)
        state.update((list(held), *(list(column) for column in zip(*held.values()))))
        timers = [timer(kept[1]) for kept in held.values() if kept[4]]
        if timers:
            state.setTimeoutTimestamp(min(timers))

    def run(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        closed = close(bucket, rows, state)
        while some := list(islice(closed, _ALERTS_A_FRAME)):
            yield pd.DataFrame(dict(zip(_COLUMNS, map(list, zip(*some)))))

    return run


_COLUMNS = ("key", "batch", "n", "first_us", "close_us", "items", "allowed", "suppressed")


def acting_alerts(
    df: DataFrame, key: str, ts: str, seq: str, columns: Sequence[str], size: int, timeout_us: int,
    period_us: int | None = None, lateness: str = "0 seconds", buckets: int = 4096,
) -> DataFrame:
    """Alert batches per key in append mode, each with its rows: ``key``, ``batch``, ``n``, ``first_ts``, ``close_ts``, ``items``
    (a struct of ``columns`` for each row, in order), ``allowed`` and ``suppressed``.

    With ``period_us`` only the first batch to close in each period of that length is allowed; it tells how many were held back
    before it. An array is at most ``size`` long. Rows must come in event-time order across micro-batches.

    The state is kept for ``buckets`` of keys, as Python is called once for each group with new rows, at some milliseconds. What is kept of
    a bucket is written anew when one of its keys has rows, and a bucket's rows of a micro-batch are put in order in
    memory: choose the number for the keys and rows that will come. A started stream keeps it.
    """
    fields = {f.name: f for f in df.schema}
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("first_us", T.LongType()), T.StructField("close_us", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("allowed", T.BooleanType()),
        T.StructField("suppressed", T.LongType()),
    ])
    # keys travel as text: a null among numbers would turn all of a batch into floating-point ones
    narrow = df.withWatermark(ts, lateness).select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket"), F.col(key).cast("string").alias("key"), F.col(ts), F.unix_micros(F.col(ts).cast("timestamp")).alias("at_us"),
        F.coalesce(F.col(seq).cast("long"), F.lit(0)).alias("seq"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("item"),
    )
    # state travels with the rows, many groups in an Arrow batch: processors with handles ask the JVM several times for each group
    alerts = narrow.groupBy("bucket").applyInPandasWithState(
        _acting_batches(size, timeout_us, period_us), schema, _OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    item = T.StructType([fields[c] for c in columns])
    return alerts.select(
        F.col("key").cast(fields[key].dataType).alias("key"), "batch", "n", F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("close_us").alias("close_ts"), F.transform("items", lambda i: F.from_json(i, item)).alias("items"),
        "allowed", "suppressed")


def payload_of(items: Column | str, cluster: str, node: str) -> Column:
    """The alert's JSON text: cluster -> sorted list of its nodes, as ``operators.alerts.alert_payload`` makes it; rows without
    a cluster are listed under the empty name."""
    items = F.col(items) if isinstance(items, str) else items
    pairs = F.transform(items, lambda i: F.struct(F.coalesce(i[cluster].cast("string"), F.lit("")).alias("c"), i[node].cast("string").alias("n")))
    clusters = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["c"])))

    def nodes(c: Column) -> Column:
        return F.array_sort(F.transform(F.filter(pairs, lambda p: p["c"] == c), lambda p: p["n"]))

    entries = F.transform(clusters, lambda c: F.struct(c.alias("key"), nodes(c).alias("value")))
    return F.to_json(F.struct(F.map_from_entries(entries).alias("cluster_offline_nodes")))


Action = Callable[[str, str], None]
_DONE = T.StructType([T.StructField("alert", T.StringType())])


def act_once(ledger: str, identity: Column, payload: Column, action: Action,
             store: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` that calls ``action(identity, payload)`` for each allowed alert, in the tasks that hold them.

    The alerts of a micro-batch are written below ``ledger`` as they are called, in a folder named by the batch
    number that Spark commits as a whole. A replayed batch whose folder is complete calls nothing. If tasks fail
    on the way the batch is called again, so ``action`` gets the alert's identity to tell a repeat by. ``store`` is
    given each batch before, for targets that take all alerts.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, done = batch.sparkSession, f"{ledger}/batch_id={batch_id}"
        if store is not None:
            store(batch, batch_id)
        if exists(spark, f"{done}/_SUCCESS"):
            return

        def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    action(name, text)
                yield part.select([0])

        allowed = batch.where("allowed").select(identity.alias("alert"), payload.alias("payload"))
        allowed.mapInArrow(call, _DONE).write.mode("overwrite").parquet(done)

    return on_batch
