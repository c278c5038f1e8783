"""Row-wise Arrow work, objects that stay with a Python worker, and bounded samples."""

from __future__ import annotations

import heapq
import pickle
import sys
import types
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

Work = Callable[..., Sequence[pa.Array]]


def map_rows(df: DataFrame, reads: Sequence[str], adds: Sequence[StructField], start: Callable[[], Work],
             keep: Sequence[str] | None = None, store: str | None = None) -> DataFrame:
    """Append the columns ``adds``, computed from the columns ``reads`` batch by batch.

    ``start`` runs once per task and returns the function from Arrow arrays to Arrow arrays. ``keep``
    names the input columns that stay (all by default); one that has the name of an added column is
    replaced by it. ``store`` names the ``worker_store`` that ``start`` uses, if any; others are emptied.
    """
    added = {field.name.lower() for field in adds}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in added]
    taken = list(dict.fromkeys([*kept, *reads]))
    places, inputs = list(range(len(kept))), [taken.index(c) for c in reads]
    names = [*kept, *(field.name for field in adds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if store is None:
            forget_stores()
        work = start()
        for batch in batches:
            made = work(*[batch.column(i) for i in inputs])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *made], names=names)
            del batch, made
        # what Arrow holds back for reuse counts as this worker's memory while other operators run
        pa.default_memory_pool().release_unused()

    schema = StructType([*(df.schema[c] for c in kept), *adds])
    return df.select(*[F.col(f"`{c}`") for c in taken]).mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """The column's texts; null reads as the empty text."""
    return ["" if text is None else text for text in column.to_pylist()]


def ship(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a model, of a size that does not grow with the data; call the result inside a task to get it.

    The value is pickled with its classes, so that executors need no copy of the package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def forget_stores(but: str | None = None) -> None:
    """Drop what earlier operators keep in this Python worker, but for the one named."""
    for key in [k for k in sys.modules if k.startswith("_tidemark_worker_") and k != but]:
        del sys.modules[key]


def worker_store(name: str) -> dict[str, Any]:
    """A dictionary that lives as long as the Python worker, over all tasks it runs.

    Task functions are pickled by value, so their own globals end with the task; a module entry does not. A
    worker serves many operators in turn: it keeps the dictionary of one at a time, so what an earlier one left is freed.
    """
    key = f"_tidemark_worker_{name}"
    forget_stores(key)
    if key not in sys.modules:
        module = types.ModuleType(key)
        module.store = {}
        sys.modules[key] = module
    return sys.modules[key].store


class Recent(dict):
    """A cache of bounded size in two generations: when the young one is full, the old one goes.

    Use it through ``get``; a hit in the old generation is carried over to the young one.
    """

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.old = most, {}

    def find(self, key):
        value = self.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self[key] = value
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value


def crc_bucket(column: str, parts: int) -> Column:
    """crc32 of the value's decimal text modulo ``parts``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def unit_hash(*columns: str) -> Column:
    """A value in [0, 1) that depends on the columns alone."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def sample_by_class(df: DataFrame, keys: Sequence[str], label: str, per_class: int, order: str = "order") -> DataFrame:
    """About ``per_class`` different rows of each value of ``label`` (null left out), chosen by a hash of ``keys``, which
    is appended as ``order``. Rows equal in ``keys`` and label have one hash and are all there: count them once
    with ``first_by_class``.
    """
    rows = df.where(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.approx_count_distinct(F.xxhash64(*keys), 0.02)).collect()}
    if not counts:
        return rows.limit(0).withColumn(order, F.lit(0).cast("long"))
    # a tenth more than asked for, as the counts are approximate
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, 1.1 * per_class / max(n, 1))])
    return rows.where(unit_hash(*keys) < share[F.col(label)]).withColumn(
        order, F.xxhash64(*keys).bitwiseAND(F.lit((1 << 52) - 1)))


def first_by_class(df: DataFrame, label: str, per_class: int, order: str = "order") -> DataFrame:
    """One row of each ``order`` of a label, and of these the first ``per_class``; cut down before the shuffle, too."""
    rest = [c for c in df.columns if c not in (label, order)]
    once = df.groupBy(label, order).agg(*[F.first(c).alias(c) for c in rest])
    place = F.row_number().over(Window.partitionBy(label).orderBy(order))
    return once.withColumn("_place", place).where(F.col("_place") <= per_class).select(df.columns)


class First:
    """Which of the orders met so far belong to the first ``most`` different ones."""

    def __init__(self, most: int) -> None:
        self.most, self.heap, self.held = most, [], set()

    def add(self, order: int) -> tuple[bool, int | None]:
        """Whether ``order`` is new and one of the first; and the order it drives out, if any."""
        if order in self.held or len(self.heap) == self.most and order > -self.heap[0]:
            return False, None
        self.held.add(order)
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, -order)
            return True, None
        out = -heapq.heapreplace(self.heap, -order)
        self.held.remove(out)
        return True, out
