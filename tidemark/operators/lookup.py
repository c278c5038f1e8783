"""Lookup joins. No side is forced to broadcast: Catalyst broadcasts a dimension whose size is
below its threshold (static or measured by AQE), a larger one is shuffled and AQE splits the
partitions of hot probe keys."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators.latest import latest_by_key
from tidemark.operators.ordered import hot_keys
from tidemark.session import discard, durable

BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 500_000  # of hot keys, which are a key wide


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take, by one aggregate over them: fixed widths, and texts measured."""
    wide = [f.name for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    other = [f.name for f in df.schema if f.dataType.simpleString().startswith(("array", "map", "struct", "variant"))]
    each = F.lit(16 * len(df.columns))
    for name in wide:
        each = each + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    for name in other:
        each = each + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))
    return df.agg(F.sum(each.cast("bigint"))).first()[0] or 0


def broadcast_if_small(dim: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the rows measure no more than ``most`` bytes; a larger frame gets no hint."""
    return F.broadcast(dim) if measured_bytes(dim) <= most else dim


def lookup_join(
    probe: DataFrame,
    dim: DataFrame,
    probe_key: str,
    dim_key: str,
    how: str = "inner",
    split_hot: int | None = None,
) -> DataFrame:
    """Join a stream or table with a dimension that has one row per key.

    Pass ``broadcast_if_small(dim)`` for a computed dimension whose size Catalyst cannot tell. For a
    dimension too large for that, ``split_hot`` names the rows from which a probe key counts as hot:
    such rows stay where they are and meet the few dimension rows of their keys by broadcast, and only
    the others are shuffled.
    """
    if split_hot is not None and not probe.isStreaming:
        hot = durable(hot_keys(probe.where(F.col(probe_key).isNotNull()), [probe_key], split_hot))
        hot = hot.select(F.col(probe_key).alias("_hot"))
        if 0 < hot.count() <= BROADCAST_ROWS:
            flags = F.broadcast(hot)
            marked = probe.join(flags, probe[probe_key] == flags["_hot"], "left")
            few = F.broadcast(dim.join(flags, dim[dim_key] == flags["_hot"], "left_semi"))
            often = marked.where("_hot IS NOT NULL").drop("_hot")
            seldom = marked.where("_hot IS NULL").drop("_hot")
            return lookup_join(often, few, probe_key, dim_key, how).unionByName(
                lookup_join(seldom, dim, probe_key, dim_key, how)
            )
    return probe.join(dim, probe[probe_key] == dim[dim_key], how)


def dict_get(
    probe: DataFrame, dim: DataFrame, probe_key: str, dim_key: str, column: str, name: str
) -> DataFrame:
    """Add one dimension column; NULL where the key is absent."""
    side = dim.select(F.col(dim_key).alias("_k"), F.col(column).alias(name))
    return probe.join(side, probe[probe_key] == side["_k"], "left").drop("_k")


def keyed_lookup(
    probe: DataFrame,
    versions: DataFrame,
    probe_key: str,
    key: str,
    order: Sequence[str],
) -> DataFrame:
    """Lookup in a keyed table given by its row versions."""
    return lookup_join(probe, latest_by_key(versions, [key], order), probe_key, key)


def two_tier_lookup(
    probe: DataFrame,
    cache: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    probe_key: str,
    key: str,
) -> DataFrame:
    """Lookup in ``cache`` first; only the keys it lacks are asked of ``fetch``.

    ``fetch`` gets a one-column frame of distinct missing keys and returns the rows of the remote
    table for them. The dimension rows of both tiers are put together before the probe, which is
    therefore read through one join.
    """
    wanted = probe.select(F.col(probe_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    missing = wanted.join(cache.select(key), key, "left_anti")
    both = cache.unionByName(fetch(missing).select(*cache.columns))
    return lookup_join(probe, both, probe_key, key)


def fetch_from_table(table: DataFrame, key: str) -> Callable[[DataFrame], DataFrame]:
    """Fetch by semi-join: the remote side filters itself to the missing keys."""
    return lambda missing: table.join(missing, key, "left_semi")


def fetch_in_tasks(
    ask: Callable[[list], pd.DataFrame], schema: str, keys_per_call: int = 1000
) -> Callable[[DataFrame], DataFrame]:
    """Ask a remote store for the missing keys from within the tasks, ``keys_per_call`` at a time.

    No key comes to the driver, and the way is the same for any number of keys. ``ask`` gets a list of
    distinct keys and returns the rows it has for them, with the columns of ``schema`` and any others; it is pickled, so it opens
    its connection itself. A key is asked for by one task; a task that is run again asks again. Returned rows of keys that were not asked for
    are the caller's error and would be joined as well.
    """

    def fetch(missing: DataFrame) -> DataFrame:
        names = T.StructType.fromDDL(schema).names

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keys = batch.iloc[:, 0].tolist()
                for begin in range(0, len(keys), keys_per_call):
                    yield ask(keys[begin:begin + keys_per_call])[names]

        return missing.mapInPandas(work, schema)

    return fetch


def sql_key(value: object) -> str | None:
    """A key as SQL text that any dialect reads the same; None where there is no such text."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'" if value.tzinfo is None else None
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str) and "\\" not in value and "\0" not in value:
        return "'" + value.replace("'", "''") + "'"
    return None


def fetch_by_key_list(
    read: Callable[[str], DataFrame], key: str, fallback: DataFrame, most: int = 1000
) -> Callable[[DataFrame], DataFrame]:
    """Push a short list of missing keys into the remote query; past ``most`` keys, semi-join.

    ``read`` takes a SQL predicate. At most ``most`` + 1 keys come to the driver. Keys that have no
    literal of one meaning in every dialect (doubles, binary, times with a zone, texts with a backslash)
    go by the semi-join as well, so both ways give the same rows.
    """

    def fetch(missing: DataFrame) -> DataFrame:
        keys = [row[0] for row in missing.limit(most + 1).collect()]
        texts = [sql_key(k) for k in keys]
        if len(keys) > most or None in texts:
            return fallback.join(missing, key, "left_semi")
        if not keys:
            return fallback.limit(0)
        return read(f"{key} IN ({', '.join(texts)})")

    return fetch


class RefreshingLookup:
    """A dimension for ``foreachBatch`` jobs, reloaded when older than ``lifetime`` seconds.

    It is held in the shared folder; a reload removes the one before. ``lifetime=None`` never reloads.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        lifetime: float | None,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load, self._lifetime, self._clock = load, lifetime, clock
        self._frame: DataFrame | None = None
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        age = self._clock() - self._loaded_at
        if self._frame is None or (self._lifetime is not None and age >= self._lifetime):
            before, self._frame = self._frame, durable(self._load())
            if before is not None:
                discard(before.sparkSession, [before])
            self._loaded_at = self._clock()
        return self._frame
