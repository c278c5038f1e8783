"""Rows as messages: JSON values, keys, headers, partitions, request bodies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.json import json_encode
from tidemark.functions.scalars import map_literal, shard_of


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON message per row, in the ``value`` column a topic sink expects."""
    return df.select(json_encode(*df.columns).alias("value"))


def message_frame(
    df: DataFrame,
    key: str,
    headers: Mapping[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``key``, ``value`` and, when asked for, ``headers`` and a forced ``partition``.

    Without ``partitions`` the producer chooses the partition from the key.
    """
    columns: list[Column] = [
        F.col(key).cast("string").alias("key"), json_encode(*df.columns).alias("value")
    ]
    if headers:
        entries = F.transform(
            F.map_entries(map_literal(headers)),
            lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
        )
        columns.append(entries.alias("headers"))
    if partitions is not None:
        columns.append(shard_of(key, partitions).cast("int").alias("partition"))
    return df.select(*columns)


def rest_bodies(df: DataFrame, batch: Column, order: str, columns: list[str]) -> DataFrame:
    """One request body ``{"columns": [...], "data": [[...], ...]}`` per batch number.

    ``batch`` must bound the rows of a body, as a sequence number divided by the batch size does.
    """
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), cells.alias("cells"))))
    data = F.transform(rows, lambda r: r["cells"]).alias("data")
    names = F.array(*[F.lit(c) for c in columns]).alias("columns")
    return df.groupBy(batch.alias("batch")).agg(F.to_json(F.struct(names, data)).alias("body"))
