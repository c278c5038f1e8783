"""Kafka options and message columns. The option builders are plain functions; the connector itself
comes with Spark's Kafka package."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def merge_profile(profile: Mapping[str, str], inline: Mapping[str, str]) -> dict[str, str]:
    """Options of a named connection profile; inline options win."""
    return {**profile, **inline}


def parse_properties(text: str) -> dict[str, str]:
    """``a=1;b=2`` as client options, which Spark passes through under ``kafka.``."""
    pairs = (p.split("=", 1) for p in text.split(";") if p.strip())
    return {f"kafka.{k.strip()}": v.strip() for k, v in pairs}


def source_options(
    brokers: str,
    topic: str,
    start: str = "latest",
    partitions: Sequence[int] | None = None,
    properties: str = "",
    security: Mapping[str, str] | None = None,
    headers: bool = False,
    max_offsets: int | None = None,
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": brokers, "startingOffsets": start}
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: list(partitions)})
    if headers:
        options["includeHeaders"] = "true"
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    options.update(parse_properties(properties))
    options.update({f"kafka.{k}": v for k, v in (security or {}).items()})
    return options


def sink_options(
    brokers: str, topic: str | None = None, properties: str = "",
    security: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": brokers}
    if topic is not None:
        options["topic"] = topic
    options.update(parse_properties(properties))
    options.update({f"kafka.{k}": v for k, v in (security or {}).items()})
    return options


def parse_partitions(text: str) -> list[int]:
    """``0..3,7`` as a list of partition numbers."""
    out: list[int] = []
    for part in text.split(","):
        low, _, high = part.partition("..")
        out.extend(range(int(low), int(high or low) + 1))
    return out


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The bounded history of a topic."""
    bounded = {"startingOffsets": "earliest", **options}
    if bounded["startingOffsets"] == "latest":
        bounded["startingOffsets"] = "earliest"
    return spark.read.format("kafka").options(**bounded).load()


def raw_text(messages: DataFrame) -> DataFrame:
    """One text column per message."""
    return messages.select(F.col("value").cast("string").alias("raw"))


def message_meta(messages: DataFrame) -> DataFrame:
    """Add ``message_key``, ``message_headers``, ``event_time``, ``shard`` from Kafka columns.

    Of a repeated header key the last value counts.
    """
    last = F.expr(
        "map_from_entries(transform(filter(headers, (h, i) -> "
        "NOT exists(slice(headers, i + 2, size(headers)), g -> g.key = h.key)), "
        "h -> struct(h.key, cast(h.value AS string))))"
    )
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        last.alias("message_headers"),
        F.col("timestamp").alias("event_time"),
        F.col("partition").alias("shard"),
        F.col("value"),
    )


def shard_subset(df: DataFrame, key: str, shards: int, wanted: Sequence[int]) -> DataFrame:
    """The part of a table one of several jobs reads, by key modulo."""
    return df.where(F.pmod(F.col(key), F.lit(shards)).isin(*wanted))
