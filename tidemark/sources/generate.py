"""Row generators: bounded from ``range``, unbounded from the ``rate`` source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def numbers(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(count).withColumnRenamed("id", "number")


def rand64(seed: int, of: Column | str = "id") -> Column:
    """A reproducible non-negative random number per row."""
    return F.xxhash64(F.col(of) if isinstance(of, str) else of, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def generate_rows(spark: SparkSession, count: int, columns: Mapping[str, Column]) -> DataFrame:
    """``count`` rows of column expressions over the row number ``id``."""
    return spark.range(count).select(*[e.alias(n) for n, e in columns.items()])


def generate_stream(spark: SparkSession, eps: int, columns: Mapping[str, Column]) -> DataFrame:
    """The same expressions at ``eps`` rows a second; ``event_time`` is the rate source's time."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", eps).load()
    return rate.select(
        F.col("value").alias("id"), F.col("timestamp").alias("event_time")
    ).select(*[e.alias(n) for n, e in columns.items()], "event_time")


def device_columns() -> dict[str, Column]:
    """Device metrics: device, region, position, temperature."""
    return {
        "device": F.concat(F.lit("dev_"), (rand64(1) % 1000).cast("string")),
        "region": F.concat(F.lit("region_"), (rand64(2) % 100).cast("string")),
        "lat": (rand64(3) % (1 << 32) / 300).cast("float"),
        "lon": (rand64(4) % (1 << 32) / 200).cast("float"),
        "temperature": (rand64(5) % (1 << 32) / 100).cast("float"),
    }


def transaction_columns(parties: int = 1_000_000) -> dict[str, Column]:
    return {
        "id": F.concat(F.lit("id_"), rand64(1).cast("string")),
        "from_id": F.concat(F.lit("from_id_"), (rand64(2) % parties).cast("string")),
        "to_id": F.concat(F.lit("to_id_"), (rand64(3) % parties).cast("string")),
        "value": rand64(4),
        "status": rand64(5).cast("string"),
        "block_id": rand64(6),
    }


def wide_columns(width: int, modulo: int) -> dict[str, Column]:
    """An id, a name and ``width`` text columns d1..dN, all from the row number."""
    key = (F.col("id") % modulo).cast("string")
    wide = {
        f"d{i}": F.concat(F.lit(f"d{i}_"), (F.col("id") * i % modulo).cast("string"))
        for i in range(1, width + 1)
    }
    return {"id": F.concat(F.lit("pid_"), key), "name": F.concat(F.lit("p"), key), **wide}
