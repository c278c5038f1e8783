"""Remote tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options; with a partition column the scan is split into range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str], one_task: bool = False) -> DataFrame:
    """The remote schema is taken as is; filters and column lists are pushed into the query.

    Without a partition column and its bounds the whole table is read by one task; that has to be asked for.
    """
    if "partitionColumn" not in options and not one_task:
        raise ValueError("give a partition column with bounds, or one_task=True for a table known to be small")
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()
