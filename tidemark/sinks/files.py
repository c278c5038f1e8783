"""Exports: delimited text, NDJSON with a description, Parquet, ORC, SQL text, split files, copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.json import json_encode


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",",
              compression: str = "none", rows_per_file: int = 0) -> None:
    """Delimited text of one line for each row, so that any file can be split.

    Text fields are quoted where they need it, quotes in them doubled; backslashes, line breaks and carriage
    returns are written as backslash escapes. NULL is ``\\N``, the empty text a pair of quotes.
    ``read_csv(..., escapes=True)`` undoes all of it.
    """
    escaped = {f.name: escape_breaks(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    df.select([escaped.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]).write.options(
        header=str(header).lower(), sep=sep, compression=compression, escape='"', emptyValue='""', nullValue="\\N",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        maxRecordsPerFile=str(rows_per_file),
    ).csv(path)


def escape_breaks(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    write_csv(df, path, header, "\t")


def write_ndjson(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.options(
        compression=compression, ignoreNullFields="false",
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS", timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
    ).json(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """The rows as NDJSON under ``data``, and their schema and count as one row under ``meta``."""
    write_ndjson(df, f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).json(f"{path}/data")
    meta = written.agg(F.count("*").alias("rows")).select(
        F.lit(df.schema.json()).alias("schema"), "rows"
    )
    meta.write.json(f"{path}/meta")


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", rows_per_file: int = 0) -> None:
    df.write.options(compression=compression, maxRecordsPerFile=str(rows_per_file)).parquet(path)


def write_orc(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.option("compression", compression).orc(path)


def discard(df: DataFrame) -> None:
    """Run a query and throw its rows away."""
    df.write.format("noop").mode("overwrite").save()


def sql_literal(value: Column, dtype: T.DataType) -> Column:
    """SQL text that gives the value again, NULL included, whatever its type; backslashes escape in it."""

    def quoted(text: Column) -> Column:
        for plain, escaped in (("\\", "\\\\"), ("'", "''"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(plain), F.lit(escaped))
        return F.concat(F.lit("'"), text, F.lit("'"))

    text = value.cast("string") if not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) else None
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda x: sql_literal(x, dtype.elementType))
        literal = F.concat(F.lit("array("), F.array_join(inner, ", "), F.lit(")"))
    elif isinstance(dtype, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat_ws(
            ", ", sql_literal(e["key"], dtype.keyType), sql_literal(e["value"], dtype.valueType)))
        literal = F.concat(F.lit("map("), F.array_join(pairs, ", "), F.lit(")"))
    elif isinstance(dtype, T.StructType):
        parts = [F.concat(F.lit(f"'{f.name}', "), sql_literal(value[f.name], f.dataType)) for f in dtype]
        literal = F.when(value.isNotNull(), F.concat(F.lit("named_struct("), F.concat_ws(", ", *parts), F.lit(")")))
    elif isinstance(dtype, T.BinaryType):
        literal = F.concat(F.lit("X'"), F.hex(value), F.lit("'"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        special = F.isnan(value) | (F.abs(value) == float("inf"))
        literal = F.when(special, F.concat(F.lit("CAST('"), text, F.lit(f"' AS {dtype.simpleString()})"))).otherwise(text)
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        literal = text
    else:
        literal = quoted(text)
    return F.coalesce(literal, F.lit("NULL"))


def sql_inserts(df: DataFrame, table: str) -> DataFrame:
    """One replayable INSERT statement per row."""
    values = F.concat_ws(", ", *[sql_literal(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("statement"))


def reconcile(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Row count and order-free content hash of both sides, and whether they agree."""

    def summary(df: DataFrame, prefix: str) -> DataFrame:
        digest = F.xxhash64(json_encode(*sorted(df.columns)))
        return df.agg(
            F.count("*").alias(f"{prefix}_rows"),
            F.sum(digest.cast("decimal(38,0)")).alias(f"_{prefix}_hash"),
        ).withColumn("_one", F.lit(1))

    both = summary(source, "source").join(summary(copy, "copy"), "_one")
    same = F.col("_source_hash").eqNullSafe(F.col("_copy_hash"))
    return both.select(
        "source_rows", "copy_rows", (same & (F.col("source_rows") == F.col("copy_rows"))).alias("same")
    )
