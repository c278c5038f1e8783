"""Scalar expressions: text extraction, time, sizes, sharding, nulls. All run in the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: record header time as it appears in log lines.
LOG_TIME_PATTERN = r"^(\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}:\d{2}\.\d+)"

# Unit names of readable sizes.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def extract(text: Column | str, pattern: str) -> Column:
    """First capture group of ``pattern``, '' when it does not match."""
    return F.regexp_extract(_col(text), pattern, 1)


def to_number(text: Column | str) -> Column:
    """Text to 64-bit integer; text that is no number gives NULL."""
    return _col(text).try_cast("bigint")


def to_time(text: Column | str) -> Column:
    """Text to time without zone, the date written with dots or dashes; other text gives NULL."""
    dashed = F.regexp_replace(_col(text), r"^(\d{4})\.(\d{2})\.(\d{2}) ", "$1-$2-$3 ")
    return dashed.try_cast("timestamp_ntz")


def contains_text(text: Column | str, part: str) -> Column:
    return F.contains(_col(text), F.lit(part))


def date_diff_ms(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MILLISECOND", _col(start), _col(end))


def start_of_hour(ts: Column | str) -> Column:
    return F.date_trunc("HOUR", _col(ts)).cast("timestamp_ntz")


def readable_size(size: Column | str) -> Column:
    """Bytes as text with two decimals and a 1024-based unit."""
    value = _col(size).cast("double")
    text = F.format_string("%.2f %s", value / F.lit(float(1024 ** (len(SIZE_UNITS) - 1))),
                           F.lit(SIZE_UNITS[-1]))
    for power in range(len(SIZE_UNITS) - 2, -1, -1):
        scaled = F.format_string("%.2f %s", value / F.lit(float(1024**power)), F.lit(SIZE_UNITS[power]))
        text = F.when(value < F.lit(float(1024 ** (power + 1))), scaled).otherwise(text)
    return F.when(value.isNotNull(), text)


def product_as_double(*factors: Column | str) -> Column:
    """Product of whole numbers, rounded once to a double; of any size, where 64 bits would overflow.

    It is exact up to 38 digits before it is rounded; a longer one is a product of doubles.
    """
    exact, rough = (reduce(multiply, (_col(f).cast(kind) for f in factors))
                    for multiply, kind in ((F.try_multiply, "decimal(38,0)"), (mul, "double")))
    return F.coalesce(exact.cast("double"), rough)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded quotient; NULL when the divisor is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def shard_of(key: Column | str, shards: int) -> Column:
    """Shard number of a key, stable across runs."""
    return F.pmod(F.xxhash64(_col(key)), F.lit(shards))


def map_literal(entries: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def job_label(name: str) -> Column:
    """The tag a job puts on its output rows."""
    return F.lit(name)


def is_bot(agent: Column | str) -> Column:
    return F.contains(F.lower(_col(agent)), F.lit("bot"))


# NULL-tolerant arithmetic: NULL only when every argument is NULL.


def null_plus(left: Column, right: Column) -> Column:
    return F.coalesce(left + right, left, right)


def null_minus(left: Column, right: Column) -> Column:
    return F.coalesce(left - right, left, -right)


def null_least(*values: Column) -> Column:
    return F.least(*values)  # skips NULLs


def null_greatest(*values: Column) -> Column:
    return F.greatest(*values)  # skips NULLs


def nullable_add(left: Column, right: Column) -> Column:
    return null_plus(left, right)


# Names of the SQL functions for use in query text.
SQL_FUNCTIONS = {
    "null_plus": (2, "coalesce(a + b, a, b)"), "null_minus": (2, "coalesce(a - b, a, -b)"),
    "null_least": (2, "least(a, b)"), "null_greatest": (2, "greatest(a, b)"),
    "null_least3": (3, "least(a, b, c)"), "null_greatest3": (3, "greatest(a, b, c)"),
}


def register_sql_functions(spark: SparkSession, dtype: str = "DOUBLE", suffix: str = "") -> None:
    """Register the NULL-tolerant functions for one type, under their names and ``suffix``.

    SQL functions have typed parameters: register them once for each type that query text needs, such as
    ``register_sql_functions(spark, "BIGINT", "_long")``. The Column forms above take any type.
    """
    numeric = dtype.upper().partition("(")[0] not in ("STRING", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "BINARY", "BOOLEAN")
    for name, (count, body) in SQL_FUNCTIONS.items():
        if numeric or "least" in name or "greatest" in name:  # least and greatest compare any type
            parameters = ", ".join(f"{p} {dtype}" for p in "abc"[:count])
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{suffix}({parameters}) RETURNS {dtype} RETURN {body}")


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill declared columns: add the missing ones, replace NULLs in the present ones."""
    return df.withColumns(
        {n: F.coalesce(df[n], e) if n in df.columns else e for n, e in defaults.items()}
    )
