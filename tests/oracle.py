"""Compare a query with its SQL in DuckDB: column names, types, row count and all values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(table: pa.Table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    table = table.select(names)
    types = [str(t).replace("large_", "").replace("string_view", "string") for t in table.schema.types]
    rows = list(zip(*[c.to_pylist() for c in table.columns]))
    return names, types, sorted(rows, key=repr)


def difference(spark_rows: pa.Table, sql_rows: pa.Table) -> str | None:
    left, right = _plain(spark_rows), _plain(sql_rows)
    for what, a, b in zip(("columns", "types"), left[:2], right[:2]):
        if a != b:
            return f"{what}: {a} != {b}"
    if len(left[2]) != len(right[2]):
        return f"rows: {len(left[2])} != {len(right[2])}"
    wrong = [(a, b) for a, b in zip(left[2], right[2]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def check(spark, name: str, sf_dir: str) -> str | None:
    from tidemark.plans import ORACLES, QUERIES

    got = QUERIES[name](spark, sf_dir).toArrow()
    if name not in ORACLES:
        return None
    sql = ORACLES[name].replace("/root/testdata/sf0.01/", f"{sf_dir}/")
    return difference(got, connect(sf_dir).execute(sql).to_arrow_table())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tidemark import build_session
    from tidemark.plans import QUERIES

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        begin = time.perf_counter()
        try:
            wrong = check(spark, name, sf_dir)
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        failed += wrong is not None
        print(f"{'FAIL' if wrong else 'ok  '} {time.perf_counter() - begin:6.2f}s {name} {wrong or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
