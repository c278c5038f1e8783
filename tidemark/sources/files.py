"""File formats: delimited text, NDJSON, Parquet, ORC, Arrow, lines; error budgets on import."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.sources.paths import exists, move, remove

CORRUPT = "_corrupt_record"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]"


class TooManyBadRows(RuntimeError):
    pass


def _text_options(header: bool, sep: str) -> dict[str, str]:
    return {
        "header": str(header).lower(), "sep": sep, "mode": "PERMISSIVE", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": TIMESTAMP_FORMAT, "timestampFormat": TIMESTAMP_FORMAT,
    }


def unescape_breaks(text: Column) -> Column:
    """Undo the backslash escapes of ``write_csv``; a pair of backslashes is set aside while the rest is undone."""
    mark = "\x00"
    text = F.replace(text, F.lit("\\\\"), F.lit(mark))
    text = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(text, F.lit(mark), F.lit("\\"))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False,
             sep: str = ",", escapes: bool = False, multiline: bool = False) -> DataFrame:
    """Delimited text. ``escapes`` undoes the backslash escapes and NULL marks of ``write_csv``; ``multiline`` takes line
    breaks within quotes from other writers, at the price of one task for each file."""
    reader = spark.read.schema(schema).options(**_text_options(header, sep), multiLine=str(multiline).lower())
    if not escapes:
        return reader.csv(path)
    rows = reader.options(nullValue="\\N", emptyValue="").csv(path)
    return rows.select([unescape_breaks(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                        else F.col(f"`{f.name}`") for f in rows.schema])


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType,
             header: bool = False, escapes: bool = False) -> DataFrame:
    return read_csv(spark, path, schema, header, "\t", escapes)


def read_ndjson(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(
        timestampNTZFormat=TIMESTAMP_FORMAT, timestampFormat=TIMESTAMP_FORMAT
    ).json(path)


def read_lines(spark: SparkSession, path: str, name: str = "raw") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", name)


def read_values(spark: SparkSession, columns: str, rows: str) -> DataFrame:
    """Inline rows: ``columns`` as in a table alias, ``rows`` as in VALUES."""
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def error_budget(
    parsed: DataFrame, most: int | None = None, ratio: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows read with ``with_corrupt`` into good and bad; raise when there are too many bad.

    The rows are counted once before the split is handed out.
    """
    # a row is known to be bad only when all its columns are parsed, so ask for all of them
    cells = [F.col(c).cast("string") for c in parsed.columns if c != CORRUPT]
    all_parsed = F.length(F.concat_ws("", *cells)) >= 0
    bad = F.col(CORRUPT).isNotNull() & all_parsed
    if most is not None or ratio is not None:
        total, wrong = parsed.agg(F.count("*"), F.count_if(bad)).first()
        if most is not None and wrong > most:
            raise TooManyBadRows(f"{wrong} bad rows, {most} allowed")
        if ratio is not None and total and wrong / total > ratio:
            raise TooManyBadRows(f"{wrong} bad rows of {total}, ratio {ratio} allowed")
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad).select(CORRUPT)


def import_within_budget(parsed: DataFrame, target: str, rejects: str, most: int | None = None,
                         ratio: float | None = None) -> tuple[int, int]:
    """Write the good rows read with ``with_corrupt`` to ``target`` and the bad ones' text to ``rejects``, or neither.

    One pass: rows are written as they are counted, to a folder of its own beside the target, and moved into place only when
    the bad ones are within the budget. Otherwise the folder is removed and ``TooManyBadRows`` raised, and nothing is ever
    visible under either name. Gives the numbers of good and bad rows. Both folders must be new.
    """
    spark = parsed.sparkSession
    for path in (target, rejects):
        if exists(spark, path):
            raise FileExistsError(path)
    staging = f"{target.rstrip('/')}._importing-{uuid.uuid4().hex}"
    cells = [F.col(f"`{c}`").cast("string") for c in parsed.columns if c != CORRUPT]
    bad = F.col(CORRUPT).isNotNull() & (F.length(F.concat_ws("", *cells)) >= 0)
    seen = Observation()
    counted = parsed.withColumn("_bad", bad).observe(seen, F.count("*").alias("total"), F.count_if("_bad").alias("bad"))
    try:
        counted.write.partitionBy("_bad").parquet(staging)
        total, wrong = seen.get["total"], seen.get["bad"]
        if most is not None and wrong > most:
            raise TooManyBadRows(f"{wrong} bad rows, {most} allowed")
        if ratio is not None and total and wrong / total > ratio:
            raise TooManyBadRows(f"{wrong} bad rows of {total}, ratio {ratio} allowed")
        for flag, path in (("true", rejects), ("false", target)):
            if exists(spark, f"{staging}/_bad={flag}"):
                move(spark, f"{staging}/_bad={flag}", path)
    finally:
        remove(spark, staging)
    return total - wrong, wrong


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths and lengths of files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


MAX_TASKS = 100_000


def spread(work: DataFrame) -> DataFrame:
    """One task per row of a list of work, up to ``MAX_TASKS``.

    The rows are tiny, so the number of tasks is set here: AQE would put them all into one.
    """
    if work.isStreaming:
        return work.repartition(int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return work.repartition(min(max(work.count(), 1), MAX_TASKS))


def open_path(path: str):
    """File system and path inside it for a Spark file URI, to be used inside tasks."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def read_arrow(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Arrow IPC files; tasks share out the files and read them batch by batch."""
    names = schema.fieldNames()

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                system, inner = open_path(file)
                with system.open_input_file(inner) as source, pa.ipc.open_file(source) as reader:
                    for i in range(reader.num_record_batches):
                        yield reader.get_batch(i).select(names)

    files = list_files(spark, path)
    return spread(files).mapInArrow(load, schema)


def write_arrow(df: DataFrame, path: str) -> None:
    """One Arrow IPC file per task; a rerun task replaces its own file. What lies under the path goes first,
    so that a later write with fewer tasks leaves no older part behind."""
    from pyspark import TaskContext

    remove(df.sparkSession, path)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, inner = open_path(path)
        system.create_dir(inner, recursive=True)
        done, count, writer = f"{inner}/part-{part:05d}.arrow", 0, None
        attempt = f"{inner}/.part-{part:05d}-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            if writer is None:
                sink = system.open_output_stream(attempt)
                writer = pa.ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
            count += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
            if system.get_file_info(done).is_file:
                system.delete_file(done)
            system.move(attempt, done)
        yield pa.RecordBatch.from_pydict({"n": pa.array([count], pa.int64())})

    df.mapInArrow(store, "n BIGINT").agg(F.sum("n")).collect()


def footer_report(spark: SparkSession, path: str) -> DataFrame:
    """Column chunk sizes and row counts from Parquet footers, one task row per file and column."""
    out = "table STRING, column STRING, compressed BIGINT, uncompressed BIGINT, rows BIGINT, file STRING"

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        for batch in batches:
            for file in batch["path"]:
                system, inner = open_path(file)
                with system.open_input_file(inner) as source:
                    meta = pq.ParquetFile(source).metadata
                # foo.parquet, or a part file inside the folder foo.parquet
                parts = [p for p in file.split("/") if p.endswith(".parquet")]
                table = parts[0][: -len(".parquet")]
                rows: dict[str, list[int]] = {}
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        sums = rows.setdefault(chunk.path_in_schema, [0, 0, 0])
                        sums[0] += chunk.total_compressed_size
                        sums[1] += chunk.total_uncompressed_size
                        sums[2] += group.num_rows
                yield pd.DataFrame(
                    [(table, name, *sums, file) for name, sums in rows.items()],
                    columns=["table", "column", "compressed", "uncompressed", "rows", "file"],
                )

    files = list_files(spark, path).where(F.col("path").endswith(".parquet"))
    return spread(files).mapInPandas(footers, out)


def union_tagged(frames: dict[str, DataFrame], tag: str = "node") -> DataFrame:
    """UNION ALL with a literal tag per branch."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
