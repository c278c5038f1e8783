"""Log files as rows: records that may span lines, cut by a regular expression for their header.

Files are cut into byte ranges, and each task reads one range on its own: it starts at the first
header that begins in its range and reads on past the range's end until the next header. A record is
thus read by exactly one task, whole, and nothing is shuffled but the list of ranges. The same
function serves batch and stream, because Spark lists files the same way in both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalars import LOG_TIME_PATTERN, extract, to_time
from tidemark.sources.files import open_path, spread

# Fixed value: how a record begins.
RECORD_HEADER = r"\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}:\d{2}\.\d+ \[ \d+ \] \{"

RANGE_BYTES = 128 << 20
LONGEST_RECORD = 64 << 20  # a task holds one record as a whole
_BLOCK = 4 << 20
_ROWS = 4096
_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("raw", T.StringType())])


class RecordTooLong(ValueError):
    """A record, or a file without a header, that is longer than a task may hold."""


def _lines(source, start: int, longest: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) from the first line that begins at or after ``start``; a line of more than ``longest`` bytes raises."""
    offset = max(start - 1, 0)
    skip = start > 0  # the line in progress belongs to the range before
    if skip:
        source.seek(offset)
    parts: list[bytes] = []
    held = 0
    while block := source.read(_BLOCK):
        head, *others = block.split(b"\n")
        parts.append(head)
        held = held + len(head) if not others else len(others[-1])
        if held > longest:
            raise RecordTooLong(f"a line from byte {offset} on is longer than {longest} bytes")
        for following in others:
            line, parts = b"".join(parts), [following]
            if skip:
                skip = False
            else:
                yield offset, line
            offset += len(line) + 1
    if not skip and (line := b"".join(parts)):
        yield offset, line


def _records(source, start: int, end: int, header: re.Pattern[bytes], longest: int = LONGEST_RECORD,
             headless: bool | None = None) -> Iterator[str]:
    """Records whose header line begins in [start, end); the first range, or one told to, also takes a headless start.

    No range reads further behind its end than one record, and a record of more than ``longest`` bytes raises.
    """
    record: list[bytes] | None = [] if (start == 0 if headless is None else headless) else None
    size = 0
    for offset, line in _lines(source, start, longest):
        size = len(line) + 1 if record is None or header.match(line) else size + len(line) + 1
        if record is not None and size > longest:
            raise RecordTooLong(f"the record before byte {offset} is longer than {longest} bytes")
        if header.match(line):
            if record:
                yield b"\n".join(record).decode("utf-8", "replace")
            if offset >= end:
                return
            record = [line]
        elif record is not None:
            record.append(line)
        elif offset >= end:
            return  # the range lies inside one record
    if record:
        yield b"\n".join(record).decode("utf-8", "replace")


def log_records(
    files: DataFrame,
    header: str = RECORD_HEADER,
    range_bytes: int = RANGE_BYTES,
    longest: int = LONGEST_RECORD,
) -> DataFrame:
    """Rows (file, raw) from a frame with ``path`` and ``length`` of the log files.

    A task reads its range and at most ``longest`` bytes more. A longer record, or as much text without any header, raises
    ``RecordTooLong`` and does not fill a task. Compressed files (.gz, .zst, .bz2) cannot be cut and are read by one task each.
    """
    whole = F.col("path").rlike(r"\.(gz|zst|bz2)$")
    zero = F.lit(0).cast("long")
    starts = F.when(whole, F.array(zero)).otherwise(
        F.sequence(zero, F.col("length") - 1, F.lit(range_bytes).cast("long"))
    )
    ranges = files.where(F.col("length") > 0).select(
        "path", F.explode(starts).alias("start"), whole.alias("whole")
    )
    pattern = header.encode()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = re.compile(pattern)
        for batch in batches:
            for task in batch.to_pylist():
                system, inner = open_path(task["path"])
                end = float("inf") if task["whole"] else task["start"] + range_bytes
                opened = system.open_input_stream if task["whole"] else system.open_input_file
                with opened(inner) as source:
                    held: list[str] = []
                    for record in _records(source, task["start"], end, compiled, longest):
                        held.append(record)
                        if len(held) == _ROWS:
                            yield pa.RecordBatch.from_pydict(
                                {"file": [task["path"]] * len(held), "raw": held})
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pydict(
                            {"file": [task["path"]] * len(held), "raw": held})

    return spread(ranges).mapInArrow(read, _SCHEMA)


def log_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length")


def log_file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Closed log files as they appear; the stream carries file names, not contents."""
    reader = spark.readStream.format("binaryFile").schema(
        "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path", "length")


def with_log_columns(records: DataFrame, time_pattern: str = LOG_TIME_PATTERN) -> DataFrame:
    """Computed columns of a log row: ``event_time``, ``level``, ``message``."""
    return records.withColumns(
        {
            "event_time": to_time(extract("raw", time_pattern)),
            "level": extract("raw", r"\} <(\w+)>"),
            "message": extract("raw", r"(?s)\} <\w+> (.*)"),
        }
    )
