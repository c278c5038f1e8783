"""Web archives: pages written as WARC records with revisits, and archives read in byte ranges."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidemark.operators.lookup import broadcast_if_small, lookup_join
from tidemark.operators.ordered import null_safe_join
from tidemark.session import durable
from tidemark.sources.files import list_files, open_path, spread

REVISIT_FROM = 100  # bytes; smaller payloads are not worth a revisit
HOT_COPIES = 100_000  # rows of one payload from which they are kept out of the shuffle
RANGE_BYTES = 32 << 20
LONGEST_HEADER = 1 << 16
BATCH_BYTES = 4 << 20

# How records begin and end, and what a record of each kind declares.
MAGIC = b"WARC/1."
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]+)[ \t]*\r\n", re.IGNORECASE)


# -- writing ----------------------------------------------------------------------------------------

def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _header(lines: list[tuple[str, Column]]) -> Column:
    """Header lines; one whose value is null is left out."""
    named = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in lines]
    return F.concat(F.lit(f"{VERSION}\r\n"), *[F.coalesce(line, F.lit("")) for line in named], F.lit("\r\n"))


def write_archives(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write a record per row into the archives of a new folder ``path``.

    Of rows with equal payloads of at least ``REVISIT_FROM`` bytes the one with the smallest page is a response, the others
    are revisits that name it and carry no payload; all smaller ones are responses. Pages without an id come last in that
    order, equal pages are told apart by url, and of rows that are equal in all three one is the response. A null payload
    is empty, a null url is left out, line breaks in a url are percent-encoded, and other columns are ignored.

    Only what occurs more than once is joined back to the rows, a row for each payload: while that is small,
    by broadcast, and payloads are never shuffled; else by the digest, with the rows of often repeated payloads
    left where they are. Files are written by Spark's text writer, so a task that is run again leaves nothing twice.
    """
    rows = pages.select(
        F.col(page).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256))
    place = F.struct(F.col("page").isNull().alias("unnamed"), "page", "url")
    # counted per page first, so that copies of one page are few rows when the payload's first page is looked for
    copies = rows.where(F.col("bytes") >= REVISIT_FROM).select("digest", place.alias("at")).groupBy("digest", "at").count()
    firsts = durable(copies.groupBy("digest").agg(
        F.min("at").alias("first"), F.min_by("count", "at").alias("equal"), F.sum("count").alias("all"))
        .where(F.col("all") > 1).select(F.col("digest").alias("known"), "first", "equal"))
    joined = lookup_join(rows.withColumn("at", place), broadcast_if_small(firsts), "digest", "known", "left", HOT_COPIES)
    is_first = F.col("known").isNull() | F.col("at").eqNullSafe(F.col("first"))
    single = F.coalesce(F.col("equal"), F.lit(1)) == 1

    columns = ("page", "url", "payload", "bytes", "digest")
    responses = joined.where(is_first & single).select(*columns, F.lit("response").alias("type"), F.lit(None).cast("long").alias("of"))
    revisits = joined.where(~is_first).select(
        "page", "url", F.lit("").alias("payload"), "bytes", "digest", F.lit("revisit").alias("type"), F.col("first.page").alias("of"))
    # rows equal in page, url and payload: one of them is written whole, the others refer to it
    equal = joined.where(is_first & ~single).groupBy("page", "url", "bytes", "digest").agg(
        F.first("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
    again = equal.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    repeats = again.select(
        "page", "url", F.when(F.col("nth") == 1, F.col("payload")).otherwise(F.lit("")).alias("payload"), "bytes", "digest",
        F.when(F.col("nth") == 1, F.lit("response")).otherwise(F.lit("revisit")).alias("type"),
        F.when(F.col("nth") > 1, F.col("page")).alias("of"))

    revisit = F.col("type") == "revisit"
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = _header([
        ("WARC-Type", F.col("type")),
        ("WARC-Record-ID", _urn(F.col("page"))),
        ("WARC-Target-URI", address),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, _urn(F.col("of")))),
        # not in the standard: lets a revisit be weighed without its response
        ("X-Payload-Length", F.when(revisit, F.col("bytes").cast("string"))),
        ("Content-Length", F.octet_length("payload").cast("string")),
    ])
    written = responses.unionByName(revisits).unionByName(repeats).select(F.concat(header, F.col("payload")).alias("record"))
    written.write.option("lineSep", END).text(path)


# -- reading ----------------------------------------------------------------------------------------

CHAIN = StructType([StructField("file", StringType()), StructField("at", LongType()), StructField("leaves", LongType())])
RECORD = StructType([
    StructField("file", StringType()), StructField("offset", LongType()), StructField("type", StringType()),
    StructField("record_id", StringType()), StructField("url", StringType()), StructField("refers_to", StringType()),
    StructField("declared_digest", StringType()), StructField("declared_bytes", LongType()),
    StructField("bytes", LongType()), StructField("digest", StringType()), StructField("payload", BinaryType()),
])


class BrokenArchive(ValueError):
    """An archive whose records do not lead from its start to its end."""


def header_end(data: bytes, at: int) -> int:
    """Where the header that begins at ``at`` ends, or -1 if it is not one: no end in sight, or no length."""
    end = data.find(b"\r\n\r\n", at, at + LONGEST_HEADER)
    return end + 4 if end >= 0 and _LENGTH.search(data, at, end + 2) else -1


def candidates(data: bytes, base: int, upto: int) -> list[tuple[int, int]]:
    """(offset, successor) of whatever looks like a record that begins in the first ``upto`` bytes of ``data``, which
    lies at ``base``; pages that hold records in their payloads give candidates, too."""
    made = []
    for match in _START.finditer(data):
        at = match.start()
        if at >= upto:
            break
        body = header_end(data, at)
        if body >= 0:
            length = int(_LENGTH.search(data, at, body - 2)[1])
            made.append((base + at, base + body + length + len(END)))
    return made


def leaving(pairs: list[tuple[int, int]], end: int, size: int) -> list[tuple[int, int]]:
    """For each candidate of a range, where following successors leaves it; -1 where they lead to no record."""
    leaves: dict[int, int] = {}
    for at, after in reversed(pairs):
        if after < end and after < size:
            leaves[at] = leaves.get(after, -1)
        else:
            leaves[at] = after if after <= size else -1
    return list(leaves.items())


def byte_ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.where("length > 0").select(F.col("path").alias("file"), F.col("length").alias("size"), F.explode(starts).alias("start"))
    return ranges


def record_starts(spark: SparkSession, files: DataFrame, range_bytes: int, strict: bool) -> DataFrame:
    """The first true record of each byte range that has one: columns ``file`` and ``at``.

    Each task reads one range and names, for every candidate in it, the place beyond the range that its
    successors lead to. Which candidates are records is then found by pointer jumping from the start of
    each file: every turn doubles how many ranges a pointer spans, so a file of n ranges takes log n turns, over
    no more than the candidates that another range points to. Each turn is written to the shared folder.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for work in batch.to_pylist():
                file, start, size = work["file"], work["start"], work["size"]
                system, inner = open_path(file)
                with system.open_input_file(inner) as source:
                    source.seek(start)
                    data = source.read(range_bytes + LONGEST_HEADER)
                end = min(start + range_bytes, size)
                pairs = leaving(candidates(data, start, end - start), end, size)
                yield pa.RecordBatch.from_arrays([
                    pa.array([file] * len(pairs), pa.string()), pa.array([p[0] for p in pairs], pa.int64()),
                    pa.array([p[1] for p in pairs], pa.int64())], names=CHAIN.names)

    files = durable(files)
    chains = durable(spread(byte_ranges(files, range_bytes)).mapInArrow(scan, CHAIN))
    starts = files.where("length > 0").select(F.col("path").alias("file"), F.lit(0).cast("long").alias("at"))
    longest = files.agg(F.max("length")).first()[0] or 0
    ranges = math.ceil(longest / range_bytes)
    targets = chains.select("file", F.col("leaves").alias("at")).where("at >= 0").distinct()
    jumps = chains.join(targets.unionByName(starts).distinct(), ["file", "at"])
    reached = starts
    for _ in range((max(ranges, 1)).bit_length()):
        jumps = durable(jumps)
        ahead = jumps.join(reached, ["file", "at"]).select("file", F.col("leaves").alias("at")).where("at >= 0")
        reached = durable(reached.unionByName(ahead).distinct())
        second = jumps.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("further"))
        jumps = jumps.join(second, ["file", "leaves"]).select("file", "at", F.col("further").alias("leaves"))
    if strict:
        sizes = files.where("length > 0").select(F.col("path").alias("file"), F.col("length").alias("at"))
        broken = sizes.join(reached, ["file", "at"], "left_anti")
        first = broken.orderBy("file").first()
        if first is not None:
            raise BrokenArchive(f"records of {broken.count()} archives do not lead to their end, first {first.file}")
    return reached


def _value(fields: dict[str, str], name: str) -> str | None:
    return fields.get(name.lower())


def parse_fields(header: bytes) -> dict[str, str]:
    fields = {}
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


def read_archives(spark: SparkSession, path: str, payloads: bool = False, range_bytes: int = RANGE_BYTES,
                  strict: bool = True) -> DataFrame:
    """The records of all archives below ``path``: ``file``, ``offset``, ``type``, ``record_id``, ``url``, ``refers_to``, the
    declared and the measured size and SHA-256 of the payload, and with ``payloads`` the payload itself.

    Archives are read in byte ranges, each by a task of its own, so one large file is not one task's work. A
    record is read, whole, by the task of the range in which it begins; the chain of records, not what looks like
    one, decides where that is, so records inside payloads are never taken for records. Files are read once
    for the candidates and once for the records; nothing but offsets is shuffled. With ``strict`` an archive whose chain does not
    end at its end (cut short, damaged, a header over ``LONGEST_HEADER``) raises ``BrokenArchive``; otherwise its records up to
    there are given. Empty files have no records.
    """
    files = list_files(spark, path)
    reached = record_starts(spark, files, range_bytes, strict)
    first = reached.withColumn("start", F.col("at") - F.col("at") % range_bytes)
    work = byte_ranges(files, range_bytes).join(first, ["file", "start"]).select("file", "at", "start", "size")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for batch in batches:
            for task in batch.to_pylist():
                system, inner = open_path(task["file"])
                end = min(task["start"] + range_bytes, task["size"])
                with system.open_input_file(inner) as source:
                    for record in walk(source, task["file"], task["at"], end, task["size"], payloads):
                        held.append(record)
                        weight += 1024 + len(record[-1] or b"")
                        if weight >= BATCH_BYTES:
                            yield _records(held)
                            held, weight = [], 0
        if held:
            yield _records(held)

    return spread(durable(work)).mapInArrow(read, RECORD)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[{"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())] for f in RECORD]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=RECORD.names)


def walk(source, file: str, at: int, end: int, size: int, payloads: bool) -> Iterator[tuple]:
    """Records from the true record at ``at`` on that begin before ``end``, block by block."""
    block, data, base = 4 << 20, b"", at

    def hold(place: int, upto: int) -> None:
        """Have the bytes from ``place`` to ``upto`` in ``data``; what lies before is dropped."""
        nonlocal data, base
        if base <= place and base + len(data) >= min(upto, size):
            return
        have = data[place - base:] if base <= place <= base + len(data) else b""
        source.seek(place + len(have))
        data, base = have + source.read(max(upto - place - len(have), block)), place

    while at < end:
        hold(at, at + LONGEST_HEADER)
        body = header_end(data, at - base)
        if body < 0 or not _START.match(data, at - base):
            return  # damaged from here on; a strict reader has noticed before
        fields = parse_fields(data[at - base:body - 4])
        length, begin = int(fields["content-length"]), base + body
        if begin + length > size:
            return
        hold(begin, begin + length)
        payload = data[begin - base:begin - base + length]
        digest = _value(fields, "warc-payload-digest")
        declared = _value(fields, "x-payload-length")
        yield (file, at, _value(fields, "warc-type"), _value(fields, "warc-record-id"), _value(fields, "warc-target-uri"),
               _value(fields, "warc-refers-to"), digest.removeprefix("sha256:") if digest else None,
               int(declared) if declared and declared.isdigit() else None, length, hashlib.sha256(payload).hexdigest(),
               payload if payloads else None)
        at = begin + length + len(END)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def page_records(records: DataFrame) -> DataFrame:
    """A row per record that ``write_archives`` wrote: ``page_id``, ``url``, ``payload_bytes`` and ``payload_digest`` of the full
    payload, ``record_type``, ``refers_to`` (the response's page for revisits, else null).

    A response is told by its payload as read. What a revisit declares is checked against the response
    of that digest: one that has none, or differs from it in size or page, raises an error when its row is read.
    """
    revisit = F.col("type") == "revisit"
    responses = records.where(~revisit).select(
        page_of(F.col("record_id")).alias("page_id"), "url", F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    named = records.where(revisit).select(
        page_of(F.col("record_id")).alias("page_id"), "url", F.col("declared_bytes").alias("payload_bytes"),
        F.col("declared_digest").alias("payload_digest"), F.col("type").alias("record_type"),
        page_of(F.col("refers_to")).alias("refers_to"))
    sought = named.select("payload_digest", "refers_to", "payload_bytes").distinct()
    held = responses.select("payload_digest", F.col("page_id").alias("refers_to"), "payload_bytes")
    lost = null_safe_join(sought, held.withColumn("held", F.lit(True)), ["payload_digest", "refers_to", "payload_bytes"], "left")
    if not lost.where(F.col("held").isNull()).isEmpty():
        raise BrokenArchive("a revisit refers to a response that is not there")
    return responses.unionByName(named)
