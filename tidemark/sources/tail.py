"""Growing log files as a stream: whole records as they are finished, each once, through rotation and restart.

An offset of the stream names, for each file, its first line's digest and how many bytes hold finished
records: those before the last header, as only the next header tells that a record is over. It is made from the
files alone; what is new is what lies between two offsets, a renamed file being known by its first line.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.files import open_path
from tidemark.sources.logs import LONGEST_RECORD, RANGE_BYTES, RECORD_HEADER, RecordTooLong, _records

_FIRST_LINE = 1 << 12
_BLOCK = 1 << 16
_HEADER_BYTES = 512  # a header is found if it is no longer than this
_ROWS = 4096


def first_line(source) -> str | None:
    """A digest of the first line; None while it is not finished. Lines over ``_FIRST_LINE`` bytes are told by those."""
    source.seek(0)
    start = source.read(_FIRST_LINE)
    line, found, _ = start.partition(b"\n")
    if not found and len(start) < _FIRST_LINE:
        return None
    return hashlib.sha256(line).hexdigest()[:24]


def last_header(source, size: int, header: re.Pattern[bytes], longest: int) -> int:
    """Where the last record begins, read backwards block by block; 0 if there is no header and the file is short."""
    end = size
    while end > 0:
        begin = max(end - _BLOCK, 0)
        source.seek(max(begin - 1, 0))
        data = source.read(min(end + _HEADER_BYTES, size) - max(begin - 1, 0))
        shift = max(begin - 1, 0)
        places = [0] if shift == 0 else []
        places += [m.start() + 1 for m in re.finditer(b"\n", data)]
        for place in reversed(places):
            if shift + place < end and header.match(data, place):
                return shift + place
        if size - begin > longest:
            raise RecordTooLong(f"no header in the last {longest} bytes")
        end = begin
    return 0


class _Upto:
    """A file that ends at ``end``."""

    def __init__(self, source, end: int) -> None:
        self.source, self.end, self.at = source, end, 0

    def seek(self, place: int) -> None:
        self.source.seek(place)
        self.at = place

    def read(self, size: int) -> bytes:
        data = self.source.read(max(min(size, self.end - self.at), 0))
        self.at += len(data)
        return data


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, upto: int, headless: bool) -> None:
        self.path, self.start, self.end, self.upto, self.headless = path, start, end, upto, headless


class _Tail(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.pattern = options.get("files", "*")
        self.header = options.get("header", RECORD_HEADER)
        self.longest = int(options.get("longest", LONGEST_RECORD))
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.idle = float(options["idle_seconds"]) if "idle_seconds" in options else None
        self.seen: dict[tuple, list] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """For each file: first line's digest, bytes of finished records, size. Only files that changed are looked into."""
        from pyarrow import fs

        system, inner = open_path(self.folder)
        found, compiled = {}, re.compile(self.header.encode())
        for info in sorted(system.get_file_info(fs.FileSelector(inner, allow_not_found=True)), key=lambda i: i.path):
            if not info.is_file or not info.size or info.base_name.startswith(("_", ".")) or not fnmatch.fnmatch(
                    info.base_name, self.pattern):
                continue
            idle = self.idle is not None and info.mtime is not None and time.time() - info.mtime.timestamp() >= self.idle
            mark = (info.path, info.size, idle)
            if mark not in self.seen:
                with system.open_input_file(info.path) as source:
                    digest = first_line(source)
                    if digest is None and not idle:
                        continue
                    done = info.size if idle else last_header(source, info.size, compiled, self.longest)
                self.seen = {k: v for k, v in self.seen.items() if k[0] != info.path}
                self.seen[mark] = [digest or "", done, info.size]
            found[info.base_name] = self.seen[mark]
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # files that were renamed since: their first lines are known, their names are gone
        moved: dict[str, list[list]] = {}
        for name, known in start.items():
            if name not in end or end[name][0] != known[0]:
                moved.setdefault(known[0], []).append(known)
        ranges = []
        for name, (digest, done, size) in end.items():
            known = start.get(name)
            if known is None or known[0] != digest:
                known = moved[digest].pop() if moved.get(digest) else None
            begin = 0 if known is None or size < known[2] else known[1]
            # what follows a record that was given because its file stood still is a record of its own
            headless = begin == 0 or known is not None and known[1] == known[2]
            for at in range(begin, done, self.range_bytes):
                ranges.append(_Range(f"{self.folder.rstrip('/')}/{name}", at, min(at + self.range_bytes, done), done,
                                     headless and at == begin))
        return ranges

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        compiled = re.compile(self.header.encode())
        system, inner = open_path(partition.path)
        with system.open_input_file(inner) as opened:
            source = _Upto(opened, partition.upto)
            held: list[str] = []
            for record in _records(source, partition.start, partition.end, compiled, self.longest, partition.headless):
                held.append(record)
                if len(held) == _ROWS:
                    yield pa.RecordBatch.from_pydict({"file": [partition.path] * len(held), "raw": held})
                    held = []
            if held:
                yield pa.RecordBatch.from_pydict({"file": [partition.path] * len(held), "raw": held})


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "file STRING, raw STRING"

    def streamReader(self, schema) -> _Tail:
        return _Tail(self.options)


def log_tail(spark: SparkSession, folder: str, files: str = "*", header: str = RECORD_HEADER, idle_seconds: float | None = None,
             longest: int = LONGEST_RECORD, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (file, raw) of the growing log files right below ``folder`` whose name fits ``files``, as a stream.

    A record is given when the next one's header is there; with ``idle_seconds``, the last one also when its file has not
    changed for so long. A file renamed by rotation goes on where it was, and a new one under the old name starts
    from its beginning; so does one that got shorter. Files are told by their first line, which should hold a time.
    A record of more than ``longest`` bytes raises ``RecordTooLong``. Large backlogs are read in byte ranges.
    """
    spark.dataSource.register(LogTail)
    options = {"path": folder, "files": files, "header": header, "longest": str(longest), "range_bytes": str(range_bytes)}
    if idle_seconds is not None:
        options["idle_seconds"] = str(idle_seconds)
    return spark.readStream.format("log_tail").options(**options).load()
