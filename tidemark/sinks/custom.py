"""Custom sinks in Python: set up once per task, write columns per batch, tear down.

Built on the Python data source API, so the same sink takes batch and streaming writes. Delivery is
at least once: a retried task sends its rows again.
"""

from __future__ import annotations

import json
import urllib.request
from base64 import b64encode
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage,
)

BATCH_ROWS = 10_000


@dataclass
class Written(WriterCommitMessage):
    rows: int


@dataclass(frozen=True)
class SinkFunctions:
    """``init(config)`` gives the state handed to ``write(state, columns)`` and ``deinit(state)``.

    ``columns`` maps column name to the list of its values in the batch.
    """

    write: Callable[[object, Mapping[str, list]], None]
    init: Callable[[dict], object] = lambda config: None
    deinit: Callable[[object], None] = lambda state: None
    batch_rows: int = BATCH_ROWS


def _send(functions: SinkFunctions, config: dict, batches: Iterator[pa.RecordBatch]) -> Written:
    state, total = functions.init(config), 0
    try:
        for batch in batches:
            for begin in range(0, batch.num_rows, functions.batch_rows):
                part = batch.slice(begin, functions.batch_rows)
                functions.write(state, part.to_pydict())
                total += part.num_rows
    finally:
        functions.deinit(state)
    return Written(total)


def register_sink(spark: SparkSession, name: str, functions: SinkFunctions) -> None:
    """Make ``format(name)`` available for writes; ``option("config", json)`` reaches ``init``. Rows come
    from the JVM as Arrow batches and reach ``write`` column by column."""

    class Writer(DataSourceArrowWriter):
        def __init__(self, options):
            self.config = json.loads(options.get("config", "{}"))

        def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
            return _send(functions, self.config, batches)

    class StreamWriter(DataSourceStreamArrowWriter):
        def __init__(self, options):
            self.config = json.loads(options.get("config", "{}"))

        def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
            return _send(functions, self.config, batches)

        def commit(self, messages, batchId: int) -> None:
            pass

        def abort(self, messages, batchId: int) -> None:
            pass

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return Writer(self.options)

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
            return StreamWriter(self.options)

    spark.dataSource.register(Sink)


Transport = Callable[[str, Mapping[str, str], bytes, float], None]


def post(url: str, headers: Mapping[str, str], body: bytes, timeout: float) -> None:
    """Send one request; an error status raises, which fails the task and has Spark retry it."""
    request = urllib.request.Request(url, data=body, headers=dict(headers), method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        answer.read()


def rest_headers(config: Mapping[str, object]) -> dict[str, str]:
    headers = {"Content-Type": "application/json"}
    if config.get("api_key"):
        headers["X-Api-Key"] = str(config["api_key"])
    if config.get("username"):
        pair = f"{config['username']}:{config.get('password', '')}".encode()
        headers["Authorization"] = "Basic " + b64encode(pair).decode()
    return headers


def rest_body(columns: Mapping[str, list]) -> bytes:
    rows = [list(row) for row in zip(*columns.values())]
    return json.dumps({"columns": list(columns), "data": rows}, default=str).encode()


def rest_sink(transport: Transport = post) -> SinkFunctions:
    """One request per batch of rows; config: url, timeout, api_key or username and password."""

    def init(config: dict) -> tuple[str, dict[str, str], float]:
        return str(config["url"]), rest_headers(config), float(config.get("timeout", 10))

    def write(state, columns: Mapping[str, list]) -> None:
        url, headers, timeout = state
        transport(url, headers, rest_body(columns), timeout)

    return SinkFunctions(write=write, init=init)


def event_sink(transport: Transport = post, sourcetype: str = "otel_trace") -> SinkFunctions:
    """Collector events, several JSON objects per request; config: url, authorization, timeout.

    Rows carry ``event`` and may carry ``sourcetype``, for which there is a default.
    """

    def init(config: dict) -> tuple[str, dict[str, str], float]:
        headers = {"Content-Type": "application/json"}
        if config.get("authorization"):
            headers["Authorization"] = str(config["authorization"])
        return str(config["url"]), headers, float(config.get("timeout", 10))

    def write(state, columns: Mapping[str, list]) -> None:
        url, headers, timeout = state
        types = columns.get("sourcetype") or [None] * len(columns["event"])
        lines = [
            json.dumps({"event": event, "sourcetype": kind or sourcetype})
            for event, kind in zip(columns["event"], types)
        ]
        transport(url, headers, "\n".join(lines).encode(), timeout)

    return SinkFunctions(write=write, init=init)
