"""Decode-once fan-out: frames, routing, per-target transforms, dead letters."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions.scalars import is_bot
from tidemark.operators.lookup import broadcast_if_small
from tidemark.session import discard, durable

# Frame layout (magic byte, then a 4-byte big-endian schema id) and routing limits.
FRAME_MAGIC = "00"
FRAME_HEADER_BYTES = 5
VARINT_BYTES = 10
HOT_ORDER_AMOUNT = 500
ALERT_TEMPERATURE = 80

TOO_SHORT = "frame too short"
BAD_MAGIC = "bad magic byte"
BAD_INDEX = "bad message index"
UNKNOWN_SCHEMA = "unknown schema id"
UNKNOWN_EVENT = "unknown event type"
UNREADABLE = "unreadable message"


def frame_header(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``schema_id``, ``payload`` and ``reason`` (NULL for a good frame)."""
    frame = F.col(value)
    good_size = F.octet_length(frame) >= FRAME_HEADER_BYTES
    magic = F.hex(F.substring(frame, 1, 1))
    reason = F.when(~F.coalesce(good_size, F.lit(False)), TOO_SHORT).when(magic != FRAME_MAGIC, BAD_MAGIC)
    schema_id = F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("bigint")
    size = F.octet_length(frame)
    payload = frame.substr(F.lit(FRAME_HEADER_BYTES + 1), size - FRAME_HEADER_BYTES)
    return df.withColumn("reason", reason).withColumns(
        {
            "schema_id": F.when(F.col("reason").isNull(), schema_id),
            "payload": F.when(F.col("reason").isNull(), payload),
        }
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row."""
    return F.transform(F.array(value), use)[0]


def _after_index(payload: Column) -> Column:
    """What follows a varint count and that many varints; NULL when they are cut short."""

    def byte(part: Column, i: Column) -> Column:
        return F.hex(part.substr(i, F.lit(1)))  # empty beyond the end

    def last_bytes(part: Column, size: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), size), lambda i: byte(part, i).between("00", "7F"))

    def number(part: Column, size: Column) -> Column:
        def bits(i: Column) -> Column:
            low = F.conv(byte(part, i), 16, 10).cast("bigint").bitwiseAND(F.lit(127))
            return F.call_function("shiftleft", low, 7 * (i - 1))

        return F.aggregate(F.sequence(F.lit(1), size), F.lit(0).cast("bigint"), lambda total, i: total + bits(i))

    def body(part: Column, first: Column, count: Column) -> Column:
        left = F.octet_length(part) - first
        index = part.substr(first + 1, F.least(left.cast("bigint"), VARINT_BYTES * count).cast("int"))
        ends = last_bytes(index, F.greatest(F.octet_length(index), F.lit(1)))
        end = F.when(count == 0, 0).otherwise(F.get(ends, (count - 1).cast("int")))
        # every varint has a byte at least; a longer count is never looked at
        return F.when(count <= left, _bound(end, lambda at: part.substr(first + at + 1, left)))

    def counted(part: Column) -> Column:
        first = F.get(last_bytes(part, F.lit(VARINT_BYTES - 1)), F.lit(0))
        return _bound(first, lambda size: _bound(number(part, size), lambda count: body(part, size, count)))

    return _bound(payload, counted)


def frame_varint(df: DataFrame, value: str = "value") -> DataFrame:
    """Like ``frame_header`` for frames with a message-index array before the payload.

    The usual array is a single zero byte. An array that is cut short, one whose count takes more than nine bytes
    and one whose entries take more than ten each on average are bad; only the array's own bytes are looked at.
    """
    payload = F.col("payload")
    short = F.hex(F.substring(payload, 1, 1)) == "00"
    body = F.when(short, payload.substr(F.lit(2), F.octet_length(payload))).otherwise(_after_index(payload))
    head = frame_header(df, value).withColumn("payload", body)
    cut = F.col("reason").isNull() & F.col("payload").isNull()
    return head.withColumn("reason", F.when(cut, BAD_INDEX).otherwise(F.col("reason")))


def route_target(
    frames: DataFrame, registry: DataFrame, names: Mapping[str, str], for_topic: bool = False
) -> DataFrame:
    """Add ``full_name``, ``target`` and ``reason`` by schema id.

    The registry has one row per schema id, while one id may be on most of the frames, so a registry
    counted as small is broadcast and the frames stay where they are. Names outside the map fall back to the full name, with
    ``.`` turned into ``_`` for tables and unchanged for topics.
    """
    known = broadcast_if_small(registry.select(F.col("schema_id").alias("_id"), "full_name"))
    joined = frames.join(known, frames["schema_id"] == known["_id"], "left").drop("_id")
    fallback = F.col("full_name") if for_topic else F.translate("full_name", ".", "_")
    target = fallback
    if names:
        pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        target = F.coalesce(F.try_element_at(pairs, F.col("full_name")), fallback)
    reason = F.coalesce(F.col("reason"), F.when(F.col("full_name").isNull(), UNKNOWN_SCHEMA))
    return joined.withColumn("reason", reason).withColumn(
        "target", F.when(F.col("reason").isNull(), target)
    )


def split_dead_letters(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows by ``reason``."""
    return df.where(F.col("reason").isNull()).drop("reason"), df.where(F.col("reason").isNotNull())


def route_counts(routed: DataFrame) -> DataFrame:
    """Rows per schema and target."""
    return routed.groupBy("full_name", "target").agg(F.count("*").alias("n"))


def forward_bytes(routed: DataFrame) -> DataFrame:
    """Message rows for a topic sink: key and value bytes unchanged, only the topic is new."""
    return routed.where(F.col("reason").isNull()).select(
        F.col("target").alias("topic"), F.col("key"), F.col("value")
    )


def decode_payload(df: DataFrame, decoder: Callable[[Column], Column], name: str = "message") -> DataFrame:
    """Apply a payload decoder; a payload it turns into NULL is marked in ``reason``."""
    decoded = df.withColumn(name, decoder(F.col("payload")))
    bad = F.col("reason").isNull() & F.col(name).isNull()
    return decoded.withColumn("reason", F.when(bad, "undecodable payload").otherwise(F.col("reason")))


def json_decoder(schema: str) -> Callable[[Column], Column]:
    return lambda payload: F.from_json(payload.cast("string"), schema)


def avro_decoder(schema: str) -> Callable[[Column], Column]:
    """Needs the Spark Avro package on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    return lambda payload: from_avro(payload, schema, {"mode": "PERMISSIVE"})


def protobuf_decoder(message: str, descriptor: bytes) -> Callable[[Column], Column]:
    """Needs the Spark Protobuf package on the classpath."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return lambda payload: from_protobuf(
        payload, message, binaryDescriptorSet=descriptor, options={"mode": "PERMISSIVE"}
    )


# Targets of the mixed event topic: which rows, and how they become target rows.


def orders_of(envelope: DataFrame) -> DataFrame:
    tier = F.when(F.col("amount") > HOT_ORDER_AMOUNT, "hot").otherwise("warm")
    return envelope.where(F.col("event_type") == "order").select(
        "order_id", "amount", "customer_id", tier.alias("tier")
    )


def devices_of(envelope: DataFrame) -> DataFrame:
    status = F.when(F.col("temperature") > ALERT_TEMPERATURE, "alert").otherwise("ok")
    return envelope.where(F.col("event_type") == "device").select(
        "device_id", "temperature", status.alias("status")
    )


def clicks_of(envelope: DataFrame) -> DataFrame:
    human = ~F.coalesce(is_bot("user_agent"), F.lit(False))
    return envelope.where((F.col("event_type") == "click") & human).select("session_id", "url")


EVENT_TARGETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": orders_of,
    "devices": devices_of,
    "clicks": clicks_of,
}
EVENT_TYPES = ("order", "device", "click")


def unrouted(envelope: DataFrame) -> DataFrame:
    """Rows for no target, with the reason: unreadable ones, and those of an unknown type. All columns
    stay, the original message among them where the envelope has it."""
    known = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    reason = F.when(~known, UNKNOWN_EVENT)
    if "reason" in envelope.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return envelope.withColumn("reason", reason).where(F.col("reason").isNotNull())


def json_envelope(messages: DataFrame, fields: Mapping[str, str], raw: str = "raw") -> DataFrame:
    """The fields of JSON messages, beside the untouched message and the ``reason`` it cannot be used.

    A message that is no JSON object, and one with a field that does not fit its type, is unreadable as a
    whole: no row is made of its other fields. Columns of the source, such as a message key, stay.
    """
    schema = ", ".join([f"`{name}` {dtype}" for name, dtype in fields.items()] + ["`_unfit` STRING"])
    parsed = F.from_json(F.col(raw), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unfit"})
    decoded = messages.withColumn("_e", parsed)
    unfit = F.col("_e").isNull() | F.col("_e._unfit").isNotNull()
    return decoded.select(
        *messages.columns, *[F.col(f"_e.`{name}`").alias(name) for name in fields],
        F.when(unfit, UNREADABLE).alias("reason"),
    )


@dataclass
class Fanout:
    """A ``foreachBatch`` function that decodes once and writes every target.

    Rows that decoding gave a ``reason`` go to the dead letters alone. The decoded batch is
    written to the shared folder, and removed again, only where several frames are made from it: a lost
    executor does not decode it a second time.
    A failed write raises, so the batch is replayed and targets must tolerate repeats (a keyed table,
    or a folder named by batch id). With ``isolate`` one target's failure does not stop the others,
    and is raised after them. ``dry_run`` counts without writing.
    """

    decode: Callable[[DataFrame], DataFrame]
    targets: Mapping[str, Callable[[DataFrame], DataFrame]]
    write: Callable[[DataFrame, str, int], None]
    dead_letters: Callable[[DataFrame], DataFrame] | None = None
    isolate: bool = True
    dry_run: bool = False
    counts: dict[str, int] = field(default_factory=dict)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        decoded = self.decode(batch)
        several = len(self.targets) + (self.dead_letters is not None) > 1
        decoded = durable(decoded) if several else decoded
        good = decoded.where(F.col("reason").isNull()).drop("reason") if "reason" in decoded.columns else decoded
        frames = {name: make(good) for name, make in self.targets.items()}
        if self.dead_letters is not None:
            frames["dead_letters"] = self.dead_letters(decoded)
        failures: list[Exception] = []
        try:
            for name, frame in frames.items():
                seen = Observation()
                observed = frame.observe(seen, F.count(F.lit(1)).alias("n"))
                try:
                    if self.dry_run:
                        observed.write.format("noop").mode("overwrite").save()
                    else:
                        self.write(observed, name, batch_id)
                    self.counts[name] = self.counts.get(name, 0) + seen.get["n"]
                except Exception as error:
                    if not self.isolate:
                        raise
                    failures.append(error)
        finally:
            if several:
                discard(decoded.sparkSession, [decoded])
        if failures:
            raise failures[0]


def write_batch_folders(root: str) -> Callable[[DataFrame, str, int], None]:
    """Writer for ``Fanout``: a replayed batch overwrites its own folder."""

    def write(frame: DataFrame, target: str, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{root}/{target}/batch={batch_id}")

    return write
