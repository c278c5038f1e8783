"""Framed messages, routing, fan-out to typed targets, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import json as J
from tidemark.operators import fanout as X
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path

# events as frames: every 50th is too short, every 70th has a wrong first byte
_SCHEMA_ID = "CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 ELSE 9 END"
_REASON = """CASE WHEN event_id % 50 = 0 THEN 'frame too short'
  WHEN event_id % 70 = 0 THEN 'bad magic byte' END"""
_NAMES = {"com.example.Order": "orders", "com.example.Device": "devices"}


def _frames(events: DataFrame, index: bytes = b"") -> DataFrame:
    bad = F.col("event_id") % 70 == 0
    magic = F.when(bad, F.lit(b"\x01")).otherwise(F.lit(b"\x00"))
    schema_id = F.unhex(F.lpad(F.hex(F.expr(_SCHEMA_ID)), 8, "0"))
    whole = F.concat(magic, schema_id, F.lit(index), F.col("props").cast("binary"))
    short = F.substring(whole, 1, 4)
    return events.select(
        "event_id", F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 50 == 0, short).otherwise(whole).alias("value"),
    )


def _registry(events: DataFrame) -> DataFrame:
    """One row per schema id and full name, as a schema registry would list them."""
    name = F.expr("""CASE event_type WHEN 'purchase' THEN 'com.example.Order'
        WHEN 'error' THEN 'com.example.Device' WHEN 'click' THEN 'com.example.Click' END""")
    return (
        events.select(F.expr(_SCHEMA_ID).cast("bigint").alias("schema_id"), name.alias("full_name"))
        .where("full_name IS NOT NULL")
        .distinct()
    )


_FRAMES = f"""
SELECT event_id, {_REASON} AS reason,
  CASE WHEN {_REASON} IS NULL THEN CAST({_SCHEMA_ID} AS BIGINT) END AS schema_id,
  CASE WHEN {_REASON} IS NULL THEN props END AS payload FROM events"""


@query("frame_header", _FRAMES)
def frame_header(t: Tables) -> DataFrame:
    return X.frame_header(_frames(t.events)).select(
        "event_id", "reason", "schema_id", F.col("payload").cast("string").alias("payload")
    )


@query("frame_varint", _FRAMES)
def frame_varint(t: Tables) -> DataFrame:
    # the usual one-byte index, and one of two entries, the second of them two bytes long
    usual, longer = F.col("event_id") % 2 == 0, F.col("event_id") % 2 != 0
    frames = _frames(t.events.where(usual), b"\x00").unionByName(
        _frames(t.events.where(longer), b"\x02\x00\x80\x01")
    )
    return X.frame_varint(frames).select(
        "event_id", "reason", "schema_id", F.col("payload").cast("string").alias("payload")
    )


def _routed(t: Tables, for_topic: bool = False) -> DataFrame:
    return X.route_target(X.frame_header(_frames(t.events)), _registry(t.events), _NAMES, for_topic)


_ROUTED = f"""
WITH f AS (SELECT event_id, user_id, props, {_REASON} AS bad, {_SCHEMA_ID} AS id FROM events),
r AS (SELECT *, coalesce(bad, CASE WHEN id = 9 THEN 'unknown schema id' END) AS reason,
  CASE WHEN bad IS NOT NULL THEN NULL WHEN id = 1 THEN 'com.example.Order' WHEN id = 2 THEN 'com.example.Device'
       WHEN id = 3 THEN 'com.example.Click' END AS full_name FROM f),
routed AS (SELECT *, CASE WHEN reason IS NOT NULL THEN NULL WHEN id = 1 THEN 'orders' WHEN id = 2 THEN 'devices'
  ELSE 'com_example_Click' END AS target FROM r)"""


@query("route_target", f"{_ROUTED} SELECT event_id, full_name, target, reason FROM routed")
def route_target(t: Tables) -> DataFrame:
    return _routed(t).select("event_id", "full_name", "target", "reason")


@query("route_counts", f"""
{_ROUTED} SELECT full_name, target, count(*) AS n FROM routed WHERE reason IS NULL GROUP BY 1, 2""")
def route_counts(t: Tables) -> DataFrame:
    good, _ = X.split_dead_letters(_routed(t))
    return X.route_counts(good)


@query("dead_letter", f"""
{_ROUTED} SELECT reason, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM routed
WHERE reason IS NOT NULL GROUP BY reason""")
def dead_letter(t: Tables) -> DataFrame:
    _, bad = X.split_dead_letters(_routed(t))
    return bad.groupBy("reason").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("forward_bytes", f"""
{_ROUTED} SELECT CASE id WHEN 3 THEN 'com.example.Click' ELSE target END AS topic,
  CAST(user_id AS VARCHAR) AS key, '000000000' || id || hex(CAST(props AS VARCHAR)) AS value
FROM routed WHERE reason IS NULL""")
def forward_bytes(t: Tables) -> DataFrame:
    return X.forward_bytes(_routed(t, for_topic=True)).select(
        "topic", F.col("key").cast("string").alias("key"), F.hex("value").alias("value")
    )


@query("decode_payload", f"""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE {_REASON} IS NULL""")
def decode_payload(t: Tables) -> DataFrame:
    decoded = X.decode_payload(X.frame_header(_frames(t.events)), X.json_decoder("k BIGINT"))
    good, _ = X.split_dead_letters(decoded)
    return good.select("event_id", "message.k")


def _envelope(events: DataFrame) -> DataFrame:
    kind = F.expr("""CASE event_type WHEN 'purchase' THEN 'order' WHEN 'error' THEN 'device'
        WHEN 'click' THEN 'click' ELSE event_type END""")
    order, device, click = kind == "order", kind == "device", kind == "click"
    number = F.col("event_id").cast("string")
    agent = F.when(F.col("user_id") % 4 == 0, "Googlebot/2.1").otherwise("Safari/17.0")
    return events.select(
        "event_id", kind.alias("event_type"),
        F.when(order, F.concat(F.lit("o-"), number)).alias("order_id"),
        F.when(order, F.col("value") * 10).alias("amount"),
        F.when(order, F.concat(F.lit("cust-"), F.col("user_id"))).alias("customer_id"),
        F.when(device, F.concat(F.lit("dev-"), F.col("user_id"))).alias("device_id"),
        F.when(device, F.col("value")).alias("temperature"),
        F.when(click, F.concat(F.lit("s-"), number)).alias("session_id"),
        F.when(click, F.concat(F.lit("/page/"), F.col("event_id") % 4)).alias("url"),
        F.when(click, agent).alias("user_agent"),
    )


def _messages(events: DataFrame) -> DataFrame:
    """Events as JSON texts with their ids; every 90th is cut short, every 130th order has a text for its amount."""
    raw = J.json_encode(*_envelope(events).columns)
    texts = _envelope(events).select(F.col("event_id"), raw.alias("raw"))
    whole = F.regexp_replace("raw", r'"amount":[-0-9.E]+', '"amount":"much"')
    spoiled = F.when(F.col("event_id") % 90 == 0, F.expr("left(raw, 20)")).when(
        F.col("event_id") % 130 == 0, whole).otherwise(F.col("raw"))
    return texts.select(F.col("event_id").alias("message_id"), spoiled.alias("raw"))


_UNFIT = "event_id % 90 = 0 OR (event_id % 130 = 0 AND event_type = 'purchase')"


def _fan_out(t: Tables, target: str) -> DataFrame:
    path = scratch_path(t.spark, "fanout")
    fields = {f.name: f.dataType.simpleString() for f in _envelope(t.events).schema if f.name != "event_id"}
    run = X.Fanout(
        decode=lambda batch: X.json_envelope(batch, fields),
        targets={name: make for name, make in X.EVENT_TARGETS.items() if name == target},
        write=X.write_batch_folders(path),
        dead_letters=X.unrouted if target == "dead_letters" else None,
    )
    run(_messages(t.events), 0)
    return t.spark.read.parquet(f"{path}/{target}").drop("batch")


@query("fanout_orders", """
SELECT 'o-' || event_id AS order_id, value * 10 AS amount, 'cust-' || user_id AS customer_id,
  CASE WHEN value * 10 > 500 THEN 'hot' ELSE 'warm' END AS tier FROM events WHERE event_type = 'purchase'
  AND NOT (""" + _UNFIT + ")")
def fanout_orders(t: Tables) -> DataFrame:
    return _fan_out(t, "orders")


@query("fanout_devices", """
SELECT 'dev-' || user_id AS device_id, value AS temperature,
  CASE WHEN value > 80 THEN 'alert' ELSE 'ok' END AS status FROM events WHERE event_type = 'error'
  AND NOT (""" + _UNFIT + ")")
def fanout_devices(t: Tables) -> DataFrame:
    return _fan_out(t, "devices")


@query("fanout_clicks", """
SELECT 's-' || event_id AS session_id, '/page/' || (event_id % 4) AS url FROM events
WHERE event_type = 'click' AND user_id % 4 <> 0 AND NOT (""" + _UNFIT + ")")
def fanout_clicks(t: Tables) -> DataFrame:
    return _fan_out(t, "clicks")


@query("fanout_dead_letters", f"""
SELECT event_id AS message_id, CASE WHEN {_UNFIT} THEN 'unreadable message' ELSE 'unknown event type' END AS reason,
  CASE WHEN event_id % 90 = 0 THEN 20 END AS cut_length, event_id % 90 <> 0 AND event_id % 130 = 0
  AND event_type = 'purchase' AS has_bad_amount
FROM events WHERE event_type IN ('view', 'signup') OR {_UNFIT}""")
def fanout_dead_letters(t: Tables) -> DataFrame:
    """Messages for no target, with their original text."""
    return _fan_out(t, "dead_letters").select(
        "message_id", "reason", F.when(F.col("message_id") % 90 == 0, F.length("raw")).alias("cut_length"),
        F.contains("raw", F.lit('"amount":"much"')).alias("has_bad_amount"))


@query("json_typed_rows", """
SELECT 1 AS node, 'dev_' || user_id AS device, 'region_' || (user_id % 10) AS region,
       CAST(value AS FLOAT) AS temperature, ts AS event_time FROM events""")
def json_typed_rows(t: Tables) -> DataFrame:
    made = t.events.select(
        F.concat(F.lit("dev_"), "user_id").alias("device"),
        F.concat(F.lit("region_"), F.col("user_id") % 10).alias("region"),
        F.col("value").alias("temperature"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
    )
    types = {"device": "string", "region": "string", "temperature": "float", "event_time": "timestamp_ntz"}
    typed = J.json_message(made).select(J.json_columns("raw", types).alias("r"))
    return typed.select(F.lit(1).alias("node"), "r.*")
