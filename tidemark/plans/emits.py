"""Emit policies, key expiry, alerts, late rows, deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.json import json_encode
from tidemark.operators import alerts, emit, expire
from tidemark.operators.aggregates import exact_sum
from tidemark.operators.latest import latest_by_key
from tidemark.operators.ordered import Running
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path
from tidemark.streaming.alerts import acting_alerts, payload_of
from tidemark.streaming.emit import expire_stream, on_update
from tidemark.streaming.shared import Aggregation, SharedViews
from tidemark.streaming.traces import trace_groups_stream as group_traces
from tidemark.streaming.views import View, run_to_end, stream_table

HOUR_US = 3_600_000_000


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def _changes() -> list[Column]:
    return [
        F.count("*").alias("c"), exact_sum("value").alias("s"),
        F.min("value").alias("mn"), F.max("value").alias("mx"),
    ]


def _running() -> dict[str, Running]:
    return {
        "c": Running("count", F.lit(1)), "s": Running("sum", _money("value")),
        "mn": Running("min", F.col("value")), "mx": Running("max", F.col("value")),
    }


_ON_UPDATE = """
SELECT event_type, count(*) AS c, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s,
       min(value) AS mn, max(value) AS mx FROM events GROUP BY event_type"""


@query("emit_on_update", _ON_UPDATE)
def emit_on_update(t: Tables) -> DataFrame:
    return on_update(t.events, ["event_type"], _changes())


@query("emit_on_update_stream", _ON_UPDATE)
def emit_on_update_stream(t: Tables) -> DataFrame:
    stream = stream_table(t.spark, t.file("events"), t.events.schema)
    log = run_to_end(on_update(stream, ["event_type"], _changes()), "update")
    return latest_by_key(log, ["event_type"], ["batch_id"]).drop("batch_id")


@query("stream_view", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def stream_view(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "view")

    def build() -> DataFrame:
        stream = stream_table(t.spark, t.file("events"), t.events.schema)
        return stream.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))

    View(t.spark, None, build, path, scratch_path(t.spark, "view-checkpoint")).start().wait()
    return t.spark.read.parquet(path)


_SHARED = {f"{name}_{k}": (keys, k) for name, keys in (
    ("type", ["event_type"]), ("user", ["user_id"]), ("both", ["event_type", "user_id"]), ("all", [])) for k in range(5)}


@query("stream_shared_views", " UNION ALL ".join(f"""
SELECT '{name}' AS view, {"event_type" if "event_type" in keys else "CAST(NULL AS VARCHAR)"} AS event_type,
  {"user_id" if "user_id" in keys else "CAST(NULL AS BIGINT)"} AS user_id, count(*) AS c, min(value) AS mn, max(value) AS mx
FROM events WHERE event_id % 5 <> {k} {"GROUP BY " + ", ".join(keys) if keys else ""}""" for name, (keys, k) in _SHARED.items()))
def stream_shared_views(t: Tables) -> DataFrame:
    """Twenty aggregations of one stream that is read once."""
    path = scratch_path(t.spark, "shared")
    columns = {"c": Running("count", F.lit(1)), "mn": Running("min", F.col("value")), "mx": Running("max", F.col("value"))}
    views = SharedViews(t.spark, f"{path}/views", [
        Aggregation(name, keys, columns, F.col("event_id") % 5 != k) for name, (keys, k) in _SHARED.items()])
    schema = t.events.schema
    View(t.spark, None, lambda: stream_table(t.spark, t.file("events"), schema), views, f"{path}/checkpoint").start().wait()
    found = [views.read(name).withColumn("view", F.lit(name)) for name in _SHARED]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found).select(
        "view", "event_type", "user_id", "c", "mn", "mx")


@query("emit_running", """
SELECT event_id, event_type, count(*) OVER w AS c,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS s,
       min(value) OVER w AS mn, max(value) OVER w AS mx FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def emit_running(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "value")
    done = emit.emit_running(rows, ["event_type"], ["event_id"], _running())
    return done.withColumn("s", F.col("s").cast("double")).drop("value")


@query("emit_on_update_batched", """
WITH k AS (SELECT event_type, date_trunc('hour', ts) AS tick, count(*) AS n,
                  sum(CAST(value AS DECIMAL(18,2))) AS v, min(value) AS lo, max(value) AS hi
           FROM events GROUP BY 1, 2)
SELECT event_type, tick, CAST(sum(n) OVER w AS BIGINT) AS c, CAST(sum(v) OVER w AS DOUBLE) AS s,
       min(lo) OVER w AS mn, max(hi) OVER w AS mx
FROM k WINDOW w AS (PARTITION BY event_type ORDER BY tick)""")
def emit_on_update_batched(t: Tables) -> DataFrame:
    done = emit.emit_on_update_batched(t.events, ["event_type"], "ts", "1 hour", _running())
    return done.withColumn("s", F.col("s").cast("double"))


_TICKS = """
k AS (SELECT date_trunc('hour', ts) AS tick, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(tick) FROM k), (SELECT max(tick) FROM k), INTERVAL 1 HOUR)) AS tick),
t AS (SELECT g.tick, CAST(sum(coalesce(n, 0)) OVER (ORDER BY g.tick) AS BIGINT) AS total
      FROM g LEFT JOIN k ON g.tick = k.tick)"""


def _totals(t: Tables) -> DataFrame:
    return emit.emit_periodic(t.events, [], "ts", "1 hour", {"total": Running("count", F.lit(1))})


@query("emit_periodic", f"WITH {_TICKS} SELECT tick, total FROM t")
def emit_periodic(t: Tables) -> DataFrame:
    return _totals(t)


@query("emit_periodic_keyed", """
WITH k AS (SELECT event_type, date_trunc('day', ts) AS tick, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT event_type, unnest(generate_series(lo, (SELECT max(tick) FROM k), INTERVAL 1 DAY)) AS tick
      FROM (SELECT event_type, min(tick) AS lo FROM k GROUP BY 1))
SELECT g.event_type, g.tick, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.event_type ORDER BY g.tick) AS BIGINT)
       AS total
FROM g LEFT JOIN k ON g.tick = k.tick AND g.event_type = k.event_type""")
def emit_periodic_keyed(t: Tables) -> DataFrame:
    total = {"total": Running("count", F.lit(1))}
    return emit.emit_periodic(t.events, ["event_type"], "ts", "1 day", total)


@query("win_emission_lag", f"""
WITH {_TICKS} SELECT tick, total, lag(total, 1, 0) OVER (ORDER BY tick) AS prev FROM t""")
def win_emission_lag(t: Tables) -> DataFrame:
    return emit.emission_rate(_totals(t), "total", 2).drop("eps")


@query("win_eps", f"""
WITH {_TICKS}
SELECT tick, total, lag(total, 1, 0) OVER (ORDER BY tick) AS prev,
       (total - lag(total, 1, 0) OVER (ORDER BY tick)) // 2 AS eps FROM t""")
def win_eps(t: Tables) -> DataFrame:
    return emit.emission_rate(_totals(t), "total", 2)


@query("win_tumble", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def win_tumble(t: Tables) -> DataFrame:
    return t.events.groupBy(emit.tick_of("ts", "5 minutes").alias("window_start"), "event_type").agg(
        F.count("*").alias("n")
    )


def _spans(events: DataFrame) -> DataFrame:
    """Events as spans: start at their time, last ``value`` milliseconds."""
    end_us = F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 1000).cast("bigint")
    return events.select(
        "user_id", "event_id", "event_type", F.col("ts").alias("start_time"),
        F.timestamp_micros(end_us).cast("timestamp_ntz").alias("end_time"),
    )


_GROUPS = """
WITH s AS (SELECT user_id, event_id, event_type, ts AS start_time,
                  ts + to_microseconds(CAST(round(value * 1000) AS BIGINT)) AS end_time FROM events),
a AS (SELECT *, max(end_time) OVER (PARTITION BY user_id ORDER BY end_time, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM s),
b AS (SELECT *, sum(CASE WHEN pm IS NULL OR epoch_us(end_time) - epoch_us(pm) > 21600000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY end_time, event_id) AS g FROM a),
c AS (SELECT user_id, min(start_time) AS start_ts, max(end_time) AS end_ts,
        (epoch_us(max(end_time)) - epoch_us(min(start_time))) // 1000 AS span_ms, count(*) AS n,
        string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}', ','
                   ORDER BY end_time, event_id) AS trace_events
      FROM b GROUP BY user_id, g)"""
_MAXSPAN_MS = 4 * 3_600_000


@query("expire_all", f"{_GROUPS} SELECT user_id, start_ts, end_ts, span_ms, n FROM c")
def expire_all(t: Tables) -> DataFrame:
    return expire.expire_groups(_spans(t.events), ["user_id"], "start_time", "end_time", 6 * HOUR_US)


@query("expire_all_stream", f"{_GROUPS} SELECT user_id, start_ts, end_ts, span_ms, n FROM c")
def expire_all_stream(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "spans")
    times = {c: F.col(c).cast("timestamp") for c in ("start_time", "end_time")}
    spans = _spans(t.events).withColumns(times).select("user_id", "start_time", "end_time")
    spans.write.parquet(path)
    # the last groups only expire when something later arrives
    later = spans.agg(F.max("end_time").alias("end_time")).select(
        F.lit(None).cast("bigint").alias("user_id"),
        *[(F.col("end_time") + F.expr("INTERVAL 30 DAYS")).alias(c) for c in times],
    )
    later.write.mode("append").parquet(path)
    stream = stream_table(t.spark, path, spans.schema)
    log = run_to_end(expire_stream(stream, ["user_id"], "start_time", "end_time", "6 hours"))
    plain = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_ts", "end_ts")]
    return log.where("user_id IS NOT NULL").select("user_id", *plain, "span_ms", "n")


@query("expire_only_outliers", f"""
{_GROUPS} SELECT user_id, start_ts, end_ts, span_ms, n FROM c WHERE span_ms > {_MAXSPAN_MS}""")
def expire_only_outliers(t: Tables) -> DataFrame:
    return expire.expire_groups(
        _spans(t.events), ["user_id"], "start_time", "end_time", 6 * HOUR_US, _MAXSPAN_MS
    )


@query("trace_groups", f"SELECT *, CAST(0 AS BIGINT) AS part FROM ({_GROUPS} SELECT * FROM c WHERE span_ms > {_MAXSPAN_MS})")
def trace_groups(t: Tables) -> DataFrame:
    groups = expire.trace_groups(
        _spans(t.events), ["user_id"], "start_time", "end_time", 6 * HOUR_US,
        json_encode("event_id", "event_type"), ["end_time", "event_id"], _MAXSPAN_MS,
    )
    return groups.withColumn("trace_events", F.array_join("trace_events", ","))


_BATCHES = """
WITH RECURSIVE e AS (SELECT ts, event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS rn
                     FROM events WHERE event_type = 'error'),
w AS (SELECT rn, ts, event_id, user_id, 0 AS b, 1 AS n, ts AS t0 FROM e WHERE rn = 1
  UNION ALL
  SELECT e.rn, e.ts, e.event_id, e.user_id,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN w.b + 1 ELSE w.b END,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN 1 ELSE w.n + 1 END,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN e.ts ELSE w.t0 END
  FROM w JOIN e ON e.rn = w.rn + 1),
batches AS (SELECT CAST(b AS BIGINT) AS batch, count(*) AS n, min(ts) AS first_ts,
    CASE WHEN count(*) >= 5 THEN max(ts) ELSE min(ts) + INTERVAL 4 HOUR END AS close_ts FROM w GROUP BY b)"""


def _errors(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'error'").select("event_id", "ts", "user_id")


@query("alert_batches", f"{_BATCHES} SELECT batch, n, first_ts, close_ts FROM batches")
def alert_batches(t: Tables) -> DataFrame:
    return alerts.alert_batches(_errors(t), [], "ts", "event_id", 5, 4 * HOUR_US)


@query("alert_rate_limit", f"""
{_BATCHES}, r AS (SELECT *, row_number() OVER (PARTITION BY date_trunc('day', close_ts) ORDER BY close_ts, batch) AS k,
  count(*) OVER (PARTITION BY date_trunc('day', close_ts)) - 1 AS suppressed FROM batches)
SELECT batch, n, first_ts, close_ts, suppressed FROM r WHERE k = 1""")
def alert_rate_limit(t: Tables) -> DataFrame:
    batches = alerts.alert_batches(_errors(t), [], "ts", "event_id", 5, 4 * HOUR_US)
    return alerts.rate_limit(batches, [], "1 day")


@query("alert_payload", f"""
{_BATCHES}, c AS (SELECT CAST(b AS BIGINT) AS batch, 'c' || (event_id % 2) AS cluster,
  '"' || string_agg(CAST(user_id AS VARCHAR), '","' ORDER BY CAST(user_id AS VARCHAR)) || '"' AS nodes
  FROM w GROUP BY 1, 2)
SELECT batch, '{{"cluster_offline_nodes":{{' || string_agg('"' || cluster || '":[' || nodes || ']', ','
  ORDER BY cluster) || '}}}}' AS payload FROM c GROUP BY batch""")
def alert_payload(t: Tables) -> DataFrame:
    rows = _errors(t).withColumn("cluster", F.concat(F.lit("c"), F.col("event_id") % 2))
    batched = alerts.greedy_batches(rows, [], "ts", "event_id", 5, 4 * HOUR_US)
    return alerts.alert_payload(batched, ["batch"], "cluster", "user_id")


_USER_BATCHES = """
WITH RECURSIVE e AS (SELECT ts, event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                     FROM events),
w AS (SELECT user_id, rn, ts, event_id, 0 AS b, 1 AS n, ts AS t0 FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.ts, e.event_id,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN w.b + 1 ELSE w.b END,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN 1 ELSE w.n + 1 END,
    CASE WHEN w.n >= 5 OR e.ts - w.t0 > INTERVAL 4 HOUR THEN e.ts ELSE w.t0 END
  FROM w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1),
batches AS (SELECT user_id, CAST(b AS BIGINT) AS batch, count(*) AS n, min(ts) AS first_ts,
    CASE WHEN count(*) >= 5 THEN max(ts) ELSE min(ts) + INTERVAL 4 HOUR END AS close_ts FROM w GROUP BY user_id, b),
c AS (SELECT user_id, CAST(b AS BIGINT) AS batch, 'c' || (event_id % 2) AS cluster,
  '"' || string_agg(CAST(event_id AS VARCHAR), '","' ORDER BY CAST(event_id AS VARCHAR)) || '"' AS nodes FROM w GROUP BY 1, 2, 3),
p AS (SELECT user_id, batch, '{"cluster_offline_nodes":{' || string_agg('"' || cluster || '":[' || nodes || ']', ','
  ORDER BY cluster) || '}}' AS payload FROM c GROUP BY user_id, batch),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', close_ts) ORDER BY close_ts, batch) AS k FROM batches)
SELECT user_id, batch, n, first_ts, close_ts, payload FROM r JOIN p USING (user_id, batch) WHERE k = 1"""


def _with_a_last_row(t: Tables, rows: DataFrame, at: str, name: str) -> str:
    """The rows as files, written in as many tasks as read them, and a last file whose row lets the watermark pass all others.

    A stream without ``files_per_batch`` takes all files in one micro-batch, so their order does not matter."""
    path = scratch_path(t.spark, name)
    later = rows.agg(F.max(at).alias("_last")).select(*[
        (F.col("_last") + F.expr("INTERVAL 60 DAYS")).alias(f.name) if f.dataType.typeName() == "timestamp"
        else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    rows.write.parquet(path)
    later.write.mode("append").parquet(path)
    return path


@query("alert_stream_payload", _USER_BATCHES)
def alert_stream_payload(t: Tables) -> DataFrame:
    """Alerts of each user on a stream: batches of five events or four hours with their payload, one a day."""
    rows = t.events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn(
        "cluster", F.concat(F.lit("c"), F.col("event_id") % 2))
    path = _with_a_last_row(t, rows, "ts", "alerts")
    stream = stream_table(t.spark, path, rows.schema)
    closed = acting_alerts(stream, "user_id", "ts", "event_id", ["cluster", "event_id"], 5, 4 * HOUR_US, 24 * HOUR_US)
    sent = closed.where("allowed AND key IS NOT NULL").select(
        F.col("key").alias("user_id"), "batch", "n", "first_ts", "close_ts", payload_of("items", "cluster", "event_id").alias("payload"))
    log = run_to_end(sent, name="alerts")
    return log.select("user_id", "batch", "n", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_ts", "close_ts")], "payload")


@query("trace_groups_stream", f"SELECT *, CAST(0 AS BIGINT) AS part FROM ({_GROUPS} SELECT * FROM c WHERE span_ms > {_MAXSPAN_MS})")
def trace_groups_stream(t: Tables) -> DataFrame:
    """The same traces from a stream."""
    times = {c: F.col(c).cast("timestamp") for c in ("start_time", "end_time")}
    rows = _spans(t.events).withColumns(times).select(
        "user_id", "event_id", "start_time", "end_time", json_encode("event_id", "event_type").alias("event"))
    path = _with_a_last_row(t, rows, "end_time", "traces")
    stream = stream_table(t.spark, path, rows.schema)
    groups = group_traces(stream, "user_id", "start_time", "end_time", "event_id", 6 * HOUR_US, F.col("event"), _MAXSPAN_MS)
    log = run_to_end(groups.where("user_id IS NOT NULL"), name="traces").drop("batch_id")
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts")}
    return log.withColumns(plain).withColumn("trace_events", F.array_join("trace_events", ","))


_CLOSED = f"""
WITH RECURSIVE s AS (SELECT user_id, event_id, ts AS start_time,
                  ts + to_microseconds(CAST(round(value * 1000) AS BIGINT)) AS end_time FROM events),
e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY end_time, event_id) AS rn FROM s),
w AS (SELECT user_id, rn, start_time, end_time, 0 AS g, end_time AS t0 FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.start_time, e.end_time,
    CASE WHEN epoch_us(e.end_time) - epoch_us(w.end_time) > 21600000000
      OR epoch_us(e.end_time) - epoch_us(w.t0) > {_MAXSPAN_MS}000 THEN w.g + 1 ELSE w.g END,
    CASE WHEN epoch_us(e.end_time) - epoch_us(w.end_time) > 21600000000
      OR epoch_us(e.end_time) - epoch_us(w.t0) > {_MAXSPAN_MS}000 THEN e.end_time ELSE w.t0 END
  FROM w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1)
SELECT user_id, min(start_time) AS start_ts, max(end_time) AS end_ts,
  (epoch_us(max(end_time)) - epoch_us(min(start_time))) // 1000 AS span_ms, count(*) AS n FROM w GROUP BY user_id, g"""


@query("expire_close_on_maxspan", _CLOSED)
def expire_close_on_maxspan(t: Tables) -> DataFrame:
    return expire.close_on_maxspan(
        _spans(t.events), ["user_id"], "start_time", "end_time", "event_id", 6 * HOUR_US, _MAXSPAN_MS * 1000
    )


@query("dedup_latest", "SELECT event_id, event_type, value FROM events")
def dedup_latest(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "value", F.lit(0).alias("batch_id"))
    replayed = rows.where("event_id % 10 = 0").withColumn("batch_id", F.lit(1))
    return latest_by_key(rows.unionByName(replayed), ["event_id"], ["batch_id"]).drop("batch_id")
