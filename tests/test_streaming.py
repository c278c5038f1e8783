"""Streams give the answers of the batch forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, expire, latest
from tidemark.operators.keyed import KeyedTable
from tidemark.sinks.custom import SinkFunctions, event_sink, register_sink, rest_body, rest_headers, rest_sink
from tidemark.sources import generate, kafka, logs
from tidemark.streaming import emit as S
from tidemark.streaming.views import View, dropped_late_rows, run_to_end, snapshot_into, stream_table

SECOND = 1_000_000


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Rows in five files, in event order, and a last file with a far-future row that flushes timers."""
    root = str(tmp_path_factory.mktemp("arrivals"))
    rows = spark.range(400).select(
        (F.col("id") % 7).alias("k"), F.col("id").alias("seq"),
        F.timestamp_micros((F.lit(1_700_000_000) + F.col("id") * 3 + F.when(F.col("id") % 50 > 25, 100).otherwise(0) + F.col("id").bitwiseAND(1)) * SECOND).alias("ts"),
        (F.col("id") % 13).alias("v"),
    ).orderBy("ts", "seq").collect()
    schema = "k BIGINT, seq BIGINT, ts TIMESTAMP, v BIGINT"
    rows.sort(key=lambda r: (r.ts, r.seq))
    for i in range(5):
        spark.createDataFrame(rows[i * 80:(i + 1) * 80], schema).coalesce(1).write.mode("append").parquet(root)
    spark.createDataFrame([(99, 10_000, dt.datetime(2030, 1, 1), 0)], schema).coalesce(1).write.mode("append").parquet(root)
    return root


def _stream(spark, root, **kw):
    schema = spark.read.parquet(root).schema
    return stream_table(spark, root, schema, files_per_batch=1, **kw)


def _last(log, keys):
    return latest.latest_by_key(log, keys, ["batch_id"]).drop("batch_id")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_on_update_last_emission_is_the_batch_answer(spark, arrivals):
    aggregates = [F.count("*").alias("c"), F.sum("v").alias("s"), F.min("v").alias("mn"), F.max("v").alias("mx")]
    log = run_to_end(S.on_update(_stream(spark, arrivals), ["k"], aggregates), "update")
    assert log.select("batch_id").distinct().count() == 6
    want = spark.read.parquet(arrivals).groupBy("k").agg(*aggregates)
    assert _rows(_last(log, ["k"])) == _rows(want)


def test_periodic_emits_whole_result_each_time(spark, arrivals):
    log = run_to_end(S.periodic(_stream(spark, arrivals), [], [F.count("*").alias("total")]), "complete")
    totals = [r.total for r in log.orderBy("batch_id").collect()]
    assert totals == [80, 160, 240, 320, 400, 401]


def test_rate_between_emissions(spark, arrivals, folder):
    write = S.rate_writer(f"{folder}/eps", "total", 2)

    def twice(batch, batch_id):  # a replay changes nothing
        write(batch, batch_id)
        write(batch, batch_id)

    build = lambda: S.periodic(_stream(spark, arrivals), [], [F.count("*").alias("total")])
    View(spark, "eps", build, twice, f"{folder}/ck", "complete").start().wait()
    got = spark.read.parquet(f"{folder}/eps").orderBy("batch_id").select("total", "prev", "eps")
    assert [tuple(r) for r in got.collect()] == [
        (80, 0, 40), (160, 80, 40), (240, 160, 40), (320, 240, 40), (400, 320, 40), (401, 400, 0)]


def test_discarding_sinks(spark, arrivals, folder):
    from tidemark.sinks.files import discard
    discard(spark.range(5))
    view = View(spark, None, lambda: _stream(spark, arrivals), None, f"{folder}/ck").start().wait()
    assert sum(p.numInputRows for p in view.query.recentProgress) == 401


def test_full_latest_join(spark, arrivals):
    def sides(df):
        df = df.withColumn("p", F.when(F.col("k") != 3, F.col("k")))
        return {
            n: df.where(F.col("seq") % 3 == i).select("p", "seq", F.col("v").alias(f"v{n}"))
            for i, n in enumerate("abc")
        }

    log = run_to_end(
        latest.full_latest_join(sides(_stream(spark, arrivals)), "p", "seq", flatten=False)
        .select("p", "a", "b", "c", F.when(F.col("p").isNull(), F.col("a").isNull().cast("int") * 2 + F.col("b").isNull().cast("int")).alias("apart")),
        "update",
    )
    got = _last(log, ["p", "apart"]).select("p", "a.va", "b.vb", "c.vc")
    want = latest.full_latest_join(sides(spark.read.parquet(arrivals)), "p", "seq")
    key = repr
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("maxspan", [None, 60_000])
def test_expired_groups(spark, arrivals, maxspan):
    table = spark.read.parquet(arrivals).where("k < 99")
    want = expire.expire_groups(table, ["k"], "ts", "ts", 30 * SECOND, maxspan)
    log = run_to_end(S.expire_stream(_stream(spark, arrivals), ["k"], "ts", "ts", "30 seconds", maxspan_ms=maxspan))
    got = log.where("k < 99").select("k", "start_ts", "end_ts", "span_ms", "n")
    assert _rows(got) == _rows(want) and want.count() > 5


def test_alert_batches(spark, arrivals):
    table = spark.read.parquet(arrivals).where("k < 99")
    want = alerts.alert_batches(table, ["k"], "ts", "seq", 5, 40 * SECOND)
    log = run_to_end(S.alert_stream(_stream(spark, arrivals), "k", "ts", "seq", 5, 40_000))
    got = log.where("key < 99").select("key", "batch", "n", "first_ts", "close_ts")
    assert _rows(got) == _rows(want.select("k", "batch", "n", "first_ts", "close_ts"))


def test_late_rows_are_dropped_and_counted(spark, folder):
    schema = "ts TIMESTAMP, v INT"
    for i, minute in enumerate((0, 30, 31, 1, 32)):  # a batch filters by the watermark of the one before
        row = [(dt.datetime(2024, 1, 1, 0, minute), i)]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    view = View(
        spark, "late",
        lambda: _stream(spark, f"{folder}/in").withWatermark("ts", "5 minutes")
        .groupBy(F.window("ts", "1 minute")).agg(F.count("*").alias("n")).select("window.start", "n"),
        f"{folder}/out", f"{folder}/ck",
    ).start().wait()
    assert dropped_late_rows(view.query) == 1


def test_dedup_within_watermark(spark, arrivals):
    twice = _stream(spark, arrivals).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert run_to_end(S.dedup_stream(twice, ["seq"], "ts", "1 hour")).count() == 401


def test_view_restart_keeps_an_upsert_target_exact(spark, arrivals, folder):
    source = spark.read.parquet(arrivals)
    table = KeyedTable(spark, f"{folder}/table", source.schema, ["k"], ["seq"], buckets=4)
    calls = []

    def sink(batch, batch_id):
        calls.append(batch_id)
        table.upsert(batch)
        if len(calls) == 3:
            raise RuntimeError("lost executor")  # after the write, before the commit

    view = View(spark, "restart", lambda: _stream(spark, arrivals), sink, f"{folder}/ck")
    with pytest.raises(Exception, match="lost executor"):
        view.start().wait()
    view.resume().wait()
    assert calls == [0, 1, 2, 2, 3, 4, 5]  # batch 2 is replayed
    want = latest.latest_by_key(source, ["k"], ["seq"])
    assert _rows(table.read()) == _rows(want.select(*source.columns))


def test_view_life_cycle(spark, arrivals, folder):
    out = f"{folder}/out"
    view = View(spark, "life", lambda: _stream(spark, arrivals).select("k", "seq"), out, f"{folder}/ck")
    view.start().wait()
    assert spark.read.parquet(out).count() == 401
    view.resume().wait()  # nothing new
    assert spark.read.parquet(out).count() == 401
    view.sink = f"{folder}/out2"
    view.recover(f"{folder}/ck2").wait()  # from the beginning
    assert spark.read.parquet(f"{folder}/out2").count() == 401
    view.pause()
    view.drop()
    from tidemark.sources.paths import exists
    assert not exists(spark, f"{folder}/out2") and not exists(spark, f"{folder}/ck2")


def test_periodic_view_can_be_stopped(spark, folder):
    stream = generate.generate_stream(spark, 50, {"device": F.concat(F.lit("d"), F.col("id") % 3)})
    view = View(spark, "rate", lambda: stream, f"{folder}/out", f"{folder}/ck", every="1 second").start()
    import time
    deadline = time.time() + 30
    while not any(p.numInputRows for p in view.query.recentProgress) and time.time() < deadline:
        time.sleep(0.5)
    view.abort()
    assert not view.query.isActive
    assert {r.device for r in spark.read.parquet(f"{folder}/out").collect()} <= {"d0", "d1", "d2"}


def test_snapshots_repeat_safely(spark, folder):
    for moment in ("2024-01-01 00:00:00", "2024-01-01 00:00:05", "2024-01-01 00:00:05"):
        snapshot_into(spark.range(3), folder, moment)
    assert spark.read.parquet(folder).count() == 6


def test_log_file_stream(spark, folder):
    import os
    for i in range(2):
        with open(os.path.join(folder, f"{i}.log"), "w") as f:
            f.write(f"2024.01.01 00:00:0{i}.5 [ 1 ] {{}} <Error> a: one\n  more\n2024.01.01 00:00:0{i}.6 [ 1 ] {{}} <Info> b: two\n")
    stream = logs.with_log_columns(logs.log_records(logs.log_file_stream(spark, folder, 1)))
    got = run_to_end(stream.select("event_time", "level", "message"))
    assert sorted((r.level, r.message) for r in got.collect()) == [
        ("Error", "a: one\n  more"), ("Error", "a: one\n  more"), ("Info", "b: two"), ("Info", "b: two")]


class _Outbox:
    """Transport that keeps requests in files, since tasks run in other processes."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, url, headers, body, timeout):
        import json, os, uuid
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            json.dump([url, dict(headers), body.decode()], f)

    def requests(self):
        import json, os
        return [json.load(open(os.path.join(self.folder, n))) for n in os.listdir(self.folder)]


def test_rest_sink_takes_a_stream(spark, arrivals, tmp_path):
    import json
    outbox = _Outbox(str(tmp_path / "box"))
    (tmp_path / "box").mkdir()
    register_sink(spark, "rest_test", rest_sink(outbox))
    q = (_stream(spark, arrivals).select("seq").writeStream.format("rest_test")
         .option("config", '{"url": "http://x/ingest", "api_key": "s"}')
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    requests = outbox.requests()
    assert sum(len(json.loads(r[2])["data"]) for r in requests) == 401
    assert {r[0] for r in requests} == {"http://x/ingest"}
    assert all(r[1]["X-Api-Key"] == "s" and json.loads(r[2])["columns"] == ["seq"] for r in requests)


def test_event_sink_fills_in_sourcetype(spark, tmp_path):
    import json
    (tmp_path / "box").mkdir()
    outbox = _Outbox(str(tmp_path / "box"))
    register_sink(spark, "event_test", event_sink(outbox))
    rows = spark.createDataFrame([("e1", None), ("e2", "other")], "event STRING, sourcetype STRING").coalesce(1)
    rows.write.format("event_test").option("config", '{"url": "http://x", "authorization": "T k"}').mode("append").save()
    (url, headers, body), = outbox.requests()
    assert headers["Authorization"] == "T k"
    assert [json.loads(x) for x in body.splitlines()] == [
        {"event": "e1", "sourcetype": "otel_trace"}, {"event": "e2", "sourcetype": "other"}]


def test_sink_tears_down_after_failure(spark, tmp_path):
    mark = str(tmp_path / "closed")

    def fail(state, columns):
        raise ValueError("refused")

    register_sink(spark, "bad_test", SinkFunctions(write=fail, deinit=lambda s: open(mark, "w").close()))
    with pytest.raises(Exception, match="refused"):
        spark.range(1).write.format("bad_test").mode("append").save()
    assert (tmp_path / "closed").exists()


def test_rest_details():
    assert rest_body({"a": [1, 2], "b": ["x", None]}) == b'{"columns": ["a", "b"], "data": [[1, "x"], [2, null]]}'
    assert rest_headers({"username": "u", "password": "p"})["Authorization"] == "Basic dTpw"


def test_kafka_options():
    assert kafka.merge_profile({"a": "1", "b": "2"}, {"b": "3"}) == {"a": "1", "b": "3"}
    assert kafka.parse_properties("queued.min.messages=10;x=y") == {"kafka.queued.min.messages": "10", "kafka.x": "y"}
    assert kafka.parse_partitions("0..3,7") == [0, 1, 2, 3, 7]
    got = kafka.source_options("b:9092", "t", "earliest", [0, 1], security={"security.protocol": "SASL_SSL"},
                               headers=True, max_offsets=5)
    assert got == {
        "kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest", "assign": '{"t": [0, 1]}',
        "includeHeaders": "true", "maxOffsetsPerTrigger": "5", "kafka.security.protocol": "SASL_SSL"}
    assert kafka.sink_options("b", "t", "queue.buffering.max.ms=100")["kafka.queue.buffering.max.ms"] == "100"
