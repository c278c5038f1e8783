"""Streams that act, gather traces and tail files; groups that close early; imports in one pass."""

import datetime as dt
import glob
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, emit, expire, latest
from tidemark.operators.aggregates import latest as latest_value
from tidemark.operators.keyed import KeyedTable
from tidemark.operators.ordered import Running
from tidemark.sources import files, logs, tail
from tidemark.streaming.alerts import act_once, acting_alerts, payload_of
from tidemark.streaming.shared import Aggregation, RefreshedSide, SharedViews
from tidemark.streaming.traces import trace_groups_stream
from tidemark.streaming.views import View, run_to_end, stream_table

SECOND = 1_000_000
START = dt.datetime(2024, 1, 1)
ALERTS = "k BIGINT, ts TIMESTAMP, seq BIGINT, cluster STRING"


def add_file(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)  # files are taken by their time


def some_rows(rng, n=300):
    at, rows = 0, []
    for seq in range(n):
        at += rng.choice([0, 1, 1, 2, 5, 30])
        rows.append((rng.choice([1, 1, 1, 2, None]), START + dt.timedelta(seconds=at), seq, rng.choice(["a", "b"])))
    return rows


def later(key=9):
    return [(key, START + dt.timedelta(days=9), 10 ** 6, "z")]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_streaming_alerts_carry_what_the_batch_form_says(spark, folder):
    rows = some_rows(random.Random(1))
    for k in range(0, 300, 60):
        add_file(spark, f"{folder}/in", rows[k:k + 60], ALERTS)
    add_file(spark, f"{folder}/in", later(), ALERTS)
    table = spark.createDataFrame(rows, ALERTS)
    batched = alerts.greedy_batches(table, ["k"], "ts", "seq", 4, 20 * SECOND)
    whole = alerts.alert_batches(table, ["k"], "ts", "seq", 4, 20 * SECOND)
    first = alerts.rate_limit(whole, ["k"], "1 minute").drop("suppressed")
    payloads = alerts.alert_payload(batched, ["k", "batch"], "cluster", "seq")
    want = first.join(payloads, first.k.eqNullSafe(payloads.k) & (first.batch == payloads.batch)).select(
        first.k, first.batch, "n", "first_ts", "close_ts", "payload")
    stream = stream_table(spark, f"{folder}/in", spark.createDataFrame([], ALERTS).schema, files_per_batch=1)
    sent = acting_alerts(stream, "k", "ts", "seq", ["cluster", "seq"], 4, 20 * SECOND, 60 * SECOND)
    log = run_to_end(sent)
    got = log.where("allowed and (key is null or key < 9)").select(
        "key", "batch", "n", "first_ts", "close_ts", payload_of("items", "cluster", "seq").alias("payload"))
    assert sorted_rows(got) == sorted_rows(want) and want.count() > 20
    # every held-back batch is told of by the next allowed one, or still open at the end
    told = log.where("key = 1").agg(F.sum("suppressed"), F.count_if(~F.col("allowed"))).first()
    assert 0 < told[0] <= told[1]


def test_streaming_alerts_keep_many_keys_in_a_bucket(spark, folder):
    rng, at, rows = random.Random(4), 0, []
    for seq in range(400):
        at += rng.choice([0, 1, 1, 2, 5, 30])
        rows.append((rng.choice([*range(12), None]), START + dt.timedelta(seconds=at), seq, rng.choice(["a", "b"])))
    for k in range(0, 400, 80):
        add_file(spark, f"{folder}/in", rows[k:k + 80], ALERTS)
    add_file(spark, f"{folder}/in", later(99), ALERTS)
    stream = stream_table(spark, f"{folder}/in", spark.createDataFrame([], ALERTS).schema, files_per_batch=1)
    whole = alerts.alert_batches(spark.createDataFrame(rows, ALERTS), ["k"], "ts", "seq", 4, 20 * SECOND)
    for buckets in (2, 4096):
        sent = acting_alerts(stream, "k", "ts", "seq", ["cluster", "seq"], 4, 20 * SECOND, buckets=buckets)
        # no processor that asks for the state of each key by itself
        assert "transformwithstate" not in sent._jdf.queryExecution().analyzed().toString().lower()
        got = run_to_end(sent).where("key is null or key < 99").select("key", "batch", "n", "first_ts", "close_ts")
        assert sorted_rows(got) == sorted_rows(whole) and got.count() > 100


def test_the_action_is_called_once_through_restart_and_replay(spark, folder):
    calls = f"{folder}/calls"
    os.mkdir(calls)

    def action(identity, payload):
        with open(f"{calls}/{os.getpid()}", "a") as out:
            out.write(json.dumps([identity, payload]) + "\n")

    def called():
        return sorted(line for f in glob.glob(f"{calls}/*") for line in open(f))

    schema = spark.createDataFrame([], ALERTS).schema
    batches = []
    act = act_once(f"{folder}/ledger", F.concat_ws("-", "key", "batch"), payload_of("items", "cluster", "seq"), action,
                   store=lambda batch, n: batches.append((n, batch.count())))

    def build():
        stream = stream_table(spark, f"{folder}/in", schema, files_per_batch=1)
        return acting_alerts(stream, "k", "ts", "seq", ["cluster", "seq"], 3, 20 * SECOND, 60 * SECOND)

    rows = some_rows(random.Random(2), 120)
    view = View(spark, None, build, act, f"{folder}/checkpoint")
    add_file(spark, f"{folder}/in", rows[:60], ALERTS)
    view.start().wait()
    add_file(spark, f"{folder}/in", rows[60:], ALERTS)
    add_file(spark, f"{folder}/in", later(), ALERTS)
    view.start().wait()
    once = called()
    stream = stream_table(spark, f"{folder}/in", schema, files_per_batch=1)
    want = run_to_end(acting_alerts(stream, "k", "ts", "seq", ["cluster", "seq"], 3, 20 * SECOND, 60 * SECOND)).where("allowed")
    names = sorted(f"{r.key}-{r.batch}" if r.key is not None else str(r.batch) for r in want.collect())
    assert sorted(json.loads(c)[0] for c in once) == names and len(names) > 5
    # a replay of a batch that was done calls nothing
    frame = want.drop("batch_id")
    number = max(n for n, _ in batches)
    act(frame, number)
    assert called() == once
    act(frame, number + 1)
    assert len(called()) == 2 * len(once)


TRACES = "k BIGINT, s TIMESTAMP, e TIMESTAMP, seq BIGINT"


def some_spans(rng, n=400):
    at, rows = 0, []
    for seq in range(n):
        at += rng.choice([0, 1, 2, 9, 40])
        end = START + dt.timedelta(seconds=at)
        rows.append((rng.choice([1, 2, 3, None]), end - dt.timedelta(seconds=rng.randint(0, 5)), end, seq))
    return rows


@pytest.mark.parametrize("per_part, maxspan", [(100_000, None), (3, 20_000)])
def test_streaming_traces_equal_the_batch_form(spark, folder, per_part, maxspan):
    rng = random.Random(3)
    rows = some_spans(rng)
    table = spark.createDataFrame(rows, TRACES)
    want = expire.trace_groups(table, ["k"], "s", "e", 30 * SECOND, F.concat(F.lit("e"), "seq"), ["e", "seq"], maxspan, per_part)
    for k in range(0, 400, 100):  # rows change places within and across files
        part = rows[k:k + 100]
        if k:
            part[:10], swapped = swapped, part[:10]  # noqa: F821
        else:
            swapped = part[-10:]
            part = part[:-10]
        rng.shuffle(part)
        add_file(spark, f"{folder}/in", part, TRACES)
    add_file(spark, f"{folder}/in", swapped, TRACES)
    add_file(spark, f"{folder}/in", [(9, *[START + dt.timedelta(days=30)] * 2, 0), (9, None, None, 1)], TRACES)
    stream = stream_table(spark, f"{folder}/in", table.schema, files_per_batch=1)
    log = run_to_end(trace_groups_stream(
        stream, "k", "s", "e", "seq", 30 * SECOND, F.concat(F.lit("e"), "seq"), maxspan, "1 day", per_part))
    columns = ["k", "part", "start_ts", "end_ts", "span_ms", "n", "trace_events"]
    got = log.where("k is null or k < 9").select(columns)
    assert sorted_rows(got) == sorted_rows(want.select(columns)) and got.count() > 10


def test_streaming_traces_are_gathered_without_calls_for_each_event(spark, folder):
    rows = [(k, START + dt.timedelta(hours=h), START + dt.timedelta(hours=h), 100 * k + h) for k in range(3) for h in range(40)]
    add_file(spark, f"{folder}/in", rows, TRACES)
    add_file(spark, f"{folder}/in", [(None, *[START + dt.timedelta(days=30)] * 2, 0)], TRACES)
    stream = stream_table(spark, f"{folder}/in", spark.createDataFrame([], TRACES).schema)
    groups = trace_groups_stream(stream, "k", "s", "e", "seq", 1800 * SECOND, F.concat(F.lit("e"), "seq"))
    assert "transformwithstate" not in groups._jdf.queryExecution().analyzed().toString().lower()
    # a filter on the key does not hold back the watermark, which passes by the rows of all keys
    got = run_to_end(groups.where("k is not null"))
    assert sorted((r.k, r.trace_events) for r in got.collect()) == sorted((r[0], [f"e{r[3]}"]) for r in rows)


def groups_by_brute_force(rows, timeout, maxspan):
    out, held = {}, {}
    for k, s, e, seq in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[3])):
        opened, last, number = held.get(k, (None, None, -1))
        if opened is None or (e - last).total_seconds() > timeout or (e - opened).total_seconds() > maxspan:
            opened, number = e, number + 1
        held[k] = (opened, e, number)
        out.setdefault((k, number), []).append((s, e))
    return sorted(((k, min(s for s, _ in g), max(e for _, e in g), len(g)) for (k, _), g in out.items()), key=repr)


@pytest.mark.parametrize("per_chunk, per_batch", [(10 ** 6, 10_000), (10 ** 6, 7), (40, 10_000), (25, 6)])
def test_groups_close_on_their_span(spark, per_chunk, per_batch):
    rng = random.Random(per_chunk + per_batch)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        for step in (1, 3):
            rows = [(k, s, START + (e - START) / step, q) for k, s, e, q in some_spans(rng, 500)] + [(1, START, None, 999)]
            made = expire.close_on_maxspan(
                spark.createDataFrame(rows, TRACES), ["k"], "s", "e", "seq", 30 * SECOND, 25 * SECOND, per_chunk)
            got = sorted((tuple(r) for r in made.select("k", "start_ts", "end_ts", "n").collect()), key=repr)
            assert got == groups_by_brute_force(rows, 30, 25)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# -- log files that grow ----------------------------------------------------------------------------

def record(n, lines=0):
    return f"2024.01.01 00:00:{n % 60:02d}.{n:06d} [ {n} ] {{q}} <Information> m{n}" + "".join(f"\n  more {k}" for k in range(lines))


def test_a_growing_log_gives_each_record_once(spark, folder):
    path, out, checkpoint = f"{folder}/logs", f"{folder}/out", f"{folder}/ck"
    os.mkdir(path)
    wanted = []

    def write(name, text, mode="a"):
        with open(f"{path}/{name}", mode) as file:
            file.write(text)

    def add(name, numbers):
        for n in numbers:
            wanted.append(record(n, n % 3))
            write(name, wanted[-1] + "\n")

    def rows():
        return sorted(r.raw for r in spark.read.schema("raw STRING").parquet(out).collect())

    def start(idle=None):
        return View(spark, None, lambda: tail.log_tail(spark, path, "*.log*", idle_seconds=idle, range_bytes=500).select("raw"),
                    out, checkpoint, every="0 seconds").start()

    view = start()
    add("a.log", range(20))
    add("b.log", range(100, 103))
    view.query.processAllAvailable()
    # the last record of each file may go on
    assert rows() == sorted(w for w in wanted if w not in (record(19, 1), record(102, 0)))
    write("a.log", "  and on\n  and")
    view.query.processAllAvailable()
    write("a.log", " on\n")
    wanted[19] += "\n  and on\n  and on"
    add("a.log", range(20, 25))
    view.query.processAllAvailable()
    assert wanted[19] in rows() and len(rows()) == 26
    view.pause()
    # while it is stopped, one file is rotated and another one takes its name
    add("a.log", range(25, 30))
    os.rename(f"{path}/a.log", f"{path}/a.log.1")
    add("a.log", range(200, 205))
    view = start()
    view.query.processAllAvailable()
    add("a.log.1", range(30, 31))
    view.query.processAllAvailable()
    view.pause()
    view = start(idle=0)
    view.query.processAllAvailable()
    view.pause()
    assert rows() == sorted(wanted)


def test_a_shortened_file_starts_anew(folder):
    reader = tail._Tail({"path": folder})
    with open(f"{folder}/x", "w") as file:
        file.write(record(1) + "\n" + record(2) + "\n")
    first = reader.latestOffset()
    with open(f"{folder}/x", "w") as file:
        file.write(record(5) + "\n" + record(6) + "\n")
    second = reader.latestOffset()
    if second == first:  # same size: it is told apart by its time only when it is looked into again
        second = tail._Tail({"path": folder}).latestOffset()
    ranges = reader.partitions(first, second)
    assert [(r.start, r.upto) for r in ranges] == [(0, len(record(5)) + 1)]


def test_records_are_bounded(spark, folder):
    with open(f"{folder}/long.log", "w") as file:
        file.write(record(1) + "\n" + "x" * 5000 + "\n" + record(2) + "\n")
    with open(f"{folder}/headless.log", "w") as file:
        file.write("no header here\n" * 900)
    for name in ("long", "headless"):
        listed = logs.log_files(spark, f"{folder}/{name}.log")
        with pytest.raises(Exception, match="longer than 3000 bytes"):
            logs.log_records(listed, range_bytes=700, longest=3000).collect()
        whole = logs.log_records(listed, range_bytes=700, longest=20_000).collect()
        assert len(whole) == (2 if name == "long" else 1)
    with pytest.raises(logs.RecordTooLong):
        tail._Tail({"path": folder, "files": "headless*", "longest": "3000"}).latestOffset()


# -- imports and ticks ------------------------------------------------------------------------------

def test_an_import_is_kept_within_its_budget_only(spark, folder):
    with open(f"{folder}/in.csv", "w") as file:
        file.write("".join("bad,\n" if k % 10 == 0 else f"{k},n{k}\n" for k in range(100)))
    schema = files.with_corrupt(spark.createDataFrame([], "a INT, b STRING").schema)
    parsed = files.read_csv(spark, f"{folder}/in.csv", schema)
    with pytest.raises(files.TooManyBadRows):
        files.import_within_budget(parsed, f"{folder}/t", f"{folder}/r", most=9)
    assert sorted(os.listdir(folder)) == ["in.csv"]
    assert files.import_within_budget(parsed, f"{folder}/t", f"{folder}/r", most=10, ratio=0.1) == (90, 10)
    assert spark.read.parquet(f"{folder}/t").agg(F.sum("a")).first()[0] == sum(k for k in range(100) if k % 10)
    assert {r[files.CORRUPT] for r in spark.read.parquet(f"{folder}/r").collect()} == {"bad,"}
    with pytest.raises(FileExistsError):
        files.import_within_budget(parsed, f"{folder}/t", f"{folder}/r2")


def test_long_gaps_are_cut(spark):
    rows = [(1, START), (1, START + dt.timedelta(days=3)), (2, START + dt.timedelta(days=1))]
    table = spark.createDataFrame(rows, "k INT, ts TIMESTAMP")
    made = emit.emit_periodic(table, ["k"], "ts", "2 seconds", {"n": Running("count", F.lit(1))})
    ticks = 3 * 43_200 + 1
    assert made.groupBy("k", "n").count().orderBy("k", "n").collect() == [(1, 1, ticks - 1), (1, 2, 1), (2, 1, 2 * 43_200 + 1)]
    assert made.distinct().count() == made.count()


# -- many views over one source, refreshed sides, ties ----------------------------------------------

def test_shared_views_read_the_source_once_and_equal_their_own_runs(spark, folder):
    schema = "k BIGINT, ts TIMESTAMP, seq BIGINT, cluster STRING"
    rows = some_rows(random.Random(4), 120)
    for k in range(0, 120, 40):
        add_file(spark, f"{folder}/in", rows[k:k + 40], schema)
    columns = {"n": Running("count", F.lit(1)), "s": Running("sum", F.col("seq")), "least": Running("min", F.col("ts"))}
    views = [Aggregation(f"v{m}", ["k", "cluster"][:m % 3], columns, F.col("seq") % 5 != m) for m in range(20)]
    shared = SharedViews(spark, f"{folder}/views", views)
    batches = []

    def on_batch(batch, batch_id):
        shared(batch, batch_id)
        batches.append((batch, batch_id))

    frame = spark.createDataFrame([], schema).schema
    view = View(spark, None, lambda: stream_table(spark, f"{folder}/in", frame, files_per_batch=1), on_batch, f"{folder}/ck")
    view.start().wait()
    assert shared.reads == [0, 1, 2]
    table = spark.createDataFrame(rows, schema)
    for one in views:
        assert sorted_rows(shared.read(one.name)) == sorted_rows(one.partial(table))
    # a replay of the last batch of which one target got lost gives the same, and none that is whole is touched
    import shutil
    target = f"{folder}/views/v7/batch_id=2"
    shutil.rmtree(target)
    again = spark.createDataFrame(rows[80:], schema)
    shared(again, 2)
    shared(again, 2)
    assert shared.reads == [0, 1, 2, 2]
    assert all(sorted_rows(shared.read(one.name)) == sorted_rows(one.partial(table)) for one in views)


def test_a_replayed_batch_sees_the_same_side(spark, folder):
    now, loads = [1000.0], []

    def load():
        loads.append(now[0])
        return spark.createDataFrame([(1, f"at {now[0]:.0f}")], "k INT, name STRING")

    def side(keep=3):
        return RefreshedSide(spark, load, f"{folder}/side", 60, lambda: now[0], keep)

    def seen(batch_id, table=None):
        return (table or side()).at(batch_id).first().name

    assert [seen(0), seen(1)] == ["at 1000", "at 1000"]
    now[0] = 1059
    assert seen(2) == "at 1000"
    now[0] = 1061
    assert seen(3) == "at 1061" and loads == [1000, 1061]
    now[0] = 5000
    assert seen(2) == "at 1000" and seen(3) == "at 1061"  # replays, by a new object as after a restart
    assert seen(4) == "at 5000"
    assert [seen(n) for n in (5, 6)] == ["at 5000"] * 2
    assert sorted(f for f in os.listdir(f"{folder}/side") if f.startswith("side=")) == ["side=5000000-4"]


def test_equal_keys_of_one_change_have_a_defined_winner(spark, folder):
    rows = [(1, k, f"v{k * 7919 % 4000}") for k in range(4000)]
    table = spark.createDataFrame(rows, "k INT, place INT, v STRING")
    winners = set()
    for n, parts in enumerate((1, 3, 8)):
        keyed = KeyedTable(spark, f"{folder}/{n}", spark.createDataFrame([], "k INT, v STRING").schema, ["k"], buckets=2)
        keyed.upsert(table.drop("place").repartition(parts))
        winners.add(keyed.read().first().v)
        keyed.upsert(table.repartition(parts), input_order="place")
        assert keyed.read().first().v == rows[-1][2]
    assert len(winners) == 1


def test_latest_values_of_fixed_width_need_no_sort(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("p"), F.col("id").alias("seq"), (F.col("id") * 1.5).alias("v"))
    joined = latest.full_latest_join(
        {"a": rows.withColumnRenamed("v", "va"), "b": rows.where("seq % 2 = 0").withColumnRenamed("v", "vb")}, "p", "seq")
    assert "SortAggregate" not in joined._jdf.queryExecution().executedPlan().toString()
    by_key = rows.groupBy("p").agg(latest_value("v", "seq").alias("v"))
    assert "SortAggregate" not in by_key._jdf.queryExecution().executedPlan().toString()
    assert {r.p: r.va for r in joined.collect()} == {r.p: r.v for r in by_key.collect()}


@pytest.mark.parametrize("per_batch", [10_000, 3])
def test_batches_do_not_depend_on_how_rows_arrive(spark, per_batch):
    rng = random.Random(per_batch)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        rows = some_rows(rng, 400)
        for per_chunk in (10 ** 6, 30):
            made = alerts.greedy_batches(spark.createDataFrame(rows, ALERTS), ["k"], "ts", "seq", 4, 20 * SECOND, per_chunk)
            state, want = {}, {}
            for k, ts, seq, _ in rows:
                batch, n, first = state.get(k, (-1, 4, None))
                if n == 4 or (ts - first).total_seconds() > 20:
                    batch, n, first = batch + 1, 0, ts
                state[k], want[seq] = (batch, n + 1, first), batch
            assert {r.seq: r.batch for r in made.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.9, 1.0])
def test_percentiles_are_exact_and_shuffle_few_values(spark, monkeypatch, fraction):
    import numpy as np

    from tidemark.operators import aggregates
    monkeypatch.setattr(aggregates, "SKETCH", 200)
    rng = np.random.default_rng(6)
    groups = {1: rng.normal(size=30_000), 2: np.repeat(rng.normal(size=5), 700), 3: rng.normal(size=1), 4: rng.normal(size=2),
              None: rng.normal(size=11), 5: []}
    rows = [(k, float(v), float(-v)) for k, vs in groups.items() for v in vs] + [(5, None, None), (1, None, 3.0)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(None if k is None else int(k), v, w) for k, v, w in rows], "k INT, v DOUBLE, w DOUBLE")
    made = {r.k: r for r in aggregates.exact_percentile(table, ["k"], {"a": "v", "b": "w"}, fraction, 50).collect()}
    for k in groups:
        for name, place in (("a", 1), ("b", 2)):
            mine = [r[place] for r in rows if r[0] == k and r[place] is not None]
            if not mine:
                assert made[k][name] is None
            else:
                assert made[k][name] == pytest.approx(np.quantile(mine, fraction), rel=1e-12, abs=1e-12)
    whole = aggregates.exact_percentile(table, [], {"a": "v"}, fraction).first().a
    assert whole == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], fraction), rel=1e-12, abs=1e-12)
