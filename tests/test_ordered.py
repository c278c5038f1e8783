"""Hot keys are split, and the answer does not change by it."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import alerts, emit, expire
from tidemark.operators.aggregates import exact_percentile, group_array
from tidemark.operators.ordered import Running, cut_into_chunks, previous, running

CHUNK_ROWS = 40


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and the NULL key hold most rows; many rows of the hot key share one time."""
    rng = random.Random(3)
    rows = []
    for seq in range(3000):
        key = rng.choice(["hot", "hot", "hot", None, f"k{rng.randrange(30)}"])
        at = 500 if key == "hot" and seq % 3 == 0 else rng.randrange(1000)
        rows.append((key, at, seq, None if seq % 11 == 0 else rng.randrange(100)))
    return spark.createDataFrame(rows, "key STRING, at BIGINT, seq BIGINT, v BIGINT").repartition(5).cache()


def _expected(rows, keys, order, update):
    """Brute force: walk each key's rows in order."""
    groups = {}
    for r in sorted(rows, key=lambda r: tuple(r[o] for o in order)):
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    return {r["seq"]: x for g in groups.values() for r, x in zip(g, update(g))}


def _walk(group):
    out, total, count, low, high, seen = [], None, 0, None, None, None
    for r in group:
        before = seen
        if r["v"] is not None:
            total = (total or 0) + r["v"]
            count += 1
            low = r["v"] if low is None else min(low, r["v"])
            high = r["v"] if high is None else max(high, r["v"])
            seen = high
        out.append((total, count, low, high, before))
    return out


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("rows_per_chunk", [CHUNK_ROWS, 1_000_000])
def test_running_matches_brute_force(skewed, keys, rows_per_chunk):
    v = F.col("v")
    columns = {
        "s": Running("sum", v), "c": Running("count", v), "lo": Running("min", v),
        "hi": Running("max", v), "before": Running("max", v, exclusive=True),
    }
    got = running(skewed, keys, ["at", "seq"], columns, rows_per_chunk).collect()
    want = _expected([r.asDict() for r in skewed.collect()], keys, ["at", "seq"], _walk)
    assert {r.seq: (r.s, r.c, r.lo, r.hi, r.before) for r in got} == want


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("rows_per_chunk", [CHUNK_ROWS, 1_000_000])
def test_previous_matches_brute_force(skewed, keys, rows_per_chunk):
    got = previous(skewed, keys, ["at", "seq"], "v", "p", -1, rows_per_chunk).collect()
    want = _expected([r.asDict() for r in skewed.collect()], keys, ["at", "seq"],
                     lambda g: [-1] + [r["v"] for r in g][:-1])
    assert {r.seq: r.p for r in got} == want


def test_chunks_are_small_and_ordered(skewed):
    chunked = cut_into_chunks(skewed, ["key"], ["at", "seq"], CHUNK_ROWS)
    assert chunked.split
    sizes = chunked.df.groupBy("key", "_chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("at", "seq")).alias("lo"), F.max(F.struct("at", "seq")).alias("hi")
    ).collect()
    assert max(r.n for r in sizes) <= 8 * CHUNK_ROWS  # the hot key has over 1,500 rows
    hot = sorted((r for r in sizes if r.key == "hot"), key=lambda r: r._chunk)
    assert len(hot) > 20
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(hot, hot[1:]))


def test_sampled_hot_key_detection(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    total = {"s": Running("sum", F.col("id"))}
    chunked = cut_into_chunks(rows, ["k"], ["id"], 10_000)
    assert chunked.split
    per_chunk = chunked.df.where("k = -1").groupBy("_chunk").count().collect()
    assert max(r["count"] for r in per_chunk) < 25_000
    got = running(rows, ["k"], ["id"], total, 10_000).where("k = -1").agg(F.max("s")).first()[0]
    assert got == sum(range(0, 200_000, 2))


@pytest.mark.parametrize("rows_per_chunk", [CHUNK_ROWS, 1_000_000])
def test_exact_percentile_of_hot_key(skewed, rows_per_chunk):
    got = exact_percentile(skewed, ["key"], {"p": "v", "q": "at"}, 0.9, rows_per_chunk).collect()
    want = skewed.groupBy("key").agg(
        F.percentile("v", 0.9).alias("p"), F.percentile("at", 0.9).alias("q")).collect()
    assert {r.key: (round(r.p, 6), round(r.q, 6)) for r in got} == {
        r.key: (round(r.p, 6), round(r.q, 6)) for r in want}


@pytest.mark.parametrize("rows_per_chunk", [CHUNK_ROWS, 1_000_000])
def test_group_array_in_parts(skewed, rows_per_chunk):
    got = group_array(skewed, ["key"], "seq", ["at", "seq"], "seqs", 100, rows_per_chunk).collect()
    assert max(len(r.seqs) for r in got) == 100
    whole = {}
    for r in sorted(got, key=lambda r: r.part):
        whole.setdefault(r.key, []).extend(r.seqs)
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: (r.at, r.seq)):
        want.setdefault(r.key, []).append(r.seq)
    assert whole == want


def _timed(skewed):
    at = F.timestamp_micros(F.col("at") * 1_000_000).cast("timestamp_ntz")
    return skewed.select("key", "seq", at.alias("start"), at.alias("end"))


@pytest.mark.parametrize("rows_per_chunk", [CHUNK_ROWS, 1_000_000])
def test_expire_partitions_the_rows(skewed, rows_per_chunk):
    rows = _timed(skewed)
    got = expire.expire_groups(rows, ["key"], "start", "end", 2_000_000, None, rows_per_chunk).collect()
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: r.at):
        groups = want.setdefault(r.key, [])
        if not groups or r.at - groups[-1][1] > 2:
            groups.append([r.at, r.at, 0])
        groups[-1][1], groups[-1][2] = r.at, groups[-1][2] + 1
    flat = sorted((str(k), a, b, n) for k, gs in want.items() for a, b, n in gs)
    zero = __import__("datetime").datetime(1970, 1, 1)
    sec = lambda t: int((t - zero).total_seconds())
    assert sorted((str(r.key), sec(r.start_ts), sec(r.end_ts), r.n) for r in got) == flat
    assert sum(r.n for r in got) == skewed.count()


def test_trace_parts_are_whole(skewed):
    rows = _timed(skewed)
    got = expire.trace_groups(
        rows, ["key"], "start", "end", 2_000_000, F.col("seq"), ["end", "seq"], None, 50, CHUNK_ROWS
    ).collect()
    assert max(len(r.trace_events) for r in got) <= 50
    assert sorted(s for r in got for s in r.trace_events) == list(range(3000))
    for key, start in {(r.key, r.start_ts) for r in got}:
        parts = sorted((r for r in got if (r.key, r.start_ts) == (key, start)), key=lambda r: r.part)
        assert [p.part for p in parts] == list(range(len(parts)))
        assert sum(len(p.trace_events) for p in parts) == parts[0].n


def _greedy(times, size, timeout):
    out, first, n, batch = [], None, 0, -1
    for t in times:
        if n == 0 or n == size or t > first + timeout:
            batch, n, first = batch + 1, 0, t
        n += 1
        out.append(batch)
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 64])
@pytest.mark.parametrize("timeout", [0, 3, 200])
def test_greedy_batches_of_hot_key(skewed, size, timeout):
    rows = skewed.select("key", "seq", F.timestamp_micros(F.col("at") * 1_000_000).alias("ts"))
    got = alerts.greedy_batches(rows, ["key"], "ts", "seq", size, timeout * 1_000_000, CHUNK_ROWS).collect()
    want = _expected([r.asDict() for r in skewed.collect()], ["key"], ["at", "seq"],
                     lambda g: _greedy([r["at"] for r in g], size, timeout))
    assert {r.seq: r.batch for r in got} == want


def test_periodic_repeats_quiet_ticks(skewed):
    rows = skewed.select("key", "v", F.timestamp_micros(F.col("at") * 1_000_000).cast("timestamp_ntz").alias("ts"))
    columns = {"n": Running("count", F.lit(1))}
    got = emit.emit_periodic(rows.where("key = 'k1'"), ["key"], "ts", "10 seconds", columns, 3).collect()
    ticks = sorted(r.tick for r in got)
    assert (ticks[-1] - ticks[0]).total_seconds() == 10 * (len(ticks) - 1)
    assert max(r.n for r in got) == skewed.where("key = 'k1'").count()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times=st.lists(st.integers(0, 60), min_size=1, max_size=60), size=st.integers(1, 6), timeout=st.integers(0, 9))
def test_greedy_batches_property(spark, times, size, timeout):
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "at BIGINT, seq BIGINT").select(
        F.timestamp_micros(F.col("at") * 1_000_000).alias("ts"), "seq")
    got = alerts.greedy_batches(rows, [], "ts", "seq", size, timeout * 1_000_000, 7).collect()
    ordered = sorted(range(len(times)), key=lambda i: (times[i], i))
    want = dict(zip(ordered, _greedy([times[i] for i in ordered], size, timeout)))
    assert {r.seq: r.batch for r in got} == want
