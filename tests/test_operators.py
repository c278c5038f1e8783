"""Pinned rows and small fixtures per operator."""

import datetime as dt
import os
import random
import struct
from pathlib import Path

import pyarrow as pa
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tidemark.functions import json as J, scalars as S
from tidemark.operators import alerts, fanout as X, keyed, latest, lookup, reports, retention
from tidemark.operators.rename import rename_chain
from tidemark.plans import QUERIES
from tidemark.sinks import files as out, messages
from tidemark.sources import files, generate, jdbc, logs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_null_arithmetic(spark):
    rows = spark.sql("SELECT * FROM VALUES (NULL, NULL), (NULL, 2), (1, NULL), (1, 2) AS t(a, b)")
    a, b = F.col("a"), F.col("b")
    got = rows.select(S.null_plus(a, b), S.null_minus(a, b), S.null_least(a, b), S.null_greatest(a, b),
                      S.nullable_add(a, b)).collect()
    assert [tuple(r) for r in got] == [
        (None, None, None, None, None), (2, -2, 2, 2, 2), (1, 1, 1, 1, 1), (3, -1, 1, 2, 3)]
    S.register_sql_functions(spark)
    assert tuple(spark.sql("SELECT null_greatest3(NULL, -5, -2), null_least(3, 1), null_plus(NULL, NULL)").first()) == (
        -2.0, 1.0, None)
    S.register_sql_functions(spark, "BIGINT", "_long")
    S.register_sql_functions(spark, "TIMESTAMP_NTZ", "_time")
    S.register_sql_functions(spark, "STRING", "_text")
    assert spark.sql("SELECT null_plus_long(9007199254740993, NULL)").first()[0] == 9007199254740993
    assert spark.sql("SELECT null_least_text('b', 'a')").first()[0] == "a"
    assert str(spark.sql("SELECT null_greatest_time(TIMESTAMP_NTZ'2024-01-02', NULL)").first()[0]) == "2024-01-02 00:00:00"


def test_key_lists_are_typed(spark):
    from datetime import date, datetime
    from decimal import Decimal
    assert lookup.sql_key(date(2024, 1, 1)) == "DATE '2024-01-01'"
    assert lookup.sql_key(datetime(2024, 1, 1, 2)) == "TIMESTAMP '2024-01-01 02:00:00'"
    assert lookup.sql_key("it's") == "'it''s'" and lookup.sql_key(Decimal("1.50")) == "1.50"
    assert lookup.sql_key("a\\b") is None and lookup.sql_key(1.5) is None and lookup.sql_key(b"x") is None
    remote = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', 1), (DATE'2024-01-02', 2) AS t(d, x)")
    fetch = lookup.fetch_by_key_list(lambda where: remote.where(where), "d", remote)
    assert [r.x for r in fetch(remote.select("d").where("x = 2")).collect()] == [2]


def test_dead_letters_keep_the_message(spark):
    raws = ['{"event_type":"order","order_id":"a","amount":5}', '{"event_type":"order","order_id":"b","amount":"much"}',
            '{broken', None, '{"event_type":"other"}']
    rows = spark.createDataFrame([(k, r) for k, r in enumerate(raws)], "key INT, raw STRING")
    decoded = X.json_envelope(rows, {"event_type": "string", "order_id": "string", "amount": "double", "customer_id": "string"})
    dead = {r.key: (r.raw, r.reason) for r in X.unrouted(decoded).collect()}
    assert dead == {1: (raws[1], X.UNREADABLE), 2: (raws[2], X.UNREADABLE), 3: (None, X.UNREADABLE),
                    4: (raws[4], X.UNKNOWN_EVENT)}
    seen = {}
    run = X.Fanout(lambda df: X.json_envelope(df, {"event_type": "string", "order_id": "string", "amount": "double",
                                                   "customer_id": "string"}),
                   {"orders": X.orders_of}, lambda frame, name, batch: seen.setdefault(name, frame.collect()), X.unrouted)
    run(rows, 0)
    assert [r.order_id for r in seen["orders"]] == ["a"] and len(seen["dead_letters"]) == 4


def test_sql_inserts_replay(spark):
    from tidemark.sinks.files import sql_inserts
    rows = spark.sql("""SELECT * FROM VALUES
        (1, 'it''s \\\\ a\\nb', array(1, NULL), X'00FF', double('NaN'), map('k', 1.5D), named_struct('x', 'q'), DATE'2024-01-02',
         TIMESTAMP_NTZ'2024-01-02 03:04:05.678', 1.25BD, true),
        (2, NULL, NULL, NULL, double('-Infinity'), NULL, NULL, NULL, NULL, NULL, NULL),
        (3, '', array(), X'', 1e300D, map(), named_struct('x', CAST(NULL AS STRING)), NULL, NULL, 0.10BD, false)
        AS t(i, s, a, b, d, m, n, day, ts, c, f)""")
    rows.createOrReplaceTempView("insert_source")
    spark.sql("CREATE OR REPLACE TEMP VIEW insert_empty AS SELECT * FROM insert_source WHERE false")
    texts = [r.statement for r in sql_inserts(rows, "t").collect()]
    types = dict(rows.dtypes)
    back = []
    for text in texts:
        values = text[text.index("VALUES (") + 7:-1]
        row = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(rows.columns)})")
        back.append(tuple(row.selectExpr(*[f"CAST({c} AS {types[c]}) {c}" for c in rows.columns]).first()))
    assert repr(back) == repr([tuple(r) for r in rows.collect()])


def test_arrow_rewrite_leaves_no_old_part(spark, folder):
    rows = spark.range(10)
    files.write_arrow(rows.repartition(4), f"{folder}/a")
    files.write_arrow(rows.coalesce(1), f"{folder}/a")
    assert files.read_arrow(spark, f"{folder}/a/*.arrow", rows.schema).count() == 10


def test_vectorised_function_surface(spark):
    @F.pandas_udf("int")
    def plus(a, b):
        return a.fillna(0).add(b.fillna(0)).where(a.notna() | b.notna())

    rows = spark.sql("SELECT * FROM VALUES (NULL, NULL), (NULL, 2), (1, NULL), (1, 2) AS t(a, b)")
    assert [r[0] for r in rows.select(plus("a", "b")).collect()] == [None, 2, 1, 3]


def test_json_golden(spark):
    text = F.lit('{"key1":"value1","key2":"value2"}')
    pairs = one(spark, J.json_pairs_raw(text))
    assert [(p.key, p.raw) for p in pairs] == [("key1", '"value1"'), ("key2", '"value2"')]
    assert one(spark, J.json_to_map(text)) == {"key1": "value1", "key2": "value2"}
    assert one(spark, J.json_pairs_raw(F.lit("{broken"))) is None
    odd = one(spark, J.json_pairs_raw(F.lit(' {"z":1.50,"a\\"b":null , "m":{"x": [1, 2]},"e":1e2, "z":"\\u00e9"} ')))
    assert [(p.key, p.raw) for p in odd] == [
        ("z", "1.50"), ('a"b', "null"), ("m", '{"x": [1, 2]}'), ("e", "1e2"), ("z", '"\\u00e9"')]
    for broken in ("[1]", '{"a":1', '{"a" 1}', '{"a":1,}', '{"a":1} x', ""):
        assert one(spark, J.json_pairs_raw(F.lit(broken))) is None
    assert one(spark, J.json_pairs_raw(F.lit("{}"))) == []
    assert one(spark, J.json_path(F.lit('{"a": "x"}'), "a", "int")) is None


def test_dynamic_json(spark):
    rows = spark.sql("""SELECT try_parse_json(j) v FROM VALUES ('{"a":42}'), ('{"b":"Hello"}'),
                        ('{"a":[1,2,3],"c":"2020-01-01"}') AS t(j)""")
    assert rows.where("try_variant_get(v, '$.a', 'int') = 42").count() == 1
    assert "a: VARIANT" in rows.selectExpr("schema_of_variant_agg(v)").first()[0]


def test_text_and_sizes(spark):
    assert one(spark, S.extract(F.lit("x=12 y"), r"x=(\d+)")) == "12"
    assert one(spark, S.extract(F.lit("none"), r"x=(\d+)")) == ""
    assert one(spark, S.to_number(F.lit(""))) is None
    assert one(spark, S.to_time(F.lit("2024.01.02 03:04:05.123456"))) == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert [one(spark, S.readable_size(F.lit(n))) for n in (0, 1023, 1024, 5 << 20, 3 << 40)] == [
        "0.00 B", "1023.00 B", "1.00 KiB", "5.00 MiB", "3.00 TiB"]
    assert one(spark, S.to_time(F.lit("2024.01.02 03:04:05.12"))) == dt.datetime(2024, 1, 2, 3, 4, 5, 120000)
    assert one(spark, S.to_time(F.lit("2024.13.02 03:04:05.1"))) is None
    assert one(spark, S.readable_size(F.lit(None).cast("long"))) is None


def test_merge_columns_and_latest_join(spark):
    raws = {
        "kt1": '{"p":"p1","c1":"c1","c2":"c2"}', "kt2": '{"p":"p1","c3":"c3","c4":"c4"}',
        "kt3": '{"p":"p1","c5":"c5","c6":"c6"}'}
    sides = {}
    for i, (name, raw) in enumerate(raws.items()):
        columns = [J.json_path("raw", f"c{j}").alias(f"c{j}") for j in (2 * i + 1, 2 * i + 2)]
        sides[name] = spark.createDataFrame([(raw, i)], "raw STRING, seq INT").select(
            J.json_path("raw", "p").alias("p"), "seq", *columns)
    assert tuple(latest.full_latest_join(sides, "p", "seq").first()) == ("p1", "c1", "c2", "c3", "c4", "c5", "c6")
    partial = latest.full_latest_join({k: sides[k] for k in ("kt2", "kt3")}, "p", "seq")
    assert tuple(partial.first()) == ("p1", "c3", "c4", "c5", "c6")


def test_latest_join_keeps_null_values_of_the_latest_row(spark):
    a = spark.createDataFrame([("k", 1, 5), ("k", 2, None)], "p STRING, seq INT, va INT")
    b = spark.createDataFrame([("k", 1, 7), (None, 2, 8), (None, 3, 9)], "p STRING, seq INT, vb INT")
    got = latest.full_latest_join({"a": a, "b": b}, "p", "seq")
    assert sorted(map(tuple, got.collect()), key=repr) == [("k", None, 7), (None, None, 9)]


def test_two_tier_lookup_asks_only_for_missing_keys(spark):
    probe = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "zz")], "o INT, pid STRING")
    remote = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "id STRING, name STRING")
    cache = spark.createDataFrame([("a", "cached")], "id STRING, name STRING")
    asked = []

    def read(predicate):
        asked.append(predicate)
        return remote.where(predicate)

    fetch = lookup.fetch_by_key_list(read, "id", remote)
    got = lookup.two_tier_lookup(probe, cache, fetch, "pid", "id").select("o", "name").collect()
    assert sorted(map(tuple, got)) == [(1, "cached"), (2, "B"), (3, "cached")]
    assert sorted(asked[0].replace("id IN (", "").rstrip(")").split(", ")) == ["'b'", "'zz'"]
    many = lookup.fetch_by_key_list(read, "id", remote, most=1)
    assert lookup.two_tier_lookup(probe, cache, many, "pid", "id").count() == 3 and len(asked) == 1


def test_two_tier_lookup_asks_in_tasks(spark, folder):
    def ask(keys):
        import uuid
        from pathlib import Path
        import pandas as pd
        Path(folder, uuid.uuid4().hex).write_text(",".join(map(str, keys)))
        have = [k for k in keys if k % 2]
        return pd.DataFrame({"more": have, "name": [f"n{k}" for k in have], "id": have})

    probe = spark.range(5000).selectExpr("id AS o", "CASE WHEN id % 10 < 9 THEN id % 700 END AS pid")
    cache = spark.range(0, 700, 3).selectExpr("id", "'cached' AS name")
    fetch = lookup.fetch_in_tasks(ask, "id BIGINT, name STRING", keys_per_call=40)
    got = {tuple(r) for r in lookup.two_tier_lookup(probe, cache, fetch, "pid", "id").select("o", "pid", "name").collect()}
    pid = {o: o % 700 for o in range(5000) if o % 10 < 9}
    assert got == {(o, p, "n%d" % p if p % 3 else "cached") for o, p in pid.items() if p % 3 == 0 or p % 2}
    calls = [f.read_text().split(",") for f in Path(folder).iterdir()]
    assert max(map(len, calls)) <= 40
    assert sorted(int(k) for call in calls for k in call) == sorted({p for p in pid.values() if p % 3})
    # nothing is missing: nothing is asked, and the schema stands
    empty = lookup.two_tier_lookup(probe.where("pid % 3 = 0"), cache, fetch, "pid", "id")
    assert empty.where("name <> 'cached'").count() == 0 and len(list(Path(folder).iterdir())) == len(calls)


def test_shards_of_keys_stay_as_they_are(spark):
    """Stored data is laid out by these numbers, so they must never change."""
    values = [0, 1, 2, -7, 1 << 40, None]
    keys = spark.createDataFrame([(v,) for v in values], "k BIGINT")
    got = keys.select(S.shard_of("k", 8).alias("n"), S.shard_of(F.col("k").cast("string"), 1000).alias("t")).collect()
    assert [tuple(r) for r in got] == [(4, 860), (2, 760), (5, 769), (1, 970), (5, 189), (2, 42)]

    def hashed(data):  # another implementation of the same hash, signed as the engine has it
        return int.from_bytes(xxhash.xxh64_digest(data, seed=42), "big", signed=True)

    assert [tuple(r) for r in got[:-1]] == [
        (hashed(struct.pack("<q", v)) % 8, hashed(str(v).encode()) % 1000) for v in values[:-1]]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_with_hot_probe_keys(spark, how):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    probe = spark.range(3000).select("id", key.alias("k"))
    dim = spark.range(0, 2000).selectExpr("id AS d", "concat('v', id) AS v")
    got = lookup.lookup_join(probe, dim, "k", "d", how, split_hot=100)
    want = lookup.lookup_join(probe, dim, "k", "d", how)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "strategy=broadcast" in plan


def test_refreshing_lookup(spark):
    now, loads = [0.0], []

    def load():
        loads.append(1)
        return spark.range(len(loads))

    side = lookup.RefreshingLookup(load, 10, lambda: now[0])
    assert side.get().count() == 1
    now[0] = 9
    assert side.get().count() == 1
    now[0] = 11
    assert side.get().count() == 2
    fixed = lookup.RefreshingLookup(load, None, lambda: now[0])
    fixed.get()
    now[0] = 1e9
    fixed.get()
    assert len(loads) == 3


def test_rename_chain_stops_at_the_limit(spark):
    changes = spark.createDataFrame(
        [(f"f{i}", f"f{i - 1}", "Rename", i) for i in range(1, 10)]
        + [("f3", "older", "Rename", 99), ("g", "", "Add", 1), ("x", "y", "Modify", 1), ("c1", "c2", "Add", 1),
           ("c2", "c1", "Add", 1)],
        "path STRING, old_path STRING, change_type STRING, time INT")
    names = spark.createDataFrame([(n,) for n in ("f9", "f2", "g", "x", "", "c1")], "path STRING")
    got = {r.path: r.history for r in rename_chain(names, changes).collect()}
    assert got["f9"] == ["f9", "f8", "f7", "f6", "f5", "f4"]
    assert got["f2"] == ["f2", "f1", "f0"] and got["g"] == ["g"] and got["x"] == ["x"] and got[""] == []
    assert got["c1"] == ["c1", "c2"] * 3
    assert len(rename_chain(names, changes, 4).where("path = 'f9'").first().history) == 4


TX = "id STRING, value BIGINT, created_at TIMESTAMP_NTZ, seq BIGINT"


def test_keyed_table(spark, folder):
    table = keyed.KeyedTable(spark, f"{folder}/t", T._parse_datatype_string(TX), ["id"], ["seq"], 4, ["id"])
    assert table.read().count() == 0
    base = spark.range(100).selectExpr("concat('id_', id) id", "id value", "TIMESTAMP_NTZ'2024-01-01' created_at", "1L seq")
    table.upsert(base)
    table.upsert(spark.createDataFrame([("id_5", 500, 2), ("new", 1, 2)], "id STRING, value BIGINT, seq BIGINT"))
    row = table.read().where("id = 'id_5'").first()
    assert (row.value, row.created_at) == (500, None) and table.read().count() == 101
    table.upsert(spark.createDataFrame([("id_5", -1, 1)], "id STRING, value BIGINT, seq BIGINT"))
    assert keyed.point_read(table.read(), id="id_5").first().value == 500
    table.delete(F.col("id") == "id_6")
    table.delete(F.col("id").between("id_70", "id_75"))
    assert table.read().count() == 94
    assert keyed.range_read(table.read(), "id", "id_60", "id_79").count() == 15  # id_60..69, id_7, id_76..79
    table.delete(F.lit(True))
    assert table.read().count() == 0
    table.upsert(base)
    assert table.read().count() == 100


def test_a_change_writes_only_its_own_rows(spark, folder):
    table = keyed.KeyedTable(spark, f"{folder}/t", T._parse_datatype_string("id BIGINT, x BIGINT"), ["id"], buckets=4, most_deltas=3)
    table.upsert(spark.range(4000).selectExpr("id", "0L x"))
    first = set(os.listdir(f"{folder}/t"))
    for change in range(1, 7):
        table.upsert(spark.range(40).selectExpr("id * 100 AS id", f"CAST({change} AS BIGINT) x"))
        if change == 1:  # spread over all buckets, yet the base stays as it is
            new, = (n for n in set(os.listdir(f"{folder}/t")) - first if n.startswith("v="))
            assert spark.read.parquet(f"{folder}/t/{new}").count() == 40
    assert table.read().groupBy("x").count().collect() and table.read().where("x = 6").count() == 40
    assert table.read().count() == 4000
    assert max(map(len, table._current()[1].values())) <= 4  # many deltas are merged into the base
    table.vacuum()
    assert table.read().where("x = 6").count() == 40 and table.read().count() == 4000
    table.upsert(spark.createDataFrame([(100,)], "id BIGINT"))
    assert table.read().where("id = 100").first().x is None


def test_keyed_table_ttl_and_compaction(spark, folder):
    table = keyed.KeyedTable(spark, f"{folder}/t", T._parse_datatype_string(TX), ["id"], ["seq"], 2)
    rows = spark.range(10).selectExpr("concat('k', id) id", "id value",
                                      "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) created_at", "1L seq")
    table.upsert(rows)
    as_of = F.lit("2024-01-01 00:00:12").cast("timestamp_ntz")
    assert keyed.unexpired(table.read(), "created_at", "10 SECONDS", as_of).count() == 7
    table.compact("10 SECONDS", "created_at", as_of)
    assert table.read().count() == 7
    folders = lambda: [n for n in os.listdir(f"{folder}/t") if n.startswith("v=")]
    assert len(folders()) == 2
    table.vacuum()
    assert len(folders()) == 1 and table.read().count() == 7


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=20),
       st.randoms())
def test_versioned_upsert_is_idempotent_and_order_free(spark, rows, random):
    rows = list({(k, v): (k, v, x) for k, v, x in rows}.values())  # a version has one value
    schema = "k STRING, version INT, x INT"
    shuffled = random.sample(rows, len(rows))
    half = len(rows) // 2
    frame = lambda r: spark.createDataFrame(r, schema)
    whole = keyed.upsert(frame(rows), frame(rows), ["k"], ["version"])
    parts = keyed.upsert(frame(shuffled[:half]), frame(shuffled[half:]), ["k"], ["version"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_delete_keeps_rows_of_unknown_predicate(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 5), (2, NULL) AS t(id, x)")
    assert [r.id for r in keyed.delete_where(rows, F.col("x") > 1).collect()] == [2]


def test_tiered_table_is_safe_to_repeat(spark, folder):
    roots = {n: f"{folder}/{n}" for n in ("hot", "warm", "cold")}
    table = retention.TieredTable(spark, roots, T._parse_datatype_string("id BIGINT, day DATE"), "day", ["id"])
    table.append(spark.range(100).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS day"))
    rules = [("3 DAYS", "warm"), ("7 DAYS", "cold")]
    for _ in range(2):
        table.apply("2024-01-11 00:00:00", rules, "9 DAYS")
    assert {t: len(table.days(t)) for t in roots} == {"hot": 2, "warm": 4, "cold": 2}
    assert table.read().count() == 80
    table.apply("2024-01-14 00:00:00", rules)
    assert {t: len(table.days(t)) for t in roots} == {"hot": 0, "warm": 3, "cold": 5}


def test_late_rows_join_a_moved_day(spark, folder):
    roots = {n: f"{folder}/{n}" for n in ("hot", "warm", "cold")}
    table = retention.TieredTable(spark, roots, T._parse_datatype_string("id BIGINT, day DATE"), "day", ["id"])
    rules = [("3 DAYS", "warm"), ("7 DAYS", "cold")]

    def add(*ids):
        table.append(spark.createDataFrame([(i,) for i in ids], "id BIGINT").selectExpr("id", "DATE'2024-01-01' AS day"))

    def ids(tier=None):
        return sorted(r.id for r in table.read(tier).collect())

    add(1, 2, 3)
    table.apply("2024-01-11 00:00:00", rules)
    add(4)
    assert ids() == [1, 2, 3, 4]
    table.apply("2024-01-11 00:00:00", rules)
    assert ids("cold") == [1, 2, 3, 4] and ids("hot") == []
    add(5, 6)
    # a move cut short after its copy: nothing is seen twice, and the rerun ends it
    table._copy("hot", "cold", table._files("hot", "2024-01-01"))
    assert ids() == [1, 2, 3, 4, 5, 6] and ids("hot") == []
    add(7)
    assert ids() == [1, 2, 3, 4, 5, 6, 7]
    table.apply("2024-01-11 00:00:00", rules)
    assert ids("cold") == [1, 2, 3, 4, 5, 6, 7] and table.days("hot") == []
    # by way of the tier between
    table.append(spark.range(8, 10).selectExpr("id", "DATE'2024-01-06' AS day"))
    table.apply("2024-01-11 00:00:00", rules)
    assert ids("warm") == [8, 9]
    table.apply("2024-01-14 00:00:00", rules)
    assert ids("cold") == [1, 2, 3, 4, 5, 6, 7, 8, 9] and ids() == ids("cold")


def test_alert_payload(spark):
    rows = spark.createDataFrame([("exp", 1, "Online", 1), ("exp", 2, "Offline", 2)],
                                 "cluster STRING, node INT, node_state STRING, seq INT")
    offline = rows.where("node_state != 'Online'").withColumn("ts", F.timestamp_seconds("seq"))
    batched = alerts.greedy_batches(offline, [], "ts", "seq", 5, 1_000_000)
    payload = alerts.alert_payload(batched, ["batch"], "cluster", "node").collect()
    assert [p.payload for p in payload] == ['{"cluster_offline_nodes":{"exp":["2"]}}']


ENVELOPE = """event_type STRING, order_id STRING, amount DOUBLE, customer_id STRING, device_id STRING,
    temperature DOUBLE, session_id STRING, url STRING, user_agent STRING"""


def _envelope(spark):
    def row(kind, **kw):
        names = [f.name for f in T._parse_datatype_string(ENVELOPE)]
        return tuple(kw.get(n, kind if n == "event_type" else None) for n in names)

    return spark.createDataFrame([
        row("order", order_id="a", amount=500.0), row("order", order_id="b", amount=500.01),
        row("device", device_id="c", temperature=80.0), row("device", device_id="d", temperature=80.1),
        row("click", session_id="e", user_agent="Googlebot/2.1"), row("click", session_id="f", user_agent="Safari/17.0"),
        row("other"), row(None)], ENVELOPE)


def test_fanout_rules(spark, folder):
    run = X.Fanout(lambda df: df, X.EVENT_TARGETS, X.write_batch_folders(folder), X.unrouted)
    run(_envelope(spark), 7)
    run(_envelope(spark), 7)  # a replay replaces the batch
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    assert {r.order_id: r.tier for r in read("orders").collect()} == {"a": "warm", "b": "hot"}
    assert {r.device_id: r.status for r in read("devices").collect()} == {"c": "ok", "d": "alert"}
    assert [r.session_id for r in read("clicks").collect()] == ["f"]
    assert read("dead_letters").count() == 2
    assert run.counts == {"orders": 4, "devices": 4, "clicks": 2, "dead_letters": 4}


def test_fanout_failure_is_isolated_and_raised(spark, folder):
    good = X.write_batch_folders(folder)

    def write(frame, target, batch_id):
        if target == "orders":
            raise OSError("target down")
        good(frame, target, batch_id)

    run = X.Fanout(lambda df: df, X.EVENT_TARGETS, write)
    with pytest.raises(OSError, match="target down"):
        run(_envelope(spark), 0)
    assert run.counts == {"devices": 2, "clicks": 1}
    dry = X.Fanout(lambda df: df, X.EVENT_TARGETS, write, dry_run=True)
    dry(_envelope(spark), 0)
    assert dry.counts == {"orders": 2, "devices": 2, "clicks": 1}


def test_frames(spark):
    frames = [b"\x00\x00\x00\x00\x02body", b"\x00\x00\x00\x00", b"\x01\x00\x00\x00\x02x", None,
              b"\x00\xff\xff\xff\xffz", b"\x00\x00\x00\x00\x01"]
    df = spark.createDataFrame([(i, bytearray(f) if f is not None else None) for i, f in enumerate(frames)],
                               "i INT, value BINARY")
    got = {r.i: r for r in X.frame_header(df).collect()}
    assert (got[0].schema_id, bytes(got[0].payload), got[0].reason) == (2, b"body", None)
    assert [got[i].reason for i in (1, 2, 3)] == [X.TOO_SHORT, X.BAD_MAGIC, X.TOO_SHORT]
    assert got[4].schema_id == 4294967295 and bytes(got[5].payload) == b""


@pytest.mark.parametrize("index,want", [
    (b"\x00", b"P"), (b"\x01\x05", b"P"), (b"\x02\x00\x80\x01", b"P"), (b"\x82\x00\x03\x04", b"P"),
])
def test_varint_index(spark, index, want):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01" + index + b"P"),)], "value BINARY")
    row = X.frame_varint(df).first()
    assert (row.schema_id, bytes(row.payload), row.reason) == (1, want, None)


def _read_varint(data, at):
    value, shift = 0, 0
    while True:
        byte, at = data[at], at + 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _plain_payload(data):
    """Byte by byte, None where the array is cut short."""
    try:
        count, at = _read_varint(data, 0)
        for _ in range(count):
            _, at = _read_varint(data, at)
    except IndexError:
        return None
    return data[at:]


def test_varint_index_by_brute_force(spark):
    dice, bodies = random.Random(5), [b"", b"\x00", b"\x80", b"\xff" * 12, b"\xff" * 8 + b"\x7f", b"\x01\x80"]
    for _ in range(400):
        count = dice.choice([0, 1, 2, 3, 130, 300])
        index = b"".join(bytes(dice.randrange(128, 256) for _ in range(dice.randrange(3))) + bytes([dice.randrange(128)])
                         for _ in range(count))
        head = bytes([count]) if count < 128 else bytes([count % 128 + 128, count // 128])
        whole = head + index + bytes(dice.randrange(256) for _ in range(dice.randrange(40)))
        bodies.append(whole if dice.random() < 0.7 else whole[:dice.randrange(len(whole) + 1)])
    df = spark.createDataFrame([(i, bytearray(b"\x00\x00\x00\x00\x01" + b)) for i, b in enumerate(bodies)], "i INT, value BINARY")
    found = X.frame_varint(df)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for row in found.collect():
        want = _plain_payload(bodies[row.i])
        assert (None if row.payload is None else bytes(row.payload)) == want, bodies[row.i]
        assert row.reason == (X.BAD_INDEX if want is None else None)


def test_varint_cut_short(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01\x05\x01"),)], "value BINARY")
    assert X.frame_varint(df).first().reason == X.BAD_INDEX


def test_routing_fallbacks(spark):
    frames = spark.createDataFrame([(1, None), (2, None), (3, None)], "schema_id BIGINT, reason STRING")
    registry = spark.createDataFrame([(1, "com.example.Order"), (2, "com.example.Other")], "schema_id INT, full_name STRING")
    names = {"com.example.Order": "orders"}
    table = {r.schema_id: (r.target, r.reason) for r in X.route_target(frames, registry, names).collect()}
    assert table == {1: ("orders", None), 2: ("com_example_Other", None), 3: (None, X.UNKNOWN_SCHEMA)}
    topic = {r.schema_id: r.target for r in X.route_target(frames, registry, {}, True).collect()}
    assert topic == {1: "com.example.Order", 2: "com.example.Other", 3: None}


def test_protobuf_payload_with_descriptor(spark):
    """A decoder is any Column to Column function; here one built on a descriptor, without a package."""
    protobuf = pytest.importorskip("google.protobuf")  # noqa: F841
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    def message_class():
        file = descriptor_pb2.FileDescriptorProto(name="foo.proto", package="t", syntax="proto3")
        message = file.message_type.add(name="Foo")
        message.field.add(name="a", number=1, type=9, label=1)
        message.field.add(name="b", number=2, type=3, label=1)
        pool = descriptor_pool.DescriptorPool()
        pool.Add(file)
        return message_factory.GetMessageClass(pool.FindMessageTypeByName("t.Foo"))

    @F.pandas_udf("a STRING, b BIGINT")
    def decode(payload):
        import pandas as pd
        cls = message_class()
        return pd.DataFrame([(m.a, m.b) for m in map(cls.FromString, payload)], columns=["a", "b"])

    body = message_class()(a="x", b=42).SerializeToString()
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01\x00" + body),)], "value BINARY")
    row = X.decode_payload(X.frame_varint(df), decode).first()
    assert (row.message.a, row.message.b, row.reason) == ("x", 42, None)


def _log(i, text):
    return f"2024.01.01 00:00:{i:02d}.000001 [ {i} ] {{q}} <Error> l: {text}"


@pytest.mark.parametrize("range_bytes", [7, 64, 1 << 20])
def test_log_records_do_not_depend_on_ranges(spark, folder, range_bytes):
    records = [_log(i, "m" * (i * 13 % 90) + "".join(f"\n  line {j}" for j in range(i % 4))) for i in range(30)]
    with open(os.path.join(folder, "a.log"), "w") as f:
        f.write("headless start\n" + "\n".join(records) + "\n")
    with open(os.path.join(folder, "b.log"), "w") as f:
        f.write("\n".join(records[:3]))  # no newline at the end
    open(os.path.join(folder, "empty.log"), "w").close()
    got = logs.log_records(logs.log_files(spark, folder), range_bytes=range_bytes)
    assert sorted(r.raw for r in got.collect()) == sorted(["headless start", *records, *records[:3]])


def test_compressed_log(spark, folder):
    import gzip
    with gzip.open(os.path.join(folder, "a.log.gz"), "wt") as f:
        f.write("\n".join([_log(1, "x\ny"), _log(2, "z")]) + "\n")
    got = logs.with_log_columns(logs.log_records(logs.log_files(spark, folder), range_bytes=8)).collect()
    assert sorted((r.level, r.message) for r in got) == [("Error", "l: x\ny"), ("Error", "l: z")]


def test_import_examples(spark, folder):
    schema = "id BIGINT, name STRING, ts TIMESTAMP_NTZ"
    texts = {
        "a.csv": "1,alice,2026-04-20 10:00:00.000\n2,bob,2026-04-20 10:00:01.000\n",
        "b.csv": "id,name,ts\n1,alice,2026-04-20 10:00:00.000\n2,bob,2026-04-20 10:00:01.000\n",
        "c.json": '{"id":1,"name":"alice","ts":"2026-04-20 10:00:00.000"}\n{"id":2,"name":"bob","ts":"2026-04-20 10:00:01.000"}\n',
    }
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    want = [(1, "alice", dt.datetime(2026, 4, 20, 10)), (2, "bob", dt.datetime(2026, 4, 20, 10, 0, 1))]
    assert [tuple(r) for r in files.read_csv(spark, f"{folder}/a.csv", schema).collect()] == want
    assert [tuple(r) for r in files.read_csv(spark, f"{folder}/b.csv", schema, header=True).collect()] == want
    assert [tuple(r) for r in files.read_ndjson(spark, f"{folder}/c.json", schema).collect()] == want
    values = files.read_values(spark, "id, name", "(100, 'eve'), (101, 'frank')")
    assert [tuple(r) for r in values.collect()] == [(100, "eve"), (101, "frank")]


def test_error_budget(spark, folder):
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("1,a\nx,b\n3,c\ny,d\n")
    schema = files.with_corrupt(T._parse_datatype_string("id BIGINT, name STRING"))
    parsed = files.read_csv(spark, folder, schema)
    good, bad = files.error_budget(parsed, most=2)
    assert [r.id for r in good.collect()] == [1, 3]
    assert sorted(r[0] for r in bad.collect()) == ["x,b", "y,d"]
    with pytest.raises(files.TooManyBadRows):
        files.error_budget(parsed, most=1)
    with pytest.raises(files.TooManyBadRows):
        files.error_budget(parsed, ratio=0.4)


def test_arrow_and_exports(spark, folder):
    rows = spark.range(1000).selectExpr("id", "concat('n', id) AS name", "CAST(NULL AS STRING) AS none")
    files.write_arrow(rows, f"{folder}/arrow")
    assert files.read_arrow(spark, f"{folder}/arrow/*.arrow", rows.schema).exceptAll(rows).count() == 0
    out.write_json_document(rows, f"{folder}/doc")
    meta = spark.read.json(f"{folder}/doc/meta").first()
    assert meta.rows == 1000 and T.StructType.fromJson(__import__("json").loads(meta.schema)) == rows.schema
    assert spark.read.schema(rows.schema).json(f"{folder}/doc/data").exceptAll(rows).count() == 0
    out.write_csv(rows.drop("none"), f"{folder}/gz", True, compression="gzip", rows_per_file=300)
    assert all(n.endswith(".csv.gz") for n in os.listdir(f"{folder}/gz") if n.startswith("part"))
    assert files.read_csv(spark, f"{folder}/gz", "id BIGINT, name STRING", header=True).count() == 1000
    changed = rows.withColumn("name", F.when(F.col("id") == 5, "other").otherwise(F.col("name")))
    assert not out.reconcile(rows, changed).first().same


def test_sql_insert_text(spark):
    rows = spark.sql("SELECT 1 AS id, \"it's\" AS name, CAST(NULL AS STRING) AS x, true AS ok, DATE'2024-01-02' AS d")
    assert out.sql_inserts(rows, "t").first()[0] == (
        "INSERT INTO t (id, name, x, ok, d) VALUES (1, 'it''s', NULL, true, '2024-01-02');")


def test_message_frame(spark):
    rows = spark.createDataFrame([("one", 1)], "key STRING, value INT")
    row = messages.message_frame(rows, "key", {"test_id": "smoke", "idx": "1"}, partitions=8).first()
    assert (row.key, row.value) == ("one", '{"key":"one","value":1}')
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("test_id", b"smoke"), ("idx", b"1")]
    assert 0 <= row.partition < 8


def test_generators(spark):
    rows = generate.generate_rows(spark, 1000, generate.transaction_columns(100))
    assert rows.select("id").distinct().count() == 1000
    assert rows.select("from_id").distinct().count() <= 100
    assert rows.where("value < 0").count() == 0
    assert rows.exceptAll(generate.generate_rows(spark, 1000, generate.transaction_columns(100))).count() == 0
    assert generate.generate_rows(spark, 10, generate.device_columns()).where("device LIKE 'dev_%'").count() == 10


def test_jdbc_options():
    got = jdbc.jdbc_options("jdbc:x", "products", "id", 0, 100, 4, user="u")
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "4" and got["user"] == "u"


def test_log_reports_on_pinned_lines(spark):
    lines = [
        "<Information> x client.data-1 connections=3 failed_connections=1 total_send_requests=9 send_bytes/s=120 send_requests/s=4",
        "<Information> x client.data-1 connections=5 total_send_requests=9 send_bytes/s=220 send_requests/s=6",
        "x tcp-server-1: current_connections=2 receive_bytes/s=7 receive_requests/s=3 unauthenticated_connections=0",
        "<Information> db.stream: Backpressure peer node=0x2",
        "<Warning> Raft recv queue is full shard=4",
    ]
    rows = spark.createDataFrame([(i, "0x1", raw) for i, raw in enumerate(lines)], "seq INT, node STRING, raw STRING")
    rows = rows.withColumn("event_time", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    client = reports.client_metrics(rows)
    assert len(client.columns) == 16 and [r.connections for r in client.collect()] == [3, 5]
    assert tuple(reports.peer_p90(client, "client", ["send_bytes_s", "send_requests_s"]).first()) == ("client.data-1", 210, 5)
    assert len(reports.server_metrics(rows).columns) == 12
    assert [(r.stream, r.peer_node, r["count"]) for r in reports.backpressure(rows).collect()] == [("db.stream", "0x2", 1)]
    assert [tuple(r) for r in reports.queue_full(rows).collect()] == [("4", 1)]


def test_token_frequency_is_descending(spark):
    counts = {"ECANCELED": 5, "EBADF": 3, "EPIPE": 1}
    lines = [(f"<Error> client.d-1: failed error={t}",) for t, n in counts.items() for _ in range(n)]
    got = reports.token_frequency(spark.createDataFrame(lines, "raw STRING")).collect()
    assert [tuple(r) for r in got] == list(counts.items())


def test_arrow_file_is_standard(spark, folder):
    files.write_arrow(spark.range(10).coalesce(1), f"{folder}/a")
    name = next(n for n in os.listdir(f"{folder}/a") if n.endswith(".arrow"))
    with pa.ipc.open_file(f"{folder}/a/{name}") as reader:
        assert reader.read_all().num_rows == 10


def test_sizes_beyond_64_bits(spark, folder):
    rows = [(9_000_000, 900_000), (3, 5), (2 ** 62, 2 ** 62), (None, 1)]
    spark.createDataFrame(rows, "o_orderkey BIGINT, o_custkey BIGINT").write.parquet(f"{folder}/orders.parquet")
    got = {r.o_orderkey: r.size for r in QUERIES["fn_readable_size"](spark, folder).collect()}
    assert got[9_000_000] == f"{9_000_000 ** 2 * 900_000 / 1024 ** 4:.2f} TiB" and got[3] == "45.00 B" and got[None] is None
    assert got[2 ** 62].startswith("892029807941") and got[2 ** 62].endswith(" TiB")
