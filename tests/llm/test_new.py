"""Periodic runs, hard negatives and web archives against brute force and round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tests.llm.cases import LONG, no_documents, odd_documents
from tidemark.llm import negatives, queries, runs, warc

# -- periodic runs ----------------------------------------------------------------------------------


def runs_by_brute_force(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        equal = [words[i] == words[i + q] for i in range(n - q)]
        start = 0
        while start < n - q:
            end = start
            while end < n - q and equal[end]:
                end += 1
            length = end - start + q
            if end > start and length >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + p] for x in range(start, start + length - p)) for p in range(1, q)):
                found.append((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng):
    words = [rng.choice("ab cde fghij".replace(" ", "")[:rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 90))]
    if len(words) > 10 and rng.random() < 0.7:
        start, period = rng.randrange(len(words)), rng.randint(1, 14)
        for i in range(start + period, len(words)):
            words[i] = words[i - period]
        if rng.random() < 0.4:
            words[rng.randrange(len(words))] = "z"
    return words


def numbered(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        words = some_words(rng)
        assert runs.find_runs(numbered(words)) == runs_by_brute_force(words), words


def test_a_period_in_which_short_grams_recur_is_found():
    # each five words of the period occur twice in it, so that short grams alone would give half of it
    block = list("abcdexabcdey") * 2 + list("abcde") + ["q"]
    words = block * 5
    assert runs.find_runs(numbered(words)) == runs_by_brute_force(words)


def test_runs_of_very_long_texts():
    same = np.zeros(400_000, dtype=np.int64)
    assert runs.find_runs(same) == [(0, 400_000, 1)]
    cycle = np.arange(400_000) % 99_991
    assert runs.find_runs(cycle) == [(0, 400_000, 99_991)]
    cycle[200_000] = 99_999
    assert runs.find_runs(cycle) == []


def test_collapsed_texts_keep_one_period(spark):
    rng = random.Random(6)
    texts = [" ".join(some_words(rng)) for _ in range(300)]
    made = runs.periodic_runs(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string"), keep=["i"])
    for row in made.collect():
        words = texts[row.i].split()
        expected = runs_by_brute_force(words)
        gone = {x for s, n, q in expected for x in range(s + q, s + n)}
        assert [tuple(r) for r in row.runs] == expected and row.n_words == len(words)
        assert row.collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_take_odd_rows(spark):
    docs = odd_documents(spark).withColumn("runs", F.lit("clash"))
    made = {(r.doc_id, r.text): r for r in runs.periodic_runs(docs).collect()}
    assert runs.periodic_runs(docs).count() == docs.count()
    for key, text in ((2, None), (3, ""), (7, " \n\t ")):
        assert made[key, text].n_words == 0 and made[key, text].runs == [] and made[key, text].collapsed == ""
    assert made[4, LONG].collapsed == "the of and in to that."
    assert [tuple(r) for r in made[4, LONG].runs] == [(0, 360_000, 6)]
    assert runs.periodic_runs(no_documents(spark)).count() == 0
    other_space = spark.createDataFrame([(1, "a b c\x1cd\x85e")], "i int, text string")
    assert runs.periodic_runs(other_space).first().n_words == 1


def test_texts_made_to_repeat(spark):
    """The query's own change of every tenth text, word by word."""
    texts = {i: " ".join(f"w{k}" for k in range(i % 37)) + " " for i in range(400)} | {1000: None, 1001: ""}
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    changed = 0
    for row in queries.repeating(frame).collect():
        words = (texts[row.doc_id] or "").split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert (row.text or "").split() == words
    assert changed > 20


# -- hard negatives ---------------------------------------------------------------------------------

VECTORS = StructType([StructField("vec_id", LongType()), StructField("label", IntegerType()),
                      StructField("embedding", ArrayType(LongType())), StructField("rank", StringType())])


def negatives_by_brute_force(rows, asks):
    rows = list(dict.fromkeys((i, c, tuple(v)) for i, c, v, *_ in rows
                              if i is not None and c is not None and v is not None and None not in v))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for anchor in [r for r in rows if asks(r[0])]:
        near = sorted((-score(anchor[2], r[2]), r[0]) for r in rows if r[1] == anchor[1] and r[0] != anchor[0])[:5]
        other = sorted((-score(anchor[2], r[2]), r[0]) for r in rows if r[1] != anchor[1])
        for p, positive in near:
            fits = [(s, i) for s, i in other if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(anchor[0], positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def clustered(rng, n, width, clusters, spread):
    centres = rng.normal(size=(clusters, width))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, width))
    return np.floor(256 * rows).astype(int).tolist()


@pytest.fixture
def small_shards(monkeypatch):
    for name, value in (("SHARD_ROWS", (50, 100)), ("SHARD_BYTES", 256 * 16 * 8), ("LEAF", 8), ("QUERIES", 16), ("ASKED", 7)):
        monkeypatch.setattr(negatives, name, value)


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_negatives_equal_brute_force(spark, small_shards, spread):
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 700, 8, 12, spread)
    rows = [(i, int(rng.integers(0, 4)), v, "x") for i, v in enumerate(vectors)]
    # copies of one vector under several labels, repeated rows, ties
    rows += [(1000 + i, i % 3, vectors[5], "x") for i in range(200)] + [rows[40], rows[40], rows[10]]
    rows += [(2000, None, vectors[1], "x"), (2005, 1, None, "x"), (None, 1, vectors[2], "x"), (2010, 1, [1, None], "x"),
             (2015, 2, [], "x"), (2020, 2, [0] * 8, "x"), (2025, 77, vectors[3], "x")]
    frame = spark.createDataFrame(rows, VECTORS)
    made = negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0)
    got = sorted(tuple(r) for r in made.collect())
    assert got == negatives_by_brute_force(rows, lambda i: i % 5 == 0) and len(got) > 500


def test_negatives_of_large_numbers_are_exact(spark, small_shards):
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 2), rng.integers(-2 ** 29, 2 ** 29, 3).tolist(), "x") for i in range(120)]
    made = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in made.collect()) == negatives_by_brute_force(rows, lambda i: i % 5 == 0)


def test_few_rows_give_few_negatives(spark):
    one = [(0, 1, [3, 4], "x")]
    for rows in ([], one, one + [(50, 1, [3, 4], "x")], [(0, None, None, None)]):
        made = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0)
        assert made.collect() == [] and made.columns == negatives.FOUND.names


def test_most_branches_are_left_out_where_rows_are_clustered():
    rng = np.random.default_rng(5)
    x = np.array(clustered(rng, 4000, 16, 60, 0.01), dtype=np.float64)
    tree = negatives.Tree(x, np.zeros(len(x), dtype=np.int64), float((x * x).sum(axis=1).max()))
    compared = 0
    take = tree._take

    def counting(who, rows):
        nonlocal compared
        compared += len(who) * len(rows)
        take(who, rows)

    tree._take = counting
    ask = x[::50]
    every = np.full((len(ask), 1), 1 << 62)
    found, scores = tree.search(ask, np.zeros(len(ask), dtype=np.int64), True, every, -every, 5)
    assert (scores[:, 0] == -np.sort(-(ask @ x.T), axis=1)[:, :5]).all()
    assert compared < 0.3 * len(ask) * len(x)


# -- web archives -----------------------------------------------------------------------------------

PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()),
                    StructField("payload", StringType()), StructField("digest", StringType())])
FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 40\r\n\r\n"
        + "x" * 40 + "\r\n\r\nWARC/1.0\r\nContent-Length: 7\r\n\r\nabc")


def archived_by_brute_force(pages):
    groups = {}
    for page, url, html, *_ in pages:
        groups.setdefault((html or "").encode(), []).append((page is None, page if page is not None else 0, url is not None, url or ""))
    out = []
    for payload, members in groups.items():
        members.sort()
        for k, (unnamed, page, *_) in enumerate(members):
            revisit = k > 0 and len(payload) >= 100
            first = None if members[0][0] else members[0][1]
            out.append((None if unnamed else page, len(payload), hashlib.sha256(payload).hexdigest(),
                        "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def some_pages():
    rng = random.Random(7)
    long = "é" * 120
    pages = [(i, f"http://a/{i}", f"<p>{i} {'x' * rng.randint(0, 900)}</p>") for i in range(60)]
    pages += [(100 + i, f"http://b/{i}", long) for i in range(30)] + [(100, "http://b/0", long), (100, "http://b/0", long)]
    pages += [(200, None, None), (201, "", ""), (202, "http://c/\r\nx y", "short"), (203, "u", "short"), (None, "n", "z" * 100),
              (None, "m", "z" * 100), (205, "w", "z" * 100), (None, None, "q" * 200), (206, "u", "q" * 99), (207, "u", "q" * 99)]
    pages += [(300 + i, "fake", FAKE * (1 + i) + "\r\n\r\n" * (i % 3)) for i in range(12)]
    pages += [(400, "big", FAKE * 3000), (401, "magic", "WARC/1.1\r\n" * 400), (402, "end", "text\r\n\r\nWARC/1.1")]
    rng.shuffle(pages)
    return [(*p, "clash", "clash") for p in pages]


@pytest.mark.parametrize("range_bytes", [97, 1000, 1 << 25])
def test_pages_come_back_from_archives(spark, folder, range_bytes):
    pages = some_pages()
    path = f"{folder}/a"
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(3), path)
    if range_bytes == 97:
        pages = [p for p in pages if p[0] != 400]
        path = f"{folder}/b"
        warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(3), path)
    records = warc.read_archives(spark, path, True, range_bytes)
    made = warc.page_records(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, made.collect()), key=repr) == archived_by_brute_force(pages)
    held = {r.digest: bytes(r.payload) for r in records.where("type = 'response'").collect()}
    assert set(held.values()) == {(p[2] or "").encode() for p in pages}
    urls = {r.url for r in warc.page_records(records).collect()}
    assert urls >= {"http://b/0", None, "http://c/%0D%0Ax y"}


def test_hot_payloads_and_large_tables_of_firsts(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "HOT_COPIES", 20)
    monkeypatch.setattr(warc, "broadcast_if_small", lambda frame: frame)
    pages = some_pages()
    warc.write_archives(spark.createDataFrame(pages, PAGES), f"{folder}/a")
    made = warc.page_records(warc.read_archives(spark, f"{folder}/a")).drop("url")
    assert sorted(map(tuple, made.collect()), key=repr) == archived_by_brute_force(pages)


def test_broken_archives_are_noticed(spark, folder):
    pages = [(i, "u", "y" * 500, "", "") for i in range(20)]
    warc.write_archives(spark.createDataFrame(pages, PAGES).coalesce(1), f"{folder}/a")
    import glob
    file = glob.glob(f"{folder}/a/part-*")[0]
    whole = open(file, "rb").read()
    for change in (whole[:-300], whole.replace(b"Content-Length: 0", b"Content-Length: 9", 1), whole + b"rest"):
        made = f"{folder}/{len(change)}-{zlib.crc32(change)}"
        import os
        os.mkdir(made)
        with open(f"{made}/x.warc", "wb") as out:
            out.write(change)
        with pytest.raises(warc.BrokenArchive):
            warc.read_archives(spark, made, range_bytes=300)
        assert warc.read_archives(spark, made, range_bytes=300, strict=False).count() < 21


def test_no_pages_no_records(spark, folder):
    warc.write_archives(spark.createDataFrame([], PAGES), f"{folder}/a")
    assert warc.page_records(warc.read_archives(spark, f"{folder}/a")).collect() == []
