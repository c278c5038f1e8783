"""Language, toxicity, near-duplicates, vectors and the pipeline against brute force and held-out rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import LONG, SMALL, no_documents, odd_documents
from tests.oracle import connect, difference
from tidemark.llm import darts, language, toxicity, vectors
from tidemark.llm.components import connected
from tidemark.llm.queries import ORACLES, QUERIES

# -- language


def test_letter_groups_of_long_texts_are_counted_whole():
    text = "añb " * 400_000
    whole = language.letter_groups(text)
    assert whole.shape == (language.SLOTS,) and abs(np.sqrt(whole @ whole) - 1) < 1e-9
    assert np.abs(whole - language.letter_groups("añb " * 4000)).max() < 1e-2


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op7_language"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_three_languages_of_a_family_are_voted_on():
    rng = np.random.default_rng(3)
    centres = rng.random((4, language.SLOTS))
    labels = [name for name in ("en", "de", "nl", "ru") for _ in range(30)]
    x = np.concatenate([c + 0.05 * rng.random((30, language.SLOTS)) for c in centres])
    x /= np.linalg.norm(x, axis=1)[:, None]
    model = language.Languages().fit(x, labels)
    assert model.families == ["germanic", "slavic"] and len(model.pairs) == 3
    assert model.predict(x)[0] == labels


def test_language_takes_odd_rows(spark):
    odd = odd_documents(spark)
    model = language.fit(odd)
    found = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (2, 3, 7, 8))
    assert found[4].lang_pred == "en"
    assert language.predict(no_documents(spark), model).count() == 0
    untaught = language.fit(no_documents(spark))
    assert {r.lang_pred for r in language.predict(odd, untaught).collect()} == {"und"}


@pytest.mark.parametrize("repeated", [None, 7])
def test_the_sample_of_languages_is_bounded(spark, monkeypatch, repeated):
    monkeypatch.setattr(language, "PER_LANGUAGE", 50)
    seen = []
    monkeypatch.setattr(language.Languages, "fit", lambda model, x, labels: seen.append((x, labels)) or model)
    # a third of the rows under one id, a third of them copies of one text
    rows = [(repeated if k % 3 == 0 else 10 + k, "one text" if k % 3 == 1 else f"{'the cat' if k % 2 else 'der hund'} {k * k}",
             "en" if k % 2 else "de") for k in range(6000)]
    rows += [(3, "a single row of copies", "fr")] * 1000
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    language.fit(documents)
    language.fit(documents.repartition(3))
    (x, labels), (y, others) = seen
    assert {name: labels.count(name) for name in labels} == {"de": 50, "en": 50, "fr": 1}
    assert labels == others and (x == y).all()
    assert len({row.tobytes() for row in x}) > 50


# -- toxicity

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes, starts = np.array([3, 1, 5, 4]), np.array([0, 3, 4, 9])
    odds, moves = np.exp(rng.normal(size=13)), np.exp(rng.normal(size=(3, 2)))
    found = toxicity.marginals(odds, starts, sizes, moves)
    for s, n in zip(starts, sizes):
        total, whole = np.zeros(n), 0.0
        for states in itertools.product((0, 1), repeat=int(n)):
            weight = moves[2, states[0]] * np.prod([odds[s + t] for t in range(n) if states[t]])
            weight *= np.prod([moves[a, b] for a, b in zip(states, states[1:])])
            whole += weight
            total += weight * np.array(states)
        assert np.allclose(total / whole, found[s:s + n])


def test_expected_moves_equal_enumeration():
    rng = np.random.default_rng(1)
    sizes, starts = np.array([4, 2]), np.array([0, 4])
    odds, moves = np.exp(rng.normal(size=6)), np.exp(rng.normal(size=(3, 2)))
    chance = toxicity.marginals(odds, starts, sizes, moves)
    first = np.array([True, False, False, False, True, False])
    found = toxicity.Tagger._pair_counts(odds, starts, sizes, moves, chance, first, np.flatnonzero(~first))
    expected = np.zeros((3, 2))
    for s, n in zip(starts, sizes):
        sums, whole = np.zeros((3, 2)), 0.0
        for states in itertools.product((0, 1), repeat=int(n)):
            weight = moves[2, states[0]] * np.prod([odds[s + t] for t in range(n) if states[t]])
            weight *= np.prod([moves[a, b] for a, b in zip(states, states[1:])])
            whole += weight
            sums[2, states[0]] += weight
            for a, b in zip(states, states[1:]):
                sums[a, b] += weight
        expected += sums / whole
    assert np.allclose(found, expected)


def test_toxic_documents_are_told_apart_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op10_toxicity"](spark, folder).join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    counts = {(r.lang, r.toxic, r.predicted): r["count"] for r in rows.groupBy("lang", "toxic", "predicted").count().collect()}
    languages = {lang for lang, *_ in counts}
    assert len(languages) == 4
    for lang in languages:
        caught, missed = counts[lang, 1, 1], counts.get((lang, 1, 0), 0)
        assert caught >= 0.8 * (caught + missed), lang
        assert counts.get((lang, 0, 1), 0) <= 0.05 * counts[lang, 0, 0], lang


def test_long_chains_are_passed_whole():
    rng = np.random.default_rng(2)
    odds, moves = np.exp(rng.normal(size=10_000)), np.array([[0.9, 0.1], [0.4, 0.6], [0.8, 0.2]])
    starts, sizes = np.array([0]), np.array([10_000])
    whole = toxicity.marginals(odds, starts, sizes, moves)
    # the same in log space by plain recurrences
    ahead, after = np.zeros((10_000, 2)), np.zeros((10_000, 2))
    emit = np.stack([np.zeros(10_000), np.log(odds)], axis=1)
    ahead[0] = np.log(moves[2]) + emit[0]
    for t in range(1, 10_000):
        ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, None] + np.log(moves[:2]), axis=0) + emit[t]
        ahead[t] -= ahead[t].max()
    for t in range(9_998, -1, -1):
        after[t] = np.logaddexp.reduce(np.log(moves[:2]) + (emit[t + 1] + after[t + 1])[None, :], axis=1)
        after[t] -= after[t].max()
    both = ahead + after
    assert np.allclose(whole, 1 / (1 + np.exp(both[:, 0] - both[:, 1])))
    assert (toxicity.chains(np.zeros(10_000, dtype=bool))[1] == [10_000]).all()


def test_signs_of_very_long_words_and_late_words_teach(spark):
    bad = "zorbix" + "x" * 80
    filler = " ".join(f"w{k}" for k in range(6000))
    rows = [(k, f"{filler} {bad if k % 3 == 0 else 'plain'} end {k}", int(k % 3 == 0)) for k in range(90)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    tagger = toxicity.fit(labelled.drop("toxic"), labelled.drop("text"))
    found = {r.doc_id: r for r in toxicity.score(labelled, tagger).collect()}
    assert all((found[k].score >= 0.7) == (k % 3 == 0) for k in range(90))
    assert [labelled.first().text[s.start:s.end] for s in found[0].toxic_spans] == [bad]


def test_toxic_words_are_located(spark):
    bad = ["you are a zorbix fool today", "what a zorbix thing it is"]
    good = ["you are a nice person today", "what a fine thing it is"]
    rows = [(k, (bad if k % 3 == 0 else good)[k % 2] + f". number {k}", int(k % 3 == 0)) for k in range(300)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    tagger = toxicity.fit(labelled.drop("toxic"), labelled.drop("text"))
    text = "Hello there. This Zorbix here! and all"
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), tagger).first()
    assert any(text[s.start:s.end] == "Zorbix" for s in row.toxic_spans) and row.score > 0.7


def test_toxicity_takes_odd_rows(spark):
    odd = odd_documents(spark)
    for tagger in (toxicity.Tagger(), toxicity.fit(odd, odd.withColumn("toxic", F.lit(None).cast("int"))),
                   toxicity.fit(no_documents(spark), odd.withColumn("toxic", (F.col("doc_id") % 2).cast("int")))):
        found = toxicity.score(odd, tagger).collect()
        assert len(found) == 10 and all(0 <= r.score < 0.7 for r in found)
    assert toxicity.score(no_documents(spark), toxicity.Tagger()).count() == 0


# -- near-duplicates

def test_signatures_agree_as_weighted_similarity():
    rng = np.random.default_rng(1)
    gaps = []
    for size in (2, 40, 500):
        for _ in range(40):
            base = rng.integers(0, 2 ** 63, size).astype(np.uint64)
            other = base.copy()
            other[:size // 4] = rng.integers(0, 2 ** 63, size // 4).astype(np.uint64)
            a, b = darts.cells(np.concatenate([base, base[:1]])), darts.cells(other)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            gaps.append((darts.sketch(a, 192) == darts.sketch(b, 192)).mean() - true)
    assert abs(np.mean(gaps)) < 0.02


def test_real_weights_agree_as_weighted_similarity():
    rng = np.random.default_rng(2)
    found = []
    regions = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    for _ in range(30):
        regions = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
        x, y = rng.random(60), rng.random(60)
        true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        found.append((darts.sketch(regions, 192, x) == darts.sketch(regions, 192, y)).mean() - true)
    assert abs(np.mean(found)) < 0.03


def classes_by_brute_force(rows):
    sets = {i: np.unique((darts.cells(darts.shingles(t or "")) >> np.uint64(32)).astype("<u4")) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if len(x) and len(y) and min(len(x), len(y)) >= 0.79 * max(len(x), len(y)):
            common = np.intersect1d(x, y, assume_unique=True).size
            if common >= 0.8 * (len(x) + len(y) - common) - 1e-9:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def test_classes_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(3000)]
    rows, n = [], 0
    for _ in range(12):
        base = list(rng.choice(words, 120))
        for _ in range(int(rng.integers(1, 14))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(words))
            rows.append((n, " ".join(copy) if n % 5 else " ".join(copy).upper() + "!"))
            n += 1
            if n % 3 == 0:
                base = copy  # a chain of ever less similar copies
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.class_id for r in darts.near_duplicates(documents).collect()}
    assert found == classes_by_brute_force(rows)


def test_crowded_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(darts, "CROWD", 5)
    monkeypatch.setattr(darts, "BLOCK", 8)
    monkeypatch.setattr(darts, "COLUMNS", 50)
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(2000)]
    rows = []
    for _ in range(3):
        base = list(rng.choice(words, 90))
        for _ in range(40):
            copy = list(base)
            for _ in range(int(rng.integers(0, 6))):
                copy[int(rng.integers(0, 90))] = str(rng.choice(words))
            rows.append((len(rows), " ".join(copy)))
    found = {r.doc_id: r.class_id for r in darts.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == classes_by_brute_force(rows)


def test_classes_of_documents_equal_brute_force(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r.class_id for r in darts.near_duplicates(documents).collect()}
    assert found == classes_by_brute_force([(r.doc_id, r.text) for r in documents.collect()])


def test_near_duplicates_take_odd_rows(spark):
    found = darts.near_duplicates(odd_documents(spark)).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(by_id) == 9
    assert by_id[5].class_id == by_id[6].class_id == 5 and by_id[5].kept and not by_id[6].kept
    assert all(by_id[i].kept for i in (1, 2, 3, 4, 7, 8, None)) and by_id[None].class_id is None
    assert darts.near_duplicates(no_documents(spark)).count() == 0


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(400, 470)]
    links += [(1000, k) for k in range(1001, 1100)] + [(None, 3), (5, 5)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    found = {r.id: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: find(i) for i in root}


# -- vectors

def some_vectors(spark, rng):
    base = rng.normal(size=(40, 16))
    rows = []
    for k in range(600):
        x = base[rng.integers(0, 40)] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3, 0.5])
        rows.append((k, [float(np.float32(v)) for v in x], k % 7))
    rows[17] = (17, rows[18][1], 0)
    rows[19] = (19, [2 * v for v in rows[18][1]], 0)
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1),
           (904, [float("inf")] * 16, 1), (905, [], 1), (906, [1.0, 2.0], 1), (None, rows[18][1], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("x"))
    return rows, frame.withColumn("id", F.lit("clash"))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 60)
    monkeypatch.setattr(vectors, "TREE", 100)
    monkeypatch.setattr(vectors, "LEAF", 8)
    monkeypatch.setattr(vectors, "QUERIES", 10)


def test_links_equal_brute_force(spark, small_blocks):
    rows, frame = some_vectors(spark, np.random.default_rng(5))
    found = {r.vec_id: r for r in vectors.similar_vectors(frame).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    labels = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(labels, np.where(linked, labels[None, :], len(x)).min(axis=1))
        if (new == labels).all():
            break
        labels = new
    for k in range(len(x)):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (linked[k].sum(), labels[k], labels[k] == k)
    for k in (*range(900, 907), None):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True)
    assert len(found) == 608
    assert vectors.similar_vectors(frame.where("false")).count() == 0


@pytest.mark.parametrize("relaxed, least", [(1.0, 1.0), (0.9, 0.95)])
def test_nearest_equal_brute_force(spark, small_blocks, relaxed, least):
    rows, frame = some_vectors(spark, np.random.default_rng(6))
    found = {}
    for r in vectors.nearest_vectors(frame, F.col("vec_id") % 20 == 0, relaxed=relaxed).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    right = total = 0
    # 906 is a query, too: short vectors are compared as if filled up with zeros
    short = np.zeros(16)
    short[:2] = np.array([1.0, 2.0]) / np.sqrt(5)
    x, ids = np.concatenate([x, short[None]]), [*range(600), 906]
    for q in range(0, 600, 20):
        scores = x @ x[q]
        order = sorted((i for i in range(len(ids)) if i != q), key=lambda i: (-round(scores[i], 12), ids[i]))[:5]
        got = [v for _, v, _ in sorted(found[q])]
        right += len(set(got) & {ids[i] for i in order})
        total += 5
        assert [r for r, _, _ in sorted(found[q])] == [1, 2, 3, 4, 5] and q not in got
        if relaxed == 1:
            assert got == [ids[i] for i in order]
            assert np.allclose([s for _, _, s in sorted(found[q])], scores[order])
    assert right >= least * total
    assert 900 not in found
    assert vectors.nearest_vectors(frame.where("false"), F.lit(True)).count() == 0
    few = vectors.nearest_vectors(frame.where("vec_id < 3"), F.col("vec_id") == 0)
    assert few.count() == 2


def test_many_copies_give_the_smallest_ids(spark):
    rows = [(k, [1.0, 0.5]) for k in range(400)] + [(k, [0.0, 1.0]) for k in range(400, 410)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    found = vectors.nearest_vectors(frame, F.col("vec_id") == 3).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [0, 1, 2, 4, 5]
    links = vectors.similar_vectors(frame).where("vec_id = 3").first()
    assert (links.n_links, links.component_id) == (399, 0)


# -- pipeline

def test_stages_keep_rows_and_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == docs.columns and after.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        after = spark.createDataFrame(after.collect(), after.schema)
        if name != "personal_data":
            assert after.exceptAll(before).count() == 0
        before = after
    assert 0.6 * docs.count() < before.count() <= docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_run_equals_the_stages_by_brute_force(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().collect()}
    clean = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, documents, SMALL), SMALL).collect()
    classes = classes_by_brute_force([(r.doc_id, r.text) for r in clean])
    assert kept == set(classes.values())


def test_stages_take_odd_rows(spark):
    odd = odd_documents(spark)
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, odd, SMALL).collect()
        sizes.append(len(rows))
        assert not rows or list(rows[0].asDict()) == odd.columns
        assert stage(spark, no_documents(spark), SMALL).columns == odd.columns
        assert stage(spark, no_documents(spark), SMALL).count() == 0
    # no letter: four rows; nothing toxic; two copies of one text; nothing personal
    assert sizes == [6, 10, 8, 10]
    assert LONG in {r.text for r in rows}
    assert corpus_pipeline.STAGES[-1][1](spark, no_documents(spark), SMALL).count() == 0


def test_one_row_of_equal_texts_stays(spark):
    text, other = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(3, text)] * 5 + [(None, text)] * 3 + [(3, other), (4, other), (None, None), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    drop = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = sorted((tuple(r) for r in drop(spark, docs, SMALL).collect()), key=repr)
    assert kept == sorted([(3, text), (3, other), (None, None), (None, None), (5, "")], key=repr)


def test_texts_in_no_language_go(spark):
    rng = random.Random(3)
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    junk = ["".join(rng.choice("0123456789abcdef") for _ in range(800)),
            "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(800))]
    more = spark.createDataFrame([(10 ** 9 + k, t, None, "s", len(t)) for k, t in enumerate(junk)], known.schema)
    identify = dict(corpus_pipeline.STAGES)["language"]
    kept = identify(spark, known.unionByName(more), "/root/testdata/sf0.01")
    assert kept.where("doc_id >= 1000000000").count() == 0
    assert kept.count() >= 0.999 * known.where(r"text rlike '\\p{L}'").count()


@pytest.mark.parametrize("name", list(QUERIES))
def test_every_query_runs(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert frame.count() > 10


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_equal_their_sql(spark, name):
    found = QUERIES[name](spark, SMALL).toArrow()
    assert difference(found, connect(SMALL).execute(ORACLES[name]).to_arrow_table()) is None
