"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.boosting import sigmoid
from tidemark.llm.rows import Recent, map_rows, ship, texts_of, unit_hash, worker_store
from tidemark.session import durable

# fitted on about so many documents of each label, on at most so many sentences of theirs (longer ones in pieces), and on
# at most so many signs (words and word beginnings) that tell toxic documents apart
PER_LABEL = {1: 2000, 0: 6000}
FIT_SENTENCES, FIT_PIECE, FIT_SIGNS = 30_000, 256, 20_000
SURE = 14.0  # log likelihood ratio from which a sign's share of toxic documents is no accident
OFTENER = 15  # times as often as in clean documents, by damped counts of its occurrences
SLOTS = 1 << 16
STEPWISE = 512  # tokens up to which chains are passed side by side; longer ones one by one
LEAST = 0.05  # smaller marginals do not count towards a document
SPAN_FROM = 0.5

TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
WORD = re.compile(r"[^\W_]+")
ENDS = frozenset(".!?\n")


def signs(word: str) -> list[str]:
    """What a labelled token is told by: the word, and its first four to seven letters."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6, 7) if len(word) > n)]


def token_features(word: str) -> list[int]:
    """Hashed features of a token: the word, its beginnings and ends, and its shape."""
    low = word.lower()
    made = [low, *(f"{low[:n]}*" for n in (3, 4, 5, 6, 7) if len(low) > n), *(f"*{low[-n:]}" for n in (3, 4) if len(low) > n)]
    shape = ("A" if word.isupper() else "a" if word.islower() else "x" if word.isalpha() else "0") + str(min(len(word), 9))
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) & (SLOTS - 1) for f in (*made, f"#{shape}")]


def marginals(odds: np.ndarray, starts: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Chance of the toxic state of each token, by forward and backward passes over all chains at once.

    ``odds`` has the weight of the toxic against the clean state of each token; chain k is the stretch of
    ``sizes[k]`` tokens from ``starts[k]``; ``moves[i, j]`` is the weight of state j after state i, and
    ``moves[2]`` that of the first states. Both passes carry the odds of the two states, which stay
    within the range of ``moves``, so nothing overflows however long a chain is.
    """
    result = np.zeros(len(odds))
    long = sizes > STEPWISE
    for start, size in zip(starts[long].tolist(), sizes[long].tolist()):
        result[start:start + size] = _one_chain(odds[start:start + size].tolist(), moves)
    starts, sizes = starts[~long], sizes[~long]
    order = np.argsort(-sizes, kind="stable")
    begins, lengths = starts[order], sizes[order]
    if not len(lengths):
        return result
    forward = np.empty(len(odds))
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # chains longer than each step
    state = np.full(len(lengths), moves[2, 1] / moves[2, 0])
    for t in range(lengths[0]):
        at = begins[:active[t]] + t
        if t:
            state = state[:active[t]]
            state = (moves[0, 1] + moves[1, 1] * state) / (moves[0, 0] + moves[1, 0] * state)
        state = state * odds[at]
        forward[at] = state
    back = np.ones(len(lengths))  # of each chain at the step in hand; chains that end there start at one
    for t in range(lengths[0] - 1, -1, -1):
        live = active[t]
        at = begins[:live] + t
        both = forward[at] * back[:live]
        result[at] = both / (1 + both)
        if t:
            ahead = odds[at] * back[:live]
            back[:live] = (moves[1, 0] + moves[1, 1] * ahead) / (moves[0, 0] + moves[0, 1] * ahead)
    return result


def _one_chain(odds: list[float], moves: np.ndarray) -> list[float]:
    """``marginals`` of a single chain, token by token: time linear in a sentence of any length."""
    (clean, enter), (leave, stay), (first_clean, first_toxic) = moves.tolist()
    state, forward = first_toxic / first_clean * odds[0], []
    forward.append(state)
    for value in odds[1:]:
        state = (enter + stay * state) / (clean + leave * state) * value
        forward.append(state)
    back, chances = 1.0, []
    for state, value in zip(reversed(forward), reversed(odds)):
        both = state * back
        chances.append(both / (1 + both))
        ahead = value * back
        back = (leave + stay * ahead) / (clean + enter * ahead)
    return chances[::-1]


def chains(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the stretches between ends."""
    places = np.flatnonzero(ends)
    starts = np.concatenate([[0], places + 1])
    sizes = np.concatenate([places, [len(ends)]]) - starts
    kept = sizes > 0
    return starts[kept], sizes[kept]


class Tagger:
    """A field over two states: clean and toxic. Weights of the features speak for the toxic state."""

    def __init__(self) -> None:
        self.weights = np.zeros(SLOTS, dtype=np.float32)
        self.bias = -8.0
        self.moves = np.ones((3, 2))
        self.readout = np.array([0.0, 6.0, 0.0, -4.0])  # of the log sum, greatest and share of marginals, and constant

    def odds_of(self, word: str) -> float:
        total = self.bias + float(self.weights[token_features(word)].sum())
        return float(np.exp(min(max(total, -30.0), 30.0)))

    def fit(self, sentences: list[list[str]], labels: list[list[int]], rounds: int = 80) -> Tagger:
        """Maximise the likelihood of the labelled sentences by Adagrad steps over all of them."""
        if not any(any(line) for line in labels):
            return self
        words = [w for line in sentences for w in line]
        truth = np.array([x for line in labels for x in line], dtype=float)
        sizes = np.array([len(line) for line in sentences])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        of = {w: token_features(w) for w in set(words)}
        slots = np.concatenate([of[w] for w in words])
        owner = np.repeat(np.arange(len(words)), [len(of[w]) for w in words])
        first = np.zeros(len(words), dtype=bool)
        first[starts[sizes > 0]] = True
        follows = np.flatnonzero(~first)
        weights, bias, moves = np.zeros(SLOTS), -2.0, np.zeros((3, 2))
        seen, seen_bias, seen_moves = np.full(SLOTS, 1e-3), 1e-3, np.full((3, 2), 1e-3)
        counts = np.zeros((3, 2))
        was, now = truth[follows - 1].astype(int), truth[follows].astype(int)
        np.add.at(counts, (was, now), 1)
        np.add.at(counts[2], truth[first].astype(int), 1)
        scale = 1 / len(words)
        for _ in range(rounds):
            score = np.bincount(owner, weights[slots], len(words)) + bias
            odds, steps = np.exp(np.clip(score, -30, 30)), np.exp(moves)
            chance = marginals(odds, starts, sizes, steps)
            error = chance - truth
            slope = np.bincount(slots, error[owner], SLOTS) * scale + 1e-7 * weights
            seen += slope ** 2
            weights -= 0.5 * slope / np.sqrt(seen)
            slope = error.sum() * scale
            seen_bias += slope ** 2
            bias -= 0.5 * slope / np.sqrt(seen_bias)
            # expected moves: pairwise marginals of neighbours from both passes
            expected = self._pair_counts(odds, starts, sizes, steps, chance, first, follows)
            slope = (expected - counts) * scale + 1e-4 * moves
            seen_moves += slope ** 2
            moves -= 0.2 * slope / np.sqrt(seen_moves)
        self.weights, self.bias, self.moves = weights.astype(np.float32), float(bias), np.exp(moves)
        return self

    @staticmethod
    def _pair_counts(odds, starts, sizes, steps, chance, first, follows) -> np.ndarray:
        """How often each move is expected under the model. The joint chance of two neighbours is the
        product of the forward chance of the one, the move, and the backward weight of the other."""
        ahead = np.zeros(len(odds))
        order = np.argsort(-sizes, kind="stable")
        begins, lengths = starts[order], sizes[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        state = np.full(len(lengths), steps[2, 1] / steps[2, 0])
        for t in range(lengths[0]):
            at = begins[:active[t]] + t
            if t:
                state = state[:active[t]]
                state = (steps[0, 1] + steps[1, 1] * state) / (steps[0, 0] + steps[1, 0] * state)
            state = state * odds[at]
            ahead[at] = state
        # what the later tokens say of a token: its marginal odds over its forward odds, times its own
        after = (chance / np.maximum(1 - chance, 1e-12)) / np.maximum(ahead, 1e-12) * odds
        a, b = ahead[follows - 1], after[follows]
        joint = np.stack([steps[0, 0] + 0 * a, steps[0, 1] * b, steps[1, 0] * a, steps[1, 1] * a * b])
        joint /= joint.sum(axis=0)
        counts = np.zeros((3, 2))
        counts[:2] = joint.sum(axis=1).reshape(2, 2)
        counts[2] = (1 - chance[first]).sum(), chance[first].sum()
        return counts


def _weighed(texts: list[str], odds_of, cache: Recent) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Odds and ends of the tokens of all texts in a row, an end after each text; and tokens per text."""
    values: list[float] = []
    counts = []
    for text in texts:
        tokens = TOKEN.findall(text)
        got = list(map(cache.get, tokens))
        if None in got:
            for k, value in enumerate(got):
                if value is None:
                    token = tokens[k]
                    value = cache.find(token)
                    if value is None:
                        value = -1.0 if token in ENDS else odds_of(token)
                        if len(token) <= 64:
                            cache.put(token, value)
                    got[k] = value
        got.append(-1.0)
        counts.append(len(got))
        values += got
    odds = np.array(values)
    return odds, odds < 0, counts


def assess(texts: list[str], tagger: Tagger, cache: Recent) -> Iterator[tuple[float, float, float, np.ndarray]]:
    """For each text the log sum of its marginals, the greatest one, the root of their share of its words, and all of them
    by token."""
    if not texts:
        return
    odds, ends, counts = _weighed(texts, tagger.odds_of, cache)
    starts, sizes = chains(ends)
    chance = marginals(odds, starts, sizes, tagger.moves)
    chance[ends] = 0
    counted = np.where(chance >= LEAST, chance, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    sums = np.add.reduceat(counted, bounds[:-1])
    tops = np.maximum.reduceat(chance, bounds[:-1])
    words = np.add.reduceat((~ends).astype(np.int64), bounds[:-1])
    shares = np.sqrt(sums / (words + 5))  # a word or two of a short text are no large share
    for k in range(len(texts)):
        yield float(np.log1p(sums[k])), float(tops[k]), float(shares[k]), chance[bounds[k]:bounds[k + 1] - 1]


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of some two million characters together, so that passes need bounded memory."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > 2_000_000:
            yield part
            part, size = [], 0
    if part:
        yield part


COUNTED = StructType([StructField("sign", StringType()), *(
    StructField(name, DoubleType()) for name in ("clean", "toxic", "clean_times", "toxic_times"))])
SENTENCES = StructType([StructField("words", ArrayType(StringType())), StructField("labels", ArrayType(IntegerType()))])


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Tagger:
    """Label tokens by what sets toxic documents apart, fit the field to them, and the readout to documents.

    All on a sample by a hash of the key, of about ``PER_LABEL`` documents of each label; a document with
    two labels is toxic. A sign is taken for toxic if more toxic documents have it than chance explains (``SURE``) and it
    occurs ``OFTENER`` times as often in them, each document counting the logarithm of its occurrences: a word
    that clean texts of a language have now and then is told by how often the toxic ones have it, and no single
    text decides. The tokens with such a sign in toxic documents are the labelled ones. Without toxic
    documents nothing is toxic.
    """
    spark = documents.sparkSession
    marks = labels.select(key, F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col(key).isNotNull())
    marks = marks.groupBy(key).agg(F.max("label").alias("label"))
    sizes = {r[0]: r[1] for r in marks.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Tagger()
    chance = F.when(F.col("label") == 1, PER_LABEL[1] / sizes[1]).otherwise(PER_LABEL[0] / sizes[0])
    # the chosen keys are few at any size of the tables, so the texts need no shuffle
    chosen = F.broadcast(marks.where(unit_hash(key) < chance).limit(2 * sum(PER_LABEL.values())))
    sample = durable(documents.select(key, text).join(chosen, key).select(text, "label"))

    def count_signs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[float]] = {}
            total = [0, 0]
            for one, mark in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                total[mark] += 1
                for sign, n in Counter(s for w in WORD.findall(one.lower()) for s in signs(w)).items():
                    held = seen.setdefault(sign, [0, 0, 0.0, 0.0])
                    held[mark] += 1
                    held[2 + mark] += math.log2(1 + n)
            seen[""] = [*total, 0.0, 0.0]  # no sign: all documents
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *(pa.array([float(v[k]) for v in seen.values()], pa.float64()) for k in range(4))],
                names=COUNTED.names)

    counted = sample.mapInArrow(count_signs, COUNTED).groupBy("sign").agg(*[F.sum(c).alias(c) for c in COUNTED.names[1:]])
    counted = durable(counted)
    totals = counted.where("sign = ''").select("clean", "toxic").first()
    if totals is None or not totals.toxic or not totals.clean:
        return Tagger()
    share, has, lacks = totals.toxic / (totals.toxic + totals.clean), F.col("toxic"), F.col("clean")
    ratio = (has * F.log(has / (share * (has + lacks)))
             + F.when(lacks > 0, lacks * F.log(lacks / ((1 - share) * (has + lacks)))).otherwise(0))
    oftener = F.col("clean_times") * totals.toxic * OFTENER <= F.col("toxic_times") * totals.clean
    telling = (counted.where((F.col("sign") != "") & (has > 0) & oftener & (ratio >= SURE))
               .orderBy(F.desc("toxic"), "sign").limit(FIT_SIGNS))
    # a word beginning needs no place of its own where the words say the same; both may teach
    known = ship(spark, frozenset(r[0] for r in telling.select("sign").collect()))

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling_signs = known()
        for batch in batches:
            lines, marks = [], []
            for one, mark in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                for sentence in re.split(r"[.!?\n]", one):
                    every = WORD.findall(sentence)
                    for begin in range(0, len(every), FIT_PIECE):
                        words = every[begin:begin + FIT_PIECE]
                        tags = [int(mark and any(s in telling_signs for s in signs(w.lower()))) for w in words]
                        if any(tags) or zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass")) % 16 == 0:
                            lines.append(words)
                            marks.append(tags)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int32()))], names=["words", "labels"])

    order = F.xxhash64("words")
    picked = sample.mapInArrow(pick, SENTENCES).orderBy(order).limit(FIT_SENTENCES).collect()
    tagger = Tagger().fit([r.words for r in picked], [r.labels for r in picked])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Recent(1 << 17)
        for batch in batches:
            found = [a[:3] for part in _slices(texts_of(batch.column(0))) for a in assess(part, tagger, cache)]
            yield pa.RecordBatch.from_arrays([*(pa.array([f[k] for f in found], pa.float64()) for k in range(3)), batch.column(1)],
                                             names=["total", "top", "share", "label"])

    schema = StructType([*(StructField(c, DoubleType()) for c in ("total", "top", "share")), StructField("label", IntegerType())])
    seen = sample.mapInArrow(read, schema).orderBy("total", "top", "share", "label").collect()
    x = np.array([[r.total, r.top, r.share, 1.0] for r in seen])
    y = np.array([r.label for r in seen], dtype=float)
    scale = np.array([*np.maximum(x[:, :3].std(axis=0), 1e-6), 1.0])  # so that the penalty weighs all alike
    x, weights = x / scale, np.zeros(4)
    for _ in range(60):
        p = sigmoid(x @ weights)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(4)
        weights -= np.clip(np.linalg.solve(hessian, x.T @ (p - y) + 0.1 * weights), -1, 1)
    tagger.readout = weights / scale
    return tagger


SPANS = ArrayType(StructType([
    StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())]))
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _spans(text: str, chance: np.ndarray) -> list[dict]:
    """Toxic tokens, neighbours of one sentence together, in code points."""
    spans: list[dict] = []
    before = -2
    places = [m.span() for m in TOKEN.finditer(text)]
    for k in np.flatnonzero(chance >= SPAN_FROM).tolist():
        start, end = places[k]
        if k == before + 1:
            spans[-1] = {"start": spans[-1]["start"], "end": end, "score": max(spans[-1]["score"], float(chance[k]))}
        else:
            spans.append({"start": start, "end": end, "score": float(chance[k])})
        before = k
    return spans


def score(df: DataFrame, tagger: Tagger, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1, higher: toxic likelier) and ``toxic_spans`` of each whole text.

    A null, empty or wordless text has the score of a text without any toxic token. Each row gives one
    row, repeated rows too; input columns with the added names are replaced; an empty table gives an
    empty one. Sentences are the chains, whole however long they are.
    """
    model = ship(df.sparkSession, tagger)

    def start():
        tagger = model()
        store = worker_store("toxicity")
        mark = zlib.crc32(tagger.weights.tobytes())
        if store.get("mark") != mark:
            store["cache"], store["mark"] = Recent(1 << 17), mark
        cache, readout = store["cache"], tagger.readout

        def work(column: pa.Array) -> list[pa.Array]:
            scores, spans = [], []
            for part in _slices(texts_of(column)):
                for one, (total, top, share, chance) in zip(part, assess(part, tagger, cache)):
                    scores.append(float(sigmoid(np.array([total, top, share, 1.0]) @ readout)))
                    spans.append(_spans(one, chance) if top >= SPAN_FROM else [])
            return [pa.array(scores, pa.float64()), pa.array(spans, ARROW_SPANS)]

        return work

    return map_rows(df, [text], [StructField("score", DoubleType()), StructField("toxic_spans", SPANS)], start, keep, "toxicity")
