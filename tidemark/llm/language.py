"""Language of a text in two steps: the family, then the language within it by pairwise linear machines."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from tidemark.llm.boosting import sigmoid
from tidemark.llm.rows import First, first_by_class, map_rows, sample_by_class

UNKNOWN = "und"
PER_LANGUAGE = 600  # fitted on about so many documents of each language
SLOTS = 2048  # slots of counted letter groups

# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af yi fy lb".split(),
    "romance": "es fr it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "uralic": "fi et hu".split(),
    "indic": "hi bn ur mr pa gu ne si".split(),
    "turkic": "tr az kk uz ky tt".split(),
    "semitic": "ar he mt am".split(),
    "baltic": "lt lv".split(),
    "celtic": "ga cy gd br".split(),
}
FAMILY = {language: family for family, members in FAMILIES.items() for language in members}
LETTER = re.compile(r"[^\W\d_]")


def letter_groups(text: str) -> np.ndarray:
    """Square roots of hashed counts of the groups of one to three bytes of the lower-case text, of length one."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(SLOTS)
    # by stretches, so that a very long text needs little memory; they overlap by two bytes
    for begin in range(0, len(raw), 1 << 20):
        part = raw[max(begin - 2, 0):begin + (1 << 20)]
        skip = min(begin, 2)
        counts[:256] += np.bincount(part[skip:], minlength=256)
        pairs = part[:-1] << 8 | part[1:]
        counts += np.bincount((pairs[max(skip - 1, 0):] * np.uint32(2654435761)) >> np.uint32(21), minlength=SLOTS)
        triples = pairs[:-1] << 8 | part[2:]
        counts += np.bincount((triples * np.uint32(2246822519)) >> np.uint32(21), minlength=SLOTS)
    counts = np.sqrt(counts)
    norm = np.sqrt(counts @ counts)
    return counts / norm if norm else counts


def linear_machine(x: np.ndarray, y: np.ndarray, cost: float = 4.0, steps: int = 20) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss (y is 1 or -1).

    Newton steps on the rows within the margin; each is solved by conjugate gradients.
    """
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y) * cost
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        slack = np.maximum(1 - y * (x @ w), 0)
        gradient = w - x.T @ (weight * y * slack)
        if np.abs(gradient).max() < 1e-2:
            break
        rows = slack > 0
        inner, scale = x[rows], weight[rows]
        step, rest = np.zeros_like(w), -gradient
        direction, size = rest.copy(), rest @ rest
        for _ in range(25):
            turned = direction + inner.T @ (scale * (inner @ direction))
            length = size / (direction @ turned)
            step += length * direction
            rest = rest - length * turned
            now = rest @ rest
            if now < 1e-10:
                break
            direction, size = rest + (now / size) * direction, now
        loss, rate = 0.5 * w @ w + 0.5 * (weight * slack ** 2).sum(), 1.0
        while rate > 1e-3:
            trial = w + rate * step
            if 0.5 * trial @ trial + 0.5 * (weight * np.maximum(1 - y * (x @ trial), 0) ** 2).sum() <= loss:
                break
            rate /= 2
        w = w + rate * step
    return w


class Languages:
    """Family machines, one against the rest, and machines for each two languages of a family."""

    def __init__(self) -> None:
        self.languages: list[str] = []
        self.families: list[str] = []
        self.members: dict[str, list[str]] = {}
        self.family_weights = np.zeros((SLOTS + 1, 0))
        self.pairs: dict[tuple[str, str], np.ndarray] = {}

    def fit(self, x: np.ndarray, labels: list[str]) -> Languages:
        named = np.array(labels, dtype=object)
        self.languages = sorted(set(labels))
        for language in self.languages:
            self.members.setdefault(FAMILY.get(language, language), []).append(language)
        self.families = sorted(self.members)
        of = np.array([FAMILY.get(label, label) for label in labels], dtype=object)
        if len(self.families) > 1:
            self.family_weights = np.stack(
                [linear_machine(x, np.where(of == f, 1.0, -1.0)) for f in self.families], axis=1)
        for family in self.families:
            for a, b in combinations(self.members[family], 2):
                rows = (named == a) | (named == b)
                self.pairs[a, b] = linear_machine(x[rows], np.where(named[rows] == a, 1.0, -1.0))
        return self

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """A language for each row, and a score: the surest answers of the machines that led to it, multiplied."""
        if not self.languages or not len(x):
            return [UNKNOWN] * len(x), np.zeros(len(x))
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        if len(self.families) > 1:
            margins = x @ self.family_weights
            best = margins.argmax(axis=1)
            score = sigmoid(3 * margins[np.arange(len(x)), best])
        else:
            best, score = np.zeros(len(x), dtype=int), np.ones(len(x))
        answer = np.empty(len(x), dtype=object)
        for k, family in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            members = self.members[family]
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(members)))
            worst = np.ones((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                sure = sigmoid(3 * (x[rows] @ self.pairs[members[a], members[b]]))
                votes[:, a] += sure > 0.5
                votes[:, b] += sure <= 0.5
                worst[:, a] = np.minimum(worst[:, a], sure)
                worst[:, b] = np.minimum(worst[:, b], 1 - sure)
            won = (votes + worst * 1e-3).argmax(axis=1)
            answer[rows] = np.array(members, dtype=object)[won]
            score[rows] *= worst[np.arange(len(rows)), won]
        return answer.tolist(), score


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> Languages:
    """Fit on at most ``PER_LANGUAGE`` different rows of each label, the first by a hash of key and text, so that
    rows without an id and rows of one id are as likely as others.

    Rows without a label, and texts without a letter, teach nothing. Letter groups are counted where the
    texts are, over whole texts; the driver gets ``SLOTS`` numbers for each chosen row.
    """
    most = PER_LANGUAGE
    chosen = sample_by_class(labelled, [key, text], label, most).select(text, label, "order")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts: dict[str, First] = {}
        found: dict[tuple[str, int], bytes] = {}
        for batch in batches:
            for t, name, order in zip(*(column.to_pylist() for column in batch.columns)):
                if t and LETTER.search(t):
                    taken, out = firsts.setdefault(name, First(most)).add(order)
                    if taken:
                        found[name, order] = letter_groups(t).astype("<f2").tobytes()
                        found.pop((name, out), None)
        yield pa.RecordBatch.from_arrays([
            pa.array(found.values(), pa.binary()), pa.array([n for n, _ in found], pa.string()),
            pa.array([o for _, o in found], pa.int64())], names=["x", "label", "order"])

    schema = StructType([StructField("x", BinaryType()), StructField("label", StringType()), StructField("order", LongType())])
    rows = first_by_class(chosen.mapInArrow(run, schema), "label", most).orderBy(F.xxhash64("x"), "label").collect()
    if not rows:
        return Languages()
    x = np.stack([np.frombuffer(r.x, dtype="<f2") for r in rows]).astype(np.float32)
    return Languages().fit(x, [r.label for r in rows])


def predict(df: DataFrame, model: Languages, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    ``und`` with score 0 where the text is null or empty or has no letter, and everywhere if the model
    has seen no language. Each row gives one row, repeated rows too; input columns with the added names are
    replaced; an empty table gives an empty one.
    """

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            texts = column.to_pylist()
            names: list[str] = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            rows = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
            for begin in range(0, len(rows), 256):
                part = rows[begin:begin + 256]
                found, score = model.predict(np.stack([letter_groups(texts[k]) for k in part]))
                scores[part] = score
                for k, name in zip(part, found):
                    names[k] = name
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return work

    return map_rows(df, [text], [StructField("lang_pred", StringType()), StructField("score", DoubleType())], start, keep)
