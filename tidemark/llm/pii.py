"""Personal data: proposed spans, judged by boosted trees."""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.boosting import BoostedTrees
from tidemark.llm.rows import map_rows, texts_of, unit_hash

KINDS = ("email", "ip", "card", "phone")
# the model is fitted on about so many documents, and on at most so many spans proposed in them
FIT_DOCUMENTS, FIT_SPANS = 20_000, 20_000
THRESHOLD = 0.95

# Base spans. Each pattern matches what the plain one does: a number is never entered in its midst,
# and nothing is given back where that cannot help, so that long runs take linear time.
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# What else is proposed.
AT = re.compile(r"\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?", re.IGNORECASE)
LOOSE_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
GROUP = re.compile(r"[0-9]+")
CLUSTER = re.compile(r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20().,/:_-]{0,2}[0-9])*+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if k % 2:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Name, at sign and host; the name goes back from the at sign to what came before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in NAME_CHARACTERS:
            start -= 1
        host = EMAIL_HOST.match(text, at) if start < at else None
        if host:
            done = host.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """What is personal data by rule: leftmost matches of each kind, without those that fail its check."""
    found = [Span("email", a, b, True) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text) is None:
        return found
    for m in IP.finditer(text):
        if all(map(_octet, m.group().split("."))):
            found.append(Span("ip", *m.span(), True))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(Span("card", *m.span(), True))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(Span("phone", *m.span(), True))
    return found


def proposed_spans(text: str) -> list[Span]:
    """Base spans and whatever else might be personal data; spans may overlap and repeat under other kinds."""
    found = base_spans(text)
    taken = {span[:3] for span in found}

    def propose(kind: str, start: int, end: int) -> None:
        if (kind, start, end) not in taken:
            taken.add((kind, start, end))
            found.append(Span(kind, start, end, False))

    if "(" in text or "[" in text or "{" in text or "<" in text:
        for m in AT.finditer(text):
            start = m.start()
            while start > 0 and text[start - 1] in NAME_CHARACTERS:
                start -= 1
            host = LOOSE_HOST.match(text, m.end())
            if host and start < m.start():
                propose("email", start, host.end())
    if DIGIT.search(text) is None:
        return found
    for m in CLUSTER.finditer(text):
        start, end = m.span()
        groups = [(start + g.start(), start + g.end()) for g in GROUP.finditer(m.group())]
        size = sum(b - a for a, b in groups)
        if m.group().count(".") >= 3:
            propose("ip", start, end)
        if 12 <= size <= 20:
            propose("card", start, end)
        if 7 <= size <= 16:
            propose("phone", start, end)
        if len(groups) > 1:
            for part in _parts(text, start, groups):
                propose(*part)
    return found


def _parts(text: str, run: int, groups: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Stretches of a run's digit groups that have the shape of a value of their own, as values may stand side
    by side. A stretch has at most 20 digits, so that the work is linear in the run."""
    for i, (begin, _) in enumerate(groups):
        size, dotted, breaks = 0, True, ""
        for j in range(i, len(groups)):
            a, end = groups[j]
            if j > i:
                between = text[groups[j - 1][1]:a]
                dotted = dotted and between.strip(" ") == "."
                breaks += between
                # neither a card nor a phone has such groups, and no address goes on
                if end - a < 2 and (not dotted or j > i + 3):
                    break
            size += end - a
            if size > 20:
                break
            sizes = [y - x for x, y in groups[i:j + 1]]
            if j == i + 3 and dotted and max(sizes) <= 3:
                yield "ip", begin, end
            if 13 <= size <= 19 and min(sizes) >= 3 and not any(c in "(),:" for c in breaks) and luhn(
                    "".join(text[x:y] for x, y in groups[i:j + 1])):
                yield "card", begin, end
            if 7 <= size <= 16 and not any(c in ",:_" for c in breaks):
                start = run if i == 0 else begin - (text[begin - 1] == "(")
                if text[start:end].count("(") != text[start:end].count(")"):
                    start = begin
                body = text[start:end]
                # an area code in brackets comes first or after a country code
                if body.count("(") != body.count(")") or "(" in body and len(GROUP.findall(body.partition("(")[0])) > 1:
                    continue
                marked = body[0] in "+(0"
                if all(n >= (2 if marked else 3) for n in sizes[1:]) and (marked or sizes[-1] >= 4):
                    yield "phone", start, end


MONTH, DAY, YEAR = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12][0-9]|3[01])", r"(?:19|20)[0-9]{2}"
DATE = re.compile(rf"(?:{YEAR}([-./]){MONTH}\1{DAY}|{DAY}([-./]){MONTH}\2{YEAR}|{MONTH}/{DAY}/{YEAR})(?![0-9./-])")
TIME = re.compile(r"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?")
THOUSANDS = re.compile(r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?")
# dotted, with a part of one digit behind the first: no number to call has that
VERSION = re.compile(r"(?=[0-9]+\.[0-9]+\.)[0-9]+(?:\.[0-9]+)*?\.[0-9](?:\.[0-9]+)*")
ADDRESS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def ruled(text: str, span: Span) -> bool | None:
    """Whether a rule says that a span is personal data, or that it is not; None if no rule decides."""
    kind, start, end, base = span
    if base:
        return True
    body = text[start:end]
    digits = "".join(c for c in body if "0" <= c <= "9")
    if kind == "card":
        return None if 13 <= len(digits) <= 19 and luhn(digits) else False
    if kind == "ip":
        groups = GROUP.findall(body)
        return None if len(groups) == 4 and all(map(_octet, groups)) else False
    if kind == "phone":
        if not 7 <= len(digits) <= 15 or any(p.fullmatch(body) for p in (TIME, THOUSANDS, VERSION, ADDRESS)):
            return False
        return False if DATE.match(body) else None
    return None


CONTEXT = (
    ("mail", "email", "e-mail", "contact", "write"), ("ip", "host", "server", "address", "addr"),
    ("card", "visa", "credit", "payment", "kreditkarte", "tarjeta", "carte"),
    ("call", "phone", "tel", "telephone", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"),
    ("version", "release", "isbn", "order", "id", "no", "number", "invoice", "date", "page", "sku", "build"),
)
WORDS = re.compile(r"[^\W\d_]+")
# a further number of the same run
BEFORE = re.compile(r"([+(]?)([0-9]+)[\x20().,/:_-]{0,2}$")
AFTER = re.compile(r"[\x20().,/:_-]{0,2}([0-9]+)")


def features(text: str, span: Span) -> list[float]:
    """Format of a span, its kind, and what stands around it."""
    kind, start, end, _ = span
    body = text[start:end]
    digits = "".join(c for c in body if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", body)
    separators = [c for c in body if not c.isalnum() and c not in "+@"]
    before, after = text[max(0, start - 32):start], text[end:end + 32]
    around = {w.lower() for w in WORDS.findall(before)[-4:]} | {w.lower() for w in WORDS.findall(after)[:2]}
    octets = len(groups) == 4 and all(map(_octet, groups))
    sides = (groups or [""])[0], (groups or [""])[-1]
    former, latter = BEFORE.search(before), AFTER.match(after)
    host = re.split(r"[@)\]}>]", body)[-1]
    return [
        *(float(kind == k) for k in KINDS),
        len(body), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(digits)), len(separators), len(set(separators)),
        float(13 <= len(digits) <= 19 and luhn(digits)), float(octets), body.count("."), body.count("-"),
        body.count(" "), body.count("("), body.count("/") + body.count(":") + body.count(","),
        float(body.startswith("+")), float(body.startswith("0")), body.count("@"),
        float("." in host), len(host.rpartition(".")[2]), sum(c.isalpha() for c in body),
        *map(len, sides), len(former.group(2)) if former else 0, float(former is not None and former.group(1) == "+"),
        len(latter.group(1)) if latter else 0,
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'#$_=/"),
        *(float(not around.isdisjoint(words)) for words in CONTEXT),
    ]


def _invented(seed: int = 11, count: int = 1500) -> tuple[list[str], list[Span], list[int]]:
    """Made-up spans in other shapes than the rules know, right and wrong ones, with their surroundings."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    def word() -> str:
        return "".join(rng.choices("abcdefghilmnoprstuv", k=rng.randint(3, 8)))

    def right_card() -> str:
        body = str(rng.randint(3, 6)) + number(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def wrong_card(n: int = 16) -> str:
        body = number(n)
        return body if not luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10)

    def address(top: int) -> str:
        return ".".join(str(rng.randint(0, top)) for _ in range(4))

    shapes = (
        ("email", 1, lambda: f"{word()}{rng.choice(('(at)', ' [at] ', '[at]', ' (at) '))}{word()}"
                             f"{rng.choice(('.', ' [dot] ', '(dot)'))}{rng.choice(('com', 'org', 'net', 'de'))}"),
        ("email", 1, lambda: f"{word()}.{number(2)}@{word()}.example.com"),
        ("phone", 1, lambda: f"({number(3)}) {number(3)}-{number(4)}"),
        ("phone", 1, lambda: f"+{rng.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"),
        ("phone", 1, lambda: f"+{rng.randint(1, 99)} {number(3)} {number(3)} {number(4)}"),
        ("card", 1, right_card),
        ("card", 1, lambda: "-".join(re.findall("....", right_card()))),
        ("ip", 1, lambda: address(255)),
        ("card", 0, wrong_card), ("card", 0, lambda: wrong_card(rng.randint(12, 20))), ("phone", 0, wrong_card),
        ("phone", 0, right_card), ("phone", 0, lambda: address(255)), ("card", 0, lambda: address(255)),
        ("phone", 0, lambda: f"20{number(2)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"),
        ("phone", 0, lambda: f"{number(2)}:{number(2)}:{number(2)}.{number(3)}"),
        ("phone", 0, lambda: number(rng.randint(7, 16))), ("phone", 0, lambda: f"{number(1)},{number(3)},{number(3)}"),
        ("ip", 0, lambda: f"{number(1)}.{number(1)}.{number(1)}.{number(4)}"),
        ("ip", 0, lambda: f"{address(9)}.{number(1)}"), ("card", 0, lambda: f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}"),
        ("phone", 0, lambda: f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}"),
    )
    def phone() -> str:
        return rng.choice(("", f"+{rng.randint(1, 99)} ")) + f"({number(3)}) {number(3)}-{number(4)}"

    def plain_phone() -> str:
        return f"+{rng.randint(1, 99)} {number(3)} {number(3)} {number(4)}"

    values = (phone, plain_phone, right_card, lambda: " ".join(re.findall("....", right_card())), lambda: address(255))

    def beside(make: Callable[[], str]) -> Callable[[], tuple[str, str, str]]:
        """A whole value with another before or behind it."""
        return lambda: (f"{rng.choice(values)()} ", make(), "") if rng.random() < 0.5 else (
            "", make(), f" {rng.choice(values)()}")

    def cut(make: Callable[[], str]) -> Callable[[], tuple[str, str, str]]:
        """A piece of a value, or a value with the first group of the next one."""
        def made() -> tuple[str, str, str]:
            one = make()
            edges = [m.span() for m in GROUP.finditer(one)]
            if rng.random() < 0.5:
                a, b = (edges[1][0], len(one)) if rng.random() < 0.7 else (0, edges[-2][1])
                a -= a > 0 and one[a - 1] == "("
                return one[:a], one[a:b], one[b:]
            other = rng.choice((lambda: address(255), right_card, lambda: f"{number(3)} {number(4)}"))()
            head = re.match(r"[0-9]{1,4}", other).group()
            return "", f"{one} {head}", other[len(head):]
        return made

    def shifted() -> tuple[str, str, str]:
        """Groups of two cards side by side that pass the check by chance."""
        while True:
            both = [g for _ in range(2) for g in re.findall("....", right_card())]
            k = rng.randint(1, 3)
            if luhn("".join(both[k:k + 4])):
                return " ".join(both[:k]) + " ", " ".join(both[k:k + 4]), " " + " ".join(both[k + 4:])

    shapes += (
        ("phone", 1, beside(phone)), ("phone", 1, beside(plain_phone)), ("card", 1, beside(right_card)),
        ("card", 1, beside(values[3])), ("ip", 1, beside(values[4])),
        ("card", 0, shifted), ("phone", 0, cut(phone)), ("phone", 0, cut(plain_phone)), ("phone", 0, cut(values[3])),
        ("phone", 0, lambda: ("", " ".join(re.findall("....", right_card())), "")),
    )
    texts, spans, labels = [], [], []
    for k in range(count):
        kind, label, make = shapes[k % len(shapes)]
        made = make()
        left, body, right = made if isinstance(made, tuple) else ("", made, "")
        hints = CONTEXT[KINDS.index(kind)] if label else CONTEXT[4]
        before = f"{word()} {rng.choice(hints) if rng.random() < 0.6 else word()} {left}"
        texts.append(f"{before}{body}{right} {word()}")
        spans.append(Span(kind, len(before), len(before) + len(body), False))
        labels.append(label)
    return texts, spans, labels


def fit(df: DataFrame, text: str = "text", key: str = "doc_id") -> BoostedTrees:
    """Fit the trees on spans proposed in a bounded sample of the documents, right or wrong where a rule says
    so, and on invented spans; what no rule decides teaches nothing. Features are computed where the texts
    are; at most ``FIT_SPANS`` rows of numbers, the first by a hash of document and span, come to the driver.
    Without documents the invented spans alone teach."""
    total = df.count()
    sample = df.where(unit_hash(key, text) < min(1.0, FIT_DOCUMENTS / max(total, 1))).where(F.col(text).rlike("[0-9@]"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels, places = [], [], []
            for document, one in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                for span in proposed_spans(one):
                    label = ruled(one, span)
                    if label is not None:
                        rows.append(np.array(features(one, span), dtype="<f4").tobytes())
                        labels.append(label)
                        places.append(f"{document}:{span.kind}:{span.start}:{span.end}")
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(labels, pa.bool_()),
                                              pa.array(places, pa.string())], names=["features", "label", "place"])

    schema = StructType([StructField("features", BinaryType()), StructField("label", BooleanType()),
                         StructField("place", StringType())])
    spans_seen = sample.select(F.xxhash64(key, text), text).mapInArrow(run, schema)
    seen = spans_seen.orderBy(F.xxhash64("place"), "place", "features").limit(FIT_SPANS).drop("place").collect()
    texts, spans, labels = _invented()
    x = [features(t, s) for t, s in zip(texts, spans)] + [np.frombuffer(r.features, dtype="<f4") for r in seen]
    y = np.array(labels + [int(r.label) for r in seen])
    mixed = np.random.default_rng(5).permutation(len(y))
    return BoostedTrees().fit(np.array(x, dtype=float)[mixed], y[mixed])


def choose(text: str, model: BoostedTrees, threshold: float | dict[str, float]) -> list[tuple[str, int, int, bool, float]]:
    """Base spans, and of the others, best first, those that reach the threshold and overlap nothing chosen."""
    spans = proposed_spans(text)
    if not spans:
        return []
    scores = model.probability(np.array([features(text, s) for s in spans], dtype=float))
    chosen = [(*s, float(p)) for s, p in zip(spans, scores) if s.base]
    # what is taken, as stretches apart from each other in order: a span is looked up by halving
    begins: list[int] = []
    ends: list[int] = []
    for begin, end in sorted((s[1], s[2]) for s in chosen):
        if ends and begin <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(begin)
            ends.append(end)
    least = threshold if isinstance(threshold, dict) else dict.fromkeys(KINDS, threshold)
    more = sorted(((p, s) for p, s in zip(scores, spans) if not s.base and p >= least[s.kind]), key=lambda x: (-x[0], x[1]))
    for p, s in more:
        k = bisect_left(begins, s.end)  # the first stretch that begins behind the span
        if k == 0 or ends[k - 1] <= s.start:
            begins.insert(k, s.start)
            ends.insert(k, s.end)
            chosen.append((*s, float(p)))
    return sorted(chosen, key=lambda s: (KINDS.index(s[0]), s[1]))


SPANS = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("base", BooleanType()), StructField("score", DoubleType()),
]))
ARROW_SPANS = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))


def redact(text: str, spans: list[tuple]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by
    the first."""
    out, done = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def find_personal_data(df: DataFrame, model: BoostedTrees, text: str = "text", keep: list[str] | None = None,
                       threshold: float | dict[str, float] = THRESHOLD, redacted: str | None = None) -> DataFrame:
    """Append ``spans``: the personal data in each whole text, by kind and start, in code points, end
    exclusive; with ``redacted``, also a column of that name with the text without it.

    Spans found by rule are always there (``base``); further ones where the calibrated ``score`` reaches
    the threshold, one for all kinds or one for each. Null and empty texts have no spans; a null text stays null when redacted. Each row
    gives one row, repeated rows too; input columns with the added names are replaced; an empty table
    gives an empty one. Texts of any length are read whole in time linear in it.
    """
    fields = [StructField("spans", SPANS)]
    if redacted:
        fields.append(StructField(redacted, StringType()))
    names = ("kind", "start", "end", "base", "score")

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            texts = column.to_pylist()
            found = [choose(t, model, threshold) if t else [] for t in texts]
            made = [pa.array([[dict(zip(names, s)) for s in spans] for spans in found], ARROW_SPANS)]
            if redacted:
                made.append(pa.array([redact(t, s) if s else t for t, s in zip(texts, found)], pa.string()))
            return made

        return work

    return map_rows(df, [text], fields, start, keep)
