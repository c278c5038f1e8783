"""Packing of documents into training sequences by order-preserving dynamic programming."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections import deque
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidemark.llm.rows import worker_store

WIDTH = 2048
END_ID = 1
# price of a cut, in tokens of padding: at a document's end, at a sentence's end, elsewhere
AT_DOCUMENT, AT_SENTENCE, ELSEWHERE = 0, 4, 16
STRIDE = 48  # in a stretch without a sentence's end, so many tokens apart may be cut
NO_PADDING_FROM = 256  # sequences of a smaller power of two are padded as any other
AHEAD, HELD_BACK = 96, 8  # windows decided together, and of those the last ones decided anew

# Where a sentence ends and the text can be cut without changing its tokens: the tokenizer's pattern
# takes a single space between two other characters to what follows, and a lone line break by itself.
# The pattern begins with the few characters that may end a sentence, so that the search skips to them.
SENTENCE_END = re.compile(r"[.!?\n](?:(?<=[.!?])(?= \S)|(?<=\S\n)(?=\S))")
LONG = 1024
LONG_WORD = re.compile(rf"\S{{{LONG}}}")

# The word pattern of byte-level tokenizers, and the characters that stand for bytes in
# their vocabularies (printable ones for themselves, the others from U+0100 on).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Where no two white spaces meet, the branch that looks ahead finds what the last one finds; without it the search needs no backtracking.
SINGLE_SPACES = PATTERN.replace(r"|\s+(?!\S)", "")
SPACES = re.compile(r"\s\s")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

PIECE = StructType([
    StructField("doc_id", LongType()), StructField("start", LongType()), StructField("length", LongType()),
    StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()), StructField("offset", LongType()),
    StructField("ids", BinaryType()),
])


def byte_ranks(definition: str) -> dict[bytes, int] | None:
    """Token bytes and ids of a byte-level vocabulary whose ids follow its merges; None for any other."""
    parts = json.loads(definition)
    model, words = parts["model"], parts.get("pre_tokenizer") or {}
    if (model["type"] != "BPE" or words.get("type") != "ByteLevel" or words.get("add_prefix_space")
            or not words.get("use_regex", True) or parts.get("normalizer") or model.get("ignore_merges")):
        return None
    rest = (b for b in range(256) if b not in PRINTABLE)
    byte_of = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = {t["content"] for t in parts.get("added_tokens", ())}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocabulary.get(m) for m in merges]
    if None in ids or ids != sorted(ids) or not all(c in byte_of for t in vocabulary for c in t):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}


class Tokens:
    """Token ids of texts, with the places where sentences end.

    A byte-level vocabulary is encoded by ranks, which is faster and gives the same ids; texts with a
    special token's name, and words so long that ranks would take quadratic time, by the tokenizer itself.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t["content"] for t in json.loads(definition).get("added_tokens", ())]
        ranks = byte_ranks(definition)
        self.fast = None
        if ranks is not None:
            from tiktoken import Encoding

            self.fast, self.single = (
                Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                for pattern in (PATTERN, SINGLE_SPACES))
            self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)  # bytes of each token
            for token, rank in ranks.items():
                self.sizes[rank] = len(token)

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> tuple[bytes, list[int]]:
        """Ids of the text and the token offsets at which a sentence ends."""
        if not text:
            return b"", []
        ends = [*(match.end() for match in SENTENCE_END.finditer(text)), len(text)]
        if self.fast is None or any(name in text for name in self.special):
            return self._in_parts(text, ends, False)
        if len(text) > LONG and any(
                b - a > LONG and LONG_WORD.search(text, a, b) for a, b in zip([0, *ends], ends)):
            return self._in_parts(text, ends, True)
        # the whole text in one call; a sentence ends at the token that reaches its last byte
        fast = self.fast if SPACES.search(text) else self.single
        ids = np.array(fast(text), dtype="<u4")
        if not text.isascii():
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            ends = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[ends]
        return ids.tobytes(), (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()

    def _in_parts(self, text: str, ends: list[int], fast: bool) -> tuple[bytes, list[int]]:
        """A sentence at a time, those with a long word, or all if not ``fast``, by the tokenizer itself."""
        ids, cuts, begin = array("I"), [], 0
        for end in ends:
            part = text[begin:end]
            slow = not fast or end - begin > LONG and LONG_WORD.search(part)
            ids.extend(self._slow(part) if slow else self.fast(part))
            cuts.append(len(ids))
            begin = end
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes(), cuts


def best_cuts(places: Sequence[int], prices: Sequence[int], width: int = WIDTH,
              unpadded_from: int = NO_PADDING_FROM) -> list[int]:
    """Indices of the cuts, first and last place included, that cost least.

    A window between two cuts holds at most ``width`` tokens and costs its padding up to ``width`` (none
    at a power of two from ``unpadded_from``) and the price of its end. Places ascend and no two
    neighbours lie more than ``width`` apart. For windows that are padded, the best begin is the least of
    cost plus place over a sliding range, which a monotone queue keeps at its head.
    """
    count = len(places)
    cost, came = [0] * count, [0] * count
    at = {place: k for k, place in enumerate(places)}
    exact = [1 << k for k in range(width.bit_length()) if unpadded_from <= 1 << k < width]
    queue: deque[tuple[int, int]] = deque([(places[0], 0)])  # (cost + place, index), ascending
    for k in range(1, count):
        here = places[k]
        while places[queue[0][1]] < here - width:
            queue.popleft()
        best, begin = queue[0][0] + width - here, queue[0][1]
        for size in exact:
            j = at.get(here - size)
            if j is not None and cost[j] < best:
                best, begin = cost[j], j
        cost[k], came[k] = best + prices[k], begin
        key = cost[k] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, k))
    cuts = [count - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Windows over a stream of documents; holds some hundred windows of tokens besides one document."""

    def __init__(self, width: int, first_sequence: int) -> None:
        self.width, self.sequence = width, first_sequence
        self.ids = bytearray()
        self.places, self.prices = [0], [0]
        self.docs: list[tuple[int, int, int]] = []  # (doc_id, place of its first token, its tokens)

    def add(self, doc_id: int, ids: bytes, cuts: list[int]) -> Iterator[tuple]:
        """Take in a document with its end id; give the pieces that are decided."""
        begin, size = len(self.ids) // 4, len(ids) // 4
        self.docs.append((doc_id, begin, size))
        self.ids += ids
        last = 0
        for cut in [*cuts, size]:
            if cut <= last or cut > size:
                continue
            while cut - last > STRIDE:
                last += min(STRIDE, self.width)
                self._place(begin + last, ELSEWHERE)
            self._place(begin + cut, AT_DOCUMENT if cut == size else AT_SENTENCE)
            last = cut
        while self.places[-1] > AHEAD * self.width:
            yield from self.decide(HELD_BACK)

    def _place(self, place: int, price: int) -> None:
        if place > self.places[-1]:
            self.places.append(place)
            self.prices.append(price)

    def decide(self, held_back: int) -> Iterator[tuple]:
        """Cut what is held; the last ``held_back`` windows stay to be cut with what follows."""
        # of a very long document, decide a stretch at a time
        upto = np.searchsorted(self.places, 2 * AHEAD * self.width) if held_back else len(self.places)
        cuts = best_cuts(self.places[:upto], self.prices[:upto], self.width)
        if held_back:
            cuts = cuts[:max(2, len(cuts) - held_back)]
        d, docs = 0, self.docs
        for a, b in zip(cuts, cuts[1:]):
            begin, end = self.places[a], self.places[b]
            at = begin
            while at < end:
                while docs[d][1] + docs[d][2] <= at:
                    d += 1
                doc_id, from_, size = docs[d]
                upto = min(end, from_ + size)
                yield (doc_id, at - from_, upto - at, size, self.sequence, at - begin,
                       bytes(self.ids[4 * at:4 * upto]))
                at = upto
            self.sequence += 1
        done = self.places[cuts[-1]]
        del self.ids[:4 * done]
        self.places = [p - done for p in self.places[cuts[-1]:]]
        self.prices = self.prices[cuts[-1]:]
        self.docs = [(i, p - done, n) for i, p, n in docs if p + n > done]

    def finish(self) -> Iterator[tuple]:
        if len(self.places) > 1:
            yield from self.decide(0)


@lru_cache(maxsize=2)
def _definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def pack(df: DataFrame, tokenizer_path: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """Cut the stream of ``doc_id``-ordered texts into sequences of at most ``width`` tokens.

    Each document gives its tokens and then ``end_id``. Windows end at documents' or sentences' ends, or
    at a higher price every ``STRIDE`` tokens of a stretch without one; the cuts cost least in padding and
    prices. One row per piece of a document in a sequence, with the piece's ids.

    A null or empty text is a document of the end id alone; null ids come first; rows with the same id are
    documents of their own, ordered by text within a range. A very long text spans many sequences. An empty table gives
    no rows; other columns, whatever their names, are left out.

    Rows are dealt by ranges of ``doc_id`` and a hash of the text, so no key gathers in one task, and each range is packed as a
    stream. Only the last sequence of a range is cut short for lack of rows. ``sequence_id`` is the
    number of the range times 2**32 plus the number in it, and a task that runs again gives the same.
    """
    definition = df.sparkSession.sparkContext.broadcast(_definition(tokenizer_path))  # fixed size
    end = np.array([end_id], dtype="<u4").tobytes()
    name = tokenizer_path
    columns = [field.name for field in PIECE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("tokens")
        if store.get("name") != name:
            store["tokens"], store["name"] = Tokens(definition.value), name
        tokens = store["tokens"]
        packer = Packer(width, TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            types = [pa.int64()] * 6 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

        for one in batches:
            for doc_id, text in zip(one.column(0).to_pylist(), one.column(1).to_pylist()):
                ids, cuts = tokens.encode(text or "")
                for row in packer.add(doc_id, ids + end, cuts):
                    rows.append(row)
                    held += len(row[-1])
                    if held > 1 << 23:
                        yield batch()
                        rows, held = [], 0
        rows.extend(packer.finish())
        if rows:
            yield batch()

    ordered = (df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(run, PIECE)
