"""Exact encoding with a merge-type piece vocabulary by longest match and backtracking, and decoding."""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField

from tidemark.llm.rows import Recent, map_rows, ship, texts_of, worker_store

SPACE = "▁"
BEGIN, END = 1, 2
NORMAL, BYTE = 1, 6
LETTER = re.compile(r"[^\W\d_]")
AT_SPACES = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
AT_WORDS = re.compile(rf"{SPACE}*[^\W\d_]+|{SPACE}*(?:[^\w{SPACE}]|[\d_])+|{SPACE}+")


class Pieces:
    """The vocabulary of a model: text, merge score and kind of each id, and its byte pieces."""

    def __init__(self, texts: list[str], scores: list[float], kinds: list[int]) -> None:
        self.texts, self.scores, self.kinds = texts, scores, kinds

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read the vocabulary on the driver; tasks get it by value and need no file."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = [BYTE if model.is_byte(i) else 0 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
                 else NORMAL for i in ids]
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], kinds)


class Encoder:
    """Encodes texts to ids and back.

    The result of merging the best-scored adjacent pair until none is left is the only sequence of
    pieces in which each piece comes out of merging its own text and each two neighbours stay apart
    when the text of both is merged. So pieces are laid by longest match, neighbours are tried by
    merging, and a position from which no piece leads on is marked and left for good.
    """

    def __init__(self, pieces: Pieces, cached: int = 1 << 19) -> None:
        self.texts = list(pieces.texts)
        normal = [i for i, kind in enumerate(pieces.kinds) if kind == NORMAL]
        self.ids = {self.texts[i]: i for i in normal}
        self.scores = {self.texts[i]: pieces.scores[i] for i in normal}
        byte_ids = [i for i, kind in enumerate(pieces.kinds) if kind == BYTE]
        self.byte_ids = {int(self.texts[i][1:-1], 16): i for i in byte_ids}
        # characters that occur only within longer pieces take part in merging, too
        inner = {c for i in normal for c in self.texts[i]} - self.ids.keys()
        self.spelled = {}
        for c in sorted(inner):
            self.ids[c] = len(self.texts)
            self.spelled[self.ids[c]] = self._spell(c)
            self.texts.append(c)
        self.known = set("".join(self.texts[i] for i in normal))
        joined = {a + b for i in normal for a, b in zip(self.texts[i], self.texts[i][1:])}
        self.joined = joined
        # no piece may reach over a cut: a space sign only begins a piece, and where the model lets
        # letters be apart from all else, words are cut out, so that they are found in the cache again
        mixed = any((LETTER.match(a) is None) != (LETTER.match(b) is None) and a != SPACE for a, b in joined)
        self.cut = (AT_SPACES if mixed else AT_WORDS).findall
        if any(b == SPACE != a for a, b in joined):
            self.cut = lambda text: [text]
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if len(self.merge(text)) == 1:  # a piece that its own text does not merge to is never used
                self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.words = Recent(cached)
        self.pairs: dict[int, bool] = {}
        self.lengths = [len(text) for text in self.texts]
        plain = [b"" for _ in pieces.texts]
        for i in normal:
            plain[i] = self.texts[i].replace(SPACE, " ").encode()
        for value, i in self.byte_ids.items():
            plain[i] = bytes([value])
        self.plain = plain

    def _spell(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by definition: join the best-scored pair, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when their joint text is merged."""
        key = left << 24 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 1 << 20:
                self.pairs.clear()
            a, b = self.texts[left], self.texts[right]
            known = self.pairs[key] = a[-1] + b[0] not in self.joined or self.merge(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text all of whose characters occur in the vocabulary."""
        size, pairs, lengths = len(text), self.pairs, self.lengths
        starts: list[list[int]] = [[] for _ in text]
        for last, piece in self.automaton.iter(text):
            starts[last + 1 - lengths[piece]].append(piece)  # shorter matches end first
        found: list[int] = []
        picks: list[int] = []
        failed, at, here = 0, 0, starts[0]
        pick = len(here) - 1
        while True:
            while pick >= 0:
                piece = here[pick]
                end = at + lengths[piece]
                if not failed >> end & 1:
                    if not found:
                        break
                    fit = pairs.get(found[-1] << 24 | piece)
                    if fit or fit is None and self.fits(found[-1], piece):
                        break
                pick -= 1
            if pick >= 0:
                found.append(piece)
                if end == size:
                    return found
                picks.append(pick)
                at, here = end, starts[end]
                pick = len(here) - 1
            else:
                failed |= 1 << at
                at -= lengths[found.pop()]
                here, pick = starts[at], picks.pop() - 1

    def _stretch(self, text: str) -> list[int]:
        """Ids of a text in which each two neighbours occur side by side in some piece."""
        if len(text) == 1 and text not in self.known:
            return self._spell(text)
        ids = self.backtrack(text)
        if self.spelled:
            return [j for i in ids for j in self.spelled.get(i, (i,))]
        return ids

    def word(self, word: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of one of the stretches that ``cut`` gives."""
        got = self.words.find(word)
        if got is None:
            if len(word) <= 64 and self.known.issuperset(word):
                got = _packed(self._stretch(word))
            else:
                got = b"".join(self._parts(word))
            if len(word) <= 64:
                self.words.put(word, got)
        return got

    def _parts(self, word: str) -> Iterator[bytes]:
        """The word's ids cut where no piece has the two characters side by side."""
        begin, joined = 0, self.joined
        for end in range(1, len(word) + 1):
            if end == len(word) or word[end - 1] + word[end] not in joined:
                part = word[begin:end]
                known = self.words.find(part)
                if known is None:
                    known = _packed(self._stretch(part))
                    if len(part) <= 64:
                        self.words.put(part, known)
                yield known
                begin = end

    def encode(self, text: str) -> bytes:
        """Ids of a text between the begin and end ids."""
        if not text:
            return np.array([BEGIN, END], dtype="<u4").tobytes()
        words = self.cut(SPACE + text.replace(" ", SPACE))
        ids = list(map(self.words.get, words))
        if None in ids:
            ids = [self.word(w) if i is None else i for i, w in zip(ids, words)]
        edge = np.array([BEGIN, END], dtype="<u4").tobytes()
        return edge[:4] + b"".join(ids) + edge[4:]

    def decode(self, ids: bytes) -> str:
        """Text of ids; the space put before the first word goes, control ids give nothing, and a byte
        that is no part of a character gives the replacement character."""
        plain = self.plain
        raw = b"".join([plain[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = _decode_bytewise(raw)
        return text[1:] if text.startswith(" ") else text


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


def _decode_bytewise(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces.load(path)


def encode_texts(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``ids`` (binary: little-endian unsigned 32-bit ids with begin and end) and ``decoded``.

    Null and empty texts give the begin and end ids and the empty text. Every row gives one row, repeated
    rows too; an input column named ``ids`` or ``decoded`` is replaced. An empty table gives an empty one.
    A very long text costs memory in proportion to itself: words are encoded one by one and cached.
    """
    vocabulary = ship(df.sparkSession, _pieces(model_path))
    name = model_path

    def start():
        store = worker_store("pieces")
        if store.get("name") != name:
            store["encoder"] = Encoder(vocabulary())
            store["name"] = name
        encoder = store["encoder"]

        def work(column: pa.Array) -> list[pa.Array]:
            ids = [encoder.encode(t) for t in texts_of(column)]
            return [pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.string())]

        return work

    fields = [StructField("ids", BinaryType()), StructField("decoded", StringType())]
    return map_rows(df, [text], fields, start, keep, "pieces")
