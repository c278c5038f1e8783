"""Chat formatting with a grammar round trip.

The template, turn by turn::

    user       [INST] text [/INST]
    system     <<SYS>>text<</SYS>>
    assistant  <s>text</s>
    any other  <|as role|>text<|end|>     (a null or empty role, and one that holds a control string, too)

A control string within a text is escaped by a backslash after its first character, and one that is
escaped already gets one more, so that taking a backslash away restores every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.rows import map_rows, texts_of

MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("<s>", "</s>")}
OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = "<|as ", "|>", "<|end|>"

OPENING = re.compile(r"\[INST\] |<<SYS>>|<s>|<\|as (.*?)\|>", re.DOTALL)
CLOSING = {"[INST] ": " [/INST]", "<<SYS>>": "<</SYS>>", "<s>": "</s>"}
ROLE = {"[INST] ": "user", "<<SYS>>": "system", "<s>": "assistant"}
# the rest of each control string after its first character
_REST = r"(/?INST\]|</?SYS>>|/?s>|\||end\|>)"
CONTROL = re.compile(rf"([\[<|])(\\*){_REST}")
ESCAPED = re.compile(rf"([\[<|])\\(\\*){_REST}")
# the bar that ends a role stands before its angle, so that pair is a control string as well
BAR = re.compile(r"\|(\\*)>")
ESCAPED_BAR = re.compile(r"\|\\(\\*)>")


def escape(text: str) -> str:
    return BAR.sub(r"|\\\1>", CONTROL.sub(r"\1\\\2\3", text))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", ESCAPED_BAR.sub(r"|\1>", text))


class Conflict(ValueError):
    """The rendered text does not follow the grammar from here on."""


def render(role: str, text: str) -> str:
    """A turn with its marks; role and text are put in as they are."""
    if role in MARKS:
        begin, end = MARKS[role]
        return f"{begin}{text}{end}"
    return f"{OTHER_OPEN}{role}{OTHER_MIDDLE}{text}{OTHER_CLOSE}"


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a rendered text: role, text (both unescaped), and where the text begins and ends."""
    at = 0
    while at < len(rendered):
        opening = OPENING.match(rendered, at)
        if opening is None:
            raise Conflict(f"no turn begins at {at}")
        mark = opening.group()
        closing = CLOSING.get(mark, OTHER_CLOSE)
        end = rendered.find(closing, opening.end())
        if end < 0:
            raise Conflict(f"the turn at {at} does not end")
        role = ROLE.get(mark)
        yield (unescape(opening.group(1)) if role is None else role, unescape(rendered[opening.end():end]),
               opening.end(), end)
        at = end + len(closing)


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """A rendered turn that parses back to just this turn, where its text lies in it, and how many times
    it was escaped.

    First as it is. While the parsed turns differ from the source, the text, and then the role, is
    escaped. A turn that parses back alone does so among others, as a turn ends where its mark does.
    """
    forms = ((role, text), (role, escape(text)), (escape(role), escape(text)))
    for times, (r, t) in enumerate(forms):
        rendered = render(r, t)
        try:
            turns = list(parse(rendered))
        except Conflict:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, turns[0][2], turns[0][3], times
    raise Conflict(f"a turn of role {role!r} cannot be escaped")


FORMATTED = [
    StructField("formatted", StringType()), StructField("text_start", LongType()),
    StructField("text_end", LongType()), StructField("times_escaped", LongType()),
]


def format_turns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Append each turn's rendered form; a conversation is the forms of its turns in order, joined by nothing.

    ``text_start`` and ``text_end`` bound the turn's text in ``formatted``: what the loss mask covers in
    an assistant's turn. A null text is an empty one, a null role is the empty role. Each row gives one
    row, repeated rows too; input columns with the added names are replaced; an empty table gives an
    empty one. A very long text needs memory for a few copies of itself.
    """

    def start():
        def work(roles: pa.Array, texts: pa.Array) -> list[pa.Array]:
            made = [format_turn(r, t) for r, t in zip(texts_of(roles), texts_of(texts))]
            forms, starts, ends, times = zip(*made) if made else ([], [], [], [])
            return [pa.array(forms, pa.string())] + [pa.array(c, pa.int64()) for c in (starts, ends, times)]

        return work

    return map_rows(df, ["role", "text"], FORMATTED, start, keep)


DIGEST = StructType([
    StructField("conv_id", LongType()), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
    StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()),
    StructField("formatted_chars", LongType()),
])


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted turns again and sum up each conversation.

    Takes ``conv_id``, ``turn`` and ``formatted``; rows are read by turn, null first, equal turns by their
    form. A conversation is read as a stream, so a very long one takes time in its task but no memory.
    Rows with a null ``conv_id`` are one conversation.
    """
    names = [field.name for field in DIGEST]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current, state = None, None

        def close() -> None:
            turns, turns_hash, loss, loss_hash, chars = state
            rows.append((current[0], turns, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), chars))

        def batch() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for one in batches:
            for conv_id, form in zip(one.column(0).to_pylist(), one.column(1).to_pylist()):
                if current != (conv_id,):
                    if current is not None:
                        close()
                    current, state = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(form)
                for role, text, _, _ in parse(form):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state[2] += len(text)
                        state[3].update(text.encode())
            if len(rows) >= 10_000:
                yield batch()
                rows = []
        if current is not None:
            close()
        if rows:
            yield batch()

    ordered = (formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "turn")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
               .select("conv_id", "formatted"))
    return ordered.mapInArrow(run, DIGEST)
