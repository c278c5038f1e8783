"""JSON text expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_path(raw: Column | str, path: str, dtype: str = "string") -> Column:
    """The value at a dotted path of a JSON text; a bad or missing value gives NULL."""
    value = F.get_json_object(_col(raw), f"$.{path}")
    return value if dtype == "string" else value.try_cast(dtype)


def json_columns(raw: Column | str, fields: Mapping[str, str]) -> Column:
    """Several top-level fields in one parse, as a struct; use for wide projections."""
    schema = ", ".join(f"`{name}` {dtype}" for name, dtype in fields.items())
    return F.from_json(_col(raw), schema, {"mode": "PERMISSIVE"})


def _raw_pairs(text: str | None) -> list[dict] | None:
    """Keys of a JSON object and the text of their values as it stands; None for anything else."""
    if text is None:
        return None
    read, blank = json.JSONDecoder().raw_decode, " \t\r\n"
    pairs, at, size = [], 0, len(text)

    def skip(at: int) -> int:
        while at < size and text[at] in blank:
            at += 1
        return at

    try:
        at = skip(at)
        if text[at] != "{":
            return None
        at = skip(at + 1)
        while text[at] != "}":
            key, at = read(text, at)
            at = skip(at)
            if not isinstance(key, str) or text[at] != ":":
                return None
            begin = skip(at + 1)
            _, at = read(text, begin)
            pairs.append({"key": key, "raw": text[begin:at]})
            at = skip(at)
            if text[at] == ",":
                at = skip(at + 1)
                if text[at] == "}":
                    return None
            elif text[at] != "}":
                return None
        return pairs if skip(at + 1) == size else None
    except (ValueError, IndexError, RecursionError):
        return None


def json_pairs_raw(raw: Column | str) -> Column:
    """``[(key, value text)]`` in source order. A value's text is cut from the source as it stands: numbers
    keep their digits, texts their quotes, nested values their blanks. NULL for a broken text.

    Spark's own JSON functions write values anew, so the text is cut in Python, in Arrow batches.
    """

    @F.arrow_udf("array<struct<key: string, raw: string>>")
    def pairs(texts: pa.Array) -> pa.Array:
        return pa.array(map(_raw_pairs, texts.to_pylist()), pa.list_(pa.struct([("key", pa.string()), ("raw", pa.string())])))

    return pairs(_col(raw).cast("string"))


def json_to_map(raw: Column | str) -> Column:
    return F.from_json(_col(raw), "map<string,string>")


def json_encode(*columns: Column | str) -> Column:
    """One JSON object keyed by column name; NULL fields are kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_message(df: DataFrame, name: str = "raw") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(json_encode(*df.columns).alias(name))
