"""Periodic runs: stretches of words that repeat with a fixed period, and texts without the repeats."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.rows import map_rows, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST_WORDS = 6  # a run has at least so many words
LEAST_TIMES = 4  # and its period fits so many times into it; the search below needs three or more
BLOCK = 64  # words compared at first when a seed is extended


def overlap(lag: int) -> int:
    """On how many places a shortest run with this period agrees with itself, moved by the period."""
    return max(LEAST_WORDS, LEAST_TIMES * lag) - lag


def agreeing(ids: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on where the words differ from those ``lag`` further, in growing blocks."""
    block, end = BLOCK, len(ids) - lag
    while at < end:
        stop = min(at + block, end)
        differ = np.flatnonzero(ids[at:stop] != ids[at + lag:stop + lag])
        if len(differ):
            return at + int(differ[0])
        at, block = stop, 2 * block
    return at


def longer(names: np.ndarray, places: np.ndarray, have: int, want: int) -> tuple[np.ndarray, np.ndarray]:
    """From the names of grams of ``have`` words to those of ``want`` (at most twice as many): names, and the places of
    grams that occur more than once. A gram that occurs once has the name -1, as has every longer one around it."""
    step = want - have
    places = places[places + step < len(names)]
    places = places[names[places + step] >= 0]
    pairs = names[places] * np.int64(len(names) + 1) + names[places + step]
    codes, different = pd.factorize(pairs)
    often = np.bincount(codes, minlength=len(different))[codes] > 1 if len(codes) else np.zeros(0, dtype=bool)
    made = np.full(len(names), -1, dtype=np.int64)
    made[places[often]] = codes[often]
    return made, places[often]


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All (start, length, period) of a text given by numbers for its words, by start, then period.

    Periods are taken in classes of doubling size. A run with a period of a class agrees with itself, moved by that
    period, on at least as many places as the class's grams are long; so each run has seeds, two places of one gram, a
    period apart. Grams are no shorter than the class's periods, so within a run a gram recurs after one period and no sooner:
    neighbouring places of a gram are pairs enough, however often it occurs, and a pair's distance is
    the smallest period of the run around it. A seed is extended both ways; what a lag has covered up to
    then is not extended again. Names of grams grow by doubling, and a gram that occurs once drops out for good.
    """
    found: list[tuple[int, int, int]] = []
    n = len(ids)
    if n < LEAST_WORDS:
        return found
    often = np.bincount(ids)[ids] > 1
    names, places, have = np.where(often, ids, -1).astype(np.int64), np.flatnonzero(often), 1
    low, high = 0, 1
    backwards = ids[::-1]
    while len(places) and max(LEAST_WORDS, LEAST_TIMES * (low + 1)) <= n:
        gram = overlap(low + 1)
        while have < gram and len(places):
            want = min(2 * have, gram)
            names, places = longer(names, places, have, want)
            have = want
        grouped = places[np.argsort(names[places], kind="stable")]  # places of one gram in order
        same = names[grouped[1:]] == names[grouped[:-1]]
        lags = grouped[1:] - grouped[:-1]
        seeds = same & (lags > low) & (lags <= high)
        starts, lags = grouped[:-1][seeds], lags[seeds]
        order = np.lexsort((starts, lags))
        starts, lags = starts[order], lags[order]
        edges = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            lag, of_lag, k = int(lags[begin]), starts[begin:end], 0
            while k < len(of_lag):
                seed = int(of_lag[k])
                right = agreeing(ids, seed + gram, lag)
                left = n - lag - agreeing(backwards, n - lag - seed, lag)
                if right - left >= overlap(lag):
                    found.append((left, right - left + lag, lag))
                k = int(np.searchsorted(of_lag, right))  # the furthest place this lag has covered
        low, high = high, 2 * high
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when of each run only the first period does."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
ARROW_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def periodic_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``n_words``, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    A run is a stretch of words with smallest period q, at least max(6, 4 q) words long, that cannot be extended
    either way. ``collapsed`` has the words that no run holds after its first period, joined by one space.

    Whole texts are searched, in time n log n of their words at most, and each by itself: nothing is shuffled. A
    null, empty or wordless text has no words, no runs and an empty ``collapsed``. Repeated rows each give a row;
    input columns with the added names are replaced; an empty table gives an empty one.
    """

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            counts, runs, collapsed = [], [], []
            for one in texts_of(column):
                words = WORD.findall(one)
                ids, _ = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, dtype=np.int64), None)
                found = find_runs(ids)
                if found:
                    kept = kept_words(len(words), found)
                    words = [w for w, stays in zip(words, kept.tolist()) if stays]
                counts.append(len(ids))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                collapsed.append(" ".join(words))
            return [pa.array(counts, pa.int64()), pa.array(runs, ARROW_RUNS), pa.array(collapsed, pa.string())]

        return work

    added = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
    return map_rows(df, [text], added, start, keep)
