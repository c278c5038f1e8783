"""Near-duplicate documents by sparse weighted minhash signatures made of thrown darts."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)
from zstandard import ZstdCompressor, ZstdDecompressor

from tidemark.llm.components import connected
from tidemark.llm.rows import map_rows, texts_of
from tidemark.llm.vectors import join_labels
from tidemark.session import durable

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6  # a pair of similarity 0.8 shares no band with a chance of 6 in 100,000
CROWD = 64  # a bucket of more texts is compared in blocks, never as pairs
BLOCK = 2048  # texts in one side of such a comparison
COLUMNS = 4096  # shingles multiplied at a time

WORD = re.compile(r"\w+")
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# chances of at most 0, 1, 2 ... darts in a region of one dart on average
AT_MOST = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(20)])


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value of each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """The value's upper bits as a number in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` lower-case words, in order; of all words, if there are fewer."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    runs = max(len(words) - size + 1, 1)
    total = np.zeros(runs, dtype=np.uint64)
    for k in range(min(size, len(words))):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix(hashed[k:k + runs] + np.uint64(k + 1))
    return mix(total)


def cells(runs: np.ndarray) -> np.ndarray:
    """A value for each occurrence of each shingle: the first, the second and so on count as elements of
    their own, so that the share of common cells is the weighted similarity of the counts."""
    if not len(runs):
        return runs
    runs = np.sort(runs)
    new = np.concatenate([[True], runs[1:] != runs[:-1]])
    first = np.flatnonzero(new)
    nth = np.arange(len(runs)) - np.repeat(first, np.diff(np.append(first, len(runs))))
    return mix(runs + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def throw(regions: np.ndarray, low: int, high: int, coordinates: int, signature: np.ndarray,
          share: np.ndarray | None = None) -> None:
    """Throw the darts of ranks ``low`` to ``high`` into regions of unit weight; keep the earliest of each coordinate.

    Where a dart falls depends on the region and the rank alone, one dart on average for each unit of
    rank, so two sets get the same darts in the regions they share. A region that an element fills only to
    a ``share`` keeps the darts that fall into that part.
    """
    ranks = np.arange(low, high, dtype=np.uint64)
    fields = mix(regions[:, None] + mix(ranks * np.uint64(0xA0761D6478BD642F) + np.uint64(1))[None, :])
    count = np.searchsorted(AT_MOST, unit(mix(fields.ravel() + np.uint64(7))), side="right")
    field = np.repeat(np.arange(fields.size), count)
    nth = np.arange(len(field)) - np.repeat(np.cumsum(count) - count, count)
    dart = mix(fields.ravel()[field] + nth.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB) + np.uint64(3))
    rank = (ranks[field % len(ranks)].astype(np.float64) + unit(mix(dart + np.uint64(1)))).astype(np.float32)
    key = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart >> np.uint64(32))
    place = (mix(dart + np.uint64(2)) % np.uint64(coordinates)).astype(np.int64)
    if share is not None:
        inside = unit(mix(dart + np.uint64(4))) < share[field // len(ranks)]
        key, place = key[inside], place[inside]
    np.minimum.at(signature, place, key)


def sketch(regions: np.ndarray, coordinates: int, share: np.ndarray | None = None) -> np.ndarray:
    """The signature of a set of unit regions: two sets agree in each coordinate with the chance of their
    weighted similarity. Ranks go on until every coordinate has a dart, at first as far as mostly suffices."""
    signature = np.full(coordinates, EMPTY)
    weight = len(regions) if share is None else float(share.sum())
    if weight <= 0:
        return signature
    low, high = 0, max(1, math.ceil(coordinates * (math.log(coordinates) + 4) / weight))
    while True:
        # a wide stretch of ranks goes in parts, so that a long text takes bounded memory
        step = max(1, (1 << 20) // len(regions))
        for begin in range(low, high, step):
            throw(regions, begin, min(high, begin + step), coordinates, signature, share)
        if not (signature == EMPTY).any():
            return signature
        low, high = high, 2 * high


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature[:bands * rows].reshape(bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        total = mix(total + parts[:, k])
    return total


SKETCH = [
    StructField("content", BinaryType()), StructField("size", IntegerType()), StructField("buckets", ArrayType(LongType())),
]
ORDERS = 4  # orders among which the leaders of buckets are chosen; a bucket's last bits tell which


def sketches(df: DataFrame, text: str = "text", keep: list[str] | None = None, bands: int = BANDS,
             rows: int = ROWS) -> DataFrame:
    """Append of each text a digest of its words, the number of its cells and the buckets of its bands;
    nulls for a text without a word."""

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            contents, sizes, keys = [], [], []
            order = np.arange(bands, dtype=np.int64) % ORDERS
            for one in texts_of(column):
                runs = shingles(one)
                if not len(runs):
                    for made in (contents, sizes, keys):
                        made.append(None)
                    continue
                own = cells(runs)
                contents.append(xxhash.xxh3_128_digest(runs.tobytes()))
                sizes.append(len(np.unique(own >> np.uint64(32))))
                found = band_keys(sketch(own, bands * rows), bands, rows).view(np.int64)
                keys.append(found // ORDERS * ORDERS + order)
            return [pa.array(contents, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]

        return work

    return map_rows(df, [text], SKETCH, start, keep)


def packed_texts(df: DataFrame) -> DataFrame:
    """``doc_id`` and the compressed text, which is what is shuffled."""

    def start():
        pack = ZstdCompressor(level=1).compress

        def work(column: pa.Array) -> list[pa.Array]:
            return [pa.array([pack(t.encode("utf-8", "surrogatepass")) for t in texts_of(column)], pa.binary())]

        return work

    return map_rows(df, ["text"], [StructField("packed", BinaryType())], start, keep=["doc_id"])


def with_cells(packed: DataFrame) -> DataFrame:
    """Replace the compressed text by its cells, as sorted 32-bit values."""

    def start():
        unpack = ZstdDecompressor().decompress

        def work(column: pa.Array) -> list[pa.Array]:
            made = []
            for one in column.to_pylist():
                own = cells(shingles(unpack(one).decode("utf-8", "surrogatepass")))
                made.append(np.unique((own >> np.uint64(32)).astype("<u4")).tobytes())
            return [pa.array(made, pa.binary())]

        return work

    return map_rows(packed, ["packed"], [StructField("cells", BinaryType())], start, keep=["doc_id"])


def similar(pairs: DataFrame, sizes: DataFrame, celled: DataFrame, least: float) -> DataFrame:
    """Of the pairs ``a``, ``b`` those whose cells are similar enough, counted exactly."""
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("doc_id").alias(side), F.col("size").alias(f"size_{side}")), side)
    # two sets of very different sizes cannot be similar; cells are fetched for the rest alone
    pairs = pairs.where(F.least("size_a", "size_b") >= F.lit(least - 1e-9) * F.greatest("size_a", "size_b"))
    pairs = durable(pairs.select("a", "b").distinct())

    def cells_of(side: str) -> DataFrame:
        wanted = pairs.select(F.col(side).alias("doc_id")).distinct()
        return celled.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias(side), F.col("cells").alias(f"cells_{side}"))

    # the leaders' cells stay in place, only the other side's travel with the pair
    with_both = pairs.join(cells_of("b"), "b").join(cells_of("a"), "a")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_py(), dtype="<u4"), np.frombuffer(right.as_py(), dtype="<u4")
                common = np.intersect1d(x, y, assume_unique=True).size
                kept.append(common >= least * (len(x) + len(y) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return with_both.select("a", "b", "cells_a", "cells_b").mapInArrow(run, LINK)


def common_cells(owners: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """How many values each two rows have in common, counted by products of their incidence."""
    order = np.argsort(values, kind="stable")
    owners, values = owners[order], values[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=bool)
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1 if len(column) else new  # a value of one row alone is common to none
    owners, column = owners[often], column[often]
    column = np.unique(column, return_inverse=True)[1]
    common = np.zeros((rows, rows), dtype=np.float32)  # exact for counts below 2 ** 24
    for begin in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        low, high = np.searchsorted(column, [begin, begin + COLUMNS])
        incidence = np.zeros((rows, COLUMNS), dtype=np.float32)
        incidence[owners[low:high], column[low:high] - begin] = 1
        common += incidence @ incidence.T
    return common


LINK = StructType([StructField("a", LongType()), StructField("b", LongType())])


def crowd_links(crowds: DataFrame, celled: DataFrame, least: float) -> DataFrame:
    """Links within large buckets, given ``bucket``, ``id`` and the bucket's size ``n``.

    Each two blocks of a bucket meet in one task, which compares all their texts exactly and gives a link
    from each linked text to the least of those it is connected with there: never more links than texts.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    tiles = (crowds.select("bucket", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id"))
    tiles = tiles.join(celled.select(F.col("doc_id").alias("id"), "cells"), "id")

    def compare(tile: pa.Table) -> pa.Table:
        ids = tile["id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # so that the least label is the least id
        ids = ids[order]
        texts = tile["cells"].combine_chunks().take(pa.array(order)).to_pylist()
        parts = [np.frombuffer(t, dtype="<u4") for t in texts]
        sizes = np.array([len(p) for p in parts])
        common = common_cells(np.repeat(np.arange(len(ids)), sizes), np.concatenate(parts), len(ids))
        labels = np.arange(len(ids))
        twice = np.flatnonzero(ids[1:] == ids[:-1])  # two texts of one id
        join_labels(labels, twice, twice + 1)
        for k in range(0, len(ids), 256):
            shared = common[k:k + 256].astype(np.float64)
            close = shared >= least * (sizes[k:k + 256, None] + sizes[None, :] - shared) - 1e-9
            x, y = np.nonzero(close)
            join_labels(labels, x + k, y)
        linked = ids[labels] != ids
        return pa.table([pa.array(ids[linked], pa.int64()), pa.array(ids[labels[linked]], pa.int64())], names=LINK.names)

    return tiles.groupBy("bucket", "i", "j").applyInArrow(compare, LINK)


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", least: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Each ``doc_id`` with its class: ``class_id`` is the smallest id that links reach, ``kept`` whether it is its own.

    Two texts are linked if the weighted similarity of their counts of five-word shingles (lower-case
    words, other characters apart) is at least ``least`` and they share one of ``bands`` band keys.
    Texts with equal words are one text from the start, so copies are never paired. A bucket of more than
    ``CROWD`` texts is compared block by block. In a smaller one all texts are compared with one of
    them, in another order in some bands; what is in one class by then needs no comparing; at last the
    texts outside their bucket's largest class are compared with all of the bucket that are not in theirs. So
    each two texts in a bucket end in one class or have been compared.

    A text without a word (null and empty ones, too) is a class of its own. Rows with the same id are one
    document; with different texts, it joins the classes of all of them. A null id gives a null class and
    is kept. Other columns are left out. An empty table gives an empty one.
    """
    texts = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = durable(sketches(texts, keep=["doc_id"], bands=bands, rows=rows))
    worded = known.where("content is not null and doc_id is not null")
    # copies: the smallest id of equal words stands for all
    first = durable(worded.groupBy("content").agg(F.min("doc_id").alias("first")))
    copies = worded.select("doc_id", "content").join(first, "content").where("doc_id <> first").select("doc_id", "first")
    sizes = durable(worded.select("doc_id", "size", "buckets").join(
        first.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "size"]))

    placed = sizes.select(F.explode("buckets").alias("bucket"), F.col("doc_id").alias("id"))
    shared = placed.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members = durable(placed.join(shared.select("bucket"), "bucket").distinct())
    sizes = sizes.select("doc_id", "size")
    candidates = members.select(F.col("id").alias("doc_id")).distinct()
    packed = packed_texts(texts).join(candidates, "doc_id", "left_semi").dropDuplicates(["doc_id", "packed"])
    celled = durable(with_cells(packed))

    def leaders(members: DataFrame) -> DataFrame:
        ordered = members.withColumn("order", F.xxhash64("id", F.pmod("bucket", F.lit(ORDERS))))
        least_order = ordered.groupBy("bucket").agg(F.min("order").alias("least"))
        return ordered.join(least_order, "bucket").where("order = least").groupBy("bucket").agg(F.min("id").alias("leader"))

    counts = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    crowds = members.join(counts.where(F.col("n") > CROWD), "bucket")
    members = durable(members.join(counts.where(F.col("n") <= CROWD).select("bucket"), "bucket"))
    links = [durable(crowd_links(crowds, celled, least))]
    pairs = members.join(leaders(members), "bucket").where("id <> leader")
    pairs = pairs.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    links.append(durable(similar(pairs, sizes, celled, least)))
    classes = durable(connected(reduce(DataFrame.unionByName, links)))
    placed = members.join(classes, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    # the largest part of a bucket is compared from outside only
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    main = parts.join(mixed.select("bucket", "n"), ["bucket", "n"]).groupBy("bucket").agg(F.min("root").alias("main"))
    rest = durable(placed.join(main, "bucket"))
    outside = rest.where("root <> main").select("bucket", F.col("id").alias("x"), F.col("root").alias("root_x"))
    pairs = (outside.join(rest, "bucket").where("root_x <> root and (root = main or x < id)")
             .select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct())
    links.append(durable(similar(pairs, sizes, celled, least)))

    copied = copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    roots = connected(reduce(DataFrame.unionByName, links).select("a", "b").unionByName(copied))
    found = known.select("doc_id").distinct().join(roots.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    found = found.select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")).cast(BooleanType()))
