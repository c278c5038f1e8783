"""Similar vectors: all pairs above a cosine, and nearest neighbours by vantage-point trees."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from tidemark.llm.components import connected
from tidemark.llm.rows import ship
from tidemark.session import durable

SAMPLE = 4096  # directions and pivots are fitted on so many vectors
PIVOTS = 512  # at most so many cells; larger tables have more blocks in each
BLOCK, LARGEST_BLOCK = 4096, 32_768  # rows of one side of a comparison; the more rows, the fewer copies of each are sent
SLICE = 512  # of those, rows compared at a time
TREE, LEAF = 8192, 64  # rows of one tree, and of a leaf
QUERIES, ASKED_AT_ONCE = 32_768, 2048  # queries that one task puts to a tree, and of these together
MOST_TASKS = 100_000
RELAXED = 0.9  # share of the distance in hand that a branch must undercut; 1 is exact


def usable(vector: str) -> Column:
    """Whether all components are there and finite and some are not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unpacked(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, short ones filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def norms(x: np.ndarray) -> np.ndarray:
    # scaled, so that squares neither overflow nor vanish
    top = np.abs(x).max(axis=1, initial=0)
    top[top == 0] = 1
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x and the same row of y, in double precision and the same for equal rows."""
    return (x / norms(x)[:, None] * (y / norms(y)[:, None])).sum(axis=1)


class Layout:
    """Directions by falling variance, and pivots, of a sample of vectors."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        unit = sample / norms(sample)[:, None] if len(sample) else sample
        width = sample.shape[1]
        values, directions = np.linalg.eigh(unit.T @ unit) if len(sample) else (np.zeros(width), np.eye(width))
        self.directions = directions[:, np.argsort(-values)]
        pivots = unit[:max(1, min(cells, len(unit)))].copy() if len(unit) else np.zeros((1, width))
        for _ in range(4):
            if not len(unit):
                break
            nearest = (unit @ pivots.T).argmax(axis=1)
            for c in range(len(pivots)):
                mean = unit[nearest == c].sum(axis=0)
                size = np.sqrt(mean @ mean)
                if size > 1e-9:
                    pivots[c] = mean / size
        self.pivots = pivots

    def distances(self, unit: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * unit @ self.pivots.T, 0))


def fit_layout(vectors: DataFrame, key: str, vector: str, width: int, cells: int) -> Layout:
    rows = vectors.orderBy(F.xxhash64(key), key).limit(SAMPLE).select(F.col(vector).cast("array<double>")).collect()
    sample = np.zeros((len(rows), width))
    for k, row in enumerate(rows):
        sample[k, :len(row[0])] = row[0]
    return Layout(sample, cells)


# -- all pairs --------------------------------------------------------------------------------------

def pairs_above(a: np.ndarray, b: np.ndarray, least: float, one: bool
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs of unit rows whose product may reach ``least``, and the products; of one set, each pair once.

    Columns are ordered by falling variance. Products add up over leading columns first; what the rest
    can add is at most the product of the two rows' rest norms, and pairs that cannot reach ``least``
    any more are left at once. While many pairs remain the next columns are multiplied for all of them.
    """
    width = a.shape[1]
    steps = sorted({max(1, width // 4), max(1, width // 2), max(1, 3 * width // 4), width})
    rest_a = {k: np.sqrt(np.maximum((a[:, k:] ** 2).sum(axis=1), 0)) for k in steps}
    rest_b = {k: np.sqrt(np.maximum((b[:, k:] ** 2).sum(axis=1), 0)) for k in steps}
    least -= 1e-9
    for begin in range(0, len(a), SLICE):
        part = a[begin:begin + SLICE]
        done, products = 0, np.zeros((len(part), len(b)))
        pairs: tuple[np.ndarray, np.ndarray] | None = None
        for k in steps:
            if pairs is None:
                products += part[:, done:k] @ b[:, done:k].T
                alive = products + rest_a[k][begin:begin + SLICE, None] * rest_b[k][None, :] >= least
                if one:
                    alive &= np.arange(begin, begin + len(part))[:, None] < np.arange(len(b))[None, :]
                if alive.sum() * 20 <= alive.size or k == width:
                    pairs = np.nonzero(alive)
                    sums = products[pairs]
            elif len(pairs[0]):
                i, j = pairs
                sums = sums + (part[i, done:k] * b[j, done:k]).sum(axis=1)
                alive = sums + rest_a[k][begin + i] * rest_b[k][j] >= least
                pairs, sums = (i[alive], j[alive]), sums[alive]
            done = k
        if len(pairs[0]):
            yield pairs[0] + begin, pairs[1], sums


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked nodes one label, the least, by hooking and jumping until nothing changes."""
    while True:
        low = np.minimum(labels[a], labels[b])
        if (labels[a] == low).all() and (labels[b] == low).all():
            return
        for side in (a, b):
            np.minimum.at(labels, labels[side], low)
            np.minimum.at(labels, side, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


PLACED = StructType([
    StructField("id", LongType()), StructField("n", LongType()), StructField("vector", ArrayType(DoubleType())),
    StructField("width", IntegerType()), StructField("cell", IntegerType()), StructField("visits", ArrayType(IntegerType())),
])
FOUND = StructType([StructField("id", LongType()), StructField("root", LongType()), StructField("links", LongType())])


def similar_vectors(df: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each vector with the number of others at a cosine of at least ``least``, and its component.

    Columns ``vec_id``, ``n_links``, ``component_id`` (the least id that links reach), ``kept``
    (``vec_id = component_id``). All pairs that can reach the cosine are compared, in blocks:
    equal vectors are one, weighted by their number. Each vector lies in the cell of its nearest pivot and
    visits each earlier cell whose border is within reach, so any two similar vectors meet in one cell. A
    cell of many rows is cut into blocks by a hash, and each two blocks are compared in a task of their
    own, which gives sums and a spanning label for each row, never pairs.

    A vector that is null or zero or holds a null or a component that is not finite, and a row with a null
    id, links with nothing (no links, its own component). Vectors of different length never link. Rows
    with the same id are one node; each counts as another vector. An empty table gives an empty one; other
    columns are left out.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("usable", usable("vector") & F.col("vec_id").isNotNull())
    good = rows.where("usable").withColumn("mark", F.xxhash64("vector"))
    # equal vectors are grouped before the shuffle, so a third of all rows in one group is one row for each task
    groups = durable(good.groupBy("mark", "vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")))
    total, width = groups.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), "usable")
    if not total:
        return alone.drop("usable").withColumn("kept", F.lit(True))
    # as large as leaves each core of the cluster some tiles
    block = int(min(max(total // (8 * spark.sparkContext.defaultParallelism), BLOCK), max(LARGEST_BLOCK, BLOCK)))
    layout = fit_layout(groups, "id", "vector", width, min(PIVOTS, math.ceil(total / block)))
    reach = math.sqrt(2 - 2 * least) + 1e-9
    model = ship(spark, layout)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = model()
        between = np.sqrt(np.maximum(2 - 2 * shape.pivots @ shape.pivots.T, 0))
        for batch in batches:
            x = unpacked(batch.column(2), width)
            far = shape.distances(x / norms(x)[:, None])
            cell = far.argmin(axis=1)
            own = far[np.arange(len(x)), cell]
            # how far the border to each other cell is
            border = (far ** 2 - own[:, None] ** 2) / (2 * np.maximum(between[cell], 1e-12))
            visits = [np.flatnonzero(row[:c] <= reach).tolist() for row, c in zip(border, cell)]
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int32()),
                pa.array(cell, pa.int32()), pa.array(visits, pa.list_(pa.int32()))], names=PLACED.names)

    placed = durable(groups.select("id", "n", "vector").mapInArrow(place, PLACED))
    at_home = {(r[0], r[1]): r[2] for r in placed.groupBy("width", "cell").count().collect()}
    guests = {(r[0], r[1]): r[2] for r in placed.select("width", F.explode("visits").alias("c")).groupBy("width", "c").count().collect()}
    plan = [(w, c, math.ceil(n / block), math.ceil(guests.get((w, c), 0) / block)) for (w, c), n in at_home.items()]
    blocks = F.broadcast(spark.createDataFrame(plan, "width int, at int, homes int, visits_ int"))  # a row for each cell

    slot = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30))
    stays = placed.withColumn("at", F.col("cell")).join(blocks, ["width", "at"]).withColumn("b", (slot % F.col("homes")).cast("int"))
    comes = (placed.withColumn("at", F.explode("visits")).join(blocks, ["width", "at"])
             .withColumn("b", (slot % F.col("visits_")).cast("int")))
    columns = ["width", "at", "i", "j", "side", "id", "n", "vector"]
    # tiles: blocks i and j of a cell (i <= j), and block j with the guests' block, numbered -1 - i
    meets = stays.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
    home_pairs = meets.select("width", "at", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                              (F.col("b") > F.col("o")).cast("int").alias("side"), "id", "n", "vector")
    hosts = stays.where("visits_ > 0").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("visits_") - 1))).select(
        "width", "at", (-1 - F.col("o")).alias("i"), F.col("b").alias("j"), F.lit(1).alias("side"), "id", "n", "vector")
    visitors = comes.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("homes") - 1))).select(
        "width", "at", (-1 - F.col("b")).alias("i"), F.col("o").alias("j"), F.lit(0).alias("side"), "id", "n", "vector")
    tiles = home_pairs.select(columns).unionByName(hosts.select(columns)).unionByName(visitors.select(columns))

    def compare(tile: pa.Table) -> pa.Table:
        shape = model()
        tile = tile.combine_chunks()
        ids, counts = tile["id"].to_numpy(), tile["n"].to_numpy()
        order = np.argsort(ids, kind="stable")  # so that the least label is the least id
        ids, counts, side = ids[order], counts[order], tile["side"].to_numpy()[order]
        original = unpacked(tile["vector"].chunk(0), width)[order]
        turned = original / norms(original)[:, None] @ shape.directions
        one = tile["i"][0].as_py() == tile["j"][0].as_py()
        left = np.arange(len(ids)) if one else np.flatnonzero(side == 0)
        right = left if one else np.flatnonzero(side == 1)
        links, labels = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        if len(left) and len(right):
            for i, j, products in pairs_above(turned[left], turned[right], least, one):
                a, b = left[i], right[j]
                near = np.flatnonzero(products < least + 1e-9)  # turning may have moved these over the border
                true = np.ones(len(a), dtype=bool)
                true[near] = cosines(original[a[near]], original[b[near]]) >= least
                a, b = a[true], b[true]
                links += np.bincount(a, counts[b], len(ids)).astype(np.int64)
                links += np.bincount(b, counts[a], len(ids)).astype(np.int64)
                join_labels(labels, a, b)
        linked = links > 0
        return pa.table([pa.array(ids[linked], pa.int64()), pa.array(ids[labels[linked]], pa.int64()),
                         pa.array(links[linked], pa.int64())], names=FOUND.names)

    found = durable(tiles.groupBy("width", "at", "i", "j").applyInArrow(compare, FOUND))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected(found, "id", "root")
    known = groups.join(sums, "id", "left").join(roots, "id", "left").select(
        "mark", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"))
    linked = good.join(known, ["mark", "vector"]).select("vec_id", "n_links", "component_id")
    rest = alone.where(~F.col("usable")).drop("usable")
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


# -- nearest neighbours -----------------------------------------------------------------------------

class Tree:
    """A vantage-point tree over unit rows: each branch has the rows within a distance of its vantage
    point, and those beyond it; leaves are compared as a whole."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF) -> None:
        self.unit, self.leaf = unit, leaf
        self.root = self._build(np.arange(len(unit)))

    def _build(self, rows: np.ndarray) -> tuple | np.ndarray:
        if len(rows) <= self.leaf:
            return rows
        # the row farthest from the first one sees the others spread out most
        far = self.unit[rows] @ self.unit[rows[0]]
        point = rows[int(far.argmin())]
        rows = rows[rows != point]
        away = np.sqrt(np.maximum(2 - 2 * (self.unit[rows] @ self.unit[point]), 0))
        middle = float(np.median(away))
        inside = away <= middle
        if inside.all():  # all at one distance: halves of the same ball
            inside = np.arange(len(rows)) < len(rows) // 2
        bounds = (float(away[inside].min()), float(away[inside].max()),
                  float(away[~inside].min()), float(away[~inside].max()))
        return point, bounds, self._build(rows[inside]), self._build(rows[~inside])

    def search(self, queries: np.ndarray, most: int, reach: np.ndarray, relaxed: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows (-1: none) and cosines of the ``most`` nearest found for each query; ``reach`` is the
        distance that a row must not exceed to matter."""
        self.found = np.full((len(queries), most), -1, dtype=np.int64)
        self.close = np.full((len(queries), most), -np.inf)
        self.queries, self.reach, self.relaxed = queries, reach.copy(), relaxed
        self._visit(self.root, np.arange(len(queries)))
        return self.found, self.close

    def _take(self, who: np.ndarray, rows: np.ndarray) -> None:
        products = self.queries[who] @ self.unit[rows].T
        better = np.flatnonzero(products.max(axis=1) > self.close[who, -1])
        if not len(better):
            return
        who, products = who[better], products[better]
        close = np.concatenate([self.close[who], products], axis=1)
        found = np.concatenate([self.found[who], np.broadcast_to(rows, products.shape)], axis=1)
        order = np.argsort(-close, axis=1, kind="stable")[:, :self.close.shape[1]]
        self.close[who] = np.take_along_axis(close, order, axis=1)
        self.found[who] = np.take_along_axis(found, order, axis=1)
        last = np.sqrt(np.maximum(2 - 2 * self.close[who, -1], 0))
        self.reach[who] = np.minimum(self.reach[who], last)

    def _visit(self, node: tuple | np.ndarray, who: np.ndarray) -> None:
        if not len(who):
            return
        if not isinstance(node, tuple):
            if len(node):
                self._take(who, node)
            return
        point, (near_low, near_high, far_low, far_high), near, far = node
        self._take(who, np.array([point]))
        away = np.sqrt(np.maximum(2 - 2 * (self.queries[who] @ self.unit[point]), 0))
        # by the triangle inequality no row of a branch is nearer than this
        to_near = np.maximum(np.maximum(away - near_high, near_low - away), 0)
        to_far = np.maximum(np.maximum(away - far_high, far_low - away), 0)
        near_first = to_near <= to_far
        for first, group in ((True, near_first), (False, ~near_first)):
            order = ((near, to_near), (far, to_far)) if first else ((far, to_far), (near, to_near))
            for branch, bound in order:
                # a hair of slack for rounding, so that a factor of one never loses a row
                open_ = group & (bound <= self.relaxed * self.reach[who] + 1e-7)
                self._visit(branch, who[open_])


SHARDED = StructType([
    StructField("id", LongType()), StructField("ids", ArrayType(LongType())), StructField("vector", ArrayType(DoubleType())),
    StructField("cell", IntegerType()), StructField("away", DoubleType()),
])
HITS = StructType([
    StructField("query", LongType()), StructField("score", DoubleType()), StructField("vec_id", LongType()),
])
ASKED = StructType([
    StructField("query", LongType()), StructField("vector", ArrayType(DoubleType())), StructField("cell", IntegerType()),
    StructField("far", BinaryType()),
])


def nearest_vectors(df: DataFrame, queries: Column, most: int = 5, relaxed: float = RELAXED, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """The ``most`` nearest other rows by cosine of each row for which ``queries`` holds.

    Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id. Every row lies
    in the cell of its nearest pivot, and each cell is cut by a hash into shards of some ``TREE`` rows,
    each with a vantage-point tree. A query first searches its own cell; the distance to the last of
    its neighbours so far then rules out cells, and branches within trees, by the triangle inequality:
    one is left if it cannot hold a row nearer than ``relaxed`` times that distance. With 1 the
    search is exact. Final scores and their order are exact cosines of the original vectors.

    Equal vectors are one row of the index, with its ``most + 1`` smallest ids: no other of its copies
    can be among the nearest of any query. Equal queries are searched once. Vectors that are null or zero or
    hold null or not finite components, and rows with a null id, take no part; vectors of different
    length are compared as if filled up with zeros. A row's own id is never its neighbour, under which no
    repeated row of that id is either. With fewer other rows, there are fewer neighbours; an empty
    table gives no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
                     F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(usable("vector") & F.col("vec_id").isNotNull()).withColumn("mark", F.xxhash64("vector"))
    few = most + 1
    # the smallest ids of each vector; the limit works before the shuffle, so copies do not gather
    nth = F.row_number().over(Window.partitionBy("mark", "vector").orderBy("vec_id"))
    least = rows.select("mark", "vector", "vec_id").distinct().withColumn("nth", nth).where(F.col("nth") <= few)
    index = durable(least.groupBy("mark", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                    .select("vector", "ids", F.col("ids")[0].alias("id")))
    asked = rows.where("asks").groupBy("mark", "vector").agg(F.min("vec_id").alias("query"))
    asked = durable(asked)
    total, width = index.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    empty = StructType([StructField("query_id", LongType()), StructField("rank", IntegerType()),
                        StructField("vec_id", LongType()), StructField("score", DoubleType())])
    if not total:
        return spark.createDataFrame([], empty)
    layout = fit_layout(index, "id", "vector", width, min(PIVOTS, math.ceil(total / TREE)))
    model = ship(spark, layout)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(2), width)
            far = model().distances(x / norms(x)[:, None])
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()),
                                              pa.array(far[np.arange(len(x)), cell], pa.float64())], names=SHARDED.names)

    placed = durable(index.select("id", "ids", "vector").mapInArrow(place, SHARDED))
    cells = {r[0]: (r[1], r[2], r[3]) for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)), F.min("away"), F.max("away")).collect()}  # a row for each pivot
    shards = {c: math.ceil(n / TREE) for c, (n, _, _) in cells.items()}

    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(1), width)
            far = model().distances(x / norms(x)[:, None])
            taken = np.array([c in cells for c in range(far.shape[1])])
            cell = np.where(taken, far, np.inf).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()),
                                              pa.array([r.tobytes() for r in far], pa.binary())], names=ASKED.names)

    located = durable(asked.select("query", "vector").mapInArrow(locate, ASKED))
    slot = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30))

    def search(visits: DataFrame) -> DataFrame:
        """``visits``: query, vector, cell, reach. Each shard's tree is built once in a task, and the queries are streamed
        past it; more than ``QUERIES`` of them for one cell are dealt to several tasks."""
        asking = {r[0]: math.ceil(r[1] / QUERIES) for r in visits.groupBy("cell").count().collect()}
        plan = [(c, shards[c], n) for c, n in asking.items()]
        if not plan:
            return spark.createDataFrame([], HITS)
        sizes = F.broadcast(spark.createDataFrame(plan, "cell int, shards int, blocks int"))  # a row for each pivot
        trees = placed.join(sizes, "cell").select(
            "cell", (slot % F.col("shards")).cast("int").alias("shard"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"),
            "id", "vector", "ids", F.lit(None).cast("double").alias("reach"))
        asks = visits.join(sizes, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
            F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("side"),
            F.col("query").alias("id"), "vector", F.lit(None).cast("array<bigint>").alias("ids"), "reach")
        by = ("cell", "shard", "block")
        tasks = min(sum(s * n for _, s, n in plan), MOST_TASKS)
        dealt = trees.unionByName(asks).repartition(tasks, *by).sortWithinPartitions(*by, "side", "id")

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at: tuple | None = None
            parts: list[pa.RecordBatch] = []
            tree: Tree | None = None
            for batch in batches:
                keys = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
                edges = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
                for begin, end in zip([0, *edges], [*edges, len(keys)]):
                    if begin == end:
                        continue
                    part, key = batch.slice(begin, end - begin), tuple(keys[begin, :3].tolist())
                    if key != at:
                        at, parts, tree = key, [], None
                    if keys[begin, 3] == 0:
                        parts.append(part)
                    elif parts:  # a shard may have been left empty by the hash
                        if tree is None:
                            table = pa.Table.from_batches(parts).combine_chunks()
                            x, lists = unpacked(table["vector"].chunk(0), width), table["ids"].chunk(0)
                            tree = Tree(x / norms(x)[:, None])
                        for k in range(0, part.num_rows, ASKED_AT_ONCE):
                            yield meet(tree, x, lists, part.slice(k, ASKED_AT_ONCE))

        def meet(tree: Tree, x: np.ndarray, lists: pa.ListArray, ask: pa.RecordBatch) -> pa.RecordBatch:
            q = unpacked(ask.column(5), width)
            found, _ = tree.search(q / norms(q)[:, None], few + 2, ask.column(7).to_numpy(), relaxed)
            who, nth = np.nonzero(found >= 0)
            hit = found[who, nth]
            score = cosines(q[who], x[hit])
            begin, end = lists.offsets.to_numpy()[hit], lists.offsets.to_numpy()[hit + 1]
            repeat = end - begin
            places = np.repeat(begin - np.cumsum(repeat) + repeat, repeat) + np.arange(repeat.sum())
            return pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ask.column(4).to_numpy()[who], repeat), pa.int64()), pa.array(np.repeat(score, repeat), pa.float64()),
                lists.values.take(pa.array(places, pa.int64()))], names=HITS.names)

        return dealt.mapInArrow(work, HITS)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def top(hits: DataFrame) -> DataFrame:
        return hits.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= few)

    far_away = F.lit(3.0)
    first = durable(top(search(located.select("query", "vector", "cell", far_away.alias("reach")))))
    # the distance within which a row is still wanted, once there are enough neighbours
    last = first.where(F.col("nth") == few).select(
        "query", F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0))).alias("reach"))
    pending = located.join(last, "query", "left").withColumn("reach", F.coalesce("reach", far_away))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sorted(cells)
        low, high = (np.array([cells[c][k] for c in order]) for k in (1, 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            far = np.stack([np.frombuffer(f.as_py()) for f in batch.column(3)])[:, order]
            bound = np.maximum(np.maximum(far - high, low - far), 0)
            open_ = bound <= relaxed * batch.column(4).to_numpy()[:, None] + 1e-7
            visits = [[order[k] for k in np.flatnonzero(row) if order[k] != own]
                      for row, own in zip(open_, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(visits, pa.list_(pa.int32()))], names=["query", "cells"])

    routed = StructType([StructField("query", LongType()), StructField("cells", ArrayType(IntegerType()))])
    more = durable(pending.select("query", "vector", "cell", "far", "reach").mapInArrow(route, routed)
                   .select("query", F.explode("cells").alias("cell")))
    visits = more.join(pending.select("query", "vector", "reach"), "query")
    hits = first.drop("nth").unionByName(search(visits))
    nearest = top(hits.distinct())
    named = rows.where("asks").select("mark", "vector", F.col("vec_id").alias("query_id")).distinct().join(
        asked, ["mark", "vector"]).select("query_id", "query")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = (named.join(nearest.drop("nth"), "query").where("query_id <> vec_id")
              .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= most))
    return ranked.select("query_id", "rank", "vec_id", "score")
