"""Hard negatives: for each anchor and near row of its label, the nearest rows of other labels within a window of scores."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.rows import ship
from tidemark.session import durable

SAMPLE = 4096  # the first level's split points are chosen among so many vectors
CELLS = 64  # at most so many of them
ARITY, LEAF = 8, 96  # split points of a node within a shard, and rows of a leaf
SHARD_ROWS = (4096, 65536)  # least and most rows of a tree
SHARD_BYTES = 64 << 20
QUERIES = 32_768  # queries that a tree answers in one task, streamed past it
ASKED = 1024  # of these, searched at a time


def lifted(x: np.ndarray, radius2: float) -> np.ndarray:
    """Rows with one more column that gives them all one length, so that a larger product with a query (which gets
    a zero there) is a smaller distance to it."""
    rest = np.sqrt(np.maximum(radius2 - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of a and those of b."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def spread_points(x: np.ndarray, most: int) -> np.ndarray:
    """Rows of x far from each other: each next one is the farthest from those chosen; fewer if the rest are equal."""
    chosen = [0]
    far = apart(x, x[:1])[:, 0]
    while len(chosen) < min(most, len(x)):
        place = int(far.argmax())
        if far[place] <= 1e-6 * (1 + np.abs(x).max()):
            break
        chosen.append(place)
        far = np.minimum(far, apart(x, x[place:place + 1])[:, 0])
    return x[chosen]


class Ring:
    """What a query still wants: rows whose distance from it is between ``near`` and ``far``."""

    def __init__(self, squares: np.ndarray, radius2: float) -> None:
        self.level = squares + radius2
        self.slack = 1e-6 * np.sqrt(self.level) + 1e-9  # rounding never loses a row

    def distance(self, score: np.ndarray, who: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.level[who] - 2 * score, 0))


def meets(away: np.ndarray, near: np.ndarray, far: np.ndarray, slack: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which subtrees can hold a row between ``near`` and ``far`` of each query.

    ``away[q, i]`` is the query's distance from split point i; ``low[i, j]`` and ``high[i, j]`` are the
    least and greatest distance of the rows of subtree j from it. By the triangle inequality a wanted
    row is between ``max(away - far, near - away)`` and ``away + far`` of each split point; a subtree of which one
    range does not meet that is left out.
    """
    least = np.maximum(away - far[:, None], near[:, None] - away) - slack[:, None]
    most = away + far[:, None] + slack[:, None]
    return ((low[None] <= most[:, :, None]) & (high[None] >= least[:, :, None])).all(axis=1)


class Node:
    __slots__ = ("points", "low", "high", "children")


class Tree:
    """A multiway hyperplane tree over lifted rows. A node has split points far from each other, each row goes to
    the nearest one, and for each split point and subtree the range of distances is kept; leaves are
    compared as a whole. Rows that are all equal make one leaf."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, radius2: float) -> None:
        self.rows, self.labels, self.radius2 = rows, labels, radius2
        self.up = lifted(rows.astype(np.float64), radius2)
        self.root = self._build(np.arange(len(rows)))

    def _build(self, rows: np.ndarray) -> Node | np.ndarray:
        if len(rows) <= LEAF:
            return rows
        x = self.up[rows]
        points = spread_points(x[::max(1, len(x) // (ARITY * 32))], ARITY)
        if len(points) < 2:
            points = spread_points(x, ARITY)
            if len(points) < 2:
                return rows
        node = Node()
        away = apart(x, points)
        home = away.argmin(axis=1)
        parts = [p for p in (np.flatnonzero(home == j) for j in range(len(points))) if len(p)]
        if len(parts) < 2:
            return rows
        node.points = points
        node.low = np.stack([away[p].min(axis=0) for p in parts], axis=1)
        node.high = np.stack([away[p].max(axis=0) for p in parts], axis=1)
        node.children = [self._build(rows[p]) for p in parts]
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, same: bool, tops: np.ndarray, floors: np.ndarray, most: int
               ) -> tuple[np.ndarray, np.ndarray]:
        """Rows (-1: none) and scores of the first ``most`` rows of each query and window, in falling order of scores, ties by
        row number. A window takes scores from its floor up to its top, of rows whose label is (``same``) or is not ``own``;
        one whose floor is above its top takes none."""
        n, windows = tops.shape
        self.queries, self.own, self.same, self.tops, self.floors = queries, own, same, tops, floors
        self.found = np.full((n, windows, most), -1, dtype=np.int64)
        self.scores = np.full((n, windows, most), -np.inf) if queries.dtype == np.float64 else np.full(
            (n, windows, most), np.iinfo(np.int64).min)
        self.asked = np.concatenate([queries.astype(np.float64), np.zeros((n, 1))], axis=1)
        self.ring = Ring((self.asked ** 2).sum(axis=1), self.radius2)
        self._visit(self.root, np.flatnonzero((floors <= tops).any(axis=1)))
        return self.found, self.scores

    def _wanted(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance at which a row still matters to some window of each query."""
        tops, floors = self.tops[who].astype(np.float64), self.floors[who].astype(np.float64)
        floors = np.maximum(floors, self.scores[who, :, -1].astype(np.float64))
        open_ = floors <= tops
        top = np.where(open_, tops, -np.inf).max(axis=1)
        floor = np.where(open_, floors, np.inf).min(axis=1)
        limit = 2 * self.ring.level[who]
        return (self.ring.distance(np.clip(top, -limit, limit), who), self.ring.distance(np.clip(floor, -limit, limit), who))

    def _visit(self, node: Node | np.ndarray, who: np.ndarray) -> None:
        if not len(who):
            return
        if not isinstance(node, Node):
            self._take(who, node)
            return
        away = apart(self.asked[who], node.points)
        first = away[:, :].argmin(axis=1) if len(node.children) == len(node.points) else None
        for turn in (True, False) if first is not None else (None,):
            for j, child in enumerate(node.children):
                group = np.arange(len(who)) if turn is None else np.flatnonzero((first == j) == turn)
                if not len(group):
                    continue
                near, far = self._wanted(who[group])
                open_ = meets(away[group], near, far, self.ring.slack[who[group]], node.low[:, j:j + 1], node.high[:, j:j + 1])[:, 0]
                self._visit(child, who[group[open_]])

    def _take(self, who: np.ndarray, rows: np.ndarray) -> None:
        products = self.queries[who] @ self.rows[rows].T
        labels = (self.own[who][:, None] == self.labels[rows][None, :]) == self.same
        for w in range(self.tops.shape[1]):
            last = self.scores[who, w, -1]
            fits = (labels & (products <= self.tops[who, w][:, None]) & (products >= self.floors[who, w][:, None])
                    & (products >= last[:, None]))
            better = np.flatnonzero(fits.any(axis=1))
            if not len(better):
                continue
            one = who[better]
            none = self.scores.dtype.type(-np.inf) if self.scores.dtype == np.float64 else np.iinfo(np.int64).min
            scores = np.concatenate([self.scores[one, w], np.where(fits[better], products[better], none)], axis=1)
            found = np.concatenate([self.found[one, w], np.where(fits[better], rows[None, :], -1)], axis=1)
            order = np.lexsort((found, -scores if scores.dtype == np.float64 else ~scores), axis=1)[:, :self.found.shape[2]]
            self.scores[one, w] = np.take_along_axis(scores, order, axis=1)
            self.found[one, w] = np.take_along_axis(found, order, axis=1)


class Level:
    """The tree's first level, over the whole table: split points, and for each of them the range of distances of
    each cell's rows."""

    def __init__(self, points: np.ndarray, radius2: float, width: int) -> None:
        self.points, self.radius2, self.width = points, radius2, width
        self.low = self.high = None

    def away(self, x: np.ndarray, asks: bool) -> np.ndarray:
        up = np.concatenate([x, np.zeros((len(x), 1))], axis=1) if asks else lifted(x, self.radius2)
        return apart(up, self.points)


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Rows of long vectors, short ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


VECTOR = ArrayType(LongType())
ROWS = StructType([
    StructField("gid", LongType()), StructField("ids", ArrayType(LongType())), StructField("label", LongType()),
    StructField("vector", VECTOR), StructField("cell", IntegerType()),
])
RANGES = StructType([
    StructField("point", IntegerType()), StructField("cell", IntegerType()), StructField("low", DoubleType()),
    StructField("high", DoubleType()),
])
WINDOW = ArrayType(LongType())
VISITS = StructType([
    StructField("gid", LongType()), StructField("label", LongType()), StructField("vector", VECTOR),
    StructField("tops", WINDOW), StructField("floors", WINDOW), StructField("marks", WINDOW),
    StructField("cells", ArrayType(IntegerType())),
])
HITS = StructType([
    StructField("gid", LongType()), StructField("mark", LongType()), StructField("vec_id", LongType()),
    StructField("score", LongType()),
])
_LEAST, _MOST = -(1 << 62), 1 << 62


class Index:
    """The rows to be searched, dealt to shards of a bounded size below the cells of the first level.

    A row is a vector and label, with its few smallest ids: no other of its copies can be among the first of any
    search. A cell is the rows nearest to one split point; its shards are cut by a hash.
    """

    def __init__(self, rows: DataFrame, few: int) -> None:
        """``rows``: vec_id, label, vector (whole numbers)."""
        spark = rows.sparkSession
        self.spark, self.few = spark, few
        rows = rows.withColumn("mark", F.xxhash64("vector"))
        nth = F.row_number().over(Window.partitionBy("mark", "vector", "label").orderBy("vec_id"))
        once = rows.select("mark", "vector", "label", "vec_id").distinct().withColumn("nth", nth).where(F.col("nth") <= few)
        # the numbering is fixed by being written
        groups = durable(once.groupBy("mark", "vector", "label").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                         .select(F.monotonically_increasing_id().alias("gid"), "ids", "label", "mark", "vector"))
        self.groups = groups
        squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
        self.total, width, radius2, top = groups.agg(
            F.count(F.lit(1)), F.max(F.size("vector")), F.max(squares), F.max(largest)).first()
        if not self.total:
            return
        self.width, self.radius2 = max(width, 1), radius2 or 0.0
        # products of such numbers are exact in doubles; larger ones are multiplied as whole numbers
        self.exact = self.width * float(top or 0) ** 2 < 2.0 ** 53
        parallel = spark.sparkContext.defaultParallelism
        wanted = min(max(self.total // (2 * parallel), SHARD_ROWS[0]), SHARD_ROWS[1])
        self.shard_rows = max(256, min(wanted, SHARD_BYTES // (16 * self.width)))
        self._place()

    def _place(self) -> None:
        width, radius2 = self.width, self.radius2
        picked = self.groups.orderBy(F.xxhash64("vector", "label"), "gid").limit(SAMPLE).select("vector").collect()
        sample = np.zeros((len(picked), width))
        for k, row in enumerate(picked):
            sample[k, :len(row[0])] = row[0]
        cells = min(CELLS, math.ceil(self.total / self.shard_rows))
        self.level = Level(spread_points(lifted(sample, radius2), cells), radius2, width)
        model = ship(self.spark, self.level)

        def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            level = model()
            for batch in batches:
                cell = level.away(whole_numbers(batch.column(3), width).astype(np.float64), False).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=ROWS.names)

        def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            level, count = model(), len(self_points)
            low, high = np.full((count, count), np.inf), np.full((count, count), -np.inf)
            for batch in batches:
                away = level.away(whole_numbers(batch.column(0), width).astype(np.float64), False)
                cell = batch.column(1).to_numpy()
                for c in np.unique(cell):
                    mine = away[cell == c]
                    low[:, c], high[:, c] = np.minimum(low[:, c], mine.min(axis=0)), np.maximum(high[:, c], mine.max(axis=0))
            point, c = np.nonzero(np.isfinite(low))
            yield pa.RecordBatch.from_arrays([pa.array(point, pa.int32()), pa.array(c, pa.int32()), pa.array(low[point, c]),
                                              pa.array(high[point, c])], names=RANGES.names)

        self_points = self.level.points
        self.placed = durable(self.groups.select("gid", "ids", "label", "vector").mapInArrow(place, ROWS))
        self.shards = {r[0]: math.ceil(r[1] / self.shard_rows) for r in self.placed.groupBy("cell").count().collect()}
        ranges = (self.placed.select("vector", "cell").mapInArrow(measure, RANGES).groupBy("point", "cell")
                  .agg(F.min("low"), F.max("high")).collect())  # a row for each two split points
        count = len(self_points)
        self.level.low, self.level.high = np.full((count, count), np.inf), np.full((count, count), -np.inf)
        for r in ranges:
            self.level.low[r[0], r[1]], self.level.high[r[0], r[1]] = r[2], r[3]

    def first(self, asked: DataFrame, same: bool, most: int) -> DataFrame:
        """Rows for each query (columns gid, label, vector and, for each window, tops, floors, marks) and window: columns gid, mark,
        vec_id, score.

        The query's own cell is searched first; what is found there narrows the windows for the others, and cells
        whose ranges miss the window's ring are left out for the query.
        """
        best = Window.partitionBy("gid", "mark").orderBy(F.desc("score"), "vec_id")

        def cut(hits: DataFrame) -> DataFrame:
            return hits.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most).drop("nth")

        own = durable(self._route(asked, None))
        begun = durable(cut(self._search(own, same, most)))
        full = begun.groupBy("gid", "mark").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= most)
        last = full.groupBy("gid").agg(F.map_from_entries(F.collect_list(F.struct("mark", "least"))).alias("last"))
        raised = F.zip_with("marks", "floors", lambda m, f: F.greatest(f, F.coalesce(F.col("last")[m], f)))
        narrowed = asked.join(last, "gid", "left").withColumn(
            "floors", F.when(F.col("last").isNull(), F.col("floors")).otherwise(raised)).drop("last")
        more = durable(self._route(narrowed, own))
        return cut(begun.unionByName(self._search(more, same, most)))

    def _route(self, asked: DataFrame, done: DataFrame | None) -> DataFrame:
        """The cells each query goes to: the nearest one, or with ``done`` all others that its ring meets."""
        model, width, taken = ship(self.spark, self.level), self.width, sorted(self.shards)
        own = done is None

        def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            level = model()
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = whole_numbers(batch.column(2), width).astype(np.float64)
                away = level.away(x, True)
                nearest = np.array(taken)[away[:, taken].argmin(axis=1)]
                if own:
                    cells = [[int(c)] for c in nearest]
                else:
                    ring = Ring((x * x).sum(axis=1), level.radius2)
                    limit = 2 * ring.level
                    bounds = [np.array([float(pick(v)) for v in batch.column(k).to_pylist()]) for k, pick in ((3, max), (4, min))]
                    near, far = (ring.distance(np.clip(b, -limit, limit), np.arange(len(x))) for b in bounds)
                    open_ = meets(away, near, far, ring.slack, level.low[:, taken], level.high[:, taken])
                    cells = [[taken[k] for k in np.flatnonzero(row) if taken[k] != home] for row, home in zip(open_, nearest)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=VISITS.names)

        return asked.select(VISITS.names[:-1]).mapInArrow(route, VISITS)

    def _search(self, visits: DataFrame, same: bool, most: int) -> DataFrame:
        """Each shard's tree is built once in a task and the queries are streamed past it; more than ``QUERIES``
        of them for one cell are dealt to several tasks."""
        spark, width, radius2, exact = self.spark, self.width, self.radius2, self.exact
        visits = visits.withColumn("cell", F.explode("cells")).drop("cells")
        asking = {r[0]: r[1] for r in visits.groupBy("cell").count().collect()}
        plan = [(c, self.shards[c], math.ceil(n / QUERIES)) for c, n in asking.items()]
        if not plan:
            return spark.createDataFrame([], HITS)
        sizes = F.broadcast(spark.createDataFrame(plan, "cell int, shards int, blocks int"))  # a row for each split point
        slot = F.pmod(F.xxhash64("gid"), F.lit(1 << 30))
        none = F.lit(None).cast(WINDOW)
        trees = self.placed.join(sizes, "cell").select(
            "cell", (slot % F.col("shards")).cast("int").alias("shard"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), "gid", "label", "vector",
            "ids", none.alias("floors"), none.alias("marks"))
        asks = visits.join(sizes, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), (slot % F.col("blocks")).cast("int").alias("block"),
            F.lit(1).alias("side"), "gid", "label", "vector", F.col("tops").alias("ids"), "floors", "marks")
        tasks = sum(shards * blocks for _, shards, blocks in plan)
        by = ("cell", "shard", "block")
        dealt = trees.unionByName(asks).repartition(min(tasks, 100_000), *by).sortWithinPartitions(*by, "side", F.col("ids")[0])

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = np.float64 if exact else np.int64
            at: tuple | None = None
            parts: list[pa.RecordBatch] = []
            tree: Tree | None = None
            for batch in batches:
                keys = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
                edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
                    if begin == end:
                        continue
                    part, key = batch.slice(begin, end - begin), tuple(keys[begin, :3].tolist())
                    if key != at:
                        at, parts, tree = key, [], None
                    if keys[begin, 3] == 0:
                        parts.append(part)
                        continue
                    if not parts:
                        continue  # a shard that the hash left empty
                    if tree is None:
                        table = pa.Table.from_batches(parts).combine_chunks()
                        vectors = whole_numbers(table["vector"].chunk(0), width)
                        tree = Tree(vectors.astype(kind), table["label"].to_numpy(), radius2)
                        ids = table["ids"].chunk(0)
                    for k in range(0, part.num_rows, ASKED):
                        yield from ask(tree, ids, part.slice(k, ASKED), kind)

        def ask(tree: Tree, ids: pa.ListArray, part: pa.RecordBatch, kind: type) -> Iterator[pa.RecordBatch]:
            queries = whole_numbers(part.column(6), width).astype(kind)
            count = max(len(t) for t in part.column(7).to_pylist())
            tops, floors, marks = (np.full((part.num_rows, count), fill) for fill in (_LEAST, _MOST, 0))
            for made, column in ((tops, 7), (floors, 8), (marks, 9)):
                for k, values in enumerate(part.column(column).to_pylist()):
                    made[k, :len(values)] = values
            found, scores = tree.search(queries, part.column(5).to_numpy(), same, tops, floors, most)
            q, w, nth = np.nonzero(found >= 0)
            hit = found[q, w, nth]
            offsets = ids.offsets.to_numpy()
            begin, repeat = offsets[hit], offsets[hit + 1] - offsets[hit]
            places = np.repeat(begin - np.cumsum(repeat) + repeat, repeat) + np.arange(repeat.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(part.column(4).to_numpy()[q], repeat), pa.int64()), pa.array(np.repeat(marks[q, w], repeat), pa.int64()),
                ids.values.take(pa.array(places, pa.int64())), pa.array(np.repeat(scores[q, w, nth].astype(np.int64), repeat), pa.int64()),
            ], names=HITS.names)

        return dealt.mapInArrow(work, HITS)


FOUND = StructType([StructField("anchor_id", LongType()), StructField("positive_id", LongType()), StructField("rank", IntegerType()),
                    StructField("negative_id", LongType()), StructField("positive_score", LongType()),
                    StructField("negative_score", LongType())])


def hard_negatives(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95),
                   key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """For each anchor and each of its ``positives`` first rows of its label, the ``negatives`` first rows of other labels.

    ``vector`` holds whole numbers; a score is the inner product with the anchor, higher first, ties by smaller id. With a
    positive's score p, rows count as negatives whose score s has ``window[0] p <= 100 s <= window[1] p``. Columns
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``. The search is exact.

    Rows with a null id, label, vector or component take no part. Rows equal in id, label and vector are one; rows that
    share an id otherwise are rows of their own, but none of an anchor's own id is its positive. Vectors of different length are
    compared as if filled up with zeros. An anchor without another row of its label gives no rows, nor does a pair
    without a row in its window. An empty table gives an empty one; other columns are left out.

    Copies are cut down to their smallest ids before the shuffle, and equal anchors of one label are searched once, so a
    third of all rows in one vector is a few rows of the index and one query.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                     F.col(vector).cast("array<bigint>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                      & F.forall("vector", lambda x: x.isNotNull()))
    index = Index(rows, max(positives + 1, negatives))
    if not index.total:
        return spark.createDataFrame([], FOUND)
    asking = rows.where("asks").withColumn("mark", F.xxhash64("vector")).select("mark", "vector", "label", "vec_id").distinct()
    asked = durable(asking.join(index.groups.drop("ids"), ["mark", "vector", "label"]).select("gid", "vec_id"))
    groups = index.groups.join(asked.select("gid").distinct(), "gid", "left_semi").select("gid", "label", "vector")
    everything = {name: F.array(F.lit(value).cast("long")) for name, value in (("tops", _MOST), ("floors", _LEAST), ("marks", 0))}
    # one more than asked for: an anchor may be among the first rows of its own search
    near = durable(index.first(groups.withColumns(everything), True, positives + 1))
    own = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    named = asked.withColumnRenamed("vec_id", "anchor_id").join(
        near.select("gid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "gid")
    pairs = durable(named.where("anchor_id <> positive_id").withColumn("nth", F.row_number().over(own))
                    .where(F.col("nth") <= positives).drop("nth"))
    # 100 s between both bounds, as whole numbers
    low, high = window
    score = "cast(positive_score AS decimal(20, 0))"
    top = F.expr(f"({high} * {score} - pmod({high} * {score}, 100)) div 100")
    floor = F.expr(f"({low} * {score} + pmod(-{low} * {score}, 100)) div 100")
    windows = pairs.select("gid", F.col("positive_score").alias("mark"), top.alias("top"), floor.alias("floor")).distinct()
    listed = windows.where("floor <= top").groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("mark", "top", "floor"))).alias("w"))
    questions = durable(groups.join(listed, "gid").select(
        "gid", "label", "vector", F.col("w.top").alias("tops"), F.col("w.floor").alias("floors"), F.col("w.mark").alias("marks")))
    ranked = Window.partitionBy("gid", "mark").orderBy(F.desc("score"), "vec_id")
    far = index.first(questions, False, negatives).withColumn("rank", F.row_number().over(ranked)).select(
        "gid", F.col("mark").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(durable(far), ["gid", "positive_score"]).select(FOUND.names)
