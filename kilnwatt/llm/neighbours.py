"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all of them, and exact
reranking of what lies in the leaves.

The trees are fitted on a bounded sample, so what is broadcast doesn't grow; every vector is then dealt to a leaf of each
tree. A query takes branches from one queue shared by all trees, least distance to the splits first, until its leaves
should hold the wanted share of the vectors. Leaves are cut into chunks of bounded size; each meets its queries in one
task, which computes exact cosines and keeps the best of each query. Equal vectors are one vector with its least ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, phase, table

#: Vectors the trees are fitted on, at most: those with the smallest hashes.
SAMPLE = 16_384
TREES = 12
#: Sampled vectors of a leaf, at most.
LEAF = 32
#: What the leaves of a query should hold together, as a part of all vectors; a vector counts once per tree it is met in.
SHARE = 1.4
#: Vectors compared with their queries at once.
CHUNK = 8_192
NEAREST = 5


class Tree:
    """Splits `normal . x <= offset` to the left; `left` is -1 for a leaf, and `weight` its share of the sample."""

    def __init__(self, points: np.ndarray, rng: np.random.Generator):
        self.normal: list[np.ndarray] = []
        self.offset: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.weight: list[float] = []
        self._grow(points, np.arange(len(points)), rng)
        self.normals, self.offsets = np.array(self.normal), np.array(self.offset)
        self.lefts, self.rights = np.array(self.left), np.array(self.right)

    def parts(self) -> tuple:
        return self.normals, self.offsets, self.left, self.right, self.weight

    @classmethod
    def of(cls, parts: tuple) -> Tree:
        """The tree again, from arrays and lists that any worker can read."""
        tree = cls.__new__(cls)
        tree.normals, tree.offsets, tree.left, tree.right, tree.weight = parts
        tree.lefts, tree.rights = np.array(tree.left), np.array(tree.right)
        return tree

    def _grow(self, points: np.ndarray, own: np.ndarray, rng: np.random.Generator) -> int:
        here = len(self.left)
        self.normal.append(np.zeros(points.shape[1]))
        self.offset.append(0.0)
        self.left.append(-1)
        self.right.append(-1)
        self.weight.append(len(own) / max(1, len(points)))
        if len(own) <= LEAF:
            return here
        # A random direction between two points, turned towards the two halves it makes.
        a, b = points[rng.choice(own, 2, replace=False)]
        some = points[rng.choice(own, min(len(own), 200), replace=False)]
        for _ in range(5):
            side = some @ (a - b) > 0
            if side.all() or not side.any():
                break
            a, b = some[side].mean(0), some[~side].mean(0)
        normal = a - b
        if not np.linalg.norm(normal):
            return here
        normal = normal / np.linalg.norm(normal)
        place = points[own] @ normal
        middle = float(np.median(place))
        low, high = own[place <= middle], own[place > middle]
        if not len(low) or not len(high):
            return here
        self.normal[here], self.offset[here] = normal, middle
        self.left[here] = self._grow(points, low, rng)
        self.right[here] = self._grow(points, high, rng)
        return here

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.lefts[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            low = np.einsum("ij,ij->i", x[inner], self.normals[at]) <= self.offsets[at]
            node[inner] = np.where(low, self.lefts[at], self.rights[at])


def leaves_for(forest: list[Tree], x: np.ndarray, share: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs for one query, from a queue of branches ordered by the squared distances to the splits crossed."""
    along = [t.normals @ x - t.offsets for t in forest]
    queue = [(0.0, i, 0) for i in range(len(forest))]
    out, held = [], 0.0
    while queue and held < share:
        far, tree, node = heapq.heappop(queue)
        t = forest[tree]
        while t.left[node] >= 0:
            d = along[tree][node]
            near, other = (t.left[node], t.right[node]) if d <= 0 else (t.right[node], t.left[node])
            heapq.heappush(queue, (far + d * d, tree, other))
            node = near
        out.append((tree, node))
        held += t.weight[node]
    return out


def _vector(column: str) -> Column:
    """The vector as doubles; null if it is null, empty, zero, or holds a null or non-finite component."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), v)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    big = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return big / np.linalg.norm(big, axis=1, keepdims=True)


def nearest(vectors: DataFrame, every: int, k: int = NEAREST, trees: int = TREES, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose vec_id is divisible by `every`, the k nearest other rows found.

    `vectors` has vec_id and embedding; other columns play no part. Vectors that are null, empty, zero or hold a null or
    non-finite component, rows without id, and vectors of another length than the commonest of the sample take no part.
    Ties go to the smaller id. A repeated id is a row of its own; a query never finds rows of its own id.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _vector("embedding").alias("v")).filter("vec_id is not null and v is not null")
    given = phase(given, "neighbours-rows")
    # k + 1 least ids of a vector are all that any query can return of it.
    alike = Window.partitionBy("v").orderBy("vec_id")
    few = given.distinct().withColumn("_n", F.row_number().over(alike)).filter(F.col("_n") <= k + 1)
    points = phase(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "neighbours-points")
    sample = points.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()["v"].tolist()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sample:
        return empty
    width = int(np.bincount([len(s) for s in sample]).argmax())
    base = _unit(np.array([s for s in sample if len(s) == width], dtype=np.float64))
    rng = np.random.default_rng(5)
    forest = vectors.sparkSession.sparkContext.broadcast([Tree(base, rng).parts() for _ in range(trees)])

    points = points.filter(F.size("v") == width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = [Tree.of(parts) for parts in forest.value]
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column("v")))
                for i, tree in enumerate(grown):
                    n = batch.num_rows
                    yield pa.record_batch([pa.array(np.full(n, i, np.int32)), pa.array(tree.leaf_of(x).astype(np.int32)), batch.column("ids"), batch.column("v")], names=["tree", "leaf", "ids", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = [Tree.of(parts) for parts in forest.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column("v")))
            for i in range(len(x)):
                seen = leaves_for(grown, x[i], share)
                tree, leaf = (np.array(c, dtype=np.int32) for c in zip(*seen, strict=True))
                rows = pa.array(np.full(len(seen), i))
                yield pa.record_batch([pa.array(tree), pa.array(leaf), batch.column("ids").take(rows), batch.column("v").take(rows)], names=["tree", "leaf", "ids", "v"])

    kind = "tree int, leaf int, ids array<long>, v array<double>"
    queries = phase(given.filter((F.col("vec_id") % every == 0) & (F.size("v") == width)).distinct(), "neighbours-queries")
    placed = phase(points.mapInArrow(lean(deal), kind), "neighbours-leaves")
    # Leaves of more than CHUNK vectors are cut by a hash, and their queries go to every cut.
    cuts = placed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("cuts"))
    cuts = phase(cuts, "neighbours-cuts")  # a row per leaf of trees that were fitted on a bounded sample
    members = placed.join(F.broadcast(cuts), ["tree", "leaf"]).withColumn("cut", F.pmod(F.xxhash64("v"), F.col("cuts")).cast("int"))
    wanted = queries.select(F.array("vec_id").alias("ids"), "v").mapInArrow(lean(ask), kind)
    wanted = wanted.join(F.broadcast(cuts), ["tree", "leaf"]).withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    columns = ["tree", "leaf", "cut", "ids", "v"]
    both = members.select(*columns, F.lit(0).alias("asks")).unionByName(wanted.select(*columns, F.lit(1).alias("asks")))
    dealt = both.repartition("tree", "leaf", "cut").sortWithinPartitions("tree", "leaf", "cut", "asks")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, x = None, [], None
        held: list[tuple[list, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(n).to_numpy() for n in ("tree", "leaf", "cut")])
            asks = batch.column("asks").to_numpy()
            v = _matrix(batch.column("v"))
            names = batch.column("ids").to_pylist()
            change = np.any(key[:, 1:] != key[:, :-1], axis=0) | (asks[1:] != asks[:-1])
            begins = [0, *(np.flatnonzero(change) + 1).tolist()]
            for a, b in zip(begins, [*begins[1:], len(asks)], strict=True):
                here = tuple(key[:, a])
                if here != place:
                    place, held, ids, x = here, [], [], None
                if not asks[a]:
                    held.append((names[a:b], v[a:b]))
                    continue
                if not held and x is None:
                    continue
                if x is None or held:
                    ids, x = sum((h[0] for h in held), ids), _unit(np.concatenate([h[1] for h in held]))
                    held = []
                rough = _unit(v[a:b]) @ x.T
                most = min(k + 1, len(ids))
                # More than k candidates where scores tie at the end: those within rounding of the last are kept.
                last = np.partition(rough, -most, axis=1)[:, -most]
                row, at = np.nonzero(rough >= last[:, None] - 1e-12)
                out = [(names[a + r][0], i, float(rough[r, c])) for r, c in zip(row.tolist(), at.tolist(), strict=True) for i in ids[c] if i != names[a + r][0]]
                if out:
                    q, i, s = zip(*out, strict=True)
                    yield pa.record_batch([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "rough"])

    found = dealt.mapInArrow(lean(rerank), "query_id long, vec_id long, rough double").groupBy("query_id", "vec_id").agg(F.max("rough").alias("rough"))
    short = phase(found.withColumn("_n", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("rough", 9))))).filter(F.col("_n") <= k).drop("_n"), "neighbours-short")
    # The final scores come from the original vectors, in an order of operations that rows share.
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    pairs = short.join(asked, "query_id").join(given.distinct(), "vec_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _matrix(batch.column("q")), _matrix(batch.column("v"))
            s = np.array([_cosine(x, y) for x, y in zip(a, b, strict=True)], dtype=np.float64)
            yield pa.record_batch([batch.column("query_id"), batch.column("vec_id"), pa.array(s)], names=["query_id", "vec_id", "score"])

    exact = pairs.select("query_id", "vec_id", "q", "v").mapInArrow(lean(score), "query_id long, vec_id long, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return exact.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision; scaled first, so that it holds for components of any size."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), every=50)
