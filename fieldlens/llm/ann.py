"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``SAMPLE`` vectors, chosen by a hash of vec_id) and has about one leaf for
``leaf_rows`` rows, ``MOST_LEAVES`` at most, as the sample bears no more; every row is indexed in it. A query walks the tree through a priority queue of branches,
nearest centre first, and so gets its leaves in the order to visit. How many leaves to visit is calibrated:
``CALIBRATION`` queries of the sample are also answered exactly over all rows, and the visits are widened until their recall reaches
``RECALL``. Queries then meet the rows of their leaves by an equi-join on the leaf, in rounds that widen by ``WIDENING``: in
each round a query only gets rows within the distance of its k-th nearest so far, so what it gathers does not
grow with the number of leaves. Distances are taken on the original vectors in double precision.

Rows with equal vectors are gathered first: any query's k nearest hold k + 1 of them at most, those with the smallest ids, so
the others need not be compared. Large leaves are dealt out in parts of ``PART_ROWS``.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of different lengths
have no distance, so each length is searched by itself; ties in distance go to the smaller vec_id; a row is never its own neighbour, but rows with equal vectors are at
distance 0; queries with fewer candidates get all; repeated rows count as one; an empty table gives an
empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, read

NEAREST = 10
QUERY_EVERY = 100
SAMPLE, CALIBRATION = 20_000, 128
LEAF_ROWS, MOST_LEAVES, BRANCHES = 256, 2_048, 8
FIRST_VISITS, WIDENING = 4, 4
RECALL = 0.97
PART_ROWS = 4_096


class Tree:
    """A hierarchical k-means tree: inner nodes hold their children's centres."""

    def __init__(self, x: np.ndarray, leaves: int, seed: int = 5):
        self.centres: list[np.ndarray] = []  # of each inner node
        self.children: list[list[int]] = []  # >= 0: inner node; < 0: leaf -1 - c
        self.n_leaves = 0
        self._random = np.random.default_rng(seed)
        least = max(2, len(x) // max(1, leaves))
        self._split(x, least)

    def _split(self, x: np.ndarray, least: int) -> int:
        branches = min(BRANCHES, -(-len(x) // least))
        distinct = np.unique(x, axis=0) if branches >= 2 and len(x) <= 4096 else x
        if branches < 2 or len(distinct) < 2:
            self.n_leaves += 1
            return -self.n_leaves
        centres = distinct[np.sort(self._random.choice(len(distinct), min(branches, len(distinct)), replace=False))]
        for _ in range(10):
            owner = _nearest(x, centres)
            counts = np.bincount(owner, minlength=len(centres))
            sums = (owner[None, :] == np.arange(len(centres))[:, None]).astype(x.dtype) @ x
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        owner = _nearest(x, centres)
        kept = np.unique(owner)
        if len(kept) < 2:
            self.n_leaves += 1
            return -self.n_leaves
        node = len(self.centres)
        self.centres.append(centres[kept])
        self.children.append([])
        self.children[node] = [self._split(x[owner == j], least) for j in kept]
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)

        def down(node: int, rows: np.ndarray) -> None:
            if node < 0:
                out[rows] = -1 - node
                return
            owner = _nearest(x[rows], self.centres[node])
            for j, child in enumerate(self.children[node]):
                if (owner == j).any():
                    down(child, rows[owner == j])

        if len(x):
            down(0 if self.centres else -1, np.arange(len(x)))
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        if not self.centres:
            return [0]
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            bound, node = heapq.heappop(queue)
            while node >= 0:  # descend to a leaf; the branches not taken wait in the queue
                d = ((self.centres[node] - query) ** 2).sum(axis=1)
                order = np.argsort(d, kind="stable")
                for j in order[1:]:
                    heapq.heappush(queue, (float(d[j]), self.children[node][j]))
                node = self.children[node][order[0]]
            out.append(-1 - node)
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _closest(queries: np.ndarray, x: np.ndarray, first: np.ndarray, k: int, radius: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query, the rows that can be among the k nearest and lie within its radius, and their exact distances. first: ids to break ties."""
    squared = (x**2).sum(1)
    for at in range(0, len(queries), 256):
        block = queries[at : at + 256]
        own = (block**2).sum(1)
        rough = squared[None, :] - 2 * block @ x.T
        take = min(k, len(x)) - 1
        limit = np.partition(rough, take, axis=1)[:, take]
        if radius is not None:
            limit = np.minimum(limit, radius[at : at + 256] ** 2 - own)
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(limit), limit, 0)) + own)
        for i in range(len(block)):
            rows = np.flatnonzero(rough[i] <= limit[i] + slack[i])
            exact = np.sqrt(((x[rows] - block[i]) ** 2).sum(1))
            order = np.lexsort((first[rows], exact))[:k]
            yield at + i, rows[order], exact[order]


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    v = F.col("v")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return fine.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda e: e != 0))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, recall: float = RECALL, vector: str = "embedding", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of vectors(vec_id, vector) found for each row of queries."""
    rows, asked = _usable(vectors, vector), _usable(queries, vector)
    lengths = [r["n"] for r in rows.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()]  # one as a rule
    of = lambda df, n: df.where(F.size("v") == n)
    found = [_nearest_of_length(of(rows, n), of(asked, n).distinct(), n, k, recall, leaf_rows) for n in lengths]
    return reduce(DataFrame.union, found) if found else vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _nearest_of_length(rows: DataFrame, asked: DataFrame, dim: int, k: int, recall: float, leaf_rows: int) -> DataFrame:
    spark = rows.sparkSession
    # Equal vectors: the k + 1 smallest ids of each are all that any query can need.
    rank = F.row_number().over(Window.partitionBy("key", "v").orderBy("vec_id"))
    keyed = rows.distinct().withColumn("key", F.xxhash64("v")).withColumn("r", rank).where(F.col("r") <= k + 1)
    points = materialize(keyed.groupBy("key", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("first", F.element_at("ids", 1)))
    n = points.count()
    sample = points.orderBy(F.xxhash64("first"), "first").limit(SAMPLE).select("first", "v").toArrow()
    x = _matrix(sample.column("v"), dim) if sample.num_rows else np.zeros((0, dim))
    firsts = sample.column("first").to_numpy()
    tree = Tree(x, max(1, min(MOST_LEAVES, n // leaf_rows)))
    shared = spark.sparkContext.broadcast(tree)
    visits = _calibrated(points, tree, x[:CALIBRATION], firsts[:CALIBRATION], dim, k, recall)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaf_of(_matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(batch.column(c) for c in ("first", "v", "ids"))], ["leaf", "first", "v", "ids"])

    placed = materialize(points.select("first", "v", "ids").mapInArrow(index, "leaf long, first long, v array<double>, ids array<long>"))
    parts = placed.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("first"), "parts").cast("int"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [shared.value.visits(q, visits) for q in _matrix(batch.column("v"), dim)]
            at = pa.array(np.repeat(np.arange(len(leaves)), [len(x) for x in leaves]))
            flat = pa.array([leaf for x in leaves for leaf in x], pa.int64())
            turn = pa.array([i for x in leaves for i in range(len(x))], pa.int32())
            yield pa.RecordBatch.from_arrays([flat, turn, batch.column("query").take(at)], ["leaf", "turn", "query"])

    # Queries with equal vectors walk once; "query" is the smallest of their ids.
    owners = materialize(asked.groupBy("v").agg(F.min("vec_id").alias("query")))
    walks = materialize(owners.select("query", "v").mapInArrow(walk, "leaf long, turn int, query long"))

    def compare(key, left, right):
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, query = right.column("ids").to_pylist(), left.column("query").to_pylist()
            first = right.column("first").to_numpy()
            radius = left.column("radius").to_numpy()
            for i, near, distance in _closest(_matrix(left.column("v"), dim), _matrix(right.column("v"), dim), first, k + 1, radius):
                for j, d in zip(near, distance):
                    for vec_id in ids[j]:
                        for column, value in zip(out, (query[i], vec_id, float(d))):
                            column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query", "vec_id", "score"])

    best = Window.partitionBy("query").orderBy("score", "vec_id")
    found, turn, to = None, 0, FIRST_VISITS
    while turn < visits:
        step = walks.where((F.col("turn") >= turn) & (F.col("turn") < to)).join(owners, "query")
        if found is None:
            step = step.withColumn("radius", F.lit(float("inf")))
        else:
            reach = found.groupBy("query").agg(F.when(F.count("*") > k, F.max("score")).alias("radius"))
            step = step.join(reach, "query", "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
        step = step.join(F.broadcast(parts), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        left = step.select("leaf", "part", "query", "v", "radius").groupBy("leaf", "part")
        met = left.cogroup(dealt.select("leaf", "part", "first", "v", "ids").groupBy("leaf", "part")).applyInArrow(compare, "query long, vec_id long, score double")
        met = met if found is None else met.union(found)
        found = materialize(met.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"))
        turn, to = to, to * WIDENING
    if found is None:
        found = spark.createDataFrame([], "query long, vec_id long, score double")
    members = asked.join(owners, "v").select("query", F.col("vec_id").alias("query_id"))
    own = found.join(members, "query").where("query_id <> vec_id")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return own.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrated(points: DataFrame, tree: Tree, queries: np.ndarray, own: np.ndarray, dim: int, k: int, recall: float) -> int:
    """How many leaves to visit for the wanted recall, by exact answers to a bounded number of queries over all rows."""
    if not len(queries):
        return 1
    shared = points.sparkSession.sparkContext.broadcast((tree, queries))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, asked = shared.value
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            if not len(x):
                continue
            first = batch.column("first").to_numpy()
            leaf = index.leaf_of(x)
            for i, near, distance in _closest(asked, x, first, k + 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), i)), pa.array(first[near]), pa.array(leaf[near]), pa.array(distance)], ["q", "first", "leaf", "d"])

    near = points.select("first", "v").mapInArrow(exact, "q long, first long, leaf long, d double")
    best = Window.partitionBy("q").orderBy("d", "first")
    true = near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).collect()
    place = [{leaf: i for i, leaf in enumerate(tree.visits(q, tree.n_leaves))} for q in queries]
    needed = np.sort([place[r["q"]][r["leaf"]] + 1 for r in true if r["first"] != own[r["q"]]])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


QUERIES = {"op2_nearest": op2_nearest}
ORACLE: dict[str, str] = {}
