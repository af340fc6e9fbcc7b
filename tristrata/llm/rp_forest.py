"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are grown on a bounded sample and every vector is put into one leaf of
each. A query walks all trees through one priority queue: whichever unvisited
branch, of any tree, lies closest across its planes comes next, until the
leaves taken hold enough entries. Their rows are ranked by exact cosine.

Vectors stay where they are: a bounded block of queries is sent to all tasks
with the leaves each has taken, and a task goes once through its vectors and
keeps the best of each query, so that what comes out is in proportion to the
queries. Of equal vectors only as many take part as one answer can name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.sources.workspace import fresh_folder

from .tables import ship, written
from .vectors import lists, matrix, typed, unit, usable

#: Vectors that the trees are grown on, at most; all vectors are indexed.
SAMPLE_ROWS = 8192
TREES = 8
#: Leaves are made for so many rows; depth grows with the table, up to DEPTH.
LEAF_ROWS = 64
DEPTH = 10
#: Share of all entries (distinct vectors times trees) that a query takes. Leaves of
#: different trees share vectors: where nothing is clustered this is two thirds of all vectors.
SHARE = 0.15
#: Queries of a block, at most twice: 16 MB of vectors of 64 components and their leaves.
QUERIES = 8192
#: Vectors that meet the queries of a block at once, and queries compared at once.
ROWS = 4096
AT_ONCE = 512


@dataclass
class Forest:
    """Planes of complete binary trees: node ``i`` of tree ``t`` splits by ``planes[t, i]`` at ``cuts[t, i]``."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.planes)), np.int32)
        for t in range(len(self.planes)):
            side = x @ self.planes[t].T > self.cuts[t]
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + side[np.arange(len(x)), at]
            out[:, t] = at - (2**self.depth - 1)
        return out

    def search(self, x: np.ndarray, sizes: np.ndarray, entries: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order the shared queue gives them, until they hold ``entries`` rows."""
        inner = 2**self.depth - 1
        margin = [(self.planes[t] @ x - self.cuts[t]).tolist() for t in range(len(self.planes))]
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        out, held = [], 0
        while queue and held < entries:
            far, t, at = heapq.heappop(queue)
            while at < inner:
                m = margin[t][at]
                near = 2 * at + 1 + (m > 0)
                other = 4 * at + 3 - near
                heapq.heappush(queue, (far + m * m, t, other))
                at = near
            leaf = at - inner
            if sizes[t, leaf]:
                out.append((t, leaf))
                held += sizes[t, leaf]
        return out


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 17) -> Forest:
    """Each node splits the sample rows it gets at the median of a random direction.

    The direction joins the centres of two groups of a few random rows, so that
    it follows clusters where there are any.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    planes = np.zeros((trees, 2**depth - 1, dims))
    cuts = np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        rows = {0: np.arange(len(sample))}
        for at in range(2**depth - 1):
            here = rows.pop(at)
            plane = _direction(sample[rng.choice(here, min(len(here), 64), replace=False)], rng) if len(here) > 3 else np.zeros(dims)
            length = np.linalg.norm(plane)
            planes[t, at] = plane / length if length > 1e-9 else rng.normal(size=dims) / math.sqrt(dims)
            value = sample[here] @ planes[t, at]
            cuts[t, at] = np.median(value) if len(here) else 0.0
            rows[2 * at + 1], rows[2 * at + 2] = here[value <= cuts[t, at]], here[value > cuts[t, at]]
    return Forest(planes, cuts, depth)


def _direction(some: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    centres = some[rng.choice(len(some), 2, replace=False)]
    for _ in range(4):
        side = (some @ centres.T).argmax(1)
        if side.min() == side.max():
            break
        centres = np.stack([some[side == k].mean(0) for k in (0, 1)])
        length = np.linalg.norm(centres, axis=1, keepdims=True)
        if (length < 1e-9).any():
            break
        centres = centres / length
    return centres[0] - centres[1]


@dataclass
class Block:
    """Queries that are sent to all tasks: ids, unit vectors and the leaves taken, a bit each."""

    ids: np.ndarray
    x: np.ndarray
    taken: np.ndarray

    def leaves(self, trees: int, count: int) -> np.ndarray:
        return np.unpackbits(self.taken, axis=1, count=trees * count).reshape(len(self.ids), trees, count).view(bool)


class _Best:
    """The best ``k`` of each query so far."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(block.ids)
        self.least = np.full(len(block.ids), -np.inf)

    def meet(self, taken: np.ndarray, ids: np.ndarray, x: np.ndarray, leaf: np.ndarray) -> None:
        """Compare vectors with the queries that have taken one of their leaves."""
        for at in range(0, len(self.block.ids), AT_ONCE):
            q = slice(at, at + AT_ONCE)
            met = np.zeros((len(self.block.ids[q]), len(ids)), bool)
            for t in range(leaf.shape[1]):
                met |= taken[q, t][:, leaf[:, t]]
            score = self.block.x[q] @ x.T
            score[~met | (self.block.ids[q, None] == ids[None])] = -np.inf
            # The product's last digits depend on where a row stands, so what is near the cut is measured anew.
            better = (score >= self.least[q, None] - 1e-12) & (score > -np.inf)
            for i in np.flatnonzero(better.any(1)).tolist():
                self._add(at + i, np.flatnonzero(better[i]), score[i], ids, x)

    def _add(self, i: int, some: np.ndarray, score: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        if len(some) > self.k:
            edge = np.partition(score[some], len(some) - self.k)[len(some) - self.k]
            some = some[score[some] >= edge - 1e-12]
        found = np.concatenate([self.rows[i][0], ids[some]])
        exact = np.concatenate([self.rows[i][1], (x[some] * self.block.x[i]).sum(1)])
        best = np.lexsort((found, -exact))[: self.k]
        self.rows[i] = found[best], exact[best]
        if len(best) == self.k:
            self.least[i] = exact[best[-1]]

    def batch(self) -> pa.RecordBatch:
        count = [len(r[0]) for r in self.rows]
        columns = [np.repeat(self.block.ids, count), *(np.concatenate(c) if count else np.zeros(0) for c in zip(*self.rows))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, share: float = SHARE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query, itself left out.

    ``vectors`` has vec_id and embedding; ``is_query`` picks the queries among
    its rows. Score is the cosine in double precision; equal scores go to the
    smaller vec_id. With ``share`` 1 every row is compared, and the result is
    exact. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, and vectors of different length don't meet. Of
    rows that repeat a vec_id the one with the greatest vector takes part. Fewer than ``k`` candidates give all of them;
    a query without any has no row.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select("vec_id", typed(vectors, "embedding").alias("x"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("vec_id").isNotNull() & usable("x"))
    rows = written(rows.withColumn("dims", F.size("x")), "vectors")
    out = None
    for dims, count in sorted((r[0], r[1]) for r in rows.groupBy("dims").count().collect()):
        some = _nearest(rows.where(F.col("dims") == dims), count, k, trees, share, sample_rows)
        out = some if out is None else out.unionByName(some)
    return out if out is not None else spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")


def _nearest(rows: DataFrame, count: int, k: int, trees: int, share: float, sample_rows: int) -> DataFrame:
    spark = rows.sparkSession
    queries = rows.where("q").count()
    if not queries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = unit(matrix(rows.select("x", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow().column("x")))
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(count / LEAF_ROWS, 1)))), max(0, int(math.log2(len(sample))) - 3))
    forest = spark.sparkContext.broadcast(grow(sample, trees, depth))
    leaves = 2**depth

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = forest.value.leaves(unit(matrix(batch.column("x"))))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), lists(leaf, pa.int32())], ["vec_id", "x", "leaf"])

    # An answer can name k of equal vectors, and the query may be one more: those with the smallest ids. The rank
    # is cut inside each task before the shuffle, so that a group of copies of any size sends a few rows a task.
    same = Window.partitionBy("x").orderBy("vec_id")
    stored = rows.groupBy("vec_id").agg(F.max("x").alias("x")).withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k + 1).drop("_copy")
    stored = written(stored.mapInArrow(index, "vec_id bigint, x array<double>, leaf array<int>"), "forest")
    # Trees times leaves rows at most, both bounded.
    sizes = np.zeros((trees, leaves), np.int64)
    for r in stored.select(F.posexplode("leaf").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect():
        sizes[r[0], r[1]] = r[2]
    entries = share * int(sizes.sum()) if share < 1 else math.inf
    shared = spark.sparkContext.broadcast(sizes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column("x")))
            taken = np.zeros((len(x), trees * leaves), bool)
            for i in range(len(x)):
                at = np.array(forest.value.search(x[i], shared.value, entries), np.int64).reshape(-1, 2)
                taken[i, at[:, 0] * leaves + at[:, 1]] = True
            packed = [row.tobytes() for row in np.packbits(taken, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(packed, pa.binary())], ["vec_id", "x", "taken"])

    asked = rows.where("q").groupBy("vec_id").agg(F.max("x").alias("x")).mapInArrow(walk, "vec_id bigint, x array<double>, taken binary")
    blocks = -(-queries // QUERIES)
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "queries")
    # As many tasks as run at a time: each keeps the best of every query of a block.
    stored = stored.coalesce(spark.sparkContext.defaultParallelism)
    folder = fresh_folder(spark, "near")
    for b in range(blocks):
        found = stored.mapInArrow(_ranker(spark, asked.where(F.col("block") == b), trees, leaves, k), "query_id bigint, vec_id bigint, score double")
        found.write.mode("append").parquet(folder)
    near = spark.read.schema("query_id bigint, vec_id bigint, score double").parquet(folder)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score")


def _ranker(spark, asked: DataFrame, trees: int, leaves: int, k: int):
    """A pass over vectors that ranks them for one block of queries, a bounded number of rows."""
    table = asked.orderBy("vec_id").select("vec_id", "x", "taken").toArrow()
    taken = np.frombuffer(b"".join(table.column("taken").to_pylist()), np.uint8).reshape(table.num_rows, -(-trees * leaves // 8))
    block = Block(table.column("vec_id").to_numpy(), unit(matrix(table.column("x"))) if table.num_rows else np.zeros((0, 0)), taken)
    sent = spark.sparkContext.broadcast(block)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(sent.value.ids):
            return
        best, taken = _Best(sent.value, k), sent.value.leaves(trees, leaves)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                leaf = some.column("leaf").flatten().to_numpy().reshape(-1, trees)
                best.meet(taken, some.column("vec_id").to_numpy(), unit(matrix(some.column("x"))), leaf)
        yield best.batch()

    return rank
