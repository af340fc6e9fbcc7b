"""Near copies among vectors by product quantisation.

Coarse centres split the vectors into inverted lists. A vector is probed in
every list that can hold a partner: one whose border is no farther than the
largest distance of a partner. Inside a list, residuals are coded by subspace;
table look-ups give the distance to a code, and the coding error, kept with it,
turns that into a bound. What the bound leaves is ranked by exact cosine. Both
bounds are exact, so the result does not depend on how well the centres fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import ship, written
from .vectors import k_means, matrix, typed, unit, usable

#: Vectors that the centres are fitted to, at most; all vectors are coded.
SAMPLE_ROWS = 8192
SUBSPACES = 8
CODES = 64
#: Rows of a list that are compared in one group.
BLOCK = 1024
#: The most lists: bounds what every task is given.
MOST_LISTS = 1024


@dataclass
class Codebook:
    centres: np.ndarray  # lists x dims
    codes: list[np.ndarray]  # for each subspace: codes x its dims
    cuts: np.ndarray  # where subspaces begin

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the distance between each and what its codes stand for."""
        code = np.zeros((len(residual), len(self.codes)), np.uint8)
        error = np.zeros(len(residual))
        for m, book in enumerate(self.codes):
            part = residual[:, self.cuts[m] : self.cuts[m + 1]]
            far = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)
            code[:, m] = far.argmin(1)
            error += ((part - book[code[:, m]]) ** 2).sum(1)
        return code, np.sqrt(error)

    def distances(self, query: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Distance of each query residual to each coded residual, summed from look-up tables."""
        total = np.zeros((len(query), len(code)))
        for m, book in enumerate(self.codes):
            part = query[:, self.cuts[m] : self.cuts[m + 1]]
            table = np.maximum((part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1), 0)
            total += table[:, code[:, m]]
        return np.sqrt(total)


def train(sample: np.ndarray, n_lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 11) -> Codebook:
    rng = np.random.default_rng(seed)
    centres = k_means(sample, n_lists, 8, rng)
    nearest = ((centres * centres).sum(1) - 2 * sample @ centres.T).argmin(1)
    residual = sample - centres[nearest]
    cuts = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
    return Codebook(centres, [k_means(residual[:, a:b], codes, 8, rng) for a, b in zip(cuts[:-1], cuts[1:])], cuts)


def probes(x: np.ndarray, centres: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each vector its list, and every later list whose border with it is within ``radius``.

    A partner in another list lies across the border, so its list is among
    these or this one is among the partner's: of two lists, the earlier probes.
    """
    gap = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(2), 1e-300)) if len(centres) <= 256 else None
    for at in range(0, len(x), 2048):
        part = x[at : at + 2048]
        far = np.maximum((part * part).sum(1)[:, None] - 2 * part @ centres.T + (centres * centres).sum(1), 0)
        home = far.argmin(1)
        between = gap[home] if gap is not None else np.sqrt(np.maximum(((centres[home] ** 2).sum(1))[:, None] - 2 * centres[home] @ centres.T + (centres**2).sum(1), 1e-300))
        border = (far - far[np.arange(len(part)), home][:, None]) / (2 * between)
        near = (border <= radius + 1e-6) & (np.arange(len(centres)) > home[:, None])
        yield home, near


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the links connect, no more than needed."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        p, q = root(i), root(j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((i, j))
    return out


def near_copies(vectors: DataFrame, least: float = 0.93, sample_rows: int = SAMPLE_ROWS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Two vectors of the same label are linked if their cosine, in double
    precision, is at least ``least`` (over 0). A null vec_id or label, or a vector that is
    null, empty, zero or holds null or non-finite components, links with
    nothing; nor do vectors of different length. Equal vectors are linked with
    each other. vec_id must be unique; of repeated rows each counts as a
    vector, and they share their component. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select("vec_id", typed(vectors, "embedding").alias("x"), "label").withColumn("ok", usable("x") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    # Equal vectors are one row from here on.
    good = rows.where("ok").withColumn("dims", F.size("x"))
    same = written(good.groupBy("label", "dims", "x").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "distinct-vectors")
    radius = math.sqrt(2 - 2 * least)
    found = None
    for dims, count in sorted((r[0], r[1]) for r in same.groupBy("dims").count().collect()):
        some = _links(same.where(F.col("dims") == dims), count, least, radius, sample_rows, block)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return alone.select("vec_id", "n_links", "component_id", F.lit(True).alias("kept"))
    found = written(found, "vector-links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    root = components(found.where("b IS NOT NULL").select("a", "b"))
    groups = same.select("id", "label", "dims", "x", "copies").join(links, "id", "left").join(root.withColumnRenamed("node", "id"), "id", "left")
    groups = groups.select("label", "dims", "x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    linked = good.join(groups, ["label", "dims", "x"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(same: DataFrame, count: int, least: float, radius: float, sample_rows: int, block: int) -> DataFrame:
    """Rows (a, null, links): ``links`` other vectors are linked to a; rows (a, b, null): a link that holds a component together."""
    sample = unit(matrix(same.select("x", "id").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow().column("x")))
    book = train(sample, min(MOST_LISTS, max(1, math.ceil(math.sqrt(count) / 4))))
    shared = same.sparkSession.sparkContext.broadcast(book)
    names = ["label", "list", "probe", "id", "copies", "x"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            at = 0
            for home, near in probes(unit(x) if len(x) else x, shared.value.centres, radius):
                row, other = np.nonzero(near)
                take = pa.array(np.concatenate([np.arange(len(home)), row]) + at)
                which = np.concatenate([home, other])
                probe = np.arange(len(which)) >= len(home)
                yield pa.RecordBatch.from_arrays([batch.column("label").take(take), pa.array(which, pa.int32()), pa.array(probe), batch.column("id").take(take), batch.column("copies").take(take), batch.column("x").take(take)], names)
                at += len(home)

    kinds = dict(same.dtypes)
    entries = same.select("label", "id", "copies", "x").mapInArrow(assign, f"label {kinds['label']}, list int, probe boolean, id {kinds['id']}, copies bigint, x array<double>")
    entries = written(entries, "inverted-lists")
    sizes = entries.groupBy("label", "list").agg(F.sum(F.when(F.col("probe"), 0).otherwise(1)).alias("own"), F.sum(F.when(F.col("probe"), 1).otherwise(0)).alias("foreign"))
    sizes = sizes.where("own > 0").select("label", "list", F.ceil(F.col("own") / block).cast("int").alias("m"), F.ceil(F.col("foreign") / block).cast("int").alias("f"))
    sizes = written(sizes, "list-sizes")
    # A list of any length is dealt into blocks, and each pair of blocks is a group of its own:
    # own block j meets own blocks i <= j and all blocks of probing vectors.
    spread = entries.join(sizes, ["label", "list"])
    part = F.pmod(F.xxhash64("id"), F.when(F.col("probe"), F.col("f")).otherwise(F.col("m"))).cast("int")
    spread = spread.withColumn("part", part)
    meet = F.when(
        F.col("probe"),
        F.expr("transform(sequence(0, m - 1), j -> struct(j AS base, -1 - part AS other, false AS is_base))"),
    ).otherwise(
        F.concat(
            F.expr("transform(sequence(0, part), i -> struct(part AS base, i AS other, true AS is_base))"),
            F.expr("CASE WHEN part < m - 1 THEN transform(sequence(part + 1, m - 1), j -> struct(j AS base, part AS other, false AS is_base)) ELSE array() END"),
            F.expr("CASE WHEN f > 0 THEN transform(sequence(0, f - 1), k -> struct(part AS base, -1 - k AS other, true AS is_base)) ELSE array() END"),
        )
    )
    spread = spread.withColumn("meet", F.explode(meet)).select("label", "list", "meet.base", "meet.other", "meet.is_base", "id", "copies", "x")

    def compare(table: pa.Table) -> pa.Table:
        base = table.column("is_base").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        copies = table.column("copies").to_numpy()
        x = matrix(table.column("x"))
        own = table.column("other")[0].as_py() == table.column("base")[0].as_py()
        left = np.flatnonzero(base)
        right = left if own else np.flatnonzero(~base)
        out = [], [], []
        if len(left) and len(right):
            n = unit(x)
            book = shared.value
            centre = book.centres[table.column("list")[0].as_py()]
            code, error = book.encode(n[left] - centre)
            links = np.zeros(len(x), np.int64)
            pairs = []
            for at in range(0, len(right), 512):
                q = right[at : at + 512]
                far = book.distances(n[q] - centre, code) - error[None]
                i, j = np.nonzero(far <= radius + 1e-6)
                a, b = q[i], left[j]
                keep = a < b if own else slice(None)
                a, b = a[keep], b[keep]
                for k in range(0, len(a), 1 << 17):
                    p, r = a[k : k + (1 << 17)], b[k : k + (1 << 17)]
                    exact = np.einsum("ij,ij->i", n[p], n[r]) >= least
                    p, r = p[exact], r[exact]
                    links += np.bincount(p, copies[r], len(x)).astype(np.int64) + np.bincount(r, copies[p], len(x)).astype(np.int64)
                    pairs += _forest(p, r, len(x))
            pairs = np.array(pairs, np.int64).reshape(-1, 2)
            pairs = np.array(_forest(pairs[:, 0], pairs[:, 1], len(x)), np.int64).reshape(-1, 2)
            some = np.flatnonzero(links)
            out = (np.concatenate([ids[some], ids[pairs[:, 0]]]), [None] * len(some) + ids[pairs[:, 1]].tolist(), links[some].tolist() + [None] * len(pairs))
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64()), "links": pa.array(out[2], pa.int64())})

    keys = ["label", "list", "base", "other"]
    tasks = int(same.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(tasks, *keys).groupBy(*keys).applyInArrow(compare, "a bigint, b bigint, links bigint")
