"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.sources.workspace import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node that can be reached.

    Each round hangs every node on the smallest node it sees, first on the side
    of its larger neighbours, then on that of its smaller ones, and halves the
    length of paths. Minima are combined before they are shuffled; no component
    and no edge list is collected. Edges with a null end or from a node to
    itself say nothing and are left out. Edges are narrow: between rounds they
    lie in twice as many parts as tasks run at a time, however many partitions
    shuffles have, since a round on few edges costs tasks and files alone.
    """
    now = _cut(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        now = _cut(_small_star(_large_star(now)))
        seen, mark = mark, _mark(now)
        if seen == mark:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _cut(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.coalesce(2 * edges.sparkSession.sparkContext.defaultParallelism))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """The larger end of each edge hangs on the smallest node that the smaller end sees, itself included; repeats stay."""
    least = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array("u", "v")).alias("u")
    return edges.join(least, "u").select(ends, F.col("m").alias("v")).where("u != v").distinct()
