"""Joins between facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows of a fact with the attributes of their dimension row.

    No broadcast is forced. Spark broadcasts the dimension when its files or,
    at run time, its shuffled size are below the session threshold; otherwise
    it sort-merges and adaptive execution splits partitions of hot keys.
    """
    return fact.join(dim, key, how)


def measure_by_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    measures: Mapping[str, Column],
    attributes: list[str],
    how: str = "inner",
) -> DataFrame:
    """Measures of a fact per dimension row.

    The fact is aggregated to one row per key before the join, so fact rows are
    reduced map-side and never meet the join: the shuffle carries at most one
    row per key and map task however hot a key is. Every measure must be an
    aggregate of the fact alone.
    """
    totals = fact.groupBy(key).agg(*[m.alias(name) for name, m in measures.items()])
    return totals.join(dim, key, how).select(*[F.col(a) for a in attributes], *measures)
