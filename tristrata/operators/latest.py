"""One row per key from an append-only log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__latest_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the row of every key that comes first in the given order.

    The rank is compared with 1 directly above the window, which lets Catalyst
    cut each map partition down to one row per key before the shuffle. A key
    that holds a third of the rows then sends one row per map task, and no
    reducer ever sees the whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("ingested_at",),
    tie_break: Sequence[str] | None = None,
    keep_unkeyed: bool = False,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` values for every key.

    Rows that tie are separated by ``tie_break``, by default every other column
    from left to right, so the result depends on the data only and not on how
    the rows were partitioned. NULLs rank last and a NULL key is a key, unless
    ``keep_unkeyed``: then rows without a complete key cannot be told to repeat
    each other and all of them are kept, in a second scan whose filter on
    missing keys is pushed down to the file statistics.

    Select the columns you need first: they are what gets sorted and shuffled.
    """
    if keep_unkeyed:
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        kept = latest_per_key(df.where(keyed), keys, order_by, tie_break)
        return kept.unionByName(df.where(~keyed))
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in order_by]
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [*order_by, *tie_break]])


def latest_keys(df: DataFrame, keys: Sequence[str], keep_unkeyed: bool = False) -> DataFrame:
    """The key columns of ``latest_per_key``.

    Which row of a key is kept does not show in them, so nothing is ranked: a
    hash aggregate takes the place of two sorts by all values.
    """
    if keep_unkeyed:
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return latest_keys(df.where(keyed), keys).unionByName(df.where(~keyed).select(*keys))
    return df.select(*keys).distinct()
