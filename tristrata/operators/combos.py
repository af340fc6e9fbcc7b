"""Distinct combinations and one value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.functions import blank_to_null, normalize
from tristrata.operators.latest import first_per_key


def conformed_combinations(
    df: DataFrame, columns: Sequence[str], merge_blank: bool = True
) -> DataFrame:
    """Distinct normalised combinations of text columns.

    With ``merge_blank`` the empty text counts as missing: both have the same
    composite key, so keeping them apart would give two rows per key. Rows are
    reduced map-side, what is shuffled is at most one row per combination and
    map task.
    """
    tidy = [normalize(c) for c in columns]
    if merge_blank:
        tidy = [blank_to_null(c) for c in tidy]
    return df.select(*[t.alias(c) for t, c in zip(tidy, columns, strict=True)]).distinct()


def smallest_value_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key with its smallest non-NULL value, NULL if it has none.

    The smallest rather than the first value seen, which would change with the
    row order. A text minimum as an aggregate would sort every input row; here
    a hash aggregate leaves the distinct pairs and only those are ranked.
    """
    pairs = df.select(*keys, value).distinct()
    return first_per_key(pairs, keys, [F.col(value).asc_nulls_last()])
