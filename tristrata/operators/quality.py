"""Data-quality checks.

Every check returns the offending values with counts, or the counts alone;
none collects rows on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A rule for one column of a table.

    ``kind`` is not_null, unique, accepted_values or relationships; ``values``
    are the accepted ones, ``parent`` is the (table, column) referred to.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None


class ChecksFailed(Exception):
    """At least one check of a run found failures."""


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: (column, failures)."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return totals.unpivot([], list(columns), "column", "failures")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: (keys, n_records). NULLs are ignored.

    Counts are built map-side, so a key that repeats very often is shuffled as
    one row per map task.
    """
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def key_collisions(df: DataFrame, hashed: str, natural: Sequence[str], seed: int = 7) -> DataFrame:
    """Hash keys that stand for different natural keys: (key, natural_keys, n_records).

    A second, independent hash of the natural key is compared inside each key:
    where its least and its greatest value differ, two natural keys share the
    first hash. Both are numbers that are combined before the shuffle, so a key
    of any number of rows costs a few numbers a task. ``natural_keys`` is the
    exact number, counted for those keys alone. Two NULLs are the same value.
    """
    parts = F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(natural)])
    # As text, with NULL told from any value and parts told apart by their lengths.
    told = F.concat_ws("|", *[F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in natural])
    second = F.xxhash64(F.lit(seed), F.reverse(told), told)
    spread = df.groupBy(F.col(hashed).alias("key")).agg(F.min(second).alias("low"), F.max(second).alias("high"), F.count(F.lit(1)).alias("n_records"))
    shared = spread.where(F.col("low") != F.col("high")).select("key", "n_records")
    rows = df.select(F.col(hashed).alias("key"), parts.alias("parts")).join(shared.select("key"), "key", "left_semi")
    return shared.join(rows.groupBy("key").agg(F.count_distinct("parts").alias("natural_keys")), "key").select("key", "natural_keys", "n_records")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside a list: (value, n_records). NULLs are ignored."""
    outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Foreign keys without a parent row: (value, n_records). NULLs are ignored.

    The child is counted per key first, so the anti join sees each key once
    and a key that most rows share costs no more than any other.
    """
    value = F.col(column).alias("value")
    keys = child.where(F.col(column).isNotNull()).groupBy(value)
    counts = keys.agg(F.count(F.lit(1)).alias("n_records"))
    return counts.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def freshness(
    df: DataFrame,
    loaded_at: str | Column,
    as_of: datetime | Column,
    warn_after: timedelta | None = None,
    error_after: timedelta | None = None,
) -> DataFrame:
    """Age of the newest row: (max_loaded_at, age_seconds, status).

    The status is pass, warn or error; a table without rows is an error.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    loaded_at = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(
        F.col("max_loaded_at").cast("timestamp")
    )
    status = F.when(F.col("max_loaded_at").isNull(), "error")
    if error_after is not None:
        status = status.when(age > int(error_after.total_seconds()), "error")
    if warn_after is not None:
        status = status.when(age > int(warn_after.total_seconds()), "warn")
    return newest.select(
        "max_loaded_at", age.alias("age_seconds"), status.otherwise("pass").alias("status")
    )


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def _nulls_and_repeats(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """not_null and unique checks of a table, sharing scans.

    The first unique column is counted in the same grouping that carries the
    NULL counts of all columns, so a table with one unique column is read once.
    """
    nulls = [c for c in checks if c.kind == "not_null"]
    uniques = [c for c in checks if c.kind == "unique"]
    parts = []
    for i, check in enumerate(uniques or [None]):
        carried = nulls if i == 0 else []
        sums = [F.count_if(F.col(c.column).isNull()).alias(f"n{j}") for j, c in enumerate(carried)]
        rows = [_row(c, F.col(f"n{j}")) for j, c in enumerate(carried)]
        if check is None:
            totals = df.agg(*sums)
        else:
            per_key = df.groupBy(F.col(check.column).alias("key")).agg(
                F.count(F.lit(1)).alias("n"), *sums
            )
            repeated = F.col("key").isNotNull() & (F.col("n") > 1)
            totals = per_key.agg(
                F.count_if(repeated).alias("repeats"),
                *[F.sum(f"n{j}").alias(f"n{j}") for j in range(len(carried))],
            )
            rows.append(_row(check, F.col("repeats")))
        parts.append(totals.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionAll, parts)


def _failures(
    df: DataFrame, checks: Sequence[Check], tables: Mapping[str, DataFrame]
) -> list[DataFrame]:
    out = []
    grouped = [c for c in checks if c.kind in ("not_null", "unique")]
    if grouped:
        out.append(_nulls_and_repeats(df, grouped))
    for check in checks:
        if check.kind == "accepted_values":
            bad = accepted_values(df, check.column, check.values)
        elif check.kind == "relationships":
            parent, parent_column = check.parent
            bad = relationships(df, check.column, tables[parent], parent_column)
        elif check in grouped:
            continue
        else:
            raise ValueError(f"unknown check {check.kind}")
        total = bad.agg(F.sum("n_records").alias("n") if check.parent else F.count(F.lit(1)).alias("n"))
        out.append(total.select(F.inline(F.array(_row(check, F.col("n"))))))
    return out


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report on all checks: (table, column, check, failures, passed).

    Failures are NULL rows, repeated keys, unaccepted values or rows without a
    parent. The checks of a table share its scan where they can.
    """
    parts: list[DataFrame] = []
    for name in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == name]
        parts += _failures(tables[name], own, tables)
    report = reduce(DataFrame.unionAll, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def require_passed(report: DataFrame) -> None:
    """Raise when a report holds failures, naming the failed checks.

    A report has one row per declared check, so reading it here is bounded by
    the declaration, not by the data.
    """
    failed = report.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table}.{r.column} {r.check}: {r.failures}" for r in failed]
        raise ChecksFailed("; ".join(sorted(lines)))
