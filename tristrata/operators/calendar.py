"""Calendar generator."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions import date_key

# Default range of the calendar dimension.
FIRST_DAY = date(2018, 1, 1)
LAST_DAY = date(2032, 12, 31)


def _with_parts(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def _days_between(bounds: DataFrame) -> DataFrame:
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence("first_day", "last_day", step)).alias("date"))


def calendar(spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    Weeks are ISO weeks; days of the week run from 1 (Sunday) to 7 (Saturday).
    """
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return _with_parts(_days_between(bounds))


def calendar_covering(
    df: DataFrame, day: str, start: date = FIRST_DAY, end: date = LAST_DAY
) -> DataFrame:
    """Calendar of the default range, widened to every date found in ``df``.

    The bounds are one aggregate over a single column, computed in the same
    query: nothing is collected on the driver.
    """
    d = F.col(day)
    bounds = df.agg(
        F.least(F.lit(start), F.min(d)).alias("first_day"),
        F.greatest(F.lit(end), F.max(d)).alias("last_day"),
    )
    return _with_parts(_days_between(bounds))


# Keys of the rows that stand for a missing day and for one outside the plausible range.
UNKNOWN_DAY = -1
ODD_DAY = -2
FIRST_PLAUSIBLE = date(1900, 1, 1)
LAST_PLAUSIBLE = date(2100, 12, 31)


def day_key(day: Column | str, first: date = FIRST_PLAUSIBLE, last: date = LAST_PLAUSIBLE) -> Column:
    """Key of the calendar row that a date belongs to; every date has one, also a missing or an odd one."""
    d = F.col(day) if isinstance(day, str) else day
    return F.when(d.isNull(), UNKNOWN_DAY).when(~d.between(F.lit(first), F.lit(last)), ODD_DAY).otherwise(date_key(d))


def calendar_of_facts(
    spark: SparkSession,
    facts: Mapping[str, tuple[DataFrame, str]],
    start: date = FIRST_DAY,
    end: date = LAST_DAY,
    first: date = FIRST_PLAUSIBLE,
    last: date = LAST_PLAUSIBLE,
) -> DataFrame:
    """Calendar that reaches every plausible date of some facts, with a row for unknown and one for odd dates.

    ``facts`` gives a table and its date column by name. The range from
    ``start`` to ``end`` is widened to the dates between ``first`` and ``last``
    that occur: two dates come back to the driver, so the calendar is a range
    over partitions, and a date far off adds no days. ``day_key`` maps any date
    to its row. Columns of the two special rows are null but for ``date_key``.
    """
    within = F.col("d").between(F.lit(first), F.lit(last))
    days = reduce(DataFrame.unionAll, [df.select(F.col(day).alias("d")) for df, day in facts.values()])
    low, high = days.where(within).agg(F.min("d"), F.max("d")).first()
    low, high = min(low or start, start), max(high or end, end)
    length = (high - low).days + 1
    whole = _with_parts(spark.range(length).select(F.date_add(F.lit(low), F.col("id").cast("int")).alias("date")))
    special = spark.range(2).select(
        F.when(F.col("id") == 0, UNKNOWN_DAY).otherwise(ODD_DAY).alias("date_key"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in whole.schema if f.name != "date_key"],
    )
    return whole.unionByName(special)


def day_counts(facts: Mapping[str, tuple[DataFrame, str]], first: date = FIRST_PLAUSIBLE, last: date = LAST_PLAUSIBLE) -> DataFrame:
    """How many rows of each fact have a known, a missing and an odd date: (fact, known, unknown, odd)."""
    parts = []
    for name, (df, day) in facts.items():
        key = day_key(day, first, last)
        parts.append(
            df.agg(F.count_if(key >= 0).alias("known"), F.count_if(key == UNKNOWN_DAY).alias("unknown"), F.count_if(key == ODD_DAY).alias("odd"))
            .select(F.lit(name).alias("fact"), "known", "unknown", "odd")
        )
    return reduce(DataFrame.unionAll, parts)
