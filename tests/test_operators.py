from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tristrata.operators import (
    calendar,
    calendar_covering,
    conformed_combinations,
    first_per_key,
    latest_per_key,
    measure_by_dimension,
    pack_and_expand,
    smallest_value_per_key,
)
from tristrata.operators.calendar import LAST_DAY, calendar_of_facts, day_counts, day_key
from tristrata.session import settings_for


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_ignores_row_order(spark):
    data = [(k, t, v) for k in range(5) for t in (1, 2) for v in ("a", "b", None)] * 3
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, ingested_at int, v string").repartition(seed + 1)
        results.add(tuple(rows(latest_per_key(df, ["k"]), "k", "ingested_at", "v")))
    assert results == {tuple((k, 2, "b") for k in range(5))}


def test_latest_treats_null_as_a_key_or_keeps_unkeyed_rows(spark):
    data = [(None, 1, "a"), (None, 2, "b"), (None, 2, "b"), (1, 1, "c"), (1, 2, "d")]
    df = spark.createDataFrame(data, "k int, ingested_at int, v string")
    assert {r.v for r in latest_per_key(df, ["k"]).collect()} == {"b", "d"}
    kept = latest_per_key(df, ["k"], keep_unkeyed=True)
    assert sorted(r.v for r in kept.collect()) == ["a", "b", "b", "d"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    n = 200_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ingested_at"),
        F.col("id").cast("string").alias("v"),
    )
    latest = latest_per_key(df, ["k"])
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    hot = latest.where("k = 0").collect()
    assert [r.ingested_at for r in hot] == [n - 2]
    assert latest.count() == 1 + n - len(range(0, n, 3))


def test_first_per_key_orders_as_asked(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "k int, v string")
    assert rows(first_per_key(df, ["k"], [F.col("v").asc_nulls_last()]), "k", "v")[0] == (1, "a")


def test_smallest_value_per_key(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, None), (2, None), (None, "z"), (None, "y")], "k int, v string"
    )
    smallest = smallest_value_per_key(df, ["k"], "v")
    assert {(r.k, r.v) for r in smallest.collect()} == {(1, "a"), (2, None), (None, "y")}
    assert "HashAggregate" in plan(smallest)
    assert "SortAggregate" not in plan(smallest)


def test_combinations_merge_blank_with_missing(spark):
    df = spark.createDataFrame(
        [(" A ", None), ("a", ""), ("A", "x"), (None, "X "), ("", "x")], "p string, q string"
    )
    merged = conformed_combinations(df, ["p", "q"])
    assert {tuple(r) for r in merged.collect()} == {("a", None), ("a", "x"), (None, "x")}
    apart = conformed_combinations(df, ["p", "q"], merge_blank=False)
    assert apart.count() == 5


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 5479
    found = {r.date: r for r in days.where(F.col("date_key").isin(20210103, 20241230)).collect()}
    sunday, monday = found[date(2021, 1, 3)], found[date(2024, 12, 30)]
    assert (sunday.week_of_year, sunday.day_of_week, sunday.is_weekend) == (53, 1, True)
    assert (monday.week_of_year, monday.day_of_week, monday.is_weekend) == (1, 2, False)
    assert (monday.year, monday.quarter, monday.month, monday.day_of_month) == (2024, 4, 12, 30)


def test_calendar_reaches_every_date(spark):
    df = spark.createDataFrame([(date(2017, 12, 30),), (None,), (date(2033, 1, 2),)], "d date")
    days = calendar_covering(df, "d")
    first, last = days.agg(F.min("date"), F.max("date")).first()
    assert (first, last) == (date(2017, 12, 30), date(2033, 1, 2))
    assert days.count() == 5479 + 2 + 2
    assert calendar_covering(df.where("false"), "d").count() == 5479


def test_pack_and_expand_is_a_projection(spark):
    df = spark.range(3).withColumn("x", F.col("id") * 2)
    packed = pack_and_expand(df, ["id", "x"])
    assert rows(packed, "id", "x") == [(0, 0), (1, 2), (2, 4)]
    assert "struct" not in packed._jdf.queryExecution().optimizedPlan().toString()


def test_measures_are_aggregated_before_the_join(spark):
    fact = spark.range(1000).select((F.col("id") % 10).alias("sk"), F.lit(2).alias("amount"))
    dim = spark.range(8).select(F.col("id").alias("sk"), F.col("id").cast("string").alias("name"))
    total = measure_by_dimension(fact, dim, "sk", {"total": F.sum("amount")}, ["name"])
    assert {(r.name, r.total) for r in total.collect()} == {(str(i), 200) for i in range(8)}
    text = plan(total)
    assert text.index("Join") < text.index("HashAggregate")


def test_settings_grow_with_the_data():
    small, large = settings_for(10**9, 8), settings_for(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 * 1024 * 1024)))
    assert large["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    assert "autoBroadcastJoinThreshold" not in str(large)


@pytest.mark.parametrize("when", [datetime(2024, 1, 1)])
def test_latest_needs_no_python(spark, when):
    df = spark.range(5).withColumn("ingested_at", F.lit(when)).withColumn("k", F.col("id") % 2)
    assert "Python" not in plan(latest_per_key(df, ["k"]))


def test_calendar_of_facts(spark):
    days = ["2017-12-30", "2024-02-29", None, "1066-10-14", "99999-01-01", "2101-01-01"]
    fact = spark.sql(" UNION ALL ".join(f"SELECT {'CAST(NULL AS DATE)' if d is None else f'make_date({int(d.split(chr(45))[0])}, {int(d.split(chr(45))[1])}, {int(d.split(chr(45))[2])})'} AS day" for d in days))
    dated = {"f": (fact, "day")}
    days_of = calendar_of_facts(spark, dated)
    assert days_of.count() == (LAST_DAY - date(2017, 12, 30)).days + 1 + 2
    assert days_of.count() == days_of.select("date_key").distinct().count()
    assert days_of.columns == calendar(spark).columns
    keys = [r.k for r in fact.select(day_key("day").alias("k")).collect()]
    assert keys == [20171230, 20240229, -1, -2, -2, -2]
    assert fact.select(day_key("day").alias("date_key")).join(days_of, "date_key").count() == len(days)
    assert tuple(day_counts(dated).first()) == ("f", 2, 1, 3)
    assert calendar_of_facts(spark, {"f": (fact.limit(0), "day")}).count() == calendar(spark).count() + 2
