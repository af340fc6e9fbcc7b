from __future__ import annotations

import random
from datetime import date, datetime, timezone

import pytest

from tristrata.operators.check_state import check_states
from tristrata.operators.quality import not_null, unique
from tristrata.sources import append_silver, reload_silver

SCHEMA = "k int, a string, b string, ingested_at timestamp"


def at(day):
    return datetime(2024, 1, day, 6, tzinfo=timezone.utc)


def rows(rng, low, high, day, n=40):
    return [(rng.choice([None, *range(low, high)]), rng.choice(["x", None]), rng.choice(["y", None]), at(day)) for _ in range(n)]


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("spread", [5, 1000])
def test_state_equals_the_full_checks_after_each_load(spark, tmp_path, spread):
    rng, path = random.Random(spread), str(tmp_path / "t")
    (state,) = check_states(spark, str(tmp_path / "state"), {"t": ("k", "int", ["a", "b", "k"])}).values()
    for day in (1, 2, 3, 3, 5):
        append_silver(spark.createDataFrame(rows(rng, day * spread, day * spread + 30, day), SCHEMA), path)
        table = spark.read.parquet(path)
        read = state.refresh(table)
        assert read[-1] == date(2024, 1, day) and len(read) <= 2  # the newest known day and the new one
        assert same(state.not_null(), not_null(table, ["a", "b", "k"]))
        assert same(state.unique(), unique(table, ["k"]))
        assert state.newest().first()[0] == table.agg({"ingested_at": "max"}).first()[0]
    reload_silver(spark.createDataFrame(rows(rng, 0, 9000, 2), SCHEMA), path)
    table = spark.read.parquet(path)
    state.refresh(table, since=date(2024, 1, 2))
    assert same(state.not_null(), not_null(table, ["a", "b", "k"])) and same(state.unique(), unique(table, ["k"]))


def test_keys_are_read_only_where_ranges_overlap(spark, tmp_path):
    path = str(tmp_path / "t")
    (state,) = check_states(spark, str(tmp_path / "state"), {"t": ("k", "int", ["a"])}).values()
    for day, (low, high) in enumerate([(0, 10), (10, 20), (20, 30), (30, 40)], 1):
        append_silver(spark.createDataFrame([(k, "x", "y", at(day)) for k in range(low, high)], SCHEMA), path)
    state.refresh(spark.read.parquet(path))
    assert state.suspect_days() == [] and state.unique().count() == 0
    append_silver(spark.createDataFrame([(15, "x", "y", at(5)), (16, "x", "y", at(5))], SCHEMA), path)
    assert state.refresh(spark.read.parquet(path)) == [date(2024, 1, 4), date(2024, 1, 5)]
    assert state.suspect_days() == [date(2024, 1, 2), date(2024, 1, 5)]
    assert sorted(map(tuple, state.unique().collect())) == [(15, 2), (16, 2)]
    plan = state.unique()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:int,n:bigint>" in plan and "ingest_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_state_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_silver(spark.createDataFrame([(1, "x", None, at(1))], SCHEMA), path)
    (state,) = check_states(spark, str(tmp_path / "state"), {"t": ("k", "int", ["a", "b"])}).values()
    assert state.refresh(spark.read.parquet(path).where("k > 5")) == []
    assert {r.column: r.failures for r in state.not_null().collect()} == {"a": 0, "b": 0}
    assert state.refresh(spark.read.parquet(path)) == [date(2024, 1, 1)]
    assert {r.column: r.failures for r in state.not_null().collect()} == {"a": 0, "b": 1}
