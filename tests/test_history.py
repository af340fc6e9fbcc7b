from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tristrata.operators import apply_snapshot, as_of_join, latest_per_key, version_dimension
from tristrata.sources import cut_lineage, expire_runs, latest_run, read_history, record_snapshot

SCHEMA = "id int, name string, city string, src string"
KEYS, CHECK, CARRIED = ["id"], ["name", "city"], ["src"]


def at(day: int) -> datetime:
    return datetime(2024, 1, day, 6, tzinfo=timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def versions(df):
    out = []
    for r in df.collect():
        day = lambda t: None if t is None else t.day
        out.append((r.id, r.name, r.city, r.src, day(r.valid_from), day(r.valid_to)))
    return sorted(out, key=repr)


def step(spark, state, rows, day):
    return cut_lineage(apply_snapshot(state, frame(spark, rows), KEYS, CHECK, at(day), CARRIED))


def test_versions(spark):
    first = [(1, "a", "x", "l1"), (2, "b", None, "l1"), (3, "c", "z", "l1"), (None, "n", "n", "l1")]
    second = [(1, "a", "x", "l2"), (2, "b", "y", "l2"), (4, "d", "w", "l2"), (None, "n", "n", "l2")]
    third = [(1, None, "x", "l3"), (2, "b", "y", "l3"), (3, "c", "z", "l3"), (None, "m", "n", "l3")]
    state = step(spark, None, first, 1)
    assert len(versions(state)) == 4
    state = step(spark, state, second, 2)
    state = step(spark, state, third, 3)
    assert versions(state) == sorted(
        [
            (1, "a", "x", "l1", 1, 3),
            (1, None, "x", "l3", 3, None),
            (2, "b", None, "l1", 1, 2),
            (2, "b", "y", "l2", 2, None),
            (3, "c", "z", "l1", 1, None),
            (4, "d", "w", "l2", 2, None),
            (None, "n", "n", "l1", 1, 3),
            (None, "m", "n", "l3", 3, None),
        ],
        key=repr,
    )
    replay = apply_snapshot(state, frame(spark, third), KEYS, CHECK, at(4), CARRIED)
    assert versions(replay) == versions(state)


def random_loads(spark, seed, loads=5, ids=40):
    rng = random.Random(seed)
    out = []
    for day in range(1, loads + 1):
        chosen = [i for i in range(ids) if rng.random() < 0.6] + [None]
        out.append(
            [(i, rng.choice("ab"), rng.choice(["x", "y", None]), f"l{day}") for i in chosen]
        )
    return out


def rebuilt(loads):
    """History of the same loads, one key at a time in plain Python."""
    history = {}
    for day, rows in enumerate(loads, start=1):
        for key, name, city, src in rows:
            own = history.setdefault(key, [])
            if own and own[-1][:2] == (name, city):
                continue
            if own:
                own[-1] = (*own[-1][:4], day)
            own.append((name, city, src, day, None))
    return sorted(((k, *v) for k, vs in history.items() for v in vs), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_stored_history_equals_rebuild(spark, tmp_path, seed):
    loads = random_loads(spark, seed)
    base = str(tmp_path / "history")
    for day, rows in enumerate(loads, start=1):
        counts = record_snapshot(frame(spark, rows), base, KEYS, CHECK, at(day), CARRIED)
        if day == 3:  # the same run again replaces itself
            again = record_snapshot(frame(spark, rows), base, KEYS, CHECK, at(day), CARRIED)
            assert again == counts
        history = read_history(spark, base)
        assert versions(history) == rebuilt(loads[:day])
        assert counts["open_versions"] == history.where("valid_to is null").count()
    assert versions(read_history(spark, base, latest_run(spark, base, before="20240104"))) == rebuilt(loads[:3])
    open_per_key = history.where("valid_to is null").groupBy("id").count()
    assert open_per_key.where("count > 1").count() == 0


def test_unfinished_run_is_ignored(spark, tmp_path):
    base = str(tmp_path / "history")
    record_snapshot(frame(spark, [(1, "a", "x", "l1")]), base, KEYS, CHECK, at(1), CARRIED)
    stray = spark.createDataFrame(
        [(1, "a", "x", "l1", at(1), at(2)), (1, "q", "x", "l2", at(2), None)],
        SCHEMA + ", valid_from timestamp, valid_to timestamp",
    )
    stray.withColumn("is_current", F.col("valid_to").isNull()).write.partitionBy("is_current").parquet(
        f"{base}/versions/run=20240102T060000000000"
    )
    assert versions(read_history(spark, base)) == [(1, "a", "x", "l1", 1, None)]
    record_snapshot(frame(spark, [(1, "b", "x", "l3")]), base, KEYS, CHECK, at(3), CARRIED)
    assert versions(read_history(spark, base)) == [(1, "a", "x", "l1", 1, 3), (1, "b", "x", "l3", 3, None)]


def test_expired_runs_lose_nothing_of_the_history(spark, tmp_path):
    loads = random_loads(spark, 5, loads=4, ids=8)
    base = str(tmp_path / "history")
    for day, rows in enumerate(loads, start=1):
        record_snapshot(frame(spark, rows), base, KEYS, CHECK, at(day), CARRIED)
    first, third = latest_run(spark, base, "20240102"), latest_run(spark, base, "20240104")
    assert len(expire_runs(spark, base, keep=2)) == 2
    assert expire_runs(spark, base, keep=2) == []
    assert versions(read_history(spark, base)) == rebuilt(loads)
    assert versions(read_history(spark, base, third)) == rebuilt(loads[:3])
    with pytest.raises(ValueError, match="expired"):
        read_history(spark, base, first)
    with pytest.raises(ValueError, match="no finished run"):
        read_history(spark, base, "20230101")


def test_source_of_a_log_is_not_shuffled_twice(spark):
    log = spark.range(0, 1000, 1, 4).select(
        (F.col("id") % 100).cast("int").alias("id"),
        F.lit("a").alias("name"),
        F.lit("x").alias("city"),
        F.col("id").cast("string").alias("src"),
        F.col("id").alias("ingested_at"),
    )
    source = latest_per_key(log, ["id"]).drop("ingested_at")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        state = apply_snapshot(None, source, KEYS, CHECK, at(1), CARRIED)
        merged = apply_snapshot(cut_lineage(state), source, KEYS, CHECK, at(2), CARRIED)
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keyed = text[: text.index("coalesce(old_id")]
    # one shuffle of the open versions, one inside the log's own ranking
    assert keyed.count("Exchange") == 2
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_version_dimension(spark):
    state = step(spark, None, [(1, "a", "x", "l1")], 1)
    state = step(spark, state, [(1, "b", "x", "l2")], 2)
    dim = version_dimension(state, "id", "sk", "nk", ["name"])
    assert dim.columns == ["sk", "nk", "name", "valid_from", "valid_to", "is_current"]
    assert {(r.name, r.is_current) for r in dim.collect()} == {("a", False), ("b", True)}
    assert dim.select("sk").distinct().count() == 2


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_as_of_join_with_a_hot_key(spark, threshold):
    loads = random_loads(spark, 3, loads=4, ids=10)
    state = None
    for day, rows in enumerate(loads, start=1):
        state = step(spark, state, rows, day)
    n = 3000
    start = at(1) - timedelta(hours=12)
    facts = spark.range(0, n, 1, 8).select(
        F.col("id").alias("fact"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 12).cast("int")).alias("who"),
        (F.lit(start).cast("timestamp") + F.make_interval(mins=F.col("id").cast("int") * 2)).alias("t"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {
            r.fact: (r.name, r.city)
            for r in as_of_join(facts, state, "who", "id", F.col("t"), ["name", "city"]).collect()
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == n
    known = state.collect()
    for r in facts.collect():
        match = [
            (v.name, v.city)
            for v in known
            if v.id == r.who and v.valid_from <= r.t and (v.valid_to is None or r.t < v.valid_to)
        ]
        assert got[r.fact] == (match[0] if match else (None, None))


def test_late_and_unfounded_runs_raise(spark, tmp_path):
    base = str(tmp_path / "ordered")
    for day in (1, 2, 4):
        record_snapshot(frame(spark, [(1, "a" * day, "x", "l")]), base, KEYS, CHECK, at(day), CARRIED)
    with pytest.raises(ValueError, match="older"):
        record_snapshot(frame(spark, [(1, "b", "x", "l")]), base, KEYS, CHECK, at(3), CARRIED)
    assert len(expire_runs(spark, base, keep=1)) == 1
    counts = record_snapshot(frame(spark, [(1, "aaaa", "x", "l")]), base, KEYS, CHECK, at(4), CARRIED)
    assert (counts["opened"], counts["closed"]) == (1, 1)
    assert read_history(spark, base).count() == 3


def test_columns_that_only_some_days_have(spark, tmp_path):
    from tristrata.sources import read_bronze

    base = str(tmp_path / "bronze")
    spark.createDataFrame([(1, "a")], "id long, a string").write.parquet(f"{base}/t/ingest_dt=2024-01-01")
    spark.createDataFrame([(2, "a", "b")], "id long, a string, b string").write.parquet(f"{base}/t/ingest_dt=2024-01-02")
    got = {r.id: r.b for r in read_bronze(spark, base, "t").collect()}
    assert got == {1: None, 2: "b"}
