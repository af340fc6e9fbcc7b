from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tristrata.plans import dims, facts, incremental
from tristrata.plans.incremental import FACTS, FactStore, Upkeep, record_changes, rows_after
from tristrata.sources import append_silver, read_history, record_snapshot
from tristrata.sources.history_store import mark_before, run_id

SCHEMA = (
    "fee_id string, appointment_id int, patient_id int, fee_date string, amount double, service_type string, "
    "description string, ingested_at timestamp"
)


def at(day, hour=6):
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


def fee(rng, i, when):
    key = None if rng.random() < 0.05 else f"f{i}"
    day = rng.choice(["2023-01-05", "2023-02-07", "2023-03-01", "bad", None])
    return (key, rng.randrange(9), rng.randrange(5), day, float(rng.randrange(20)), rng.choice(["a ", "B"]), None, when)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_facts_after_each_load_equal_the_full_rebuild(spark, tmp_path):
    rng = random.Random(1)
    base, log_path = str(tmp_path / "gold"), str(tmp_path / "log")
    store = FactStore(spark, base, FACTS["fact_billing"])
    assert store.mark() is None
    for load in range(1, 5):
        when = [at(load, 6), at(load, 6), at(load, 18)]
        rows = [fee(rng, rng.randrange(40), rng.choice(when)) for _ in range(60)]
        append_silver(frame(spark, rows), log_path)
        log = spark.read.parquet(log_path)
        done = store.update(log)
        assert done["rows_read"] == 60 and same(store.read(), facts.fact_billing(log))
        assert store.mark() == max(r[-1] for r in rows)
        assert store.update(log) == {"mark": store.mark(), "periods": [], "rows_read": 0}
    # loads stamped a little before the mark come in late
    late = [fee(rng, 100 + i, at(4, 17)) for i in range(5)] + [(None, 1, 1, "2023-01-05", 1.0, "x", "late", at(4, 17))]
    append_silver(frame(spark, late), log_path)
    log = spark.read.parquet(log_path)
    assert store.update(log)["rows_read"] == 0
    before = store.read().count()
    append_silver(frame(spark, [fee(rng, 200, at(5))]), log_path)
    log = spark.read.parquet(log_path)
    store.update(log, overlap=timedelta(days=1))
    assert same(store.read(), facts.fact_billing(log)) and store.read().count() > before


def test_a_key_that_moves_leaves_its_month(spark, tmp_path):
    base, log_path = str(tmp_path / "gold"), str(tmp_path / "log")
    store = FactStore(spark, base, FACTS["fact_billing"])
    row = ("k", 1, 1, "2023-01-05", 1.0, "a", "b")
    append_silver(frame(spark, [(*row, at(1)), ("other", *row[1:3], "2023-05-05", *row[4:], at(1))]), log_path)
    store.update(spark.read.parquet(log_path))
    append_silver(frame(spark, [(*row[:3], "2023-02-05", *row[4:], at(2))]), log_path)
    log = spark.read.parquet(log_path)
    assert store.update(log)["periods"] == ["2023-01", "2023-02"]
    assert same(store.read(), facts.fact_billing(log)) and store.read().count() == 2
    assert not list((tmp_path / "gold" / "fact").glob("period=2023-01/*")) and list((tmp_path / "gold" / "fact").glob("period=2023-05/*"))


@pytest.mark.parametrize("stop_at", [0, 1, 2])
def test_a_stopped_run_can_be_repeated(spark, tmp_path, monkeypatch, stop_at):
    rng = random.Random(stop_at)
    log_path = str(tmp_path / "log")
    store = FactStore(spark, str(tmp_path / "gold"), FACTS["fact_billing"])
    for load in (1, 2):
        append_silver(frame(spark, [fee(rng, rng.randrange(20), at(load)) for _ in range(50)]), log_path)
        log = spark.read.parquet(log_path)
        calls = []
        whole = FactStore._drop_periods

        def stopping(self, name, months):
            calls.append(name)
            if len(calls) == stop_at + 1 or stop_at == 2 and len(calls) == 2:
                if stop_at == 2:
                    whole(self, name, months)
                raise RuntimeError("stopped")
            whole(self, name, months)

        monkeypatch.setattr(FactStore, "_drop_periods", stopping)
        with pytest.raises(RuntimeError, match="stopped"):
            store.update(log)
        monkeypatch.setattr(FactStore, "_drop_periods", whole)
        assert store.update(log)["rows_read"] == 50
        assert same(store.read(), facts.fact_billing(log))


def test_other_months_and_days_are_not_read(spark, tmp_path):
    log_path = str(tmp_path / "log")
    store = FactStore(spark, str(tmp_path / "gold"), FACTS["fact_billing"])
    rows = [(f"f{i}", 1, 1, f"2023-{1 + i % 9:02d}-01", 1.0, "a", "b", at(1 + i % 9)) for i in range(90)]
    append_silver(frame(spark, rows), log_path)
    log = spark.read.parquet(log_path)
    store.update(log)
    new = store._new_rows(log, at(7), None)
    assert "PartitionFilters: [isnotnull(ingest_day" in plan(new) and new.count() == 20
    merged = store.merged(new, ["2023-08", "2023-09"], at(7))
    assert "period#" in plan(merged) and "IN (2023-08,2023-09)" in plan(merged)
    merged.collect()
    keys = new.select("fee_id").distinct()
    looked_up = plan(store._current().select("fee_id", "period").join(keys, "fee_id", "left_semi"))
    assert "ReadSchema: struct<fee_id:string>" in looked_up
    # what passes by is not shuffled: the new keys are sent round
    assert "left_anti" in plan(merged).lower().replace("leftanti", "left_anti")


@pytest.mark.parametrize("name", sorted(FACTS))
def test_every_fact_has_its_columns(spark, sf_dir, tmp_path, name):
    from tristrata.workload.views import silver

    upkeep: Upkeep = FACTS[name]
    log = silver(spark, sf_dir, upkeep.log).where(F.crc32(F.col(upkeep.key).cast("string")) % 20 == 0)
    # one load day is enough here
    log = log.withColumn("ingested_at", F.lit(at(1)))
    store = FactStore(spark, str(tmp_path), upkeep)
    store.update(log)
    full = upkeep.build(log)
    assert store.read().columns == full.columns and same(store.read(), full)


# --- history by changes -----------------------------------------------------------

PEOPLE = "patient_id int, patient_name string, patient_gender string, patient_dob string, patient_address string, patient_phone string, patient_email string, ingested_at timestamp"


def person(rng, i, when):
    return (i, f"n{i}", "F", "1990-01-01", rng.choice(["here", "there", None]), "1", None, when)


def versions(spark, base):
    return sorted((tuple(r) for r in read_history(spark, base).collect()), key=str)


def test_history_by_changes_equals_whole_logs(spark, tmp_path):
    rng = random.Random(3)
    log_path, by_changes, whole = (str(tmp_path / n) for n in ("log", "changes", "whole"))
    for day in range(1, 5):
        people = [person(rng, i if i else None, at(day, rng.choice([3, 5]))) for i in rng.sample(range(30), 12)]
        append_silver(spark.createDataFrame(people, PEOPLE), log_path)
        log = spark.read.parquet(log_path)
        counts = record_changes(log, by_changes, dims.patient_snapshot_source, ["patient_id"], dims.PATIENT, at(day), [dims.SOURCE_TIME])
        source = dims.patient_snapshot_source(log, at(day))
        assert counts == record_snapshot(source, whole, ["patient_id"], dims.PATIENT, at(day), [dims.SOURCE_TIME])
        assert versions(spark, by_changes) == versions(spark, whole)
        assert mark_before(spark, by_changes, run_id(at(day + 1))) == max(p[-1] for p in people)
    # a repeated run starts from the mark of the one before it
    record_changes(log, by_changes, dims.patient_snapshot_source, ["patient_id"], dims.PATIENT, at(4), [dims.SOURCE_TIME])
    assert versions(spark, by_changes) == versions(spark, whole)


def test_files_read_do_not_grow_with_the_log(spark, tmp_path):
    rng = random.Random(4)
    log_path = str(tmp_path / "log")
    read = []
    for day in range(1, 6):
        append_silver(spark.createDataFrame([person(rng, i, at(day)) for i in range(20)], PEOPLE).coalesce(1), log_path)
        new = rows_after(spark.read.parquet(log_path), at(day - 1) if day > 1 else None)
        assert "ingest_day" in plan(new).split("PartitionFilters: [")[1].split("]")[0] or day == 1
        read.append(new.select(F.input_file_name()).distinct().count())
    assert read == [1] * 5


def test_a_rewritten_log_is_read_whole_on_request(spark, tmp_path):
    log_path, base = str(tmp_path / "log"), str(tmp_path / "history")
    make = lambda city, day: spark.createDataFrame([(1, "n", "F", None, city, None, None, at(day))], PEOPLE)
    make("x", 3).write.parquet(log_path)
    run = lambda day, **k: record_changes(
        spark.read.parquet(log_path), base, dims.patient_snapshot_source, ["patient_id"], dims.PATIENT, at(day), [dims.SOURCE_TIME], **k
    )
    run(3)
    make("y", 2).write.mode("overwrite").parquet(log_path)
    assert run(4)["opened"] == 0
    assert run(5, full=True)["opened"] == 1


def test_many_new_rows_are_ranked_in_one_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "FEW_ROWS", 5)
    log_path = str(tmp_path / "log")
    store = FactStore(spark, str(tmp_path / "gold"), FACTS["fact_billing"])
    for day in (1, 2, 3):
        rows = [(f"f{i * day % 17}" if i % 7 else None, day, 1, f"2023-{1 + (i + day) % 5:02d}-01", float(i), "a", "b", at(day)) for i in range(30)]
        append_silver(frame(spark, rows), log_path)
        log = spark.read.parquet(log_path)
        store.update(log)
        assert same(store.read(), facts.fact_billing(log))
    new = store._new_rows(log, at(2), None)
    assert "Join" not in plan(store.merged(new, ["2023-01", "2023-02"], at(2), 30))
