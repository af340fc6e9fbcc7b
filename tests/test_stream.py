from __future__ import annotations

import glob
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from tristrata.plans.contracts import SILVER
from tristrata.operators import latest_per_key
from tristrata.streaming import keep_state_on_disk, newest_stream, raw_stream, silver_stream, stream_to_silver
from tristrata.workload.table_queries import stream_newest

SCHEMA = "disease_id string, patient_id string, disease_name string, diagnosis_date string"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **kwargs):
    raw = raw_stream(spark, str(tmp_path / "raw"), SCHEMA, files_per_batch=1)
    rows = silver_stream(raw, SILVER["diseases"], ["disease_id", "patient_id"], **kwargs)
    stream_to_silver(rows, str(tmp_path / "silver"), str(tmp_path / "checkpoint"))
    return spark.read.parquet(str(tmp_path / "silver"))


@pytest.mark.parametrize("spread", [1, 4])
def test_each_key_once_across_files_and_runs(spark, tmp_path, spread):
    raw = str(tmp_path / "raw")
    run_all = partial(run, spark, tmp_path, spread=spread)
    put(spark, raw, [("1", "7", "flu", "2024-01-01"), ("2.0", "7", "cold", "2001-01-01")])
    put(spark, raw, [("1", "7", "flu", "2024-01-01"), ("x", "8", None, None)])
    stored = run_all()
    assert stored.count() == 3
    assert {(r.disease_id, r.patient_id) for r in stored.collect()} == {(1, 7), (2, 7), (None, 8)}
    # the next run takes the new file only and still knows the old keys
    put(spark, raw, [("2", "7", "cold", "2001-01-01"), ("3", "9", "old", "1970-01-01")])
    stored = run_all()
    assert sorted(r.disease_id or 0 for r in stored.collect()) == [0, 1, 2, 3]
    assert stored.where(F.col("ingest_day").isNull()).count() == 0
    assert run_all().count() == 4


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    put(spark, str(tmp_path / "raw"), [(str(i), "7", "flu", "2024-01-01") for i in range(20)])
    assert run(spark, tmp_path).count() == 20
    # forget the commit of the last batch, as after a failure between write and commit
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    crc = last.with_name(f".{last.name}.crc")
    for path in (last, crc):
        if path.exists():
            path.unlink()
    assert run(spark, tmp_path).count() == 20


def test_the_newest_row_of_a_key_comes_out_after_the_horizon(spark, tmp_path):
    keep_state_on_disk(spark)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    raw, hour = tmp_path / "raw", 3600
    deliveries = [
        (0, [("1", "7", "flu", "a"), ("2", "7", "cold", "a"), (None, "8", "x", "a"), ("1", "7", "flu", "b")]),
        (2, [("1", "7", "gout", "a")] * 50 + [("2", "7", None, "a")]),
        (5, [("3", "9", "old", "z")]),
        (100, [("1", "7", "late", "a")]),  # a repeat after the horizon
        (300, [("99", "99", "end", "z")]),
    ]
    emitted = []
    for hours, rows in deliveries:
        known = set(raw.glob("*.parquet")) if raw.exists() else set()
        put(spark, str(raw), rows)
        for file in set(raw.glob("*.parquet")) - known:
            os.utime(file, (1_704_067_200 + hours * hour,) * 2)
        stream = raw_stream(spark, str(raw), SCHEMA, files_per_batch=1)
        newest = newest_stream(stream, SILVER["diseases"], ["disease_id", "patient_id"], "10 hours")
        stream_to_silver(newest, str(tmp_path / "silver"), str(tmp_path / "checkpoint"))
        found = spark.read.parquet(str(tmp_path / "silver")) if list((tmp_path / "silver").glob("*")) else None
        emitted.append(0 if found is None else found.count())
    assert emitted == [0, 0, 0, 4, 5]  # sessions close with the delivery after the horizon
    stored = {(r.disease_id, r.disease_name, r.diagnosis_date) for r in found.collect()}
    assert stored == {(1, "gout", "a"), (1, "late", "a"), (2, None, "a"), (3, "old", "z"), (None, "x", "a")}
    last = latest_per_key(found, ["disease_id", "patient_id"], ["ingested_at"])
    assert {(r.disease_id, r.disease_name) for r in last.collect()} == {(1, "late"), (2, None), (3, "old"), (None, "x")}


def test_a_delivery_is_one_batch_however_many_files_it_has(spark, tmp_path):
    rows = spark.range(0, 64, 1, 16).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 10:00:00' AS ts", "id % 7 AS user_id", "'x' AS event_type", "CAST(id AS DOUBLE) AS value", "'{}' AS props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    checkpoints, own = spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    known = set(glob.glob(f"{checkpoints}/**/stream-newest-*", recursive=True))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        newest = stream_newest(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)
    added = {0: 0, 1: 1, 2: 2}
    expected = {(i, i % 7, i + added[2 if i % 5 == 0 else 1 if i % 3 == 0 else 0]) for i in range(64)}
    assert {tuple(r) for r in newest.collect()} == expected
    (folder,) = set(glob.glob(f"{checkpoints}/**/stream-newest-*", recursive=True)) - known
    assert len(glob.glob(f"{folder}/raw/part=1/part-*")) > 8
    # three deliveries, the row that closes them and the batch that the watermark asks for
    assert len(glob.glob(f"{folder}/checkpoint/commits/[0-9]*")) <= 5
