from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tristrata.operators import conform
from tristrata.operators import upkeep
from tristrata.operators.upkeep import compact, compact_day, day_files, maintain
from tristrata.plans.contracts import SILVER
from tristrata.plans.silver import SilverConfig, run_silver
from tristrata.sources import coalesce_files, sinks
from tristrata.sources import (
    Tables,
    WriteLayout,
    append_silver,
    discover,
    ensure_db,
    ensure_table,
    land,
    land_all,
    read_bronze,
    read_dated_files,
    read_raw_csv,
    reload_silver,
    stringify,
)

DAY = date(2024, 1, 5)
ENTITIES = [c.raw for c in SILVER.values()]


@pytest.fixture
def raw_folder(tmp_path):
    root = tmp_path / "raw"
    (root / "2024" / "north").mkdir(parents=True)
    (root / "2024" / "appointments.csv").write_text(
        "appointment_id,patient_id,phone,start_time,reason\n"
        '1,5.0,0123,09:30,"said ""ok"", left"\n'
        "2,,0456,10:00,N/A\n"
        '3,7, 07 ,,""\n'
    )
    (root / "2024" / "north" / "appointments_more.csv").write_text(
        "appointment_id,patient_id,phone,start_time,reason\n4,8,1,11:00,x\n5,9,2,11:30,y,surplus\n"
    )
    (root / "doctors.json").write_text('{"doctor_id": "1", "Name": "A"}\n{"doctor_id": "2"}\n')
    (root / "notes.txt").write_text("line one\nline two\n")
    (root / "scan.pdf").write_bytes(b"%PDF-1.4 \x00\x01")
    (root / "treatments.parquet").write_text("this is no parquet file")
    return str(root)


def test_csv_keeps_text(spark, raw_folder):
    df = read_raw_csv(spark, f"{raw_folder}/2024/appointments.csv")
    got = {r.appointment_id: r for r in df.collect()}
    assert set(dict(df.dtypes).values()) == {"string"}
    assert (got["1"].phone, got["1"].start_time, got["1"].patient_id) == ("0123", "09:30", "5.0")
    assert got["1"].reason == 'said "ok", left'
    assert (got["2"].patient_id, got["2"].reason) == (None, None)
    assert (got["3"].phone, got["3"].start_time, got["3"].reason) == (" 07 ", None, None)


def test_discover(spark, raw_folder):
    found = {Path(r.path).name: (r.entity, r.format) for r in discover(spark, raw_folder, ENTITIES).collect()}
    assert found == {
        "appointments.csv": ("appointments", "csv"),
        "appointments_more.csv": ("appointments", "csv"),
        "doctors.json": ("doctors", "json"),
        "notes.txt": ("notes", "txt"),
        "scan.pdf": ("scan", "pdf"),
        "treatments.parquet": ("treatments", "parquet"),
    }


def test_land_all_reports_and_continues(spark, raw_folder, tmp_path):
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        report = land_all(spark, raw_folder, bronze, DAY, ENTITIES)
    got = {r.entity: (r.status, r.rows, r.bad_rows) for r in report.collect()}
    assert got == {
        "appointments": ("ok", 5, 1),
        "doctors": ("ok", 2, 0),
        "notes": ("ok", 2, 0),
        "scan": ("ok", 1, 0),
        "treatments": ("failed", None, None),
    }
    assert report.where("error is not null").count() == 1
    appointments = read_bronze(spark, bronze, "appointments", DAY)
    assert appointments.count() == 5
    assert appointments.where("_corrupt_record is not null").select("_corrupt_record").first()[0] == (
        "5,9,2,11:30,y,surplus"
    )
    assert read_bronze(spark, bronze, "scan").select("content").first()[0] == b"%PDF-1.4 \x00\x01"


def test_csv_files_with_other_columns_are_lined_up(spark, tmp_path):
    raw, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()
    (raw / "patient_1.csv").write_text("patient_id,name\n1,a\n")
    (raw / "patient_2.csv").write_text("name,patient_id,email\nb,2,b@x\n")
    report = land_all(spark, str(raw), bronze, DAY, ENTITIES).first()
    assert (report.status, report.rows) == ("ok", 2)
    landed = read_bronze(spark, bronze, "patient")
    assert {(r.patient_id, r.name, r.email) for r in landed.collect()} == {
        ("1", "a", None),
        ("2", "b", "b@x"),
    }


def test_landing_replaces_its_own_day_only(spark, tmp_path):
    base = str(tmp_path)
    for day, n in ((DAY, 3), (date(2024, 1, 6), 4), (DAY, 5)):
        land(stringify(spark.range(n)), base, "x", day)
    assert read_bronze(spark, base, "x").groupBy("ingest_dt").count().orderBy("ingest_dt").collect() == [
        (DAY, 5),
        (date(2024, 1, 6), 4),
    ]
    one_day = read_bronze(spark, base, "x", "2024-01-06")
    assert one_day.count() == 4
    assert dict(one_day.dtypes)["ingest_dt"] == "date"
    assert all("ingest_dt=2024-01-06" in f for f in one_day.inputFiles())
    assert list(Path(base, "x").rglob("*.snappy.parquet"))


def test_dated_files_are_told_apart_by_name(spark, tmp_path):
    for day in ("2024-01-05", "2024-01-06"):
        for name in ("patient", "patient_2", "doctors"):
            folder = tmp_path / f"ingest_dt={day}"
            folder.mkdir(exist_ok=True)
            import pyarrow as pa

            pq.write_table(pa.table({"name": [name]}), folder / f"{name}.parquet")
    assert read_dated_files(spark, str(tmp_path), "patient").count() == 4
    one = read_dated_files(spark, str(tmp_path), "patient", DAY)
    assert {(r.name, r.ingest_dt) for r in one.collect()} == {("patient", DAY), ("patient_2", DAY)}


@pytest.mark.parametrize("table", list(SILVER))
def test_conform_gives_the_contract(spark, table):
    contract = SILVER[table]
    raw = spark.createDataFrame(
        [tuple("7.0" for _ in contract.raw_columns), tuple("?" for _ in contract.raw_columns)],
        ", ".join(f"`{c}` string" for c in contract.raw_columns),
    )
    rows = conform(raw, contract, datetime(2024, 1, 1))
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in contract.schema()
    ]
    numeric = [t for _, t, kind in contract.specs() if kind in ("int", "float")]
    bad = rows.where(F.col(contract.specs()[-1][1]) == "?") if not numeric else rows.where(
        F.coalesce(*numeric).isNull()
    )
    assert bad.count() == 1
    assert rows.select("ingested_at").distinct().count() == 1


def test_conform_narrows_typed_columns(spark):
    raw = spark.createDataFrame(
        [(5.7, 2**40, 3, date(2024, 1, 1)), (float("nan"), 9, None, None)],
        "treatment_id double, patient_id long, doctor_id int, treatment_date date",
    ).selectExpr("*", "'x' AS disease_id", "1 AS treatment_description")
    first, second = conform(raw, SILVER["treatments"]).drop("ingested_at").collect()
    assert tuple(first) == (5, None, 3, None, "1", "2024-01-01")
    assert tuple(second) == (None, 9, None, None, "1", None)


def test_conform_defaults_and_prunes(spark, tmp_path):
    contract = SILVER["lab_results"]
    cells = {c: None for c in contract.raw_columns}
    schema = ", ".join(f"{c} string" for c in [*contract.raw_columns, "unused"])
    df = spark.createDataFrame([(*cells.values(), "x")], schema)
    df.write.parquet(str(tmp_path / "raw"))
    rows = conform(spark.read.parquet(str(tmp_path / "raw")), contract)
    assert rows.first().unit == "Unknown"
    assert "unused" not in rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def silver_rows(spark, n, *days):
    times = F.array(*[F.lit(datetime(2024, 1, d, 6)) for d in days])
    return spark.range(n).select("id", F.explode(times).alias("ingested_at"))


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_append_and_reload(spark, tmp_path, kind):
    schema = silver_rows(spark, 1, 1).schema
    if kind == "catalog":
        ensure_db(spark, "silver_test")
        ensure_table(spark, "silver_test.t", schema)
        ensure_table(spark, "silver_test.t", schema)
        target, read = "silver_test.t", lambda: spark.table("silver_test.t")
    else:
        target = str(tmp_path / "t")
        read = lambda: spark.read.parquet(target)
    append_silver(silver_rows(spark, 10, 1), target)
    append_silver(silver_rows(spark, 10, 1, 2), target, WriteLayout(files=1))
    counts = lambda: {r.ingest_day.day: r["count"] for r in read().groupBy("ingest_day").count().collect()}
    assert counts() == {1: 20, 2: 10}
    if kind == "catalog":
        spark.catalog.refreshTable(target)
    reload_silver(silver_rows(spark, 3, 2, 3), target, WriteLayout(rebalance=True))
    assert counts() == {1: 20, 2: 3, 3: 3}


def test_reload_refuses_a_table_it_would_empty(spark):
    ensure_db(spark, "silver_test")
    spark.sql(
        "CREATE TABLE silver_test.other (id BIGINT, ingested_at TIMESTAMP, ingest_day DATE) "
        "USING parquet PARTITIONED BY (ingest_day)"
    )
    append_silver(silver_rows(spark, 4, 1), "silver_test.other")
    with pytest.raises(ValueError, match="would empty it"):
        reload_silver(silver_rows(spark, 4, 2), "silver_test.other")
    assert spark.table("silver_test.other").count() == 4


def test_layout_options_reach_the_files(spark, tmp_path):
    layout = WriteLayout(
        compression="snappy", row_group_bytes=8 << 20, page_bytes=128 << 10, dictionary=False, files=2
    )
    append_silver(silver_rows(spark, 1000, 1).repartition(8), str(tmp_path / "t"), layout)
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len(files) <= 2
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert column.compression == "SNAPPY" and not any("DICT" in e for e in column.encodings)


def test_tables_by_name(spark, tmp_path):
    folder = Tables(spark, str(tmp_path / "gold"))
    assert folder.publish(spark.range(3), "a").count() == 3
    assert folder.publish(spark.range(2), "a").count() == 2
    catalog = Tables(spark, "gold_test", given={"b": spark.range(7)})
    assert catalog.source("b").count() == 7
    assert catalog.publish(spark.range(4), "b").count() == 4
    assert catalog.ref("b").count() == 4


def fragmented(spark, path, days=(1, 2), files=6):
    for _ in range(files):
        append_silver(silver_rows(spark, 50, *days).coalesce(1), path)


def test_compact_one_day(spark, tmp_path):
    path = str(tmp_path / "t")
    fragmented(spark, path)
    before = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert compact_day(spark, path, date(2024, 1, 1)) == 300
    files = {r.ingest_day.day: r.files for r in day_files(spark, path).collect()}
    assert files == {1: 1, 2: 6}
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == before


def test_compact_touches_fragmented_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    fragmented(spark, path)
    append_silver(silver_rows(spark, 50, 3).coalesce(1), path)
    whole = next((tmp_path / "t" / "ingest_day=2024-01-03").glob("*.parquet"))
    before = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert compact(spark, path) == 600
    assert compact(spark, path) == 0
    assert whole.exists()
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == before


def test_compaction_leaves_large_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_silver(silver_rows(spark, 20_000, 1).coalesce(1), path)
    large = next((tmp_path / "t").rglob("*.parquet"))
    fragmented(spark, path)
    target = int(large.stat().st_size / 0.8)
    small = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet") if f != large)
    seen, whole = [], upkeep._replace_files
    monkeypatch.setattr(upkeep, "_replace_files", lambda *args: seen.append(whole(*args)) or seen[-1])
    before = spark.read.parquet(path).count()
    (report,) = maintain(spark, {"t": path}, date(2024, 1, 5), target_bytes=target).collect()
    assert large.exists() and seen[0].bytes_read == small and seen[0].rows == 600
    assert spark.read.parquet(path).count() == before
    left = [f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet")]
    assert (report.files_after, report.bytes_after) == (len(left), sum(left))
    assert compact(spark, path, target_bytes=target) == 0


def test_compaction_keeps_what_is_appended_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    fragmented(spark, path)
    replace = upkeep._replace_files

    def append_first(*args):
        append_silver(silver_rows(spark, 10, 1), path)
        return replace(*args)

    monkeypatch.setattr(upkeep, "_replace_files", append_first)
    assert compact_day(spark, path, date(2024, 1, 1)) == 300
    assert spark.read.parquet(path).count() == 610
    assert compact(spark, path) == 610
    assert spark.read.parquet(path).count() == 620


def test_compaction_gives_way_to_a_reload(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    fragmented(spark, path)
    replace = upkeep._replace_files

    def reload_first(rows, *args):
        kept = spark.createDataFrame(rows.collect(), rows.schema)
        reload_silver(silver_rows(spark, 3, 1), path)
        return replace(kept, *args)

    monkeypatch.setattr(upkeep, "_replace_files", reload_first)
    with pytest.raises(RuntimeError, match="were replaced during the compaction"):
        compact(spark, path)
    assert spark.read.parquet(path).count() == 303
    assert not list((tmp_path / "t").glob("_compacting-*"))


def test_a_stopped_swap_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    fragmented(spark, path)
    before = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    with monkeypatch.context() as stopped:
        finish, calls = upkeep.finish_compactions, []
        stopped.setattr(upkeep, "finish_compactions", lambda *args: calls.append(1) or (finish(*args) if len(calls) == 1 else None))
        compact(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == before
    upkeep.finish_compactions(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == before
    assert sum(r.files for r in day_files(spark, path).collect()) == 2


def test_compaction_keeps_the_batches_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(2):
        rows = silver_rows(spark, 40, 1).selectExpr("*", "to_date(ingested_at) AS ingest_day", f"{batch} AS batch")
        rows.repartition(4).write.mode("append").partitionBy("ingest_day", "batch").parquet(path)
    assert compact(spark, path) == 80
    stored = spark.read.parquet(path)
    assert {r.batch: r["count"] for r in stored.groupBy("batch").count().collect()} == {0: 40, 1: 40}
    assert day_files(spark, path).first().files == 2


def test_maintain_reports(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("a", "b")}
    for path in paths.values():
        fragmented(spark, path, files=3)
    report = {r.table: r for r in maintain(spark, paths, date(2024, 1, 5), window_days=3).collect()}
    assert set(report) == {"a", "b"}
    for r in report.values():
        assert (r.days, r.files_before, r.files_after, r["rows"]) == (2, 6, 4, 150)
        assert r.bytes_after < r.bytes_before


def test_silver_run_reports_failures_and_keeps_the_day(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    contract = SILVER["patient"]
    rows = spark.createDataFrame(
        [tuple("1" for _ in contract.raw_columns)], ", ".join(f"{c} string" for c in contract.raw_columns)
    )
    for day in (DAY, date(2024, 1, 6)):
        land(rows, bronze, contract.raw, day)
    cfg = SilverConfig(bronze, str(tmp_path / "silver"), tables=("patient", "doctors"))
    with pytest.raises(RuntimeError, match="1 of 2 silver tables failed: doctors"):
        run_silver(spark, SilverConfig(bronze, str(tmp_path / "raised"), tables=("patient", "doctors")), datetime(2024, 1, 7))
    assert spark.read.parquet(f"{tmp_path}/raised/patient").count() == 2
    report = {r.table: r for r in run_silver(spark, cfg, datetime(2024, 1, 7), raise_failed=False).collect()}
    assert (report["patient"].status, report["patient"]["rows"]) == ("ok", 2)
    assert report["doctors"].status == "failed" and "doctors" in report["doctors"].error
    stored = spark.read.parquet(f"{tmp_path}/silver/patient")
    assert stored.select("ingest_dt").distinct().count() == 2


def test_silver_run_into_a_database(spark, tmp_path):
    bronze, contract = str(tmp_path / "bronze"), SILVER["diseases"]
    rows = spark.createDataFrame(
        [("1.0", "2", "flu", "2024-01-01")], ", ".join(f"{c} string" for c in contract.raw_columns)
    )
    land(rows, bronze, contract.raw, DAY)
    cfg = SilverConfig(bronze, "silver_run_test", ingest_dt=DAY, tables=("diseases",))
    for _ in range(2):
        report = run_silver(spark, cfg, datetime(2024, 1, 7)).first()
        assert (report.status, report.error) == ("ok", None)
    assert spark.table("silver_run_test.diseases").count() == 2


def test_files_limit_small_loads_only(spark, monkeypatch):
    rows = spark.range(0, 100_000, 1, 6)
    assert coalesce_files(rows, 2).rdd.getNumPartitions() == 2
    monkeypatch.setattr(sinks, "FILE_BYTES", 1000)
    assert coalesce_files(rows, 2).rdd.getNumPartitions() == 6
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,), (2,)], 6), "id long")
    assert coalesce_files(unknown, 2).rdd.getNumPartitions() == 2


def test_silver_run_casts_each_value_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(" 1 ", "a"), ("x", "b"), (None, None)], "doctor_id string, Name string")
    for c in ("specialization", "phone", "email"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    land(rows, str(tmp_path / "bronze"), "doctors", date(2024, 1, 1))
    seen, kind = [], type(rows)
    real = kind.observe
    monkeypatch.setattr(kind, "observe", lambda self, o, *columns: (seen.extend(str(c) for c in columns), real(self, o, *columns))[1])
    cfg = SilverConfig(str(tmp_path / "bronze"), str(tmp_path / "silver"), date(2024, 1, 1), ["doctors"])
    (report,) = run_silver(spark, cfg, datetime(2024, 1, 1, 6)).collect()
    assert (report.rows, report.misfits) == (3, {"doctor_id": 1})
    assert seen and not any("cast" in text.lower() for text in seen)
