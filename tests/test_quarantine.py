from __future__ import annotations

import gzip
from datetime import date, datetime, timezone

import pytest

from tristrata.plans.contracts import SILVER
from tristrata.plans.silver import SilverConfig, quarantine_target, run_silver
from tristrata.sources import land_all, read_bronze
from tristrata.sources.landing import SOURCE_FILE, _first_lines, discover, header_groups

DAY = date(2024, 1, 5)
RUN = datetime(2024, 1, 5, 6, tzinfo=timezone.utc)
ENTITIES = [c.raw for c in SILVER.values()]
HEADER = "doctor_id,Name,specialization,phone,email\n"


def landed(spark, tmp_path, text, name="doctors.csv"):
    (tmp_path / "raw").mkdir(exist_ok=True)
    (tmp_path / "raw" / name).write_text(HEADER + text)
    land_all(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), DAY, ENTITIES)


def config(tmp_path, silver=None, **more):
    return SilverConfig(str(tmp_path / "bronze"), silver or str(tmp_path / "silver"), DAY, ["doctors"], **more)


def test_malformed_rows_never_enter_silver(spark, tmp_path):
    landed(spark, tmp_path, "1,a,x,7,a@x\n2,b,x,7,b@x,surplus\n3,c\nfour,d,x,7,d@x\n")
    report = run_silver(spark, config(tmp_path), RUN).first()
    assert (report.status, report.rows, report.bad_rows, report.misfits) == ("ok", 2, 2, {"doctor_id": 1})
    stored = spark.read.parquet(str(tmp_path / "silver" / "doctors"))
    assert {r.doctor_name for r in stored.collect()} == {"a", "d"}
    apart = spark.read.parquet(quarantine_target(str(tmp_path / "silver"), "doctors")).orderBy("record").collect()
    assert [(r.reason, r.record) for r in apart] == [("does not fit the header", "2,b,x,7,b@x,surplus"), ("does not fit the header", "3,c")]
    assert all(r.source_file.endswith("raw/doctors.csv") and r.ingested_at is not None for r in apart)


def test_rows_without_a_key_on_request(spark, tmp_path):
    landed(spark, tmp_path, "1,a,x,7,a@x\nfour,d,x,7,d@x\n,e,,,\n5,f,x,7,f@x,more\n")
    for replace in (False, True):
        report = run_silver(spark, config(tmp_path, keyed=True, replace=replace), RUN).first()
        assert (report.rows, report.bad_rows, report.misfits) == (1, 3, {})
    apart = spark.read.parquet(quarantine_target(str(tmp_path / "silver"), "doctors"))
    assert apart.count() == 3  # the second run replaced the load day
    assert apart.where("reason = 'key missing or unreadable'").count() == 2
    assert '"Name":"d"' in apart.where("record LIKE '%four%'").first().record


def test_too_many_bad_rows_fail_the_load(spark, tmp_path):
    landed(spark, tmp_path, "1,a,x,7,a@x\n2,b,x,7,b@x,surplus\n3,c,x,7,c@x\n")
    assert run_silver(spark, config(tmp_path, max_bad_share=0.34), RUN).first().status == "ok"
    other = str(tmp_path / "other")
    with pytest.raises(RuntimeError, match="doctors: 1 of 3 rows are bad"):
        run_silver(spark, config(tmp_path, other, max_bad_share=0.33), RUN)
    assert not (tmp_path / "other" / "doctors").exists()
    assert spark.read.parquet(quarantine_target(other, "doctors")).count() == 1


def test_quarantine_in_a_database(spark, tmp_path):
    landed(spark, tmp_path, "1,a,x,7,a@x\n2,b,x,7,b@x,surplus\n")
    run_silver(spark, config(tmp_path, "silver_quarantine_test"), RUN)
    assert spark.table("silver_quarantine_test.doctors").count() == 1
    assert spark.table("silver_quarantine_test.quarantine_doctors").first().record == "2,b,x,7,b@x,surplus"


def test_packed_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with gzip.open(raw / "doctors_1.csv.gz", "wt") as f:
        f.write(HEADER + "1,a,x,7,a@x\n")
    (raw / "doctors_2.csv").write_text("email,doctor_id\nb@x,2\n")
    (raw / "scan.tar.gz").write_bytes(b"\x1f\x8b not text")
    found = {r.path.split("/")[-1]: (r.entity, r.format) for r in discover(spark, str(raw), ENTITIES).collect()}
    assert found == {"doctors_1.csv.gz": ("doctors", "csv"), "doctors_2.csv": ("doctors", "csv"), "scan.tar.gz": ("scan.tar", "gz")}
    report = {r.entity: (r.status, r.rows) for r in land_all(spark, str(raw), str(tmp_path / "bronze"), DAY, ENTITIES).collect()}
    assert report == {"doctors": ("ok", 2), "scan.tar": ("ok", 1)}
    rows = read_bronze(spark, str(tmp_path / "bronze"), "doctors").orderBy("doctor_id").collect()
    assert [(r.doctor_id, r.Name, r.email, r[SOURCE_FILE].split("/")[-1]) for r in rows] == [
        ("1", "a", "a@x", "doctors_1.csv.gz"), ("2", None, "b@x", "doctors_2.csv"),
    ]


def test_headers_are_found_in_one_query(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    odd = raw / "doctors a+b%20c é.csv"
    odd.write_text("email,doctor_id\nodd@x,0\n")
    for i in range(2000):
        header, row = (("doctor_id,email", f"{i},m@x"), ("email,doctor_id", f"m@x,{i}"))[i % 2]
        (raw / f"doctors_{i}.csv").write_text(f"{header}\n{row}\n")
    (raw / "doctors_empty.csv").write_text("")
    paths = [f"file:{p}" for p in sorted(raw.iterdir())]
    spark.sparkContext.setJobGroup("headers", "headers")
    groups, missing = header_groups(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs) <= 6
    assert sorted(len(g) for g in groups) == [1000, 1001] and [p.split("/")[-1] for p in missing] == ["doctors_empty.csv"]
    assert any(odd.name in p for g in groups for p in g)
    (report,) = land_all(spark, str(raw), str(tmp_path / "bronze"), DAY, ENTITIES).collect()
    assert (report.status, report.rows) == ("ok", 2001)  # an empty file is no file to Spark
    assert read_bronze(spark, str(tmp_path / "bronze"), "doctors").where("email = 'm@x'").count() == 2000


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    for name, header in (("a", "x,y"), ("b", "\ufeffx,y"), ("c", "y,x")):
        (tmp_path / f"{name}.csv").write_text(header + "\n" + "1,2\n" * 5000)
    paths = [str(tmp_path / f"{name}.csv") for name in "abc"]
    plan = _first_lines(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert header_groups(spark, paths) == ([paths[:2], paths[2:]], [])
