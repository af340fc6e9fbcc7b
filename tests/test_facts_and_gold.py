from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tristrata.operators.quality import ChecksFailed
from tristrata.plans import dims, facts
from tristrata.plans.contracts import SILVER
from tristrata.plans.gold import BUILDERS, GoldConfig, run_gold
from tristrata.sources import Builds, Tables
from tristrata.sources.history_store import run_id
from tristrata.workload.views import silver


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


FACTS = [
    (facts.fact_appointments, "appointment"),
    (facts.fact_billing, "hospital_fee"),
    (facts.fact_lab_results, "lab_results"),
    (facts.fact_treatments, "treatments"),
    (facts.fact_vitals, "vital_signs"),
]


@pytest.mark.parametrize(("build", "view"), FACTS)
def test_facts_shuffle_once_or_not_at_all(spark, sf_dir, tmp_path, build, view):
    silver(spark, sf_dir, view).write.parquet(str(tmp_path / view))
    log = spark.read.parquet(str(tmp_path / view))
    every_row = build(log, dedupe=False)
    assert "Exchange" not in plan(every_row)
    assert every_row.count() == log.count()
    deduped = plan(build(log))
    assert deduped.count("Exchange") == 1
    # the scan for rows without a key stops at the file statistics
    assert f"IsNull({SILVER[view].keys[0]})" in deduped


def test_rows_without_id_are_kept(spark, sf_dir):
    fees = silver(spark, sf_dir, "hospital_fee")
    unkeyed = fees.limit(5).withColumn("fee_id", F.lit(None).cast("string"))
    built = facts.fact_billing(fees.unionByName(unkeyed).unionByName(unkeyed))
    assert built.where("fee_id is null").count() == 10
    assert built.count() == fees.select("fee_id").distinct().count() + 10


def test_repeated_loads_do_not_multiply_facts(spark, sf_dir):
    fees = silver(spark, sf_dir, "hospital_fee")
    once = facts.fact_billing(fees)
    twice = facts.fact_billing(fees.unionByName(fees.withColumn("ingested_at", F.col("ingested_at"))))
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_location_key_reaches_its_dimension(spark, sf_dir):
    appointment = silver(spark, sf_dir, "appointment")
    located = appointment.where("location is not null or phone is not null")
    dim = dims.dim_location(appointment)
    fixed = facts.fact_appointments(located)
    assert fixed.join(dim, "location_sk", "left_anti").count() == 0
    raw = facts.fact_appointments(located, parity=True)
    assert raw.join(dim, "location_sk", "left_anti").count() > 0
    assert dim.count() == dim.select("location_sk").distinct().count()
    apart = dims.dim_location(appointment, parity=True)
    assert apart.count() > apart.select("location_sk").distinct().count()


def test_every_key_of_the_other_facts_has_a_row(spark, sf_dir):
    fees, lab = silver(spark, sf_dir, "hospital_fee"), silver(spark, sf_dir, "lab_results")
    for fact, dim, key in (
        (facts.fact_billing(fees), dims.dim_service(fees), "service_sk"),
        (facts.fact_lab_results(lab), dims.dim_test(lab), "test_sk"),
    ):
        assert fact.join(dim, key, "left_anti").count() == 0


def store(spark, sf_dir, place, **changed):
    tables = Tables(spark, place)
    for name in SILVER:
        tables.publish(changed.get(name, silver(spark, sf_dir, name)), name)


def run_ts(day):
    return datetime(2024, 1, day, 6, tzinfo=timezone.utc)


def test_gold_run_twice(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    patient = silver(spark, sf_dir, "patient")
    store(spark, sf_dir, f"{base}/silver", patient=patient.where("ingested_at < '2024-01-03'"))
    cfg = GoldConfig(f"{base}/silver", f"{base}/gold", f"{base}/snapshots")
    first, report = run_gold(spark, cfg, run_ts(2))
    assert report.count() == 36 and report.where("not passed").isEmpty()
    n = first.ref("dim_patient").count()
    assert first.ref("dim_patient_scd2").count() == n

    Tables(spark, f"{base}/silver").publish(patient, "patient")
    second, _ = run_gold(spark, cfg, run_ts(3))
    versions = second.ref("dim_patient_scd2")
    assert versions.where("is_current").count() == n
    assert versions.where("not is_current").count() > 0
    # the earlier build is still there
    assert first.ref("dim_patient_scd2").count() == n
    assert set(BUILDERS) == {t for t in BUILDERS if second.ref(t).count() > 0}


def test_gold_run_fails_on_bad_data(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    nameless = silver(spark, sf_dir, "vital_signs").withColumn("vital_id", F.lit(None).cast("int"))
    store(spark, sf_dir, f"{base}/silver", vital_signs=nameless)
    cfg = GoldConfig(f"{base}/silver", f"{base}/gold", f"{base}/snapshots")
    with pytest.raises(ChecksFailed, match="fact_vitals.vital_id not_null"):
        run_gold(spark, cfg, run_ts(2))
    stored = spark.read.parquet(*map(str, tmp_path.glob("gold/build=*/check_report")))
    assert stored.where("NOT passed").count() > 0


def test_gold_run_into_a_database(spark, sf_dir, tmp_path):
    store(spark, sf_dir, "silver_db_test")
    cfg = GoldConfig("silver_db_test", "gold_db_test", str(tmp_path / "snapshots"), tables=SMALL)
    gold, _ = run_gold(spark, cfg, run_ts(4))
    counts = spark.sql("SELECT status, count(*) AS n FROM gold_db_test.fact_appointments GROUP BY 1")
    assert counts.agg(F.sum("n")).first()[0] == gold.ref("fact_appointments").count()


SMALL = ("dim_patient", "fact_appointments")


def test_a_failing_check_leaves_the_last_good_build_visible(spark, sf_dir, tmp_path):
    store(spark, sf_dir, "silver_switch_test")
    silver_tables = Tables(spark, "silver_switch_test")
    patient = silver(spark, sf_dir, "patient")
    cfg = GoldConfig("silver_switch_test", "gold_switch_test", str(tmp_path / "snapshots"), tables=SMALL)
    builds = Builds(spark, "gold_switch_test")
    with pytest.raises(ValueError, match="no good build"):
        builds.tables()

    def shown():
        return sorted(map(tuple, spark.table("gold_switch_test.dim_patient").collect()))

    silver_tables.publish(patient.where("ingested_at < '2024-01-02'"), "patient")
    first, _ = run_gold(spark, cfg, run_ts(1))
    before = shown()
    nobody = patient.limit(1).withColumn("patient_id", F.lit(None).cast("int"))
    silver_tables.publish(patient.unionByName(nobody), "patient")
    with pytest.raises(ChecksFailed, match="dim_patient.patient_nk not_null"):
        run_gold(spark, cfg, run_ts(2))
    assert shown() == before and builds.newest_good() == run_id(run_ts(1))
    assert builds.open(run_id(run_ts(2))).ref("check_report").where("NOT passed").count() > 0

    silver_tables.publish(patient, "patient")
    run_gold(spark, cfg, run_ts(2))  # the same run again, with mended data
    assert shown() != before and builds.newest_good() == run_id(run_ts(2))
    # readers of the old build keep it until it expires
    assert sorted(map(tuple, first.ref("dim_patient").collect())) == before
    run_gold(spark, cfg, run_ts(3))
    assert builds.expire([*SMALL, "check_report"], keep=2) == [run_id(run_ts(1))]
    assert not spark.catalog.tableExists(first.target("dim_patient"))
    assert builds.tables().ref("dim_patient").count() == spark.table("gold_switch_test.dim_patient").count()


def test_a_table_in_the_way_of_a_view(spark, tmp_path):
    builds = Builds(spark, "gold_view_test")
    builds.publish(spark.range(3), "b1", "t")
    spark.range(1).write.saveAsTable("gold_view_test.t")
    with pytest.raises(ValueError, match="is a table, not a view"):
        builds.switch("b1", ["t"])


def test_builds_in_a_folder(spark, tmp_path):
    builds = Builds(spark, str(tmp_path / "gold"))
    for build, rows, failures in (("b1", 1, 0), ("b2", 2, 0), ("b3", 3, 1)):
        builds.publish(spark.range(rows), build, "t")
        builds.record(build, failures)
        builds.switch(build, ["t"])
    assert builds.newest_good() == "b2" and builds.tables().ref("t").count() == 2
    assert builds.expire(["t"], keep=1) == ["b1"] and builds.tables().ref("t").count() == 2
