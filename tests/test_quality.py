from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tristrata.operators.quality import (
    Check,
    ChecksFailed,
    accepted_values,
    freshness,
    key_collisions,
    not_null,
    relationships,
    require_passed,
    run_checks,
    unique,
)
from tristrata.plans.checks import GOLD_CHECKS
from tristrata.plans.contracts import SILVER
from tristrata.plans.gold import BUILDERS, tables_to_check
from tristrata.sources import Tables
from tristrata.workload.table_queries import dq_report
from tristrata.workload.views import silver


@pytest.fixture(scope="module")
def child(spark):
    rows = [(1, "a", 10), (1, "b", 10), (2, "a", None), (None, "c", 99), (None, None, 99), (3, "z", 10)]
    return spark.createDataFrame(rows, "id int, kind string, parent int")


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(10,), (11,)], "pk int")


def test_single_checks(child, parent):
    assert {tuple(r) for r in not_null(child, ["id", "kind"]).collect()} == {("id", 2), ("kind", 1)}
    assert [tuple(r) for r in unique(child, ["id"]).collect()] == [(1, 2)]
    assert unique(child, ["id", "kind"]).count() == 0
    assert [tuple(r) for r in accepted_values(child, "kind", ["a", "b", "c"]).collect()] == [("z", 1)]
    assert [tuple(r) for r in relationships(child, "parent", parent, "pk").collect()] == [(99, 2)]


def test_report_finds_seeded_faults(child, parent):
    checks = [
        Check("child", "id", "not_null"),
        Check("child", "kind", "not_null"),
        Check("child", "id", "unique"),
        Check("child", "kind", "unique"),
        Check("child", "kind", "accepted_values", values=("a", "b", "c")),
        Check("child", "parent", "relationships", parent=("parent", "pk")),
        Check("parent", "pk", "not_null"),
        Check("parent", "pk", "unique"),
    ]
    report = run_checks({"child": child, "parent": parent}, checks)
    assert report.columns == ["table", "column", "check", "failures", "passed"]
    found = {(r["table"], r["column"], r["check"]): (r.failures, r.passed) for r in report.collect()}
    assert found == {
        ("child", "id", "not_null"): (2, False),
        ("child", "kind", "not_null"): (1, False),
        ("child", "id", "unique"): (1, False),
        ("child", "kind", "unique"): (1, False),
        ("child", "kind", "accepted_values"): (1, False),
        ("child", "parent", "relationships"): (2, False),
        ("parent", "pk", "not_null"): (0, True),
        ("parent", "pk", "unique"): (0, True),
    }
    with pytest.raises(ChecksFailed, match="child.parent relationships: 2"):
        require_passed(report)
    require_passed(report.where("passed"))


def test_checks_of_an_empty_table_pass(child):
    checks = [Check("t", "id", "not_null"), Check("t", "id", "unique"), Check("t", "kind", "not_null")]
    report = run_checks({"t": child.where("false")}, checks)
    assert {(r.column, r.check, r.failures) for r in report.collect()} == {
        ("id", "not_null", 0),
        ("id", "unique", 0),
        ("kind", "not_null", 0),
    }


def test_one_scan_serves_all_checks_of_a_table(spark, child, tmp_path):
    child.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    checks = [Check("t", "id", "not_null"), Check("t", "kind", "not_null"), Check("t", "id", "unique")]
    text = run_checks({"t": stored}, checks)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_hot_foreign_key_is_counted_before_the_join(spark, parent):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 77).otherwise(10).alias("fk"))
    orphans = relationships(facts, "fk", parent, "pk")
    assert [tuple(r) for r in orphans.collect()] == [(77, 20_000)]
    text = orphans._jdf.queryExecution().executedPlan().toString()
    assert text.index("LeftAnti") < text.index("HashAggregate")


@pytest.mark.parametrize(
    ("hours", "status"), [(1, "pass"), (30, "warn"), (60, "error")]
)
def test_freshness(spark, hours, status):
    newest = datetime(2024, 1, 3, 6)
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (newest,), (None,)], "t timestamp")
    age = freshness(df, "t", newest + timedelta(hours=hours), timedelta(days=1), timedelta(days=2))
    row = age.first()
    assert (row.max_loaded_at, row.age_seconds, row.status) == (newest, hours * 3600, status)


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert freshness(df, "t", datetime(2024, 1, 1)).first().status == "error"


def test_declared_checks():
    kinds = [c.kind for c in GOLD_CHECKS]
    assert (kinds.count("not_null"), kinds.count("unique"), len(kinds)) == (24, 12, 36)
    assert len({c.table for c in GOLD_CHECKS}) == 14


def test_key_collisions(spark):
    rows = [(1, "a", None), (1, "a", None), (1, "a", ""), (2, "b", "c"), (2, "b", "c"), (3, "b|c", "d"), (3, "b", "c|d"), (None, "x", "y"), (None, "z", "y")]
    df = spark.createDataFrame(rows * 3, "sk long, a string, b string")
    found = {r.key: (r.natural_keys, r.n_records) for r in key_collisions(df, "sk", ["a", "b"]).collect()}
    assert found == {1: (2, 9), 3: (2, 6)}
    assert key_collisions(df.limit(0), "sk", ["a", "b"]).count() == 0


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Tables whose keys repeat with other values, or are missing."""
    folder = str(tmp_path_factory.mktemp("odd"))
    day = "timestamp'2024-01-0{} 10:00:00'"
    rows = {
        "customer": "SELECT id AS c_custkey, concat('n', d) AS c_name, 'seg' AS c_mktsegment",
        "supplier": "SELECT id AS s_suppkey, concat('n', d) AS s_name, 1 AS s_nationkey",
        "part": "SELECT coalesce(id, 3) AS p_partkey",
        "orders": "SELECT id AS o_orderkey, d AS o_custkey, t AS o_orderdate, 'p' AS o_orderpriority, 'O' AS o_orderstatus",
        "lineitem": "SELECT id AS l_orderkey, 1 AS l_linenumber, d AS l_partkey, d AS l_suppkey, 1.0D * d AS l_extendedprice, 2.0D AS l_quantity, 0.0D AS l_tax, 'A' AS l_returnflag, 'O' AS l_linestatus, t AS l_shipdate",
        "events": "SELECT id AS event_id, d AS user_id, t AS ts, 1.0D * d AS value",
    }
    for name, text in rows.items():
        source = f"(SELECT CASE WHEN id < 20 THEN id % 15 + 1 END AS id, id AS d, CASE WHEN id < 18 THEN {day.format(1)} ELSE {day.format(2)} END AS t FROM range(24))"
        spark.sql(f"{text} FROM {source}").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_the_report_ranks_no_rows_of_which_it_reads_the_keys(spark, odd_tables):
    plan = dq_report(spark, odd_tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # the smallest name of a disease, the smallest range of a test


def test_the_report_on_keys_is_the_report_on_whole_tables(spark, odd_tables):
    given = {name: silver(spark, odd_tables, name) for name in SILVER}
    for name, log in (("patient_snapshot", "patient"), ("doctor_snapshot", "doctors")):
        given[name] = given[log].withColumns({"valid_from": F.col("ingested_at"), "valid_to": F.lit(None).cast("timestamp")})
    tables = Tables(spark, given=given)
    whole = run_checks({name: build(spark, tables) for name, build in BUILDERS.items()}, GOLD_CHECKS)
    found = {tuple(r) for r in run_checks(tables_to_check(spark, tables), GOLD_CHECKS).collect()}
    assert found == {tuple(r) for r in whole.collect()}
    assert {("fact_billing", "fee_id", "not_null", 4, False), ("fact_billing", "fee_id", "unique", 0, True)} <= found
    assert {("dim_patient", "patient_nk", "not_null", 0, True), ("fact_appointments", "appointment_sk", "unique", 1, False)} <= found
    # a check of another column reads the whole table
    other = Check("fact_billing", "appointment_sk", "not_null")
    assert "appointment_sk" in tables_to_check(spark, tables, [*GOLD_CHECKS, other])["fact_billing"].columns
