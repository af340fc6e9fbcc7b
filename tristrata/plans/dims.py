"""Type-1 and type-2 dimensions of the gold star."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions import nk_concat, sk, sk_concat, try_date
from tristrata.operators.calendar import FIRST_DAY, LAST_DAY, calendar
from tristrata.operators.combos import conformed_combinations, smallest_value_per_key
from tristrata.operators.conform import LOADED_AT, run_stamp
from tristrata.operators.history import version_dimension
from tristrata.operators.latest import latest_per_key
from tristrata.sources.bronze import INGEST_DT

# Attributes kept for patients and doctors, in stored order. They
# are also the columns whose change opens a new version.
PATIENT = (
    "patient_name", "patient_gender", "patient_dob",
    "patient_address", "patient_phone", "patient_email",
)
DOCTOR = ("doctor_name", "doctor_specialization", "doctor_phone", "doctor_email")

SOURCE_TIME = "src_updated_at"


def latest_rows(
    log: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_unkeyed: bool = False
) -> DataFrame:
    """Newest row per key of a silver log, reduced to the columns in use.

    Rows of one load share their load time; where the log carries the day of
    the raw file, it decides first, then the values themselves.
    """
    order = [LOADED_AT, *([INGEST_DT] if INGEST_DT in log.columns else [])]
    wanted = [*keys, *[c for c in columns if c not in (*keys, *order)], *order]
    return latest_per_key(log.select(*wanted), keys, order, keep_unkeyed=keep_unkeyed)


def dim_date(spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY) -> DataFrame:
    return calendar(spark, start, end)


def dim_patient(patient: DataFrame) -> DataFrame:
    """Newest row of every patient."""
    latest = latest_rows(patient, ["patient_id"], PATIENT)
    return latest.select(
        sk("patient_id").alias("patient_sk"),
        F.col("patient_id").alias("patient_nk"),
        *_patient_attributes(),
    )


def dim_doctor(doctors: DataFrame) -> DataFrame:
    """Newest row of every doctor."""
    latest = latest_rows(doctors, ["doctor_id"], DOCTOR)
    return latest.select(
        sk("doctor_id").alias("doctor_sk"), F.col("doctor_id").alias("doctor_nk"), *DOCTOR
    )


def dim_disease(diseases: DataFrame) -> DataFrame:
    """One row per disease with a name, if any row has one."""
    named = smallest_value_per_key(diseases, ["disease_id"], "disease_name")
    return named.select(
        sk("disease_id").alias("disease_sk"), F.col("disease_id").alias("disease_nk"), "disease_name"
    )


def _composite(rows: DataFrame, name: str, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return rows.select(
        sk_concat(*key).alias(f"{name}_sk"), nk_concat(*key).alias(f"{name}_nk"), *columns
    )


def dim_location(appointment: DataFrame, parity: bool = False) -> DataFrame:
    """Distinct places, identified by location and phone.

    ``parity`` keeps an empty and a missing text apart although they share a
    key, here and in the next two dimensions.
    """
    columns = ["location", "phone"]
    known = appointment.where(F.col("location").isNotNull() | F.col("phone").isNotNull())
    rows = conformed_combinations(known, columns, merge_blank=not parity)
    return _composite(rows, "location", columns, columns)


def dim_service(hospital_fee: DataFrame, parity: bool = False) -> DataFrame:
    """Distinct services, identified by type and description."""
    columns = ["service_type", "description"]
    rows = conformed_combinations(hospital_fee, columns, merge_blank=not parity)
    return _composite(rows, "service", columns, columns)


def dim_test(lab_results: DataFrame, parity: bool = False) -> DataFrame:
    """Distinct laboratory tests, identified by type, parameter and unit.

    The normal range is an attribute, not part of the key: one row per key with
    its smallest range, or with ``parity`` one row per range.
    """
    key = ["test_type", "parameter", "unit"]
    columns = [*key, "normal_range"]
    rows = conformed_combinations(lab_results, columns, merge_blank=not parity)
    if not parity:
        rows = smallest_value_per_key(rows, key, "normal_range")
    return _composite(rows, "test", key, columns)


def _patient_attributes() -> list[Column]:
    return [(try_date(c) if c == "patient_dob" else F.col(c)).alias(c) for c in PATIENT]


def _snapshot_source(
    log: DataFrame, key: str, tracked: Sequence[str], run_ts: datetime | Column
) -> DataFrame:
    latest = latest_rows(log, [key], tracked)
    loaded = F.coalesce(F.col(LOADED_AT).cast("timestamp"), run_stamp(run_ts).cast("timestamp"))
    return latest.select(key, *tracked, loaded.alias(SOURCE_TIME))


def patient_snapshot_source(patient: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """What a snapshot run compares: the newest row per patient."""
    return _snapshot_source(patient, "patient_id", PATIENT, run_ts)


def doctor_snapshot_source(doctors: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """What a snapshot run compares: the newest row per doctor."""
    return _snapshot_source(doctors, "doctor_id", DOCTOR, run_ts)


def dim_patient_scd2(history: DataFrame) -> DataFrame:
    """One row per version of a patient."""
    return version_dimension(
        history, "patient_id", "patient_sk", "patient_nk", _patient_attributes()
    )


def dim_doctor_scd2(history: DataFrame) -> DataFrame:
    """One row per version of a doctor."""
    return version_dimension(history, "doctor_id", "doctor_sk", "doctor_nk", list(DOCTOR))
