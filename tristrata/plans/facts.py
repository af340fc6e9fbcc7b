"""Facts of the gold star.

A fact keeps the newest row per business key of its silver log
(``dedupe=True``): one shuffle; rows without a key are all kept. With ``dedupe=False`` every row of the log is
kept and the build is a single projection without a shuffle. Foreign keys are
hashes of the row's own columns, so no dimension is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.functions import duration_minutes, extract_number, normalize, sk, sk_concat, try_date
from tristrata.plans.dims import latest_rows


def _rows(log: DataFrame, key: str, columns: Sequence[str], dedupe: bool) -> DataFrame:
    return latest_rows(log, [key], columns, keep_unkeyed=True) if dedupe else log


def fact_appointments(
    appointment: DataFrame, dedupe: bool = True, parity: bool = False
) -> DataFrame:
    """Appointments with their duration in minutes.

    The location key is made from the normalised texts, as in the dimension;
    ``parity`` hashes the raw texts instead, which miss it.
    """
    used = [
        "patient_id", "doctor_id", "appointment_date", "start_time", "end_time",
        "status", "appointment_type", "reason", "location", "phone",
    ]
    place = ["location", "phone"] if parity else [normalize("location"), normalize("phone")]
    day = try_date("appointment_date")
    return _rows(appointment, "appointment_id", used, dedupe).select(
        sk("appointment_id").alias("appointment_sk"),
        sk("patient_id").alias("patient_sk"),
        sk("doctor_id").alias("doctor_sk"),
        day.alias("appointment_date"),
        duration_minutes(day, "start_time", "end_time").alias("duration_min"),
        "status",
        "appointment_type",
        "reason",
        sk_concat(*place).alias("location_sk"),
    )


def fact_billing(hospital_fee: DataFrame, dedupe: bool = True) -> DataFrame:
    """Fees with the service they were charged for."""
    used = ["appointment_id", "patient_id", "fee_date", "amount", "service_type", "description"]
    return _rows(hospital_fee, "fee_id", used, dedupe).select(
        "fee_id",
        sk("appointment_id").alias("appointment_sk"),
        sk("patient_id").alias("patient_sk"),
        try_date("fee_date").alias("fee_date"),
        "amount",
        sk_concat(normalize("service_type"), normalize("description")).alias("service_sk"),
    )


def fact_lab_results(lab_results: DataFrame, dedupe: bool = True) -> DataFrame:
    """Laboratory results with the number contained in their text."""
    used = [
        "appointment_id", "patient_id", "test_date", "test_type", "parameter", "unit",
        "value", "interpretation",
    ]
    test = [normalize("test_type"), normalize("parameter"), normalize("unit")]
    return _rows(lab_results, "lab_result_id", used, dedupe).select(
        "lab_result_id",
        sk("appointment_id").alias("appointment_sk"),
        sk("patient_id").alias("patient_sk"),
        try_date("test_date").alias("test_date"),
        sk_concat(*test).alias("test_sk"),
        extract_number("value").alias("numeric_value"),
        "interpretation",
    )


def fact_treatments(treatments: DataFrame, dedupe: bool = True) -> DataFrame:
    """Treatments, each counting one."""
    used = ["patient_id", "doctor_id", "disease_id", "treatment_date"]
    return _rows(treatments, "treatment_id", used, dedupe).select(
        "treatment_id",
        sk("patient_id").alias("patient_sk"),
        sk("doctor_id").alias("doctor_sk"),
        sk("disease_id").alias("disease_sk"),
        try_date("treatment_date").alias("treatment_date"),
        F.lit(1).alias("treatment_cnt"),
    )


def fact_vitals(vital_signs: DataFrame, dedupe: bool = True) -> DataFrame:
    """Vital signs."""
    measures = [
        "blood_pressure", "heart_rate", "respiratory_rate",
        "temperature", "oxygen_saturation", "blood_sugar",
    ]
    used = ["patient_id", "measurement_date", *measures]
    return _rows(vital_signs, "vital_id", used, dedupe).select(
        "vital_id",
        sk("patient_id").alias("patient_sk"),
        try_date("measurement_date").alias("measurement_date"),
        *measures,
    )
