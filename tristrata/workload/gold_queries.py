"""Queries on keys, scalars, dimensions, facts, history and star joins."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata import functions as fx
from tristrata.operators import (
    as_of_join,
    calendar_covering,
    latest_per_key,
    measure_by_dimension,
    star_join,
)
from tristrata.operators.quality import key_collisions
from tristrata.plans import dims, facts
from tristrata.plans.incremental import FACTS, FactStore, record_changes
from tristrata.sources.history_store import read_history, record_snapshot
from tristrata.sources.sinks import append_silver
from tristrata.sources.workspace import fresh_folder
from tristrata.workload import duck, gold_sql
from tristrata.workload.registry import query
from tristrata.workload.views import LOAD_TIMES, silver, table, with_views


def session_time(spark: SparkSession, text: str) -> datetime:
    """A point in time given as text of the session's time zone."""
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return datetime.fromisoformat(text).replace(tzinfo=zone)


# --- scalars and keys -------------------------------------------------------


@query(
    "normalize_text",
    with_views(
        f"""SELECT location, phone, {duck.norm("location")} AS location_norm,
  {duck.norm("phone")} AS phone_norm, count(*) AS n FROM appointment GROUP BY location, phone""",
        "appointment",
    ),
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = silver(spark, sf_dir, "appointment").groupBy("location", "phone")
    return texts.agg(F.count(F.lit(1)).alias("n")).select(
        "*", fx.normalize("location").alias("location_norm"), fx.normalize("phone").alias("phone_norm")
    )


@query(
    "lab_numeric_value",
    with_views(
        f"SELECT lab_result_id, value, {duck.number('value')} AS numeric_value FROM lab_results",
        "lab_results",
    ),
)
def lab_numeric_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = silver(spark, sf_dir, "lab_results")
    return lab.select("lab_result_id", "value", fx.extract_number("value").alias("numeric_value"))


@query(
    "appointment_duration",
    with_views(
        f"""SELECT appointment_id, start_time, end_time,
  {duck.duration("appointment_date", "start_time", "end_time")} AS duration_min FROM appointment""",
        "appointment",
    ),
)
def appointment_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fx.try_date("appointment_date")
    return silver(spark, sf_dir, "appointment").select(
        "appointment_id",
        "start_time",
        "end_time",
        fx.duration_minutes(day, "start_time", "end_time").alias("duration_min"),
    )


_LOOSE_NUMBER = "CASE WHEN o_orderkey % 3 = 0 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' " \
    "WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS STRING) || '.9' ELSE 'x' || o_orderstatus END"
_LOOSE_DATE = "CASE WHEN o_orderkey % 4 = 0 THEN '2024-02-30' WHEN o_orderkey % 4 = 1 THEN 'soon' " \
    "ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END"  # fmt: skip


@query(
    "safe_casts",
    f"""SELECT o_orderkey, {duck.to_int("num")} AS as_int,
  CAST(try_cast(trim(num) AS FLOAT) AS DOUBLE) AS as_float,
  try_cast(trim(num) AS DOUBLE) AS as_double, CAST(o_orderkey AS VARCHAR) AS as_string,
  try_cast(day AS DATE) AS as_date
FROM (SELECT o_orderkey, {_LOOSE_NUMBER} AS num, {_LOOSE_DATE} AS day FROM orders)""",
)
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(_LOOSE_NUMBER).alias("num"), F.expr(_LOOSE_DATE).alias("day")
    )
    return loose.select(
        "o_orderkey",
        fx.safe_int("num").alias("as_int"),
        fx.safe_cast("num", "float").cast("double").alias("as_float"),
        fx.safe_cast("num", "double").alias("as_double"),
        fx.safe_cast("o_orderkey", "string").alias("as_string"),
        fx.try_date("day").alias("as_date"),
    )


@query(
    "sk_values",
    with_views(
        f"""SELECT appointment_id, {duck.sk("appointment_id")} AS appointment_sk,
  {duck.sk("doctor_id")} AS doctor_sk,
  CASE WHEN doctor_id IS NOT NULL THEN {duck.sk("doctor_id")} END AS doctor_sk_or_null,
  {duck.sk_concat("location", "phone")} AS raw_location_sk,
  {duck.nk("location", "phone")} AS raw_location_nk,
  {duck.sk_text("(CAST(patient_id AS VARCHAR) || '|' || CAST(ingested_at AS VARCHAR))")}
    AS version_sk,
  CAST(strftime({duck.to_date("appointment_date")}, '%Y%m%d') AS INT) AS date_key
FROM appointment""",
        "appointment",
    ),
)
def sk_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, "appointment").select(
        "appointment_id",
        fx.sk("appointment_id").alias("appointment_sk"),
        fx.sk("doctor_id").alias("doctor_sk"),
        fx.sk("doctor_id", null_key=False).alias("doctor_sk_or_null"),
        fx.sk_concat("location", "phone").alias("raw_location_sk"),
        fx.nk_concat("location", "phone").alias("raw_location_nk"),
        fx.sk_version("patient_id", "ingested_at").alias("version_sk"),
        fx.date_key(fx.try_date("appointment_date")).alias("date_key"),
    )


# --- dimensions -------------------------------------------------------------


@query("dim_date", gold_sql.DIM_DATE_COVERING)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return calendar_covering(orders, "day")


@query("dim_patient", with_views(gold_sql.DIM_PATIENT, "patient"))
def dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_patient(silver(spark, sf_dir, "patient"))


@query("dim_doctor", with_views(gold_sql.DIM_DOCTOR, "doctors"))
def dim_doctor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_doctor(silver(spark, sf_dir, "doctors"))


@query("dim_disease", with_views(gold_sql.DIM_DISEASE, "diseases"))
def dim_disease(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_disease(silver(spark, sf_dir, "diseases"))


@query("dim_location", with_views(gold_sql.dim_location(), "appointment"))
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(silver(spark, sf_dir, "appointment"))


@query("dim_location_parity", with_views(gold_sql.dim_location(parity=True), "appointment"))
def dim_location_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(silver(spark, sf_dir, "appointment"), parity=True)


@query("dim_service", with_views(gold_sql.dim_service(), "hospital_fee"))
def dim_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_service(silver(spark, sf_dir, "hospital_fee"))


@query("dim_test", with_views(gold_sql.dim_test(), "lab_results"))
def dim_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_test(silver(spark, sf_dir, "lab_results"))


@query("dim_test_parity", with_views(gold_sql.dim_test(parity=True), "lab_results"))
def dim_test_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_test(silver(spark, sf_dir, "lab_results"), parity=True)


@query(
    "latest_per_key_events",
    """SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def latest_per_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


# --- facts ------------------------------------------------------------------


@query("fact_appointments", with_views(gold_sql.fact_appointments(), "appointment"))
def fact_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_appointments(silver(spark, sf_dir, "appointment"))


@query(
    "fact_appointments_parity",
    with_views(gold_sql.fact_appointments(dedupe=False, parity=True), "appointment"),
)
def fact_appointments_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    appointment = silver(spark, sf_dir, "appointment")
    return facts.fact_appointments(appointment, dedupe=False, parity=True)


@query("fact_billing", with_views(gold_sql.fact_billing(), "hospital_fee"))
def fact_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_billing(silver(spark, sf_dir, "hospital_fee"))


@query("fact_billing_parity", with_views(gold_sql.fact_billing(dedupe=False), "hospital_fee"))
def fact_billing_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_billing(silver(spark, sf_dir, "hospital_fee"), dedupe=False)


@query("fact_lab_results", with_views(gold_sql.fact_lab_results(), "lab_results"))
def fact_lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_lab_results(silver(spark, sf_dir, "lab_results"))


@query("fact_treatments", with_views(gold_sql.fact_treatments(), "treatments"))
def fact_treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_treatments(silver(spark, sf_dir, "treatments"))


@query("fact_vitals", with_views(gold_sql.fact_vitals(), "vital_signs"))
def fact_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_vitals(silver(spark, sf_dir, "vital_signs"))


# --- star joins and reports -------------------------------------------------


@query(
    "star_billing_by_service",
    with_views(
        f""", fees AS (SELECT *, {duck.norm("service_type")} AS st, {duck.norm("description")} AS d
  FROM {duck.latest("hospital_fee", "fee_id",
      ["appointment_id", "patient_id", "fee_date", "amount", "service_type", "description"])})
SELECT st AS service_type, d AS description, count(*) AS fees,
  CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM fees GROUP BY st, d""",
        "hospital_fee",
    ),
)
def star_billing_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    fees = silver(spark, sf_dir, "hospital_fee")
    revenue = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return measure_by_dimension(
        facts.fact_billing(fees),
        dims.dim_service(fees),
        "service_sk",
        {"fees": F.count(F.lit(1)), "revenue": revenue},
        ["service_type", "description"],
    )


@query(
    "star_sk_equals_nk",
    with_views(
        f"""SELECT p.patient_id AS patient_nk, count(*) AS n
FROM {duck.latest("appointment", "appointment_id", [])} a
JOIN (SELECT DISTINCT patient_id FROM patient) p USING (patient_id) GROUP BY p.patient_id""",
        "appointment",
        "patient",
    ),
)
def star_sk_equals_nk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_by_dimension(
        facts.fact_appointments(silver(spark, sf_dir, "appointment")),
        dims.dim_patient(silver(spark, sf_dir, "patient")),
        "patient_sk",
        {"n": F.count(F.lit(1))},
        ["patient_nk"],
    )


@query(
    "star_appointments_enriched",
    with_views(
        f""", place AS (SELECT DISTINCT {duck.tidy("location")} AS location,
    {duck.tidy("phone")} AS phone
  FROM appointment WHERE location IS NOT NULL OR phone IS NOT NULL)
SELECT {duck.sk("a.appointment_id")} AS appointment_sk, p.location, p.phone
FROM appointment a LEFT JOIN place p
  ON {duck.nk(duck.norm("a.location"), duck.norm("a.phone"))} = {duck.nk("p.location", "p.phone")}""",
        "appointment",
    ),
)
def star_appointments_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    appointment = silver(spark, sf_dir, "appointment")
    fact = facts.fact_appointments(appointment).select("appointment_sk", "location_sk")
    placed = star_join(fact, dims.dim_location(appointment), "location_sk", "left")
    return placed.select("appointment_sk", "location", "phone")


@query(
    "star_appointments_by_weekday",
    with_views(
        f""", days AS (SELECT {duck.to_date("appointment_date")} AS d,
    {duck.duration("appointment_date", "start_time", "end_time")} AS m FROM appointment)
SELECT CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  count(*) AS appointments, CAST(sum(m) AS BIGINT) AS minutes
FROM days WHERE d IS NOT NULL GROUP BY ALL""",
        "appointment",
    ),
)
def star_appointments_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.fact_appointments(silver(spark, sf_dir, "appointment"))
    fact = fact.select(F.col("appointment_date").alias("date"), "duration_min")
    per_day = measure_by_dimension(
        fact,
        calendar_covering(fact, "date"),
        "date",
        {"n": F.count(F.lit(1)), "m": F.sum("duration_min")},
        ["day_of_week", "is_weekend"],
    )
    return per_day.groupBy("day_of_week", "is_weekend").agg(
        F.sum("n").alias("appointments"), F.sum("m").alias("minutes")
    )


@query(
    "status_counts",
    with_views("SELECT status, count(*) AS n FROM appointment GROUP BY status", "appointment"),
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir, "appointment")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# --- history ----------------------------------------------------------------


def patient_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored history after a snapshot run at each of the three loads."""
    return _history(spark, sf_dir, "patient", LOAD_TIMES)


def doctor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored history after a snapshot run at each of the two loads."""
    return _history(spark, sf_dir, "doctors", LOAD_TIMES[:2])


def _history(spark: SparkSession, sf_dir: str, name: str, loads: tuple[str, ...]) -> DataFrame:
    log = silver(spark, sf_dir, name)
    base = fresh_folder(spark, f"{name}-history")
    if name == "patient":
        source, key, tracked = dims.patient_snapshot_source, "patient_id", dims.PATIENT
    else:
        source, key, tracked = dims.doctor_snapshot_source, "doctor_id", dims.DOCTOR
    for text in loads:
        run_ts = session_time(spark, text)
        known = log.where(F.col("ingested_at") <= F.lit(run_ts))
        record_snapshot(
            source(known, run_ts), base, [key], tracked, run_ts, carried=[dims.SOURCE_TIME]
        )
    return read_history(spark, base)


def _times_as_text(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def _snapshot_sql(key: str, tracked: list[str], versions: str) -> str:
    times = ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in ("src_updated_at", "valid_from", "valid_to")
    )
    return f"SELECT {key}, {', '.join(tracked)}, {times} FROM {versions}"


# The carried load time is that of the row that opened the version.
@query(
    "scd2_snapshot_patient",
    with_views(
        _snapshot_sql("patient_id", gold_sql.PATIENT, gold_sql.PATIENT_VERSIONS), "patient"
    ),
)
def scd2_snapshot_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_as_text(patient_history(spark, sf_dir))


@query(
    "scd2_snapshot_doctor",
    with_views(_snapshot_sql("doctor_id", gold_sql.DOCTOR, gold_sql.DOCTOR_VERSIONS), "doctors"),
)
def scd2_snapshot_doctor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_as_text(doctor_history(spark, sf_dir))


@query("dim_patient_scd2", with_views(gold_sql.DIM_PATIENT_SCD2, "patient"))
def dim_patient_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_as_text(dims.dim_patient_scd2(patient_history(spark, sf_dir)))


@query("dim_doctor_scd2", with_views(gold_sql.DIM_DOCTOR_SCD2, "doctors"))
def dim_doctor_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_as_text(dims.dim_doctor_scd2(doctor_history(spark, sf_dir)))


@query(
    "asof_scd2",
    with_views(
        f"""SELECT v.vital_id, v.patient_id, v.measurement_date, p.patient_address, p.patient_email,
  CAST(p.valid_from AS VARCHAR) AS version_from
FROM vital_signs v LEFT JOIN {gold_sql.PATIENT_VERSIONS} p
  ON v.patient_id = p.patient_id AND p.valid_from <= v.ingested_at
  AND (v.ingested_at < p.valid_to OR p.valid_to IS NULL)""",
        "vital_signs",
        "patient",
    ),
)
def asof_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = patient_history(spark, sf_dir).withColumn(
        "version_from", F.col("valid_from").cast("string")
    )
    vitals = silver(spark, sf_dir, "vital_signs")
    return as_of_join(
        vitals.select("vital_id", "patient_id", "measurement_date", "ingested_at"),
        versions,
        "patient_id",
        "patient_id",
        F.col("ingested_at"),
        ["patient_address", "patient_email", "version_from"],
    ).drop("ingested_at")


@query(
    "scd2_incremental",
    with_views(_snapshot_sql("patient_id", gold_sql.PATIENT, gold_sql.PATIENT_VERSIONS), "patient"),
)
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history from a silver log that grows by a load before each run, of which a run reads the new day."""
    folder = fresh_folder(spark, "scd2-incremental")
    patient = silver(spark, sf_dir, "patient")
    for text in LOAD_TIMES:
        run_ts = session_time(spark, text)
        append_silver(patient.where(F.col("ingested_at") == F.lit(run_ts)), f"{folder}/patient")
        record_changes(
            spark.read.parquet(f"{folder}/patient"), f"{folder}/history", dims.patient_snapshot_source,
            ["patient_id"], dims.PATIENT, run_ts, [dims.SOURCE_TIME],
        )
    return _times_as_text(read_history(spark, f"{folder}/history"))


# Loads of whole years, so that a silver log has few load days.
_YEARLY = "date_trunc('year', ingested_at)"


@query(
    "gold_incremental",
    with_views(
        f""", yearly AS (SELECT * REPLACE ({_YEARLY} AS ingested_at) FROM hospital_fee)
{gold_sql.fact_billing().replace("hospital_fee", "yearly")}""",
        "hospital_fee",
    ),
)
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact kept up to date over three runs, each of which merges the load days that came since the one before."""
    folder = fresh_folder(spark, "gold-incremental")
    store = FactStore(spark, f"{folder}/gold", replace(FACTS["fact_billing"], period="yyyy"))
    fees = silver(spark, sf_dir, "hospital_fee").withColumn("ingested_at", F.expr(_YEARLY).cast("timestamp"))
    first = None
    for last in ("1997-06-01", "1999-06-01", "2999-01-01"):
        some = fees.where(F.col("ingested_at") < F.lit(last).cast("timestamp"))
        append_silver(some if first is None else some.where(F.col("ingested_at") >= F.lit(first).cast("timestamp")), f"{folder}/log")
        store.update(spark.read.parquet(f"{folder}/log"))
        first = last
    return store.read()


# Patients whose number ends in 00 get the key of the patient after them.
_CLASH = "CASE WHEN patient_id % 100 = 0 THEN patient_id + 1 ELSE patient_id END"


@query(
    "key_collisions",
    with_views(
        f""", keyed AS (SELECT {_CLASH} AS key, patient_id, patient_name FROM patient)
SELECT key, count(DISTINCT (patient_id, patient_name)) AS natural_keys, count(*) AS n_records
FROM keyed GROUP BY key HAVING count(DISTINCT (patient_id, patient_name)) > 1""",
        "patient",
    ),
)
def key_collisions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted collisions are found: two patients that share a key."""
    patient = silver(spark, sf_dir, "patient").withColumn("key", F.expr(_CLASH))
    return key_collisions(patient, "key", ["patient_id", "patient_name"])
