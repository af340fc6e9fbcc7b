"""DuckDB text of every gold table over the silver views."""

from __future__ import annotations

from tristrata.workload import duck
from tristrata.workload.views import LOAD_TIMES

_LATEST_PATIENT = duck.latest(
    "patient",
    "patient_id",
    ["patient_name", "patient_gender", "patient_dob", "patient_address", "patient_phone",
     "patient_email"],
)
_LATEST_DOCTOR = duck.latest(
    "doctors", "doctor_id", ["doctor_name", "doctor_specialization", "doctor_phone", "doctor_email"]
)


def _source(view: str, key: str, columns: list[str], dedupe: bool) -> str:
    return duck.latest(view, key, columns) if dedupe else view


def fact_appointments(dedupe: bool = True, parity: bool = False) -> str:
    used = ["patient_id", "doctor_id", "appointment_date", "start_time", "end_time", "status",
            "appointment_type", "reason", "location", "phone"]
    place = (
        duck.sk_concat("location", "phone")
        if parity
        else duck.sk_concat(duck.norm("location"), duck.norm("phone"))
    )
    return f"""
SELECT {duck.sk("appointment_id")} AS appointment_sk, {duck.sk("patient_id")} AS patient_sk,
  {duck.sk("doctor_id")} AS doctor_sk, {duck.to_date("appointment_date")} AS appointment_date,
  {duck.duration("appointment_date", "start_time", "end_time")} AS duration_min, status,
  appointment_type, reason, {place} AS location_sk
FROM {_source("appointment", "appointment_id", used, dedupe)}"""


def fact_billing(dedupe: bool = True) -> str:
    used = ["appointment_id", "patient_id", "fee_date", "amount", "service_type", "description"]
    return f"""
SELECT fee_id, {duck.sk("appointment_id")} AS appointment_sk, {duck.sk("patient_id")} AS patient_sk,
  {duck.to_date("fee_date")} AS fee_date, amount,
  {duck.sk_concat(duck.norm("service_type"), duck.norm("description"))} AS service_sk
FROM {_source("hospital_fee", "fee_id", used, dedupe)}"""


def fact_lab_results(dedupe: bool = True) -> str:
    used = ["appointment_id", "patient_id", "test_date", "test_type", "parameter", "unit", "value",
            "interpretation"]
    test = duck.sk_concat(duck.norm("test_type"), duck.norm("parameter"), duck.norm("unit"))
    return f"""
SELECT lab_result_id, {duck.sk("appointment_id")} AS appointment_sk,
  {duck.sk("patient_id")} AS patient_sk, {duck.to_date("test_date")} AS test_date,
  {test} AS test_sk, {duck.number("value")} AS numeric_value, interpretation
FROM {_source("lab_results", "lab_result_id", used, dedupe)}"""


def fact_treatments(dedupe: bool = True) -> str:
    used = ["patient_id", "doctor_id", "disease_id", "treatment_date"]
    return f"""
SELECT treatment_id, {duck.sk("patient_id")} AS patient_sk, {duck.sk("doctor_id")} AS doctor_sk,
  {duck.sk("disease_id")} AS disease_sk, {duck.to_date("treatment_date")} AS treatment_date,
  CAST(1 AS INT) AS treatment_cnt
FROM {_source("treatments", "treatment_id", used, dedupe)}"""


def fact_vitals(dedupe: bool = True) -> str:
    measures = ["blood_pressure", "heart_rate", "respiratory_rate", "temperature",
                "oxygen_saturation", "blood_sugar"]
    used = ["patient_id", "measurement_date", *measures]
    return f"""
SELECT vital_id, {duck.sk("patient_id")} AS patient_sk,
  {duck.to_date("measurement_date")} AS measurement_date, {", ".join(measures)}
FROM {_source("vital_signs", "vital_id", used, dedupe)}"""


def _composite(view: str, name: str, key: list[str], parity: bool, where: str = "") -> str:
    clean = duck.norm if parity else duck.tidy
    columns = ", ".join(key)
    rows = f"SELECT DISTINCT {', '.join(f'{clean(c)} AS {c}' for c in key)} FROM {view} {where}"
    return f"""
SELECT {duck.sk_concat(*key)} AS {name}_sk, {duck.nk(*key)} AS {name}_nk, {columns}
FROM ({rows})"""


def dim_location(parity: bool = False) -> str:
    known = "WHERE location IS NOT NULL OR phone IS NOT NULL"
    return _composite("appointment", "location", ["location", "phone"], parity, known)


def dim_service(parity: bool = False) -> str:
    return _composite("hospital_fee", "service", ["service_type", "description"], parity)


def dim_test(parity: bool = False) -> str:
    key = ["test_type", "parameter", "unit"]
    clean = duck.norm if parity else duck.tidy
    parts = ", ".join(f"{clean(c)} AS {c}" for c in [*key, "normal_range"])
    rows = f"SELECT DISTINCT {parts} FROM lab_results"
    if not parity:
        rows = f"SELECT {', '.join(key)}, min(normal_range) AS normal_range FROM ({rows}) GROUP BY ALL"
    return f"""
SELECT {duck.sk_concat(*key)} AS test_sk, {duck.nk(*key)} AS test_nk, {", ".join(key)}, normal_range
FROM ({rows})"""


DIM_PATIENT = f"""
SELECT {duck.sk("patient_id")} AS patient_sk, patient_id AS patient_nk, patient_name, patient_gender,
  {duck.to_date("patient_dob")} AS patient_dob, patient_address, patient_phone, patient_email
FROM {_LATEST_PATIENT}"""

DIM_DOCTOR = f"""
SELECT {duck.sk("doctor_id")} AS doctor_sk, doctor_id AS doctor_nk, doctor_name,
  doctor_specialization, doctor_phone, doctor_email
FROM {_LATEST_DOCTOR}"""

DIM_DISEASE = f"""
SELECT {duck.sk("disease_id")} AS disease_sk, disease_id AS disease_nk, disease_name
FROM (SELECT disease_id, min(disease_name) AS disease_name FROM diseases GROUP BY disease_id)"""


def calendar(days: str) -> str:
    """Calendar of a query that yields one column d of dates."""
    return f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, d AS "date",
  CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
  CAST(day(d) AS INT) AS day_of_month, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
  CAST(weekofyear(d) AS INT) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
FROM ({days})"""


def days(first: str, last: str, source: str = "") -> str:
    """One row per day between two dates, which may be aggregates of a source."""
    series = f"generate_series({first}, {last}, INTERVAL 1 DAY)"
    return f"SELECT CAST(unnest({series}) AS DATE) AS d {source}"


DIM_DATE = calendar(days("DATE '2018-01-01'", "DATE '2032-12-31'"))
DIM_DATE_COVERING = calendar(
    days(
        "least(DATE '2018-01-01', CAST(min(o_orderdate) AS DATE))",
        "greatest(DATE '2032-12-31', CAST(max(o_orderdate) AS DATE))",
        "FROM orders",
    )
)


def versions(view: str, key: str, tracked: list[str]) -> str:
    """History rebuilt in one pass: a version starts where a tracked value
    differs from the row before and lasts until the next one."""
    changed = " OR ".join(f"{c} IS DISTINCT FROM prev_{c}" for c in tracked)
    lags = ", ".join(
        f"lag({c}) OVER (PARTITION BY {key} ORDER BY ingested_at) AS prev_{c}" for c in tracked
    )
    nth = f"row_number() OVER (PARTITION BY {key} ORDER BY ingested_at) AS nth"
    return f"""(
SELECT {key}, {", ".join(tracked)}, ingested_at AS src_updated_at, ingested_at AS valid_from,
  lead(ingested_at) OVER (PARTITION BY {key} ORDER BY ingested_at) AS valid_to
FROM (SELECT *, {lags}, {nth} FROM {view}) WHERE nth = 1 OR {changed})"""


PATIENT = ["patient_name", "patient_gender", "patient_dob", "patient_address", "patient_phone",
           "patient_email"]
DOCTOR = ["doctor_name", "doctor_specialization", "doctor_phone", "doctor_email"]
PATIENT_VERSIONS = versions("patient", "patient_id", PATIENT)
DOCTOR_VERSIONS = versions("doctors", "doctor_id", DOCTOR)


def _version_sk(key: str) -> str:
    return duck.sk_text(f"(CAST({key} AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR))")


_BOUNDS = """CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
  valid_to IS NULL AS is_current"""

DIM_PATIENT_SCD2 = f"""
SELECT {_version_sk("patient_id")} AS patient_sk, patient_id AS patient_nk, patient_name,
  patient_gender, {duck.to_date("patient_dob")} AS patient_dob, patient_address, patient_phone,
  patient_email, {_BOUNDS}
FROM {PATIENT_VERSIONS}"""

DIM_DOCTOR_SCD2 = f"""
SELECT {_version_sk("doctor_id")} AS doctor_sk, doctor_id AS doctor_nk, doctor_name,
  doctor_specialization, doctor_phone, doctor_email, {_BOUNDS}
FROM {DOCTOR_VERSIONS}"""

# After a single run over the whole log every entity has one open version, dated
# with the time of that run.
FIRST_RUN = f"timestamp '{LOAD_TIMES[2]}'"


def gold_tables(dedupe: bool = True, parity: bool = False, history: str = "loads") -> dict[str, str]:
    """Name -> text of all gold tables.

    ``history`` is "loads" (a snapshot after every load) or "once" (a single
    snapshot after the last load).
    """
    if history == "loads":
        patient_scd2, doctor_scd2 = DIM_PATIENT_SCD2, DIM_DOCTOR_SCD2
    else:
        patient_scd2, doctor_scd2 = (
            f"SELECT {_version_sk(key)} AS {name}_sk, {key} AS {name}_nk, valid_from "
            f"FROM (SELECT *, {FIRST_RUN} AS valid_from FROM {rows})"
            for key, name, rows in (
                ("patient_id", "patient", _LATEST_PATIENT),
                ("doctor_id", "doctor", _LATEST_DOCTOR),
            )
        )
    return {
        "dim_date": DIM_DATE,
        "dim_patient": DIM_PATIENT,
        "dim_doctor": DIM_DOCTOR,
        "dim_disease": DIM_DISEASE,
        "dim_location": dim_location(parity),
        "dim_service": dim_service(parity),
        "dim_test": dim_test(parity),
        "fact_appointments": fact_appointments(dedupe, parity),
        "fact_billing": fact_billing(dedupe),
        "fact_lab_results": fact_lab_results(dedupe),
        "fact_treatments": fact_treatments(dedupe),
        "fact_vitals": fact_vitals(dedupe),
        "dim_patient_scd2": patient_scd2,
        "dim_doctor_scd2": doctor_scd2,
    }


ALL_VIEWS = ("patient", "doctors", "appointment", "hospital_fee", "lab_results", "treatments",
             "vital_signs", "diseases")
