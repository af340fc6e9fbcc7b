"""Queries on landing, conforming, storing, checking and streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.operators import conform, latest_per_key, pack_and_expand
from tristrata.operators.calendar import day_key
from tristrata.operators.check_state import CheckState
from tristrata.operators.quarantine import MALFORMED
from tristrata.operators.quality import (
    ChecksFailed,
    accepted_values,
    freshness,
    not_null,
    relationships,
    run_checks,
    unique,
)
from tristrata.operators.upkeep import compact, compact_day, maintain
from tristrata.plans import dims, facts
from tristrata.plans.checks import GOLD_CHECKS, NOT_NULL, UNIQUE
from tristrata.plans.contracts import SILVER
from tristrata.plans.gold import BUILDERS, FACT_DAYS, GoldConfig, run_gold, tables_to_check
from tristrata.plans.silver import SilverConfig, quarantine_target, run_silver
from tristrata.sources import (
    Builds,
    Tables,
    WriteLayout,
    append_silver,
    cut_lineage,
    ensure_db,
    ensure_table,
    fresh_folder,
    land,
    land_all,
    read_bronze,
    read_raw,
    read_raw_csv,
    reload_silver,
    stringify,
)
from tristrata.sources.history_store import run_id
from tristrata.sources.landing import NULL_TOKENS
from tristrata.sources.sinks import INGEST_DAY
from tristrata.streaming import keep_state_on_disk, newest_stream, raw_stream, silver_stream, stream_to_silver
from tristrata.workload import duck, gold_sql
from tristrata.workload.gold_queries import doctor_history, patient_history, session_time
from tristrata.workload.registry import ORACLES, query
from tristrata.workload.views import LOAD_TIMES, RAW_SQL, raw, silver, with_views

DAY = date(2024, 1, 1)

# --- conforming -------------------------------------------------------------

_DUCK_CASTS: dict[str, Callable[[str], str]] = {
    "int": duck.to_int,
    "float": lambda c: f"try_cast({c} AS FLOAT)",
    "string": lambda c: f"CAST({c} AS VARCHAR)",
}


def conform_sql(name: str) -> str:
    """DuckDB text of a contract applied to the raw shape of a view."""
    contract = SILVER[name]
    columns = []
    for source, target, data_type in contract.specs():
        value = _DUCK_CASTS[data_type](source)
        if target in contract.defaults:
            value = f"coalesce({value}, '{contract.defaults[target]}')"
        columns.append(f"{value} AS {target}")
    return with_views(f"SELECT {', '.join(columns)} FROM ({RAW_SQL[name]})", name)


def _conformed(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return conform(raw(spark, sf_dir, name), SILVER[name]).drop("ingested_at")

    return run


for _name in SILVER:
    query(f"silver_{_name}", conform_sql(_name))(_conformed(_name))


@query("struct_pack_expand", conform_sql("doctors"))
def struct_pack_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(raw(spark, sf_dir, "doctors"), SILVER["doctors"])
    return pack_and_expand(rows, SILVER["doctors"].target_columns)


# --- landing ----------------------------------------------------------------

_APPOINTMENT_COLUMNS = SILVER["appointment"].raw_columns
_NULLS = ", ".join(f"'{t}'" for t in ("", *NULL_TOKENS))


def _export_csv(df: DataFrame, path: str, **options: str) -> None:
    writer = df.write.option("header", True).option("escape", '"')
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**spaces, **options).csv(path)


@query(
    "bronze_land_csv",
    with_views(
        "SELECT "
        + ", ".join(
            f"CASE WHEN {c} NOT IN ({_NULLS}) THEN {c} END AS {c}" for c in _APPOINTMENT_COLUMNS
        )
        + f", DATE '{DAY}' AS ingest_dt FROM ({RAW_SQL['appointment']})",
        "appointment",
    ),
)
def bronze_land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "land-csv")
    _export_csv(raw(spark, sf_dir, "appointment"), f"{folder}/raw/appointments")
    rows = read_raw_csv(spark, f"{folder}/raw/appointments", _APPOINTMENT_COLUMNS)
    for _ in range(2):  # landing a day again replaces it
        land(rows, f"{folder}/bronze", "appointments", DAY)
    return read_bronze(spark, f"{folder}/bronze", "appointments").drop("_corrupt_record")


@query("bronze_land_gzip", ORACLES["bronze_land_csv"])
def bronze_land_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed CSV under the landing folder is landed as its rows."""
    folder = fresh_folder(spark, "land-gzip")
    _export_csv(raw(spark, sf_dir, "appointment").repartition(6), f"{folder}/raw/appointments", compression="gzip")
    land_all(spark, f"{folder}/raw", f"{folder}/bronze", DAY, ["appointments"])
    return read_bronze(spark, f"{folder}/bronze", "appointments").select(*_APPOINTMENT_COLUMNS, "ingest_dt")


def _tidy(*columns: str) -> str:
    return ", ".join(f"CASE WHEN {c} NOT IN ({_NULLS}) THEN {c} END AS {c}" for c in columns)


@query(
    "bronze_land_drift",
    with_views(
        f"""SELECT {_tidy("lab_result_id", "value")}, NULL::VARCHAR AS unit FROM ({RAW_SQL['lab_results']})
UNION ALL SELECT {_tidy("lab_result_id")}, NULL, {_tidy("unit")} FROM ({RAW_SQL['lab_results']})
UNION ALL SELECT {_tidy("lab_result_id", "value", "unit")} FROM ({RAW_SQL['lab_results']})""",
        "lab_results",
    ),
)
def bronze_land_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one entity with three different headers, some of them packed, lined up by column name."""
    folder = fresh_folder(spark, "land-drift")
    lab = raw(spark, sf_dir, "lab_results")
    _export_csv(lab.select("lab_result_id", "value"), f"{folder}/raw/lab_results")
    # A packed file is read by one task whatever its size.
    _export_csv(lab.select("unit", "lab_result_id"), f"{folder}/raw/lab_results_2", compression="gzip", maxRecordsPerFile="500000")
    _export_csv(lab.select("value", "unit", "lab_result_id"), f"{folder}/raw/lab_results_3")
    land_all(spark, f"{folder}/raw", f"{folder}/bronze", DAY, ["lab_results"])
    return read_bronze(spark, f"{folder}/bronze", "lab_results").select("lab_result_id", "value", "unit")


@query(
    "bronze_land_parquet",
    with_views(
        f"SELECT *, DATE '{DAY}' AS ingest_dt FROM ({RAW_SQL['hospital_fee']})", "hospital_fee"
    ),
)
def bronze_land_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "land-parquet")
    raw(spark, sf_dir, "hospital_fee").write.parquet(f"{folder}/raw/hospital_fee")
    rows = read_raw(spark, f"{folder}/raw/hospital_fee", "parquet")
    land(rows, f"{folder}/bronze", "hospital_fee", DAY)
    return read_bronze(spark, f"{folder}/bronze", "hospital_fee", DAY)


@query(
    "bronze_land_report",
    with_views(
        """SELECT 'appointments' AS entity, 'ok' AS status, count(*) AS "rows" FROM appointment
UNION ALL SELECT 'doctors', 'ok', count(*) FROM doctors
UNION ALL SELECT 'treatments', 'ok', count(*) FROM treatments
UNION ALL SELECT 'lab_results', 'ok', 2 * count(*) FROM lab_results
UNION ALL SELECT 'diseases', 'failed', NULL""",
        "appointment",
        "doctors",
        "treatments",
        "lab_results",
    ),
)
def bronze_land_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "land-all")
    _export_csv(raw(spark, sf_dir, "appointment"), f"{folder}/raw/2024/appointments")
    raw(spark, sf_dir, "doctors").write.json(f"{folder}/raw/doctors")
    raw(spark, sf_dir, "treatments").write.parquet(f"{folder}/raw/deep/er/treatments")
    # Headers of one entity may disagree: its files are lined up by name.
    lab = raw(spark, sf_dir, "lab_results")
    _export_csv(lab.select("lab_result_id", "value"), f"{folder}/raw/lab_results")
    _export_csv(lab.select("unit", "lab_result_id"), f"{folder}/raw/lab_results_more")
    # Types that cannot be reconciled: this entity fails, the others still land.
    disease = raw(spark, sf_dir, "diseases").select("disease_id")
    disease.write.parquet(f"{folder}/raw/diseases")
    disease.select(F.lit(1).alias("disease_id")).write.parquet(f"{folder}/raw/diseases_more")
    entities = [c.raw for c in SILVER.values()]
    report = land_all(spark, f"{folder}/raw", f"{folder}/bronze", DAY, entities)
    return report.select("entity", "status", "rows")


def _two_days(spark: SparkSession, sf_dir: str) -> str:
    """Bronze with the first load of patients on one day and the rest later."""
    folder = fresh_folder(spark, "bronze-days")
    rows = raw(spark, sf_dir, "patient")
    for i, _ in enumerate(LOAD_TIMES):
        day = DAY + timedelta(days=i)
        land(rows.where(F.col("load_day") == day.isoformat()), folder, "patient", day)
    return folder


@query(
    "bronze_read_day",
    with_views(
        f"""SELECT *, DATE '2024-01-02' AS ingest_dt FROM ({RAW_SQL['patient']})
WHERE load_day = '2024-01-02'""",
        "patient",
    ),
)
def bronze_read_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _two_days(spark, sf_dir), "patient", DAY + timedelta(days=1))


@query(
    "bronze_read_all",
    with_views(
        f"SELECT *, CAST(load_day AS DATE) AS ingest_dt FROM ({RAW_SQL['patient']})", "patient"
    ),
)
def bronze_read_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _two_days(spark, sf_dir), "patient")


# --- silver tables ----------------------------------------------------------

@query(
    "silver_append",
    f"""SELECT *, CAST(ingest_day AS VARCHAR) AS ingested_on
FROM ({conform_sql("hospital_fee")}) CROSS JOIN (VALUES (DATE '2024-01-01'), (DATE '2024-01-02'))
  AS runs(ingest_day)""",
)
def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{fresh_folder(spark, 'silver-append')}/hospital_fee"
    rows = raw(spark, sf_dir, "hospital_fee")
    for text in LOAD_TIMES[:2]:
        load = conform(rows, SILVER["hospital_fee"], session_time(spark, text))
        append_silver(load, target)
    ingested_on = F.col("ingested_at").cast("date").cast("string").alias("ingested_on")
    stored = spark.read.parquet(target)
    return stored.select(*SILVER["hospital_fee"].target_columns, INGEST_DAY, ingested_on)


@query(
    "silver_reload",
    with_views(
        """SELECT patient_id, patient_name, patient_address,
  CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_day
FROM patient""",
        "patient",
    ),
)
def silver_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{fresh_folder(spark, 'silver-reload')}/patient"
    log = silver(spark, sf_dir, "patient")
    for text in (*LOAD_TIMES, LOAD_TIMES[1]):  # the second load arrives twice
        load = log.where(F.col("ingested_at") == F.lit(session_time(spark, text)))
        reload_silver(load, target)
    day = F.col(INGEST_DAY).cast("string").alias(INGEST_DAY)
    return spark.read.parquet(target).select("patient_id", "patient_name", "patient_address", day)


# Every seventh line has a field too many.
_SURPLUS = "TRY_CAST(trim(doctor_id) AS DOUBLE) % 7 = 0"


@query(
    "silver_quarantine",
    with_views(
        f""", raw_doctors AS ({RAW_SQL["doctors"]}),
good AS (SELECT * FROM raw_doctors WHERE NOT coalesce({_SURPLUS}, false))
SELECT 'silver' AS place, {duck.to_int("doctor_id")} AS doctor_id, Name AS doctor_name, email AS doctor_email, NULL AS reason, NULL AS record
FROM good
UNION ALL SELECT 'quarantine', NULL, NULL, NULL, '{MALFORMED}',
  concat_ws(',', doctor_id, Name, specialization, phone, email, 'surplus') FROM raw_doctors WHERE {_SURPLUS}""",
        "doctors",
    ),
)
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines with a field too many are set apart with reason and text, and never enter silver."""
    folder = fresh_folder(spark, "silver-quarantine")
    doctors = raw(spark, sf_dir, "doctors")
    surplus = F.when(F.expr(_SURPLUS), ",surplus").otherwise("")
    # Lines as one column under the header's text, so that nothing is quoted.
    lines = doctors.select(F.concat(F.concat_ws(",", *doctors.columns), surplus).alias(",".join(doctors.columns)))
    _export_csv(lines, f"{folder}/raw/doctors", sep="\u0001")
    land_all(spark, f"{folder}/raw", f"{folder}/bronze", DAY, ["doctors"])
    cfg = SilverConfig(f"{folder}/bronze", f"{folder}/silver", DAY, ["doctors"], max_bad_share=0.5)
    run_silver(spark, cfg, session_time(spark, LOAD_TIMES[0]))
    none = F.lit(None).cast("string")
    stored = spark.read.parquet(f"{folder}/silver/doctors").select(
        F.lit("silver").alias("place"), "doctor_id", "doctor_name", "doctor_email", none.alias("reason"), none.alias("record")
    )
    apart = spark.read.parquet(quarantine_target(f"{folder}/silver", "doctors")).select(
        F.lit("quarantine").alias("place"), F.lit(None).cast("int").alias("doctor_id"), none.alias("doctor_name"),
        none.alias("doctor_email"), "reason", "record",
    )
    return stored.unionAll(apart)


@query(
    "silver_append_table",
    f"""SELECT * FROM ({conform_sql("hospital_fee")})
UNION ALL SELECT * FROM ({conform_sql("hospital_fee")})""",
)
def silver_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads appended to a table of the catalog, one of them repeated by a reload; raw columns were made text first."""
    mark = uuid.uuid4().hex[:12]
    ensure_db(spark, f"silver_{mark}", f"{fresh_folder(spark, 'silver-table')}/db")
    target = f"silver_{mark}.hospital_fee"
    typed = raw(spark, sf_dir, "hospital_fee").withColumn("appointment_id", F.col("appointment_id").cast("long"))
    rows = stringify(typed, ["appointment_id"])
    layout = WriteLayout(compression="zstd", row_group_bytes=64 << 20, files=2)
    for i, text in enumerate((*LOAD_TIMES[:2], LOAD_TIMES[1])):
        load = conform(rows, SILVER["hospital_fee"], session_time(spark, text))
        ensure_table(spark, target, load.schema)
        (reload_silver if i == 2 else append_silver)(load, target, layout)
    return spark.table(target).select(*SILVER["hospital_fee"].target_columns)


_RAW_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"table\", 'ok' AS status, count(*) AS \"rows\" FROM {c}" for c in SILVER
)


@query("silver_run", with_views(_RAW_COUNTS, *SILVER))
def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "silver-run")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda name: land(raw(spark, sf_dir, name), f"{folder}/bronze", SILVER[name].raw, DAY), SILVER))
    cfg = SilverConfig(f"{folder}/bronze", f"{folder}/silver", ingest_dt=DAY)
    report = run_silver(spark, cfg, session_time(spark, LOAD_TIMES[0]))
    return report.select("table", "status", "rows")


def _gold_counts() -> str:
    tables = gold_sql.gold_tables(history="once")
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", count(*) AS \"rows\" FROM ({sql})" for n, sql in tables.items()
    )


@query("gold_run", with_views(_gold_counts(), *gold_sql.ALL_VIEWS))
def gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "gold-run")
    stored = Tables(spark, f"{folder}/silver")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda name: stored.publish(silver(spark, sf_dir, name), name), SILVER))
    cfg = GoldConfig(f"{folder}/silver", f"{folder}/gold", f"{folder}/snapshots")
    gold, _ = run_gold(spark, cfg, session_time(spark, LOAD_TIMES[2]))
    parts = [
        gold.ref(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n in BUILDERS
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionAll(part)
    return counts


_SHOWN = ("dim_patient", "fact_appointments")


def _patients_after(load: int) -> str:
    """DuckDB: the patient dimension as of a load, as the rows of one build."""
    return f"""SELECT patient_nk, patient_address, appointments
FROM (SELECT patient_id AS patient_nk, patient_address FROM {duck.latest(
    f"(SELECT * FROM patient WHERE ingested_at <= TIMESTAMP '{LOAD_TIMES[load]}')", "patient_id",
    ["patient_name", "patient_gender", "patient_dob", "patient_address", "patient_phone", "patient_email"])})
LEFT JOIN (SELECT patient_id, count(*) AS appointments
  FROM {duck.latest("appointment", "appointment_id", [])} GROUP BY patient_id) ON patient_id = patient_nk"""


@query(
    "gold_switch",
    with_views(
        f"""SELECT 'first build' AS seen, * FROM ({_patients_after(0)})
UNION ALL SELECT 'shown', * FROM ({_patients_after(1)})""",
        "patient",
        "appointment",
    ),
)
def gold_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs into a database, the last of which fails a check: readers see the second, and may still open the first."""
    mark = uuid.uuid4().hex[:12]
    db, snapshots = f"gold_{mark}", fresh_folder(spark, "switch-snapshots")
    stored = Tables(spark, f"silver_{mark}")
    for name in ("doctors", "appointment"):
        stored.publish(silver(spark, sf_dir, name), name)
    for name in set(SILVER) - {"patient", "doctors", "appointment"}:
        stored.publish(silver(spark, sf_dir, name).limit(0), name)
    patient = silver(spark, sf_dir, "patient")
    cfg = GoldConfig(f"silver_{mark}", db, snapshots, tables=_SHOWN)
    for i, text in enumerate(LOAD_TIMES):
        run_ts = session_time(spark, text)
        known = patient.where(F.col("ingested_at") <= F.lit(run_ts))
        if i == 2:
            known = known.withColumn("patient_id", F.when(F.col("patient_id") % 5 != 0, F.col("patient_id")))
        stored.publish(known, "patient")
        try:
            run_gold(spark, cfg, run_ts)
        except ChecksFailed:
            if i != 2:
                raise

    def seen(name: str, tables: Tables) -> DataFrame:
        per_patient = tables.ref("fact_appointments").groupBy("patient_sk").agg(F.count(F.lit(1)).alias("appointments"))
        rows = tables.ref("dim_patient").join(per_patient, "patient_sk", "left")
        return rows.select(F.lit(name).alias("seen"), "patient_nk", "patient_address", "appointments")

    first = Builds(spark, db).open(run_id(session_time(spark, LOAD_TIMES[0])))
    return seen("first build", first).unionAll(seen("shown", Tables(spark, db)))


# Appointments with some dates of the year 9999.
_FAR = "CASE WHEN appointment_id % 37 = 0 THEN '9999-12-31' ELSE appointment_date END"


@query(
    "gold_fact_by_date",
    with_views(
        f""", dated AS (
  SELECT 'fact_appointments' AS fact, {duck.to_date(f"({_FAR})")} AS d FROM {duck.latest("appointment", "appointment_id", [])}
  UNION ALL SELECT 'fact_billing', {duck.to_date("fee_date")}
  FROM {duck.latest("hospital_fee", "fee_id", ["appointment_id", "patient_id", "fee_date", "amount", "service_type", "description"])})
SELECT fact, CASE WHEN d IS NULL THEN -1 WHEN d NOT BETWEEN DATE '1900-01-01' AND DATE '2100-12-31' THEN -2 ELSE 1 END AS kind,
  CAST(CASE WHEN d BETWEEN DATE '1900-01-01' AND DATE '2100-12-31' THEN year(d) END AS INT) AS year, count(*) AS "rows"
FROM dated GROUP BY ALL""",
        "appointment",
        "hospital_fee",
    ),
)
def gold_fact_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the stored facts meets one row of the stored calendar, whatever its date."""
    folder = fresh_folder(spark, "fact-by-date")
    stored = Tables(spark, f"{folder}/silver")
    for name in SILVER:
        rows = silver(spark, sf_dir, name)
        if name == "appointment":
            rows = rows.withColumn("appointment_date", F.expr(_FAR))
        stored.publish(rows, name)
    names = ("dim_date", "fact_appointments", "fact_billing")
    cfg = GoldConfig(f"{folder}/silver", f"{folder}/gold", f"{folder}/snapshots", tables=names, days_of_facts=True)
    gold, _ = run_gold(spark, cfg, session_time(spark, LOAD_TIMES[2]))
    parts = []
    for name in names[1:]:
        per_day = gold.ref(name).groupBy(day_key(FACT_DAYS[name]).alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
        days = per_day.join(gold.ref("dim_date"), "date_key").withColumn("kind", F.when(F.col("date_key") < 0, F.col("date_key")).otherwise(1))
        parts.append(days.groupBy(F.lit(name).alias("fact"), "kind", "year").agg(F.sum("n").alias("rows")))
    return parts[0].unionAll(parts[1])


# --- data quality -----------------------------------------------------------


@query(
    "dq_not_null",
    with_views(
        """SELECT * FROM (VALUES ('doctor_id'), ('end_time'), ('phone'), ('location')) c("column"),
LATERAL (SELECT count(*) FILTER (WHERE CASE "column" WHEN 'doctor_id' THEN doctor_id IS NULL
  WHEN 'end_time' THEN end_time IS NULL WHEN 'phone' THEN phone IS NULL ELSE location IS NULL END)
  AS failures FROM appointment)""",
        "appointment",
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doctor_id", "end_time", "phone", "location"]
    return not_null(silver(spark, sf_dir, "appointment"), columns)


@query(
    "dq_unique",
    with_views(
        "SELECT fee_id, count(*) AS n_records FROM hospital_fee GROUP BY fee_id HAVING count(*) > 1",
        "hospital_fee",
    ),
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique(silver(spark, sf_dir, "hospital_fee"), ["fee_id"])


@query(
    "dq_accepted_values",
    with_views(
        """SELECT status AS value, count(*) AS n_records FROM appointment
WHERE status NOT IN ('O', 'F') GROUP BY status""",
        "appointment",
    ),
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_values(silver(spark, sf_dir, "appointment"), "status", ["O", "F"])


@query(
    "dq_relationships",
    with_views(
        """SELECT appointment_id AS value, count(*) AS n_records FROM hospital_fee f
WHERE NOT EXISTS (SELECT 1 FROM appointment a
  WHERE a.appointment_id = f.appointment_id AND a.location IS NOT NULL)
AND appointment_id IS NOT NULL GROUP BY appointment_id""",
        "hospital_fee",
        "appointment",
    ),
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = silver(spark, sf_dir, "appointment").where(F.col("location").isNotNull())
    fees = silver(spark, sf_dir, "hospital_fee")
    return relationships(fees, "appointment_id", placed, "appointment_id")


@query(
    "dq_freshness",
    with_views(
        """SELECT CAST(max(ingested_at) AS VARCHAR) AS max_loaded_at,
  CAST(epoch(timestamp '2024-01-05 00:00:00') - epoch(max(ingested_at)) AS BIGINT) AS age_seconds,
  CASE WHEN epoch(timestamp '2024-01-05 00:00:00') - epoch(max(ingested_at)) > 2 * 86400
    THEN 'error' WHEN epoch(timestamp '2024-01-05 00:00:00') - epoch(max(ingested_at)) > 86400
    THEN 'warn' ELSE 'pass' END AS status
FROM patient""",
        "patient",
    ),
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(session_time(spark, "2024-01-05 00:00:00"))
    patient = silver(spark, sf_dir, "patient")
    age = freshness(patient, "ingested_at", as_of, timedelta(days=1), timedelta(days=2))
    return age.withColumn("max_loaded_at", F.col("max_loaded_at").cast("string"))


def _report_sql(dedupe: bool, parity: bool) -> str:
    tables = gold_sql.gold_tables(dedupe, parity)
    parts = []
    for kind, declared in (("not_null", NOT_NULL), ("unique", UNIQUE)):
        for name, columns in declared.items():
            for column in columns:
                failures = (
                    f"SELECT count(*) AS failures FROM {name} WHERE {column} IS NULL"
                    if kind == "not_null"
                    else f"SELECT count(*) AS failures FROM (SELECT {column} FROM {name} "
                    f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
                )
                parts.append(
                    f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", '{kind}' AS \"check\", "
                    f"failures, failures = 0 AS passed FROM ({failures})"
                )
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in tables.items())
    return with_views(f", {ctes}\n" + "\nUNION ALL ".join(parts), *gold_sql.ALL_VIEWS)


def _gold(spark: SparkSession, sf_dir: str) -> Tables:
    given = {name: silver(spark, sf_dir, name) for name in SILVER}
    # The runs of a history follow one another; the two histories do not depend on each other.
    with ThreadPoolExecutor(2) as pool:
        histories = [pool.submit(make, spark, sf_dir) for make in (patient_history, doctor_history)]
    given["patient_snapshot"], given["doctor_snapshot"] = [h.result() for h in histories]
    return Tables(spark, given=given)


@query("dq_report", _report_sql(dedupe=True, parity=False))
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(tables_to_check(spark, _gold(spark, sf_dir)), GOLD_CHECKS)


_PATIENT_FILLED = ("patient_email", "patient_name")


def _state_sql() -> str:
    parts = []
    for i, text in enumerate(LOAD_TIMES):
        known = f"(SELECT * FROM patient WHERE ingested_at <= TIMESTAMP '{text}')"
        nulls = [f"SELECT {i} AS load, 'not_null' AS \"check\", '{c}' AS what, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {known}" for c in _PATIENT_FILLED]
        parts += [*nulls, f"SELECT {i}, 'unique', CAST(patient_id AS VARCHAR), count(*) FROM {known} GROUP BY patient_id HAVING count(*) > 1"]
    return " UNION ALL ".join(parts)


@query("dq_incremental", with_views(_state_sql(), "patient"))
def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a growing log after each load, from a state that reads the new day only."""
    folder = fresh_folder(spark, "dq-incremental")
    patient = silver(spark, sf_dir, "patient")
    state = CheckState(spark, f"{folder}/state", "patient_id", "int", _PATIENT_FILLED)
    parts = []
    for i, text in enumerate(LOAD_TIMES):
        append_silver(patient.where(F.col("ingested_at") == F.lit(session_time(spark, text))), f"{folder}/patient")
        state.refresh(spark.read.parquet(f"{folder}/patient"))
        nulls = state.not_null().select(F.lit("not_null").alias("check"), F.col("column").alias("what"), "failures")
        repeats = state.unique().select(F.lit("unique"), F.col("patient_id").cast("string"), "n_records")
        # The state grows with the next load: its answer is stored now.
        parts.append(cut_lineage(nulls.unionAll(repeats)).select(F.lit(i).alias("load"), "check", "what", "failures"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# Without removing repeated loads the declared checks find what is wrong.
@query("dq_report_parity", _report_sql(dedupe=False, parity=True))
def dq_report_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _gold(spark, sf_dir)
    built = tables_to_check(spark, t)
    built |= {
        "dim_location": dims.dim_location(t.source("appointment"), parity=True),
        "dim_service": dims.dim_service(t.source("hospital_fee"), parity=True),
        "dim_test": dims.dim_test(t.source("lab_results"), parity=True),
        "fact_appointments": facts.fact_appointments(
            t.source("appointment"), dedupe=False, parity=True
        ),
        "fact_billing": facts.fact_billing(t.source("hospital_fee"), dedupe=False),
        "fact_lab_results": facts.fact_lab_results(t.source("lab_results"), dedupe=False),
        "fact_treatments": facts.fact_treatments(t.source("treatments"), dedupe=False),
        "fact_vitals": facts.fact_vitals(t.source("vital_signs"), dedupe=False),
    }
    return run_checks(built, GOLD_CHECKS)


# --- upkeep -----------------------------------------------------------------

_VITALS = "vital_id, patient_id, blood_pressure, heart_rate"


def _fragmented(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A silver table whose days are spread over many small files."""
    target = f"{fresh_folder(spark, label)}/vital_signs"
    append_silver(silver(spark, sf_dir, "vital_signs").repartition(8, "vital_id"), target)
    return target


@query(
    "compact_day",
    with_views(
        f"SELECT {_VITALS}, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_day FROM vital_signs",
        "vital_signs",
    ),
)
def compact_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _fragmented(spark, sf_dir, "compact-day")
    compact_day(spark, target, DAY)
    return _stored_vitals(spark, target)


def _stored_vitals(spark: SparkSession, target: str) -> DataFrame:
    day = F.col(INGEST_DAY).cast("string").alias(INGEST_DAY)
    return spark.read.parquet(target).select(*_VITALS.split(", "), day)


@query(
    "compact_all",
    with_views(
        f"SELECT {_VITALS}, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_day FROM vital_signs",
        "vital_signs",
    ),
)
def compact_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _fragmented(spark, sf_dir, "compact-all")
    compact(spark, target)
    return _stored_vitals(spark, target)


@query("compact_under_append", ORACLES["compact_all"].replace("FROM vital_signs", "FROM (SELECT * FROM vital_signs UNION ALL SELECT * FROM vital_signs WHERE vital_id % 3 = 0)"))
def compact_under_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compaction between two appends; the second lands in days that were just compacted and is compacted with them."""
    target = _fragmented(spark, sf_dir, "compact-append")
    compact(spark, target)
    append_silver(silver(spark, sf_dir, "vital_signs").where("vital_id % 3 = 0").repartition(4, "vital_id"), target)
    compact(spark, target)
    return _stored_vitals(spark, target)


@query(
    "compact_streamed",
    with_views(f"SELECT {_VITALS}, CAST(vital_id % 3 AS INT) AS batch FROM vital_signs", "vital_signs"),
)
def compact_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose days are split further, as a stream's sink writes them, keeps that split."""
    target = f"{fresh_folder(spark, 'compact-streamed')}/vital_signs"
    rows = silver(spark, sf_dir, "vital_signs").withColumns({INGEST_DAY: F.lit(DAY), "batch": F.col("vital_id") % 3})
    for part in range(4):
        rows.where(F.col("vital_id") % 4 == part).write.mode("append").partitionBy(INGEST_DAY, "batch").parquet(target)
    compact(spark, target)
    return spark.read.parquet(target).select(*_VITALS.split(", "), "batch")


@query(
    "compact_report",
    with_views(
        """SELECT 'vital_signs' AS "table", CAST(count(DISTINCT CAST(ingested_at AS DATE)) AS INT)
  AS days, count(DISTINCT CAST(ingested_at AS DATE)) AS files_after, count(*) AS "rows"
FROM vital_signs""",
        "vital_signs",
    ),
)
def compact_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _fragmented(spark, sf_dir, "compact-report")
    report = maintain(spark, {"vital_signs": target}, DAY, window_days=None)
    return report.select("table", "days", "files_after", "rows")


# --- streaming --------------------------------------------------------------

_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@query(
    "stream_silver_events",
    with_views(
        "SELECT vital_id, patient_id, measurement_date, CAST(temperature AS FLOAT) AS temperature "
        "FROM vital_signs",
        "vital_signs",
    ),
)
def stream_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "stream")
    events = raw_stream(spark, sf_dir, _EVENTS, pathGlobFilter="events.parquet")
    none = F.lit(None).cast("string")
    vitals = events.select(
        F.col("event_id").cast("string").alias("vital_id"),
        F.col("user_id").cast("string").alias("patient_id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("measurement_date"),
        F.col("value").cast("string").alias("temperature"),
        *[none.alias(c) for c in ("blood_pressure", "heart_rate", "respiratory_rate")],
        *[none.alias(c) for c in ("oxygen_saturation", "blood_sugar")],
        "arrived_at",
        "arrival_part",
    )
    delivered_twice = vitals.unionAll(vitals)
    rows = silver_stream(delivered_twice, SILVER["vital_signs"], ["vital_id"])
    stream_to_silver(rows, f"{folder}/vital_signs", f"{folder}/checkpoint")
    stored = spark.read.parquet(f"{folder}/vital_signs")
    return stored.select("vital_id", "patient_id", "measurement_date", "temperature")


def _vital_rows(vitals: DataFrame, added: int) -> DataFrame:
    none = F.lit(None).cast("string")
    return vitals.select(
        F.col("vital_id").cast("string").alias("vital_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        "measurement_date",
        (F.col("temperature") + added).cast("string").alias("temperature"),
        *[none.alias(c) for c in ("blood_pressure", "heart_rate", "respiratory_rate", "oxygen_saturation", "blood_sugar")],
    )


def _arrive(spark: SparkSession, rows: DataFrame, folder: str, name: str, hours: int) -> int:
    """Files that arrived so many hours after the first ones, and how many of them hold rows."""
    rows.write.parquet(f"{folder}/{name}")
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [status.getPath() for status in fs.listStatus(make(f"{folder}/{name}"))]
    for path in paths:
        fs.setTimes(path, 1_704_067_200_000 + hours * 3_600_000, -1)
    return sum(path.getName().startswith("part-") for path in paths)


@query(
    "stream_newest",
    with_views(
        """SELECT vital_id, patient_id, CAST(CAST(CAST(temperature + CASE WHEN vital_id % 5 = 0 THEN 2 WHEN vital_id % 3 = 0 THEN 1 ELSE 0 END
  AS VARCHAR) AS FLOAT) AS DOUBLE) AS temperature FROM vital_signs""",
        "vital_signs",
    ),
)
def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries taken one by one, the second within the horizon of the first and the third long after it.

    Every batch opens, searches and saves the whole state, so a batch takes as many files as the largest
    delivery has: their number does not grow with the files.
    """
    folder = fresh_folder(spark, "stream-newest")
    vitals = silver(spark, sf_dir, "vital_signs")
    keep_state_on_disk(spark)
    files = [
        _arrive(spark, _vital_rows(vitals, 0), f"{folder}/raw", "part=1", 0),
        _arrive(spark, _vital_rows(vitals.where("vital_id % 3 = 0"), 1), f"{folder}/raw", "part=2", 2),
        _arrive(spark, _vital_rows(vitals.where("vital_id % 5 = 0"), 2), f"{folder}/raw", "part=3", 90),
    ]
    # What arrives last closes the sessions before it; its own stays open.
    last = spark.range(1).select(F.lit(-1).alias("vital_id"), F.lit(-1).alias("patient_id"), F.lit(None).cast("string").alias("measurement_date"), F.lit(0.0).alias("temperature"))
    _arrive(spark, _vital_rows(last, 0), f"{folder}/raw", "part=4", 500)
    schema = spark.read.parquet(f"{folder}/raw").drop("part").schema
    rows = raw_stream(spark, f"{folder}/raw", schema, files_per_batch=max(2, *files), recursiveFileLookup=True)
    stream_to_silver(newest_stream(rows, SILVER["vital_signs"], ["vital_id"], "1 day"), f"{folder}/vital_signs", f"{folder}/checkpoint")
    stored = spark.read.parquet(f"{folder}/vital_signs")
    newest = latest_per_key(stored.where("vital_id >= 0"), ["vital_id"], ["ingested_at"])
    return newest.select("vital_id", "patient_id", F.col("temperature").cast("double").alias("temperature"))
