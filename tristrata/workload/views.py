"""Silver- and raw-shaped views over the driver's tables.

The text of a view runs unchanged in Spark and in DuckDB. ``{name}`` stands for
one of the driver's tables or for one of the two prepared inputs below, which
repeat every customer (supplier) once per load of an append log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_TIMES = ("2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00")

_LOAD_TIME = "CASE load_no " + " ".join(
    f"WHEN {i} THEN timestamp '{t}'" for i, t in enumerate(LOAD_TIMES)
) + " END"

SILVER_SQL = {
    "patient": f"""
SELECT CAST(c_custkey AS INT) AS patient_id, c_name AS patient_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS patient_gender,
  '19' || lpad(CAST(40 + c_custkey % 60 AS STRING), 2, '0')
    || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
    || '-' || lpad(CAST(1 + c_custkey % 31 AS STRING), 2, '0') AS patient_dob,
  c_mktsegment || CASE WHEN c_custkey % 3 = load_no THEN ' moved' ELSE '' END AS patient_address,
  '555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') AS patient_phone,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lower(c_name) || '@example.org' END AS patient_email,
  {_LOAD_TIME} AS ingested_at
FROM {{customer_loads}} WHERE c_custkey % (load_no + 1) = 0""",
    "doctors": f"""
SELECT CAST(s_suppkey AS INT) AS doctor_id, s_name AS doctor_name,
  CASE WHEN (s_suppkey + load_no) % 3 = 0 THEN 'Cardiology' ELSE 'General' END
    AS doctor_specialization,
  '777-' || CAST(s_nationkey AS STRING) AS doctor_phone,
  lower(s_name) || '@example.org' AS doctor_email,
  {_LOAD_TIME} AS ingested_at
FROM {{supplier_loads}} WHERE load_no = 0 OR s_suppkey % 2 = 0""",
    "appointment": """
SELECT CAST(o_orderkey AS INT) AS appointment_id, CAST(o_custkey AS INT) AS patient_id,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderkey % 10 AS INT) END AS doctor_id,
  CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END
    AS appointment_date,
  lpad(CAST(8 + o_orderkey % 9 AS STRING), 2, '0') || ':'
    || lpad(CAST((o_orderkey % 4) * 15 AS STRING), 2, '0') AS start_time,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '17:00:00'
    WHEN o_orderkey % 23 = 0 THEN '00:30'
    ELSE lpad(CAST(9 + o_orderkey % 9 AS STRING), 2, '0') || ':10' END AS end_time,
  o_orderpriority AS reason, o_orderstatus AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 35 = 1 THEN ''
    ELSE ' Ext-' || CAST(o_orderkey % 4 AS STRING) || ' ' END AS phone,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '  Clinic A '
    WHEN o_orderkey % 3 = 1 THEN 'clinic a' ELSE 'CLINIC B' END AS location,
  CASE WHEN o_orderkey % 2 = 0 THEN 'follow-up' ELSE 'new' END AS appointment_type,
  timestamp '2024-01-01 06:00:00' AS ingested_at
FROM {orders}""",
    "hospital_fee": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS fee_id,
  CAST(l_orderkey AS INT) AS appointment_id, CAST(l_suppkey AS INT) AS patient_id,
  CASE WHEN l_returnflag = 'A' THEN ' Imaging' WHEN l_returnflag = 'N' THEN 'imaging '
    ELSE 'Consult' END AS service_type,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE 'Line ' || l_linestatus END AS description,
  l_extendedprice AS amount, substr(CAST(l_shipdate AS STRING), 1, 10) AS fee_date,
  '888-' || CAST(l_linenumber AS STRING) AS phone, CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM {lineitem}""",
    "lab_results": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS lab_result_id,
  CAST(l_orderkey AS INT) AS appointment_id, CAST(l_suppkey AS INT) AS patient_id,
  CASE WHEN l_returnflag = 'A' THEN ' Blood ' ELSE 'blood' END AS test_type,
  'Glucose' AS parameter,
  CASE l_linenumber WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.4 mmol/L'
    WHEN 2 THEN '<0.5' WHEN 3 THEN '3.5-5.0 g/dL' WHEN 4 THEN 'Negative' WHEN 5 THEN '1,200'
    WHEN 6 THEN NULL ELSE '-7' END AS value,
  coalesce(CASE WHEN l_linestatus = 'O' THEN 'mmol/L' ELSE NULL END, 'Unknown') AS unit,
  CASE WHEN l_tax > 0.04 THEN '3-5' ELSE '4-6' END AS normal_range,
  l_linestatus AS interpretation, substr(CAST(l_shipdate AS STRING), 1, 10) AS test_date,
  CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM {lineitem}""",
    "treatments": """
SELECT CAST(l_orderkey * 10 + l_linenumber AS INT) AS treatment_id,
  CAST(l_suppkey AS INT) AS patient_id, CAST(l_suppkey % 10 AS INT) AS doctor_id,
  CAST(l_partkey % 50 AS INT) AS disease_id, l_linestatus AS treatment_description,
  substr(CAST(l_shipdate AS STRING), 1, 10) AS treatment_date,
  CAST(l_shipdate AS TIMESTAMP) AS ingested_at
FROM {lineitem}""",
    "vital_signs": """
SELECT CAST(event_id AS INT) AS vital_id, CAST(user_id AS INT) AS patient_id,
  substr(CAST(ts AS STRING), 1, 19) AS measurement_date,
  CAST(100 + event_id % 60 AS STRING) || '/' || CAST(60 + event_id % 30 AS STRING)
    AS blood_pressure,
  CAST(60 + event_id % 50 AS INT) AS heart_rate, CAST(12 + event_id % 8 AS INT) AS respiratory_rate,
  value AS temperature, CAST(90 + event_id % 10 AS INT) AS oxygen_saturation,
  CAST(70 + event_id % 80 AS INT) AS blood_sugar, CAST(ts AS TIMESTAMP) AS ingested_at
FROM {events}""",
    "diseases": """
SELECT CAST(p_partkey % 50 AS INT) AS disease_id, CAST(p_partkey AS INT) AS patient_id,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'Disease-' || CAST(p_partkey % 50 AS STRING) END
    AS disease_name,
  '2024-01-01' AS diagnosis_date, timestamp '2024-01-01 06:00:00' AS ingested_at
FROM {part}""",
}

# An id as it may arrive in a raw file: padded, as decimal text, or not a number.
_DIRTY = (
    "CASE WHEN {c} % 6 = 0 THEN CAST({c} AS STRING) || '.0' "
    "WHEN {c} % 29 = 1 THEN 'unknown' WHEN {c} % 31 = 2 THEN CAST({c} AS STRING) || '.7' "
    "ELSE ' ' || CAST({c} AS STRING) || ' ' END"
)


def _dirty(column: str) -> str:
    return f"{_DIRTY.format(c=column)} AS {column}"


# Raw shape of a silver view, to be selected from that view.
RAW_SQL = {
    "patient": f"""
SELECT {_dirty("patient_id")}, patient_name AS name, patient_gender AS gender, patient_dob AS dob,
  patient_address AS address, patient_phone AS phone, patient_email AS email,
  CAST(CAST(ingested_at AS DATE) AS STRING) AS load_day FROM patient""",
    "doctors": f"""
SELECT {_dirty("doctor_id")}, doctor_name AS Name, doctor_specialization AS specialization,
  doctor_phone AS phone, doctor_email AS email FROM doctors""",
    "appointment": f"""
SELECT CAST(appointment_id AS STRING) AS appointment_id, {_dirty("patient_id")},
  {_dirty("doctor_id")}, appointment_date, start_time, end_time, reason, status, phone, location,
  appointment_type FROM appointment""",
    "hospital_fee": f"""
SELECT fee_id, CAST(appointment_id AS STRING) AS appointment_id, {_dirty("patient_id")},
  service_type, description,
  CASE WHEN patient_id % 11 = 3 THEN 'free' ELSE CAST(amount AS STRING) END AS amount,
  fee_date, phone FROM hospital_fee""",
    "lab_results": f"""
SELECT lab_result_id, CAST(appointment_id AS STRING) AS appointment_id, {_dirty("patient_id")},
  test_type, parameter, value, CASE WHEN unit = 'Unknown' THEN NULL ELSE unit END AS unit,
  normal_range, interpretation, test_date FROM lab_results""",
    "treatments": f"""
SELECT CAST(treatment_id AS STRING) AS treatment_id, {_dirty("patient_id")},
  {_dirty("doctor_id")}, {_dirty("disease_id")}, treatment_description, treatment_date
FROM treatments""",
    "vital_signs": f"""
SELECT CAST(vital_id AS STRING) AS vital_id, {_dirty("patient_id")}, measurement_date,
  blood_pressure, {_dirty("heart_rate")}, {_dirty("respiratory_rate")},
  CAST(temperature AS STRING) AS temperature, {_dirty("oxygen_saturation")},
  {_dirty("blood_sugar")} FROM vital_signs""",
    "diseases": f"""
SELECT {_dirty("disease_id")}, CAST(patient_id AS STRING) AS patient_id, disease_name,
  diagnosis_date FROM diseases""",
}

_DUCK_INPUTS = {
    "customer_loads": "(SELECT *, unnest([0, 1, 2]) AS load_no FROM customer)",
    "supplier_loads": "(SELECT *, unnest([0, 1]) AS load_no FROM supplier)",
    **{t: t for t in ("orders", "lineitem", "events", "part")},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, _, suffix = name.partition("_loads")
    df = table(spark, sf_dir, base)
    if "_loads" not in name:
        return df
    loads = 3 if base == "customer" else 2
    return df.withColumn("load_no", F.explode(F.array(*[F.lit(i) for i in range(loads)])))


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A silver view."""
    text = SILVER_SQL[name]
    used = {n: _input(spark, sf_dir, n) for n in _DUCK_INPUTS if "{" + n + "}" in text}
    return spark.sql(text, **used)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw shape of a silver view: every column is text."""
    text = RAW_SQL[name].replace(f"FROM {name}", "FROM {view}")
    return spark.sql(text, view=silver(spark, sf_dir, name))


def with_views(query: str, *names: str) -> str:
    """A DuckDB query with the silver views it names in front."""
    ctes = [f"{n} AS ({SILVER_SQL[n].format(**_DUCK_INPUTS)})" for n in names]
    return "WITH " + ",\n".join(ctes) + "\n" + query
