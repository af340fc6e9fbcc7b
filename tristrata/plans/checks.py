"""Checks declared for the gold tables."""

from __future__ import annotations

from tristrata.operators.quality import Check

# Columns that must be filled, and those that must be unique.
NOT_NULL = {
    "dim_date": ["date_key"],
    "dim_patient": ["patient_sk", "patient_nk"],
    "dim_doctor": ["doctor_sk", "doctor_nk"],
    "dim_disease": ["disease_sk", "disease_nk"],
    "dim_service": ["service_sk", "service_nk"],
    "dim_test": ["test_sk", "test_nk"],
    "dim_location": ["location_sk", "location_nk"],
    "fact_appointments": ["appointment_sk"],
    "fact_billing": ["fee_id"],
    "fact_lab_results": ["lab_result_id"],
    "fact_treatments": ["treatment_id"],
    "fact_vitals": ["vital_id"],
    "dim_patient_scd2": ["patient_sk", "patient_nk", "valid_from"],
    "dim_doctor_scd2": ["doctor_sk", "doctor_nk", "valid_from"],
}
UNIQUE = {
    "dim_date": ["date_key"],
    "dim_patient": ["patient_sk"],
    "dim_doctor": ["doctor_sk"],
    "dim_disease": ["disease_sk"],
    "dim_service": ["service_sk"],
    "dim_test": ["test_sk"],
    "dim_location": ["location_sk"],
    "fact_appointments": ["appointment_sk"],
    "fact_billing": ["fee_id"],
    "fact_lab_results": ["lab_result_id"],
    "fact_treatments": ["treatment_id"],
    "fact_vitals": ["vital_id"],
}

GOLD_CHECKS = tuple(
    Check(table, column, kind)
    for kind, declared in (("not_null", NOT_NULL), ("unique", UNIQUE))
    for table, columns in declared.items()
    for column in columns
)
