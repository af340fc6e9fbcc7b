"""Silver tables: raw column, stored column and type."""

from __future__ import annotations

from tristrata.operators.conform import Contract

# Names and types of the raw and silver columns.
SILVER = {
    c.table: c
    for c in (
        Contract(
            table="appointment",
            raw="appointments",
            columns="appointment_id:int, patient_id:int, doctor_id:int, appointment_date:string, "
            "start_time:string, end_time:string, reason:string, status:string, phone:string, "
            "location:string, appointment_type:string",
            keys=("appointment_id",),
        ),
        Contract(
            table="diseases",
            raw="diseases",
            columns="disease_id:int, patient_id:int, disease_name:string, diagnosis_date:string",
            keys=("disease_id",),
        ),
        Contract(
            table="doctors",
            raw="doctors",
            columns="doctor_id:int, Name->doctor_name:string, "
            "specialization->doctor_specialization:string, phone->doctor_phone:string, "
            "email->doctor_email:string",
            keys=("doctor_id",),
        ),
        Contract(
            table="hospital_fee",
            raw="hospital_fee",
            columns="fee_id:string, appointment_id:int, patient_id:int, service_type:string, "
            "description:string, amount:float, fee_date:string, phone:string",
            keys=("fee_id",),
        ),
        Contract(
            table="lab_results",
            raw="lab_results",
            columns="lab_result_id:string, appointment_id:int, patient_id:int, test_type:string, "
            "parameter:string, value:string, unit:string, normal_range:string, "
            "interpretation:string, test_date:string",
            keys=("lab_result_id",),
            defaults={"unit": "Unknown"},
        ),
        Contract(
            table="patient",
            raw="patient",
            columns="patient_id:int, name->patient_name:string, gender->patient_gender:string, "
            "dob->patient_dob:string, address->patient_address:string, "
            "phone->patient_phone:string, email->patient_email:string",
            keys=("patient_id",),
        ),
        Contract(
            table="treatments",
            raw="treatments",
            columns="treatment_id:int, patient_id:int, doctor_id:int, disease_id:int, "
            "treatment_description:string, treatment_date:string",
            keys=("treatment_id",),
        ),
        Contract(
            table="vital_signs",
            raw="vital_signs",
            columns="vital_id:int, patient_id:int, measurement_date:string, "
            "blood_pressure:string, heart_rate:int, respiratory_rate:int, temperature:float, "
            "oxygen_saturation:int, blood_sugar:int",
            keys=("vital_id",),
        ),
    )
}
