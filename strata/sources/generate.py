"""Synthetic patient admissions, generated on the executors.

Rows come from a frame of integer ids (``spark.range(n)`` or the keys of a
given table), and every value is a pick by a hash of the id and the column's
salt — no driver-side loop, no random state, so the result is the same however
the ids are partitioned and it scales past what a driver could hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The value domains of the synthetic healthcare dataset.
CONDITIONS = ["Diabetes", "Hypertension", "Asthma", "Arthritis", "Cancer", "Obesity"]
HOSPITALS = ["Smith Medical Center", "Johnson Hospital", "Williams Clinic",
             "Brown Healthcare", "Jones Memorial Hospital", "Davis Medical Group"]
DOCTORS = ["Dr. Michael Smith", "Dr. Sarah Johnson", "Dr. David Williams", "Dr. Emily Brown",
           "Dr. Robert Jones", "Dr. Jennifer Davis", "Dr. James Wilson", "Dr. Jessica Taylor"]
INSURERS = ["Aetna", "Blue Cross", "Cigna", "UnitedHealthcare", "Medicare"]
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
GENDERS = ["Male", "Female"]
ADMISSION_TYPES = ["Emergency", "Elective", "Urgent"]
MEDICATIONS = ["Aspirin", "Ibuprofen", "Paracetamol", "Penicillin", "Lipitor"]
TEST_RESULTS = ["Normal", "Abnormal", "Inconclusive"]
FIRST_NAMES = ["Pavan", "Rahul", "Sneha", "Arjun", "Meena", "Priya", "Ravi", "John", "Emily", "Sarah",
               "Michael", "Jessica", "David", "Lisa", "Robert", "Jennifer", "James", "Mary", "William", "Linda"]
LAST_NAMES = ["Reddy", "Kumar", "Sharma", "Patel", "Singh", "Smith", "Johnson", "Williams", "Brown",
              "Jones", "Davis", "Miller", "Wilson", "Taylor"]
CSV_HEADER = ["Name", "Age", "Gender", "Blood Type", "Medical Condition", "Date of Admission", "Doctor",
              "Hospital", "Insurance Provider", "Billing Amount", "Room Number", "Admission Type",
              "Discharge Date", "Medication", "Test Results"]
START_DATE = "2023-01-01"
ADMISSION_SPAN_DAYS = 731      # admission = start + 0..730 days
STAY_DAYS = (1, 30)
AGE_RANGE = (18, 85)
BILLING_RANGE = (1000, 50000)  # two decimals
ROOM_RANGE = (100, 500)

# Hex digits of a hash that make one pick: 48 bits, so a pick of up to 10**7 values is even to 1 in 10**7.
HASH_DIGITS = 12


def mix(id_col: Column, salt: int) -> Column:
    """A number from a hash of the id and a salt: independent between salts, with no period over the ids."""
    digest = F.sha2(F.concat(id_col.cast("string"), F.lit(f":{salt}")), 256)
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def pick(values: list[str], id_col: Column, salt: int) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(mix(id_col, salt), F.lit(len(values))) + 1).cast("int"))


def between(lo: int, hi: int, id_col: Column, salt: int) -> Column:
    return (F.lit(lo) + F.pmod(mix(id_col, salt), F.lit(hi - lo + 1))).cast("int")


def gen_patients(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """One patient admission per id, with the 15 CSV header columns."""
    i = F.col(id_col).cast("bigint")
    admission = F.date_add(F.lit(START_DATE).cast("date"), between(0, ADMISSION_SPAN_DAYS - 1, i, 6))
    billing_cents = F.lit(BILLING_RANGE[0] * 100) + F.pmod(
        mix(i, 10), F.lit((BILLING_RANGE[1] - BILLING_RANGE[0]) * 100 + 1))
    return ids.select(
        F.concat_ws(" ", pick(FIRST_NAMES, i, 1), pick(LAST_NAMES, i, 2)).alias("Name"),
        between(*AGE_RANGE, i, 3).alias("Age"),
        pick(GENDERS, i, 4).alias("Gender"),
        pick(BLOOD_TYPES, i, 5).alias("Blood Type"),
        pick(CONDITIONS, i, 7).alias("Medical Condition"),
        admission.alias("Date of Admission"),
        pick(DOCTORS, i, 8).alias("Doctor"),
        pick(HOSPITALS, i, 9).alias("Hospital"),
        pick(INSURERS, i, 12).alias("Insurance Provider"),
        (billing_cents / 100.0).alias("Billing Amount"),
        between(*ROOM_RANGE, i, 13).alias("Room Number"),
        pick(ADMISSION_TYPES, i, 14).alias("Admission Type"),
        F.date_add(admission, between(*STAY_DAYS, i, 15)).alias("Discharge Date"),
        pick(MEDICATIONS, i, 16).alias("Medication"),
        pick(TEST_RESULTS, i, 17).alias("Test Results"),
    )
