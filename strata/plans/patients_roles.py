"""Patient admissions, role-driven variant: columns are found by keyword and type.

Bronze keeps the raw header names and adds lineage plus a row hash; silver
drops exact duplicates by hash, then standardises each column by the role its
name and type give it; four gold tables use whatever measures the schema
offers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.derive import bucketize, stay_days
from strata.operators.bronze import audit_columns, business_columns, surrogate_id, with_row_hash
from strata.operators.clean import RoleRule, resolve_roles, role_transform, trim_all_strings
from strata.operators.dedup import dedup_hash
from strata.operators.gold import Measure, group_summary, measures_for
from strata.operators.quality import layer_report
from strata.plans.layout import LayerLayout
from strata.plans.patients import RAW_SCHEMA
from strata.sources.readers import read_csv, read_layer
from strata.sources.sinks import write_all, write_counted

STRING = ("string",)
# Role keywords matched against lower-cased column names.
ROLE_RULES = (
    RoleRule("proper", ("name", "doctor", "hospital"), STRING),
    RoleRule("upper", ("blood", "type", "gender", "result"), STRING),
    RoleRule("date", ("date",), whole_word=True),
    # "Admission Type" is text, not a date.
    RoleRule("date", ("admission", "discharge"), exclude=("type", "reason", "source")),
    RoleRule("double", ("billing", "amount")),
    RoleRule("int", ("age", "room"), whole_word=True),
)
# Keywords of the condition column.
CONDITION_KEYWORDS = ("condition", "medical")
# Age and billing buckets (upper bounds exclusive).
AGE_BUCKETS = ((18, "Pediatric"), (40, "Young Adult"), (60, "Middle Aged"))
AGE_TOP = "Senior"
BILLING_BUCKETS = ((10000, "Low"), (25000, "Medium"), (40000, "High"))
BILLING_TOP = "Very High"


def bronze_patients(raw: DataFrame, source_file: str) -> DataFrame:
    """Raw columns + ``_ingested_at``, ``_source_file`` and ``_row_hash``."""
    hashed = with_row_hash(raw, business_columns(raw))
    return audit_columns(hashed, literals={"_source_file": source_file})


def _first(df: DataFrame, *must: str) -> str | None:
    return next((c for c in business_columns(df) if all(m in c.lower() for m in must)), None)


def silver_patients(bronze: DataFrame) -> DataFrame:
    """Hash dedup → trims → role standardisation → stay, age and billing buckets → audit.

    The bronze lineage columns are dropped before the dedup: they are batch
    constants, and without them the hash covers the whole row, so copies are
    removed by a keys-only hash aggregate.
    """
    deduped = dedup_hash(bronze.drop("_ingested_at", "_source_file"), "_row_hash", whole_row=True)
    df = trim_all_strings(deduped)
    roles = resolve_roles(df, ROLE_RULES)
    df = role_transform(df, roles, ["proper", "upper", "date", "double", "int"])
    derived = {}
    admission, discharge = _first(df, "admission", "date"), _first(df, "discharge", "date")
    if admission and discharge:
        derived["length_of_stay_days"] = stay_days(discharge, admission)
    age = _first(df, "age")
    if age:
        derived["age_group"] = bucketize(age, AGE_BUCKETS, AGE_TOP)
    billing = _first(df, "billing")
    if billing:
        derived["billing_category"] = bucketize(billing, BILLING_BUCKETS, BILLING_TOP)
    derived["_silver_processed_at"] = F.current_timestamp()
    df = surrogate_id(df.withColumns(derived), "_silver_record_id")
    return df.drop("_row_hash")


def _measures(df: DataFrame, count_name: str, with_age: bool, with_min_max: bool,
              with_stay: bool, exact: bool) -> list[Measure]:
    billing, age = _first(df, "billing"), _first(df, "age")
    spec: dict[str, list[Measure]] = {"*": [Measure(count_name, "count")]}
    if billing:
        spec[billing] = [Measure("avg_billing_amount", "avg", billing, 2, exact),
                         Measure("total_revenue", "sum", billing, 2, exact=True)]
        if with_min_max:
            spec[billing] += [Measure("min_billing", "min", billing, 2), Measure("max_billing", "max", billing, 2)]
    if with_age and age:
        spec[age] = [Measure("avg_age", "avg", age, 1, exact)]
    if with_stay:
        spec["length_of_stay_days"] = [Measure("avg_length_of_stay", "avg", "length_of_stay_days", 1, exact)]
    return measures_for(df.columns, spec)


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("_gold_processed_at", F.current_timestamp())


def gold_condition_analytics(silver: DataFrame, exact: bool = False) -> DataFrame | None:
    cond = next((c for c in business_columns(silver) if any(k in c.lower() for k in CONDITION_KEYWORDS)), None)
    if cond is None:
        return None
    ms = _measures(silver, "total_admissions", False, False, True, exact)
    age = _first(silver, "age")
    if age:
        ms += [Measure("avg_age", "avg", age, 1, exact),
               Measure("min_age", "min", age), Measure("max_age", "max", age)]
    return _stamp(group_summary(silver, [F.col(cond).alias("medical_condition")], ms,
                                order_by=[F.col("total_admissions").desc()]))


def gold_hospital_metrics(silver: DataFrame, exact: bool = False) -> DataFrame | None:
    hosp = _first(silver, "hospital")
    if hosp is None:
        return None
    return _stamp(group_summary(silver, [F.col(hosp).alias("hospital")],
                                _measures(silver, "total_patients", False, False, True, exact),
                                order_by=[F.col("total_patients").desc()]))


def gold_insurer_revenue(silver: DataFrame, exact: bool = False) -> DataFrame | None:
    ins = _first(silver, "insurance")
    if ins is None:
        return None
    return _stamp(group_summary(silver, [F.col(ins).alias("insurance_provider")],
                                _measures(silver, "total_patients", False, True, False, exact),
                                order_by=[F.col("total_revenue").desc()]))


def gold_demographics(silver: DataFrame, exact: bool = False) -> DataFrame | None:
    gender = _first(silver, "gender")
    if gender is None or "age_group" not in silver.columns:
        return None
    return _stamp(group_summary(silver, ["age_group", F.col(gender).alias("gender")],
                                _measures(silver, "patient_count", True, False, True, exact),
                                order_by=["age_group", "gender"]))


def run(spark: SparkSession, csv_path: str, layout: LayerLayout, schema: str | None = RAW_SCHEMA) -> DataFrame:
    """Multi-line CSV → bronze → silver → four gold tables; skipped gold tables report N/A.

    ``schema=None`` infers the columns, for files of another shape (one more pass over the file).
    """
    raw = read_csv(spark, csv_path, schema=schema, infer=schema is None, multiline=True)
    bronze_spec = layout.spec("bronze", "patients_raw")
    write_counted(bronze_patients(raw, csv_path.rsplit("/", 1)[-1]), bronze_spec)
    bronze = read_layer(spark, bronze_spec.target, layout.format)
    silver_spec = layout.spec("silver", "patients_cleaned")
    write_counted(silver_patients(bronze), silver_spec)
    silver = read_layer(spark, silver_spec.target, layout.format)
    gold = {
        "condition_analytics": (gold_condition_analytics(silver), layout.spec("gold", "condition_analytics")),
        "hospital_metrics": (gold_hospital_metrics(silver), layout.spec("gold", "hospital_metrics")),
        "insurer_revenue": (gold_insurer_revenue(silver), layout.spec("gold", "insurer_revenue")),
        "demographics": (gold_demographics(silver), layout.spec("gold", "demographics")),
    }
    write_all(spark, gold)
    entries = [("bronze", "patients_raw", bronze), ("silver", "patients_cleaned", silver)]
    entries += [("gold", n, read_layer(spark, s.target, layout.format) if df is not None else None)
                for n, (df, s) in gold.items()]
    return layer_report(entries, baseline=("bronze", "patients_raw"))
