"""AI-jobs study: explicit-schema CSV → table → high-adoption salary-drop report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.operators.dedup import distinct_count

# The 20 columns of the study, in file order.
_INT = ("job_id", "year", "education_requirement_level")
_STR = ("job_role", "industry", "country", "automation_risk_category")
STUDY_COLUMNS = ("job_id", "job_role", "industry", "country", "year", "automation_risk_percent",
                 "automation_risk_category", "ai_replacement_score", "skill_gap_index", "salary_before_usd",
                 "salary_after_usd", "salary_change_percent", "skill_demand_growth_percent",
                 "remote_feasibility_score", "education_requirement_level", "ai_adoption_level",
                 "skill_transition_pressure", "wage_volatility_index", "reskilling_urgency_score",
                 "ai_disruption_intensity")
STUDY_SCHEMA = StructType([
    StructField(c, IntegerType() if c in _INT else StringType() if c in _STR else DoubleType(), True)
    for c in STUDY_COLUMNS
])
AI_ADOPTION_THRESHOLD = 70


def high_adoption_salary_drop(df: DataFrame, threshold: float = AI_ADOPTION_THRESHOLD) -> DataFrame:
    """Jobs with adoption ≥ threshold whose salary fell; rounded report sorted by the
    unrounded change (a column the projection no longer shows)."""
    return (
        df.filter((F.col("ai_adoption_level") >= threshold) & (F.col("salary_change_percent") < 0))
        .select("job_id", "job_role", "industry", "country", "year",
                F.round("ai_adoption_level", 2).alias("ai_adoption_level"),
                F.round("salary_before_usd", 2).alias("salary_before_usd"),
                F.round("salary_after_usd", 2).alias("salary_after_usd"),
                F.round("salary_change_percent", 2).alias("salary_change_pct"),
                "automation_risk_category")
        .orderBy(F.col("salary_change_percent").asc(), "job_id")
    )


def distinct_roles(report: DataFrame) -> DataFrame:
    return distinct_count(report, "job_role", "distinct_job_roles")
