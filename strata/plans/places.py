"""Points of interest: Parquet → cleansed places (silver) → 3 gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import flag, safe_cast
from strata.functions.text import digits_and_plus
from strata.operators.bronze import audit_columns
from strata.operators.gold import (
    Measure, distinct_measure, group_summary, with_completeness, with_pct_of_total,
)
from strata.operators.quality import flag_rows, layer_report, quarantine_split
from strata.plans.layout import LayerLayout
from strata.sources.readers import read_layer
from strata.sources.sinks import write_all, write_counted, write_flag_split

# The text columns of a place, trimmed in silver.
TEXT_COLUMNS = ("id", "name", "address", "city", "state", "zip", "country", "url", "phone",
                "categories", "point_of_interest")
SILVER_COLUMNS = ("id", "name", "latitude", "longitude", "address", "city", "state", "zip", "country",
                  "url", "phone", "phone_clean", "categories", "point_of_interest",
                  "has_address", "has_contact", "ingested_at", "silver_ingested_at")


def bronze_places(raw: DataFrame) -> DataFrame:
    return audit_columns(raw, timestamp="ingested_at")


def has_contact(strict: bool = False):
    """Whether the trimmed phone or url is there; ``strict``: holds text."""
    if strict:
        return flag((F.length("phone") > 0) | (F.length("url") > 0))
    return flag(F.col("phone").isNotNull() | F.col("url").isNotNull())


def silver_places(bronze: DataFrame, strict_contact: bool = False) -> DataFrame:
    """Trim text, upper-case country, double coordinates, phone digits, completeness flags.

    ``has_address`` needs non-empty text while ``has_contact`` accepts an empty
    phone or url, as the flow defines them; ``strict_contact`` requires text.
    """
    cleaned = {c: F.trim(F.col(c)) for c in TEXT_COLUMNS}
    cleaned["country"] = F.upper(F.trim(F.col("country")))
    cleaned["latitude"] = safe_cast("latitude", "double")
    cleaned["longitude"] = safe_cast("longitude", "double")
    df = bronze.withColumns(cleaned)
    return df.withColumns({
        "phone_clean": digits_and_plus("phone"),
        "has_address": flag(F.col("address").isNotNull() & (F.length("address") > 0)),
        "has_contact": has_contact(strict_contact),
        "silver_ingested_at": F.current_timestamp(),
    }).select(*SILVER_COLUMNS)


def quarantine_conditions():
    """Missing id, name or country; missing or out-of-range coordinates."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return [F.col("id").isNull(), F.col("id") == "", F.col("name").isNull(), F.col("name") == "",
            lat.isNull(), lat < -90, lat > 90, lon.isNull(), lon < -180, lon > 180,
            F.col("country").isNull(), F.col("country") == ""]


def split_places(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quarantine_split(silver, quarantine_conditions())


def not_blank(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def gold_country_summary(silver: DataFrame, exact: bool = False, approximate: bool = False) -> DataFrame:
    """Per country: places, cities, categories, mean coordinates, completeness, share of all places."""
    g = group_summary(silver, ["country"], [
        Measure("poi_count", "count"),
        distinct_measure("unique_cities", "city", approximate),
        distinct_measure("unique_categories", "categories", approximate),
        Measure("avg_latitude", "avg", "latitude", round=4, exact=exact),
        Measure("avg_longitude", "avg", "longitude", round=4, exact=exact),
        Measure("with_address", "count_if", F.col("has_address")),
        Measure("with_contact", "count_if", F.col("has_contact")),
    ])
    g = with_pct_of_total(g, "poi_count")
    g = with_completeness(g, {"address_completeness_pct": ("with_address", "poi_count"),
                              "contact_completeness_pct": ("with_contact", "poi_count")})
    return g.orderBy(F.col("poi_count").desc())


def gold_category_distribution(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Per non-blank category; the share is of **all** places, blank categories included."""
    g = group_summary(silver, ["categories"], [
        Measure("poi_count", "count"),
        distinct_measure("countries_present", "country", approximate),
        distinct_measure("unique_cities", "city", approximate),
    ])
    return with_pct_of_total(g, "poi_count").filter(not_blank("categories")).orderBy(F.col("poi_count").desc(), "categories")


def gold_city_density(silver: DataFrame, exact: bool = False, approximate: bool = False) -> DataFrame:
    """Per non-blank (city, state, country): places, categories and centre coordinates."""
    return group_summary(silver.filter(not_blank("city")), ["city", "state", "country"], [
        Measure("poi_count", "count"),
        distinct_measure("unique_categories", "categories", approximate),
        Measure("center_latitude", "avg", "latitude", round=6, exact=exact),
        Measure("center_longitude", "avg", "longitude", round=6, exact=exact),
    ], order_by=[F.col("poi_count").desc()])


SPLIT_FLAG = "_is_quarantined"


def split_root(layout: LayerLayout) -> str:
    """Both sides of the split are written in one job below this folder, which lies beside the layers."""
    return layout.spec("split", "places").target


def layer_locations(layout: LayerLayout) -> dict[str, str]:
    """Where ``run`` leaves each layer."""
    root = split_root(layout)
    return {"bronze": layout.spec("bronze", "places").target, "silver": f"{root}/{SPLIT_FLAG}=false",
            "quarantine": f"{root}/{SPLIT_FLAG}=true"}


def run(spark: SparkSession, raw: DataFrame, layout: LayerLayout) -> DataFrame:
    bronze_spec = layout.spec("bronze", "places")
    write_counted(bronze_places(raw), bronze_spec)
    bronze = read_layer(spark, bronze_spec.target, layout.format)
    flagged = flag_rows(silver_places(bronze), quarantine_conditions(), SPLIT_FLAG)
    silver_path, quarantine_path = write_flag_split(flagged, SPLIT_FLAG, split_root(layout), layout.format)
    silver = read_layer(spark, silver_path, layout.format)
    gold = {
        "country_summary": (gold_country_summary(silver), layout.spec("gold", "country_summary")),
        "category_distribution": (gold_category_distribution(silver),
                                  layout.spec("gold", "category_distribution")),
        "city_density": (gold_city_density(silver), layout.spec("gold", "city_density")),
    }
    write_all(spark, gold)
    entries = [("bronze", "places", bronze), ("silver", "places", silver),
               ("quarantine", "places", read_layer(spark, quarantine_path, layout.format))]
    entries += [("gold", n, read_layer(spark, s.target, layout.format)) for n, (_, s) in gold.items()]
    return layer_report(entries, baseline=("bronze", "places"))
