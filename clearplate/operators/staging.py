"""Typed, cleaned and deduplicated records, and the two reference lists taken from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.functions.cast import to_day, to_decimal, to_whole_number
from clearplate.functions.latest import top_per_key
from clearplate.functions.text import blank_to_null, concat_ws_strict, initcap_ext

# One record per restaurant, visit and citation.
BUSINESS_KEY = [
    "restaurant_id", "inspection_date", "inspection_type", "action",
    "violation_code", "is_critical_violation", "record_date",
]
PROFILE = [
    "restaurant_id", "restaurant_name", "borough", "building_number", "street_name", "zipcode",
    "phone", "cuisine_description", "latitude", "longitude", "neighborhood_code",
]


def clean_inspections(raw: DataFrame) -> DataFrame:
    """Typed columns from all-string records; records without an id are dropped."""
    flag = F.upper(F.trim("critical_flag"))
    return raw.filter(F.trim("camis") != "").select(
        F.col("camis").alias("restaurant_id"),
        F.trim(F.upper("dba")).alias("restaurant_name"),
        initcap_ext(F.trim("boro")).alias("borough"),
        F.trim("building").alias("building_number"),
        initcap_ext(F.trim("street")).alias("street_name"),
        F.lpad(F.trim("zipcode"), 5, "0").alias("zipcode"),
        F.trim("phone").alias("phone"),
        initcap_ext(F.trim("cuisine_description")).alias("cuisine_description"),
        to_decimal(F.trim("latitude"), 10, 7).alias("latitude"),
        to_decimal(F.trim("longitude"), 10, 7).alias("longitude"),
        F.trim("nta").alias("neighborhood_code"),
        to_day(F.col("inspection_date")).alias("inspection_date"),
        F.trim("inspection_type").alias("inspection_type"),
        F.trim("action").alias("action"),
        F.trim("violation_code").alias("violation_code"),
        F.trim("violation_description").alias("violation_description"),
        F.when(flag == "CRITICAL", True).when(flag == "NOT CRITICAL", False).alias("is_critical_violation"),
        to_whole_number(F.trim("score")).alias("inspection_score"),
        blank_to_null(F.trim("grade")).alias("grade"),
        to_day(F.col("grade_date")).alias("grade_date"),
        to_day(F.col("record_date")).alias("record_date"),
        F.col("_loaded_at").alias("loaded_at"),
    )


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key: first by ``order`` (column, 'asc' or 'desc'), then by all other columns, so that the winner is always the same. NULLs come last."""
    ranked = [n for n, _ in order]
    ways = [*order, *[(c, "asc") for c in df.columns if c not in keys and c not in ranked]]
    return top_per_key(df, keys, [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in ways])


def stage_inspections(raw: DataFrame) -> DataFrame:
    """Clean records, one per business key: newest load, then highest score."""
    order = [("loaded_at", "desc"), ("inspection_score", "desc"), ("violation_description", "asc"), ("grade", "asc"), ("grade_date", "asc")]
    return dedupe_latest(clean_inspections(raw), BUSINESS_KEY, order)


def _recency(day: str, time: str) -> Column:
    """A number that orders (day, time) as the pair does; a NULL comes before all others."""
    none = F.lit(-(10**7)).cast("long")  # before the first day that a date can hold
    days = lambda c: F.coalesce(F.unix_date(c).cast("long"), none)
    whole = days(F.to_date(time)) * 86400 + F.coalesce(F.hour(time) * 3600 + F.minute(time) * 60, F.lit(0))
    seconds = whole.cast("decimal(20,6)") + F.coalesce(F.date_part(F.lit("SECOND"), F.col(time)), F.lit(0).cast("decimal(8,6)"))
    return (days(F.col(day)).cast("decimal(10,0)") * F.lit(10**13).cast("decimal(14,0)") + seconds).cast("decimal(38,6)")


def latest_profile(stg: DataFrame) -> DataFrame:
    """Latest known profile of each restaurant: newest record, then newest load.

    Each profile is first cut to its newest mention, a number that a hash aggregate can hold;
    sorting all records by restaurant to find the same would outgrow a task.
    """
    rows = stg.select(*PROFILE, "record_date", "loaded_at").filter(F.col("restaurant_id").isNotNull())
    seen = rows.groupBy(*PROFILE).agg(F.max(_recency("record_date", "loaded_at")).alias("_newest"))
    return dedupe_latest(seen, ["restaurant_id"], [("_newest", "desc")]).select(
        *PROFILE, concat_ws_strict(" ", F.col("building_number"), F.col("street_name")).alias("street_address")
    )


def reference_codes(stg: DataFrame) -> DataFrame:
    """One description and flag per violation code: critical before not critical before unknown."""
    columns = ["violation_code", "violation_description", "is_critical_violation"]
    rows = stg.select(*columns).filter(F.trim("violation_code") != "").distinct()
    return dedupe_latest(rows, ["violation_code"], [("is_critical_violation", "desc")])
