"""Star schema: three dimensions and two facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.functions.text import concat_ws_strict

# The date spine covers 2000-01-01 to 2030-12-31, 11,323 days.
SPINE_START, SPINE_END = "2000-01-01", "2030-12-31"


def dim_restaurant(profile: DataFrame) -> DataFrame:
    return profile.select(
        F.md5("restaurant_id").alias("dim_restaurant_key"),
        "restaurant_id", "restaurant_name", "borough", "street_address", "building_number", "street_name",
        "zipcode", "phone", "cuisine_description", "latitude", "longitude", "neighborhood_code",
    )


def dim_violation_type(codes: DataFrame) -> DataFrame:
    critical = F.col("is_critical_violation")
    label = F.when(critical, "Critical").when(~critical, "Not Critical").otherwise("Not Applicable")
    return codes.select(
        F.md5("violation_code").alias("dim_violation_key"),
        "violation_code", "violation_description", "is_critical_violation", label.alias("criticality_label"),
    )


def dim_date(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """Calendar with one row per day. Its size depends on the two dates only, so it may be broadcast."""
    d = F.col("calendar_date")
    weekday = F.dayofweek(d) - 1
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("calendar_date")
    )
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        (F.year(d) * 100 + F.quarter(d)).alias("year_quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_label"),
        F.month(d).alias("month_number"),
        (F.year(d) * 100 + F.month(d)).alias("year_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "E").alias("day_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        weekday.isin(0, 6).alias("is_weekend"),
        (d == F.trunc(d, "month")).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    )


def with_date_key(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Left join to the calendar; a day outside it gets a NULL key."""
    keys = dates.select(F.col("calendar_date").alias("inspection_date"), F.col("date_key").alias("inspection_date_key"))
    return df.join(F.broadcast(keys), "inspection_date", "left")


def _inspection_parts() -> list:
    return [
        F.col("restaurant_id"), F.col("inspection_date").cast("string"), F.col("inspection_type"),
        F.coalesce("action", F.lit("")),
    ]


def _arranged(rows: DataFrame, arrange: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, list[str]]:
    """Rows as ``arrange`` places them, and the columns it added."""
    placed = arrange(rows) if arrange else rows
    return placed, [c for c in placed.columns if c not in rows.columns]


def fct_inspections(stg: DataFrame, dates: DataFrame, arrange: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per visit and outcome, with counts of its citations.

    ``arrange`` places the rows and may add columns. It comes before the keys are made: they
    are hashes, which compress badly, and a shuffle or sort of them costs more than of their rows.
    """
    critical = F.col("is_critical_violation")
    visits = (
        stg.filter(F.col("inspection_date").isNotNull() & F.col("inspection_type").isNotNull())
        .groupBy("restaurant_id", "inspection_date", "inspection_type", "action", "grade", "grade_date")
        .agg(
            F.max("inspection_score").alias("inspection_score"),
            F.count("violation_code").alias("total_violations"),
            F.count_if(critical).alias("critical_violations"),
            F.count_if(~critical).alias("non_critical_violations"),
        )
    )
    grade = F.col("grade")
    visits, extra = _arranged(visits, arrange)
    return with_date_key(visits, dates).select(
        F.md5(concat_ws_strict("|", *_inspection_parts())).alias("fct_inspection_key"),
        F.md5("restaurant_id").alias("dim_restaurant_key"),
        "inspection_date_key", "restaurant_id", "inspection_date", "inspection_type", "action", "grade", "grade_date",
        F.when(grade == "A", 1).when(grade == "B", 2).when(grade == "C", 3).alias("grade_sort_order"),
        "inspection_score", "total_violations", "critical_violations", "non_critical_violations",
        F.coalesce(grade == "A", F.lit(False)).alias("passed_with_grade_a"),
        (F.col("critical_violations") > 0).alias("has_critical_violation"), *extra,
    )


def fct_violations(stg: DataFrame, dates: DataFrame, arrange: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per citation; ``arrange`` as in :func:`fct_inspections`."""
    code = F.coalesce("violation_code", F.lit("NO_VIOLATION"))
    cited = stg.filter(F.col("violation_code").isNotNull() & F.col("inspection_type").isNotNull())
    cited = cited.select("restaurant_id", "inspection_date", "inspection_type", "action", "violation_code", "is_critical_violation", "inspection_score")
    cited, extra = _arranged(cited, arrange)
    return with_date_key(cited, dates).select(
        F.md5(concat_ws_strict("|", *_inspection_parts(), code)).alias("fct_violation_key"),
        F.md5("restaurant_id").alias("dim_restaurant_key"),
        F.md5(F.coalesce("violation_code", F.lit(""))).alias("dim_violation_key"),
        "inspection_date_key",
        F.md5(concat_ws_strict("|", *_inspection_parts())).alias("fct_inspection_key"),
        "restaurant_id", "inspection_date", "inspection_type", "action", "violation_code",
        F.lit(1).alias("violation_count"), "is_critical_violation", "inspection_score", *extra,
    )
