"""The twelve standing business questions, written directly on the star schema.

Each first sums the fact by foreign key and only then joins the restaurants, which
grow with the data; the calendar has a fixed size and is broadcast. Options cover the
variant form of the same questions: ``exclude_unknown`` drops borough '0', ``digits``
sets the rounding, ``labelled`` adds the criticality label.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.functions.cast import percent
from clearplate.plans.build import Marts, within_days


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _year_start(as_of: str) -> Column:
    return F.trunc(F.lit(as_of).cast("date"), "year")


def _since(as_of: str, months: int) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -months)


def _up_to(fact: DataFrame, first: Column, as_of: str) -> DataFrame:
    """Rows from ``first`` to the reporting date, both included."""
    return within_days(fact, first, F.lit(as_of).cast("date"))


def _maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def on_calendar(fact: DataFrame) -> DataFrame:
    """Rows whose day is in the calendar; all that a join for the day alone would do."""
    return fact.filter(F.col("inspection_date_key").isNotNull())


def with_calendar(fact: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    right = dates.select(F.col("date_key").alias("inspection_date_key"), *columns)
    return fact.join(F.broadcast(right), "inspection_date_key")


def sums_by_restaurant(
    fact: DataFrame, restaurants: DataFrame, group: Sequence[str], attributes: Sequence[str], sums: Mapping[str, Column], maxima: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums (and maxima) of a fact by restaurant attributes and own columns.

    ``restaurants_seen`` counts the restaurants behind each group.
    """
    maxima = maxima or {}
    small = fact.groupBy("dim_restaurant_key", *group).agg(*[c.alias(n) for n, c in {**sums, **maxima}.items()])
    joined = small.join(restaurants.select("dim_restaurant_key", *attributes), "dim_restaurant_key")
    return joined.groupBy(*attributes, *group).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima], _n().alias("restaurants_seen")
    )


def _restaurants(m: Marts, exclude_unknown: bool = False) -> DataFrame:
    r = m.dim_restaurant.withColumnRenamed("cuisine_description", "cuisine_type")
    return r.filter(F.col("borough") != "0") if exclude_unknown else r


def _critical_citations() -> Column:
    return F.sum(F.when(F.col("is_critical_violation"), F.col("violation_count")).otherwise(0))


def grade_distribution(m: Marts) -> DataFrame:
    graded = m.fct_inspections.filter(F.col("grade").isin("A", "B", "C"))
    out = sums_by_restaurant(graded, _restaurants(m), ["grade"], ["borough"], {"inspection_count": _n()})
    return out.select("borough", "grade", "inspection_count").orderBy("borough", "grade")


def grade_a_rate(m: Marts, exclude_unknown: bool = False, digits: int | None = None) -> DataFrame:
    out = sums_by_restaurant(
        m.fct_inspections, _restaurants(m, exclude_unknown), [], ["borough"], {"passed": _n(F.col("passed_with_grade_a")), "total_inspections": _n()}
    )
    rate = _maybe_round(percent(F.col("passed"), F.col("total_inspections")), digits)
    return out.select("borough", rate.alias("grade_a_pass_rate"), "total_inspections").orderBy(F.desc_nulls_last("grade_a_pass_rate"), "borough")


def top_critical_violations(m: Marts, k: int = 10, labelled: bool = False) -> DataFrame:
    cited = m.fct_violations.filter("is_critical_violation").groupBy("dim_violation_key").agg(F.sum("violation_count").alias("citation_count"))
    label = ["criticality_label"] if labelled else []
    named = cited.join(m.dim_violation_type, "dim_violation_key").select("violation_code", "violation_description", *label, "citation_count")
    return named.orderBy(F.desc_nulls_last("citation_count"), "violation_code").limit(k)


def critical_by_cuisine(m: Marts, at_least: int = 100, k: int = 15) -> DataFrame:
    out = sums_by_restaurant(
        m.fct_violations, _restaurants(m), [], ["cuisine_type"], {"critical_citations": _critical_citations(), "total_citations": F.sum("violation_count")}
    )
    share = F.round(percent(F.col("critical_citations"), F.col("total_citations")), 1)
    return (
        out.filter(F.col("total_citations") >= at_least)
        .select("cuisine_type", "critical_citations", "total_citations", share.alias("critical_share_pct"))
        .orderBy(F.desc_nulls_last("critical_citations"), F.asc_nulls_last("cuisine_type")).limit(k)
    )


def closure_rate(m: Marts, exclude_unknown: bool = False) -> DataFrame:
    closed = F.col("action").ilike("%Establishment Closed%")
    out = sums_by_restaurant(m.fct_inspections, _restaurants(m, exclude_unknown), [], ["borough"], {"total_inspections": _n(), "closures": _n(closed)})
    rate = F.round(percent(F.col("closures"), F.col("total_inspections")), 2)
    return out.select("borough", "total_inspections", "closures", rate.alias("closure_rate_pct")).orderBy(F.desc_nulls_last("closure_rate_pct"), "borough")


def re_inspection_rate(m: Marts, as_of: str, exclude_unknown: bool = False) -> DataFrame:
    again = F.col("inspection_type").ilike("%Re-Inspection%")
    this_year = _up_to(on_calendar(m.fct_inspections), _year_start(as_of), as_of)
    out = sums_by_restaurant(this_year, _restaurants(m, exclude_unknown), [], ["borough"], {"total_inspections": _n(), "re_inspections": _n(again)})
    rate = F.round(percent(F.col("re_inspections"), F.col("total_inspections")), 2)
    return out.select("borough", "total_inspections", "re_inspections", rate.alias("re_inspection_rate_pct")).orderBy(F.desc_nulls_last("re_inspection_rate_pct"), "borough")


def monthly_trend(m: Marts, as_of: str) -> DataFrame:
    # The year condition is repeated on the fact's own day, where the scan can use it.
    first = F.trunc(_since(as_of, 12), "year")
    recent = _up_to(m.fct_inspections, first, as_of)
    return (
        with_calendar(recent, m.dim_date, "year_number", "month_name", "month_number")
        .groupBy("year_number", "month_name", "month_number")
        .agg(
            _n().alias("inspections"),
            F.round(F.avg("inspection_score"), 1).alias("avg_score"),
            F.round(percent(_n(F.col("passed_with_grade_a")), _n()), 1).alias("grade_a_rate"),
        )
        .orderBy("year_number", "month_number")
    )


def quarterly_critical_trend(m: Marts, as_of: str, borough: str = "Brooklyn") -> DataFrame:
    first = F.trunc(_since(as_of, 24), "year")
    cited = with_calendar(_up_to(m.fct_violations, first, as_of), m.dim_date, "year_number", "quarter_label")
    out = sums_by_restaurant(
        cited, _restaurants(m).filter(F.col("borough") == borough), ["year_number", "quarter_label"], ["borough"],
        {"critical_citations": _critical_citations(), "total_citations": F.sum("violation_count")},
    )
    share = F.round(percent(F.col("critical_citations"), F.col("total_citations")), 1)
    return out.select("year_number", "quarter_label", "critical_citations", "total_citations", share.alias("critical_share_pct")).orderBy("year_number", "quarter_label")


def zip_hotspots(m: Marts, as_of: str, at_least: int = 20, k: int = 20) -> DataFrame:
    cited = _up_to(on_calendar(m.fct_violations), _since(as_of, 12), as_of)
    located = _restaurants(m).filter(F.col("zipcode").isNotNull())
    out = sums_by_restaurant(cited, located, [], ["zipcode", "borough"], {"critical_citations": _critical_citations()})
    rate = F.round(F.col("critical_citations") * F.lit(1.0) / F.nullif("restaurants_seen", F.lit(0)), 1)
    return (
        out.filter(F.col("restaurants_seen") >= at_least)
        .select("zipcode", "borough", F.col("restaurants_seen").alias("restaurants"), "critical_citations", rate.alias("critical_per_restaurant"))
        .orderBy(F.desc_nulls_last("critical_per_restaurant"), "zipcode", F.asc_nulls_last("borough")).limit(k)
    )


WHO = ["restaurant_name", "borough", "cuisine_type", "street_address"]


def _who_order() -> list[Column]:
    return [F.asc_nulls_last(c) for c in WHO]


def highest_risk(m: Marts, as_of: str, at_least: int = 2, k: int = 20, digits: int = 1) -> DataFrame:
    scored = _up_to(on_calendar(m.fct_inspections), _year_start(as_of), as_of).filter(F.col("inspection_score").isNotNull())
    sums = {"score_sum": F.sum("inspection_score"), "total_critical": F.sum("critical_violations"), "inspections_this_year": _n()}
    out = sums_by_restaurant(scored, _restaurants(m), [], WHO, sums, {"worst_score": F.max("inspection_score")})
    mean = F.round(F.col("score_sum") / F.col("inspections_this_year"), digits)
    return (
        out.filter(F.col("inspections_this_year") >= at_least)
        .select(*WHO, "worst_score", mean.alias("avg_score"), "total_critical", "inspections_this_year")
        .orderBy(F.desc_nulls_last("avg_score"), *_who_order()).limit(k)
    )


def repeat_closures(m: Marts, more_than: int = 1, k: int = 20) -> DataFrame:
    closed = m.fct_inspections.filter(F.col("action").ilike("%Establishment Closed%"))
    out = sums_by_restaurant(closed, _restaurants(m), [], WHO, {"closure_count": _n()})
    return (
        out.filter(F.col("closure_count") > more_than).select(*WHO, "closure_count")
        .orderBy(F.desc_nulls_last("closure_count"), *_who_order()).limit(k)
    )


def by_weekday(m: Marts, as_of: str) -> DataFrame:
    this_year = _up_to(m.fct_inspections, _year_start(as_of), as_of)
    dated = with_calendar(this_year, m.dim_date.withColumnRenamed("day_name_short", "day_name"), "day_name", "day_of_week")
    return (
        dated.groupBy("day_name", "day_of_week")
        .agg(_n().alias("inspections"), F.round(F.avg("inspection_score"), 1).alias("avg_score")).orderBy("day_of_week")
    )
