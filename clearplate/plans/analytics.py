"""Further questions the system answers: shares, comparisons, correlations, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearplate.functions.cast import percent
from clearplate.functions.latest import top_per_key
from clearplate.operators.semantic import SemanticLayer
from clearplate.plans.build import Marts
from clearplate.plans.verified import with_calendar


def critical_share_of_total(m: Marts, k: int = 15) -> DataFrame:
    """Most cited critical codes and their share of all citations (a scalar subquery, no join)."""
    total = m.fct_violations.agg(F.sum("violation_count").alias("n")).scalar()
    cited = m.fct_violations.filter("is_critical_violation").groupBy("dim_violation_key").agg(F.sum("violation_count").alias("citation_count"))
    named = cited.join(m.dim_violation_type.select("dim_violation_key", "violation_code", "violation_description"), "dim_violation_key")
    top = named.orderBy(F.desc("citation_count"), "violation_code").limit(k)
    return top.select("violation_code", "violation_description", "citation_count", percent(F.col("citation_count"), total).alias("share_pct"))


def quarter_compare(m: Marts, years: Sequence[int]) -> DataFrame:
    """Closure rate by quarter, years side by side."""
    dated = with_calendar(m.fct_inspections, m.dim_date.filter(F.col("year_number").isin(list(years))), "year_number", "quarter_label")
    closed = F.col("action").ilike("%Establishment Closed%")
    rates = dated.groupBy("quarter_label", "year_number").agg(percent(F.count_if(closed), F.count(F.lit(1))).alias("rate"))
    out = rates.groupBy("quarter_label").pivot("year_number", list(years)).agg(F.max("rate"))
    return out.select("quarter_label", *[F.col(str(y)).alias(f"closure_rate_{y}") for y in years]).orderBy("quarter_label")


def rate_score_correlation(layer: SemanticLayer) -> DataFrame:
    """Correlation of re-inspection rate and mean score over boroughs."""
    rates = layer.query(["re_inspection_rate", "average_score"], ["borough"], where=[("borough", lambda c: c != "0")])
    return rates.agg(F.corr("re_inspection_rate", "average_score").alias("correlation"), F.count(F.lit(1)).alias("boroughs"))


def worst_cuisines(layer: SemanticLayer, k: int = 10) -> DataFrame:
    return layer.query(
        ["average_score", "total_inspections"], ["cuisine_type"], order=[("average_score", "desc"), ("cuisine_type", "asc")], limit=k
    )


def trend(layer: SemanticLayer, months: int = 24) -> DataFrame:
    end = F.lit(layer.as_of).cast("date")
    return layer.query(
        ["total_inspections", "average_score"], ["year_month"], where=[("dates.calendar_date", lambda c: c.between(F.add_months(end, -months), end))], order=[("year_month", "asc")]
    )


def code_rate_by_cuisine(m: Marts, code: str) -> DataFrame:
    """Share of citations that are for one code, per cuisine."""
    per = m.fct_violations.groupBy("dim_restaurant_key").agg(
        F.sum(F.when(F.col("violation_code") == code, F.col("violation_count")).otherwise(0)).alias("hits"), F.sum("violation_count").alias("citations")
    )
    joined = per.join(m.dim_restaurant.select("dim_restaurant_key", F.col("cuisine_description").alias("cuisine_type")), "dim_restaurant_key")
    out = joined.groupBy("cuisine_type").agg(F.sum("hits").alias("code_citations"), F.sum("citations").alias("total_citations"))
    return out.withColumn("code_rate_pct", percent(F.col("code_citations"), F.col("total_citations")))


def local_vs_overall(layer: SemanticLayer) -> DataFrame:
    """Each borough's mean score beside the mean of all."""
    overall = layer.query(["average_score"]).scalar()
    local = layer.query(["average_score", "total_inspections"], ["borough"])
    return local.withColumn("overall_score", overall).withColumn("difference", F.col("average_score") - F.col("overall_score"))


def condition_compare(m: Marts, cuisine: str, borough: str, k: int = 5) -> DataFrame:
    """For one cuisine in one borough: critical rate, and the most cited codes."""
    chosen = m.dim_restaurant.filter((F.col("cuisine_description") == cuisine) & (F.col("borough") == borough)).select("dim_restaurant_key")
    cited = m.fct_violations.join(chosen, "dim_restaurant_key", "left_semi")
    critical = F.sum(F.when(F.col("is_critical_violation"), F.col("violation_count")).otherwise(0))
    rate = cited.agg(percent(critical, F.sum("violation_count")).alias("r")).scalar()
    codes = cited.groupBy("violation_code").agg(F.sum("violation_count").alias("citations"))
    return codes.orderBy(F.desc("citations"), "violation_code").limit(k).withColumn("critical_rate_pct", rate)


def top_codes_per_borough(m: Marts, k: int = 3) -> DataFrame:
    """Most cited codes within each borough."""
    per = m.fct_violations.groupBy("dim_restaurant_key", "violation_code").agg(F.sum("violation_count").alias("citations"))
    joined = per.join(m.dim_restaurant.select("dim_restaurant_key", "borough"), "dim_restaurant_key")
    counts = joined.groupBy("borough", "violation_code").agg(F.sum("citations").alias("citations"))
    return top_per_key(counts, ["borough"], [F.desc("citations"), F.col("violation_code")], k, rank="rank")
