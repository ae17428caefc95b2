from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from clearplate.functions.latest import carry_last, neighbour
from clearplate.operators import quality as Q
from clearplate.operators.semantic import SemanticError
from clearplate.plans import verified as V


@pytest.mark.parametrize("request_", [
    dict(metrics=["total_inspections"], facts=["latitude"]),
    dict(metrics=[]),
    dict(metrics=["nothing"]),
    dict(metrics=["total_inspections"], dimensions=["inspection_date"]),  # on two entities
    dict(metrics=["total_restaurants"], dimensions=["grade"]),  # one to many
    dict(metrics=["total_inspections"], filters=["critical_only"]),  # a filter of many rows per visit
    dict(metrics=["total_inspections"], dimensions=["inspections.action", "violations.action"]),
])
def test_refused(layer, request_):
    with pytest.raises(SemanticError):
        layer.query(**request_)


def test_refused_facts(layer):
    with pytest.raises(SemanticError):
        layer.facts(["grade_sort_order"])
    with pytest.raises(SemanticError):
        layer.facts(["latitude"], ["grade"])
    with pytest.raises(SemanticError):
        layer.facts(["latitude"], metrics=["total_inspections"])


def test_layer_equals_hand_written(layer, marts):
    by_hand = rows(V.closure_rate(marts), "borough", "total_inspections", "closure_rate_pct")
    resolved = layer.query(["total_inspections", "closure_rate"], ["borough"])
    assert rows(resolved.select("borough", "total_inspections", F.round("closure_rate", 2))) == by_hand
    graded = layer.query(["total_inspections"], ["borough", "grade"], filters=["graded_inspections"])
    assert rows(graded, "borough", "grade", "total_inspections") == rows(V.grade_distribution(marts))
    top = layer.query(
        ["total_violation_citations"], ["violation_types.violation_code", "violation_description"], filters=["critical_only"],
        order=[("total_violation_citations", "desc"), ("violation_code", "asc")], limit=10,
    )
    assert rows(top) == rows(V.top_critical_violations(marts).select("violation_code", "violation_description", "citation_count"))


def test_drill_across_does_not_multiply(layer, marts):
    both = layer.query(["total_inspections", "total_violation_citations"], ["borough"])
    assert both.agg(F.sum("total_inspections"), F.sum("total_violation_citations")).first() == (marts.fct_inspections.count(), marts.fct_violations.count())
    total = layer.query(["total_inspections", "total_violation_citations"]).first()
    assert tuple(total) == (marts.fct_inspections.count(), marts.fct_violations.count())


def test_defaults_and_freshness(layer):
    plain = layer.query(["total_inspections"], ["borough"], defaults=True)
    assert all(len(r.applied_filters) == 2 for r in plain.collect())
    dated = layer.query(["total_inspections"], ["year_number"], where=[("calendar_date", lambda c: c >= "2000-01-01")], defaults=True)
    assert all(len(r.applied_filters) == 1 and r.applied_filters[0].startswith("borough != '0'") for r in dated.collect())
    assert str(layer.query(["total_inspections"]).withColumn("d", layer.freshness()).first().d) <= "2001-08-01"
    assert layer.query(["average_score"], ["borough"], rounded=True).filter("average_score != round(average_score)").count() == 0


def test_growing_dimension_is_joined_after_the_sum(layer):
    plan = layer.query(["total_inspections"], ["borough"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate"), plan
    assert "count" in plan[plan.index("Join"):]


def test_checks(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (2, "x"), (None, "B")], "k int, g string")
    suite = [*Q.unique("t", "k"), *Q.not_null("t", "k", "g"), *Q.accepted("t", "g", ["A", "B"])]
    assert rows(Q.check_all(suite, {"t": df})) == sorted([("unique", "t", "k", 1), ("not_null", "t", "k", 1), ("not_null", "t", "g", 1), ("accepted", "t", "g", 1)], key=repr)


def test_thresholds(spark, marts):
    # A group exactly on the threshold stays.
    counts = V.critical_by_cuisine(marts, at_least=0).collect()
    edge = counts[0].total_citations
    assert any(r.total_citations == edge for r in V.critical_by_cuisine(marts, at_least=edge).collect())
    assert V.critical_by_cuisine(marts, at_least=10**9).count() == 0


@pytest.fixture(scope="module")
def long_group(spark):
    """One key holds most rows; values are sparse, one key is NULL."""
    ids = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("k"), F.col("id").alias("pos"), F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))
    return ids.withColumn("k", F.when(F.col("k") != 3, F.col("k")))


def test_blocked_look_back_equals_a_window(spark, long_group):
    w = "PARTITION BY k ORDER BY pos"
    long_group.createOrReplaceTempView("long_group")
    want = spark.sql(f"SELECT k, pos, v, last(v) IGNORE NULLS OVER ({w} ROWS UNBOUNDED PRECEDING) AS f, lag(v) OVER ({w}) AS p, lead(pos) OVER ({w}) AS n FROM long_group")
    got = carry_last(long_group, ["k"], "pos", {"f": "v"}, block=64)
    assert rows(got) == rows(want, "k", "pos", "v", "f")
    assert rows(neighbour(long_group, ["k"], "pos", {"p": "v"}, -1, block=64)) == rows(want, "k", "pos", "v", "p")
    assert rows(neighbour(long_group, ["k"], "pos", {"n": "pos"}, 1, block=64)) == rows(want, "k", "pos", "v", "n")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("question", [V.re_inspection_rate, V.monthly_trend, V.quarterly_critical_trend, V.zip_hotspots, V.highest_risk, V.by_weekday])
def test_dated_questions_open_their_months_only(marts, question):
    scans = [line for line in plan_of(question(marts, "2001-03-15")).splitlines() if "FileScan" in line and "fct_" in line]
    assert scans and all("inspection_month" in line.split("PartitionFilters: ")[1].split("]")[0] for line in scans)


def test_freshness_reads_footers(spark, sf_dir, marts):
    from clearplate.registry.base import marts_path

    latest = Q.latest_in_footers(spark, f"{marts_path(spark, sf_dir)}/fct_inspections", "inspection_date")
    assert "PushedAggregation: [MAX(inspection_date)]" in plan_of(latest)
    assert latest.first()["latest"] == marts.fct_inspections.agg(F.max("inspection_date")).first()[0]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_grouping_sets_tell_subtotals_from_missing_values(spark, layer):
    got = layer.query(["total_inspections"], ["borough", "grade"], sets=[["borough"], ["grade"], []]).collect()
    by = {}
    for r in got:
        by.setdefault(r["grouped_by"], []).append(r)
    whole = layer.query(["total_inspections"]).first()["total_inspections"]
    assert set(by) == {"borough", "grade", ""} and by[""][0]["total_inspections"] == whole
    assert any(r["grade"] is None for r in by["grade"]) and sum(r["total_inspections"] for r in by["grade"]) == whole
    assert all(r["grade"] is None for r in by["borough"]) and sum(r["total_inspections"] for r in by["borough"]) == whole
    with pytest.raises(SemanticError):
        layer.query(["total_inspections"], ["borough"], sets=[["grade"]])


def test_sketches_keep_their_error(spark):
    """Ten days of skewed values: half of them one value, the others spread over five powers of ten."""
    from clearplate.operators import sketches as K

    df = spark.range(200_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("d"), (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.pow(F.lit(10.0), F.pmod(F.xxhash64("id"), F.lit(5000)) / 1000)).alias("x"), F.pmod(F.hash("id"), F.lit(60_000)).alias("code"),
    )
    kept = K.daily(df, "d", ["g"], {"codes": "code"}, {"mid": "x"}).cache()
    assert kept.count() == 30
    for first, last in ((None, None), ("2024-01-03", "2024-01-07")):
        chosen = df if first is None else df.filter(F.col("d").between(first, last))
        true = {r["g"]: r for r in chosen.groupBy("g").agg(F.count_distinct("code").alias("n"), F.count("*").alias("rows")).collect()}
        for r in K.over(kept, ["g"], first, last, ["codes"], ["mid"]).collect():
            assert r["rows"] == true[r["g"]]["rows"] and abs(r["codes"] / true[r["g"]]["n"] - 1) < 3 * K.HLL_ERROR
            own = chosen.filter(F.col("g") == r["g"])
            below, upto = own.filter(F.col("x") < r["mid"]).count() / r["rows"], own.filter(F.col("x") <= r["mid"]).count() / r["rows"]
            assert below <= 0.5 + K.KLL_RANK_ERROR and upto >= 0.5 - K.KLL_RANK_ERROR
    nothing = K.daily(df.withColumn("x", F.lit(None).cast("double")), "d", [], {}, {"mid": "x"})
    assert K.over(nothing, [], None, None, [], ["mid"]).first()["mid"] is None


def test_unknown_boroughs_are_left_out_by_default(layer):
    every = layer.query(["total_inspections"], ["borough"]).collect()
    known = layer.query(["total_inspections"], ["borough"], defaults=True).collect()
    assert "0" in {r["borough"] for r in every} and "0" not in {r["borough"] for r in known}
