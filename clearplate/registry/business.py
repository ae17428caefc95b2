"""Registered queries: data checks, semantic layer, standing questions, further analytics.

Fixed values: the output columns, thresholds and first-k limits of the standing questions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import quality as Q
from clearplate.operators import sketches as K
from clearplate.plans import analytics as A
from clearplate.plans import verified as V
from clearplate.plans.model import semantic_layer
from clearplate.registry.base import marts_of, marts_path, query
from clearplate.registry.star_sql import star
from clearplate.session import written
from clearplate.sources.bind import AS_OF

# The bound records have region names in place of boroughs.
BOUND_BOROUGHS = ["Africa", "America", "Asia", "Europe"]


def layer_of(spark, sf_dir):
    return semantic_layer(marts_of(spark, sf_dir), AS_OF)


def marts_query(name, sql, build):
    query(name, star(sql))(lambda spark, sf_dir: build(marts_of(spark, sf_dir)))


def layer_query(name, sql, build):
    query(name, star(sql))(lambda spark, sf_dir: build(layer_of(spark, sf_dir)))


# -- data checks ---------------------------------------------------------------

_SQL_TABLES = {"stg_inspections": "stg", "dim_restaurant": "restaurants", "dim_violation_type": "violation_types", "dim_date": "dates", "fct_inspections": "inspections", "fct_violations": "violations"}


def _check_sql(c: Q.Check) -> str:
    t, col = _SQL_TABLES[c.table], c.column
    if c.kind == "unique":
        failing = f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    elif c.kind == "not_null":
        failing = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
    else:
        listed = ", ".join(f"'{v}'" for v in c.values)
        failing = f"(SELECT count(*) FROM {t} WHERE {col} NOT IN ({listed}))"
    return f"""SELECT '{c.kind}' AS "check", '{c.table}' AS "table", '{col}' AS "column", {failing} AS failing_rows"""


_SUITE = Q.mart_suite(BOUND_BOROUGHS)
marts_query("dq_report", " UNION ALL ".join(_check_sql(c) for c in _SUITE), lambda m: Q.check_all(_SUITE, {n: getattr(m, n) for n in m.__dataclass_fields__}))
marts_query(
    "q1_duplicate_keys", "SELECT fct_inspection_key, count(*) AS rows FROM inspections GROUP BY 1 HAVING count(*) > 1",
    lambda m: Q.duplicate_keys(m.fct_inspections, "fct_inspection_key"),
)
marts_query("q2_null_rows", "SELECT dim_restaurant_key, restaurant_id FROM restaurants WHERE latitude IS NULL", lambda m: Q.null_rows(m.dim_restaurant, "latitude").select("dim_restaurant_key", "restaurant_id"))
marts_query(
    "q3_unaccepted", "SELECT restaurant_id, borough FROM restaurants WHERE borough NOT IN ('Africa', 'America', 'Asia', 'Europe')",
    lambda m: Q.unaccepted_rows(m.dim_restaurant, "borough", BOUND_BOROUGHS).select("restaurant_id", "borough"),
)
marts_query(
    "coord_coverage",
    """SELECT borough, count(*) AS rows, round(avg(latitude::double), 6) AS avg_latitude, avg((latitude IS NOT NULL)::int) AS share_latitude,
    round(avg(longitude::double), 6) AS avg_longitude, avg((longitude IS NOT NULL)::int) AS share_longitude FROM restaurants WHERE borough <> '0' GROUP BY 1""",
    lambda m: Q.coverage(m.dim_restaurant.filter("borough <> '0'"), ["latitude", "longitude"], ["borough"])
    .withColumns({c: F.round(c, 6) for c in ("avg_latitude", "avg_longitude")}),
)

# -- standing questions --------------------------------------------------------

_CRIT = "sum(CASE WHEN is_critical_violation THEN violation_count ELSE 0 END)::bigint"
_YEAR = "date_trunc('year', {as_of})"


def v(name, sql, build):
    marts_query(name, sql, build)


v("v01_grade_distribution", "SELECT borough, grade, count(*) AS inspection_count FROM ir WHERE grade IN ('A', 'B', 'C') GROUP BY 1, 2", V.grade_distribution)
v(
    "v02_grade_a_rate", "SELECT borough, round(avg(CASE WHEN passed_with_grade_a THEN 100.0 ELSE 0.0 END), 4) AS grade_a_pass_rate, count(*) AS total_inspections FROM ir GROUP BY 1",
    lambda m: V.grade_a_rate(m, digits=4),
)
v(
    "v03_top_critical", """SELECT t.violation_code, t.violation_description, sum(violation_count)::bigint AS citation_count FROM violations v JOIN violation_types t USING (dim_violation_key)
    WHERE v.is_critical_violation GROUP BY 1, 2 ORDER BY citation_count DESC, violation_code LIMIT 10""", V.top_critical_violations,
)
_V4 = f"""SELECT cuisine_type, {_CRIT} AS critical_citations, sum(violation_count)::bigint AS total_citations,
  round({_CRIT} * 100.0::double / nullif(sum(violation_count), 0), 1) AS critical_share_pct FROM vr GROUP BY 1 HAVING sum(violation_count) >= 100
  ORDER BY critical_citations DESC, cuisine_type NULLS LAST LIMIT 15"""
v("v04_critical_by_cuisine", _V4, V.critical_by_cuisine)
_V5 = """SELECT borough, count(*) AS total_inspections, count(*) FILTER (WHERE action ILIKE '%Establishment Closed%') AS closures,
  round(count(*) FILTER (WHERE action ILIKE '%Establishment Closed%') * 100.0::double / count(*), 2) AS closure_rate_pct FROM ir GROUP BY 1"""
v("v05_closure_rate", _V5, V.closure_rate)
_V6 = f"""SELECT borough, count(*) AS total_inspections, count(*) FILTER (WHERE inspection_type ILIKE '%Re-Inspection%') AS re_inspections,
  round(count(*) FILTER (WHERE inspection_type ILIKE '%Re-Inspection%') * 100.0::double / count(*), 2) AS re_inspection_rate_pct
  FROM ir JOIN dates ON inspection_date_key = date_key WHERE calendar_date BETWEEN {_YEAR} AND {{as_of}} GROUP BY 1"""
v("v06_re_inspection_rate", _V6, lambda m: V.re_inspection_rate(m, AS_OF))
v(
    "v07_monthly_trend", """SELECT year_number::bigint AS year_number, month_name, month_number::bigint AS month_number, count(*) AS inspections, round(avg(inspection_score), 1) AS avg_score,
  round(avg(CASE WHEN passed_with_grade_a THEN 100.0::double ELSE 0 END), 1) AS grade_a_rate FROM inspections JOIN dates ON inspection_date_key = date_key
  WHERE year_number >= year({as_of}) - 1 AND calendar_date <= {as_of} GROUP BY 1, 2, 3""", lambda m: V.monthly_trend(m, AS_OF),
)
v(
    "v08_quarterly_critical", f"""SELECT year_number::bigint AS year_number, quarter_label, {_CRIT} AS critical_citations, sum(violation_count)::bigint AS total_citations,
  round({_CRIT} * 100.0::double / nullif(sum(violation_count), 0), 1) AS critical_share_pct FROM vr JOIN dates ON inspection_date_key = date_key
  WHERE borough = 'Europe' AND year_number >= year({{as_of}}) - 2 AND calendar_date <= {{as_of}} GROUP BY 1, 2""", lambda m: V.quarterly_critical_trend(m, AS_OF, "Europe"),
)
v(
    "v09_zip_hotspots", f"""SELECT zipcode, borough, count(DISTINCT restaurant_id) AS restaurants, {_CRIT} AS critical_citations,
  round({_CRIT} * 1.0::double / nullif(count(DISTINCT restaurant_id), 0), 1) AS critical_per_restaurant FROM vr JOIN dates ON inspection_date_key = date_key
  WHERE calendar_date BETWEEN {{as_of}} - INTERVAL 12 MONTH AND {{as_of}} AND zipcode IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT restaurant_id) >= 20
  ORDER BY critical_per_restaurant DESC, zipcode, borough NULLS LAST LIMIT 20""", lambda m: V.zip_hotspots(m, AS_OF),
)


def _v10(digits: int) -> str:
    return f"""SELECT restaurant_name, borough, cuisine_type, street_address, max(inspection_score)::bigint AS worst_score, round(avg(inspection_score), {digits}) AS avg_score,
  sum(critical_violations)::bigint AS total_critical, count(*) AS inspections_this_year FROM ir JOIN dates ON inspection_date_key = date_key
  WHERE calendar_date BETWEEN {_YEAR} AND {{as_of}} AND inspection_score IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2
  ORDER BY avg_score DESC, restaurant_name NULLS LAST, borough NULLS LAST, cuisine_type NULLS LAST, street_address NULLS LAST LIMIT 20"""


v("v10_highest_risk", _v10(1), lambda m: V.highest_risk(m, AS_OF))
v(
    "v11_repeat_closures", """SELECT restaurant_name, borough, cuisine_type, street_address, count(*) AS closure_count FROM ir WHERE action ILIKE '%Establishment Closed%'
  GROUP BY 1, 2, 3, 4 HAVING count(*) > 1 ORDER BY closure_count DESC, restaurant_name NULLS LAST, borough NULLS LAST, cuisine_type NULLS LAST, street_address NULLS LAST LIMIT 20""",
    V.repeat_closures,
)
v(
    "v12_weekday", """SELECT day_name_short AS day_name, day_of_week::bigint AS day_of_week, count(*) AS inspections, round(avg(inspection_score), 1) AS avg_score
  FROM inspections JOIN dates ON inspection_date_key = date_key WHERE year_number = year({as_of}) AND calendar_date <= {as_of} GROUP BY 1, 2""", lambda m: V.by_weekday(m, AS_OF),
)
v("v13_grade_a_rate_rounded", "SELECT borough, round(avg(CASE WHEN passed_with_grade_a THEN 100.0::double ELSE 0 END), 1) AS grade_a_pass_rate, count(*) AS total_inspections FROM ir WHERE borough <> '0' GROUP BY 1", lambda m: V.grade_a_rate(m, True, 1))
v("v13_closure_rate_known", _V5.replace("FROM ir", "FROM ir WHERE borough <> '0'"), lambda m: V.closure_rate(m, True))
v("v13_re_inspection_rate_known", _V6.replace("WHERE", "WHERE borough <> '0' AND"), lambda m: V.re_inspection_rate(m, AS_OF, True))
v("v13_highest_risk_whole", _v10(0), lambda m: V.highest_risk(m, AS_OF, digits=0))
v(
    "v13_top_critical_labelled", """SELECT t.violation_code, t.violation_description, t.criticality_label, sum(violation_count)::bigint AS citation_count FROM violations v JOIN violation_types t USING (dim_violation_key)
    WHERE v.is_critical_violation GROUP BY 1, 2, 3 ORDER BY citation_count DESC, violation_code LIMIT 10""", lambda m: V.top_critical_violations(m, labelled=True),
)

# -- semantic layer --------------------------------------------------------------

_METRIC_SQL = {
    "total_inspections": "count(fct_inspection_key)",
    "average_score": "avg(inspection_score)",
    "median_score": "median(inspection_score)::double",
    "max_score": "max(inspection_score)::bigint",
    "total_violations_cited": "sum(total_violations)::bigint",
    "total_critical_violations_cited": "sum(critical_violations)::bigint",
    "grade_a_pass_rate": "avg(CASE WHEN passed_with_grade_a THEN 100.0::double ELSE 0 END)",
    "grade_b_rate": "sum(CASE WHEN grade = 'B' THEN 1 ELSE 0 END) * 100.0::double / nullif(count(fct_inspection_key), 0)",
    "grade_c_rate": "sum(CASE WHEN grade = 'C' THEN 1 ELSE 0 END) * 100.0::double / nullif(count(fct_inspection_key), 0)",
    "closure_rate": "sum(CASE WHEN action ILIKE '%Establishment Closed%' THEN 1 ELSE 0 END) * 100.0::double / nullif(count(fct_inspection_key), 0)",
    "re_inspection_rate": "sum(CASE WHEN inspection_type ILIKE '%Re-Inspection%' THEN 1 ELSE 0 END) * 100.0::double / nullif(count(fct_inspection_key), 0)",
    "inspections_with_critical_pct": "count(DISTINCT CASE WHEN has_critical_violation THEN fct_inspection_key END) * 100.0::double / nullif(count(DISTINCT fct_inspection_key), 0)",
    "avg_violations_per_inspection": "avg(total_violations)",
    "avg_critical_violations_per_inspection": "avg(critical_violations)",
}
_CITATION_SQL = {
    "total_violation_citations": "sum(violation_count)::bigint",
    "critical_violation_rate": f"{_CRIT} * 100.0::double / nullif(sum(violation_count), 0)",
    "critical_violation_citations": _CRIT,
    "non_critical_violation_citations": "sum(CASE WHEN NOT is_critical_violation THEN violation_count ELSE 0 END)::bigint",
    "distinct_violation_codes_cited": "count(DISTINCT violation_code)",
}
_WHOLE = {"total_inspections", "max_score", "total_violations_cited", "total_critical_violations_cited", "total_violation_citations",
          "critical_violation_citations", "non_critical_violation_citations", "distinct_violation_codes_cited", "total_restaurants"}


def _cols(sql: dict[str, str], names=None) -> str:
    return ", ".join(f"{e} AS {n}" if n in _WHOLE else f"round({e}, 4) AS {n}" for n, e in sql.items() if names is None or n in names)


def rounded(df):
    return df.select(*[F.round(f.name, 4).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema])


def sv(name, sql, build):
    layer_query(name, sql, lambda layer: rounded(build(layer)))


sv("sv_all_inspection_metrics", f"SELECT borough, {_cols(_METRIC_SQL)} FROM ir GROUP BY 1", lambda s: s.query(list(_METRIC_SQL), ["borough"]))
sv("sv_all_citation_metrics", f"SELECT cuisine_type, {_cols(_CITATION_SQL)} FROM vr GROUP BY 1", lambda s: s.query(list(_CITATION_SQL), ["cuisine_type"]))
sv("sv_grade_rates_by_borough", f"SELECT borough, {_cols(_METRIC_SQL, ['grade_a_pass_rate', 'grade_b_rate', 'grade_c_rate'])} FROM ir GROUP BY 1", lambda s: s.query(["grade_a_pass_rate", "grade_b_rate", "grade_c_rate"], ["borough"]))
sv("sv_median_by_cuisine", f"SELECT cuisine_type, {_cols(_METRIC_SQL, ['median_score', 'total_inspections'])} FROM ir GROUP BY 1", lambda s: s.query(["median_score", "total_inspections"], ["cuisine_type"]))
sv(
    "sv_drill_across",
    f"""SELECT coalesce(i.borough, v.borough) AS borough, total_inspections, average_score, total_violation_citations, critical_violation_rate, total_restaurants
  FROM (SELECT borough, {_cols(_METRIC_SQL, ['total_inspections', 'average_score'])} FROM ir GROUP BY 1) i
  FULL JOIN (SELECT borough, {_cols(_CITATION_SQL, ['total_violation_citations', 'critical_violation_rate'])} FROM vr GROUP BY 1) v ON i.borough IS NOT DISTINCT FROM v.borough
  FULL JOIN (SELECT borough, count(DISTINCT restaurant_id) AS total_restaurants FROM restaurants GROUP BY 1) r ON r.borough IS NOT DISTINCT FROM coalesce(i.borough, v.borough)""",
    lambda s: s.query(["total_inspections", "average_score", "total_violation_citations", "critical_violation_rate", "total_restaurants"], ["borough"]),
)
sv(
    "sv_citations_by_grade",
    """SELECT grade, sum(violation_count)::bigint AS total_violation_citations FROM violations v
  JOIN (SELECT fct_inspection_key, grade FROM inspections QUALIFY row_number() OVER (PARTITION BY fct_inspection_key ORDER BY grade NULLS LAST, grade_date NULLS LAST) = 1) i USING (fct_inspection_key) GROUP BY 1""",
    lambda s: s.query(["total_violation_citations"], ["inspections.grade"]),
)
_NAMED = {
    "graded_inspections": "grade IN ('A', 'B', 'C')", "initial_inspections": "inspection_type ILIKE '%Initial Inspection%'", "re_inspections": "inspection_type ILIKE '%Re-Inspection%'",
    "closures": "action ILIKE '%Establishment Closed%'", "clean_inspections": "action ILIKE '%No violations were recorded%'", "inspections.recent_12_months": "inspection_date BETWEEN {as_of} - INTERVAL 12 MONTH AND {as_of}", "inspections.recent_6_months": "inspection_date BETWEEN {as_of} - INTERVAL 6 MONTH AND {as_of}",
    "critical_only": "is_critical_violation", "non_critical_only": "NOT is_critical_violation", "violations.recent_12_months": "inspection_date BETWEEN {as_of} - INTERVAL 12 MONTH AND {as_of}", "violations.recent_6_months": "inspection_date BETWEEN {as_of} - INTERVAL 6 MONTH AND {as_of}",
}


def _on_citations(name: str) -> bool:
    return name in ("critical_only", "non_critical_only") or name.startswith("violations.")


def _named_filters(layer):
    out = None
    for name in _NAMED:
        metric = "total_violation_citations" if _on_citations(name) else "total_inspections"
        one = layer.query([metric], ["borough"], filters=[name]).select(F.lit(name).alias("filter_name"), "borough", F.col(metric).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


sv(
    "sv_named_filters",
    " UNION ALL ".join(f"SELECT '{n}' AS filter_name, borough, count(*) AS n FROM {'vr' if _on_citations(n) else 'ir'} WHERE {c} GROUP BY 1, 2" for n, c in _NAMED.items()),
    _named_filters,
)
sv(
    "sv_default_rules",
    f"""SELECT borough, {_cols(_METRIC_SQL, ['total_inspections', 'closure_rate'])},
  'borough != ''0'' — records with missing borough data are left out|inspection_date between add_months(date''{AS_OF}'', -12) and date''{AS_OF}'' — last 12 months, as no date was given' AS applied_filters
  FROM ir WHERE borough <> '0' AND inspection_date BETWEEN {{as_of}} - INTERVAL 12 MONTH AND {{as_of}} GROUP BY 1""",
    lambda s: s.query(["total_inspections", "closure_rate"], ["borough"], defaults=True),
)
sv(
    "sv_best_restaurants", f"""SELECT restaurant_name, borough, {_cols(_METRIC_SQL, ['average_score', 'total_inspections'])} FROM ir GROUP BY 1, 2
  ORDER BY avg(inspection_score) NULLS LAST, restaurant_name, borough LIMIT 25""",
    lambda s: s.query(["average_score", "total_inspections"], ["restaurant_name", "borough"], best=True, order=[("restaurant_name", "asc"), ("borough", "asc")], limit=25),
)
sv("sv_facts", "SELECT restaurant_name, round(latitude::double, 7) AS latitude, round(longitude::double, 7) AS longitude FROM restaurants", lambda s: s.facts(["latitude", "longitude"], ["restaurant_name"]))
sv(
    "sv_freshness", f"SELECT borough, {_cols(_METRIC_SQL, ['total_inspections'])}, (SELECT CAST(max(inspection_date) AS varchar) FROM inspections) AS data_through FROM ir GROUP BY 1",
    lambda s: s.query(["total_inspections"], ["borough"]).withColumn("data_through", s.freshness()),
)



@query("sv_freshness_footers", star(f"SELECT borough, {_cols(_METRIC_SQL, ['total_inspections'])}, (SELECT CAST(max(inspection_date) AS varchar) FROM inspections) AS data_through FROM ir GROUP BY 1"))
def _(s, d):
    """The latest day beside an answer, read from the footers of the stored fact."""
    layer = layer_of(s, d)
    (latest,) = Q.latest_in_footers(s, f"{marts_path(s, d)}/fct_inspections", "inspection_date").first()
    return layer.query(["total_inspections"], ["borough"]).withColumn("data_through", F.lit(str(latest)))


_SETS = [["borough"], ["cuisine_type"], ["borough", "cuisine_type"], []]


def _sets_sql(table: str, sql: str) -> str:
    return f"""SELECT borough, cuisine_type, concat_ws(',', CASE WHEN grouping(borough) = 0 THEN 'borough' END, CASE WHEN grouping(cuisine_type) = 0 THEN 'cuisine_type' END) AS grouped_by, {sql}
  FROM {table} GROUP BY GROUPING SETS ((borough), (cuisine_type), (borough, cuisine_type), ())"""


sv(
    "sv_subtotals",
    f"""SELECT i.borough, i.cuisine_type, i.grouped_by, total_inspections, median_score, closure_rate, total_violation_citations, distinct_violation_codes_cited
  FROM ({_sets_sql('ir', _cols(_METRIC_SQL, ['total_inspections', 'median_score', 'closure_rate']))}) i
  JOIN ({_sets_sql('vr', _cols(_CITATION_SQL, ['total_violation_citations', 'distinct_violation_codes_cited']))}) v
    ON i.borough IS NOT DISTINCT FROM v.borough AND i.cuisine_type IS NOT DISTINCT FROM v.cuisine_type AND i.grouped_by = v.grouped_by""",
    lambda s: s.query(["total_inspections", "median_score", "closure_rate", "total_violation_citations", "distinct_violation_codes_cited"], ["borough", "cuisine_type"], sets=_SETS),
)


def _in_rank(found, values, by, name):
    """Share of values below, and up to, an estimated median, against the middle."""
    met = values.join(found.select(*by, F.col(name).alias("_m")), list(by)).groupBy(*by).agg(
        F.avg(F.when(F.col("v") < F.col("_m"), 1.0).otherwise(0.0)).alias("below"), F.avg(F.when(F.col("v") <= F.col("_m"), 1.0).otherwise(0.0)).alias("upto")
    )
    return met.select(*by, ((F.col("below") <= 0.5 + K.KLL_RANK_ERROR) & (F.col("upto") >= 0.5 - K.KLL_RANK_ERROR)).alias("median_within_error"))


def _approximate(layer):
    names = ["distinct_violation_codes_cited", "median_score", "total_inspections"]
    exact, close = layer.query(names, ["cuisine_type"]), layer.query(names, ["cuisine_type"], approximate=True)
    restaurants = layer.tables["dim_restaurant"].select("dim_restaurant_key", F.col("cuisine_description").alias("cuisine_type"))
    values = layer.tables["fct_inspections"].join(restaurants, "dim_restaurant_key").select("cuisine_type", F.col("inspection_score").alias("v")).filter("v IS NOT NULL")
    near = F.abs(F.col("_codes") - F.col("distinct_violation_codes_cited")) <= 3 * K.HLL_ERROR * F.col("distinct_violation_codes_cited")
    both = exact.join(close.select("cuisine_type", F.col("distinct_violation_codes_cited").alias("_codes")), "cuisine_type")
    return both.select("cuisine_type", "total_inspections", near.alias("codes_within_error")).join(_in_rank(close, values, ["cuisine_type"], "median_score"), "cuisine_type")


sv("sv_approximate", "SELECT cuisine_type, count(fct_inspection_key) AS total_inspections, true AS codes_within_error, true AS median_within_error FROM ir WHERE cuisine_type IS NOT NULL GROUP BY 1", _approximate)


def _from_sketches(layer):
    """Sketches kept per day and type of visit; a request over some years merges them and reads no fact."""
    fact = layer.tables["fct_violations"]
    kept = written(K.daily(fact, "inspection_date", ["inspection_type"], {"codes": "violation_code", "places": "restaurant_id"}, {"score": "inspection_score"}), "sketches")
    low, high = "1994-01-01", "1996-12-31"
    found = K.over(kept, ["inspection_type"], low, high, ["codes", "places"], ["score"])
    rows = fact.filter(F.col("inspection_date").between(low, high))
    true = rows.groupBy("inspection_type").agg(F.count_distinct("violation_code").alias("c"), F.count_distinct("restaurant_id").alias("p"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 3 * K.HLL_ERROR * F.col(b)
    median = _in_rank(found, rows.select("inspection_type", F.col("inspection_score").alias("v")).filter("v IS NOT NULL"), ["inspection_type"], "score")
    return found.join(true, "inspection_type").join(median, "inspection_type").select(
        "inspection_type", F.col("rows").alias("citations"), close("codes", "c").alias("codes_within_error"), close("places", "p").alias("places_within_error"), "median_within_error"
    )


sv(
    "sv_kept_sketches",
    """SELECT inspection_type, count(*) AS citations, true AS codes_within_error, true AS places_within_error, true AS median_within_error
  FROM violations WHERE inspection_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31' GROUP BY 1""",
    _from_sketches,
)

# -- further analytics -------------------------------------------------------------


def a(name, sql, build):
    marts_query(name, sql, lambda m: rounded(build(m)))


a(
    "a1_share_of_total", """SELECT violation_code, violation_description, citation_count, round(citation_count * 100.0::double / (SELECT sum(violation_count) FROM violations), 4) AS share_pct
  FROM (SELECT t.violation_code, t.violation_description, sum(violation_count)::bigint AS citation_count FROM violations v JOIN violation_types t USING (dim_violation_key) WHERE v.is_critical_violation GROUP BY 1, 2)
  ORDER BY citation_count DESC, violation_code LIMIT 15""", A.critical_share_of_total,
)

a(
    "a2_quarter_pivot", """SELECT quarter_label,
  round(100.0::double * count(*) FILTER (WHERE year_number = 2000 AND action ILIKE '%Establishment Closed%') / nullif(count(*) FILTER (WHERE year_number = 2000), 0), 4) AS closure_rate_2000,
  round(100.0::double * count(*) FILTER (WHERE year_number = 2001 AND action ILIKE '%Establishment Closed%') / nullif(count(*) FILTER (WHERE year_number = 2001), 0), 4) AS closure_rate_2001
  FROM inspections JOIN dates ON inspection_date_key = date_key WHERE year_number IN (2000, 2001) GROUP BY 1""", lambda m: A.quarter_compare(m, [2000, 2001]),
)
sv(
    "a3_rate_score_corr", f"""SELECT round(corr(r, s), 4) AS correlation, count(*) AS boroughs FROM (SELECT borough, {_METRIC_SQL['re_inspection_rate']} AS r, avg(inspection_score) AS s FROM ir WHERE borough <> '0' GROUP BY 1)""",
    A.rate_score_correlation,
)
sv("a4_worst_cuisines", f"SELECT cuisine_type, {_cols(_METRIC_SQL, ['average_score', 'total_inspections'])} FROM ir GROUP BY 1 ORDER BY avg(inspection_score) DESC NULLS LAST, cuisine_type LIMIT 10", A.worst_cuisines)
sv(
    "a5_trend_24_months", f"""SELECT year_month::bigint AS year_month, {_cols(_METRIC_SQL, ['average_score', 'total_inspections'])} FROM inspections JOIN dates ON inspection_date_key = date_key
  WHERE calendar_date BETWEEN {{as_of}} - INTERVAL 24 MONTH AND {{as_of}} GROUP BY 1""", A.trend,
)
a(
    "a6_code_rate", """SELECT cuisine_type, sum(CASE WHEN violation_code = '04B' THEN violation_count ELSE 0 END)::bigint AS code_citations, sum(violation_count)::bigint AS total_citations,
  round(sum(CASE WHEN violation_code = '04B' THEN violation_count ELSE 0 END) * 100.0::double / nullif(sum(violation_count), 0), 4) AS code_rate_pct FROM vr GROUP BY 1""", lambda m: A.code_rate_by_cuisine(m, "04B"),
)
sv(
    "a7_local_vs_overall", """SELECT borough, round(avg(inspection_score), 4) AS average_score, count(*) AS total_inspections, round((SELECT avg(inspection_score) FROM inspections), 4) AS overall_score,
  round(avg(inspection_score) - (SELECT avg(inspection_score) FROM inspections), 4) AS difference FROM ir GROUP BY 1""", A.local_vs_overall,
)
a(
    "a8_condition_compare", f"""SELECT violation_code, sum(violation_count)::bigint AS citations,
  round((SELECT {_CRIT} * 100.0::double / sum(violation_count) FROM vr WHERE cuisine_type = 'Machinery' AND borough = 'Asia'), 4) AS critical_rate_pct
  FROM vr WHERE cuisine_type = 'Machinery' AND borough = 'Asia' GROUP BY 1 ORDER BY citations DESC, violation_code LIMIT 5""", lambda m: A.condition_compare(m, "Machinery", "Asia"),
)
a(
    "a8_top_codes_per_borough", """SELECT borough, violation_code, citations, rank FROM (SELECT borough, violation_code, citations, row_number() OVER (PARTITION BY borough ORDER BY citations DESC, violation_code) AS rank
  FROM (SELECT borough, violation_code, sum(violation_count)::bigint AS citations FROM vr GROUP BY 1, 2)) WHERE rank <= 3""", A.top_codes_per_borough,
)
