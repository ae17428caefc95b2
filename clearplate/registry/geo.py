"""Registered queries: radius search, map datasets, result-set events."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import geo as G
from clearplate.registry.base import marts_of, query
from clearplate.registry.business import layer_of
from clearplate.registry.star_sql import star
from clearplate.sources import bind
from clearplate.sources.resultset import name_borough_pairs, result_table

START, END = "2000-08-01", bind.AS_OF
_POINTS = "(SELECT s_suppkey AS point_id, (s_suppkey % 400 + 40500) / 1000.0::double AS point_lat, (s_suppkey * 7 % 500 - 74200) / 1000.0::double AS point_lon FROM supplier)"


def _haversine(lat: str, lon: str) -> str:
    return f"""(2 * 6371000.0::double * asin(sqrt(pow(sin(radians(p.point_lat - {lat}) / 2), 2)
  + cos(radians({lat})) * cos(radians(p.point_lat)) * pow(sin(radians(p.point_lon - {lon}) / 2), 2))))"""


_DIST = _haversine("r.latitude::double", "r.longitude::double")
_NEAR = f"(SELECT r.*, p.point_id, {_DIST} AS distance_m FROM restaurants r, {_POINTS} p WHERE {_DIST} <= 804.0)"
query("g1_within_radius", star(f"SELECT point_id, restaurant_id, round(distance_m, 3) AS distance_m FROM {_NEAR}"))(
    lambda s, d: G.within_radius(marts_of(s, d).dim_restaurant.select("restaurant_id", "latitude", "longitude"), bind.points(s, d)).select("point_id", "restaurant_id", F.round("distance_m", 3).alias("distance_m"))
)
query("g1_within_mile_salted", star(f"SELECT point_id, count(*) AS restaurants, round(min(distance_m), 3) AS nearest_m FROM {_NEAR.replace('804.0', '1609.34')} GROUP BY 1"))(
    lambda s, d: G.count_within_radius(marts_of(s, d).dim_restaurant, bind.points(s, d), 1609.34, cell_places=2)
    .groupBy("point_id").agg(F.sum("restaurants").alias("restaurants"), F.round(F.min("nearest_m"), 3).alias("nearest_m"))
)
query(
    "g2_nearby_critical",
    star(f"""SELECT point_id, restaurant_name, street_address, borough, cuisine_description, latitude::double AS latitude, longitude::double AS longitude, round(distance_m, 3) AS distance_m,
  latest_grade, score, last_inspection FROM {_NEAR} JOIN (
    SELECT v.dim_restaurant_key, arg_max(coalesce(i.grade, ''), (v.inspection_date, i.fct_inspection_key, coalesce(i.grade, ''))) AS latest_grade, round(avg(i.inspection_score), 1) AS score,
      CAST(max(v.inspection_date) AS varchar) AS last_inspection
    FROM violations v JOIN inspections i USING (fct_inspection_key) WHERE v.is_critical_violation AND v.inspection_date BETWEEN {{as_of}} - INTERVAL 6 MONTH AND {{as_of}} GROUP BY 1) USING (dim_restaurant_key)"""),
)(lambda s, d: G.nearby_critical(marts_of(s, d), bind.points(s, d), END).drop("point_lat", "point_lon").withColumns({"distance_m": F.round("distance_m", 3), "latest_grade": F.coalesce("latest_grade", F.lit(""))}))

_WIN = f"inspection_date BETWEEN DATE '{START}' AND DATE '{END}'"
_PER = f"""per AS (SELECT dim_restaurant_key, restaurant_name, borough, cuisine_type, latitude::double AS latitude, longitude::double AS longitude,
    nullif(arg_max(coalesce(grade, ''), (inspection_date, fct_inspection_key, coalesce(grade, ''))), '') AS latest_grade, round(avg(inspection_score), 1) AS avg_score, count(*) AS inspection_count,
    bool_or(has_critical_violation) AS any_critical FROM ir WHERE {_WIN} AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6)"""


def g(name, select, build):
    query(name, star("").rstrip() + ", " + _PER + "\n" + select)(build)


def per(s, d, **kw):
    return G.per_restaurant(layer_of(s, d), marts_of(s, d), START, END, **kw)


g("g3_per_restaurant", "SELECT * FROM per", per)
g("g3_per_restaurant_filtered", "SELECT * FROM per WHERE borough IN ('Asia', 'Europe') AND cuisine_type IN ('Machinery', 'Furniture')", lambda s, d: per(s, d, boroughs=["Asia", "Europe"], cuisines=["Machinery", "Furniture"]))
_SV = """(SELECT restaurant_name, borough, cuisine_type, inspection_date, grade, has_critical_violation, avg(inspection_score) AS average_score, count(*) AS total_inspections
  FROM ir WHERE COND GROUP BY 1, 2, 3, 4, 5, 6)"""
_PLACES = "(SELECT restaurant_name, max(latitude)::double AS latitude, max(longitude)::double AS longitude FROM restaurants GROUP BY 1 HAVING max(latitude) IS NOT NULL AND max(longitude) IS NOT NULL)"
g(
    "g3_legacy_by_name",
    f"""SELECT i.restaurant_name, borough, cuisine_type, latitude, longitude, nullif(arg_max(coalesce(grade, ''), (inspection_date, coalesce(grade, ''), has_critical_violation)), '') AS latest_grade,
  round(avg(average_score), 1) AS avg_score, sum(total_inspections)::bigint AS inspection_count, bool_or(has_critical_violation) AS any_critical
  FROM {_SV.replace('COND', _WIN)} i JOIN {_PLACES} USING (restaurant_name) GROUP BY 1, 2, 3, 4, 5""",
    lambda s, d: per(s, d, legacy_by_name=True),
)
g("g4_outcome_filter", "SELECT * FROM per WHERE latest_grade IN ('A', 'B') AND any_critical", lambda s, d: G.outcome_filter(per(s, d), ["A", "B"], True))
g("g5_map_points", "SELECT restaurant_name, borough, latitude, longitude, cuisine_type, latest_grade AS grade, avg_score AS score FROM per", lambda s, d: G.map_points(per(s, d)))
g(
    "g5_summary_top500", """SELECT restaurant_name, borough, cuisine_type, inspection_count, avg_score, latest_grade FROM per
  ORDER BY inspection_count DESC, avg_score NULLS LAST, restaurant_name NULLS LAST, borough NULLS LAST, cuisine_type NULLS LAST LIMIT 500""", lambda s, d: G.summary_table(per(s, d)),
)
_PAIRS = "(SELECT DISTINCT restaurant_name, CASE WHEN latitude IS NULL THEN '' ELSE borough END AS borough FROM restaurants)"
g(
    "g6_pairs",
    f"""SELECT i.restaurant_name, i.borough, latitude, longitude, nullif(arg_max(coalesce(grade, ''), (inspection_date, coalesce(grade, ''))), '') AS grade, round(avg(average_score), 1) AS score
  FROM (SELECT restaurant_name, borough, inspection_date, grade, has_critical_violation, avg(inspection_score) AS average_score FROM ir WHERE has_critical_violation GROUP BY 1, 2, 3, 4, 5) i JOIN {_PLACES} USING (restaurant_name)
  WHERE EXISTS (SELECT 1 FROM {_PAIRS} p WHERE p.restaurant_name = i.restaurant_name AND (p.borough = '' OR p.borough = i.borough)) GROUP BY 1, 2, 3, 4""",
    lambda s, d: G.points_for_pairs(layer_of(s, d), marts_of(s, d).dim_restaurant.select("restaurant_name", F.when(F.col("latitude").isNull(), "").otherwise(F.col("borough")).alias("borough"))),
)
query("g7_result_pairs", star("SELECT DISTINCT trim(upper(dba)) AS restaurant_name, boro AS borough FROM raw"))(lambda s, d: name_borough_pairs(bind.result_events(s, d)))
query("s10_result_table", star("SELECT trim(upper(dba)) AS restaurant_name, boro AS borough, latitude, longitude, score AS inspection_score FROM raw"))(
    lambda s, d: (lambda t: t.select(*[F.col(c).alias(c.lower()) for c in t.columns]))(
        result_table(bind.result_events(s, d), ["RESTAURANT_NAME", "BOROUGH", "LATITUDE", "LONGITUDE", "INSPECTION_SCORE"])
    )
)
g(
    "g8_default_feed",
    f"""SELECT i.restaurant_name, borough, latitude, longitude, nullif(arg_max(coalesce(grade, ''), (inspection_date, coalesce(grade, ''))), '') AS grade, round(avg(average_score), 1) AS score
  FROM (SELECT restaurant_name, borough, inspection_date, grade, has_critical_violation, avg(inspection_score) AS average_score FROM ir
    WHERE inspection_date BETWEEN {{as_of}} - 365 AND {{as_of}} AND has_critical_violation GROUP BY 1, 2, 3, 4, 5) i JOIN {_PLACES} USING (restaurant_name)
  GROUP BY 1, 2, 3, 4""".replace("{as_of}", f"DATE '{END}'"),
    lambda s, d: G.default_feed(layer_of(s, d), END),
)
_GRADE = "CASE WHEN m IS NULL THEN '' WHEN m <= 13 THEN 'A' WHEN m <= 27 THEN 'B' ELSE 'C' END"
query(
    "g9_inferred_grade",
    star(f"""SELECT restaurant_name, borough, latitude, longitude, '' AS cuisine_type, {_GRADE} AS grade, round_even(m, 0)::bigint AS score FROM (
  SELECT trim(upper(dba)) AS restaurant_name, boro AS borough, min(try_cast(latitude AS double)) AS latitude, min(try_cast(longitude AS double)) AS longitude, avg(try_cast(score AS double)) AS m
  FROM raw WHERE try_cast(latitude AS double) IS NOT NULL GROUP BY 1, 2)"""),
)(lambda s, d: G.points_from_events(bind.result_events(s, d)))
_COLOUR = "CASE upper(coalesce(latest_grade, '')) WHEN 'A' THEN '0|180|0|210' WHEN 'B' THEN '255|165|0|210' WHEN 'C' THEN '220|50|50|210' ELSE '150|150|150|180' END"
g(
    "g10_style_points", f"""SELECT restaurant_name, borough, latitude, longitude, coalesce(cuisine_type, '') AS cuisine_type, upper(coalesce(latest_grade, '')) AS grade,
  coalesce(CAST(CAST(trunc(avg_score) AS bigint) AS varchar), '–') AS score, {_COLOUR} AS fill_color FROM per""", lambda s, d: G.style_points(G.map_points(per(s, d))),
)
g(
    "g11_kpis", """SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(latest_grade, '') <> '') AS graded,
  round(coalesce(100.0::double * count(*) FILTER (WHERE latest_grade = 'A') / nullif(count(*) FILTER (WHERE coalesce(latest_grade, '') <> ''), 0), 0), 1) AS pct_a, round(avg(avg_score), 1) AS avg_score FROM per""",
    lambda s, d: G.kpi_strip(G.map_points(per(s, d))),
)
query("g12_density", star("SELECT floor(latitude::double / 0.01::double)::bigint AS cell_lat, floor(longitude::double / 0.01::double)::bigint AS cell_lon, count(*) AS points FROM restaurants WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2"))(
    lambda s, d: G.density(marts_of(s, d).dim_restaurant)
)
query("g13_boroughs", star("SELECT DISTINCT borough FROM restaurants WHERE borough <> '0'"))(lambda s, d: G.boroughs(layer_of(s, d)))
query("g13_top_cuisines", star("SELECT cuisine_description AS cuisine_type, count(DISTINCT restaurant_id) AS total_restaurants FROM restaurants WHERE cuisine_description IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))(lambda s, d: G.top_cuisines(layer_of(s, d)))
