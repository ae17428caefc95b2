"""Registered queries: raw records, staging, marts and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import marts as M
from clearplate.operators import staging as S
from clearplate.plans.build import build_marts, derive_marts, read_alike
from clearplate.registry.base import marts_of, query
from clearplate.registry.star_sql import RAW, star
from clearplate.session import fresh_path
from clearplate.sources import bind, raw, tables


def staged(spark, sf_dir):
    return S.stage_inspections(bind.raw_inspections(spark, sf_dir))


def _raw_check(null_names: str) -> str:
    return f"""
WITH {RAW}, n AS (SELECT camis, nullif(trim(dba), '') AS dba, boro, building, street, zipcode, nullif(trim(critical_flag), '') AS critical_flag,
  nullif(score, '') AS score, nullif(grade, '') AS grade, inspection_date, inspection_type, violation_code, latitude FROM raw)
SELECT boro, count(*) AS records, count(dba) AS names, min(dba) AS first_name, count(building) AS buildings, count(score) AS scores,
  count(grade) AS grades, min(critical_flag) AS first_flag, count(inspection_type) AS types, count(violation_code) AS codes,
  count(latitude) AS latitudes, max(inspection_date) AS last_date, {null_names} AS phones FROM n GROUP BY boro"""


def _raw_summary(df):
    c = F.count
    return df.groupBy("boro").agg(
        c("*").alias("records"), c("dba").alias("names"), F.min("dba").alias("first_name"), c("building").alias("buildings"),
        c("score").alias("scores"), c("grade").alias("grades"), F.min("critical_flag").alias("first_flag"), c("inspection_type").alias("types"),
        c("violation_code").alias("codes"), c("latitude").alias("latitudes"), F.max("inspection_date").alias("last_date"), c("phone").alias("phones"),
    )


@query("s1_read_landed_json", _raw_check("CAST(0 AS bigint)"))
def _(spark, sf_dir):
    path = fresh_path(spark, "landed")
    bind.raw_inspections(spark, sf_dir).drop("_loaded_at").write.json(path, compression="gzip")  # as a loader lands them
    return _raw_summary(raw.normalise_raw(raw.read_raw(spark, path), "2001-08-02"))


@query("s2_normalise", _raw_check("CAST(0 AS bigint)"))
def _(spark, sf_dir):
    return _raw_summary(raw.normalise_raw(bind.raw_inspections(spark, sf_dir)))


STG_COLUMNS = """restaurant_id, restaurant_name, borough, building_number, street_name, zipcode, phone, cuisine_description,
  CAST(latitude AS double) AS latitude, CAST(longitude AS double) AS longitude, neighborhood_code, CAST(inspection_date AS varchar) AS inspection_date,
  inspection_type, action, violation_code, violation_description, is_critical_violation, inspection_score::bigint AS inspection_score, grade,
  CAST(grade_date AS varchar) AS grade_date, CAST(record_date AS varchar) AS record_date, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at"""


@query("stg_inspections", star(f"SELECT {STG_COLUMNS} FROM stg"))
def _(spark, sf_dir):
    return staged(spark, sf_dir)


@query("stg_dedupe_count", star("""SELECT (SELECT count(*) FROM cleaned) AS cleaned_rows, (SELECT count(*) FROM stg) AS kept_rows"""))
def _(spark, sf_dir):
    clean = S.clean_inspections(bind.raw_inspections(spark, sf_dir))
    # Duplicates can also be counted without picking a winner: one partial aggregate per key.
    per_key = clean.groupBy(*S.BUSINESS_KEY).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("cleaned_rows"), F.count("*").alias("kept_rows"))


PROFILE_COLUMNS = """restaurant_id, restaurant_name, borough, building_number, street_name, zipcode, phone, cuisine_description,
  CAST(latitude AS double) AS latitude, CAST(longitude AS double) AS longitude, neighborhood_code, street_address"""


@query("stg_restaurants", star(f"SELECT {PROFILE_COLUMNS} FROM profile"))
def _(spark, sf_dir):
    return S.latest_profile(staged(spark, sf_dir))


@query("stg_violations", star("SELECT * FROM codes"))
def _(spark, sf_dir):
    return S.reference_codes(staged(spark, sf_dir))


@query("dim_restaurant", star(f"SELECT dim_restaurant_key, {PROFILE_COLUMNS} FROM restaurants"))
def _(spark, sf_dir):
    return M.dim_restaurant(S.latest_profile(staged(spark, sf_dir)))


@query("dim_violation_type", star("SELECT * FROM violation_types"))
def _(spark, sf_dir):
    return M.dim_violation_type(S.reference_codes(staged(spark, sf_dir)))


_DATE_SQL = star("""SELECT CAST(i.inspection_date AS varchar) AS calendar_date, count(*) AS visits, min(d.date_key)::bigint AS date_key, min(year_number)::bigint AS year_number,
  min(quarter_number)::bigint AS quarter_number, min(year_quarter)::bigint AS year_quarter, min(quarter_label) AS quarter_label,
  min(month_number)::bigint AS month_number, min(year_month)::bigint AS year_month, min(month_name) AS month_name, min(month_short) AS month_short,
  min(week_of_year)::bigint AS week_of_year, min(day_of_week)::bigint AS day_of_week, min(day_name_short) AS day_name_short,
  min(day_of_month)::bigint AS day_of_month, min(day_of_year)::bigint AS day_of_year, bool_or(is_weekend) AS is_weekend,
  bool_or(is_month_start) AS is_month_start, bool_or(is_month_end) AS is_month_end
FROM inspections i LEFT JOIN dates d ON i.inspection_date = d.calendar_date GROUP BY i.inspection_date""")


@query("dim_date", _DATE_SQL)
def _(spark, sf_dir):
    """The calendar rows of every day on which something was inspected."""
    days = marts_of(spark, sf_dir).fct_inspections.groupBy("inspection_date").agg(F.count("*").alias("visits"))
    calendar = M.dim_date(spark)
    return (
        days.join(F.broadcast(calendar), F.col("inspection_date") == F.col("calendar_date"), "left")
        .withColumn("calendar_date", F.col("inspection_date")).drop("inspection_date", "quarter_number")
        .withColumn("quarter_number", F.substring("quarter_label", 2, 1).cast("long"))
    )


FACT_COLUMNS = """fct_inspection_key, dim_restaurant_key, inspection_date_key::bigint AS inspection_date_key, restaurant_id,
  CAST(inspection_date AS varchar) AS inspection_date, inspection_type, action, grade, CAST(grade_date AS varchar) AS grade_date,
  grade_sort_order::bigint AS grade_sort_order, inspection_score::bigint AS inspection_score, total_violations, critical_violations,
  non_critical_violations, passed_with_grade_a, has_critical_violation"""


@query("fct_inspections", star(f"SELECT {FACT_COLUMNS} FROM inspections"))
def _(spark, sf_dir):
    return M.fct_inspections(staged(spark, sf_dir), M.dim_date(spark))


VIOLATION_COLUMNS = """fct_violation_key, dim_restaurant_key, dim_violation_key, inspection_date_key::bigint AS inspection_date_key, fct_inspection_key,
  restaurant_id, CAST(inspection_date AS varchar) AS inspection_date, inspection_type, action, violation_code, violation_count::bigint AS violation_count,
  is_critical_violation, inspection_score::bigint AS inspection_score"""


@query("fct_violations", star(f"SELECT {VIOLATION_COLUMNS} FROM violations"))
def _(spark, sf_dir):
    return M.fct_violations(staged(spark, sf_dir), M.dim_date(spark))


_LAYERS = star("""SELECT 'raw' AS layer, (SELECT count(*) FROM raw) AS row_count UNION ALL SELECT 'stg_inspections', (SELECT count(*) FROM stg)
UNION ALL SELECT 'dim_restaurant', (SELECT count(*) FROM restaurants) UNION ALL SELECT 'dim_violation_type', (SELECT count(*) FROM violation_types)
UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dates) UNION ALL SELECT 'fct_inspections', (SELECT count(*) FROM inspections)
UNION ALL SELECT 'fct_violations', (SELECT count(*) FROM violations)""")


def _layers(spark, sf_dir, m):
    named = {name: getattr(m, name) for name in m.__dataclass_fields__}
    return tables.layer_counts({"raw": bind.raw_inspections(spark, sf_dir), **named})


@query("layer_counts", _LAYERS)
def _(spark, sf_dir):
    return _layers(spark, sf_dir, marts_of(spark, sf_dir))


@query("build_marts", _LAYERS)
def _(spark, sf_dir):
    """Raw records to written marts, end to end, each time it is called."""
    m = build_marts(bind.raw_inspections(spark, sf_dir), fresh_path(spark, "build"))
    return _layers(spark, sf_dir, m)


@query("derive_marts_lazy", _LAYERS)
def _(spark, sf_dir):
    """The same star schema as unmaterialised views."""
    return _layers(spark, sf_dir, derive_marts(read_alike(staged(spark, sf_dir))))
