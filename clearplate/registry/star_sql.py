"""The star schema as SQL for the checking engine: a shared chain of CTEs.

Fixed values: the names of columns and models, the labels, and the recipes of the keys.
"""

from __future__ import annotations

from clearplate.sources.bind import ACTIONS, AS_OF, GRADES, INSPECTION_TYPES


def _case(column: str, values: dict[str, str]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _initcap(c: str) -> str:
    pieces = rf"""regexp_extract_all(lower({c}), '[^!?@"^#$&~_,.:;+\-*%/|\\\[\](){{}}<>\s]*[!?@"^#$&~_,.:;+\-*%/|\\\[\](){{}}<>\s]?')"""
    return f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '')"


def _day(c: str) -> str:
    return f"CAST(try_cast({c} AS timestamp) AS date)"


_GRADE_LIST = "[" + ", ".join(f"'{g}'" for g in GRADES) + "]"

RAW = f"""
raw AS (
  SELECT CAST(c_custkey AS varchar) AS camis,
    '  ' || lower(c_name) || ' ' AS dba,
    CASE WHEN c_custkey % 19 = 0 THEN '0' ELSE upper(r_name) END AS boro,
    CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey % 500 AS varchar) END AS building,
    upper(n_name) || ' STREET' AS street,
    CASE WHEN c_custkey % 31 = 0 THEN '10025-1234' ELSE CAST(c_nationkey AS varchar) END AS zipcode,
    CAST(NULL AS varchar) AS phone,
    CASE WHEN c_custkey % 13 = 0 THEN 'CAFE/COFFEE/TEA' ELSE upper(c_mktsegment) END AS cuisine_description,
    strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000' AS inspection_date,
    {_case('o_orderstatus', ACTIONS)} AS action,
    CASE WHEN NOT (l_orderkey % 41 = 0 AND l_linenumber = 7)
      THEN lpad(CAST(l_orderkey % 25 AS varchar), 2, '0') || substr('ABCDEFG', l_linenumber, 1) END AS violation_code,
    p_type || ' ' || p_brand AS violation_description,
    CASE (l_orderkey + l_linenumber) % 3 WHEN 0 THEN ' critical' WHEN 1 THEN 'Not Critical' ELSE 'Not Applicable' END AS critical_flag,
    CASE WHEN l_partkey % 37 = 0 THEN '' ELSE CAST(CAST(l_quantity AS int) AS varchar) END AS score,
    {_GRADE_LIST}[o_orderkey % 7 + 1] AS grade,
    strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d') || 'T00:00:00.000' AS grade_date,
    strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') || 'T00:00:00.000' AS record_date,
    {_case('o_orderpriority', INSPECTION_TYPES)} AS inspection_type,
    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'bad'
      ELSE CAST((c_custkey % 400 + 40500) / 1000.0::double AS varchar) END AS latitude,
    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'bad'
      ELSE CAST((c_custkey * 7 % 500 - 74200) / 1000.0::double AS varchar) END AS longitude,
    CAST(NULL AS varchar) AS nta,
    TIMESTAMP '2001-08-02 00:00:00' + to_hours(CAST(l_suppkey % 3 AS int)) AS loaded_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

STG = f"""
cleaned AS (
  SELECT camis AS restaurant_id, trim(upper(dba)) AS restaurant_name, {_initcap('trim(boro)')} AS borough,
    trim(building) AS building_number, {_initcap('trim(street)')} AS street_name, lpad(trim(zipcode), 5, '0') AS zipcode,
    trim(phone) AS phone, {_initcap('trim(cuisine_description)')} AS cuisine_description,
    try_cast(trim(latitude) AS decimal(10,7)) AS latitude, try_cast(trim(longitude) AS decimal(10,7)) AS longitude,
    trim(nta) AS neighborhood_code, {_day('inspection_date')} AS inspection_date, trim(inspection_type) AS inspection_type,
    trim(action) AS action, trim(violation_code) AS violation_code, trim(violation_description) AS violation_description,
    CASE upper(trim(critical_flag)) WHEN 'CRITICAL' THEN true WHEN 'NOT CRITICAL' THEN false END AS is_critical_violation,
    CAST(try_cast(trim(score) AS decimal(38,0)) AS int) AS inspection_score, nullif(trim(grade), '') AS grade,
    {_day('grade_date')} AS grade_date, {_day('record_date')} AS record_date, loaded_at
  FROM raw WHERE camis IS NOT NULL AND trim(camis) <> ''
),
stg AS MATERIALIZED (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY restaurant_id, inspection_date, inspection_type, action, violation_code, is_critical_violation, record_date
    ORDER BY loaded_at DESC NULLS LAST, inspection_score DESC NULLS LAST, violation_description NULLS LAST, grade NULLS LAST,
      grade_date NULLS LAST, restaurant_name NULLS LAST, borough NULLS LAST, building_number NULLS LAST, street_name NULLS LAST,
      zipcode NULLS LAST, phone NULLS LAST, cuisine_description NULLS LAST, latitude NULLS LAST, longitude NULLS LAST) = 1
)"""

PROFILE = """
profile AS (
  SELECT restaurant_id, restaurant_name, borough, building_number, street_name, zipcode, phone, cuisine_description,
    latitude, longitude, neighborhood_code,
    CASE WHEN building_number IS NOT NULL AND street_name IS NOT NULL THEN building_number || ' ' || street_name END AS street_address
  FROM stg QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY record_date DESC NULLS LAST, loaded_at DESC NULLS LAST,
    restaurant_name NULLS LAST, borough NULLS LAST, building_number NULLS LAST, street_name NULLS LAST, zipcode NULLS LAST,
    cuisine_description NULLS LAST, latitude NULLS LAST, longitude NULLS LAST) = 1
)"""

CODES = """
codes AS (
  SELECT violation_code, violation_description, is_critical_violation
  FROM (SELECT DISTINCT violation_code, violation_description, is_critical_violation FROM stg
        WHERE violation_code IS NOT NULL AND trim(violation_code) <> '')
  QUALIFY row_number() OVER (PARTITION BY violation_code
    ORDER BY is_critical_violation DESC NULLS LAST, violation_description NULLS LAST) = 1
)"""

DIMS = """
restaurants AS (
  SELECT md5(restaurant_id) AS dim_restaurant_key, restaurant_id, restaurant_name, borough, street_address, building_number,
    street_name, zipcode, phone, cuisine_description, latitude, longitude, neighborhood_code FROM profile
),
violation_types AS (
  SELECT md5(violation_code) AS dim_violation_key, violation_code, violation_description, is_critical_violation,
    CASE WHEN is_critical_violation THEN 'Critical' WHEN NOT is_critical_violation THEN 'Not Critical' ELSE 'Not Applicable' END AS criticality_label
  FROM codes
),
dates AS (
  SELECT d AS calendar_date, CAST(strftime(d, '%Y%m%d') AS int) AS date_key, year(d) AS year_number, quarter(d) AS quarter_number,
    year(d) * 100 + quarter(d) AS year_quarter, 'Q' || quarter(d) AS quarter_label, month(d) AS month_number,
    year(d) * 100 + month(d) AS year_month, monthname(d) AS month_name, strftime(d, '%b') AS month_short, weekofyear(d) AS week_of_year,
    dayofweek(d) AS day_of_week, strftime(d, '%a') AS day_name_short, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
    dayofweek(d) IN (0, 6) AS is_weekend, d = date_trunc('month', d) AS is_month_start, d = last_day(d) AS is_month_end
  FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS date) AS d)
)"""

FACTS = """
inspections AS MATERIALIZED (
  SELECT md5(i.restaurant_id || '|' || CAST(i.inspection_date AS varchar) || '|' || i.inspection_type || '|' || coalesce(i.action, '')) AS fct_inspection_key,
    md5(i.restaurant_id) AS dim_restaurant_key, d.date_key AS inspection_date_key, i.restaurant_id, i.inspection_date, i.inspection_type,
    i.action, i.grade, i.grade_date, CASE i.grade WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 END AS grade_sort_order,
    i.inspection_score, i.total_violations, i.critical_violations, i.non_critical_violations,
    coalesce(i.grade = 'A', false) AS passed_with_grade_a, i.critical_violations > 0 AS has_critical_violation
  FROM (SELECT restaurant_id, inspection_date, inspection_type, action, grade, grade_date, max(inspection_score) AS inspection_score,
      count(violation_code) AS total_violations, count(*) FILTER (WHERE is_critical_violation) AS critical_violations,
      count(*) FILTER (WHERE NOT is_critical_violation) AS non_critical_violations
    FROM stg WHERE inspection_date IS NOT NULL AND inspection_type IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6) i
  LEFT JOIN dates d ON i.inspection_date = d.calendar_date
),
violations AS MATERIALIZED (
  SELECT md5(s.restaurant_id || '|' || CAST(s.inspection_date AS varchar) || '|' || s.inspection_type || '|' || coalesce(s.action, '') || '|' || s.violation_code) AS fct_violation_key,
    md5(s.restaurant_id) AS dim_restaurant_key, md5(s.violation_code) AS dim_violation_key, d.date_key AS inspection_date_key,
    md5(s.restaurant_id || '|' || CAST(s.inspection_date AS varchar) || '|' || s.inspection_type || '|' || coalesce(s.action, '')) AS fct_inspection_key,
    s.restaurant_id, s.inspection_date, s.inspection_type, s.action, s.violation_code, 1 AS violation_count, s.is_critical_violation, s.inspection_score
  FROM stg s LEFT JOIN dates d ON s.inspection_date = d.calendar_date
  WHERE s.violation_code IS NOT NULL AND s.inspection_type IS NOT NULL
)"""

# Joined forms that many checks share.
JOINED = """
ir AS (SELECT i.*, r.restaurant_name, r.borough, r.cuisine_description AS cuisine_type, r.street_address, r.zipcode, r.latitude, r.longitude
  FROM inspections i JOIN restaurants r USING (dim_restaurant_key)),
vr AS (SELECT v.*, r.restaurant_name, r.borough, r.cuisine_description AS cuisine_type, r.street_address, r.zipcode, r.latitude, r.longitude
  FROM violations v JOIN restaurants r USING (dim_restaurant_key))"""

ALL = ",".join([RAW, STG, PROFILE, CODES, DIMS, FACTS, JOINED])
AS_OF_SQL = f"DATE '{AS_OF}'"


def star(select: str) -> str:
    """A check over the star schema; ``{as_of}`` stands for the reporting date."""
    return f"WITH {ALL}\n{select.replace('{as_of}', AS_OF_SQL)}"
