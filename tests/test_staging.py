from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from clearplate.functions import text as X
from clearplate.operators import marts as M
from clearplate.operators import staging as S
from clearplate.sources.raw import normalise_raw, read_raw
from clearplate.sources.schemas import RAW_COLUMNS

LOADED = dt.datetime(2024, 1, 1)


def raw(spark, *records):
    """Raw records from dicts; a field that is not given is NULL."""
    base = {"camis": "1", "inspection_date": "2024-01-10T00:00:00.000", "inspection_type": "Cycle Inspection / Initial Inspection", "action": "cited", "violation_code": "04L", "record_date": "2024-02-01T00:00:00.000", "_loaded_at": LOADED}
    data = [[{**base, **r}.get(c) for c in [*RAW_COLUMNS, "_loaded_at"]] for r in records]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", _loaded_at timestamp_ntz")


def test_read_and_normalise(spark, tmp_path):
    lines = [{"camis": "\t 42  ", "dba": "  ", "score": "12"}, {"camis": "43", "extra": 1}]
    (tmp_path / "page.json").write_text("\n".join(map(json.dumps, lines)))
    df = normalise_raw(read_raw(spark, str(tmp_path)), "2024-01-01")
    assert df.columns == [*RAW_COLUMNS, "_loaded_at"]
    assert rows(df, "camis", "dba", "score", "_loaded_at") == [("42", None, "12", LOADED), ("43", None, None, LOADED)]
    assert normalise_raw(df, upper_names=True).columns[0] == "CAMIS"
    assert read_raw(spark, str(tmp_path), limit=1).count() == 1


@pytest.mark.parametrize("given, want", [
    ("CAFÉ/COFFEE/TEA", "Café/Coffee/Tea"), ("o'brien's pub", "O'brien's Pub"), ("ÉCOLE (north)", "École (North)"), ("a-b c_d", "A-B C_D"), ("plain words", "Plain Words"), ("", ""), (None, None),
])
def test_initcap(spark, given, want):
    df = spark.createDataFrame([(given,)], "s string")
    assert df.select(X.initcap_ext(F.col("s"))).first()[0] == want


def test_concat_ws_strict(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(X.concat_ws_strict("|", F.col("x"), F.col("y"))).collect()] == ["a|b", None]


def test_clean_values(spark):
    df = S.clean_inspections(raw(
        spark, {"camis": "  "}, {"camis": None},
        {"score": "12.7", "zipcode": "501", "latitude": "40.71", "longitude": "12345.1", "critical_flag": " critical", "grade": " "},
        {"score": "abc", "zipcode": "10025-1234", "latitude": "bad", "inspection_date": "nonsense", "critical_flag": "Not Applicable", "grade": "A"},
        {"score": "", "critical_flag": "not critical", "inspection_date": "1900-01-01"},
    ))
    got = [tuple(r) for r in df.select("inspection_score", "zipcode", "latitude", "longitude", "is_critical_violation", "grade", "inspection_date").collect()]
    day = dt.date(2024, 1, 10)
    assert got == [
        (13, "00501", Decimal("40.7100000"), None, True, None, day),
        (None, "10025", None, None, None, "A", None),
        (None, None, None, None, False, None, dt.date(1900, 1, 1)),
    ]


def test_dedupe(spark):
    two_scores = [{"score": "15"}, {"score": "20"}]
    older = {"camis": "2", "score": "99"}
    newer = {"camis": "2", "score": "1", "_loaded_at": dt.datetime(2024, 1, 2)}
    null_score = [{"camis": "3"}, {"camis": "3", "score": "0"}]
    null_keys = [{"camis": "4", "action": None, "violation_code": None}] * 2
    stg = S.stage_inspections(raw(spark, *two_scores, older, newer, *null_score, *null_keys))
    assert rows(stg, "restaurant_id", "inspection_score") == [("1", 20), ("2", 1), ("3", 0), ("4", None)]
    again = S.dedupe_latest(stg, S.BUSINESS_KEY, [("loaded_at", "desc"), ("inspection_score", "desc")])
    assert rows(again) == rows(stg)


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = S.stage_inspections(raw(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    before, after = plan.split("Exchange hashpartitioning")[:2]
    assert "Final" in before and "Partial" in after


def test_profile_and_codes(spark):
    stg = S.stage_inspections(raw(
        spark,
        {"dba": "old", "record_date": "2024-01-01T00:00:00.000", "building": "1", "street": "MAIN ST"},
        {"dba": "new", "record_date": "2024-03-01T00:00:00.000", "building": "2", "street": "MAIN ST", "violation_description": "b", "critical_flag": "Not Critical"},
        {"dba": "unknown day", "record_date": None, "violation_description": "a", "critical_flag": "Critical"},
        {"camis": "2", "building": None, "street": "X", "violation_code": " ", "critical_flag": "Critical"},
    ))
    assert rows(S.latest_profile(stg), "restaurant_id", "restaurant_name", "street_address") == [("1", "NEW", "2 Main St"), ("2", None, None)]
    assert rows(S.reference_codes(stg)) == [("04L", "a", True)]
    label = M.dim_violation_type(spark.createDataFrame([("1", "x", True), ("2", "x", False), ("3", "x", None)], "violation_code string, violation_description string, is_critical_violation boolean"))
    assert rows(label, "criticality_label") == [("Critical",), ("Not Applicable",), ("Not Critical",)]


def test_calendar(spark):
    dates = M.dim_date(spark).cache()
    assert dates.count() == 11_323
    pick = {r.date_key: r for r in dates.filter(F.col("date_key").isin(20000229, 20241230, 20240107, 20240131)).collect()}
    leap, week1, sunday, end = pick[20000229], pick[20241230], pick[20240107], pick[20240131]
    assert leap.is_month_end and leap.day_of_year == 60 and leap.month_name == "February" and leap.quarter_label == "Q1" and leap.year_quarter == 200001
    assert week1.week_of_year == 1 and week1.day_name_short == "Mon" and week1.day_of_week == 1
    assert sunday.is_weekend and sunday.day_of_week == 0
    assert end.is_month_end and not end.is_month_start


def test_facts(spark):
    stg = S.stage_inspections(raw(
        spark,
        {"violation_code": "04L", "critical_flag": "Critical", "score": "20", "grade": "A"}, {"violation_code": "10F", "critical_flag": "Not Critical", "score": "25", "grade": "A"},
        {"violation_code": "08A", "grade": "B"},
        {"action": "closed", "violation_code": None}, {"action": None},
        {"camis": "9", "inspection_date": "1999-12-31T00:00:00.000"}, {"camis": "8", "inspection_date": "1900-01-01T00:00:00.000", "inspection_type": None},
    ))
    dates = M.dim_date(spark)
    visits = M.fct_inspections(stg, dates)
    assert rows(visits, "restaurant_id", "action", "grade", "inspection_score", "total_violations", "critical_violations", "non_critical_violations", "passed_with_grade_a", "inspection_date_key") == sorted([
        ("1", "cited", "A", 25, 2, 1, 1, True, 20240110), ("1", "cited", "B", None, 1, 0, 0, False, 20240110),
        ("1", "closed", None, None, 0, 0, 0, False, 20240110), ("1", None, None, None, 1, 0, 0, False, 20240110), ("9", "cited", None, None, 1, 0, 0, False, None),
    ], key=repr)
    # Two grades on one visit share the key: a collision the data checks report.
    keys = [r[0] for r in visits.filter("action = 'cited' AND restaurant_id = '1'").select("fct_inspection_key").collect()]
    assert len(keys) == 2 and len(set(keys)) == 1
    cited = M.fct_violations(stg, dates)
    assert cited.count() == 5 and cited.filter("fct_violation_key IS NULL").count() == 0
    assert rows(cited.join(visits, "fct_inspection_key", "left_anti")) == []
