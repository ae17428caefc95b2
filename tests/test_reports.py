from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from clearplate.functions.geo import haversine_m
from clearplate.operators import geo as G
from clearplate.operators import monitoring as O
from clearplate.sources import bind, tables
from clearplate.sources.resultset import name_borough_pairs, result_table
from clearplate.streaming import jobs as X

AS_OF = "2024-01-31"


def at(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


def test_nested_payload(spark):
    payloads = [
        [{"r1": {"analyst": {"m1": {"input": 3, "output": 2, "cache_read_input": 1}}, "start_time": "2024-01-01"}}, {"r2": {"analyst": {"m1": {"input": 5}, "m2": {}}}}],
        [], None,
    ]
    df = spark.createDataFrame([(at(10), json.dumps(p) if p is not None else None) for p in payloads] + [(dt.datetime(2023, 1, 1), json.dumps(payloads[0]))], "start_time timestamp_ntz, credits_granular string")
    assert rows(O.nested_credits(df, AS_OF)) == [(dt.date(2024, 1, 10), "analyst", "m1", 11), (dt.date(2024, 1, 10), "analyst", "m2", 0)]


def feedback(spark, *data):
    return spark.createDataFrame([(f"f{i}", "u", s, t, "q" * 90 + str(i), "a", r, c) for i, (s, t, r, c) in enumerate(data)], "feedback_id string, user_id string, session_id string, turn_index long, question string, answer string, rating string, created_at timestamp_ntz")


def test_negative_gaps_look_at_negative_turns_only(spark):
    df = feedback(spark, ("s", 1, "down", at(2, 0, 0, 0)), ("s", 3, "up", at(2, 0, 1)), ("s", 5, "down", at(2, 0, 2, 0)), ("t", 1, "down", at(3)))
    assert rows(O.negative_turns(df), "session_id", "turn_index", "seconds_since_prev_turn") == [("s", 1, None), ("s", 5, 120), ("t", 1, None)]
    assert O.negative_turns(df, 1).first().session_id == "t"


def test_boundaries_are_counted(spark):
    from clearplate.functions.cast import seconds_between

    df = spark.createDataFrame([(at(1, 0, 0, 0, 900_000), at(1, 0, 0, 1, 100_000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_cost_and_quality_fan_out(spark):
    """Two requests and three ratings in one hour: six rows when joined first."""
    used = spark.createDataFrame([("u", at(2, 0, 5), 10, 1.0), ("u", at(2, 0, 6), 20, 2.0)], "user_name string, start_time timestamp_ntz, tokens long, token_credits double")
    rated = feedback(spark, ("s", 1, "up", at(2, 0, 1)), ("s", 2, "down", at(2, 0, 2)), ("s", 3, "up", at(2, 0, 3)), ("s", 4, "up", at(2, 5)))
    columns = ["rated_turns", "thumbs_down", "satisfaction_pct", "tokens_in_window", "estimated_cost_usd"]
    assert rows(O.cost_and_quality(rated, used, AS_OF), *columns) == [(1, 0, 100.0, 0, 0.0), (3, 1, 66.7, 30, 9.0)]
    joined = rated.join(used, (F.col("user_id") == F.col("user_name")) & (F.date_trunc("hour", "created_at") == F.date_trunc("hour", "start_time")), "left")
    want = joined.groupBy("session_id", F.date_trunc("hour", "created_at")).agg(
        F.count("*").alias("rated_turns"), F.count_if(F.col("rating") == "down").alias("thumbs_down"), F.round(100.0 * F.count_if(F.col("rating") == "up") / F.count("*"), 1).alias("satisfaction_pct"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens_in_window"), F.round(F.coalesce(F.sum("token_credits"), F.lit(0.0)) * 3.0, 4).alias("estimated_cost_usd"),
    )
    assert rows(O.cost_and_quality(rated, used, AS_OF, raw_join=True), *columns) == rows(want, *columns)


def test_stored_payloads_are_not_parsed_again(spark, tmp_path):
    payload = json.dumps([{"r1": {"analyst": {"m1": {"input": 3, "output": 2}}, "start_time": "x"}}])
    df = spark.createDataFrame([(at(10), payload), (at(11), "no json"), (at(12), None)], "start_time timestamp_ntz, credits_granular string")
    O.load_payloads(df, str(tmp_path / "usage"), ["credits_granular"])
    stored = spark.read.parquet(str(tmp_path / "usage"))
    assert dict(stored.dtypes)["credits_granular_v"] == "variant"
    got, plain = O.nested_credits(stored, AS_OF), O.nested_credits(df, AS_OF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "parsejson" not in plan.lower() and "parsejson" in plain._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(got) == rows(plain) and got.first()["total_credits"] == 5
    asked = spark.createDataFrame([(at(10), "u", '[{"positive":true}]', '{"agent_request_id":"r1"}'), (at(10), "u", "[]", "{}"), (at(10), "u", None, "bad")], "timestamp timestamp_ntz, user_id string, feedback string, source string")
    asked = asked.withColumns({c: F.lit(None).cast("string") for c in ("semantic_model_name", "latest_question", "generated_sql", "response_status_code")})
    O.load_payloads(asked, str(tmp_path / "asked"), ["feedback", "source"])
    kept = spark.read.parquet(str(tmp_path / "asked"))
    for question in (O.requests_with_feedback, O.agent_requests):
        found = question(kept, AS_OF)
        assert "parsejson" not in found._jdf.queryExecution().executedPlan().toString().lower()
        assert rows(found) == rows(question(asked, AS_OF)) and found.count() == 1


def test_stems(spark):
    df = feedback(spark, ("s", 1, "down", at(2)), ("s", 2, "down", at(3)), ("s", 3, "up", at(4)))
    assert rows(O.question_stems(df), "question_prefix", "negative_ratings", "distinct_users") == [("q" * 80, 2, 1)]
    assert O.satisfaction(df, AS_OF).first().satisfaction_pct == 33.3
    assert O.satisfaction_by_user(df, AS_OF, at_least=4).count() == 0


# -- map -------------------------------------------------------------------------


@pytest.mark.parametrize("metres, cell_places", [(804.0, 10**6), (804.0, 30), (50_000.0, 10**6), (50_000.0, 50)])
def test_radius_equals_brute_force(spark, metres, cell_places):
    rng = random.Random(7)
    spots = [(i, 40.5 + rng.random() * 0.1, -74.2 + rng.random() * 0.1) for i in range(300)] + [(1000 + i, 40.55, -74.15) for i in range(150)]
    spots += [(2000, None, -74.0), (2001, 89.99, 10.0), (2002, 89.99, -170.0), (2003, 0.0, 179.999), (2004, 0.0, -179.999)]
    df = spark.createDataFrame(spots, "id long, latitude double, longitude double")
    centres = spark.createDataFrame([(1, 40.55, -74.15), (2, 40.52, -74.11), (3, 89.995, 100.0), (4, 0.0, 180.0)], "point_id long, point_lat double, point_lon double")
    d = haversine_m(F.col("latitude"), F.col("longitude"), F.col("point_lat"), F.col("point_lon"))
    want = df.crossJoin(centres).filter(d <= metres)
    got = G.within_radius(df, centres, metres, cell_places)
    assert rows(got, "id", "point_id") == rows(want, "id", "point_id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_inferred_grades(spark):
    df = spark.createDataFrame([("a", "13", "1"), ("b", "13.5", "1"), ("c", "27", "1"), ("d", "28", "1"), ("e", None, "1"), ("f", "1", "x")], "restaurant_name string, inspection_score string, latitude string")
    df = df.withColumns({"borough": F.lit("B"), "longitude": F.col("latitude"), "cuisine_type": F.lit(None).cast("string")})
    points = G.points_from_rows(df)
    assert rows(points, "restaurant_name", "grade", "score", "cuisine_type") == [("a", "A", 13, ""), ("b", "B", 14, ""), ("c", "B", 27, ""), ("d", "C", 28, ""), ("e", "", None, "")]
    styled = {r.restaurant_name: r for r in G.style_points(points).collect()}
    assert styled["a"].fill_color == [0, 180, 0, 210] and styled["e"].score == "–" and styled["e"].fill_color == [150, 150, 150, 180]
    strip = G.kpi_strip(points).first()
    assert tuple(strip) == (5, 4, 25.0, 20.5)


def test_a_crowded_cell_is_cut_by_its_count(spark):
    """Nearly a third of all places in one cell: no group of the join holds more than about the bound."""
    rng = random.Random(5)
    crowd = [(i, 40.7 + rng.random() / 500, -74.0 + rng.random() / 500) for i in range(3_000)]
    rest = [(i, 40.0 + rng.random(), -74.5 + rng.random()) for i in range(3_000, 10_000)]
    df = spark.createDataFrame([*crowd, *rest], "id long, latitude double, longitude double")
    centres = spark.createDataFrame([(1, 40.701, -73.999), (2, 40.5, -74.2)], "point_id long, point_lat double, point_lon double")
    located, spread = G._in_cells(df, centres, 804.0, 100)
    sizes = sorted(r["count"] for r in located.groupBy("cell_lat", "cell_lon", "_part").count().collect())
    assert sizes[-1] < 150 and sum(sizes) == 10_000
    assert spread.groupBy("point_id", "cell_lat", "cell_lon", "_part").count().filter("count > 1").count() == 0
    whole, cut = (rows(G.within_radius(df, centres, 804.0, n), "id", "point_id") for n in (10**6, 100))
    assert whole == cut and len(whole) > 2_500


def test_result_events(spark):
    def event(names, data):
        return json.dumps({"event": "response.table", "data": {"result_set": {"resultSetMetaData": {"numRows": 1, "rowType": [{"name": n} for n in names]}, "data": data}}})

    names = ["RESTAURANT_NAME", "BOROUGH", "N"]
    df = spark.createDataFrame([(event(names, [["A", "Q", "1"], ["B", None, "2"]]),), (event(names, [[["C", "", "3"], ["A", "Q", "4"]], "junk"]),), (event(["N"], [["5"]]),), ("not json",), (None,)], "payload string")
    assert rows(result_table(df, ["RESTAURANT_NAME", "N"])) == [("A", "1"), ("A", "4"), ("B", "2"), ("C", "3"), (None, "5")]
    assert rows(name_borough_pairs(df)) == [("A", "Q"), ("B", ""), ("C", "")]


def test_map_filters_follow_the_aggregate(layer, marts):
    per = G.per_restaurant(layer, marts, "1995-01-01", "2001-08-01").cache()
    kept = G.outcome_filter(per, ["A"], True)
    assert kept.filter("latest_grade <> 'A' OR NOT any_critical").count() == 0
    assert kept.join(per.select("dim_restaurant_key", "inspection_count"), ["dim_restaurant_key", "inspection_count"], "left_anti").count() == 0
    assert G.summary_table(per, 3).count() == 3


# -- streams ---------------------------------------------------------------------


def test_fact_state_over_batches(spark, tmp_path):
    """Batches out of order, some delivered twice, a restart from the checkpoint, a store that comes after its delete."""
    from clearplate.operators.facts import fold_facts

    rng = random.Random(3)
    events = [(f"u{rng.randrange(6)}", f"k{rng.randrange(4)}", str(i), rng.choice(["store", "store", "delete"]), i) for i in range(200)]
    rng.shuffle(events)
    events += [("late", "k", "gone", "delete", 500), ("late", "k", "old", "store", 400), ("late", "j", "stays", "store", None), ("late", "j", "newer", "store", 1)]
    schema = "user_id string, fact_key string, fact_value string, action string, ts long"
    source, out, check = tmp_path / "in", str(tmp_path / "changes"), str(tmp_path / "check")

    def deliver(name, part):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(source / name))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
        X.fact_state_stream(stream, out, check).awaitTermination()

    for i in range(3):
        deliver(f"b{i}", events[i * 50 : i * 50 + 50])
    deliver("delete", [events[200], events[202]])
    run()
    assert rows(X.fact_state(spark, check)) == rows(fold_facts(spark.createDataFrame([*events[:150], events[200], events[202]], schema)))
    deliver("again", events[:50])
    deliver("late", [events[201], events[203], *events[150:200]])
    run()
    assert rows(X.fact_state(spark, check)) == rows(fold_facts(spark.createDataFrame(events, schema)))
    # The table of changes comes to the same newest record of each key, deletes included.
    newest = X.latest_values(spark, out, X.FACT_KEY)
    assert rows(newest) == rows(X.kept_state(spark, check)) and newest.filter("action = 'delete' AND user_id = 'late'").count() == 1
    assert spark.conf.get(X.STATE_STORE) != X.ROCKSDB


def test_repeated_batch_of_updates(spark, tmp_path):
    """A batch that is written again, as after a failure, leaves one row per key."""
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    tables.overwrite_partitions(df.withColumn("_at", F.lit(0)), path, ["_at"])
    for _ in range(2):
        tables.overwrite_partitions(df.filter("k = 'a'").withColumns({"n": F.lit(5), "_at": F.lit(1)}), path, ["_at"])
    assert rows(X.latest_values(spark, path, ["k"]), "k", "n") == [("a", 5), ("b", 2)] and spark.read.parquet(path).count() == 3


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "start_time timestamp, agent_name string, tokens long, token_credits double"
    source = tmp_path / "in"
    # A record is judged by the watermark of the batch before, so the late one comes two batches after the jump.
    parts = [[(at(1, 10), "a", 1, 1.0)], [(at(1, 20), "a", 1, 1.0)], [(at(1, 20, 10), "a", 1, 1.0)], [(at(1, 10, 30), "a", 4, 1.0), (at(1, 20, 30), "a", 8, 1.0)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(source / f"b{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
    out = str(tmp_path / "out")
    X.write_updates(X.hourly_usage(stream), out, str(tmp_path / "check")).awaitTermination()
    got = {r.hour.hour: r.total_tokens for r in X.latest_values(spark, out, ["hour", "agent_name"]).collect()}
    assert got == {10: 1, 20: 10}


def test_adapters_cover_whole_tables(spark, sf_dir):
    n = bind.table(spark, sf_dir, "lineitem").count()
    assert bind.raw_inspections(spark, sf_dir).count() == n and bind.result_events(spark, sf_dir).filter("payload IS NOT NULL").count() == n


def test_window_ends_before_as_of(spark):
    days = [(at(d), at(d), "u", "agent", 10, 1.0) for d in (4, 5, 14, 15, 20)]
    df = spark.createDataFrame(days, "start_time timestamp_ntz, end_time timestamp_ntz, user_name string, agent_name string, tokens long, token_credits double")
    got = [r.usage_date.day for r in O.daily_usage(df, "2024-01-15", days=10).collect()]
    assert got == [14, 5]
