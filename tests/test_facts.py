from __future__ import annotations

import datetime as dt
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from clearplate.operators import evaluation as E
from clearplate.operators import facts as U
from clearplate.sources import tables as T

DAY = dt.datetime(2024, 1, 1)
FACT = "user_id string, fact_key string, fact_value string, category string, fact_embedding array<float>, created_at timestamp_ntz, updated_at timestamp_ntz"


def facts(spark, *data):
    return spark.createDataFrame([(u, k, v, c, e, DAY, DAY + dt.timedelta(hours=i)) for i, (u, k, v, c, e) in enumerate(data)], FACT)


def test_normalise(spark):
    df = facts(spark, ("u", " Home Address ", " O'Hara St ", "LOCATION ", None), ("u", "  ", "x", None, None), ("u", "k", " ", None, None), ("u", "role", "chef", "job", None))
    assert rows(U.normalise_facts(df), "fact_key", "fact_value", "category") == [("home_address", "O'Hara St", "location"), ("role", "chef", "general")]


def test_store_twice_is_store_once(spark):
    target = facts(spark, ("u", "home_address", "old", "location", None), ("v", "role", "chef", "identity", None))
    later = [F.desc("updated_at")]
    batch = facts(spark, ("u", "Home Address", "first", "location", [1.0]), ("u", "home address", "last", "location", [2.0]), ("w", "role", "cook", "identity", None))
    batch = batch.withColumn("created_at", F.lit("2025-01-01").cast("timestamp_ntz"))
    once = U.store_facts(target, batch, later)
    assert rows(once, "user_id", "fact_key", "fact_value") == [("u", "home_address", "last"), ("v", "role", "chef"), ("w", "role", "cook")]
    assert once.filter("user_id = 'u'").first().created_at == DAY and once.filter("user_id = 'w'").first().created_at.year == 2025
    assert rows(U.store_facts(once, batch, later)) == rows(once)


def test_delete_insert_correct(spark, tmp_path):
    target = facts(spark, ("u", "a", "1", "general", None), ("u", "b", "2", "general", None), ("v", "a", "3", "general", None))
    doomed = spark.createDataFrame([("u",), ("u",)], "user_id string")
    assert rows(T.delete_where(target, doomed, ["user_id"]), "user_id") == [("v",)]
    assert T.deleted_counts(target, doomed, ["user_id"]).first().rows_deleted == 2
    source = facts(spark, ("u", "a", "other", "general", None), ("w", "a", "4", "general", None))
    assert rows(T.insert_missing(target, source, ["user_id", "fact_key"]), "user_id", "fact_key", "fact_value")[-1] == ("w", "a", "4")
    changes = spark.createDataFrame([("u", "a", "new", [1.0]), ("x", "a", "none", [1.0])], "user_id string, fact_key string, fact_value string, fact_embedding array<float>")
    fixed = T.correct_fact(target, changes)
    assert rows(fixed, "user_id", "fact_key", "fact_value") == [("u", "a", "new"), ("u", "b", "2"), ("v", "a", "3")]
    with pytest.raises(ValueError):
        T.correct_fact(target, changes.drop("fact_embedding"))
    assert T.full_refresh(target, str(tmp_path / "t")) == 3
    T.replace_by_key(target, str(tmp_path / "p"), "user_id")
    T.replace_by_key(target.filter("user_id = 'u' AND fact_key = 'a'"), str(tmp_path / "p"), "user_id")
    assert rows(T.stored(spark, str(tmp_path / "p")), "user_id", "fact_key") == [("u", "a"), ("v", "a")]


def test_replace_by_key_of_odd_values(spark, tmp_path):
    """NULL, empty, long and odd values of the key are partitions of their own; a failed change is not seen."""
    path = str(tmp_path / "t")
    keys = [None, "", "a/b=c %20", "x" * 400, "1", "01"]
    first = spark.createDataFrame([(k, i, "old") for i, k in enumerate(keys) for _ in range(3)], "source_url string, n int, v string")
    T.replace_by_key(first, path, "source_url")
    assert rows(T.stored(spark, path)) == rows(first)
    broken = first.select("source_url", "n", F.when(F.col("n") == 3, F.raise_error(F.lit("lost"))).otherwise("new").alias("v"))
    with pytest.raises(Exception, match="lost"):
        T.replace_by_key(broken, path, "source_url")
    assert rows(T.stored(spark, path)) == rows(first)
    for k in keys:
        again = spark.createDataFrame([(k, 9, "new")], first.schema)
        for _ in range(2):
            T.replace_by_key(again, path, "source_url")
        assert [tuple(r) for r in T.stored(spark, path).filter(F.col("source_url").eqNullSafe(k)).collect()] == [(k, 9, "new")]
    assert T.stored(spark, path).count() == len(keys)


def test_upsert_touches_few_partitions(spark, tmp_path):
    path = tmp_path / "t"
    first = spark.createDataFrame([(i, "old", DAY) for i in range(50)], "id long, v string, created_at timestamp_ntz")
    T.create_cut_by_keys(first, str(path), ["id"], part_rows=5)
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    before = files()
    assert len({f.parent for f in before}) == 10
    for _ in range(2):
        T.upsert_partitions(str(path), first.filter("id = 7").withColumn("v", F.lit("new")).unionByName(first.filter("id = 8").withColumn("id", F.lit(80).cast("long"))), ["id"])
    got = {r.id: r.v for r in T.stored(spark, str(path)).collect()}
    assert len(got) == 51 and got[7] == "new" and got[80] == "old"
    kept = {f.parent for f, t in files().items() if before.get(f) == t}
    assert len(kept) >= 8


def test_recall_of_one_user_with_nearly_everything(spark):
    rng = random.Random(4)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    held = [("u" if i % 20 else f"w{i}", f"k{i}", f"v{i}", "general", vec(), DAY) for i in range(400)]
    df = spark.createDataFrame(held, "user_id string, fact_key string, fact_value string, category string, fact_embedding array<double>, updated_at timestamp_ntz")
    q = spark.createDataFrame([(i, "u", vec()) for i in range(60)], "query_id long, user_id string, embedding array<double>")
    small = rows(U.recall(q, df, cell_facts=30, block_queries=7))
    assert small == rows(U.recall(q, df)) and len(small) > 200
    plan = U.recall(q, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 4


def test_ratings(spark):
    df = spark.createDataFrame([("u", "s", 1, "q", "a", "up"), ("u", "s", 2, "q", "a", "meh"), ("u", None, 3, "q", "a", "down")], "user_id string, session_id string, turn_index long, question string, answer string, rating string")
    got = T.rating_events(df).collect()
    assert len(got) == 1 and got[0].feedback_id and got[0].created_at


def test_context(spark):
    df = facts(spark, ("u", "home_address", "here", "location", None), ("u", "age", "9", "general", None))
    users = spark.createDataFrame([("u",), ("nobody",)], "user_id string")
    assert rows(U.context_text(users, df)) == [("nobody", ""), ("u", U.CONTEXT_HEADER + "  - age: 9\n  - home address: here")]
    assert [tuple(r) for r in U.facts_of(df, "u").collect()] == [("age", "9"), ("home_address", "here")]


def turns(spark, *data):
    return spark.createDataFrame([(1, i, role, text) for i, (role, text) in enumerate(data)], "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("text, key", [
    ("Could you share your home address?", "home_address"), ("Where is your office?", "work_location"), ("Which borough do you mean?", "preferred_borough"), ("What cuisine do you prefer?", "favorite_cuisine"),
    ("Which violation code?", "violation_focus"), ("what is your job", "role"), ("Your agency, please", "organization"), ("How far back should I look?", "time_window"),
    ("The address information you provided is fine", None), ("What is your home address and which borough?", "home_address"),
])
def test_requests(spark, text, key):
    got = U.detect_request(turns(spark, ("assistant", text))).collect()
    assert [r.fact_key for r in got] == ([key] if key else [])
    assert U.detect_request(turns(spark, ("user", text))).count() == 0


def test_capture(spark):
    talk = turns(
        spark, ("system", "x"), ("assistant", "What is your home address?"), ("user", "245 W 107th St"), ("user", "not an answer"),
        ("assistant", "Which borough?"), ("user", "is it open?"), ("assistant", "Your role?"), ("user", "Show me grades"), ("assistant", "Your team?"), ("assistant", "Take your time."), ("user", "Food safety"),
        ("assistant", "your job?"),
    )
    assert rows(U.capture_facts(talk), "turn", "fact_key", "fact_value") == sorted([(2, "home_address", "245 W 107th St"), (10, "organization", "Food safety")], key=repr)
    assert rows(U.capture_facts(talk, guard=False), "turn") == sorted([(2,), (5,), (7,), (10,)], key=repr)


@pytest.mark.parametrize("text, key", [
    ("please forget my home address", "home_address"), ("REMOVE the saved cuisine", "favorite_cuisine"), ("delete\nmy role", None), ("clear all of the things that you know about me and my old team", None), ("erase where I live", "home_address"), ("my address", None),
])
def test_delete_requests(spark, text, key):
    got = U.detect_delete(turns(spark, ("user", text))).collect()
    assert [r.fact_key for r in got] == ([key] if key else [])


def test_fold(spark):
    ev = spark.createDataFrame([
        ("u", "a", "1", "store", 1), ("u", "a", None, "delete", 2), ("u", "a", "2", "store", 3), ("u", "b", "1", "store", 1), ("u", "b", "REMOVE", "store", 2), ("u", "c", "1", "store", 1), ("u", "c", None, "delete", 5),
    ], "user_id string, fact_key string, fact_value string, action string, ts long")
    assert rows(U.fold_facts(ev)) == [("u", "a", "2", 3)]


def test_recall(spark):
    high, edge, low = [1.0, 0.0], [0.3, (1 - 0.09) ** 0.5], [0.2999, (1 - 0.2999**2) ** 0.5]
    df = facts(spark, ("u", "a", "x", "general", high), ("u", "b", "y", "general", edge), ("u", "c", "z", "general", low), ("v", "a", "x", "general", [-1.0, 0.0]))
    q = spark.createDataFrame([(1, "u", [2.0, 0.0]), (2, "v", [1.0, 0.0]), (3, "w", [1.0, 0.0])], "query_id long, user_id string, embedding array<float>")
    assert rows(U.recall(q, df), "query_id", "fact_key", "similarity", "rank") == [(1, "a", 1.0, 1), (1, "b", 0.3, 2)]
    assert rows(U.recall(q, df, 1), "fact_key") == [("a",)]
    assert rows(U.recall(q, df, cell_facts=1, block_queries=1)) == rows(U.recall(q, df))
    texts = {r.query_id: (r.status, r.text) for r in U.recall_text(q, df).collect()}
    assert texts[1][1].splitlines() == ["Found 2 relevant fact(s) for user u:", "- a: x (category: general, relevance: 1.0, updated: 2024-01-01 00:00)", "- b: y (category: general, relevance: 0.3, updated: 2024-01-01 01:00)"]
    assert texts[2] == ("none_relevant", "") and texts[3] == ("no_facts", "")
    assert [U.clamp_results(k) for k in (0, 5, 50, None, -3)] == [5, 5, 10, 5, 1]
    assert U.similarity_matrix(df, {"p": [1.0, 0.0]}).filter("fact_key = 'b'").first().sim_p == 0.3


def test_recall_of_a_user_with_most_facts(spark):
    """One user holds nearly all facts, many of them equal: cells give the same as the plain join."""
    data = [("big" if i % 10 else f"u{i % 7}", f"k{i:04d}", "v", "general", [1.0, float(i % 4), 0.5]) for i in range(600)]
    df = facts(spark, *data)
    q = spark.createDataFrame([(i, "big" if i % 2 else "u3", [1.0, float(i), 0.0]) for i in range(8)], "query_id long, user_id string, embedding array<float>")
    assert rows(U.recall(q, df, 5, cell_facts=50, block_queries=3), "query_id", "fact_key", "similarity", "rank") == rows(U.recall(q, df, 5), "query_id", "fact_key", "similarity", "rank")


def test_answers(spark):
    texts = [
        "📅 Data through: 2025-11-14\n🔍 Filters applied:\n   - grade IN ('A') — Final grades only\n – role -- because\n - alone\n\nBody one.\n- a bullet of the body",
        "Intro\n🔍 filters applied:\n- x — y — z\nno blank line before this",
        "Nothing here", "🔍 Filters applied:\n\nOnly a header", "🔍 Filters applied:\n- a\n📅 Data through: today\n- kept",
    ]
    df = U.parse_answers(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i")
    got = [(r.freshness_date, [tuple(p) for p in r.filter_parts], r.body) for r in df.collect()]
    assert got == [
        ("2025-11-14", [("grade IN ('A')", "Final grades only"), ("role", "because"), ("alone", None)], "Body one.\n- a bullet of the body"),
        (None, [("x", "y — z")], "Intro\nno blank line before this"),
        (None, [], "Nothing here"), (None, [], "Only a header"), ("today", [("a", None)], "- kept"),
    ]


def test_geo_text(spark):
    df = spark.createDataFrame([("Anything near my office?", "ST_MAKEPOINT( -73.99 , 40.7)"), ("nearly done", "st_makepoint(1,2)"), ("show me a MAP", None)], "q string, s string")
    got = [tuple(r) for r in df.select(U.geo_intent(F.col("q")), U.sql_point(F.col("s"))["latitude"], U.sql_point(F.col("s"))["longitude"]).collect()]
    assert got == [(True, 40.7, -73.99), (False, None, None), (True, None, None)]


def test_conflicts(spark):
    df = facts(spark, ("u", "home_address", "100 Broadway, Financial District", "location", None), ("u", "home_borough", "Brooklyn", "location", None), ("v", "home_address", "Brooklyn Heights", "location", None), ("v", "home_borough", "brooklyn", "location", None))
    places = {r"\b(manhattan|financial district)\b": "Manhattan", r"\bbrooklyn\b": "Brooklyn"}
    assert rows(U.conflicts(df, places, ["home_address", "home_borough"]), "user_id", "place_a", "place_b") == [("u", "Manhattan", "Brooklyn")]


def test_evaluation(spark):
    schema = "run_id string, agent string, question_id string, category string, expected_tools array<string>, actual_tools array<string>, passed boolean"
    df = spark.createDataFrame([
        ("1", "a", "q1", "c", ["x", "y"], ["y", "x"], True), ("1", "a", "q2", "c", ["x"], ["x", "z"], False), ("1", "a", "q3", "c", ["x"], [], None), ("1", "a", "q5", "c", ["x"], ["x"], False),
        ("2", "b", "q1", "c", ["x"], ["x"], False), ("2", "b", "q2", "c", ["x"], ["x"], True), ("2", "b", "q4", "c", ["x"], ["x"], True), ("2", "b", "q3", "c", ["x"], ["x"], True), ("2", "b", "q5", "c", ["x"], ["x"], False),
    ], schema)
    assert rows(E.scorecard(df)) == [("1", "c", 4, 1, 2, 1, 33.3), ("2", "c", 5, 3, 2, 0, 60.0)]
    match = {r.question_id: r for r in E.tool_match(df.filter("run_id = '1'")).collect()}
    assert match["q1"].same_tools and not match["q1"].same_order and match["q2"].extra_tools == ["z"] and match["q3"].missing_tools == ["x"]
    assert rows(E.regression(df, "1", "2"), "question_id", "change") == [("q1", "broken"), ("q2", "fixed"), ("q3", "open"), ("q4", "added"), ("q5", "unchanged")]
    assert rows(E.overuse(df, ["c"], ["z"]), "question_id") == [("q2",)]
    assert rows(E.compare_agents(df, ["a", "b"])) == [("c", 33.3, 60.0)]
