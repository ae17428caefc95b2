"""Parts that follow the number of rows, so that no task grows with the tables."""

from __future__ import annotations

import datetime as dt
import glob
import re

import numpy as np
from frames import rows
from pyspark.sql import functions as F

from clearplate.operators import facts as U
from clearplate.operators import geo as G
from clearplate.operators import marts as M
from clearplate.operators import retrieval as R
from clearplate.operators import staging as S
from clearplate.plans import build
from clearplate.registry import QUERIES, star
from clearplate.sources import bind


def citations(spark, n):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int"))
    return spark.range(n).select(
        F.lit("1").alias("restaurant_id"), F.when(F.col("id") % 10 > 0, day).alias("inspection_date"), F.lit("type").alias("inspection_type"), F.lit("action").alias("action"),
        F.col("id").cast("string").alias("violation_code"), (F.col("id") % 2 == 0).alias("is_critical_violation"), F.lit(7).alias("inspection_score"),
    )


def test_landed_lines_lie_in_parts_by_their_number(spark, sf_dir, monkeypatch):
    monkeypatch.setitem(bind.LANDED_ROWS, "lineitem", 100)
    lines = bind.table(spark, sf_dir, "lineitem").count()
    assert bind.raw_inspections(spark, sf_dir).rdd.getNumPartitions() >= lines / 100


def test_a_month_is_cut_by_its_rows_and_keys_are_made_after(spark, monkeypatch):
    monkeypatch.setattr(build, "PART_ROWS", 100)
    stg, dates = citations(spark, 2000), M.dim_date(spark)
    placed = build.by_month(stg)
    seen = []
    fact = M.fct_violations(stg, dates, lambda df: placed(seen.append(df.columns) or df))
    assert not [c for c in seen[0] if c.endswith("_key")]
    sizes = fact.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 700  # one month and the rows without a day; uncut, 1800 rows lie together
    plain = M.fct_violations(stg, dates)
    assert rows(fact.drop(build.MONTH)) == rows(plain)


def test_profile_is_that_of_the_newest_record_then_load(spark):
    day, time = dt.date, dt.datetime
    seen = [
        ("1", "OLD", day(2024, 1, 1), time(2024, 5, 1, 23, 59, 59, 999999)), ("1", "NEW", day(2024, 1, 2), time(2024, 2, 1)), ("1", "NONE", None, time(2025, 1, 1)),
        ("2", "LATE", None, time(2024, 1, 1, 0, 0, 0, 2)), ("2", "EARLY", None, time(2024, 1, 1, 0, 0, 0, 1)), ("2", "NONE", None, None),
        ("3", "B", day(1960, 1, 1), None), ("3", "A", day(1960, 1, 1), None), ("3", "Z", day(1959, 12, 31), time(2024, 1, 1)),
    ]
    frame = spark.createDataFrame(seen, "restaurant_id string, restaurant_name string, record_date date, loaded_at timestamp_ntz")
    frame = frame.select("*", *[F.lit(None).cast("string").alias(c) for c in S.PROFILE if c not in frame.columns])
    found = S.latest_profile(frame)
    assert rows(found, "restaurant_id", "restaurant_name") == [("1", "NEW"), ("2", "LATE"), ("3", "A")]
    assert "WindowGroupLimit" not in found._jdf.queryExecution().executedPlan().toString().split("HashAggregate")[-1]


def test_landed_json_is_compressed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "fresh_path", lambda spark, label: str(tmp_path / label))
    QUERIES["s1_read_landed_json"](spark, sf_dir).collect()
    assert glob.glob(str(tmp_path / "landed" / "*.json.gz")) and not glob.glob(str(tmp_path / "landed" / "*.json"))


def test_counts_within_a_radius_are_those_of_the_pairs(spark):
    places = spark.createDataFrame([(i, 40.7 + i % 5 * 0.004, -73.9) for i in range(200)] + [(999, None, None)], "restaurant_id int, latitude double, longitude double")
    points = spark.createDataFrame([(i, 40.7 + i % 3 * 0.006, -73.9) for i in range(60)] + [(60, 10.0, 10.0)], "point_id int, point_lat double, point_lon double")
    want = G.within_radius(places, points, 900.0).groupBy("point_id").agg(F.count("*").alias("restaurants"), F.min("distance_m").alias("nearest_m"))
    got = G.count_within_radius(places, points, 900.0, cell_places=2)
    assert rows(got, "point_id", "restaurants", "nearest_m") == rows(want) and got.count() == 60


def test_buckets_of_an_index_follow_the_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "BUCKET_WORDS", 50)
    docs = spark.createDataFrame([(i, f"common word number{i} of text") for i in range(100)], "doc_id long, chunk_text string")
    R.write_index(R.build_index(docs), str(tmp_path / "index"), buckets=2)
    assert spark.read.parquet(str(tmp_path / "index" / "totals")).first()["buckets"] == 10


def test_a_bucket_is_sorted_in_little_memory():
    assert R.BUCKET_WORDS * 50 <= 1 << 27  # a task that sorts a bucket holds 50 bytes for each word of its texts


def test_groups_of_a_search_are_dealt_by_documents(spark, monkeypatch):
    monkeypatch.setattr(R, "CELL_DOCS", 5)
    docs = spark.createDataFrame([(i, f"common word number{i % 7}") for i in range(100)], "doc_id long, chunk_text string")
    asked = spark.createDataFrame([(i, f"common number{i}") for i in range(4)], "query_id long, query_text string")
    index = R.build_index(docs)
    cut = R._asked(asked, index, 2, 100, 10)
    assert cut.parts == 100 * cut.blocks // 5 and cut.dealt(cut.weights.withColumn("cell", F.lit(0))).rdd.getNumPartitions() == cut.parts
    assert rows(R.keyword_search(asked, index, block_queries=2, cell_docs=10)) == rows(R.keyword_search(asked, index))


def test_a_product_of_vectors_is_made_in_slices(monkeypatch):
    monkeypatch.setattr(R, "MATRIX_CELLS", 40)
    sizes, add = [], R._Best.add
    monkeypatch.setattr(R._Best, "add", lambda self, ids, scores, valid=None: sizes.append(scores.size) or add(self, ids, scores, valid))
    rng = np.random.default_rng(1)
    asked, held = R.unit_rows(rng.normal(size=(4, 8))), rng.normal(size=(101, 8))
    (got,) = [f for f in R._best(np.array([7]), asked[:1], iter([(np.arange(101), held)]), 3)]
    assert max(sizes) <= 40
    want = R.first_k(np.round(R.unit_rows(held) @ asked[0], 4), np.arange(101), 3)
    assert got["_id"].tolist() == want.tolist()
    assert U.MATRIX_CELLS == 4_000_000


def test_landed_documents_are_dealt_so_that_their_postings_fit_a_task(spark, sf_dir):
    chars = bind.table(spark, sf_dir, "documents").agg(F.avg(F.length("text"))).first()[0]
    assert bind.LANDED_ROWS["documents"] * chars < 1 << 24


def test_a_refresh_leaves_postings_by_id_where_they_lie(spark):
    docs = spark.createDataFrame([(i % 90, f"common word number{i}") for i in range(100)] + [(None, "no id")], "doc_id long, chunk_text string")
    changed, gone = docs.filter("doc_id < 10").withColumn("chunk_text", F.lit("new words")), docs.filter("doc_id >= 80")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = R.refresh_index(R.build_index(docs.repartition(3, "doc_id")), changed.repartition(3, "doc_id"), gone).postings
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ENSURE_REQUIREMENTS") == 1  # of the touched ids
        rebuilt = R.build_index(docs.filter("doc_id IS NULL OR doc_id >= 10 AND doc_id < 80").unionByName(changed)).postings
        assert rows(found, "term", "doc_id", "tf", "length") == rows(rebuilt, "term", "doc_id", "tf", "length")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_visit_is_in_one_part_of_its_month(spark, monkeypatch):
    monkeypatch.setattr(build, "PART_ROWS", 100)
    stg = citations(spark, 2000)
    placed = M.fct_violations(stg, M.dim_date(spark), build.by_month(stg)).withColumn("at", F.spark_partition_id())
    seen = placed.filter("inspection_date IS NOT NULL").select("restaurant_id", "inspection_date", "at").distinct().collect()
    assert len(seen) == 31 and len({r["at"] for r in seen}) > 1


def test_records_carry_only_what_is_used_of_lines_and_orders(spark, sf_dir):
    plan = bind.raw_inspections(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert moved and not [x for x in moved if "l_suppkey" in x or "n_name" in x]
    under = plan.split("Exchange hashpartitioning(l_orderkey")[1].split("\n")[1]
    assert "scored" in under and "described" in under and "l_partkey#" not in under.split("AS scored")[-1]


def test_views_over_one_staging_share_its_shuffle(spark, sf_dir):
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["derive_marts_lazy"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(restaurant_id" in x and "record_date#" in x]
    assert sum("ReusedExchange" in x for x in dealt) == 4 and len(dealt) == 5


def test_a_write_drops_its_shuffles_and_marts_are_packed(spark, sf_dir, tmp_path):
    def held() -> set[str]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.mkString("\n")))

    before = held()
    build.build_marts(bind.raw_inspections(spark, sf_dir), str(tmp_path / "marts"))
    left = held() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert len(left) < 5, left
    assert all(glob.glob(str(tmp_path / "marts" / name / "**" / "*.zstd.parquet"), recursive=True) for name in build.TABLES)
