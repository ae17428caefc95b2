from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from clearplate.llm.exact_dedup import DigestIndex, dedupe, drop_copies
from clearplate.session import fresh_path


def index(spark):
    return DigestIndex(spark, fresh_path(spark, "test-index"), buckets=3)


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        norm = re.sub(r"[\x20\x09-\x0d]", "", text or "")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {h: (min(g)[3], len(g)) for h, g in groups.items()}


def check(spark, df, rows):
    got = dedupe(df, index(spark)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in got) == len(want)


def test_matches_brute_force(spark, docs, doc_rows):
    check(spark, docs, doc_rows)


def test_edge_rows(spark, messy, messy_rows):
    check(spark, messy, messy_rows)
    left = drop_copies(messy, index(spark))
    assert left.columns == messy.columns
    ids = sorted((r["doc_id"] or 0) for r in left.collect())
    assert ids == [0, 1, 4, 5, 6, 7, 9, 10]


def test_empty_table(spark, nothing):
    assert dedupe(nothing, index(spark)).count() == 0
    assert drop_copies(nothing, index(spark)).count() == 0


def test_index_lasts_over_batches(spark):
    schema = "doc_id long, text string"
    own = index(spark)
    first = dedupe(spark.createDataFrame([(1, "a b"), (2, "c")], schema), own)
    assert [r["kept"] for r in first.collect()] == [True, True]
    again = DigestIndex(spark, own.path, buckets=3)
    second = {r["doc_id"]: r for r in dedupe(spark.createDataFrame([(3, "a  b"), (4, "d"), (5, "d")], schema), again).collect()}
    assert (second[3]["keep_id"], second[3]["kept"]) == (1, False)
    assert (second[4]["keep_id"], second[4]["kept"], second[5]["kept"]) == (4, True, False)
    replay = {r["doc_id"]: r["kept"] for r in dedupe(spark.createDataFrame([(3, "a  b"), (4, "d"), (5, "d")], schema), again).collect()}
    assert replay == {3: False, 4: True, 5: False}
    assert again.bucketed().count() == 3


def test_index_is_joined_once_as_it_lies(spark):
    """The index side of the sort-merge join is a bucketed scan without an exchange, also for a batch too large to broadcast."""
    own = index(spark)
    dedupe(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"), own)
    best = spark.range(100).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("keep_id"), F.lit(1).alias("keep_points"))
    met = own.met(best)
    assert met.filter("known").count() == 0 and met.count() == 100
    plan = met._jdf.queryExecution().executedPlan().toString()
    # Only the batch is shuffled, to the index's buckets.
    assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 1 and plan.count("Exchange") == 1
