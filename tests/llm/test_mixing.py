from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from clearplate.llm.mixing import MARGINS, _sql, cell_rates, mix, op6_mixing, sample


def test_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(_sql()).fetchall()
    got = [tuple(r) for r in op6_mixing(spark, sf_dir).select("doc_id", "source", "lang", "topic", "n_tokens", "prob", "kept").collect()]
    assert sorted(got) == sorted(want)


def test_raked_to_given_marginals(spark):
    rows = [(s, lang, t, 100) for s in "ab" for lang in "xy" for t in "pq" for _ in range(3 if s == "a" else 1)]
    counts = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    keyed = counts.select(*[F.to_json(F.struct(F.col(m).alias("v"))).alias(m) for m in MARGINS], "n_tokens")
    weights = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.75, "y": 0.25}, "topic": {"p": 0.6, "q": 0.4}}
    targets = {m: spark.createDataFrame(list(w.items()), f"{m} string, weight double") for m, w in weights.items()}
    got = cell_rates(keyed, targets=targets, budget=0.2).collect()
    kept = {tuple(r[m][6] for m in MARGINS): r["tokens"] * r["prob"] for r in got}
    total = sum(kept.values())
    assert total == pytest.approx(0.2 * 1600)
    for k, m in enumerate(MARGINS):
        for value, w in weights[m].items():
            assert sum(v for c, v in kept.items() if c[k] == value) / total == pytest.approx(w, rel=1e-6)


def test_budget_is_met_where_cells_are_full(spark):
    counts = spark.createDataFrame([("a", "x", "p", 1000), ("b", "x", "p", 10), ("c", "x", "p", 10)], "source string, lang string, topic string, n_tokens long")
    got = cell_rates(counts, powers={"source": 0.0, "lang": 1.0, "topic": 1.0}, budget=0.5).collect()
    assert sum(r["tokens"] * r["prob"] for r in got) == pytest.approx(510)
    assert max(r["prob"] for r in got) == 1.0


def test_edge_rows(messy, nothing):
    got = mix(messy).collect()
    assert len(got) == 13 and all(0 <= r["prob"] <= 1 for r in got)
    twice = [r for r in got if r["doc_id"] == 1]
    assert twice[0] == twice[1]
    kept = sorted(r["doc_id"] or 0 for r in got if r["kept"])
    left = sample(messy)
    assert left.columns == messy.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == kept
    assert mix(nothing).count() == 0 and sample(nothing).count() == 0


def test_share_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mix(docs).agg(F.sum(F.when(F.col("kept"), F.col("n_tokens"))) / F.sum("n_tokens")).first()[0]
    assert abs(got - 0.6) < 0.08
    plan = mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
