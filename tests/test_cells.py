"""Stored cells: exact when all are asked, pruned otherwise, bounded in a crowded cell."""

from __future__ import annotations

import numpy as np
import pytest
from frames import rows

from clearplate.operators import cells as V
from clearplate.operators import retrieval as R


def frame(spark, vectors, name="doc_id"):
    data = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, f"{name} long, embedding array<double>").repartition(3)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 16)) * 3
    own = [middles[i % 12] + rng.normal(size=16) for i in range(500)]
    # A third of all vectors are one vector; some are NULL or zero.
    return [*own, *[own[0]] * 250, None, None, np.zeros(16), np.zeros(16)]


@pytest.fixture(scope="module")
def stored(spark, vectors, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "index")
    V.write_cells(frame(spark, vectors), path, cells=20)
    return path


@pytest.fixture(scope="module")
def asked(spark, vectors):
    return frame(spark, [vectors[3], vectors[700], None, vectors[-1], vectors[100]], "query_id")


def test_all_cells_are_the_exact_search(spark, stored, asked, vectors):
    index = V.read_cells(spark, stored)
    assert index.vectors.count() == len(vectors) - 2 and index.probes <= len(index.centroids) == 20
    for cut in ({}, {"cell_rows": 7, "block_queries": 1}):
        got = V.cell_search(asked, index, 8, probes=20, **cut)
        assert rows(got, "query_id", "doc_id", "score", "rank") == rows(R.vector_search(asked, frame(spark, vectors), 8), "query_id", "doc_id", "score", "rank")


def test_default_probes_reach_recall_and_prune(spark, stored, vectors):
    index = V.read_cells(spark, stored)
    assert index.probes < 20
    queries = frame(spark, vectors[:200], "query_id")
    (r,) = V.recall_of(V.cell_search(queries, index), R.vector_search(queries, frame(spark, vectors))).collect()
    assert r["queries"] == 200 and r["found"] >= 0.9 * r["wanted"]


def test_cells_not_asked_are_not_read(spark, stored, asked):
    plan = V.cell_search(asked.filter("query_id = 0"), V.read_cells(spark, stored), probes=1)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "vectors" in line]
    assert filters and all("cell" in line.split("PartitionFilters: ")[1].split("]")[0] for line in filters)


def test_added_vectors_are_found(spark, vectors, tmp_path):
    path = str(tmp_path / "index")
    V.write_cells(frame(spark, vectors[:300]), path)
    new = frame(spark, vectors).filter("doc_id >= 300")
    V.add_vectors(new, path)
    queries = frame(spark, vectors[400:410], "query_id")
    index = V.read_cells(spark, path)
    got = V.cell_search(queries, index, probes=len(index.centroids))
    assert rows(got, "query_id", "doc_id", "score") == rows(R.vector_search(queries, frame(spark, vectors)), "query_id", "doc_id", "score")


def test_nothing_to_find(spark, stored, asked, tmp_path):
    nothing = frame(spark, [None])
    V.write_cells(nothing, str(tmp_path / "empty"))
    empty = V.read_cells(spark, str(tmp_path / "empty"))
    assert V.cell_search(asked, empty).count() == 0
    assert V.cell_search(asked.limit(0), V.read_cells(spark, stored)).count() == 0
    with pytest.raises(ValueError):
        V.add_vectors(nothing, str(tmp_path / "empty"))


def test_probes_cover_the_sampled_neighbours():
    rng = np.random.default_rng(1)
    sample = R.unit_rows(rng.normal(size=(400, 8)))
    centers = V.centroids_of(sample, 16)
    few, many = V.probes_for(sample, centers, recall=0.5), V.probes_for(sample, centers, recall=1.0)
    assert 1 <= few < many <= 16 and V.probes_for(sample[:1], centers) == 16
    same = np.repeat(sample[:1], 50, axis=0)
    assert len(V.centroids_of(same, 8)) == 1


def test_made_and_read_without_arrow_transfer(spark, vectors, asked, tmp_path):
    """The driver's frames may come and go without Arrow, which is a plain session's setting."""
    setting = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        V.write_cells(frame(spark, vectors), str(tmp_path / "index"), cells=20)
        index = V.read_cells(spark, str(tmp_path / "index"))
        got = rows(V.cell_search(asked, index, 8, probes=20), "query_id", "doc_id", "score", "rank")
    finally:
        spark.conf.set(setting, before)
    assert got == rows(R.vector_search(asked, frame(spark, vectors), 8), "query_id", "doc_id", "score", "rank")
