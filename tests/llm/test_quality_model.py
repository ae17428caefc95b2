from __future__ import annotations

import zlib

import numpy as np
import pytest

from clearplate.llm.quality_model import features, fit_hinge, margins, op10_quality_model, score, shape, train


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op10_quality_model(spark, sf).collect()
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    right = np.mean([r["predicted"] == labels[r["doc_id"]] for r in held])
    assert right > 0.95 and all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_hinge_fit_is_the_optimum():
    """Against gradient descent on the primal."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(40)]
    y = np.where([3 in r for r in rows], 1.0, -1.0)
    y[::7] *= -1
    values = rng.normal(size=12)
    x = np.zeros((40, 13))
    for k, r in enumerate(rows):
        x[k, r] = values[r] / np.sqrt(len(r))
        x[k, 12] = 1
    objective = lambda w: 0.5 * w @ w + (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    w = np.zeros(13)
    for _ in range(20_000):
        w -= 0.005 * (w - 2 * x.T @ (y * np.maximum(0, 1 - y * (x @ w))))
    got, bias = fit_hinge(rows, values, y, epochs=400)
    assert objective(np.append(got, bias)) == pytest.approx(objective(w), rel=1e-4)


def test_features_do_not_depend_on_the_batch():
    texts = ["One two one two three!!", "", "### token = 12ab", "One two one two three!!"]
    row, feature = features(texts)
    for k, t in enumerate(texts):
        assert sorted(features([t])[1]) == sorted(feature[row == k])
    assert shape("And12!!") == "Aa0!!" and shape("#" * 40) == "#" * 40


def test_edge_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (6, 1), (7, 1), (8, 0), (9, 0), (10, 1), (2, 0), (3, 5), (4, None), (None, 1)], "doc_id long, quality int")
    model = train(messy, labels)
    got = score(messy, model).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 for r in got)
    assert score(nothing, model).count() == 0
    assert margins(["", " "], model).tolist() == [model.intercept] * 2
    one = train(messy, labels.filter("quality = 1"))
    assert all(r["score"] > 0.99 for r in score(messy, one).collect())
    none = train(messy, labels.limit(0))
    assert {r["score"] for r in score(messy, none).collect()} == {0.5}


def test_an_id_on_very_many_rows(spark):
    """One labelled id on 20,000 rows is one row of the sample: the others still teach, and both classes are told apart."""
    good, bad = "calm words of even length follow here", "$$$ buy buy buy now now !!!"
    rows = [(0, good)] * 20_000 + [(i, f"{good} {i}" if i % 2 else f"{bad} {i}") for i in range(1, 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(0, 1)] + [(i, i % 2) for i in range(1, 31)], "doc_id long, quality int")
    model = train(docs, labels, rows=50)
    got = {r["doc"]["doc_id"]: r["score"] for r in score(docs, model).collect()}
    assert min(got[i] for i in range(1, 41, 2)) > 0.5 > max(got[i] for i in range(2, 41, 2))


def test_a_long_text_teaches_by_all_its_words(spark):
    """Only the last of 25,000 different words tells the classes apart; brute force of the fit on the same indicators."""
    long = " ".join(f"w{i}x" for i in range(25_000))
    rows = [(i, f"{long} {'good' if i % 2 else 'evil'}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    model = train(docs, spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int"))
    assert len(features([rows[0][1]])[1]) > 25_000
    split = [features([t])[1] for _, t in rows]
    teach = [k for k in range(12) if k % 5]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(12)])
    count = {c: 1.0 + sum(np.bincount(split[k], minlength=1 << 18) for k in teach if y[k] == c) for c in (1.0, -1.0)}
    ratio = np.log(count[1.0] / count[1.0].sum()) - np.log(count[-1.0] / count[-1.0].sum())
    w, bias = fit_hinge([split[k] for k in teach], ratio, y[teach])
    want = [bias + (w * ratio)[f].sum() / np.sqrt(len(f)) for f in split]
    assert margins([t for _, t in rows], model) == pytest.approx(want, abs=1e-4)
    assert np.mean(want[1::2]) > np.mean(want[::2])
