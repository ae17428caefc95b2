from __future__ import annotations

import math
import zlib

import numpy as np
from clearplate.llm import langid
from clearplate.llm.langid import LanguageModel, identify, keep_identified, score_texts, split_model, train


def test_held_out_accuracy(docs, doc_rows):
    model = split_model(docs)
    held = [r for r in doc_rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    names, scores = score_texts([r[1] for r in held], model)
    assert len(held) > 20 and np.mean([n == r[2] for n, r in zip(names, held)]) > 0.97
    assert all(0 <= s <= 1 for s in scores)


def test_same_as_naive_bayes_by_hand(monkeypatch):
    rng = np.random.default_rng(0)
    model = LanguageModel(["a", "b"], np.log([0.3, 0.7]), np.log(rng.dirichlet(np.ones(256), 2)).astype(np.float32))
    texts = ["Hello there", "x", "ab cd ef", "é" * 50]

    def by_hand(text):
        padded = f" {text.lower()}  "
        total = np.zeros(2)
        for i in range(len(padded) - 2):
            grams, _, _ = langid._buckets([padded[i : i + 3]], 8)
            total += sum(model.logp[:, g[0]].astype(float) for g in grams)
        n = 3 * (len(padded) - 2)
        logits = total / n * min(n, langid.EVIDENCE) + model.prior
        return logits.argmax(), 1 / np.exp(logits - logits.max()).sum()

    for piece in (1 << 18, 3):
        monkeypatch.setattr(langid, "PIECE", piece)
        names, scores = score_texts(texts, model)
        for t, n, s in zip(texts, names, scores):
            k, p = by_hand(t)
            assert n == model.languages[k] and math.isclose(s, p, rel_tol=1e-5)


def test_long_text_outweighs_the_prior():
    """A rare language with a small advantage per n-gram wins a long text; the score stays below one."""
    rng = np.random.default_rng(1)
    logp = np.tile(np.log(rng.dirichlet(np.ones(256))), (2, 1))
    logp[1] += 0.05
    model = LanguageModel(["hot", "rare"], np.log([0.999, 0.001]), logp.astype(np.float32))
    names, scores = score_texts(["some words " * 40, "so"], model)
    assert names == ["rare", "hot"] and 0.5 < scores[0] < 0.999


def test_close_languages_are_kept(spark):
    """Four languages that are nearly one: no score reaches a half, and no text with letters is lost."""
    logp = np.tile(np.log(np.full(256, 1 / 256)), (4, 1))
    logp[2] += 0.001
    model = LanguageModel(["a", "b", "c", "d"], np.log(np.full(4, 0.25)), logp.astype(np.float32))
    docs = spark.createDataFrame([(1, "clean words " * 200), (2, "123")], "doc_id long, text string")
    got = {r["doc"]["doc_id"]: r for r in identify(docs, model).collect()}
    assert got[1]["lang_pred"] == "c" and got[1]["score"] < 0.5
    assert [r["doc_id"] for r in keep_identified(docs, model).collect()] == [1]


def test_counts_of_training(spark):
    rows = [("ab", "x"), ("ab", "x"), ("zz", "y"), (None, "y"), ("cd", None)]
    model = train(spark.createDataFrame(rows, "text string, lang string"), bits=13)
    assert model.languages == ["x", "y"]
    assert np.allclose(np.exp(model.prior), [2 / 3, 1 / 3])
    assert np.allclose(np.exp(model.logp.astype(float)).sum(axis=1), 1, atol=1e-3)


def test_edge_rows(messy, nothing):
    model = train(messy)
    got = identify(messy, model).collect()
    by_id = {r["doc"]["doc_id"]: r for r in got}
    assert len(got) == 13
    for k in (2, 3, 4, 9):
        assert (by_id[k]["lang_pred"], by_id[k]["score"]) == ("und", 0.0)
    assert by_id[1]["lang_pred"] in ("en", "fr", "de")
    kept = keep_identified(messy, model, least=0.0)
    assert kept.columns == messy.columns and kept.count() == 9
    assert identify(nothing, model).count() == 0


def test_untrained(messy, nothing):
    assert {r["lang_pred"] for r in identify(messy, train(nothing)).collect()} == {"und"}
