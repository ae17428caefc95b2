from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clearplate.llm import quality_rules as Q
from clearplate.llm.quality_rules import STATS, judge, statistics


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check_base(rows, got):
    want = sorted(((r[0], *brute_base(r[1])) for r in rows), key=repr)
    assert sorted((tuple(r) for r in got.select("doc_id", *COLUMNS).collect()), key=repr) == want


def test_base_matches_brute_force(docs, doc_rows):
    check_base(doc_rows, statistics(docs))


def test_edge_rows(messy, messy_rows, nothing):
    got = judge(messy)
    check_base(messy_rows, got)
    assert got.filter("kept").count() == 0
    assert judge(nothing).count() == 0


def test_a_table_of_three_rows_is_judged(spark):
    rows = [(k, " ".join(f"w{k}x{i}" + "#" * k for i in range(60 + 50 * k)), None, "a") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in judge(df).collect()}
    stats = {r["doc_id"]: [r[x] for x in STATS] for r in statistics(df).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert np.allclose([got[k]["distance"] for k in range(3)], brute_estimate(np.array([stats[k] for k in range(3)], float)), rtol=1e-6)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 200])
def test_repeats(spark, n):
    rng = random.Random(n)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(n))) for k in range(20)]
    df = spark.createDataFrame([(k, t, None, None) for k, t in rows], "doc_id long, text string, lang string, source string")
    check_base(rows, statistics(df))


def brute_estimate(x):
    """The same concentration steps in numpy."""
    floors = np.array(Q.FLOORS, float)
    d = lambda m, c: (np.linalg.solve(np.linalg.cholesky(c), (x - m).T) ** 2).sum(axis=0)
    bin_of = lambda v: np.floor(np.log(v + 1e-9) * Q.BINS_PER_E)
    quartile = lambda q: np.sort(x, axis=0)[int(np.ceil(q * len(x))) - 1]
    cov = lambda y: np.cov(y.T, bias=True) + np.diag(floors**2)
    starts = {"robust": (quartile(0.5), np.diag(np.maximum((quartile(0.75) - quartile(0.25)) / 1.349, floors) ** 2)), "all": (x.mean(axis=0), cov(x))}
    out = []
    for name, (m, c) in starts.items():
        for _ in range(Q.STEPS):
            b = bin_of(d(m, c))
            order = np.sort(b)
            upto = {v: (b < v).sum() for v in set(order)}
            near = np.array([upto[v] < Q.KEEP_SHARE * len(x) for v in b])
            m, c = x[near].mean(axis=0), cov(x[near])
        mid = np.sort(bin_of(d(m, c)))[int(np.ceil(0.5 * len(x))) - 1]
        scale = max(1.0, np.exp((mid + 0.5) / Q.BINS_PER_E) / Q.CHI2_MEDIAN)
        out.append((round(np.log(np.diag(np.linalg.cholesky(c))).sum(), 6), name != "robust", d(m, c) / scale))
    return min(out, key=lambda o: o[:2])[2]


def test_distances_match_numpy(spark):
    rng = np.random.default_rng(4)
    rows = []
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    for k in range(330):
        n = int(rng.integers(60, 400))
        text = [words[i] + str(rng.integers(1000)) for i in rng.integers(0, len(words), n)]
        if k % 11 == 0:
            text = [w + "###" for w in text]
        rows.append((k, " ".join(text), "en" if k % 3 else None, "a" if k % 2 else "b"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in judge(df, least=100).collect()}
    stats = {r["doc_id"]: [r[x] for x in STATS] for r in statistics(df).collect()}
    # (en, a) and (en, b) have over 100 rows each; the two groups without a language are pooled.
    for group in (lambda r: r[2] and r[3] == "a", lambda r: r[2] and r[3] == "b", lambda r: r[2] is None):
        ids = [r[0] for r in rows if group(r)]
        want = brute_estimate(np.array([stats[i] for i in ids], float))
        assert np.allclose([got[i]["distance"] for i in ids], want, rtol=1e-6)
    for k in got:
        assert got[k]["kept"] == (k % 11 != 0)


def test_small_groups_are_judged_by_the_whole_table(spark):
    """Twenty rows of two rare languages, three of them junk: each has the distance of the estimate over all rows."""
    rng = random.Random(21)
    rows = [(k, " ".join(plain(rng, rng.randrange(60, 400))), "en", "a") for k in range(300)]
    rows += [(300 + k, " ".join(w + "###" * (k % 7 == 0) for w in plain(rng, 150)), "xx" if k % 2 else None, "b") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in judge(df, least=100).collect()}
    stats = {r["doc_id"]: [r[x] for x in STATS] for r in statistics(df).collect()}
    whole = brute_estimate(np.array([stats[r[0]] for r in rows], float))
    assert np.allclose([got[300 + k]["distance"] for k in range(20)], whole[300:], rtol=1e-6)
    own = brute_estimate(np.array([stats[k] for k in range(300)], float))
    assert np.allclose([got[k]["distance"] for k in range(300)], own, rtol=1e-6)
    assert [got[300 + k]["kept"] for k in range(20)] == [k % 7 != 0 for k in range(20)]


def plain(rng, n):
    """Distinct words of one to nine letters."""
    return [rng.choice("abcdefgh") * rng.randrange(1, 8) + str(rng.randrange(100)) for _ in range(n)]


def judged(spark, texts):
    df = spark.createDataFrame([(k, t, "en", "a") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    return {r["doc_id"]: r for r in judge(df).collect()}


@pytest.mark.parametrize("share", [0.34, 0.45])
def test_a_block_of_identical_junk_is_rejected(spark, share):
    rng = random.Random(11)
    n = 400
    junk = " ".join(w + "###" for w in plain(rng, 150))
    texts = [junk if k < share * n else " ".join(plain(rng, rng.randrange(60, 400))) for k in range(n)]
    got = judged(spark, texts)
    assert not any(r["base_failed"] for r in got.values())
    assert not any(got[k]["kept"] for k in range(n) if k < share * n)
    assert sum(got[k]["kept"] for k in range(n) if k >= share * n) >= 0.99 * (1 - share) * n


def test_each_kind_of_junk_is_rejected(spark):
    rng = random.Random(12)
    texts = [" ".join(plain(rng, rng.randrange(60, 400))) for _ in range(300)]
    spaced = " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200))
    symbols = " ".join(w + "#" * (k % 2) for k, w in enumerate(plain(rng, 200)))
    fresh = [f"w{k}x" for k in range(108)]
    repeated = " ".join(" ".join(fresh[k : k + 4]) + " one two three" for k in range(0, 108, 4))
    got = judged(spark, [*texts, spaced, symbols, repeated])
    assert not any(got[k]["base_failed"] for k in (300, 301, 302))
    assert [got[k]["kept"] for k in (300, 301, 302)] == [False] * 3
    assert sum(got[k]["kept"] for k in range(300)) >= 297


def test_plan_is_native(docs):
    plan = judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_clean_documents_stay(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = judge(table).filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg({"kept": "count", "doc_id": "count"}).collect()
    kept = judge(table).filter("not base_failed and kept").join(labels, "doc_id").groupBy("quality").count().collect()
    share = {r["quality"]: r["count"] for r in kept}
    size = {r["quality"]: r["count(doc_id)"] for r in got}
    assert share[1] >= 0.99 * size[1] and share.get(0, 0) < 0.8 * size[0]
