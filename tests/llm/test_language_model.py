from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clearplate.llm.elias_fano import EliasFano, load, save
from clearplate.llm.language_model import DISCOUNT, END, _expand, _squeeze, op5_language_model, score, token_hashes, train
from clearplate.session import fresh_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), " "]


class Brute:
    """The same smoothing without quantising, in dictionaries."""

    def __init__(self, texts):
        self.one, pairs, triples = Counter(), Counter(), Counter()
        for t in texts:
            own = ["<s>", *tokens(t)]
            self.one.update(own[1:])
            pairs.update(zip(own, own[1:]))
            triples.update(zip(own, own[1:], own[2:]))
        self.N, self.V = sum(self.one.values()), len(self.one)
        self.pairs = {k: v for k, v in pairs.items() if v >= 2}
        self.triples = {k: v for k, v in triples.items() if v >= 2}
        self.total = {**self.one, "<s>": len(texts)}
        self.used, self.used2 = Counter(), Counter()
        for k, v in self.pairs.items():
            self.used[k[0]] += v - DISCOUNT
        for k, v in self.triples.items():
            self.used2[k[:2]] += v - DISCOUNT

    def p1(self, w):
        return (self.one[w] + 1) / (self.N + self.V + 1)

    def p2(self, a, b):
        if not self.total.get(a):
            return self.p1(b)
        return (self.pairs.get((a, b), DISCOUNT) - DISCOUNT) / self.total[a] + (1 - self.used[a] / self.total[a]) * self.p1(b)

    def p3(self, a, b, c):
        n = self.pairs.get((a, b))
        if not n:
            return self.p2(b, c)
        return (self.triples.get((a, b, c), DISCOUNT) - DISCOUNT) / n + max(1 - self.used2[a, b] / n, 1e-11) * self.p2(b, c)

    def score(self, text):
        own = ["<s>", *tokens(text)]
        return sum(math.log10(self.p2(*own[:2]) if k == 1 else self.p3(*own[k - 2 : k + 1])) for k in range(1, len(own)))


def check(got, texts, brute):
    for r, t in zip(got, texts):
        own = tokens(t)
        assert (r["n_tokens"], r["n_known"]) == (len(own), sum(w in brute.one for w in own))
        assert r["base_score"] == pytest.approx(sum(math.log10(brute.p1(w)) for w in own), rel=1e-9)
        assert abs(r["score"] - brute.score(t)) < 0.05 * len(own)


def test_tables_match_brute_force(spark, docs, doc_rows):
    learn = docs.filter("doc_id % 3 > 0")
    model = train(learn, fresh_path(spark, "trie"), size=2_000)
    brute = Brute([r[1] for r in doc_rows if r[0] % 3 > 0])
    assert (model.tokens, model.distinct) == (brute.N, brute.V)
    assert (sum(s.n for s in model.pairs), sum(s.n for s in model.triples)) == (len(brute.pairs), len(brute.triples))
    got = {r["doc"]["doc_id"]: r for r in score(docs, model).collect()}
    check([got[r[0]] for r in doc_rows], [r[1] for r in doc_rows], brute)
    mean = np.mean([(got[r[0]]["score"] - brute.score(r[1])) / got[r[0]]["n_tokens"] for r in doc_rows])
    assert abs(mean) < 0.01


def test_edge_rows(spark, messy, messy_rows, nothing):
    model = train(messy, fresh_path(spark, "trie"))
    rows = score(messy, model).collect()
    brute = Brute([r[1] for r in messy_rows])
    check(rows, [r["doc"]["text"] for r in rows], brute)
    assert score(nothing, model).count() == 0
    empty = train(nothing, fresh_path(spark, "trie"))
    assert {r["score"] for r in score(messy, empty).collect()} == {0.0}


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    counts = np.where(rng.random(len(keys)) < 0.1, rng.integers(200, 1 << 40, len(keys)), 1)
    a, b = _expand(_squeeze(keys, counts))
    assert (a == keys).all() and (b == counts).all()


@pytest.mark.parametrize("n,u", [(0, 10), (1, 0), (5, 5), (1000, 1 << 50), (50_000, 1 << 30), (50_000, 300)])
def test_elias_fano(tmp_path, n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u + 1, n))
    save(f"file://{tmp_path}/x", EliasFano.build(v, u, "s"))
    e = EliasFano(load(f"file://{tmp_path}/x"), "s")
    i = rng.integers(0, n, 500) if n else np.zeros(0, np.int64)
    assert (e.access(i) == v[i]).all()
    q = np.concatenate([rng.integers(0, u + 1, 500), v[i]])
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), n)
    assert (e.successor(q, lo, hi) == np.searchsorted(v, q)).all()
    assert ((e.find(q, lo, hi) >= 0) == np.isin(q, v)).all()
    if n:
        assert len(e.low) * 64 + len(e.high) * 64 < n * (e.width + 3) + 2048 + u / max(1, 1 << e.width)


def test_query_learns_ngrams_seen_once(spark, tmp_path):
    """A held-out text that repeats a phrase seen once scores above one of the same words in new order."""
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    learn = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 != 2][:3]
    rows = [*zip(learn, ("red fox jumps", "blue owl sleeps", "old dog barks")), (held[0], "red fox jumps"), (held[1], "red owl barks")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op5_language_model(spark, str(tmp_path)).collect()}
    known, new = got[held[0]], got[held[1]]
    assert known["held_out"] and new["held_out"] and known["base_score"] == pytest.approx(new["base_score"])
    assert known["score"] > new["score"] + 1


def test_words_are_hashed_at_once_and_apart():
    texts = ["", " \t", "a" * 63 + " " + "a" * 64 + " " + "a" * 65 + " " + "a" * 66, "A\tb\x0bB\x0c\ra\nab \x00 \x00\x00 \x1c \ud800 é É \x85", *(f"{'word' * (k % 7)}{k}" for k in range(3000))]
    for cut in (1, 7, len(texts)):
        hashes, sizes = zip(*(token_hashes(texts[k : k + cut]) for k in range(0, len(texts), cut)))
        assert np.concatenate(sizes).tolist() == [len(tokens(t)) for t in texts]
        words = [w for t in texts for w in tokens(t)]
        known = dict(zip(words, np.concatenate(hashes).tolist()))
        assert [known[w] for w in words] == np.concatenate(hashes).tolist() and len(set(known.values())) == len(known) and known[" "] == END
    assert token_hashes([])[0].size == 0


def test_query_cuts_texts_twice(spark, tmp_path):
    """Once to count the words and once to write their ids; n-grams and scores come from the ids."""
    spark.createDataFrame([(k, "red fox jumps") for k in range(20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op5_language_model(spark, str(tmp_path))
    assert "ids" in out._jdf.queryExecution().optimizedPlan().toString() and "text" not in out._jdf.queryExecution().optimizedPlan().toString()
