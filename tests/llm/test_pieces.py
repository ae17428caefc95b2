from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from clearplate.llm.pieces import MODEL_PATH, PieceCodec, decode, encode, load_model


@pytest.fixture(scope="module")
def model():
    return load_model()


def test_round_trip_and_edges(messy, messy_rows, nothing, model):
    rows = encode(messy, model)
    got = rows.collect()
    assert len(got) == 13 and all(r["lossless"] for r in got)
    by_id = {r["doc"]["doc_id"]: r for r in got}
    assert by_id[2]["ids"] == [] == by_id[3]["ids"]
    flat = rows.select("doc.doc_id", "ids")
    back = decode(flat, model).select("doc.doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((r[0] or 0, r[1] or "") for r in messy_rows)
    assert encode(nothing, model).count() == 0


def test_library_reads_the_same_text(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    text = "Of the thing, und für die élève.\nNew  line 漢 \U0001F600"
    _, ids = PieceCodec(model).encode([text], ["k"])
    assert sp.decode(ids.tolist()) == text


def test_same_cut_in_any_batch(model):
    texts, keys = ["a thing of beauty"] * 3 + ["another text, longer than that"], ["1", "2", "1", "4"]
    offsets, ids = PieceCodec(model).encode(texts, keys)
    cuts = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert cuts[0] == cuts[2]
    for t, k, c in zip(texts, keys, cuts):
        assert PieceCodec(model).encode([t], [k])[1].tolist() == c


def test_draws_follow_the_lattice(model):
    """Frequencies of all cuts of a word against their weights by enumeration."""
    codec = PieceCodec(model)
    pieces = {b.decode(): (i, codec.log_p[i]) for i, b in enumerate(codec.bytes_of) if codec.length[i]}
    word = " thing"

    def cuts(at):
        if at == len(word):
            yield (), 0.0
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in pieces:
                i, p = pieces[word[at:end]]
                for rest, q in cuts(end):
                    yield (i, *rest), p + q

    weights = {c: math.exp(p) for c, p in cuts(0)}
    total = sum(weights.values())
    n = 20_000
    offsets, ids = codec.encode(["thing"] * n, [str(k) for k in range(n)])
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:]))
    assert set(seen) <= set(weights)
    for c, w in weights.items():
        p = w / total
        assert abs(seen[c] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_sampling_options(model):
    sharp = PieceCodec(type(model)(model.proto, alpha=6.0))
    flat = PieceCodec(type(model)(model.proto, alpha=0.01))
    text = ["the thing that was said of the other thing"] * 50
    keys = [str(k) for k in range(50)]
    assert len(sharp.encode(text, keys)[1]) < len(flat.encode(text, keys)[1])
    other = PieceCodec(type(model)(model.proto, seed=99))
    assert not np.array_equal(other.encode(text, keys)[1], PieceCodec(model).encode(text, keys)[1])
