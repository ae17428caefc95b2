from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clearplate.llm import word_bpe

ODD = [
    "a  b <|endoftext|>x<|startoftext|><|endoftext|> <|EndOfText|>",
    "I'LL don't they're WE'VE 'tis 12 3.4 !!??",
    "ΣΑΣ Σ ẞ İ é é ́ Å",
    "aaaaaaa aaaaaa " + "ab" * 999 + " " + "x" * 20_000,
    "\x85\x1c a\x1cb\xa0 c​d \0",
    "　漢字 😀😀👩‍👩‍👧",
    " \t\n",
    "",
]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(word_bpe.VOCABULARY)
    tok.no_truncation()
    tok.no_padding()
    return tok


@pytest.fixture(scope="module")
def codec():
    return word_bpe.BpeCodec(word_bpe.load_model())


def want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_same_ids_and_text_as_the_library(codec, library, doc_rows):
    texts = [t or "" for _, t, _, _ in doc_rows] + ODD
    coded = codec.encode([t.encode() for t in texts])
    for text, own in zip(texts, coded):
        ids = np.frombuffer(own, "<u4").tolist()
        assert (ids, codec.decode(ids)) == want(library, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aabtheinsr'1!É ß\n"), max_size=30), min_size=1, max_size=5))
def test_words_of_a_run_do_not_touch(codec, library, texts):
    fresh = codec.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in fresh] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_merges_by_plain_greedy_rule(codec):
    """The index gives each word what merging its lowest-ranked pair, left first, again and again gives."""

    def greedy(word):
        own = [codec.inner[c] for c in word[:-1]] + [codec.final[word[-1]]]
        while True:
            found = min(((codec.rank[a << 32 | b], i) for i, (a, b) in enumerate(zip(own, own[1:])) if a << 32 | b in codec.rank), default=None)
            if found is None:
                return own
            own[found[1] : found[1] + 2] = [codec.merged[found[0]]]

    words = ["banana", "aaaaaaaa", "ababababab", "mississippi", "thethethe", "a", "zzzzz", "ininining"]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.merge(words)] == [greedy(w) for w in words]


def test_full_caches_are_emptied(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "MAX_CHUNKS", 2)
    small = word_bpe.BpeCodec(word_bpe.load_model())
    for text in ["one two three four", "five six", "one <|endoftext|> two"]:
        assert np.frombuffer(small.encode([text.encode()])[0], "<u4").tolist() == want(library, text)[0]


def test_edge_rows(spark, messy, nothing, library):
    model = word_bpe.load_model()
    out = word_bpe.encode(messy, model, decoded=True)
    assert out.select("doc.*").columns == messy.columns
    got = out.collect()
    assert len(got) == messy.count()
    for r in got:
        assert (r["ids"], r["decoded"]) == want(library, r["doc"]["text"] or "") and r["n_tokens"] == len(r["ids"])
    back = word_bpe.decode(out.select("doc.doc_id", "ids", "decoded"), model)
    assert back.filter("doc.decoded <> text or text is null").count() == 0
    assert word_bpe.encode(nothing, model).count() == 0 and word_bpe.decode(out.select("ids").limit(0), model).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert sorted((r["text"] for r in word_bpe.decode(nulls, model).collect()), key=repr) == ["", None]


def test_query_by_brute_force(spark, sf_dir, doc_rows, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in word_bpe.op13_word_bpe(spark, sf_dir).collect()}
    assert len(got) == len(doc_rows)
    for doc_id, text, _, _ in doc_rows:
        ids, plain = want(library, text or "")
        assert got[doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest())


def test_other_vocabularies_are_refused():
    spec = json.loads(word_bpe.load_model().text)
    spec["model"]["dropout"] = 0.1
    with pytest.raises(ValueError):
        word_bpe.BpeCodec(word_bpe.BpeModel(json.dumps(spec)))
