from __future__ import annotations

import functools
import hashlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearplate.llm import token_alignment as ta

ODD = [
    "a  b\n\n c\t\td <|endoftext|>x </s><s> <unk> <0x41>",
    "\x85\x1c a\x1cb\xa0 c​d \0 　漢字 😀😀👩‍👩‍👧  ",
    " \n ",
    "don't they're",
    "has ▁ in it",
    "x" * 5_000 + " " * 300 + "ab" * 999,
    "é é",
    "a\u2003\u2003 b\u3000\u3000c \u1680\u1680d\xa0\n\ne\u2028\u2029 f",
]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(ta.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.PIECE_VOCABULARY)
    return a, b, ta._byte_symbols()


def ranges(sides, text):
    """Ids with the byte range of each token, by the libraries; none where a side does not spell the text."""
    a, b, symbols = sides
    if not text:
        return [], []
    out = []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelt_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
    spelt_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    for ids, spelt in ((ids_a, spelt_a), (ids_b, spelt_b)):
        if b"".join(spelt) != (" " + text).encode():
            return [], []
        at, own = 0, []
        for i, s in zip(ids, spelt):
            own.append((i, at, at + len(s)))
            at += len(s)
        out.append(own)
    return out


def brute(sides, rows):
    """The contract by its words: every pair of occurrences is compared."""
    per, count = [], Counter()
    for doc_id, text in rows:
        a, b = ranges(sides, text or "")
        common = {e for _, _, e in a} & {e for _, _, e in b}
        groups, links = [], []
        if a:
            bounds = [0, *sorted(common)]
            side = [[], []]
            for k, tokens in enumerate((a, b)):
                own = defaultdict(list)
                g = 0
                for i, s, e in tokens:
                    while s >= bounds[g + 1]:
                        g += 1
                    own[g].append(i)
                side[k] = own
            groups = [",".join(map(str, side[0][g])) + "|" + ",".join(map(str, side[1][g])) for g in range(len(bounds) - 1)]
        j = 0
        for i, s, e in a:
            while j and b[j][1] > s:
                j -= 1
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        count.update(set(links))
        per.append((doc_id, len(a), len(b), groups, links))
    most = {}
    for (i, _), n in count.items():
        most[i] = max(most.get(i, 0), n)
    return sorted(
        (
            (d, na, nb, len(g), len(x), sum(count[p] == most[p[0]] for p in x), sum(count[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
            for d, na, nb, g, x in per
        ),
        key=repr,
    )


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_by_brute_force(spark, sf_dir, doc_rows, sides):
    assert collected(ta.op12_token_alignment(spark, sf_dir)) == brute(sides, [(d, t) for d, t, _, _ in doc_rows])


def test_small_blocks_and_odd_texts(spark, sides):
    rows = list(enumerate([*ODD, *ODD[:2], "plain words here", None, ""]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (1, 100, 1 << 20):
        assert collected(ta.link_totals(df, ta.load_vocabularies(), block_bytes=size)) == brute(sides, rows)


def test_unspellable_text_has_no_tokens(sides):
    assert ranges(sides, "has ▁ in it") == ([], []) or ranges(sides, "has ▁ in it")[0]
    x = ta.Aligner(ta.load_vocabularies()).align(["fine", "has ▁ in it", "", "fine"])
    sizes = [len(ranges(sides, t)[0]) for t in ("fine", "has ▁ in it", "", "fine")]
    assert (x.cut_a[1:] - x.cut_a[:-1]).tolist() == sizes


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.sets(st.integers(0, 59)), st.sets(st.integers(0, 200)))
def test_gallop_against_all_pairs(widths, joined, split):
    a, at = [], 0
    for k, w in enumerate(widths):
        at += w
        if k not in joined or k == len(widths) - 1:
            a.append(at)
    every = sorted({e for k, e in enumerate(range(1, at + 1)) if k not in split} | {at})
    for b in (a, every):
        stretches, odd = ta.gallop(array("q", a), array("q", b))
        left, right = ta.overlaps(np.array(a), np.array(b), np.array(odd, np.int64).reshape(-1, 4))
        groups = sorted([(i + k, i + k + 1, j + k, j + k + 1) for i, j, n in stretches for k in range(n)] + odd)
        assert [a[g[1] - 1] for g in groups] == sorted(set(a) & set(b)) == [b[g[3] - 1] for g in groups]
        links = sorted([(i + k, j + k) for i, j, n in stretches for k in range(n)] + list(zip(left.tolist(), right.tolist())))
        starts_a, starts_b = [0, *a], [0, *b]
        assert links == [(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts_a[i], starts_b[j]) < min(a[i], b[j])]


def test_stretches_are_as_long_as_can_be():
    same = array("q", range(1, 10_001))
    assert ta.gallop(same, same)[0] == [(0, 0, 10_000)]
    b = array("q", [x for x in range(1, 10_001) if x != 5_000])
    stretches, odd = ta.gallop(same, b)
    assert stretches == [(0, 0, 4_999), (5_001, 5_000, 4_999)] and odd == [(4_999, 5_001, 4_999, 5_000)]


def test_edge_rows(spark, messy, nothing, messy_rows, sides):
    model = ta.load_vocabularies()
    assert collected(ta.link_totals(messy, model)) == brute(sides, [(r[0], r[1]) for r in messy_rows])
    assert ta.link_totals(nothing, model).count() == 0 and ta.align(nothing, model).count() == 0
    out = ta.align(messy, model)
    assert out.select("doc.*").columns == messy.columns
    for r in out.collect():
        a, b = ranges(sides, r["doc"]["text"] or "")
        assert r["ids_a"] == [x[0] for x in a] and r["ids_b"] == [x[0] for x in b]
        assert [a[e - 1][2] for e in r["ends_a"]] == [b[e - 1][2] for e in r["ends_b"]] == sorted({x[2] for x in a} & {x[2] for x in b})


def test_full_caches_are_emptied(sides, monkeypatch):
    monkeypatch.setattr(ta, "MAX_UNITS", 2)
    own = ta.Aligner(ta.load_vocabularies())
    for text in ["one two three four", "five\n six seven  eight", "one"]:
        a, b = own.ids([text])
        assert list(array("i", a[0])) == [x[0] for x in ranges(sides, text)[0]] and list(array("i", b[0])) == [x[0] for x in ranges(sides, text)[1]]


def test_words_encoded_apart_are_the_whole_text(sides, doc_rows):
    """Ids put together from remembered words are those of both libraries on the whole text."""
    texts = [t for _, t, _, _ in doc_rows if t] + ODD
    own = ta.Aligner(ta.load_vocabularies())
    for text, a, b in zip(texts, *own.ids(texts)):
        want = ranges(sides, text)
        assert (list(array("i", a)), list(array("i", b))) == tuple([x[0] for x in side] for side in want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abeisntABÀßéñ'12.,!?_-$«»½²"), min_size=1, max_size=12), min_size=1, max_size=8))
def test_quick_encoder_is_the_library(words):
    own = byte_encoder()
    assert own.quick is not None
    texts = [" " + w for w in words]
    assert own.each(texts) == own._each(texts)


@functools.cache
def byte_encoder():
    return ta.ByteEncoder(ta.load_vocabularies().byte_text)


def test_new_words_are_encoded_in_one_call():
    """Costs of the 30 GB projection: no call for every word, and none for a word met before."""
    own = ta.Aligner(ta.load_vocabularies())
    quick, calls = own.a.quick, []
    own.a.quick = lambda text: calls.append(text) or quick(text)
    texts = [" ".join(f"w{k}é" for k in range(s, s + 500)) for s in range(0, 2_000, 500)]
    first = own.ids(texts)
    assert len(calls) == 1
    assert own.ids(texts) == first and len(calls) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abeisntABÀß'12.,!?_-$«½\n\x1c\xa0漢ж😀▁"), min_size=1, max_size=12).map(lambda w: f"x{w}y"), max_size=8, unique=True))
def test_words_encoded_together_are_those_encoded_apart(words):
    own = aligner()
    for side, apart in ((own.a, [own.a._each([" " + w])[0] for w in words]), (own.b, own.b.each(words))):
        ids, sizes = side.words(words)
        assert ids.tobytes() == b"".join(apart) and sizes.tolist() == [len(x) // 4 for x in apart]


def test_words_of_all_kinds_move_up(sides, monkeypatch):
    """Words kept, not spelt and next to white space, Latin and other, in batches that push each other out."""
    monkeypatch.setattr(ta, "MAX_UNITS", 8)
    own = ta.Aligner(ta.load_vocabularies())
    batches = [["one two", "has ▁ it", "two  three", ""], ["жук one 漢字", "", "has two"], [*ODD, "one"], ["▁ one", "жук  two", "three"], [""], ["one two", "has ▁ it"]]
    for texts in batches * 2:
        for text, a, b in zip(texts, *own.ids(texts), strict=True):
            want = ranges(sides, text)
            assert (list(array("i", a)), list(array("i", b))) == tuple([x[0] for x in side] for side in want)


def test_long_words_are_not_all_remembered(sides, monkeypatch):
    monkeypatch.setattr(ta, "MAX_IDS", 300)
    own = ta.Aligner(ta.load_vocabularies())
    for k in range(9):
        text = f"{k}漢字" * 100 + f" {k}ab" * 50
        a, b = own.ids([text])
        assert (list(array("i", a[0])), list(array("i", b[0]))) == tuple([x[0] for x in side] for side in ranges(sides, text))
        assert all(len(x[0]) <= 300 + max(len(a[0]), len(b[0])) // 4 for x in own.words.sides)


@functools.cache
def aligner():
    return ta.Aligner(ta.load_vocabularies())


def test_a_task_holds_few_blocks_however_many_there_are(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words of text number {i}") for i in range(120)], "doc_id long, text string").coalesce(1)
    vocabularies, plain, blocks = ta.load_vocabularies(), ta.written, []
    want = sorted(map(tuple, ta.link_totals(docs, vocabularies).collect()))
    monkeypatch.setattr(ta, "written", lambda *a: blocks.append(plain(*a)) or blocks[-1])
    changed = {"spark.sql.shuffle.partitions": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    kept = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        found = ta.link_totals(docs, vocabularies, block_bytes=1)
        assert sorted(map(tuple, found.collect())) == want
        assert found.rdd.getNumPartitions() >= 120
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    in_files = blocks[0].groupBy(F.input_file_name()).count().agg(F.sum("count"), F.max("count")).first()
    assert in_files[0] == 120 and in_files[1] <= ta.BLOCKS_HELD
