from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from clearplate.llm import simhash
from clearplate.llm.components import components
from clearplate.llm.simhash import anchors, fingerprint, forest, keep_one, links, near_duplicates


def brute_fingerprint(text):
    table = {**{c: c + 32 for c in range(65, 91)}, **{c: 32 for c in range(9, 14)}}
    words = (text or "").translate(table).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    """Smallest id reachable over links of three or fewer bits."""
    label = {k: i for k, (i, _) in enumerate(fps)}
    order = lambda x: (x is None, x or 0)
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a][1] ^ fps[b][1]).bit_count() <= 3 and order(label[b]) < order(label[a]):
                    label[a], changed = label[b], True
    return sorted(((fps[k][0], f"{fps[k][1]:016x}", label[k]) for k in label), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_edge_rows(messy, messy_rows):
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in messy_rows])
    assert got(near_duplicates(messy)) == want
    left = keep_one(messy)
    assert left.columns == messy.columns
    assert left.count() == len({w[2] for w in want})


def test_each_group_keeps_one_row(spark):
    rng = random.Random(7)
    one, two, three, four, five = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(80)) for _ in range(5))
    rows = [(None, one), (None, two), (None, two), (None, three), (1, four), (1, five), (2, five), (3, three)]
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])
    assert len({w[1] for w in want}) == 5
    left = [tuple(r) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(left, key=repr) == sorted([(None, one), (None, two), (3, three), (1, four), (1, five)], key=repr)


def test_empty_table(nothing):
    assert near_duplicates(nothing).count() == 0 and keep_one(nothing).count() == 0


def test_tables_match_brute_force(docs, doc_rows):
    assert got(near_duplicates(docs)) == brute_components([(r[0], brute_fingerprint(r[1])) for r in doc_rows])


def test_long_texts_in_steps(monkeypatch):
    rng = random.Random(1)
    text = " ".join(str(rng.randrange(50)) for _ in range(1000))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 64)
    assert fingerprint(text) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("block", [4, 2048])
def test_every_link_is_found(spark, block):
    rng = random.Random(2)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(12):
            x = base
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = components(links(frame, block=block))
    roots = {r["node"]: r["root"] for r in found.collect()}
    label = {k: k for k in range(len(fps))}
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a] ^ fps[b]).bit_count() <= 3 and signed[label[b]] < signed[label[a]]:
                    label[a], changed = label[b], True
    assert {signed[k]: signed[v] for k, v in label.items()} == {x: roots.get(x, x) for x in signed}


def test_anchors_are_code_words_within_two_bits(spark):
    rng = random.Random(3)
    fps = np.array([rng.getrandbits(64) for _ in range(50)], np.uint64).view(np.int64).tolist()
    rows = anchors(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    for r in rows:
        part = (r["fp"] >> (32 * r["part"])) & (2**31 - 1)
        syndrome = 0
        for i in range(1, 32):
            if r["anchor"] >> (i - 1) & 1:
                syndrome ^= i
        assert syndrome == 0 and (part ^ r["anchor"]).bit_count() <= (1 if r["home"] else 2)
    assert sum(r["home"] for r in rows) == 100


def test_forest_spans():
    fps = np.array([0, 1, 3, 7, 15, 31, 31 << 40], np.uint64)
    a, b = forest(fps)
    assert len(a) == 5


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, x) for x in range(1001, 1300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert {found[x] for x in range(201)} == {0} and {found[x] for x in range(1000, 1300)} == {1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
