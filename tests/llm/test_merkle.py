from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from clearplate.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """All levels, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([sha("".join(own[i : i + arity])) for i in range(0, len(own), arity)])
    return levels


def path(levels, i, arity):
    """(left, right) of a leaf, from the leaf up."""
    out = []
    for own in levels[:-1]:
        first = i // arity * arity
        out.append(("".join(own[first:i]), "".join(own[i + 1 : first + arity])))
        i //= arity
    return out


def brute(rows, arity=2):
    """The contract by its words, one language after the other."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    levels, ordered = {}, {}
    for lang in langs:
        ordered[lang] = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        levels[lang] = tree([leaf(r) for r in ordered[lang]], arity)
    top = tree([levels[x][-1][0] for x in langs], arity)
    root = top[-1][0]
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(ordered[lang]):
            proof = path(levels[lang], i, arity) + path(top, k, arity)
            own = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                own = leaf((*r[:3], r[3] + 1, r[4]))
            for a, b in proof:
                own = sha(a + own + b)
            out.append((r[0], leaf(r), levels[lang][-1][0], root, sha("".join(a + b for a, b in proof)), own, own == root))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_by_brute_force(spark, sf_dir, docs):
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    got = collected(merkle.op11_merkle(spark, sf_dir))
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 2), (3, 2), (5, 3)])
def test_other_shapes(spark, arity, levels):
    rows = [(i, "s", lang, i, f"text {i}") for lang, n in (("a", 1), ("b", 2), ("é", 27), (None, 9), ("z", 28)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(3)
    assert collected(merkle.audit(df, arity, levels)) == brute(rows, arity)


def test_edge_rows(spark, messy, nothing, messy_rows):
    """Null ids, languages, sources, sizes and texts; repeated rows; very long texts; other columns of any name."""
    for n_chars in (F.lit(None).cast("int"), F.length("text")):
        df = messy.withColumn("n_chars", n_chars).withColumn("tree", F.lit(1)).withColumn("rank", F.lit(1))
        rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
        assert collected(merkle.audit(df)) == brute(rows)
    assert merkle.audit(nothing.withColumn("n_chars", F.lit(1))).count() == 0


def test_one_document(spark):
    df = spark.createDataFrame([(7, "s", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars int, text string")
    (row,) = merkle.audit(df).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")
    assert row["verified"] == (zlib.crc32(b"7") % 7 != 0)


def test_many_equal_rows(spark):
    """A third of all rows are one row: equal digests, equal records, and each row has its proof."""
    rows = [(1, "s", "en", 3, "abc")] * 600 + [(i, "s", "en", 3, "abc") for i in range(2, 1202)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(5)
    assert collected(merkle.audit(df)) == brute(rows)


def test_records_prove_some_leaves(spark, docs):
    """A few requests: proofs come from records alone, no others are visited, unknown places give no row."""
    manifest = merkle.build(merkle.document_leaves(docs), "doc_id", levels=3)
    records = {r["digest"]: r["children"] for r in manifest.records().collect()}
    assert all(sha("".join(kids)) == digest for digest, kids in records.items())
    leaves = manifest.leaves.collect()
    some = [(r["tree"], r["rank"], (r["leaf"],)) for r in leaves if r["rank"] in (0, 5, 20)]
    requests = spark.createDataFrame([*some, ("=no such", 0, ("x",)), (leaves[0]["tree"], 10**6, ("x",))], "tree string, rank long, asked struct<leaf: string>")
    got = merkle.prove(manifest, requests).collect()
    root = manifest.root().first()["root"]
    assert len(got) == len(some)
    for r in got:
        assert r["leaf"] == r["asked"]["leaf"] and r["root"] == root
        own = r["leaf"]
        for s in r["proof"]:
            own = sha(s["left"] + own + s["right"])
            assert own in records
        assert own == root


def test_rank_follows_order(spark):
    df = spark.range(5_000).select((F.col("id") % 3).cast("string").alias("tree"), F.hash("id").alias("x"))
    got = merkle.ranked(df, "tree", "x").collect()
    for t in "012":
        own = sorted((r["rank"], r["x"], r["n"]) for r in got if r["tree"] == t)
        assert [r[0] for r in own] == list(range(len(own))) and [r[1] for r in own] == sorted(r[1] for r in own) and {r[2] for r in own} == {len(own)}


def test_pages_are_bounded():
    with pytest.raises(ValueError):
        merkle.grow(None, arity=2, levels=17)
