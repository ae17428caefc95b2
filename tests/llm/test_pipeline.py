from __future__ import annotations

import re

import corpus_pipeline
import __spark_entry__ as entry_file
from clearplate.llm.mixing import mix
from clearplate.llm.registry import QUERIES
from clearplate.llm.simhash import fingerprint
from clearplate.session import written


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "mixing", "pieces"]


def test_each_stage_on_what_the_one_before_kept(spark, docs, sf_dir):
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], sf_dir), name))
        if name != "pieces":
            assert frames[-1].columns == docs.columns
    rows = [{r["doc_id"]: r for r in f.collect()} for f in frames]
    _, told, exact, near, mixed, cut = rows
    assert set(cut) == set(mixed) < set(near) <= set(exact) <= set(told) <= set(rows[0])
    # Each stage by brute force on its own input.
    assert set(told) == {k for k, r in rows[0].items() if re.search(r"[^\W\d_]", r["text"])}
    best = {}
    for k, r in told.items():
        t = re.sub(r"[\x20\x09-\x0d]", "", r["text"])
        best[t] = min(best.get(t, (1, 0)), (-len(r["text"]), k))
    assert set(exact) == {k for _, k in best.values()}
    fps = {k: fingerprint(r["text"]) for k, r in exact.items()}
    root = {k: k for k in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and root[b] < root[a]:
                    root[a], changed = root[b], True
    assert set(near) == set(root.values())
    assert set(mixed) == {r["doc_id"] for r in mix(frames[3]).filter("kept").collect()}
    assert all(r["lossless"] and len(r["ids"]) == r["n_pieces"] for r in cut.values())
    run = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert run == {k: r["ids"] for k, r in cut.items()}


def test_registered():
    names = entry_file.queries()
    assert len(QUERIES) == 13 and set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


MESSY = "doc_id long, text string, lang string, source string, n_chars int, key string, cell string, ids string, fp string, digest string, u string, doc string, prob string"


def through(spark, rows, schema=MESSY):
    """What each stage leaves of some rows."""
    frames = [written(spark.createDataFrame(rows, schema), "messy")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], ""), name))
    return frames


def test_messy_rows_through_all_stages(spark, monkeypatch):
    """Null ids, texts, languages and sources, repeated rows, ties, an empty and a very long text, and columns with clashing names."""
    monkeypatch.setattr(corpus_pipeline.mixing, "BUDGET", 1.0)
    extra = (7, "k", None, "i", "f", "d", "u", "x", None)
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [
        (1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"), (None, "one two three  four five six", None, None),
        (2, None, "en", "a"), (3, "", "en", None), (4, "123 !!", "en", "a"), (5, long, None, "b"), (6, long + " word", "en", "b"),
        (None, "quite another text without an id", "en", "a"), (None, "and a third one that has none either", "de", None), (7, "une phrase en français bien sûr", "fr", "c"),
    ]
    frames = through(spark, [(*r, *extra) for r in rows])
    texts = [sorted((r["doc_id"] or 0, r["text"] or "") for r in f.collect()) for f in frames]
    for f in frames[:5]:
        assert f.columns == frames[0].columns
    _, told, exact, near, mixed, cut = texts
    assert told == sorted((d or 0, t) for d, t, _, _ in rows if t and re.search("[a-z]", t))
    # The longest of equal texts stays, here the one with two blanks and no id; long texts that differ are no exact copies.
    assert len(exact) == len(told) - 2 and (0, "one two three  four five six") in exact
    by = {}
    for d, t in exact:
        by.setdefault(next((k for k in by if (fingerprint(k) ^ fingerprint(t)).bit_count() <= 3), t), []).append((d, t))
    assert len(near) == len(by) and set(near) <= set(exact)
    assert set(mixed) <= set(near) and cut == mixed
    assert frames[5].columns == [c for c in frames[0].columns if c != "ids"] + ["ids", "n_pieces", "lossless"]
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) > 0 for r in frames[5].collect())


def test_empty_table_through_all_stages(spark):
    assert [f.count() for f in through(spark, [])] == [0] * 6


def test_run_on_a_table_that_nothing_survives(spark, tmp_path):
    spark.createDataFrame([(1, None, "en", "a"), (2, "12 34", None, None)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
