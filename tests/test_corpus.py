from __future__ import annotations

import math

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from clearplate.operators import corpus as C
from clearplate.operators import retrieval as R
from clearplate.session import dir_tag


def pages(spark, *texts):
    return spark.createDataFrame([("d", i + 1, t) for i, t in enumerate(texts)], "doc_id string, page_number int, page_text string")


@pytest.mark.parametrize("n, want", [
    (0, []), (49, []), (50, [50]), (720, [720]), (769, [769]), (770, [770, 50]), (800, [800, 80]), (801, [800, 81]), (1440, [800, 720]), (1500, [800, 780, 60]),
])
def test_chunk_windows(spark, n, want):
    text = " \n".join(f"w{i}" for i in range(n))
    got = C.chunk_words(pages(spark, text)).orderBy("chunk_index").collect()
    assert [r.word_count for r in got] == want
    assert [r.chunk_index for r in got] == list(range(len(want)))
    if got:
        # Each window starts 720 words after the one before, so the words can be put together again.
        whole = [w for r in got for w in r.chunk_text.split()[:720]] + got[-1].chunk_text.split()[720:]
        assert whole[:n] == [f"w{i}" for i in range(n)][: len(whole)]


def test_chunk_plan_has_no_python_and_one_split(spark):
    plan = C.chunk_words(spark.range(1).select(F.col("id").cast("string").alias("page_text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("split(") == 1


def test_chunk_ids_are_stable(spark):
    df = pages(spark, " ".join(["a"] * 900)).withColumns({"source_url": F.lit("u"), "doc_type": F.lit("t"), "doc_label": F.lit("l")})
    first, second = (rows(C.chunk_rows(df), "doc_id", "chunk_index") for _ in range(2))
    assert first == second and len({i for i, _ in first}) == 2


def test_page_text(spark):
    html = "<html><head><style>p{}</style><SCRIPT>x<y</SCRIPT></head><body><!-- no --><h1>A&amp;B</h1><p>one<br>two &lt;3</p></body>"
    df = spark.createDataFrame([(1, html), (2, "<p> </p>"), (3, None)], "id int, html string")
    assert rows(C.page_text(df), "id", "page_text") == [(1, "A&B\none\ntwo <3")]


def test_context(spark):
    df = pages(
        spark, "Food Source\nbefore any appendix", "plain", "APPENDIX 23-A\nsomething\nInspection Worksheet", "  ", "Other Criticals", "plain",
        "appendix 23-C\nPENALTY SCHEDULE General Violations", "APPENDIX 23-C PENALTY SCHEDULE and UNSCORED VIOLATIONS", "plain",
    )
    got = {r.page_number: (r.appendix, r.section) for r in C.forward_fill_context(df).collect()}
    assert got == {
        1: (None, "Food Source"), 2: (None, "Food Source"), 3: ("23-A", None), 5: ("23-A", "Other Criticals"), 6: ("23-A", "Other Criticals"),
        7: ("23-C-scored", "General Violations"), 8: ("23-C-unscored", None), 9: ("23-C-unscored", None),
    }
    prefix = C.forward_fill_context(df).select("page_number", C.context_prefix(F.col("appendix"), F.col("section")).alias("p"))
    texts = {r.page_number: r.p for r in prefix.collect()}
    assert texts[1] == "Section: Food Source." and texts[5].endswith("point scores. Section: Other Criticals.") and texts[8] == C.CONTEXT["23-C-unscored"]


@pytest.mark.parametrize("text, want", [
    ("- - - - 28", {"V": 28}), ("7 8 9 10 28", {"I": 7, "II": 8, "III": 9, "IV": 10, "V": 28}), ("1 2 3 4 5 6", {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}),
    ("– — 9", {"III": 9}), ("x 5", {"II": 5}), ("", {}), (None, {}),
])
def test_scores(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.parse_scores(F.col("t"))).first()[0] == want


def test_codes(spark):
    df = spark.createDataFrame([("04L* then 10F+, 04L* 2B and 04L x123A 9Cx",)], "t string")
    assert df.select(C.page_codes(F.col("t"))).first()[0] == ["04L", "10F", "2B"]
    many = " ".join(f"{i:02d}A" for i in range(20))
    df = spark.createDataFrame([(many,)], "t string")
    assert len(df.select(C.page_codes(F.col("t"))).first()[0]) == 15 and len(df.select(C.all_codes(F.col("t"))).first()[0]) == 20


def test_narration(spark):
    df = spark.createDataFrame([
        (1, "worksheet", ["04L* Evidence\nof mice", "", "7 8 - 10 28"]), (2, "worksheet", ["04M+ Roaches", None, "n/a"]), (3, "worksheet", ["no code", "7"]),
        (4, "guide", ["02B", "Hot food not held\nat 140", "one item", "—", None, "", "ten items"]), (5, "guide", ["02B", "short"]), (6, "guide", ["02B", "x", "y"]),
        (7, "penalty", ["02B", "§81.09", "Critical", "Hot food item not held hot", "$200", "-", "$400"]), (8, "penalty", ["2B", "§81.09", "c", "Hot food item not held hot enough by far"]), (9, None, ["04L x"]),
    ], "id int, layout string, cells array<string>")
    assert rows(C.narrate_rows(df), "id", "prose") == [
        (1, "Violation 04L* (Critical/Public Health Hazard) : Evidence of mice  Point scores: Condition I = 7 points, Condition II = 8 points, Condition IV = 10 points, Condition V = 28 points."),
        (2, "Violation 04M+ (Pre-permit Serious) : Roaches  (Scored only at highest condition levels.)"),
        (4, "Violation 02B: Hot food not held at 140 Condition I: one item Condition V: ten items"),
        (7, "Violation 02B (§81.09): Hot food item not held hot. Category: Critical. Penalties: $200, $400."),
    ]


def test_assembled_pages(spark):
    df = C.forward_fill_context(pages(spark, "APPENDIX 23-A INSPECTION WORKSHEET 04L", "prose 04L only", "table nobody can read"))
    table = spark.createDataFrame([("d", 1, 2, ["04M x", "5"]), ("d", 1, 1, ["04L* y", "7"]), ("d", 3, 1, ["?"])], "doc_id string, page_number int, position int, cells array<string>")
    got = {r.page_number: r.page_text for r in C.assemble_pages(df, table).collect()}
    parts = got[1].split("\n\n")
    assert parts[0] == C.CONTEXT["23-A"] and parts[1] == "Violation codes on this page: 04L." and parts[2].startswith("Violation 04L*") and parts[3].startswith("Violation 04M")
    assert got[2] == "prose 04L only"
    assert got[3] == "table nobody can read"


# -- retrieval -------------------------------------------------------------------


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, "mice " * (i % 3) + ("rare" if i == 7 else "common"), "en" if i % 2 else "de", [float(i % 5), 1.0, float(i % 7)]) for i in range(60)]
    return spark.createDataFrame(data, "doc_id long, chunk_text string, doc_type string, embedding array<float>").cache()


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "Mice!", [1.0, 1.0, 0.0]), (2, "rare mice", [0.0, 1.0, 3.0]), (3, "unknown words", [0.0, 0.0, 1.0]), (4, "", None)], "query_id long, query_text string, embedding array<float>").cache()


def test_keyword(docs, queries):
    found = R.keyword_search(queries, R.build_index(docs), 3).collect()
    by_query = {q: [r.doc_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] for q in (1, 2, 3, 4)}
    assert by_query[2][0] == 7
    assert by_query[1] == [2, 5, 8]  # equal scores go by id
    assert by_query[3] == [] and by_query[4] == []


def test_filters(docs, queries):
    one = docs.filter(R.attribute_filter({"@eq": {"doc_type": "en"}}))
    both = docs.filter(R.attribute_filter({"@or": [{"@eq": {"doc_type": "en"}}, {"@eq": {"doc_type": "de"}}]}))
    none = docs.filter(R.attribute_filter({"@and": [{"@eq": {"doc_type": "en"}}, {"@eq": {"doc_type": "de"}}]}))
    assert (one.count(), both.count(), none.count()) == (30, 60, 0)
    assert R.keyword_search(queries, R.build_index(none)).count() == 0
    with pytest.raises(ValueError):
        R.attribute_filter({"@not": {}})


def brute_vectors(docs, queries, k):
    d = [(r.doc_id, np.array(r.embedding, dtype=float)) for r in docs.collect()]
    out = []
    for q in queries.collect():
        if q.embedding is None:
            continue
        v = np.array(q.embedding, dtype=float)
        s = sorted(((round(float(v @ e / np.linalg.norm(v) / np.linalg.norm(e)), 4), i) for i, e in d), key=lambda t: (-t[0], t[1]))
        out += [(q.query_id, i, sc, n + 1) for n, (sc, i) in enumerate(s[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", [{}, {"max_broadcast": 2, "cell_rows": 7}, {"max_broadcast": 1, "cell_rows": 1000}])
def test_vectors(docs, queries, how):
    got = R.vector_search(queries, docs, 4, **how)
    assert rows(got, "query_id", "doc_id", "score", "rank") == brute_vectors(docs, queries, 4)


def test_many_copies_do_not_crowd_a_task(spark, queries):
    """A third of the corpus is one vector: ties are settled by id and no more than k leave a task."""
    data = [(i, [1.0, 1.0, 0.0] if i % 3 == 0 else [0.0, float(i), 1.0]) for i in range(3000)]
    corpus = spark.createDataFrame(data, "doc_id long, embedding array<float>").repartition(4, "doc_id")
    assert R.vector_candidates(queries, corpus, 5).count() <= 3 * 5 * 4
    first = R.vector_search(queries.filter("query_id = 1"), corpus, 5).orderBy("rank")
    assert [r.doc_id for r in first.collect()] == [0, 3, 6, 9, 12]


def brute_bm25(docs, queries):
    split = {r.doc_id: r.chunk_text.lower().split() for r in docs.collect()}
    mean = sum(map(len, split.values())) / len(split)
    out = {}
    for q in queries.collect():
        for d, ws in split.items():
            score = 0.0
            for t in set("".join(c if c.isalnum() else " " for c in q.query_text.lower()).split()) & set(ws):
                df = sum(t in other for other in split.values())
                score += math.log(1 + (len(split) - df + 0.5) / (df + 0.5)) * ws.count(t) * 2.2 / (ws.count(t) + 1.2 * (0.25 + 0.75 * len(ws) / mean))
            if score:
                out[q.query_id, d] = round(score, 4)
    return out


@pytest.mark.parametrize("how", [{}, {"block_terms": 1}, {"block_queries": 1, "cell_docs": 7}])
def test_keyword_equals_brute_force(docs, queries, how):
    want = brute_bm25(docs, queries)
    got = R.keyword_search(queries, R.build_index(docs), 7, **how)
    best = [(q, d, s, n + 1) for q in (1, 2) for n, (s, d) in enumerate(sorted(((s, d) for (a, d), s in want.items() if a == q), key=lambda p: (-p[0], p[1]))[:7])]
    assert rows(got, "query_id", "doc_id", "score", "rank") == sorted(best, key=repr)


def test_small_products_give_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    q, term = np.divmod(rng.choice(40, 25, replace=False), 10)
    d, hit = np.divmod(rng.choice(300, 80, replace=False), 10)
    scorer = lambda: R._Scorer(np.arange(4), q, term, np.arange(1.0, 26), np.arange(30), d, np.where(np.isin(hit, term), hit, term[0]), np.ones(80))
    ((_, whole),) = list(scorer())
    monkeypatch.setattr(R, "MATRIX_CELLS", 100)
    parts = list(scorer())
    assert len(parts) == 3 and (np.concatenate([p for _, p in parts], axis=1) == whole).all() and whole.any()


@pytest.mark.parametrize("how", [{}, {"block_terms": 1}, {"block_queries": 1, "cell_docs": 7}])
@pytest.mark.parametrize("profile", list(R.PROFILES))
def test_hybrid_is_exact(docs, queries, profile, how):
    """The result equals scoring every pair on both legs."""
    docs = docs.withColumn("embedding", F.when(F.col("doc_id") % 6 != 0, F.col("embedding")))
    index = R.build_index(docs)
    k, (wt, wv) = 5, R.PROFILES[profile]
    text = brute_bm25(docs, queries)
    vec = {(q, d): s for q, d, s, _ in brute_vectors(docs.filter("embedding IS NOT NULL"), queries, 10**6)}
    want = []
    for q in (1, 2, 3):
        t = [s for (a, _), s in text.items() if a == q]
        v = [s for (a, _), s in vec.items() if a == q]
        scale = lambda s, all_: 0.0 if s is None else (s - min(all_)) / (max(all_) - min(all_)) if max(all_) > min(all_) else 1.0
        held = [d for d in range(60) if (q, d) in text or (q, d) in vec]
        scored = sorted(((round((scale(text.get((q, d)), t) * wt + scale(vec.get((q, d)), v) * wv) / (wt + wv), 10), d) for d in held), key=lambda p: (-p[0], p[1]))
        want += [(q, d, n + 1) for n, (_, d) in enumerate(scored[:k])]
    got = R.hybrid(queries, docs, index, profile, k, **how)
    assert rows(got, "query_id", "doc_id", "rank") == sorted(want, key=repr)


def hybrid_plan(spark, docs, queries) -> str:
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return R.hybrid(queries, docs, R.build_index(docs))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def test_both_passes_of_a_hybrid_search_read_one_shuffle(spark, docs, queries):
    plan = hybrid_plan(spark, docs, queries)
    assert plan.count("FlatMapCoGroupsInArrow") == 2
    assert plan.count("explode(blocks#") == 1
    assert len([x for x in plan.splitlines() if "ReusedExchange" in x and "gain#" in x]) == 1


def test_term_rows_reach_python_with_an_empty_vector(spark, docs, queries):
    assert hybrid_plan(spark, docs, queries).count("coalesce(_v#") == 4  # both sides of both passes
    words, vectors = (spark.createDataFrame(*x) for x in (([(1, 2)], "query_id long, term_no long"), ([(1, [1.0, 2.0]), (2, [])], "query_id long, _v array<float>")))
    assert rows(R._no_null_vectors(R._with_vectors(words, vectors)), "query_id", "term_no", "_v") == [(1, 2, []), (1, None, [1.0, 2.0]), (2, None, [])]


def test_hybrid_of_odd_rows(spark):
    """No text, no vector, neither, and rows that come twice, on both sides."""
    held = [(1, None, [1.0, 0.0]), (2, "", [0.0, 1.0]), (3, "mice common", None), (4, "mice mice", [1.0, 1.0]), (4, "mice mice", [1.0, 1.0]), (5, "common", None), (6, None, None)]
    docs = spark.createDataFrame(held, "doc_id long, chunk_text string, embedding array<float>")
    asked = [(1, "mice", None), (2, None, [1.0, 0.0]), (3, "Mice, mice!", [0.0, 1.0]), (3, "Mice, mice!", [0.0, 1.0]), (4, None, None), (5, "unknown", None)]
    queries = spark.createDataFrame(asked, "query_id long, query_text string, embedding array<float>")
    index = R.build_index(docs)
    got = R.hybrid(queries, docs, index)
    want = [(1, 1, 4, 0.5), (1, 2, 3, 0.0), (2, 1, 1, 0.5), (2, 2, 4, 0.3536), (2, 3, 2, 0.0), (3, 1, 4, 0.8536), (3, 2, 2, 0.5), (3, 3, 1, 0.0), (3, 4, 3, 0.0)]
    assert rows(got, "query_id", "rank", "doc_id", "score") == want
    sides = R.compare_profiles(queries, docs, index)
    assert rows(sides, "query_id", "rank", "default") == [r[:3] for r in want if r[1] <= 3]


def test_refresh_equals_rebuild(spark, docs):
    changed = docs.filter("doc_id < 10").withColumn("chunk_text", F.lit("new words mice"))
    gone = docs.filter("doc_id >= 50")
    fresh = R.refresh_index(R.build_index(docs), changed, gone)
    rebuilt = R.build_index(docs.filter("doc_id >= 10 AND doc_id < 50").unionByName(changed))
    assert rows(fresh.postings, "term", "doc_id", "tf", "length") == rows(rebuilt.postings, "term", "doc_id", "tf", "length")
    assert rows(fresh.lengths) == rows(rebuilt.lengths)
    assert R.changed_since(spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-02' AS loaded_at"), "2024-01-01").count() == 1


def test_written_index(spark, docs, queries, tmp_path):
    index = R.build_index(docs)
    stored = R.write_index(index, str(tmp_path), buckets=4)
    assert rows(R.keyword_search(queries, stored)) == rows(R.keyword_search(queries, index))
    # Opened where the catalog does not know it, as by another session.
    for part in ("postings", "frequency"):
        spark.sql(f"DROP TABLE terms_{dir_tag(f'{tmp_path}/{part}')}")
    assert rows(R.keyword_search(queries, R.read_index(spark, str(tmp_path)))) == rows(R.keyword_search(queries, index))


def test_postings_are_not_shuffled_to_meet_their_terms(spark, docs, tmp_path):
    stored = R.write_index(R.build_index(docs), str(tmp_path), buckets=4)
    asked = stored.frequency.filter("df > 1").select("term").distinct().hint("merge")
    plan = stored.postings.join(asked, "term")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_context_keeps_rows_of_one_page_number(spark):
    df = spark.createDataFrame([("d", 1, "Food Source one"), ("d", 2, "b plain"), ("d", 2, "a Other Criticals"), ("d", 3, "plain")], "doc_id string, page_number int, page_text string")
    got = rows(C.forward_fill_context(df), "page_number", "page_text", "section")
    assert got == [(1, "Food Source one", "Food Source"), (2, "a Other Criticals", "Other Criticals"), (2, "b plain", "Other Criticals"), (3, "plain", "Other Criticals")]


def test_rows_of_very_many_cells(spark):
    cells = ["04A\nTEXT OF THE VIOLATION", *[""] * 1100, "7 8 9 10 28"]
    money = ["04A", "81.1", "", "TEXT OF THE VIOLATION THAT IS LONG ENOUGH", *["$1"] * 1200, "$99"]
    df = spark.createDataFrame([(1, "worksheet", cells), (2, "penalty", money)], "id int, layout string, cells array<string>")
    prose = {r.id: r.prose for r in C.narrate_rows(df).collect()}
    assert prose[1].endswith("Condition V = 28 points.") and prose[2].endswith("$1, $99.")
