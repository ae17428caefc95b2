"""Registered queries: document corpus and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import cells as V
from clearplate.operators import corpus as C
from clearplate.operators import quality as Q
from clearplate.operators import retrieval as R
from clearplate.plans.verified import top_critical_violations
from clearplate.registry.base import marts_of, query
from clearplate.registry.star_sql import star
from clearplate.session import dir_tag, fresh_path, work_path
from clearplate.sources import bind, tables

LOADED = "2024-01-31 00:00:00"


def _stamp():
    return F.lit(LOADED).cast("timestamp_ntz")


# -- pages and chunks ----------------------------------------------------------

_CLEAN = "html"
for _pattern, _to in [
    (r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " "),
    (r"(?i)<(br|/p|/div|/li|/h[1-6]|/tr)\b[^>]*>", "\n"),
    (r"<[^>]*>", " "),
]:
    _CLEAN = f"regexp_replace({_CLEAN}, '{_pattern}', '{_to}', 'g')"
for _entity, _char in C.ENTITIES.items():
    _CLEAN = f"replace({_CLEAN}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"
_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace({_CLEAN}, '[ \t\x0B\f\r]+', ' ', 'g'), ' ?\n[ \n]*', '" + "\n" + r"', 'g'), '^\s+|\s+$', '', 'g')"
query("d1_page_text", f"SELECT * FROM (SELECT page_id, url, {_CLEAN} AS page_text FROM pages) WHERE page_text <> ''")(
    lambda s, d: C.page_text(bind.web_pages(s, d)).select("page_id", "url", "page_text")
)

_MANUAL = """WITH manual AS (SELECT source AS doc_id, doc_id AS page_number,
  CASE doc_id % 13 WHEN 0 THEN '23-A' WHEN 4 THEN '23-B' WHEN 7 THEN '23-C-scored' WHEN 10 THEN '23-C-unscored' END AS a,
  CASE doc_id % 13 WHEN 4 THEN 'Food Source' WHEN 2 THEN 'Food Protection' WHEN 8 THEN 'General Violations' WHEN 11 THEN 'Other Criticals' END AS s, text FROM documents),
runs AS (SELECT *, last_value(a IGNORE NULLS) OVER w AS appendix, count(a) OVER w AS run FROM manual WINDOW w AS (PARTITION BY doc_id ORDER BY page_number ROWS UNBOUNDED PRECEDING)),
context AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS section FROM runs)
"""


def context(s, d):
    return C.forward_fill_context(bind.manual_pages(s, d))


def _placed_rows(s, d):
    layout = F.coalesce(*[F.when(F.col("appendix") == a, F.lit(name)) for a, name in C.LAYOUTS.items()])
    pages = context(s, d).select("doc_id", "page_number", layout.alias("layout"))
    return bind.manual_rows(s, d).join(pages, ["page_number", "layout"]).drop("layout")


query("d2_forward_fill", _MANUAL + "SELECT doc_id, page_number, appendix, section FROM context")(lambda s, d: context(s, d).select("doc_id", "page_number", "appendix", "section"))
_PREFIX = "concat_ws(' ', CASE appendix " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.CONTEXT.items()) + " END, 'Section: ' || section || '.')"
query("d3_context_prefix", _MANUAL + f"SELECT doc_id, page_number, {_PREFIX} AS prefix FROM context")(
    lambda s, d: context(s, d).select("doc_id", "page_number", C.context_prefix(F.col("appendix"), F.col("section")).alias("prefix"))
)


def _code(a: str, b: str) -> str:
    return f"lpad(({a} % 25)::varchar, 2, '0') || substr('ABCDEFG', ({b} % 7 + 1)::int, 1)"


_PASSAGES = f"""WITH passages AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS doc_id,
  'Codes ' || {_code('l_orderkey', 'l_partkey')} || '*, ' || {_code('l_partkey', 'l_suppkey')} || '+ and ' || {_code('l_orderkey', 'l_partkey')} || '; also ' || {_code('l_suppkey', 'l_orderkey')} || '.' AS text FROM lineitem),
found AS (SELECT doc_id, text, regexp_extract_all(text, '\\b([0-9]{{1,2}}[A-Z]\\*?\\+?)\\b', 1) AS codes FROM passages)"""
query("d4_codes", _PASSAGES + " SELECT doc_id, array_to_string(list_filter(codes, lambda c, i: list_position(codes, c) = i), '|') AS codes FROM found")(
    lambda s, d: bind.code_passages(s, d).select("doc_id", C.all_codes(F.col("chunk_text")).alias("codes"))
)

_LEVELS = "['I', 'II', 'III', 'IV', 'V']"
# Score texts in every shape: numbers, dashes of three kinds, more than five tokens.
_SCORES = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::int || ' ' || CASE l_suppkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '–' WHEN 2 THEN '—' ELSE '9' END
  || '  ' || l_partkey || ' x' || CASE WHEN l_linenumber % 2 = 0 THEN ' 28' ELSE '' END || CASE WHEN l_linenumber % 4 = 0 THEN ' 99' ELSE '' END AS scores FROM lineitem"""


def _points(tokens: str) -> str:
    zipped = f"list_filter(list_zip({_LEVELS}, ({tokens})[1:5]), lambda p: regexp_matches(coalesce(p[2], ''), '^[0-9]+$'))"
    return zipped


def _tokens(text: str) -> str:
    return rf"string_split_regex(trim(regexp_replace({text}, '[–—]', '-', 'g')), '\s+')"


query(
    "d5_parse_scores",
    f"""SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_partkey, l_suppkey, array_to_string(list_transform({_points(_tokens('scores'))}, lambda p: p[1] || '=' || p[2]), '|') AS points FROM ({_SCORES})""",
)(
    lambda s, d: bind.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat(
            F.col("l_quantity").cast("int"), F.lit(" "), F.when(F.col("l_suppkey") % 4 == 0, "-").when(F.col("l_suppkey") % 4 == 1, "–").when(F.col("l_suppkey") % 4 == 2, "—").otherwise("9"),
            F.lit("  "), F.col("l_partkey"), F.lit(" x"), F.when(F.col("l_linenumber") % 2 == 0, " 28").otherwise(""), F.when(F.col("l_linenumber") % 4 == 0, " 99").otherwise(""),
        ).alias("scores"),
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.transform(F.map_entries(C.parse_scores(F.col("scores"))), lambda e: F.concat(e["key"], F.lit("="), e["value"])).alias("points"))
)

_ROW_CODE = _code("p_partkey", "p_partkey")
_MARK = "CASE WHEN p_partkey % 2 = 0 THEN '*' WHEN p_partkey % 5 = 0 THEN '+' ELSE '' END"
_PROSE = f"""CASE p_partkey % 3
  WHEN 0 THEN 'Violation ' || {_ROW_CODE} || {_MARK} || ' ' || CASE WHEN p_partkey % 2 = 0 THEN '(Critical/Public Health Hazard) ' WHEN p_partkey % 5 = 0 THEN '(Pre-permit Serious) ' ELSE '' END || ': ' || p_type || ' '
    || CASE WHEN p_partkey % 4 = 0 THEN ' Point scores: Condition III = 9 points, Condition V = 28 points.'
       WHEN p_partkey % 6 <> 0 THEN ' Point scores: Condition I = 7 points, Condition II = 8 points, Condition III = 9 points, Condition IV = 10 points, Condition V = 28 points.'
       ELSE ' (Scored only at highest condition levels.)' END
  WHEN 1 THEN 'Violation ' || {_ROW_CODE} || ': ' || p_type || ' in ' || p_brand || ' Condition I: slight amount seen Condition III: more than ' || p_size || ' seen'
  ELSE CASE WHEN p_partkey % 9 <> 0 AND length('Violation ' || {_ROW_CODE} || ' (§81.' || p_size || '): ' || p_type || '.' || CASE WHEN p_partkey % 2 = 0 THEN ' Category: ' || p_brand || '.' ELSE '' END || ' Penalties: $200, $' || (p_size * 10) || '.') > 50
    THEN 'Violation ' || {_ROW_CODE} || ' (§81.' || p_size || '): ' || p_type || '.' || CASE WHEN p_partkey % 2 = 0 THEN ' Category: ' || p_brand || '.' ELSE '' END || ' Penalties: $200, $' || (p_size * 10) || '.' END END"""
query("d6_narrate_rows", f"SELECT page_number, prose FROM (SELECT p_partkey AS page_number, {_PROSE} AS prose FROM part) WHERE prose IS NOT NULL")(
    lambda s, d: C.narrate_rows(bind.manual_rows(s, d)).select("page_number", "prose")
)
_HEADING = r"""CASE doc_id_number % 13 WHEN 0 THEN E'APPENDIX 23-A\nINSPECTION WORKSHEET\n' WHEN 4 THEN E'Appendix 23-B\nGuide to Conditions\nFood Source\n' WHEN 7 THEN E'APPENDIX 23-C PENALTY SCHEDULE\n'
  WHEN 10 THEN E'APPENDIX 23-C\nUNSCORED VIOLATIONS\n' WHEN 2 THEN E'Food Protection\n' WHEN 8 THEN E'General Violations\n' WHEN 11 THEN E'Other Criticals\n' ELSE '' END""".replace("doc_id_number", "page_number")
_LAYOUT = "CASE WHEN appendix = '23-A' THEN 0 WHEN appendix = '23-B' THEN 1 WHEN appendix IS NOT NULL THEN 2 END"
query(
    "d7_table_pages",
    _MANUAL + f"""SELECT doc_id, page_number, CASE WHEN prose IS NOT NULL THEN concat_ws(E'\\n\\n', {_PREFIX}, prose) ELSE regexp_replace({_HEADING} || text, '^\\s+|\\s+$', '', 'g') END AS page_text
  FROM context LEFT JOIN (SELECT p_partkey, {_PROSE} AS prose FROM part) ON p_partkey = page_number AND {_LAYOUT} = p_partkey % 3""",
)(
    # All pages; rows are placed on pages of their own layout.
    lambda s, d: C.assemble_pages(context(s, d), _placed_rows(s, d)).select("doc_id", "page_number", "page_text")
)

_WORDS = r"string_split_regex(trim(text, E' \t\n\r'), '\s+')"
_CHUNKS = f"""WITH w AS (SELECT doc_id, source, lang, {_WORDS} AS words FROM documents),
chunks AS (SELECT doc_id, source, lang, i AS chunk_index, len(words[i * 720 + 1:i * 720 + 800]) AS word_count, array_to_string(words[i * 720 + 1:i * 720 + 800], ' ') AS chunk_text
  FROM (SELECT *, unnest(range(0, (len(words) + 719) // 720)) AS i FROM w WHERE len(words) >= 50))
"""
query("d8_chunks", _CHUNKS + "SELECT doc_id, chunk_index, word_count, chunk_text FROM chunks WHERE word_count >= 50")(
    lambda s, d: C.chunk_words(bind.documents(s, d)).select("doc_id", "chunk_index", "word_count", "chunk_text")
)
_CHUNK_ROWS = f"""SELECT sha256(doc_id || '|' || source || '|1|' || chunk_index) AS doc_id, source AS source_url, lang AS doc_type, source AS doc_label, 1::bigint AS page_number, chunk_index, word_count, chunk_text,
  '{LOADED}' AS loaded_at FROM chunks WHERE word_count >= 50"""


def chunks_of(s, d):
    return C.chunk_rows(bind.documents(s, d), loaded_at=_stamp())


query("d9_chunk_rows", _CHUNKS + _CHUNK_ROWS)(chunks_of)
query("d10_searchable", _CHUNKS + _CHUNK_ROWS.replace(">= 50", ">= 200"))(lambda s, d: C.searchable(chunks_of(s, d), 200))
query("d11_of_types", _CHUNKS + _CHUNK_ROWS + " AND lang IN ('en', 'de')")(lambda s, d: C.of_types(chunks_of(s, d), ["en", "de"]))
query(
    "q6_corpus_stats", _CHUNKS + f"""SELECT lang AS doc_type, count(DISTINCT source) AS documents, count(*) AS chunks, round(avg(word_count), 0) AS avg_words_per_chunk, '{LOADED}' AS last_loaded
  FROM chunks WHERE word_count >= 50 GROUP BY 1""",
)(lambda s, d: Q.corpus_stats(chunks_of(s, d)))


@query(
    "s4_replace_by_source", _CHUNKS + """SELECT source AS source_url, count(*) AS chunks, sum(word_count)::bigint AS words,
  min(CASE WHEN source IN ('src1', 'src2') THEN upper(chunk_text) ELSE chunk_text END) AS first_text FROM chunks WHERE word_count >= 50 GROUP BY 1""",
)
def _(s, d):
    """Load all sources, then reload two of them, twice; the other sources stay as they were."""
    path = fresh_path(s, "corpus")
    tables.replace_by_key(chunks_of(s, d), path, "source_url")
    again = chunks_of(s, d).filter(F.col("source_url").isin("src1", "src2")).withColumn("chunk_text", F.upper("chunk_text"))
    tables.replace_by_key(again, path, "source_url")
    tables.replace_by_key(again, path, "source_url")
    return tables.stored(s, path).groupBy("source_url").agg(F.count("*").alias("chunks"), F.sum("word_count").alias("words"), F.min("chunk_text").alias("first_text"))


# -- retrieval -------------------------------------------------------------------

_SPLIT = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"


def _bm25(where: str = "", text: str = _SPLIT) -> str:
    return f"""WITH toks AS (SELECT doc_id, {text} AS ts FROM documents {where}),
post AS (SELECT term, doc_id, len, count(*) AS tf FROM (SELECT doc_id, len(ts) AS len, unnest(ts) AS term FROM toks) GROUP BY 1, 2, 3),
stats AS (SELECT count(*) AS n, avg(len(ts)) AS m FROM toks),
asked AS (SELECT item_id AS query_id, unnest(list_distinct({_SPLIT})) AS term FROM benchmark),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
kw AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * len / m))), 4) AS score
  FROM asked JOIN freq USING (term) JOIN post USING (term), stats GROUP BY 1, 2)"""


_TOP = "SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {}) WHERE rank <= {}"


_STORED: set[str] = set()


def stored_index(s, d):
    """The stored index of a data folder's corpus, made on first use in this application, as a search service keeps it."""
    path = work_path(s, "index", dir_tag(d))
    if path not in _STORED:
        R.write_index(R.build_index(bind.search_corpus(s, d)), path)
        _STORED.add(path)
    return R.read_index(s, path)


query("r1_index_terms", _bm25() + " SELECT term, count(*) AS df, sum(tf)::bigint AS cf FROM post GROUP BY 1")(
    lambda s, d: R.build_index(bind.search_corpus(s, d)).postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
)
query("r2_bm25", _bm25() + _TOP.format("kw", 5))(lambda s, d: R.keyword_search(bind.search_queries(s, d), stored_index(s, d)))


@query("r2_bm25_written_index", _bm25() + _TOP.format("kw", 5))
def _(s, d):
    """The index made, stored in a few buckets and searched in small blocks and cells."""
    index = R.write_index(R.build_index(bind.search_corpus(s, d)), fresh_path(s, "index"), buckets=5)
    return R.keyword_search(bind.search_queries(s, d), index, block_queries=16, cell_docs=100)


_VECTORS = """WITH qv AS (SELECT item_id AS query_id, embedding::double[] AS q FROM benchmark JOIN embeddings ON item_id = vec_id),
dv AS (SELECT doc_id, lang, embedding::double[] AS v FROM documents JOIN embeddings ON doc_id = vec_id),
vec AS (SELECT query_id, doc_id, lang, round(list_cosine_similarity(q, v), 4) + 0.0 AS score FROM qv, dv)"""
query("r3_cosine_topk", _VECTORS + _TOP.format("vec", 5))(lambda s, d: R.vector_search(bind.search_queries(s, d), bind.search_corpus(s, d)))
query("r3_cosine_topk_blocked", _VECTORS + _TOP.format("vec", 10))(
    lambda s, d: R.vector_search(bind.search_queries(s, d), bind.search_corpus(s, d), 10, max_broadcast=16, cell_rows=200)
)



def _cells(s, d):
    """The stored cells of the corpus, read back."""
    path = fresh_path(s, "cells")
    V.write_cells(bind.search_corpus(s, d), path)
    return V.read_cells(s, path)


@query("r3_cells_all_probed", _VECTORS + _TOP.format("vec", 5))
def _(s, d):
    """Every cell asked: the exact answer from the stored cells, crowded ones cut small."""
    index = _cells(s, d)
    return V.cell_search(bind.search_queries(s, d), index, probes=len(index.centroids), cell_rows=50, block_queries=16)


@query("r3_cells_recall", _VECTORS + ", top AS (" + _TOP.format("vec", 5) + ") SELECT count(DISTINCT query_id) AS queries, count(*) AS wanted, true AS nine_in_ten FROM top")
def _(s, d):
    """The default number of cells asked, against brute force: at least nine in ten of the true neighbours."""
    queries = bind.search_queries(s, d)
    found = V.recall_of(V.cell_search(queries, _cells(s, d)), R.vector_search(queries, bind.search_corpus(s, d)))
    return found.select("queries", "wanted", (F.col("found") >= 0.9 * F.col("wanted")).alias("nine_in_ten"))


def _hybrid(texts: float, vectors: float) -> str:
    return f"""{_bm25()}, {_VECTORS[5:]},
tr AS (SELECT query_id, min(score) AS lo, max(score) AS hi FROM kw GROUP BY 1), vr AS (SELECT query_id, min(score) AS lo, max(score) AS hi FROM vec GROUP BY 1),
legs AS (SELECT query_id, doc_id,
    coalesce(CASE WHEN kw.score IS NOT NULL THEN CASE WHEN tr.hi > tr.lo THEN (kw.score - tr.lo) / (tr.hi - tr.lo) ELSE 1.0 END END, 0.0)::double AS t,
    coalesce(CASE WHEN vec.score IS NOT NULL THEN CASE WHEN vr.hi > vr.lo THEN (vec.score - vr.lo) / (vr.hi - vr.lo) ELSE 1.0 END END, 0.0)::double AS v
  FROM kw FULL JOIN vec USING (query_id, doc_id) LEFT JOIN tr USING (query_id) LEFT JOIN vr USING (query_id)),
fused AS (SELECT query_id, doc_id, round((t * {texts}::double + v * {vectors}::double) / {texts + vectors}::double, 10) AS score FROM legs),
ranked AS ({_TOP.format('fused', 5)})"""


_FUSED = " SELECT query_id, doc_id, round(score, 4) AS score, rank FROM ranked"
query("r4_hybrid", _hybrid(1.0, 1.0) + _FUSED)(lambda s, d: R.hybrid(bind.search_queries(s, d), bind.search_corpus(s, d), stored_index(s, d)))
query("r4_hybrid_keyword_heavy", _hybrid(3.0, 1.0) + _FUSED)(
    lambda s, d: R.hybrid(bind.search_queries(s, d), bind.search_corpus(s, d), stored_index(s, d), "keyword_heavy")
)
_EN_OR_SRC1 = {"@or": [{"@eq": {"doc_type": "en"}}, {"@eq": {"doc_label": "src1"}}]}
query("r5_filtered", _bm25("WHERE lang = 'en' OR source = 'src1'") + _TOP.format("kw", 5))(
    lambda s, d: R.keyword_search(bind.search_queries(s, d), R.build_index(bind.search_corpus(s, d).filter(R.attribute_filter(_EN_OR_SRC1))))
)
query("r5_filter_forms", """SELECT 'either' AS form, count(*) AS documents FROM documents WHERE lang = 'en' OR source = 'src1' UNION ALL SELECT 'both', count(*) FROM documents WHERE lang = 'en' AND source = 'src1'
  UNION ALL SELECT 'two types at once', count(*) FROM documents WHERE lang = 'en' AND lang = 'de'""")(lambda s, d: _filter_forms(bind.search_corpus(s, d)))


def _filter_forms(corpus):
    en, de, src1 = ({"@eq": {"doc_type": "en"}}, {"@eq": {"doc_type": "de"}}, {"@eq": {"doc_label": "src1"}})
    forms = {"either": {"@or": [en, src1]}, "both": {"@and": [en, src1]}, "two types at once": {"@and": [en, de]}}
    counted = corpus.agg(*[F.count_if(R.attribute_filter(f)).alias(name) for name, f in forms.items()])
    return counted.unpivot([], list(forms), "form", "documents")


query("r6_projected", _bm25() + f" SELECT query_id, doc_id, score, rank, lang AS doc_type, source AS doc_label FROM ({_TOP.format('kw', 3)}) JOIN documents USING (doc_id)")(
    lambda s, d: R.with_columns(R.keyword_search(bind.search_queries(s, d), stored_index(s, d)), bind.search_corpus(s, d), "doc_id", ["doc_type", "doc_label"], 3)
)
_PROFILE_TOP = "SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round((t * {w} + v) / ({w} + 1), 10) DESC, doc_id) AS rank FROM legs"
query(
    "r7_compare_profiles",
    _hybrid(1.0, 1.0) + f""", a AS ({_PROFILE_TOP.format(w='1.0::double')}), b AS ({_PROFILE_TOP.format(w='3.0::double')})
  SELECT query_id, rank, a.doc_id AS "default", a.doc_id AS no_reranker, b.doc_id AS keyword_heavy FROM a JOIN b USING (query_id, rank) WHERE rank <= 3""",
)(lambda s, d: R.compare_profiles(bind.search_queries(s, d), bind.search_corpus(s, d), stored_index(s, d)))


@query("r8_refresh_index", _bm25("WHERE lang <> 'de'", _SPLIT.replace("lower(text)", "lower(CASE WHEN lang = 'en' THEN text || ' refreshed passage' ELSE text END)")) + " SELECT term, count(*) AS df, sum(tf)::bigint AS cf FROM post GROUP BY 1")
def _(s, d):
    """English texts changed and German texts went; the rest of the index is kept."""
    docs = bind.search_corpus(s, d)
    changed = docs.filter("doc_type = 'en'").withColumn("chunk_text", F.concat("chunk_text", F.lit(" refreshed passage")))
    fresh = R.refresh_index(R.build_index(docs), changed, docs.filter("doc_type = 'de'"))
    return fresh.postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


_R9 = star("").replace("WITH ", _PASSAGES + ", ", 1).rstrip() + """
SELECT violation_code, citation_count, count(DISTINCT doc_id) AS passages, min(doc_id) AS first_passage FROM (
  SELECT t.violation_code, t.violation_description, sum(violation_count)::bigint AS citation_count FROM violations v JOIN violation_types t USING (dim_violation_key)
    WHERE v.is_critical_violation GROUP BY 1, 2 ORDER BY citation_count DESC, violation_code LIMIT 5)
  JOIN (SELECT doc_id, regexp_replace(unnest(codes), '[*+]', '', 'g') AS violation_code FROM found) USING (violation_code) GROUP BY 1, 2"""
query("r9_explain_codes", _R9)(
    lambda s, d: R.explain_codes(top_critical_violations(marts_of(s, d), 5), bind.code_passages(s, d))
    .groupBy("violation_code", "citation_count").agg(F.count_distinct("doc_id").alias("passages"), F.min("doc_id").alias("first_passage"))
)
