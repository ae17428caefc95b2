"""Document corpus: page text, page context, table rows as prose, word chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.functions.latest import carry_last, keep_computed
from clearplate.functions.text import strip, words

# Chunk sizes, appendix and section headings, page texts and layouts.
CHUNK_SIZE, CHUNK_OVERLAP, MIN_CHUNK_WORDS = 800, 80, 50
APPENDICES = [
    ("23-C-unscored", r"(?isU)APPENDIX\s+23-C.*UNSCORED\s+VIOLATIONS"),
    ("23-C-scored", r"(?isU)APPENDIX\s+23-C.*PENALTY\s+SCHEDULE"),
    ("23-B", r"(?isU)APPENDIX\s+23-B.*GUIDE\s+TO\s+CONDITIONS"),
    ("23-A", r"(?isU)APPENDIX\s+23-A.*INSPECTION\s+WORKSHEET"),
]
SECTIONS = [
    "Time and Temperature Control for Safety",
    "Food Source",
    "Food Protection",
    "Facility Design and Construction",
    "Food Worker Hygiene and Other Food Protection",
    "Other Criticals",
    "Garbage, Waste Disposal and Pest Management",
    "General Violations",
]
CONTEXT = {
    "23-A": "Appendix 23-A of Chapter 23: Food Service Establishment Inspection Worksheet — violation codes, condition levels (I through V), and point scores.",
    "23-B": "Appendix 23-B of Chapter 23: Inspection Scoring Parameters — a guide to condition levels with examples for each violation.",
    "23-C-scored": "Appendix 23-C of Chapter 23: Penalty Schedule for scored violations — fine amounts by violation code, Health Code citation, and condition level.",
    "23-C-unscored": "Appendix 23-C of Chapter 23: Penalty Schedule for unscored violations — fines for tobacco, signage, permits, and other non-food-safety violations.",
}
LAYOUTS = {"23-A": "worksheet", "23-B": "guide", "23-C-scored": "penalty", "23-C-unscored": "penalty"}
CONDITIONS = ["I", "II", "III", "IV", "V"]
CODE = r"\d{1,2}[A-Z]\*?\+?"
MAX_PAGE_CODES = 15
MIN_PROSE = 50
DASHES = ["—", "–", "-"]
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def page_text(pages: DataFrame, source: str = "html", out: str = "page_text") -> DataFrame:
    """Text of landed pages: markup, scripts and comments removed, blank pages dropped."""
    c = F.regexp_replace(source, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?i)<(br|/p|/div|/li|/h[1-6]|/tr)\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    c = F.regexp_replace(c, r"[ \t\x0B\f\r]+", " ")
    c = strip(F.regexp_replace(c, r" ?\n[ \n]*", "\n"))
    return keep_computed(pages, out, F.nullif(c, F.lit("")))


def matched_appendix(text: Column) -> Column:
    """First matching appendix heading, in the listed order."""
    return F.coalesce(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in APPENDICES])


def matched_section(text: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(text, F.lit(s)), F.lit(s)) for s in SECTIONS])


def forward_fill_context(pages: DataFrame, doc: str = "doc_id", page: str = "page_number", text: str = "page_text") -> DataFrame:
    """Add the appendix and section each page is in.

    A page without a heading stays in the last one seen. A new appendix ends the section:
    a section counts only if its heading came at or after the appendix heading. Rows stay
    as many as they were, also where a page number repeats; such rows are ordered by text.
    The text is shuffled once, for the look-back itself.
    """
    kept = pages.filter(strip(F.col(text)) != "")
    heads = kept.select("*", matched_appendix(F.col(text)).alias("_a"), matched_section(F.col(text)).alias("_s"))
    heads = heads.withColumns({
        "_at": F.when(F.col("_a").isNotNull(), F.struct(F.col("_a").alias("name"), F.col(page).alias("page"))),
        "_st": F.when(F.col("_s").isNotNull(), F.struct(F.col("_s").alias("name"), F.col(page).alias("page"))),
    }).drop("_a", "_s")
    filled = carry_last(heads, [doc], page, {"_app": "_at", "_sec": "_st"}, tie=[text])
    current = F.when(F.coalesce(F.col("_sec.page") >= F.col("_app.page"), F.lit(True)), F.col("_sec.name"))
    return filled.select(*pages.columns, F.col("_app.name").alias("appendix"), current.alias("section"))


def context_prefix(appendix: Column, section: Column) -> Column:
    """Sentence that places a page; '' outside every appendix and section."""
    intro = F.coalesce(*[F.when(appendix == name, F.lit(text)) for name, text in CONTEXT.items()])
    return F.concat_ws(" ", intro, F.concat(F.lit("Section: "), section, F.lit(".")))


def all_codes(text: Column) -> Column:
    """Distinct codes in a text, in the order first seen."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?U)\b({CODE})\b"), 1))


def page_codes(text: Column, most: int = MAX_PAGE_CODES) -> Column:
    """The codes named in the summary line of a page: the first ``most``, as the page layout states."""
    return F.slice(all_codes(text), 1, most)


def parse_scores(text: Column) -> Column:
    """'7 8 9 10 28' to {I: 7, II: 8, ...}; a dash skips its condition. No scores give an empty map."""
    tokens = F.slice(words(F.regexp_replace(F.coalesce(text, F.lit("")), "[–—]", "-")), 1, len(CONDITIONS))
    names = F.array(*map(F.lit, CONDITIONS))
    pairs = F.transform(tokens, lambda t, i: F.struct(F.get(names, i).alias("condition"), F.when(t.rlike(r"^\d+$"), t.try_cast("int")).alias("points")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["points"].isNotNull()))


def _cell(cells: Column, i: int) -> Column:
    """Cell text on one line; '' for a missing cell."""
    return strip(F.replace(F.coalesce(F.get(cells, F.lit(i)), F.lit("")), F.lit("\n"), F.lit(" ")))


def _cells_from(cells: Column, first: int) -> Column:
    """All cells from the ``first``-th on."""
    return F.slice(cells, F.lit(first), F.greatest(F.size(cells) - (first - 1), F.lit(0)))


def _long_enough(prose: Column) -> Column:
    return F.when(F.length(prose) > MIN_PROSE, prose)


def _worksheet_row(cells: Column) -> Column:
    first = _cell(cells, 0)
    pattern = rf"(?sU)^({CODE})\s+(.+)"
    code, description = F.regexp_extract(first, pattern, 1), strip(F.regexp_extract(first, pattern, 2))
    others = F.transform(_cells_from(cells, 2), lambda c: parse_scores(c))
    scores = F.get(F.filter(others, lambda m: F.size(m) > 0), F.lit(0))
    listed = F.array_join(F.transform(F.map_entries(scores), lambda e: F.concat(F.lit("Condition "), e["key"], F.lit(" = "), e["value"].cast("string"), F.lit(" points"))), ", ")
    mark = F.when(F.contains(code, F.lit("*")), "(Critical/Public Health Hazard)").when(F.contains(code, F.lit("+")), "(Pre-permit Serious)")
    tail = F.when(scores.isNotNull(), F.concat(F.lit(" Point scores: "), listed, F.lit("."))).otherwise(" (Scored only at highest condition levels.)")
    prose = F.concat_ws(" ", F.concat(F.lit("Violation "), code), mark, F.concat(F.lit(": "), description), tail)
    return F.when(code != "", prose)


def _guide_row(cells: Column) -> Column:
    code = strip(F.coalesce(F.get(cells, F.lit(0)), F.lit("")))
    levels = []
    for i, name in enumerate(CONDITIONS):
        text = _cell(cells, i + 2)
        levels.append(F.when((text != "") & ~text.isin(*DASHES), F.concat(F.lit(f"Condition {name}: "), text)))
    prose = F.concat_ws(" ", F.concat(F.lit("Violation "), code, F.lit(": "), _cell(cells, 1)), *levels)
    return F.when((F.size(cells) >= 3) & code.rlike(r"^\d{1,2}[A-Z]"), _long_enough(prose))


def _penalty_row(cells: Column) -> Column:
    code = strip(F.coalesce(F.get(cells, F.lit(0)), F.lit("")))
    amounts = F.transform(_cells_from(cells, 5), lambda c: strip(F.coalesce(c, F.lit(""))))
    amounts = F.filter(amounts, lambda c: (c != "") & ~c.isin(*DASHES))
    category = _cell(cells, 2)
    prose = F.concat_ws(
        " ",
        F.concat(F.lit("Violation "), code, F.lit(" ("), _cell(cells, 1), F.lit("): "), _cell(cells, 3), F.lit(".")),
        F.when(category != "", F.concat(F.lit("Category: "), category, F.lit("."))),
        F.when(F.size(amounts) > 0, F.concat(F.lit("Penalties: "), F.array_join(amounts, ", "), F.lit("."))),
    )
    return F.when((F.size(cells) >= 4) & code.rlike(r"^\d{2}[A-Z]"), _long_enough(prose))


def narrate(cells: Column, layout: Column) -> Column:
    """A table row (array of cells) as prose, by layout; NULL for a row without a code."""
    return F.when(layout == "worksheet", _worksheet_row(cells)).when(layout == "guide", _guide_row(cells)).when(layout == "penalty", _penalty_row(cells))


def narrate_rows(rows: DataFrame, cells: str = "cells", layout: str = "layout") -> DataFrame:
    return keep_computed(rows, "prose", narrate(F.col(cells), F.col(layout)))


def assemble_pages(pages: DataFrame, rows: DataFrame, doc: str = "doc_id", page: str = "page_number", text: str = "page_text") -> DataFrame:
    """Page text with its table rows told as prose.

    ``pages`` comes from :func:`forward_fill_context`; ``rows`` has (doc, page, position,
    cells). A page with a table becomes context, codes and rows, one paragraph each, when
    that gives at least two paragraphs; every other page keeps its text.
    """
    layout = F.coalesce(*[F.when(F.col("appendix") == a, F.lit(name)) for a, name in LAYOUTS.items()])
    placed = rows.join(pages.select(doc, page, layout.alias("layout")), [doc, page])
    told = placed.select(doc, page, "position", narrate(F.col("cells"), F.col("layout")).alias("prose"))
    per_page = told.groupBy(doc, page).agg(
        F.array_sort(F.collect_list(F.when(F.col("prose").isNotNull(), F.struct("position", "prose")))).alias("_rows")
    )
    prefix = F.nullif(context_prefix(F.col("appendix"), F.col("section")), F.lit(""))
    codes = page_codes(F.col(text))
    code_line = F.when(F.size(codes) > 0, F.concat(F.lit("Violation codes on this page: "), F.array_join(codes, ", "), F.lit(".")))
    parts = F.concat(F.array_compact(F.array(prefix, code_line)), F.transform("_rows", lambda r: r["prose"]))
    joined = pages.join(per_page, [doc, page], "left")
    has_table = F.col("_rows").isNotNull()
    new_text = F.when(has_table & (F.size(parts) > 1), F.array_join(parts, "\n\n")).otherwise(strip(F.col(text)))
    return joined.withColumn(text, new_text).drop("_rows")


def chunk_words(df: DataFrame, text: str = "page_text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, least: int = MIN_CHUNK_WORDS) -> DataFrame:
    """Overlapping word windows: one row per chunk with chunk_index, word_count, chunk_text.

    Windows are made inside the row and exploded as finished chunks; the word array
    itself is never repeated. A text or a last window under ``least`` words is dropped.
    """
    split = df.withColumn("_words", words(F.col(text))).drop(text)
    starts = F.sequence(F.lit(0), F.size("_words") - 1, F.lit(size - overlap))

    def window(start: Column, index: Column) -> Column:
        part = F.slice("_words", start + 1, F.lit(size))
        return F.struct(index.cast("int").alias("chunk_index"), F.size(part).alias("word_count"), F.array_join(part, " ").alias("chunk_text"))

    # The outer form keeps the optimizer from repeating the whole expression in a filter below it.
    made = F.when(F.size("_words") >= least, F.transform(starts, window))
    flat = split.withColumn("_chunks", made).drop("_words").select("*", F.inline_outer("_chunks")).drop("_chunks")
    return flat.filter(F.col("word_count") >= least)


def chunk_rows(pages: DataFrame, doc: str = "doc_id", loaded_at: Column | None = None) -> DataFrame:
    """Pages to chunk rows. The id follows from document, source, page and index, so a reload gives the same ids."""
    chunks = chunk_words(pages)
    identity = F.sha2(F.concat_ws("|", F.col(doc).cast("string"), "source_url", "page_number", "chunk_index"), 256)
    return chunks.select(
        identity.alias("doc_id"), "source_url", "doc_type", "doc_label", "page_number", "chunk_index", "word_count", "chunk_text",
        (loaded_at if loaded_at is not None else F.localtimestamp()).alias("loaded_at"),
    )


def searchable(chunks: DataFrame, least: int = MIN_CHUNK_WORDS) -> DataFrame:
    return chunks.filter(F.col("chunk_text").isNotNull() & (F.col("word_count") >= least))


def of_types(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """Sources of the given document types; prunes folders when the table is partitioned by type."""
    return df.filter(F.col("doc_type").isin(list(types)))
