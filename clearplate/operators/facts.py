"""User facts: store, recall, capture from conversations, and answer parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.functions.latest import keep_computed, neighbour, top_per_key
from clearplate.functions.text import strip, terms
from clearplate.functions.vector import cosine
from clearplate.operators.retrieval import MATRIX_CELLS, first_k, numbers_below, stacked, unit_rows
from clearplate.session import written
from clearplate.sources import tables

# Categories, limits, texts and patterns.
CATEGORIES = ["location", "preference", "identity", "analytical", "general"]
DEFAULT_RESULTS, MAX_RESULTS, THRESHOLD = 5, 10, 0.3
# Facts and queries of a user that meet in one matrix product.
CELL_FACTS, BLOCK_QUERIES = 20_000, 2048
VECTOR_SIZE = 64
TOMBSTONE = "REMOVE"
CONTEXT_HEADER = (
    "The following facts about this user are known and should be used "
    "to answer location-specific and preference-specific questions directly "
    "without asking for them again:\n"
)
REQUEST_PATTERNS = [
    ("home_address", r"\b(where (do |did )?you (live|stay|reside|are located|are based)|your (home |current )?(address|location|neighbourhood|neighborhood)|(share|tell me|provide|what is) your (home |current )?(address|location))\b"),
    ("work_location", r"\b(your (work|office|workplace) (address|location)|where (do you work|is your office|is your workplace)|(share|tell me|provide) your (work|office) (address|location))\b"),
    ("neighborhood", r"\b(which (neighbourhood|neighborhood|area|district)|your (neighbourhood|neighborhood|area|district)|what (neighbourhood|neighborhood|area) (are you|do you)|(share|tell me) your (neighbourhood|neighborhood|area))\b"),
    ("preferred_borough", r"\b(preferred borough|which borough|borough you (prefer|live|work)|your (preferred |home )?borough)\b"),
    ("favorite_cuisine", r"\b(your (favorite|favourite|preferred) cuisine|which cuisine (is your (favorite|favourite)|do you prefer|are you interested in)|what (cuisine|food) (is your (favorite|favourite)|do you prefer|do you like|are you (interested|focused) in))\b"),
    ("violation_focus", r"\b(which violation (code|type|category|number)|what violation (code|type|category|number)|violation (code|type|category) (are you|do you) (focus|track|monitor|investigat|interest)|(focusing|working|concentrating) on (which|what) violation|your (focus|target|current) violation)\b"),
    ("grade_focus", r"\b(which grade(s)?( are you| do you)? (focus|track|monitor|interest|look)|what grade(s)? (are you|do you) (focus|track|monitor|interest|look)|your (preferred|focus|target) grade(s)?|grade(s)? (you are|you're) (focused|interested|monitoring|tracking))\b"),
    ("inspection_type", r"\b(which (type of )?inspection(s)?( are you| do you)? (focus|track|prefer|interest)|initial or re.?inspection|your (preferred|focus) inspection type|(initial|re-?inspection)(s)? (only|preference|focus))\b"),
    ("score_threshold", r"\b(your (score|inspection score) threshold|what score (threshold|cutoff|limit|range)|which score(s)? (are you|do you) (focus|track|monitor|interest)|score (above|below|over|under|greater|less) (which|what) (value|number|threshold))\b"),
    ("time_window", r"\b(your (preferred |default )?(date range|time (range|window|period|frame))|how (far back|many months) (do you|would you|should (i|we))|what (date range|time (range|period|frame|window)) (do you|would you) prefer)\b"),
    ("role", r"\b(your (role|job|title|position)|what (do you do|is your role|is your job|is your title))\b"),
    ("organization", r"\b(your (organization|organisation|company|agency|department|team)|which (organization|organisation|company|agency|department|team) (do you|are you))\b"),
]
_DELETE = r"\b(remove|delete|forget|clear|erase)\b.{0,40}"
DELETE_PATTERNS = [
    ("home_address", _DELETE + r"\b(home|home address|address|where i live|my location)\b"),
    ("work_location", _DELETE + r"\b(work|office|workplace|work address|work location)\b"),
    ("neighborhood", _DELETE + r"\b(neighbourhood|neighborhood|area|district)\b"),
    ("preferred_borough", _DELETE + r"\b(borough|preferred borough)\b"),
    ("favorite_cuisine", _DELETE + r"\b(cuisine|food|favorite cuisine|favourite cuisine)\b"),
    ("violation_focus", _DELETE + r"\b(violation|violation code|violation type|violation focus)\b"),
    ("grade_focus", _DELETE + r"\b(grade|grade focus|grade filter|grades)\b"),
    ("inspection_type", _DELETE + r"\b(inspection type|initial|re-?inspection)\b"),
    ("score_threshold", _DELETE + r"\b(score|threshold|score threshold|cutoff)\b"),
    ("time_window", _DELETE + r"\b(date range|time (range|window|period|frame)|time window)\b"),
    ("role", _DELETE + r"\b(role|job|title|position)\b"),
    ("organization", _DELETE + r"\b(org|organization|organisation|company|agency|department|team)\b"),
]
QUESTION_STARTERS = (
    r"^(what|how|show|tell|find|which|same|can|could|would|is|are|do|does|did|"
    r"where|when|who|why|get|list|give|help|any|compare|top|best|worst)\b"
)
GEO_INTENT = (
    r"\b(near|close to|within|around|vicinity|near my (home|house|place|address|location)|"
    r"show.*map|map of|on a map|geospatial|coordinates?)\b"
)
MAKE_POINT = r"ST_MAKEPOINT\(\s*([+-]?\d+(?:\.\d+)?)\s*,\s*([+-]?\d+(?:\.\d+)?)\s*\)"
# Line marks of an answer. A blank line ends a filter block and goes with it.
FRESHNESS_MARK = r"📅[^\S\n]*Data through:"
FILTERS_MARK = r"🔍[^\S\n]*Filters applied:"


def _search(text: Column, pattern: str) -> Column:
    """Unicode-aware, case-blind search in which only a line feed ends a line."""
    return text.rlike(f"(?iUd){pattern}")


def first_match(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Name of the first pattern found, in the listed order."""
    return F.coalesce(*[F.when(_search(text, p), F.lit(name)) for name, p in patterns])


# -- store -----------------------------------------------------------------------


def normalise_facts(facts: DataFrame) -> DataFrame:
    """Clean keys, values and categories; a fact with a blank key or value is rejected."""
    category = F.lower(strip(F.coalesce("category", F.lit("general"))))
    cleaned = facts.withColumns({
        "fact_key": F.replace(F.lower(strip(F.col("fact_key"))), F.lit(" "), F.lit("_")),
        "fact_value": strip(F.col("fact_value")),
        "category": F.when(category.isin(*CATEGORIES), category).otherwise("general"),
    })
    return cleaned.filter((F.col("fact_key") != "") & (F.col("fact_value") != ""))


def embed_text() -> Column:
    """What a fact's vector is made from: key and value together."""
    return F.concat("fact_key", F.lit(": "), "fact_value")


def hashed_vectors(facts: DataFrame, size: int = VECTOR_SIZE) -> DataFrame:
    """Facts (one per user and key) with a vector made from their text, where no model gives one.

    Terms of "key: value" are hashed to ``size`` places and weighted by how often they occur
    and in how few of these facts; the vector has length 1, or is zero for a fact without terms.
    """
    keys = ["user_id", "fact_key"]
    each = facts.select(*keys, F.explode(terms(embed_text())).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
    rare = each.groupBy("term").agg(F.log((facts.agg(F.count(F.lit(1)).alias("n")).scalar() + 1) / (F.count(F.lit(1)) + 1)).alias("idf"))
    place = (F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("long") % size).cast("int")
    placed = each.join(rare, "term").groupBy(*keys, place.alias("place")).agg(F.sum(F.col("tf") * (F.col("idf") + 1)).alias("w"))
    whole = placed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", "w"))).alias("_w"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("_w", i) / F.col("_norm"), F.lit(0.0)).cast("float"))
    return facts.drop("fact_embedding").join(whole, keys, "left").withColumn("fact_embedding", spread).drop("_w", "_norm")


def store_facts(target: DataFrame, facts: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Normalise a batch, keep the last fact per key, and upsert it.

    Vectors come with the batch; if it has none and the target does, they are made from the
    text, so a changed value has a new vector.
    """
    batch = tables.last_update_wins(normalise_facts(facts), ["user_id", "fact_key"], order)
    if "fact_embedding" in target.columns and "fact_embedding" not in facts.columns:
        batch = hashed_vectors(batch.select("user_id", "fact_key", *[c for c in batch.columns if c in target.columns and c not in ("user_id", "fact_key")]))
    return tables.upsert(target, batch, ["user_id", "fact_key"])


def facts_of(facts: DataFrame, user_id: str) -> DataFrame:
    return facts.filter(F.col("user_id") == user_id).select("fact_key", "fact_value").orderBy("fact_key")


def context_text(users: DataFrame, facts: DataFrame) -> DataFrame:
    """The known facts of each user as one text, '' for a user without facts.

    A user has one fact per key, and the result is one text of them all, so what is gathered
    for a user is never more than the text that is asked for.
    """
    line = F.concat(F.lit("  - "), F.replace("fact_key", F.lit("_"), F.lit(" ")), F.lit(": "), "fact_value")
    per_user = facts.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("fact_key", line.alias("line")))).alias("_lines"))
    body = F.array_join(F.transform("_lines", lambda e: e["line"]), "\n")
    joined = users.select("user_id").distinct().join(per_user, "user_id", "left")
    return joined.select("user_id", F.when(F.col("_lines").isNotNull(), F.concat(F.lit(CONTEXT_HEADER), body)).otherwise("").alias("context"))


# -- capture from conversations ------------------------------------------------------


def detect_request(turns: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(REQUEST_PATTERNS)) -> DataFrame:
    """Assistant turns that ask for a fact: at most one key per turn."""
    return keep_computed(turns.filter(F.col("role") == "assistant"), "fact_key", first_match(F.col("text"), patterns))


def looks_like_answer(text: Column) -> Column:
    return ~F.contains(text, F.lit("?")) & ~_search(strip(text), QUESTION_STARTERS)


def capture_facts(turns: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(REQUEST_PATTERNS), guard: bool = True, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Facts given in reply to a request: the next user turn, unless it reads like a question.

    Only requests and user turns take part in the look-back, and only their keys; the
    text of the reply is the value.
    """
    slim = turns.select(conv, turn, "role", "text")
    asked = detect_request(slim, patterns).select(conv, turn, "role", F.col("fact_key").alias("_key"))
    said = slim.filter(F.col("role") == "user").select(conv, turn, "role", F.lit(None).cast("string").alias("_key"))
    before = neighbour(asked.unionByName(said), [conv], turn, {"fact_key": "_key"}, step=-1)
    replies = before.filter((F.col("role") == "user") & F.col("fact_key").isNotNull()).select(conv, turn, "fact_key")
    answers = turns.filter(F.col("role") == "user").select(conv, turn, F.col("text").alias("fact_value"))
    if guard:
        answers = answers.filter(looks_like_answer(F.col("fact_value")))
    return replies.join(answers, [conv, turn])


def detect_delete(turns: DataFrame, patterns: Sequence[tuple[str, str]] = tuple(DELETE_PATTERNS)) -> DataFrame:
    """User turns that ask to forget a fact."""
    return keep_computed(turns.filter(F.col("role") == "user"), "fact_key", first_match(F.col("text"), patterns))


def latest_events(events: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Last store or delete per (user, key). Each task keeps one row per key before the shuffle."""
    return top_per_key(events, ["user_id", "fact_key"], [F.col(c).desc_nulls_last() for c in order])


def live(events: DataFrame) -> DataFrame:
    return events.filter((F.col("action") != "delete") & (F.coalesce("fact_value", F.lit("")) != TOMBSTONE))


def fold_facts(events: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Replay of (user_id, fact_key, fact_value, action, ts): the facts that stand at the end."""
    return live(latest_events(events, order)).select("user_id", "fact_key", "fact_value", *order)


# -- recall ------------------------------------------------------------------------


def clamp_results(k: int | None) -> int:
    return max(1, min(k or DEFAULT_RESULTS, MAX_RESULTS))


def recall(queries: DataFrame, facts: DataFrame, k: int | None = DEFAULT_RESULTS, cell_facts: int = CELL_FACTS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Relevant facts per query (query_id, user_id, embedding), from the facts of its user only.

    The best ``k`` come first and the threshold after, so a query never gets more than k.
    A user's facts are cut into cells and its queries into blocks of bounded size; most
    users have one of each. A (user, block, cell) is one matrix product, of which k rows per
    query come out: no pair becomes a row. The numbers of cells and blocks are counted once
    and written as a small table.
    """
    k = clamp_results(k)
    asked = queries.filter(F.col("embedding").isNotNull()).select("user_id", "query_id", F.col("embedding").alias("_v"))
    held = facts.filter(F.col("fact_embedding").isNotNull()).select("user_id", "fact_key", F.col("fact_embedding").alias("_v"), "fact_value", "category", "updated_at")
    per = lambda df, out, size: df.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / size).alias(out))
    sizes = written(per(asked, "blocks", block_queries).join(per(held, "cells", cell_facts), "user_id"), "recall-sizes")
    left = asked.join(sizes, "user_id").select("user_id", "query_id", "_v", F.pmod(F.xxhash64("query_id"), F.col("blocks")).alias("_block"), numbers_below(F.col("cells")).alias("_cell"))
    right = held.join(sizes, "user_id").select(*held.columns, F.pmod(F.xxhash64("fact_key"), F.col("cells")).alias("_cell"), numbers_below(F.col("blocks")).alias("_block"))
    fields = [asked.schema["query_id"], asked.schema["user_id"], held.schema["fact_key"], T.StructField("similarity", T.DoubleType()), *[held.schema[c] for c in ("fact_value", "category", "updated_at")]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def product(key: tuple, q: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        if q.empty or f.empty:
            return pd.DataFrame(columns=schema.fieldNames())
        f = f.reset_index(drop=True)
        names = np.asarray(f["fact_key"].tolist())
        asked, held = unit_rows(stacked(q["_v"])), unit_rows(stacked(f["_v"]))
        best, near = [], []
        step = max(1, MATRIX_CELLS // len(f))  # the whole product of a block and a cell would be some hundred MB
        for a in range(0, len(q), step):
            for row in np.round(asked[a : a + step] @ held.T, 4) + 0.0:
                best.append(first_k(row, names, k))
                near.append(row[best[-1]])
        at = np.concatenate(best)
        who = np.repeat(np.arange(len(q)), [len(b) for b in best])
        out = f.loc[at, ["fact_key", "fact_value", "category", "updated_at"]].reset_index(drop=True)
        return out.assign(query_id=q["query_id"].to_numpy()[who], user_id=key[0], similarity=np.concatenate(near))[schema.fieldNames()]

    keys = ["user_id", "_block", "_cell"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(product, schema)
    best = top_per_key(found, ["query_id"], [F.desc("similarity"), F.col("fact_key")], k, rank="rank")
    return best.filter(F.col("similarity") >= THRESHOLD)


def recall_text(queries: DataFrame, facts: DataFrame, k: int | None = DEFAULT_RESULTS) -> DataFrame:
    """One row per query: status (found, no_facts, none_relevant) and the formatted facts."""
    line = F.concat(
        F.lit("- "), "fact_key", F.lit(": "), "fact_value", F.lit(" (category: "), "category", F.lit(", relevance: "), F.col("similarity").cast("string"),
        F.lit(", updated: "), F.date_format("updated_at", "yyyy-MM-dd HH:mm"), F.lit(")"),
    )
    found = recall(queries, facts, k).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("_lines"))
    known = facts.filter(F.col("fact_embedding").isNotNull()).select("user_id").distinct().withColumn("_known", F.lit(True))
    out = queries.select("query_id", "user_id").join(known, "user_id", "left").join(found, "query_id", "left")
    status = F.when(F.col("_known").isNull(), "no_facts").when(F.col("_lines").isNull(), "none_relevant").otherwise("found")
    header = F.concat(F.lit("Found "), F.size("_lines"), F.lit(" relevant fact(s) for user "), "user_id", F.lit(":\n"))
    text = F.when(status == "found", F.concat(header, F.array_join(F.transform("_lines", lambda e: e["line"]), "\n"))).otherwise("")
    return out.select("query_id", "user_id", status.alias("status"), text.alias("text"))


def similarity_matrix(facts: DataFrame, probes: Mapping[str, Sequence[float]]) -> DataFrame:
    """Each fact's similarity to a few probe vectors, one column per probe. Probes are literals: nothing is joined."""
    columns = [F.round(cosine(F.col("fact_embedding"), F.lit([float(x) for x in v])), 4).alias(f"sim_{name}") for name, v in probes.items()]
    return facts.select("user_id", "fact_key", "fact_value", "category", *columns, "updated_at")


def conflicts(facts: DataFrame, places: Mapping[str, str] | DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of location facts of one user that name different places.

    ``places`` maps a pattern to the place it means, or is a table (name, place) of place
    names that are looked up among the runs of one to three words of a value; of several,
    the longest name, then the first in order, counts. ``keys`` lists the facts that tell a
    place; a user has one row per key, so a user gives at most as many pairs as there are
    pairs of keys.
    """
    asked = facts.filter(F.col("fact_key").isin(list(keys))).select("user_id", "fact_key", "fact_value")
    if isinstance(places, DataFrame):
        said = F.filter(F.split(F.lower("fact_value"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
        runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(said) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(said, i, n), " "))))
        each = asked.select("*", F.explode(F.array_distinct(runs)).alias("_name"))
        named = each.join(places.select(F.lower("name").alias("_name"), "place"), "_name")
        told = named.groupBy("user_id", "fact_key", "fact_value").agg(F.min(F.struct(-F.length("_name"), "_name", "place")).alias("_p"))
        told = told.select("user_id", "fact_key", "fact_value", F.col("_p.place").alias("place"))
    else:
        told = asked.select("*", first_match(F.col("fact_value"), [(place, p) for p, place in places.items()]).alias("place")).filter(F.col("place").isNotNull())
    left, right = (told.select("user_id", *[F.col(c).alias(f"{c}_{side}") for c in ("fact_key", "fact_value", "place")]) for side in ("a", "b"))
    return left.join(right, "user_id").filter((F.col("fact_key_a") < F.col("fact_key_b")) & (F.col("place_a") != F.col("place_b")))


# -- answers -------------------------------------------------------------------------

_HEADER_LINE = rf"\n(?!{FRESHNESS_MARK})[^\n]*{FILTERS_MARK}[^\n]*"
_BULLET_LINE = rf"\n(?!{FRESHNESS_MARK})(?![^\n]*{FILTERS_MARK})[^\S\n]*[-–][^\S\n]+([^\n]+)"
_BLOCK = rf"(?iU){_HEADER_LINE}(?:{_BULLET_LINE}|{_HEADER_LINE})*(?:\n[^\S\n]*(?=\n|$))?"
_FRESH_LINE = rf"(?iU)\n{FRESHNESS_MARK}[^\S\n]*([^\n]+)"


def parse_answers(turns: DataFrame, text: str = "text") -> DataFrame:
    """Split an answer into its data date, the filters it applied, and the remaining body.

    A filter block is a header line and the bullet lines under it. Filters are split at
    the first dash into condition and reason. All of it is done inside the row.
    """
    lines = F.concat(F.lit("\n"), F.col(text))
    blocks = F.array_join(F.regexp_extract_all(lines, F.lit(_BLOCK), 0), "")
    bullets = F.transform(F.regexp_extract_all(blocks, F.lit(f"(?iU){_BULLET_LINE}"), 1), strip)
    dates = F.regexp_extract_all(lines, F.lit(_FRESH_LINE), 1)

    def pieces(line: Column) -> Column:
        dash = F.when(F.contains(line, F.lit(" — ")), F.lit(" — ")).otherwise(F.lit(" -- "))
        at = F.instr(line, dash)
        return F.struct(
            strip(F.when(at > 0, F.substr(line, F.lit(1), at - 1)).otherwise(line)).alias("condition"),
            F.when(at > 0, strip(F.substr(line, at + F.length(dash)))).alias("reason"),
        )

    body = strip(F.regexp_replace(F.regexp_replace(lines, _BLOCK, ""), _FRESH_LINE, ""))
    return turns.withColumns({
        "freshness_date": strip(F.try_element_at(dates, F.lit(-1))),
        "filters": bullets,
        "filter_parts": F.transform(bullets, pieces),
        "body": body,
    })


def geo_intent(text: Column) -> Column:
    return _search(text, GEO_INTENT)


def sql_point(sql: Column) -> Column:
    """(latitude, longitude) of the first point in a SQL text, which names longitude first; NULL without one."""
    lon = F.nullif(F.regexp_extract(sql, MAKE_POINT, 1), F.lit(""))
    lat = F.nullif(F.regexp_extract(sql, MAKE_POINT, 2), F.lit(""))
    return F.when(lon.isNotNull(), F.struct(lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude")))
