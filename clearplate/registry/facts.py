"""Registered queries: tables that change, user facts, test runs, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import evaluation as E
from clearplate.operators import facts as U
from clearplate.operators import quality as Q
from clearplate.registry.base import query
from clearplate.registry.star_sql import RAW, star
from clearplate.session import fresh_path
from clearplate.sources import bind, tables
from clearplate.streaming import jobs as X

NEW = "2024-02-01 00:00:00"


def _new():
    return F.lit(NEW).cast("timestamp_ntz")


_MADE = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(vec_id)"
_FACTS = f"""WITH facts AS (SELECT (vec_id % 10)::varchar AS user_id, 'fact_' || vec_id AS fact_key, 'value ' || vec_id AS fact_value,
  ['location', 'preference', 'identity', 'analytical', 'general'][label % 5 + 1] AS category, {_MADE} AS created_at, {_MADE} AS updated_at, embedding::double[] AS v, label, vec_id FROM embeddings),
upd AS (SELECT (vec_id % 10)::varchar AS user_id, CASE WHEN label = 5 THEN 'extra_' ELSE 'fact_' END || vec_id AS fact_key, 'changed ' || vec_id AS fact_value, 'general' AS category, vec_id, label
  FROM embeddings WHERE label IN (0, 1, 2, 5))
"""
_OUT = ["user_id", "fact_key", "fact_value", "category", "created_at", "updated_at"]


def _t(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c.split('.')[-1]}"


def updates(s, d):
    new_key = F.concat(F.when(F.col("label") == 5, "extra_").otherwise("fact_"), "vec_id")
    return bind.table(s, d, "embeddings").filter(F.col("label").isin(0, 1, 2, 5)).select(
        (F.col("vec_id") % 10).cast("string").alias("user_id"), new_key.alias("fact_key"), F.concat(F.lit("changed "), "vec_id").alias("fact_value"), F.lit("general").alias("category"),
        F.col("embedding").alias("fact_embedding"), F.lit("said so").alias("source_turn"), F.lit(1.0).alias("confidence"), _new().alias("created_at"), _new().alias("updated_at"),
    )


# -- tables that change ------------------------------------------------------------

_UPSERT = _FACTS + f"""SELECT coalesce(f.user_id, u.user_id) AS user_id, coalesce(f.fact_key, u.fact_key) AS fact_key, coalesce(u.fact_value, f.fact_value) AS fact_value, coalesce(u.category, f.category) AS category,
  strftime(coalesce(f.created_at, TIMESTAMP '{NEW}'), '%Y-%m-%d %H:%M:%S') AS created_at, CASE WHEN u.user_id IS NULL THEN strftime(f.updated_at, '%Y-%m-%d %H:%M:%S') ELSE '{NEW}' END AS updated_at
  FROM facts f FULL JOIN upd u ON f.user_id = u.user_id AND f.fact_key = u.fact_key"""
query("s5_upsert", _UPSERT)(lambda s, d: tables.upsert(bind.memory_vectors(s, d), updates(s, d), ["user_id", "fact_key"]).select(*_OUT))


@query("s5_upsert_partitions", _UPSERT)
def _(s, d):
    """The same upsert into a written table, rewriting only touched parts; done twice."""
    path, keys = fresh_path(s, "facts"), ["user_id", "fact_key"]
    tables.create_cut_by_keys(bind.memory_vectors(s, d), path, keys, part_rows=100)
    for _ in range(2):
        tables.upsert_partitions(path, updates(s, d), keys)
    return tables.stored(s, path).select(*_OUT)


query("s6_delete", _FACTS + f"SELECT user_id, fact_key, fact_value, category, {_t('created_at')}, {_t('updated_at')} FROM facts f WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.user_id = f.user_id AND u.fact_key = f.fact_key)")(
    lambda s, d: tables.delete_where(bind.memory_vectors(s, d), updates(s, d), ["user_id", "fact_key"]).select(*_OUT)
)
query("s6_deleted_counts", _FACTS + "SELECT f.user_id, count(*) AS rows_deleted FROM facts f JOIN upd u ON u.user_id = f.user_id AND u.fact_key = f.fact_key GROUP BY 1")(
    lambda s, d: tables.deleted_counts(bind.memory_vectors(s, d), updates(s, d), ["user_id", "fact_key"], ["user_id"])
)
query(
    "s7_append_ratings", """SELECT rating, count(*) AS ratings, count(*) AS ids, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS newest FROM (
  SELECT CASE WHEN length(text) % 3 = 0 THEN 'down' WHEN length(text) % 3 = 1 THEN 'up' ELSE 'meh' END AS rating, TIMESTAMP '2024-01-01 00:00:00' + to_minutes((conv_id * 60 + turn)::bigint) AS created_at
  FROM conversations WHERE role = 'assistant') WHERE rating <> 'meh' GROUP BY 1""",
)(lambda s, d: _rated(s, d))


def _rated(s, d):
    """Append a batch with a rating outside the domain; only known ratings arrive."""
    path = fresh_path(s, "ratings")
    graded = F.when(F.length("answer") % 3 == 0, "down").when(F.length("answer") % 3 == 1, "up").otherwise("meh")
    tables.append(tables.rating_events(bind.feedback(s, d).withColumn("rating", graded)), path)
    return s.read.parquet(path).groupBy("rating").agg(F.count("*").alias("ratings"), F.count_distinct("feedback_id").alias("ids"), F.max("created_at").alias("newest"))


query(
    "s8_insert_missing", _FACTS + f"""SELECT user_id, fact_key, fact_value, category, {_t('created_at')}, {_t('updated_at')} FROM facts
  UNION ALL SELECT user_id, fact_key, fact_value, category, '{NEW}', '{NEW}' FROM upd u WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE u.user_id = f.user_id AND u.fact_key = f.fact_key)""",
)(lambda s, d: tables.insert_missing(bind.memory_vectors(s, d), updates(s, d), ["user_id", "fact_key"]).select(*_OUT))
query(
    "s13_correct", _FACTS + f"""SELECT f.user_id, f.fact_key, coalesce(u.fact_value, f.fact_value) AS fact_value, f.category, {_t('f.created_at')},
  CASE WHEN u.user_id IS NULL THEN strftime(f.updated_at, '%Y-%m-%d %H:%M:%S') ELSE '{NEW}' END AS updated_at FROM facts f LEFT JOIN upd u ON f.user_id = u.user_id AND f.fact_key = u.fact_key""",
)(lambda s, d: tables.correct_fact(bind.memory_vectors(s, d), updates(s, d).select("user_id", "fact_key", "fact_value", "fact_embedding", "updated_at")).select(*_OUT))


@query("s3_full_refresh", star("SELECT (SELECT count(*) FROM raw) AS written, (SELECT count(*) FROM raw) AS stored"))
def _(s, d):
    path = fresh_path(s, "raw")
    written = tables.full_refresh(bind.raw_inspections(s, d), path)
    written = tables.full_refresh(bind.raw_inspections(s, d), path)
    return s.read.parquet(path).agg(F.count("*").alias("stored")).withColumn("written", F.lit(written))


_RAW_FIELDS = "camis dba boro building street zipcode phone cuisine_description inspection_date action violation_code violation_description critical_flag score grade grade_date record_date inspection_type latitude longitude community_board council_district census_tract bin bbl nta".split()


@query(
    "s9_load_audit", f"""WITH {RAW} SELECT 'r1' AS run_id, 'COMPLETE' AS event_type, '{NEW}' AS event_time, 'load_inspections' AS job, 'landing/inspections|landing/corrections' AS inputs, 'raw.inspections' AS output,
  '{"|".join(f"{c}:string" for c in _RAW_FIELDS)}|_loaded_at:timestamp_ntz' AS columns, count(*) AS row_count, 'OVERWRITE' AS lifecycle_state FROM raw""",
)
def _(s, d):
    """The row that the load appended to its audit table."""
    path, log = fresh_path(s, "raw"), fresh_path(s, "audit")
    tables.write_audited(bind.raw_inspections(s, d), path, log, "load_inspections", "r1", NEW, [{"namespace": "landing", "name": "inspections"}, {"namespace": "landing", "name": "corrections"}], "raw.inspections")
    audit = s.read.parquet(log)
    return audit.withColumns({
        "inputs": F.transform("inputs", lambda i: F.concat(i["namespace"], F.lit("/"), i["name"])), "columns": F.transform("columns", lambda c: F.concat(c["name"], F.lit(":"), c["type"])),
    })


@query("s11_export_csv", "SELECT c_mktsegment, count(*) AS customers, min(c_name) AS first_name FROM customer GROUP BY 1")
def _(s, d):
    path = fresh_path(s, "csv")
    tables.export_csv(bind.table(s, d, "customer"), path)
    back = s.read.option("header", True).schema("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").csv(path)
    return back.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.min("c_name").alias("first_name"))


query("q7_vector_checks", _FACTS + "SELECT user_id, fact_key, true AS has_embedding, round(sqrt(list_inner_product(v, v)), 4) AS embedding_norm, true AS single_row FROM facts")(
    lambda s, d: Q.vector_checks(bind.memory_vectors(s, d))
)

# -- user facts ----------------------------------------------------------------------

_MESSY = """WITH messy AS (SELECT (p_partkey % 50)::varchar AS user_id, '  ' || p_type || ' ' || p_name || E'\\t' AS fact_key, CASE WHEN p_size % 10 = 0 THEN '  ' ELSE ' ' || p_brand || ' ' END AS fact_value,
  CASE WHEN p_size % 3 = 0 THEN ' LOCATION ' WHEN p_size % 3 = 1 THEN 'colour' END AS category FROM part)"""


def messy(s, d):
    return bind.table(s, d, "part").select(
        (F.col("p_partkey") % 50).cast("string").alias("user_id"), F.concat(F.lit("  "), "p_type", F.lit(" "), "p_name", F.lit("\t")).alias("fact_key"),
        F.when(F.col("p_size") % 10 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" "))).alias("fact_value"),
        F.when(F.col("p_size") % 3 == 0, " LOCATION ").when(F.col("p_size") % 3 == 1, "colour").alias("category"),
    )


_NORMAL = r"SELECT user_id, replace(lower(trim(fact_key, E' \t')), ' ', '_') AS fact_key, trim(fact_value) AS fact_value, CASE WHEN category = ' LOCATION ' THEN 'location' ELSE 'general' END AS category FROM messy WHERE trim(fact_value) <> ''"
query("u1_normalise_facts", _MESSY + _NORMAL)(lambda s, d: U.normalise_facts(messy(s, d)))
_TERMS = r"list_filter(regexp_split_to_array(lower(fact_key || ': ' || fact_value), '[^\p{L}\p{N}]+'), lambda t: t <> '')"


def _vectors(name: str, table: str) -> str:
    """Hashed vectors of a table of facts, as whole ten-thousandths."""
    return f"""{name}_each AS (SELECT user_id, fact_key, term, count(*) AS tf FROM (SELECT user_id, fact_key, unnest({_TERMS}) AS term FROM {table}) GROUP BY ALL),
{name}_rare AS (SELECT term, ln(((SELECT count(*) FROM {table}) + 1)::double / (count(*) + 1)) + 1 AS idf FROM {name}_each GROUP BY 1),
{name}_places AS (SELECT user_id, fact_key, ('0x' || substr(md5(term), 1, 8))::bigint % 64 AS place, sum(tf * idf) AS w FROM {name}_each JOIN {name}_rare USING (term) GROUP BY ALL),
{name} AS (SELECT user_id, fact_key, array_to_string(list_transform(range(64), lambda i: round((coalesce(m[i], 0) / norm)::float * 1000)::bigint), '|') AS vector
  FROM (SELECT user_id, fact_key, map_from_entries(list((place, w))) AS m, sqrt(sum(w * w)) AS norm FROM {name}_places GROUP BY 1, 2))"""


# Stored before: a third of the keys with other values, and keys that the batch does not have.
_STORED = """stored AS (SELECT user_id, fact_key, 'stored value' AS fact_value, 'general' AS category FROM batch WHERE length(fact_key) % 3 = 0
  UNION ALL SELECT user_id, 'only_stored_' || fact_key, 'kept ' || fact_value, category FROM batch WHERE length(fact_key) % 4 = 0)"""


@query(
    "u2_store_facts", _MESSY + f""", n AS ({_NORMAL}), batch AS (SELECT user_id, fact_key, max(fact_value) AS fact_value, arg_max(category, (fact_value, category)) AS category FROM n GROUP BY 1, 2), {_STORED},
{_vectors('bv', 'batch')}, {_vectors('sv', 'stored')}
SELECT user_id, fact_key, coalesce(b.fact_value, s.fact_value) AS fact_value, coalesce(b.category, s.category) AS category, coalesce(bv.vector, sv.vector) AS vector
  FROM batch b FULL JOIN stored s USING (user_id, fact_key) LEFT JOIN bv USING (user_id, fact_key) LEFT JOIN sv USING (user_id, fact_key)""",
)
def _(s, d):
    """A batch into a store that has some of its keys with older values and vectors, and other keys."""
    order = [F.desc("fact_value"), F.desc("category")]
    batch = tables.last_update_wins(U.normalise_facts(messy(s, d)), ["user_id", "fact_key"], order)
    old = batch.filter(F.length("fact_key") % 3 == 0).select("user_id", "fact_key", F.lit("stored value").alias("fact_value"), F.lit("general").alias("category"))
    other = batch.filter(F.length("fact_key") % 4 == 0).select("user_id", F.concat(F.lit("only_stored_"), "fact_key").alias("fact_key"), F.concat(F.lit("kept "), "fact_value").alias("fact_value"), "category")
    after = U.store_facts(U.hashed_vectors(old.unionByName(other)), messy(s, d), order)
    return after.select("user_id", "fact_key", "fact_value", "category", F.transform("fact_embedding", lambda x: F.round(x * 1000).cast("long")).alias("vector"))


query("u3_facts_of_user", _FACTS + "SELECT fact_key, fact_value FROM facts WHERE user_id = '3'")(lambda s, d: U.facts_of(bind.memory_vectors(s, d), "3"))
_HEADER = U.CONTEXT_HEADER.replace("\n", "")
query(
    "u4_context", _FACTS + f"""SELECT u.user_id, CASE WHEN t.user_id IS NULL THEN '' ELSE '{_HEADER}' || E'\\n' || t.lines END AS context
  FROM (SELECT DISTINCT (user_id % 12)::varchar AS user_id FROM events) u LEFT JOIN (SELECT user_id, string_agg('  - ' || replace(fact_key, '_', ' ') || ': ' || fact_value, E'\\n' ORDER BY fact_key) AS lines FROM facts GROUP BY 1) t USING (user_id)""",
)(lambda s, d: U.context_text(bind.table(s, d, "events").select((F.col("user_id") % 12).cast("string").alias("user_id")), bind.memory_vectors(s, d)))

# The bound conversations are invented words: a spoken sentence stands before some turns, chosen by their numbers.
ASKED = [
    "May I ask where do you live?", "Please share your work address.", "And which neighbourhood is it?", "Is there a preferred borough?", "What food do you like?", "Which violation code matters?",
    "Which grade do you track?", "Do you want initial or re-inspection?", "What score threshold should apply?", "How far back do you look?", "And what is your role?", "Please name your company.",
    # Two requests in one turn: the first in the list of patterns counts.
    "What is your role, and your home address?",
]
SAID = [
    "Please forget my home address.", "Remove the office now.", "Delete my neighborhood.", "Clear the borough", "erase my favourite cuisine", "FORGET the violation code", "remove grade A",
    "delete the inspection type", "clear the score cutoff", "forget my time window", "erase my job", "remove my company", "forget the work and home things",
    "What about Queens?", "It is near the park?", "show me the worst", "Compare both", "The address is gone, forgotten", "I like noodles",
]


def _spoken_sql() -> str:
    listed = lambda lines: "[" + ", ".join("'" + x + "'" for x in lines) + "]"
    return f"""spoken AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' AND (conv_id + turn) % {len(ASKED) + 2} < {len(ASKED)} THEN {listed(ASKED)}[(conv_id + turn) % {len(ASKED) + 2} + 1] || ' '
  WHEN role = 'user' AND (conv_id * 3 + turn) % {len(SAID) + 5} < {len(SAID)} THEN {listed(SAID)}[(conv_id * 3 + turn) % {len(SAID) + 5} + 1] || ' ' ELSE '' END || text AS text FROM conversations)"""


_SPOKEN = _spoken_sql()


def _first(column: str, patterns) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '(?i){p.replace(chr(39), chr(39) * 2)}') THEN '{n}'" for n, p in patterns) + " END"


def turns_of(s, d):
    return bind.table(s, d, "conversations")


def spoken(s, d):
    def line(lines, n, more):
        n = n % (len(lines) + more)
        return F.when(n < len(lines), F.concat(F.get(F.array(*map(F.lit, lines)), n.cast("int")), F.lit(" "))).otherwise("")

    said = F.when(F.col("role") == "assistant", line(ASKED, F.col("conv_id") + F.col("turn"), 2)).when(F.col("role") == "user", line(SAID, F.col("conv_id") * 3 + F.col("turn"), 5)).otherwise("")
    return turns_of(s, d).withColumn("text", F.concat(said, "text"))


query("u5_first_match", f"WITH {_SPOKEN} SELECT * FROM (SELECT conv_id, turn, {_first('text', U.REQUEST_PATTERNS)} AS fact_key FROM spoken WHERE role = 'assistant') WHERE fact_key IS NOT NULL")(
    lambda s, d: U.detect_request(spoken(s, d)).select("conv_id", "turn", "fact_key")
)
_CAPTURE = f"""WITH {_SPOKEN}, marked AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'assistant' THEN {_first('text', U.REQUEST_PATTERNS)} END AS k FROM spoken WHERE role IN ('user', 'assistant')),
near AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY turn) AS fact_key FROM marked WHERE role = 'user' OR k IS NOT NULL)
SELECT conv_id, turn, fact_key, text AS fact_value FROM near WHERE role = 'user' AND fact_key IS NOT NULL"""
query("u6_capture_unguarded", _CAPTURE)(lambda s, d: U.capture_facts(spoken(s, d), guard=False))
query("u6_capture", _CAPTURE + f" AND NOT contains(text, '?') AND NOT regexp_matches(trim(text), '(?i){U.QUESTION_STARTERS}')")(lambda s, d: U.capture_facts(spoken(s, d)))
query("u7_detect_delete", f"WITH {_SPOKEN} SELECT * FROM (SELECT conv_id, turn, {_first('text', U.DELETE_PATTERNS)} AS fact_key FROM spoken WHERE role = 'user') WHERE fact_key IS NOT NULL")(
    lambda s, d: U.detect_delete(spoken(s, d)).select("conv_id", "turn", "fact_key")
)


def fact_events(df):
    return df.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("fact_key"), F.when(F.col("value") > 60, U.TOMBSTONE).otherwise(F.col("value").cast("string")).alias("fact_value"),
        F.when(F.col("value") < 10, "delete").otherwise("store").alias("action"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("event_id"),
    )


_FOLD = """SELECT user_id::varchar AS user_id, event_type AS fact_key, value::varchar AS fact_value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id
  FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) WHERE value >= 10 AND value <= 60"""
query("u8_fold", _FOLD)(lambda s, d: U.fold_facts(fact_events(bind.table(s, d, "events")), ["ts", "event_id"]))


def recall_queries(s, d):
    return bind.table(s, d, "embeddings").select(F.col("vec_id").alias("query_id"), (F.col("vec_id") % 12).cast("string").alias("user_id"), "embedding")


_RECALL = _FACTS + """, ranked AS (SELECT q.vec_id AS query_id, f.*, round(list_cosine_similarity(f.v, q.embedding::double[]), 4) + 0.0 AS similarity,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(f.v, q.embedding::double[]), 4) DESC, f.fact_key) AS rank
  FROM embeddings q JOIN facts f ON f.user_id = (q.vec_id % 12)::varchar),
hits AS (SELECT * FROM ranked WHERE rank <= 5 AND similarity >= 0.3)
"""
query("u9_recall", _RECALL + f"SELECT query_id, user_id, fact_key, fact_value, category, {_t('updated_at')}, similarity, rank FROM hits")(
    lambda s, d: U.recall(recall_queries(s, d), bind.memory_vectors(s, d)).select("query_id", "user_id", "fact_key", "fact_value", "category", "updated_at", "similarity", "rank")
)
query(
    "u9_recall_text", _RECALL + """SELECT q.vec_id AS query_id, (q.vec_id % 12)::varchar AS user_id, CASE WHEN q.vec_id % 12 >= 10 THEN 'no_facts' WHEN h.query_id IS NULL THEN 'none_relevant' ELSE 'found' END AS status,
  coalesce('Found ' || n || ' relevant fact(s) for user ' || (q.vec_id % 12) || E':\\n' || lines, '') AS text
  FROM embeddings q LEFT JOIN (SELECT query_id, count(*) AS n, string_agg('- ' || fact_key || ': ' || fact_value || ' (category: ' || category || ', relevance: ' || similarity || ', updated: ' || strftime(updated_at, '%Y-%m-%d %H:%M') || ')', E'\\n' ORDER BY rank) AS lines
    FROM hits GROUP BY 1) h ON h.query_id = q.vec_id""",
)(lambda s, d: U.recall_text(recall_queries(s, d), bind.memory_vectors(s, d)))


@query(
    "u10_similarity_matrix", _FACTS + f"""SELECT user_id, fact_key, fact_value, category, round(list_cosine_similarity(v, (SELECT v FROM facts WHERE vec_id = 0)), 4) + 0.0 AS sim_home, round(list_cosine_similarity(v, (SELECT v FROM facts WHERE vec_id = 1)), 4) + 0.0 AS sim_food,
  {_t('updated_at')} FROM facts""",
)
def _(s, d):
    """Every fact against two probes: the vectors of the two lowest numbers."""
    probes = bind.table(s, d, "embeddings").orderBy("vec_id").limit(2).collect()
    return U.similarity_matrix(bind.memory_vectors(s, d), {"home": probes[0]["embedding"], "food": probes[1]["embedding"]})


_ANSWERS = """WITH answers AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, CASE WHEN turn % 4 <> 3 THEN '2024-01-' || lpad((conv_id % 28 + 1)::varchar, 2, '0') END AS freshness_date,
  CASE WHEN turn % 3 = 0 THEN '' ELSE 'grade IN (A, B) — Final grades only|role = ' || conv_id || ' -- as asked|no dash here' END AS filters,
  CASE WHEN turn % 3 = 0 THEN '' ELSE 'grade IN (A, B)=Final grades only|role = ' || conv_id || '=as asked|no dash here=' END AS filter_parts,
  trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS body FROM answers"""


@query("u11_parse_answers", _ANSWERS)
def _(s, d):
    """Assistant turns dressed with a date line and a filter block."""
    conv = F.col("conv_id")
    date = F.when(F.col("turn") % 4 != 3, F.concat(F.lit("📅 Data through: 2024-01-"), F.lpad((conv % 28 + 1).cast("string"), 2, "0"), F.lit("\n"))).otherwise("")
    block = F.when(F.col("turn") % 3 != 0, F.concat(F.lit("🔍 Filters applied:\n   - grade IN (A, B) — Final grades only\n - role = "), conv, F.lit(" -- as asked\n– no dash here \n\n"))).otherwise("")
    dressed = turns_of(s, d).filter("role = 'assistant'").withColumn("text", F.concat(date, block, "text"))
    parsed = U.parse_answers(dressed).withColumn("filter_parts", F.transform("filter_parts", lambda p: F.concat(p["condition"], F.lit("="), F.coalesce(p["reason"], F.lit("")))))
    return parsed.select("conv_id", "turn", "freshness_date", "filters", "filter_parts", "body")


@query(
    "u12_geo_intent", """SELECT event_id, event_type IN ('view', 'purchase') AS is_geo, CASE WHEN event_type <> 'error' THEN round(40.5::double + (user_id % 400) / 1000.0::double, 3) END AS latitude,
  CASE WHEN event_type <> 'error' THEN round(-74.2::double + (user_id * 7 % 500) / 1000.0::double, 3) END AS longitude FROM events""",
)
def _(s, d):
    """A question and a generated SQL text per event."""
    question = F.when(F.col("event_type") == "view", "what is Near my home?").when(F.col("event_type") == "purchase", "show closures on a MAP").when(F.col("event_type") == "click", "nearly all grades, mapped").otherwise("worst grades")
    user = F.col("user_id")
    point = F.concat(F.lit("SELECT ST_DISTANCE(p, ST_MAKEPOINT( "), F.round((user * 7 % 500 - 74200) / 1000.0, 3).cast("string"), F.lit(" ,"), F.round((user % 400 + 40500) / 1000.0, 3).cast("string"), F.lit(")) < 804"))
    texts = bind.table(s, d, "events").select("event_id", question.alias("q"), F.when(F.col("event_type") != "error", point).otherwise("SELECT 1").alias("sql"))
    found = texts.select("event_id", U.geo_intent(F.col("q")).alias("is_geo"), U.sql_point(F.col("sql")).alias("p"))
    return found.select("event_id", "is_geo", "p.latitude", "p.longitude")


_PLACES_SQL = """WITH told AS (SELECT c_custkey::varchar AS user_id, n_name || ' street 1' AS address, r.r_name AS address_place, b.r_name AS borough
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey JOIN region b ON b.r_regionkey = c_custkey % 5)
SELECT user_id, 'home_address' AS fact_key_a, address AS fact_value_a, address_place AS place_a, 'home_borough' AS fact_key_b, borough AS fact_value_b, borough AS place_b FROM told WHERE address_place <> borough"""


@query("u13_conflicts", _PLACES_SQL)
def _(s, d):
    """Customers' nation as address, some region as borough; places by name from the nation and region tables."""
    regions = bind.table(s, d, "region")
    places = bind.table(s, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("place"))
    places = places.unionByName(regions.select(F.col("r_name").alias("name"), F.col("r_name").alias("place")))
    customers = bind.table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), "c_custkey", "c_nationkey")
    address = customers.join(bind.table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("user_id", F.lit("home_address").alias("fact_key"), F.concat("n_name", F.lit(" street 1")).alias("fact_value"))
    borough = customers.join(bind.table(s, d, "region"), F.col("c_custkey") % 5 == F.col("r_regionkey")).select("user_id", F.lit("home_borough").alias("fact_key"), F.col("r_name").alias("fact_value"))
    return U.conflicts(address.unionByName(borough), places, ["home_address", "home_borough"])


# -- test runs ------------------------------------------------------------------------

_RUNS = """WITH base AS (SELECT doc_id, doc_id::varchar AS question_id, 'quality_' || quality AS category, ['analyst', 'search', 'memory'][1:doc_id % 3 + 1] AS e,
  CASE doc_id % 4 WHEN 0 THEN ['analyst', 'search'] WHEN 1 THEN ['memory', 'search', 'analyst'] ELSE ['analyst', 'search', 'memory'][1:doc_id % 3 + 1] END AS a, CASE WHEN doc_id % 11 <> 0 THEN toxic = 0 END AS passed FROM labels),
runs AS (SELECT 'run_1' AS run_id, 'original' AS agent, base.* FROM base UNION ALL SELECT 'run_2', 'memory', doc_id, question_id, category, e, a, CASE WHEN doc_id % 7 = 0 THEN NOT passed ELSE passed END FROM base)
"""
query(
    "e1_scorecard", _RUNS + """SELECT run_id, category, count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE passed IS NULL) AS skipped,
  round(100.0::double * count(*) FILTER (WHERE passed) / count(passed), 1) AS pass_rate FROM runs GROUP BY 1, 2""",
)(lambda s, d: E.scorecard(bind.test_runs(s, d)))
query(
    "e2_tool_match", _RUNS + """SELECT run_id, question_id, array_to_string(list_filter(e, lambda x: NOT list_contains(a, x)), '|') AS missing_tools, array_to_string(list_filter(a, lambda x: NOT list_contains(e, x)), '|') AS extra_tools,
  list_sort(e) = list_sort(a) AS same_tools, e = a AS same_order FROM runs""",
)(lambda s, d: E.tool_match(bind.test_runs(s, d)).select("run_id", "question_id", "missing_tools", "extra_tools", "same_tools", "same_order"))
query("e3_overuse", _RUNS + "SELECT run_id, question_id, 'memory' AS fired_tools FROM runs WHERE category = 'quality_1' AND list_contains(a, 'memory')")(
    lambda s, d: E.overuse(bind.test_runs(s, d), ["quality_1"], ["memory"]).select("run_id", "question_id", "fired_tools")
)
query(
    "e4_regression", _RUNS + """SELECT question_id, x.passed AS before, y.passed AS after, CASE WHEN x.passed IS NULL OR y.passed IS NULL THEN 'open' WHEN NOT x.passed AND y.passed THEN 'fixed' WHEN x.passed AND NOT y.passed THEN 'broken' ELSE 'unchanged' END AS change
  FROM (SELECT * FROM runs WHERE run_id = 'run_1') x FULL JOIN (SELECT * FROM runs WHERE run_id = 'run_2') y USING (question_id)""",
)(lambda s, d: E.regression(bind.test_runs(s, d), "run_1", "run_2"))
query(
    "e5_compare_agents", _RUNS + """SELECT category, round(100.0::double * count(*) FILTER (WHERE passed AND agent = 'original') / count(passed) FILTER (WHERE agent = 'original'), 1) AS pass_rate_original,
  round(100.0::double * count(*) FILTER (WHERE passed AND agent = 'memory') / count(passed) FILTER (WHERE agent = 'memory'), 1) AS pass_rate_memory FROM runs GROUP BY 1""",
)(lambda s, d: E.compare_agents(bind.test_runs(s, d), ["original", "memory"]))

# -- streams: the same rows as a stream give the batch result ---------------------------


def stream_of(s, d):
    """The events table as a file stream."""
    schema = bind.table(s, d, "events").schema
    return s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query(
    "x1_hourly_usage", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type AS agent_name, count(*) AS total_requests, sum(round(value * 100)::bigint)::bigint AS total_tokens, round(sum(value), 6) AS total_credits
  FROM events GROUP BY 1, 2""",
)
def _(s, d):
    usage = stream_of(s, d).select(
        F.col("ts").cast("timestamp").alias("start_time"), F.col("event_type").alias("agent_name"), F.round(F.col("value") * 100).cast("long").alias("tokens"), F.col("value").alias("token_credits")
    )
    out, check = fresh_path(s, "hourly"), fresh_path(s, "hourly-checkpoint")
    X.write_updates(X.hourly_usage(usage), out, check).awaitTermination()
    return X.latest_values(s, out, ["hour", "agent_name"]).withColumn("total_credits", F.round("total_credits", 6))


@query("x2_stream_dedupe", "SELECT event_type, count(*) AS events, round(sum(value), 6) AS value FROM events GROUP BY 1")
def _(s, d):
    """Every record is delivered twice; one of each is kept."""
    once = stream_of(s, d)
    twice = once.unionByName(stream_of(s, d)).withColumn("seen", F.col("ts").cast("timestamp"))
    out, check = fresh_path(s, "dedupe"), fresh_path(s, "dedupe-checkpoint")
    kept = X.dedupe_stream(twice, ["event_id"], "seen")
    kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 6).alias("value"))


@query("x3_fact_state", _FOLD)
def _(s, d):
    out, check = fresh_path(s, "fact-state"), fresh_path(s, "fact-state-checkpoint")
    X.fact_state_stream(fact_events(stream_of(s, d)), out, check, ["ts", "event_id"]).awaitTermination()
    return X.fact_state(s, check, ["ts", "event_id"])
