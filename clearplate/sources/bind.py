"""Adapters that present the benchmark tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.sources.schemas import LOADED_AT, RAW_COLUMNS

AS_OF = "2001-03-15"
EVENTS_AS_OF = "2024-01-20"

# What each order status and priority stands for in the bound records.
ACTIONS = {
    "F": "Establishment Closed by DOHMH. Violations were cited in the following area(s) and those requiring immediate action were addressed.",
    "O": "Violations were cited in the following area(s).",
    "P": "No violations were recorded at the time of this inspection.",
}
INSPECTION_TYPES = {
    "1-URGENT": "Cycle Inspection / Initial Inspection",
    "2-HIGH": "Cycle Inspection / Re-Inspection",
    "3-MEDIUM": "Pre-permit (Operational) / Initial Inspection",
    "4-NOT SPECIFIED": "Pre-permit (Operational) / Re-Inspection",
}
GRADES = ["A", "A", "A", "B", "C", "Z", ""]
# Rows of a landed table that one task takes: some 100 to 200 MB as records or pages, or as the postings of texts.
LANDED_ROWS = {"lineitem": 400_000, "documents": 5_000, "pages": 20_000}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table as a load would leave it: spread by ``key`` over parts of bounded size."""
    return spread(table(spark, sf_dir, name), landed_parts(spark, sf_dir, name), key)


def landed_parts(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Parts of a landed table: one for each core at least, and more with more rows, so that no part outgrows a task."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, name).count() // LANDED_ROWS[name]))


def spread(df: DataFrame, parts: int, key: str) -> DataFrame:
    """Rows dealt to ``parts`` by ``key``.

    The given tables are one file with one row group each, which is one task for a scan and
    all that follows it. A landing zone has many files; this stands for it and is part of no operator.
    """
    return df.repartition(parts, key)


def _mapped(values: dict[str, str], c: str):
    out = F.lit(None).cast("string")
    for key, value in values.items():
        out = F.when(F.col(c) == key, value).otherwise(out)
    return out


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as all-string inspection records.

    Customers are joined to orders, of which there are fewer than lines; the lines meet them
    last, so the wide records are made in the parts of the landed table and moved by no join.
    What a record takes of a number or a time is cut out before it is moved, and names of the
    nation and region (tables of fixed size) are added where the record is made.
    """
    t = lambda name: table(spark, sf_dir, name)
    orders = (
        t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("ordered"), "o_orderpriority")
        .join(t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .drop("o_custkey")
    )
    named = (
        t("lineitem").select("l_orderkey", "l_partkey", (F.col("l_suppkey") % 3).cast("int").alias("hours"), "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"))
        .join(t("part").select("p_partkey", F.concat_ws(" ", "p_type", "p_brand").alias("described")), F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_linenumber", "hours", "described", F.when(F.col("l_partkey") % 37 == 0, "").otherwise(F.col("quantity").cast("string")).alias("scored"))
    )
    parts = landed_parts(spark, sf_dir, "lineitem")  # the same on both sides, or the join would deal the lines anew
    lines = (
        spread(named, parts, "l_orderkey").join(spread(orders, parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    cust, order, line = F.col("c_custkey"), F.col("l_orderkey"), F.col("l_linenumber")
    iso = lambda d: F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00.000"))
    flag = (order + line) % 3
    grade = F.element_at(F.array(*map(F.lit, GRADES)), (order % 7 + 1).cast("int"))

    def coordinate(value):
        return F.when(cust % 23 == 0, None).when(cust % 29 == 0, "bad").otherwise(value.cast("string"))

    made = {
        "camis": cust.cast("string"),
        "dba": F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")),
        "boro": F.when(cust % 19 == 0, "0").otherwise(F.upper("r_name")),  # '0' stands for an unknown one
        "building": F.when(cust % 17 != 0, (cust % 500).cast("string")),
        "street": F.concat(F.upper("n_name"), F.lit(" STREET")),
        "zipcode": F.when(cust % 31 == 0, "10025-1234").otherwise(F.col("c_nationkey").cast("string")),
        "cuisine_description": F.when(cust % 13 == 0, "CAFE/COFFEE/TEA").otherwise(F.upper("c_mktsegment")),
        "inspection_date": iso(F.col("ordered")),
        "action": _mapped(ACTIONS, "o_orderstatus"),
        "violation_code": F.when(
            ~((order % 41 == 0) & (line == 7)),
            F.concat(F.lpad((order % 25).cast("string"), 2, "0"), F.substr(F.lit("ABCDEFG"), line, F.lit(1))),
        ),
        "violation_description": F.col("described"),
        "critical_flag": F.when(flag == 0, " critical").when(flag == 1, "Not Critical").otherwise("Not Applicable"),
        "score": F.col("scored"),
        "grade": grade,
        "grade_date": iso(F.date_add("ordered", 14)),
        "record_date": iso(F.date_add("ordered", 30)),
        "inspection_type": _mapped(INSPECTION_TYPES, "o_orderpriority"),
        "latitude": coordinate((cust % 400 + 40500) / F.lit(1000.0)),
        "longitude": coordinate((cust * 7 % 500 - 74200) / F.lit(1000.0)),
    }
    loaded = F.timestamp_add("HOUR", F.col("hours"), F.lit("2001-08-02 00:00:00").cast("timestamp_ntz"))
    columns = [made.get(c, F.lit(None)).cast("string").alias(c) for c in RAW_COLUMNS]
    return lines.select(*columns, loaded.alias(LOADED_AT))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places to search around."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("point_id"), ((key % 400 + 40500) / F.lit(1000.0)).alias("point_lat"), ((key * 7 % 500 - 74200) / F.lit(1000.0)).alias("point_lon"),
    )


def result_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as result-set events: one row each, nested in a block on even lines, beside an item to skip."""
    names = ["RESTAURANT_NAME", "BOROUGH", "LATITUDE", "LONGITUDE", "INSPECTION_SCORE"]
    head = '{"event":"response.table","data":{"result_set":{"resultSetMetaData":{"numRows":1,"rowType":[' + ",".join(f'{{"name":"{n}"}}' for n in names) + ']},"data":["skip",'
    raw = raw_inspections(spark, sf_dir)
    row = F.to_json(F.array(F.upper(F.trim("dba")), "boro", "latitude", "longitude", "score"))
    nested = F.col("violation_code").rlike("[BDF]$")
    block = F.when(nested, F.concat(F.lit("["), row, F.lit("]"))).otherwise(row)
    return raw.select(F.concat(F.lit(head), block, F.lit("]}}}")).alias("payload"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as agent requests with a nested credit payload."""
    k = F.get_json_object("props", "$.k").cast("long")
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("user_id").cast("string").alias("user_name"),
        F.col("event_type").alias("agent_name"),
        F.col("ts").cast("timestamp_ntz").alias("start_time"),
        (F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.round(value * 100).cast("long") / 1000).cast("decimal(18,6)"))).alias("end_time"),
        F.round(value * 100).cast("long").alias("tokens"),
        value.alias("token_credits"),
        F.concat(
            F.lit('[{"'), F.col("event_id"), F.lit('":{"'), F.col("event_type"), F.lit('":{"m'), (k % 3).cast("string"),
            F.lit('":{"input":'), k.cast("string"), F.lit(',"output":'), value.cast("string"),
            F.lit('}},"start_time":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}}]'),
        ).alias("credits_granular"),
        k.alias("k"),
    )


def search_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("usage_date"), F.concat(F.lit("svc_"), F.col("user_id") % 4).alias("service_name"),
        F.when(F.col("event_type") == "signup", "embed_text_tokens").otherwise("SERVING").alias("consumption_type"),
        F.col("value").alias("credits"), F.col("event_id").alias("row_id"),
    )


def service_metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.when(F.col("event_type") == "view", "AI_SERVICES").when(F.col("event_type") == "click", "AI_INFERENCE").otherwise("WAREHOUSE_METERING")
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("usage_date"), kinds.alias("service_type"), F.col("value").alias("credits_used"))


def compute_metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("start_time"),
        F.concat(F.lit("WH_"), F.col("user_id") % 3).alias("warehouse_name"), F.col("value").alias("credits_used"),
    )


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id"), F.col("user_id").cast("string").alias("user_name"), F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("event_type").alias("reported_client_type"), (F.col("event_type") != "error").alias("is_success"),
        F.when(F.col("event_type") == "error", "FAILED").alias("error_message"),
        F.concat(F.lit("10.0.0."), F.col("user_id") % 256).alias("client_ip"),
        F.lit("PASSWORD").alias("first_authentication_factor"),
        F.when(F.col("user_id") % 2 != 0, "TOTP").alias("second_authentication_factor"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.lower("c_name").alias("login_name"), (F.col("c_custkey") % 2 == 0).alias("has_password"),
        (F.col("c_custkey") % 3 == 0).alias("has_rsa_public_key"), (F.col("c_custkey") % 5 == 0).alias("disabled"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as rated answers to the turn before them."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    minute = F.timestamp_add("MINUTE", (F.col("conv_id") * 60 + F.col("turn")).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return turns.filter(F.col("role") == "assistant").join(asked, ["conv_id", "turn"], "left").select(
        F.concat_ws("-", "conv_id", "turn").alias("feedback_id"), (F.col("conv_id") % 150).cast("string").alias("user_id"),
        F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("turn_index"), "question", F.col("text").alias("answer"),
        F.when(F.length("text") % 3 == 0, "down").otherwise("up").alias("rating"), minute.alias("created_at"),
    )


def observability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as platform log records with nested attributes (JSON text)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id"), F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("event_type").isin("click", "purchase"), "AGENT_FEEDBACK").otherwise("AGENT_REQUEST").alias("record_name"),
        F.concat(F.lit('{"user_id":"u'), F.col("user_id"), F.lit('","feedback":"'), F.when(F.col("value") > 50, "negative").otherwise("positive"), F.lit('"}')).alias("record_attributes"),
    )


def analyst_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as generated-SQL requests; some carry feedback or the id of a calling agent."""
    k = F.get_json_object("props", "$.k").cast("long")
    event = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id"), F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("user_id").cast("string").alias("user_id"),
        F.lit("inspections").alias("semantic_model_name"), F.concat(F.lit("question "), k).alias("latest_question"),
        F.concat(F.lit("select "), k).alias("generated_sql"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("response_status_code"),
        F.when(F.col("event_type") == "click", F.concat(F.lit('[{"positive":'), (k % 2 == 0).cast("string"), F.lit("}]")))
        .when(F.col("event_type") == "view", "[]").alias("feedback"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"agent_request_id":"r'), event, F.lit('"}'))).otherwise("{}").alias("source"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-page sources."""
    return landed(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id"), F.col("source").alias("source_url"), F.col("lang").alias("doc_type"), F.col("source").alias("doc_label"),
        F.lit(1).alias("page_number"), F.col("text").alias("page_text"),
    )


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages."""
    return landed(spark, sf_dir, "pages", "page_id")


def manual_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of one manual per source, some with appendix and section headings."""
    n = F.col("doc_id") % 13
    heading = (
        F.when(n == 0, "APPENDIX 23-A\nINSPECTION WORKSHEET\n").when(n == 4, "Appendix 23-B\nGuide to Conditions\nFood Source\n")
        .when(n == 7, "APPENDIX 23-C PENALTY SCHEDULE\n").when(n == 10, "APPENDIX 23-C\nUNSCORED VIOLATIONS\n")
        .when(n == 2, "Food Protection\n").when(n == 8, "General Violations\n").when(n == 11, "Other Criticals\n").otherwise("")
    )
    return landed(spark, sf_dir, "documents", "doc_id").select(
        F.col("source").alias("doc_id"), F.col("doc_id").alias("page_number"), F.concat(heading, F.col("text")).alias("page_text")
    )


def manual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as table rows, in the three layouts in turn, on the page of the document with that number."""
    key, n = F.col("p_partkey"), F.col("p_partkey") % 3
    code = F.concat(F.lpad((key % 25).cast("string"), 2, "0"), F.substr(F.lit("ABCDEFG"), (key % 7 + 1).cast("int"), F.lit(1)))
    mark = F.when(key % 2 == 0, "*").when(key % 5 == 0, "+").otherwise("")
    worksheet = F.array(F.concat(code, mark, F.lit("\n"), F.col("p_type")), F.when(key % 4 == 0, "- – 9 — 28").otherwise(""), F.when(key % 6 != 0, "7 8 9 10 28"))
    guide = F.array(code, F.concat("p_type", F.lit("\nin "), "p_brand"), F.lit("slight amount seen"), F.lit("—"), F.concat(F.lit("more than "), F.col("p_size"), F.lit(" seen")))
    penalty = F.array(F.when(key % 9 == 0, "none").otherwise(code), F.concat(F.lit("§81."), F.col("p_size")), F.when(key % 2 == 0, F.col("p_brand")), F.col("p_type"), F.lit("$200"), F.lit("-"), F.concat(F.lit("$"), F.col("p_size") * 10))
    return table(spark, sf_dir, "part").select(
        key.alias("page_number"), F.lit(1).alias("position"),
        F.when(n == 0, "worksheet").when(n == 1, "guide").otherwise("penalty").alias("layout"),
        F.when(n == 0, worksheet).when(n == 1, guide).otherwise(penalty).alias("cells"),
    )


def code_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as short passages that name violation codes."""
    letter = lambda n: F.substr(F.lit("ABCDEFG"), (n % 7 + 1).cast("int"), F.lit(1))
    code = lambda a, b: F.concat(F.lpad((a % 25).cast("string"), 2, "0"), letter(b))
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    text = F.concat(F.lit("Codes "), code(order, part), F.lit("*, "), code(part, supp), F.lit("+ and "), code(order, part), F.lit("; also "), code(supp, order), F.lit("."))
    return landed(spark, sf_dir, "lineitem", "l_orderkey").select(F.concat_ws("-", order, F.col("l_linenumber"), part, supp).alias("doc_id"), text.alias("chunk_text"))


def search_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the vector of the same number, where there is one."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    docs = landed(spark, sf_dir, "documents", "doc_id").select("doc_id", F.col("text").alias("chunk_text"), F.col("lang").alias("doc_type"), F.col("source").alias("doc_label"))
    return docs.join(vectors, "doc_id", "left")


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as queries, each with the vector of its number."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return table(spark, sf_dir, "benchmark").join(vectors, "item_id", "left").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), "embedding")


def memory_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as stored user facts."""
    categories = F.array(*map(F.lit, ["location", "preference", "identity", "analytical", "general"]))
    made = F.timestamp_add("MINUTE", F.col("vec_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 10).cast("string").alias("user_id"), F.concat(F.lit("fact_"), "vec_id").alias("fact_key"),
        F.concat(F.lit("value "), "vec_id").alias("fact_value"), F.element_at(categories, (F.col("label") % 5 + 1).cast("int")).alias("category"),
        F.col("embedding").alias("fact_embedding"), F.concat(F.lit("turn "), "vec_id").alias("source_turn"), F.lit(1.0).alias("confidence"),
        made.alias("created_at"), made.alias("updated_at"),
    )


def test_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as two runs of a question suite; the second run flips every seventh outcome."""
    labels = table(spark, sf_dir, "labels")
    q = F.col("doc_id")
    tools = F.array(F.lit("analyst"), F.lit("search"), F.lit("memory"))
    base = labels.select(
        q.cast("string").alias("question_id"), F.concat(F.lit("quality_"), "quality").alias("category"),
        F.slice(tools, 1, (q % 3 + 1).cast("int")).alias("expected_tools"),
        F.when(q % 4 == 0, F.slice(tools, 1, 2)).when(q % 4 == 1, F.reverse(tools)).otherwise(F.slice(tools, 1, (q % 3 + 1).cast("int"))).alias("actual_tools"),
        F.when(q % 11 != 0, F.col("toxic") == 0).alias("passed"),
    )
    first = base.withColumns({"run_id": F.lit("run_1"), "agent": F.lit("original")})
    flipped = F.when(F.col("question_id").cast("long") % 7 == 0, ~F.col("passed")).otherwise(F.col("passed"))
    second = base.withColumns({"run_id": F.lit("run_2"), "agent": F.lit("memory"), "passed": flipped})
    return first.unionByName(second)
