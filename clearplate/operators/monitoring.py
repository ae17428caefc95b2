"""Usage, cost, latency, audit and feedback reports.

Every report takes ``as_of``, the end of its window (itself outside), and the window's
days, and reads only the columns it sums. Reports without a first-k limit come unordered
where they list rows: the caller sorts what it shows. Money is credits times a price per credit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.functions.cast import millis_between, percent, seconds_between
from clearplate.functions.latest import neighbour

# Fixed values.
PRICE_PER_CREDIT = 3.00
WINDOW_DAYS = 30
LOGIN_WINDOW_DAYS = 7
AI_SERVICES = ["AI_SERVICES", "AI_INFERENCE"]
FEEDBACK_RECORD = "AGENT_FEEDBACK"
CREDIT_COUNTERS = ["input", "output", "cache_read_input", "cache_write_input"]
STEM_LENGTH = 80


def _within(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """Rows of the ``days`` days before ``as_of``; ``as_of`` itself is outside."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return df.filter((F.col(column) >= end - F.make_dt_interval(days=F.lit(days))) & (F.col(column) < end))


def _day(column: str) -> Column:
    return F.to_date(column)


def _cost(credits: Column) -> Column:
    return F.round(credits * PRICE_PER_CREDIT, 4)


def _rows() -> Column:
    return F.count(F.lit(1))


# -- usage and cost ------------------------------------------------------------


def daily_usage(usage: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return (
        _within(usage, "start_time", as_of, days).groupBy(_day("start_time").alias("usage_date"), "agent_name")
        .agg(
            _rows().alias("total_requests"), F.sum("tokens").alias("total_tokens"), F.sum("token_credits").alias("total_credits"),
            _cost(F.sum("token_credits")).alias("estimated_cost_usd"), F.round(F.sum("tokens") / _rows(), 0).alias("avg_tokens_per_request"),
        )
        .orderBy(F.desc("usage_date"), "agent_name")
    )


def load_payloads(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write records with each JSON column parsed once, as a VARIANT ``<column>_v`` beside its text.

    Text that is no JSON has no variant. Questions over the stored table read fields of the
    variant and parse nothing.
    """
    df.withColumns({f"{c}_v": F.try_parse_json(c) for c in columns}).write.mode("overwrite").parquet(path)


def _payload(df: DataFrame, column: str) -> Column:
    """The variant of a JSON column: as stored, else parsed here."""
    return F.col(f"{column}_v") if f"{column}_v" in df.columns else F.try_parse_json(column)


def nested_credits(usage: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Credits by service and model out of the nested payload.

    Array, request, service, model: one explode per level. Only the payload and the day
    enter the explodes. A scalar beside the services (the start time) yields no rows; it
    is also named, as its key is known.
    """
    rows = _within(usage, "start_time", as_of, days).select(_day("start_time").alias("usage_date"), _payload(usage, "credits_granular").alias("payload"))
    flat = rows
    for source, level in [("payload", "arr"), ("arr.value", "req"), ("req.value", "svc"), ("svc.value", "mdl")]:
        inner = rows.sparkSession.tvf.variant_explode(F.col(source).outer()).select(F.struct("key", "value").alias(level))
        flat = flat.lateralJoin(inner)
    counter = lambda name: F.coalesce(F.try_variant_get("mdl.value", f"$.{name}", "decimal(38,0)"), F.lit(0))
    counters = reduce(lambda a, b: a + b, map(counter, CREDIT_COUNTERS))
    return (
        flat.filter(F.col("svc.key") != "start_time")
        .groupBy("usage_date", F.col("svc.key").alias("service_type"), F.col("mdl.key").alias("model"))
        .agg(F.sum(counters).cast("long").alias("total_credits"))
        .orderBy(F.desc("usage_date"), "service_type", "model")
    )


def latency(usage: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    took = millis_between(F.col("start_time"), F.col("end_time"))
    return (
        _within(usage, "start_time", as_of, days).groupBy(_day("start_time").alias("usage_date"))
        .agg(_rows().alias("requests"), F.round(F.avg(took) / 1000.0, 1).alias("avg_latency_sec"), F.round(F.max(took) / 1000.0, 1).alias("max_latency_sec"))
        .orderBy(F.desc("usage_date"))
    )


def user_cost(usage: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return (
        _within(usage, "start_time", as_of, days).groupBy("user_name")
        .agg(_rows().alias("total_requests"), F.sum("token_credits").alias("credits_consumed"), _cost(F.sum("token_credits")).alias("estimated_cost_usd"))
        .orderBy(F.desc_nulls_last("credits_consumed"), "user_name")
    )


def search_credits(search: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return _within(search, "usage_date", as_of, days).select("usage_date", "service_name", "consumption_type", "credits")


def service_rollup(metering: DataFrame, as_of: str, services: Sequence[str] = tuple(AI_SERVICES), by_day: bool = True, days: int = WINDOW_DAYS) -> DataFrame:
    """Credits per service type of a list, by day or over the whole window."""
    group = (["usage_date"] if by_day else []) + ["service_type"]
    out = _within(metering.filter(F.col("service_type").isin(list(services))), "usage_date", as_of, days).groupBy(*group).agg(
        F.sum("credits_used").alias("credits_used"), _cost(F.sum("credits_used")).alias("estimated_cost_usd")
    )
    return out.orderBy(*([F.desc("usage_date"), "service_type"] if by_day else [F.desc("credits_used"), "service_type"]))


def compute_daily(metering: DataFrame, as_of: str, warehouse: str, days: int = WINDOW_DAYS) -> DataFrame:
    return (
        _within(metering.filter(F.col("warehouse_name") == warehouse), "start_time", as_of, days)
        .groupBy(_day("start_time").alias("usage_date"), "warehouse_name")
        .agg(F.sum("credits_used").alias("credits_used"), _cost(F.sum("credits_used")).alias("estimated_cost_usd"))
        .orderBy(F.desc("usage_date"))
    )


def cost_categories(compute: DataFrame, usage: DataFrame, search: DataFrame, as_of: str, warehouse: str, days: int = WINDOW_DAYS) -> DataFrame:
    def line(df: DataFrame, name: str, column: str) -> DataFrame:
        total = F.sum(column)
        return df.agg(F.round(total, 6).alias("total_credits"), _cost(total).alias("estimated_cost_usd")).select(F.lit(name).alias("cost_category"), "*")

    return (
        line(_within(compute.filter(F.col("warehouse_name") == warehouse), "start_time", as_of, days), "warehouse_compute", "credits_used")
        .unionByName(line(_within(usage, "start_time", as_of, days), "agent", "token_credits"))
        .unionByName(line(_within(search, "usage_date", as_of, days), "search", "credits"))
        .orderBy(F.desc_nulls_last("total_credits"))
    )


# -- audit -----------------------------------------------------------------------


def password_only_logins(logins: DataFrame, as_of: str, days: int = LOGIN_WINDOW_DAYS) -> DataFrame:
    weak = (F.col("first_authentication_factor") == "PASSWORD") & F.col("second_authentication_factor").isNull()
    return (
        _within(logins.filter(weak), "event_timestamp", as_of, days)
        .select("user_name", "event_timestamp", "reported_client_type", "is_success", "error_message", "client_ip")
    )


def password_only_users(logins: DataFrame, as_of: str, days: int = LOGIN_WINDOW_DAYS) -> DataFrame:
    return (
        password_only_logins(logins, as_of, days).groupBy("user_name")
        .agg(_rows().alias("login_attempts"), F.max("event_timestamp").alias("last_attempt"), F.bool_or(~F.col("is_success")).alias("had_failure"))
        .orderBy(F.desc("login_attempts"), "user_name")
    )


def users_without_key(users: DataFrame) -> DataFrame:
    return (
        users.filter(F.col("has_password") & ~F.col("has_rsa_public_key") & ~F.col("disabled"))
        .select("name", "login_name", "has_password", "has_rsa_public_key", "disabled")
    )


# -- feedback --------------------------------------------------------------------


def _ratings() -> list[Column]:
    up, down = F.count_if(F.col("rating") == "up"), F.count_if(F.col("rating") == "down")
    return [_rows().alias("total_ratings"), up.alias("thumbs_up"), down.alias("thumbs_down"), F.round(percent(up, _rows()), 1).alias("satisfaction_pct")]


def satisfaction(feedback: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return _within(feedback, "created_at", as_of, days).agg(*_ratings())


def satisfaction_trend(feedback: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return _within(feedback, "created_at", as_of, days).groupBy(_day("created_at").alias("feedback_date")).agg(*_ratings()).orderBy(F.desc("feedback_date"))


def satisfaction_by_user(feedback: DataFrame, as_of: str, at_least: int = 3, days: int = WINDOW_DAYS) -> DataFrame:
    out = _within(feedback, "created_at", as_of, days).groupBy("user_id").agg(*_ratings())
    return out.filter(F.col("total_ratings") >= at_least).orderBy("satisfaction_pct", F.desc("total_ratings"), "user_id")


def negative_turns(feedback: DataFrame, k: int = 100) -> DataFrame:
    """Newest negative turns, with the seconds since the previous negative turn of the session."""
    down = feedback.filter(F.col("rating") == "down")
    newest = F.broadcast(
        down.select("created_at", "user_id", "session_id", "turn_index", "question", "answer", "feedback_id")
        .orderBy(F.desc("created_at"), "feedback_id").limit(k)
    )
    # Only the sessions of the k kept rows need a look back, and their text stays out of it.
    slim = down.select("feedback_id", "session_id", "turn_index", "created_at").join(newest.select("session_id").distinct(), "session_id", "left_semi")
    gaps = neighbour(slim, ["session_id"], "turn_index", {"_prev": "created_at"}, step=-1, tie=["feedback_id"])
    gaps = gaps.select("feedback_id", seconds_between(F.col("_prev"), F.col("created_at")).alias("seconds_since_prev_turn"))
    return gaps.join(newest, "feedback_id").select(
        "created_at", "user_id", "session_id", "turn_index", "question", "answer", "seconds_since_prev_turn"
    ).orderBy(F.desc("created_at"))


def question_stems(feedback: DataFrame, at_least: int = 2) -> DataFrame:
    """Negative questions that begin alike."""
    down = feedback.filter((F.col("rating") == "down") & F.col("question").isNotNull())
    stem = F.left(F.trim("question"), F.lit(STEM_LENGTH)).alias("question_prefix")
    out = down.groupBy(stem).agg(
        _rows().alias("negative_ratings"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"), F.count_distinct("user_id").alias("distinct_users")
    )
    return out.filter(F.col("negative_ratings") >= at_least).orderBy(F.desc("negative_ratings"), F.desc("last_seen"), "question_prefix")


def cost_and_quality(feedback: DataFrame, usage: DataFrame, as_of: str, raw_join: bool = False, days: int = WINDOW_DAYS) -> DataFrame:
    """Ratings beside the usage of the same user and hour.

    Both sides are summed before they meet. ``raw_join`` gives the numbers of a row-by-row
    join, in which n ratings and m requests make n times m rows: they follow from the sums.
    """
    hour = lambda c: F.date_trunc("hour", F.col(c)).cast("timestamp_ntz")
    rated = _within(feedback, "created_at", as_of, days).groupBy("user_id", "session_id", hour("created_at").alias("session_hour")).agg(
        _rows().alias("n"), F.count_if(F.col("rating") == "down").alias("down"), F.count_if(F.col("rating") == "up").alias("up")
    )
    # Only usage in hours that a rating of the window can fall into.
    end = F.lit(as_of).cast("timestamp_ntz")
    first, last = F.date_trunc("hour", end - F.make_dt_interval(days=F.lit(days))), end + F.make_dt_interval(hours=F.lit(1))
    used = usage.filter((F.col("start_time") >= first) & (F.col("start_time") < last)).groupBy(F.col("user_name").alias("user_id"), hour("start_time").alias("session_hour")).agg(
        _rows().alias("m"), F.sum("tokens").alias("tokens"), F.sum("token_credits").alias("credits")
    )
    both = rated.join(used, ["user_id", "session_hour"], "left")
    tokens, credits = F.coalesce("tokens", F.lit(0)), F.coalesce("credits", F.lit(0.0))
    ratings_factor = F.greatest(F.coalesce("m", F.lit(1)), F.lit(1)) if raw_join else F.lit(1)
    usage_factor = F.col("n") if raw_join else F.lit(1)
    return both.select(
        "user_id", "session_id", "session_hour", (F.col("n") * ratings_factor).alias("rated_turns"), (F.col("down") * ratings_factor).alias("thumbs_down"),
        F.round(percent(F.col("up"), F.col("n")), 1).alias("satisfaction_pct"), (tokens * usage_factor).alias("tokens_in_window"),
        _cost(credits * usage_factor).alias("estimated_cost_usd"),
    ).orderBy(F.desc("thumbs_down"), F.desc("tokens_in_window"), "user_id", "session_id", "session_hour")


# -- platform records --------------------------------------------------------------


def _attribute(df: DataFrame, column: str, path: str) -> Column:
    return F.try_variant_get(_payload(df, column), path, "string")


def platform_feedback(events: DataFrame, k: int = 50) -> DataFrame:
    given = events.filter(F.col("record_name") == FEEDBACK_RECORD)
    named = {"user_id": "$.user_id", "feedback_sentiment": "$.feedback"}
    attributes = [_attribute(events, "record_attributes", p).alias(n) for n, p in named.items()]
    out = given.select(F.col("timestamp").alias("event_time"), *attributes, F.col("record_attributes").alias("raw_attributes"))
    return out.orderBy(F.desc("event_time"), "user_id").limit(k)


def platform_feedback_daily(events: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    rows = _within(events.filter(F.col("record_name") == FEEDBACK_RECORD), "timestamp", as_of, days)
    return (
        rows.groupBy(_day("timestamp").alias("event_date"), _attribute(events, "record_attributes", "$.feedback").alias("sentiment"))
        .agg(_rows().alias("count")).orderBy(F.desc("event_date"), "sentiment")
    )


def requests_with_feedback(requests: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    given = F.try_variant_get(_payload(requests, "feedback"), "$[0]", "variant").isNotNull()
    return (
        _within(requests.filter(F.col("feedback").isNotNull() & given), "timestamp", as_of, days)
        .select("timestamp", "user_id", "semantic_model_name", "latest_question", "generated_sql", "response_status_code", "feedback")
    )


def agent_requests(requests: DataFrame, as_of: str, k: int = 200, days: int = WINDOW_DAYS) -> DataFrame:
    """Newest requests that carry the id of the agent that made them."""
    linked = requests.withColumn("agent_request_id", _attribute(requests, "source", "$.agent_request_id")).filter("agent_request_id IS NOT NULL")
    return (
        _within(linked, "timestamp", as_of, days).orderBy(F.desc("timestamp"), "agent_request_id").limit(k)
        .select("timestamp", "user_id", "latest_question", "generated_sql", "agent_request_id", "response_status_code", "feedback")
    )


def fact_store_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("user_id").agg(_rows().alias("total_facts"), F.min("created_at").alias("first_stored"), F.max("updated_at").alias("last_updated"))


# -- dashboard tiles -----------------------------------------------------------------


def tile_daily(usage: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    out = _within(usage, "start_time", as_of, days).groupBy(_day("start_time").alias("usage_date"))
    return out.agg(_rows().alias("total_requests"), F.round(F.sum("token_credits"), 6).alias("total_credits")).orderBy("usage_date")


def tile_by_service(metering: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return service_rollup(metering, as_of, by_day=False, days=days).withColumn("credits_used", F.round("credits_used", 6))


def tile_serving(search: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    return search_credits(search, as_of, days).select("usage_date", "consumption_type", "credits")
