"""Registered queries: usage, cost, audit and feedback reports.

Fixed values: the output columns of the reports, and the window lengths in their module.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clearplate.operators import monitoring as O
from clearplate.registry.base import ORACLES, query
from clearplate.session import fresh_path
from clearplate.sources import bind

# Windows lie inside the data, so both of their ends leave rows out.
END, DAYS = bind.EVENTS_AS_OF, 10
RATED_END, RATED_DAYS = "2024-01-04", 2
_T = f"TIMESTAMP '{END} 00:00:00'"


def _between(c: str, end: str, days: int) -> str:
    return f"({c} >= TIMESTAMP '{end} 00:00:00' - INTERVAL {days} DAY AND {c} < TIMESTAMP '{end} 00:00:00')"


def _in(c: str) -> str:
    return _between(c, END, DAYS)


_RATED_IN = _between("created_at", RATED_END, RATED_DAYS)

# The bound tables in SQL.
_K = "CAST(json_extract_string(props, '$.k') AS bigint)"
_BOUND = f"""WITH usage AS (SELECT event_id, user_id::varchar AS user_name, event_type AS agent_name, ts AS start_time, ts + to_milliseconds(round(value * 100)::bigint) AS end_time,
  round(value * 100)::bigint AS tokens, value AS token_credits, {_K} AS k FROM events),
search AS (SELECT CAST(ts AS date) AS usage_date, 'svc_' || (user_id % 4) AS service_name, CASE WHEN event_type = 'signup' THEN 'embed_text_tokens' ELSE 'SERVING' END AS consumption_type, value AS credits, event_id FROM events),
metering AS (SELECT CAST(ts AS date) AS usage_date, CASE event_type WHEN 'view' THEN 'AI_SERVICES' WHEN 'click' THEN 'AI_INFERENCE' ELSE 'WAREHOUSE_METERING' END AS service_type, value AS credits_used FROM events),
compute AS (SELECT ts AS start_time, 'WH_' || (user_id % 3) AS warehouse_name, value AS credits_used FROM events),
logins AS (SELECT event_id, user_id::varchar AS user_name, ts AS event_timestamp, event_type AS reported_client_type, event_type <> 'error' AS is_success,
  CASE WHEN event_type = 'error' THEN 'FAILED' END AS error_message, '10.0.0.' || (user_id % 256) AS client_ip, CASE WHEN user_id % 2 <> 0 THEN 'TOTP' END AS second_factor FROM events),
feedback AS (SELECT a.conv_id || '-' || a.turn AS feedback_id, (a.conv_id % 150)::varchar AS user_id, a.conv_id::varchar AS session_id, a.turn AS turn_index, q.text AS question, a.text AS answer,
  CASE WHEN length(a.text) % 3 = 0 THEN 'down' ELSE 'up' END AS rating, TIMESTAMP '2024-01-01 00:00:00' + to_minutes((a.conv_id * 60 + a.turn)::bigint) AS created_at
  FROM conversations a LEFT JOIN conversations q ON q.conv_id = a.conv_id AND q.turn = a.turn - 1 WHERE a.role = 'assistant')
"""


def o(name, sql, build):
    query(name, None if sql is None else sql if sql.startswith(_BOUND) else _BOUND + sql)(build)


def r6(df, *columns):
    """Sums of doubles depend on the order of addition; six places are the same in any order."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


_DAY = "CAST(CAST(start_time AS date) AS varchar) AS usage_date"
o(
    "o01_daily_usage", f"""SELECT {_DAY}, agent_name, count(*) AS total_requests, sum(tokens)::bigint AS total_tokens, round(sum(token_credits), 6) AS total_credits,
  round(sum(token_credits) * 3.0::double, 4) AS estimated_cost_usd, round(sum(tokens)::double / count(*), 0) AS avg_tokens_per_request FROM usage WHERE {_in("start_time")} GROUP BY 1, 2""",
    lambda s, d: r6(O.daily_usage(bind.usage(s, d), END, days=DAYS), "total_credits"),
)
o(
    "o02_nested_credits", f"""SELECT {_DAY}, agent_name AS service_type, 'm' || (k % 3) AS model, (sum(k) + sum(round(token_credits)))::bigint AS total_credits
  FROM usage WHERE {_in("start_time")} GROUP BY 1, 2, 3""",
    lambda s, d: O.nested_credits(bind.usage(s, d), END, days=DAYS),
)
o(
    "o03_latency", f"""SELECT {_DAY}, count(*) AS requests, round(avg(date_diff('millisecond', start_time, end_time)) / 1000.0::double, 1) AS avg_latency_sec,
  round(max(date_diff('millisecond', start_time, end_time)) / 1000.0::double, 1) AS max_latency_sec FROM usage WHERE {_in("start_time")} GROUP BY 1""",
    lambda s, d: O.latency(bind.usage(s, d), END, days=DAYS),
)
o(
    "o04_user_cost", f"""SELECT user_name, count(*) AS total_requests, round(sum(token_credits), 6) AS credits_consumed, round(sum(token_credits) * 3.0::double, 4) AS estimated_cost_usd
  FROM usage WHERE {_in("start_time")} GROUP BY 1""", lambda s, d: r6(O.user_cost(bind.usage(s, d), END, days=DAYS), "credits_consumed"),
)
o(
    "o05_search_credits", f"SELECT CAST(usage_date AS varchar) AS usage_date, service_name, consumption_type, credits FROM search WHERE {_in("usage_date")}",
    lambda s, d: O.search_credits(bind.search_usage(s, d), END, days=DAYS),
)
_SERVICE = f"round(sum(credits_used), 6) AS credits_used, round(sum(credits_used) * 3.0::double, 4) AS estimated_cost_usd FROM metering WHERE service_type IN ('AI_SERVICES', 'AI_INFERENCE') AND {_in("usage_date")}"
o("o06_service_rollup", f"SELECT CAST(usage_date AS varchar) AS usage_date, service_type, {_SERVICE} GROUP BY 1, 2", lambda s, d: r6(O.service_rollup(bind.service_metering(s, d), END, days=DAYS), "credits_used"))
o(
    "o07_compute_daily", f"""SELECT {_DAY}, warehouse_name, round(sum(credits_used), 6) AS credits_used, round(sum(credits_used) * 3.0::double, 4) AS estimated_cost_usd
  FROM compute WHERE warehouse_name = 'WH_1' AND {_in("start_time")} GROUP BY 1, 2""", lambda s, d: r6(O.compute_daily(bind.compute_metering(s, d), END, "WH_1", days=DAYS), "credits_used"),
)
_CATEGORIES = f"""SELECT 'warehouse_compute' AS cost_category, round(sum(credits_used), 6) AS total_credits, round(sum(credits_used) * 3.0::double, 4) AS estimated_cost_usd FROM compute WHERE warehouse_name = 'WH_1' AND {_in("start_time")}
  UNION ALL SELECT 'agent', round(sum(token_credits), 6), round(sum(token_credits) * 3.0::double, 4) FROM usage WHERE {_in("start_time")}
  UNION ALL SELECT 'search', round(sum(credits), 6), round(sum(credits) * 3.0::double, 4) FROM search WHERE {_in("usage_date")}"""


def _categories(s, d):
    return O.cost_categories(bind.compute_metering(s, d), bind.usage(s, d), bind.search_usage(s, d), END, "WH_1", days=DAYS)


o("o08_cost_categories", _CATEGORIES, _categories)
_WEAK = f"second_factor IS NULL AND event_timestamp >= {_T} - INTERVAL 7 DAY AND event_timestamp < {_T}"
o(
    "o09_login_audit", f"""SELECT user_name, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp, reported_client_type, is_success, error_message, client_ip FROM logins WHERE {_WEAK}""",
    lambda s, d: O.password_only_logins(bind.logins(s, d), END),
)
o(
    "o09_login_audit_by_user", f"""SELECT user_name, count(*) AS login_attempts, strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') AS last_attempt, bool_or(NOT is_success) AS had_failure
  FROM logins WHERE {_WEAK} GROUP BY 1""", lambda s, d: O.password_only_users(bind.logins(s, d), END),
)
o(
    "o10_users_without_key", """SELECT c_name AS name, lower(c_name) AS login_name, true AS has_password, false AS has_rsa_public_key, false AS disabled
  FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0 AND c_custkey % 5 <> 0""", lambda s, d: O.users_without_key(bind.users(s, d)),
)
_RATED = """count(*) AS total_ratings, count(*) FILTER (WHERE rating = 'up') AS thumbs_up, count(*) FILTER (WHERE rating = 'down') AS thumbs_down,
  round(100.0::double * count(*) FILTER (WHERE rating = 'up') / count(*), 1) AS satisfaction_pct"""
o("o11_satisfaction", f"SELECT {_RATED} FROM feedback WHERE {_RATED_IN}", lambda s, d: O.satisfaction(bind.feedback(s, d), RATED_END, days=RATED_DAYS))
_TREND = f"SELECT CAST(CAST(created_at AS date) AS varchar) AS feedback_date, {_RATED} FROM feedback WHERE {_RATED_IN} GROUP BY 1"
o("o12_trend", _TREND, lambda s, d: O.satisfaction_trend(bind.feedback(s, d), RATED_END, days=RATED_DAYS))
o("o13_by_user", f"SELECT user_id, {_RATED} FROM feedback WHERE {_RATED_IN} GROUP BY 1 HAVING count(*) >= 3", lambda s, d: O.satisfaction_by_user(bind.feedback(s, d), RATED_END, days=RATED_DAYS))
o(
    "o14_negative_gaps", """SELECT strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, user_id, session_id, turn_index, question, answer,
  date_diff('second', lag(created_at) OVER (PARTITION BY session_id ORDER BY turn_index), created_at) AS seconds_since_prev_turn, feedback_id
  FROM feedback WHERE rating = 'down' ORDER BY feedback.created_at DESC, feedback_id LIMIT 100""".replace(", feedback_id\n", "\n"),
    lambda s, d: O.negative_turns(bind.feedback(s, d)),
)
o(
    "o15_stems", """SELECT left(trim(question), 80) AS question_prefix, count(*) AS negative_ratings, strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_seen, count(DISTINCT user_id) AS distinct_users FROM feedback WHERE rating = 'down' AND question IS NOT NULL GROUP BY 1 HAVING count(*) >= 1""",
    lambda s, d: O.question_stems(bind.feedback(s, d), at_least=1),
)
_HOURS = f"""SELECT f.user_id, f.session_id, strftime(f.h, '%Y-%m-%d %H:%M:%S') AS session_hour, n AS rated_turns, down AS thumbs_down, round(100.0::double * up / n, 1) AS satisfaction_pct,
  coalesce(tokens, 0)::bigint AS tokens_in_window, round(coalesce(credits, 0) * 3.0::double, 4) AS estimated_cost_usd
  FROM (SELECT user_id, session_id, date_trunc('hour', created_at) AS h, count(*) AS n, count(*) FILTER (WHERE rating = 'down') AS down, count(*) FILTER (WHERE rating = 'up') AS up
    FROM feedback WHERE {_RATED_IN} GROUP BY 1, 2, 3) f
  LEFT JOIN (SELECT user_name, date_trunc('hour', start_time) AS h, sum(tokens) AS tokens, sum(token_credits) AS credits FROM usage GROUP BY 1, 2) u ON u.user_name = f.user_id AND u.h = f.h"""
o("o16_cost_quality", _HOURS, lambda s, d: O.cost_and_quality(bind.feedback(s, d), bind.usage(s, d), RATED_END, days=RATED_DAYS))
o(
    "o16_cost_quality_raw_join", f"""SELECT f.user_id, f.session_id, strftime(date_trunc('hour', f.created_at), '%Y-%m-%d %H:%M:%S') AS session_hour, count(f.feedback_id) AS rated_turns,
  sum(CASE WHEN f.rating = 'down' THEN 1 ELSE 0 END)::bigint AS thumbs_down, round(100.0::double * sum(CASE WHEN f.rating = 'up' THEN 1 ELSE 0 END) / count(*), 1) AS satisfaction_pct,
  coalesce(sum(u.tokens), 0)::bigint AS tokens_in_window, round(coalesce(sum(u.token_credits), 0) * 3.0::double, 4) AS estimated_cost_usd
  FROM feedback f LEFT JOIN usage u ON u.user_name = f.user_id AND date_trunc('hour', u.start_time) = date_trunc('hour', f.created_at)
  WHERE {_between("f.created_at", RATED_END, RATED_DAYS)} GROUP BY f.user_id, f.session_id, date_trunc('hour', f.created_at)""",
    lambda s, d: O.cost_and_quality(bind.feedback(s, d), bind.usage(s, d), RATED_END, days=RATED_DAYS, raw_join=True),
)
_SENTIMENT = "CASE WHEN value > 50 THEN 'negative' ELSE 'positive' END"
o(
    "o17_platform_feedback", f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, 'u' || user_id AS user_id, {_SENTIMENT} AS feedback_sentiment,
  '{{"user_id":"u' || user_id || '","feedback":"' || {_SENTIMENT} || '"}}' AS raw_attributes FROM events WHERE event_type IN ('click', 'purchase') ORDER BY ts DESC, 'u' || user_id LIMIT 50""",
    lambda s, d: O.platform_feedback(bind.observability(s, d)),
)
o(
    "o17_platform_feedback_daily", f"""SELECT CAST(CAST(ts AS date) AS varchar) AS event_date, {_SENTIMENT} AS sentiment, count(*) AS count FROM events
  WHERE event_type IN ('click', 'purchase') AND {_in("ts")} GROUP BY 1, 2""", lambda s, d: O.platform_feedback_daily(bind.observability(s, d), END, days=DAYS),
)
_REQUEST = f"""strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, user_id::varchar AS user_id, 'question ' || {_K} AS latest_question, 'select ' || {_K} AS generated_sql,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END::bigint AS response_status_code"""
o(
    "o18_requests_with_feedback", f"""SELECT {_REQUEST}, 'inspections' AS semantic_model_name, '[{{"positive":' || ({_K} % 2 = 0)::varchar || '}}]' AS feedback FROM events WHERE event_type = 'click' AND {_in("ts")}""",
    lambda s, d: O.requests_with_feedback(bind.analyst_requests(s, d), END, days=DAYS),
)
o(
    "o18_agent_requests", f"""SELECT {_REQUEST}, 'r' || event_id AS agent_request_id, CAST(NULL AS varchar) AS feedback FROM events WHERE event_type = 'purchase' AND {_in("ts")}
  ORDER BY ts DESC, 'r' || event_id LIMIT 200""", lambda s, d: O.agent_requests(bind.analyst_requests(s, d), END, days=DAYS),
)


def stored(s, d, records, *columns):
    """Records of a data folder as loaded, with their payloads as variants."""
    path = fresh_path(s, "payloads")
    O.load_payloads(records(s, d), path, columns)
    return s.read.parquet(path)


# The same questions over stored payloads.
o("o02_nested_credits_stored", ORACLES["o02_nested_credits"], lambda s, d: O.nested_credits(stored(s, d, bind.usage, "credits_granular"), END, days=DAYS))
o("o17_platform_feedback_stored", ORACLES["o17_platform_feedback"], lambda s, d: O.platform_feedback(stored(s, d, bind.observability, "record_attributes")))
o("o17_platform_feedback_daily_stored", ORACLES["o17_platform_feedback_daily"], lambda s, d: O.platform_feedback_daily(stored(s, d, bind.observability, "record_attributes"), END, days=DAYS))
o("o18_requests_with_feedback_stored", ORACLES["o18_requests_with_feedback"], lambda s, d: O.requests_with_feedback(stored(s, d, bind.analyst_requests, "feedback", "source"), END, days=DAYS))
o("o18_agent_requests_stored", ORACLES["o18_agent_requests"], lambda s, d: O.agent_requests(stored(s, d, bind.analyst_requests, "feedback", "source"), END, days=DAYS))
o("o19_tile_daily", f"SELECT {_DAY}, count(*) AS total_requests, round(sum(token_credits), 6) AS total_credits FROM usage WHERE {_in("start_time")} GROUP BY 1", lambda s, d: O.tile_daily(bind.usage(s, d), END, days=DAYS))
o("o19_tile_by_service", f"SELECT service_type, {_SERVICE} GROUP BY 1", lambda s, d: O.tile_by_service(bind.service_metering(s, d), END, days=DAYS))
o("o19_tile_serving", f"SELECT CAST(usage_date AS varchar) AS usage_date, consumption_type, credits FROM search WHERE {_in("usage_date")}", lambda s, d: O.tile_serving(bind.search_usage(s, d), END, days=DAYS))
o(
    "o20_fact_stats", """SELECT (vec_id % 10)::varchar AS user_id, count(*) AS total_facts, strftime(min(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(vec_id)), '%Y-%m-%d %H:%M:%S') AS first_stored,
  strftime(max(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(vec_id)), '%Y-%m-%d %H:%M:%S') AS last_updated FROM embeddings GROUP BY 1""", lambda s, d: O.fact_store_stats(bind.memory_vectors(s, d)),
)
