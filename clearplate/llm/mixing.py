"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Token counts are summed by source, language and topic. The cells' weights are raked in
turn to the three targets; each cell's rate is its weight over its tokens, and a document
is sampled with its cell's rate, scaled to a share of all tokens and at most 1. The draw of
a document is a number made from its id, so a run repeated gives the same sample.

Everything is DataFrame expressions. Raking runs on the cells, of which there are as many
as combinations of the three columns, and reads no document; only whole-table totals (one
row) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearplate.llm.base import SPACE, filled, pack, query, table
from clearplate.session import written

MARGINS = ("source", "lang", "topic")
# Targets are token shares to these powers: 1 keeps a margin as it is, 0 makes it even.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.9}
ROUNDS = 12
BUDGET = 0.6
SEED = 7
FILLS = 12


def n_tokens(text: str = "text") -> Column:
    """Words of a text; null and blank texts have none."""
    trimmed = F.trim(filled(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACE}+"))).cast("long")


def topic(text: str = "text") -> Column:
    """A coarse topic by what a text holds; the first that applies."""
    t = filled(text)
    return F.when(t.rlike("Licensed under|Copyright|SPDX-"), "licence").when(t.contains("@"), "contact").when(t.contains(" | "), "list").otherwise("prose")


def _key(c: str) -> Column:
    """Null is a category of its own."""
    return F.to_json(F.struct(F.col(c).alias("v")))


def cell_rates(counts: DataFrame, powers: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, budget: float = BUDGET) -> DataFrame:
    """``source, lang, topic, tokens, prob`` by cell from rows ``source, lang, topic, n_tokens``.

    A margin's target comes from ``targets`` (columns: the margin and ``weight``) or else is
    its token count to the power in ``powers``. Cells without tokens get the mean rate.
    """
    powers = powers or POWERS
    cells = written(counts.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goal = cells
    for m in MARGINS:
        if targets and m in targets:
            given = targets[m].select(_key(m).alias(m), F.col("weight").cast("double").alias(f"t_{m}"))
            goal = goal.join(given, m, "left").fillna(0.0, [f"t_{m}"])
        else:
            goal = goal.withColumn(f"t_{m}", F.pow(F.sum("tokens").over(Window.partitionBy(m)).cast("double"), F.lit(powers[m])))
    now = goal.withColumn("w", F.col("tokens").cast("double"))
    for k in range(rounds):
        for m in MARGINS:
            total = F.sum("w").over(Window.partitionBy(m))
            now = now.withColumn("w", F.when(total > 0, F.col("w") * F.col(f"t_{m}") / total).otherwise(F.lit(0.0)))
        if k % 3 == 2 or k == rounds - 1:
            now = written(now, "raked")
    # The scale at which min(1, scale * rate) keeps the budgeted tokens: full cells are set apart until none is added.
    everything = now.agg(F.sum("tokens")).first()[0] or 0
    scale, full = 0.0, F.lit(False)
    for _ in range(FILLS):
        taken, rest = now.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("w")))).first()
        if not rest:
            break
        left = budget * everything - float(taken or 0)
        if left <= 0 or left / rest <= scale:
            break
        scale = left / rest
        full = F.col("w") * scale >= F.col("tokens")
    prob = F.when(F.col("tokens") == 0, F.lit(budget)).otherwise(F.least(F.lit(1.0), F.col("w") * F.lit(scale) / F.col("tokens")))
    return written(now.select(*MARGINS, "tokens", prob.alias("prob")), "rates")


def draw(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A number in [0, 1) made from the id; null draws like the empty id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic_of: Column | None = None, **options) -> DataFrame:
    """One row per document: ``doc_id, source, lang, topic, n_tokens, prob, kept``.

    Null sources, languages and topics are categories of their own. A category whose target
    weight is zero is not sampled. Documents without tokens are sampled at the overall
    rate. Rows that repeat an id share its draw. An empty table gives no rows. Columns of
    other names are ignored.
    """
    topic_of = topic(text) if topic_of is None else topic_of
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("s"), F.col(lang).alias("l"), topic_of.alias("t"), n_tokens(text).alias("n_tokens"))
    slim = written(slim.select("*", _key("s").alias("source"), _key("l").alias("lang"), _key("t").alias("topic")), "tokens")
    rates = cell_rates(slim, **options).select(*MARGINS, "prob")
    joined = slim.join(rates, list(MARGINS))
    return joined.select("doc_id", F.col("s").alias("source"), F.col("l").alias("lang"), F.col("t").alias("topic"), "n_tokens", "prob", (draw() < F.col("prob")).alias("kept"))


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", **options) -> DataFrame:
    """The documents that ``mix`` keeps, with all their columns; columns of any name pass through.

    The rates are joined to the documents by cell, so no text is shuffled while the cells
    are small enough for Spark to broadcast by their measured size.
    """
    slim = docs.select(F.col(source).alias("s"), F.col(lang).alias("l"), topic(text).alias("t"), n_tokens(text).alias("n_tokens"))
    rates = cell_rates(slim.select(_key("s").alias("source"), _key("l").alias("lang"), _key("t").alias("topic"), "n_tokens"), **options)
    rates = rates.select(F.concat_ws("\x1f", *MARGINS).alias("cell"), "prob")
    marked = pack(docs, cell=F.concat_ws("\x1f", _key(source), _key(lang), F.to_json(F.struct(topic(text).alias("v")))), u=draw(doc_id))
    return marked.join(rates, "cell").filter(F.col("u") < F.col("prob")).select("doc.*")


def _sql() -> str:
    key = {m: m for m in MARGINS}
    steps = [
        r"""d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, source, lang,
  CASE WHEN regexp_matches(t, 'Licensed under|Copyright|SPDX-') THEN 'licence' WHEN contains(t, '@') THEN 'contact' WHEN contains(t, ' | ') THEN 'list' ELSE 'prose' END AS topic,
  len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_tokens FROM d),
c AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM n GROUP BY ALL)""",
        "w0 AS (SELECT *, tokens::DOUBLE AS w, " + ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {key[m]})::DOUBLE, {POWERS[m]}) AS t_{m}" for m in MARGINS) + " FROM c)",
    ]
    k = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            steps.append(f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {m}) > 0 THEN w * t_{m} / sum(w) OVER (PARTITION BY {m}) ELSE 0 END AS w) FROM w{k})")
            k += 1
    steps.append("f0 AS (SELECT 0.0::DOUBLE AS scale)")
    for i in range(FILLS):
        full = f"(f{i}.scale > 0 AND w * f{i}.scale >= tokens)"
        steps.append(
            f"f{i + 1} AS MATERIALIZED (SELECT CASE WHEN r > 0 AND ({BUDGET} * a - coalesce(q, 0)) / r > s THEN ({BUDGET} * a - coalesce(q, 0)) / r ELSE s END AS scale FROM "
            f"(SELECT sum(tokens)::DOUBLE AS a, sum(CASE WHEN {full} THEN tokens END)::DOUBLE AS q, sum(CASE WHEN NOT {full} THEN w END) AS r, any_value(f{i}.scale) AS s FROM w{k}, f{i}))"
        )
    steps.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens = 0 THEN {BUDGET} ELSE least(1.0, w * scale / tokens) END AS prob FROM w{k}, f{FILLS})")
    draw = f"(('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0)"
    on = " AND ".join(f"n.{m} IS NOT DISTINCT FROM p.{m}" for m in MARGINS)
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, n.source, n.lang, n.topic, n_tokens, round(prob, 6) AS prob, {draw} < prob AS kept FROM n JOIN p ON {on}"


@query("op6_mixing", _sql())
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).withColumn("prob", F.round("prob", 6))
