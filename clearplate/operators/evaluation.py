"""Scorecards over recorded test runs (run_id, agent, question_id, category, expected_tools, actual_tools, passed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearplate.functions.cast import percent

# The tools that must stay silent on plain data questions.
MEMORY_TOOLS = ["store_user_memory", "retrieve_user_memories"]


def scorecard(results: DataFrame, by: Sequence[str] = ("run_id", "category")) -> DataFrame:
    """Totals per group; a question without an outcome is skipped and counts in the total."""
    passed, failed = F.count_if("passed"), F.count_if(~F.col("passed"))
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), passed.alias("passed"), failed.alias("failed"), F.count_if(F.col("passed").isNull()).alias("skipped"),
        F.round(percent(passed, passed + failed), 1).alias("pass_rate"),
    )


def tool_match(results: DataFrame) -> DataFrame:
    """Expected against observed tools: missing, extra, same set, same order."""
    e, a = F.col("expected_tools"), F.col("actual_tools")
    missing, extra = F.array_except(e, a), F.array_except(a, e)
    return results.withColumns({
        "missing_tools": missing, "extra_tools": extra, "same_tools": (F.size(missing) == 0) & (F.size(extra) == 0), "same_order": e == a,
    })


def overuse(results: DataFrame, categories: Sequence[str], tools: Sequence[str] = tuple(MEMORY_TOOLS)) -> DataFrame:
    """Questions of categories in which these tools must not run, yet did."""
    fired = F.array_intersect("actual_tools", F.array(*map(F.lit, tools)))
    return results.filter(F.col("category").isin(list(categories))).withColumn("fired_tools", fired).filter(F.size("fired_tools") > 0)


def regression(results: DataFrame, before: str, after: str) -> DataFrame:
    """Outcome of each question in two runs: fixed, broken, unchanged, added, removed or open.

    The runs are laid over each other by grouping: one row per question, no join.
    """
    runs = results.filter(F.col("run_id").isin(before, after))
    in_run = lambda run: F.col("run_id") == run
    both = runs.groupBy("question_id").agg(
        F.count_if(in_run(before)).alias("_b"), F.count_if(in_run(after)).alias("_a"),
        F.bool_and(F.when(in_run(before), F.col("passed"))).alias("before"), F.bool_and(F.when(in_run(after), F.col("passed"))).alias("after"),
    )
    b, a = F.col("before"), F.col("after")
    change = (
        F.when(F.col("_b") == 0, "added").when(F.col("_a") == 0, "removed").when(b.isNull() | a.isNull(), "open")
        .when(~b & a, "fixed").when(b & ~a, "broken").otherwise("unchanged")
    )
    return both.select("question_id", "before", "after", change.alias("change"))


def compare_agents(results: DataFrame, agents: Sequence[str]) -> DataFrame:
    """Pass rate per category, one column per agent."""
    rates = results.groupBy("category", "agent").agg(percent(F.count_if("passed"), F.count_if(F.col("passed").isNotNull())).alias("rate"))
    wide = rates.groupBy("category").pivot("agent", list(agents)).agg(F.round(F.max("rate"), 1))
    return wide.select("category", *[F.col(a).alias(f"pass_rate_{a}") for a in agents])
