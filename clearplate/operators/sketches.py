"""Distinct counts and quantiles by sketches that are stored once and merged per request.

A HyperLogLog sketch of 2^HLL_LOG2 registers counts distinct values with a relative standard
error of 1.04 / sqrt(2^HLL_LOG2), 1.6 %. A KLL sketch of KLL_K gives a quantile whose rank is
within KLL_RANK_ERROR of the one asked for, with 99 % confidence. Both have a bounded size
whatever they have seen, and merging loses nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_LOG2 = 12
HLL_ERROR = 1.04 / 2 ** (HLL_LOG2 / 2)
KLL_K = 200
KLL_RANK_ERROR = 0.0165


def distinct_sketch(value: str | Column) -> Column:
    return F.hll_sketch_agg(value, F.lit(HLL_LOG2))


def merge_distinct(sketch: str | Column) -> Column:
    return F.hll_union_agg(sketch)


def quantile_sketch(value: str | Column) -> Column:
    """NULL values are not seen."""
    value = F.col(value) if isinstance(value, str) else value
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_K))


def merge_quantile(sketch: str | Column) -> Column:
    return F.kll_merge_agg_double(sketch)


def quantile_of(sketch: str | Column, q: float) -> Column:
    """NULL for a sketch that has seen nothing."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def estimate(kind: str, sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch) if kind == "hll" else quantile_of(sketch, 0.5)


def daily(fact: DataFrame, day: str, by: Sequence[str], distinct: Mapping[str, str], quantiles: Mapping[str, str]) -> DataFrame:
    """A row per day and group, with the sketches of its rows: the table to keep.

    ``distinct`` and ``quantiles`` map the sketch's name to the expression it has seen. A new
    day is new rows; no earlier row changes.
    """
    sketches = [distinct_sketch(F.expr(e)).alias(n) for n, e in distinct.items()] + [quantile_sketch(F.expr(e)).alias(n) for n, e in quantiles.items()]
    return fact.groupBy(F.col(day).alias("day"), *by).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def over(kept: DataFrame, by: Sequence[str], first: str | None, last: str | None, distinct: Sequence[str] = (), medians: Sequence[str] = ()) -> DataFrame:
    """Estimates over the days ``first`` to ``last`` (either may be open), by any of the kept groups: no row of the fact is read."""
    for bound, rule in ((first, lambda d: F.col("day") >= d), (last, lambda d: F.col("day") <= d)):
        if bound is not None:
            kept = kept.filter(rule(F.lit(bound).cast("date")))
    merged = kept.groupBy(*by).agg(F.sum("rows").alias("rows"), *[merge_distinct(n).alias(n) for n in distinct], *[merge_quantile(n).alias(n) for n in medians])
    return merged.select(*by, "rows", *[estimate("hll", n).alias(n) for n in distinct], *[estimate("kll", n).alias(n) for n in medians])
