"""Declared checks over tables, as one small report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.functions.vector import l2_norm

# Fixed values accepted by the declared checks; NULL always passes.
GRADES = ["A", "B", "C", "Z", "P", "G", "N"]
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "Missing", "0"]


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted
    table: str
    column: str
    values: tuple = ()


def unique(table: str, *columns: str) -> list[Check]:
    return [Check("unique", table, c) for c in columns]


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def accepted(table: str, column: str, values: Sequence[str]) -> list[Check]:
    return [Check("accepted", table, column, tuple(values))]


def mart_suite(boroughs: Sequence[str] = tuple(BOROUGHS)) -> list[Check]:
    """The checks declared on staging and marts."""
    return [
        *not_null("stg_inspections", "restaurant_id", "inspection_date"),
        *accepted("stg_inspections", "borough", boroughs),
        *unique("dim_restaurant", "dim_restaurant_key", "restaurant_id"),
        *not_null("dim_restaurant", "dim_restaurant_key", "restaurant_id"),
        *unique("dim_violation_type", "dim_violation_key", "violation_code"),
        *not_null("dim_violation_type", "dim_violation_key", "violation_code"),
        *unique("dim_date", "calendar_date", "date_key"),
        *not_null("dim_date", "calendar_date", "date_key"),
        *unique("fct_inspections", "fct_inspection_key"),
        *not_null("fct_inspections", "fct_inspection_key", "dim_restaurant_key"),
        *accepted("fct_inspections", "grade", GRADES),
        *unique("fct_violations", "fct_violation_key"),
        *not_null("fct_violations", "fct_violation_key", "dim_restaurant_key"),
    ]


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_rows(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(values)))


def _failing(check: Check):
    c = F.col(check.column)
    return F.count_if(c.isNull()) if check.kind == "not_null" else F.count_if(~c.isin(list(check.values)))


def check_all(suite: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check, table, column, failing_rows). All row checks of a table share one scan; each unique check is one grouping."""
    reports = []
    for name in dict.fromkeys(c.table for c in suite):
        df = tables[name]
        row_checks = [c for c in suite if c.table == name and c.kind != "unique"]
        if row_checks:
            counts = df.agg(*[_failing(c).alias(f"f{i}") for i, c in enumerate(row_checks)])
            lines = [F.struct(F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"), F.col(f"f{i}").alias("failing_rows")) for i, c in enumerate(row_checks)]
            reports.append(counts.select(F.explode(F.array(*lines)).alias("l")).select("l.check", F.lit(name).alias("table"), "l.column", "l.failing_rows"))
        for c in (c for c in suite if c.table == name and c.kind == "unique"):
            total = duplicate_keys(df, c.column).agg(F.count(F.lit(1)).alias("failing_rows"))
            reports.append(total.select(F.lit("unique").alias("check"), F.lit(name).alias("table"), F.lit(c.column).alias("column"), "failing_rows"))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def coverage(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean of each column and the share of rows in which it is present, per group."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"avg_{c}"), F.avg(F.col(c).isNotNull().cast("double")).alias(f"share_{c}")]
    return df.groupBy(*by).agg(*aggs)


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """Documents, chunks, mean words and last load per document type."""
    return chunks.groupBy("doc_type").agg(
        F.count_distinct("source_url").alias("documents"),
        F.count(F.lit(1)).alias("chunks"),
        F.round(F.avg("word_count"), 0).alias("avg_words_per_chunk"),
        F.max("loaded_at").alias("last_loaded"),
    )


def vector_checks(facts: DataFrame, keys: Sequence[str] = ("user_id", "fact_key")) -> DataFrame:
    """Per key: has every row a vector, its length, and is there one row only."""
    return facts.groupBy(*keys).agg(
        F.bool_and(F.col("fact_embedding").isNotNull()).alias("has_embedding"),
        F.round(F.max(l2_norm(F.col("fact_embedding"))), 4).alias("embedding_norm"),
        (F.count(F.lit(1)) == 1).alias("single_row"),
    )


def latest_in_footers(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row ``latest``: the greatest value of a column of a stored Parquet table, from file statistics alone.

    The aggregate goes down into the reader, which opens footers and no data. Only the
    reader of the newer source interface does that, so the frame belongs to a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(column).alias("latest"))
