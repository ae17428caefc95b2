"""From raw records to the star schema."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.functions.latest import join_null_safe
from clearplate.operators import marts, staging
from clearplate.session import shuffles_dropped


@dataclass(frozen=True)
class Marts:
    stg_inspections: DataFrame
    dim_restaurant: DataFrame
    dim_violation_type: DataFrame
    dim_date: DataFrame
    fct_inspections: DataFrame
    fct_violations: DataFrame


THREADS = 4
MONTH = "inspection_month"
# Staged records compress to a tenth of their size in memory; files of so many keep a split of them within a task.
FILE_ROWS = 200_000
# Rows of a fact that one task sorts, some 100 MB.
PART_ROWS = 250_000
# Keys are hashes in text: of those only a codec that codes single letters makes less.
CODEC = "zstd"
# Rows of a visit agree in most columns, so they compress best where they lie together.
VISIT = ["restaurant_id", "inspection_date"]
TABLES = list(Marts.__dataclass_fields__)


def month_of(day: Column) -> Column:
    """A day's month as year * 100 + month."""
    return F.year(day) * 100 + F.month(day)


def within_days(fact: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; of a stored fact only the folders of their months are read."""
    if MONTH in fact.columns:
        fact = fact.filter(F.col(MONTH).between(month_of(first), month_of(last)))
    return fact.filter(F.col("inspection_date").between(first, last))


def by_month(stg: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that puts the rows of a month together and sorts them by day, with whole visits side by side.

    A month is cut into parts by its number of staged rows, visits uncut. A cut by size, as rebalancing does
    it, would go by compressed bytes, of which these rows have few: a part would outgrow a task.
    """
    spark = stg.sparkSession
    month = month_of(F.col("inspection_date")).alias(MONTH)
    per = stg.groupBy(month).agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("_of")).collect()  # a row per month
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(r["n"] for r in per) // PART_ROWS))
    large = spark.createDataFrame([(r[MONTH], r["_of"]) for r in per if r["_of"] > 1], f"{MONTH} int, _of long")

    def arrange(fact: DataFrame) -> DataFrame:
        dated = fact.withColumn(MONTH, month_of(F.col("inspection_date")))
        cut = join_null_safe(dated, F.broadcast(large), [MONTH], "left")
        dealt = cut.withColumn("_part", F.pmod(F.xxhash64(*VISIT), F.coalesce("_of", F.lit(1).cast("long"))))
        return dealt.repartition(parts, MONTH, "_part").drop("_of", "_part").sortWithinPartitions(MONTH, "inspection_date", "restaurant_id")

    return arrange


def read_alike(stg: DataFrame) -> DataFrame:
    """The same rows, with filters of those who read them kept above.

    A filter pushed below the dedupe makes its shuffle another one for each view. Kept above what
    is observed, as Spark does it, all views in one plan read the same shuffle.
    """
    return stg.observe("staged", F.count(F.lit(1)).alias("rows"))


def derive_marts(stg: DataFrame, arrange: Callable[[DataFrame], DataFrame] | None = None) -> Marts:
    """All marts as lazy frames over one staging frame; ``arrange`` places the rows of the facts."""
    dates = marts.dim_date(stg.sparkSession)
    return Marts(
        stg,
        marts.dim_restaurant(staging.latest_profile(stg)),
        marts.dim_violation_type(staging.reference_codes(stg)),
        dates,
        marts.fct_inspections(stg, dates, arrange),
        marts.fct_violations(stg, dates, arrange),
    )


def read_marts(spark: SparkSession, target: str) -> Marts:
    return Marts(*[spark.read.parquet(f"{target}/{name}") for name in TABLES])


def build_marts(raw: DataFrame, target: str) -> Marts:
    """Write staging once, then each mart from it, and return the written tables.

    Staging feeds four models. It is written rather than cached: the table survives a
    lost executor and cuts the lineage. Facts lie in a folder for each month and sorted by
    day within, so a filter made by :func:`within_days` opens only the months it asks for.
    """
    spark = raw.sparkSession
    with shuffles_dropped(spark):
        staged = staging.stage_inspections(raw).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
        staged.parquet(f"{target}/stg_inspections", compression=CODEC)
    stg = spark.read.parquet(f"{target}/stg_inspections")
    built = derive_marts(stg, by_month(stg))

    def write(name: str) -> None:
        df = getattr(built, name)
        out = df.write.mode("overwrite")
        (out.partitionBy(MONTH) if name.startswith("fct_") else out).parquet(f"{target}/{name}", compression=CODEC)

    # The marts do not depend on each other; submitted together they share the cluster.
    with shuffles_dropped(spark), ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(write, TABLES[1:]))
    return read_marts(spark, target)
