"""Reading landed raw records and cleaning them before the typed stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.functions.text import blank_to_null, strip
from clearplate.sources.schemas import LOADED_AT, RAW_COLUMNS, RAW_SCHEMA


def read_raw(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """JSON records as 26 string columns; a field that a record lacks is NULL.

    The schema is explicit, so no pass over the data is spent on inferring it.
    ``limit`` is the test-load switch of the loader.
    """
    df = spark.read.schema(RAW_SCHEMA).json(path)
    return df if limit is None else df.limit(limit)


def normalise_raw(df: DataFrame, loaded_at=None, upper_names: bool = False) -> DataFrame:
    """Strip every value, turn blanks into NULL, fix the column order, add the load time."""
    stamp = F.col(LOADED_AT) if LOADED_AT in df.columns else F.lit(loaded_at).cast("timestamp_ntz")
    name = str.upper if upper_names else str
    cleaned = [
        blank_to_null(strip(F.col(c).cast("string"))).alias(name(c)) if c in df.columns
        else F.lit(None).cast("string").alias(name(c))
        for c in RAW_COLUMNS
    ]
    return df.select(*cleaned, stamp.alias(name(LOADED_AT)))
