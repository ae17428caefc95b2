"""Registration of runnable queries together with the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.plans.build import Marts, build_marts, read_marts
from clearplate.session import dir_tag, work_path
from clearplate.sources import bind

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_BUILT: set[str] = set()


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines print alike: text for dates, times and arrays, bigint and double for numbers."""
    out = []
    for f in df.schema:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a query, and its check when SQL can express it on whole tables."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def marts_path(spark: SparkSession, sf_dir: str) -> str:
    return work_path(spark, "marts", dir_tag(os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir))


def marts_of(spark: SparkSession, sf_dir: str) -> Marts:
    """The written star schema of a data folder, built on first use in this application.

    Marts are tables, as in any warehouse; the queries over them read what was
    written. ``build_marts`` is a registered query of its own, always run in full.
    """
    target = marts_path(spark, sf_dir)
    if target not in _BUILT:
        build_marts(bind.raw_inspections(spark, sf_dir), target)
        _BUILT.add(target)
    return read_marts(spark, target)
