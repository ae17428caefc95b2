"""Casts for raw strings: bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def to_whole_number(c: Column) -> Column:
    """Rounds halves away from zero, so it goes through a decimal."""
    return c.try_cast("decimal(38,0)").try_cast("int")


def to_day(c: Column) -> Column:
    return F.to_date(c.try_cast("timestamp_ntz"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def percent(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))
