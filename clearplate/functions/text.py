"""String expressions whose meaning differs from the Spark built-in of that name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which INITCAP starts a new word.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\s"""


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def initcap_ext(c: Column) -> Column:
    """INITCAP that also breaks words on punctuation.

    Plain words take the built-in; only values with other characters pay for the split.
    """
    pieces = F.split(F.lower(c), f"(?<=[{WORD_BREAKS}])")
    capped = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.when(c.rlike(r"^[\p{L}\p{N} ']*$"), F.initcap(c)).otherwise(F.array_join(capped, ""))


def concat_ws_strict(sep: str, *cols: Column) -> Column:
    """CONCAT_WS that is NULL as soon as one argument is NULL."""
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(complete, F.concat_ws(sep, *cols))


def md5_key(*cols: Column) -> Column:
    """Surrogate key over the parts joined by '|'; NULL when a part is NULL."""
    return F.md5(cols[0] if len(cols) == 1 else concat_ws_strict("|", *cols))


def words(c: Column) -> Column:
    """Words as split by any white space, without an empty first or last word."""
    return F.split(strip(c), r"(?U)\s+")


def terms(c: Column) -> Column:
    """Lower-case runs of letters and digits, for keyword search."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != "")
