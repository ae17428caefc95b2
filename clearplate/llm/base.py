"""Registration of the pipeline operators' queries, and what several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# White space that parts words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def query(name: str, sql: str | None = None):
    """Register a query, and its check when SQL can express it on whole tables."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pack(docs: DataFrame, **added: Column) -> DataFrame:
    """All columns as one struct ``doc`` beside the added ones, so that no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *[c.alias(n) for n, c in added.items()])


def id_key(doc_id: str) -> Column:
    """An id as text that is never null, so that a join on it needs no null-safe form and leaves rows of one key together."""
    return F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit(""))


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for explicit repartitioning."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
