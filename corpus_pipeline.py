"""From raw documents to sampled piece ids: five stages, each on all that the one before kept.

Every stage takes null in any column, empty and very long texts (always whole), repeated
rows, an empty table, and further columns of any name, which pass through. Ties are told
apart as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearplate.llm import exact_dedup, langid, mixing, pieces, simhash
from clearplate.llm.base import table
from clearplate.session import fresh_path, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without letters go, whatever their ``lang`` says."""
    return langid.keep_identified(docs, langid.split_model(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest document of each text, then the smallest id, null last; of equal rows with one id, one."""
    return exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark, fresh_path(spark, "digest-index")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates; where all its ids are null, one row. Of several rows with that id, that with the smallest fingerprint."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target weights; null is a category. Rows with one id share a draw."""
    return mixing.sample(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids, n_pieces, lossless`` of one sampled cut of each text; these take the place of columns so named."""
    added = ["ids", "n_pieces", "lossless"]
    kept = [f"doc.`{c}`" for c in docs.columns if c.lower() not in added]
    return pieces.encode(docs, pieces.load_model()).select(*kept, *added)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# Fingerprint components, sampled cuts and the language model are beyond SQL; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
