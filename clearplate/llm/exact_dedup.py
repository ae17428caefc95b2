"""Exact duplicates against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is first cut to one row per
digest, so a text that fills a third of the batch is one row from then on. One sort-merge
join with the index, which reads the buckets as they lie, tells what the index holds and,
by what does not match, what it lacks; that is appended.
A batch sent again finds its own digests there and gets the same answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.llm.base import SPACE, filled, id_key, pack, query, table
from clearplate.session import dir_tag, fresh_path, written

INDEX_COLUMNS = "digest BINARY, keep_id BIGINT, keep_points BIGINT"


def text_digest(text: str = "text"):
    """SHA-256 of the text without white space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(filled(text), f"{SPACE}+", "").cast("binary"), 256))


class DigestIndex:
    """Digests seen so far with the document kept for each: ``digest, keep_id, keep_points``.

    ``path`` must be a folder that every executor can reach; opening it again continues
    the index. ``buckets`` should give buckets of some 100 MB at the size expected.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{dir_tag(path)}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({INDEX_COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def bucketed(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def met(self, best: DataFrame) -> DataFrame:
        """``best``, which holds each digest once, with ``held_id, held_points`` of what is there; ``known`` is null for what is not.

        One sort-merge join tells both, and reads the buckets as they lie.
        """
        held = self.bucketed().select("digest", F.col("keep_id").alias("held_id"), F.col("keep_points").alias("held_points"), F.lit(True).alias("known"))
        return best.join(held.hint("merge"), "digest", "left")

    def append(self, new: DataFrame) -> None:
        """Add digests that are not there, in the index's columns."""
        new.select("digest", "keep_id", "keep_points").repartition(self.buckets, "digest").write.insertInto(self.name)


def dedupe(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts are those with the same characters but for white space. Of a text that the
    index does not know, the row with the most code points stays, then the smallest id;
    null ids come last. A known text keeps the document the index names. ``group_size``
    counts the rows of this batch. Of repeated rows with one id, one row is kept. Null
    texts equal empty ones. Other columns of any name are ignored. An empty batch gives no rows.
    """
    row = F.monotonically_increasing_id()
    digests = written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_digest(text).alias("digest"), F.char_length(filled(text)).cast("long").alias("n_points"), row.alias("row")), "digests")
    first = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")))
    best = digests.groupBy("digest").agg(first.alias("b"), F.count("*").alias("group_size"))
    best = written(best.select("digest", "b.keep_id", (-F.col("b.p")).alias("keep_points"), "b.keep_row", "group_size"), "best")
    met = written(index.met(best), "met")
    index.append(met.filter("known is null"))
    stays = F.col("known").isNull() | (F.col("keep_id").eqNullSafe(F.col("held_id")) & (F.col("keep_points") == F.col("held_points")))
    groups = met.select("digest", "group_size", F.when(F.col("known"), F.col("held_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(stays, F.col("keep_row")).alias("keep_row"))
    joined = digests.join(written(groups, "groups"), "digest")
    return joined.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that ``dedupe`` keeps, with all their columns.

    The text is shuffled once, by id and digest, so copies of one text go to many tasks.
    Rows with one id and equal texts count as one row. Columns of any name pass through.
    """
    kept = dedupe(docs, index, doc_id, text).filter("kept").select(id_key("doc_id").alias("key"), F.unhex("text_sha256").alias("digest"))
    rows = pack(docs, key=id_key(doc_id), digest=text_digest(text))
    return rows.join(written(kept, "kept"), ["key", "digest"]).dropDuplicates(["key", "digest"]).select("doc.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""


@query("op4_exact_dedup", SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "documents"), DigestIndex(spark, fresh_path(spark, "digest-index")))
