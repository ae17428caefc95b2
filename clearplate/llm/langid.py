"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three characters into a fixed number of buckets per
language; the counts of a task are one bounded block of numbers, summed by Spark. The
log-probability matrix has languages x buckets entries, whatever the size of the data, and
is broadcast. Scoring reads, for each n-gram that occurs, one entry per language, many
documents to one numpy call.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.llm.base import fold_of, pack, query, table

BUCKET_BITS = 15
BLOCK = 4096
MAX_LANGUAGES = 512
EVIDENCE = 50
PIECE = 1 << 18
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_LOW = np.array([c if chr(c).isalpha() else 32 for c in range(0x250)], np.uint32)


@dataclass
class LanguageModel:
    """Languages in order, their log priors, and log probabilities by (language, bucket)."""

    languages: list[str]
    prior: np.ndarray
    logp: np.ndarray


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Padded texts in groups of about PIECE characters; a longer text comes in several pieces that overlap by two."""
    owners, parts, size = [], [], 0
    for k, text in enumerate(texts):
        padded = f" {text.lower()}  "
        for at in range(0, len(padded) - 2, PIECE):
            owners.append(k)
            parts.append(padded[at : at + PIECE + 2])
            size += len(parts[-1])
            if size >= PIECE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def _buckets(parts: list[str], bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket of the n-gram that starts at each character, for n = 1, 2, 3, and each part's first and last such character."""
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < len(_LOW), _LOW[np.minimum(points, len(_LOW) - 1)], points)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    one, two, three = points[:-2], points[1:-1], points[2:]
    mixed, out = np.uint32(0x9E3779B1) * one, []
    for n, following in ((1, None), (2, two), (3, three)):
        if following is not None:
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) + following * np.uint32(0xC2B2AE3D)
        out.append(((mixed + np.uint32(n)) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - bits))
    return out, starts, starts + lengths - 2


def train(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = BUCKET_BITS) -> LanguageModel:
    """Count every row with a language and a text; rows without either teach nothing.

    More than MAX_LANGUAGES labels raise an error, since the matrix is held by the driver.
    """
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for df in batches:
            for name, texts in df.groupby("lang")["text"]:
                own = sums.setdefault(name, np.zeros(1 << bits, np.int64))
                rows[name] = rows.get(name, 0) + len(texts)
                for _, parts in _pieces(texts.tolist()):
                    grams, starts, ends = _buckets(parts, bits)
                    for g in grams:
                        own += np.bincount(g, minlength=1 << bits)
                        # n-grams across the border of two parts were counted with the rest.
                        for k in (0, 1):
                            across = ends[:-1] + k
                            own -= np.bincount(g[across], minlength=1 << bits)
        for name, own in sums.items():
            blocks = own.reshape(-1, BLOCK)
            yield pd.DataFrame({"lang": name, "block": range(len(blocks)), "rows": rows[name], "n": list(blocks)})

    def add(df: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(df["n"].to_list()), axis=0)
        return pd.DataFrame({"lang": df["lang"][:1], "block": df["block"][:1], "rows": [df["rows"].sum()], "n": [total]})

    schema = "lang string, block int, rows long, n array<long>"
    counted = labelled.mapInPandas(count, schema).groupBy("lang", "block").applyInPandas(add, schema)
    got = counted.limit(MAX_LANGUAGES * ((1 << bits) // BLOCK) + 1).toPandas()
    languages = sorted(got["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(languages), 1 << bits))
    rows = np.zeros(len(languages))
    for name, block, n, values in got.itertuples(index=False):
        k = languages.index(name)
        counts[k, block * BLOCK : (block + 1) * BLOCK] = values
        rows[k] = n
    logp = np.log(counts + 0.5) - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])
    return LanguageModel(languages, np.log(rows / rows.sum()) if len(rows) else rows, logp.astype(np.float32))


def score_texts(texts: list[str | None], model: LanguageModel, evidence: int = EVIDENCE) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    given = [t or "" for t in texts]
    bits = int(model.logp.shape[1]).bit_length() - 1
    sums = np.zeros((len(model.languages), len(texts)))
    for owners, parts in _pieces(given):
        grams, starts, ends = _buckets(parts, bits)
        cuts = np.stack([starts, np.minimum(ends, len(grams[0]))], axis=1).ravel()
        for k, row in enumerate(model.logp):
            values = row[grams[0]] + row[grams[1]] + row[grams[2]]
            values = np.append(values, np.float32(0))
            sums[k] += np.bincount(owners, np.add.reduceat(values, cuts, dtype=np.float64)[::2], len(texts))
    windows = np.array([len(t.lower()) + 1 for t in given]) * 3.0
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model.languages:
        logits = sums + model.prior[:, None]
        best = logits.argmax(axis=0)
        sure = 1.0 / np.exp((logits - logits.max(axis=0)) * np.minimum(1.0, evidence / windows)).sum(axis=0)
        for k, t in enumerate(given):
            if _LETTER.search(t):
                names[k], scores[k] = model.languages[best[k]], sure[k]
    return names, scores


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", evidence: int = EVIDENCE) -> DataFrame:
    """Every row as struct ``doc`` with ``lang_pred`` and ``score``.

    The language is that of the greatest posterior, all n-grams counted in full. The score
    is a tempered posterior: likelihood and prior are scaled alike, down to the weight of at
    most ``evidence`` n-grams, as neighbouring n-grams are far from independent; so it never
    changes which language is first. A text that is
    null, empty or without a letter, or an untrained model, gives ``und`` and 0. Ties go
    to the first language in order. Texts of any length are read whole. Repeated rows
    return repeated rows, an empty table none, and columns of any name pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    schema = T.StructType([*pack(docs).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = score_texts(batch.column(0).field(at).to_pylist(), shared.value, evidence)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc", "lang_pred", "score"])

    return pack(docs).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.0) -> DataFrame:
    """Rows whose language is told, with a score of ``least`` or more; by default only ``und`` is rejected.

    The score falls with the number of close languages, not only with doubt about a text.
    """
    return identify(docs, model, text).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("doc.*")


def split_model(docs: DataFrame) -> LanguageModel:
    """A model of the training rows of ``documents``: crc32 of the id mod 4 is not 2; null ids teach nothing."""
    return train(docs.filter(fold_of("doc_id", 4) != 2))


@query("op3_langid")
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "text")
    held_out = F.coalesce(fold_of("doc.doc_id", 4) == 2, F.lit(False))
    return identify(slim, split_model(docs)).select("doc.doc_id", held_out.alias("held_out"), "lang_pred", "score")
