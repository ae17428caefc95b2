"""Quality classifier: n-gram indicators scaled by naive Bayes, then a linear hinge-loss model.

Indicators of word and word-shape n-grams are hashed to a fixed number of features. On a
bounded sample of labelled rows each feature gets its class log-count ratio; a support
vector machine on the scaled indicators is fitted by dual coordinate descent. Its weights,
folded with the ratios into one vector of fixed size, are broadcast to score all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.llm.base import fold_of, pack, query, table

FEATURE_BITS = 18
# The labelled sample: all indicators of at most this many rows teach.
TRAIN_ROWS = 6000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
CUT = 0.3
BATCH_CHARS = 1 << 19
MAX_WORDS = 300_000

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")
_SHAPES: dict[str, tuple[int, int]] = {}


def shape(word: str) -> str:
    """A word with runs of capitals, other letters and digits as one sign each: ``And!!`` is ``Aa!!``."""
    return _DIGIT.sub("0", _UPPER.sub("A", _LOWER.sub("a", word)))


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, lower-cased, and of its shape."""
    if len(_SHAPES) > MAX_WORDS:
        _SHAPES.clear()
    for w in {w for w in words if w not in _SHAPES}:
        _SHAPES[w] = (xxhash.xxh32_intdigest(w.lower().encode("utf-8", "surrogatepass")), xxhash.xxh32_intdigest(shape(w).encode("utf-8", "surrogatepass"), 1))
    both = np.array(list(map(_SHAPES.__getitem__, words)), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def features(texts: list[str], bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each indicator, sorted by row: words and shapes, one to two or three in a row.

    A word equal to the one before, or to the one before that, has a shape of its own, so
    stuttering texts have n-grams of their own.
    """
    split = [_WORDS.findall(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for s in split for w in s]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, form = _hashes(flat)
    row = np.repeat(np.arange(len(texts)), sizes)
    again = np.zeros(len(flat), bool)
    for back in (1, 2):
        again[back:] |= (word[back:] == word[:-back]) & (row[back:] == row[:-back])
    form = np.where(again, np.uint64(0x5EED), form)
    out = []
    for kind, (h, most) in enumerate(((word, 2), (form, 3))):
        mixed = h
        for n in range(1, most + 1):
            if n > 1:
                mixed = (mixed[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (mixed[:-1] >> np.uint64(29)) ^ h[n - 1 :]
            inside = slice(None) if n == 1 else row[: len(row) - n + 1] == row[n - 1 :]
            x = (mixed[inside] + np.uint64(2 * n + kind)) * np.uint64(0xD6E8FEB86659FD93)
            owner = row[: len(row) - n + 1][inside].astype(np.uint64)
            out.append((owner << np.uint64(bits)) | (x >> np.uint64(64 - bits)))
    keys = np.unique(np.concatenate(out)).astype(np.int64)
    return keys >> bits, keys & ((1 << bits) - 1)


@dataclass
class QualityModel:
    """Weight per feature, intercept, and the logistic curve from margin to score."""

    weight: np.ndarray
    intercept: float
    slope: float
    offset: float


def _groups(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def margins(texts: list[str], model: QualityModel) -> np.ndarray:
    """Distance from the separating plane; indicators of a row are scaled to unit length."""
    bits = len(model.weight).bit_length() - 1
    out = np.full(len(texts), model.intercept)
    for part in _groups(texts):
        row, feature = features(texts[part], bits)
        n = part.stop - part.start
        size = np.bincount(row, minlength=n)
        out[part] += np.bincount(row, model.weight[feature], n) / np.sqrt(np.maximum(size, 1))
    return out


def fit_hinge(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge model by dual coordinate descent.

    Row k has value ``values[f] / sqrt(len(rows[k]))`` at each feature f it names; the
    last weight belongs to a constant 1.
    """
    w, bias = np.zeros(len(values)), 0.0
    scale = np.array([1 / np.sqrt(max(len(r), 1)) for r in rows])
    norm = np.array([(values[r] ** 2).sum() for r in rows]) * scale**2 + 1.0
    dual = np.zeros(len(rows))
    diagonal = 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            r = rows[k]
            gradient = y[k] * ((w[r] @ values[r]) * scale[k] + bias) - 1 + diagonal * dual[k]
            new = max(dual[k] - gradient / (norm[k] + diagonal), 0.0)
            step = (new - dual[k]) * y[k]
            if step:
                w[r] += step * scale[k] * values[r]
                bias += step
                dual[k] = new
    return w, bias


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1) over margins by Newton steps, with a light prior on the slope."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * m).sum() + 1e-3 * a, (p - y).sum()])
        h = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS, bits: int = FEATURE_BITS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents, those with the smallest hash of the id.

    The ids are chosen first (a bounded list, broadcast to find the texts in one pass). A
    chosen row teaches by all its indicators, of which there are at most ``2 ** bits``. A fifth
    of the rows sets the curve from margin to score. Labels other than 0 and 1 are left out; of
    several labels of one id the smallest counts, and of several texts the first in order.
    With labels of one class only, the score is that class.
    """
    given = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("y"))
    chosen = given.orderBy(F.xxhash64("id"), "id").limit(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts = df["text"].tolist()
            lists: list[np.ndarray] = []
            for part in _groups(texts):
                row, feature = features(texts[part], bits)
                cuts = np.searchsorted(row, np.arange(part.stop - part.start + 1))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    lists.append(feature[a:b].astype(np.int32))
            yield pd.DataFrame({"id": df["id"], "y": df["y"], "f": lists})

    found = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    found = found.groupBy("id", "y").agg(F.min("text").alias("text"))  # an id on many rows is one row of each task before the shuffle
    got = found.mapInPandas(run, T.StructType([found.schema["id"], T.StructField("y", T.IntegerType()), T.StructField("f", T.ArrayType(T.IntegerType()))])).toPandas()
    got = got.sort_values("id", kind="stable", ignore_index=True)
    x = [np.asarray(f, np.int64) for f in got["f"]]
    y = np.where(got["y"].to_numpy() == 1, 1.0, -1.0)
    if len(set(y)) < 2:
        return QualityModel(np.zeros(1 << bits, np.float32), 0.0, 0.0, float(20 * y[0]) if len(y) else 0.0)
    held = np.arange(len(x)) % 5 == 0
    counts = {c: np.bincount(np.concatenate([x[k] for k in np.flatnonzero((y == c) & ~held)] or [np.zeros(0, np.int64)]), minlength=1 << bits) + SMOOTHING for c in (1.0, -1.0)}
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    use = np.flatnonzero(~held)
    w, bias = fit_hinge([x[k] for k in use], ratio, y[use])
    model = QualityModel((w * ratio).astype(np.float32), float(bias), 1.0, 0.0)
    m = np.array([bias + model.weight[f].sum() / np.sqrt(max(len(f), 1)) for f in x])
    test = held if 0 < (y[held] > 0).sum() < held.sum() else np.ones(len(x), bool)
    model.slope, model.offset = _logistic(m[test], (y[test] > 0).astype(float))
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with ``score`` in 0..1.

    Null texts count as empty; a text without words gets the intercept's score. Texts are
    read whole, repeated rows get equal scores, an empty table gives no rows, and columns of
    any name pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    packed = pack(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(0).field(at).to_pylist()]
            m = np.clip(own.slope * margins(texts, own) + own.offset, -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-m)))], names=["doc", "score"])

    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType())]))


@query("op10_quality_model")
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").filter(fold_of("doc_id", 5) != 0))
    held_out = F.coalesce(fold_of("doc.doc_id", 5) == 0, F.lit(False))
    return score(docs, model).select("doc.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
