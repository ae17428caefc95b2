"""Vector search over stored cells: only the cells nearest a query are read.

Centroids are fitted on a bounded sample; every vector is stored in the folder of its nearest
centroid. A query asks its nearest cells. How many it asks by default is measured when the
index is made: so many that sampled queries find RECALL of their nearest neighbours. With all
cells asked the answer is that of the exact scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.functions.latest import top_per_key
from clearplate.operators.retrieval import CELL_ROWS, DEFAULT_LIMIT, MAX_BROADCAST_QUERIES, _matrix, best_in_cells, best_schema, numbers_below, stacked, unit_rows
from clearplate.session import written

# Centroids are fitted on at most this many vectors, those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 500
# Bound of the centroids, which every task holds.
MAX_CELLS = 4096
ROUNDS = 12
RECALL = 0.95


@dataclass(frozen=True)
class CellIndex:
    """Vectors ``cell, id, vector`` in folders by cell, the centroids (unit rows), and the cells a query asks by default."""

    vectors: DataFrame
    centroids: np.ndarray
    probes: int
    id_col: str
    vector: str


def centroids_of(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Spherical k-means; an empty cell takes the vector that its own centroid fits worst."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centers = distinct[rng.choice(len(distinct), min(cells, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        near = sample @ centers.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centers)) == 0)
        worst = np.argsort(near[np.arange(len(sample)), own], kind="stable")[: len(empty)]
        sums[empty[: len(worst)]] = sample[worst]
        centers = unit_rows(sums)
    return centers


def probes_for(sample: np.ndarray, centers: np.ndarray, k: int = DEFAULT_LIMIT, recall: float = RECALL, queries: int = SAMPLE_QUERIES) -> int:
    """Cells to ask so that ``recall`` of the sampled queries' ``k`` nearest neighbours lie in them."""
    asked = sample[:queries]
    near = asked @ sample.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf  # a query is no neighbour of its own
    best = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    if not best.size:
        return len(centers)
    cell = (sample @ centers.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(asked @ centers.T), axis=1, kind="stable"), axis=1, kind="stable")
    ranks = np.sort(np.take_along_axis(place, cell[best], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1


def _placed(rows: DataFrame, centers: np.ndarray, id_col: str, vector: str) -> DataFrame:
    """``cell, id, vector`` of the vectors that are not NULL."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), rows.schema[id_col], rows.schema[vector]])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = (unit_rows(_matrix(batch.column(1))) @ centers.T).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=schema.names)

    return rows.select(id_col, vector).filter(F.col(vector).isNotNull()).mapInArrow(place, schema)


def _store(placed: DataFrame, path: str) -> None:
    # Rebalancing splits the partition of a crowded cell by size, and each part writes a file of its own.
    placed.hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{path}/vectors")


def write_cells(corpus: DataFrame, path: str, cells: int | None = None, id_col: str = "doc_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS) -> None:
    """Fit centroids on a sample of at most ``sample_rows`` vectors and store all vectors by cell.

    By default there are about 2 sqrt(n) cells, at most MAX_CELLS. NULL vectors are not stored.
    """
    spark = corpus.sparkSession
    held = corpus.select(id_col, vector).filter(F.col(vector).isNotNull())
    n = held.count()
    picked = held.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows).toPandas()
    sample = unit_rows(stacked(picked[vector])) if len(picked) else np.zeros((0, 1))
    wanted = min(cells or round(2 * n**0.5), MAX_CELLS, len(picked))
    centers = centroids_of(sample, wanted) if len(picked) else sample
    probes = probes_for(sample, centers) if len(picked) else 0
    rows = [(cell, center, probes) for cell, center in enumerate(centers.tolist())]
    spark.createDataFrame(rows, "cell int, centroid array<double>, probes int").coalesce(1).write.parquet(f"{path}/centroids")
    held.select(F.lit(0).alias("cell"), id_col, vector).limit(0).write.parquet(f"{path}/columns")
    if len(centers):
        _store(_placed(held, centers, id_col, vector), path)


def add_vectors(new: DataFrame, path: str) -> None:
    """Store further vectors; centroids stay, so the index should be made anew once the data have changed much."""
    index = read_cells(new.sparkSession, path)
    if not len(index.centroids):
        raise ValueError("an index made of no vectors has no cells; make it anew")
    _store(_placed(new, index.centroids, index.id_col, index.vector), path)


def read_cells(spark: SparkSession, path: str) -> CellIndex:
    """Open a stored index; the centroids, at most MAX_CELLS rows, come to the driver."""
    own = spark.read.parquet(f"{path}/centroids").orderBy("cell").toPandas()
    columns = spark.read.parquet(f"{path}/columns")
    vectors = spark.read.schema(columns.schema).parquet(f"{path}/vectors") if len(own) else columns
    centers = stacked(own["centroid"]) if len(own) else np.zeros((0, 1))
    return CellIndex(vectors, centers, int(own["probes"].max()) if len(own) else 0, columns.columns[1], columns.columns[2])


def asked_cells(queries: DataFrame, index: CellIndex, probes: int | None = None) -> DataFrame:
    """``query_id, _v, cell``: the nearest cells of each query that has a vector."""
    n = min(probes or index.probes, len(index.centroids))
    q = queries.select("query_id", F.col(index.vector).alias("_v")).filter(F.col("_v").isNotNull())
    schema = T.StructType([*q.schema.fields, T.StructField("cell", T.IntegerType())])
    centers = index.centroids

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and n:
                near = np.argsort(-(unit_rows(_matrix(batch.column(1))) @ centers.T), axis=1, kind="stable")[:, :n]
                rows = pa.array(np.repeat(np.arange(batch.num_rows), n))
                yield pa.RecordBatch.from_arrays([*batch.take(rows).columns, pa.array(near.ravel().astype(np.int32))], names=schema.names)

    return q.mapInArrow(ask, schema)


def cell_search(queries: DataFrame, index: CellIndex, k: int = DEFAULT_LIMIT, probes: int | None = None, cell_rows: int = CELL_ROWS, block_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """``query_id, id, score, rank``: the best ``k`` by cosine among the vectors of the asked cells.

    Folders of cells that no query asks are not read. A crowded cell is cut by its measured
    rows and the queries that ask it into groups of at most about ``cell_rows`` vectors and
    ``block_queries`` queries, so no task holds a whole cell. Scores and ties are those of
    ``vector_search``; with as many ``probes`` as cells so is the answer.
    """
    asked = written(asked_cells(queries, index, probes), "asked-cells")
    wanted = [r["cell"] for r in asked.select("cell").distinct().collect()]  # at most MAX_CELLS numbers
    held = index.vectors.filter(F.col("cell").isin(wanted)).select("cell", F.col(index.id_col).alias("_id"), F.col(index.vector).alias("_v"))
    of_cells = held.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("parts"))
    of_asked = asked.groupBy("cell").agg(F.ceil(F.count("*") / block_queries).alias("blocks"))
    sizes = written(of_cells.join(of_asked, "cell"), "cell-sizes")
    left = asked.join(sizes, "cell").select("cell", "query_id", "_v", F.pmod(F.xxhash64("query_id"), "blocks").alias("_block"), numbers_below(F.col("parts")).alias("_part"))
    right = held.join(sizes, "cell").select("cell", "_id", "_v", F.pmod(F.xxhash64("_id"), "parts").alias("_part"), numbers_below(F.col("blocks")).alias("_block"))
    schema = best_schema(queries.schema["query_id"].dataType, held.schema["_id"].dataType)
    found = best_in_cells(left, right, ["cell", "_part", "_block"], k, schema).select("query_id", F.col("_id").alias(index.id_col), "score")
    return top_per_key(found, ["query_id"], [F.desc("score"), F.col(index.id_col)], k, rank="rank")


def recall_of(found: DataFrame, exact: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row: rows of the exact answer, and how many of them were found."""
    hit = found.select("query_id", id_col, F.lit(1).alias("_hit"))
    return exact.join(hit, ["query_id", id_col], "left").agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"), F.count("_hit").alias("found"))
