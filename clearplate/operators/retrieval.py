"""Batch retrieval: keyword, vector and hybrid search over document chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clearplate.functions.latest import top_per_key
from clearplate.functions.text import terms
from clearplate.operators.corpus import all_codes
from clearplate.session import dir_tag, written

# BM25 constants, and fixed values of the scoring profiles.
K1, B = 1.2, 0.75
PROFILES = {"default": (1.0, 1.0), "no_reranker": (1.0, 1.0), "keyword_heavy": (3.0, 1.0)}
DEFAULT_LIMIT = 5
# A batch of at most this many query vectors travels to every task; a larger one is cut into blocks.
MAX_BROADCAST_QUERIES = 2048
CELL_ROWS = 50_000
# Keyword search cuts a batch into blocks of about so many queries and (query, term) rows, and the corpus into cells.
BLOCK_QUERIES = 256
BLOCK_TERMS = 16_000
CELL_DOCS = 20_000
BUCKET_WORDS = 2_000_000
# Size of a product's matrices.
MATRIX_CELLS = 4_000_000


@dataclass(frozen=True)
class Index:
    """Postings (term, id, tf, length), lengths (id, length), documents per term (term, df), and documents with their mean length (total, mean)."""

    postings: DataFrame
    lengths: DataFrame
    frequency: DataFrame
    totals: DataFrame


# -- filters and projection --------------------------------------------------------


def attribute_filter(spec: Mapping) -> Column:
    """``{"@eq": {column: value}}``, ``{"@or": [...]}``, ``{"@and": [...]}`` as a predicate.

    It is applied to the corpus before scoring, where it reaches the scan. Two values
    asked of one attribute with ``@and`` match nothing, as a chunk has one value.
    """
    if len(spec) != 1:
        raise ValueError("a filter has one operator")
    op, body = next(iter(spec.items()))
    if op == "@eq":
        return reduce(lambda a, b: a & b, [F.col(c) == v for c, v in body.items()])
    if op in ("@or", "@and"):
        parts = [attribute_filter(s) for s in body]
        return reduce((lambda a, b: a | b) if op == "@or" else (lambda a, b: a & b), parts)
    raise ValueError(f"unknown filter operator {op}")


def with_columns(ranked: DataFrame, corpus: DataFrame, id_col: str, columns: Sequence[str], k: int = DEFAULT_LIMIT) -> DataFrame:
    """The first ``k`` results with the asked-for columns. Text is joined to ranked ids, never carried through ranking."""
    return ranked.filter(F.col("rank") <= k).join(corpus.select(id_col, *[c for c in columns if c != id_col]), id_col)


# -- keyword ---------------------------------------------------------------------


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "chunk_text") -> Index:
    split = docs.select(id_col, terms(F.col(text)).alias("_terms"))
    lengths = split.select(id_col, F.size("_terms").alias("length"))
    each = split.select(id_col, F.size("_terms").alias("length"), F.explode_outer("_terms").alias("term")).filter(F.col("term").isNotNull())
    postings = each.groupBy("term", id_col, "length").agg(F.count(F.lit(1)).alias("tf"))
    return _index_of(postings, lengths)


def _index_of(postings: DataFrame, lengths: DataFrame) -> Index:
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return Index(postings, lengths, frequency, lengths.agg(F.count(F.lit(1)).alias("total"), F.avg("length").alias("mean")))


def _bucketed(df: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write a table bucketed and sorted by term, and read it as such."""
    name = f"terms_{dir_tag(path)}"
    df.write.mode("overwrite").bucketBy(buckets, "term").sortBy("term").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_index(index: Index, path: str, buckets: int | None = None) -> Index:
    """Store an index, postings and frequencies bucketed and sorted by term, and return it as stored.

    A join on the term reads the buckets as they lie; within a file, a look-up of few terms skips
    row groups. There are at least ``buckets``, by default as many as shuffle partitions, and more
    where the texts have more than BUCKET_WORDS words for each, as one task sorts a bucket.
    """
    spark = index.postings.sparkSession
    index.lengths.write.mode("overwrite").parquet(f"{path}/lengths")
    words = spark.read.parquet(f"{path}/lengths").agg(F.sum("length")).first()[0] or 0
    buckets = max(buckets or _shuffle_parts(spark), -(-words // BUCKET_WORDS))
    postings = _bucketed(index.postings.repartition(buckets, "term"), f"{path}/postings", buckets)
    stored = _index_of(postings, spark.read.parquet(f"{path}/lengths"))
    _bucketed(stored.frequency, f"{path}/frequency", buckets)
    stored.totals.withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/totals")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    """Open a stored index, in another session too: its tables are declared over their folders where the catalog lacks them."""
    totals = spark.read.parquet(f"{path}/totals")
    buckets = totals.first()["buckets"]
    tables = []
    for part in ("postings", "frequency"):
        name = f"terms_{dir_tag(f'{path}/{part}')}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{part}").schema)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (term) SORTED BY (term) INTO {buckets} BUCKETS LOCATION '{path}/{part}'")
        tables.append(spark.table(name))
    return Index(tables[0], spark.read.parquet(f"{path}/lengths"), tables[1], totals.drop("buckets"))


def refresh_index(index: Index, changed: DataFrame, gone: DataFrame | None = None, id_col: str = "doc_id", text: str = "chunk_text") -> Index:
    """Index after changed (and removed) chunks: entries of touched ids go, new ones come; others are not recomputed.

    Touched ids are not made distinct first: that would deal them to other parts than postings by id
    lie in, and the postings would be shuffled to meet them.
    """
    fresh = build_index(changed, id_col, text)
    touched = changed.select(id_col) if gone is None else changed.select(id_col).unionByName(gone.select(id_col))
    return _index_of(
        index.postings.join(touched, id_col, "left_anti").unionByName(fresh.postings),
        index.lengths.join(touched, id_col, "left_anti").unionByName(fresh.lengths),
    )


def changed_since(chunks: DataFrame, since) -> DataFrame:
    return chunks.filter(F.col("loaded_at") > F.lit(since).cast("timestamp_ntz"))


@dataclass(frozen=True)
class _Asked:
    """A batch of queries cut into blocks: its weights (query_id, block, term_no, idf), its terms (term, term_no, blocks), and the cuts."""

    weights: DataFrame
    terms: DataFrame
    blocks: int
    cells: int
    mean: float
    parts: int

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows dealt by block and cell to so many parts that each takes about the postings of CELL_DOCS documents for one block.

        They are sorted here, as a grouping carries its keys a second time through a shuffle and a sort of its own.
        """
        few = self.parts <= _shuffle_parts(rows.sparkSession)  # then Spark's own number, which it may lower, is enough
        dealt = rows.repartition("block", "cell") if few else rows.repartition(self.parts, "block", "cell")
        return dealt.sortWithinPartitions("block", "cell")


def _asked(queries: DataFrame, index: Index, block_queries: int, block_terms: int, cell_docs: int) -> _Asked:
    """Number the known terms of a batch and weigh them (idf). Counts decide how many blocks and cells there are."""
    spark = queries.sparkSession
    total, mean = index.totals.first()
    asked = queries.select("query_id", F.explode_outer(F.array_distinct(terms(F.col("query_text")))).alias("term")).filter(F.col("term").isNotNull())
    known = index.frequency.join(asked.select("term").distinct(), "term")
    idf = F.log(1 + (F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = written(known.select("term", idf.alias("idf")).withColumn("term_no", F.monotonically_increasing_id()), "terms")
    weights = written(asked.join(known, "term").select("query_id", "term_no", "idf"), "weights")
    rows, n = weights.agg(F.count(F.lit(1)), F.count_distinct("query_id")).first()
    blocks = max(1, -(-rows // block_terms), -(-n // block_queries))
    weights = weights.withColumn("block", _hashed("query_id", blocks))
    met = weights.groupBy("term_no").agg(F.collect_set("block").alias("blocks"))
    cells = max(-(-(total or 0) // cell_docs), _shuffle_parts(spark))
    parts = max(-(-(total or 0) * blocks // CELL_DOCS), _shuffle_parts(spark))
    return _Asked(weights, written(known.join(met, "term_no").select("term", "term_no", "blocks"), "asked-terms"), blocks, cells, mean or 0.0, parts)


def _shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _hashed(column: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def _hits(index: Index, asked: _Asked, id_col: str) -> DataFrame:
    """(block, cell, _id, term_no, gain) of the postings of asked terms: BM25 without the idf. Postings are not shuffled to meet their terms."""
    gain = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(asked.mean)))
    met = index.postings.join(asked.terms, "term").select(F.col(id_col).alias("_id"), "term_no", gain.alias("gain"), "blocks")
    return met.select(F.explode("blocks").alias("block"), _hashed("_id", asked.cells).alias("cell"), "_id", "term_no", "gain")


def _every_cell(rows: DataFrame, cells: int) -> DataFrame:
    return rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


class _Scorer:
    """Scores of one cell of documents against one block of queries, some documents at a time."""

    def __init__(self, query_ids: np.ndarray, q: np.ndarray, term: np.ndarray, idf: np.ndarray, ids: np.ndarray, d: np.ndarray, hit: np.ndarray, gain: np.ndarray):
        self.query_ids, self.ids = query_ids, ids
        terms, t = np.unique(term, return_inverse=True)
        self.weights = np.zeros((len(terms), len(query_ids)))
        self.weights[t, q] = idf
        order = np.argsort(d, kind="stable")
        self.d, self.t, self.gain = d[order], np.searchsorted(terms, hit[order]), gain[order]

    def __iter__(self) -> Iterator[tuple[slice, np.ndarray]]:
        """(documents, queries x documents); 0 where they share no term."""
        most = max(1, MATRIX_CELLS // max(1, len(self.query_ids), len(self.weights)))
        for a in range(0, len(self.ids), most):
            b = min(a + most, len(self.ids))
            rows = slice(*np.searchsorted(self.d, [a, b]))
            used, column = np.unique(self.t[rows], return_inverse=True)
            gains = np.zeros((b - a, len(used)))
            gains[self.d[rows] - a, column] = self.gain[rows]
            yield slice(a, b), (gains @ self.weights[used]).T


def _text_scorer(asked: pa.Table, held: pa.Table) -> _Scorer:
    query_ids, q = np.unique(_numbers(asked["query_id"]), return_inverse=True)
    ids, d = np.unique(_numbers(held["_id"]), return_inverse=True)
    return _Scorer(query_ids, q, _numbers(asked["term_no"]), _numbers(asked["idf"]), ids, d, _numbers(held["term_no"]), _numbers(held["gain"]))


def keyword_candidates(queries: DataFrame, index: Index, k: int, id_col: str = "doc_id", block_queries: int = BLOCK_QUERIES, block_terms: int = BLOCK_TERMS, cell_docs: int = CELL_DOCS) -> DataFrame:
    """Exact BM25: the best ``k`` of each cell per query (query_id, id, score, low, high).

    A frequent word makes nearly every document match nearly every query, so a row per
    matching pair would be all pairs. Queries are cut into blocks and documents into cells;
    a group is the postings of one cell for the terms of one block, it multiplies its
    matrices and keeps ``k`` per query. One plan for any batch; no term and no document is left out.
    """
    asked = _asked(queries, index, block_queries, block_terms, cell_docs)
    schema = best_schema(queries.schema["query_id"].dataType, index.postings.schema[id_col].dataType)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([], schema)
        scorer = _text_scorer(left, right)
        kept = _Best(len(scorer.query_ids), k)
        for docs, scores in scorer:
            kept.add(scorer.ids[docs], np.round(scores, 4), scores > 0)
        return _table(kept.frames(scorer.query_ids), schema)

    left, right = asked.dealt(_every_cell(asked.weights, asked.cells)), asked.dealt(_hits(index, asked, id_col))
    found = left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInArrow(best, schema)
    return found.withColumnRenamed("_id", id_col)


def keyword_search(queries: DataFrame, index: Index, k: int = DEFAULT_LIMIT, id_col: str = "doc_id", **how) -> DataFrame:
    found = keyword_candidates(queries, index, k, id_col, **how).select("query_id", id_col, "score")
    return top_per_key(found, ["query_id"], [F.desc("score"), F.col(id_col)], k, rank="rank")


# -- vector ----------------------------------------------------------------------


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero row stays zero."""
    m = m.astype("float64")
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1, norms)


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy())


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow column that are not NULL, one per row, without a Python object per value."""
    held = column.drop_null()
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def _out(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        yield pa.RecordBatch.from_pandas(frame, preserve_index=False)


def _table(frames: Iterable[pd.DataFrame], schema: T.StructType) -> pa.Table:
    own = list(frames)
    arrow = to_arrow_schema(schema)
    return pa.concat_tables([pa.Table.from_pandas(f[schema.names], arrow, preserve_index=False) for f in own]) if own else arrow.empty_table()


def first_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, equal scores by id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        held = np.nonzero(scores >= cut)[0]
    else:
        held = np.arange(len(scores))
    return held[np.lexsort((ids[held], -scores[held]))][:k]


class _Best:
    """The best k of a stream of scored batches for each query, with the lowest and highest score met."""

    def __init__(self, queries: int, k: int):
        self.k, self.kept = k, [None] * queries
        self.low, self.high = np.full(queries, np.inf), np.full(queries, -np.inf)

    def add(self, ids: np.ndarray, scores: np.ndarray, valid: np.ndarray | None = None) -> None:
        """``scores`` is queries x ids; entries that are not ``valid`` do not count."""
        for q in range(len(self.kept)):
            s, i = (scores[q], ids) if valid is None else (scores[q][valid[q]], ids[valid[q]])
            if not len(s):
                continue
            self.low[q], self.high[q] = min(self.low[q], s.min()), max(self.high[q], s.max())
            pick = first_k(s, i, self.k)
            s, i = s[pick], i[pick]
            if self.kept[q] is not None:
                s, i = np.concatenate([self.kept[q][0], s]), np.concatenate([self.kept[q][1], i])
                pick = first_k(s, i, self.k)
                s, i = s[pick], i[pick]
            self.kept[q] = (s, i)

    def frames(self, query_ids: np.ndarray) -> Iterator[pd.DataFrame]:
        for q, found in enumerate(self.kept):
            if found is not None:
                yield pd.DataFrame({"query_id": query_ids[q], "_id": found[1], "score": found[0], "low": self.low[q], "high": self.high[q]})


def _best(query_ids: np.ndarray, queries: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[pd.DataFrame]:
    """Best k of corpus batches (ids, vectors) by cosine."""
    best, step = _Best(len(query_ids), k), max(1, MATRIX_CELLS // max(1, len(query_ids)))
    for ids, vectors in batches:
        for a in range(0, len(ids), step):
            best.add(ids[a : a + step], np.round(queries @ unit_rows(vectors[a : a + step]).T, 4) + 0.0)
    yield from best.frames(query_ids)


def best_schema(query_id: T.DataType, item_id: T.DataType) -> T.StructType:
    types = {"query_id": query_id, "_id": item_id, "score": T.DoubleType(), "low": T.DoubleType(), "high": T.DoubleType()}
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def numbers_below(n: Column | int) -> Column:
    """One row per number from 0 to n - 1."""
    top = n if isinstance(n, Column) else F.lit(n)
    return F.explode(F.sequence(F.lit(0).cast("long"), (top - 1).cast("long")))


def vector_candidates(queries: DataFrame, corpus: DataFrame, k: int, id_col: str = "doc_id", vector: str = "embedding", max_broadcast: int = MAX_BROADCAST_QUERIES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact cosine: the best ``k`` of each part of the corpus per query (query_id, id, score, low, high).

    The score of a pair never becomes a row: a task multiplies its vectors with the query
    matrix and keeps ``k`` rows per query. A batch of at most ``max_broadcast`` queries is
    sent to the tasks, and the corpus is scanned where it lies. A larger batch is cut: queries
    into blocks, the corpus into cells of about ``cell_rows``, and each (block, cell) is one
    group of bounded size.
    """
    spark = queries.sparkSession
    q = queries.select("query_id", F.col(vector).alias("_v")).filter(F.col("_v").isNotNull())
    c = corpus.select(F.col(id_col).alias("_id"), F.col(vector).alias("_v")).filter(F.col("_v").isNotNull())
    schema = best_schema(q.schema["query_id"].dataType, c.schema["_id"].dataType)
    head = q.limit(max_broadcast + 1).toPandas()
    if len(head) <= max_broadcast:
        if head.empty:
            return spark.createDataFrame([], schema).withColumnRenamed("_id", id_col)
        ids, matrix = head["query_id"].to_numpy(), unit_rows(stacked(head["_v"]))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs = ((np.asarray(b.column("_id").to_pylist()), _matrix(b.column("_v"))) for b in batches if b.num_rows)
            return _out(_best(ids, matrix, pairs, k))

        return c.mapInArrow(scan, schema).withColumnRenamed("_id", id_col)

    blocks = -(-q.count() // max_broadcast)
    cells = max(1, -(-c.count() // cell_rows))
    left = q.withColumns({"_block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)), "_cell": numbers_below(cells)})
    right = c.withColumns({"_cell": F.pmod(F.xxhash64("_id"), F.lit(cells)), "_block": numbers_below(blocks)})

    return best_in_cells(left, right, ["_block", "_cell"], k, schema).withColumnRenamed("_id", id_col)


def best_in_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], k: int, schema: T.StructType) -> DataFrame:
    """Best ``k`` of ``right`` (_id, _v) for each row of ``left`` (query_id, _v) within groups of bounded size."""

    def one_cell(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame(columns=schema.fieldNames())
        corpus = [(np.asarray(held["_id"].tolist()), stacked(held["_v"]))]
        return pd.concat(_best(asked["query_id"].to_numpy(), unit_rows(stacked(asked["_v"])), iter(corpus), k))

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(one_cell, schema)


def vector_search(queries: DataFrame, corpus: DataFrame, k: int = DEFAULT_LIMIT, id_col: str = "doc_id", vector: str = "embedding", **how) -> DataFrame:
    found = vector_candidates(queries, corpus, k, id_col, vector, **how).select("query_id", id_col, "score")
    return top_per_key(found, ["query_id"], [F.desc("score"), F.col(id_col)], k, rank="rank")


# -- hybrid ----------------------------------------------------------------------


def _scaled(scores: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1 within a query; 1 when all its scores are equal. A query without scores has no range."""
    wide = high > low
    return np.where(wide, (scores - np.where(wide, low, 0.0)) / np.where(wide, high - np.where(wide, low, 0.0), 1.0), 1.0)


def _with_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows of terms, and behind them rows that carry a vector in place of a term."""
    return rows.unionByName(vectors, allowMissingColumns=True)


def _no_null_vectors(rows: DataFrame) -> DataFrame:
    """Rows of terms with an empty vector: Arrow goes back over the whole run of nulls before it for each null of a list column."""
    return rows.withColumn("_v", F.coalesce("_v", F.array().cast(rows.schema["_v"].dataType)))


class _Both(_Scorer):
    """As :class:`_Scorer`, with the cosine where both sides have a vector."""

    def __init__(self, asked: pa.Table, held: pa.Table):
        query_ids, q = np.unique(_numbers(asked["query_id"]), return_inverse=True)
        ids, d = np.unique(_numbers(held["_id"]), return_inverse=True)
        text, hit = (pc.is_valid(t["term_no"]).to_numpy() for t in (asked, held))
        words, postings = asked.filter(pa.array(text)), held.filter(pa.array(hit))
        super().__init__(query_ids, q[text], _numbers(words["term_no"]), _numbers(words["idf"]), ids, d[hit], _numbers(postings["term_no"]), _numbers(postings["gain"]))
        self.has_query, self.query_vectors = self._placed(asked, ~text, q, len(query_ids))
        self.has_doc, self.doc_vectors = self._placed(held, ~hit, d, len(ids))

    @staticmethod
    def _placed(rows: pa.Table, vector: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        has = np.zeros(n, bool)
        has[at[vector]] = True
        matrix = _matrix(rows.filter(pa.array(vector))["_v"].combine_chunks()) if vector.any() else np.zeros((0, 1))
        out = np.zeros((n, matrix.shape[1]))
        out[at[vector]] = unit_rows(matrix)
        return has, out

    def legs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, text score, whether it applies, cosine, whether it applies)."""
        for docs, text in self:
            both = self.has_query[:, None] & self.has_doc[docs][None, :]
            near = np.zeros_like(text)
            if both.any():
                near = np.where(both, np.round(self.query_vectors @ self.doc_vectors[docs].T, 4) + 0.0, 0.0)
            yield self.ids[docs], np.round(text, 4), text > 0, near, both


_LEGS = ["text_low", "text_high", "near_low", "near_high"]


def hybrid_candidates(
    queries: DataFrame, corpus: DataFrame, index: Index, profiles: Sequence[str], k: int, id_col: str = "doc_id", vector: str = "embedding",
    block_queries: int = BLOCK_QUERIES, block_terms: int = BLOCK_TERMS, cell_docs: int = CELL_DOCS,
) -> DataFrame:
    """The best ``k`` of each cell per query and profile (query_id, id, score, profile).

    Both scores are scaled per query to 0..1 over the documents they apply to and averaged by
    the weights of the profile; a leg that does not apply counts 0. Postings and vectors of a
    cell meet the terms and vectors of a block, as in keyword search: a first pass finds the
    ranges of both legs, the second scores them at once and keeps ``k`` per query: exact, and no pair becomes a row.
    Both are one plan, so that postings and vectors are met and shuffled once and both passes read that shuffle.
    How the legs are joined is our choice; no reranker follows.
    """
    asked = _asked(queries, index, block_queries, block_terms, cell_docs)
    query_id, item = queries.schema["query_id"].dataType, index.postings.schema[id_col].dataType
    base = best_schema(query_id, item)
    schema = T.StructType([*base.fields[:3], T.StructField("profile", T.StringType())])
    ranged = T.StructType([base.fields[0], *[T.StructField(n, T.DoubleType()) for n in _LEGS]])
    query_vectors = queries.filter(F.col(vector).isNotNull()).select("query_id", F.col(vector).alias("_v"), _hashed("query_id", asked.blocks).alias("block"))
    left = written(_with_vectors(asked.weights, query_vectors), "asked")
    vectors = corpus.filter(F.col(vector).isNotNull()).select(F.col(id_col).alias("_id"), F.col(vector).alias("_v"), _hashed(id_col, asked.cells).alias("cell"))
    every_block = vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(asked.blocks - 1))))
    right = asked.dealt(_with_vectors(_hits(index, asked, id_col), every_block))

    def in_cells(own: DataFrame):
        return _no_null_vectors(asked.dealt(_every_cell(own, asked.cells))).groupBy("block", "cell").cogroup(_no_null_vectors(right).groupBy("block", "cell"))

    def ranges(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return _table([], ranged)
        own = _Both(a, b)
        low, high = np.full((2, len(own.query_ids)), np.inf), np.full((2, len(own.query_ids)), -np.inf)
        for _, text, has_text, near, has_near in own.legs():
            for i, (x, has) in enumerate(((text, has_text), (near, has_near))):
                low[i] = np.minimum(low[i], np.where(has, x, np.inf).min(axis=1))
                high[i] = np.maximum(high[i], np.where(has, x, -np.inf).max(axis=1))
        return _table([pd.DataFrame(dict(zip(ranged.names, (own.query_ids, low[0], high[0], low[1], high[1]))))], ranged)

    def fused(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return _table([], schema)
        own = _Both(a, b)
        first = np.unique(_numbers(a["query_id"]), return_index=True)[1]
        text_low, text_high, near_low, near_high = (_numbers(a[n])[first][:, None] for n in _LEGS)
        best = {p: _Best(len(own.query_ids), k) for p in profiles}
        for ids, text, has_text, near, has_near in own.legs():
            t = np.where(has_text, _scaled(text, text_low, text_high), 0.0)
            v = np.where(has_near, _scaled(near, near_low, near_high), 0.0)
            for p in profiles:
                wt, wv = PROFILES[p]
                best[p].add(ids, np.round((t * wt + v * wv) / (wt + wv), 10), has_text | has_near)
        return _table([f.assign(profile=p) for p in profiles for f in best[p].frames(own.query_ids)], schema)

    seen = in_cells(left).applyInArrow(ranges, ranged).groupBy("query_id").agg(*[(F.min if n.endswith("low") else F.max)(n).alias(n) for n in _LEGS])
    return in_cells(left.join(seen, "query_id")).applyInArrow(fused, schema).withColumnRenamed("_id", id_col)


def _ranked(found: DataFrame, k: int, id_col: str) -> DataFrame:
    best = top_per_key(found, ["profile", "query_id"], [F.desc("score"), F.col(id_col)], k, rank="rank")
    return best.withColumn("score", F.round("score", 4))


def hybrid(queries: DataFrame, corpus: DataFrame, index: Index, profile: str = "default", k: int = DEFAULT_LIMIT, id_col: str = "doc_id", vector: str = "embedding", **how) -> DataFrame:
    found = hybrid_candidates(queries, corpus, index, [profile], k, id_col, vector, **how)
    return _ranked(found, k, id_col).select("query_id", id_col, "score", "rank")


def compare_profiles(queries: DataFrame, corpus: DataFrame, index: Index, profiles: Sequence[str] = tuple(PROFILES), k: int = 3, id_col: str = "doc_id", vector: str = "embedding") -> DataFrame:
    """The results of one query under each profile side by side, by rank. All profiles come from the same passes."""
    ranked = _ranked(hybrid_candidates(queries, corpus, index, profiles, k, id_col, vector), k, id_col)
    return ranked.groupBy("query_id", "rank").pivot("profile", list(profiles)).agg(F.first(id_col))


def explain_codes(top_codes: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text: str = "chunk_text", code: str = "violation_code") -> DataFrame:
    """Codes found in data, joined to the passages that mention them.

    ``top_codes`` is a report of a few codes; passages meet it before they are made
    distinct, so only mentions of those codes are shuffled.
    """
    mentions = chunks.select(id_col, F.explode_outer(all_codes(F.col(text))).alias("_mention")).filter(F.col("_mention").isNotNull())
    bare = mentions.select(id_col, F.regexp_replace("_mention", r"[*+]", "").alias(code))
    met = bare.join(top_codes.select(code).distinct(), code, "left_semi").distinct()
    return top_codes.join(met, code)
