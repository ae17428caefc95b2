"""Near-duplicates by 64-bit SimHash, found through anchor points of a covering code.

Two fingerprints at three or fewer differing bits differ in at most one bit of one of
their two 31-bit parts. The code words of the perfect Hamming code of length 31 are the
anchors of each part: every word lies within the covering radius 1 of exactly one of them,
its home. A fingerprint is replicated to every anchor within radius 1 plus threshold 1, so
it meets the home of each partner, and is compared there on all 64 bits.

Equal fingerprints are one row from the start. An anchor with many fingerprints is cut
into tiles of bounded size, each pair of blocks being one tile; a tile returns a spanning
forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.llm.base import filled, id_key, pack, query, slots, table
from clearplate.llm.components import components
from clearplate.session import written

SEED = 42
SHINGLE = 3
BITS = 3
PART = 31
BLOCK = 2048
STEP = 1 << 17

# A-Z to a-z, and the other white space to a blank.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\x0b\x0c\r", bytes(range(97, 123)) + b"     ")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text; zero for one without words.

    A long text is taken in steps, so the arrays stay bounded whatever its length.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        stop = min(n, at + STEP)
        first = ends[at - 1] + 1 if at else 0
        starts = np.concatenate(([first], ends[at : stop - 1] + 1)).tolist()
        cuts = ends[at + width - 1 : stop + width - 1].tolist()
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, cuts)), np.uint64, stop - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), filled(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _syndrome(v: Column) -> Column:
    """Position 1..31 whose bit leads from a 31-bit word to its code word; 0 for a code word."""
    bits = []
    for k in range(5):
        mask = sum(1 << (i - 1) for i in range(1, PART + 1) if i >> k & 1)
        bits.append((F.bit_count(v.bitwiseAND(F.lit(mask).cast("long"))) % 2).cast("int") * (1 << k))
    return sum(bits[1:], bits[0])


def _flip(i: Column) -> Column:
    """The word with bit ``i`` set, for i = 1..31; 0 for i = 0."""
    return F.call_function("shiftright", F.call_function("shiftleft", F.lit(1).cast("long"), i), F.lit(1))


def anchors(fps: DataFrame) -> DataFrame:
    """``part, anchor, fp, home``: every anchor within radius 2 of each part of each fingerprint."""
    out = []
    for part, shift in enumerate((0, 32)):
        v = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << PART) - 1).cast("long"))
        s = fps.select("fp", v.alias("v")).select("fp", "v", _syndrome(F.col("v")).alias("s"))
        home = F.col("v").bitwiseXOR(_flip(F.col("s")))
        pairs = F.filter(F.sequence(F.lit(1), F.lit(PART)), lambda i: (F.col("s") != 0) & (i < i.bitwiseXOR(F.col("s"))))
        near = F.transform(pairs, lambda i: F.col("v").bitwiseXOR(_flip(i)).bitwiseXOR(_flip(i.bitwiseXOR(F.col("s")))))
        all_ = F.concat(F.array(F.struct(home.alias("anchor"), F.lit(True).alias("home"))), F.transform(near, lambda a: F.struct(a.alias("anchor"), F.lit(False).alias("home"))))
        out.append(s.select(F.lit(part).alias("part"), "fp", F.explode(all_).alias("x")).select("part", "x.anchor", "fp", "x.home"))
    return out[0].union(out[1])


def forest(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever is linked at ``bits`` or fewer differing bits: a spanning forest."""
    left = np.arange(len(fps))
    a, b = [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            found = []
            for f in front:
                if not len(left):
                    break
                hit = np.bitwise_count(fps[left] ^ fps[f]) <= bits
                if hit.any():
                    new = left[hit]
                    a.append(np.full(len(new), f))
                    b.append(new)
                    found.append(new)
                    left = left[~hit]
            front = np.concatenate(found) if found else left[:0]
    empty = np.zeros(0, np.int64)
    return (fps[np.concatenate(a)], fps[np.concatenate(b)]) if a else (fps[empty], fps[empty])


def _tiles(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Links of rows that lie together by tile, small tiles many at a time."""

    def links(df: pd.DataFrame) -> pd.DataFrame:
        fps = df["fp"].to_numpy(np.int64).view(np.uint64)
        starts = np.flatnonzero(np.concatenate(([True], (df[key].to_numpy()[1:] != df[key].to_numpy()[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(df)))
        a, b = [], []
        for size in np.unique(sizes):
            at = starts[sizes == size]
            if size == 1:
                continue
            if size <= 16:
                rows = fps[at[:, None] + np.arange(size)]
                for i in range(size - 1):
                    hit = np.bitwise_count(rows[:, i : i + 1] ^ rows[:, i + 1 :]) <= bits
                    r, c = np.nonzero(hit)
                    a.append(rows[r, i])
                    b.append(rows[r, i + 1 + c])
            else:
                for s in at:
                    x, y = forest(fps[s : s + size], bits)
                    a.append(x)
                    b.append(y)
        empty = np.zeros(0, np.uint64)
        a, b = np.concatenate([*a, empty]), np.concatenate([*b, empty])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    key = ["part", "anchor", "i", "j"]
    rest = None
    for df in batches:
        df = df if rest is None else pd.concat([rest, df], ignore_index=True)
        last = (df[key].to_numpy() != df[key].iloc[-1].to_numpy()).any(axis=1) if len(df) else np.zeros(0, bool)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        rest = df.iloc[cut:]
        yield links(df.iloc[:cut])
    if rest is not None and len(rest):
        yield links(rest)


def links(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect whatever links at ``bits`` or fewer bits connect. ``fps`` holds each ``fp`` once."""
    if bits > 3:
        raise ValueError("two parts with threshold 1 each cover three differing bits")
    cells = written(anchors(fps), "anchors")
    sizes = cells.groupBy("part", "anchor").agg(F.count("*").alias("n"), F.max("home").alias("met")).filter("n > 1 and met")
    met = cells.join(written(sizes, "sizes"), ["part", "anchor"])
    blocks = met.select("part", "anchor", "fp", F.ceil(F.col("n") / block).cast("int").alias("k")).withColumn("own", F.pmod(F.hash("fp"), F.col("k")))
    tiles = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    tiles = tiles.select("part", "anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    keys = ["part", "anchor", "i", "j"]
    tiles = tiles.repartition(slots(fps.sparkSession), *keys).sortWithinPartitions(*keys)
    return tiles.mapInPandas(lambda batches: _tiles(batches, bits), "a long, b long").distinct()


def _placed(docs: DataFrame, doc_id: str, text: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents; and each fingerprint once, with its smallest id and the root of its group."""
    prints = written(fingerprints(docs, doc_id, text), "prints")
    groups = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    roots = written(components(links(groups.select("fp"), bits)), "roots")
    placed = groups.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return prints, written(placed, "placed")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Documents whose fingerprints differ in ``bits`` or fewer bits are linked; the component
    is the smallest id that links reach. Null and empty texts have fingerprint zero and are
    linked like any other; fewer words than a shingle are one shingle. Null ids never name
    a component unless all its ids are null. Repeated rows return repeated rows; other
    columns of any name are ignored; an empty table gives no rows.
    """
    prints, placed = _placed(docs, doc_id, text, bits)
    least = written(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least-id")
    named = written(placed.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_fingerprint(docs: DataFrame, text: str) -> DataFrame:
    """Every row as struct ``doc`` with its fingerprint ``fp``."""
    at = docs.columns.index(text)
    schema = T.StructType([*pack(docs).schema.fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py() or "") for t in batch.column(0).field(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc", "fp"])

    return pack(docs).mapInArrow(run, schema)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row of each group, one with the smallest id; all columns of any name pass through.

    The choice is one id and fingerprint for each group, and a fingerprint lies in one group
    only. So an id on texts of several groups can stand for each of them, and of rows whose
    ids are all null every group still keeps one. Where the smallest id has several
    fingerprints in its group, the smallest of these stays; of equal pairs, any one row.
    """
    _, placed = _placed(docs, doc_id, text, bits)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp"))
    kept = placed.groupBy("root").agg(first.alias("x")).select(id_key("x.least").alias("key"), F.col("x.fp").alias("fp"))
    rows = _with_fingerprint(docs, text).withColumn("key", id_key(f"doc.`{doc_id}`"))
    return rows.join(written(kept, "kept"), ["key", "fp"]).dropDuplicates(["key", "fp"]).select("doc.*")


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
