"""Merkle manifest of a dataset: a content-addressed graph of digests, proofs by descent from the root.

Documents are leaves. Those of one tree (here: one language) lie in order, and every run of
ARITY nodes becomes one node until one is left, the subroot; subroots become the root alike.
The graph is stored as records from a digest to its children, and nothing else is needed to
prove a leaf: a request starts at the root, looks up the record of the digest it is at, goes
on to the child that the next digit of its rank names, and collects the children it does not
select. The path so collected, reversed segment by segment, is the proof.

Records of LEVELS levels below one node lie together as a page, found by the digest at its
top, so a descent is one join per page and not one per level. Requests go down together:
above the leaves a page is visited once however many requests pass through it, and the path
above is carried once per page. Only pages and digests are shuffled, never texts; no task
sees more than a page of one tree, however large the tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearplate.llm.base import let, query, slots, table
from clearplate.session import written

ARITY = 2
LEVELS = 8
PATH = "array<struct<left: string, right: string>>"


def digest(text: Column) -> Column:
    """SHA-256 as lower-case hex."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that neighbouring values cannot be told apart in two ways; null is ``-``."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """The rows with their ``rank`` in the order, from 0 in each tree, and the tree's number ``n`` of rows.

    Rows are laid out by range, so a tree of any size is spread over many tasks; each range
    counts its own rows and a table of counts, a row for each range and tree, gives what
    lies before. Equal rows are told apart by their place in the input.
    """
    keys = [tree, *order, "_row"]
    laid = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(slots(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    laid = written(laid.select(*rows.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "laid")
    own = laid.groupBy(tree, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(own.select(tree, "_part", (before - F.col("_first")).alias("_offset"), F.sum("_n").over(whole).alias("n")), "offsets")
    return laid.join(offsets, [tree, "_part"]).select(*rows.columns, (F.col("_at") + F.col("_offset")).alias("rank"), "n")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long")) if by > 1 else value


def _grown(nodes: Column, height: Column, arity: int) -> Column:
    """Records of each level over some nodes, lowest first; the first level has the nodes themselves."""
    level = "array<struct<digest: string, children: array<string>>>"
    start = F.array(F.transform(nodes, lambda d: F.struct(d.alias("digest"), F.array().cast("array<string>").alias("children")))).cast(f"array<{level}>")

    def up(below: Column) -> Column:
        def record(own: Column, j: Column) -> Column:
            return let(F.slice(own, j * arity + 1, F.lit(arity)), lambda kids: F.struct(digest(F.array_join(kids, "")).alias("digest"), kids.alias("children")))

        runs = lambda own: F.sequence(F.lit(0), F.floor((F.size(own) - 1) / arity).cast("int"))
        return let(F.transform(F.element_at(below, -1), lambda x: x["digest"]), lambda own: F.transform(runs(own), lambda j: record(own, j)))

    steps = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, lambda below, _: F.concat(below, F.array(up(below))).cast(f"array<{level}>"))


@dataclass
class Forest:
    """Trees over ranked nodes: pages by layer (``tree, chunk, digest, height, records, n``), lowest first."""

    pages: list[DataFrame]
    arity: int
    levels: int

    @property
    def span(self) -> int:
        return self.arity**self.levels

    def tops(self) -> DataFrame:
        """``tree, digest, layers``: the last node of each tree, and the pages above each of its leaves."""
        own = [p.filter(F.col("n") <= self.span).select("tree", "digest", F.lit(k + 1).alias("layers")) for k, p in enumerate(self.pages)]
        return reduce(DataFrame.union, own)

    def records(self) -> DataFrame:
        """``digest, children``: the whole graph, each record once."""
        own = [p.select(F.explode("records").alias("digest", "children")) for p in self.pages]
        return reduce(DataFrame.union, own).distinct()


def grow(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> Forest:
    """The forest over ``tree, rank, digest, n``. A lone leaf is its own top."""
    if arity < 2 or arity**levels > 1 << 16:
        raise ValueError("a page holds at most 65,536 nodes of a level")
    span = arity**levels
    pages: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        runs = nodes.groupBy("tree", _div(F.col("rank"), span).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("own"), F.max("n").alias("n"))
        height = sum((F.when(F.col("n") > arity**k, 1).otherwise(0) for k in range(levels)), F.lit(0))
        made = runs.select("tree", "chunk", "n", height.alias("height"), F.col("own.digest").alias("own"))
        made = made.select("tree", "chunk", "n", "height", _grown(F.col("own"), F.col("height"), arity).alias("grown"))
        records = F.map_from_entries(F.array_distinct(F.flatten(F.slice("grown", 2, levels))))
        pages.append(written(made.select("tree", "chunk", "n", "height", F.element_at("grown", -1)[0]["digest"].alias("digest"), records.alias("records")), f"pages-{len(pages)}"))
        if most <= span:
            return Forest(pages, arity, levels)
        nodes = pages[-1].filter(F.col("n") > span).select("tree", F.col("chunk").alias("rank"), "digest", F.ceil(F.col("n") / span).alias("n"))
        most = -(-most // span)


def descend(forest: Forest, start: DataFrame, requests: DataFrame) -> DataFrame:
    """``tree, above, asked, digest, path`` for each request: where its descent ends, and what it passed by.

    ``start``: ``tree, digest, layers, path, above``, one row for each tree, at its top, with the path
    that led there and any struct of values to carry along. ``requests``: ``tree, rank, asked``, with
    any struct ``asked``. The path runs from the root down.
    """
    arity, span = forest.arity, forest.span
    wanted = [requests]
    for _ in forest.pages[1:]:
        wanted.append(wanted[-1].select("tree", _div(F.col("rank"), span).alias("rank")).distinct().withColumn("asked", F.lit(None).cast("string")))
    powers = F.array(*[F.lit(arity**k) for k in range(forest.levels)])

    def step(at: Column, k: Column) -> Column:
        """Down one level: ``k`` levels lie below the child."""
        digit = F.floor(F.col("local") / F.element_at(powers, k + 1)).cast("int") % arity

        def onto(kids: Column) -> Column:
            beside = F.struct(F.array_join(F.slice(kids, F.lit(1), digit), "").alias("left"), F.array_join(F.slice(kids, digit + 2, F.lit(arity)), "").alias("right"))
            return F.struct(F.element_at(kids, digit + 1).alias("digest"), F.concat(at["path"], F.array(beside)).alias("path"))

        return let(F.element_at(F.col("records"), at["digest"]), onto).cast(f"struct<digest: string, path: {PATH}>")

    places = start.withColumn("rank", F.lit(0).cast("long"))
    for layer in range(len(forest.pages) - 1, -1, -1):
        asks = wanted[layer].groupBy("tree", _div(F.col("rank"), span).alias("chunk")).agg(F.collect_list(F.struct((F.col("rank") % span).cast("int").alias("local"), "asked")).alias("asks"))
        page = forest.pages[layer].select(F.col("digest").alias("top"), "height", "records").dropDuplicates(["top"])
        here = places.filter(F.col("layers") > layer).withColumnRenamed("rank", "chunk").join(asks, ["tree", "chunk"])
        here = here.join(page, F.col("digest") == F.col("top")).select("tree", "chunk", "layers", "above", "digest", "path", "height", "records", F.explode("asks").alias("ask"))
        here = here.select("*", F.col("ask.local").alias("local"), F.col("ask.asked").alias("asked"))
        downward = F.when(F.col("height") > 0, F.sequence(F.col("height") - 1, F.lit(0))).otherwise(F.array().cast("array<int>"))
        first = F.struct(F.col("digest"), F.col("path")).cast(f"struct<digest: string, path: {PATH}>")
        here = here.select("tree", "layers", "above", "asked", (F.col("chunk") * span + F.col("local")).alias("rank"), F.aggregate(downward, first, step).alias("end"))
        here = here.select("tree", "layers", "above", "asked", "rank", "end.digest", "end.path")
        if not layer:
            return here.select("tree", "above", "asked", "digest", "path")
        waiting = places.filter(F.col("layers") <= layer)
        places = written(here.drop("asked").unionByName(waiting), f"places-{layer}")
    raise AssertionError("a forest has a page layer")


def upward(path: Column) -> Column:
    """The segments of a path from the leaf to the root."""
    return F.reverse(path)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof, from the leaf up, come to."""
    return F.aggregate(proof, leaf, lambda own, s: digest(F.concat(s["left"], own, s["right"])))


@dataclass
class Manifest:
    """Ranked leaves (``tree, rank, n, leaf`` and other columns), and the forests below and above the subroots."""

    leaves: DataFrame
    trees: Forest
    names: DataFrame
    above: Forest

    def records(self) -> DataFrame:
        return self.trees.records().union(self.above.records()).distinct()

    def root(self) -> DataFrame:
        """One row ``root``; none for an empty table."""
        return self.above.tops().select(F.col("digest").alias("root"))


def build(leaves: DataFrame, *order: str, arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The manifest over ``tree, leaf`` and the columns of the order within a tree (nulls first).

    ``tree`` is text and never null; trees are ordered by its UTF-8 bytes. Leaves of one
    place in the order are ordered by digest, so it makes no difference which comes first.
    """
    own = written(ranked(leaves, "tree", *order, "leaf"), "leaves")
    trees = grow(own.select("tree", "rank", F.col("leaf").alias("digest"), "n"), arity, levels)
    tops = written(trees.tops(), "tops")
    names = written(ranked(tops.withColumn("all", F.lit("")), "all", "tree"), "trees")
    above = grow(names.select(F.col("all").alias("tree"), "rank", "digest", "n"), arity, levels)
    return Manifest(own, trees, names, above)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``tree, asked, leaf, subroot, root, proof``: the proof, from the leaf up, of each requested ``tree, rank, asked``.

    Requests of ranks or trees that do not exist get no row. A proof's segments have the digests
    to the left and to the right of the path in one run.
    """
    empty = F.array().cast(PATH)
    top = manifest.above.tops().select("tree", "digest", "layers", empty.alias("path"), F.struct(F.col("digest").alias("root")).alias("above"))
    asked = requests.select("tree").distinct()
    of_trees = manifest.names.join(asked, "tree").select(F.col("all").alias("tree"), "rank", F.struct(F.col("tree").alias("name"), "layers").alias("asked"))
    found = descend(manifest.above, top, of_trees)
    start = found.select(F.col("asked.name").alias("tree"), "digest", F.col("asked.layers").alias("layers"), "path", F.struct(F.col("digest").alias("subroot"), F.col("above.root").alias("root")).alias("above"))
    ends = descend(manifest.trees, written(start, "subroots"), requests)
    return ends.select("tree", "asked", F.col("digest").alias("leaf"), "above.subroot", "above.root", upward(F.col("path")).alias("proof"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, tampered`` of documents: a tree for each language, null first.

    ``tampered`` is the leaf with one more character claimed, where 7 divides the unsigned
    crc32 of the id and the number of characters is not null; else null.
    """
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [*values[:3], values[3] + 1, values[4]]
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(*values).alias("leaf"), F.when(chosen, leaf_digest(*changed)).alias("tampered"))


def audit(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Every document is requested, and its proof folded from the tampered leaf where there is
    one, else from the original. Null ids come first in their tree; a null language is a tree
    of its own. Rows with one id are ordered by digest; repeated rows are leaves of their own.
    Nulls of other columns are values. Texts of any length are hashed whole. Other columns of
    any name are ignored; an empty table gives no rows.
    """
    manifest = build(document_leaves(docs), "doc_id", arity=arity, levels=levels)
    requests = manifest.leaves.select("tree", "rank", F.struct("doc_id", "tampered").alias("asked"))
    proofs = prove(manifest, requests)
    folded = fold(F.coalesce("asked.tampered", "leaf"), F.col("proof"))
    seen = digest(F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), ""))
    out = proofs.select("asked.doc_id", "leaf", "subroot", "root", seen.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang"))
SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, n_chars, coalesce('=' || lang, '') AS g, row_number() OVER () AS id,
    sha256({_HEAD} || {_FIELD.format("n_chars")} || {_FIELD.format("text")}) AS leaf,
    sha256({_HEAD} || {_FIELD.format("(n_chars + 1)")} || {_FIELD.format("text")}) AS changed,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS crc
  FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS r,
    CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN changed ELSE leaf END AS shown
  FROM d),
n AS (
  SELECT 0 AS lvl, g, r, leaf AS h FROM l
  UNION ALL
  SELECT lvl + 1, g, r // 2, sha256(string_agg(h, '' ORDER BY r)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM n) WHERE c > 1 GROUP BY lvl, g, r // 2),
s AS (SELECT g, h, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS r FROM (SELECT *, max(lvl) OVER (PARTITION BY g) AS top FROM n) WHERE lvl = top),
m AS (
  SELECT 0 AS lvl, r, h FROM s
  UNION ALL
  SELECT lvl + 1, r // 2, sha256(string_agg(h, '' ORDER BY r)) FROM (SELECT *, count(*) OVER () AS c FROM m) WHERE c > 1 GROUP BY lvl, r // 2),
t AS (SELECT h AS root, lvl AS height FROM m ORDER BY lvl DESC LIMIT 1),
k AS (SELECT unnest(range(64)) AS k),
steps AS (
  SELECT l.id, k.k AS pos, (l.r >> k.k) & 1 AS side, coalesce(n.h, '') AS sib
  FROM l JOIN s USING (g) JOIN k ON k.k < s.height LEFT JOIN n ON n.g = l.g AND n.lvl = k.k AND n.r = xor(l.r >> k.k, 1)
  UNION ALL
  SELECT l.id, s.height + k.k AS pos, (s.r >> k.k) & 1, coalesce(m.h, '')
  FROM l JOIN s USING (g) CROSS JOIN t JOIN k ON k.k < t.height LEFT JOIN m ON m.lvl = k.k AND m.r = xor(s.r >> k.k, 1)),
f AS (
  SELECT id, 0 AS pos, shown AS h FROM l
  UNION ALL
  SELECT f.id, f.pos + 1, sha256(CASE WHEN side = 1 THEN sib || f.h ELSE f.h || sib END) FROM f JOIN steps ON steps.id = f.id AND steps.pos = f.pos),
p AS (SELECT id, sha256(string_agg(sib, '' ORDER BY pos)) AS proof FROM steps GROUP BY id)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.root AS verified
FROM l JOIN s USING (g) CROSS JOIN t JOIN f ON f.id = l.id AND f.pos = s.height + t.height LEFT JOIN p ON p.id = l.id
"""


@query("op11_merkle", SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
