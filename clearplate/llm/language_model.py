"""Trigram language model in Elias-Fano tries, built by Spark and memory-mapped by its tasks.

Level 1 holds the words: sorted 64-bit hashes, and running sums of their counts; a word's id
is its rank. Level 2 holds, for each word, the words seen behind it; level 3 the words seen
behind each pair. A level is cut into shards by context. A shard keeps, as monotone
sequences, pointers from its contexts to their successors, and the successors' ids made
monotone by adding the context's number times the vocabulary. A look-up goes through the
pointers to the context's range and searches the successor relative to the context.

Probabilities are smoothed by absolute discounting with interpolation: what the kept
successors of a context leave over goes to the next shorter context, and at the end to
add-one unigrams. Level 2 and 3 keep n-grams seen at least MIN_COUNT times, in the query all; both the
probabilities and the weights left over are quantised to one byte of a log scale.

Texts are cut into words twice: to count the words, and to write their ids, from which n-grams
are counted and texts scored.

Counts: each task sums its own n-grams, sorts and compresses them into one block per
bucket; blocks are shuffled by bucket and merged, and a bucket becomes a shard at once. Buckets
are runs of contexts with some SHARD tokens, cut by the counts of the level below, so a task's
memory does not grow with the corpus. A word that is a third of all tokens is one number per task by then. Trigrams are counted only where both bigrams are kept, which
loses none that reach MIN_COUNT. Shards are files in the shared folder, so a lost executor
loses none; a task run again writes the same file again. No count, id or level passes
through the driver, only the list of shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.llm.base import filled, fold_of, pack, query, slots, table
from clearplate.llm.elias_fano import EliasFano, load, save
from clearplate.session import fresh_path, written

MIN_COUNT = 2
# Tokens whose n-grams one shard holds; a task builds one shard at a time.
SHARD = 1 << 21
DISCOUNT = 0.75
BATCH_CHARS = 1 << 22
BATCH_IDS = 5 << 19  # bytes of ids
LONG_WORD = 64
# One byte of log10: 0 is certainty, 255 the least.
STEP = 0.045

_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\x0b\x0c\r", bytes(range(97, 123)) + b"     ")
END = xxhash.xxh64_intdigest(b" ")  # no word holds a blank
_ALL = np.uint64((1 << 64) - 1)


def _code(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.clip(np.round(-np.log10(p) / STEP), 0, 255).astype(np.uint8)


_VALUE = -STEP * np.arange(256)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, one to one."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0x9E3779B97F4A7C15)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each token and the tokens of each text, which END closes.

    All words are hashed at once, eight bytes a step, and the few beyond LONG_WORD bytes one by one.
    """
    # No UTF-8 text holds the byte 255, so it stands for the end.
    raw = b" " + b"".join(x for t in texts for x in (t.encode("utf-8", "surrogatepass"), b" \xff ")).translate(_FOLD)
    blank = np.frombuffer(raw, np.uint8) == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eights = np.frombuffer(raw + bytes(-len(raw) % 8 + 16), np.uint64)
    out = _mixed(sizes.astype(np.uint64))
    own, at, left = slice(None), starts, sizes
    for step in range(0, min(int(sizes.max(initial=0)), LONG_WORD), 8):
        if step:
            own = np.flatnonzero(sizes > step)
            at, left = starts[own] + step, sizes[own] - step
        place, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        part = (eights[place] >> shift) | ((eights[place + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        out[own] = _mixed(out[own] ^ (part & (_ALL >> ((8 - np.minimum(left, 8)).astype(np.uint64) << np.uint64(3)))))
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(raw[starts[k] : starts[k] + sizes[k]])
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8)[starts] == 255)
    out[ends] = END
    return out, np.diff(ends, prepend=-1)


def _groups(texts: list[str] | list[bytes], most: int) -> Iterator[slice]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


# --- counting ---------------------------------------------------------------------------

_SHARDS = {"path": pa.string(), "first": pa.string(), "n": pa.int64(), "tokens": pa.int64(), "cuts": pa.list_(pa.int64())}
_BLOCKS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.BinaryType())])


def _squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, compressed; bytes of one place lie together."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype(np.int64)
    raw = len(keys).to_bytes(8, "little") + np.ascontiguousarray(steps).tobytes() + small.tobytes() + large.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _expand(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(raw[:8], "little")
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T)
    counts = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[8 + 9 * n :], np.int64)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64), counts


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys.astype(np.uint64), np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.diff(np.append(starts, len(keys))) if counts is None else np.add.reduceat(counts, starts)


def _counts_by_bucket(rows: DataFrame, keys_of: Callable[[], Callable[[list], np.ndarray]], bucket_of: Callable[[np.ndarray], np.ndarray], at_once: int, flush: int = 1 << 22) -> DataFrame:
    """Blocks of summed keys by bucket; a task sends what it holds whenever that reaches ``flush`` keys.

    ``rows`` has one column, of which some ``at_once`` characters or bytes are turned into keys at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_in, held, size = keys_of(), [], 0

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = _summed(np.concatenate(held))
            bucket = bucket_of(keys)
            order = np.argsort(bucket, kind="stable")
            keys, counts, bucket = keys[order], counts[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            blocks = [_squeeze(k, c) for k, c in zip(np.split(keys, cuts), np.split(counts, cuts))]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[np.concatenate(([0], cuts))].astype(np.int32)), pa.array(blocks, pa.binary())], names=["bucket", "block"])

        for batch in batches:
            values = batch.column(0).to_pylist()
            for part in _groups(values, at_once):
                held.append(keys_in(values[part]))
                size += len(held[-1])
                if size >= flush:
                    yield from send()
                    held, size = [], 0
        if size:
            yield from send()

    return rows.mapInArrow(run, _BLOCKS)


def _summed_by_bucket(blocks: DataFrame, build: Callable[[int, np.ndarray, np.ndarray], tuple], at_once: int = 1 << 21) -> DataFrame:
    """A row ``_SHARDS`` of ``build(bucket, keys, counts)`` for every bucket.

    Blocks of a bucket come one after the other and are summed whenever ``at_once`` keys are
    held, so a task holds the distinct keys of one bucket and not all that was sent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0

        def total() -> tuple[np.ndarray, np.ndarray]:
            keys, counts = zip(*held)
            return _summed(np.concatenate(keys), np.concatenate(counts))

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(build(at, *total()), _SHARDS.values())], names=list(_SHARDS))

        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at and held:
                    yield row()
                    held, size = [], 0
                at = bucket
                held.append(_expand(block.as_py()))
                size += len(held[-1][0])
                if size >= at_once and len(held) > 1:
                    held = [total()]
                    size = 0
        if held:
            yield row()

    n = slots(blocks.sparkSession)
    return blocks.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "path string, first string, n long, tokens long, cuts array<long>")


# --- the trie ---------------------------------------------------------------------------


@dataclass
class Shard:
    path: str
    first: int  # first hash, word or pair that this shard answers for
    base: int  # number of entries in the shards before it
    n: int


@dataclass
class Model:
    """Where the shards are, and the totals: tokens N, distinct tokens V, texts."""

    words: list[Shard] = field(default_factory=list)
    pairs: list[Shard] = field(default_factory=list)
    triples: list[Shard] = field(default_factory=list)
    tokens: int = 0
    distinct: int = 0
    texts: int = 0

    def id_type(self) -> np.dtype:
        return np.dtype(np.int32 if self.distinct + 2 < 1 << 31 else np.int64)


class Level:
    """Shards of one level, opened on first use, with queries sent to the shard that answers."""

    def __init__(self, shards: list[Shard]):
        self.shards = shards
        self.firsts = np.array([s.first for s in shards], np.uint64)
        self.open: dict[int, dict] = {}

    def part(self, k: int) -> dict:
        if k not in self.open:
            parts = load(self.shards[k].path)
            sequences = {name: EliasFano(parts, name) for name in ("keys", "sums", "pointers", "children") if f"{name}.size" in parts}
            self.open[k] = parts | sequences
        return self.open[k]

    def by_key(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        yield from self._split(keys.astype(np.uint64), self.firsts)

    def by_place(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        yield from self._split(places, np.array([s.base for s in self.shards]))

    @staticmethod
    def _split(keys: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Rows by shard, in key order, so that look-ups go through a shard from front to back."""
        order = np.argsort(keys, kind="stable")
        cuts = np.append(np.searchsorted(keys[order], firsts), len(keys))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            yield k, order[cuts[k] : cuts[k + 1]]


class Trie:
    """Queries of one process on the memory-mapped levels."""

    def __init__(self, model: Model):
        self.m = model
        self.words, self.pairs, self.triples = Level(model.words), Level(model.pairs), Level(model.triples)
        self.unknown, self.begin = model.distinct, model.distinct + 1  # ids beside the words'
        self.width = model.distinct + 2

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids; ``unknown`` for words not seen."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), self.unknown, np.int64)
        for k, rows in self.words.by_key(distinct):
            shard, part = self.words.shards[k], self.words.part(k)
            relative = (distinct[rows] - np.uint64(shard.first)).astype(np.int64)
            inside = np.flatnonzero(relative <= int(part["span"][0]))
            at = part["keys"].find(relative[inside], np.zeros(len(inside), np.int64), np.full(len(inside), shard.n))
            out[rows[inside[at >= 0]]] = at[at >= 0] + shard.base
        return out[back]

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of words; of ``begin``, the number of texts; of ``unknown``, zero."""
        distinct, back = np.unique(ids, return_inverse=True)
        out = np.where(distinct == self.begin, self.m.texts, 0)
        for k, rows in self.words.by_place(np.where(distinct < self.m.distinct, distinct, -1)):  # -1 is in no shard
            out[rows] = self._count(self.words.part(k), distinct[rows] - self.words.shards[k].base)
        return out[back]

    @staticmethod
    def _count(part: dict, at: np.ndarray) -> np.ndarray:
        before, upto = part["sums"].access_two(at)
        return upto - before

    def _children(self, level: Level, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each context and word: place of the n-gram (-1 if absent), its code, and the context's left-over code."""
        place, code, rest = np.full(len(contexts), -1, np.int64), np.zeros(len(contexts), np.uint8), np.zeros(len(contexts), np.uint8)
        for k, rows in level.by_key(contexts):
            shard, part = level.shards[k], level.part(k)
            relative = contexts[rows] - shard.first
            n = int(part["contexts"][0])
            rows, relative = rows[relative < n], relative[relative < n]
            # Rows lie in the order of their contexts, so each context is looked up once.
            firsts = np.flatnonzero(np.concatenate(([True], relative[1:] != relative[:-1]))) if len(relative) else rows
            own, each = relative[firsts], np.diff(np.append(firsts, len(relative)))
            start, stop = (np.repeat(x, each) for x in part["pointers"].access_two(own))
            rest[rows] = np.repeat(part["rest"][own], each)
            ask = np.flatnonzero((start < stop) & (words[rows] != self.unknown))
            at = part["children"].find(relative[ask] * self.width + words[rows[ask]], start[ask], stop[ask])
            hit = rows[ask[at >= 0]]
            at = at[at >= 0]
            place[hit], code[hit] = at + shard.base, part["codes"][at]
        return place, code, rest

    def pair(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._children(self.pairs, first, second)

    def triple(self, pair: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._children(self.triples, pair, third)

    def pair_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Second word and training count of the pairs at ``places``."""
        word, count = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        for k, rows in self.pairs.by_place(places):
            shard, part = self.pairs.shards[k], self.pairs.part(k)
            at = places[rows] - shard.base
            word[rows] = part["children"].access(at) % self.width
            count[rows] = self._count(part, at)
        return word, count

    def chains(self, coded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of all coded texts, the id before each (``begin`` at a text's start), and tokens per text."""
        kind = self.m.id_type()
        ids = np.frombuffer(b"".join(coded), kind).astype(np.int64)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // kind.itemsize
        before = np.concatenate(([self.begin], ids[:-1]))
        before[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = self.begin
        return ids, before, sizes

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.m.tokens + self.m.distinct + 1)

    def log_probabilities(self, ids: np.ndarray, before: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P of each token given the two before it in its text."""
        single = np.log10(self.unigram(counts))
        pair, code, rest = self.pair(before, ids)
        double = np.where(pair >= 0, _VALUE[code], _VALUE[rest] + single)
        context = np.concatenate(([-1], pair[:-1]))
        context[before == self.begin] = -1
        known = np.flatnonzero(context >= 0)
        triple, code, rest = self.triple(context[known], ids[known])
        out = double.copy()
        out[known] = np.where(triple >= 0, _VALUE[code], _VALUE[rest] + double[known])
        return np.minimum(out, 0.0)


_TRIES: dict[str, Trie] = {}


def _trie(model: Model) -> Trie:
    """The trie of this process."""
    name = model.words[0].path if model.words else ""
    state = f"{name}:{len(model.pairs)}:{len(model.triples)}"
    if state not in _TRIES:
        _TRIES.clear()
        _TRIES[state] = Trie(model)
    return _TRIES[state]


# --- building ---------------------------------------------------------------------------

def _cuts(sums: np.ndarray, size: int) -> list[int]:
    """Places that cut a level in runs of some ``size`` tokens; one place with more is a run of its own."""
    return np.unique(np.searchsorted(sums, np.arange(size, int(sums[-1]), size))).tolist()


def _shards(rows: DataFrame) -> tuple[list[Shard], np.ndarray]:
    """The written shards in key order, and where the level above them is cut: a few numbers per shard."""
    out, cuts, base = [], [0], 0
    for r in sorted(written(rows, "shards").collect(), key=lambda r: int(r["first"])):
        out.append(Shard(r["path"], int(r["first"]), base, int(r["n"])))
        cuts += [base + c for c in [0, *r["cuts"]]]
        base += int(r["n"])
    return out, np.unique(np.array(cuts, np.int64))


def _count_words(docs: DataFrame, folder: str, buckets: int, size: int) -> tuple[list[Shard], np.ndarray, int]:
    """Level 1: buckets are ranges of the hash, so each summed bucket is a shard."""
    bits = max(1, (buckets - 1).bit_length())

    blocks = _counts_by_bucket(docs.select("text"), lambda: lambda texts: token_hashes(texts)[0], lambda keys: (keys >> np.uint64(64 - bits)).astype(np.int64), BATCH_CHARS)

    def build(bucket: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
        first = bucket << (64 - bits)
        span = int(keys[-1]) - first
        sums = np.concatenate(([0], np.cumsum(counts)))
        path = f"{folder}/words-{bucket:05d}"
        save(path, EliasFano.build(keys - np.uint64(first), span, "keys") | EliasFano.build(sums, int(sums[-1]), "sums") | {"span": np.array([span], np.int64)})
        return path, str(first), len(keys), int(sums[-1]), _cuts(sums, size)

    built = written(_summed_by_bucket(blocks, build), "words")
    return *_shards(built), int(built.agg(F.sum("tokens")).first()[0] or 0)


def _level(coded: DataFrame, keys_of, model: Model, bounds: np.ndarray, folder: str, name: str, least: int, size: int) -> tuple[list[Shard], np.ndarray]:
    """Count the n-grams of a level and write it: a bucket is a run of contexts between two ``bounds``, and becomes a shard.

    Keys are context * width + word. Runs hold some ``size`` tokens of the level below, which no
    run of contexts can exceed in distinct n-grams; a single context has at most the vocabulary's.
    """
    width = model.distinct + 2
    ends = np.append(bounds[1:], width if name == "pairs" else sum(s.n for s in model.pairs))
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def build(bucket: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
        keep = counts >= least
        keys, n = keys[keep].astype(np.int64), counts[keep]
        trie = _trie(shared.value)
        first, contexts = int(bounds[bucket]), int(ends[bucket] - bounds[bucket])
        keys -= first * width
        relative = keys // width
        word = keys - relative * width
        pointers = np.concatenate(([0], np.cumsum(np.bincount(relative, minlength=contexts))))
        own = np.flatnonzero(np.diff(pointers))
        total = np.zeros(contexts)
        if name == "pairs":
            total[own] = trie.counts(own + first)
            shorter = trie.unigram(trie.counts(word))
        else:
            second, total[own] = trie.pair_at(own + first)
            before = np.zeros(contexts, np.int64)
            before[own] = second
            place, code, rest = trie.pair(before[relative], word)
            shorter = 10 ** np.where(place >= 0, _VALUE[code], _VALUE[rest] + np.log10(trie.unigram(trie.counts(word))))
        left = np.ones(contexts)
        left[own] = 1 - np.bincount(relative, n - DISCOUNT, contexts)[own] / total[own]
        left = np.clip(left, 1e-11, 1)
        p = (n - DISCOUNT) / total[relative] + left[relative] * shorter
        path = f"{folder}/{name}-{first:020d}"
        parts = EliasFano.build(pointers, len(word), "pointers") | EliasFano.build(keys, contexts * width, "children")
        sums = np.concatenate(([0], np.cumsum(n)))
        if name == "pairs":
            parts |= EliasFano.build(sums, int(sums[-1]), "sums")
        save(path, parts | {"codes": _code(p), "rest": _code(left), "contexts": np.array([contexts], np.int64)})
        return path, str(first), len(word), int(n.sum()), _cuts(sums, size)

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, (keys // np.uint64(width)).astype(np.int64), side="right") - 1

    blocks = _counts_by_bucket(coded.select("ids"), keys_of, bucket_of, BATCH_IDS)
    return _shards(_summed_by_bucket(blocks, build))


def train(docs: DataFrame, folder: str, text: str = "text", least: int = MIN_COUNT, size: int = SHARD) -> Model:
    """Count and build the trie of all rows of ``docs``; null texts count as empty, and each text has an end.

    ``folder`` must be reached by every executor. Shards follow the counts: some ``size`` tokens each.
    """
    docs = docs.select(filled(text).alias("text"))
    model, cuts = learn_words(docs, folder, size)
    coded = written(code(pack(docs, text=F.col("text")), model).select("ids"), "ids")
    return learn_ngrams(coded, model, cuts, folder, least, size)


def learn_words(docs: DataFrame, folder: str, size: int = SHARD) -> tuple[Model, np.ndarray]:
    """Level 1 of the rows' ``text``, and where level 2 is cut."""
    model = Model()
    model.words, cuts, model.tokens = _count_words(docs, folder, max(4, slots(docs.sparkSession) // 4), size)
    model.distinct = sum(s.n for s in model.words)
    if model.words:
        model.texts = int(Trie(model).counts(Trie(model).ids(np.array([END], np.uint64)))[0])
    return model, cuts


def code(rows: DataFrame, model: Model) -> DataFrame:
    """Rows ``doc, text`` as ``doc, ids``: the ids of the text's tokens one after the other."""
    shared, kind = rows.sparkSession.sparkContext.broadcast(model), model.id_type()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _groups(texts, BATCH_CHARS):
                hashes, sizes = token_hashes(texts[part])
                raw = trie.ids(hashes).astype(kind).tobytes()
                cuts = np.concatenate(([0], np.cumsum(sizes * kind.itemsize))).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["doc", "ids"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("ids", T.BinaryType())]))


def learn_ngrams(coded: DataFrame, model: Model, of_words: np.ndarray, folder: str, least: int = MIN_COUNT, size: int = SHARD) -> Model:
    """The model with levels 2 and 3 of all rows' ``ids``."""
    if not model.words:
        return model
    width = model.distinct + 2
    if width * width >= 1 << 63:
        raise ValueError("more distinct words than pairs of them fit 63 bits")
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def pair_keys():
        trie = _trie(shared.value)

        def keys(own: list[bytes]) -> np.ndarray:
            ids, before, _ = trie.chains(own)
            return before.astype(np.uint64) * np.uint64(width) + ids.astype(np.uint64)

        return keys

    pairs, of_pairs = _level(coded, pair_keys, model, of_words, folder, "pairs", least, size)
    with_pairs = Model(model.words, pairs, [], model.tokens, model.distinct, model.texts)
    if sum(s.n for s in with_pairs.pairs) * width >= 1 << 63:
        raise ValueError("more pairs than triples of them fit 63 bits")
    shared_pairs = coded.sparkSession.sparkContext.broadcast(with_pairs)

    def triple_keys():
        trie = _trie(shared_pairs.value)

        def keys(own: list[bytes]) -> np.ndarray:
            ids, before, _ = trie.chains(own)
            place, _, _ = trie.pair(before, ids)
            context = np.concatenate(([-1], place[:-1]))
            use = np.flatnonzero((place >= 0) & (context >= 0) & (before != trie.begin))
            return context[use].astype(np.uint64) * np.uint64(width) + ids[use].astype(np.uint64)

        return keys

    triples, _ = _level(coded, triple_keys, with_pairs, of_pairs, folder, "triples", least, size)
    return Model(model.words, pairs, triples, model.tokens, model.distinct, model.texts)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with ``n_tokens, n_known, base_score, score``.

    ``base_score`` is that of add-one unigrams. Null and empty texts are their end alone.
    An empty model knows no word and gives every token log10 1 = 0. Texts are read whole;
    repeated rows get equal scores; an empty table gives no rows; columns of any name pass
    through.
    """
    return score_coded(code(pack(docs, text=filled(text)), model), model)


def score_coded(coded: DataFrame, model: Model) -> DataFrame:
    """The figures of ``score`` for rows ``doc, ids``."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(shared.value)
        for batch in batches:
            own = batch.column(1).to_pylist()
            for part in _groups(own, BATCH_IDS):
                ids, before, sizes = trie.chains(own[part])
                counts = trie.counts(ids)
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                base = np.log10(trie.unigram(counts))
                sums = [np.add.reduceat(x, starts) for x in ((counts > 0).astype(np.int64), base, trie.log_probabilities(ids, before, counts))]
                columns = [batch.column(0)[part], pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "n_tokens", "n_known", "base_score", "score"])

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    return coded.mapInArrow(run, T.StructType([coded.schema["doc"], *added]))


@query("op5_language_model")
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns every n-gram of documents whose crc32 of the id mod 7 is not 2; null ids teach nothing."""
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id").alias("doc"), filled("text").alias("text"))
    taught, folder = fold_of("doc.doc_id", 7) != 2, fresh_path(spark, "trie")
    words, cuts = learn_words(docs.filter(taught).select("text"), folder)
    coded = written(code(docs, words), "ids")
    model = learn_ngrams(coded.filter(taught), words, cuts, folder, least=1)
    held_out = F.coalesce(fold_of("doc.doc_id", 7) == 2, F.lit(False))
    out = score_coded(coded, model)
    return out.select("doc.doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
