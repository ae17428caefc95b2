"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding.

All ways to cut a text into vocabulary pieces form a lattice. Forward filtering sums the
weights of all cuts up to each character; backward sampling then draws one cut, piece by
piece from the end, with its exact probability. The draws are numbers made from the row's
key and the place in the text, so a row has the same cut whatever task or batch it is in.

Pieces hold a blank only at their start, so the lattice falls apart into units of blanks
and the word behind them. Lattices of distinct units are built once and kept in flat
arrays; all units of a batch of texts are then sampled together, one numpy step per piece.
The vocabulary file carries merge ranks and no probabilities, so weights follow Zipf's law
of the rank: log p = -alpha * log(rank + 2).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearplate.llm.base import pack, query, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 11
ALPHA = 1.0
BATCH_CHARS = 1 << 20
MAX_UNITS = 120_000


@dataclass(frozen=True)
class PieceModel:
    """The bytes of a SentencePiece model file (below a megabyte) and the sampling options."""

    proto: bytes
    alpha: float = ALPHA
    seed: int = SEED


def load_model(path: str = MODEL_PATH, alpha: float = ALPHA, seed: int = SEED) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read(), alpha, seed)


class PieceCodec:
    """Encoder and decoder of one process; keeps lattices of up to MAX_UNITS distinct units."""

    def __init__(self, model: PieceModel):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
        size = sp.get_piece_size()
        self.seed = model.seed
        self.bytes_of: list[bytes] = [b""] * size
        byte_ids, rank = {}, 0
        # The vocabulary as a tree: (node, character) to node, and the piece that ends at a node.
        step_to: dict[int, int] = {}
        piece_at = [-1]
        self.log_p, self.length = np.zeros(size), np.zeros(size, np.int64)
        newline = False
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
                byte_ids[self.bytes_of[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain = piece.replace("▁", " ")
                rank += 1
                self.bytes_of[i], self.length[i], self.log_p[i] = plain.encode(), len(plain), -model.alpha * np.log(rank + 2.0)
                newline |= "\n" in plain
                node = 0
                for char in plain:
                    node = step_to.setdefault(node << 21 | ord(char), len(piece_at))
                    if node == len(piece_at):
                        piece_at.append(-1)
                piece_at[node] = i
        self.steps = np.array(sorted(step_to), np.int64)
        self.nodes_to = np.array([step_to[k] for k in self.steps.tolist()], np.int64)
        self.piece_at = np.array(piece_at, np.int64)
        self.byte_ids = np.array([byte_ids[b] for b in range(256)])
        self.log_p[self.byte_ids] = -model.alpha * np.log(size + 2.0)
        self.unit = re.compile(r" *[^ ]+| +" if newline else r" *[^ \n]+|\n| +")
        # Characters outside the vocabulary: ids from ``size`` on, each standing for its bytes.
        self.size, self.other_bytes, self.other_ids = size, [], {}
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.first, self.chars = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.key, self.step, self.piece = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.nodes = 0

    def _other(self, char: str) -> int:
        if char not in self.other_ids:
            self.other_ids[char] = self.size + len(self.other_bytes)
            self.other_bytes.append(self.byte_ids[np.frombuffer(char.encode("utf-8", "surrogatepass"), np.uint8)])
        return self.other_ids[char]

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """End and id of every piece at every place of a text: all places walk down the tree together."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start, node, depth = np.arange(len(points)), np.zeros(len(points), np.int64), 0
        ends, found = [], []
        while len(start):
            key = node << 21 | points[start + depth]
            at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[at] == key
            start, node, depth = start[hit], self.nodes_to[at[hit]], depth + 1
            piece = self.piece_at[node]
            whole = piece >= 0
            ends.append(start[whole] + depth)
            found.append(piece[whole])
            inside = start + depth < len(points)
            start, node = start[inside], node[inside]
        return np.concatenate(ends), np.concatenate(found)

    def _add(self, units: list[str]) -> None:
        """Forward filtering of new units: cumulative draw probabilities of the pieces that end at each character."""
        joined = "\0".join(units) + "\0"
        n = np.fromiter(map(len, units), np.int64, len(units))
        at = np.cumsum(n + 1) - n - 1
        owner = np.repeat(np.arange(len(units)), n + 1)
        end, piece = self._matches(joined)
        step = self.length[piece]
        covered = np.zeros(len(joined) + 1, bool)
        covered[end[step == 1]] = True
        covered[np.append(at + n + 1, 0)] = True
        bare = np.flatnonzero(~covered)
        log_p = self.log_p[piece]
        if len(bare):
            others = np.array([self._other(joined[e - 1]) for e in bare.tolist()])
            sizes = np.array([len(self.other_bytes[i - self.size]) for i in others.tolist()])
            end, step, piece = np.concatenate([end, bare]), np.concatenate([step, np.ones(len(bare), np.int64)]), np.concatenate([piece, others])
            log_p = np.concatenate([log_p, sizes * self.log_p[self.byte_ids[0]]])
        place = end - at[owner[end - 1]]
        order = np.lexsort((end, place))
        end, step, piece, log_p, place = end[order], step[order], piece[order], log_p[order], place[order]
        alpha = np.zeros(len(joined) + 1)  # at[k] + e: log weight of all cuts of the first e characters
        base = end - place
        bounds = np.searchsorted(place, np.arange(1, n.max() + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            ends = end[a:b]
            starts = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
            into = alpha[ends - step[a:b]] * (place[a:b] != step[a:b]) + log_p[a:b]
            alpha[ends[starts]] = np.logaddexp.reduceat(into, starts)
        order = np.argsort(end, kind="stable")
        end, step, piece, log_p, place, base = end[order], step[order], piece[order], log_p[order], place[order], base[order]
        weight = np.exp(alpha[end - step] * (place != step) + log_p - alpha[end])
        starts = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
        upto = np.cumsum(weight)
        per = np.diff(np.append(starts, len(end)))
        upto -= np.repeat(upto[starts] - weight[starts], per)
        upto[np.append(starts[1:], len(end)) - 1] = 1.0
        node = self.nodes + end - 1 - owner[end - 1]
        self.code.update(zip(units, range(len(self.first), len(self.first) + len(units))))
        self.first = np.concatenate([self.first, self.nodes + at - np.arange(len(units))])
        self.chars = np.concatenate([self.chars, n])
        self.key = np.concatenate([self.key, node + np.minimum(upto, 1.0)])
        self.step, self.piece = np.concatenate([self.step, step]), np.concatenate([self.piece, piece])
        self.nodes += int(n.sum())

    def encode(self, texts: list[str], keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets by text and the ids of all texts, one sampled cut of each. An empty text has no pieces."""
        if len(self.code) > MAX_UNITS:
            self._clear()
        units: list[str] = []
        per_text = []
        for text in texts:
            own = self.unit.findall(" " + text) if text else []
            units += own
            per_text.append(len(own))
        codes = list(map(self.code.get, units))
        new = list({u: None for u, c in zip(units, codes) if c is None})
        if new:
            self._add(new)
            codes = list(map(self.code.__getitem__, units))
        code = np.array(codes, np.int64)
        per_text = np.array(per_text, np.int64)
        if not len(code):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
        keyed = np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), self.seed) for k in keys), np.uint64, len(keys))
        length = self.chars[code]
        upto = np.cumsum(length)
        firsts = np.concatenate(([0], np.cumsum(per_text)))
        begun = np.concatenate(([0], upto))[firsts[:-1]]
        # A draw's number: the row's key and the place in the row's text where the piece ends.
        place = upto - np.repeat(begun, per_text)
        counter = np.repeat(keyed, per_text) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        node, left, active = self.first[code] + length - 1, length, np.arange(len(code))
        drawn, count = [], np.zeros(len(code), np.int64)
        while len(active):
            z = counter
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            r = ((z ^ (z >> np.uint64(31))) >> np.uint64(40)).astype(np.float64) / (1 << 24)
            edge = np.searchsorted(self.key, node + r, side="right")
            drawn.append((active, self.piece[edge]))
            count[active] += 1
            step = self.step[edge]
            more = left > step
            active, step = active[more], step[more]
            left, node = left[more] - step, node[more] - step
            counter = counter[more] - step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        ends = np.cumsum(count)
        ids = np.empty(int(ends[-1]), np.int64)
        for k, (who, piece) in enumerate(drawn):
            ids[ends[who] - 1 - k] = piece
        offsets = np.concatenate(([0], ends))[firsts]
        if len(self.other_bytes) and (other := ids >= self.size).any():
            sizes = np.ones(len(ids), np.int64)
            sizes[other] = [len(self.other_bytes[i]) for i in (ids[other] - self.size).tolist()]
            offsets = np.concatenate(([0], np.cumsum(sizes)))[offsets]
            parts = np.repeat(ids, sizes)
            spread = np.repeat(other, sizes)
            parts[spread] = np.concatenate([self.other_bytes[i] for i in (ids[other] - self.size).tolist()])
            ids = parts
        if len(self.other_bytes) > MAX_UNITS:
            self.other_bytes, self.other_ids = [], {}
            self._clear()
        return offsets, ids.astype(np.int32)

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts again: pieces joined, without the blank that encoding put in front."""
        out = []
        flat = list(map(self.bytes_of.__getitem__, ids.tolist()))
        cuts = offsets.tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            out.append(b"".join(flat[a:b]).decode("utf-8", "surrogatepass")[1:])
        return out


_CODECS: dict[PieceModel, PieceCodec] = {}


def codec(model: PieceModel) -> PieceCodec:
    """The codec of this process."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def _groups(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of some BATCH_CHARS characters."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with ``ids``, ``n_pieces`` and ``lossless``.

    ``lossless`` tells that decoding the ids gave the text again. Null texts count as
    empty; empty texts have no pieces. Null keys draw like the empty key; rows that repeat
    key and text get the same ids. Characters outside the vocabulary become their UTF-8
    bytes. Texts of any length are one lattice and are never cut. An empty table gives no
    rows; columns of any name pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_pieces", T.IntegerType()), T.StructField("lossless", T.BooleanType())]
    packed = pack(docs, key=F.coalesce(F.col(key).cast("string"), F.lit("")))
    schema = T.StructType([packed.schema["doc"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).field(at).to_pylist()]
            keys = batch.column(1).to_pylist()
            for part in _groups(texts):
                offsets, ids = own.encode(texts[part], keys[part])
                back = own.decode(offsets, ids)
                columns = [
                    batch.column(0)[part],
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    pa.array(np.diff(offsets), pa.int32()),
                    pa.array([a == b for a, b in zip(back, texts[part])], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "ids", "n_pieces", "lossless"])

    return packed.mapInArrow(run, schema)


def decode(rows: DataFrame, model: PieceModel, ids: str = "ids", out: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with the decoded text as ``out``; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    at = rows.columns.index(ids)
    packed = pack(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            lists = batch.column(0).field(at).to_pylist()
            sizes = [len(x or []) for x in lists]
            offsets = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
            flat = np.array([i for x in lists for i in x or []], np.int64)
            texts = [None if x is None else t for x, t in zip(lists, own.decode(offsets, flat))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", out])

    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField(out, T.StringType())]))


@query("op1_pieces")
def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, load_model()).select("doc.doc_id", "ids", "n_pieces", "lossless")
