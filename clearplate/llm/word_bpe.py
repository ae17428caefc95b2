"""Byte-pair encoding by an index of pair occurrences, and decoding.

The distinct words of a run of texts are laid out as one chain of symbols. An index maps
each pair of neighbours to all its positions. Ranks with an occurrence wait in a heap and
are applied in ascending order, each to all positions of its pair at once; a merge adds the
two pairs it makes to the lists of the index. A position that a merge has made stale is told
by its symbols and passed over. Words do not touch, so the order of ranks within each word
is that of merging the word alone.

White space parts words and is lost, case is folded, and special tokens are found first, all
as the vocabulary file says. A text is cut at ASCII white space, which no word, special token
or normalisation step crosses; the ids of such a chunk are kept, up to MAX_CHUNKS of them.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from clearplate.llm.base import filled, pack, query, table

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
MAX_CHUNKS = 600_000
BATCH_BYTES = 1 << 21


@dataclass(frozen=True)
class BpeModel:
    """The text of a vocabulary file (a few megabytes)."""

    text: str


def load_model(path: str = VOCABULARY) -> BpeModel:
    with open(path, encoding="utf-8") as f:
        return BpeModel(f.read())


def _plain_split(spec: dict) -> re.Pattern | None:
    """The pattern that finds the words of lower-case visible ASCII, where the file's steps come down to that.

    Composition and white space do nothing to visible ASCII, and each such character stands
    for its own byte. Any other step, and all other text, is left to the library's own steps.
    """
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    words = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != {"Regex": r"\s+"} or steps[1]["content"] != " ":
        return None
    if [s["type"] for s in words] != ["Split", "ByteLevel"] or (words[0]["behavior"], words[0]["invert"]) != ("Removed", True) or words[1]["add_prefix_space"] or words[1]["use_regex"]:
        return None
    pattern = words[0]["pattern"].get("Regex")
    if pattern is None or "(" in pattern:
        return None
    return regex.compile(pattern)


class BpeCodec:
    """Encoder and decoder of one process."""

    def __init__(self, model: BpeModel):
        spec = json.loads(model.text)
        body = spec["model"]
        if body["type"] != "BPE" or body.get("continuing_subword_prefix") or body.get("unk_token") or body.get("dropout") or body.get("byte_fallback") or body.get("ignore_merges"):
            raise ValueError("a plain BPE vocabulary without prefix, unknown token, dropout or byte fallback is needed")
        whole = Tokenizer.from_str(model.text)
        self.normalizer, self.pre_tokenizer, self.decoder = whole.normalizer, whole.pre_tokenizer, whole.decoder
        vocabulary: dict[str, int] = body["vocab"]
        suffix = body.get("end_of_word_suffix") or ""
        self.inner = {c: i for c, i in vocabulary.items() if len(c) == 1}
        self.final = {c[0]: i for c, i in vocabulary.items() if len(c) == 1 + len(suffix) and c.endswith(suffix)}
        if len(self.inner) < 256 or len(self.final) < 256:
            raise ValueError("the vocabulary lacks a byte inside or at the end of words")
        # The pair (a, b) as a << 32 | b to its rank and the symbol it becomes.
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        made_by: dict[int, int] = {}
        for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in body["merges"]):
            into = vocabulary[a + b]
            pair = vocabulary[a] << 32 | vocabulary[b]
            self.rank[pair] = k
            self.merged.append(into)
            made_by.setdefault(into, k)
        if any(self.rank[p] <= max(made_by.get(p >> 32, -1), made_by.get(p & 0xFFFFFFFF, -1)) for p in self.rank):
            raise ValueError("a pair ranks before the merge that makes its part")
        self.pair_of = list(self.rank)
        self.sorted_pairs = np.array(sorted(self.rank), np.int64)
        self.sorted_ranks = np.array([self.rank[p] for p in self.sorted_pairs.tolist()], np.int64)
        added = spec.get("added_tokens") or []
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("special tokens are matched as they stand, without white space in or around them")
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.special, key=len, reverse=True)) + ")") if added else None
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.token_of = [""] * size
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.token_of[i] = token
        self.bytes_of = [t.encode() for t in self.token_of]
        self.plain, self.visible = _plain_split(spec), re.compile(rb"[!-~]+").fullmatch
        self._clear()

    def _clear(self) -> None:
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {c: np.array([i], "<u4").tobytes() for c, i in self.special.items()}

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word after all merges, as little-endian unsigned 32-bit integers."""
        symbol: list[int] = []
        ends = []
        inner, final = self.inner.get, self.final.get
        for word in words:
            symbol += map(inner, word[:-1])
            symbol.append(final(word[-1]))
            ends.append(len(symbol))
        last = np.zeros(len(symbol), bool)
        last[np.array(ends) - 1] = True
        place = np.arange(len(symbol))
        after = np.where(last, -1, place + 1).tolist()
        before = np.where(np.concatenate(([True], last[:-1])), -1, place - 1).tolist()
        flat = np.array(symbol, np.int64)
        pairs = np.where(last[:-1], -1, flat[:-1] << 32 | flat[1:])
        at = np.minimum(np.searchsorted(self.sorted_pairs, pairs), len(self.sorted_pairs) - 1)
        hit = np.flatnonzero(self.sorted_pairs[at] == pairs)
        ranks = self.sorted_ranks[at[hit]]
        order = np.argsort(ranks, kind="stable")
        ranks, hit = ranks[order], hit[order].tolist()
        firsts = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1]))) if len(ranks) else place[:0]
        active = ranks[firsts].tolist()  # ascending, so a heap
        cuts = [*firsts.tolist(), len(hit)]
        positions = {k: hit[x:y] for k, x, y in zip(active, cuts[:-1], cuts[1:])}
        rank, merged, pair_of, push = self.rank.get, self.merged, self.pair_of, heapq.heappush
        while active:
            k = heapq.heappop(active)
            pair = pair_of[k]
            a, b, into = pair >> 32, pair & 0xFFFFFFFF, merged[k]
            # In ascending order, so that of overlapping occurrences the left one is merged.
            for i in sorted(positions.pop(k)):
                j = after[i]
                if symbol[i] != a or j < 0 or symbol[j] != b:
                    continue
                symbol[i], symbol[j] = into, -1
                after[i] = right = after[j]
                left = before[i]
                if right >= 0:
                    before[right] = i
                    new = rank(into << 32 | symbol[right])
                    if new is not None:
                        if new in positions:
                            positions[new].append(i)
                        else:
                            positions[new] = [i]
                            push(active, new)
                if left >= 0:
                    new = rank(symbol[left] << 32 | into)
                    if new is not None:
                        if new in positions:
                            positions[new].append(left)
                        else:
                            positions[new] = [left]
                            push(active, new)
        flat = np.array(symbol, np.int64)
        upto = np.concatenate(([0], np.cumsum(flat >= 0)))[[0, *ends]] * 4
        coded = flat[flat >= 0].astype("<u4").tobytes()
        return [coded[x:y] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _words(self, chunk: bytes) -> list[str]:
        """The words of a chunk as the vocabulary file's steps give them; special tokens stand for themselves."""
        if self.plain is not None and self.visible(chunk):
            text = chunk.decode()
            if self.cut is None or not self.cut.search(text):
                return self.plain.findall(text.lower())
        own: list[str] = []
        text = chunk.decode("utf-8", "surrogatepass")
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                own.append(piece)
            elif piece:
                piece = self.normalizer.normalize_str(piece) if self.normalizer else piece
                own += [word for word, _ in self.pre_tokenizer.pre_tokenize_str(piece)] if self.pre_tokenizer else [piece]
        return own

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of new chunks; their distinct new words are merged together."""
        parts = list(map(self._words, chunks))
        known = self.words
        new = list({w: None for own in parts for w in own if w not in known})
        if new:
            known.update(zip(new, self.merge(new)))
        for chunk, own in zip(chunks, parts):
            self.chunks[chunk] = known[own[0]] if len(own) == 1 else b"".join(map(known.__getitem__, own))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        cut = [t.split() for t in texts]
        if len(self.chunks) > MAX_CHUNKS:
            self._clear()
        new = list({c: None for own in cut for c in own if c not in self.chunks})
        if new:
            self._learn(new)
        get = self.chunks.__getitem__
        return [b"".join(map(get, own)) for own in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids as the vocabulary's decoder writes it; without one, tokens parted by blanks."""
        if self.decoder is not None:
            return self.decoder.decode([self.token_of[i] for i in ids])
        return b" ".join(map(self.bytes_of.__getitem__, ids)).decode()


_CODECS: dict[BpeModel, BpeCodec] = {}


def codec(model: BpeModel) -> BpeCodec:
    """The codec of this process."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = BpeCodec(model)
    return _CODECS[model]


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of some BATCH_BYTES bytes, with the place of the first; null is empty."""
    start, size, own = 0, 0, []
    for k, text in enumerate(texts.cast(pa.binary())):
        text = text.as_py() or b""
        own.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield start, own
            start, size, own = k + 1, 0, []
    if own:
        yield start, own


def encode(docs: DataFrame, model: BpeModel, text: str = "text", decoded: bool = False, as_bytes: bool = False) -> DataFrame:
    """Every row as struct ``doc`` with ``ids`` and ``n_tokens``, and on request the text ``decoded`` from the ids.

    ``ids`` is an array, or with ``as_bytes`` the same as little-endian unsigned 32-bit integers.

    Null and empty texts, and those of white space only, have no ids and decode to the empty
    text. Texts of any length are encoded whole. Rows that repeat a text get the same ids. An
    empty table gives no rows; columns of any name pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = pack(docs, text=filled(text))
    fields = [T.StructField("ids", T.BinaryType() if as_bytes else T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("decoded", T.StringType())] * decoded
    schema = T.StructType([packed.schema["doc"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            for start, texts in _runs(batch.column(1)):
                coded = own.encode(texts)
                sizes = np.array([len(x) // 4 for x in coded], np.int64)
                flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                ids = pa.array(coded, pa.binary()) if as_bytes else pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                columns = [batch.column(0)[start : start + len(texts)], ids, pa.array(sizes)]
                if decoded:
                    cuts = offsets.tolist()
                    columns.append(pa.array([own.decode(flat[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return packed.mapInArrow(run, schema)


def decode(rows: DataFrame, model: BpeModel, ids: str = "ids", out: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with the text of its ids as ``out``; null ids give null, no ids the empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    packed = pack(rows, ids=F.col(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            texts = [None if x is None else own.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", out])

    return packed.mapInArrow(run, T.StructType([packed.schema["doc"], T.StructField(out, T.StringType())]))


@query("op13_word_bpe")
def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), load_model(), decoded=True, as_bytes=True)
    return coded.select("doc.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
