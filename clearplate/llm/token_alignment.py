"""Alignment of the tokens that two tokenizers give the same text, and how often ids meet.

Both token sequences of a text cover the same bytes, so each is an ascending array of end
offsets. Places where both end cut the tokens into groups. Long stretches of one token to
one token are equal arrays at the present index shift: they are skipped by exponential
probing, which compares runs of 1, 2, 4, ... ends and then narrows down on the first that
differ. What differs there is an irregular group; it is resolved token by token up to the
next common end, and the shift becomes what it is behind that group.

For counts over a corpus, each task sums blocks of texts of bounded size: a block lists its
distinct id pairs once, with the number of its documents that hold them, and its documents
as numbers of that list. Only lists are shuffled to be summed; totals come back to the
blocks that ask for them, so neither a pair in every document nor one document's links
become many rows.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, count, islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from clearplate.llm.base import filled, pack, query, table
from clearplate.session import written

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MAX_UNITS = 200_000
# Ids that are remembered with words, each side: text without blanks is one long word.
MAX_IDS = 1 << 22
BLOCK_BYTES = 1 << 22
# Blocks, some 6 MB each, of a file, which a task holds at a time.
BLOCKS_HELD = 4
BATCH_BYTES = 1 << 20
# What a word is: remembered with its ids; one that ends or begins in white space, whose text is encoded whole; one that its ids do not spell.
KEPT, WHOLE, NOT_SPELT = range(3)

# The white space of Unicode, which parts the units that byte-level BPE encodes apart.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# Fixed value: the pattern by which byte-level BPE parts a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters below this are the same in every version of Unicode that a library may know.
LATIN_END = "\u0250"


@dataclass(frozen=True)
class Vocabularies:
    """The contents of both files (some megabytes): a byte-level BPE and a SentencePiece model."""

    byte_text: str
    piece_proto: bytes


def load_vocabularies(byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY) -> Vocabularies:
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        return Vocabularies(a.read(), b.read())


def _byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 for itself, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteEncoder:
    """Byte-level BPE without special tokens. Ids of units of white space and the word behind are kept."""

    def __init__(self, text: str):
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.whole.encode_special_tokens = True
        special = self.whole.get_added_tokens_decoder()
        symbols = _byte_symbols()
        names = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size(with_added_tokens=True))]
        self.bytes_of = [t.encode() if i in special else bytes(map(symbols.__getitem__, t)) for i, t in enumerate(names)]
        self.length = np.array(list(map(len, self.bytes_of)), np.int64)
        self.unit = regex.compile(rf"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.units: dict[str, bytes] = {}
        self.quick = self._quick(json.loads(text))

    def _quick(self, spec: dict) -> Callable[[str], list[int]] | None:
        """A faster encoder of the same vocabulary and merges for short texts of Latin letters.

        It ranks merges by the id they make, so it serves where these are in the same order.
        """
        model = spec["model"]
        names = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in names]
        plain = spec.get("normalizer") is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"]
        if not plain or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) or made != sorted(made) or len(set(made)) < len(made):
            return None
        special = self.whole.get_added_tokens_decoder()
        ranks = {self.bytes_of[i]: i for i in model["vocab"].values() if i not in special}
        return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of short texts as 32-bit integers."""
        if self.quick:
            latin = [t for t in texts if t.isascii() or max(t) < LATIN_END]
            known = {t: array("i", self.quick(t)).tobytes() for t in latin}
            others = [t for t in texts if t not in known]
            known.update(zip(others, self._each(others)))
            return list(map(known.__getitem__, texts))
        return self._each(texts)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a blank and the word behind it, one word after another, and how many each has.

        No word may end or begin in white space: a blank between two words parts what is encoded
        apart, so all words of Latin letters go to the quicker encoder in one call.
        """
        latin = np.array([self.quick is not None and (w.isascii() or max(w) < LATIN_END) for w in words], bool)
        if latin.all():
            return self._latin([" " + w for w in words])
        picks = latin, ~latin
        own = [[" " + words[k] for k in np.flatnonzero(p).tolist()] for p in picks]
        sides = self._latin(own[0]), _joined(self._each(own[1]))
        sizes = np.zeros(len(words), np.int64)
        for p, (_, n) in zip(picks, sides):
            sizes[p] = n
        ids, starts = np.zeros(int(sizes.sum()), np.int32), np.cumsum(sizes) - sizes
        for p, (x, n) in zip(picks, sides):
            ids[_spread(starts[p], n)] = x
        return ids, sizes

    def _latin(self, after_blank: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.quick("".join(after_blank)), np.int32) if after_blank else np.zeros(0, np.int32)
        ends, upto = (np.cumsum(x, dtype=np.int64) for x in ([len(w.encode()) for w in after_blank], self.length[ids]))
        last = np.searchsorted(upto, ends)
        # A word must end where an id does; if one did not, each would be encoded by itself.
        if len(ids) and upto[-1] == ends[-1] and (upto[last] == ends).all():
            return ids, np.diff(last, prepend=-1)
        return _joined(self.each(after_blank))

    def _each(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(texts), 10_000):
            out += [array("i", x.ids).tobytes() for x in self.whole.encode_batch(texts[k : k + 10_000], add_special_tokens=False)]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text of any length, by units that are encoded apart."""
        own = self.unit.findall(text)
        if len(self.units) > MAX_UNITS:
            self.units = {}
        new = list({u: None for u in own if u not in self.units})
        self.units.update(zip(new, self.each(new)))
        return b"".join(map(self.units.__getitem__, own))


class PieceEncoder:
    """SentencePiece, which puts a blank before the text itself."""

    def __init__(self, proto: bytes):
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.bytes_of = [self._bytes(i) for i in range(self.whole.get_piece_size())]
        # No merge reaches over a blank where no piece has one behind another character.
        self.parted = not any(b" " in x.lstrip(b" ") for x in self.bytes_of)
        self.length = np.array(list(map(len, self.bytes_of)), np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.whole.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.whole.is_byte(i) else piece.replace("▁", " ").encode()

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids as 32-bit integers."""
        return [array("i", x).tobytes() for x in self.whole.encode(texts, num_threads=1)]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a blank and the word behind it, one word after another, and how many each has."""
        ids = self.whole.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def encode(self, text: str) -> bytes:
        return self.each([text])[0]


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def gallop(a: array, b: array) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Groups of two ascending arrays of end offsets with the same last end.

    Returns stretches ``(i, j, n)`` of n one-to-one groups, and irregular groups ``(i, i2, j, j2)``.
    """
    stretches, odd = [], []
    add_stretch, add_odd = stretches.append, odd.append
    # Runs of ends are compared as bytes: W to an end. What follows the last ends differs, so no run goes beyond them.
    W = a.itemsize
    raw_a, raw_b = a.tobytes() + b"a", b.tobytes() + b"b"
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            # Probe at the present shift, doubling while runs are equal; then halve to the first that differ.
            step = W
            x, y = W * i + W, W * j + W
            x2, y2 = x + W, y + W
            while raw_a[x:x2] == raw_b[y:y2]:
                x, y = x2, y2
                step += step
                x2 += step
                y2 += step
            while step > W:
                step >>= 1
                x2, y2 = x + step, y + step
                if raw_a[x:x2] == raw_b[y:y2]:
                    x, y = x2, y2
            done = x // W - i
            add_stretch((i, j, done))
            i += done
            j += done
            if i >= n:
                break
        i0, j0, x, y = i, j, a[i], b[j]
        if x != y:
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            add_odd((i0, i, j0, j))
    return stretches, odd


@dataclass
class Aligned:
    """Some texts: offsets of their tokens, groups and links in the arrays of all of them."""

    cut_a: np.ndarray
    cut_b: np.ndarray
    cut_group: np.ndarray
    cut_link: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray  # first token of each group, and the number of tokens at the end
    group_b: np.ndarray
    link_a: np.ndarray  # places of the tokens of each link
    link_b: np.ndarray


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its size."""
    begun = np.cumsum(sizes) - sizes
    return np.repeat(starts - begun, sizes) + np.arange(int(sizes.sum()))


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two ascending arrays as one: a stable sort merges runs."""
    return np.sort(np.concatenate([a, b]), kind="stable")


def overlaps(a: np.ndarray, b: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens that overlap inside irregular groups: each run of bytes without an end in it is one overlap."""
    own_a, own_b = _spread(odd[:, 0], odd[:, 1] - odd[:, 0]), _spread(odd[:, 2], odd[:, 3] - odd[:, 2])
    ends_a, ends_b = a[own_a], b[own_b]
    ends = _merged(ends_a, ends_b)
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    return own_a[np.searchsorted(ends_a, ends)], own_b[np.searchsorted(ends_b, ends)]


class _Words:
    """Numbered words: what each is, and where its ids of both sides lie among those of all."""

    def __init__(self):
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.kind = np.zeros(0, np.int8)
        self.sides = [[np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in range(2)]

    def grow(self) -> None:
        """Room for the words numbered since."""
        more = np.zeros(len(self.number) - len(self.kind), np.int64)
        self.kind = np.concatenate([self.kind, more.astype(np.int8)])
        self.sides = [[ids, np.concatenate([starts, more]), np.concatenate([sizes, more])] for ids, starts, sizes in self.sides]

    def put(self, numbers: np.ndarray, kind: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.kind[numbers] = kind
        for side, (ids, sizes) in zip(self.sides, sides):
            side[1][numbers] = len(side[0]) + np.cumsum(sizes) - sizes
            side[2][numbers] = sizes
            side[0] = np.concatenate([side[0], ids])

    def get(self, numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of these words, one word after another, and how many each has; for both sides."""
        return [(ids[_spread(starts[numbers], sizes[numbers])], sizes[numbers]) for ids, starts, sizes in self.sides]


class Aligner:
    """Both encoders of one process."""

    def __init__(self, vocabularies: Vocabularies):
        self.a, self.b = ByteEncoder(vocabularies.byte_text), PieceEncoder(vocabularies.piece_proto)
        # Words met lately, and those met before them; a word that is met again moves up.
        self.words, self.older = _Words(), _Words()
        self.length_a, self.length_b = self.a.length, self.b.length

    def _spells(self, text: str, ids_a: bytes, ids_b: bytes) -> bool:
        spelt = (" " + text).encode("utf-8", "surrogatepass")
        return all(b"".join(map(x.bytes_of.__getitem__, np.frombuffer(ids, np.int32).tolist())) == spelt for x, ids in ((self.a, ids_a), (self.b, ids_b)))

    def _learn(self, numbers: np.ndarray, words: list[str]) -> None:
        """Remembers a blank and the word behind it as both sides encode them."""
        apart = np.array([self.b.parted and w != "" and not (w[0].isspace() or w[-1].isspace()) for w in words], bool)
        none = np.zeros(0, np.int32), np.zeros(int((~apart).sum()), np.int64)
        self.words.put(numbers[~apart], np.int8(WHOLE), [none, none])
        if not apart.all():
            numbers, words = numbers[apart], [w for w, x in zip(words, apart.tolist()) if x]
        if not words:
            return
        sides = [self.a.words(words), self.b.words(words)]
        spelt = [(" " + w).encode("utf-8", "surrogatepass") for w in words]
        lengths, whole = np.fromiter(map(len, spelt), np.int64, len(spelt)), b"".join(spelt)
        right = np.ones(len(words), bool)
        for side, (ids, sizes) in zip((self.a, self.b), sides):
            ends = np.concatenate(([0], np.cumsum(sizes)))
            fits = np.diff(np.concatenate(([0], np.cumsum(side.length[ids])))[ends]) == lengths
            # All words at once; only if lengths or bytes differ somewhere, one by one.
            if not fits.all() or b"".join(map(side.bytes_of.__getitem__, ids.tolist())) != whole:
                right &= [b"".join(map(side.bytes_of.__getitem__, ids[s:e].tolist())) == w for s, e, w in zip(ends[:-1].tolist(), ends[1:].tolist(), spelt)]
        self.words.put(numbers, np.where(right, KEPT, NOT_SPELT), sides)

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers; those not met yet are learnt."""
        if len(self.words.number) > MAX_UNITS // 2 or max(len(x[0]) for x in self.words.sides) > MAX_IDS:
            self.older, self.words = self.words, _Words()
        mine, older = self.words, self.older
        before = len(mine.number)
        out = np.fromiter(map(mine.number.__getitem__, words), np.int64, len(words))
        new = list(islice(mine.number, before, None))
        if new:
            mine.grow()
            numbers = np.arange(before, before + len(new))
            at = np.fromiter(map(older.number.get, new, repeat(-1)), np.int64, len(new))
            known = at >= 0
            mine.put(numbers[known], older.kind[at[known]], older.get(at[known]))
            self._learn(numbers[~known], [w for w, x in zip(new, known.tolist()) if not x])
        return out

    def _ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts, one text after another, and where each text's begin and end; for both sides.

        None for a text that is empty or that a side does not spell. Single blanks between
        words part a text on both sides, so words are encoded once and remembered. A text with
        other white space beside a blank is encoded whole.
        """
        own = [t.split(" ") for t in texts]
        numbers = self._numbers(list(chain.from_iterable(own)))
        cuts = np.concatenate(([0], np.cumsum(list(map(len, own)), dtype=np.int64)))
        kinds = self.words.kind[numbers]
        odd: dict[int, tuple[bytes, bytes]] = {}
        if kinds.any():
            worst = np.maximum.reduceat(kinds, cuts[:-1])
            for k in np.flatnonzero(worst == WHOLE).tolist():
                ids = (self.a.encode(" " + texts[k]), self.b.encode(texts[k])) if texts[k] else (b"", b"")
                if any(ids) and self._spells(texts[k], *ids):
                    odd[k] = ids
            numbers = numbers[np.repeat(worst == KEPT, np.diff(cuts))]
            cuts = np.concatenate(([0], np.cumsum(np.where(worst == KEPT, np.diff(cuts), 0))))
        out = []
        for side, (ids, sizes) in enumerate(self.words.get(numbers)):
            cut = np.concatenate(([0], np.cumsum(sizes)))[cuts]
            if odd:
                parts = [np.frombuffer(odd[k][side], np.int32) if k in odd else ids[s:e] for k, (s, e) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist()))]
                ids, cut = np.concatenate(parts), np.concatenate(([0], np.cumsum(list(map(len, parts)))))
            out.append((ids, cut))
        return out

    def ids(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text on both sides as 32-bit integers; none for a text that is empty or that a side does not spell."""
        a, b = ([ids[s:e].tobytes() for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())] for ids, cut in self._ids(texts))
        return a, b

    def align(self, texts: list[str]) -> Aligned:
        """Texts that are empty, or that either sequence does not spell out byte for byte, have no tokens."""
        (ids_a, cut_a), (ids_b, cut_b) = self._ids(texts)
        # Offsets run on from text to text, so a text's last end is a common one like any other.
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        stretches, odd = gallop(array("q", ends_a.tobytes()), array("q", ends_b.tobytes()))
        runs = np.fromiter(chain.from_iterable(stretches), np.int64, 3 * len(stretches)).reshape(-1, 3)
        odd = np.fromiter(chain.from_iterable(odd), np.int64, 4 * len(odd)).reshape(-1, 4)
        even_a, even_b = _spread(runs[:, 0], runs[:, 2]), _spread(runs[:, 1], runs[:, 2])
        group_a, group_b = _merged(even_a, odd[:, 0]), _merged(even_b, odd[:, 2])
        left, right = overlaps(ends_a, ends_b, odd)
        link_a, link_b = _merged(even_a, left), _merged(even_b, right)
        return Aligned(
            cut_a,
            cut_b,
            np.searchsorted(group_a, cut_a),
            np.searchsorted(link_a, cut_a),
            ids_a,
            ids_b,
            np.append(group_a, len(ids_a)),
            np.append(group_b, len(ids_b)),
            link_a,
            link_b,
        )

    def written_groups(self, x: Aligned) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        names = getattr(self, "_names", None)
        if names is None:
            # An id and what follows it: within a side, at the end of the first side, at the end of a group.
            most = max(len(self.length_a), len(self.length_b))
            names = self._names = [f"{i}{end}" for end in ",|;" for i in range(most)]
        most = len(names) // 3
        a, b = x.ids_a.astype(np.int64), x.ids_b.astype(np.int64)
        a[x.group_a[1:] - 1] += most
        b[x.group_b[1:] - 1] += 2 * most
        coded = np.empty(len(a) + len(b), np.int64)
        # The tokens of each group: first side, second side.
        coded[np.arange(len(a)) + np.repeat(x.group_b[:-1], np.diff(x.group_a))] = a
        coded[np.arange(len(b)) + np.repeat(x.group_a[1:], np.diff(x.group_b))] = b
        cuts = (x.cut_a + x.cut_b).tolist()
        return ["".join(map(names.__getitem__, coded[s:e].tolist()))[:-1] for s, e in zip(cuts[:-1], cuts[1:])]


_ALIGNERS: dict[Vocabularies, Aligner] = {}


def aligner(vocabularies: Vocabularies) -> Aligner:
    """The aligner of this process."""
    if vocabularies not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[vocabularies] = Aligner(vocabularies)
    return _ALIGNERS[vocabularies]


def _runs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of some BATCH_BYTES characters, with the place of the first; null is empty."""
    start, size, own = 0, 0, []
    for k, text in enumerate(column):
        text = text.as_py() or ""
        own.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield start, own
            start, size, own = k + 1, 0, []
    if own:
        yield start, own


def align(docs: DataFrame, vocabularies: Vocabularies, text: str = "text") -> DataFrame:
    """Every row as struct ``doc`` with ``ids_a, ids_b`` and, for each group, where its tokens end: ``ends_a, ends_b``.

    Null and empty texts, and texts that the tokens of one side do not spell out byte for
    byte, have no tokens. Texts of any length are aligned whole; rows that repeat a text get
    the same groups. An empty table gives no rows; columns of any name pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)
    packed = pack(docs, text=filled(text))
    names = ["ids_a", "ids_b", "ends_a", "ends_b"]
    schema = T.StructType([packed.schema["doc"], *[T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in names]])

    def lists(cuts: np.ndarray, values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(shared.value)
        for batch in batches:
            for start, texts in _runs(batch.column(1)):
                x = own.align(texts)
                groups = np.diff(x.cut_group)
                ends_a, ends_b = x.group_a[1:] - np.repeat(x.cut_a[:-1], groups), x.group_b[1:] - np.repeat(x.cut_b[:-1], groups)
                columns = [batch.column(0)[start : start + len(texts)], lists(x.cut_a, x.ids_a), lists(x.cut_b, x.ids_b), lists(x.cut_group, ends_a), lists(x.cut_group, ends_b)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", *names])

    return packed.mapInArrow(run, schema)


class _Block:
    """Documents of one task until they are enough for a row."""

    def __init__(self):
        self.size = 0
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[int] = []

    def add(self, own: Aligner, ids: list, texts: list[str]) -> None:
        x = own.align(texts)
        groups = own.written_groups(x)
        per = [np.diff(c).tolist() for c in (x.cut_a, x.cut_b, x.cut_group, x.cut_link)]
        shas = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(groups, per[0])]
        self.rows += zip(ids, *per, shas)
        self.pairs.append(x.ids_a[x.link_a].astype(np.int64) << 32 | x.ids_b[x.link_b])
        self.links += per[3]
        self.size += sum(map(len, texts))

    def row(self, number: int) -> dict:
        """Distinct pairs with their documents; for each document the numbers of its pairs, and how often each is linked."""
        place, pairs = pd.factorize(np.concatenate([np.zeros(0, np.int64), *self.pairs]))
        doc = np.repeat(np.arange(len(self.rows)), self.links)
        # Numbered in the order they are met, so those of a document stay together.
        number_of, held = pd.factorize(doc * max(1, len(pairs)) + place)
        times = np.bincount(number_of, minlength=len(held))
        doc, place = np.divmod(held, max(1, len(pairs)))
        columns = list(zip(*self.rows))
        return {
            "block": number,
            "doc_id": columns[0],
            **{n: columns[1 + k] for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"))},
            "held": np.bincount(doc, minlength=len(self.rows)),
            "place": place.astype(np.int32),
            "times": times.astype(np.int32),
            "pair": pairs,
            "docs": np.bincount(place, minlength=len(pairs)),
        }


_LISTS = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "held": pa.int32(), "place": pa.int32(), "times": pa.int32(), "pair": pa.int64(), "docs": pa.int64()}
_SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string"}


def _blocks(docs: DataFrame, vocabularies: Vocabularies, doc_id: str, text: str, block_bytes: int) -> DataFrame:
    """A row for every block of documents of some ``block_bytes`` characters; a longer text is a block with those before it."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)
    schema = "block bigint, " + ", ".join(f"{n} array<{_SQL_TYPES[t]}>" for n, t in _LISTS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = aligner(shared.value), _Block()

        def full() -> pa.RecordBatch:
            row = block.row(0)
            return pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), *[pa.array([row[n]], pa.list_(t)) for n, t in _LISTS.items()]], names=["block", *_LISTS])

        for batch in batches:
            for start, texts in _runs(batch.column(1)):
                block.add(own, batch.column(0)[start : start + len(texts)].to_pylist(), texts)
                if block.size >= block_bytes:
                    yield full()
                    block = _Block()
        if block.rows:
            yield full()

    made = docs.select(F.col(doc_id).cast("long").alias("doc_id"), filled(text).alias("text")).mapInArrow(run, schema)
    return written(made.withColumn("block", F.monotonically_increasing_id()), "alignment-blocks", BLOCKS_HELD)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, count, best`` from ``pair, docs``: documents that hold a pair, and whether no pair of its first id has more."""
    counts = written(pairs.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("id_a")).agg(F.max("count").alias("most"))
    return counts.withColumn("id_a", first).join(most, "id_a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of each block: its own figures, and sums over its links of what the corpus says."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k] for n in batch.schema.names}
            array_of = {n: np.asarray(row[n].values) if row[n].is_valid else np.zeros(0, np.int64) for n in ("held", "place", "times", "at", "count", "best")}
            count, best = (np.zeros(len(array_of["at"]), np.int64) for _ in range(2))
            count[array_of["at"]], best[array_of["at"]] = array_of["count"], array_of["best"]
            upto = np.concatenate(([0], np.cumsum(array_of["held"])))
            links = array_of["times"].astype(np.int64)
            sums = [np.diff(np.concatenate(([0], np.cumsum(links * x[array_of["place"]])))[upto]) for x in (best, count)]
            given = [row[n].values for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*given, *[pa.array(s, pa.int64()) for s in sums], row["groups_sha256"].values], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def link_totals(docs: DataFrame, vocabularies: Vocabularies, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Links are all overlapping token occurrences of both sides; a pair of ids counts the
    documents of the whole table that hold it linked. ``n_best`` are the links whose count
    is the highest of their first id, ties included; ``count_sum`` sums over links. Documents
    without tokens (null or empty text, or one that a side cannot spell) have zeros and ''.
    Repeated rows and null ids are documents of their own. Long texts are whole. Other columns of
    any name are ignored; an empty table gives no rows.
    """
    blocks = _blocks(docs, vocabularies, doc_id, text, block_bytes)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pair", "docs")).alias("at", "x")).select("block", "at", "x.pair", "x.docs")
    found = listed.select("block", "at", "pair").join(pair_counts(listed.select("pair", "docs")), "pair")
    # As many parts as blocks, whatever the session's number: all blocks of a part go to the task as one batch.
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, blocks.count())
    back = found.repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("x"))
    back = back.select("block", F.col("x.at").alias("at"), F.col("x.count").alias("count"), F.transform("x.best", lambda b: b.cast("int")).alias("best"))
    both = blocks.drop("pair", "docs").repartition(parts, "block").join(back, "block", "left").drop("block")
    return both.mapInArrow(_totals, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_totals(table(spark, sf_dir, "documents"), load_vocabularies())
