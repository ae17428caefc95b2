"""Elias-Fano sequences over numpy arrays, with vectorised access and search, and their files.

A monotone sequence of n numbers below u keeps the low log2(u / n) bits of each packed, and
the high bits in unary, about two bits each. A directory of the ones before each 64-bit word
finds the k-th one or zero. All queries take and return arrays, and work on memory-mapped parts.
"""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np
from pyarrow import fs

_WORD = 64
_AT_ONCE = 8192  # queries whose intermediate arrays fit a processor's cache
_BYTE_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _BYTE_SELECT[_b, _k] = _p

_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_PAIRS, _FOURS, _BYTES = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
_1, _2, _4, _8, _56, _63, _255 = (np.uint64(x) for x in (1, 2, 4, 8, 56, 63, 255))


def _in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one in each word: counts by byte, summed up to each byte in one product."""
    s = words - ((words >> _1) & _PAIRS)
    s = (s & _FOURS) + ((s >> _2) & _FOURS)
    s = ((s + (s >> _4)) & _BYTES) * _ONES
    k = k.astype(np.uint64)
    place = np.bitwise_count(((k * _ONES | _TOPS) - s) & _TOPS).astype(np.uint64) << np.uint64(3)
    rank = k - (((s << _8) >> place) & _255)
    return place.astype(np.int64) + _BYTE_SELECT[((words >> place) & _255).astype(np.intp), rank.astype(np.intp)]


def _window(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 64 bits from each place on."""
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    return (words[word] >> shift) | ((words[word + 1] << _1) << (_63 - shift))


def _ones_first(words: np.ndarray) -> np.ndarray:
    """How many ones each word begins with, from the low end."""
    zeros = ~words
    return np.bitwise_count((zeros & (~zeros + _1)) - _1).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after the other, in 64-bit words, with one word to spare."""
    n = len(values)
    out = np.zeros((n * width + 63) // 64 * 8 + 8, np.uint8)
    step = 1 << 16  # a multiple of eight numbers, so pieces end at bytes
    shifts = np.arange(width, dtype=np.uint64)
    for at in range(0, n, step):
        bits = ((values[at : at + step, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bits.ravel(), bitorder="little")
        out[at * width // 8 : at * width // 8 + len(packed)] = packed
    return out.view(np.uint64)


class EliasFano:
    """A monotone sequence made of the arrays in ``parts``."""

    def __init__(self, parts: dict[str, np.ndarray], name: str):
        self.n, self.width = (int(x) for x in parts[f"{name}.size"])
        self.low, self.high, self.ones = parts[f"{name}.low"], parts[f"{name}.high"], parts[f"{name}.ones"]
        self.mask = np.uint64((1 << self.width) - 1)
        self.zeros = np.arange(len(self.ones)) * _WORD - self.ones

    @staticmethod
    def build(values: np.ndarray, universe: int, name: str) -> dict[str, np.ndarray]:
        """Arrays of the sequence ``values`` (sorted, each at most ``universe``)."""
        values = values.astype(np.uint64)
        n = len(values)
        width = min(56, max(0, (universe // max(n, 1)).bit_length() - 1))
        high = (values >> np.uint64(width)).astype(np.int64)
        length = n + (universe >> width) + 2
        bits = np.zeros((length + _WORD - 1) // _WORD * 8 + 16, np.uint8)
        place = high + np.arange(n)
        if n:
            starts = np.flatnonzero(np.concatenate(([True], (place[1:] >> 3) != (place[:-1] >> 3))))
            bits[place[starts] >> 3] = np.bitwise_or.reduceat((1 << (place & 7)).astype(np.uint8), starts)
        words = bits.view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
        low = _pack(values & np.uint64((1 << width) - 1), width) if width else np.zeros(1, np.uint64)
        return {f"{name}.size": np.array([n, width], np.int64), f"{name}.low": low, f"{name}.high": words, f"{name}.ones": ones}

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th one (or zero), counted from 0."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        words = self.high[word]
        return word * _WORD + _in_word(words if one else ~words, k - before[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        return ((self.low[word] >> shift) | ((self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        if not len(i):
            return np.zeros(0, np.int64)
        return self._value(self._select(i, True), i)

    def _value(self, position: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (((position - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)).astype(np.int64)

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at places ``i`` and ``i + 1``: the next one lies few bits further."""
        if not len(i):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self._select(i, True)
        gap = _ones_first(~_window(self.high, at + 1))
        following = at + 1 + gap
        far = np.flatnonzero(gap == _WORD)
        if len(far):
            following[far] = self._select(i[far] + 1, True)
        return self._value(at, i), self._value(following, i + 1)

    def _narrowed(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place in ``begin..end`` with a number of at least ``x``; the end of the numbers with the high bits of ``x``; its low bits."""
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.width)).astype(np.int64)
        # Numbers with these high bits are the ones right behind the zero that closes the bits before.
        zero = np.where(high > 0, self._select(np.maximum(high - 1, 0), False), -1)
        run = _ones_first(_window(self.high, zero + 1))
        first = zero + 1 - high
        after = first + run
        far = np.flatnonzero(run == _WORD)
        if len(far):
            after[far] = self._select(high[far], False) - high[far]
        lo, hi = np.clip(first, begin, end), np.clip(after, begin, end)
        stop = hi.copy()
        target = x & self.mask
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) >> 1
            less = self._low(middle) < target[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo, stop, target

    def successor(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """First place in ``begin..end`` with a number of at least ``x``; ``end`` if there is none."""
        return self._narrowed(x, begin, end)[0] if len(x) else np.zeros(0, np.int64)

    def find(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each ``x`` in ``begin..end``; -1 where it is not there.

        A successor with the same high bits is told by its low bits alone.
        """
        if len(x) > _AT_ONCE:
            cuts = range(0, len(x), _AT_ONCE)
            return np.concatenate([self.find(x[c : c + _AT_ONCE], begin[c : c + _AT_ONCE], end[c : c + _AT_ONCE]) for c in cuts])
        out = np.full(len(x), -1, np.int64)
        if len(x):
            at, stop, target = self._narrowed(x, begin, end)
            there = np.flatnonzero(at < stop)
            there = there[self._low(at[there]) == target[there]]
            out[there] = at[there]
        return out


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def save(uri: str, parts: dict[str, np.ndarray]) -> None:
    """Write arrays as one file. The file appears whole or not at all, so a task may be run again."""
    heads, data, at = {}, [], 0
    for name, a in parts.items():
        raw = np.ascontiguousarray(a).tobytes()
        heads[name] = [str(a.dtype), at, len(a)]
        data += [raw, b"\0" * (-len(raw) % 8)]
        at += len(raw) + (-len(raw) % 8)
    head = json.dumps(heads).encode()
    head += b" " * (-len(head) % 8)
    system, path = _filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{os.urandom(6).hex()}"
    with system.open_output_stream(part) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for raw in data:
            out.write(raw)
    system.move(part, path)


def load(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; a file in a remote store is copied to this machine first."""
    system, path = _filesystem(uri)
    if not isinstance(system, fs.LocalFileSystem):
        copy = os.path.join(tempfile.mkdtemp(prefix="ef-"), os.path.basename(path))
        fs.copy_files(path, copy, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        path = copy
    raw = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(raw[:8].tobytes(), "little")
    out = {}
    for name, (kind, at, n) in json.loads(raw[8 : 8 + size].tobytes()).items():
        start = 8 + size + at
        out[name] = raw[start : start + n * np.dtype(kind).itemsize].view(kind).view(np.ndarray)
    return out
