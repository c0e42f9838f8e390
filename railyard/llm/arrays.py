"""Words and their hashes over a whole Arrow batch at once, with numpy and without a Python object per word.

A batch's texts lie in one UTF-8 buffer. All separators used here are ASCII, so words can be cut out of the
bytes. A word's hash is a polynomial over random 64-bit values of its bytes (mod 2**64), finished by a mixing
step; it depends on the bytes alone, not on the place, the batch or the process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_table(member: str) -> np.ndarray:
    """True for the bytes that belong to words: ``plain`` (anything but ASCII white space) or ``alnum``."""
    table = np.ones(256, bool)
    if member == "plain":
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif member == "alnum":
        table[:0x80] = False
        table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    else:
        raise ValueError(member)
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
PLAIN, ALNUM = byte_table("plain"), byte_table("alnum")
_BYTE_VALUES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the public splitmix64 finisher)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, grown when a text is longer than any before."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            inverse = pow(_ODD, -1, 1 << 64)
            self.up, self.down = (np.full(size, base, np.uint64) for base in (_ODD, inverse))
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up, self.down


_POWERS = _Powers()


class Texts:
    """Some texts of a batch: bytes, and where each text starts and ends. NULL counts as empty."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first
        self.count = len(bounds) - 1

    def words(self, table: np.ndarray, lower: bool = True) -> "Words":
        return Words(self, table, lower)


class Words:
    """All words of some texts, in order: ``starts``, ``ends`` (bytes) and ``text`` (index of the text)."""

    def __init__(self, texts: Texts, table: np.ndarray, lower: bool):
        self.texts = texts
        self.data = LOWER[texts.data] if lower else texts.data
        member = table[self.data]
        edge = np.zeros(len(member) + 1, bool)
        edge[texts.bounds] = True
        before = np.empty_like(member)
        before[:1], before[1:] = False, member[:-1]
        after = np.empty_like(member)
        after[-1:], after[:-1] = False, member[1:]
        self.starts = np.flatnonzero(member & (~before | edge[:-1]))
        self.ends = np.flatnonzero(member & (~after | edge[1:])) + 1
        # per text: its words are [bounds[i], bounds[i + 1])
        self.bounds = np.searchsorted(self.starts, texts.bounds)
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(texts.count), self.counts)

    def hashes(self) -> np.ndarray:
        up, down = _POWERS.upto(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * up[: len(self.data)], out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(value + (self.ends - self.starts).astype(np.uint64))

    def position(self) -> np.ndarray:
        """Each word's place in its text, from 0."""
        return np.arange(len(self.starts)) - np.repeat(self.bounds[:-1], self.counts)


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The batch's texts in runs of about ``chunk_bytes``; a longer text is a run of its own, never cut."""
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + chunk_bytes, "right")) - 1)
        end = min(end, n)
        yield Texts(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin], begin)
        begin = end


def pieces(texts: Texts, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    """A run of texts as it is; a single long text in pieces that end at white space where there is any, else after a
    whole character."""
    if texts.count != 1 or len(texts.data) <= size:
        yield texts
        return
    begin, n = 0, len(texts.data)
    while begin < n:
        end = min(begin + size, n)
        if end < n:
            gaps = np.flatnonzero(~PLAIN[texts.data[begin:end]])
            if len(gaps):
                end = begin + int(gaps[-1]) + 1
            else:
                while end < n and texts.data[end] & 0xC0 == 0x80:
                    end += 1
        yield Texts(texts.data[begin:end], np.array([0, end - begin]), texts.first)
        begin = end


def shingles(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``width`` words; a shorter text with words has its whole sequence as one."""
    n = len(hashes)
    total = np.maximum(n - width + 1, 0)
    value = np.zeros(total, np.uint64)
    factor = 1
    for k in range(width):
        value += hashes[k : k + total] * _U(factor)
        factor = factor * _ODD & _MASK
    whole = words.text[:total] == words.text[width - 1 : width - 1 + total] if total else np.zeros(0, bool)
    out, owner = mix(value[whole]), words.text[:total][whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        extra = []
        for t in short:
            acc = int(words.counts[t])
            for k, h in enumerate(hashes[words.bounds[t] : words.bounds[t + 1]]):
                acc = (acc + int(h) * pow(_ODD, k + 1, 1 << 64)) & _MASK
            extra.append(acc)
        out = np.concatenate([out, mix(np.array(extra, np.uint64) ^ _U(0x5555555555555555))])
        owner = np.concatenate([owner, short])
    return out, owner


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class Index:
    """Numbers of given hashes, looked up for many hashes at once in an open-addressed table."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint64)
        self.bits = max(8, int(len(values)).bit_length() + 2)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        place, rest = self._slot(self.values), np.arange(len(values))
        while len(rest):
            free = self.slots[place[rest]] < 0
            self.slots[place[rest[free]]] = rest[free]  # of several, one stays
            rest = rest[self.slots[place[rest]] != rest]
            place[rest] = (place[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is none of the values."""
        out = np.full(len(hashes), -1, np.int32)
        place, rest = self._slot(hashes), np.arange(len(hashes))
        while len(rest):
            there = self.slots[place]
            used = there >= 0
            hit = used & (self.values[np.maximum(there, 0)] == hashes[rest]) if len(self.values) else used
            out[rest[hit]] = there[hit]
            on = used & ~hit
            rest, place = rest[on], (place[on] + 1) & ((1 << self.bits) - 1)
        return out
