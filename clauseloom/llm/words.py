"""Words of many texts at once as 64-bit hashes, worked out on the bytes of an Arrow column.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return, which is the same
cut as on code points.  A-Z may count as a-z.  All arrays but the word hashes themselves are bounded by ``STRETCH`` bytes at a time,
however long a text is (a single longer word excepted).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

STRETCH = 1 << 20
BATCH_BYTES = 4 << 20  # bytes of text that the callers hash at a time

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_STATE = {"powers": np.ones(1, np.uint64)}


def _powers(n: int) -> np.ndarray:
    if len(_STATE["powers"]) < n:
        base = np.full(max(n, 256), mix(np.array([7], np.uint64))[0] | np.uint64(1), np.uint64)
        base[0] = 1
        _STATE["powers"] = np.cumprod(base, dtype=np.uint64)
    return _STATE["powers"]


@dataclass
class Words:
    hashes: np.ndarray  # one per word, in order
    bounds: np.ndarray  # words of text i are bounds[i] to bounds[i + 1]
    starts: np.ndarray | None = None  # byte at which each word starts
    sizes: np.ndarray | None = None  # its bytes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text ends; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def hash_words(data: np.ndarray, offsets: np.ndarray, fold: bool = False, separator: np.ndarray = SEPARATOR) -> Words:
    """Hashes of the words of all texts; ``offsets`` as ``text_bytes`` gives them."""
    value = _FOLDED if fold else _VALUE
    hashes, starts_at, all_sizes = [], [], []
    begin, n = 0, len(data)
    while begin < n:
        end = min(n, begin + STRETCH)
        while end < n:  # to the next separator or text border, so that no word is cut
            gap = np.flatnonzero(separator[data[end:end + STRETCH]])
            border = offsets[np.searchsorted(offsets, end)]
            stop = min(end + int(gap[0]) if len(gap) else n, int(border))
            if len(gap) or border <= end + STRETCH:
                end = stop
                break
            end = min(n, end + STRETCH)
        part = data[begin:end]
        inside = ~separator[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[np.searchsorted(offsets, begin):np.searchsorted(offsets, end)] - begin
        first[borders] |= inside[borders]
        at = np.flatnonzero(first)
        if len(at):
            letters = part[inside]
            start = (np.cumsum(inside) - 1)[at]
            sizes = np.diff(start, append=len(letters))
            place = np.arange(len(letters)) - np.repeat(start, sizes)
            total = np.add.reduceat(value[letters] * _powers(int(sizes.max()))[place], start)
            hashes.append(mix(total ^ sizes.astype(np.uint64)))
            starts_at.append(at + begin)
            all_sizes.append(sizes)
        begin = end
    if not hashes:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none)
    starts = np.concatenate(starts_at)
    return Words(np.concatenate(hashes), np.searchsorted(starts, offsets), starts, np.concatenate(all_sizes))


def shingles(words: Words, size: int, whole_if_short: bool = True) -> Words:
    """Hashes of the ``size``-word windows of each text; a shorter text with words is one window, if so wished."""
    h, counts = words.hashes, words.counts
    out = np.zeros(len(h), np.uint64)
    if len(h) >= size:
        run = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            run = run * _BASE + h[k:len(h) - size + 1 + k]
        out[:len(run)] = mix(run)
    windows = np.maximum(counts - size + 1, 0)
    if whole_if_short:
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            total = np.uint64(counts[i])
            for x in h[words.bounds[i]:words.bounds[i + 1]]:
                with np.errstate(over="ignore"):
                    total = total * _BASE + x
            out[words.bounds[i]] = mix(np.array([total]))[0]
            windows[i] = 1
    taken = np.arange(len(h)) - np.repeat(words.bounds[:-1], counts) < np.repeat(windows, counts)
    return Words(out[taken], np.concatenate(([0], np.cumsum(windows))))


def distinct(words: Words) -> Words:
    """Sorted distinct hashes of each text."""
    sets = [np.unique(words.hashes[a:b]) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    return Words(np.concatenate(sets) if sets else words.hashes, np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64))))


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES):
    """Slices of a batch with about ``limit`` bytes of text; a longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    ends = np.cumsum(sizes)
    done = 0
    while done < len(sizes):
        before = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(done, upto - done)
        done = upto


class Known:
    """A bounded dictionary of 64-bit hashes; ``find`` tells which of many hashes it holds."""

    SIEVE_BITS = 20

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes  # sorted, distinct
        self.sieve = np.zeros(1 << self.SIEVE_BITS, bool)  # which upper bits occur
        self.sieve[hashes >> np.uint64(64 - self.SIEVE_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of what is known, and its places in the dictionary."""
        at = np.flatnonzero(self.sieve[hashes >> np.uint64(64 - self.SIEVE_BITS)])
        which = np.searchsorted(self.hashes, hashes[at])
        known = which < len(self.hashes)
        known[known] = self.hashes[which[known]] == hashes[at[known]]
        return at[known], which[known]
