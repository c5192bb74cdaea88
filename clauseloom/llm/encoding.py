"""Exact token ids of whole texts through the tokenizers library, with each distinct piece encoded once per worker.

A blank or a line break ends every pre-token of the vocabularies used here, is itself dropped, and neither its
normalisation nor its added tokens reach across it.  So the ids of a text are the ids of its pieces between blanks, one
after the other, and a piece that was met before need not be encoded again.  Other white space stays inside its piece
and is left to the library.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from .words import Words, hash_words, text_bytes

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x0A]] = True
MARKS = (".", ",")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")  # letters that normalisation leaves alone

SLICE_CHARS = 4_000_000  # texts worked on together; a longer text is a slice of its own
MISSES_CHARS = 200_000  # characters encoded in one call
CACHE_CHARS = 32_000_000  # characters of pieces kept by a worker before it starts afresh

_WORKER: dict[str, "PieceEncoder"] = {}


def load_tokenizer(path: str):
    """The library's tokenizer of ``path``, one thread, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces_of(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def slices(texts: Iterable[str], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts in groups of about ``limit`` characters."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_pieces(tokenizer, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of non-empty ``pieces`` in one array, and the number of ids of each.

    The pieces are joined by blanks and encoded as one text; where a token starts tells whose it is.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    encoded = tokenizer.encode(" ".join(pieces), add_special_tokens=False)
    starts = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded))
    counts = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
    return np.asarray(encoded.ids, np.int32), counts


class PieceEncoder:
    """Ids of pieces, held in one flat array and found by the 64-bit hash of the piece; bounded by ``cache_chars``.

    A piece in capitals has the ids of its lower-case form where the tokenizer folds case, and a full stop or comma behind
    a letter is a pre-token of its own where the tokenizer splits there; both are asked of the tokenizer, and used to
    encode fewer pieces.
    """

    def __init__(self, path: str, cache_chars: int = CACHE_CHARS):
        self.tokenizer = load_tokenizer(path)
        self.cache_chars = cache_chars
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.folds = normalizer is not None and normalizer.normalize_str("AbcXYZ") == "abcxyz"
        self.splits = splitter is not None and all([p for p, _ in splitter.pre_tokenize_str("ab" + m)] == ["ab", m] for m in MARKS)
        self._clear()

    @classmethod
    def of_worker(cls, path: str) -> "PieceEncoder":
        if path not in _WORKER:
            _WORKER[path] = cls(path)
        return _WORKER[path]

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of pieces, and where each is in first and length
        self.places = np.zeros(0, np.int64)
        self.chars = 0
        self.ids = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 15, np.int64)
        self.length = np.zeros(1 << 15, np.int64)
        self.known = self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of sorted hashes; -1 for those not known."""
        at = np.searchsorted(self.keys, hashes)
        inside = at < len(self.keys)
        places = np.full(len(hashes), -1, np.int64)
        inside[inside] = self.keys[at[inside]] == hashes[inside]
        places[inside] = self.places[at[inside]]
        return places

    def _insert(self, hashes: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(hashes)
        at = np.searchsorted(self.keys, hashes[order])
        self.keys, self.places = np.insert(self.keys, at, hashes[order]), np.insert(self.places, at, places[order])

    def _store(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        upto = self.known + len(lengths)
        while upto > len(self.first):
            self.first, self.length = np.resize(self.first, 2 * len(self.first)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used:self.used + len(flat)] = flat
        self.length[self.known:upto] = lengths
        self.first[self.known:upto] = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        self.known = upto

    def _plain(self, pieces: list[str]) -> dict[str, int]:
        """Places of distinct pieces, which the library encodes where they are new."""
        data, offsets = text_bytes(pa.array([" ".join(pieces)], pa.large_string()))
        hashes, at = np.unique(hash_words(data, offsets, separator=BLANKS).hashes, return_index=True)
        places = self._find(hashes)
        new = np.flatnonzero(places < 0)
        start = self.known
        for group in slices((pieces[i] for i in at[new]), MISSES_CHARS):
            self._store(*encode_pieces(self.tokenizer, group))
            self.chars += sum(map(len, group))
        places[new] = np.arange(start, start + len(new))
        self._insert(hashes[new], places[new])
        return dict(zip((pieces[i] for i in at), places.tolist()))

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        forms = [p.lower() if p.isascii() else p for p in pieces] if self.folds else pieces
        marked = [self.splits and len(p) > 1 and p[-1] in MARKS and p[-2] in LETTERS for p in forms]
        plain = self._plain(list(dict.fromkeys([*MARKS, *(p[:-1] if m else p for p, m in zip(forms, marked))])))
        joined: dict[str, int] = {}
        parts: list[np.ndarray] = []
        places = []
        for p, m in zip(forms, marked):
            if not m:
                places.append(plain[p])
                continue
            if p not in joined:
                joined[p] = self.known + len(parts)
                both = [self.ids[self.first[c]:self.first[c] + self.length[c]] for c in (plain[p[:-1]], plain[p[-1]])]
                parts.append(np.concatenate(both))
            places.append(joined[p])
        if parts:
            self._store(np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts)))
        left = self._find(hashes) < 0  # a piece that is its own plain form is known by now
        self._insert(hashes[left], np.array(places, np.int64)[left])
        self.chars += 4 * len(pieces)

    def numbered(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all pieces of texts given as bytes: where their ids are; and where the pieces of each text begin."""
        if self.chars > self.cache_chars:
            self._clear()
        words = hash_words(data, offsets, separator=BLANKS)
        hashes, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        return self.places_of(hashes, data, words, at)[back], words.bounds

    def places_of(self, hashes: np.ndarray, data: np.ndarray, words: Words, at: np.ndarray) -> np.ndarray:
        """Where the ids of distinct pieces, given by sorted hashes, are; ``at`` gives one place of each among ``words``."""
        places = self._find(hashes)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            whole = data.tobytes()
            begin, size = words.starts[at[missing]].tolist(), words.sizes[at[missing]].tolist()
            self._learn(hashes[missing], [whole[b:b + n].decode() for b, n in zip(begin, size)])
            places = self._find(hashes)
        return places

    def lengths_of(self, hashes: np.ndarray, data: np.ndarray, words: Words, at: np.ndarray) -> np.ndarray:
        """The same for the numbers of their ids."""
        if self.chars > self.cache_chars:
            self._clear()
        places = self.places_of(hashes, data, words, at)
        return self.length[places]

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the number of ids of each text."""
        codes, bounds = self.numbered(data, offsets)
        lengths = self.length[codes]
        before = np.concatenate(([0], np.cumsum(lengths)))
        index = np.arange(before[-1]) + np.repeat(self.first[codes] - before[:-1], lengths)
        return self.ids[index], np.diff(before[bounds])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_bytes(*text_bytes(pa.array(texts, pa.large_string())))
