"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the code points cuts every text where the last ``WINDOW`` of them hash to a given pattern, so equal
passages of different documents fall into equal chunks wherever they stand.  A worker encodes each distinct chunk once and
keeps its ids over all its tasks, up to ``CACHE_BYTES``.  A chunk may end inside a word, where the ids of two chunks side by side are not those of the joined text:
each join is repaired by encoding a window around it again.  The window grows by one blank on either side until the ids of
its two outer parts agree with the last ids of the left chunk and the first ids of the right one; chunks without any blank
are joined to the one before and encoded with it, once.  Blanks end pre-tokens and are dropped, so what agrees there is exact.

Null or empty text: no ids, and the decoded text is empty.  Repeated rows are encoded each; extra columns pass through
unless they clash with the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import PieceEncoder, load_tokenizer
from .registry import free_name
from .words import by_bytes

WINDOW, CUT_BITS = 16, 9  # a cut about every 512 code points
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_ONE = 1 << 64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _POWER or len(_POWER[base]) < n:
        _POWER[base] = _powers(base, max(n, 1 << 16))
    return _POWER[base][:n]


def cuts(text: str) -> list[int]:
    """Ends of the chunks of ``text``."""
    n = len(text)
    if n <= WINDOW:
        return [n] if n else []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    prefix = np.cumsum(points * powers(_BASE, n), dtype=np.uint64)
    window = prefix[WINDOW - 1:].copy()
    window[1:] -= prefix[:-WINDOW]
    rolling = window * powers(pow(_BASE, -1, _ONE), n - WINDOW + 1)  # independent of the position
    rolling = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    ends = np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    return [*ends[ends < n].tolist(), n]


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Start and end of what is encoded together, and whether it is one chunk: chunks up to the next one with a blank."""
    found: list[tuple[int, int, bool]] = []
    start, open_ = 0, True  # no blank yet in what came last
    for end in cuts(text):
        blank = blank_after(text, start, end) < end
        if found and (open_ or not blank):
            found[-1] = (found[-1][0], end, False)
            open_ = open_ and not blank
        else:
            found.append((start, end, True))
            open_ = not blank
        start = end
    return found


def blank_before(text: str, end: int) -> int:
    """The last place before ``end`` behind a blank or a line break; 0 where there is none."""
    return max(text.rfind(" ", 0, end), text.rfind("\n", 0, end)) + 1


def blank_after(text: str, start: int, end: int | None = None) -> int:
    """The first blank or line break from ``start`` on; the end where there is none."""
    end = len(text) if end is None else end
    found = [i for i in (text.find(" ", start, end), text.find("\n", start, end)) if i >= 0]
    return min(found, default=end)


_ENCODERS: dict[str, "ChunkEncoder"] = {}
_DECODERS: dict[str, "Decoder"] = {}
LONG_WINDOW = 10_000  # longer windows are not kept
PIECE_CHARS = 8_000_000  # characters of pieces that a worker keeps for them, some 100 MB of arrays
CACHE_BYTES, ENTRY = 32_000_000, 400  # about what a worker keeps, and what an entry takes besides its text and ids


class ChunkEncoder:
    """Chunks and joins of one worker; both caches start afresh beyond ``CACHE_BYTES``."""

    @classmethod
    def of_worker(cls, path: str) -> "ChunkEncoder":
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def __init__(self, path: str):
        self.pieces = PieceEncoder(path, PIECE_CHARS)
        self.chunks: dict[str, np.ndarray] = {}
        self.windows: dict[str, list[int]] = {}
        self.held = 0
        self.reused = self.encoded = 0

    def _window(self, text: str) -> list[int]:
        if len(text) > LONG_WINDOW:
            return self.pieces.tokenizer.encode(text, add_special_tokens=False).ids
        if text not in self.windows:
            self.windows[text] = self.pieces.tokenizer.encode(text, add_special_tokens=False).ids if text else []
            self.held += ENTRY + 3 * len(text)
        return self.windows[text]

    def chunk_ids(self, chunks: list[str]) -> None:
        """Encode the chunks that are not known yet."""
        if self.held > CACHE_BYTES:
            self.chunks, self.windows, self.held = {}, {}, 0
        missing = [c for c in dict.fromkeys(chunks) if c not in self.chunks]
        self.encoded += len(missing)
        self.reused += len(chunks) - len(missing)
        if missing:
            flat, counts = self.pieces.encode(missing)
            self.chunks.update((c, ids.copy()) for c, ids in zip(missing, np.split(flat, np.cumsum(counts)[:-1])))  # views would keep all of flat
            self.held += sum(ENTRY + 3 * len(c) for c in missing)

    def _repaired(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> tuple[int, list[int], int]:
        """How many ids of ``left`` hold, the ids of the window, and how many ids of ``right`` it replaces."""
        start, end = blank_before(left, len(left)), blank_after(right, 0)
        while True:
            before, after = self._window(left[start:]), self._window(right[:end])
            agrees_left = start == 0 or left_ids[len(left_ids) - len(before):].tolist() == before
            agrees_right = end == len(right) or right_ids[:len(after)].tolist() == after
            if agrees_left and agrees_right:
                return len(left_ids) - len(before), self._window(left[start:] + right[:end]), len(after)
            start = start if agrees_left else blank_before(left, start - 1)
            end = end if agrees_right else blank_after(right, end + 1)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; new chunks of all of them are encoded first, in one call."""
        parts = [spans(t) for t in texts]
        self.chunk_ids([t[a:b] for t, own in zip(texts, parts) for a, b, single in own if single])
        return [self._joined(t, own) for t, own in zip(texts, parts)]

    def _joined(self, text: str, parts: list[tuple[int, int, bool]]) -> np.ndarray:
        done: list[np.ndarray] = []
        whole, ids = "", np.zeros(0, np.int32)  # what has not been given out yet, and its ids; with a blank, unless it is all
        for start, end, single in parts:
            part = text[start:end]
            own = self.chunks[part] if single else self.pieces.encode([part])[0]
            if not whole:
                whole, ids = part, own
                continue
            keep, window, drop = self._repaired(whole, ids, part, own)
            done += [ids[:keep], np.asarray(window, np.int32)]
            whole, ids = part[blank_after(part, 0):], own[drop:]
        return np.concatenate([*done, ids]) if done else ids


class Decoder:
    """Text of ids as the library gives it where a vocabulary has no decoder: tokens with a blank between them."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.plain = self.tokenizer.decoder is None
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)] if self.plain else []

    @classmethod
    def of_worker(cls, path: str) -> "Decoder":
        if path not in _DECODERS:
            _DECODERS[path] = cls(path)
        return _DECODERS[path]

    def decode(self, ids: np.ndarray) -> str:
        if not self.plain:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


BATCH_BYTES = 400_000  # of texts that are encoded in one call and given out in one batch; a longer text is one by itself


def _coded(ids: list[np.ndarray], decoder: Decoder, with_ids: bool) -> pa.StructArray:
    sizes = [len(i) for i in ids]
    columns = {"n_tokens": pa.array(sizes, pa.int64()),
               "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
               "decoded_sha256": pa.array([hashlib.sha256(decoder.decode(i).encode()).hexdigest() for i in ids], pa.string())}
    if with_ids:
        flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        columns["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def coded(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256.

    ``with_ids``: with the ids themselves as well.
    """
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.arrow_udf(f"struct<{kind.replace(' ', ':').replace(',:', ',')}>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = ChunkEncoder.of_worker(path), Decoder.of_worker(path)
        for column in batches:
            whole = pa.RecordBatch.from_arrays([column], names=["text"])
            for part in by_bytes(whole, "text", BATCH_BYTES):
                yield _coded(encoder.encode_all(part.column(0).to_pylist()), decoder, with_ids)

    names = [c.split()[0] for c in kind.split(", ")]
    own = docs.drop(*names)
    result = free_name(own, "code_")
    rows = own.withColumn(result, code(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return rows.select(*own.columns, *[F.col(f"{result}.{n}").alias(n) for n in names])
