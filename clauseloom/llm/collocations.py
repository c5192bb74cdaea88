"""Phrase collocations: pairs of frequency-ranked ids counted in tiles, level by level.

**Ranks.** The words of ``min_count`` occurrences or more in their language are numbered by frequency.  A text becomes a stream of these
numbers, broken at other words and at the ends of pieces: a phrase that is frequent enough has only such words.
**Tiles.** Adjoining numbers are pairs.  A pair of ranks (a, b) lies in the tile (a / ``TILE``, b / ``TILE``).  The tiles in the corner of the
frequent ranks are addressed directly and counted with a dense bincount; pairs of all others are sorted coordinates.  Counts are
summed in the task, which gives out what passes its bound, and then over all tasks by a shuffle.
**Recursion.** Frequent pairs are ranked by frequency in turn and replace their two places in the stream: two adjoining pairs
are a phrase of three words, and so on.  Every phrase is a pair of phrases one word shorter, which are frequent too.

Dictionaries are broadcast in blocks of ``BLOCK`` entries; beyond one block, a written pass over the streams for each finishes them.
Words are known by 62-bit hashes together with their language while texts are read; their counts are by the words themselves.

Null texts are empty, a null lang is ``und``; rows that repeat an id, and its value, do not matter; extra columns are ignored.  Where
no phrase reaches ``min_count`` there are no rows.  Languages with too few words simply have no phrases.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.session import written

from .registry import discard
from .words import Known, by_bytes, hash_words, mix, text_bytes

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
TILE_BITS, CORNER = 9, 16  # 512 x 512 pairs a tile; tiles (i, j) with (i + 1) (j + 1) <= CORNER are dense
SPARSE = 2 << 20  # sorted coordinates that a task holds
BLOCK = 2 << 20  # dictionary entries broadcast at a time
BETWEEN = "[ \t.,;:!?\n-\r]+"

_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _PIECE.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOW = (1 << 32) - 1


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of every word of the texts."""
    text = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    # an inner explode would let the split be worked out a second time, for a filter on its size
    words = docs.select(_lang().alias("lang"), F.explode_outer(F.split(text, BETWEEN)).alias("word"))
    return words.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))


def _lang():
    return F.coalesce(F.col("lang").cast("string"), F.lit("und"))


def ranked(df: DataFrame, name: str, *order) -> DataFrame:
    """The rows with ``id``, their place in the order from 0: parts of a range partition, numbered from the sizes of those before."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = written(placed.withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))}), name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each part of the range partition
    starts = placed.groupBy("part").agg(F.count("*").alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").withColumn("id", F.col("start") + F.col("place")).drop("part", "place", "start")


# --- streams ---------------------------------------------------------------------------------------------


def lang_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def word_keys(column: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """62-bit keys of the words of texts, and which of them begin a piece."""
    data, offsets = text_bytes(column)
    words = hash_words(data, offsets, fold=True, separator=_BETWEEN)
    own = np.repeat(np.array([lang_key(x) for x in langs.to_pylist()], np.uint64), words.counts)
    keys = (mix(words.hashes ^ own) >> np.uint64(2)).view(np.int64)
    piece = np.searchsorted(np.flatnonzero(_PIECE[data]), words.starts) if len(keys) else keys
    first = np.ones(len(keys), bool)
    first[1:] = piece[1:] != piece[:-1]
    first[words.bounds[:-1][words.counts > 0]] = True
    return keys, first


def with_breaks(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The keys with -1 before each that begins a piece."""
    stream = np.full(len(keys) + int(first.sum()), -1, np.int64)
    stream[np.arange(len(keys)) + np.cumsum(first)] = keys
    return stream


def tidy(stream: np.ndarray, shortest: int = 2) -> np.ndarray:
    """Without numbers that have no neighbour (for ``shortest`` = 2) and with one break between runs."""
    valid = np.concatenate(([False], stream != -1, [False]))
    if shortest > 1:
        valid[1:-1] &= valid[:-2] | valid[2:]
    inside, behind = valid[1:-1], valid[:-2]
    return np.where(inside, stream, -1)[inside | behind]


def pair_keys(stream: np.ndarray) -> np.ndarray:
    """Each place's number and the next as one key, -1 where there are not two."""
    a, b = stream[:-1], stream[1:]
    return np.where((a >= 0) & (b >= 0), (a << 32) | np.maximum(b, 0), -1)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for whole in batches:
        for batch in by_bytes(whole, "text"):
            yield with_breaks(*word_keys(batch.column("text"), batch.column("lang")))


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        column = batch.column("stream")
        flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
        for a, b in zip(ends[:-1], ends[1:]):
            yield flat[a:b].astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for stream in _stored(batches):
        yield pair_keys(stream)


class Dictionary:
    """A block of keys with their numbers."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        order = np.argsort(keys)
        self.known, self.ids = Known(_spread(keys[order])), ids[order]

    def fill(self, keys: np.ndarray) -> np.ndarray:
        """Known keys (0 or more) become -2 - number; others stay."""
        out = keys.copy()
        open_ = np.flatnonzero(keys >= 0)
        at, which = self.known.find(_spread(keys[open_]))
        out[open_[at]] = -2 - self.ids[which]
        return out


def _spread(keys: np.ndarray) -> np.ndarray:
    """Keys moved up to the bits that the sieve looks at, in the same order."""
    return keys.astype(np.uint64) << np.uint64(1)


def replaced(source: DataFrame, read: Callable, table: DataFrame, key: Callable[[pa.Table], np.ndarray], columns: list[str]) -> DataFrame:
    """``stream``: the keys that ``read`` makes of ``source``, as the ids of ``table``; keys that it does not hold are breaks."""
    spark = source.sparkSession
    blocks = max(1, -(-table.count() // BLOCK))
    if blocks * BLOCK >= 1 << 31:
        raise ValueError("more phrases of one length than 31 bits can number")
    current = source
    for k in range(blocks):
        rows = table.where((F.col("id") >= k * BLOCK) & (F.col("id") < (k + 1) * BLOCK)).select("id", *columns).toArrow()
        shared, last = spark.sparkContext.broadcast(Dictionary(key(rows), rows.column("id").to_numpy())), k == blocks - 1

        def fill(batches: Iterator[pa.RecordBatch], shared=shared, last=last, read=read) -> Iterator[pa.RecordBatch]:
            for keys in read(batches):
                stream = shared.value.fill(keys)
                if last:
                    stream = tidy(np.where(stream <= -2, -2 - stream, -1))
                if len(stream):
                    kind = np.int32 if last else np.int64
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(stream)], pa.int32()), pa.array(stream.astype(kind)))], names=["stream"])

        before, current = current, written(current.mapInArrow(fill, "stream array<int>" if last else "stream array<long>"), "streams")
        if k:
            discard(before)
        read = _stored
    return current


# --- counts ------------------------------------------------------------------------------------------------


class TileCounts:
    """Counts of pairs of ranks: dense tiles in the frequent corner, sorted coordinates elsewhere."""

    def __init__(self, bits: int = TILE_BITS, corner: int = CORNER, sparse: int = SPARSE):
        self.bits, self.corner, self.most = bits, corner, sparse
        self.dense: dict[int, np.ndarray] = {}
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a, b = keys >> 32, keys & _LOW
        i, j = a >> self.bits, b >> self.bits
        corner = (i + 1) * (j + 1) <= self.corner
        size, inside = 1 << self.bits, (1 << self.bits) - 1
        tiles = (i * self.corner + j)[corner]
        cells = (((a & inside) << self.bits) | (b & inside))[corner]
        order = np.argsort(tiles, kind="stable")
        tiles, cells = tiles[order], cells[order]
        cuts = np.flatnonzero(np.diff(tiles)) + 1
        for part, tile in zip(np.split(cells, cuts), tiles[np.concatenate(([0], cuts))] if len(tiles) else []):
            counts = np.bincount(part, minlength=size * size)
            if tile in self.dense:
                self.dense[int(tile)] += counts
            else:
                self.dense[int(tile)] = counts
        self.waiting.append(keys[~corner])
        self.n_waiting += len(self.waiting[-1])
        if self.n_waiting >= self.most:
            self._merge()
            if len(self.keys) >= self.most:
                yield self.keys, self.counts
                self.keys, self.counts = self.keys[:0], self.counts[:0]

    def _merge(self) -> None:
        keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True) if self.waiting else (self.keys[:0], self.counts[:0])
        self.waiting, self.n_waiting = [], 0
        both = np.concatenate((self.keys, keys))
        order = np.argsort(both, kind="stable")
        both, added = both[order], np.concatenate((self.counts, counts))[order]
        if len(both):
            starts = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
            self.keys, self.counts = both[starts], np.add.reduceat(added, starts)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self._merge()
        yield self.keys, self.counts
        for tile, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            a = (tile // self.corner << self.bits) | (cells >> self.bits)
            b = (tile % self.corner << self.bits) | (cells & ((1 << self.bits) - 1))
            yield (a << 32) | b, counts[cells]


def pair_counts(streams: DataFrame) -> DataFrame:
    """pair, n: how often each pair of numbers adjoins in the streams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = lambda keys, counts: pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["pair", "n"])
        tiles = TileCounts()
        for keys in _pairs(batches):
            for out in tiles.add(keys[keys >= 0]):
                yield give(*out)
        for out in tiles.rest():
            yield give(*out)

    return streams.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


# --- phrases -------------------------------------------------------------------------------------------------


def phrase_levels(docs: DataFrame, min_count: int, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language, and for each length from 1 the frequent phrases.

    Phrases have id, lang, phrase, a, left and right (ids one level down), and ``heads`` and ``tails``: counts of their first
    and last 1, 2, ... words.
    """
    counts = written(word_counts(docs), "word-counts")
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("n")), "lang-words")
    words = ranked(counts.where(F.col("n") >= min_count), "words", F.desc("n"), "lang", "word")
    none = F.lit(None).cast("long")
    words = written(words.select("id", "lang", F.col("word").alias("phrase"), F.col("n").alias("a"), none.alias("left"), none.alias("right"),
                                 F.array("n").alias("heads"), F.array("n").alias("tails")), "phrases")
    discard(counts)
    levels = [words]
    texts = docs.select(_lang().alias("lang"), F.col("text").cast("string").alias("text"))

    def word_key(rows: pa.Table) -> np.ndarray:
        column = rows.column("phrase").combine_chunks()
        return word_keys(column, rows.column("lang").combine_chunks())[0]

    streams = replaced(texts, _texts, words, word_key, ["phrase", "lang"])
    for length in range(2, longest + 1):
        pairs = ranked(pair_counts(streams).where(F.col("n") >= min_count), "pairs", F.desc("n"), "pair")
        pairs = pairs.select("id", F.col("n").alias("a"), F.shiftright("pair", 32).alias("left"), F.col("pair").bitwiseAND(F.lit(_LOW)).alias("right"))
        below = levels[-1]
        left = below.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"), "heads")
        right = below.select(F.col("id").alias("right"), F.substring_index("phrase", " ", -1).alias("end"), "tails")
        more = lambda c: F.concat(c, F.array("a")).alias(c)
        phrases = pairs.join(left, "left").join(right, "right").select(
            "id", "lang", F.concat_ws(" ", "start", "end").alias("phrase"), "a", "left", "right", more("heads"), more("tails"))
        levels.append(written(phrases, "phrases"))
        if length < longest:
            before = streams
            streams = replaced(before, _pairs, levels[-1], lambda rows: (rows.column("left").to_numpy() << 32) | rows.column("right").to_numpy(), ["left", "right"])
            discard(before)
    discard(streams)
    return totals, levels


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``longest`` words of each language (documents: text, lang)."""
    totals, levels = phrase_levels(docs, min_count, longest)
    candidates = None
    for size, phrases in enumerate(levels[1:], 2):
        found = phrases.withColumn("size", F.lit(size))
        if size < longest:
            # a longer phrase as frequent holds it at every occurrence; one word more is enough to look at
            longer = levels[size].select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("longer"))
            found = found.join(longer.groupBy("id").agg(F.max("longer").alias("longer")), "id", "left").where("longer is null or longer < a")
        found = found.select("lang", "phrase", "a", "heads", "tails", "size")
        candidates = found if candidates is None else candidates.unionByName(found)
    whole = "cast({} as decimal(20, 0))"
    cut = (f"struct((cast(1000 as decimal(4, 0)) * {whole.format('a')} * {whole.format('n')}) div ({whole.format('heads[k - 1]')} * {whole.format('tails[size - k - 1]')}) as score, "
           "k, heads[k - 1] as l, tails[size - k - 1] as r)")
    scored = candidates.join(totals, "lang").withColumn("cut", F.expr(f"array_min(transform(sequence(1, size - 1), k -> {cut}))"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
