"""Benchmark decontamination: rare n-gram seeds find passages, word-level Smith-Waterman alignment scores them.

**Alignment.** Match +2, other word -1, missing or added word -2, best local score S.  An item of L words leaks into a document
where S >= 2 L - 3 e with e = L x (100 - similarity) / 100, rounded down: up to e replaced words, or fewer words that were
dropped or added.
**Seeds.** Such an alignment leaves out or breaks at most 3 e of the item's 3-word sequences, so of any 3 e + 1 of them one
stands unchanged in the document.  Taken are those that fewest documents contain, counted over all documents; a
document without a seed of an item cannot hold it.  Where a seed is found, the part of the text that an alignment through it can
touch is aligned, if it has enough words of the item at all.

Words are runs of letters and digits in lower case; ASCII, Latin-1, general and East Asian punctuation separates.  In scripts
without blanks (Chinese, Japanese, Thai and their like) each code point is a word.  The items are a query
set, broadcast in blocks of at most ``BLOCK_CHARS`` characters, each of which meets all documents inside their rows: no text is
shuffled.  Items of fewer than ``EXACT_BELOW`` words must stand in the document word for word.  Those of fewer than ``SEED``, which
any text may hold by chance, are not searched, and neither are null items; ``unsearched`` lists both.
Null, empty and short documents hold nothing.  Items with equal texts are reported each, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, by_bytes, hash_words, shingles, text_bytes

SEED, EXACT_BELOW, SIMILARITY = 3, 8, 80
BLOCK_CHARS = 4_000_000
_SIEVE_BITS = 20
_PART = 1 << 20  # scores and matches share a number: score x _PART + matches

_BETWEEN = np.ones(256, bool)
_BETWEEN[0x80:] = False
for _first, _last in ("09", "az", "AZ"):
    _BETWEEN[ord(_first):ord(_last) + 1] = False


_EASTERN = np.zeros(256, bool)
_EASTERN[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, *range(0xF0, 0xF5)]] = True
_ALONE = "([\u0e00-\u0edf\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])"
_EASTERN_MARKS = "[\u3000-\u3004\u3008-\u3040\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]"


def leak_words(column: pa.Array) -> Words:
    """Hashes of the lower-case words of texts."""
    column = pc.utf8_lower(column.cast(pa.large_string()))
    data, offsets = text_bytes(column)
    # first bytes of U+0800 to U+0FFF, U+1000 to U+1FFF, U+3000 to U+9FFF, U+F000 to U+FFFF and beyond
    if _EASTERN[data].any():
        marked = pc.replace_substring_regex(column, _EASTERN_MARKS, " ")
        data, offsets = text_bytes(pc.replace_substring_regex(marked, _ALONE, r" \1 "))
    lead = np.flatnonzero(data[:-1] >= 0xC2) if len(data) else np.zeros(0, np.int64)
    latin = lead[data[lead] == 0xC2]
    general = lead[(data[lead] == 0xE2) & (data[lead + 1] & 0xFE == 0x80)]
    if len(latin) or len(general):
        data = data.copy()
        data[latin] = data[latin + 1] = 0x20
        data[general] = data[general + 1] = data[general + 2] = 0x20
    return hash_words(data, offsets, separator=_BETWEEN)


@dataclass
class Block:
    """A bounded part of the items with their 3-word sequences."""

    ids: np.ndarray
    words: list[np.ndarray]
    grams: np.ndarray  # sorted distinct sequences of the block
    sieve: np.ndarray  # which upper bits of a hash occur among them

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of known sequences, and which they are."""
        at = np.flatnonzero(self.sieve[hashes >> np.uint64(64 - _SIEVE_BITS)])
        which = np.searchsorted(self.grams, hashes[at])
        known = which < len(self.grams)
        known[known] = self.grams[which[known]] == hashes[at[known]]
        return at[known], which[known]


def _sieve(grams: np.ndarray) -> np.ndarray:
    sieve = np.zeros(1 << _SIEVE_BITS, bool)
    sieve[grams >> np.uint64(64 - _SIEVE_BITS)] = True
    return sieve


def build_block(ids: list[int], texts: list[str]) -> Block:
    words = leak_words(pa.array(texts, pa.string()))
    long = np.flatnonzero(words.counts >= SEED)
    grams = np.unique(shingles(words, SEED, whole_if_short=False).hashes)
    return Block(np.array(ids, np.int64)[long], [words.hashes[words.bounds[i]:words.bounds[i + 1]] for i in long], grams, _sieve(grams))


def _grams(words: np.ndarray) -> np.ndarray:
    return shingles(Words(words, np.array([0, len(words)])), SEED, whole_if_short=False).hashes


def edits(length: int, similarity: int) -> int:
    return length * (100 - similarity) // 100 if length >= EXACT_BELOW else 0


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local score, the words matched by it, and the word of ``text`` where it ends."""
    ramp = 2 * _PART * np.arange(1, len(text) + 1, dtype=np.int64)
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = above[:-1] + np.where(text == word, 2 * _PART + 1, -_PART)
        here = np.maximum(np.maximum(step, above[1:] - 2 * _PART), 0)
        here = np.maximum.accumulate(here + ramp) - ramp
        here[here < _PART] = 0
        above[1:] = here
        top = int(here.argmax()) if len(here) else 0
        if len(here) and here[top] > best:
            best, end = int(here[top]), top
    return best // _PART, best % _PART, end


def document_frequencies(docs: DataFrame, block) -> dict[int, int]:
    """In how many documents each sequence of the block occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.value.grams), np.int64)
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                sequences = shingles(leak_words(batch.column("text")), SEED, whole_if_short=False)
                at, which = block.value.find(sequences.hashes)
                owner = np.searchsorted(sequences.bounds, at, "right")
                pairs = np.unique(owner * len(total) + which)
                total += np.bincount(pairs % len(total), minlength=len(total)) if len(pairs) else 0
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(met, pa.int64()), "n": pa.array(total[met], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r.gram: r.n for r in rows}  # at most the sequences of one block


def seeds_of(block: Block, frequency: dict[int, int], similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds as sorted hashes, with the item (its place in the block) and the word it stands at."""
    hashes, items, places = [], [], []
    for i, words in enumerate(block.words):
        grams = _grams(words)
        rarity = [frequency.get(int(g), 0) for g in np.searchsorted(block.grams, grams)]
        taken = sorted(range(len(grams)), key=lambda k: (rarity[k], k))[:3 * edits(len(words), similarity) + 1]
        hashes.append(grams[taken])
        items.append(np.full(len(taken), i))
        places.append(np.array(taken))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, items, places = np.concatenate(hashes), np.concatenate(items), np.concatenate(places)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], items[order], places[order]


def leaks_in(text: np.ndarray, at: np.ndarray, items: np.ndarray, places: np.ndarray, block: Block, similarity: int):
    """The items that ``text`` holds, from its seed hits: (item, score, matched, end)."""
    for i in np.unique(items):
        item = block.words[i]
        e = edits(len(item), similarity)
        least = 2 * len(item) - 3 * e
        reach = len(item) + 3 * e  # an alignment through a seed lies within this
        starts = np.unique(at[items == i] - places[items == i])
        best = (0, 0, 0)
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > reach) + 1):
            low, high = max(0, int(part[0]) - 3 * e), min(len(text), int(part[-1]) + reach)
            window = text[low:high]
            if 2 * np.isin(item, window).sum() < least:
                continue
            score, matched, end = align(window, item)
            if score > best[0]:
                best = (score, matched, low + end)
        if best[0] >= least:
            yield int(i), best[0] / (2 * len(item)), best[1], best[2]


def find_leaks(docs: DataFrame, items: DataFrame, similarity: int = SIMILARITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, score (part of the full alignment score), n_matched, n_words, end_word: documents that hold items."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = int((items.agg(F.sum(F.char_length("text"))).first()[0] or 0) / block_chars) + 1
    kind = "doc_id long, item_id long, score double, n_matched long, n_words long, end_word long"
    found = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        block = spark.sparkContext.broadcast(build_block([r.item_id for r in rows], [r.text for r in rows]))
        hashes, owners, places = seeds_of(block.value, document_frequencies(texts, block), similarity)
        seeds = spark.sparkContext.broadcast((Block(block.value.ids, block.value.words, np.unique(hashes), _sieve(hashes)), hashes, owners, places))

        def match(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            known, all_hashes, all_owners, all_places = seeds.value
            first, last = (np.searchsorted(all_hashes, known.grams, side) for side in ("left", "right"))
            for whole in batches:
                for batch in by_bytes(whole, "text"):
                    out = []
                    words = leak_words(batch.column("text"))
                    sequences = shingles(words, SEED, whole_if_short=False)
                    at, which = known.find(sequences.hashes)
                    owner = np.searchsorted(sequences.bounds, at, "right") - 1
                    ids = batch.column("doc_id").to_pylist()
                    for d in np.unique(owner):
                        mine = owner == d
                        place, gram = at[mine] - sequences.bounds[d], which[mine]
                        times = last[gram] - first[gram]
                        entry = np.repeat(first[gram], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        text = words.hashes[words.bounds[d]:words.bounds[d + 1]]
                        for i, score, matched, end in leaks_in(text, np.repeat(place, times), all_owners[entry], all_places[entry], known, similarity):
                            out.append((ids[d], int(known.ids[i]), score, matched, len(known.words[i]), end))
                    columns = list(zip(*out)) if out else [[]] * 6
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                     names=["doc_id", "item_id", "score", "n_matched", "n_words", "end_word"])

        part = texts.mapInArrow(match, kind)
        found = part if found is None else found.unionByName(part)
    return found


def unsearched(items: DataFrame) -> DataFrame:
    """item_id, n_words: the items that ``find_leaks`` passes over."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(leak_words(batch.column("text")).counts, pa.int64())], names=["item_id", "n_words"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "item_id long, n_words long").where(F.col("n_words") < SEED)


def without_leaks(docs: DataFrame, items: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` without those that hold an item; a document is dropped whole.  Rows without an id are kept."""
    leaks = find_leaks(docs, items, similarity).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
