"""Quality rules: counts of each text, and how far its make-up is from that of its language.

Counts: words, their code points, symbols, repeated lines, and words in repeated 3-word windows.  Two histograms of each
text, one of character classes and one of the language's common words (with one bin for all others), are
compared with the sums over all documents of the language by the Jensen-Shannon distance (base 2, from 0 to 1).

Sums follow junk as its share grows.  ``typical=True`` also compares the character classes with the typical document of the
language, the median of each class's share over all its documents, which junk moves only once it is about half of them: a
document must be near both.

The references cover the whole table.  Common words are those with at least ``SHARE`` of all words of their language, so there
are at most 1 / SHARE of them, each seen 20 times or more: a language with fewer than ``MIN_LANGUAGE_WORDS`` words has no
reference, as its few documents would be held against themselves, and what the rest of the table holds has no part in that.
Languages are dealt into blocks of ``BLOCK_LANGUAGES`` on average, each with a pass of its own, which bounds what is broadcast.
Documents without a reference, and those with fewer than ``MIN_WORDS`` words (``MIN_COMMON_WORDS`` for the finer word
histogram), are not judged by distance.

Null text counts as empty and fails the base rules; null lang is a language of its own.  Repeated rows are judged each
and count in the references each.  Columns of ``docs`` that clash with results are replaced; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.session import written

from .words import SEPARATOR, by_bytes, hash_words, mix, shingles, text_bytes

SHARE, MIN_LANGUAGE_WORDS, BLOCK_LANGUAGES = 0.004, 5_000, 1_000
MIN_WORDS, MIN_COMMON_WORDS = 50, 100
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.45

CLASSES = ("lower", "upper", "digit", "space", "mark", "latin", "other")
_CLASS = np.full(256, 6, np.int64)
_CLASS[0x00:0x80] = 4
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[SEPARATOR] = 3
_CLASS[0x80:0xC0] = 7  # not the first byte of a code point
_CLASS[0xC3:0xCA] = 5  # U+00C0 to U+027F
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE_END = np.zeros(256, bool)
_LINE_END[0x0A] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def text_counts(data: np.ndarray, offsets: np.ndarray, words) -> dict[str, np.ndarray]:
    """The base counts of all texts."""
    n = len(offsets) - 1
    own = mix(np.arange(1, n + 1, dtype=np.uint64))  # keeps equal windows of different texts apart
    inside = ~SEPARATOR[data]

    windows = shingles(words, 3, whole_if_short=False)
    text_of = np.repeat(np.arange(n), windows.counts)
    _, back, found = np.unique(windows.hashes ^ own[text_of], return_inverse=True, return_counts=True)
    repeated = found[back] >= 2
    first_word = words.bounds[:-1][text_of] + np.arange(len(text_of)) - windows.bounds[:-1][text_of]
    covered = np.zeros(len(words.hashes), bool)
    for k in range(3):
        covered[first_word[repeated] + k] = True

    lines = hash_words(data, offsets, separator=_LINE_END)
    seen = np.concatenate(([0], np.cumsum(inside)))
    has_word = seen[lines.starts + lines.sizes] > seen[lines.starts]
    line_text = np.repeat(np.arange(n), lines.counts)[has_word]
    _, first = np.unique(lines.hashes[has_word] ^ own[line_text], return_index=True)
    again = np.ones(len(line_text), bool)
    again[first] = False
    return {
        "n_words": words.counts,
        "word_chars": _per_text(inside & (data & 0xC0 != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_text[again], minlength=n),
        "n_repeat_words": _per_text(covered, words.bounds),
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of counts ``p`` from the counts ``q``; 0 for rows without counts."""
    total = p.sum(axis=1, keepdims=True)
    p = p / np.where(total > 0, total, 1)
    q = np.broadcast_to(q / max(q.sum(), 1), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip(parts.sum(axis=1) / 2, 0, 1)), 0.0)


@dataclass
class Reference:
    hashes: np.ndarray  # of the common words, sorted
    counts: np.ndarray  # of the common words and, last, of all others


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all documents."""
    word = F.explode(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"))
    counts = docs.select("lang", word.alias("word")).where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    return written(counts, "word-counts")


def in_block(block: int, blocks: int) -> Column:
    return F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block


def common_words(counts: DataFrame, totals: DataFrame, share: float = SHARE) -> dict[str, Reference]:
    """The common words of each language of ``totals`` (lang, total); 1 / share rows of each at most reach the driver."""
    rows: dict[str, list] = {r.lang: [] for r in totals.select("lang").collect()}
    for r in counts.join(totals, "lang").where(F.col("n") >= share * F.col("total")).select("lang", "word", "n", "total").collect():
        rows[r.lang].append(r)
    found: dict[str, Reference] = {}
    for lang, common in rows.items():
        data, offsets = text_bytes(pa.array([r.word for r in common], pa.string()))
        hashes = hash_words(data, offsets).hashes
        order = np.argsort(hashes)
        n = np.array([r.n for r in common], np.float64)[order]
        found[lang] = Reference(hashes[order], np.append(n, common[0].total - n.sum() if common else 1.0))
    return found


def measure(docs: DataFrame, share: float = SHARE, min_language_words: int = MIN_LANGUAGE_WORDS, typical: bool = False,
            block_languages: int = BLOCK_LANGUAGES) -> DataFrame:
    """``docs`` (doc_id, text, lang) with the counts, class_distance and word_distance (null without a reference), and typical_distance if asked for."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    counts = word_counts(rows)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= min_language_words)
    blocks = max(1, -(-totals.count() // block_languages))
    kind = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", classes array<long>, word_distance double"
    passes = []
    for block in range(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(common_words(counts.where(in_block(block, blocks)), totals.where(in_block(block, blocks)), share))
        passes.append(written(rows.where(in_block(block, blocks)).mapInArrow(_counter(shared), kind), "text-counts"))
    return reduce(DataFrame.unionByName, [_distances(counted, min_language_words, typical) for counted in passes])


def _distances(counted: DataFrame, min_language_words: int, typical: bool) -> DataFrame:
    """The counts of one block of languages with their distances; ``counted`` is a written table."""
    sums = counted.groupBy("lang").agg(F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]).alias("reference"), F.sum("n_words").alias("n"))
    sums = sums.where(F.col("n") >= min_language_words).drop("n")
    if typical:
        sums = sums.join(_medians(counted), "lang", "left")
    # one row per language with a reference, BLOCK_LANGUAGES on average
    judged = counted.join(F.broadcast(sums), "lang", "left")
    distances = [_js(F.col("classes"), F.col("typical")).alias("typical_distance")] if typical else []
    return judged.select("doc_id", "lang", *COUNTS, _js(F.col("classes"), F.col("reference")).alias("class_distance"), "word_distance", *distances)


def _medians(counted: DataFrame) -> DataFrame:
    """lang, typical: for each class the exact median of its share in a text, in thousandths.

    The shares are counted first, which leaves at most 1,001 rows for each language and class; empty texts have none.
    """
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda s, v: s + v)
    shares = F.transform("classes", lambda n: F.floor((2000 * n + F.col("total")) / (2 * F.col("total"))))
    texts = counted.withColumn("total", total).where("total > 0").select("lang", F.posexplode(shares).alias("kind", "share"))
    counts = texts.groupBy("lang", "kind", "share").agg(F.count("*").alias("n"))
    of_kind = Window.partitionBy("lang", "kind")
    upto = counts.withColumns({"upto": F.sum("n").over(of_kind.orderBy("share")), "all": F.sum("n").over(of_kind)})
    # the two middle ones of an even number
    middle = upto.groupBy("lang", "kind").agg((F.min(F.when(2 * F.col("upto") >= F.col("all"), F.col("share")))
                                               + F.min(F.when(2 * F.col("upto") > F.col("all"), F.col("share")))).alias("twice"))
    return middle.groupBy("lang").agg(F.array(*[F.max(F.when(F.col("kind") == i, F.col("twice") / 2)) for i in range(len(CLASSES))]).alias("typical"))


def _counter(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What counts each text and compares its words with the shared references."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = shared.value
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                data, offsets = text_bytes(batch.column("text"))
                words = hash_words(data, offsets)
                n = len(offsets) - 1
                counts = text_counts(data, offsets, words)
                text_of_byte = np.repeat(np.arange(n), np.diff(offsets))
                classes = np.bincount(text_of_byte * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)[:, :len(CLASSES)]
                distance = np.full(n, np.nan)
                langs = np.array(batch.column("lang").to_pylist(), object)
                text_of_word = np.repeat(np.arange(n), words.counts)
                for lang in set(langs) & set(references):
                    ref, size = references[lang], len(references[lang].counts)
                    of_lang = np.flatnonzero(langs == lang)
                    row = np.full(n, -1)
                    row[of_lang] = np.arange(len(of_lang))
                    mine = row[text_of_word] >= 0
                    h = words.hashes[mine]
                    bin_ = np.searchsorted(ref.hashes, h)
                    hit = bin_ < size - 1
                    hit[hit] = ref.hashes[bin_[hit]] == h[hit]
                    bins = np.where(hit, bin_, size - 1)
                    table = np.bincount(row[text_of_word[mine]] * size + bins, minlength=len(of_lang) * size).reshape(-1, size)
                    distance[of_lang] = js_distance(table, ref.counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("lang"), *(pa.array(counts[c], pa.int64()) for c in COUNTS),
                     pa.array(list(classes.astype(np.int64)), pa.list_(pa.int64())), pa.array(distance, from_pandas=True)],
                    names=["doc_id", "lang", *COUNTS, "classes", "word_distance"])

    return count


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null where one is missing or empty."""
    total = lambda x: F.nullif(F.aggregate(x, F.lit(0.0), lambda s, v: s + v), F.lit(0.0))
    shares = lambda x: F.transform(x, lambda v: v / total(x))
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    parts = F.zip_with(shares(p), shares(q), lambda a, b: (part(a, b) + part(b, a)) / 2)
    distance = F.sqrt(F.least(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v), F.lit(0.0)), F.lit(1.0)))
    return F.when(total(p).isNotNull() & total(q).isNotNull(), distance)  # least and greatest pass over nulls


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_quality(docs: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, typical: bool = False) -> DataFrame:
    """Counts, distances, base_failed and kept, one row per row of ``docs``."""
    measured = measure(docs, typical=typical)
    class_distance = F.greatest("class_distance", "typical_distance") if typical else F.col("class_distance")
    far = (((F.col("n_words") >= MIN_WORDS) & (class_distance > max_class))
           | ((F.col("n_words") >= MIN_COMMON_WORDS) & (F.col("word_distance") > max_word)))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
