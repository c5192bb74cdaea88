"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a table of scores, one per quantile bin; so has each of the ``PAIRS`` pairs of features that explain most of what
is left.  All tables are learned together: shallow trees are boosted on one feature after the other, round after round, and
added to the feature's table.  A document's score is the logistic function of the sum of its bins' scores.

Learning takes at most ``MAX_TRAIN`` labelled documents, those with the smallest hashed ids, of which only the features reach
the driver; documents whose crc32(doc_id as text) leaves the remainder 1 modulo 3 are held out.  Scoring passes every whole text once.
Texts stay Arrow arrays, of which ``SLICE_BYTES`` are measured at a time (one text at least).  Inputs are measured on the text alone: labels, lang, source and doc_id are none.

Null and empty texts are scored like any other, by the bins of their zeros.  Without any label the score is 0.5; rows are
scored each; a null id is never learned from nor held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import _CLASS, CLASSES, text_counts
from .words import by_bytes, hash_words, mix, text_bytes

MAX_TRAIN = 20_000
SLICE_BYTES = 1 << 19  # a byte of text takes some 60 bytes of arrays while it is measured
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 64, 12, 12, 150, 60, 0.1

FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeated", "distinct", "top_word", "words_per_line", "log_lines",
            *(f"share_{c}" for c in CLASSES), "mark_words", "long_words")
_LINE_END = np.zeros(256, bool)
_LINE_END[0x0A] = True
_LETTER = np.isin(_CLASS, (0, 1, 5, 6))


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    words = hash_words(data, offsets)
    lines = hash_words(data, offsets, separator=_LINE_END)
    counts = text_counts(data, offsets, words)
    n_words, n_lines = counts["n_words"].astype(float), lines.counts.astype(float)
    per_word = lambda x: x / np.maximum(n_words, 1)
    owner = np.repeat(np.arange(n), words.counts)
    own = mix(np.arange(1, n + 1, dtype=np.uint64))
    _, first, times = np.unique(words.hashes ^ own[owner], return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, owner[first], times)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)[:, :len(CLASSES)]
    is_letter = np.concatenate(([0], np.cumsum(_LETTER[data])))
    letters = is_letter[words.starts + words.sizes] - is_letter[words.starts]
    return np.column_stack([
        np.log1p(n_words), per_word(counts["word_chars"]), per_word(counts["n_symbols"]), counts["n_dup_lines"] / np.maximum(n_lines, 1),
        per_word(counts["n_repeat_words"]), per_word(np.bincount(owner[first], minlength=n)), per_word(top),
        n_words / np.maximum(n_lines, 1), np.log1p(n_lines), *(kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)).T,
        per_word(np.bincount(owner[letters == 0], minlength=n)), per_word(np.bincount(owner[words.sizes > 20], minlength=n))])


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j])]
        coarse = [np.searchsorted(e, x[:, j]) for j, e in enumerate(self.pair_edges)]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _leaf(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient / (hessian + 1.0)


def _gain(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient**2 / (hessian + 1.0)


def _shallow_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree of up to three leaves over ordered bins."""
    values = np.zeros(len(gradient))
    parts = [(0, len(gradient))]
    for _ in range(2):
        options = []
        for a, b in parts:
            if b - a > 1:
                g, h = np.cumsum(gradient[a:b]), np.cumsum(hessian[a:b])
                gain = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
                k = int(gain.argmax())
                options.append((gain[k], a, b, a + k + 1))
        if not options:
            break
        _, a, b, cut = max(options)
        parts.remove((a, b))
        parts += [(a, cut), (cut, b)]
    for a, b in parts:
        values[a:b] = _leaf(gradient[a:b].sum(), hessian[a:b].sum())
    return values


def _best_cross(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, int, int]:
    """The cut on both axes that gains most: gain and how many bins lie below each cut."""
    corner = lambda t: np.cumsum(np.cumsum(t, 0), 1)
    g, h = corner(gradient), corner(hessian)
    gain = np.zeros((g.shape[0] - 1, g.shape[1] - 1))
    for top in (True, False):
        for left in (True, False):
            parts = []
            for t in (g, h):
                a, r, c, w = t[:-1, :-1], t[:-1, -1:], t[-1:, :-1], t[-1, -1]
                parts.append(a if top and left else r - a if top else c - a if left else w - r - c + a)
            gain += _gain(*parts)
    if not gain.size:
        return -1.0, 0, 0
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[i, j]), int(i) + 1, int(j) + 1


def _cross_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    values = np.zeros(gradient.shape)
    _, i, j = _best_cross(gradient, hessian)
    for rows in (slice(0, i), slice(i, None)):
        for columns in (slice(0, j), slice(j, None)):
            values[rows, columns] = _leaf(gradient[rows, columns].sum(), hessian[rows, columns].sum())
    return values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    model = Model()
    if not len(y):
        return model
    rate = np.clip(y.mean(), 0.01, 0.99)
    model.intercept = float(np.log(rate / (1 - rate)))
    model.edges = [_edges(c, BINS) for c in x.T]
    model.pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, c) for e, c in zip(model.edges, x.T)]
    total = np.full(len(y), model.intercept)

    def slopes(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(cells, y - p, size), np.bincount(cells, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j, cells in enumerate(bins):
            step = RATE * _shallow_tree(*slopes(cells, len(model.tables[j])))
            model.tables[j] += step
            total += step[cells]
    coarse = [np.searchsorted(e, c) for e, c in zip(model.pair_edges, x.T)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    cells_of = lambda i, j: coarse[i] * sizes[j] + coarse[j]
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            g, h = slopes(cells_of(i, j), sizes[i] * sizes[j])
            ranked.append((_best_cross(g.reshape(sizes[i], -1), h.reshape(sizes[i], -1))[0], i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(ranked, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            g, h = slopes(cells_of(i, j), table.size)
            step = RATE * _cross_tree(g.reshape(table.shape), h.reshape(table.shape))
            table += step
            total += step.ravel()[cells_of(i, j)]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled documents that are not held out."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    chosen = known.select("doc_id", F.col("quality").cast("double").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_train)
    # broadcast: max_train rows of two numbers
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, "text", SLICE_BYTES):
                rows = pa.array(list(features(batch.column("text"))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), rows], names=["doc_id", "quality", "x"])

    kind = f"doc_id {dict(texts.dtypes)['doc_id']}, quality double, x array<double>"
    rows = sorted(texts.mapInArrow(measure, kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).collect(), key=lambda r: (r.doc_id, r.quality, r.x))
    return fit(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r.quality for r in rows]))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, score and predicted, which replace columns of the same names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.drop("held_out", "score", "predicted")

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            for part in by_bytes(batch, "text", SLICE_BYTES):
                yield pa.array(shared.value.score(features(part.column(0))))

    scored = own.withColumn("score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("held_out", held_out(F.col("doc_id")))
