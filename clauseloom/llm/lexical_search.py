"""Ranked lexical search: term at a time over the documents' postings, with a limit on new accumulators.

**Postings.** One pass over the texts keeps, for each document, its number of terms and the counts of those that occur in a query.  The
corpus figures (documents, terms, document frequencies) are sums over this table, and cover all documents.
**Accumulators.** Each task takes its postings in slices of documents, inverted by term.  A query's terms are taken rarest first.  A
document gets an accumulator with the first term that it holds, as long as the terms left could still lift a new one to the k-th
partial score: their bounds are the highest impacts in the slice.  Once they cannot, no accumulator is created, and the terms left update
the survivors exactly.  The k-th score of earlier slices of the task counts as well.  A task returns k documents a query, and the
best k of all tasks are the result, which is that of scoring every document.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased; they are known by 64-bit
hashes.  The queries are a stated set, broadcast in blocks of at most ``BLOCK_CHARS`` characters, each of which meets all documents.

Null and empty texts have no terms: such a document is not counted and never found, such a query finds nothing.  Every row is a document or a
query of its own, also where ids repeat or are null; equal scores are in ascending order of doc_id, null first, and copies of one id
have a rank each.  Other columns are ignored.  No documents, no terms or no queries give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.session import written

from .words import Known, by_bytes, hash_words, text_bytes

TOP = 20
BLOCK_CHARS = 4_000_000
POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "query int, item_id long, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).min

_BETWEEN = np.ones(256, bool)
_BETWEEN[0x80:] = False
for _first, _last in ("09", "az", "AZ"):
    _BETWEEN[ord(_first):ord(_last) + 1] = False


def terms_of(column: pa.Array):
    return hash_words(*text_bytes(column), fold=True, separator=_BETWEEN)


def postings(docs: DataFrame, known) -> DataFrame:
    """doc_id, n (all terms of the text), and which terms of the broadcast dictionary it holds how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(known.value.hashes), 1)
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                words = terms_of(batch.column("text"))
                at, which = known.value.find(words.hashes)
                owner = np.searchsorted(words.bounds, at, "right") - 1
                pairs, times = np.unique(owner * size + which, return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(len(batch) + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (pairs % size, times)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts, pa.int64()), *lists],
                                                 names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, POSTINGS)


@dataclass
class Queries:
    """A bounded block of queries: for each its terms, rarest first, and their weights times their occurrences."""

    ids: list[int | None]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    n_docs: int
    n_terms: int


def weigh(ids: list, words, known: Known, frequency: dict[int, int], n_docs: int, n_terms: int) -> Queries:
    terms, weights = [], []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        own, times = np.unique(np.searchsorted(known.hashes, words.hashes[a:b]), return_counts=True)
        held = [(frequency[t], t, q) for t, q in zip(own.tolist(), times.tolist()) if t in frequency]
        held.sort()
        terms.append(np.array([t for _, t, _ in held], np.int64))
        weights.append(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * q for df, _, q in held], np.int64))
    return Queries(ids, terms, weights, n_docs, n_terms)


class Slice:
    """Postings of some documents, by term: places of the documents and impacts."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries, n_terms: int):
        n, lists, counts = batch.column("n").to_numpy(), batch.column("terms"), batch.column("counts")
        self.ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
        own, tf = lists.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
        m = 75 + (25 * n * queries.n_docs) // queries.n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[owner])
        order = np.argsort(own, kind="stable")
        self.docs, self.impacts = owner[order], impact[order]
        self.bounds = np.searchsorted(own[order], np.arange(n_terms + 1))
        self.highest = np.zeros(n_terms, np.int64)
        held = np.flatnonzero(np.diff(self.bounds))
        if len(held):
            self.highest[held] = np.maximum.reduceat(self.impacts, self.bounds[held])
        self.scores = np.zeros(len(batch), np.int64)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.bounds[term], self.bounds[term + 1]
        return self.docs[a:b], self.impacts[a:b]

    def search(self, terms: np.ndarray, weights: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores, among them all of the best ``top`` with a score of ``floor`` or more."""
        left = np.cumsum((weights * self.highest[terms])[::-1])[::-1]  # what the terms from here on can add
        survivors, at, reached = np.zeros(0, np.int64), 0, floor
        while at < len(terms) and left[at] > 0 and left[at] >= reached:
            docs, impacts = self.of(terms[at])
            if len(docs):
                self.scores[docs] += weights[at] * impacts
                survivors = np.union1d(survivors, docs)
                if len(survivors) >= top:
                    reached = max(floor, int(np.partition(self.scores[survivors], len(survivors) - top)[len(survivors) - top]))
            at += 1
        for term, weight in zip(terms[at:], weights[at:]):
            docs, impacts = self.of(term)
            if len(docs) and len(survivors):
                place = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
                held = docs[place] == survivors
                self.scores[survivors[held]] += weight * impacts[place[held]]
        found = self.scores[survivors]
        self.scores[survivors] = 0
        good = (found > 0) & (found >= floor)
        return self.ids[survivors[good]], found[good]


def best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents (doc_id, text) for each item (item_id, text)."""
    spark = docs.sparkSession
    items = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = int(chars / block_chars) + 1
    result = None
    for k in range(blocks if chars else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        words = terms_of(pa.array([r.text for r in rows], pa.string()))
        known = Known(np.unique(words.hashes))
        stored = written(postings(docs, spark.sparkContext.broadcast(known)), "postings")
        n_docs, n_terms = stored.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_terms:
            break
        # at most the terms of one block
        held = stored.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()
        queries = weigh([r.item_id for r in rows], words, known, {r.term: r.n for r in held}, n_docs, n_terms)
        found = _searched(stored, spark.sparkContext.broadcast((queries, len(known.hashes))), top)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        rows = ranked.select("item_id", "rank", "doc_id", "score")
        result = rows if result is None else result.unionByName(rows)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if result is None else result


def _searched(stored: DataFrame, shared, top: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, n_terms = shared.value
        none = np.zeros(0, np.int64)
        kept = [(none, none)] * len(queries.ids)
        for batch in batches:
            if not len(batch):
                continue
            part = Slice(batch, queries, n_terms)
            for i, (terms, weights) in enumerate(zip(queries.terms, queries.weights)):
                ids, scores = kept[i]
                more_ids, more = part.search(terms, weights, top, int(scores[-1]) if len(scores) >= top else 0)
                if len(more):
                    kept[i] = best(np.concatenate((ids, more_ids)), np.concatenate((scores, more)), top)
        sizes = [len(scores) for _, scores in kept]
        ids, scores = (np.concatenate([x[k] for x in kept]) if kept else none for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(kept), dtype=np.int32), sizes)), pa.array([i for i, n in zip(queries.ids, sizes) for _ in range(n)], pa.int64()),
             pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], names=["query", "item_id", "doc_id", "score"])

    return stored.mapInArrow(scan, FOUND)
