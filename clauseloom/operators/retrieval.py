"""Top chunks per document and query, deduplicated and joined to one context per document.

Give these functions chunks partitioned by ``contract_id`` (``sources.contracts.by_contract`` or a
table bucketed by it): a document's chunks are then gathered, ranked, deduplicated and joined where they are, and only
the queries are sent to every executor, in blocks of bounded size.

All chunks of a document meet the queries in one call: its counts of terms meet the postings of the queries, the products with all
queries of a block are one sum by chunk and query, and only the best ``k`` of each query leave the task.  Arrays are bounded by
``CELLS`` numbers, however many chunks a document has.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx
from ..session import ship, written

BLOCK_QUERIES, BLOCK_TERMS = 200, 50_000  # of a broadcast block
CELLS = 2_000_000  # numbers in an array
SLICE_BYTES, SLICE_ROWS = 4_000_000, 100_000  # of texts that are Python objects at a time (one document at least), and of rows given out at once


def default_queries(spark: SparkSession) -> DataFrame:
    """The built-in queries, as literals: Spark knows their size, so whether they are broadcast is its own choice."""
    rows = [(group, text) for group, texts in fv.QUERIES.items() for text in texts]
    literals = [F.struct(F.lit(i).alias("query_idx"), F.lit(g).alias("query_group"), F.lit(t).alias("query_text")) for i, (g, t) in enumerate(rows)]
    return spark.range(1).select(F.inline(F.array(*literals)))


def _blocks(queries: DataFrame) -> list:
    """The queries as broadcast blocks of (query_idx, terms)."""
    ship(queries.sparkSession)
    rows = queries.select("query_idx", F.coalesce(tx.terms(F.col("query_text")), F.array().cast("array<string>")).alias("terms"))
    n, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_QUERIES), -(-n_terms // BLOCK_TERMS))
    context = queries.sparkSession.sparkContext
    parts = [rows.where(F.pmod(F.xxhash64("query_idx"), F.lit(blocks)) == k).collect() for k in range(blocks)]
    return [context.broadcast([(r.query_idx, r.terms) for r in part]) for part in parts if part]


def _ranker(shared, k: int):
    """What ranks the chunks of one document: a function of its texts to places, products and query lengths, and the query numbers."""
    asked = shared.value
    vocabulary: dict[str, int] = {}
    for _, terms in asked:
        for term in terms:
            vocabulary.setdefault(term, len(vocabulary))
    held_by = sorted((vocabulary[term], j, times) for j, (_, terms) in enumerate(asked) for term, times in Counter(terms).items())
    posted, query, count = np.array(held_by, np.int64).reshape(-1, 3).T
    start_of = np.searchsorted(posted, np.arange(len(vocabulary) + 1))
    n_held = np.diff(start_of)
    query_sq = np.bincount(query, (count * count).astype(float), minlength=len(asked))
    find = re.compile(tx.TERM).findall

    def postings(terms: np.ndarray):
        """The places in ``query`` and ``count`` of some terms of the vocabulary, and how many each has."""
        n = n_held[terms]
        return np.repeat(start_of[terms] - np.cumsum(n) + n, n) + np.arange(n.sum()), n

    def rank(texts: list[str], n_chunks: int):
        own: dict[str, int] = defaultdict(itertools.count().__next__)
        places = [[own[word] for word in find((text or "").lower())] for text in texts]
        sizes = [len(p) for p in places]
        pairs = np.repeat(np.arange(len(texts), dtype=np.int64), sizes) * max(len(own), 1) + np.fromiter(itertools.chain.from_iterable(places), np.int64, sum(sizes))
        pairs, tf = np.unique(pairs, return_counts=True)
        chunk, term = np.divmod(pairs, max(len(own), 1))
        idf = np.log((1.0 + n_chunks) / (1.0 + np.bincount(term, minlength=len(own)))) + 1.0
        unseen = np.log(1.0 + n_chunks) + 1.0
        length = np.sqrt(np.bincount(chunk, (tf * idf[term]) ** 2, minlength=len(texts)))
        asked_term = np.array([vocabulary.get(word, -1) for word in own], np.int64)
        held = np.flatnonzero(asked_term >= 0)
        entry, n = postings(asked_term[held])
        seen = np.bincount(query[entry], count[entry] ** 2 * np.repeat(idf[held] ** 2 - unseen**2, n), minlength=len(asked))
        query_length = np.sqrt(np.maximum(query_sq * unseen**2 + seen, 0.0))
        known = asked_term[term] >= 0
        row, place, value = chunk[known], asked_term[term[known]], (tf * idf[term] ** 2)[known]
        best, values, every = np.zeros((0, len(asked)), np.int64), np.zeros((0, len(asked))), np.arange(len(asked))
        step = max(k, min(CELLS // max(len(asked), 1), len(texts) * CELLS // max(int(n_held[place].sum()), 1)))
        for start in range(0, len(texts), step):
            stop = min(start + step, len(texts))
            a, b = np.searchsorted(row, (start, stop))
            entry, n = postings(place[a:b])
            cell = np.repeat((row[a:b] - start) * len(asked), n) + query[entry]
            products = np.bincount(cell, np.repeat(value[a:b], n) * count[entry], minlength=(stop - start) * len(asked)).astype(float).reshape(stop - start, len(asked))
            part = length[start:stop, None]
            products = np.divide(products, part, out=np.zeros_like(products), where=part > 0)
            if start:
                products = np.concatenate((values, products))
            # what came before has the smaller places, so a stable sort breaks ties by place
            order = np.argsort(-np.round(products, 9), axis=0, kind="stable")[:k]
            values = products[order, every]
            best = np.concatenate((best, np.repeat(np.arange(start, stop)[:, None], len(asked), axis=1)))[order, every] if start else order
        return best, np.divide(values, query_length, out=np.zeros_like(values), where=query_length > 0)

    return rank, [q for q, _ in asked]


def gathered(chunks: DataFrame) -> DataFrame:
    """One stored row per document with its chunks, for ``rank_chunks`` and ``spread`` in place of the chunks: what is read more than once is cut once."""
    return written(_documents(chunks), "chunked")


def spread(documents: DataFrame) -> DataFrame:
    """The chunks of gathered documents: contract_id, n_chunks, chunk_idx, chunk_text."""
    return documents.select("contract_id", "n_chunks", F.inline("chunks"))


def _documents(chunks: DataFrame) -> DataFrame:
    """One row per document with its chunks in order; gathered ones are given back."""
    if "chunks" in chunks.columns:
        return chunks
    ordered = F.sort_array(F.collect_list(F.struct("chunk_idx", "chunk_text")))
    return chunks.groupBy("contract_id").agg(F.max("n_chunks").alias("n_chunks"), ordered.alias("chunks"))


def _parts(batches, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _chunks_of(part: pa.RecordBatch) -> list[tuple]:
    numbers, texts = part.column("chunks").flatten().flatten()
    numbers, texts = numbers.to_numpy(zero_copy_only=False), texts.to_pylist()
    ends = np.cumsum(pc.list_value_length(part.column("chunks")).to_numpy(zero_copy_only=False)).tolist()
    spans = zip(part.column("n_chunks").to_pylist(), [0, *ends], ends)
    return [(n_chunks, numbers[a:b], texts[a:b]) for n_chunks, a, b in spans]


def _slices(batches, size: int = SLICE_BYTES) -> Iterator[tuple]:
    """Documents a bounded slice of a batch at a time: their ids, and (chunks of the document, chunk numbers, chunk texts) of each."""
    for part in _parts(batches, size):
        yield part.column("contract_id"), _chunks_of(part)


def _close_enough(similarity: np.ndarray, k: int, closeness: float) -> np.ndarray:
    """Which places of the columns of ``similarity`` are kept: the first ``k``, and further ones up to the first clear step down."""
    kept = np.ones(similarity.shape, bool)
    if len(similarity) > k:
        values = np.round(similarity[k - 1:], 9)
        kept[k:] = np.logical_and.accumulate((values[1:] >= (1 - closeness) * values[:-1]) & (values[1:] > 0), axis=0)
    return kept


def rank_adaptively(chunks: DataFrame, queries: DataFrame, k: int, most: int, closeness: float, relevant: DataFrame | None = None) -> DataFrame:
    """``rank_chunks`` with a ``k`` that grows, for each document and query by itself, up to ``most``.

    Further chunks are taken as long as each has at least 1 - ``closeness`` times the similarity of the one before it: where the
    scores fall off behind the ``k``-th, ``k`` chunks are enough, and where they hardly differ, the cut would be arbitrary.  All
    of it is decided in the pass that ranks the chunks.
    """
    if not 1 <= k <= most or not 0 <= closeness < 1:
        raise ValueError("1 <= k <= most and 0 <= closeness < 1 are required")
    return rank_chunks(chunks, queries, most, lambda similarity: _close_enough(similarity, k, closeness), relevant)


def rank_chunks(chunks: DataFrame, queries: DataFrame, k: int = fv.TOP_K, keep: Callable[[np.ndarray], np.ndarray] | None = None,
                relevant: DataFrame | None = None) -> DataFrame:
    """The ``k`` best chunks of each document for each query, or all of them when there are fewer.

    ``similarity`` is the cosine.  Within one document and query its order is that of ``product``, the
    cosine times the length of the query, rounded to nine digits, then that of the chunks.  ``keep`` says which of them stay,
    from the similarities of a document by rank and query.

    With ``relevant``, rows of (contract_id, query_idx, chunk_idx), each row also tells in ``judged`` whether it is one of them or may not
    be the only one of its document, query and chunk number.  These rows come to the documents, which stay where they are.

    ``chunks`` may also be documents of ``gathered``.
    """
    documents, found, marked, stored = _documents(chunks), None, relevant is not None, "chunks" in chunks.columns
    if marked:
        pairs = relevant.groupBy("contract_id").agg(F.collect_set(F.struct("query_idx", "chunk_idx")).alias("pairs"))
        documents = documents.join(pairs if stored else pairs.hint("shuffle_hash"), "contract_id", "left")
    types = {**dict((spread(chunks) if stored else chunks).dtypes), **dict(queries.dtypes)}
    kind = f"contract_id {types['contract_id']}, query_idx {types['query_idx']}, chunk_idx {types['chunk_idx']}, rank int, similarity double"
    kind += ", judged boolean" if marked else ""
    for shared in _blocks(queries):

        def ranked(batches, shared=shared):
            rank, names = _ranker(shared, k)
            for part in _parts(batches):
                columns, n = [], 0
                pairs_of = part.column("pairs").to_pylist() if marked else itertools.repeat(None)
                for document, (n_chunks, numbers, texts), pairs in zip(part.column("contract_id").to_pylist(), _chunks_of(part), pairs_of):
                    best, similarity = rank(texts, n_chunks)
                    place, asked = np.nonzero(np.ones(best.shape, bool) if keep is None else keep(similarity))
                    row = [document, asked, numbers[best[place, asked]], place + 1, similarity[place, asked]]
                    if marked:
                        row.append(_judged(names, numbers, pairs)(asked, row[2]))
                    columns.append(row)
                    n += len(place)
                    if n >= SLICE_ROWS:
                        yield _ranked_batch(columns, names, kind)
                        columns, n = [], 0
                yield _ranked_batch(columns, names, kind)

        part = documents.mapInArrow(ranked, kind)
        found = part if found is None else found.unionByName(part)
    return documents.sparkSession.createDataFrame([], kind) if found is None else found


def _judged(names: list, numbers: np.ndarray, pairs: list | None) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Of the places of queries and the chunk numbers of a document's rows, which are among ``pairs`` or can occur twice."""
    queries, chunks = Counter(names), dict(zip(*(x.tolist() for x in np.unique(numbers, return_counts=True))))
    twice = np.array([queries[q] > 1 for q in names], bool)
    repeated = [c for c, n in chunks.items() if n > 1]
    chunks_of = defaultdict(list)
    for pair in pairs or ():
        chunks_of[pair["query_idx"]].append(pair["chunk_idx"])

    def judged(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
        found = twice[asked] | np.isin(held, repeated)
        for place in [i for i, q in enumerate(names) if q in chunks_of] if chunks_of else ():
            found |= (asked == place) & np.isin(held, chunks_of[names[place]])
        return found

    return judged


def _ranked_batch(columns: list, names: list, kind: str) -> pa.RecordBatch:
    sizes = [len(c[1]) for c in columns]
    joined = lambda k: np.concatenate([c[k] for c in columns]) if columns else np.zeros(0)
    values = [pa.array([c[0] for c in columns]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))) if columns else pa.array([], pa.string()),
              pa.array(names).take(pa.array(joined(1).astype(np.int64))), pa.array(joined(2)), pa.array(joined(3)), pa.array(joined(4)), *([pa.array(joined(5).astype(bool))] if "judged" in kind else [])]
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split(" ") for f in kind.split(", ")]
    return pa.RecordBatch.from_arrays([v.cast(arrow[t]) for v, (_, t) in zip(values, fields)], names=[n for n, _ in fields])


def _picked(chunks: DataFrame, shared, k: int) -> DataFrame:
    """contract_id and the retrieved texts of each document, each once, in the order of their first hits."""
    key = dict(chunks.dtypes)["contract_id"]

    def pick(batches):
        rank, names = _ranker(shared, k)
        firsts = np.array(names)[None, :] * k
        for documents, parts in _slices(batches):
            ends, seen, picked = [0], [], []
            for n_chunks, _, texts in parts:
                best, _ = rank(texts, n_chunks)
                numbers = firsts + np.arange(len(best))[:, None]
                earliest = np.full(len(texts), np.iinfo(np.int64).max)
                np.minimum.at(earliest, best.ravel(), numbers.ravel())
                first: dict[str, int] = {}
                for place in np.unique(best).tolist():
                    number = int(earliest[place])
                    first[texts[place]] = min(number, first.get(texts[place], number))
                for text, number in sorted(first.items(), key=lambda x: x[1]):
                    seen.append(number)
                    picked.append(text)
                ends.append(len(seen))
            rows = pa.StructArray.from_arrays([pa.array(seen, pa.int32()), pa.array(picked, pa.string())], names=["seen", "chunk_text"])
            yield pa.RecordBatch.from_arrays([documents, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], names=["contract_id", "picked"])

    return _documents(chunks).mapInArrow(pick, f"contract_id {key}, picked array<struct<seen:int,chunk_text:string>>")


def retrieved(chunks: DataFrame, queries: DataFrame, k: int = fv.TOP_K) -> DataFrame:
    """``first_seen`` of ``rank_chunks``: where the queries are one block, in the pass that ranks the chunks."""
    blocks = _blocks(queries)
    if len(blocks) != 1:
        return first_seen(rank_chunks(chunks, queries, k), chunks, k)
    texts = _picked(chunks, blocks[0], k).select("contract_id", F.explode("picked").alias("text"))
    seen = F.col("text.seen")
    return texts.select("contract_id", seen.alias("seen"), F.floor(seen / k).cast("int").alias("query_idx"), (seen % k + 1).cast("int").alias("rank"),
                        F.col("text.chunk_text").alias("chunk_text"))


def first_seen(ranked: DataFrame, chunks: DataFrame, k: int = fv.TOP_K) -> DataFrame:
    """Retrieved chunk texts of each document, each once, numbered by query and rank of its first hit.

    The positions of a document (at most queries x k) travel as one map, so the texts are looked up by
    ``contract_id`` alone and stay in the partitions they are in.
    """
    seen = (
        ranked.withColumn("seen", F.col("query_idx") * F.lit(k) + F.col("rank") - 1)
        .groupBy("contract_id", "chunk_idx").agg(F.min("seen").alias("seen"))
        .groupBy("contract_id").agg(F.map_from_entries(F.collect_list(F.struct("chunk_idx", "seen"))).alias("picked"))
    )
    texts = chunks.select("contract_id", "chunk_idx", "chunk_text").join(seen.hint("merge"), "contract_id")
    found = texts.select("contract_id", "chunk_text", F.try_element_at("picked", F.col("chunk_idx")).alias("seen"))
    by_text = found.where(F.col("seen").isNotNull()).groupBy("contract_id", "chunk_text").agg(F.min("seen").alias("seen"))
    return by_text.select("contract_id", "seen", F.floor(F.col("seen") / k).cast("int").alias("query_idx"),
                          (F.col("seen") % k + 1).cast("int").alias("rank"), "chunk_text")


def contexts(seen: DataFrame, separator: str = fv.CONTEXT_SEPARATOR) -> DataFrame:
    """One context per document: at most queries x k chunks, in first-seen order."""
    ordered = F.array_sort(F.collect_list(F.struct("seen", "chunk_text")))
    return seen.groupBy("contract_id").agg(
        F.array_join(F.transform(ordered, lambda c: c["chunk_text"]), separator).alias("context"),
        F.count(F.lit(1)).alias("n_chunks"))


def retrieve(chunks: DataFrame, queries: DataFrame, k: int = fv.TOP_K, separator: str = fv.CONTEXT_SEPARATOR) -> DataFrame:
    """``contexts`` of the retrieved texts; with one block of queries each document's context is joined in its own row."""
    blocks = _blocks(queries)
    if len(blocks) != 1:
        return contexts(first_seen(rank_chunks(chunks, queries, k), chunks, k), separator)
    rows = _picked(chunks, blocks[0], k)
    return rows.select("contract_id", F.array_join(F.transform("picked", lambda c: c["chunk_text"]), separator).alias("context"), F.size("picked").cast("long").alias("n_chunks"))


def isolation_check(seen: DataFrame, chunks: DataFrame) -> DataFrame:
    """Retrieved chunks, and those among them that are not a chunk of the same document (always 0)."""
    own = chunks.select("contract_id", "chunk_text").distinct().withColumn("own", F.lit(True))
    return seen.join(own, ["contract_id", "chunk_text"], "left").agg(
        F.count(F.lit(1)).alias("n_retrieved"), F.count_if(F.col("own").isNull()).alias("n_foreign"))


def query_group_hits(ranked: DataFrame, queries: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per query group: relevant (contract, query) pairs, and those with a relevant chunk in the ranking.

    ``relevant`` lists (contract_id, query_idx, chunk_idx).
    """
    hit = (
        relevant.join(ranked.select("contract_id", "query_idx", "chunk_idx", "rank"),
                      ["contract_id", "query_idx", "chunk_idx"], "left")
        .groupBy("contract_id", "query_idx").agg(F.min("rank").alias("best_rank"))
    )
    grouped = hit.join(queries.select("query_idx", "query_group"), "query_idx")
    return grouped.groupBy("query_group").agg(
        F.count(F.lit(1)).alias("n_relevant"), F.count("best_rank").alias("n_found"),
        F.round(F.count("best_rank") / F.count(F.lit(1)), 6).alias("recall"),
        F.coalesce(F.max("best_rank"), F.lit(0)).alias("needed_k"))


def adaptive_gain(wide: DataFrame, adaptive: DataFrame, queries: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Per query group, what a fixed ``k``, the growing one and ``wide`` (the most it grows to) take and find.

    ``n_*`` counts chunks, ``found_*`` the (contract, query) pairs with a relevant chunk among them; ``relevant`` lists
    (contract_id, query_idx, chunk_idx).  Where both rankings were made with ``relevant``, only the rows that they mark as judged
    meet each other and the relevant ones; each of the others is one of its kind, found by no one, and counted where it is.  Both
    rankings are then made once: what is counted and the judged rows are written.
    """
    keys = ["contract_id", "query_idx", "chunk_idx"]
    marked = "judged" in wide.columns and "judged" in adaptive.columns
    fixed, kept, right = F.col("rank") <= k, F.col("kept").isNotNull(), F.col("right").isNotNull()
    if marked:
        counted = [_counted_once(ranked, fixed) for ranked in (wide, adaptive)]
        wide, adaptive = (rows.where("judged").select(*keys, "rank", F.explode(F.sequence(F.lit(1), F.col("n")))) for rows in counted)
    taken = wide.select(*keys, "rank").join(adaptive.select(*keys, F.lit(True).alias("kept")), keys, "left")
    judged = taken.join(relevant.select(*keys, F.lit(True).alias("right")), keys, "left")
    counts = judged.groupBy("contract_id", "query_idx").agg(
        F.count_if(fixed).alias("n_fixed"), F.count_if(kept).alias("n_adaptive"), F.count(F.lit(1)).alias("n_most"),
        F.max((fixed & right).cast("long")).alias("found_fixed"), F.max((kept & right).cast("long")).alias("found_adaptive"),
        F.max(right.cast("long")).alias("found_most")).drop("contract_id")
    if marked:
        none = F.lit(0).cast("long")
        by_wide, by_adaptive = (rows.where("not judged") for rows in counted)
        for part in (by_wide.select("query_idx", "n_fixed", F.col("n").alias("n_most")), by_adaptive.select("query_idx", F.col("n_met").alias("n_adaptive"))):
            counts = counts.unionByName(part.select("query_idx", *[F.col(c) if c in part.columns else none.alias(c) for c in counts.columns[1:]]))
    sums = [F.sum(f"{what}_{which}").alias(f"{what}_{which}") for what in ("n", "found") for which in ("fixed", "adaptive", "most")]
    return counts.join(queries.select("query_idx", "query_group"), "query_idx").groupBy("query_group").agg(*sums)


def _counted_once(ranked: DataFrame, fixed: Column) -> DataFrame:
    """The judged rows of a ranking, equal ones as one with their number ``n``, and one row per query for all others, written in one pass."""
    own = [F.when(F.col("judged"), F.col(c)).alias(c) for c in ("contract_id", "chunk_idx", "rank")]
    met = F.col("contract_id").isNotNull() & F.col("query_idx").isNotNull()  # as in the join
    return written(ranked.select("query_idx", "judged", *own, met.alias("met"), fixed.alias("fixed")).groupBy("query_idx", "judged", "contract_id", "chunk_idx", "rank").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("fixed").alias("n_fixed"), F.count_if("met").alias("n_met")), "gains")
