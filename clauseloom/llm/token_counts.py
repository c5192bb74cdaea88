"""Token counts: a broadcast table of frequent pieces first, worker caches around the library second.

``frequent_pieces`` finds what is frequent: each task sums up its rows in a bounded table and gives its most frequent
pieces; only these summaries are added up.  The table is a cache: it changes the speed and never a count.
``count_tokens`` looks every piece of a text up in the broadcast table and encodes the rest through a worker's cache, so
no piece is ever shuffled.

Null or empty text: 0 bytes, 0 tokens.  Repeated rows are counted each; other columns pass through unless their names
clash with the results, which then replace them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import BLANKS, PieceEncoder, pieces_of, slices
from .words import hash_words, text_bytes

TABLE_SIZE = 16_384  # pieces in the broadcast table, each of at most PIECE_CHARS characters: under 2 MB
PIECE_CHARS = 32
TASK_SIZE = 2_048  # pieces that a task reports
TASK_TABLE = 400_000  # pieces a task holds before it forgets those met once


def _task_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(pieces_of(text))
            while len(counts) > TASK_TABLE:
                least = sorted(counts.values())[len(counts) // 2]
                counts = Counter({p: n - least for p, n in counts.items() if n > least})
    top = sorted(((n, p) for p, n in counts.items() if 0 < len(p) <= PIECE_CHARS), reverse=True)[:TASK_SIZE]
    yield pa.RecordBatch.from_pydict({"piece": pa.array([p for _, p in top], pa.string()),
                                      "n": pa.array([n for n, _ in top], pa.int64())})


def frequent_pieces(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """At most ``size`` short pieces that are frequent in the whole table."""
    summaries = docs.select("text").mapInArrow(_task_summary, "piece string, n long")
    rows = summaries.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size).collect()
    return [r.piece for r in rows]


def frequent_lengths(pieces: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the pieces, and how many ids each has."""
    data, offsets = text_bytes(pa.array([" ".join(pieces)], pa.large_string()))
    words = hash_words(data, offsets, separator=BLANKS)
    hashes, at = np.unique(words.hashes, return_index=True)
    return hashes, PieceEncoder(path).lengths_of(hashes, data, words, at).astype(np.int16)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, table_size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit of the whole text."""
    # a compact table: sorted hashes of the frequent pieces and their lengths, 10 bytes each
    frequent = frequent_pieces(docs, table_size)
    hashes, lengths = frequent_lengths(frequent, path)
    table = docs.sparkSession.sparkContext.broadcast((hashes, lengths))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys, known = table.value
        encoder = PieceEncoder.of_worker(path)
        for column in batches:
            out = [np.zeros(0, np.int64)]
            for group in slices(column):
                data, offsets = text_bytes(pa.array(group, pa.large_string()))
                words = hash_words(data, offsets, separator=BLANKS)
                pieces, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
                place = np.minimum(np.searchsorted(keys, pieces), max(len(keys) - 1, 0))
                first = keys[place] == pieces if len(keys) else np.zeros(len(pieces), bool)
                counts = np.zeros(len(pieces), np.int64)
                counts[first] = known[place[first]]
                counts[~first] = encoder.lengths_of(pieces[~first], data, words, at[~first])
                out.append(np.diff(np.concatenate(([0], np.cumsum(counts[back])))[words.bounds]))
            yield pd.Series(np.concatenate(out))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.withColumn("n_tokens", n_tokens(text)).withColumn("n_bytes", F.octet_length(text).cast("long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
