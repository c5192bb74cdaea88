"""Term weights of chunks and queries.

A document is its own index: document frequencies count the chunks of that document only.  Every
key starts with ``contract_id``, so chunks partitioned by it need no further shuffle.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import ship

SLICE_BYTES = 1_000_000  # of texts that are Python objects at a time, one document at least


def inverse_frequency(n_chunks: Column, frequency: Column) -> Column:
    return F.log((F.lit(1.0) + n_chunks) / (F.lit(1.0) + frequency)) + 1.0


def term_counts(chunks: DataFrame, terms: Column) -> DataFrame:
    """Occurrences of each term of ``terms`` in each chunk, with the chunks of the document holding it."""
    spread = chunks.select("contract_id", "n_chunks", "chunk_idx", F.explode_outer(terms).alias("term"))
    counted = (
        spread.where(F.col("term").isNotNull())
        .groupBy("contract_id", "n_chunks", "chunk_idx", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    in_document = Window.partitionBy("contract_id", "term")
    return counted.withColumn("df", F.count(F.lit(1)).over(in_document))


def gathered(chunks: DataFrame) -> DataFrame:
    """One row per document with its chunks, texts in lower case: where they are, if they are partitioned by ``contract_id``."""
    number = F.col("n_chunks").cast("long") if "n_chunks" in chunks.columns else F.lit(0).cast("long")
    parts = F.collect_list(F.struct(number.alias("n_chunks"), F.col("chunk_idx").cast("long").alias("chunk_idx"), F.lower("chunk_text").alias("low")))
    return chunks.groupBy("contract_id").agg(parts.alias("chunks"))


def counted(batches, size: int = SLICE_BYTES) -> Iterator[tuple]:
    """Counts of terms from the batches of ``gathered``, a bounded slice at a time.

    Gives the ids of the documents; document, n_chunks, chunk_idx of each chunk and the rows it came in; chunk, term and tf of each
    pair of a chunk and a term of it; and the terms.
    """
    find = re.compile(tx.TERM).findall
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            n_chunks, numbers, texts = part.column("chunks").flatten().flatten()
            document = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("chunks")).to_numpy(zero_copy_only=False))
            rows = np.stack([document, n_chunks.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False)])
            order = np.lexsort(rows[::-1])
            first = np.ones(len(order), bool)
            first[1:] = (np.diff(rows[:, order]) != 0).any(axis=0)
            keys, key_of = rows[:, order[first]], np.empty(len(order), np.int64)
            key_of[order] = np.cumsum(first) - 1
            own: dict[str, int] = defaultdict(itertools.count().__next__)
            places = [[own[word] for word in find(text or "")] for text in texts.to_pylist()]
            sizes = [len(p) for p in places]
            width = max(len(own), 1)
            pairs = np.repeat(key_of, sizes) * width + np.fromiter(itertools.chain.from_iterable(places), np.int64, sum(sizes))
            pairs, tf = np.unique(pairs, return_counts=True)
            chunk, term = np.divmod(pairs, width)
            yield part.column("contract_id"), keys, np.bincount(key_of, minlength=keys.shape[1]), chunk, term, tf, list(own)


def chunk_term_weights(chunks: DataFrame) -> DataFrame:
    """Sparse chunk vectors: one row per chunk and term, counted a document at a time, so that no term is sorted or shuffled."""
    types = dict(chunks.dtypes)
    kind = f"contract_id {types['contract_id']}, chunk_idx {types['chunk_idx']}, term string, tf long, df long, weight double"
    wide = chunks.schema["chunk_idx"].dataType.typeName() == "long"

    def weigh(batches):
        for documents, keys, _, chunk, term, tf, terms in counted(batches):
            document, n_chunks, number = keys[:, chunk]
            _, of, times = np.unique(document * max(len(terms), 1) + term, return_inverse=True, return_counts=True)
            df = times[of]
            weight = tf * (np.log((1.0 + n_chunks) / (1.0 + df)) + 1.0)
            yield pa.RecordBatch.from_arrays(
                [documents.take(pa.array(document)), pa.array(number, pa.int64() if wide else pa.int32()),
                 pa.array(terms, pa.string()).take(pa.array(term)), pa.array(tf, pa.int64()), pa.array(df, pa.int64()), pa.array(weight)],
                names=["contract_id", "chunk_idx", "term", "tf", "df", "weight"])

    ship(chunks.sparkSession)
    return gathered(chunks).mapInArrow(weigh, kind)
