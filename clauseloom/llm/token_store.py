"""Token ids in ORC files: ascending document order, run-length encoded integers, row indexes, Bloom filters on doc_id.

``write_tokens`` range-partitions the documents by doc_id, sorts each part, encodes it and writes one ORC file (or more)
per part.  Each row carries the number of ids before it in its part, which the encoding task counts as it goes, so
reading needs no window over all rows.  Stripes are read in parallel, and a filter on doc_id is answered from the stripe
and row-group statistics and the Bloom filters.

``read_tokens`` adds the global start of every document: the sizes of the parts, one row each, are summed in order and
joined back.

Null or empty text: only the end id.  Rows that repeat a doc_id are all kept, next to each other.  Null ids
come first.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoding import PieceEncoder, slices

STORED = "doc_id long, part int, start_in_part long, ids array<int>"
STRIPE_BYTES = 16 << 20


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, parts: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids to ORC files under ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of_worker(tokenizer_path)
        before = 0
        for batch in batches:
            ids, texts, number = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            done = 0
            for group in slices(texts):
                flat, counts = encoder.encode(group)
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, end_id)
                offsets = np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(done, len(group)), number.slice(done, len(group)), pa.array(before + offsets[:-1], pa.int64()), lists],
                    names=["doc_id", "part", "start_in_part", "ids"])
                before += int(offsets[-1])
                done += len(group)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]  # the second deals out rows that repeat one id
    ordered = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    ordered = ordered.sortWithinPartitions(*keys, "text").withColumn("part", F.spark_partition_id())
    (ordered.mapInArrow(encode, STORED).write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", "2000").option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.dictionary.key.threshold", "0").option("compression", "snappy").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every stored document; start counts the ids of all documents before it."""
    stored = spark.read.schema(STORED).orc(path)
    rows = stored.select("doc_id", "part", "start_in_part", F.size("ids").cast("long").alias("n_tokens"), "ids")
    sizes = stored.groupBy("part").agg(F.max(F.col("start_in_part") + F.size("ids")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    # one row per part of the writing job: the number of its tasks bounds what is broadcast
    return rows.join(F.broadcast(starts), "part").select("doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """crc32 of the ids of each row as little-endian unsigned 32-bit integers."""
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])
