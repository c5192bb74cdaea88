"""Incremental runs: each new file once, each contract one current row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import contracts as ct
from ..sources import results as rt

Store = Callable[[DataFrame, str, str, int], object]

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(spark: SparkSession, folder: str, schema: T.StructType, to_results: Callable[[DataFrame], DataFrame],
                     table: str, checkpoint: str, pattern: str = "*.parquet", files_per_batch: int = 1000, store: Store = rt.append_batch) -> None:
    """Process Parquet files that are new since the checkpoint and add their rows to the result table, then stop.

    A batch repeated after a failure replaces its own rows.  The checkpoint knows the files already
    read, so a second run over the same folder adds nothing.  It also keeps the id of the stream, under which its batches are
    stored: another stream, or the same one with a new checkpoint, leaves them alone.  ``store`` takes rows, table, run and number
    of a batch; ``snapshots.merge`` is another one.
    """
    files = (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
             .option("maxFilesPerTrigger", files_per_batch).parquet(folder))
    _run(files, to_results, table, checkpoint, store)


def ingest_contract_files(spark: SparkSession, folder: str, to_results: Callable[[DataFrame], DataFrame], table: str, checkpoint: str,
                          pattern: str = "*.txt", files_per_batch: int = 1000, once_within: str | None = None, store: Store = rt.append_batch) -> None:
    """The same for contracts stored as text files: ``to_results`` gets what ``contracts.scan_files`` gives.

    ``once_within`` (such as ``"30 days"``): a file whose content came before, under any name and in any trigger, within so much time by
    the files' own times, is left out.  The state holds one digest per content of that time, in the checkpoint.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", pattern)
             .option("maxFilesPerTrigger", files_per_batch).load(folder))
    if once_within:
        seen = files.withColumn("digest", F.sha2("content", 256)).withWatermark("modificationTime", once_within)
        files = seen.dropDuplicatesWithinWatermark(["digest"]).drop("digest")
    _run(ct.as_contracts(files), to_results, table, checkpoint, store)


def _run(files: DataFrame, to_results: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, store: Store) -> None:
    def save(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store(to_results(batch), table, f"stream-{stream_id}", batch_id)

    query = (files.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
             .foreachBatch(save).start())
    query.awaitTermination()
