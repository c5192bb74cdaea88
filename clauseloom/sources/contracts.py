"""Contract sources: whole files, page rows, tables; admission and listing."""

from __future__ import annotations

import os
from collections.abc import Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx
from ..session import local_path, written

PAGE_BLOCK = 256
FOLDER_FILES = 1_000  # that a task puts in one folder
TASK_SPLITS, TASK_BYTES = 32, 128 << 20  # splits of small files that one task reads, while they hold no more than this


def scan_files(spark: SparkSession, folder: str | Sequence[str], pattern: str = "*.txt") -> DataFrame:
    """One row per file directly in ``folder`` (or in one of several): id from the file name, whole content as text.

    Bytes that are not UTF-8 become replacement characters.  A missing folder is an error.
    """
    return as_contracts(_few_tasks(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)))


def _few_tasks(files: DataFrame) -> DataFrame:
    """``files`` with up to ``TASK_SPLITS`` splits a task.

    Spark counts a file as at least four megabytes, so a split holds some 32 small files, and a task of them takes longer to begin than to read.
    """
    plan = files._jdf.queryExecution()
    splits, size = plan.toRdd().getNumPartitions(), int(plan.optimizedPlan().stats().sizeInBytes())
    tasks = max(-(-splits // TASK_SPLITS), -(-size // TASK_BYTES), 4 * files.sparkSession.sparkContext.defaultParallelism)
    return files.coalesce(tasks) if tasks < splits else files


def write_files(texts: DataFrame, folder: str) -> list[str]:
    """Write the column ``text`` as one text file per row, ended by a line break; gives the folders that hold the files.

    Where ``folder`` is on a disk or a mount, tasks write the files themselves: without its native library, Hadoop starts a process for each file
    that it creates there, and another for its checksum.  A task writes to folders of its own attempt, and only those of attempts that
    came to their end are given, so repeated tasks leave no file twice.
    """
    spark, rows = texts.sparkSession, texts.select("text")
    # tasks put their files in place themselves; the folder is new and nobody reads it before the write is over
    one_each = rows.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    path = local_path(spark, folder)
    if path is None:
        one_each.text(folder)
        return [folder]
    os.makedirs(path)

    def put(batches):
        task, n, block = TaskContext.get(), 0, ""
        for batch in batches:
            for text in batch.column(0):
                if n % FOLDER_FILES == 0:
                    block = f"{task.partitionId()}-{task.taskAttemptId()}-{n // FOLDER_FILES}"
                    os.makedirs(f"{path}/{block}")
                    yield pa.RecordBatch.from_arrays([pa.array([block])], names=["block"])
                with open(f"{path}/{block}/{task.partitionId()}-{n}.txt", "wb") as file:
                    if text.is_valid:
                        file.write(text.as_buffer())
                    file.write(b"\n")
                n += 1

    done = rows.select(F.col("text").cast("binary")).mapInArrow(put, "block string").collect()  # a row per FOLDER_FILES files
    return [f"{folder}/{row.block}" for row in done] or [folder]


def as_contracts(files: DataFrame) -> DataFrame:
    """Contracts of binary files, read at once or as a stream."""
    return files.select(tx.file_stem(F.col("path")).alias("contract_id"), F.col("path").alias("file_path"),
                        F.lit(fv.FILE_SOURCE).alias("source"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def positioned(table: DataFrame, order: Sequence[str], position: str = "position") -> DataFrame:
    """``table`` with the place (from 0, without gaps) of each row by the columns ``order``, nulls first.

    Rows are sorted in ranges and stored; a row's place is that in its range plus the rows of the ranges before, of which
    one number each reaches the driver.  Rows that are equal in ``order`` are told apart by a hash of the whole row, so many of them
    spread over ranges as well; rows that are equal in everything stand in any order.
    """
    numbered, row_hash = _unused(table, "row_id"), _unused(table, "row_hash")
    keys = [*(F.col(c).asc_nulls_first() for c in order), F.col(row_hash)]
    ranged = table.withColumn(row_hash, F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])).repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = written(ranged.drop(row_hash).withColumn(numbered, F.monotonically_increasing_id()), "positions")
    part = _unused(stored, "part")
    parts = stored.groupBy(F.shiftright(numbered, 33).alias(part)).agg(F.count(F.lit(1)).alias("rows")).orderBy(part).collect()
    starts, total = [], 0
    for row in parts:
        starts.append((row[part], total))
        total += row["rows"]
    before = _unused(stored, "rows_before")
    offsets = table.sparkSession.createDataFrame(starts, f"{part} long, {before} long")
    placed = stored.withColumn(part, F.shiftright(numbered, 33)).join(F.broadcast(offsets), part)  # a row per range
    within = F.col(numbered).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*[F.col(f"`{c}`") for c in table.columns if c != position], (F.col(before) + within).alias(position))


def _unused(table: DataFrame, name: str) -> str:
    while name in table.columns:
        name += "_"
    return name


def load_corpus(spark: SparkSession, folder: str, limit: int | None = None, position: str = "position",
                text: str = "text", order: Sequence[str] | None = None) -> DataFrame:
    """Contracts of a folder: its Parquet dataset when it holds one, its text files otherwise.

    The cap counts dataset positions, or file names in order.  A dataset without positions is given them by ``order``.
    """
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path")
    if not stored.isEmpty():
        table = spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)
        return dataset_scan(positioned(table, order, position) if order else table, position, text, limit)
    files = scan_files(spark, folder)
    if limit is None:
        return files
    # the paths alone are ordered in one task
    first = list_files(spark, folder, "*.txt").orderBy("path").limit(limit)
    return files.join(first, F.col("file_path") == F.col("path"), "left_semi")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths of the text and page files directly in ``folder``, without reading their content."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return read.select(F.col("path"))


def corpus_listing(paths: DataFrame, limit: int | None = None) -> DataFrame:
    """All ``.txt`` paths in order, then all ``.pdf`` paths in order; the cap counts along that order."""
    suffix = F.regexp_extract("path", r"\.([^./]+)$", 1)
    rank = F.when(suffix == "txt", 0).when(suffix == "pdf", 1)
    listed = paths.select(tx.file_stem(F.col("path")).alias("contract_id"), "path", rank.alias("ext_rank"))
    ordered = listed.where(F.col("ext_rank").isNotNull()).orderBy("ext_rank", "path")
    return ordered.limit(limit) if limit else ordered


def assemble_pages(pages: DataFrame, key: str, page_no: str, page_text: str) -> DataFrame:
    """Pages of each document joined by line breaks, in page order; a missing page is an empty one.

    Pages are joined in blocks first and the blocks then, so that a document with very many pages
    is spread over many tasks until only its finished blocks are left.
    """
    def joined(number: str, text: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(number, text)))
        return F.array_join(F.transform(ordered, lambda p: p[text]), "\n")

    rows = pages.select(F.col(key).alias("contract_id"), F.col(page_no).alias("page_no"),
                        F.coalesce(F.col(page_text), F.lit("")).alias("page_text"))
    blocks = (
        rows.withColumn("block", F.floor(F.col("page_no") / PAGE_BLOCK))
        .groupBy("contract_id", "block")
        .agg(joined("page_no", "page_text").alias("block_text"), F.count(F.lit(1)).alias("n_pages"))
    )
    return blocks.groupBy("contract_id").agg(joined("block", "block_text").alias("text"),
                                             F.sum("n_pages").alias("n_pages"))


def dataset_scan(table: DataFrame, position: str, text: str, limit: int | None = None) -> DataFrame:
    """Rows of a stored dataset as contracts; the id comes from the row's own position column."""
    kept = table.where(F.col(position) < limit) if limit else table
    contract_id = F.concat(F.lit(fv.DATASET_ID_PREFIX), F.col(position).cast("string"))
    before, after = fv.DATASET_PATH
    return kept.select(contract_id.alias("contract_id"),
                       F.concat(F.lit(before), contract_id, F.lit(after)).alias("file_path"),
                       F.lit(fv.DATASET_SOURCE).alias("source"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def admit(table: DataFrame, position: str, text: str, window: int = fv.ADMISSION_WINDOW) -> DataFrame:
    """Texts worth keeping: long enough after stripping, and no paper or dataset description by their first ``window`` characters."""
    head = F.lower(F.substring("stripped", 1, window))
    paper = tx.any_of([F.contains(head, F.lit(m)) for m in fv.ADMISSION_MARKERS])
    description = (F.col("position") == 0) & F.contains(head, F.lit(fv.FIRST_DOCUMENT_MARKER))
    stripped = tx.computed_once(table.select(F.col(position).alias("position"), F.col(text).alias("_text")),
                                stripped=tx.strip(F.coalesce(F.col("_text"), F.lit(""))))
    kept = stripped.where((F.length("stripped") >= fv.MIN_ADMITTED_CHARS) & ~paper & ~description)
    number = F.col("position").cast("string")
    padded = F.when(F.length(number) >= 4, number).otherwise(F.lpad(number, 4, "0"))
    return kept.select(F.concat(F.lit(fv.DATASET_ID_PREFIX), padded).alias("contract_id"), F.col("stripped").alias("text"))


def cleaned(contracts: DataFrame) -> DataFrame:
    """Adds ``clean_text``; evaluated once, whatever is filtered on it afterwards."""
    kept = [c for c in contracts.columns if c != "text"]
    return tx.computed_once(contracts, clean_text=tx.clean_text(F.col("text"))).select(*kept, "clean_text")


def by_contract(contracts: DataFrame) -> DataFrame:
    """Bring each contract to the partition of its id, as plain text, before anything is spread out.

    This is the one shuffle of the retrieval plan.  Contracts stored with ``write_bucketed`` do not need it.
    """
    return contracts.repartition("contract_id")


def write_bucketed(contracts: DataFrame, table: str, buckets: int) -> None:
    """Store contracts or results bucketed by id: joins and groupings on the id then read without a shuffle."""
    contracts.write.bucketBy(buckets, "contract_id").sortBy("contract_id").mode("overwrite").saveAsTable(table)


def ready(contracts: DataFrame) -> DataFrame:
    """Cleaned contracts that are long enough to process."""
    return cleaned(contracts).where(tx.is_long_enough(F.col("clean_text")))


def too_short(contracts: DataFrame) -> DataFrame:
    """Failure rows of contracts that are not."""
    short = cleaned(contracts).where(~tx.is_long_enough(F.col("clean_text")))
    return short.select(F.col("contract_id").alias("id"), F.lit("text too short").alias("error"))


