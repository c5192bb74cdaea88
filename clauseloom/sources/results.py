"""The result table and what is exported from it.

The table is a folder of Parquet batches.  A batch is written under the id of its run and its number
in that run, and replaces itself when it is written again; batches of other runs are never touched.
Readers take the latest row of each contract.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..fields import SLA_FIELDS, FieldConfig, result_schema

RUN, BATCH = "run_id", "batch_id"
WRITTEN, SEQ = "written_at", "write_seq"  # order of rows that are equally new: the last write wins


def create(spark: SparkSession, path: str, fields: FieldConfig = SLA_FIELDS) -> None:
    """Make an empty result table where there is none; an existing one is left as it is."""
    if not exists(spark, path):
        reset(spark, path, fields)


def reset(spark: SparkSession, path: str, fields: FieldConfig = SLA_FIELDS) -> None:
    """Replace the table by an empty one."""
    empty = _numbered(spark.createDataFrame([], result_schema(fields))).withColumn(RUN, F.lit("")).withColumn(BATCH, F.lit(-1))
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(RUN, BATCH).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there.  Only a missing path means no; every other error is raised."""
    try:
        spark.read.format("parquet").schema(result_schema()).load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with the time of writing and their place in the batch, unless they bring their own."""
    own = {WRITTEN: F.current_timestamp(), SEQ: F.monotonically_increasing_id()}
    return rows.withColumns({name: value for name, value in own.items() if name not in rows.columns})


def append_batch(rows: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Write one batch of a run.

    Writing the same run and number again replaces that batch alone, so a repeated batch changes nothing.  ``run_id`` must be
    new for a new run (letters, digits, ``-``, ``_`` and ``.``): a stream has an id of its own, which its checkpoint keeps.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r}: letters, digits, '-', '_' and '.' only")
    _numbered(rows).write.mode("overwrite").parquet(f"{path}/{RUN}={run_id}/{BATCH}={int(batch_id)}")


def read_all(spark: SparkSession, path: str, fields: FieldConfig = SLA_FIELDS) -> DataFrame:
    schema = result_schema(fields).add(WRITTEN, "timestamp").add(SEQ, "long").add(RUN, "string").add(BATCH, "long")
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def latest(rows: DataFrame, *newest_first: Column) -> DataFrame:
    """The newest row of each contract.

    Each task keeps one row per contract before the shuffle, so many versions of one contract do not pile up.
    """
    order = newest_first or (F.col("created_at").desc_nulls_last(), F.col(WRITTEN).desc_nulls_last(), F.col(BATCH).desc(), F.col(SEQ).desc())
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("contract_id").orderBy(*order)))
    return ranked.where(F.col("_n") == 1).drop("_n")


def read_latest(spark: SparkSession, path: str, fields: FieldConfig = SLA_FIELDS) -> DataFrame:
    return latest(read_all(spark, path, fields)).drop(RUN, BATCH, WRITTEN, SEQ)


def compact(spark: SparkSession, path: str, into: str, fields: FieldConfig = SLA_FIELDS) -> None:
    """Write the current rows to a new folder as its first batch, when many batches have piled up."""
    append_batch(read_latest(spark, path, fields), into, "compacted", 0)


def upsert(existing: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Existing rows without a new version, and the newest new row of each contract; ``seq`` orders a batch."""
    winners = latest(new, F.col("created_at").desc_nulls_last(), F.col(seq).desc())
    return existing.join(winners, "contract_id", "left_anti").unionByName(winners.drop(seq))


def processed_ids(results: DataFrame) -> DataFrame:
    return results.select("contract_id").distinct()


def pending(contracts: DataFrame, results: DataFrame, limit: int | None = None) -> DataFrame:
    """Contracts without a result row.  Failed ones have a row; short ones have none and come again.

    The cap counts pending contracts: with the cap taken first, a resumed run would find nothing to do.
    """
    done = results.select("contract_id")
    if limit is None:
        return contracts.join(done, "contract_id", "left_anti")
    # the ids alone are ordered in one task; the texts stay where they are
    first = contracts.select("contract_id").join(done, "contract_id", "left_anti").orderBy("contract_id").limit(limit)
    return contracts.join(first, "contract_id", "left_semi")


def retry(contracts: DataFrame, failures: DataFrame) -> DataFrame:
    """Contracts listed in the failure log."""
    return contracts.join(failures.select(F.col("id").alias("contract_id")), "contract_id", "left_semi")


def failure_log(short: DataFrame, results: DataFrame) -> DataFrame:
    """Failure rows of a run: texts too short, and failed results.  Written also when empty."""
    failed = results.where(F.col("status") == "failed")
    return short.unionByName(failed.select(F.col("contract_id").alias("id"), "error"))


def as_json_lines(results: DataFrame) -> DataFrame:
    """Each row as one JSON text, nulls written out."""
    return results.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))


def export_json_lines(results: DataFrame, path: str) -> None:
    """JSON Lines with explicit nulls and escaped non-ASCII characters."""
    (results.write.mode("overwrite").option("ignoreNullFields", "false")
     .option("writeNonAsciiCharacterAsCodePoint", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(path))


def export_csv(results: DataFrame, path: str) -> None:
    """CSV with a header, without response texts and errors; blanks around a value are kept."""
    (results.drop("raw_response", "error").write.mode("overwrite").option("header", True).option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_failures(failures: DataFrame, path: str) -> None:
    """The failure log as JSON Lines, in place of an earlier one; a run without failures leaves an empty log."""
    failures.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """A written failure log, also an empty one, in which Spark could not find the columns."""
    return spark.read.schema("id string, error string").json(path)
