"""A corpus from raw documents to token ids, as a list of stages.

Each stage takes the documents that its predecessor kept, as written to Parquet, and returns a DataFrame; all but the last
return the columns of ``documents``.

1. The quality classifier learns from ``labels`` and drops the documents that it scores below 0.5.
2. Line dedup drops lines that occur before, equal or within two edits; a document whose lines all go, goes itself.
3. Near-dedup keeps the document of the smallest id of each group (five-word shingles, similarity of 0.8 or more).
4. Decontamination drops documents that hold an item of ``benchmark``.
5. The texts are encoded and decoded; the ids and the digests of both are returned.

Rows without an id pass stages 3 and 4; rows that repeat an id stand for one document and go or stay together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.llm import bpe_reuse, decontamination, line_dedup, near_dedup, quality_gam
from clauseloom.llm.registry import query, ship, table
from clauseloom.session import written

VOCABULARY = "word_bpe_49k.json"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_gam.score_quality(docs.select("doc_id", "text", F.struct("*").alias("row")), model)  # no name of docs is replaced
    return scored.where("predicted = 1").select("row.*")


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = near_dedup.near_duplicates(docs.select("doc_id", "text"), 5, 80).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_reuse.coded(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), with_ids=True).drop("text")


STAGES = [("quality classifier", good), ("line dedup", new_lines), ("minhash near-dedup", one_of_each_group),
          ("benchmark decontamination", unleaked), ("bpe encoding and decoding", encoded)]

ORACLE_SQL = None  # neither the boosted classifier nor the tokenizer can be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage written to the shared folder and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
