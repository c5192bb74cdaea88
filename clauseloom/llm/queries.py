"""The dealt operators applied to their whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.session import new_folder, written

from . import (bpe_reuse, chat_format, collocations, decontamination, lexical_search, line_dedup, near_dedup, quality_gam, quality_rules, sql, token_counts,
               token_store, url_filter, warc)
from .registry import query, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
RULES = (url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
         url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"))
EXTRA_TURNS = ((-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok"))


@query("op2_token_store")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-ids")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY), END_ID)
    return token_store.read_tokens(spark, path).mapInArrow(token_store.digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op4_chat_format", sql.chat())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    formatted = written(chat_format.format_conversations(turns.unionByName(extra)), "chat")
    return chat_format.digest(formatted)


@query("op5_bpe_reuse")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_reuse.coded(docs, public_tokenizers.path(VOCABULARY)).drop("text")


@query("op6_url_filter", sql.urls(RULES, url_filter.ROUNDS, url_filter.DAMPING, url_filter.THRESHOLD))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(VOCABULARY)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op9_near_dedup", sql.near_duplicates(4, 80))
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 80)


@query("op8_quality_rules", sql.quality(quality_rules.SHARE, quality_rules.MIN_LANGUAGE_WORDS, quality_rules.MIN_WORDS, quality_rules.MIN_COMMON_WORDS,
                                        quality_rules.MAX_CLASS_DISTANCE, quality_rules.MAX_WORD_DISTANCE))
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"), typical=True)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept",
                         *[F.round(c, 6).alias(c) for c in ("class_distance", "typical_distance", "word_distance")])


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.withColumn("score", F.round("score", 6))


@query("op10_quality_gam")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return quality_gam.score_quality(docs, model).select("doc_id", "held_out", "score", "predicted")


@query("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.judge_lines(docs).drop("row_hash")


@query("op11_warc_revisits", sql.archives())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(warc.page_records(table(spark, sf_dir, "pages")), path)
    found = warc.resolved(warc.read_archives(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op12_lexical_search", sql.searched(lexical_search.TOP))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_collocations", sql.phrases(collocations.MIN_COUNT, collocations.LONGEST, collocations.TOP))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))
