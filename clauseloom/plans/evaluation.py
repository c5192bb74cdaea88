"""Evaluation reports over scored results (``operators.scoring.score_results``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fields import FieldConfig
from ..functions import text as tx
from ..operators import scoring as sc

SCORES = (1.0, 0.8, 0.6, 0.4, 0.0, None)


def _at_least(threshold: float) -> Column:
    return F.count_if(F.col("overall") >= threshold)


def field_summary(scored: DataFrame) -> DataFrame:
    """Per field: mean of the extracted, and how many are extracted, missed and absent."""
    rows = sc.field_scores(sc.contracts_only(scored))
    score = F.col("score")
    return rows.groupBy("field").agg(
        F.coalesce(F.avg(F.when(score > 0, score)), F.lit(0.0)).alias("avg_score"),
        F.count_if(score > 0).alias("extracted"), F.count_if(score == 0).alias("missed"),
        F.count_if(score.isNull()).alias("absent"))


def eval_summary(scored: DataFrame, without: str | int | None = None) -> DataFrame:
    """One row: contracts, mean score, counts at three thresholds, and contracts left out as non-contracts."""
    kept = scored if without is None else scored.where(F.col("contract_id") != without)
    real = ~F.col("is_non_contract")
    overall = F.when(real, F.col("overall"))
    return kept.select("is_non_contract", overall.alias("overall")).agg(
        F.count("overall").alias("n_contracts"), F.count_if("is_non_contract").alias("n_excluded"),
        F.avg("overall").alias("avg_overall"), _at_least(0.8).alias("score_gte_0_8"),
        _at_least(0.7).alias("score_gte_0_7"), _at_least(0.5).alias("score_gte_0_5"))


def first_results(results: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` results by id, for a quick evaluation."""
    first = results.select("contract_id").orderBy("contract_id").limit(limit)  # ids alone meet in one task
    return results.join(first, "contract_id", "left_semi")


def eval_extremes(scored: DataFrame, n: int) -> DataFrame:
    """The ``n`` lowest with their missed fields, and the ``n`` highest with their well-scored ones."""
    def picked(keep) -> Column:
        return F.array_join(F.array_sort(F.transform(F.filter("checks", keep), lambda c: c["field"])), ",")

    real = sc.contracts_only(scored)
    low = real.select(F.lit("lowest").alias("side"), "contract_id", "overall",
                      picked(lambda c: c["score"] == 0.0).alias("fields"))
    high = real.select(F.lit("highest").alias("side"), "contract_id", "overall",
                       picked(lambda c: c["score"] >= 0.8).alias("fields"))
    return low.orderBy("overall", "contract_id").limit(n).unionByName(
        high.orderBy(F.desc("overall"), F.desc("contract_id")).limit(n))


def score_histogram(scored: DataFrame) -> DataFrame:
    """Number of (contract, field) pairs per score; scores that do not occur are kept with 0."""
    rows = sc.field_scores(sc.contracts_only(scored)).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    levels = scored.sparkSession.createDataFrame([(s,) for s in SCORES], "level double")
    joined = rows.join(F.broadcast(levels), F.col("score").eqNullSafe(F.col("level")), "right")
    return joined.select(F.coalesce(F.col("level").cast("string"), F.lit("null")).alias("score"),
                         F.coalesce("n", F.lit(0)).alias("n_pairs"))


def _with_value(scored: DataFrame, score: float) -> DataFrame:
    rows = sc.field_scores(sc.contracts_only(scored))
    return rows.where((F.col("score") == score) & (F.col("value") != ""))


def _cut(text: Column, size: int | None) -> Column:
    return text if size is None else F.substring(text, 1, size)


def near_misses(scored: DataFrame, n: int | None = None, snippet_chars: int | None = None) -> DataFrame:
    """Values of the right form that were not found, and whether a shorter start of them is found."""
    snippet = tx.strip(F.lower(F.substring("value", 1, sc.NEAR_CHARS)))
    rows = _with_value(scored, 0.6).select("contract_id", "field", F.col("near").alias("ws_match"),
                                           _cut(snippet, snippet_chars).alias("snippet"))
    ordered = rows.orderBy("contract_id", "field")
    return ordered.limit(n) if n else ordered


def unverifiable(scored: DataFrame, n: int | None = None, snippet_chars: int | None = None) -> DataFrame:
    """Values that were neither found nor of the right form."""
    rows = _with_value(scored, 0.4).select("contract_id", "field", _cut(F.col("value"), snippet_chars).alias("snippet"))
    ordered = rows.orderBy("contract_id", "field")
    return ordered.limit(n) if n else ordered


def missed_by_field(scored: DataFrame) -> DataFrame:
    rows = sc.field_scores(sc.contracts_only(scored)).where(F.col("score") == 0.0)
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("n_missed")).orderBy(F.desc("n_missed"), "field")


def leaderboard(scored: DataFrame) -> DataFrame:
    """Contracts by score, with extracted and missed counts."""
    extracted = F.size(F.filter("checks", lambda c: c["score"] > 0))
    rows = sc.contracts_only(scored).select("contract_id", "overall", extracted.alias("extracted"), "missed")
    return rows.orderBy(F.desc("overall"), "contract_id")


def eval_report(scored: DataFrame, fields: FieldConfig) -> DataFrame:
    """Corpus summary with the per-field figures as one map, in one pass.  Contracts are a table of their own.

    ``checks`` follows the order of the configuration, so a field is read by position.
    """
    real = sc.contracts_only(scored)
    columns = real.select("overall", *[F.col("checks")[i]["score"].alias(f"s{i}") for i in range(len(fields))])
    figures = columns.agg(
        F.count(F.lit(1)).alias("n_contracts"), F.coalesce(F.avg("overall"), F.lit(0.0)).alias("avg_overall"),
        _at_least(0.8).alias("score_gte_0_8"), _at_least(0.7).alias("score_gte_0_7"),
        _at_least(0.5).alias("score_gte_0_5"),
        *[F.struct(F.coalesce(F.avg(F.when(F.col(f"s{i}") > 0, F.col(f"s{i}"))), F.lit(0.0)).alias("avg_score"),
                   F.count_if(F.col(f"s{i}") > 0).alias("extracted"), F.count_if(F.col(f"s{i}") == 0).alias("missed"),
                   F.count_if(F.col(f"s{i}").isNull()).alias("absent")).alias(f"s{i}") for i in range(len(fields))])
    per_field = F.map_from_arrays(F.array(*[F.lit(f.name) for f in fields]),
                                  F.array(*[F.col(f"s{i}") for i in range(len(fields))]))
    return figures.select("n_contracts", "avg_overall", "score_gte_0_8", "score_gte_0_7", "score_gte_0_5",
                          per_field.alias("per_field"))
