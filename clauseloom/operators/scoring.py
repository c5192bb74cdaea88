"""How far each extracted value can be trusted, judged against the text it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import BOOLEAN, PRESENCE, FieldConfig, Field
from ..functions import text as tx

NEAR_CHARS = 80


def source_norm(contracts: DataFrame) -> DataFrame:
    """Both levels a quote is looked up in: lower-cased clean text, and the same with white space collapsed."""
    low = tx.computed_once(contracts, src_clean=F.lower(F.coalesce(F.col("clean_text"), F.lit(""))))
    return tx.computed_once(low, src_ws=F.regexp_replace("src_clean", r"\s+", " ")).drop("clean_text")


def _snippet(value: Column, size: int | None) -> Column:
    return tx.strip(F.lower(F.substring(value, 1, size) if size else value))


def _in_source(value: Column, size: int | None = fv.SNIPPET_CHARS) -> Column:
    """Whether the first characters of the value, or with ``size`` None all of it, are in the text."""
    found = tx.let(_snippet(value, size), lambda s: F.contains(F.col("src_clean"), s)
                   | F.contains(F.col("src_ws"), tx.collapse_spaces(s)))
    return (F.col("src_clean") != "") & found


def _score(field: Field) -> Column:
    value = F.col(field.name)
    none = F.lit(None).cast("double")
    if field.kind == BOOLEAN:
        return F.when(value.isNotNull(), 1.0).otherwise(none)
    given = value.isNotNull() & (value != "")
    if field.kind == PRESENCE:
        return F.when(given, 1.0).otherwise(none)
    formed = F.rlike(value, F.lit(f"(?iU){field.pattern}")) if field.pattern else F.lit(True)
    quoted = F.when(formed, 1.0).otherwise(0.8)
    unquoted = F.when(formed, 0.6).otherwise(0.4)
    expected = tx.any_of([F.contains(F.col("src_clean"), F.lit(k)) for k in field.keywords])
    return F.when(given, F.when(_in_source(value), quoted).otherwise(unquoted)).otherwise(F.when(expected, 0.0))


def _fully_quoted(field: Field) -> Column:
    """Whether the whole value is in the text, which the score asks of its first characters only; null without a value to look up."""
    value = F.col(field.name)
    if field.kind in (BOOLEAN, PRESENCE):
        return F.lit(None).cast("boolean")
    return F.when(value.isNotNull() & (value != ""), _in_source(value, None))


def _check(field: Field) -> Column:
    """Score of one field, with the value, whether its first characters are found after all, and whether the whole value is."""
    value = F.col(field.name).cast("string")
    near = F.contains(F.col("src_ws"), tx.collapse_spaces(_snippet(value, NEAR_CHARS)))
    score = F.col(f"_score_{field.name}")
    return F.struct(F.lit(field.name).alias("field"), score.alias("score"), value.alias("value"),
                    F.when(score == 0.6, near).alias("near"), _fully_quoted(field).alias("fully_quoted"))


def score_results(results: DataFrame, contracts: DataFrame, fields: FieldConfig) -> DataFrame:
    """One row per result: ``checks`` per field, ``overall`` mean of the scored fields, ``missed`` fields.

    All fields of a contract are judged in one pass over its text; only scores and values leave it.
    A result without a source text is judged as if the text were empty.
    """
    texts = contracts.select("contract_id", "clean_text")
    joined = results.select("contract_id", *[f.name for f in fields]).join(texts, "contract_id", "left")
    scored = tx.computed_once(source_norm(joined), **{f"_score_{f.name}": _score(f) for f in fields})
    scores = [F.col(f"_score_{f.name}") for f in fields]
    total = sum((F.coalesce(s, F.lit(0.0)) for s in scores), F.lit(0.0))
    count = sum((s.isNotNull().cast("int") for s in scores), F.lit(0))
    missed = sum((F.coalesce((s == 0.0).cast("int"), F.lit(0)) for s in scores), F.lit(0))
    return tx.computed_once(
        scored, is_non_contract=tx.is_non_contract(F.col("src_clean")), checks=F.array(*[_check(f) for f in fields]),
        overall=F.coalesce(F.try_divide(total, count), F.lit(0.0)), missed=missed,
    ).select("contract_id", "is_non_contract", "checks", "overall", "missed")


def field_scores(scored: DataFrame) -> DataFrame:
    """One row per contract and field."""
    spread = scored.select("contract_id", "is_non_contract", F.explode_outer("checks").alias("check"))
    return spread.select("contract_id", "is_non_contract", "check.*")


def contracts_only(scored: DataFrame) -> DataFrame:
    return scored.where(~F.col("is_non_contract"))


def excluded(scored: DataFrame) -> DataFrame:
    return scored.where("is_non_contract").select("contract_id")


def scores_by_field(scored: DataFrame) -> DataFrame:
    """The same scores as one map per contract."""
    entries = F.transform("checks", lambda c: F.struct(c["field"], c["score"]))
    return scored.select("contract_id", "is_non_contract", F.map_from_entries(entries).alias("scores"), "overall", "missed")
