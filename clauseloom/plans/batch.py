"""Whole runs: contracts in, prompts or result rows out, each as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import BOOLEAN, SLA_FIELDS, FieldConfig, names
from ..operators import chunking as ch
from ..operators import extraction as ex
from ..operators import prompts as pr
from ..operators import retrieval as rt
from ..sources import contracts as ct
from .statistics import populated_count

PENALTIES = list(fv.PENALTY_FIELDS)


@dataclass(frozen=True)
class Settings:
    chunk_size: int = fv.CHUNK_SIZE
    chunk_overlap: int = fv.CHUNK_OVERLAP
    top_k: int = fv.TOP_K


def retrieved(contracts: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Retrieved chunks of every contract that is long enough, each text once."""
    chunks = ch.chunk(ct.ready(ct.by_contract(contracts)), settings.chunk_size, settings.chunk_overlap)
    return rt.retrieved(chunks, queries, settings.top_k)


def prompts(contracts: DataFrame, queries: DataFrame, settings: Settings = Settings(),
            template: str | None = None) -> DataFrame:
    """Messages and token budget of each contract, for a model run elsewhere.

    Its answers come back as a table of contract_id, file_path, raw_response, tokens_used and
    created_at, and become result rows in ``operators.responses.result_rows``.
    """
    chunks = ch.chunk(ct.ready(ct.by_contract(contracts)), settings.chunk_size, settings.chunk_overlap)
    return pr.budget(pr.messages(rt.retrieve(chunks, queries, settings.top_k), template))


def rule_results(contracts: DataFrame, queries: DataFrame, created_at: Column, fields: FieldConfig = SLA_FIELDS,
                 settings: Settings = Settings(), penalties: list[str] = PENALTIES) -> DataFrame:
    """Result rows from the extraction rules: text fields by rule, money fields derived from the penalty clauses.

    ``contracts`` has contract_id, file_path and text.
    """
    clauses = ex.extract_clauses(retrieved(contracts.select("contract_id", "text"), queries, settings), fields)
    with_money = ex.with_money(clauses, [p for p in penalties if p in clauses.columns])
    found = with_money.join(contracts.select("contract_id", "file_path"), "contract_id")
    given = [F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.spark_type).alias(f.name) for f in fields]
    filled = found.select("contract_id", "file_path", *given)
    status = F.when(populated_count(fields) >= fv.SUCCESS_FIELDS, "success").otherwise("partial")
    values = [F.col(f.name).cast("int").alias(f.name) if f.kind == BOOLEAN else F.col(f.name) for f in fields]
    none = F.lit(None).cast("string")
    return filled.select("contract_id", "file_path", status.alias("status"), F.lit(0).cast("long").alias("tokens_used"), *values,
                         F.to_json(F.struct(*names(fields)), {"ignoreNullFields": "false"}).alias("raw_response"),
                         none.alias("error"), created_at.alias("created_at"))

