"""Evaluation reports on disk: a summary of one row, and one line per contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fields import FieldConfig
from ..operators import scoring as sc
from ..plans import evaluation as ev

PER_CONTRACT = "contract_id string, is_non_contract boolean, scores map<string,double>, overall double, missed int"


def write_report(scored: DataFrame, path: str, fields: FieldConfig) -> None:
    """Summary, evaluated contracts and excluded contracts, each in its own folder."""
    ev.eval_report(scored, fields).write.mode("overwrite").json(f"{path}/summary")
    sc.scores_by_field(sc.contracts_only(scored)).write.mode("overwrite").option(
        "ignoreNullFields", "false").json(f"{path}/per_contract")
    sc.excluded(scored).write.mode("overwrite").json(f"{path}/excluded")


def read_per_contract(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PER_CONTRACT).json(f"{path}/per_contract")


def flatten_report(per_contract: DataFrame) -> DataFrame:
    """One row per contract and field."""
    return per_contract.select("contract_id", "overall", F.explode_outer("scores").alias("field", "score"))
