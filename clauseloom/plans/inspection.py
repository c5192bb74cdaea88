"""Reading single contracts and filtered lists out of the result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fields import BOOLEAN, SLA_FIELDS, Field, FieldConfig
from ..functions import text as tx
from .statistics import populated_count


def inspect_contract(results: DataFrame, contract_id, fields: FieldConfig = SLA_FIELDS, size: int = 200) -> DataFrame:
    """One row per field of one contract: marker Y or -, and the value cut to ``size`` characters."""
    one = results.where(F.col("contract_id") == contract_id)

    def detail(number: int, field: Field) -> Column:
        value = F.col(field.name)
        given = value == 1 if field.kind == BOOLEAN else value != ""
        return F.struct(F.lit(number).alias("field_no"), F.lit(field.name).alias("field"), value.cast("string").alias("value"),
                        F.coalesce(given, F.lit(False)).alias("given"))

    details = F.array(*[detail(i, f) for i, f in enumerate(fields)])
    rows = one.select("contract_id", F.explode(details).alias("d")).select("contract_id", "d.*")
    return rows.select("contract_id", "field_no", "field", F.when(F.col("given"), "Y").otherwise("-").alias("marker"),
                       F.when(F.col("given"), tx.preview(F.col("value"), size)).alias("preview"))


def list_contracts(results: DataFrame, fields: FieldConfig = SLA_FIELDS) -> DataFrame:
    return results.select("contract_id", "status", F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"),
                          populated_count(fields).alias("n_fields")).orderBy("contract_id")


def cash_penalties(results: DataFrame) -> DataFrame:
    """Contracts with a cash penalty, by amount in text order, largest first."""
    rows = results.where(F.col("penalty_has_monetary") == 1)
    return rows.select("contract_id", "penalty_max_amount", "penalty_currency", "penalty_uptime_breach").orderBy(
        F.col("penalty_max_amount").desc_nulls_last(), "contract_id")


def having(results: DataFrame, field: str, *columns: str) -> DataFrame:
    """Contracts in which ``field`` was found."""
    return results.where(F.col(field).isNotNull()).select("contract_id", field, *columns)


def next_candidates(contracts: DataFrame, results: DataFrame, n: int) -> DataFrame:
    """The first ``n`` contracts by id without a result."""
    left = contracts.select("contract_id").join(results.select("contract_id"), "contract_id", "left_anti")
    return left.orderBy("contract_id").limit(n)
