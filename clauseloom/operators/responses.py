"""From raw responses to typed result rows.  A bad response makes a failed row, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import BOOLEAN, FieldConfig, names
from ..functions import responses as rs
from ..functions import text as tx


def parse(responses: DataFrame) -> DataFrame:
    """Adds ``members``: the JSON object found in ``raw_response``, null when there is none.

    The whole text is tried first.  Only a text that is no JSON at all is searched for a brace span;
    JSON that is not an object has no members.  Of a key that an object repeats, the last value counts.
    """
    body = tx.computed_once(responses, body=rs.unfenced(F.col("raw_response")))
    whole = tx.computed_once(body, whole=rs.parsed(F.col("body")))
    span = F.when(F.col("whole").isNull(), rs.parsed(rs.brace_span(F.col("body"))))
    found = tx.computed_once(whole, once=rs.members(F.coalesce(F.col("whole"), span)))
    again = F.when(rs.is_json(F.col("body")), rs.repeating_members(F.col("body"))).otherwise(rs.repeating_members(rs.brace_span(F.col("body"))))
    members = F.when(F.col("once").isNull() & F.col("whole").isNull(), again).otherwise(F.col("once"))
    return tx.computed_once(found, members=members).drop("body", "whole", "once")


def populated(members: Column) -> Column:
    """Non-null values of the object, whatever their keys; false and the empty text count."""
    return F.size(F.filter(F.map_values(members), lambda v: ~F.is_variant_null(v)))


def validate(parsed: DataFrame, fields: FieldConfig) -> DataFrame:
    """Typed fields, status and error.  Unknown keys are dropped, but counted as populated.

    A failed row keeps its identity and gets empty fields, no response text and no tokens.
    """
    members = F.col("members")
    values = {f.name: F.try_element_at(members, F.lit(f.name)) for f in fields}
    wrong = F.filter(
        F.array(*[F.when(~rs.is_valid(values[f.name], f), F.lit(f.name)) for f in fields]), lambda n: n.isNotNull())
    kept = [c for c in parsed.columns if c not in ("members", "raw_response", "tokens_used")]
    checked = tx.computed_once(
        parsed, wrong=wrong, populated=populated(members),
        **{f"_{f.name}": rs.field_value(values[f.name], f) for f in fields})
    error = F.when(members.isNull(), F.lit("response is not a JSON object")).when(
        F.size("wrong") > 0, F.concat(F.lit("wrong type: "), F.array_join("wrong", ", ")))
    judged = checked.withColumn("error", error)
    ok = F.col("error").isNull()
    return judged.select(
        *kept,
        F.when(~ok, "failed").when(F.col("populated") >= fv.SUCCESS_FIELDS, "success").otherwise("partial")
        .alias("status"),
        F.when(ok, F.col("tokens_used")).otherwise(0).cast("long").alias("tokens_used"),
        F.when(ok, F.col("populated")).alias("populated"),
        *[F.when(ok, F.col(f"_{f.name}")).alias(f.name) for f in fields],
        F.when(ok, F.col("raw_response")).alias("raw_response"),
        "error",
    )


def extraction_results(responses: DataFrame, fields: FieldConfig) -> DataFrame:
    """Parse and validate; the clause values nested in one column."""
    flat = validate(parse(responses), fields)
    others = [c for c in flat.columns if c not in names(fields)]
    return flat.select(*others, F.struct(*names(fields)).alias("sla"))


def result_rows(responses: DataFrame, fields: FieldConfig) -> DataFrame:
    """Rows of the result table: booleans as 0, 1 or null."""
    flat = validate(parse(responses), fields)
    flags = {f.name for f in fields if f.kind == BOOLEAN}
    columns = ["contract_id", "file_path", "status", "tokens_used", *names(fields), "raw_response", "error", "created_at"]
    return flat.select(*[F.col(c).cast("int").alias(c) if c in flags else F.col(c) for c in columns])


def raw_preview(results: DataFrame, contract_id, size: int = 100) -> DataFrame:
    """Keys of one contract's response with a value, the value cut to ``size`` characters."""
    one = parse(results.where(F.col("contract_id") == contract_id).select("contract_id", "raw_response"))
    spread = one.select("contract_id", F.explode_outer("members").alias("key", "value"))
    text = spread.select("contract_id", "key", F.try_variant_get("value", "$", "string").alias("value"),
                         F.schema_of_variant("value").alias("type"))
    truthy = F.col("value").isNotNull() & (F.col("value") != "") & ~(
        (F.col("type") == "BOOLEAN") & (F.col("value") == "false")) & ~(
        (F.col("type") != "STRING") & F.col("value").isin("0", "0.0", "[]", "{}"))
    return text.where(truthy).select("contract_id", "key", tx.preview(F.col("value"), size).alias("preview"))
