"""Prompts: one per context, from a template with a single ``{context}`` slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import BOOLEAN, SLA_FIELDS, FieldConfig
from ..functions import text as tx

SLOT = "{context}"

SYSTEM_MESSAGE = (
    "You read contracts and report service levels and penalties, money above all. "
    "Answer with one JSON object and nothing around it. Quote the contract word for word. "
    "Use null for what the contract does not say, and true or false without quotes."
)


def default_template(fields: FieldConfig = SLA_FIELDS) -> str:
    """Template asking for every field of a configuration, with its guidance; literal braces are doubled."""
    def asked(field) -> str:
        kind = "true, false or null" if field.kind == BOOLEAN else "exact quote or null"
        return f'  "{field.name}": {kind}' + (f" ({field.guidance})" if field.guidance else "")

    lines = ",\n".join(asked(f).replace("{", "{{").replace("}", "}}") for f in fields)
    return (
        "Find the clauses below in the contract excerpt and return them as a JSON object with exactly these keys:\n\n"
        "{{\n" + lines + "\n}}\n\n"
        "Contract excerpt:\n" + SLOT + "\n\nReturn the JSON object only."
    )


def render(template: str, context: Column) -> Column:
    """Fill the slot.  Braces in the context are left alone."""
    before, after = (part.replace("{{", "{").replace("}}", "}") for part in template.split(SLOT))
    return F.concat(F.lit(before), context, F.lit(after))


def messages(contexts: DataFrame, template: str | None = None, system: str = SYSTEM_MESSAGE) -> DataFrame:
    """System and user message of each contract."""
    user = render(template or default_template(), F.col("context"))

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return contexts.select("contract_id", F.array(message("system", F.lit(system)), message("user", user)).alias("messages"))


def budget(prompts: DataFrame, max_output: int = fv.MAX_OUTPUT_TOKENS) -> DataFrame:
    """Adds the estimated tokens of each prompt, in words, and the most a call may use."""
    words = F.aggregate("messages", F.lit(0), lambda n, m: n + tx.token_count(tx.strip(m["content"])))
    counted = tx.computed_once(prompts, prompt_tokens=words)
    return counted.select("*", F.lit(max_output).alias("max_output_tokens"),
                          (F.col("prompt_tokens") + max_output).alias("token_budget"))
