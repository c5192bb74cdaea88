"""Field configurations: what is extracted and how each value is judged.

A configuration is a small, ordered tuple fixed when the job is written.  Operators turn it
into column expressions, so it never travels as data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import fixed_values as fv

TEXT, BOOLEAN, PRESENCE = "text", "boolean", "presence"


@dataclass(frozen=True)
class Field:
    """One extracted field.

    ``kind`` is ``text`` (judged against the source), ``boolean`` (any value counts) or
    ``presence`` (any non-empty value counts).  ``guidance`` goes into the default prompt.
    """

    name: str
    kind: str = TEXT
    keywords: tuple[str, ...] = ()
    pattern: str = ""
    guidance: str = ""  # what a reader of the contract should answer with

    @property
    def spark_type(self) -> T.DataType:
        return T.BooleanType() if self.kind == BOOLEAN else T.StringType()


FieldConfig = tuple[Field, ...]

_KINDS = {"penalty_has_monetary": BOOLEAN, "penalty_max_amount": PRESENCE, "penalty_currency": PRESENCE}

_GUIDANCE = {
    "uptime_guarantee": "the share of time the service is promised to be up",
    "response_time_sla": "how fast the provider reacts, for each priority where they differ",
    "sla_breach_threshold": "the level from which a remedy is owed",
    "sla_measurement_period": "over what time and how the service level is worked out",
    "penalty_uptime_breach": "what is credited or paid when the service is down too long, with the amount or how it is worked out",
    "penalty_late_delivery": "what is owed for work or milestones that come late, with the amount",
    "penalty_termination_fee": "what is owed when the contract is ended or cancelled before its term",
    "penalty_late_payment": "interest or charges on invoices that are not paid in time",
    "penalty_data_breach": "fines, liability or indemnity after a loss of data or a security incident",
    "penalty_has_monetary": "true where some penalty is payable in cash, as an amount or as a part of fees; false where all that is owed is "
                            "credit for later service; null where the contract has no penalty",
    "penalty_max_amount": "the highest amount that any penalty names",
    "penalty_currency": "the code of the currency of the penalties, not a quote",
    "service_credit_cap": "the most credit that can be claimed",
    "renewal_terms": "whether the contract goes on by itself, and by when it must be stopped",
    "termination_clause": "on what grounds and with what notice a party may end the contract",
    "liability_cap": "the most that a party can be liable for in all",
    "governing_law": "the law that applies, and where",
    "dispute_resolution": "how and where disputes are settled: by a court, an arbitrator or a mediator",
}

SLA_FIELDS: FieldConfig = tuple(
    Field(name, _KINDS.get(name, TEXT), fv.KEYWORDS.get(name, ()), fv.PATTERNS.get(name, ""), _GUIDANCE[name])
    for name in fv.PERFORMANCE_FIELDS + fv.PENALTY_FIELDS + fv.MONETARY_FIELDS + fv.MECHANICS_FIELDS
)


def names(fields: FieldConfig) -> list[str]:
    return [f.name for f in fields]


def clause_type(fields: FieldConfig = SLA_FIELDS) -> T.StructType:
    """Nested value of one extraction."""
    return T.StructType([T.StructField(f.name, f.spark_type) for f in fields])


def extraction_schema(fields: FieldConfig = SLA_FIELDS) -> T.StructType:
    """Nested result of one extraction, before it is flattened for the result table."""
    return T.StructType(
        [
            T.StructField("contract_id", T.StringType()),
            T.StructField("file_path", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("sla", clause_type(fields)),
            T.StructField("raw_response", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("tokens_used", T.LongType()),
        ]
    )


def result_schema(fields: FieldConfig = SLA_FIELDS) -> T.StructType:
    """Flat result table: one row per contract, booleans stored as 0, 1 or null."""
    columns = [("contract_id", T.StringType()), ("file_path", T.StringType()), ("status", T.StringType()),
               ("tokens_used", T.LongType())]
    columns += [(f.name, T.IntegerType() if f.kind == BOOLEAN else T.StringType()) for f in fields]
    columns += [("raw_response", T.StringType()), ("error", T.StringType()), ("created_at", T.TimestampNTZType())]
    return T.StructType([T.StructField(n, t) for n, t in columns])
