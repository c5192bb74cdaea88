"""Result tables derived from the given documents, and field configurations that fit them.

The documents hold no contract vocabulary, so responses are built from each text by fixed rules:
quotes, altered quotes, inventions and gaps, in plain, fenced, wrapped and broken JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.fields import BOOLEAN, PRESENCE, SLA_FIELDS, Field, names
from clauseloom.functions import text as tx
from clauseloom.operators import responses as rp
from clauseloom.sources import contracts as ct

FIELDS = (
    Field("opening_quote", keywords=("the ",), pattern=r"\b(?:the|and|of)\b"),
    Field("spaced_quote", pattern=r"(?:\bthe\b|\band\b)"),
    Field("invented", keywords=("with ",), pattern=r"\bthe\b"),
    Field("license_line", keywords=("released under", "licensed under"), pattern=r"licen[sc]e"),
    Field("has_flag", kind=BOOLEAN),
    Field("max_amount", kind=PRESENCE),
)

EXTRACTED = (
    Field("license_line", keywords=("released under", "licensed under"), pattern=r"licen[sc]e"),
    Field("with_the", keywords=("with ",), pattern=r"\bthe\b"),
    Field("long_number", pattern=r"[0-9]{4}"),
    Field("percentage", pattern=r"[0-9]+ ?%"),
    Field("only_keyword", keywords=("ation", "tion")),
)

RENAMED = {  # result column: fixture field shown in it
    "uptime_guarantee": "opening_quote",
    "sla_breach_threshold": "spaced_quote",
    "sla_measurement_period": "license_line",
    "penalty_uptime_breach": "invented",
    "penalty_late_payment": "spaced_quote",
    "penalty_has_monetary": "has_flag",
    "penalty_max_amount": "max_amount",
    "governing_law": "license_line",
}


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def stream_folder(sf: str, table: str) -> str:
    """Where a stream finds the files of a table, stored as one file or as a folder: streams read a single file by a pattern only."""
    return f"{sf}/[{table[0]}]{table[1:]}.parquet"


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("contract_id"), "text", F.col("doc_id"))


def ready(spark: SparkSession, sf: str) -> DataFrame:
    return ct.ready(contracts(spark, sf))


def ready_by_contract(spark: SparkSession, sf: str) -> DataFrame:
    return ct.ready(ct.by_contract(contracts(spark, sf)))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Responses in the partitions of their contracts, where results are later merged and judged."""
    return respond(ready_by_contract(spark, sf))


CLAUSES = (  # added to documents in turn, so that every field occurs
    "The uptime SLA is 99.95% in each calendar month.",
    "Support will respond within 4 hours of a priority 1 report.",
    "A breach threshold is met when availability drops below 99.5%.",
    "Availability is measured monthly over a rolling 12 month period.",
    "A service credit of 10% is granted for each breach.",
    "Liquidated damages of USD 5,000 are due per day of delay.",
    "An early termination fee equal to three months of fees applies.",
    "Overdue interest of 1.5% per month applies to unpaid invoices.",
    "The data breach penalty is a fine of $250,000.",
    "Credits shall not exceed 30% of the monthly fee.",
    "The agreement will automatically renew for one year terms.",
    "Either party may give notice of termination with 30 days prior written notice.",
    "In no event is the aggregate liability above $1,000,000.",
    "This agreement shall be governed by the laws of the State of Delaware.",
    "Any dispute shall be settled by arbitration.",
)


def contract_like(spark: SparkSession, sf: str) -> DataFrame:
    """Each document with four of the clauses put behind its first line."""
    docs = ready_by_contract(spark, sf)
    number = F.col("contract_id").cast("int")
    picked = F.concat_ws("\n", *[F.element_at(F.array(*[F.lit(c) for c in CLAUSES]), (number * (i + 1) + i * 4) % len(CLAUSES) + 1)
                                 for i in range(4)])
    end = F.greatest(F.instr("clean_text", "\n") - 1, F.lit(0))
    text = F.concat(F.substring("clean_text", F.lit(1), end), F.lit("\n"), picked, F.lit("\n"),
                    F.substring("clean_text", end + 1, F.length("clean_text")))
    return tx.computed_once(docs, joined=text).select("contract_id", F.col("joined").alias("clean_text"))


def _amounts(doc):
    """Ways to state an amount."""
    written = (("$", doc * 100, ""), ("up to $", doc, ".5k in total"), ("", doc * 10, " USD for each case"), ("€", doc, " million"),
               ("after 12 months of fees, at most $", doc, ",000"))
    return [F.concat(F.lit(before), number.cast("string"), F.lit(after)) for before, number, after in written]


REPEATED = '{"invented":"an earlier value",'  # opens responses that repeat a key


def respond(docs: DataFrame) -> DataFrame:
    """One response per cleaned document."""
    doc, clean = F.col("doc_id"), F.col("clean_text")
    # only the start of a sentence can start the match; saying so spares the search at every other character
    line = F.regexp_extract(clean, r"(?i)(?:^|(?<=[.!?\n]))[^.!?\n]*(?:released|licensed) under[^.!?\n]*", 0)
    license_line = F.nullif(line, F.lit(""))
    values = F.struct(
        F.when(doc % 5 < 3, F.substring(clean, 1, 130)).alias("opening_quote"),
        F.when(doc % 7 < 4, F.replace(F.substring(clean, 41, 60), F.lit(" "), F.lit("  "))).alias("spaced_quote"),
        F.when(doc % 3 == 0, F.concat(F.lit("the summary of "), doc.cast("string")))
        .when(doc % 3 == 1, F.concat(F.lit("zzz-"), doc.cast("string"))).alias("invented"),
        F.when(doc % 2 == 0, license_line).alias("license_line"),
        F.when(doc % 4 == 0, True).when(doc % 4 == 1, False).alias("has_flag"),
        F.when(doc % 10 == 0, F.element_at(F.array(*_amounts(doc)), (doc / 10).cast("int") % 5 + 1)).alias("max_amount"),
    )
    js = F.to_json(values, {"ignoreNullFields": "false"})
    built = tx.computed_once(docs, js=F.when(doc % 19 == 4, F.concat(F.lit(REPEATED), F.substring(js, F.lit(2), F.length(js)))).otherwise(js))
    js = F.col("js")
    raw = (F.when(doc % 17 == 0, F.substring(js, F.lit(1), F.length(js) - 20))
           .when(doc % 11 == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
           .when(doc % 13 == 0, F.concat(F.lit("Here it is: "), js, F.lit(" Done.")))
           .otherwise(js))
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(secs=(doc * 7).cast("decimal(18,6)"))
    return built.select("contract_id", "doc_id", F.concat(F.lit("documents/"), doc.cast("string")).alias("file_path"),
                        raw.alias("raw_response"), (F.lit(2000) + (doc * 37) % 9000).alias("tokens_used"),
                        at.alias("created_at"))


def second_batch(spark: SparkSession, sf: str) -> DataFrame:
    return answered_again(responses(spark, sf))


def answered_again(first: DataFrame) -> DataFrame:
    """Every fourth response, a day later."""
    day = F.make_dt_interval(days=F.lit(1))
    again = first.where(F.col("doc_id") % 4 == 0)
    return again.withColumn("created_at", F.col("created_at") + day).withColumn("tokens_used", F.col("tokens_used") + 1)


def results(spark: SparkSession, sf: str) -> DataFrame:
    return rp.result_rows(responses(spark, sf), FIELDS)


def sla_results(spark: SparkSession, sf: str) -> DataFrame:
    """The same results under the names of the full result table."""
    rows = results(spark, sf)
    columns = []
    for name in names(SLA_FIELDS):
        if name == "penalty_currency":
            columns.append(F.when(F.col("max_amount").isNotNull(), F.lit("USD")).alias(name))
        else:
            columns.append(F.col(RENAMED[name]).alias(name) if name in RENAMED else F.lit(None).cast("string").alias(name))
    return rows.select("contract_id", "file_path", "status", "tokens_used", *columns, "raw_response", "error", "created_at")


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    items = read(spark, sf, "benchmark")
    group = F.concat(F.lit("group_"), (F.col("item_id") % 4).cast("string"))
    return items.select(F.col("item_id").cast("int").alias("query_idx"), group.alias("query_group"),
                        F.col("text").alias("query_text"))
