"""Smaller reports and checks around the extraction: amounts, overlap, rules, sections, costs, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..functions import text as tx

CRITICAL_FIELDS = ("uptime_guarantee", "response_time_sla", "penalty_uptime_breach")
SECTION_HEADER = r"^(?:(?i)section|article|schedule|exhibit|appendix) +[0-9A-Z]+(?:\.[0-9]+)*"
SECTION_NUMBER = r"(?i)^(?:section|article|schedule|exhibit|appendix) +([0-9A-Z]+(?:\.[0-9]+)*)"
SECTION_REFERENCE = r"(?i)see section ([0-9]+(?:\.[0-9]+)*)"


def penalty_over(results: DataFrame, minimum, code: str = "USD") -> DataFrame:
    """Contracts with a penalty above ``minimum``: the largest amount of one currency in the field, whatever else it says.

    Amounts of other currencies are not compared.
    """
    top = money.largest(money.amounts(F.col("penalty_max_amount")), code)
    rows = tx.computed_once(results.select("contract_id", "penalty_max_amount"), amount=top["value"])
    return rows.where(F.col("amount") > F.lit(minimum))


def token_overlap(pairs: DataFrame, predicted: str = "predicted", gold: str = "gold") -> DataFrame:
    """Share of the gold words that the prediction has; a match above one half."""
    def words(column: str) -> Column:
        return F.array_distinct(F.filter(F.split(F.lower(F.col(column)), r"\s+"), lambda w: w != ""))

    worded = tx.computed_once(pairs, _p=words(predicted), _g=words(gold))
    empty = F.coalesce(F.size("_p") <= 0, F.lit(True)) | F.coalesce(F.size("_g") <= 0, F.lit(True))
    share = F.when(empty, 0.0).otherwise(F.try_divide(F.size(F.array_intersect("_p", "_g")).cast("double"), F.size("_g")))
    scored = tx.computed_once(worded, _share=share)
    return scored.select(*[c for c in pairs.columns if c not in (predicted, gold)],
                         F.round("_share", 3).alias("score"), (F.col("_share") > 0.5).alias("is_match"))


def validate_rules(results: DataFrame, critical: tuple[str, ...] = CRITICAL_FIELDS) -> DataFrame:
    """Rule violations of each result; ``confidence`` is judged where the table has it."""
    def given(column: str) -> Column:
        return F.coalesce(F.col(column) != "", F.lit(False))

    rules = [
        F.when(~tx.any_of([given(c) for c in critical]), F.lit("no critical field")),
        F.when(given("uptime_guarantee") & ~F.contains("uptime_guarantee", F.lit("%")), F.lit("uptime without percentage")),
    ]
    if "confidence" in results.columns:
        rules.append(F.when(F.col("confidence") == "low", F.lit("low confidence")))
    issues = F.array_compact(F.array(*rules))
    return results.select("contract_id", (F.size(issues) == 0).alias("valid"), F.array_join(issues, "; ").alias("issues"))


def chunk_cap(seen: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` retrieved chunks of each contract."""
    order = Window.partitionBy("contract_id").orderBy("seen")
    return seen.withColumn("position", F.row_number().over(order)).where(F.col("position") <= cap)


def section_chunks(contracts: DataFrame, header: str = SECTION_HEADER) -> DataFrame:
    """Sections of each text, from one header line to the next; what precedes the first header is section 0.

    Sections are cut inside the row that holds the text.
    """
    lined = contracts.select("contract_id", F.split("clean_text", "\n").alias("lines"))
    is_head = F.transform("lines", lambda line, i: F.when(F.rlike(line, F.lit(header)) | (i == 0), i))
    starts = lined.select("contract_id", "lines", F.filter(is_head, lambda i: i.isNotNull()).alias("starts"))
    spans = starts.select("contract_id", "lines", F.transform("starts", lambda s, j: F.struct(
        s.alias("first"), (F.coalesce(F.get("starts", j + 1), F.size("lines")) - s).alias("n_lines"))).alias("spans"))
    spread = tx.exploded(spans, ["contract_id", "lines"], "spans", "at", "span")
    first_is_head = F.rlike(F.col("lines")[0], F.lit(header)).cast("int")
    return spread.select(
        "contract_id", (F.col("at") + first_is_head).alias("section_no"), F.get("lines", F.col("span.first")).alias("header"),
        F.array_join(F.slice("lines", F.col("span.first") + 1, F.col("span.n_lines")), "\n").alias("section_text"))


def changed_docs(contracts: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Contracts whose cleaned text differs from the one fingerprinted before, or is new."""
    current = contracts.withColumn("digest", F.sha2("clean_text", 256))
    return current.join(fingerprints.select("contract_id", "digest"), ["contract_id", "digest"], "left_anti")


def section_refs(contracts: DataFrame, sections: DataFrame, reference: str = SECTION_REFERENCE,
                 number: str = SECTION_NUMBER) -> DataFrame:
    """References to sections, each with the section of the same contract it leads to."""
    refs = tx.exploded(contracts.select("contract_id", F.regexp_extract_all("clean_text", F.lit(reference), F.lit(1))
                                        .alias("refs")), ["contract_id"], "refs", "ref_no", "target")
    numbered = sections.select("contract_id", "section_no", "section_text",
                               F.regexp_extract("header", number, 1).alias("target")).where(F.col("target") != "")
    return refs.join(numbered, ["contract_id", "target"], "left").select(
        "contract_id", "ref_no", "target", "section_no", "section_text")


def prf1(judged: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Confusion counts, precision, recall and F1 of a prediction."""
    rows = judged.select(predicted.cast("boolean").alias("p"), actual.cast("boolean").alias("a"))
    counts = rows.agg(F.count_if(F.col("p") & F.col("a")).alias("tp"), F.count_if(F.col("p") & ~F.col("a")).alias("fp"),
                      F.count_if(~F.col("p") & F.col("a")).alias("fn"), F.count_if(~F.col("p") & ~F.col("a")).alias("tn"))
    tp = F.col("tp").cast("double")
    return counts.select("tp", "fp", "fn", "tn", F.try_divide(tp, F.col("tp") + F.col("fp")).alias("precision"),
                         F.try_divide(tp, F.col("tp") + F.col("fn")).alias("recall"),
                         F.try_divide(tp * 2, tp * 2 + F.col("fp") + F.col("fn")).alias("f1"))


def provider_cost(usage: DataFrame, scale_to: int, prices: dict[str, tuple[str, str]],
                  base: str) -> DataFrame:
    """Cost of all tokens at each price pair, relative to ``base``, and scaled to ``scale_to`` contracts.

    ``usage`` has input_tokens and output_tokens per contract; the prices are a few fixed pairs.
    """
    total = usage.agg(F.count(F.lit(1)).alias("n_contracts"), F.sum("input_tokens").cast("decimal(20,0)").alias("i"),
                      F.sum("output_tokens").cast("decimal(20,0)").alias("o"))

    def cost(pair: tuple[str, str]) -> Column:
        return (F.col("i") * F.lit(pair[0]).cast("decimal(10,4)") + F.col("o") * F.lit(pair[1]).cast("decimal(10,4)")) / F.lit(1_000_000)

    rows = F.array(*[F.struct(F.lit(name).alias("provider"), cost(pair).cast("double").alias("cost")) for name, pair in prices.items()])
    spread = total.select("n_contracts", cost(prices[base]).cast("double").alias("base_cost"), F.explode(rows).alias("p"))
    return spread.select(F.col("p.provider").alias("provider"), F.round("p.cost", 6).alias("cost"),
                         F.round(F.try_divide("p.cost", "base_cost"), 6).alias("multiplier"),
                         F.round(F.try_divide(F.col("p.cost") * scale_to, F.col("n_contracts")), 6).alias("scaled_cost"))


def doc_route(contracts: DataFrame, short_tokens: int, dense_markers: tuple[str, ...]) -> DataFrame:
    """Route of each document: short ones, dense ones (long with a marker), and the rest."""
    measured = tx.computed_once(contracts, n_tokens=tx.token_count(F.col("clean_text")))
    dense = tx.any_of([F.contains(F.lower("clean_text"), F.lit(m)) for m in dense_markers])
    route = F.when(F.col("n_tokens") <= short_tokens, "short").when(dense, "dense").otherwise("standard")
    return measured.select("contract_id", "n_tokens", route.alias("route"))


def plan_filters(results: DataFrame, field: str, unlike: str) -> DataFrame:
    """Rows whose ``field`` is given and does not match a LIKE pattern."""
    return results.where(F.col(field).isNotNull() & ~F.col(field).like(unlike)).select("contract_id", field)
