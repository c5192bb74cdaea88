"""Figures over the result table.  Each is one aggregation, whatever the number of fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import FieldConfig

MILLION = 1_000_000


def _seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def token_usage(results: DataFrame) -> DataFrame:
    total, n = F.coalesce(F.sum("tokens_used"), F.lit(0)), F.count(F.lit(1))
    return results.agg(total.alias("total_tokens"), (total / F.greatest(n, F.lit(1))).alias("avg_tokens"))


def time_span(results: DataFrame) -> DataFrame:
    return results.agg(F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))


def field_coverage(results: DataFrame, fields: list[str], digits: int | None = None) -> DataFrame:
    """Filled rows and their share in percent per field."""
    counted = results.agg(F.count(F.lit(1)).alias("total"), *[F.count(f).alias(f) for f in fields])
    rows = counted.unpivot("total", fields, "field", "filled")
    percent = F.coalesce(F.try_divide(F.col("filled") * 100.0, F.col("total")), F.lit(0.0))
    return rows.select("field", "filled", "total", (F.round(percent, digits) if digits is not None else percent).alias("percent"))


def penalty_profile(results: DataFrame) -> DataFrame:
    """Contracts with cash penalties, with credits only and without either, with shares in percent."""
    flag, n = F.col("penalty_has_monetary"), F.count(F.lit(1))
    groups = {"cash": F.count_if(flag == 1), "credits_only": F.count_if(flag == 0), "none": F.count_if(flag.isNull())}
    return results.agg(*[c.alias(g) for g, c in groups.items()],
                       *[F.try_divide(c * 100.0, n).alias(f"{g}_percent") for g, c in groups.items()])


def coverage_wide(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("uptime_guarantee").alias("has_uptime"), F.count("penalty_uptime_breach").alias("has_uptime_penalty"),
        F.count("penalty_has_monetary").alias("has_any_penalty"), F.sum("penalty_has_monetary").alias("has_cash_penalty"),
        F.count(F.lit(1)).alias("total"))


def _cost(tokens: Column, rate: Column) -> Column:
    return (tokens.cast("decimal(20,0)") * rate.cast("decimal(10,4)") / F.lit(MILLION)).cast("decimal(30,8)")


def cost_bands(results: DataFrame, bands: dict[str, str] = fv.COST_BANDS) -> DataFrame:
    """Cost of all tokens at each rate; the rates are a few fixed pairs."""
    total = results.agg(F.coalesce(F.sum("tokens_used"), F.lit(0)).alias("total_tokens"))
    rates = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(r).cast("decimal(10,4)").alias("rate")) for b, r in bands.items()])
    spread = total.select("total_tokens", F.explode(rates).alias("r"))
    return spread.select(F.col("r.band").alias("band"), "total_tokens", _cost(F.col("total_tokens"), F.col("r.rate")).alias("cost"))


def batch_summary(results: DataFrame, failures: DataFrame, rate: str = fv.BATCH_RATE) -> DataFrame:
    """Results that did not fail, logged failures, tokens and estimated cost of a run."""
    done = results.select((F.col("status") != "failed").cast("int").alias("ok"), F.lit(0).alias("failure"), "tokens_used")
    logged = failures.select(F.lit(0).alias("ok"), F.lit(1).alias("failure"), F.lit(0).cast("long").alias("tokens_used"))
    totals = done.unionByName(logged).agg(F.sum("ok").alias("n_success"), F.sum("failure").alias("n_failed"),
                                          F.sum("tokens_used").alias("total_tokens"))
    return totals.select("*", _cost(F.col("total_tokens"), F.lit(rate)).alias("estimated_cost"))


def progress_eta(results: DataFrame, corpus_size: int = fv.CORPUS_SIZE) -> DataFrame:
    """Done, rate per second and seconds left; no rate while all rows share one second."""
    span = results.agg(F.count(F.lit(1)).alias("done"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))
    timed = span.select("done", "last_at", _seconds("first_at", "last_at").alias("elapsed_sec"),
                        (F.lit(corpus_size) - F.col("done")).alias("remaining"))
    rate = F.try_divide(F.col("done").cast("double"), F.col("elapsed_sec"))
    return timed.select("done", "elapsed_sec", "remaining", (F.col("done") * 100.0 / corpus_size).alias("percent"),
                        rate.alias("rate_per_sec"), F.try_divide(F.col("remaining").cast("double"), rate).alias("eta_sec"))


def recent_rate(results: DataFrame, n: int = fv.RECENT_ROWS, corpus_size: int = fv.CORPUS_SIZE) -> DataFrame:
    """Rate over the latest ``n`` rows, and the seconds the rest takes at that rate; no row for fewer than two."""
    recent = results.select("created_at", "contract_id").orderBy(F.desc("created_at"), F.desc("contract_id")).limit(n)
    span = recent.agg(F.count(F.lit(1)).alias("n_recent"), F.min("created_at").alias("first_at"),
                      F.max("created_at").alias("last_at")).where(F.col("n_recent") >= 2)
    total = results.agg(F.count(F.lit(1)).alias("done"))
    rate = F.try_divide((F.col("n_recent") - 1).cast("double"), F.col("span_sec"))
    timed = span.select(F.lit(1).alias("one"), "n_recent", _seconds("first_at", "last_at").alias("span_sec"))
    joined = timed.join(total.withColumn("one", F.lit(1)), "one")
    return joined.select("n_recent", "span_sec", rate.alias("rate_per_sec"), (F.lit(corpus_size) - F.col("done")).alias("remaining"),
                         F.try_divide((F.lit(corpus_size) - F.col("done")).cast("double"), rate).alias("eta_sec"))


def populated_count(fields: FieldConfig) -> Column:
    """Number of filled fields of a result row."""
    return sum((F.col(f.name).isNotNull().cast("int") for f in fields), F.lit(0))
