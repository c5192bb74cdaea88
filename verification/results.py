"""Responses, result table, exports, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from clauseloom import session
from clauseloom.fields import BOOLEAN, SLA_FIELDS, Field, names, result_schema
from clauseloom.operators import responses as rp
from clauseloom.plans import inspection as ins
from clauseloom.plans import planned as pl
from clauseloom.plans import statistics as st
from clauseloom.sources import contracts as ct
from clauseloom.sources import results as rs
from clauseloom.sources import snapshots as sn

from . import fixture as fx
from . import oracle_parts as o
from .registry import query

_FIELDS = "opening_quote, spaced_quote, invented, license_line, has_flag, max_amount"


@query("parse_response", f"""WITH {o.PARSED}
SELECT contract_id, obj IS NOT NULL AS is_object, obj ->> '$.opening_quote' AS opening_quote, obj ->> '$.license_line' AS license_line,
       obj ->> '$.has_flag' AS has_flag, obj ->> '$.max_amount' AS max_amount FROM parsed""")
def parse_response(spark, sf):
    parsed = rp.parse(fx.responses(spark, sf))
    fields = [F.try_variant_get(F.try_element_at("members", F.lit(f)), "$", "string").alias(f)
              for f in ("opening_quote", "license_line", "has_flag", "max_amount")]
    return parsed.select("contract_id", F.col("members").isNotNull().alias("is_object"), *fields)


_STRICT = (Field("opening_quote"), Field("has_flag"), Field("invented", kind=BOOLEAN))


@query("validate_response", f"""WITH {o.PARSED}, checked AS (
SELECT contract_id, obj, CASE WHEN json_type(obj, '$.has_flag') = 'BOOLEAN' THEN 1 ELSE 0 END AS w1,
       CASE WHEN obj ->> '$.invented' IS NOT NULL THEN 1 ELSE 0 END AS w2 FROM parsed)
SELECT contract_id, CASE WHEN obj IS NULL OR w1 + w2 > 0 THEN 'failed' ELSE CASE WHEN
   (obj ->> '$.opening_quote' IS NOT NULL)::INT + (obj ->> '$.spaced_quote' IS NOT NULL)::INT + (obj ->> '$.license_line' IS NOT NULL)::INT
   + (obj ->> '$.max_amount' IS NOT NULL)::INT >= 2 THEN 'success' ELSE 'partial' END END AS status,
   CASE WHEN obj IS NULL THEN 'response is not a JSON object' WHEN w1 = 1 AND w2 = 1 THEN 'wrong type: has_flag, invented'
        WHEN w1 = 1 THEN 'wrong type: has_flag' WHEN w2 = 1 THEN 'wrong type: invented' END AS error FROM checked""")
def validate_response(spark, sf):
    """The responses held to another configuration: a boolean where text is declared, a text where a boolean is."""
    return rp.validate(rp.parse(fx.responses(spark, sf)), _STRICT).select("contract_id", "status", "error")


@query("populated_count", f"WITH {o.RESULTS} SELECT contract_id, populated FROM results")
def populated_count(spark, sf):
    return rp.validate(rp.parse(fx.responses(spark, sf)), fx.FIELDS).select("contract_id", "populated")


@query("status_class", f"WITH {o.RESULTS} SELECT contract_id, file_path, status, tokens_used, {_FIELDS}, error, created_at FROM results")
def status_class(spark, sf):
    return fx.results(spark, sf).drop("raw_response")


@query("nested_results", f"WITH {o.RESULTS} SELECT contract_id, status, opening_quote, license_line, has_flag = 1 AS has_flag FROM results")
def nested_results(spark, sf):
    nested = rp.extraction_results(fx.responses(spark, sf), fx.FIELDS)
    return nested.select("contract_id", "status", "sla.opening_quote", "sla.license_line", "sla.has_flag")


_ROW = "contract_id, file_path, status, tokens_used, opening_quote, spaced_quote, invented, license_line, has_flag, max_amount, raw_response, error"


_UPSERTED = f"""WITH {o.RESULTS}
SELECT contract_id, status, CASE WHEN doc_id % 4 = 0 AND status <> 'failed' THEN tokens_used + 1 ELSE tokens_used END AS tokens_used,
       CASE WHEN doc_id % 4 = 0 THEN created_at + INTERVAL 1 DAY ELSE created_at END AS created_at FROM results"""


@query("upsert_latest", _UPSERTED)
def upsert_latest(spark, sf):
    """A second batch that also repeats the first one's rows: older versions inside a batch lose."""
    first = session.written(fx.responses(spark, sf), "responses")
    again = fx.answered_again(first)
    outdated = first.where(F.col("doc_id") % 4 == 0)
    same_time = again.withColumn("tokens_used", F.col("tokens_used") + 7)  # written before ``again``: only the sequence tells
    batches = [rp.result_rows(rows, fx.FIELDS).withColumn("seq", F.lit(i)) for i, rows in ((3, outdated), (1, same_time), (2, again))]
    new = batches[0].unionByName(batches[1]).unionByName(batches[2])
    merged = rs.upsert(rp.result_rows(first, fx.FIELDS), new, "seq")
    return merged.select("contract_id", "status", "tokens_used", "created_at")


@query("snapshot_table", _UPSERTED)
def snapshot_table(spark, sf):
    """Batches merged into a snapshot table: the second one twice, then rows that are older than those stored."""
    path = session.new_folder(spark, "snapshots")
    first = session.written(fx.responses(spark, sf), "responses")
    again = rp.result_rows(fx.answered_again(first), fx.FIELDS)
    sn.create(spark, path, 16, fx.FIELDS)
    sn.merge(rp.result_rows(first, fx.FIELDS), path, "first", 0, fx.FIELDS)
    sn.merge(again, path, "second", 0, fx.FIELDS)
    sn.merge(again, path, "second", 0, fx.FIELDS)
    sn.merge(rp.result_rows(first.where(F.col("doc_id") % 4 == 0), fx.FIELDS), path, "second", 1, fx.FIELDS)
    return sn.read(spark, path, fx.FIELDS).select("contract_id", "status", "tokens_used", "created_at")


@query("result_table", f"""WITH {o.RESULTS}
SELECT contract_id, status, CASE WHEN doc_id % 4 = 0 AND status <> 'failed' THEN tokens_used + 1 ELSE tokens_used END AS tokens_used FROM results""")
def result_table(spark, sf):
    """Two batches written to a stored table, the second one twice; read back as the latest rows."""
    path = session.new_folder(spark, "results")
    rs.create(spark, path, fx.FIELDS)
    rs.append_batch(fx.results(spark, sf), path, "first", 0)
    second = rp.result_rows(fx.second_batch(spark, sf), fx.FIELDS)
    rs.append_batch(second, path, "second", 0)
    rs.append_batch(second, path, "second", 0)
    return rs.read_latest(spark, path, fx.FIELDS).select("contract_id", "status", "tokens_used")


@query("result_schema", f"WITH {o.SLA} SELECT count(*) AS n_rows, 25 AS n_columns FROM sla")
def result_schema_query(spark, sf):
    """The derived results, written under the declared schema of the full table."""
    path = session.new_folder(spark, "schema")
    rs.reset(spark, path)
    rs.append_batch(fx.sla_results(spark, sf), path, "all", 0)
    stored = rs.read_latest(spark, path)
    n_columns = len([c for c in stored.columns if c in result_schema().names])
    return stored.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(n_columns))


@query("processed_ids", f"WITH {o.RESULTS} SELECT DISTINCT contract_id FROM results")
def processed_ids(spark, sf):
    return rs.processed_ids(fx.results(spark, sf))


@query("export_jsonl", f"""WITH {o.RESULTS}
SELECT CAST(to_json({{'contract_id': contract_id, 'file_path': file_path, 'status': status, 'tokens_used': tokens_used, 'opening_quote': opening_quote,
  'spaced_quote': spaced_quote, 'invented': invented, 'license_line': license_line, 'has_flag': has_flag, 'max_amount': max_amount,
  'raw_response': raw_response, 'error': error}}) AS VARCHAR) AS line FROM results""")
def export_jsonl(spark, sf):
    return rs.as_json_lines(fx.results(spark, sf).drop("created_at"))


@query("export_jsonl_files", f"WITH {o.RESULTS} SELECT {_ROW}, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM results")
def export_jsonl_files(spark, sf):
    """The JSON Lines export, read back."""
    path = session.new_folder(spark, "jsonl")
    rows = fx.results(spark, sf)
    rs.export_json_lines(rows, path)
    schema = ", ".join(f"{f.name} {'string' if f.name == 'created_at' else f.dataType.simpleString()}" for f in rows.schema)
    return spark.read.schema(schema).json(path)


@query("export_csv", f"""WITH {o.RESULTS} SELECT contract_id, file_path, status, tokens_used, opening_quote, spaced_quote, invented, license_line, has_flag,
       max_amount, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM results""")
def export_csv(spark, sf):
    """The CSV export, read back."""
    path = session.new_folder(spark, "csv")
    rows = fx.results(spark, sf)
    rs.export_csv(rows, path)
    kept = rows.drop("raw_response", "error")
    schema = ", ".join(f"{f.name} {'string' if f.name == 'created_at' else f.dataType.simpleString()}" for f in kept.schema)
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


_FAILURES = f"""WITH {o.RESULTS}
SELECT contract_id AS id, 'text too short' AS error FROM docs WHERE length(clean_text) < 100
UNION ALL SELECT contract_id, error FROM results WHERE status = 'failed'"""


@query("failure_log", _FAILURES)
def failure_log(spark, sf):
    return rs.failure_log(ct.too_short(fx.contracts(spark, sf)), fx.results(spark, sf))


@query("failure_log_stored", _FAILURES)
def failure_log_stored(spark, sf):
    """The log as it is written and read back, in place of an earlier, empty one."""
    path = session.new_folder(spark, "failures")
    log = failure_log(spark, sf)
    rs.write_failures(log.where("false"), path)
    rs.write_failures(log, path)
    return rs.read_failures(spark, path)


@query("resume_pending", f"""WITH {o.RESULTS}
SELECT contract_id, doc_id FROM docs WHERE contract_id NOT IN (SELECT contract_id FROM results WHERE doc_id % 3 <> 0)""")
def resume_pending(spark, sf):
    """A run that stored two thirds of its results, resumed: failed rows are done, short texts come again."""
    stored = fx.results(spark, sf).where(F.col("contract_id").cast("long") % 3 != 0)
    return rs.pending(fx.contracts(spark, sf).select("contract_id", "doc_id"), stored)


@query("retry_failed", f"""WITH {o.RESULTS}
SELECT contract_id, status FROM (
  SELECT contract_id, CASE WHEN status = 'failed' THEN 'partial' ELSE status END AS status FROM results)""")
def retry_failed(spark, sf):
    """Failed contracts get a new, repaired response; the rest of the table stays."""
    results = fx.results(spark, sf)
    failures = rs.failure_log(ct.too_short(fx.contracts(spark, sf)), results)
    again = rs.retry(fx.responses(spark, sf), failures).withColumn("raw_response", F.lit('{"invented": "repaired"}'))
    rows = rp.result_rows(again.withColumn("created_at", F.col("created_at") + F.expr("interval 1 day")), fx.FIELDS)
    return rs.upsert(results, rows.withColumn("seq", F.lit(1)), "seq").select("contract_id", "status")


@query("inspect_contract", f"""WITH {o.RESULTS},
one AS (SELECT * FROM results WHERE contract_id = '10'),
rows AS (SELECT contract_id, 0 AS field_no, 'opening_quote' AS field, opening_quote AS v FROM one UNION ALL SELECT contract_id, 1, 'spaced_quote', spaced_quote FROM one
  UNION ALL SELECT contract_id, 2, 'invented', invented FROM one UNION ALL SELECT contract_id, 3, 'license_line', license_line FROM one
  UNION ALL SELECT contract_id, 4, 'has_flag', CAST(has_flag AS VARCHAR) FROM one UNION ALL SELECT contract_id, 5, 'max_amount', max_amount FROM one)
SELECT contract_id, field_no, field, CASE WHEN v IS NOT NULL AND v NOT IN ('', '0') THEN 'Y' ELSE '-' END AS marker,
  CASE WHEN v IS NOT NULL AND v NOT IN ('', '0') THEN substring(v, 1, 50) || CASE WHEN length(v) > 50 THEN '...' ELSE '' END END AS preview FROM rows""")
def inspect_contract(spark, sf):
    return ins.inspect_contract(fx.results(spark, sf), "10", fx.FIELDS, size=50)


@query("list_contracts", f"""WITH {o.RESULTS} SELECT contract_id, status, coalesce(tokens_used, 0) AS tokens_used, coalesce(populated, 0) AS n_fields FROM results ORDER BY contract_id""")
def list_contracts(spark, sf):
    return ins.list_contracts(fx.results(spark, sf), fx.FIELDS)


@query("raw_preview", f"""WITH {o.RESULTS},
one AS (SELECT * FROM results WHERE contract_id = '10')
SELECT contract_id, key, substring(v, 1, 100) || CASE WHEN length(v) > 100 THEN '...' ELSE '' END AS preview FROM (
  SELECT contract_id, unnest(['opening_quote', 'spaced_quote', 'invented', 'license_line', 'has_flag', 'max_amount']) AS key,
         unnest([opening_quote, spaced_quote, invented, license_line, CASE WHEN has_flag = 1 THEN 'true' END, max_amount]) AS v FROM one) WHERE v <> ''""")
def raw_preview(spark, sf):
    return rp.raw_preview(fx.results(spark, sf), "10")


@query("cash_penalties", f"""WITH {o.SLA} SELECT contract_id, penalty_max_amount, penalty_currency, penalty_uptime_breach FROM sla
WHERE penalty_has_monetary = 1 ORDER BY penalty_max_amount DESC NULLS LAST, contract_id""")
def cash_penalties(spark, sf):
    return ins.cash_penalties(fx.sla_results(spark, sf))


@query("presence_filters", f"""WITH {o.SLA}
SELECT 'uptime_penalty' AS filter, contract_id, penalty_uptime_breach AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3 FROM sla WHERE penalty_uptime_breach IS NOT NULL
UNION ALL SELECT 'uptime', contract_id, uptime_guarantee, sla_breach_threshold, sla_measurement_period FROM sla WHERE uptime_guarantee IS NOT NULL
UNION ALL SELECT 'late_payment', contract_id, penalty_late_payment, NULL, NULL FROM sla WHERE penalty_late_payment IS NOT NULL""")
def presence_filters(spark, sf):
    sla, no = fx.sla_results(spark, sf), F.lit(None).cast("string")
    first = ins.having(sla, "penalty_uptime_breach").toDF("contract_id", "v1").select(F.lit("uptime_penalty").alias("filter"), "*", no.alias("v2"), no.alias("v3"))
    second = ins.having(sla, "uptime_guarantee", "sla_breach_threshold", "sla_measurement_period").toDF("contract_id", "v1", "v2", "v3")
    third = ins.having(sla, "penalty_late_payment").toDF("contract_id", "v1").select(F.lit("late_payment").alias("filter"), "*", no.alias("v2"), no.alias("v3"))
    return first.unionByName(second.select(F.lit("uptime").alias("filter"), "*")).unionByName(third)


@query("next_candidates", f"""WITH {o.RESULTS} SELECT contract_id FROM docs WHERE contract_id NOT IN (SELECT contract_id FROM results) ORDER BY contract_id LIMIT 3""")
def next_candidates(spark, sf):
    return ins.next_candidates(fx.contracts(spark, sf), fx.results(spark, sf), 3)


@query("penalty_over", f"""WITH {o.SLA} SELECT contract_id, penalty_max_amount, amount FROM (SELECT contract_id, penalty_max_amount,
  CASE (contract_id::BIGINT // 10) % 5 WHEN 0 THEN contract_id::BIGINT * 100 WHEN 1 THEN contract_id::BIGINT * 1000 + 500
       WHEN 2 THEN contract_id::BIGINT * 10 WHEN 4 THEN contract_id::BIGINT * 1000 END::DOUBLE AS amount
  FROM sla WHERE penalty_max_amount IS NOT NULL) WHERE amount > 30000""")
def penalty_over(spark, sf):
    return pl.penalty_over(fx.sla_results(spark, sf), 30000).withColumn("amount", F.col("amount").cast("double"))


@query("validate_rules", f"""WITH {o.SLA},
j AS (SELECT contract_id, CASE WHEN coalesce(uptime_guarantee, '') = '' AND coalesce(penalty_uptime_breach, '') = '' THEN 'no critical field' END AS a,
  CASE WHEN coalesce(uptime_guarantee, '') <> '' AND NOT contains(uptime_guarantee, '%') THEN 'uptime without percentage' END AS b,
  CASE WHEN tokens_used < 4000 THEN 'low confidence' END AS c FROM sla)
SELECT contract_id, a IS NULL AND b IS NULL AND c IS NULL AS valid, concat_ws('; ', a, b, c) AS issues FROM j""")
def validate_rules(spark, sf):
    confidence = F.when(F.col("tokens_used") < 4000, "low").otherwise("high")
    return pl.validate_rules(fx.sla_results(spark, sf).withColumn("confidence", confidence))


@query("plan_filters", f"""WITH {o.SLA} SELECT contract_id, uptime_guarantee FROM sla WHERE uptime_guarantee IS NOT NULL AND uptime_guarantee NOT LIKE '%the of%'""")
def plan_filters(spark, sf):
    return pl.plan_filters(fx.sla_results(spark, sf), "uptime_guarantee", "%the of%")


# --- figures over the result table ---------------------------------------------------


def _sixed(df, *columns):
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("status_counts", f"WITH {o.SLA} SELECT status, count(*) AS n FROM sla GROUP BY status")
def status_counts(spark, sf):
    return st.status_counts(fx.sla_results(spark, sf))


@query("token_usage", f"WITH {o.SLA} SELECT CAST(sum(tokens_used) AS BIGINT) AS total_tokens, round(sum(tokens_used) / greatest(count(*), 1), 6) AS avg_tokens FROM sla")
def token_usage(spark, sf):
    return _sixed(st.token_usage(fx.sla_results(spark, sf)), "avg_tokens")


@query("time_span", f"WITH {o.SLA} SELECT min(created_at) AS first_at, max(created_at) AS last_at FROM sla")
def time_span(spark, sf):
    return st.time_span(fx.sla_results(spark, sf))


def _coverage(columns: list[str], digits: int) -> str:
    return f"WITH {o.SLA} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, {f'count({c})' if c in fx.RENAMED or c == 'penalty_currency' else 0} AS filled, count(*) AS total, "
        f"round({f'count({c})' if c in fx.RENAMED or c == 'penalty_currency' else 0} * 100.0 / count(*), {digits}) AS percent FROM sla" for c in columns)


@query("field_coverage", _coverage(names(SLA_FIELDS), 6))
def field_coverage(spark, sf):
    return st.field_coverage(fx.sla_results(spark, sf), names(SLA_FIELDS), 6)


_CHOSEN = ["termination_clause", "governing_law", "liability_cap", "penalty_has_monetary", "penalty_late_payment", "dispute_resolution"]


@query("coverage_frame", _coverage(_CHOSEN, 1))
def coverage_frame(spark, sf):
    return st.field_coverage(fx.sla_results(spark, sf), _CHOSEN, 1)


@query("penalty_profile", f"""WITH {o.SLA}, c AS (SELECT count(*) FILTER (WHERE penalty_has_monetary = 1) AS cash, count(*) FILTER (WHERE penalty_has_monetary = 0) AS credits_only,
  count(*) FILTER (WHERE penalty_has_monetary IS NULL) AS none, count(*) AS n FROM sla)
SELECT cash, credits_only, none, round(cash * 100.0 / n, 6) AS cash_percent, round(credits_only * 100.0 / n, 6) AS credits_only_percent, round(none * 100.0 / n, 6) AS none_percent FROM c""")
def penalty_profile(spark, sf):
    return _sixed(st.penalty_profile(fx.sla_results(spark, sf)), "cash_percent", "credits_only_percent", "none_percent")


@query("coverage_wide", f"""WITH {o.SLA} SELECT count(uptime_guarantee) AS has_uptime, count(penalty_uptime_breach) AS has_uptime_penalty,
  count(penalty_has_monetary) AS has_any_penalty, CAST(sum(penalty_has_monetary) AS BIGINT) AS has_cash_penalty, count(*) AS total FROM sla""")
def coverage_wide(spark, sf):
    return st.coverage_wide(fx.sla_results(spark, sf))


@query("cost_bands", f"""WITH {o.SLA}, t AS (SELECT CAST(sum(tokens_used) AS BIGINT) AS n FROM sla)
SELECT band, n AS total_tokens, round(n * rate / 1000000, 6) AS cost FROM t, (VALUES ('min', 0.27), ('blended', 0.40), ('max', 1.10)) r(band, rate)""")
def cost_bands(spark, sf):
    return _sixed(st.cost_bands(fx.sla_results(spark, sf)), "cost")


@query("batch_summary", f"""WITH {o.RESULTS}
SELECT count(*) FILTER (WHERE status <> 'failed') AS n_success,
  count(*) FILTER (WHERE status = 'failed') + (SELECT count(*) FROM docs WHERE length(clean_text) < 100) AS n_failed,
  CAST(sum(tokens_used) AS BIGINT) AS total_tokens, round(CAST(sum(tokens_used) AS DOUBLE) * 0.14 / 1000000, 6) AS estimated_cost FROM results""")
def batch_summary(spark, sf):
    results = fx.results(spark, sf)
    failures = rs.failure_log(ct.too_short(fx.contracts(spark, sf)), results)
    return _sixed(st.batch_summary(results, failures), "estimated_cost")


_SIZE = 200_000


@query("progress_eta", f"""WITH {o.SLA}, s AS (SELECT count(*) AS done, date_diff('second', min(created_at), max(created_at)) AS elapsed_sec FROM sla)
SELECT done, elapsed_sec, {_SIZE} - done AS remaining, round(done * 100.0 / {_SIZE}, 6) AS percent, round(done / elapsed_sec, 6) AS rate_per_sec,
       round(({_SIZE} - done) / (done / elapsed_sec), 6) AS eta_sec FROM s""")
def progress_eta(spark, sf):
    return _sixed(st.progress_eta(fx.sla_results(spark, sf), _SIZE), "percent", "rate_per_sec", "eta_sec")


@query("recent_rate", f"""WITH {o.SLA}, r AS (SELECT created_at FROM sla ORDER BY created_at DESC, contract_id DESC LIMIT 20),
s AS (SELECT count(*) AS n_recent, date_diff('second', min(created_at), max(created_at)) AS span_sec FROM r), t AS (SELECT count(*) AS done FROM sla)
SELECT n_recent, span_sec, round((n_recent - 1) / span_sec, 6) AS rate_per_sec, {_SIZE} - done AS remaining,
       round(({_SIZE} - done) / ((n_recent - 1) / span_sec), 6) AS eta_sec FROM s, t""")
def recent_rate(spark, sf):
    return _sixed(st.recent_rate(fx.sla_results(spark, sf), corpus_size=_SIZE), "rate_per_sec", "eta_sec")


_PRICES = {"ours": ("0.40", "0.90"), "theirs": ("2.00", "6.50")}  # any table of input and output prices


@query("provider_cost", f"""WITH {o.SLA}, u AS (SELECT count(*) AS n, sum(tokens_used - tokens_used // 4) AS i, sum(tokens_used // 4) AS o FROM sla),
c AS (SELECT provider, n, (i * pi + o * po) / 1000000 AS cost, (i * 0.40 + o * 0.90) / 1000000 AS base FROM u,
  (VALUES ('ours', 0.40, 0.90), ('theirs', 2.00, 6.50)) p(provider, pi, po))
SELECT provider, round(CAST(cost AS DOUBLE), 6) AS cost, round(CAST(cost AS DOUBLE) / CAST(base AS DOUBLE), 6) AS multiplier,
       round(CAST(cost AS DOUBLE) * 10000 / n, 6) AS scaled_cost FROM c""")
def provider_cost(spark, sf):
    output = F.floor(F.col("tokens_used") / 4).cast("long")
    usage = fx.sla_results(spark, sf).select((F.col("tokens_used") - output).alias("input_tokens"), output.alias("output_tokens"))
    return pl.provider_cost(usage, 10_000, _PRICES, "ours")
