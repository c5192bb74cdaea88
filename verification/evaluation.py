"""Scores and the reports over them; streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from clauseloom import session
from clauseloom.fields import BOOLEAN, PRESENCE
from clauseloom.operators import responses as rp
from clauseloom.operators import scoring as sc
from clauseloom.plans import evaluation as ev
from clauseloom.sources import contracts as ct
from clauseloom.sources import reports as rep
from clauseloom.sources import results as rs
from clauseloom.streaming import ingest, throughput

from . import fixture as fx
from . import oracle_parts as o
from .registry import query


def _scored(spark, sf):
    return sc.score_results(fx.results(spark, sf), fx.ready_by_contract(spark, sf), fx.FIELDS)


@query("field_scores", f"WITH {o.SCORES} SELECT contract_id, field, score FROM scores")
def field_scores(spark, sf):
    return sc.field_scores(_scored(spark, sf)).select("contract_id", "field", "score")


INVENTED_END = " and an end that no document has"
_WHOLE = "trim(lower(value), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_FULLY_QUOTED = rf"""SELECT contract_id, field, CASE WHEN value <> '' THEN
  src_clean <> '' AND (contains(src_clean, {_WHOLE}) OR contains(src_ws, regexp_replace({_WHOLE}, '\s+', ' ', 'g'))) END AS fully_quoted
FROM (""" + " UNION ALL ".join(
    f"SELECT contract_id, src_clean, src_ws, '{name}' AS field, {value} AS value FROM sourced" for name, value in (
        ("opening_quote", f"CASE WHEN contract_id::BIGINT % 2 = 0 THEN opening_quote || '{INVENTED_END}' ELSE opening_quote END"),
        ("spaced_quote", "spaced_quote"), ("invented", "invented"), ("license_line", "license_line"))) + ")"


@query("fully_quoted", f"WITH {o.SCORES} {_FULLY_QUOTED}")
def fully_quoted(spark, sf):
    """Openings of 130 characters, of which every other one gets an invented end."""
    ended = F.when(F.col("contract_id").cast("long") % 2 == 0, F.concat("opening_quote", F.lit(INVENTED_END))).otherwise(F.col("opening_quote"))
    rows = fx.results(spark, sf).withColumn("opening_quote", ended)
    scored = sc.score_results(rows, fx.ready_by_contract(spark, sf), [f for f in fx.FIELDS if f.kind not in (BOOLEAN, PRESENCE)])
    return sc.field_scores(scored).select("contract_id", "field", "fully_quoted")


@query("contract_scores", f"WITH {o.SCORES} SELECT contract_id, false AS is_non_contract, round(overall, 6) AS overall, missed FROM per_contract")
def contract_scores(spark, sf):
    return _scored(spark, sf).select("contract_id", "is_non_contract", F.round("overall", 6).alias("overall"), "missed")


_FIELD = """SELECT field, round(coalesce(avg(score) FILTER (WHERE score > 0), 0.0), 6) AS avg_score, count(*) FILTER (WHERE score > 0) AS extracted,
  count(*) FILTER (WHERE score = 0) AS missed, count(*) FILTER (WHERE score IS NULL) AS absent FROM scores GROUP BY field"""


@query("field_summary", f"WITH {o.SCORES} {_FIELD}")
def field_summary(spark, sf):
    return ev.field_summary(_scored(spark, sf)).withColumn("avg_score", F.round("avg_score", 6))


_SUMMARY = """SELECT count(*) AS n_contracts, 0 AS n_excluded, round(avg(overall), 6) AS avg_overall, count(*) FILTER (WHERE overall >= 0.8) AS score_gte_0_8,
  count(*) FILTER (WHERE overall >= 0.7) AS score_gte_0_7, count(*) FILTER (WHERE overall >= 0.5) AS score_gte_0_5 FROM per_contract"""


@query("eval_summary", f"WITH {o.SCORES} {_SUMMARY}")
def eval_summary(spark, sf):
    return ev.eval_summary(_scored(spark, sf)).withColumn("avg_overall", F.round("avg_overall", 6))


@query("eval_summary_without", f"WITH {o.SCORES} {_SUMMARY} WHERE contract_id <> '0'")
def eval_summary_without(spark, sf):
    return ev.eval_summary(_scored(spark, sf), without="0").withColumn("avg_overall", F.round("avg_overall", 6))


_PAPERS = o.SCORES.replace("lower(clean_text) AS src_clean", "lower(CASE WHEN doc_id % 6 = 0 THEN 'arXiv:2401.1 ' || clean_text ELSE clean_text END) AS src_clean") + """,
kinds AS (SELECT contract_id, contains(substring(src_clean, 1, 1000), 'arxiv:') OR contains(substring(src_clean, 1, 1000), 'datasheet for contract understanding')
            OR contains(substring(src_clean, 1, 1000), 'abstract' || chr(10) || 'we present')
            OR contains(substring(src_clean, 1, 1000), 'i.motivation' || chr(10) || 'a. who created') AS is_non_contract FROM sourced)"""


def _with_papers(spark, sf):
    """Scores where every sixth text is a paper."""
    texts = fx.ready_by_contract(spark, sf)
    paper = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("arXiv:2401.1 "), "clean_text")).otherwise(F.col("clean_text"))
    return sc.score_results(fx.results(spark, sf), texts.withColumn("clean_text", paper), fx.FIELDS)


@query("eval_summary_excluded", f"""WITH {_PAPERS}
SELECT count(*) FILTER (WHERE NOT is_non_contract) AS n_contracts, count(*) FILTER (WHERE is_non_contract) AS n_excluded, round(avg(overall) FILTER (WHERE NOT is_non_contract), 6) AS avg_overall,
  count(*) FILTER (WHERE overall >= 0.8 AND NOT is_non_contract) AS score_gte_0_8, count(*) FILTER (WHERE overall >= 0.7 AND NOT is_non_contract) AS score_gte_0_7,
  count(*) FILTER (WHERE overall >= 0.5 AND NOT is_non_contract) AS score_gte_0_5 FROM per_contract JOIN kinds USING (contract_id)""")
def eval_summary_excluded(spark, sf):
    return ev.eval_summary(_with_papers(spark, sf)).withColumn("avg_overall", F.round("avg_overall", 6))


@query("field_summary_excluded", f"""WITH {_PAPERS}, real AS (SELECT scores.* FROM scores JOIN kinds USING (contract_id) WHERE NOT is_non_contract)
{_FIELD.replace("FROM scores", "FROM real")}""")
def field_summary_excluded(spark, sf):
    return ev.field_summary(_with_papers(spark, sf)).withColumn("avg_score", F.round("avg_score", 6))


@query("non_contracts", f"WITH {_PAPERS} SELECT contract_id FROM kinds WHERE is_non_contract")
def non_contracts(spark, sf):
    return sc.excluded(_with_papers(spark, sf))


@query("eval_first_results", f"WITH {o.SCORES} {_SUMMARY} WHERE contract_id IN (SELECT contract_id FROM per_contract ORDER BY contract_id LIMIT 25)")
def eval_first_results(spark, sf):
    """A quick evaluation of the first 25 results by id."""
    scored = sc.score_results(ev.first_results(fx.results(spark, sf), 25), fx.ready_by_contract(spark, sf), fx.FIELDS)
    return ev.eval_summary(scored).withColumn("avg_overall", F.round("avg_overall", 6))


@query("eval_extremes", f"""WITH {o.SCORES},
low AS (SELECT 'lowest' AS side, contract_id, overall FROM per_contract ORDER BY overall, contract_id LIMIT 3),
high AS (SELECT 'highest' AS side, contract_id, overall FROM per_contract ORDER BY overall DESC, contract_id DESC LIMIT 3)
SELECT side, p.contract_id, round(p.overall, 6) AS overall, coalesce(string_agg(s.field, ',' ORDER BY s.field), '') AS fields FROM low p
  LEFT JOIN scores s ON s.contract_id = p.contract_id AND s.score = 0 GROUP BY ALL
UNION ALL SELECT side, p.contract_id, round(p.overall, 6), coalesce(string_agg(s.field, ',' ORDER BY s.field), '') FROM high p
  LEFT JOIN scores s ON s.contract_id = p.contract_id AND s.score >= 0.8 GROUP BY ALL""")
def eval_extremes(spark, sf):
    return ev.eval_extremes(_scored(spark, sf), 3).withColumn("overall", F.round("overall", 6))


@query("score_histogram", f"""WITH {o.SCORES}, levels AS (SELECT * FROM (VALUES (1.0, '1.0'), (0.8, '0.8'), (0.6, '0.6'), (0.4, '0.4'), (0.0, '0.0'), (NULL, 'null')) l(v, name))
SELECT name AS score, (SELECT count(*) FROM scores s WHERE s.score IS NOT DISTINCT FROM CAST(l.v AS DOUBLE)) AS n_pairs FROM levels l""")
def score_histogram(spark, sf):
    return ev.score_histogram(_scored(spark, sf))


def _near_sql(cut: str, first: str) -> str:
    return f"""WITH {o.SCORES}
SELECT s.contract_id, field, contains(src_ws, regexp_replace(trim(lower(substring(value, 1, 80))), '\\s+', ' ', 'g')) AS ws_match,
       {cut.format("trim(lower(substring(value, 1, 80)))")} AS snippet
FROM scores s JOIN sourced USING (contract_id) WHERE score = 0.6 AND value <> '' {first}"""


@query("near_misses", _near_sql("{}", ""))
def near_misses(spark, sf):
    return ev.near_misses(_scored(spark, sf))


@query("near_misses_first", _near_sql("substring({}, 1, 50)", "ORDER BY s.contract_id, field LIMIT 10"))
def near_misses_first(spark, sf):
    """The top of the list, cut for display."""
    return ev.near_misses(_scored(spark, sf), 10, 50)


def _unverifiable_sql(snippet: str, first: str) -> str:
    return f"WITH {o.SCORES} SELECT contract_id, field, {snippet} AS snippet FROM scores WHERE score = 0.4 AND value <> '' {first}"


@query("unverifiable", _unverifiable_sql("value", ""))
def unverifiable(spark, sf):
    return ev.unverifiable(_scored(spark, sf))


@query("unverifiable_first", _unverifiable_sql("substring(value, 1, 60)", "ORDER BY contract_id, field LIMIT 8"))
def unverifiable_first(spark, sf):
    return ev.unverifiable(_scored(spark, sf), 8, 60)


@query("missed_by_field", f"WITH {o.SCORES} SELECT field, count(*) AS n_missed FROM scores WHERE score = 0 GROUP BY field")
def missed_by_field(spark, sf):
    return ev.missed_by_field(_scored(spark, sf))


@query("eval_leaderboard", f"WITH {o.SCORES} SELECT contract_id, round(overall, 6) AS overall, extracted, missed FROM per_contract")
def eval_leaderboard(spark, sf):
    return ev.leaderboard(_scored(spark, sf)).withColumn("overall", F.round("overall", 6))


@query("eval_report", f"""WITH {o.SCORES}, f AS ({_FIELD}), s AS ({_SUMMARY})
SELECT n_contracts, avg_overall, score_gte_0_8, score_gte_0_7, score_gte_0_5, field, avg_score, extracted, missed, absent FROM s, f""")
def eval_report(spark, sf):
    """The report row, its map of fields laid out for comparison."""
    report = ev.eval_report(_scored(spark, sf), fx.FIELDS)
    flat = report.select("*", F.explode("per_field").alias("field", "v")).select(*report.columns[:-1], "field", "v.*")
    return flat.withColumn("avg_overall", F.round("avg_overall", 6)).withColumn("avg_score", F.round("avg_score", 6))


@query("report_flatten", f"WITH {o.SCORES} SELECT contract_id, round(overall, 6) AS overall, field, score FROM scores JOIN per_contract USING (contract_id)")
def report_flatten(spark, sf):
    """The report written to disk and read back."""
    path = session.new_folder(spark, "report")
    rep.write_report(_scored(spark, sf), path, fx.FIELDS)
    return rep.flatten_report(rep.read_per_contract(spark, path)).withColumn("overall", F.round("overall", 6))


def _events(spark, sf):
    return fx.read(spark, sf, "events")


@query("stream_throughput", """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n, round(count(*) / 3600, 6) AS rate_per_sec FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1""")
def stream_throughput(spark, sf):
    """Events per hour as a stream; the last open window is not emitted."""
    events = (spark.readStream.schema(_events(spark, sf).schema).option("pathGlobFilter", "*.parquet").parquet(fx.stream_folder(sf, "events")))
    path = session.new_folder(spark, "throughput")
    throughput.run_to_table(throughput.throughput(events, F.col("ts")), path, session.new_folder(spark, "throughput-checkpoint"))
    return spark.read.parquet(path)


@query("throughput_batch", "SELECT date_trunc('hour', ts) AS window_start, count(*) AS n, round(count(*) / 3600, 6) AS rate_per_sec FROM events GROUP BY 1")
def throughput_batch(spark, sf):
    return throughput.throughput_batch(_events(spark, sf), F.col("ts"))


@query("stream_ingest", f"WITH {o.RESULTS} SELECT contract_id, status, tokens_used FROM results")
def stream_ingest(spark, sf):
    """The documents table ingested as new files, twice on one checkpoint; the second run finds nothing new."""
    table, checkpoint = session.new_folder(spark, "ingested"), session.new_folder(spark, "ingest-checkpoint")
    schema = fx.read(spark, sf, "documents").schema

    def to_results(batch):
        docs = batch.select(F.col("doc_id").cast("string").alias("contract_id"), "text", "doc_id")
        return rp.result_rows(fx.respond(ct.ready(docs)), fx.FIELDS)

    for _ in range(2):
        ingest.ingest_new_files(spark, fx.stream_folder(sf, "documents"), schema, to_results, table, checkpoint)
    return rs.read_latest(spark, table, fx.FIELDS).select("contract_id", "status", "tokens_used")


@query("ingest_into_existing", f"WITH {o.RESULTS} SELECT contract_id, status, tokens_used FROM results")
def ingest_into_existing(spark, sf):
    """A stored batch with number 0, then two streams with checkpoints of their own: nobody's rows are lost."""
    table = session.new_folder(spark, "existing")
    schema = fx.read(spark, sf, "documents").schema
    rs.append_batch(fx.results(spark, sf).where(F.col("contract_id").cast("long") % 2 == 0), table, "stored", 0)

    def to_results(part):
        def convert(batch):
            docs = batch.where(F.col("doc_id") % 4 == part).select(F.col("doc_id").cast("string").alias("contract_id"), "text", "doc_id")
            return rp.result_rows(fx.respond(ct.ready(docs)), fx.FIELDS)
        return convert

    for part in (1, 3):
        ingest.ingest_new_files(spark, fx.stream_folder(sf, "documents"), schema, to_results(part), table, session.new_folder(spark, "checkpoint"))
    return rs.read_latest(spark, table, fx.FIELDS).select("contract_id", "status", "tokens_used")
