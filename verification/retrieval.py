"""Weights, retrieval, context, prompts, rule extraction, dense vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from clauseloom.operators import chunking as ch
from clauseloom.operators import extraction as ex
from clauseloom.operators import prompts as pr
from clauseloom.operators import retrieval as rt
from clauseloom.operators import vectors as ve
from clauseloom.operators import weights as wt
from clauseloom.plans import batch
from clauseloom.plans import planned as pl
from clauseloom import fixed_values as fv
from clauseloom.functions import text as tx
from clauseloom.fields import SLA_FIELDS, TEXT
from clauseloom.session import written
from clauseloom.operators import scoring as sc

from . import fixture as fx
from . import oracle_parts as o
from .registry import query
from .texts import OVERLAP, SIZE

K = 5


def _chunks(spark, sf, size=SIZE, overlap=OVERLAP):
    return ch.chunk(fx.ready_by_contract(spark, sf), size, overlap)


def _seen(spark, sf, k=K):
    chunks = _chunks(spark, sf)
    return rt.retrieved(chunks, fx.benchmark_queries(spark, sf), k)


_CHUNKS = o.chunks(SIZE, OVERLAP)
_TOP = f"WITH RECURSIVE {_CHUNKS}, {o.BENCHMARK}, "


def _contexts(spark, sf, k=K):
    return rt.retrieve(_chunks(spark, sf), fx.benchmark_queries(spark, sf), k)


@query("chunk_term_weights", f"""WITH RECURSIVE {_CHUNKS}, {o.WEIGHTS}
SELECT contract_id, chunk_idx, term, tf, df, round(weight, 6) AS weight FROM weights""")
def chunk_term_weights(spark, sf):
    weights = wt.chunk_term_weights(_chunks(spark, sf))
    return weights.withColumn("weight", F.round("weight", 6))


@query("retrieve_topk", f"{_TOP}{o.ranked(K)} SELECT contract_id, query_idx, chunk_idx, rank, round(similarity, 6) AS similarity FROM ranked")
def retrieve_topk(spark, sf):
    ranked = rt.rank_chunks(_chunks(spark, sf), fx.benchmark_queries(spark, sf), K)
    return ranked.withColumn("similarity", F.round("similarity", 6))


@query("retrieve_top2", f"{_TOP}{o.ranked(2)} SELECT contract_id, query_idx, chunk_idx, rank, round(similarity, 6) AS similarity FROM ranked")
def retrieve_top2(spark, sf):
    ranked = rt.rank_chunks(_chunks(spark, sf), fx.benchmark_queries(spark, sf), 2)
    return ranked.withColumn("similarity", F.round("similarity", 6))


@query("retrieve_dedup", f"{_TOP}{o.seen(K)} SELECT contract_id, seen, chunk_text, seen // {K} AS query_idx, seen % {K} + 1 AS rank FROM seen")
def retrieve_dedup(spark, sf):
    return _seen(spark, sf)


@query("context", f"{_TOP}{o.seen(K)} SELECT contract_id, context, n_chunks FROM contexts")
def context(spark, sf):
    return _contexts(spark, sf)


_SLA_QUERIES = "queries AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{g}', '{t}')" for i, (g, t) in enumerate((g, t) for g, ts in fv.QUERIES.items() for t in ts)
) + ") v(query_idx, query_group, query_text))"


@query("context_default", f"WITH RECURSIVE {o.chunks(512, 64)}, {_SLA_QUERIES}, {o.seen(K)} SELECT contract_id, context, n_chunks FROM contexts")
def context_default(spark, sf):
    """The full plan with the default sizes and the built-in queries."""
    return rt.retrieve(ch.chunk(fx.ready_by_contract(spark, sf)), rt.default_queries(spark))


@query("chunk_profile", f"""{_TOP}{o.seen(K)}
SELECT r.contract_id, length(r.clean_text) AS clean_chars, c.n_chunks, CAST(c.chunk_chars AS BIGINT) AS chunk_chars, length(x.context) AS context_chars
FROM ready r JOIN (SELECT contract_id, count(*) AS n_chunks, sum(length(chunk_text)) AS chunk_chars FROM chunks GROUP BY contract_id) c USING (contract_id)
JOIN contexts x USING (contract_id)""")
def chunk_profile(spark, sf):
    contracts = fx.ready_by_contract(spark, sf)
    chunks = ch.chunk(contracts, SIZE, OVERLAP)
    return ch.chunk_profile(contracts, chunks, rt.retrieve(chunks, fx.benchmark_queries(spark, sf), K))


@query("isolation_check", f"{_TOP}{o.seen(K)} SELECT count(*) AS n_retrieved, 0 AS n_foreign FROM seen")
def isolation_check(spark, sf):
    return rt.isolation_check(_seen(spark, sf), _chunks(spark, sf))


_RELEVANT = f"""qsents AS (SELECT query_idx, trim(unnest(regexp_extract_all({o.clean('query_text')}, '{o.SENTENCE}'))) AS s FROM queries),
csents AS (SELECT contract_id, chunk_idx, trim(unnest(regexp_extract_all(chunk_text, '{o.SENTENCE}'))) AS s FROM chunks),
relevant AS (SELECT DISTINCT c.contract_id, q.query_idx, c.chunk_idx FROM csents c JOIN qsents q ON c.s = q.s WHERE length(q.s) >= 20)"""


@query("query_recall", f"""{_TOP}{o.ranked(K)}, {_RELEVANT},
hit AS (SELECT r.contract_id, r.query_idx, min(k.rank) AS best FROM relevant r LEFT JOIN ranked k USING (contract_id, query_idx, chunk_idx) GROUP BY ALL)
SELECT query_group, count(*) AS n_relevant, count(best) AS n_found, round(count(best) / count(*), 6) AS recall, coalesce(max(best), 0) AS needed_k
FROM hit JOIN queries USING (query_idx) GROUP BY query_group""")
def query_recall(spark, sf):
    """Chunks sharing a whole sentence with a passage are relevant to it."""
    queries, chunks = fx.benchmark_queries(spark, sf), _chunks(spark, sf)
    return rt.query_group_hits(rt.rank_chunks(chunks, queries, K), queries, _relevant(queries, chunks))


def _relevant(queries, chunks):

    def spread(rows, text, *keys):
        return rows.select(*keys, F.explode_outer(tx.sentences(text)).alias("sentence")).where(F.length("sentence") >= 20)

    wanted = spread(queries, tx.clean_text(F.col("query_text")), "query_idx")
    held = spread(chunks, F.col("chunk_text"), "contract_id", "chunk_idx")
    return held.join(wanted, "sentence").select("contract_id", "query_idx", "chunk_idx").distinct()


FEW, MOST, CLOSENESS = 2, 8, 0.1
_GROWN = f"""{o.ranked(MOST)},
stepped AS (SELECT *, round(similarity, 9) AS s, lag(round(similarity, 9)) OVER (PARTITION BY contract_id, query_idx ORDER BY rank) AS before FROM ranked),
grown AS MATERIALIZED (SELECT *, max(CASE WHEN rank > {FEW} AND NOT (s > 0 AND s >= (1 - {CLOSENESS}::DOUBLE) * before) THEN 1 ELSE 0 END)
          OVER (PARTITION BY contract_id, query_idx ORDER BY rank) = 0 AS kept FROM stepped)"""


@query("retrieve_adaptive", f"{_TOP}{_GROWN} SELECT contract_id, query_idx, chunk_idx, rank, round(similarity, 6) AS similarity FROM grown WHERE kept")
def retrieve_adaptive(spark, sf):
    ranked = rt.rank_adaptively(_chunks(spark, sf), fx.benchmark_queries(spark, sf), FEW, MOST, CLOSENESS)
    return ranked.withColumn("similarity", F.round("similarity", 6))


@query("adaptive_gain", f"""{_TOP}{_GROWN}, {_RELEVANT},
pairs AS (SELECT g.contract_id, g.query_idx, count(*) FILTER (rank <= {FEW}) AS n_fixed, count(*) FILTER (kept) AS n_adaptive, count(*) AS n_most,
                 max((rank <= {FEW} AND r.chunk_idx IS NOT NULL)::INT) AS found_fixed, max((kept AND r.chunk_idx IS NOT NULL)::INT) AS found_adaptive,
                 max((r.chunk_idx IS NOT NULL)::INT) AS found_most
          FROM grown g LEFT JOIN relevant r USING (contract_id, query_idx, chunk_idx) GROUP BY ALL)
SELECT query_group, sum(n_fixed)::BIGINT AS n_fixed, sum(n_adaptive)::BIGINT AS n_adaptive, sum(n_most)::BIGINT AS n_most,
       sum(found_fixed)::BIGINT AS found_fixed, sum(found_adaptive)::BIGINT AS found_adaptive, sum(found_most)::BIGINT AS found_most
FROM pairs JOIN queries USING (query_idx) GROUP BY query_group""")
def adaptive_gain(spark, sf):
    """Chunks taken and relevant ones found by two chunks a query, by a growing number and by eight."""
    queries, chunks = fx.benchmark_queries(spark, sf), rt.gathered(_chunks(spark, sf))
    relevant = written(_relevant(queries, rt.spread(chunks)), "relevant")
    adaptive = rt.rank_adaptively(chunks, queries, FEW, MOST, CLOSENESS, relevant)
    return rt.adaptive_gain(rt.rank_chunks(chunks, queries, MOST, relevant=relevant), adaptive, queries, relevant, FEW)


@query("chunk_cap", f"{_TOP}{o.seen(K)} SELECT contract_id, seen, position FROM (SELECT contract_id, seen, row_number() OVER (PARTITION BY contract_id ORDER BY seen) AS position FROM seen) WHERE position <= 25")
def chunk_cap(spark, sf):
    return pl.chunk_cap(_seen(spark, sf), 25).select("contract_id", "seen", "position")


_TEMPLATE = "Fill in {{\"clause\": null}} from:\n{context}\nJSON only."


@query("prompt_messages", f"""{_TOP}{o.seen(K)}
SELECT contract_id, unnest(['system', 'user']) AS role,
       unnest(['{pr.SYSTEM_MESSAGE}', 'Fill in {{"clause": null}} from:' || chr(10) || context || chr(10) || 'JSON only.']) AS content FROM contexts""")
def prompt_messages(spark, sf):
    prompts = pr.messages(_contexts(spark, sf), _TEMPLATE)
    return prompts.select("contract_id", F.explode("messages").alias("m")).select("contract_id", "m.role", "m.content")


_DEFAULT_BEFORE, _DEFAULT_AFTER = (t.replace("{{", "{").replace("}}", "}").replace("'", "''") for t in pr.default_template().split(pr.SLOT))


@query("prompt_messages_default", f"""{_TOP}{o.seen(K)}
SELECT contract_id, unnest(['system', 'user']) AS role, unnest(['{pr.SYSTEM_MESSAGE}', '{_DEFAULT_BEFORE}' || context || '{_DEFAULT_AFTER}']) AS content FROM contexts""")
def prompt_messages_default(spark, sf):
    """The template that asks for every field with its guidance."""
    prompts = pr.messages(_contexts(spark, sf))
    return prompts.select("contract_id", F.explode("messages").alias("m")).select("contract_id", "m.role", "m.content")


@query("prompt_budget", f"""{_TOP}{o.seen(K)}, sized AS (
SELECT contract_id, len(regexp_extract_all('{pr.SYSTEM_MESSAGE}', '\\S+')) + len(regexp_extract_all(
  'Fill in {{"clause": null}} from:' || chr(10) || context || chr(10) || 'JSON only.', '\\S+')) AS n FROM contexts)
SELECT contract_id, n AS prompt_tokens, 1500 AS max_output_tokens, n + 1500 AS token_budget FROM sized""")
def prompt_budget(spark, sf):
    return pr.budget(pr.messages(_contexts(spark, sf), _TEMPLATE)).drop("messages")


def _extract_sql(rules: dict[str, str]) -> str:
    columns = ", ".join(f"arg_min(sentence, (seen, i)) FILTER (WHERE {rule}) AS {name}" for name, rule in rules.items())
    return f"""{_TOP}{o.seen(K)},
found AS (SELECT contract_id, seen, unnest(s) AS sentence, generate_subscripts(s, 1) AS i
  FROM (SELECT contract_id, seen, list_filter(list_transform(regexp_extract_all(chunk_text, '{o.SENTENCE}'),
        lambda x: trim(x)), lambda x: x <> '') AS s FROM seen))
SELECT contract_id, {columns} FROM found GROUP BY contract_id"""


@query("extract_clauses", _extract_sql({
    "license_line": "(contains(lower(sentence), 'released under') OR contains(lower(sentence), 'licensed under')) AND regexp_matches(sentence, '(?i)licen[sc]e')",
    "with_the": r"contains(lower(sentence), 'with ') AND regexp_matches(sentence, '(?i)\bthe\b')",
    "long_number": "regexp_matches(sentence, '[0-9]{4}')",
    "percentage": "regexp_matches(sentence, '[0-9]+ ?%')",
    "only_keyword": "contains(lower(sentence), 'ation') OR contains(lower(sentence), 'tion')",
}))
def extract_clauses(spark, sf):
    return ex.extract_clauses(_seen(spark, sf), fx.EXTRACTED)


@query("rule_results", _extract_sql({
    "license_line": "(contains(lower(sentence), 'released under') OR contains(lower(sentence), 'licensed under')) AND regexp_matches(sentence, '(?i)licen[sc]e')",
    "with_the": r"contains(lower(sentence), 'with ') AND regexp_matches(sentence, '(?i)\bthe\b')",
    "long_number": "regexp_matches(sentence, '[0-9]{4}')",
}).replace("SELECT contract_id, arg_min", "SELECT contract_id, 'documents/' || contract_id AS file_path, CASE WHEN (license_line IS NOT NULL)::INT + (with_the IS NOT NULL)::INT + (long_number IS NOT NULL)::INT >= 2 THEN 'success' ELSE 'partial' END AS status, license_line, with_the, long_number FROM (SELECT contract_id, arg_min", 1) + ")")
def rule_results(spark, sf):
    """A whole run by rules: text in, result rows out."""
    contracts = fx.contracts(spark, sf).select("contract_id", F.concat(F.lit("documents/"), "contract_id").alias("file_path"), "text")
    rows = batch.rule_results(contracts, fx.benchmark_queries(spark, sf), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")),
                              fx.EXTRACTED[:3], batch.Settings(SIZE, OVERLAP, K), penalties=[])
    return rows.select("contract_id", "file_path", "status", "license_line", "with_the", "long_number")


@query("batch_prompts", f"""{_TOP}{o.seen(K)}
SELECT contract_id, n_words AS prompt_tokens, n_words + 1500 AS token_budget FROM (SELECT contract_id, len(regexp_extract_all(
  '{pr.SYSTEM_MESSAGE}', '\\S+')) + len(regexp_extract_all('Context: ' || context, '\\S+')) AS n_words FROM contexts)""")
def batch_prompts(spark, sf):
    contracts = fx.contracts(spark, sf).select("contract_id", "text")
    asked = batch.prompts(contracts, fx.benchmark_queries(spark, sf), batch.Settings(SIZE, OVERLAP, K), "Context: {context}")
    return asked.select("contract_id", "prompt_tokens", "token_budget")


def _sla_rule(field) -> str:
    words = " OR ".join(f"contains(lower(sentence), '{k}')" for k in field.keywords)
    return f"({words}) AND regexp_matches(sentence, '(?i){field.pattern}')"


_SLA_TEXT = {f.name: _sla_rule(f) for f in SLA_FIELDS if f.kind == TEXT}
_SLA_TOP = f"WITH RECURSIVE {o.chunks(SIZE, OVERLAP).replace(o.READY, o.CONTRACT_LIKE)}, {_SLA_QUERIES}, "
_SLA_EXTRACT = _extract_sql(_SLA_TEXT).replace(_TOP, _SLA_TOP)


def _sla_seen(spark, sf):
    chunks = ch.chunk(fx.contract_like(spark, sf), SIZE, OVERLAP)
    return rt.retrieved(chunks, rt.default_queries(spark))


@query("extract_sla_clauses", _SLA_EXTRACT)
def extract_sla_clauses(spark, sf):
    """The full field configuration and the built-in queries over contract-like texts."""
    return ex.extract_clauses(_sla_seen(spark, sf), SLA_FIELDS)


def _sla_score(f) -> str:
    sn = f"trim(lower(substring({f.name}, 1, 120)))"
    hit = " OR ".join(f"contains(low, '{k}')" for k in f.keywords)
    return f"""SELECT contract_id, '{f.name}' AS field, CASE WHEN {f.name} IS NOT NULL THEN
  CASE WHEN contains(low, {sn}) OR contains(ws, regexp_replace({sn}, '\\s+', ' ', 'g'))
       THEN CASE WHEN regexp_matches({f.name}, '(?i){f.pattern}') THEN 1.0 ELSE 0.8 END
       ELSE CASE WHEN regexp_matches({f.name}, '(?i){f.pattern}') THEN 0.6 ELSE 0.4 END END WHEN {hit} THEN 0.0 END::DOUBLE AS score FROM judged"""


@query("sla_field_scores", _SLA_EXTRACT.replace("\nSELECT contract_id, arg_min", ",\nclauses AS (SELECT contract_id, arg_min", 1) + """),
judged AS MATERIALIZED (SELECT c.*, lower(r.clean_text) AS low, regexp_replace(lower(r.clean_text), '\\s+', ' ', 'g') AS ws FROM clauses c JOIN ready r USING (contract_id))
""" + " UNION ALL ".join(_sla_score(f) for f in SLA_FIELDS if f.kind == TEXT))
def sla_field_scores(spark, sf):
    """The extracted clauses of contract-like texts, judged with the full field configuration."""
    fields = tuple(f for f in SLA_FIELDS if f.kind == TEXT)
    scored = sc.score_results(ex.extract_clauses(_sla_seen(spark, sf), SLA_FIELDS), fx.contract_like(spark, sf), fields)
    return sc.field_scores(scored).select("contract_id", "field", "score")


@query("monetary_summary", f"""WITH {o.READY},
clauses AS (SELECT contract_id, doc_id, list_filter([
    CASE WHEN doc_id % 3 = 0 THEN 'A fee of $' || (doc_id * 100) || '.50, or USD 2 million for ' || clean_text END,
    CASE WHEN doc_id % 4 = 0 THEN 'Interest of 1.5% per month: ' || clean_text END,
    CASE WHEN doc_id % 5 = 0 THEN 'A service credit of 10% of the fee' END], lambda c: c IS NOT NULL) AS cs FROM ready)
SELECT contract_id, CASE WHEN len(cs) > 0 THEN doc_id % 3 = 0 OR len(list_filter(cs, lambda c: regexp_matches(c, '[0-9]+(?:\\.[0-9]+)? ?%') AND NOT contains(lower(c), 'credit'))) > 0 END AS penalty_has_monetary,
       CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id * 100 + 0.5 > 2000000 THEN '$' || (doc_id * 100) || '.50' ELSE 'USD 2 million' END END AS penalty_max_amount,
       CASE WHEN doc_id % 3 = 0 THEN greatest(doc_id * 100 + 0.5, 2000000) END::DOUBLE AS max_amount_value,
       CASE WHEN doc_id % 3 = 0 THEN 'USD' END AS penalty_currency FROM clauses""")
def monetary_summary(spark, sf):
    """Penalty clauses built from each text: amounts in three forms, percentages, credits, none."""
    doc, clean = F.col("doc_id"), F.col("clean_text")
    rows = fx.ready(spark, sf).select(
        "contract_id",
        F.when(doc % 3 == 0, F.concat(F.lit("A fee of $"), (doc * 100).cast("string"), F.lit(".50, or USD 2 million for "), clean)).alias("penalty_termination_fee"),
        F.when(doc % 4 == 0, F.concat(F.lit("Interest of 1.5% per month: "), clean)).alias("penalty_late_payment"),
        F.when(doc % 5 == 0, "A service credit of 10% of the fee").alias("penalty_uptime_breach"))
    summary = ex.monetary_summary(rows, ["penalty_termination_fee", "penalty_late_payment", "penalty_uptime_breach"])
    return summary.withColumn("max_amount_value", F.col("max_amount_value").cast("double"))


_UNIT = """units AS MATERIALIZED (SELECT vec_id, label, norm, list_transform(v, lambda x: x / norm) AS unit
  FROM (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm
        FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))),
centres AS MATERIALIZED (SELECT label, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS unit
  FROM (SELECT label, list(m ORDER BY i) AS c FROM (
    SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(unit) AS x, generate_subscripts(unit, 1) AS i FROM units) GROUP BY label, i) GROUP BY label))"""


def _units(spark, sf):
    return ve.normalised(fx.read(spark, sf, "embeddings"), "embedding", 64)


def _centres(units):
    """Mean direction of each label, as its query."""
    sums = units.select("label", F.posexplode("unit").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    rows = sums.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    return ve.normalised(rows, "centre", 64).select(F.col("label").alias("query_idx"), "unit")


@query("vector_norms", f"WITH {_UNIT} SELECT vec_id, label, round(norm, 6) AS norm, round(unit[1], 6) AS first_value, round(list_sum(unit), 6) AS total FROM units")
def vector_norms(spark, sf):
    return _units(spark, sf).select("vec_id", "label", F.round("norm", 6).alias("norm"), F.round(F.col("unit")[0], 6).alias("first_value"),
                                    F.round(F.aggregate("unit", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query("vector_topk", f"""WITH {_UNIT},
scored AS (SELECT u.label AS group_id, u.label AS query_idx, u.vec_id, list_dot_product(u.unit, c.unit) AS similarity
           FROM units u JOIN centres c ON c.label = u.label)
SELECT group_id, query_idx, vec_id, round(similarity, 6) AS similarity,
       row_number() OVER (PARTITION BY group_id, query_idx ORDER BY round(similarity, 9) DESC, vec_id) AS rank FROM scored QUALIFY rank <= 5""")
def vector_topk(spark, sf):
    units = _units(spark, sf)
    queries = _centres(units).withColumn("group_id", F.col("query_idx"))
    return ve.top_k_vectors(units.withColumn("group_id", F.col("label")), queries, 5).withColumn("similarity", F.round("similarity", 6))


_NEAR = f"""WITH {_UNIT},
planes AS (SELECT i, b, (((i * 97 + b * 389 + 7) * (i * 97 + b * 389 + 7) * 31 + (i * 97 + b * 389 + 7) * 17) % 1009) / 504.5 - 1 AS p
           FROM (SELECT unnest(range(64)) AS i) CROSS JOIN (SELECT unnest(range(256)) AS b)),
vbits AS MATERIALIZED (SELECT vec_id, b, sum(x * p) > 0 AS s FROM (SELECT vec_id, unnest(unit) AS x, generate_subscripts(unit, 1) - 1 AS i FROM units)
          JOIN planes USING (i) GROUP BY vec_id, b),
qbits AS MATERIALIZED (SELECT label, b, sum(x * p) > 0 AS s FROM (SELECT label, unnest(unit) AS x, generate_subscripts(unit, 1) - 1 AS i FROM centres)
          JOIN planes USING (i) GROUP BY label, b),
candidates AS MATERIALIZED (SELECT q.label, v.vec_id FROM qbits q JOIN vbits v USING (b) GROUP BY q.label, v.vec_id HAVING count(*) FILTER (q.s <> v.s) <= 0.44 * 256),
exact AS (SELECT c.label AS query_idx, u.vec_id, list_dot_product(u.unit, c.unit) AS similarity FROM units u CROSS JOIN centres c),
near AS (SELECT query_idx, vec_id, similarity, row_number() OVER (PARTITION BY query_idx ORDER BY round(similarity, 9) DESC, vec_id) AS rank
         FROM exact SEMI JOIN candidates ON candidates.label = query_idx AND candidates.vec_id = exact.vec_id QUALIFY rank <= 5)
"""


@query("vector_ann", _NEAR + "SELECT query_idx, vec_id, round(similarity, 6) AS similarity, rank FROM near")
def vector_ann(spark, sf):
    """Hits of the approximate search for the label centres over all vectors."""
    units = _units(spark, sf)
    return ve.approximate_neighbours(units, _centres(units), 5).withColumn("similarity", F.round("similarity", 6))


@query("vector_ann_recall", _NEAR + """SELECT (SELECT count(*) FROM candidates) AS n_candidates, (SELECT count(*) FROM exact) AS n_pairs, count(*) AS n_exact,
       count(n.vec_id) AS n_found, count(n.vec_id) / count(*) AS recall
FROM (SELECT * FROM exact QUALIFY row_number() OVER (PARTITION BY query_idx ORDER BY round(similarity, 9) DESC, vec_id) <= 5) e
LEFT JOIN near n ON n.query_idx = e.query_idx AND n.vec_id = e.vec_id""")
def vector_ann_recall(spark, sf):
    units = _units(spark, sf).withColumn("group_id", F.lit(0))
    queries = _centres(units).withColumn("group_id", F.lit(0))
    recall = ve.neighbour_recall(ve.top_k_vectors(units, queries, 5), ve.approximate_neighbours(units, queries, 5))
    return recall.withColumns({"n_candidates": F.lit(ve.near_candidates(units, queries).count()), "n_pairs": F.lit(units.count() * queries.count())})


_NEAR_ROWS = f"""WITH {_UNIT},
planes AS (SELECT i, b, (((i * 97 + b * 389 + 7) * (i * 97 + b * 389 + 7) * 31 + (i * 97 + b * 389 + 7) * 17) % 1009) / 504.5 - 1 AS p
           FROM (SELECT unnest(range(64)) AS i) CROSS JOIN (SELECT unnest(range(256)) AS b)),
bits AS MATERIALIZED (SELECT vec_id, b, sum(x * p) > 0 AS s FROM (SELECT vec_id, unnest(unit) AS x, generate_subscripts(unit, 1) - 1 AS i FROM units)
          JOIN planes USING (i) GROUP BY vec_id, b),
sketches AS MATERIALIZED (SELECT vec_id, string_agg(CASE WHEN s THEN '1' ELSE '0' END, '' ORDER BY b) AS s FROM bits GROUP BY vec_id),
exact AS MATERIALIZED (SELECT q.vec_id AS query_idx, u.vec_id, list_dot_product(u.unit, q.unit) AS similarity FROM units u JOIN units q ON q.vec_id % 50 = 0),
candidates AS MATERIALIZED (SELECT q.vec_id AS query_idx, v.vec_id FROM sketches q JOIN sketches v ON q.vec_id % 50 = 0 AND hamming(q.s, v.s) <= 0.44 * 256),
met AS (SELECT * FROM exact e WHERE EXISTS (SELECT 1 FROM candidates c WHERE c.query_idx = e.query_idx AND c.vec_id = e.vec_id)
        OR (SELECT count(*) FROM candidates c WHERE c.query_idx = e.query_idx) < 5),
near AS (SELECT query_idx, vec_id, similarity, row_number() OVER (PARTITION BY query_idx ORDER BY round(similarity, 9) DESC, vec_id) AS rank FROM met QUALIFY rank <= 5)
"""


def _rows_asked(units):
    return units.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_idx"), "unit")


@query("vector_ann_rows", _NEAR_ROWS + "SELECT query_idx, vec_id, round(similarity, 6) AS similarity, rank FROM near")
def vector_ann_rows(spark, sf):
    """The approximate search for every row whose id is divisible by 50."""
    units = _units(spark, sf)
    return ve.approximate_neighbours(units, _rows_asked(units), 5).withColumn("similarity", F.round("similarity", 6))


@query("vector_ann_rows_recall", _NEAR_ROWS + """SELECT count(*) AS n_exact, count(n.vec_id) AS n_found, count(n.vec_id) / count(*) AS recall
FROM (SELECT * FROM exact QUALIFY row_number() OVER (PARTITION BY query_idx ORDER BY round(similarity, 9) DESC, vec_id) <= 5) e
LEFT JOIN near n ON n.query_idx = e.query_idx AND n.vec_id = e.vec_id""")
def vector_ann_rows_recall(spark, sf):
    units = _units(spark, sf).withColumn("group_id", F.lit(0))
    queries = _rows_asked(units).withColumn("group_id", F.lit(0))
    return ve.neighbour_recall(ve.top_k_vectors(units, queries, 5), ve.approximate_neighbours(units, queries, 5))


@query("ml_tfidf", f"""WITH RECURSIVE {_CHUNKS}, {o.WEIGHTS}, total AS (SELECT count(*) AS n FROM chunks),
weighed AS (SELECT t.contract_id, t.chunk_idx, t.tf * ln((1.0 + n) / (1.0 + d.df)) AS weight FROM tf t
            JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) d ON d.term = t.term CROSS JOIN total WHERE d.df < n)
SELECT contract_id, chunk_idx, count(*) AS n_features, round(max(weight) / sqrt(sum(weight * weight)), 6) AS largest FROM weighed GROUP BY contract_id, chunk_idx""")
def ml_tfidf(spark, sf):
    vectors = ve.corpus_vectors(_chunks(spark, sf).select("contract_id", "chunk_idx", "chunk_text"))
    return vectors.groupBy("contract_id", "chunk_idx").agg(F.count("*").alias("n_features"), F.round(F.max("weight"), 6).alias("largest"))


_BINS = 1 << 12  # few, so that terms meet


@query("hashed_tfidf", f"""WITH RECURSIVE {_CHUNKS},
hashed AS (SELECT contract_id, chunk_idx, md5(unnest(regexp_extract_all(lower(chunk_text), '[a-z0-9]+'))) AS h FROM chunks),
counts AS (SELECT contract_id, chunk_idx, ('0x' || substr(h, 1, 8))::BIGINT % {_BINS} AS bin, sum(CASE WHEN ('0x' || substr(h, 9, 1))::INT % 2 = 0 THEN 1 ELSE -1 END) AS tf
           FROM hashed GROUP BY ALL HAVING tf <> 0),
total AS (SELECT count(*) AS n FROM chunks), holders AS (SELECT bin, count(*) AS df FROM counts GROUP BY bin),
weighed AS (SELECT contract_id, chunk_idx, bin, tf * ln((1.0 + n) / (1.0 + df)) AS weight FROM counts JOIN holders USING (bin) CROSS JOIN total WHERE df < n)
SELECT contract_id, chunk_idx, count(*) AS n_bins, sum(bin)::BIGINT AS bins, round(max(weight) / sqrt(sum(weight * weight)), 6) AS largest,
       round(min(weight) / sqrt(sum(weight * weight)), 6) AS smallest FROM weighed GROUP BY contract_id, chunk_idx""")
def hashed_tfidf(spark, sf):
    vectors = ve.hashed_vectors(_chunks(spark, sf).select("contract_id", "chunk_idx", "chunk_text"), _BINS)
    return vectors.groupBy("contract_id", "chunk_idx").agg(F.count("*").alias("n_bins"), F.sum("bin").alias("bins"),
                                                           F.round(F.max("weight"), 6).alias("largest"), F.round(F.min("weight"), 6).alias("smallest"))


@query("amounts_by_currency", f"""WITH {o.READY}
SELECT contract_id, currency, value, text FROM (
  SELECT contract_id, 'USD' AS currency, greatest(doc_id * 100 + 0.5, 70)::DOUBLE AS value,
         CASE WHEN doc_id * 100 + 0.5 >= 70 THEN '$' || (doc_id * 100) || '.50' ELSE '70 USD' END AS text FROM ready WHERE doc_id % 3 = 0
  UNION ALL SELECT contract_id, 'EUR', (CASE WHEN doc_id % 5 = 0 THEN 2000000 ELSE doc_id END)::DOUBLE,
         CASE WHEN doc_id % 5 = 0 THEN 'EUR 2 million' ELSE '€' || doc_id END FROM ready WHERE doc_id % 3 = 0 OR doc_id % 5 = 0)
WHERE currency = 'USD' OR contract_id::BIGINT % 3 = 0 OR contract_id::BIGINT % 5 = 0""")
def amounts_by_currency(spark, sf):
    """Clauses that name amounts in two currencies, the smaller number in the dearer one."""
    doc = F.col("doc_id")
    rows = fx.ready(spark, sf).select(
        "contract_id", F.when(doc % 3 == 0, F.concat(F.lit("A fee of $"), (doc * 100).cast("string"), F.lit(".50 or €"), doc.cast("string"), F.lit(" for each case"))).alias("p"),
        F.when(doc % 5 == 0, "not above EUR 2 million").alias("q"), F.when(doc % 3 == 0, "70 USD in any case").alias("r"))
    return ex.amounts_by_currency(rows, ["p", "q", "r"]).withColumn("value", F.col("value").cast("double"))
