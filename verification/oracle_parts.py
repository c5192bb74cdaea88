"""Common table expressions of the SQL checks, written for the same tables without looking at any plan."""

from __future__ import annotations

from .fixture import CLAUSES


def clean(x: str) -> str:
    unified = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    limited = rf"regexp_replace({unified}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    squeezed = rf"regexp_replace({limited}, '[ \t]{{2,}}', ' ', 'g')"
    printable = rf"regexp_replace({squeezed}, '[^\x20-\x7E\n]', ' ', 'g')"
    return f"trim({printable}, ' ' || chr(10))"


DOCS = f"""docs AS MATERIALIZED (
  SELECT CAST(doc_id AS VARCHAR) AS contract_id, doc_id, text, {clean('text')} AS clean_text FROM documents)"""

READY = DOCS + """,
ready AS MATERIALIZED (SELECT contract_id, doc_id, clean_text FROM docs WHERE length(clean_text) >= 100)"""

_CLAUSES = "[" + ", ".join(f"'{c}'" for c in CLAUSES) + "]"
CONTRACT_LIKE = DOCS + f""",
ready AS MATERIALIZED (
  SELECT contract_id, doc_id, substring(clean_text, 1, e) || chr(10) || """ + " || chr(10) || ".join(
    f"{_CLAUSES}[(doc_id * {i + 1} + {i * 4}) % {len(CLAUSES)} + 1]" for i in range(4)) + """ || chr(10) || substring(clean_text, e + 1) AS clean_text
  FROM (SELECT *, greatest(strpos(clean_text, chr(10)) - 1, 0) AS e FROM docs WHERE length(clean_text) >= 100))"""

SENTENCE = r"[^.!?\n]+(?:[.!?]+[^.!?\s][^.!?\n]*)*[.!?]*"

SENTENCES = rf"""sents AS MATERIALIZED (
  SELECT contract_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS sent_idx
  FROM (SELECT contract_id, list_filter(list_transform(regexp_extract_all(clean_text, '{SENTENCE}'),
               lambda x: trim(x)), lambda x: x <> '') AS s FROM ready))"""


def chunks(size: int, overlap: int) -> str:
    """READY up to ``chunks(contract_id, chunk_idx, n_chunks, n_tokens, chunk_text)``; needs WITH RECURSIVE."""
    return READY + ",\n" + SENTENCES + rf""",
cut AS (
  SELECT contract_id, sent_idx, unnest(p) AS piece, generate_subscripts(p, 1) AS piece_no
  FROM (SELECT contract_id, sent_idx, CASE WHEN len(t) <= {size} THEN [sentence]
               ELSE list_transform(range(0, CAST(ceil(len(t) / {size}.0) AS BIGINT)),
                                   lambda i: trim(array_to_string(t[i * {size} + 1:(i + 1) * {size}], ''))) END AS p
        FROM (SELECT contract_id, sent_idx, sentence, regexp_extract_all(sentence, '[^ \n]+[ \n]*') AS t FROM sents))),
pieces AS MATERIALIZED (
  SELECT contract_id, piece, n, i, sum(n) OVER (PARTITION BY contract_id ORDER BY i) AS upto,
         count(*) OVER (PARTITION BY contract_id) AS n_pieces
  FROM (SELECT contract_id, piece, len(regexp_extract_all(piece, '[^ \n]+')) AS n,
               row_number() OVER (PARTITION BY contract_id ORDER BY sent_idx, piece_no) AS i FROM cut)),
reach AS (
  SELECT a.contract_id, a.i, max(b.i) AS j, any_value(a.n_pieces) AS n_pieces
  FROM pieces a JOIN pieces b ON b.contract_id = a.contract_id AND b.i >= a.i AND b.upto - a.upto + a.n <= {size}
  GROUP BY a.contract_id, a.i),
step AS MATERIALIZED (
  SELECT r.contract_id, r.i, any_value(r.j) AS j, min(k.i) AS nxt
  FROM reach r JOIN pieces e ON e.contract_id = r.contract_id AND e.i = r.j
  LEFT JOIN pieces f ON f.contract_id = r.contract_id AND f.i = r.j + 1
  LEFT JOIN pieces k ON k.contract_id = r.contract_id AND k.i > r.i AND k.i <= r.j + 1 AND f.i IS NOT NULL
       AND e.upto - k.upto + k.n <= {overlap} AND f.upto - k.upto + k.n <= {size}
  GROUP BY r.contract_id, r.i),
walk AS (
  SELECT contract_id, i, j, nxt, 0 AS chunk_idx FROM step WHERE i = 1
  UNION ALL
  SELECT s.contract_id, s.i, s.j, s.nxt, w.chunk_idx + 1 FROM walk w JOIN step s ON s.contract_id = w.contract_id AND s.i = w.nxt),
chunks AS MATERIALIZED (
  SELECT w.contract_id, w.chunk_idx, max(w.chunk_idx) OVER (PARTITION BY w.contract_id) + 1 AS n_chunks, n_tokens, chunk_text
  FROM (SELECT w.contract_id, w.chunk_idx, sum(p.n) AS n_tokens, string_agg(p.piece, ' ' ORDER BY p.i) AS chunk_text
        FROM walk w JOIN pieces p ON p.contract_id = w.contract_id AND p.i BETWEEN w.i AND w.j
        GROUP BY w.contract_id, w.chunk_idx) w)"""


WEIGHTS = r"""tf AS MATERIALIZED (
  SELECT contract_id, chunk_idx, any_value(n_chunks) AS n_chunks, term, count(*) AS tf
  FROM (SELECT contract_id, chunk_idx, n_chunks, unnest(regexp_extract_all(lower(chunk_text), '[a-z0-9]+')) AS term FROM chunks)
  GROUP BY contract_id, chunk_idx, term),
weights AS MATERIALIZED (
  SELECT t.contract_id, t.chunk_idx, t.term, t.tf, d.df, t.tf * (ln((1.0 + t.n_chunks) / (1.0 + d.df)) + 1.0) AS weight
  FROM tf t JOIN (SELECT contract_id, term, count(*) AS df FROM tf GROUP BY contract_id, term) d
    ON d.contract_id = t.contract_id AND d.term = t.term)"""

BENCHMARK = "queries AS (SELECT CAST(item_id AS INTEGER) AS query_idx, 'group_' || (item_id % 4) AS query_group, text AS query_text FROM benchmark)"


def ranked(k: int) -> str:
    """``ranked`` from ``chunks`` and ``queries``: every pair of a document scored, then the best ``k`` kept."""
    return WEIGHTS + rf""",
qterms AS (
  SELECT query_idx, term, count(*) AS qtf
  FROM (SELECT query_idx, unnest(regexp_extract_all(lower(query_text), '[a-z0-9]+')) AS term FROM queries) GROUP BY query_idx, term),
idfs AS (SELECT contract_id, term, any_value(weight / tf) AS idf FROM weights GROUP BY contract_id, term),
sizes AS (SELECT contract_id, max(n_chunks) AS n_chunks FROM chunks GROUP BY contract_id),
qlen AS (
  SELECT s.contract_id, q.query_idx,
         sqrt(sum(pow(q.qtf * coalesce(i.idf, ln(1.0 + s.n_chunks) + 1.0), 2))) AS len
  FROM sizes s CROSS JOIN qterms q LEFT JOIN idfs i ON i.contract_id = s.contract_id AND i.term = q.term
  GROUP BY s.contract_id, q.query_idx),
clen AS (SELECT contract_id, chunk_idx, sqrt(sum(weight * weight)) AS len FROM weights GROUP BY contract_id, chunk_idx),
dots AS (
  SELECT w.contract_id, w.chunk_idx, q.query_idx, sum(w.weight * q.qtf * w.weight / w.tf) AS dot
  FROM weights w JOIN qterms q ON q.term = w.term GROUP BY w.contract_id, w.chunk_idx, q.query_idx),
scored AS (
  SELECT c.contract_id, q.query_idx, c.chunk_idx, coalesce(d.dot / nullif(l.len, 0), 0.0) AS product, ql.len AS qlen
  FROM chunks c CROSS JOIN queries q
  LEFT JOIN dots d ON d.contract_id = c.contract_id AND d.chunk_idx = c.chunk_idx AND d.query_idx = q.query_idx
  LEFT JOIN clen l ON l.contract_id = c.contract_id AND l.chunk_idx = c.chunk_idx
  LEFT JOIN qlen ql ON ql.contract_id = c.contract_id AND ql.query_idx = q.query_idx),
ranked AS MATERIALIZED (
  SELECT contract_id, query_idx, chunk_idx, coalesce(product / nullif(qlen, 0), 0.0) AS similarity,
         row_number() OVER (PARTITION BY contract_id, query_idx ORDER BY round(product, 9) DESC, chunk_idx) AS rank
  FROM scored QUALIFY rank <= {k})"""


def seen(k: int) -> str:
    return ranked(k) + f""",
seen AS MATERIALIZED (
  SELECT contract_id, chunk_text, min(query_idx * {k} + rank - 1) AS seen
  FROM ranked JOIN chunks USING (contract_id, chunk_idx) GROUP BY contract_id, chunk_text),
contexts AS MATERIALIZED (
  SELECT contract_id, string_agg(chunk_text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY seen) AS context,
         count(*) AS n_chunks FROM seen GROUP BY contract_id)"""


RESPONSES = READY + r""",
responses AS MATERIALIZED (
  SELECT contract_id, doc_id, clean_text, 'documents/' || doc_id AS file_path,
         CASE WHEN doc_id % 17 = 0 THEN substring(js, 1, length(js) - 20)
              WHEN doc_id % 11 = 0 THEN '```json' || chr(10) || js || chr(10) || '```'
              WHEN doc_id % 13 = 0 THEN 'Here it is: ' || js || ' Done.' ELSE js END AS raw_response,
         2000 + (doc_id * 37) % 9000 AS tokens_used,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 7) AS created_at
  FROM (SELECT contract_id, doc_id, clean_text,
          CASE WHEN doc_id % 19 = 4 THEN '{"invented":"an earlier value",' || substring(js, 2) ELSE js END AS js
        FROM (SELECT contract_id, doc_id, clean_text, CAST(to_json({
          'opening_quote': CASE WHEN doc_id % 5 < 3 THEN substring(clean_text, 1, 130) END,
          'spaced_quote': CASE WHEN doc_id % 7 < 4 THEN replace(substring(clean_text, 41, 60), ' ', '  ') END,
          'invented': CASE WHEN doc_id % 3 = 0 THEN 'the summary of ' || doc_id WHEN doc_id % 3 = 1 THEN 'zzz-' || doc_id END,
          'license_line': CASE WHEN doc_id % 2 = 0 THEN nullif(regexp_extract(clean_text,
                '(?i)[^.!?\n]*(?:released|licensed) under[^.!?\n]*'), '') END,
          'has_flag': CASE WHEN doc_id % 4 = 0 THEN true WHEN doc_id % 4 = 1 THEN false END,
          'max_amount': CASE WHEN doc_id % 10 = 0 THEN CASE (doc_id // 10) % 5 WHEN 0 THEN '$' || (doc_id * 100)
                WHEN 1 THEN 'up to $' || doc_id || '.5k in total' WHEN 2 THEN (doc_id * 10) || ' USD for each case' WHEN 3 THEN '€' || doc_id || ' million'
                ELSE 'after 12 months of fees, at most $' || doc_id || ',000' END END}) AS VARCHAR) AS js FROM ready)))"""

PARSED = RESPONSES + r""",
bodies AS (
  SELECT *, CASE WHEN starts_with(b, '```') AND len(string_split(b, chr(10))) > 2
                 THEN array_to_string(string_split(b, chr(10))[2:len(string_split(b, chr(10))) - 1], chr(10)) ELSE b END AS body
  FROM (SELECT *, regexp_replace(raw_response, '^\s+|\s+$', '', 'g') AS b FROM responses)),
parsed AS MATERIALIZED (
  SELECT contract_id, doc_id, clean_text, file_path, raw_response, tokens_used, created_at,
         replace(CASE WHEN json_valid(body) THEN CASE WHEN json_type(body) = 'OBJECT' THEN body END
              WHEN json_valid(nullif(regexp_extract(body, '(?s)\{.*\}'), '')) THEN regexp_extract(body, '(?s)\{.*\}') END,
           '{"invented":"an earlier value",', '{') AS obj  -- the later value of the key counts
  FROM bodies)"""

RESULTS = PARSED + r""",
fields AS (
  SELECT *, obj ->> '$.opening_quote' AS opening_quote, obj ->> '$.spaced_quote' AS spaced_quote,
         obj ->> '$.invented' AS invented, obj ->> '$.license_line' AS license_line,
         CASE obj ->> '$.has_flag' WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS has_flag, obj ->> '$.max_amount' AS max_amount
  FROM parsed),
results AS MATERIALIZED (
  SELECT contract_id, doc_id, clean_text, file_path,
         CASE WHEN obj IS NULL THEN 'failed' WHEN filled >= 2 THEN 'success' ELSE 'partial' END AS status,
         CASE WHEN obj IS NULL THEN 0 ELSE tokens_used END AS tokens_used,
         CASE WHEN obj IS NOT NULL THEN filled END AS populated,
         opening_quote, spaced_quote, invented, license_line, has_flag, max_amount,
         CASE WHEN obj IS NOT NULL THEN raw_response END AS raw_response,
         CASE WHEN obj IS NULL THEN 'response is not a JSON object' END AS error, created_at
  FROM (SELECT *, (opening_quote IS NOT NULL)::INT + (spaced_quote IS NOT NULL)::INT + (invented IS NOT NULL)::INT
             + (license_line IS NOT NULL)::INT + (has_flag IS NOT NULL)::INT + (max_amount IS NOT NULL)::INT AS filled FROM fields))"""

SLA = RESULTS + r""",
sla AS MATERIALIZED (
  SELECT contract_id, file_path, status, tokens_used, opening_quote AS uptime_guarantee, spaced_quote AS sla_breach_threshold,
         license_line AS sla_measurement_period, invented AS penalty_uptime_breach, spaced_quote AS penalty_late_payment,
         has_flag AS penalty_has_monetary, max_amount AS penalty_max_amount,
         CASE WHEN max_amount IS NOT NULL THEN 'USD' END AS penalty_currency, license_line AS governing_law,
         raw_response, error, created_at FROM results)"""


def _text_score(name: str, pattern: str, keywords: list[str]) -> str:
    sn = f"trim(lower(substring({name}, 1, 120)))"
    hit = " OR ".join(f"contains(src_clean, '{k}')" for k in keywords) or "false"
    return rf"""CASE WHEN {name} IS NOT NULL AND {name} <> '' THEN
      CASE WHEN src_clean <> '' AND (contains(src_clean, {sn}) OR contains(src_ws, regexp_replace({sn}, '\s+', ' ', 'g')))
           THEN CASE WHEN regexp_matches({name}, '(?i){pattern}') THEN 1.0 ELSE 0.8 END
           ELSE CASE WHEN regexp_matches({name}, '(?i){pattern}') THEN 0.6 ELSE 0.4 END END
      WHEN {hit} THEN 0.0 END::DOUBLE"""


_RULES = [
    ("opening_quote", _text_score("opening_quote", r"\b(?:the|and|of)\b", ["the "])),
    ("spaced_quote", _text_score("spaced_quote", r"(?:\bthe\b|\band\b)", [])),
    ("invented", _text_score("invented", r"\bthe\b", ["with "])),
    ("license_line", _text_score("license_line", r"licen[sc]e", ["released under", "licensed under"])),
    ("has_flag", "CASE WHEN has_flag IS NOT NULL THEN 1.0 END::DOUBLE"),
    ("max_amount", "CASE WHEN max_amount IS NOT NULL AND max_amount <> '' THEN 1.0 END::DOUBLE"),
]

SCORES = RESULTS + r""",
sourced AS MATERIALIZED (
  SELECT *, regexp_replace(src_clean, '\s+', ' ', 'g') AS src_ws FROM (SELECT *, lower(clean_text) AS src_clean FROM results)),
scores AS MATERIALIZED (""" + "\n  UNION ALL ".join(
    f"SELECT contract_id, '{name}' AS field, {rule} AS score, CAST({name} AS VARCHAR) AS value FROM sourced" for name, rule in _RULES) + r"""),
per_contract AS MATERIALIZED (
  SELECT contract_id, coalesce(avg(score), 0.0) AS overall, count(*) FILTER (WHERE score = 0) AS missed,
         count(*) FILTER (WHERE score > 0) AS extracted FROM scores GROUP BY contract_id)"""
