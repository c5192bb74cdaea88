"""DuckDB SQL that must give the rows of the queries, written from their contracts."""

from __future__ import annotations


def chat() -> str:
    """Formatted lengths follow the template: '### role:' + line break, text, '</turn>' + line break, with escapes."""
    body = r"replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e')"
    role = r"replace(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), chr(10), '\n'), ':', '\c')"
    return rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({role}) + length({body}) + 14)::BIGINT AS formatted_chars,
       (count(*) FILTER (role = 'assistant'))::BIGINT AS n_examples
FROM t GROUP BY conv_id"""


def urls(rules, rounds: int, damping: float, threshold: float) -> str:
    order = sorted(rules, key=lambda r: -len(r.text))
    fits = [f"((host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}'))" for r in order]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, order)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, order)) + " END"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower.format("regexp_extract(CASE WHEN contains({u}, '://') THEN substr({u}, instr({u}, '://') + 3) ELSE '' END, '^([^/?#]*)', 1)")
    path = "regexp_extract(CASE WHEN contains({u}, '://') THEN substr({u}, instr({u}, '://') + 3) ELSE '' END, '^[^/?#]*([^?#]*)', 1)"
    ranks = []
    for name, seed, src, dst in (("trust", "trusted", "src", "dst"), ("distrust", "blocked", "dst", "src")):
        ranks.append(f"{name}_share AS (SELECT {src} AS src, {dst} AS dst, weight / sum(weight) OVER (PARTITION BY {src}) AS share FROM edges)")
        ranks.append(f"{name}0 AS (SELECT host, coalesce({seed} / nullif((SELECT sum({seed}) FROM hosts), 0), 0) AS restart, "
                     f"coalesce({seed} / nullif((SELECT sum({seed}) FROM hosts), 0), 0) AS rank FROM hosts)")
        for i in range(rounds):
            ranks.append(
                f"{name}{i + 1} AS MATERIALIZED (SELECT n.host, n.restart, {damping} * coalesce(g.got, 0) + {1.0 - damping} * n.restart AS rank FROM {name}{i} n "
                f"LEFT JOIN (SELECT s.dst AS host, sum(s.share * r.rank) AS got FROM {name}_share s JOIN {name}{i} r ON s.src = r.host GROUP BY 1) g "
                f"ON g.host = n.host)")
    link = r"""'(?i)(?:href|src)\s*=\s*["'']?([^"''\s>]+)'"""
    absolute = "CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END"
    return f"""
WITH parsed AS (SELECT page_id, html, {host.format(u="coalesce(url, '')")} AS host, {path.format(u="coalesce(url, '')")} AS path FROM pages),
ruled AS (SELECT *, {rule} AS rule, {verdict} AS rule_verdict FROM parsed),
links AS (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), {link}, 1)) AS link FROM ruled WHERE host <> ''),
edges AS (SELECT host AS src, coalesce(nullif({host.format(u=f"({absolute})")}, ''), host) AS dst, count(*)::DOUBLE AS weight FROM links GROUP BY 1, 2),
counted AS (SELECT host, (count(*) FILTER (rule_verdict = 'allow'))::DOUBLE AS trusted, (count(*) FILTER (rule_verdict = 'block'))::DOUBLE AS blocked
            FROM ruled WHERE host <> '' GROUP BY 1),
hosts AS (SELECT host, sum(trusted) AS trusted, sum(blocked) AS blocked FROM
          (SELECT * FROM counted UNION ALL SELECT dst, 0.0, 0.0 FROM edges) GROUP BY 1),
{", ".join(ranks)},
scores AS (SELECT host, t.rank AS trust, d.rank AS distrust FROM trust{rounds} t JOIN distrust{rounds} d USING (host))
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN distrust > 0 AND distrust >= {threshold} * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN scores USING (host)"""


def near_duplicates(size: int, threshold: int) -> str:
    """All pairs that share a shingle, exactly; components by spreading ids until nothing changes."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
       ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * k >= {threshold} * (x.n + y.n - k)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.reached) AS component_id, min(r.reached) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id"""


def quality(share: float, min_language_words: int, min_words: int, min_common: int, max_class: float, max_word: float) -> str:
    """Counts by the contract; distances summed over the bins a text has, plus what the reference holds elsewhere."""
    kept_only = lambda kinds: f"length(regexp_replace(text, '[^{kinds}]', '', 'g'))"
    classes = {"lower": kept_only("a-z"), "upper": kept_only("A-Z"), "digit": kept_only("0-9"), "space": kept_only(r"\x20\x09-\x0D"),
               "mark": kept_only(r"\x00-\x08\x0E-\x1F!-/:-@\[-`{-\x7F"), "latin": kept_only(r"\x{C0}-\x{27F}"), "other": kept_only(r"\x{80}-\x{BF}\x{280}-\x{10FFFF}")}
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
    both = f"({part.format('p', 'q')} + {part.format('q', 'p')})"
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents),
win AS (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS n FROM (SELECT id, unnest(range(1, len(w) - 1)) AS i,
      unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM d WHERE len(w) >= 3)),
rep AS (SELECT id, count(DISTINCT i + k) AS n FROM win CROSS JOIN (VALUES (0), (1), (2)) s(k) WHERE n >= 2 GROUP BY id),
wc AS MATERIALIZED (SELECT id, lang, word, count(*) AS n FROM (SELECT id, lang, unnest(w) AS word FROM d) GROUP BY ALL),
lw AS (SELECT lang, word, sum(n) AS n FROM wc GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM lw GROUP BY lang HAVING sum(n) >= {min_language_words}),
common AS (SELECT lang, word, n::DOUBLE / total AS q FROM lw JOIN lt USING (lang) WHERE n >= {share} * total),
rest AS (SELECT lang, 1 - coalesce(sum(q), 0) AS q FROM lt LEFT JOIN common USING (lang) GROUP BY lang),
bins AS (SELECT id, wc.lang, coalesce(c.word, '') AS bin, sum(n)::DOUBLE / sum(sum(n)) OVER (PARTITION BY id) AS p, coalesce(any_value(c.q), any_value(rest.q)) AS q
         FROM wc JOIN rest USING (lang) LEFT JOIN common c ON c.lang = wc.lang AND c.word = wc.word GROUP BY id, wc.lang, coalesce(c.word, '')),
wd AS (SELECT id, sqrt(least(greatest((sum{both} + 1 - sum(q)) / 2, 0), 1)) AS distance FROM bins GROUP BY id),
cc AS MATERIALIZED (SELECT id, lang, {", ".join(f"{v} AS {k}" for k, v in classes.items())} FROM d),
cl AS (SELECT id, lang, unnest({list(classes)}) AS kind, unnest([{", ".join(classes)}])::DOUBLE AS n FROM cc),
cr AS (SELECT lang, kind, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY lang), 0) AS q FROM cl WHERE lang IN (SELECT lang FROM lt) GROUP BY lang, kind),
cp AS (SELECT id, lang, kind, n / nullif(sum(n) OVER (PARTITION BY id), 0) AS p FROM cl),
cd AS (SELECT id, sqrt(least(greatest(sum{both} / 2, 0), 1)) AS distance FROM cp JOIN cr USING (lang, kind) WHERE p IS NOT NULL GROUP BY id),
ct AS (SELECT id, lang, kind, n::BIGINT AS n, sum(n::BIGINT) OVER (PARTITION BY id) AS total FROM cl WHERE lang IN (SELECT lang FROM lt)),
md AS (SELECT lang, kind, quantile_cont(((2000 * n + total) // (2 * total))::BIGINT, 0.5) AS q FROM ct WHERE total > 0 GROUP BY lang, kind),
mt AS (SELECT lang, kind, q / nullif(sum(q) OVER (PARTITION BY lang), 0) AS q FROM md),
td AS (SELECT id, sqrt(least(greatest(sum{both} / 2, 0), 1)) AS distance FROM cp JOIN mt USING (lang, kind) WHERE p IS NOT NULL AND q IS NOT NULL GROUP BY id),
counted AS (SELECT d.id, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
      coalesce(rep.n, 0)::BIGINT AS n_repeat_words, cd.distance AS class_distance, td.distance AS typical_distance,
      CASE WHEN d.lang IN (SELECT lang FROM lt) THEN coalesce(wd.distance, 0) END AS word_distance
      FROM d LEFT JOIN rep USING (id) LEFT JOIN cd ON cd.id = d.id LEFT JOIN td ON td.id = d.id LEFT JOIN wd ON wd.id = d.id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      coalesce(n_words >= {min_words} AND greatest(class_distance, typical_distance) > {max_class}, false) OR coalesce(n_words >= {min_common} AND word_distance > {max_word}, false) AS far FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept,
       round(class_distance, 6) AS class_distance, round(typical_distance, 6) AS typical_distance, round(word_distance, 6) AS word_distance FROM judged"""


def archives() -> str:
    """Base32 of SHA-1: five hexadecimal digits are four letters."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31) + 1, 1)"
    return f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
o AS (SELECT hex, min(page_id) AS original FROM p GROUP BY hex)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: {letter}), '') AS payload_digest,
       CASE WHEN page_id > original THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > original THEN original END AS refers_to
FROM p JOIN o USING (hex)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def searched(top: int) -> str:
    """Scores of all documents that share a term with an item, then the best."""
    terms = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS doc, doc_id, {terms} AS w FROM documents),
q AS (SELECT item, item_id, term, count(*) AS q FROM (SELECT row_number() OVER () AS item, item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) AS N, sum(len(w))::BIGINT AS L FROM d WHERE len(w) > 0),
t AS MATERIALIZED (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT N FROM s) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM t GROUP BY term),
p AS (SELECT t.doc, t.term, doc_id, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * N) // L))) AS part
      FROM t JOIN w USING (term) JOIN d USING (doc), s),
f AS (SELECT item, item_id, doc, doc_id, sum(q * part)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM f WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {top}"""


def phrases(min_count: int, longest: int, top: int) -> str:
    """Every phrase counted; the parts of a phrase and what holds it are found by their words."""
    return rf"""
WITH w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM
       (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest(range(1, {longest + 1})) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k AS size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {min_count}),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f x WHERE size >= 2 AND NOT EXISTS
      (SELECT 1 FROM f y WHERE y.lang = x.lang AND y.a = x.a AND y.size > x.size AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
p AS (SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r, n, (1000::HUGEINT * k.a * n) // (x.a::HUGEINT * y.a) AS score FROM k JOIN t ON t.lang = k.lang
      JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
m AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM r WHERE rank <= {top}"""
