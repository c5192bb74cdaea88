"""Sources, cleaning, filters, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from clauseloom import session
from clauseloom.functions import text as tx
from clauseloom.operators import chunking as ch
from clauseloom.operators import extraction as ex
from clauseloom.operators import scoring as sc
from clauseloom.plans import planned as pl
from clauseloom.plans import sections
from clauseloom.sources import contracts as ct
from clauseloom.fields import Field

from . import fixture as fx
from . import oracle_parts as o
from .registry import query

SIZE, OVERLAP = 64, 8
FIXTURE_MARKERS = ("tion of", "les de")


@query("clean_text", f"WITH {o.DOCS} SELECT contract_id, clean_text, length(clean_text) AS clean_chars FROM docs")
def clean_text(spark, sf):
    docs = ct.cleaned(fx.contracts(spark, sf))
    return docs.select("contract_id", "clean_text", F.length("clean_text").alias("clean_chars"))


@query("scan_text", r"""
SELECT length(t) AS n_chars, md5(t) AS text_md5, 'file' AS source FROM (SELECT text || chr(10) AS t FROM documents)""")
def scan_text(spark, sf):
    """The documents as one text file each, read back as whole files."""
    docs = fx.read(spark, sf, "documents").repartition("doc_id").select("text")
    files = ct.scan_files(spark, ct.write_files(docs, session.new_folder(spark, "texts")))
    return files.select(F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"), "source")


@query("page_assembly", """
SELECT CAST(conv_id AS VARCHAR) AS contract_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS text,
       count(*) AS n_pages FROM conversations GROUP BY conv_id""")
def page_assembly(spark, sf):
    turns = fx.read(spark, sf, "conversations").withColumn("conv_id", F.col("conv_id").cast("string"))
    return ct.assemble_pages(turns, "conv_id", "turn", "text")


_LISTING = r"""
SELECT regexp_replace(regexp_extract(path, '([^/]+)/*$', 1), '(.)\.[^.]*$', '\1') AS contract_id, path, ext_rank
FROM (SELECT path, CASE regexp_extract(path, '\.([^./]+)$', 1) WHEN 'txt' THEN 0 WHEN 'pdf' THEN 1 END AS ext_rank
      FROM (SELECT url || CASE page_id % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.pdf' ELSE '.html' END AS path FROM pages))
WHERE ext_rank IS NOT NULL ORDER BY ext_rank, path"""


def _paths(spark, sf):
    suffix = F.when(F.col("page_id") % 3 == 0, ".txt").when(F.col("page_id") % 3 == 1, ".pdf").otherwise(".html")
    return fx.read(spark, sf, "pages").select(F.concat("url", suffix).alias("path"))


@query("corpus_listing", _LISTING)
def corpus_listing(spark, sf):
    return ct.corpus_listing(_paths(spark, sf))


@query("corpus_listing_first", _LISTING + " LIMIT 100")
def corpus_listing_first(spark, sf):
    return ct.corpus_listing(_paths(spark, sf), 100)


@query("dataset_scan", """
SELECT 'cuad_' || doc_id AS contract_id, 'cuad_dataset[cuad_' || doc_id || ']' AS file_path, 'cuad' AS source,
       coalesce(CASE WHEN lang <> 'fr' THEN text END, '') AS text FROM documents""")
def dataset_scan(spark, sf):
    docs = fx.read(spark, sf, "documents").withColumn("text", F.when(F.col("lang") != "fr", F.col("text")))
    return ct.dataset_scan(docs, "doc_id", "text")


_CORPUS = """SELECT 'cuad_' || position AS contract_id, 'cuad_dataset[cuad_' || position || ']' AS file_path, 'cuad' AS source, coalesce(text, '') AS text
FROM (SELECT text, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST) - 1 AS position FROM documents)"""


@query("load_corpus", _CORPUS)
def load_corpus(spark, sf):
    """The stored documents as a corpus; their positions are those by source and id."""
    return ct.load_corpus(spark, f"{sf}/documents.parquet", order=["source", "doc_id"])


@query("load_corpus_first", _CORPUS + " WHERE position < 100")
def load_corpus_first(spark, sf):
    return ct.load_corpus(spark, f"{sf}/documents.parquet", 100, order=["source", "doc_id"])


@query("corpus_admission", r"""
SELECT 'cuad_' || CASE WHEN doc_id > 999 THEN CAST(doc_id AS VARCHAR) ELSE lpad(CAST(doc_id AS VARCHAR), 4, '0') END AS contract_id, s AS text
FROM (SELECT doc_id, regexp_replace(CASE doc_id % 5 WHEN 1 THEN 'arXiv: ' WHEN 2 THEN '  Abstract' || chr(10) ELSE '' END || text,
             '^\s+|\s+$', '', 'g') AS s FROM documents)
WHERE length(s) >= 200 AND NOT contains(lower(substring(s, 1, 500)), 'datasheet for') AND NOT contains(lower(substring(s, 1, 500)), 'arxiv:')
  AND NOT contains(lower(substring(s, 1, 500)), 'abstract' || chr(10))
  AND NOT (doc_id = 0 AND contains(lower(substring(s, 1, 500)), 'atticus dataset'))""")
def corpus_admission(spark, sf):
    start = F.when(F.col("doc_id") % 5 == 1, "arXiv: ").when(F.col("doc_id") % 5 == 2, "  Abstract\n").otherwise("")
    docs = fx.read(spark, sf, "documents").select("doc_id", F.concat(start, "text").alias("text"))
    return ct.admit(docs, "doc_id", "text")


@query("short_gate", f"""WITH {o.DOCS}
SELECT contract_id AS id, 'text too short' AS error FROM docs WHERE length(clean_text) < 100""")
def short_gate(spark, sf):
    return ct.too_short(fx.contracts(spark, sf))


@query("non_contract", f"""WITH {o.DOCS}
SELECT contract_id,
       contains(head, 'datasheet for contract understanding') OR contains(head, 'arxiv:') OR contains(head, 'abstract' || chr(10) || 'we present')
         OR contains(head, 'i.motivation' || chr(10) || 'a. who created') AS is_non_contract,
       contains(head, 'tion of') OR contains(head, 'les de') AS has_fixture_marker
FROM (SELECT contract_id, substring(lower(clean_text), 1, 1000) AS head FROM docs)""")
def non_contract(spark, sf):
    low = F.lower(F.col("clean_text"))
    return ct.cleaned(fx.contracts(spark, sf)).select(
        "contract_id", tx.is_non_contract(low).alias("is_non_contract"),
        tx.starts_with_marker(low, FIXTURE_MARKERS, 1000).alias("has_fixture_marker"))


@query("sentences", f"WITH {o.READY}, {o.SENTENCES} SELECT contract_id, sent_idx, sentence FROM sents")
def sentences(spark, sf):
    return ch.split_sentences(fx.ready(spark, sf))


@query("chunk_pack", f"WITH RECURSIVE {o.chunks(SIZE, OVERLAP)} SELECT contract_id, chunk_idx, n_chunks, CAST(n_tokens AS BIGINT) AS n_tokens, chunk_text FROM chunks")
def chunk_pack(spark, sf):
    return ch.chunk(fx.ready(spark, sf), SIZE, OVERLAP)


@query("chunk_pack_default", f"WITH RECURSIVE {o.chunks(512, 64)} SELECT contract_id, chunk_idx, n_chunks, CAST(n_tokens AS BIGINT) AS n_tokens, chunk_text FROM chunks")
def chunk_pack_default(spark, sf):
    return ch.chunk(fx.ready(spark, sf))


@query("source_norm", f"""WITH {o.DOCS} SELECT contract_id, low AS src_clean, regexp_replace(low, '\\s+', ' ', 'g') AS src_ws
FROM (SELECT contract_id, lower(clean_text) AS low FROM docs)""")
def source_norm(spark, sf):
    return sc.source_norm(ct.cleaned(fx.contracts(spark, sf))).select("contract_id", "src_clean", "src_ws")


@query("keyword_hits", f"""WITH {o.DOCS}, low AS (SELECT contract_id, lower(clean_text) AS t FROM docs),
hits AS (
  SELECT contract_id, 'license' AS field, 1 AS n, 'released under' AS k FROM low WHERE contains(t, 'released under')
  UNION ALL SELECT contract_id, 'license', 2, 'licensed under' FROM low WHERE contains(t, 'licensed under')
  UNION ALL SELECT contract_id, 'common', 1, 'the ' FROM low WHERE contains(t, 'the ')
  UNION ALL SELECT contract_id, 'common', 2, 'with ' FROM low WHERE contains(t, 'with '))
SELECT contract_id, field, string_agg(k, '|' ORDER BY n) AS keywords FROM hits GROUP BY contract_id, field""")
def keyword_hits(spark, sf):
    fields = (Field("license", keywords=("released under", "licensed under")), Field("common", keywords=("the ", "with ")))
    return ex.keyword_hits(ct.cleaned(fx.contracts(spark, sf)), fields)


@query("keyword_table", f"""WITH {o.DOCS}, low AS (SELECT contract_id, lower(clean_text) AS t FROM docs),
words AS (SELECT 'group_' || item_id % 4 AS field, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
keywords AS (SELECT DISTINCT field, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS keyword FROM words)
SELECT contract_id, field, keyword FROM low JOIN keywords ON contains(t, lower(keyword))""")
def keyword_table(spark, sf):
    """Thousands of keywords as rows: all pairs of neighbouring words of the passages."""
    words = fx.read(spark, sf, "benchmark").select(F.concat(F.lit("group_"), (F.col("item_id") % 4).cast("string")).alias("field"),
                                                   F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)).alias("w"))
    pairs = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1)))
    return ex.keyword_table_hits(ct.cleaned(fx.contracts(spark, sf)), words.select("field", F.explode(pairs).alias("keyword")))


@query("strip_page_marks", f"""WITH {o.DOCS} SELECT contract_id, regexp_replace(t, 'Page \\d+ of \\d+', '', 'g') AS text
FROM (SELECT contract_id, 'Page ' || doc_id || ' of 9000' || chr(10) || replace(clean_text, chr(10), chr(10) || 'Page 7 of 12 ') AS t FROM docs)""")
def strip_page_marks(spark, sf):
    docs = ct.cleaned(fx.contracts(spark, sf))
    marked = F.concat(F.lit("Page "), F.col("doc_id").cast("string"), F.lit(" of 9000\n"),
                      F.replace("clean_text", F.lit("\n"), F.lit("\nPage 7 of 12 ")))
    return docs.select("contract_id", tx.strip_page_marks(marked).alias("text"))


HEADER = r"^[A-Z][a-z]+\.$"
_SECTIONS = o.READY + r""",
lines AS (SELECT contract_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
          FROM (SELECT contract_id, string_split(clean_text, chr(10)) AS l FROM ready)),
numbered AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-Z][a-z]+\.$') THEN 1 ELSE 0 END)
                     OVER (PARTITION BY contract_id ORDER BY i) AS section_no FROM lines)"""


@query("section_chunks", f"""WITH {_SECTIONS}
SELECT contract_id, CAST(section_no AS BIGINT) AS section_no, arg_min(line, i) AS header, string_agg(line, chr(10) ORDER BY i) AS section_text
FROM numbered GROUP BY contract_id, section_no""")
def section_chunks(spark, sf):
    return pl.section_chunks(fx.ready(spark, sf), HEADER)


_REFERENCED = rf"""docs AS (SELECT contract_id, doc_id,
    'SECTION 1' || chr(10) || replace(clean_text, '.' || chr(10), '.' || chr(10) || 'SECTION 2' || chr(10) || 'See Section 1 and see section 2.1 ') AS clean_text FROM base)"""


@query("section_refs", f"""WITH {o.DOCS.replace('docs AS', 'base AS', 1)}, {_REFERENCED},
lines AS (SELECT contract_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
          FROM (SELECT contract_id, string_split(clean_text, chr(10)) AS l FROM docs)),
numbered AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^(?i:section|article|schedule|exhibit|appendix) +[0-9A-Z]+') THEN 1 ELSE 0 END)
                     OVER (PARTITION BY contract_id ORDER BY i) AS section_no FROM lines),
sections AS (SELECT contract_id, CAST(section_no AS BIGINT) AS section_no,
                    regexp_extract(arg_min(line, i), '(?i)^(?:section|article|schedule|exhibit|appendix) +([0-9A-Z]+(?:\\.[0-9]+)*)', 1) AS target,
                    string_agg(line, chr(10) ORDER BY i) AS section_text FROM numbered GROUP BY contract_id, section_no),
refs AS (SELECT contract_id, unnest(r) AS target, generate_subscripts(r, 1) - 1 AS ref_no
         FROM (SELECT contract_id, regexp_extract_all(clean_text, '(?i)see section ([0-9]+(?:\\.[0-9]+)*)', 1) AS r FROM docs))
SELECT r.contract_id, r.ref_no, r.target, s.section_no, md5(s.section_text) AS section_md5
FROM refs r LEFT JOIN sections s ON s.contract_id = r.contract_id AND s.target = r.target""")
def section_refs(spark, sf):
    docs = ct.cleaned(ct.by_contract(fx.contracts(spark, sf)))
    text = F.concat(F.lit("SECTION 1\n"), F.replace("clean_text", F.lit(".\n"), F.lit(".\nSECTION 2\nSee Section 1 and see section 2.1 ")))
    docs = docs.select("contract_id", text.alias("clean_text"))
    refs = pl.section_refs(docs, pl.section_chunks(docs))
    return refs.select("contract_id", "ref_no", "target", "section_no", F.md5("section_text").alias("section_md5"))


_HEADER = r'^(?i:(section|article|schedule|exhibit|appendix)) +([0-9A-Z]+(?:\.[0-9]+)*)'
_PARTS = """replace(clean_text, '.' || chr(10), '.' || chr(10) || 'SECTION 2' || chr(10) || 'See Section 1 and see section 2 or see section 7 ')"""


@query("resolved_refs", f"""WITH {o.DOCS.replace('docs AS', 'base AS', 1)},
docs AS (SELECT contract_id, 'SECTION 1' || chr(10) || t || chr(10) || 'EXHIBIT A' || chr(10) || 'ARTICLE IV' || chr(10) || 'SECTION 1' || chr(10) || t
           || chr(10) || 'SECTION 7' || chr(10) || 'EXHIBIT B' || chr(10) || t AS clean_text FROM (SELECT contract_id, {_PARTS} AS t FROM base)),
lines AS (SELECT contract_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i FROM (SELECT contract_id, string_split(clean_text, chr(10)) AS l FROM docs)),
kinds AS (SELECT contract_id, line, i, lower(regexp_extract(line, '{_HEADER}', 1)) AS kind, regexp_extract(line, '{_HEADER}', 2) AS number FROM lines),
placed AS (SELECT *, count(*) FILTER (WHERE kind IN ('exhibit', 'schedule', 'appendix')) OVER (PARTITION BY contract_id ORDER BY i) AS exhibit FROM kinds),
sections AS (SELECT *, last_value(CASE WHEN kind = 'article' THEN number END IGNORE NULLS) OVER (PARTITION BY contract_id, exhibit ORDER BY i) AS article FROM placed),
refs AS (SELECT contract_id, i, exhibit, unnest(r) AS target, generate_subscripts(r, 1) AS nth
         FROM (SELECT *, regexp_extract_all(line, '(?i)see section ([0-9]+(?:\\.[0-9]+)*)', 1) AS r FROM placed)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY i, nth) - 1 AS ref_no FROM refs)
SELECT r.contract_id, r.ref_no, r.target, r.exhibit, s.i AS section_line, s.article FROM numbered r
LEFT JOIN sections s ON s.contract_id = r.contract_id AND s.exhibit = r.exhibit AND s.number = r.target AND s.kind = 'section'
QUALIFY row_number() OVER (PARTITION BY r.contract_id, r.ref_no ORDER BY abs(s.i - r.i), s.i) = 1""")
def resolved_refs(spark, sf):
    """Texts with a main part and two exhibits whose sections have the same numbers."""
    docs = ct.cleaned(ct.by_contract(fx.contracts(spark, sf)))
    part = F.replace("clean_text", F.lit(".\n"), F.lit(".\nSECTION 2\nSee Section 1 and see section 2 or see section 7 "))
    text = F.concat(F.lit("SECTION 1\n"), part, F.lit("\nEXHIBIT A\nARTICLE IV\nSECTION 1\n"), part, F.lit("\nSECTION 7\nEXHIBIT B\n"), part)
    return sections.resolved_refs(docs.select("contract_id", text.alias("clean_text")))


@query("changed_docs", f"""WITH {o.READY}
SELECT contract_id, sha256(clean_text) AS digest FROM ready WHERE doc_id % 3 <> 0""")
def changed_docs(spark, sf):
    """Two thirds of the texts were fingerprinted in another form, as if they had changed since."""
    docs = fx.ready(spark, sf)
    before = F.when(F.col("doc_id") % 3 == 0, F.col("clean_text")).otherwise(F.concat("clean_text", F.lit(" old")))
    fingerprints = docs.select("contract_id", F.sha2(before, 256).alias("digest"))
    return pl.changed_docs(docs.select("contract_id", "clean_text"), fingerprints).select("contract_id", "digest")


@query("doc_route", f"""WITH {o.READY}
SELECT contract_id, n_tokens, CASE WHEN n_tokens <= 120 THEN 'short' WHEN contains(lower(clean_text), 'licensed under')
       OR contains(lower(clean_text), 'nd the') THEN 'dense' ELSE 'standard' END AS route
FROM (SELECT contract_id, clean_text, len(regexp_extract_all(clean_text, '[^ \\n]+')) AS n_tokens FROM ready)""")
def doc_route(spark, sf):
    return pl.doc_route(fx.ready(spark, sf), 120, ("licensed under", "nd the"))


@query("token_overlap", f"""WITH {o.READY},
words AS (SELECT contract_id, doc_id, list_distinct(list_filter(regexp_split_to_array(lower(clean_text), '\\s+'), lambda w: w <> '')) AS w FROM ready),
shares AS (SELECT p.contract_id, CASE WHEN len(p.w) = 0 OR len(g.w) = 0 THEN 0.0 ELSE len(list_intersect(p.w, g.w))::DOUBLE / len(g.w) END AS share
           FROM words p JOIN words g ON g.doc_id = p.doc_id + 1)
SELECT contract_id, round(share, 3) AS score, share > 0.5 AS is_match FROM shares""")
def token_overlap(spark, sf):
    """Each whole text against the one with the next number."""
    docs = fx.ready(spark, sf)
    gold = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("clean_text").alias("gold"))
    return pl.token_overlap(docs.select("contract_id", "doc_id", F.col("clean_text").alias("predicted")).join(gold, "doc_id").drop("doc_id"))


@query("prf1", """WITH j AS (SELECT quality = 1 AS a, d.n_chars >= 1500 AS p FROM labels l JOIN documents d USING (doc_id)),
c AS (SELECT count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp,
             count(*) FILTER (WHERE NOT p AND a) AS fn, count(*) FILTER (WHERE NOT p AND NOT a) AS tn FROM j)
SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""")
def prf1(spark, sf):
    judged = fx.read(spark, sf, "labels").join(fx.read(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    counts = pl.prf1(judged, F.col("n_chars") >= 1500, F.col("quality") == 1)
    return counts.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])
