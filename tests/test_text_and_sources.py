import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clauseloom.functions import money
from clauseloom.functions import text as tx
from clauseloom.operators import chunking as ch
from clauseloom.plans import planned as pl
from clauseloom.plans import sections
from clauseloom.sources import contracts as ct

from conftest import values


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize("raw, clean", [
    ("a\r\nb\rc", "a\nb\nc"), ("a\n\n\n\nb", "a\n\nb"), ("a \t b", "a b"), ("a\tb", "a b"), ("café x", "caf  x"),
    (" x", "x"), ("a\r\n\r\n\r\nb", "a\n\nb"), ("a 😀 b", "a   b"), ("", ""), (" x\n", "x"),
])
def test_clean(spark, raw, clean):
    assert one(spark, raw, tx.clean_text) == clean


@given(st.lists(st.text(alphabet="ab \t\r\n.é 😀", max_size=40), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_clean_agrees_with_its_definition(spark, texts):
    def expected(t):
        t = re.sub(r"\r\n?", "\n", t)
        t = re.sub(r"\n\n\n+", "\n\n", t)
        t = re.sub(r"[ \t][ \t]+", " ", t)
        return re.sub(r"[^ -~\n]", " ", t).strip()

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(values(rows.select("i", tx.clean_text(F.col("t")).alias("c"))))
    assert got == {i: expected(t) for i, t in enumerate(texts)}


def test_sentences_keep_inner_dots(spark):
    text = "Uptime is 99.9% here. See a.b@c.de now! Next?\nNew line"
    assert one(spark, text, tx.sentences) == ["Uptime is 99.9% here.", "See a.b@c.de now!", "Next?", "New line"]
    assert one(spark, "...", tx.sentences) == []


def test_sentences_of_very_long_text_without_stops(spark):
    assert one(spark, "1.2,3.4;" * 60_000, tx.sentences) == ["1.2,3.4;" * 60_000]


def _packed(counts, size, overlap):
    """Spans by trying every start and end."""
    spans, i, n = [], 0, len(counts)
    while n:
        j = max(e for e in range(i, n) if sum(counts[i:e + 1]) <= size)
        spans.append((i + 1, j + 1, sum(counts[i:j + 1])))
        if j == n - 1:
            break
        i = min(k for k in range(i + 1, j + 2) if sum(counts[k:j + 1]) <= overlap and sum(counts[k:j + 2]) <= size)
    return spans


@given(st.lists(st.lists(st.integers(1, 9), max_size=40), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_packing_agrees_with_brute_force(spark, lists):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(lists)], "i int, c array<int>")
    for size, overlap in ((9, 4), (20, 7), (12, 0)):
        got = dict(values(rows.select("i", ch.pack(F.col("c"), size, overlap).alias("s"))))
        for i, counts in enumerate(lists):
            assert [tuple(s) for s in got[i]] == _packed(counts, size, overlap)


def test_chunks_lose_no_sentence_and_stay_in_size(spark):
    text = " ".join(f"Word{i} says something{'.' if i % 3 else ', long'}" for i in range(400)) + "\n" + "w  " * 300
    docs = spark.createDataFrame([("a", text), ("b", "short one.")], "contract_id string, text string")
    ready = ct.cleaned(docs)
    chunks = ch.chunk(ready, 50, 10).orderBy("contract_id", "chunk_idx").collect()
    assert all(c["n_tokens"] <= 50 and len(c["chunk_text"].split()) == c["n_tokens"] for c in chunks)
    assert {c["contract_id"]: c["n_chunks"] for c in chunks}["b"] == 1
    words = set(text.split())
    assert words == {w for c in chunks if c["contract_id"] == "a" for w in c["chunk_text"].split()}


def test_page_assembly_over_blocks(spark):
    rows = [("d", n, None if n % 7 == 0 else f"p{n}") for n in range(ct.PAGE_BLOCK * 2 + 5)] + [("e", 3, "only")]
    pages = spark.createDataFrame(rows[::-1], "id string, no int, t string")
    got = {r["contract_id"]: r["text"] for r in ct.assemble_pages(pages, "id", "no", "t").collect()}
    assert got == {"d": "\n".join(t or "" for _, _, t in rows[:-1]), "e": "only"}


def test_admission(spark):
    fill = "x" * 199
    rows = [(0, "Atticus Dataset " + fill), (1, fill), (2, " " + fill + "y "), (3, "z" * 400 + " arXiv: " + fill),
            (4, "z" * 600 + " arxiv: " + fill), (5, "Abstract\n" + fill), (6, "atticus dataset " + fill), (12345, fill + "zz")]
    docs = spark.createDataFrame(rows, "i long, t string")
    assert sorted(r["contract_id"] for r in ct.admit(docs, "i", "t").collect()) == ["cuad_0002", "cuad_0004", "cuad_0006", "cuad_12345"]


def test_listing_orders_text_files_first(spark):
    paths = spark.createDataFrame([("/x/b.pdf",), ("/x/b.txt",), ("/x/a.pdf",), ("/x/c.d.txt",), ("/x/n.doc",)], "path string")
    assert values(ct.corpus_listing(paths), "contract_id") == [("b",), ("c.d",), ("a",), ("b",)]
    assert values(ct.corpus_listing(paths, 1), "contract_id") == [("b",)]


def test_file_scan(spark, tmp_path):
    (tmp_path / "c1.txt").write_bytes(b"ok \xff end\r\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c2.txt").write_text("nested")
    rows = values(ct.scan_files(spark, str(tmp_path)), "contract_id", "text")
    assert rows == [("c1", "ok � end\r\n")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ct.scan_files(spark, str(tmp_path / "none")).collect()


def test_corpus_is_a_dataset_or_files(spark, tmp_path):
    files, stored = tmp_path / "files", tmp_path / "stored"
    files.mkdir()
    for name in ("b", "a", "c"):
        (files / f"{name}.txt").write_text(name)
    assert sorted(values(ct.load_corpus(spark, str(files), 2), "contract_id")) == [("a",), ("b",)]
    spark.createDataFrame([(0, "x"), (1, None), (2, "z")], "position long, text string").write.parquet(str(stored))
    assert sorted(values(ct.load_corpus(spark, str(stored), 2), "contract_id", "text")) == [("cuad_0", "x"), ("cuad_1", "")]
    assert sorted(values(ct.load_corpus(spark, str(stored), 2, order=["text"]), "contract_id", "text")) == [("cuad_0", ""), ("cuad_1", "x")]


def test_positions_are_dense_and_in_order(spark):
    keys = [None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 7}" for i in range(500)]
    rows = [(i, key, "x") for i, key in enumerate(keys)] + [(3, keys[3], "x")]  # one row stands twice
    table = spark.createDataFrame(rows, "row_id long, key string, part string").repartition(5)
    got = values(ct.positioned(table, ["key"]), "position", "key", "row_id", "part")
    assert sorted(p for p, *_ in got) == list(range(501))
    ordered = [key for _, key, *_ in sorted(got, key=lambda r: r[0])]
    assert ordered == sorted(ordered, key=lambda k: (k is not None, k or ""))
    assert sorted(i for _, _, i, _ in got) == sorted(i for i, _, _ in rows)
    plan = ct.positioned(table, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert ct.positioned(table.where("false"), ["key"]).count() == 0


def test_non_contract_marker_window(spark):
    marker = "arxiv:"
    assert one(spark, "x" * 900 + marker, tx.is_non_contract)
    assert not one(spark, "x" * 1000 + marker, tx.is_non_contract)


@pytest.mark.parametrize("text, value, currency", [
    ("$1,234.50", 1234.5, "USD"), ("EUR 2 million", 2e6, "EUR"), ("£5K", 5000, "GBP"), ("USD 7", 7, "USD"), ("none", None, None),
    ("$2 million per breach", 2e6, "USD"), ("up to $1.5M in aggregate", 1.5e6, "USD"), ("$3 billion", 3e9, "USD"), ("5,000 USD", 5000, "USD"),
    ("capped at 12 months of fees, at most $100,000", 1e5, "USD"), ("$10k", 1e4, "USD"), ("€1.2 billion", 1.2e9, "EUR"),
    ("USD 20 or 3 million GBP, 7 months", 3e6, "GBP")])
def test_amounts(spark, text, value, currency):
    top = money.largest(money.amounts(F.col("t")))
    row = spark.createDataFrame([(text,)], "t string").select(top["value"].cast("double").alias("n"), money.currency(top["text"]).alias("c")).first()
    assert (row["n"], row["c"]) == (value, currency)


def test_penalties_are_compared_in_one_currency(spark):
    rows = spark.createDataFrame([("a", "€9 million or $10k"), ("b", "$2 million per breach"), ("c", "12 months"), ("d", None)],
                                 "contract_id string, penalty_max_amount string")
    assert values(pl.penalty_over(rows, 50_000), "contract_id") == [("b",)]
    assert values(pl.penalty_over(rows, 50_000, "EUR"), "contract_id") == [("a",)]


def test_empty_text_has_no_tokens(spark):
    row = spark.createDataFrame([("", "a b\nc")], "x string, y string").select(tx.token_count(F.col("x")), tx.token_count(F.col("y"))).first()
    assert tuple(row) == (0, 3)


def test_token_overlap(spark):
    rows = spark.createDataFrame([(1, "a b", "a c"), (2, "a", ""), (3, None, "x"), (4, "A b c", "a b")], "i int, predicted string, gold string")
    assert sorted(values(pl.token_overlap(rows))) == [(1, 0.5, False), (2, 0.0, False), (3, 0.0, False), (4, 1.0, True)]


def test_sections_and_references(spark):
    text = "Preamble\nSECTION 1\nSee Section 2.1 and see section 9\nSECTION 2.1\nFound"
    docs = spark.createDataFrame([("d", text)], "contract_id string, clean_text string")
    sections = pl.section_chunks(docs)
    assert values(sections.orderBy("section_no"), "section_no", "header") == [(0, "Preamble"), (1, "SECTION 1"), (2, "SECTION 2.1")]
    refs = values(pl.section_refs(docs, sections).orderBy("ref_no"), "target", "section_text")
    assert refs == [("2.1", "SECTION 2.1\nFound"), ("9", None)]


def test_references_lead_to_the_nearest_section_of_their_exhibit(spark):
    text = "\n".join(["See section 1", "ARTICLE II", "Section 1 Scope", "x see section 2", "Section 2 Term", "as see Section 1 and see section 9",
                      "EXHIBIT A", "see section 1", "Section 1 Fees", "x", "Section 1 Fees", "see section 1, see section 2"])
    df = spark.createDataFrame([("a", text), ("b", None), ("c", "")], "contract_id string, clean_text string")
    got = values(sections.resolved_refs(df).orderBy("ref_no"), "contract_id", "ref_no", "target", "exhibit", "section_line", "article")
    assert got == [("a", 0, "1", 0, 2, "II"), ("a", 1, "2", 0, 4, "II"), ("a", 2, "1", 0, 2, "II"), ("a", 3, "9", 0, None, None),
                   ("a", 4, "1", 1, 8, None), ("a", 5, "1", 1, 10, None), ("a", 6, "2", 1, None, None)]


def test_resolved_references_shuffle_by_contract_alone(spark):
    df = spark.createDataFrame([("a", "see section 1")], "contract_id string, clean_text string")
    plan = sections.resolved_refs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_references_are_resolved_text_by_text(spark):
    """No mark is sorted with those of other texts; rows of one id are one text."""
    df = spark.createDataFrame([("a", "SECTION 1\nsee section 2\nSECTION 2\nEXHIBIT A\nsee section 2"), ("b", None)], "contract_id string, clean_text string")
    refs = sections.resolved_refs(df)
    assert "Window" not in refs._jdf.queryExecution().executedPlan().toString()
    assert sorted(values(refs, "ref_no", "target", "exhibit", "section_line", "article")) == [(0, "2", 0, 2, None), (1, "2", 1, None, None)]
    assert sorted(values(sections.marks(df), "line", "kind", "exhibit")) == [(0, "section", 0), (1, "reference", 0), (2, "section", 0), (3, "exhibit", 1), (4, "reference", 1)]


def test_tasks_put_scanned_files_in_place(spark, sf, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from verification import texts

    given, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, key, value: given.update({key: value}) or option(self, key, value))
    rows = texts.scan_text(spark, sf).collect()
    expected = [len(r.text or "") + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(r.n_chars for r in rows) == sorted(expected)
    assert given["maxRecordsPerFile"] == 1 and given["mapreduce.fileoutputcommitter.algorithm.version"] == "2"  # else the driver moves each file


def test_tasks_write_files_themselves_where_they_can(spark, tmp_path, monkeypatch):
    """Each row is one file with nothing beside it, in folders of a bounded size; other stores go through Spark's writer."""
    monkeypatch.setattr(ct, "FOLDER_FILES", 3)
    texts = ["one", "", "two\nlines\r\n", "é€", "one", None, *(f"text {i}" for i in range(20))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = sorted((t or "") + "\n" for t in texts)
    for name, own in (("own", True), ("spark", False)):
        if not own:
            monkeypatch.setattr(ct, "local_path", lambda *_: None)
        folders = ct.write_files(df, f"file://{tmp_path}/{name}")
        assert sorted(r.text for r in ct.scan_files(spark, folders).collect()) == expected
        if own:
            files = [f for f in (tmp_path / name).rglob("*") if f.is_file()]
            assert len(files) == len(texts) and len({f.name for f in files}) == len(texts) and all(f.suffix == ".txt" for f in files)
            assert len(folders) >= 9
            assert ct.scan_files(spark, ct.write_files(df.where("false"), str(tmp_path / "none"))).count() == 0


def test_only_files_of_ended_attempts_are_read(spark, tmp_path):
    folders = ct.write_files(spark.createDataFrame([("a",), ("b",)], "text string"), str(tmp_path / "texts"))
    (tmp_path / "texts" / "0-999-0").mkdir()
    (tmp_path / "texts" / "0-999-0" / "0-0.txt").write_text("of an attempt that failed\n")
    assert sorted(r.text for r in ct.scan_files(spark, folders).collect()) == ["a\n", "b\n"]


def test_a_task_reads_many_small_files(spark, tmp_path):
    for i in range(1500):
        (tmp_path / f"{i}.txt").write_text(str(i))
    files = ct.scan_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() <= 16  # 47 splits of 32 files before
    assert sorted(int(r.text) for r in files.collect()) == list(range(1500))
