import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from clauseloom.llm import queries  # noqa: F401 - registers the queries
from clauseloom.llm.encoding import load_tokenizer
from clauseloom.llm.registry import QUERIES, SQL
from test_duplicates import brute_components


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage, with odd rows and a column whose name clashes."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("clash"))
    good = docs.orderBy(F.desc("n_chars")).limit(3)
    copies = good.withColumn("doc_id", F.col("doc_id") + 10_000)
    near = good.withColumns({"doc_id": F.col("doc_id") + 20_000, "text": F.concat("text", F.lit(" ending."))})
    leak = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").limit(2).select(
        (F.col("item_id") + 30_000).alias("doc_id"), F.concat(F.lit(good.first().text[:600] + "\n"), "text").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit("clash").alias("score"))
    odd = spark.createDataFrame([(40_000, None, "en", "s", None, "clash"), (40_001, "", None, None, 0, None), (None, "no id", "en", "s", 5, "clash")], "doc_id long, text string, lang string, source string, n_chars long, score string")
    found = [docs.unionByName(copies).unionByName(near).unionByName(leak).unionByName(odd)]
    for name, stage in cp.STAGES:
        found.append(cp.written(stage(spark, found[-1], sf), "stage"))
    return found


def test_stages_keep_the_columns_and_judge_what_came(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "minhash near-dedup", "benchmark decontamination", "bpe encoding and decoding"]
    sizes = [d.count() for d in stages]
    assert all(d.columns == stages[0].columns for d in stages[:5]) and sizes == sorted(sizes, reverse=True)
    assert all(d.where("score <> 'clash'").count() == 0 for d in stages[:5])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in stages]
    assert ids[5] == ids[4] <= ids[3] <= ids[2] <= ids[1] <= ids[0]


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    before, after = (d.join(labels, "doc_id") for d in stages[:2])
    good = before.where("quality = 1").count()
    assert after.where("quality = 1").count() >= 0.98 * good and after.where("quality = 0").count() <= 0.1 * before.where("quality = 0").count() + 1


def test_no_line_is_left_twice(stages):
    lines = stages[2].select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    assert lines.count() == lines.distinct().count()
    before = stages[1].select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    assert before.distinct().subtract(lines).count() <= 0.02 * before.distinct().count()  # every line stays once, but for near ones
    assert stages[2].where("text is not null and n_chars <> char_length(text)").count() == 0


def test_one_document_of_each_group_stays(spark, stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect() if r.doc_id is not None]
    roots = brute_components(rows, 5, 80)
    assert {r.doc_id for r in stages[3].collect()} == {d for d, root in roots.items() if d == root} | {r.doc_id for r in stages[2].collect() if r.doc_id is None}
    pool = cp.one_of_each_group(spark, stages[0], "")  # before lines are dropped, copies are whole
    rows = [(r.doc_id, r.text) for r in stages[0].collect() if r.doc_id is not None]
    roots = brute_components(rows, 5, 80)
    assert {r.doc_id for r in pool.collect()} - {None} == {d for d, root in roots.items() if d == root}


def test_no_item_is_left(spark, stages):
    items = [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    for r in stages[4].collect():
        text = " ".join(re.findall(r"[^\W_]+", (r.text or "").lower()))
        assert not any(" ".join(i) in text for i in items)
    assert stages[4].count() < stages[3].count()


def test_ids_are_those_of_the_library(stages):
    import public_tokenizers

    tokenizer = load_tokenizer(public_tokenizers.path(cp.VOCABULARY))
    texts = {r.doc_id: r.text or "" for r in stages[4].collect()}
    for r in stages[5].collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op4_chat_format", "op6_url_filter", "op8_quality_rules", "op9_near_dedup", "op11_warc_revisits",
                                  "op12_lexical_search", "op13_collocations"])
def test_queries_agree_with_sql(name):
    from verification.compare import main

    assert main("/root/testdata/sf0.001", [name]) == 0
