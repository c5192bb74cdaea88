import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clauseloom.fields import SLA_FIELDS, Field
from clauseloom.operators import chunking as ch
from clauseloom.operators import extraction as ex
from clauseloom.operators import prompts as pr
from clauseloom.operators import retrieval as rt
from clauseloom.operators import scoring as sc
from clauseloom.operators import vectors as ve
from clauseloom.operators import weights as wt
from clauseloom.plans import batch
from clauseloom.plans import evaluation as ev
from clauseloom.sources import contracts as ct
from clauseloom.sources import reports as rep
from verification import fixture as fx

from conftest import values


def chunks_of(spark, documents):
    rows = [(d, i, len(texts), t) for d, texts in documents.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "contract_id string, chunk_idx int, n_chunks int, chunk_text string").repartition("contract_id")


def queries_of(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "query_idx int, query_text string")


def brute_force(documents, queries, k):
    words = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    out = {}
    for d, texts in documents.items():
        n, held = len(texts), [words(t) for t in texts]
        idf = lambda w: math.log((1 + n) / (1 + sum(w in h for h in held))) + 1
        vec = lambda ws: {w: ws.count(w) * idf(w) for w in set(ws)}
        length = lambda v: math.sqrt(sum(x * x for x in v.values()))
        for q, text in enumerate(queries):
            qv = vec(words(text))
            scored = []
            for i, h in enumerate(held):
                cv = vec(h)
                product = sum(x * qv.get(w, 0) for w, x in cv.items()) / length(cv) if cv else 0.0
                scored.append((-round(product, 9), i, product / length(qv) if qv else 0.0))
            for r, (_, i, s) in enumerate(sorted(scored)[:k]):
                out[d, q, r + 1] = (i, round(s, 9))
    return out


DOCUMENTS = {
    "x": ["the law of the land", "pay the fee now", "nothing here", "the law the law", "...", "fee fee fee law"],
    "y": ["one chunk only about a fee"],
    "z": ["alpha", "beta", "alpha"],
}
QUERIES = ["law fee", "unknown words", "the the fee", "", "alpha beta"]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_ranking_agrees_with_brute_force(spark, k):
    ranked = rt.rank_chunks(chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES), k)
    got = {(r["contract_id"], r["query_idx"], r["rank"]): (r["chunk_idx"], round(r["similarity"], 9)) for r in ranked.collect()}
    assert got == brute_force(DOCUMENTS, QUERIES, k)


@pytest.mark.parametrize("k, most, closeness", [(1, 6, 0.3), (2, 4, 0.0), (3, 3, 0.5)])
def test_growing_k_agrees_with_brute_force(spark, k, most, closeness):
    found = values(rt.rank_adaptively(chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES), k, most, closeness),
                   "contract_id", "query_idx", "rank", "chunk_idx", "similarity")
    wide, expected = brute_force(DOCUMENTS, QUERIES, most), {}
    for d in DOCUMENTS:
        for q in range(len(QUERIES)):
            for r in range(1, most + 1):
                if (d, q, r) not in wide or r > k and not (wide[d, q, r][1] > 0 and wide[d, q, r][1] >= (1 - closeness) * wide[d, q, r - 1][1]):
                    break
                expected[d, q, r] = wide[d, q, r]
    assert {(d, q, r): (i, round(s, 9)) for d, q, r, i, s in found} == expected
    with pytest.raises(ValueError):
        rt.rank_adaptively(chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES), 3, 2, closeness)


def test_growing_k_finds_no_less_with_fewer_chunks(spark, sf):
    from verification.retrieval import adaptive_gain

    rows = adaptive_gain(spark, sf).collect()
    assert rows and all(r.found_fixed <= r.found_adaptive <= r.found_most and r.n_fixed <= r.n_adaptive <= r.n_most for r in rows)
    assert sum(r.n_fixed for r in rows) < sum(r.n_adaptive for r in rows) < sum(r.n_most for r in rows)


def test_gain_of_marked_rankings_is_that_of_whole_ones(spark):
    chunks, queries = chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES)
    first = sorted(DOCUMENTS)[0]
    again = chunks.where(F.col("contract_id") == first)
    chunks = chunks.unionByName(again).unionByName(again.withColumn("contract_id", F.lit(None).cast("string")))
    queries = queries.withColumn("query_group", F.lit("g"))
    relevant = spark.createDataFrame([(d, q, 0) for d in DOCUMENTS for q in range(2)] + [(None, 0, 0)], "contract_id string, query_idx int, chunk_idx int")
    plain = [rt.rank_chunks(chunks, queries, 3), rt.rank_adaptively(chunks, queries, 1, 3, 0.5)]
    marked = [rt.rank_chunks(chunks, queries, 3, relevant=relevant), rt.rank_adaptively(chunks, queries, 1, 3, 0.5, relevant)]
    for a, b in zip(plain, marked):
        assert sorted(map(str, values(b.drop("judged")))) == sorted(map(str, values(a)))
    right = {(r.contract_id, r.query_idx, r.chunk_idx) for r in relevant.collect()}
    for r in marked[0].where("contract_id is not null").collect():
        assert r.judged == (r.contract_id == first or (r.contract_id, r.query_idx, r.chunk_idx) in right)
    assert marked[0].where("not judged").count() > 0
    gains = [values(rt.adaptive_gain(wide, adaptive, queries, relevant, 1)) for wide, adaptive in (plain, marked)]
    assert gains[0] == gains[1] and gains[0]


def test_gain_ranks_stored_documents_once(spark):
    """Gathered documents rank as their chunks do, and what is counted of both rankings is stored, so that neither is made again."""
    chunks, queries = chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES).withColumn("query_group", F.lit("g"))
    again = chunks.where(F.col("contract_id") == sorted(DOCUMENTS)[0])
    chunks = chunks.unionByName(again).unionByName(again.withColumn("contract_id", F.lit(None).cast("string")))
    relevant = spark.createDataFrame([(d, q, 0) for d in DOCUMENTS for q in range(2)] + [(None, 0, 0)], "contract_id string, query_idx int, chunk_idx int")
    documents, gains = rt.gathered(chunks), []
    of_chunks = ["contract_id", "n_chunks", "chunk_idx", "chunk_text"]
    assert sorted(map(str, values(rt.spread(documents), *of_chunks))) == sorted(map(str, values(chunks, *of_chunks)))
    for given in (chunks, documents):
        wide, adaptive = rt.rank_chunks(given, queries, 3, relevant=relevant), rt.rank_adaptively(given, queries, 1, 3, 0.5, relevant)
        gain = rt.adaptive_gain(wide, adaptive, queries, relevant, 1)
        assert "MapInArrow" not in gain._jdf.queryExecution().executedPlan().toString()  # four passes before
        gains.append((sorted(map(str, values(wide))), sorted(map(str, values(adaptive))), values(gain)))
    assert gains[0] == gains[1] and gains[0][2]


def test_ranking_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ranked = rt.rank_chunks(chunks_of(spark, DOCUMENTS), queries_of(spark, *QUERIES), 2)
        got = {(r["contract_id"], r["query_idx"], r["rank"]): (r["chunk_idx"], round(r["similarity"], 9)) for r in ranked.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_force(DOCUMENTS, QUERIES, 2)


def test_context_has_each_text_once_in_first_seen_order(spark):
    chunks = chunks_of(spark, {"z": ["alpha", "beta", "alpha"]})
    context = rt.retrieve(chunks, queries_of(spark, "beta", "alpha"), 5).first()
    assert context["context"] == "beta\n\n---\n\nalpha" and context["n_chunks"] == 2


def test_retrieval_shuffles_each_document_once(spark, sf):
    chunks = ch.chunk(fx.ready_by_contract(spark, sf))
    plan = rt.retrieve(chunks, rt.default_queries(spark))._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(contract_id" in line]
    assert shuffles and all("REPARTITION_BY_COL" in line for line in shuffles)
    assert "Join" not in plan and "CartesianProduct" not in plan and plan.count("MapInArrow") == 1  # the texts are taken where they are ranked


def test_blocks_of_queries_and_of_chunks_change_nothing(spark, sf, monkeypatch):
    from clauseloom.operators import chunking as ch
    from verification import fixture as fx

    chunks, queries = ch.chunk(fx.ready_by_contract(spark, sf), 40, 10), fx.benchmark_queries(spark, sf).limit(30)
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = rows(rt.rank_chunks(chunks, queries)), rows(rt.retrieved(chunks, queries)), rows(rt.retrieve(chunks, queries))
    assert whole[0] and rows(rt.contexts(rt.retrieved(chunks, queries))) == whole[2]
    monkeypatch.setattr(rt, "CELLS", 100)
    assert [(*r[:4], round(r[4], 9)) for r in rows(rt.rank_chunks(chunks, queries))] == [(*r[:4], round(r[4], 9)) for r in whole[0]]
    monkeypatch.setattr(rt, "BLOCK_QUERIES", 7)
    assert rows(rt.retrieved(chunks, queries)) == whole[1] and rows(rt.retrieve(chunks, queries)) == whole[2]
    assert rt.rank_chunks(chunks, queries.where("false")).count() == 0 == rt.rank_chunks(chunks.where("false"), queries).count()


def test_prompt_slot_and_braces(spark):
    contexts = spark.createDataFrame([("a", "text {context} {{x}}")], "contract_id string, context string")
    messages = pr.messages(contexts, "J {{}} of {context}!").first()["messages"]
    assert [m["role"] for m in messages] == ["system", "user"]
    assert messages[1]["content"] == "J {} of text {context} {{x}}!"
    template = pr.default_template()
    assert template.count("{context}") == 1 and all(f'"{f.name}"' in template for f in SLA_FIELDS)


FIELDS = (Field("q", keywords=("kw",), pattern="law"), Field("none", pattern="law"),
          Field("flag", kind="boolean"), Field("amount", kind="presence"))


def score(spark, value, text="a kw and\nthe law of   lands", flag=None, amount=None):
    results = spark.createDataFrame([("c", value, None, flag, amount)], "contract_id string, q string, none string, flag int, amount string")
    texts = spark.createDataFrame([("c", text)] if text is not None else [], "contract_id string, clean_text string")
    return {r["field"]: r["score"] for r in sc.field_scores(sc.score_results(results, texts, FIELDS)).collect()}


@pytest.mark.parametrize("value, expected", [
    ("THE LAW", 1.0), ("kw and the law", 1.0), ("kw and", 0.8), ("some law", 0.6), ("some", 0.4), ("", 0.0), (None, 0.0), (" ", 0.8)])
def test_score_ladder(spark, value, expected):
    assert score(spark, value)["q"] == expected


def test_a_true_start_with_an_invented_end_is_not_fully_quoted(spark):
    text = "The parties agree to the law of the land.\nNotices " + "are given in writing " * 10
    values = [(text[:130], True), (text[:130] + " and an invented end", False), (text.replace("\n", "  ")[:150], True), ("some", False), ("", None), (None, None)]
    results = spark.createDataFrame([(str(i), v, None, None, "$5") for i, (v, _) in enumerate(values)], "contract_id string, q string, none string, flag int, amount string")
    texts = spark.createDataFrame([(str(i), text) for i in range(len(values))], "contract_id string, clean_text string")
    rows = {(r["contract_id"], r["field"]): r for r in sc.field_scores(sc.score_results(results, texts, FIELDS)).collect()}
    assert [rows[str(i), "q"]["fully_quoted"] for i in range(len(values))] == [w for _, w in values]
    assert rows["1", "q"]["score"] == 1.0 and rows["0", "amount"]["fully_quoted"] is None


def test_score_corners(spark):
    assert score(spark, None, text="no word of it")["q"] is None
    assert score(spark, "law", text=None)["q"] == 0.6 and score(spark, "x", text=None)["q"] == 0.4
    assert score(spark, None)["none"] is None
    special = score(spark, None, flag=0, amount="")
    assert special["flag"] == 1.0 and special["amount"] is None
    assert score(spark, None, amount="$5")["amount"] == 1.0 and score(spark, None)["flag"] is None


def test_full_lexicon(spark):
    names = [f.name for f in SLA_FIELDS]
    row = {n: None for n in names} | {"governing_law": "laws of the State of Delaware"}
    schema = ", ".join(["contract_id string"] + [f"{n} {'int' if n == 'penalty_has_monetary' else 'string'}" for n in names])
    results = spark.createDataFrame([("c", *row.values())], schema)
    texts = spark.createDataFrame([("c", "Uptime of 99.9% under the laws of the State of Delaware.")], "contract_id string, clean_text string")
    scores = {r["field"]: r["score"] for r in sc.field_scores(sc.score_results(results, texts, SLA_FIELDS)).collect()}
    assert scores["governing_law"] == 1.0 and scores["uptime_guarantee"] == 0.0 and scores["renewal_terms"] is None


def test_non_contracts_are_left_out_and_empty_scores_are_zero(spark):
    results = spark.createDataFrame([("paper", "x"), ("plain", None)], "contract_id string, q string")
    texts = spark.createDataFrame([("paper", "see arXiv: 1"), ("plain", "nothing")], "contract_id string, clean_text string")
    scored = sc.score_results(results, texts, FIELDS[:1])
    summary = ev.eval_summary(scored).first()
    assert (summary["n_contracts"], summary["n_excluded"], summary["avg_overall"]) == (1, 1, 0.0)
    assert values(sc.excluded(scored)) == [("paper",)]


def test_every_field_adds_up_and_the_report_agrees(spark, sf, tmp_path):
    scored = sc.score_results(fx.results(spark, sf), fx.ready_by_contract(spark, sf), fx.FIELDS).cache()
    n = scored.count()
    summary = {r["field"]: r for r in ev.field_summary(scored).collect()}
    assert all(r["extracted"] + r["missed"] + r["absent"] == n for r in summary.values())
    report = ev.eval_report(scored, fx.FIELDS).first()
    assert report["n_contracts"] == n
    assert {f: v["missed"] for f, v in report["per_field"].items()} == {f: r["missed"] for f, r in summary.items()}
    rep.write_report(scored, str(tmp_path / "r"), fx.FIELDS)
    flat = rep.flatten_report(rep.read_per_contract(spark, str(tmp_path / "r")))
    assert flat.count() == n * len(fx.FIELDS) and flat.where("score is null").count() == sum(r["absent"] for r in summary.values())
    scored.unpersist()


def test_fixture_score_counts(spark):
    big = "/root/testdata/sf0.01"
    rows = sc.field_scores(sc.score_results(fx.results(spark, big), fx.ready_by_contract(spark, big), fx.FIELDS))
    counts = {(r["field"], r["score"]): r["count"] for r in rows.groupBy("field", "score").count().collect()}
    expected = {"opening_quote": {1.0: 317, 0.8: 235, 0.0: 242, None: 185}, "spaced_quote": {1.0: 197, 0.8: 332, None: 450},
                "invented": {0.6: 304, 0.4: 310, 0.0: 141, None: 224}, "license_line": {1.0: 21, 0.0: 16, None: 942}}
    assert {k: v for k, v in counts.items() if k[0] in expected} == {(f, s): n for f, c in expected.items() for s, n in c.items()}


def test_extraction_takes_the_first_match_in_context_order(spark):
    seen = spark.createDataFrame([("c", 7, "Late fee is high. A fee of $5."), ("c", 2, "No. Fee of 3% here. Fee of 4% too.")],
                                 "contract_id string, seen int, chunk_text string")
    fields = (Field("fee", keywords=("fee of",), pattern=r"[0-9]"), Field("word", keywords=("late",)))
    assert values(ex.extract_clauses(seen, fields), "fee", "word") == [("Fee of 3% here.", "Late fee is high.")]


def test_money_rule(spark):
    data = [("a", "A fee of $1,000 or EUR 2K", None), ("b", None, "credit of 5%"), ("c", None, None), ("d", "interest of 2%", None), ("e", "a fine", None)]
    df = spark.createDataFrame(data, "contract_id string, p string, q string")
    got = {r["contract_id"]: (r["penalty_has_monetary"], r["penalty_max_amount"], r["penalty_currency"])
           for r in ex.monetary_summary(df, ["p", "q"]).collect()}
    assert got == {"a": (True, "$1,000", "USD"), "b": (False, None, None), "c": (None, None, None),
                   "d": (True, None, None), "e": (False, None, None)}


def test_currencies_are_not_compared(spark):
    df = spark.createDataFrame([("a", "EUR 5 or $1,000", "USD 2K and €7"), ("b", None, "none"), ("c", None, None)], "contract_id string, p string, q string")
    got = values(ex.amounts_by_currency(df, ["p", "q"]).withColumn("value", F.col("value").cast("double")), "contract_id", "currency", "value", "text")
    assert sorted(got) == [("a", "EUR", 7.0, "€7"), ("a", "USD", 2000.0, "USD 2K")]


def test_hashed_weights_join_on_no_term(spark, sf):
    chunks = ch.chunk(ct.ready(fx.contracts(spark, sf)), 120, 20).select("contract_id", "chunk_idx", "chunk_text")
    hashed = ve.hashed_vectors(chunks, 1 << 16)
    lengths = hashed.groupBy("contract_id", "chunk_idx").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert lengths.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0
    plan = hashed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan
    # bins enough for the terms: as many features as without hashing but for a few that meet
    plain = ve.corpus_vectors(chunks).count()
    assert 0.95 * plain <= hashed.count() <= plain
    assert ve.hashed_vectors(chunks.where("false"), 8).count() == 0


def test_rule_results_have_the_shape_of_the_table(spark, sf):
    contracts = fx.contracts(spark, sf).select("contract_id", F.lit("f").alias("file_path"), "text")
    rows = batch.rule_results(contracts, rt.default_queries(spark), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    from clauseloom.fields import result_schema
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in result_schema()]
    assert rows.count() == ct.ready(contracts).count()


def test_vectors(spark):
    data = [(1, [3.0, 4.0]), (2, [0.0, 0.0])]
    units = ve.normalised(spark.createDataFrame(data, "vec_id int, e array<float>"), "e", 2)
    assert sorted(values(units, "vec_id", "norm", "unit")) == [(1, 5.0, [0.6, 0.8]), (2, 0.0, [0.0, 0.0])]
    with pytest.raises(Exception, match="expected 3 values"):
        ve.normalised(spark.createDataFrame(data, "vec_id int, e array<float>"), "e", 3).collect()


def test_keyword_table_agrees_with_looking_for_each(spark):
    """Keywords of any length as rows, also with capitals, blanks, repeats and nulls; texts of any length."""
    from clauseloom.operators import extraction as ex

    texts = {"a": "The fee is due. Late FEES apply", "b": "", "c": None, "d": "x", "e": "aaaa aaab", "f": "under a licence, é ünder", "g": "the " * 5000}
    words = [("f1", "fee"), ("f1", "Fee "), ("f2", "late fees"), ("f2", "x"), ("f2", "aaab"), ("f3", "aa"), ("f3", "nowhere to be found"), ("f3", None), ("f3", ""),
             (None, "the"), ("f1", "fee"), ("f4", "é ünd"), ("f4", "e t"), ("f5", "licence, é")]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "contract_id string, clean_text string, gram string")
    table = spark.createDataFrame([(*w, "clash") for w in words], "field string, keyword string, contract_id string")
    got = ex.keyword_table_hits(docs, table)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    expected = {(k, f, w) for k, t in texts.items() for f, w in words if t and w and w.lower() in t.lower()}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == expected and len(rows) == len(expected)
    assert ex.keyword_table_hits(docs, table.where("false")).count() == 0 == ex.keyword_table_hits(docs.where("false"), table).count()


def test_near_vectors_in_small_steps(spark, monkeypatch):
    """Pairs are met in steps of bounded size, and all of them are still met."""
    rows = [(i, [float((i * 7 + j * j) % 11 - 5) + 0.1 for j in range(8)]) for i in range(60)]
    units = ve.normalised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", 8)
    queries = units.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_idx"), "unit")
    whole = sorted(values(ve.near_candidates(units, queries, cut=1.0), "query_idx", "vec_id"))
    monkeypatch.setattr(ve, "CELLS", 3 * 8 * 4)
    assert sorted(values(ve.near_candidates(units, queries, cut=1.0), "query_idx", "vec_id")) == whole and len(whole) == 180


def _ranked_by_hand(vectors, queries, k, met=lambda q, v: True):
    """The k best of (id, group, unit) rows for (query, group, unit) rows of the same group: rounded similarity, then id, nulls first."""
    expected = set()
    for query, of, unit in queries:
        scored = []
        for vec_id, group, v in vectors:
            if of is not None and group == of and met(unit, v):
                total = 0.0
                for x, y in zip(unit, v):
                    total += x * y
                scored.append((-round(total, 9), vec_id is not None, vec_id or 0))
        expected |= {(query, rank, None if not known else vec_id, -s) for rank, (s, known, vec_id) in enumerate(sorted(scored)[:k], 1)}
    return expected


def test_nearest_vectors_agree_with_brute_force(spark, monkeypatch):
    """Exact and approximate search, with ties, equal vectors, repeated and missing keys, in small steps and blocks."""
    rows = [(i, ("a", "b", None)[i % 3], [float((i * 7 + j * j + i * j) % 11 - 5) + 0.1 for j in range(8)]) for i in range(90)]
    rows += [(200 - i, "a", [1.0] * 8) for i in range(40)] + [(7, "b", [2.0, *[0.0] * 7]), (7, "b", [0.0] * 8), (None, "a", [1.0] * 8)]
    units = ve.normalised(spark.createDataFrame(rows, "vec_id long, group_id string, embedding array<double>"), "embedding", 8).repartition(5)
    queries = units.where("vec_id % 10 = 0").select("group_id", F.col("vec_id").alias("query_idx"), "unit")
    vectors, asked = values(units, "vec_id", "group_id", "unit"), values(queries, "query_idx", "group_id", "unit")
    assert any(g is None for _, g, _ in asked) and len(asked) > 10
    a = np.arange(8)[:, None] * 97 + np.arange(256)[None, :] * 389 + 7
    planes = (a * a * 31 + a * 17) % 1009 / 504.5 - 1
    near = lambda q, v: ((np.array(q) @ planes > 0) != (np.array(v) @ planes > 0)).sum() <= 0.44 * 256
    everyone = lambda found: [(x, 0, u) for x, _, u in found]
    few = [q for q, _, u in asked if sum(near(u, v) for _, _, v in vectors) < 50]
    by_sketch = {r for q in asked for r in _ranked_by_hand(everyone(vectors), everyone([q]), 50, (lambda *_: True) if q[0] in few else near)}
    assert 0 < len(few) < len(asked)
    for cells, numbers in ((2_000_000, 2_000_000), (40, 64)):
        monkeypatch.setattr(ve, "CELLS", cells)
        monkeypatch.setattr(ve, "BLOCK_NUMBERS", numbers)
        exact = ve.top_k_vectors(units, queries, 4)
        assert "Join" not in exact._jdf.queryExecution().executedPlan().toString()  # pairs are no rows
        got = [(r.query_idx, r.rank, r.vec_id, round(r.similarity, 9)) for r in exact.collect()]
        assert set(got) == _ranked_by_hand(vectors, asked, 4) and len(got) == len(set(got))
        got = [(r.query_idx, r.rank, r.vec_id, round(r.similarity, 9)) for r in ve.approximate_neighbours(units, queries, 50).collect()]
        assert set(got) == by_sketch and len(got) == len(set(got))
    assert ve.top_k_vectors(units, queries.where("false"), 4).count() == 0 == ve.approximate_neighbours(units, queries.where("false"), 4).count()


def test_pairs_of_sketches_are_not_written(spark, monkeypatch):
    units = ve.normalised(spark.createDataFrame([(i, [1.0, 1.0 + i / 1000]) for i in range(500)], "vec_id long, embedding array<double>"), "embedding", 2)
    kept, stored = [], ve.written
    monkeypatch.setattr(ve, "written", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    queries = units.where("vec_id < 20").select(F.col("vec_id").alias("query_idx"), "unit")
    assert ve.approximate_neighbours(units, queries, 3).count() == 60
    assert kept[0].count() <= 20 * 3 * ve.TASKS_PER_CORE * spark.sparkContext.defaultParallelism  # 10,000 before


def test_ninth_digits_round_as_spark_does(spark):
    numbers = [0.1234567885, 0.1234567895, -0.1234567885, 0.5, 1.0, 0.0, -0.0, 0.30000000049999999, 0.9999999995, *np.random.default_rng(1).uniform(-1, 1, 500).round(10).tolist()]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double").select("i", F.round("x", 9).alias("r")).orderBy("i")
    assert [round(r.r * 1e9) for r in df.collect()] == ve._ninth_digits(np.array(numbers)).tolist()
    assert ve._ninth_digits(np.array([np.nan]))[0] > ve._ninth_digits(np.array([1.0]))[0]


def test_slices_of_documents():
    """A batch becomes Python objects a bounded slice at a time, with nothing lost between the slices."""
    chunks = [[{"chunk_idx": i, "chunk_text": f"{d} {i}"} for i in range(d % 4)] for d in range(50)]
    batch = pa.RecordBatch.from_pylist([{"contract_id": str(d), "n_chunks": len(c), "chunks": c} for d, c in enumerate(chunks)])
    slices = list(rt._slices([batch.slice(3), batch.slice(0, 3)], 200))
    found = [(d, [{"chunk_idx": int(i), "chunk_text": t} for i, t in zip(numbers, texts)])
             for ids, parts in slices for d, (_, numbers, texts) in zip(ids.to_pylist(), parts)]
    assert len(slices) > 5 and found == [(str(d), chunks[d]) for d in [*range(3, 50), 0, 1, 2]]


def test_terms_are_counted_where_their_document_is(spark):
    """No row of a chunk and a term is sorted or shuffled to be weighed, and rare terms that are looked up by a join weigh the same."""
    chunks = chunks_of(spark, {str(d): [f"law {'of' * (d % 3)} w{d * i % 7} w{d}" for i in range(1, 5)] for d in range(12)})
    whole = sorted(values(ve.corpus_vectors(chunks), "contract_id", "chunk_idx", "term", "weight"))
    assert sorted(values(ve.corpus_vectors(chunks, 2), "contract_id", "chunk_idx", "term", "weight")) == whole and whole
    for weighed in (wt.chunk_term_weights(chunks), ve.hashed_vectors(chunks, 64), ve.corpus_vectors(chunks)):
        plan = weighed._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan


def test_keywords_meet_texts_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([("a", "The Fee of ten"), ("a", "late fee"), (None, "fee"), ("b", None), ("c", "")], "contract_id string, clean_text string")
    table = spark.createDataFrame([("x", "fee of"), ("y", "Late"), ("x", "t"), ("x", "often"), ("x", "")], "field string, keyword string")
    monkeypatch.setattr(ex, "BLOCK_KEYWORDS", 1)
    monkeypatch.setattr(ex, "HIT_ROWS", 1)
    found = sorted(values(ex.keyword_table_hits(docs, table), "contract_id", "field", "keyword"))
    assert found == [("a", "x", "fee of"), ("a", "x", "t"), ("a", "y", "Late")]
