import math
import re
import statistics
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clauseloom.llm import quality_gam as gam
from clauseloom.llm import quality_rules as rules


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, None, "en"), (-2, "", None), (-3, " \n\n \x1c", "en"), (-4, "a b c a b c\nx\nx\n\nx", "xx"), (-5, "é#\n" * 400, "en"), (-5, "é#\n" * 400, "en"),
           (-6, "word " * 40_000, "en")]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({"kept": F.lit("clash"), "n_words": F.lit("clash")})


def test_counts_and_distances_agree_with_plain_python(spark, sf):
    docs = table(spark, sf)
    texts = [(r.doc_id, r.text or "", r.lang or "") for r in docs.collect()]
    judged = rules.judge_quality(docs, typical=True).collect()
    got = {r.doc_id: r for r in judged}
    assert len(judged) == len(texts)
    words_of = Counter()
    for _, t, lang in texts:
        words_of.update((lang, w) for w in re.findall(r"[^\x20\x09-\x0D]+", t))
    total = Counter()
    for (lang, _), n in words_of.items():
        total[lang] += n
    large = {lang for lang, n in total.items() if n >= rules.MIN_LANGUAGE_WORDS}
    common = {lang: {w: n for (x, w), n in words_of.items() if x == lang and n >= rules.SHARE * total[lang]} for lang in large}

    def kinds(text):
        def kind(c):
            if c in " \t\n\x0b\x0c\r":
                return "space"
            if ord(c) < 128:
                return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "mark"
            return "latin" if 0xC0 <= ord(c) < 0x280 else "other"
        found = Counter(map(kind, text))
        return [found[c] for c in rules.CLASSES]

    def js(p, q):
        if not sum(p):
            return 0.0
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))

    reference = {lang: [sum(x) for x in zip(*(kinds(t) for _, t, x in texts if x == lang))] for lang in large}
    typical = {}
    for lang in large:
        shares = [[(2000 * x + sum(k)) // (2 * sum(k)) for x in k] for _, t, x in texts if x == lang and t for k in [kinds(t)]]
        typical[lang] = [statistics.median(x) for x in zip(*shares)]
    for d, t, lang in texts:
        r = got[d]
        counts = plain_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        far = False
        if lang in large and counts[0]:
            mine = Counter(re.findall(r"[^\x20\x09-\x0D]+", t))
            names = sorted(common[lang])
            rest = lambda table, n: [*(table.get(w, 0) for w in names), n - sum(table.get(w, 0) for w in names)]
            word = js(rest(mine, counts[0]), rest(common[lang], total[lang]))
            kind = js(kinds(t), reference[lang])
            assert r.word_distance == pytest.approx(word, abs=1e-6) and r.class_distance == pytest.approx(kind, abs=1e-6)
            middle = js(kinds(t), typical[lang])
            assert r.typical_distance == pytest.approx(middle, abs=1e-6)
            far = max(kind, middle) > rules.MAX_CLASS_DISTANCE or counts[0] >= rules.MIN_COMMON_WORDS and word > rules.MAX_WORD_DISTANCE
        assert (r.base_failed, r.kept) == (failed, not failed and not far)


def test_good_documents_are_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = rules.judge_quality(docs).join(labels.where("quality = 1"), "doc_id")
    passed = judged.where("not base_failed")
    assert passed.count() > 200 and passed.where("kept").count() >= 0.99 * passed.count()


def test_junk_that_is_a_third_of_a_language_is_not_kept(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("lang = 'en' and n_chars > 500").join(labels.where("quality = 1"), "doc_id", "left_semi").select("doc_id", "text", "lang")
    junk = docs.where("doc_id % 2 = 0").select(-F.col("doc_id") - 1, F.regexp_replace("text", r"(?m)(\w)(?=\s|$)", "$1%%%"), "lang")
    share = junk.count() / (junk.count() + docs.count())
    assert 0.28 < share < 0.38
    judged = rules.judge_quality(docs.unionByName(junk.toDF("doc_id", "text", "lang")), typical=True).where("not base_failed").withColumn("junk", F.col("doc_id") < 0)
    got = {r.junk: r for r in judged.groupBy("junk").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept"), F.count_if(F.col("class_distance") <= 0.3).alias("pooled"),
                                                             F.count_if(F.col("typical_distance") <= 0.3).alias("near")).collect()}
    assert got[True].n > 40 and got[True].kept == 0 and got[True].pooled > 0.9 * got[True].n
    assert got[False].near == got[False].n


def test_a_small_language_beside_large_ones_is_judged(spark):
    words = [f"wort{i}" for i in range(40)]
    small = [(-i - 1, " ".join(words[(i + 7 * k) % 40] for k in range(120)) + ".", "xx") for i in range(60)]
    small.append((-99, " ".join(f"%{i}%" for i in range(120)), "xx"))
    large = [(i, " ".join(f"term{(i + k * k) % 97}" for k in range(20_000)), "en") for i in range(80)]
    docs = spark.createDataFrame(small + large, "doc_id long, text string, lang string")
    assert len(small) * 120 < 0.005 * len(large) * 20_000
    got = {r.doc_id: r for r in rules.judge_quality(docs).where("lang = 'xx'").collect()}
    assert got[-99].class_distance > 0.3 and got[-99].word_distance > 0.45 and not got[-99].kept
    assert all(r.word_distance < 0.3 for d, r in got.items() if d != -99)
    blocked = rules.measure(docs, block_languages=1).where("lang = 'xx'").collect()
    assert {r.doc_id: (r.class_distance, r.word_distance) for r in blocked} == {d: (r.class_distance, r.word_distance) for d, r in got.items()}
    assert rules.measure(docs, min_language_words=10_000).where("lang = 'xx' and (class_distance is not null or word_distance is not null)").count() == 0


def test_no_documents(spark, sf):
    docs = table(spark, sf).where("false")
    assert rules.judge_quality(docs).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert gam.score_quality(docs, gam.train(docs, labels)).count() == 0


def test_model_learns_curves_and_a_pair():
    pick = np.random.default_rng(1)
    x = pick.random((4_000, 4))
    y = ((np.abs(x[:, 0] - 0.5) > 0.25) & ((x[:, 1] > 0.5) == (x[:, 2] > 0.5))).astype(float)  # a valley, and a pair without main effects
    model = gam.fit(x[:3_000], y[:3_000])
    assert (2, 1) in model.pairs
    assert ((model.score(x[3_000:]) >= 0.5) == y[3_000:]).mean() > 0.95
    table = model.tables[0]
    assert len(table) == len(model.edges[0]) + 1 and model.score(x[:1]).shape == (1,)


def test_features_of_odd_texts():
    rows = gam.features(pa.array([None, "", " \n", "A b\nA b\n12 ##", "x" * 100_000]))
    assert rows.shape == (5, len(gam.FEATURES)) and np.isfinite(rows).all() and not rows[:2].any()
    named = dict(zip(gam.FEATURES, rows[3]))
    assert named["dup_lines"] == 1 / 3 and named["mark_words"] == 2 / 6 and named["symbols"] == 2 / 6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x y z"), (-1, None)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("clash"))
    scored = gam.score_quality(rows, gam.train(rows, labels)).collect()
    assert len(scored) == docs.count() + 4
    for r in scored:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [r.predicted == quality[r.doc_id] for r in scored if r.held_out and r.doc_id in quality]
    assert len(held) > 80 and np.mean(held) > 0.95


def test_labels_of_held_out_rows_are_never_used(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: r.score for r in gam.score_quality(docs, gam.train(docs, x)).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]
    few = gam.train(docs, labels, max_train=5)
    assert gam.score_quality(docs, few).count() == docs.count()


def test_features_take_little_memory_beside_the_texts():
    import tracemalloc

    from clauseloom.llm.words import by_bytes

    batch = pa.RecordBatch.from_arrays([pa.array([f"word{i} stands here.\n" * 200 for i in range(1_000)])], names=["text"])
    assert batch.nbytes > 4_000_000
    whole = gam.features(batch.column(0))
    tracemalloc.start()
    rows = np.concatenate([gam.features(part.column(0)) for part in by_bytes(batch, "text", gam.SLICE_BYTES)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and (rows == whole).all()
