import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clauseloom.llm import bpe_reuse, token_counts, token_store, words
from clauseloom.llm.encoding import PieceEncoder, load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "Ab", "THE", "the.", "end,", " ", "  ", "\n", "\t", "\x1c", "é", "é", "É.", "İ", "İ.", "Σ", "'s", "'re", "12", "!?", "...",
         "<|endoftext|>", "<|startoftext|>", "\u2003", "\u00a0", "x" * 30, "中", "😀", "\u0301", "word", "\r", "ab" * 300]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(1)
    made = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 200))) for _ in range(300)]
    return [*made, "", "x" * 20_000, "ab " * 5_000, " " * 3_000, "\n" * 2_000]


@pytest.fixture(scope="module")
def expected(texts):
    return [e.ids for e in load_tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]


def test_words_agree_with_a_pattern(texts, monkeypatch):
    for stretch in (64, 1 << 20):
        monkeypatch.setattr(words, "STRETCH", stretch)
        for fold in (False, True):
            found = words.hash_words(*words.text_bytes(pa.array([*texts, None])), fold=fold)
            plain = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in [*texts, ""]]
            if fold:
                plain = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in p] for p in plain]
            assert found.counts.tolist() == [len(p) for p in plain]
            seen = {}
            for p, a, b in zip(plain, found.bounds[:-1], found.bounds[1:]):
                assert all(seen.setdefault(w, h) == h for w, h in zip(p, found.hashes[a:b]))
            assert len(set(seen.values())) == len(seen)
            windows = words.shingles(found, 4)
            assert windows.counts.tolist() == [max(len(p) - 3, min(len(p), 1)) for p in plain]


def test_pieces_agree_with_the_library(texts, expected):
    encoder = PieceEncoder(PATH)
    for _ in range(2):  # the second time from the cache
        flat, counts = encoder.encode(texts)
        assert [ids.tolist() for ids in np.split(flat, np.cumsum(counts)[:-1])] == expected


def test_chunks_are_repaired_at_their_joins(texts, expected):
    encoder = bpe_reuse.ChunkEncoder(PATH)
    for text, ids in zip(texts, expected):
        assert encoder.encode_all([text])[0].tolist() == ids
    assert [x.tolist() for x in encoder.encode_all(texts)] == expected
    prose = " ".join(random.Random(2).choices(["thistle", "heather", "moss", "fern."], k=4_000))
    moved = "another start " + prose
    shared = {prose[a:b] for a, b in zip([0, *bpe_reuse.cuts(prose)], bpe_reuse.cuts(prose))}
    again = [moved[a:b] in shared for a, b in zip([0, *bpe_reuse.cuts(moved)], bpe_reuse.cuts(moved))]
    assert sum(again) >= len(again) - 2  # chunks are found again wherever they stand


def test_long_texts_without_blanks(expected):
    """A stretch without blanks is encoded once, also between texts with blanks."""
    pick, tokenizer, encoder = random.Random(7), load_tokenizer(PATH), bpe_reuse.ChunkEncoder(PATH)
    stretch = "".join(chr(pick.randrange(0x4E00, 0x9FA0)) for _ in range(1_000_000))
    words = " ".join(pick.choices(["thistle", "heather", "moss"], k=500))
    start = time.perf_counter()
    ids = tokenizer.encode(stretch, add_special_tokens=False).ids
    library = time.perf_counter() - start
    start = time.perf_counter()
    assert encoder.encode_all([stretch])[0].tolist() == ids
    assert time.perf_counter() - start < 10 * library + 1
    for text in (words + stretch[:20_000], stretch[:20_000] + " " + words, words + " " + stretch[:3_000] + " " + words + stretch[:3_000]):
        assert encoder.encode_all([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_are_kept_over_tasks():
    encoder = bpe_reuse.ChunkEncoder.of_worker(PATH)
    assert encoder is bpe_reuse.ChunkEncoder.of_worker(PATH)
    prose = " ".join(random.Random(3).choices(["thistle", "heather", "moss", "fern."], k=2_000))
    encoder.encode_all([prose])
    encoded, reused = encoder.encoded, encoder.reused
    encoder.encode_all([prose, "more " + prose])
    assert encoder.encoded <= encoded + 2 and encoder.reused > reused + 20


def test_decoding_agrees_with_the_library(expected):
    tokenizer, decoder = load_tokenizer(PATH), bpe_reuse.Decoder(PATH)
    assert all(decoder.decode(np.array(ids, np.int32)) == tokenizer.decode(ids, skip_special_tokens=False) for ids in expected)


def frame(spark, texts):
    rows = [(i, t, "clash", 1.5) for i, t in enumerate([*texts, None])]
    return spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, n_tokens string, score double")


def test_operators_on_tables(spark, texts, expected, tmp_path):
    docs, ids_of = frame(spark, texts), [*expected, []]
    text_of = [*texts, ""]
    clash = bpe_reuse.coded(docs.limit(2).withColumn("code_", F.lit("mine")), PATH)
    assert all(r.code_ == "mine" and r.ids_sha256 for r in clash.collect())
    coded = bpe_reuse.coded(docs, PATH, with_ids=True).collect()
    assert len(coded) == len(texts) + 2
    for r in coded:
        raw = np.array(ids_of[r.doc_id], "<u4").tobytes()
        assert (r.n_tokens, list(r.ids), r.ids_sha256) == (len(ids_of[r.doc_id]), ids_of[r.doc_id], hashlib.sha256(raw).hexdigest())
    for size in (token_counts.TABLE_SIZE, 3):
        counted = token_counts.count_tokens(docs, PATH, 100, size).collect()
        assert len(counted) == len(texts) + 2
        for r in counted:
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text_of[r.doc_id].encode()), len(ids_of[r.doc_id]), len(ids_of[r.doc_id]) > 100)
    path = str(tmp_path / "orc")
    token_store.write_tokens(docs, path, PATH, parts=3)
    stored = token_store.read_tokens(spark, path)
    read = stored.mapInArrow(token_store.digests, "doc_id long, start long, n_tokens long, ids_crc32 long").orderBy("start").collect()
    start = 0
    for r in read:
        ids = [*ids_of[r.doc_id], 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert [r.doc_id for r in read] == sorted(r.doc_id for r in coded)
    one = stored.where("doc_id = 7")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert one.count() == 1 and "EqualTo(doc_id,7)" in plan  # answered from the files' statistics, indexes and Bloom filters


def test_empty_tables(spark, tmp_path):
    docs = frame(spark, ["x"] * 5).where("false")
    assert bpe_reuse.coded(docs, PATH).count() == 0
    assert token_counts.count_tokens(docs, PATH).count() == 0
    token_store.write_tokens(docs, str(tmp_path / "none"), PATH)
    assert token_store.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_frequent_pieces_cover_all_rows(spark):
    docs = spark.createDataFrame([(f"often word{i} often",) for i in range(50)] + [(None,)], "text string").repartition(4)
    assert token_counts.frequent_pieces(docs, 1) == ["often"]
    assert docs.select(F.count("text")).first()[0] == 50
