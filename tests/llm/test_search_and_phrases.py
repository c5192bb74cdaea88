import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clauseloom.llm import collocations as col
from clauseloom.llm import lexical_search as lex

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- search ------------------------------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, top):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for *_, n in held if n), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, counts, n in held:
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * counts[w] // (1000 * counts[w] + 12 * m)) for w in terms(text) if w in counts)
            if score > 0:
                scores.append((-score, (d is not None, d), d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def search_rows():
    pick = random.Random(2)
    word = lambda: f"{pick.choice(['W', 'w', 'é', 'É'])}{int(pick.paretovariate(0.6)) % 300}"
    docs = [(i, pick.choice([" ", "--", "\n"]).join(word() for _ in range(pick.randint(0, 60)))) for i in range(300)]
    docs += [(500 + i, docs[7][1]) for i in range(120)]  # ties
    docs += [(7, docs[7][1]), (7, "w1 another text of one id"), (None, docs[9][1]), (None, "w2 w2"), (600, None), (601, ""), (602, " .-_"), (603, "w1 w5 w77 " * 20_000), (604, "\0w1\x7fw2")]
    items = [(i, " ".join(word() for _ in range(pick.randint(1, 40)))) for i in range(25)]
    return docs, [*items, (3, items[3][1]), (3, "w1"), (None, "w2 w2 w2 é3"), (90, None), (91, ""), (92, "nowhere"), (93, "W1 w1 É1 w1, w250")]


@pytest.mark.parametrize("top, block_chars", [(20, lex.BLOCK_CHARS), (3, 500), (1000, 4_000_000)])
def test_search_agrees_with_scoring_everything(spark, top, block_chars):
    docs, items = search_rows()
    table = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, rank string, n int").repartition(3)
    wanted = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, score string")
    got = sorted((tuple(r) for r in lex.search(table, wanted, top, block_chars).collect()), key=str)
    assert got == brute_search(docs, items, top)


def test_accumulators_stop_before_the_common_terms():
    """Slices of one task: common terms create none, scores stay exact, and earlier slices raise the bar."""
    pick = random.Random(3)
    docs = [" ".join(["the", "of"] * 5 + [f"r{pick.randrange(2000)}" for _ in range(20)]) for _ in range(3000)]
    words = lex.terms_of(pa.array(docs))
    known = lex.Known(np.unique(words.hashes))
    which = np.searchsorted(known.hashes, words.hashes)
    rows = [Counter(which[a:b].tolist()) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(3000), pa.int64()), "n": pa.array([30] * 3000, pa.int64()),
                                        "terms": pa.array([list(r) for r in rows], pa.list_(pa.int32())), "counts": pa.array([list(r.values()) for r in rows], pa.list_(pa.int32()))})
    df = dict(Counter(t for r in rows for t in r))
    query = lex.terms_of(pa.array(["r1 r2 r3 r4 r5 r6 the of"]))
    queries = lex.weigh([0], query, known, df, 3000, 90_000)
    part = lex.Slice(batch, queries, len(known.hashes))
    ids, scores = part.search(queries.terms[0], queries.weights[0], 20, 0)
    assert 20 <= len(ids) < 400 and not part.scores.any()
    kth = int(np.sort(scores)[-20])
    again, _ = part.search(queries.terms[0], queries.weights[0], 20, kth)
    assert set(again) == set(ids[scores >= kth])


def test_nothing_to_search(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lex.search(docs.where("false"), items).count() == 0 == lex.search(docs, items.where("false")).count()
    assert lex.search(docs.where("doc_id = 2"), items).count() == 0
    assert lex.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


# --- phrases -------------------------------------------------------------------------------------------------


def brute_phrases(rows, min_count, longest, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, words[i:i + k]] = counts.get((lang, words[i:i + k]), 0) + 1
    found = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) < 2 or a < min_count:
            continue
        held = [p for (x, p), b in counts.items() if x == lang and len(p) > len(phrase) and b >= a and b >= min_count
                and any(p[i:i + len(phrase)] == phrase for i in range(len(p)))]
        if not held:
            n = totals[lang]
            score, _, left, right = min((1000 * a * n // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k, counts[lang, phrase[:k]], counts[lang, phrase[k:]])
                                        for k in range(1, len(phrase)))
            found.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right, n))
    return sorted((lang, k, p.decode(), -a, left, right, n, -s) for lang, all_ in found.items() for k, (s, a, p, left, right, n) in enumerate(sorted(all_)[:top], 1))


def phrase_rows():
    pick = random.Random(4)
    rows = []
    for i in range(150):
        words = [pick.choice(["New york city hall", "the", "of the", "a", "a a a", "é É", "x\x0by", f"w{int(pick.paretovariate(0.7)) % 400}"]) for _ in range(pick.randint(0, 40))]
        rows.append((pick.choice(["en", "de", None, "und", ""]), pick.choice([" ", "  ", "\t", " , "]).join(words)))
    return [*rows, ("en", None), ("en", ""), (None, ".,;"), ("zz", "one word"), ("en", "the end of the " * 20_000), ("a b. c", "the of\nthe of\r the of " * 8)]


@pytest.mark.parametrize("min_count, top, block, sparse", [(5, 2000, col.BLOCK, col.SPARSE), (3, 10, 17, 50)])
def test_phrases_agree_with_counting_everything(spark, monkeypatch, min_count, top, block, sparse):
    """Also with dictionaries in several blocks, tiles of 4 x 4 and coordinates that are given out early."""
    rows = phrase_rows()
    monkeypatch.setattr(col, "BLOCK", block)
    if block < 100:
        tiles = col.TileCounts
        monkeypatch.setattr(col, "TileCounts", lambda: tiles(2, 6, sparse))
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, text string, n string, left int").repartition(3)
    got = sorted(tuple(r) for r in col.collocations(docs, min_count, 5, top).collect())
    assert got == brute_phrases(rows, min_count, 5, top) and len(got) > 30


def test_tiles_count_pairs():
    pick = np.random.default_rng(5)
    ranks = np.minimum(pick.zipf(1.3, 50_000), 5_000_000).astype(np.int64)
    keys = (ranks[:-1] << 32) | ranks[1:]
    tiles, got = col.TileCounts(3, 8, 1000), Counter()
    for part in np.array_split(keys, 7):
        for k, n in tiles.add(part):
            got.update(dict(zip(k.tolist(), n.tolist())))
    for k, n in tiles.rest():
        got.update(dict(zip(k.tolist(), n.tolist())))
    assert got == Counter(keys.tolist()) and len(tiles.dense) > 5


def test_streams():
    assert col.tidy(np.array([-1, 3, -1, 4, 5, -1, -1, 6, 7, 8, -1, 9])).tolist() == [4, 5, -1, 6, 7, 8, -1]
    assert col.pair_keys(np.array([4, 5, -1, 6, 7, 8])).tolist() == [4 << 32 | 5, -1, -1, 6 << 32 | 7, 7 << 32 | 8]
    assert col.tidy(np.array([], np.int64)).tolist() == []


def test_no_phrases(spark):
    docs = spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")
    assert col.collocations(docs).count() == 0 == col.collocations(docs.where("false")).count()
    assert col.collocations(docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
