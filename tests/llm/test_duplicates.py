import random
import re
from itertools import combinations

import pytest

from clauseloom.llm import decontamination as dec
from clauseloom.llm import line_dedup as lines
from clauseloom.llm import near_dedup as near


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, kept_lines string, component_id int")


# --- near duplicates ---------------------------------------------------------------------------------


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(rows, size, threshold):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, set()).add(shingles(t, size))
    reach = {d: d for d in sets}

    def root(d):
        while reach[d] != d:
            d = reach[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= threshold * len(x | y) for x in sets[a] for y in sets[b]):
            low, high = sorted((root(a), root(b)))
            reach[high] = low
    return {d: root(d) for d in sets}


def varied(pick, base, edits):
    words = base.split()
    for _ in range(edits):
        place = pick.randrange(len(words))
        words[place:place + pick.randint(0, 1)] = [f"new{pick.randrange(10**6)}"] * pick.randint(0, 2) or ["the"]
    return " ".join(words)


def corpus(copies=60):
    pick = random.Random(4)
    prose = lambda n: " ".join(f"w{pick.randrange(400)}" for _ in range(n))
    base = prose(120)
    rows = [(i, varied(pick, base, pick.randint(0, 9))) for i in range(copies)]  # loose copies around the threshold
    rows += [(100 + i, varied(pick, base[:400], pick.randint(0, 3))) for i in range(15)]  # shortened ones
    rows += [(200 + i, prose(pick.randint(1, 60))) for i in range(40)]
    rows += [(300 + i, rows[i][1].upper().replace(" ", "\n ")) for i in range(10)]
    return [*rows, (400, None), (401, ""), (402, " \n\t"), (403, "one two"), (404, "One  two"), (405, "one"), (406, "x " * 30_000), (406, "x " * 30_000)]


@pytest.mark.parametrize("size, threshold", [(4, 80), (5, 80), (3, 60)])
def test_components_agree_with_all_pairs(spark, size, threshold):
    rows = corpus()
    got = near.near_duplicates(frame(spark, rows), size, threshold).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows, size, threshold)
    assert {r.doc_id: r.component_id for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(rows)[r.doc_id], size)) for r in got)


def test_late_pairs_are_found_without_the_bound(spark, monkeypatch):
    """The bound ends pairs early; it must not end any that are linked."""
    from pyspark.sql import functions as F

    rows = corpus(90)
    bounded = {r.doc_id: r.component_id for r in near.near_duplicates(frame(spark, rows), 4, 80).collect()}
    monkeypatch.setattr(near, "may_share_enough", lambda *args: F.lit(True))
    assert bounded == {r.doc_id: r.component_id for r in near.near_duplicates(frame(spark, rows), 4, 80).collect()}


def test_rows_grow_with_a_loose_group(spark, monkeypatch):
    """Pairs compared and edges spread for n and 2 n loose copies of one text; all pairs would be four times as many."""
    keep, counted = near.written, []
    monkeypatch.setattr(near, "written", lambda df, name: (df := keep(df, name), counted.append(df.count()) if name in ("pairs", "late-pairs", "edges") else None)[0])
    pick = random.Random(9)
    base = " ".join(f"w{pick.randrange(400)}" for _ in range(120))
    sums = []
    for n in (150, 300):
        counted.clear()
        near.near_duplicates(frame(spark, [(i, varied(pick, base, pick.randint(1, 7))) for i in range(n)]), 4, 80).collect()
        sums.append(sum(counted))
    assert sums[1] <= 3 * sums[0] and sums[1] <= 60 * 300, sums


def test_only_what_the_result_reads_is_left_on_disk(spark, monkeypatch, tmp_path):
    """Tables written on the way go as soon as what is made of them is written."""
    from clauseloom import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    got = near.near_duplicates(frame(spark, corpus()), 4, 80)
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir() if any(p.glob("*.parquet")))
    assert left == ["classes", "labels", "signatures"]
    assert got.count() == len(corpus())


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 101), (7, 7)]
    got = {r.node: r.component for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)}


# --- lines --------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last = [i]
        for j, y in enumerate(b, 1):
            last.append(min(row[j] + 1, last[-1] + 1, row[j - 1] + (x != y)))
        row = last
    return row[-1]


def edited(pick, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        kind, place = pick.random(), pick.randint(0, len(out))
        if kind < 0.33:
            out.insert(place, pick.choice(letters))
        elif out:
            out[min(place, len(out) - 1):min(place, len(out) - 1) + 1] = [] if kind < 0.66 else [pick.choice(letters)]
    return "".join(out)


def test_banded_distance_agrees_with_the_full_table(spark):
    pick = random.Random(3)
    pairs = [("", ""), ("", "ab"), ("abc", "")]
    for _ in range(500):
        a = "".join(pick.choice("abc é") for _ in range(pick.randint(0, 14)))
        pairs.append((a, edited(pick, a, pick.randint(0, 4), "abc é")))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        got = df.select("a", "b", lines.within_edits(df.a, df.b, edits).alias("near"), lines.trimmed(df.a, df.b).alias("t")).collect()
        assert all(r.near == (distance(r.a, r.b) <= edits) and distance(r.t.a, r.t.b) == distance(r.a, r.b) for r in got)


def line_rows():
    pick = random.Random(5)
    letters = "abcdefgh "
    base = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 30))) for _ in range(50)]
    rows = []
    for i in range(100):
        own = [edited(pick, pick.choice(base), pick.choice([0, 0, 1, 2, 3]), letters) if pick.random() < 0.8 else pick.choice(["", "  ", "\t"])
               for _ in range(pick.randint(0, 8))]
        rows.append((i, "\n".join(own) if own else None))
    return [*rows, (None, base[0]), (5, rows[5][1]), (5, "another text of one id"), (200, ""), (201, "\n\n"), (202, "long " * 30_000)]


def brute_lines(rows, edits, min_chars):
    has_word = lambda line: re.search(r"[^\x20\x09-\x0D]", line)
    places = sorted((d is not None, d or 0, hash_of(t), k, line) for d, t in set(rows) if t is not None for k, line in enumerate(t.split("\n")) if has_word(line))
    first = {}
    for *place, line in places:
        first.setdefault(line, tuple(place))
    root = {line: line for line in first}

    def top(line):
        while root[line] != line:
            line = root[line]
        return line

    for a, b in combinations(first, 2):
        if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
            early, late = sorted((top(a), top(b)), key=first.get)
            root[late] = early
    found = {}
    for d, t in set(rows):
        own = [(k, line) for k, line in enumerate((t or "").split("\n")) if has_word(line)]
        firsts = [(k, line) for k, line in own if first[line] == (d is not None, d or 0, hash_of(t), k)]
        kept = [k for k, line in firsts if top(line) == line]
        near = [(k, first[top(line)][1] if first[top(line)][0] else None, first[top(line)][3]) for k, line in firsts if top(line) != line]
        if own:
            found[d, t] = (len(own), len(own) - len(firsts), len(near), kept, near)
    return found


HASHES = {}


def hash_of(text):
    return HASHES[text]


@pytest.mark.parametrize("edits, min_chars", [(2, 8), (1, 6)])
def test_lines_agree_with_all_pairs(spark, edits, min_chars):
    from pyspark.sql import functions as F

    rows = line_rows()
    docs = frame(spark, rows)
    # the order of rows that repeat an id is that of their hashes
    HASHES.update({r.text: r.h for r in docs.select("text", F.xxhash64("doc_id", "text").alias("h")).collect()})
    text_of = {HASHES[t]: t for _, t in rows}
    got = {(r.doc_id, text_of[r.row_hash]): (r.n_lines, r.n_dup_lines, r.n_near_lines, r.kept_lines, [tuple(x) for x in r.near_of])
           for r in lines.judge_lines(docs, edits, min_chars).collect()}
    expected = brute_lines(rows, edits, min_chars)
    assert got == expected and sum(v[2] for v in expected.values()) > 20
    kept = lines.without_repeated_lines(docs, edits, min_chars)
    assert kept.columns == docs.columns
    texts = {}
    for d, t in rows:
        drop = expected.get((d, t))
        if drop is None:
            texts.setdefault(d, []).append(t)
        elif drop[3]:
            texts.setdefault(d, []).append("\n".join(x for k, x in enumerate(t.split("\n")) if k in drop[3] or not x.strip()))
    found = {}
    for r in kept.collect():
        assert r.kept_lines == "clash"
        found.setdefault(r.doc_id, []).append(r.text)
    order = lambda x: {k: sorted(v, key=str) for k, v in x.items()}
    assert order(found) == order(texts)


def test_pairs_of_variants_grow_with_their_number(spark, monkeypatch):
    """Variants within two edits of one line, the line itself left out: the pairs compared must not be a square of them."""
    pick = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz "
    line = "".join(pick.choice(letters) for _ in range(60))
    counted = []
    keep = lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: (df := keep(df, name), counted.append(df.count()) if name == "line-pairs" else None)[0])
    sums = []
    for n in (250, 500, 1000):
        counted.clear()
        rows = [(i, edited(pick, line, 2, letters)) for i in range(n)]
        got = lines.judge_lines(frame(spark, rows)).collect()
        sums.append(sum(counted))
        if n == 250:
            HASHES.update({r.text: r.h for r in frame(spark, rows).selectExpr("text", "xxhash64(doc_id, text) as h").collect()})
            expected = brute_lines(rows, 2, 40)
            text_of = {HASHES[t]: t for _, t in rows}
            assert {(r.doc_id, text_of[r.row_hash]): r.kept_lines for r in got} == {k: v[3] for k, v in expected.items()}
    assert sums[2] <= 8 * 1000 and sums[2] <= 3 * sums[1], sums  # of 499,500 pairs


# --- benchmark items ------------------------------------------------------------------------------------


def plain_score(text, item):
    best, above = 0, [0] * (len(text) + 1)
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (2 if other == word else -1), above[j + 1] - 2, row[-1] - 2))
        best, above = max(best, *row), row
    return best


def test_leaks_agree_with_aligning_everything(spark):
    pick = random.Random(6)
    word = lambda: f"w{pick.randrange(150)}"
    items = [(i, " ".join(word() for _ in range(pick.randint(5, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "too short to tell")]
    rows = []
    for i in range(80):
        rate, item = pick.choice([0, 0.1, 0.2, 0.3]), pick.choice(items[:12])[1].split()
        changed = [x for w in item for x in (["other"] if pick.random() < rate / 2 else [] if pick.random() < rate / 3 else [w, "more"] if pick.random() < rate / 3 else [w])]
        before, after = ([word() for _ in range(pick.randint(0, 60))] for _ in range(2))
        rows.append((i, ", ".join([*before, *changed, *after]).upper()))
    rows += [(90, None), (91, ""), (92, items[0][1]), (92, items[0][1]), (93, "w1 " * 50_000), (94, items[3][1].replace(" ", "” — "))]
    docs = frame(spark, rows)
    words = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    expected = []
    for d, t in rows:
        for i, item in items:
            own = words(item)
            if len(own) >= dec.SEED and len(words(t)) < 10_000:
                score, edits = plain_score(words(t), own), dec.edits(len(own), 80)
                if score >= 2 * len(own) - 3 * edits:
                    expected.append((d, i, round(score / (2 * len(own)), 9)))
    table = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    for block_chars in (dec.BLOCK_CHARS, 400):  # in one block and in several
        got = [(r.doc_id, r.item_id, round(r.score, 9)) for r in dec.find_leaks(docs, table, block_chars=block_chars).collect()]
        assert sorted(got) == sorted(expected) and len(expected) > 25
    kept = dec.without_leaks(docs, table)
    leaked = {d for d, *_ in expected}
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d not in leaked)
    assert dec.find_leaks(docs, table.where("false")).count() == 0


def test_short_items_and_scripts_without_blanks(spark):
    """Items of three to seven words are found word for word; code points count as words where there are no blanks."""
    chinese = "今天天气很好，我们一起去公园散步吧。"
    items = [(1, "one two three"), (2, "alpha beta gamma delta epsilon zeta eta"), (3, chinese), (4, "ประเทศไทยสวยงาม"), (5, "too short"), (6, None), (7, "...")]
    docs = [(1, "x ONE, two-three y"), (2, "one two or three"), (3, "alpha beta gamma delta epsilon zeta eta"), (4, "alpha beta gamma other epsilon zeta eta"),
            (5, "前面的话" + chinese + "后面的话"), (6, "前面的话" + chinese.replace("公园", "学校") + "后面"), (7, "他说的是别的事情"), (8, "ในประเทศไทยสวยงามมาก"), (9, "too short")]
    kind = "{} long, text string"
    table = spark.createDataFrame(items, kind.format("item_id"))
    found = {(r.doc_id, r.item_id) for r in dec.find_leaks(spark.createDataFrame(docs, kind.format("doc_id")), table).collect()}
    assert found == {(1, 1), (3, 2), (5, 3), (6, 3), (8, 4)}
    assert {(r.item_id, r.n_words) for r in dec.unsearched(table).collect()} == {(5, 2), (6, 0), (7, 0)}


def test_empty_tables(spark):
    docs = frame(spark, corpus()).where("false")
    assert near.near_duplicates(docs).count() == 0
    assert lines.judge_lines(docs).count() == 0 and lines.without_repeated_lines(docs).count() == 0
    assert dec.find_leaks(docs, spark.createDataFrame([(1, "a b c d e f g h i")], "item_id long, text string")).count() == 0
