import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clauseloom.llm import chat_format as chat
from clauseloom.llm import url_filter as urls

TURNS = [(1, 0, "system", "be brief"), (1, 1, "user", "a ### b </turn>\n c"), (1, 2, "assistant", r"x \h \b ### Assistant: </turn>"),
         (1, 3, "user", None), (1, 4, "assistant", "é\n"), (1, 5, "user", "end"), (2, 0, "user", "only asks"), (3, 0, None, "x"), (3, 0, None, "x"),
         (4, None, "assistant", ""), (5, 0, "as:si\n### stant", "odd role"), (None, 0, "assistant", "no id"), (6, 0, "assistant", "</turn>\n### user:\n"),
         (7, 2, "assistant", "B"), (7, 1, "assistant", "A")]
KIND = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], KIND + ", formatted string, number int")


def brute():
    found = {}
    for conv in {r[0] for r in TURNS}:
        turns = sorted((r for r in TURNS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found[conv] = (len(turns), sha(whole), len(loss), sha(loss), sum(r[2] == "assistant" for r in turns))
    return found


def test_conversations_come_back(spark):
    formatted = chat.format_conversations(frame(spark, TURNS))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in chat.digest(formatted).collect()}
    assert got == brute()


def test_each_assistant_turn_is_an_example_with_its_context(spark):
    rows = {(r.conv_id, r.number): r for r in chat.examples(chat.format_conversations(frame(spark, TURNS))).collect()}
    assert sorted(k for k in rows if k[0] == 1) == [(1, 2), (1, 4)]
    first, second = rows[1, 2], rows[1, 4]
    assert second.text.startswith(first.text) and first.text.count("</turn>\n") == 3 and second.text.count("</turn>\n") == 5
    assert second.text[second.mask_start:second.mask_start + second.mask_chars] == "é\n"
    assert first.text.endswith("</turn>\n") and first.mask_start + first.mask_chars == len(first.text) - len("</turn>\n")


def test_a_wrong_mask_is_an_error(spark):
    """The digest goes through the expanded examples, so a wrong context or end does not pass."""
    formatted = chat.format_conversations(frame(spark, TURNS)).where("conv_id = 1")
    for field, change in (("end", 1), ("mask_start", -1), ("mask_chars", 1)):
        wrong = formatted.withColumn("examples", F.transform("examples", lambda e: e.withField(field, e[field] + change)))
        with pytest.raises(Exception, match="mask is not its last turn"):
            chat.digest(wrong).collect()


def test_a_long_conversation_is_stored_in_proportion(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 3) for i in range(2_000)]
    r = chat.digest(chat.format_conversations(frame(spark, rows))).first()
    assert (r.n_turns, r.n_examples) == (2_000, 1_000) and r.formatted_chars < 2_000 * 80


def test_no_conversations(spark):
    assert chat.digest(chat.format_conversations(frame(spark, TURNS).where("false"))).count() == 0


RULES = (urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
         urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"))
CASES = {
    "http://A.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/"),
    "https://example.org/en/12?x=://y": ("example.org", "/en/12", "example.org/en/1"),
    "x://notexample.org/es/": ("notexample.org", "/es/", "org/"),
    "http://org/a#b": ("org", "/a", "org/"),
    "http://b.com/fr/": ("b.com", "/fr/", "com/fr/"),
    "http://b.com?/de/": ("b.com", "", None),
    "http://b.org": ("b.org", "", None),
    "http://ÄB.net/é": ("Äb.net", "/é", None),
    "no scheme": ("", "", None),
    "": ("", "", None),
    None: ("", "", None),
    "://": ("", "", None),
}


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(CASES)], "page_id long, url string, html string, verdict string")
    rows = {r.url: r for r in urls.judge_urls(pages, RULES, rounds=2).collect()}
    assert {u: (r.host, r.path, r.rule) for u, r in rows.items()} == CASES
    assert rows["http://b.com/fr/"].verdict == "allow" and rows["x://notexample.org/es/"].verdict == "allow"
    clash = urls.judge_urls(pages.withColumns({"fit": F.lit("mine"), "trust": F.lit("x"), "host": F.lit("y")}), RULES, rounds=1)
    assert {(r.url, r.fit, r.host) for r in clash.collect()} == {(u, "mine", h) for u, (h, _, _) in CASES.items()}
    assert rows["http://A.Example.ORG/es/1"].verdict == "block" and rows[None].verdict == "allow"


def test_trust_follows_links_and_distrust_goes_back(spark):
    link = lambda *to: " ".join(f'<a href="http://{t}/x">' for t in to)
    pages = [(1, "http://good.org/a", link("fine.net")), (2, "http://fine.net/a", ""), (3, "http://farm.net/a", link("b.com")),
             (4, "http://b.com/de/1", ""), (5, "http://b.com/de/2", ""), (6, "http://alone.net/", link("alone.net")), (6, "http://alone.net/", None),
             (7, "http://near.net/", link("farm.net"))]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.host: r for r in urls.judge_urls(table, RULES).collect()}
    assert {h: r.verdict for h, r in got.items()} == {"good.org": "allow", "fine.net": "allow", "farm.net": "block", "b.com": "block",
                                                     "alone.net": "allow", "near.net": "block"}
    assert got["fine.net"].trust > 0 == got["fine.net"].distrust and got["farm.net"].distrust > got["near.net"].distrust > 0


def test_ranks_agree_with_a_plain_loop(spark):
    edges = [("a", "b", 0.5), ("a", "c", 0.5), ("b", "a", 1.0), ("c", "c", 1.0)]
    seeds = {"a": 1.0, "b": 3.0, "c": 0.0}
    rank = restart = {h: s / 4 for h, s in seeds.items()}
    for _ in range(7):
        rank = {h: 0.85 * sum(w * rank[s] for s, d, w in edges if d == h) + 0.15 * restart[h] for h in seeds}
    got = urls.propagate(spark.createDataFrame(list(seeds.items()), "host string, seed double"),
                         spark.createDataFrame(edges, "src string, dst string, share double"), "seed", 7)
    assert {r.host: round(r["rank"], 12) for r in got.collect()} == {h: round(v, 12) for h, v in rank.items()}


def test_ranks_settle_on_a_long_chain_and_across_hosts(spark):
    link = lambda *to: " ".join(f'<a href="http://{t}/x">' for t in to)
    chain = [f"c{i}.net" for i in range(25)]
    random = np.random.default_rng(4)
    web = {f"w{i}.net": [f"w{j}.net" for j in random.integers(0, 40, 2)] + [f"w{i}.net"] * 4 for i in range(40)}
    links = {"good.org": [chain[0], "w0.net", "w1.net"]} | {a: [b] for a, b in zip(chain, chain[1:])} | {chain[-1]: []} | web
    links |= {"bad.com": []} | {h: [*to, "bad.com"] for h, to in web.items() if int(h[1:-4]) % 9 == 5}
    pages = [(i, f"http://{h}/{'de/' if h == 'bad.com' else 'x'}", link(*to)) for i, (h, to) in enumerate(links.items())]
    got = {r.host: r for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}

    hosts, limits = list(links), {}
    weight = np.array([[links[a].count(b) for b in hosts] for a in hosts], float)
    for name, w, seed in (("trust", weight, "good.org"), ("distrust", weight.T, "bad.com")):
        share = w / np.maximum(w.sum(axis=1, keepdims=True), 1)
        restart = np.array([float(h == seed) for h in hosts])
        limits[name] = np.linalg.solve(np.eye(len(hosts)) - 0.85 * share.T, 0.15 * restart)
        assert sum(abs(getattr(got[h], name) - x) for h, x in zip(hosts, limits[name])) < urls.TOLERANCE
    assert all(got[h].trust > 0 for h in chain)
    bad = {h: d > 0 and d >= 0.5 * (t + d) for h, t, d in zip(hosts, limits["trust"], limits["distrust"])}
    assert {h: got[h].verdict == "block" for h in web} == {h: bool(bad[h]) for h in web}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_urls(pages, RULES, rounds=1).count() == 0
