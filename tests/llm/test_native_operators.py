"""Operators in SQL functions: rules, urls, dialogues; their DuckDB twins and awkward rows."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from floegrid.llm import chat, rules, urls
from floegrid.llm.queries import REGISTRY

from ..test_queries import SF, TABLES, rows as normal
from . import samples


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = REGISTRY[name][0](spark, SF).toPandas(), con.execute(REGISTRY[name][1]).df()
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", ["op2_host_rules", "op9_perspectives", "op10_urls"])
def test_no_python_on_the_main_path(spark, name):
    plan = REGISTRY[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def rules_brute(text: str | None) -> tuple:
    t = text or ""
    w = samples.spaced_words(t)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen, under = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            under.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if samples.spaced_words(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(under),
            len(w) < 20 or 100 * len(under) > 30 * len(w))


def test_rules_match_brute_force(spark):
    rng = random.Random(6)
    rows = samples.awkward(rng)
    for i in range(40):
        part = samples.sentence(rng, rng.randint(1, 14), "ab")
        rows.append((i, "\n".join(rng.choice([part, samples.sentence(rng, 9), "#*| <x>", "", " "]) for _ in range(rng.randint(1, 30))), "en", f"s{i % 3}", 1))
    docs = samples.frame(spark, rows).withColumns({"host_docs": F.lit("clash"), "kept": F.lit(1)})
    got = rules.judge(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules_brute(r.text), r
    assert rules.judge(docs.limit(0)).count() == 0


def test_a_failing_host_is_rejected_and_small_hosts_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "few words"
    rows = [(i, good, None, "clean", 1) for i in range(200)] + [(1000 + i, bad, None, "spam", 1) for i in range(195)]
    rows += [(2000 + i, good, None, "spam", 1) for i in range(5)] + [(3000, bad, None, "small", 1), (3001, good, None, "small", 1)]
    rows += [(4000, good, None, None, 1), (4001, bad, None, "one", 1)]
    got = {r.doc_id: r for r in rules.judge(samples.frame(spark, rows)).collect()}
    assert got[0].kept and not got[2000].kept and not got[2000].base_failed and got[3001].kept and got[4000].kept
    assert got[2000].host_rate > 0.9 and got[4001].host_rate < 1


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/EN/x", "https://example.net/en/1", "https://example.net/En/1", "https://example.net",
        "https://example.net?x=/en/", "http://net/", "http://mynet/", "http://a.b.net/x#y", "https://example.com/de/", "https://notexample.com/de/",
        "https://x.org/fr/1?q", "https://x.org/frx/", "ftp://u@h:80/p?q#f", "a://b://c/d", "https://ü.org/fr/é🙂", "x" * 5000 + "://y.net/z"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(5, URLS[5])], "page_id long, url string").withColumn("host", F.lit(1))
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(URLS) + 1
    bias, weights = urls.train()
    for r in got:
        host, path = urls.host_path_of(r.url or "")
        fit = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda f: len(f[0]), default=(None, None))
        score = bias + sum(weights[b] for b in urls.grams_of(host, path))
        assert (r.host, r.path, r.rule, r.score) == (host, path, rule, score)
        assert r.verdict == (verdict or ("block" if score > 0 else "allow"))
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_url_regression_learns_its_table(spark):
    bias, weights = urls.train()
    right = [(bias + sum(weights[b] for b in urls.grams_of(*urls.host_path_of(u))) > 0) == bool(y) for u, y in urls.LABELLED]
    assert all(right)
    table = spark.createDataFrame([*urls.LABELLED, (None, 1)], "url string, label int")
    assert urls.train_on(table) == urls.train(sorted(urls.LABELLED))
    assert all(w == 0 for w in urls.train([])[1])


def chat_brute(turns: list[tuple]) -> dict[tuple, tuple[str, str]]:
    """(conv_id, speaker) to the whole dialogue and the masked spans."""
    first = lambda v: (v is not None, v if v is not None else 0)
    text = lambda v: (v is not None, v or "")
    talks: dict = {}
    for c, t, r, x in sorted(set(turns), key=lambda v: (first(v[0]), first(v[1]), text(v[2]), text(v[3]))):
        talks.setdefault(c if c is not None else ("row", t, r, x), []).append((r or "unknown", x or ""))
    out = {}
    for c, talk in talks.items():
        for who in {r for r, _ in talk if r != "system"}:
            shown, spans = "", []
            for r, x in talk:
                shown += "<|system|>\n" if r == "system" else "<|assistant|>\n" if r == who else f"<|user name={r}|>\n"
                if r == who:
                    spans.append(f"{len(shown)}-{len(shown) + len(x) + 8}")
                shown += x + "<|end|>\n"
            out.setdefault((c if not isinstance(c, tuple) else None, who), []).append((shown, ",".join(spans)))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("block", [256, 4])
def test_perspectives_match_brute_force(spark, block):
    rng = random.Random(9)
    turns = [(c, t, rng.choice(["ann", "bob", "eve", "system"]), samples.sentence(rng, rng.randint(0, 6))) for c in range(8) for t in range(rng.randint(1, 30))]
    turns += [(50, 0, None, None), (50, None, "ann", "né 🙂"), (50, 0, "bob", ""), (None, 1, "ann", "alone"), (None, 2, "ann", "alone"),
              (60, 0, "system", "only"), (61, 3, "a", "tie"), (61, 3, "b", "tie"), (61, 3, "b", "tie")]
    turns.append(turns[0])
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    got: dict = {}
    for r in sorted(chat.perspectives(table, block).collect(), key=lambda r: (r.dialogue, r.speaker, r.block)):
        before = got.setdefault((r.conv_id, r.dialogue, r.speaker), ["", []])
        assert r.start_char == len(before[0]) and r.n_turns <= block
        before[0] += r.rendered
        before[1] += [r.masks] if r.masks else []
    found: dict = {}
    for (c, _, who), (shown, masks) in got.items():
        found.setdefault((c, who), []).append((shown, ",".join(masks)))
    assert {k: sorted(v) for k, v in found.items()} == chat_brute(turns)
    assert chat.perspectives(table.limit(0)).count() == 0


def test_no_window_over_a_speaker_carries_text(spark):
    from floegrid.llm.chat import perspectives
    turns = spark.createDataFrame([("c", i, "ab"[i % 2], "t" * i) for i in range(9)], "conv_id string, turn int, role string, text string")
    found = perspectives(turns, block=2)
    seen = []

    def walk(node):
        if node.nodeName() == "Window" and "speaker" in node.partitionSpec().toString():
            seen.append({node.output().apply(i).name() for i in range(node.output().length())})
        for i in range(node.children().length()):
            walk(node.children().apply(i))
    walk(found._jdf.queryExecution().optimizedPlan())
    assert seen and all(not names & {"t", "p", "rendered"} for names in seen)
    rows = sorted(found.where("speaker = 'a'").collect(), key=lambda r: r.block)
    assert [r.start_char for r in rows] == [sum(len(x.rendered) for x in rows[:i]) for i in range(len(rows))]
