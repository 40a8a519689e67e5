"""The n-gram join, hard negatives and collocations against brute force on small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from floegrid.llm import collocations, hard_negatives, ngram_join

from . import samples


def near_copies(rng: random.Random) -> list[tuple]:
    """A chain in which only neighbours link, copies around a base, texts that share a frequent passage, and a text between two groups."""
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=60)
    rows, n = [], 0

    def add(words: list[str]) -> None:
        nonlocal n
        rows.append((n, " ".join(words), "en", "s", 1))
        n += 1
    for _ in range(4):
        words = rng.choices(vocabulary, k=rng.randint(40, 160))
        for _ in range(14):
            add(words)
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
    base = rng.choices(vocabulary, k=300)
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        add(copy)
    for _ in range(40):
        add(rng.choices(vocabulary, k=rng.randint(0, 90)) + passage)
    for _ in range(3):
        add(passage)
    for _ in range(12):
        add(rng.choices(vocabulary[:6], k=rng.randint(1, 5)))
    return rows


@pytest.mark.parametrize(("size", "percent", "block"), [(4, 85, 2048), (4, 85, 7), (2, 60, 16)])
def test_joined_components_equal_all_pairs(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(random.Random(31 + size))
    rng = random.Random(5)
    rng.shuffle(rows)
    rows += [r for r in samples.awkward(rng) if r[0] is not None and r[0] != 1005]
    got = ngram_join.assign(samples.frame(spark, rows), size, percent).collect()
    want = samples.components_brute([(r[0], r[1]) for r in rows], size, percent)
    assert {r["_id"]: (r.n_shingles, r.component_id) for r in got} == {k: v[:2] for k, v in want.items()}


def test_join_of_awkward_rows(spark):
    rows = samples.awkward(random.Random(1))
    docs = samples.frame(spark, rows).withColumn("component_id", F.lit("clash")).withColumn("bits", F.lit(1)).withColumn("label", F.lit(2))
    got = ngram_join.jaccard_components(docs, 4, 85).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1000].n_shingles == 0 and by_id[1000].component_id == 1000 and by_id[1000].group is None
    assert by_id[1005].component_id == 1005 and by_id[1005].n_shingles == 1 and by_id[1005].label == 2
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    sets = [rng.choice(1 << 62, rng.integers(1, 900), replace=False).astype(np.uint64) for _ in range(40)]
    sets += [np.concatenate((s[: len(s) * 9 // 10], rng.integers(0, 1 << 62, 20).astype(np.uint64))) for s in sets]
    sets = [np.unique(s) for s in sets]
    maps = ngram_join.parity_bitmaps(np.concatenate(sets), np.cumsum([0, *map(len, sets)])).to_pylist()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = len(np.setxor1d(a, b))
            assert ngram_join.least_difference(maps[i], maps[j]) <= apart
            if 4 * apart < len(a):
                assert ngram_join.least_difference(maps[i], maps[j]) >= apart // 3


def mined_brute(rows: list[tuple], every: int) -> list[tuple]:
    usable = [(i, r[0], r[1], [math.floor(256 * x) for x in r[2]]) for i, r in enumerate(rows)
              if r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])]
    out = []
    for i, key, label, v in usable:
        if key is None or key % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), float("inf") if k is None else k, j, m, k) for j, k, m, w in usable if j != i)
        for p in [s for s in scored if s[3] == label][:5]:
            inside = [s for s in scored if s[3] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:3]
            out += [(key, p[4], n + 1, s[4], -p[0], -s[0]) for n, s in enumerate(inside)]
    return out


def vectors(rng: np.random.Generator, n: int) -> list[tuple]:
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(c := rng.integers(0, 6)), (centres[rng.integers(0, 6) if rng.random() < .3 else c] + rng.normal(size=8) * .4).tolist())
            for i in range(n)]
    # One vector that a third of the rows have, repeated rows, and rows that take no part.
    rows += [(n + i, i % 3, rows[0][2]) for i in range(n // 2)]
    rows += [rows[10], rows[10], (None, 1, rows[3][2]), (2 * n, None, rows[3][2]), (2 * n + 1, 1, None), (2 * n + 2, 1, []),
             (2 * n + 3, 1, [float("nan")] * 8), (2 * n + 4, 1, [1.0] * 7 + [None]), (2 * n + 5, 2, [float("inf")] * 8)]
    return rows


def sorted_rows(rows: list[tuple]) -> list[tuple]:
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


@pytest.mark.parametrize("sizes", [{}, {"pivots": 5, "sample": 30, "shard_rows": 64}])
def test_mined_negatives_equal_brute_force(spark, sizes):
    rows = vectors(np.random.default_rng(8), 400)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("_rid", F.lit("clash"))
    got = hard_negatives.mine(frame.drop("_rid") if sizes else frame, F.col("vec_id") % 20 == 0, F.col("label"), **sizes).collect()
    want = mined_brute(rows, 20)
    assert want and sorted_rows(map(tuple, got)) == sorted_rows(want)
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 20 == 0, F.col("label")).count() == 0


def test_rows_of_another_length_take_no_part(spark):
    rows = vectors(np.random.default_rng(9), 60)
    frame = spark.createDataFrame(rows + [(9000, 1, [1.0, 2.0])], "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(frame, F.col("vec_id") % 20 == 0, F.col("label")).collect()
    assert sorted_rows(map(tuple, got)) == sorted_rows(mined_brute(rows, 20))


def test_covering_radii_hold_all_rows_of_a_node():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(700, 6)) * 100)
    x[100:300] = x[5]
    largest = float((x * x).sum(axis=1).max())
    tree = hard_negatives.build(x, np.arange(700), np.arange(700), rng.integers(0, 3, 700), largest)
    points = hard_negatives.augmented(tree.vectors, largest)
    assert sorted(tree.rid) == list(range(700))
    for i in range(len(tree.low)):
        apart = hard_negatives.distances(points[tree.low[i]:tree.high[i]], points[tree.centre[i]])
        assert apart.max() <= tree.radius[i] + 1e-9
        kids = tree.children[tree.child[i]:tree.child[i + 1]]
        if len(kids):
            assert (tree.radius[kids] <= tree.radius[i] / 2 + 1e-9).all()
            assert tree.low[kids].min() == tree.low[i] and tree.high[kids].max() == tree.high[i]


def phrases_brute(docs: list[tuple], floor: int, top: int) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) in exact integers."""
    counts: dict[str, Counter] = {}
    for text, lang in docs:
        c = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(samples.LOWER)):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        rows = []
        for p, a in c.items():
            if len(p) < 2 or a < floor:
                continue
            score, _, left, right = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            around = [f for q, f in c.items() if len(q) == 3 and f >= floor and p in (q[:2], q[1:])] if len(p) == 2 else []
            if not any(100 * f >= 50 * a for f in around):
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return out


@pytest.mark.parametrize("sizes", [{}, {"head": 12, "side": 4, "flush": 300, "strip_mass": 100}, {"head": 200, "side": 32, "strip_mass": 64},
                                   {"head": 1, "side": 2}])
def test_phrases_equal_brute_force(spark, sizes):
    rng = random.Random(12)
    vocabulary = ["the", "of", "new york", "new york city", "ünder", "wie Geht es", "x", "漢 字"] + [f"v{i}" for i in range(30)]
    docs = [("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for _ in range(rng.randint(0, 120))),
             rng.choice(["en", "en", "de", None])) for _ in range(120)]
    docs += [docs[0]] * 3 + [(None, "en"), ("", "de"), (None, None), ("word " * 3000, "en"), ("\x00 zero", "fr")]
    frame = spark.createDataFrame(docs, "text string, lang string").withColumn("key", F.lit("clash")).withColumn("n", F.lit(1))
    got = [tuple(r) for r in collocations.collocations(frame, 40, 4, **sizes).collect()]
    assert sorted(got) == sorted(phrases_brute(docs, 4, 40))
    assert collocations.collocations(frame.limit(0)).count() == 0


def test_scores_past_64_bits_are_exact(spark):
    a, left, right = 10 ** 14 + 7, 10 ** 14 + 9, 3 * 10 ** 14 + 1
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(F.expr(collocations.score("a", "l", "r"))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)
