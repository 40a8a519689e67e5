"""Encoding, long repeats, near copies and benchmark text against brute force on small tables."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from floegrid.llm import near_dup, suffix_dedup
from floegrid.llm.bpe import Encoder, Vocabulary, encode_documents, read_vocabulary
from floegrid.llm.decontaminate import find_benchmark, is_contaminated
from floegrid.llm.queries import vocabulary_path

from . import samples


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def test_encoding_matches_the_library(library):
    rng = random.Random(3)
    alphabet = "abcdefgh   \n\t'sdtre1234567890!!##éüñß漢字かな\x1c\x1d\x85​🙂́-_AZ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 3000, " " * 999, "<|endoftext|>x<|endoftext|><|endoftext|>", "<|endoftext", "ab" * 2000, "don't we'll I'M"]
    encoder = Encoder(Vocabulary.from_json(read_vocabulary(vocabulary_path())))
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = encoder.encode(text)
        assert ids == want.ids, text
        assert encoder.decode(ids) == text == library.decode(ids, skip_special_tokens=False)


def test_encoded_rows(spark, library):
    rows = samples.awkward(random.Random(1))
    docs = samples.frame(spark, rows).withColumn("n_tokens", F.lit("clash"))
    got = encode_documents(docs, vocabulary_path()).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert encode_documents(docs.limit(0), vocabulary_path()).count() == 0


def long_repeats(rng: random.Random) -> list[str | None]:
    passage, other = samples.sentence(rng, 200), samples.sentence(rng, 75)
    base = samples.sentence(rng, 400)
    texts: list[str | None] = [None, "", "short", base, base, base[:900] + "!" + base[900:], base[37:1500], other, other + "x",
                               passage[:399], passage[:400] + "q", "é" * 500, "ab" * 900, "z" * 1200]
    for _ in range(25):
        cut = rng.randint(0, 300)
        texts.append(samples.sentence(rng, 40) + passage[cut:cut + rng.randint(380, 700)] + samples.sentence(rng, 30))
    texts.append(samples.sentence(rng, 10) + (samples.sentence(rng, 60) + " ") * 4)
    return texts


@pytest.mark.parametrize(("range_rows", "length"), [(8_000, 400), (3, 400), (50, 240), (3, 37), (8_000, 16)])
def test_long_repeats_match_brute_force(spark, monkeypatch, range_rows, length):
    """With 3 suffixes in a range, most fingerprints are shared by several tasks."""
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", range_rows)
    texts = long_repeats(random.Random(5))
    docs = samples.frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).withColumns(
        {"n_bytes": F.lit("clash"), "_k1": F.lit(1)})
    found = suffix_dedup.remove_repeats(docs, length).collect()
    assert all(r["_k1"] == 1 for r in found)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    want = samples.removed_brute(texts, length)
    assert got == dict(enumerate(want)) and sum(w[1] for w in want) > 20_000


def test_long_repeats_of_awkward_rows(spark):
    rows = samples.awkward(random.Random(1))
    got = suffix_dedup.remove_repeats(samples.frame(spark, rows)).collect()
    want = samples.removed_brute([r[1] for r in rows], 400)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert all(r.kept_text == (r.text or "") for r in got if not r.n_removed)
    assert suffix_dedup.remove_repeats(samples.frame(spark, [])).count() == 0


def test_loser_tree_gives_sorted_suffixes_with_their_common_prefixes():
    rng = random.Random(8)
    runs = []
    for _ in range(7):
        own = sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(rng.randint(0, 30)))
        runs.append(suffix_dedup.front_decode(suffix_dedup.front_code(own)))
        assert runs[-1][0] == own
    before, out = b"", []
    for run, i, shared in suffix_dedup.LoserTree(runs):
        s = runs[run][0][i]
        assert shared == len(next((before[:n] for n in range(min(len(before), len(s)), -1, -1) if before[:n] == s[:n])))
        out.append(s)
        before = s
    assert out == sorted(s for r in runs for s in r[0])


def near_copies(rng: random.Random) -> list[tuple[int, str | None]]:
    texts: list[str | None] = [None, "", "  ", "one", "ONE", "one two", "Two One"]
    for _ in range(12):
        words = samples.sentence(rng, rng.randint(8, 150)).split()
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 9)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 8))):
                copy[rng.randrange(len(copy))] = samples.sentence(rng, 1)
            texts.append((" " if rng.random() < .5 else "\n").join(copy).upper() if rng.random() < .3 else " ".join(copy))
            if rng.random() < .3:
                words = copy
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("size", [2, 5])
def test_near_copies_match_all_pairs(spark, size):
    docs = near_copies(random.Random(11))
    table = samples.frame(spark, [(i, t, None, None, None) for i, t in docs]).withColumns({"group": F.lit(1), "kept": F.lit("no")})
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(table, size).collect()}
    assert got == samples.components_brute(docs, size)


def test_near_copies_of_awkward_rows(spark):
    rows = samples.awkward(random.Random(1))
    got = near_dup.near_duplicates(samples.frame(spark, rows), 2).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.n_shingles == 0 and r.kept and r.component_id == r.doc_id for k in (1000, 1001, 1002) for r in by[k])
    assert [r.component_id for r in by[1005]] == [1005, 1005] and all(r.kept for r in by[1005])
    assert len(near_dup.one_of_each(samples.frame(spark, rows), 2).where("doc_id = 1005").collect()) == 1
    assert near_dup.near_duplicates(samples.frame(spark, []), 2).count() == 0


def test_a_link_between_members_that_are_no_centre_is_found(spark):
    """A chain of copies, each near the next only, is one component whichever member is the centre of a bucket."""
    rng = random.Random(2)
    words = samples.sentence(rng, 200).split()
    docs = []
    for i in range(12):
        docs.append((i, " ".join(words)))
        words = list(words)
        for j in range(i * 15, i * 15 + 15):
            words[j % 200] = samples.sentence(rng, 1)
    table = samples.frame(spark, [(i, t, None, None, None) for i, t in docs])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(table, 2).collect()}
    assert got == samples.components_brute(docs, 2) and {v[1] for v in got.values()} == {0}


def test_odd_sketches_estimate_high_similarities():
    import numpy as np
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = (np.sort(np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)])) for _ in range(2))
    values = near_dup.minhashes(np.concatenate([a, b]), np.array([0, 950, 1900]))
    s = near_dup.odd_sketches(values)
    assert abs(near_dup.sketch_similarity(s[0], s[1]) - 0.9) < 0.06


def benchmark_case(rng: random.Random):
    items = [(i, samples.sentence(rng, rng.randint(13, 40))) for i in range(12)]
    items += [(20, "tiny item"), (21, "Seven words are in THIS item, yes"), (22, None), (23, " .,; "), (0, "tiny item"), (24, "solo")]
    docs = []
    for i in range(40):
        key, text = items[rng.randrange(len(items))]
        words = (text or "").split()
        cut = rng.randint(0, 3)
        part = " ".join(words[cut:]).upper() if rng.random() < .5 else ", ".join(words[:len(words) - cut])
        docs.append((i, samples.sentence(rng, rng.randint(0, 60)) + " " + part + " " + samples.sentence(rng, rng.randint(0, 400))))
    return docs, items


def test_benchmark_text_matches_brute_force(spark):
    rng = random.Random(4)
    docs, items = benchmark_case(rng)
    docs += [(r[0], r[1]) for r in samples.awkward(rng) if r[0] is not None]
    table = samples.frame(spark, [(i, t, None, None, None) for i, t in docs]).withColumns({"n_words": F.lit("x"), "item_ids": F.lit(1)})
    found = find_benchmark(table, spark.createDataFrame(items, "item_id long, text string")).withColumn("bad", is_contaminated())
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.bad)
           for r in found.collect()}
    assert got == samples.contamination_brute(docs, items)
    assert sum(v[4] for v in got.values()) > 10


def test_benchmark_of_nothing(spark):
    rows = samples.awkward(random.Random(1))
    none = spark.createDataFrame([], "item_id long, text string")
    got = find_benchmark(samples.frame(spark, rows), none).collect()
    assert len(got) == len(rows) and all(r.n_hit == 0 and r.n_items == 0 for r in got)
    items = spark.createDataFrame([(None, "only a text"), (1, "x")], "item_id long, text string")
    assert find_benchmark(samples.frame(spark, []), items).count() == 0
    got = {r.text: r for r in find_benchmark(samples.frame(spark, rows), items).collect()}
    assert got["only a text"].n_items == 1 and got["only a text"].item_ids == [] and got["only a text"].n_hit == 3
