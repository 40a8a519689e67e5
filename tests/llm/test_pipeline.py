"""The pipeline's stages one by one against brute force, and on awkward documents."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from floegrid.llm.tables import cut

from . import samples

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
        out.append(docs.collect())
    return out


def test_stages_by_brute_force(spark, steps):
    start, good, single, cleaned, last, encoded = steps
    label = dict(spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").select("doc_id", "quality").collect())
    kept = {r.doc_id for r in good}
    wrong = [r.doc_id for r in start if r.doc_id in label and (r.doc_id in kept) != bool(label[r.doc_id])]
    assert len(wrong) <= 0.06 * len(label)
    groups = samples.components_brute([(r.doc_id, r.text) for r in good], 5)
    assert {r.doc_id for r in single} == {i for i, g in groups.items() if g[2]}
    texts = [r.text for r in single]
    want = samples.cut_brute(texts, corpus_pipeline.REPEAT_BYTES)
    by_id = {r.doc_id: r for r in cleaned}
    assert len(by_id) == len(single) and sum(w[1] for w in want)
    for r, w in zip(single, want):
        assert by_id[r.doc_id].text == w[3].decode("utf-8", "ignore")
        assert by_id[r.doc_id].n_chars == len(by_id[r.doc_id].text)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = samples.contamination_brute([(r.doc_id, r.text) for r in cleaned], items)
    assert {r.doc_id for r in last} == {i for i, f in found.items() if not f[4]}
    assert {r.doc_id: r.decoded_sha256 for r in encoded} == {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in last}


def test_run_gives_the_last_stage(spark, steps):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, steps[-1]))


def test_awkward_documents_pass_every_stage(spark):
    docs = samples.frame(spark, samples.awkward(random.Random(1)))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
