"""Language, quality and licence models by held-out accuracy, and their awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from floegrid.llm import language, licences, quality
from floegrid.llm.queries import REGISTRY

from . import samples

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    rows = REGISTRY["op5_language_mixture"][0](spark, SF).collect()
    lang = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_mixtures_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn_languages(docs)
    pick = {r.lang: r.text for r in docs.where("length(text) > 1500").orderBy("doc_id").collect()}
    both = pick["en"][:1500] + "\n" + pick["de"][:700]
    parts = dict(zip(model.languages, model.proportions(language.trigram_counts(pa.array([both, pick["fr"]])))[0]))
    assert abs(parts["en"] - 0.68) < 0.1 and abs(parts["de"] - 0.32) < 0.1
    alone = model.proportions(language.trigram_counts(pa.array([pick["fr"]])))[0]
    assert alone[model.languages.index("fr")] == 1


def test_mixtures_of_every_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn_languages(docs)
    pick = {r.lang: r.text for r in docs.where("length(text) > 1500 and lang is not null").orderBy("doc_id").collect()}
    assert len(pick) == len(model.languages) == 4
    text = "\n".join(pick[x][:1000] for x in model.languages)
    parts = model.proportions(language.trigram_counts(pa.array([pick["fr"], text, None])))[1]
    assert (parts > 0.15).all() and np.isclose(parts.sum(), 1)
    rng = np.random.default_rng(4)
    chances = rng.dirichlet(np.full(language.BUCKETS, 0.02), 7).T + 1e-6
    many = language.LanguageModel(list("abcdefg"), (chances / chances.sum(axis=0)).astype(np.float32))
    mean = many.chances[:, :6].mean(axis=1).astype(np.float64)
    parts = many.proportions(rng.multinomial(3000, mean / mean.sum(), 1))[0]
    assert (parts[:6] > 0.1).all() and parts[6] == 0


def test_language_of_awkward_rows(spark):
    rows = samples.awkward(random.Random(1)) + [(5, "12 34 ... 56", "en", "s", 1)]
    docs = samples.frame(spark, rows).withColumn("score", F.lit("clash"))
    got = language.predict_languages(docs, language.learn_languages(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "de") and 0 < r.score <= 1) if letters else (r.lang_pred == "und" and r.score == 0)
    nothing = language.learn_languages(docs.where("lang is null"))
    assert {r.lang_pred for r in language.predict_languages(docs, nothing).collect()} == {"und"}
    assert language.predict_languages(docs.limit(0), nothing).count() == 0


def test_quality_of_held_out_documents(spark):
    rows = REGISTRY["op8_quality_machine"][0](spark, SF).collect()
    label = dict(spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").select("doc_id", "quality").collect())
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.93


def test_linear_time_pairs_equal_all_pairs():
    rng = np.random.default_rng(3)
    machine = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, quality.RANK)))
    kinds, values = np.array([3, 7, 20, 41]), np.array([.5, -1, 2, .25])
    want = 0.3 + machine.weights[kinds] @ values + sum(
        machine.factors[kinds[i]] @ machine.factors[kinds[j]] * values[i] * values[j] for i in range(4) for j in range(i + 1, 4))
    assert np.isclose(machine.margin(np.array([0, 4]), kinds, values)[0], want)


def test_quality_of_awkward_rows(spark):
    rows = samples.awkward(random.Random(1))
    docs = samples.frame(spark, rows).withColumn("predicted", F.lit("clash"))
    labels = spark.createDataFrame([(1003, 1), (1004, 0), (1005, None), (None, 1), (1006, 1), (1006, 0), (77, 1)], "doc_id long, quality int")
    got = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id in (1000, 1001)]
    assert same[0] == same[1]
    blank = quality.score_quality(docs, quality.fit_quality(docs, labels.limit(0)))
    assert all(abs(r.score - 0.5) < 1e-6 for r in blank.collect())
    assert quality.score_quality(docs.limit(0), quality.fit_quality(docs.limit(0), labels)).count() == 0


def test_licences_of_documents(spark):
    """The licence lines of the documents are of four notices."""
    rows = licences.scan_licences(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).collect()
    lines = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "All rights reserved.": "proprietary",
             "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0"}
    for r in rows:
        want = sorted({f for line, f in lines.items() if line in (r.text or "").split("\n")})
        assert (r.licences or "") == ",".join(want)
        for f in r.finds:
            assert f.family == "unknown" or (r.text or "").encode()[f.first:f.end].decode() in lines


def test_licences_of_other_notices(spark):
    rows = [(1, "Some words here.\nlicensed under the apache license, version 2.0\nmore"), (2, "You need a license to fish in this lake."),
            (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files, to deal in the Software without restriction."), (4, None), (5, ""), (6, "\n \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("finds", F.lit(1))
    got = {r.doc_id: (r.n_paragraphs, r.licences) for r in licences.scan_licences(docs).collect()}
    assert got == {1: (3, "apache-2.0"), 2: (1, None), 3: (1, "mit"), 4: (0, None), 5: (0, None), 6: (0, None)}
    assert licences.scan_licences(docs.limit(0)).count() == 0
    rows = samples.awkward(random.Random(1))
    assert licences.scan_licences(samples.frame(spark, rows)).where("licences is null").count() == len(rows)


GPL_3 = ("    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU {}General Public License as published by\n"
         "    the Free Software Foundation, either version {} of the License, or\n    (at your option) any later version.")
MIT = (" * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\"), to deal\n"
       " * in the Software without restriction, including without limitation the rights\n * to use, copy, modify, merge, publish and sell copies of the Software.")
BSD = ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:")


def test_licences_in_wrapped_notices_and_one_line_documents(spark):
    """Hard-wrapped notices are put together; other versions and relatives are not taken for a family; long lines do not dilute a notice."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    filler = " ".join(docs.where("doc_id is not null and length(text) > 3000").orderBy("doc_id").first().text.split()[:400])
    rows = [("gpl-3.0", GPL_3.format("", 3)), ("gpl-2.0", GPL_3.format("", 2)), ("agpl-3.0", GPL_3.format("Affero ", 3)), (None, GPL_3.format("Lesser ", 2.1)),
            ("mit", MIT), ("bsd-3-clause", BSD), ("mit", f"A file.\n{MIT}\n\nint main() {{}}"), ("mit", MIT.replace("\n", "\r\n")),
            (None, BSD.replace("\n", "\n\n")), ("apache-2.0", f"{filler} Licensed under the Apache License, Version 2.0. {filler}"), (None, filler),
            ("gpl-3.0", f"{filler} {' '.join(GPL_3.format('', 3).split())} {filler}"),
            ("apache-2.0,mit", f"{filler} Released under the MIT License. {filler} Licensed under the Apache License, Version 2.0.")]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(docs.select("doc_id", "text").where("doc_id > 100").unionByName(frame)).where("doc_id <= 100").collect()}
    assert [got[i].licences for i in range(len(rows))] == [f for f, _ in rows]
    assert [f.family for f in got[3].finds] and {f.family for f in got[3].finds} == {"unknown"}
    span = got[9].finds[0]
    assert rows[9][1].encode()[span.first:span.end].decode() == "Licensed under the Apache License, Version 2.0"
