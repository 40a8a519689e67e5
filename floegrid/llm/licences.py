"""Licence scan: a trained paragraph classifier whose finds are confirmed against templates.

A paragraph is a line with a word. Lines that follow each other without a line between that has no word are a run, and notices are sought in runs,
so neither line breaks nor the length of a line hide one. A span of words is a sparse vector of hashed words and word pairs. A logistic
regression with a row of weights for each licence family and one for "none" gives probabilities; a temperature fitted on held-out examples
calibrates them. A predicted family is confirmed by comparison with its templates: the span must contain at least MIN_SHARE of the words and
pairs of one of them, all its numbers, and no other mark (such as Affero or NonCommercial) than it. Spans are, in this order,

1. the places of a run where MIN_SHARE of a template stands within a little more than its length, the greatest share first,
2. lines of at most LONG words that no find touches,
3. windows of WINDOWS words, half over each other, of what is left of runs of several lines and of longer lines.

A line or window that is a licence with MIN_CHANCE and looks ALIKE, but whose family is below MIN_CHANCE or not confirmed, is of an unknown
licence; windows over each other are one find. A find that is alone in a line of at most LONG words has the line's bounds. The model is trained on the driver on variations of the templates and at most `ordinary`
lines of the corpus, one whole line, chosen by hash, of each of the documents with the least hash. Lines that look ALIKE to a template or speak of licences or rights are left
out, as they may be notices of families without a template. The model's size is fixed. Rows are independent: there is no shuffle besides that choice.

Defined results: a null or empty text has no paragraph and no licence; repeated rows get equal results; an empty table is trained on templates alone.
Other columns are passed through; made columns replace columns of their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from floegrid.llm.text import chunks, packed, pair, word_hashes, word_spans, word_table, lower_table

BITS = 13
MIN_CHANCE = 0.7
MIN_SHARE = 0.75
ALIKE = 0.25
ORDINARY = 4_000
UNKNOWN_FAMILY = "unknown"
# Words of a span that is scored whole: more than the longest template; and of the windows of longer ones.
LONG = 80
WINDOWS = (16, LONG)
BLOCK_WORDS = 1 << 17
# Words that tell the families of one publisher apart; they hold where the first word of the group stands in a template.
MARKS = {"gnu": ["affero", "lesser", "library"],
         "cc": ["nc", "sa", "nd"], "commons": ["noncommercial", "sharealike", "noderivatives", "noderivs"]}

# Usual notices of public licence families.
TEMPLATES: dict[str, list[str]] = {
    "agpl-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.",
                 "Released under the GNU Affero General Public License version 3 or later.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met.",
                     "Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "cc0-1.0": ["Released into the public domain under CC0 1.0 Universal."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                 "Public License as published by the Free Software Foundation, either version 2 of the License, or any later version."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "lgpl-3.0": ["Licensed under the GNU Lesser General Public License, version 3.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced without permission."],
}
# Sentences that speak of licences without granting one.
NO_GRANT = ["You need a license to drive a car.", "The license of the restaurant was renewed in version 3 of the plan.",
            "The public library is open to any person free of charge.", "She made a copy of the file with permission."]


@dataclass
class Words:
    """Lines with a word (places in all bytes, text, run) and the words (hash, places, line, pair hash with the next word, 0 at a run's end)."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    line_run: np.ndarray
    line: np.ndarray
    hashes: np.ndarray
    pairs: np.ndarray
    w_start: np.ndarray
    w_end: np.ndarray

    @property
    def run(self) -> np.ndarray:
        return self.line_run[self.line]


def words_of(column: pa.Array) -> Words:
    data, offsets = packed(column)
    low = lower_table()[data]
    starts, ends = word_spans(low, offsets, low != 10)
    w_start, w_end = word_spans(low, offsets, word_table()[low])
    has, line = np.unique(np.searchsorted(starts, w_start, "right") - 1, return_inverse=True)
    starts, ends = starts[has], ends[has]
    owner = np.searchsorted(offsets, starts, "right") - 1
    fresh = np.ones(len(has), bool)
    fresh[1:] = (np.diff(has) > 1) | (starts[1:] - ends[:-1] > 1) | (owner[1:] != owner[:-1])
    line_run = np.cumsum(fresh) - 1
    hashes = word_hashes(low, w_start, w_end)
    pairs = np.zeros(len(hashes), np.uint64)
    if len(hashes) > 1:
        run = line_run[line]
        pairs[:-1] = np.where(run[1:] == run[:-1], pair(hashes[:-1], hashes[1:]), np.uint64(0))
    return Words(starts, ends, owner, line_run, line, hashes, pairs, w_start, w_end)


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class LicenceModel:
    """Families, weights (buckets by families + none), their constants and the temperature; the last class is none."""

    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def chances(self, words: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the classes for spans of words, `last` excluded; a span is in one run and not empty."""
        out = np.zeros((len(first), len(self.bias)))
        order = np.argsort(first, kind="stable")
        at = 0
        while at < len(order):
            base = first[order[at]]
            to = max(at + 1, int(np.searchsorted(first[order], base + BLOCK_WORDS)))
            some = order[at:to]
            a, b, top = first[some] - base, last[some] - base, last[some].max()
            singles, pairs = (np.concatenate((np.zeros((1, len(self.bias))), np.cumsum(self.weights[bucket(h[base:top])], axis=0, dtype=np.float64)))
                              for h in (words.hashes, words.pairs))
            z = (singles[b] - singles[a] + pairs[b - 1] - pairs[a]) / np.sqrt(2 * (b - a) - 1)[:, None]
            z = (z + self.bias) / self.temperature
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out[some] = e / e.sum(axis=1, keepdims=True)
            at = to
        return out


def _variations(rng: np.random.Generator, text: str, n: int) -> list[str]:
    """The text, and copies with single words left out or added, in other case, or inside a sentence."""
    fill = "the file and its parts see below for details by the authors note that code here".split()
    out = [text]
    for _ in range(n - 1):
        words = text.split()
        if len(words) > 5 and rng.random() < 0.5:
            del words[rng.integers(len(words))]
        for _ in range(rng.integers(0, 4)):
            words.insert(0 if rng.random() < 0.5 else len(words), fill[rng.integers(len(fill))])
        out.append(" ".join(words).upper() if rng.random() < 0.1 else " ".join(words))
    return out


def train(ordinary: list[str], seed: int = 5, steps: int = 300) -> LicenceModel:
    """Gradient descent on the cross entropy; a fifth of the examples is left out and sets the temperature."""
    rng = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    texts, labels = [], []
    for k, family in enumerate(families):
        for t in TEMPLATES[family]:
            some = _variations(rng, t, 40)
            texts += some
            labels += [k] * len(some)
    for t in NO_GRANT:
        some = _variations(rng, t, 20)
        texts += some
        labels += [len(families)] * len(some)
    texts += ordinary
    labels += [len(families)] * len(ordinary)
    texts = [t.replace("\n", " ") for t in texts]
    y = np.array(labels)
    w = words_of(pa.array(texts, pa.string()))
    line, hashes, pairs = w.line, w.hashes, w.pairs
    y, n, classes = y[w.owner], len(w.starts), len(families) + 1
    some = pairs != 0
    rows, cols = np.concatenate([line, line[some]]), np.concatenate([bucket(hashes), bucket(pairs[some])])
    value = 1 / np.sqrt(np.bincount(rows, minlength=n))
    held = rng.random(n) < 0.2
    weight = np.where(held, 0.0, 1.0) / np.bincount(y, minlength=classes)[y]
    weight /= weight.sum()
    model = LicenceModel(families, np.zeros((1 << BITS, classes), np.float64), np.zeros(classes), 1.0)
    used, col = np.unique(cols, return_inverse=True)
    part, seen = np.zeros((len(used), classes)), np.full((len(used), classes), 1e-8)
    order = np.argsort(col, kind="stable")
    cuts = np.searchsorted(col[order], np.arange(len(used)))
    by_row = np.argsort(rows, kind="stable")
    row_cuts = np.searchsorted(rows[by_row], np.arange(n))
    target = np.eye(classes)[y]

    def logits() -> np.ndarray:
        return np.add.reduceat(part[col[by_row]], row_cuts) * value[:, None] + model.bias
    for _ in range(steps):
        z = logits()
        e = np.exp(z - z.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - target) * weight[:, None]
        grad = np.add.reduceat((error * value[:, None])[rows[order]], cuts) + 1e-6 * part
        seen += grad ** 2
        part -= 0.3 * grad / np.sqrt(seen)
        model.bias -= 2.0 * error.sum(axis=0)
    model.weights[used] = part
    z = logits()[held]
    best = None
    for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0):
        s = z / t - (z / t).max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y[held]])) if len(s) else 0.0
        if best is None or loss < best[0]:
            best = (loss, t)
    model.temperature = best[1]
    return model


@dataclass
class Template:
    """A template's words and pairs, the number of its words, its numbers, the marks that it must not lack and those that it must not have."""

    family: str
    features: np.ndarray
    length: int
    needed: np.ndarray
    barred: np.ndarray

    def confirmed(self, own: np.ndarray) -> bool:
        return bool(np.isin(self.needed, own).all() and not np.isin(self.barred, own).any())


def _hash(words: list[str]) -> np.ndarray:
    return words_of(pa.array(words, pa.string())).hashes


def template_list() -> list[Template]:
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            w = words_of(pa.array([text], pa.string()))
            known = re.findall("[a-z0-9]+", text.lower())
            marks = [m for first, group in MARKS.items() if first in known for m in group]
            out.append(Template(family, np.unique(np.concatenate([w.hashes, w.pairs[:-1]])), len(w.hashes),
                                _hash(sorted({x for x in known if x.isdigit() or x in marks})), _hash([m for m in marks if m not in known])))
    return out


def features_of(words: Words, first: int, last: int) -> np.ndarray:
    """Hashes of the words and pairs of a span."""
    return np.concatenate([words.hashes[first:last], words.pairs[first:last - 1]])


def template_share(own: np.ndarray, template: Template) -> float:
    """Part of a template's words and pairs that a span contains."""
    return float(np.isin(template.features, own).mean())


def template_index(templates: list[Template]) -> tuple[np.ndarray, np.ndarray]:
    """The words and pairs of all templates, and for each template which of them are its own."""
    every = np.unique(np.concatenate([t.features for t in templates]))
    return every, np.stack([np.isin(every, t.features) for t in templates])


def template_spans(words: Words, templates: list[Template], index: tuple[np.ndarray, np.ndarray]) -> list[tuple[float, int, int, int]]:
    """(share, template, first, last) of the shortest spans of a run that hold MIN_SHARE of a template within a little more than its length."""
    run = words.run
    every, own = index
    # A pair is placed at its second word, so a span holds it when it holds both words.
    at = np.concatenate([np.arange(len(run)), np.arange(1, len(run) + 1)])
    kind = np.concatenate([words.hashes, words.pairs])
    slot = np.minimum(np.searchsorted(every, kind), len(every) - 1)
    some = np.flatnonzero(every[slot] == kind)
    some = some[np.argsort(at[some], kind="stable")]
    at, slot = at[some], slot[some]
    out = []
    for k, t in enumerate(templates):
        mine = own[k][slot]
        place, what = at[mine], slot[mine]
        need, size = int(np.ceil(MIN_SHARE * len(t.features))), t.length + t.length // 4 + 4
        if len(place) < need:
            continue
        to = place[need - 1:]
        start = place[:len(to)]
        tight = np.unique(start[(to - start < size) & (run[start] == run[to])])
        found = []
        for s in tight.tolist():
            low, high = np.searchsorted(place, [s, s + size])
            inside = np.arange(low, high)
            inside = inside[run[place[inside]] == run[s]]
            _, firsts = np.unique(what[inside], return_index=True)
            if len(firsts) < need:
                continue
            end = place[inside[firsts]].max()
            inside = inside[place[inside] <= end][::-1]
            _, lasts = np.unique(what[inside], return_index=True)
            first = min(place[inside[lasts]].min(), end)
            found.append((len(lasts) / len(t.features), k, int(first), int(end) + 1))
        out += sorted(set(found))
    return out


def find_notices(words: Words, model: LicenceModel, templates: list[Template],
                 index: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, str, float, float]]:
    """(first word, last word excluded, family, chance, share) of all finds in the order of their places; see the module's docstring."""
    n = len(words.hashes)
    index = index or template_index(templates)
    if not n:
        return []
    finds: list[tuple[int, int, str, float, float]] = []
    taken = np.zeros(n, bool)
    by_family = {f: [t for t in templates if t.family == f] for f in model.families}
    line_first = np.searchsorted(words.line, np.arange(len(words.starts) + 1))

    def judge(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, str, float, float]]:
        chances = model.chances(words, first, last)
        for i in np.flatnonzero(chances[:, -1] < 0.5):
            k = int(np.argmax(chances[i, :-1]))
            own = features_of(words, first[i], last[i])
            shares = [(template_share(own, t), t) for t in by_family[model.families[k]]]
            share = max(x for x, _ in shares)
            sure = chances[i, k] >= MIN_CHANCE and any(x >= MIN_SHARE and t.confirmed(own) for x, t in shares)
            if sure or (chances[i, -1] <= 1 - MIN_CHANCE and share >= ALIKE):
                yield int(first[i]), int(last[i]), model.families[k] if sure else UNKNOWN_FAMILY, float(chances[i, k]), share

    spans = [x for x in template_spans(words, templates, index) if templates[x[1]].confirmed(features_of(words, x[2], x[3]))]
    spans.sort(key=lambda x: (-x[0], x[2] - x[3], x[2]))
    chances = model.chances(words, np.array([x[2] for x in spans], np.int64), np.array([x[3] for x in spans], np.int64))
    for (share, k, first, last), chance in zip(spans, chances):
        own = model.families.index(templates[k].family)
        if chance[own] >= MIN_CHANCE and not taken[first:last].any():
            taken[first:last] = True
            finds.append((first, last, model.families[own], float(chance[own]), share))

    free = np.concatenate(([0], np.cumsum(taken)))
    whole = (np.diff(line_first) <= LONG) & (free[line_first[1:]] == free[line_first[:-1]])
    lines = list(judge(line_first[:-1][whole], line_first[1:][whole]))
    for f in lines:
        taken[f[0]:f[1]] = True
    finds += lines

    cut = np.ones(n, bool)
    cut[1:] = (np.diff(words.run) > 0) | (np.diff(taken.astype(np.int8)) != 0)
    p_first = np.flatnonzero(cut)
    p_last = np.append(p_first[1:], n)
    size = p_last - p_first
    scored = (line_first[words.line[p_first]] == p_first) & (line_first[words.line[p_first] + 1] == p_last) & (size <= LONG)
    left = ~taken[p_first] & ~scored
    p_first, p_last, size = p_first[left], p_last[left], size[left]
    windows = []
    for width in WINDOWS:
        step = width // 2
        count = 1 + np.maximum(0, -(-(size - width) // step))
        which = np.repeat(np.arange(len(size)), count)
        first = p_first[which] + (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)) * step
        windows += judge(first, np.minimum(first + width, p_last[which]))
    # The family of a confirmed window goes before an unknown one; windows over each other are one find.
    merged: list[tuple[int, int, str, float, float]] = []
    for f in sorted(windows, key=lambda x: (x[2] == UNKNOWN_FAMILY, x[0], -x[1])):
        if f[2] != UNKNOWN_FAMILY:
            if taken[f[0]:f[1]].any():
                continue
            taken[f[0]:f[1]] = True
        elif taken[f[0]:f[1]].any():
            continue
        elif merged and merged[-1][2] == UNKNOWN_FAMILY and f[0] < merged[-1][1]:
            best = max(merged[-1], f, key=lambda x: x[3])
            merged[-1] = (merged[-1][0], max(merged[-1][1], f[1]), UNKNOWN_FAMILY, best[3], best[4])
            continue
        merged.append(f)
    return sorted(finds + merged)


def find_bounds(words: Words, finds: list[tuple[int, int, str, float, float]]) -> list[tuple[int, int]]:
    """Byte places of each find: its line if it is alone in one of at most LONG words, else from its first word to its last, or to the end of that one's line."""
    line_first = np.searchsorted(words.line, np.arange(len(words.starts) + 1))
    lines = [(int(words.line[f[0]]), int(words.line[f[1] - 1])) for f in finds]
    count = Counter(x for a, b in lines for x in range(a, b + 1))
    out = []
    for (first, last, *_), (a, b) in zip(finds, lines):
        if a == b and count[a] == 1 and line_first[a + 1] - line_first[a] <= LONG:
            out.append((int(words.starts[a]), int(words.ends[a])))
        else:
            out.append((int(words.w_start[first]), int(words.ends[b] if last == line_first[b + 1] else words.w_end[last - 1])))
    return out


# Beginnings of words that speak of licences or rights in the languages of the corpus.
OF_RIGHTS = ("licen", "lizenz", "copyright", "rights", "permission", "derechos", "droits", "rechte", "urheber", "redistribut", "warrant")


def ordinary_paragraphs(docs: DataFrame, ordinary: int, key: str, text: str) -> list[str]:
    """At most `ordinary` whole lines, one by hash from each of the documents with the least hash, without any that may be a notice."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.trim(s)) > 0)
    # Only about twice the wanted rows pass the hash filter, so what tasks send does not grow with the number of documents.
    share = min(1.0, 2 * ordinary / max(docs.count(), 1))
    rows = (docs.where(F.col(text).isNotNull()).withColumn("h", F.xxhash64(key, text))
            .where(F.pmod("h", F.lit(1 << 31)) < int(share * (1 << 31))).select("h", lines.alias("lines")).where(F.size("lines") > 0)
            .select("h", F.element_at("lines", F.pmod(F.xxhash64("h"), F.size("lines")).cast("int") + 1).alias("p"))
            .orderBy("h", "p").limit(ordinary).collect())
    found = [r["p"] for r in rows if not any(x in r["p"].lower() for x in OF_RIGHTS)]
    if not found:
        return []
    templates = template_list()
    w = words_of(pa.array(found, pa.string()))
    bounds = np.searchsorted(w.line, np.arange(len(w.owner) + 1))
    return [found[o] for i, o in enumerate(w.owner)
            if all(template_share(features_of(w, bounds[i], bounds[i + 1]), t) < ALIKE for t in templates)]


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", ordinary: int = ORDINARY) -> DataFrame:
    """`docs` with n_paragraphs, licences (sorted, comma-joined, null if none), n_licence, n_unknown and finds.

    finds: array of (paragraph, family, chance, share, first, end): the number of the first line and byte places in the text. The family of an unknown
    licence is `unknown`.
    """
    model = train(ordinary_paragraphs(docs, ordinary, key, text))
    shared = docs.sparkSession.sparkContext.broadcast(
        ((model.families, model.weights.astype(np.float32), model.bias, model.temperature),
         # Plain values: a broadcast object of a class of this package would need the package on the worker's path.
         [(t.family, t.features, t.length, t.needed, t.barred) for t in template_list()]))
    made = {"n_paragraphs": "long", "licences": "string", "n_licence": "long", "n_unknown": "long",
            "finds": "array<struct<paragraph:int,family:string,chance:double,share:double,first:int,end:int>>"}
    kept = [f for f in docs.schema.fields if f.name not in made]
    schema = T.StructType([*kept, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in made.items()]])
    finds_type = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("chance", pa.float64()),
                                     ("share", pa.float64()), ("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, plain = shared.value
        known, templates = LicenceModel(*parts), [Template(*t) for t in plain]
        index = template_index(templates)
        for batch in chunks(batches, text):
            column = batch.column(text)
            words = words_of(column)
            owner = words.owner
            _, offsets = packed(column)
            numbers = np.arange(len(owner)) - np.searchsorted(owner, owner)
            finds: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            found = find_notices(words, known, templates, index)
            for (first, _, family, chance, share), (start, end) in zip(found, find_bounds(words, found)):
                i = words.line[first]
                finds[owner[i]].append({"paragraph": int(numbers[i]), "family": family, "chance": chance, "share": share,
                                        "first": int(start - offsets[owner[i]]), "end": int(end - offsets[owner[i]])})
            names = [sorted({f["family"] for f in x if f["family"] != UNKNOWN_FAMILY}) for x in finds]
            unknown = [sum(f["family"] == UNKNOWN_FAMILY for f in x) for x in finds]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(np.bincount(owner, minlength=batch.num_rows)),
                 pa.array([",".join(x) if x else None for x in names], pa.string()),
                 pa.array([len(x) - u for x, u in zip(finds, unknown)], pa.int64()), pa.array(unknown, pa.int64()),
                 pa.array(finds, finds_type)], names=schema.names)
    return docs.mapInArrow(run, schema)
