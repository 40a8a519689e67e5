"""Language proportions of documents by expectation-maximisation over a mixture of languages.

Every language is a distribution over hashed byte trigrams, counted over all labelled documents. A document's trigrams are taken
as drawn from a mixture of languages; expectation-maximisation gives the proportions. Language sets of growing size
(the most frequent ones of the full fit), up to all learned languages, are fitted on their own and compared by likelihood less
a penalty of half the logarithm of the trigram count per further language. A document's sets grow until an upper bound of the likelihood
of every mixture, less the penalty of the next size, is not above the best value, so no size that could win is left out. The prediction is the largest part of the best set.

Counting adds up per task before the shuffle, so a frequent language is no hot key; the model has one row for each language and trigram bucket.
Prediction has no shuffle; all documents of a chunk are fitted together.

Defined results: null texts and texts without a letter are `und` with score 0; with nothing to learn from, all are. Null languages are
not learned. Repeated rows get equal results. Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from floegrid.llm.text import chunks, packed

BUCKETS = 1 << 13
UNKNOWN = "und"
CHUNK = 1 << 20
CHUNK_ROWS = 256


def fold_table() -> np.ndarray:
    """ASCII letters in lower case, other ASCII as a space, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for c in range(26):
        table[65 + c] = table[97 + c] = 97 + c
    return table


def trigram_counts(column: pa.Array) -> np.ndarray:
    """Trigram counts of each text: rows by buckets."""
    data, offsets = packed(column)
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.int64)
    b = fold_table()[data].astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    inside = owner[:-2] == owner[2:]
    blank = code == 0x202020
    use = inside & ~blank
    return np.bincount(owner[:-2][use] * BUCKETS + bucket[use], minlength=n * BUCKETS).reshape(n, BUCKETS)


def has_letter(column: pa.Array) -> np.ndarray:
    data, offsets = packed(column)
    fold = np.zeros(256, bool)
    fold[65:91] = fold[97:123] = True
    total = np.concatenate(([0], np.cumsum(fold[data])))
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode())
    return found


@dataclass
class LanguageModel:
    """Language names and the probability of each bucket in each language, buckets by languages."""

    languages: list[str]
    chances: np.ndarray

    def proportions(self, counts: np.ndarray, steps: int = 8) -> np.ndarray:
        """Proportions of the languages in each text (rows sum to 1); parts outside the chosen set are 0."""
        n, k = len(counts), len(self.languages)
        total = np.maximum(counts.sum(axis=1), 1).astype(np.float64)
        doc, bucket = np.nonzero(counts)
        c = counts[doc, bucket].astype(np.float32)
        chance = self.chances[bucket]

        def sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
            out = np.zeros((n, *values.shape[1:]))
            if len(doc):
                filled = np.unique(doc)
                out[filled] = np.add.reduceat(values, np.searchsorted(doc, filled))
            return out

        def fit(parts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Proportions and likelihood of the documents `rows`, and a bound of the likelihood of every mixture."""
            if len(rows) == n:
                d, own, ch = doc, c, chance
            else:
                place = np.full(n, -1)
                place[rows] = np.arange(len(rows))
                some = place[doc] >= 0
                d, own, ch = place[doc[some]], c[some], chance[some]
            size = total[rows][:, None]
            blank = counts[rows].sum(axis=1) == 0
            for _ in range(steps):
                joint = ch * parts.astype(np.float32)[d]
                parts = sums(joint * (own / joint.sum(axis=1))[:, None], d, len(rows)) / size
                parts[blank] = 1 / k
            joint = np.maximum((ch * parts.astype(np.float32)[d]).sum(axis=1), 1e-30)
            likelihood = sums(own * np.log(joint), d, len(rows))
            # The logarithm is concave: a mixture gains at most the log of the mean ratio of the language that fits best.
            gain = (sums(ch * (own / joint)[:, None], d, len(rows)) / size).max(axis=1, initial=0)
            return parts, likelihood, likelihood + size[:, 0] * np.log(np.maximum(gain, 1)) + 1e-6 * size[:, 0]

        if not k:
            return np.zeros((n, 0))
        full, _, bound = fit(np.full((n, k), 1 / k), np.arange(n))
        rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
        alone = sums(c[:, None] * np.log(chance), doc, n)
        best, value = np.eye(k)[np.argmax(alone, axis=1)], alone.max(axis=1)
        for size in range(2, k + 1):
            penalty = (size - 1) * np.log(np.maximum(total, 2)) / 2
            rows = np.flatnonzero(bound - penalty > value)
            if not len(rows):
                break
            start = np.where(rank[rows] < size, np.maximum(full[rows], 1e-3), 0)
            parts, likelihood, limit = fit(start / start.sum(axis=1, keepdims=True), rows)
            bound[rows] = np.minimum(bound[rows], limit)
            likelihood = likelihood - penalty[rows]
            better = likelihood > value[rows]
            best[rows[better]], value[rows[better]] = parts[better], likelihood[better]
        return best


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count the trigrams of every row with a language; a text that is null or has no trigram adds nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in chunks(batches, "_text", CHUNK, CHUNK_ROWS):
            counts = trigram_counts(batch.column("_text"))
            langs = np.array(batch.column("_lang").to_pylist(), object)
            for name in set(langs.tolist()):
                sums[name] = sums.get(name, 0) + counts[langs == name].sum(axis=0)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(total[at])], names=["lang", "bucket", "n"])
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    found = (rows.mapInArrow(run, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    at = {name: i for i, name in enumerate(names)}
    counts[found.column("bucket").to_numpy(), [at[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    chances = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)
    return LanguageModel(names, chances.astype(np.float32))


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` (the part of that language) and `lang_parts` (map of all parts above 0)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.chances))
    made = ("lang_pred", "score", "lang_parts")
    kept = [f for f in docs.schema.fields if f.name not in made]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("lang_parts", T.MapType(T.StringType(), T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        for batch in chunks(batches, text, CHUNK, CHUNK_ROWS):
            column = batch.column(text)
            letters = has_letter(column) & bool(known.languages)
            names, scores, parts = [], [], []
            proportions = known.proportions(trigram_counts(column)) if known.languages else [None] * len(letters)
            for found, row in zip(letters.tolist(), proportions):
                top = int(np.argmax(row)) if found else 0
                names.append(known.languages[top] if found else UNKNOWN)
                scores.append(min(1.0, float(row[top])) if found else 0.0)
                parts.append([(known.languages[i], float(row[i])) for i in np.flatnonzero(row)] if found else [])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(parts, pa.map_(pa.string(), pa.float64()))], names=schema.names)
    return docs.mapInArrow(run, schema)
