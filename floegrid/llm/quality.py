"""Document quality by a factorisation machine.

A document is a sparse vector of hashed words (weighted by the logarithm of their count, unit length), bins of structure statistics
and a bin of its size. The machine adds a weight per feature and a low-rank weight per pair of features;
all pairs are summed in time linear in the features, as half of the square of the sum minus the sum of squares.

The machine is fitted on the driver on at most `fit_rows` labelled documents, those with the least hash of their id, whose features are made in tasks.
Every document is scored, over its whole text. Rows are independent: there is no shuffle besides the choice of the fitting rows.

Defined results: null and empty texts get the score of a document without words; repeated rows get equal scores; a row with
a null or conflicting label is fitted as it stands, null labels are left out; without labels of both
kinds the score is the share of label 1, or 0.5 without any. Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from floegrid.llm.text import SPACE, chunks, mix, packed, word_hashes, word_spans, word_table

WORD_BITS = 14
BINS = 16
FIT_ROWS = 6_000
RANK = 8
STATISTICS = ("mean_word", "long_word", "upper", "digit", "mark", "symbol", "bar", "repeat_word", "repeat_line", "words", "size")
WIDTH = (1 << WORD_BITS) + len(STATISTICS) * BINS


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _byte_flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of all texts: n + 1 offsets, feature numbers and values."""
    data, offsets = packed(column)
    n = len(offsets) - 1
    inside = word_table(SPACE)[data]
    starts, ends = word_spans(data, offsets, inside)
    owner = np.searchsorted(offsets, starts, "right") - 1
    hashes = word_hashes(data, starts, ends)
    words = np.bincount(owner, minlength=n).astype(np.float64)

    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    first = np.concatenate(([True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])))[:len(o)]
    at = np.flatnonzero(first)
    count = np.diff(np.concatenate((at, [len(o)])))
    doc, kind = o[at], (h[at] >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, weights=value ** 2, minlength=n))
    value = value / np.maximum(norm[doc], 1e-9)

    size = np.diff(offsets).astype(np.float64)
    letters = np.maximum(_sums(inside, offsets), 1)
    lengths = (ends - starts).astype(np.float64)
    line_starts, line_ends = word_spans(data, offsets, data != 10)
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    line_hash = word_hashes(data, line_starts, line_ends)
    line_order = np.lexsort((line_hash, line_owner))
    lo, lh = line_owner[line_order], line_hash[line_order]
    again = np.concatenate(([False], (lo[1:] == lo[:-1]) & (lh[1:] == lh[:-1])))[:len(lo)]
    lines = np.bincount(line_owner, minlength=n)
    some = np.maximum(words, 1)
    stats = np.stack([
        np.bincount(owner, weights=lengths, minlength=n) / some / 16,
        np.bincount(owner, weights=lengths > 14, minlength=n) / some * 2,
        _sums(_byte_flags(bytes(range(65, 91)))[data], offsets) / letters,
        _sums(_byte_flags(b"0123456789")[data], offsets) / letters * 2,
        _sums(_byte_flags(b".,;:!?")[data], offsets) / letters * 2,
        _sums(_byte_flags(b"#*$%&<>@^~=+_")[data], offsets) / letters * 4,
        _sums(_byte_flags(b"|")[data], offsets) / some,
        1 - np.bincount(doc, minlength=n) / some,
        np.bincount(lo[again], minlength=n) / np.maximum(lines, 1),
        np.log2(words + 1) / 16, np.log2(size + 1) / 20], axis=1)
    bins = np.clip((stats * BINS).astype(np.int64), 0, BINS - 1)
    fixed = (1 << WORD_BITS) + np.arange(len(STATISTICS)) * BINS + bins

    all_doc = np.concatenate([doc, np.repeat(np.arange(n), len(STATISTICS))])
    all_kind = np.concatenate([kind, fixed.reshape(-1)])
    all_value = np.concatenate([value, np.full(n * len(STATISTICS), 0.5)])
    by_doc = np.argsort(all_doc, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(all_doc, minlength=n))))
    return bounds, all_kind[by_doc], all_value[by_doc]


@dataclass
class Machine:
    """bias, a weight of each feature, and `RANK` factors of each feature."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, bounds: np.ndarray, kinds: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Score before the sigmoid of each sparse row; every row has at least one feature."""
        x = values[:, None]
        vx = self.factors[kinds] * x
        linear = np.add.reduceat(self.weights[kinds] * values, bounds[:-1])
        sums, squares = np.add.reduceat(vx, bounds[:-1]), np.add.reduceat(vx * vx, bounds[:-1])
        return self.bias + linear + 0.5 * (sums ** 2 - squares).sum(axis=1)

    def scores(self, bounds: np.ndarray, kinds: np.ndarray, values: np.ndarray) -> np.ndarray:
        if len(bounds) == 1:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margin(bounds, kinds, values), -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 500, batch: int = 128,
        rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Adaptive stochastic gradient descent on the logistic loss; rows are (feature numbers, values)."""
    random = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    machine = Machine(0.0, np.zeros(WIDTH), random.normal(0, 0.01, (WIDTH, RANK)))
    if share in (0.0, 1.0) or not len(labels):
        machine.factors[:] = 0
        machine.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return machine
    machine.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(WIDTH, 1e-2), np.full((WIDTH, RANK), 1e-2), 1e-2
    for _ in range(-(-steps * batch // len(rows))):
        order = random.permutation(len(rows))
        for i in range(0, len(rows), batch):
            some = order[i:i + batch]
            kinds = np.concatenate([rows[j][0] for j in some])
            values = np.concatenate([rows[j][1] for j in some])
            sizes = np.array([len(rows[j][0]) for j in some])
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            error = (machine.scores(bounds, kinds, values) - labels[some]) / len(some)
            each = np.repeat(error, sizes)
            vx = machine.factors[kinds] * values[:, None]
            sums = np.repeat(np.add.reduceat(vx, bounds[:-1]), sizes, axis=0)
            grad_v = (each * values)[:, None] * (sums - vx)
            touched, where = np.unique(kinds, return_inverse=True)
            gw = np.bincount(where, weights=each * values, minlength=len(touched)) + decay * machine.weights[touched]
            gv = np.stack([np.bincount(where, weights=grad_v[:, f], minlength=len(touched)) for f in range(RANK)], axis=1)
            gv += decay * machine.factors[touched]
            gb = float(error.sum())
            seen_w[touched] += gw ** 2
            seen_v[touched] += gv ** 2
            seen_b += gb ** 2
            machine.weights[touched] -= rate * 5 * gw / np.sqrt(seen_w[touched])
            machine.factors[touched] -= rate * gv / np.sqrt(seen_v[touched])
            machine.bias -= rate * gb / np.sqrt(seen_b)
    return machine


def fitting_rows(docs: DataFrame, labels: DataFrame, fit_rows: int, key: str = "doc_id", text: str = "text",
                 label: str = "quality") -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Features and labels of at most `fit_rows` labelled documents; the ids chosen bound the broadcast side."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
              .select(key, F.col(label).cast("double").alias("_label"))
              .orderBy(F.xxhash64(key), key, "_label").limit(fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            bounds, kinds, values = features(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_label"),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(kinds.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.float32)))],
                names=["key", "label", "kinds", "values"])
    kind = dict(docs.dtypes)[key]
    joined = (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
              .join(F.broadcast(chosen.withColumnRenamed(key, "_key")), "_key").select("_key", "_text", "_label"))
    made = joined.mapInArrow(run, f"key {kind}, label double, kinds array<int>, values array<float>")
    found = made.orderBy(F.xxhash64("key"), "key", "label").limit(fit_rows).toArrow()
    rows = [(np.asarray(k), np.asarray(v, np.float64)) for k, v in zip(
        found.column("kinds").to_pylist(), found.column("values").to_pylist())]
    return rows, np.asarray(found.column("label").to_pylist(), np.float64)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **names: str) -> Machine:
    return fit(*fitting_rows(docs, labels, fit_rows, **names))


def score_quality(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """`docs` with `score` and `predicted`; the model's size is fixed by its parameters."""
    model = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.weights.astype(np.float32), machine.factors.astype(np.float32)))
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Machine(*model.value)
        for batch in chunks(batches, text):
            scores = shared.scores(*features(batch.column(text))).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=schema.names)
    return docs.mapInArrow(run, schema)
