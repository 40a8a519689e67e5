"""Near-duplicate documents: banded MinHash candidates, odd-sketch estimates, exact confirmation, components.

1. A document's set is its distinct word shingles. Documents with equal sets are one class from here on, so exact copies cost one
   row each and never meet each other.
2. BANDS x ROWS MinHash values are taken per class. Classes that agree in all rows of a band share a bucket. Each bucket has a centre, the member
   with the most neighbours over all its buckets (the text that the others are copies of, as a rule), and its members are
   candidates with the centre only.
3. The MinHash samples are also folded into an odd sketch: every sample flips one bit of a bitmap. The number of bits in which
   two sketches differ estimates how many samples differ, most precisely for high similarities. A candidate goes on only if the
   estimate is within MARGIN of the threshold, which is more than six standard errors.
4. Remaining candidates are confirmed on the full sets, and confirmed links are joined to components.
5. Buckets that still hold several components can hide links between members that are no centre. They are worked on in blocks: pairs
   of different components whose sketches allow it, most alike first, are confirmed on the full sets inside the task,
   each pair in the first bucket that it shares, until the two components are linked. Only links leave the task.

No pairs of a group are written: a group of n classes makes n candidates in a band. A pair at the threshold shares no band with a
chance of (1 - s^ROWS)^BANDS: 2.5e-7 at s = 0.8.

Defined results: documents without words or text are linked with nothing and kept; rows with equal sets are linked;
a null id counts as the largest: a component of null ids only has a null component_id, and all its rows are kept. Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from floegrid.llm.tables import cut, passing_through, text_key
from floegrid.llm.text import SPACE, chunks, mix, pair, texts_words, word_table

BANDS = 50
ROWS = 6
SKETCH_WORDS = 16
MARGIN = 0.15
KEYS = ["_k1", "_k2", "_k3"]
BLOCK = 1024
_SEEDS = np.random.default_rng(77).integers(1, 1 << 32, (2, BANDS * ROWS), dtype=np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and the n + 1 bounds.

    A text of fewer than `size` words has its whole sequence as its only shingle; without words it has none.
    """
    words, owner, bounds = texts_words(column, word_table(SPACE), True)
    n = len(bounds) - 1
    grams = words[:max(0, len(words) - size + 1)]
    for i in range(1, size):
        grams = pair(grams, words[i:len(words) - size + 1 + i])
    at = np.arange(len(grams))
    valid = owner[at] == owner[at + size - 1]
    doc, gram = owner[at][valid], grams[valid]
    counts = np.diff(bounds)
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        whole = []
        for i in few:
            h = np.uint64(counts[i])
            for w in words[bounds[i]:bounds[i + 1]]:
                h = pair(np.array([h]), np.array([w]))[0]
            whole.append(h)
        doc, gram = np.concatenate((doc, few)), np.concatenate((gram, np.array(whole, np.uint64)))
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])))[:len(doc)]
    doc, gram = doc[fresh], gram[fresh]
    return gram, np.searchsorted(doc, np.arange(n + 1))


def set_ids(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole set; 0 for an empty one."""
    sizes = np.diff(bounds)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5DEECE66D)), dtype=np.uint64)))
    out = mix((total[bounds[1:]] - total[bounds[:-1]]) ^ mix(sizes.astype(np.uint64)))
    out[out == 0] = 1
    out[sizes == 0] = 0
    return out


def minhashes(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """BANDS * ROWS MinHash values of each set; every set has at least one shingle."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.empty((BANDS * ROWS, len(bounds) - 1), np.uint32)
    for j in range(BANDS * ROWS):
        h = low * _SEEDS[0, j] + _SEEDS[1, j]
        h ^= h >> np.uint32(15)
        out[j] = np.minimum.reduceat(h, bounds[:-1])
    return out.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set and band."""
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(values), BANDS))
    for r in range(ROWS):
        h = pair(h, values[:, r::ROWS].astype(np.uint64))
    return h


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Bitmaps of 64 * SKETCH_WORDS bits in which each sample of a set has flipped one bit."""
    spot = mix(values.astype(np.uint64) * np.uint64(BANDS * ROWS) + np.arange(BANDS * ROWS, dtype=np.uint64))
    spot = (spot >> np.uint64(64 - 10)).astype(np.int64) % (64 * SKETCH_WORDS)
    parity = np.zeros((len(values), 64 * SKETCH_WORDS), np.uint8)
    np.add.at(parity, (np.arange(len(values))[:, None], spot), 1)
    return np.packbits(parity & 1, axis=1).view(np.uint64)


def sketch_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches, along the last axis."""
    m, k = 64 * SKETCH_WORDS, BANDS * ROWS
    differ = np.bitwise_count(a ^ b).sum(axis=-1).astype(np.float64)
    return 1 + m / (4 * k) * np.log(np.maximum(1 - 2 * differ / m, 1e-9))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Set hash, size, bands and sketch of each row of (_k1, _k2, _k3, _id, _text).

    Bands and sketch are given once for each different set of a chunk and are empty in the other rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            grams, bounds = shingle_sets(batch.column("_text"), size)
            sizes, ids = np.diff(bounds), set_ids(grams, bounds)
            some = np.flatnonzero(sizes)
            # Equal sets of a chunk are signed once.
            one, where = np.unique(ids[some], return_inverse=True)
            first = np.zeros(len(one), np.int64)
            first[where[::-1]] = some[::-1]
            keep = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in first]) if len(first) else np.zeros(0, np.int64)
            sub = np.concatenate(([0], np.cumsum(sizes[first])))
            values = minhashes(grams[keep], sub) if len(first) else np.zeros((0, BANDS * ROWS), np.uint32)
            bands, sketches = band_keys(values), odd_sketches(values)
            lead = np.zeros(len(ids), bool)
            lead[first] = True
            at = np.concatenate(([0], np.cumsum(lead)))
            order = np.argsort(first)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in KEYS], batch.column("_id"), pa.array(ids.view(np.int64)), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array((at * BANDS).astype(np.int32)), pa.array(bands[order].reshape(-1).view(np.int64))),
                 pa.ListArray.from_arrays(pa.array((at * SKETCH_WORDS).astype(np.int32)), pa.array(sketches[order].reshape(-1).view(np.int64)))],
                names=[*KEYS, "_id", "node", "n_shingles", "bands", "sketch"])
    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(run, f"_k1 long, _k2 long, _k3 long, _id {kind}, node long, n_shingles long, bands array<long>, sketch array<long>")


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """node and its whole set of shingle hashes, for rows of (node, _text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            grams, bounds = shingle_sets(batch.column("_text"), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(grams.view(np.int64)))],
                names=["node", "grams"])
    return texts.mapInArrow(run, "node long, grams array<long>")


def likely(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sketches allow the threshold."""
    both = (pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b"))
    differ = F.expr("aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (n, c) -> n + c)")
    return both.where(differ <= most_different(threshold)).select("a", "b")


def most_different(threshold: float) -> int:
    """Differing sketch bits up to which the estimate reaches the threshold less MARGIN."""
    m, k = 64 * SKETCH_WORDS, BANDS * ROWS
    return int(m / 2 * (1 - np.exp(-4 * k * (1 - threshold + MARGIN) / m)))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b"))
    common = F.size(F.array_intersect("ga", "gb"))
    return both.where(100 * common >= percent * (F.size("ga") + F.size("gb") - common)).select("a", "b").distinct()


def components(links: DataFrame, label: str = "label") -> DataFrame:
    """Least node of the component of each linked node: labels spread to neighbours and labels of labels until nothing changes.

    `links`: (a, b). A round moves one row for each link, with labels combined in the tasks first.
    """
    edges = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(edges.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("l")).withColumnRenamed("a", "node"))
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "l"), "b").select(F.col("a").alias("node"), "l"))
        low = labels.unionByName(near).groupBy("node").agg(F.min("l").alias("l"))
        # The label of the label: a chain halves in each round.
        far = low.join(labels.select(F.col("node").alias("l"), F.col("l").alias("ll")), "l", "left")
        new = cut(far.select("node", F.least("l", F.coalesce("ll", "l")).alias("l")))
        changed = new.join(labels.withColumnRenamed("l", "old"), "node").where(F.col("l") != F.col("old")).limit(1).count()
        labels = new
        if not changed:
            return labels.withColumnRenamed("l", label)


def hidden_links(crowded: DataFrame, signed: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between members of different components that share a bucket.

    crowded: (band, node) of buckets with two members or more. A large bucket is cut into blocks of about BLOCK
    members, and each pair of blocks is one task's work.
    """
    labelled = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = cut(labelled.groupBy("band").agg(F.min("label").alias("_x"), F.max("label").alias("_y"), F.count(F.lit(1)).alias("_n"))
                .where((F.col("_x") != F.col("_y")) & (F.col("_n") > 2))
                .select("band", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")))
    rows = (labelled.join(mixed, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .join(signed, "node").join(sets, "node")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "label",
                    "bands", "sketch", "grams"))
    least = most_different(percent / 100)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        node, label, own = (rows.column(c).to_numpy() for c in ("node", "label", "own"))
        sketch = np.stack(rows.column("sketch").to_numpy()).view(np.uint64)
        bands, grams = np.stack(rows.column("bands").to_numpy()), rows.column("grams").to_numpy()
        band, p, q = (k.as_py() for k in key)
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x
        out = []
        for i in range(0, len(left), 32):
            part = left[i:i + 32]
            differ = np.bitwise_count(sketch[part][:, None, :] ^ sketch[right][None, :, :]).sum(axis=2)
            x, y = np.nonzero((differ <= least) & (label[part][:, None] != label[right][None, :]))
            if p == q:
                x, y = x[part[x] < right[y]], y[part[x] < right[y]]
            for k in np.argsort(differ[x, y], kind="stable"):
                a, b = part[x[k]], right[y[k]]
                ra, rb = find(label[a]), find(label[b])
                if ra == rb or bands[a][np.argmax(bands[a] == bands[b])] != band:
                    continue
                common = len(np.intersect1d(grams[a], grams[b], assume_unique=True))
                if 100 * common >= percent * (len(grams[a]) + len(grams[b]) - common):
                    joined[ra] = rb
                    out.append((min(node[a], node[b]), max(node[a], node[b])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())],
                                             names=["a", "b"])
    return rows.groupBy("band", "p", "q").applyInArrow(run, "a long, b long").distinct()


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Two hashes of the text and one of the id, so that rows meet again whatever is null or repeated."""
    return docs.withColumns({**dict(zip(KEYS, text_key(F.col(text)))), "_k3": F.xxhash64(F.col(key))})


def assign(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: _k1, _k2, _k3, _id, n_shingles, group (null without words), component_id, kept."""
    base = keyed(docs, key, text).select(*KEYS, F.col(key).alias("_id"), F.col(text).alias("_text"))
    rows = cut(signatures(base, size))
    signed = cut(rows.where(F.size("bands") > 0).groupBy("node")
                 .agg(F.first(F.struct("bands", "sketch")).alias("s")).select("node", "s.bands", "s.sketch"))
    each = signed.select("node", F.explode("bands").alias("band"))
    # Tables that are joined to a crowded key are written first: then both sides are shuffled and the runtime can split it.
    full = cut(each.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    crowded = cut(each.join(full, "band"))
    rank = cut(crowded.groupBy("node").agg(F.sum("n").alias("neighbours")))
    centres = cut(crowded.join(rank, "node").groupBy("band").agg(F.max(F.struct("neighbours", "node")).alias("c"))
                  .select("band", F.col("c.node").alias("c")))
    found = cut(likely(crowded.join(centres, "band").where("node <> c")
                       .select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct(),
                       signed, percent / 100))
    # Text of one row for each node in a bucket; which one does not matter, as their sets are equal.
    one = (rows.where(F.size("bands") > 0).join(rank, "node").groupBy("node")
           .agg(F.min(F.struct(*KEYS)).alias("k")).select("node", "k.*"))
    texts = base.select(*KEYS, "_text").join(one, KEYS).groupBy("node").agg(F.first("_text").alias("_text"))
    sets = cut(full_sets(texts, size))
    links = cut(confirmed(found, sets, percent))
    labels = components(links)
    hidden = cut(hidden_links(crowded.select("band", "node"), signed, sets, labels, percent))
    if hidden.limit(1).count():
        labels = components(cut(links.unionByName(hidden)))
    named = (rows.drop("bands", "sketch").join(labels, "node", "left")
             .withColumn("group", F.when(F.col("node") != 0, F.coalesce("label", "node"))).drop("node", "label"))
    least = cut(named.groupBy("group").agg(F.min("_id").alias("component_id")))
    return (named.join(least.where(F.col("group").isNotNull()), "group", "left")
            .withColumn("component_id", F.when(F.col("group").isNull(), F.col("_id")).otherwise(F.col("component_id")))
            .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id"))))


@passing_through(*KEYS)
def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with n_shingles, group (null without words), component_id (least id that can be reached) and kept."""
    base = keyed(docs.drop("n_shingles", "group", "component_id", "kept"), key, text)
    found = assign(docs, size, percent, key, text).drop("_id").distinct()
    return base.join(found, KEYS).drop(*KEYS)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group left, the one with the least id, and all rows without words.

    The row is chosen among small rows, so texts are shuffled once. Of repeated rows with one id and text one stays, the least by the
    hash of its columns.
    """
    rows = assign(docs, size, percent, key, text).where("kept")
    chosen = (rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct(*KEYS)).alias("k"))
              .select("k.*", F.lit(True).alias("_single")))
    lone = rows.where(F.col("group").isNull()).select(*KEYS, F.lit(False).alias("_single")).distinct()
    # Map columns have no hash.
    same = Window.partitionBy(*KEYS).orderBy(F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind]))
    return (keyed(docs, key, text).join(chosen.unionByName(lone), KEYS).withColumn("_i", F.row_number().over(same))
            .where(~F.col("_single") | (F.col("_i") == 1)).select(*docs.columns))
