"""Jaccard self-join of word n-gram sets by vertical partitioning.

The n-grams have one global order, rare ones first: by the level of a counter of fixed size (counts over all documents), then by
hash. The order is cut into FRAGMENTS of about equal mass, and a set is cut with it.

1. Documents with equal sets are one class from here on, so exact copies cost one row each and never meet each other.
2. Of a set of s grams, the p = s - ceil(threshold * s) + 1 first ones in the order are its prefix. Sets of a link share a gram of both
   prefixes, and of prefixes that are longer by k - 1 they share k grams. So a class takes part only if at least a quarter of p of its longer
   prefix occurs in other longer prefixes; a few chance grams do not do. Classes that are left and share a gram of their prefixes share a bucket.
3. In each bucket, every member is a candidate with the bucket's centre only, the member with the most neighbours. A bitmap with the
   parity of the grams of each slot bounds the difference of two sets from below, without error, and drops most candidates.
4. *Vertical partitioning.* Each remaining pair is counted fragment by fragment: the overlap of the two segments is one row, and the rows are
   summed for the pair. A very long set is never in one row.
5. Buckets that still hold several components can hide links between members that are no centre. Only pairs that can still be new are looked
   at: one side is outside the bucket's largest component, or lacks the gram that comes before the bucket's in the centre's
   prefix (members that both have it meet in that bucket), whichever side is smaller. Blocks of the two sides are compared by bitmap;
   members of surviving pairs are joined to their segments and counted fragment by fragment inside the task. Only links leave it.

No pairs of a group are written. Work is quadratic only for a bucket whose members are all unlinked, in comparisons of bitmaps inside tasks.

Defined results: words and shingles as in `near_dup`; a document without words or text is linked with nothing and has its own id as component;
rows with equal sets are linked; a null id is the component of its group only if no other id is in it; an empty table gives
no rows. Of clashing column names, those of the result win.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from floegrid.llm.near_dup import KEYS, components, keyed, set_ids, shingle_sets
from floegrid.llm.tables import cut, key_bitmap, may_hold, passing_through
from floegrid.llm.text import SPACE, chunks, pair, texts_words, word_table

SLOT_BITS = 22
PARTS = 64
FRAGMENTS = 8
BLOCK = 512
_SHIFT = np.uint64(64 - SLOT_BITS)


class Order(NamedTuple):
    """Level of each slot of gram hashes, and the (level, slot) codes at which fragments begin."""
    levels: np.ndarray
    pivots: np.ndarray

    def level(self, grams: np.ndarray) -> np.ndarray:
        return self.levels[(grams >> _SHIFT).astype(np.int64)]

    def fragment(self, grams: np.ndarray) -> np.ndarray:
        slots = (grams >> _SHIFT).astype(np.int64)
        return np.searchsorted(self.pivots, (self.levels[slots].astype(np.int64) << SLOT_BITS) | slots, "right")


def gram_order(docs: DataFrame, size: int, text: str = "text", fragments: int = FRAGMENTS) -> Order:
    """The global order from counts of all grams of all texts in 2^SLOT_BITS counters.

    A counter above the mean by 8 standard deviations or more belongs to frequent grams; its level grows with the logarithm
    of the excess. The order changes the cost only, never a result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in chunks(batches, "_text"):
            words, owner, _ = texts_words(batch.column("_text"), word_table(SPACE), True)
            grams = words[:max(0, len(words) - size + 1)]
            for i in range(1, size):
                grams = pair(grams, words[i:len(words) - size + 1 + i])
            at = np.arange(len(grams))
            slots, n = np.unique((grams[owner[at] == owner[at + size - 1]] >> _SHIFT).astype(np.uint32), return_counts=True)
            total[slots] += n.astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(PARTS), pa.int32()),
             pa.array([pack.compress(p.astype(np.uint64).tobytes()) for p in np.split(total, PARTS)], pa.binary())], names=["part", "counts"])

    def add(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros((1 << SLOT_BITS) // PARTS, np.uint64), 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(row["counts"]), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())],
            names=["part", "counts"])

    # Parts are added in two rounds, so that no task reads a counter block of every task of the scan.
    each = docs.select(F.col(text).alias("_text")).mapInArrow(count, "part int, counts binary")
    some = each.withColumn("salt", (F.rand(7) * 64).cast("int")).groupBy("part", "salt").applyInArrow(add, "part int, counts binary")
    counts = np.zeros(1 << SLOT_BITS, np.uint64)
    for row in some.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        block = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["counts"]), np.uint64)
        counts[row["part"] * len(block):][:len(block)] = block
    excess = (counts - counts.mean()) / np.sqrt(counts.mean() + 1) / 8
    levels = np.where(excess < 1, 0, 1 + np.log2(np.maximum(excess, 1))).astype(np.uint8)
    order = np.argsort(levels, kind="stable")
    mass = np.cumsum(counts[order])
    cuts = order[np.searchsorted(mass, np.arange(1, fragments) * (mass[-1] / fragments)).clip(max=len(order) - 1)]
    return Order(levels, np.unique((levels[cuts].astype(np.int64) << SLOT_BITS) | cuts))


def prefix_size(n, percent: int):
    """Grams of the prefix of a set of n: all sets that it may link to share one of them."""
    return n - (percent * n + 99) // 100 + 1


def shared_least(n, percent: int):
    """Grams that a set of n shares within the longer prefixes, which have one less more than the prefix."""
    return (prefix_size(n, percent) + 3) // 4


def required(a: int, b: int, percent: int) -> int:
    """Least overlap of sets of a and b grams with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def bit_sizes(sizes: np.ndarray) -> np.ndarray:
    """Bits of each set's bitmap: the power of two of at least its size, 64 or more."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))


def parity_bitmaps(grams: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Bit of each slot: whether an odd number of the set's grams fall on it."""
    bits = bit_sizes(np.diff(bounds))
    starts = np.concatenate(([0], np.cumsum(bits)))
    owner = np.repeat(np.arange(len(bits)), np.diff(bounds))
    spot = starts[owner] + (grams & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    data = np.packbits((np.bincount(spot, minlength=int(starts[-1])) & 1).astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer((starts // 8).astype(np.int32)), pa.py_buffer(data)])


def least_difference(a: bytes, b: bytes) -> int:
    """Lower bound of the size of the symmetric difference; the larger bitmap is folded to the smaller one's size."""
    if len(a) < len(b):
        a, b = b, a
    x, n = int.from_bytes(a, "little"), 8 * len(a)
    while n > 8 * len(b):
        n //= 2
        x = (x >> n) ^ (x & ((1 << n) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def signatures(docs: DataFrame, size: int, percent: int, order: Order) -> DataFrame:
    """Class, size, prefix and bitmap of each row of (_k1, _k2, _k3, _id, _text); the last two once for each set of a chunk."""
    shared = docs.sparkSession.sparkContext.broadcast((order.levels, order.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Order(*shared.value)
        for batch in chunks(batches, "_text"):
            grams, bounds = shingle_sets(batch.column("_text"), size)
            sizes, ids = np.diff(bounds), set_ids(grams, bounds)
            some = np.flatnonzero(sizes)
            lead = np.zeros(len(ids), bool)
            lead[some[np.unique(ids[some], return_index=True)[1]]] = True
            first = np.flatnonzero(lead)
            keep = np.repeat(lead, sizes)
            own, kept = grams[keep], np.concatenate(([0], np.cumsum(sizes[first]))).astype(np.int64)
            owner = np.repeat(np.arange(len(first)), sizes[first])
            ranked = own[np.argsort((owner << 8) | by.level(own), kind="stable")]
            length = np.minimum(sizes[first], prefix_size(sizes[first], percent) - 1 + shared_least(sizes[first], percent))
            prefix = ranked[np.arange(len(ranked)) - kept[owner] < length[owner]]
            at = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(lead)))]
            maps = parity_bitmaps(own, kept).take(pa.array(np.where(lead, np.cumsum(lead) - 1, -1), mask=~lead))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in KEYS], batch.column("_id"), pa.array(ids.view(np.int64)), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(prefix.view(np.int64))), maps],
                names=[*KEYS, "_id", "node", "n_shingles", "prefix", "bits"])
    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(run, f"_k1 long, _k2 long, _k3 long, _id {kind}, node long, n_shingles long, prefix array<long>, bits binary")


def segments(base: DataFrame, wanted: DataFrame, size: int, order: Order) -> DataFrame:
    """node, fragment and the grams of the set in it, for each (node, _k1, _k2, _k3) of `wanted`.

    Rows of `base` (_k1, _k2, _k3, _text) are cut where they lie; a bitmap of the wanted keys leaves out most others, so no texts are shuffled.
    """
    bits = key_bitmap(wanted.select(F.col("_k1").alias("key")))
    shared = base.sparkSession.sparkContext.broadcast((order.levels, order.pivots, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, some = Order(*shared.value[:2]), shared.value[2]
        for whole in batches:
            likely = whole.filter(pa.array(may_hold(some, whole.column("_k1").to_numpy().view(np.uint64))))
            for batch in chunks(iter([likely]), "_text"):
                grams, bounds = shingle_sets(batch.column("_text"), size)
                place = np.repeat(np.arange(batch.num_rows), np.diff(bounds)) * 256 + by.fragment(grams)
                sort = np.argsort(place, kind="stable")
                which, start = np.unique(place[sort], return_index=True)
                offsets = np.append(start, len(sort)).astype(np.int32)
                own = batch.take(pa.array(which // 256))
                yield pa.RecordBatch.from_arrays(
                    [*[own.column(k) for k in KEYS], pa.array((which % 256).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams[sort].view(np.int64)))], names=[*KEYS, "fragment", "grams"])
    found = base.select(*KEYS, "_text").mapInArrow(run, "_k1 long, _k2 long, _k3 long, fragment int, grams array<long>")
    return found.join(wanted, KEYS).groupBy("node", "fragment").agg(F.first("grams").alias("grams"))


def can_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, need) whose sizes and bitmaps allow a link; need: the least overlap."""
    both = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            need = required(na, nb, percent)
            apart = np.fromiter(map(least_difference, batch.column("ba").to_pylist(), batch.column("bb").to_pylist()), np.int64, len(na))
            keep = pa.array(apart <= na + nb - 2 * need)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(need)], names=["a", "b", "need"]).filter(keep)
    return both.mapInArrow(run, "a long, b long, need long")


def counted(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs (a, b, need): overlaps of the fragments, counted apart and summed for each pair."""
    both = (pairs.join(parts.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga")), "a")
            .join(parts.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb")), ["b", "fragment"]))
    return (both.select("a", "b", "need", F.size(F.array_intersect("ga", "gb")).alias("common"))
            .groupBy("a", "b", "need").agg(F.sum("common").alias("common")).where("common >= need").select("a", "b"))


def _close(left: dict, right: dict, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in left and right of pairs that may link across components, with their least difference."""
    for v in np.unique(left["size"]):
        rows = np.flatnonzero(left["size"] == v)
        for w in (v // 2, v, 2 * v):
            cols = np.flatnonzero(right["size"] == w)
            if not len(cols):
                continue
            n = int(min(v, w))
            a, b = _folded(left["bits"], rows, n), _folded(right["bits"], cols, n)
            step = max(1, (4 << 20) // max(1, b.nbytes))
            for i in range(0, len(rows), step):
                x, y = rows[i:i + step], cols
                apart = np.bitwise_count(a[i:i + step, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int64)
                total = left["n"][x][:, None] + right["n"][y][None, :]
                most = total - 2 * required(left["n"][x][:, None], right["n"][y][None, :], percent)
                p, q = np.nonzero((apart <= most) & (left["label"][x][:, None] != right["label"][y][None, :]))
                yield x[p], y[q], apart[p, q]


def _folded(bits: list[bytes], rows: np.ndarray, n: int) -> np.ndarray:
    out = np.frombuffer(b"".join(bits[r] for r in rows), np.uint64).reshape(len(rows), -1)
    while out.shape[1] * 64 > n:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return out


def _sides(table: pa.Table) -> tuple[dict, dict]:
    out = []
    for side in (True, False):
        part = table.filter(pa.compute.equal(table.column("is_left"), side))
        bits = part.column("bits").to_pylist()
        out.append({"node": part.column("node").to_numpy(), "n": part.column("n").to_numpy(), "label": part.column("label").to_numpy(),
                    "bits": bits, "size": np.array([8 * len(b) for b in bits], np.int64),
                    "sets": part.column("sets").to_pylist() if "sets" in part.column_names else None})
    return out[0], out[1]


def hidden_links(crowded: DataFrame, centres: DataFrame, nodes: DataFrame, labels: DataFrame, parts_of, percent: int) -> DataFrame:
    """Links (a, b) between members of different components of a bucket.

    crowded: (gram, node); centres: (gram, parent); parts_of: the segments of a table of nodes.
    """
    labelled = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    count = cut(labelled.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("_n")))
    mixed = cut(count.groupBy("gram").agg(F.max(F.struct("_n", "label")).alias("_top"), F.count(F.lit(1)).alias("_labels"))
                .where("_labels > 1").select("gram", F.col("_top.label").alias("_top")))
    before = crowded.select(F.col("gram").alias("parent"), "node", F.lit(True).alias("_has"))
    members = cut(labelled.join(mixed, "gram").join(centres.select("gram", "parent"), "gram").join(before, ["parent", "node"], "left")
                  .select("gram", "node", "label", (F.col("label") != F.col("_top")).alias("stray"), F.col("_has").isNull().alias("orphan")))
    shape = cut(members.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"), F.count_if("stray").alias("_s"), F.count_if("orphan").alias("_o"))
                .where("_o > 0").select("gram", (F.col("_s") <= F.col("_o")).alias("by_stray"),
                                        F.ceil(F.col("_n") / BLOCK).cast("int").alias("rights"),
                                        F.ceil(F.least("_s", "_o") / BLOCK).cast("int").alias("lefts")))
    # The hash is salted: rows of one shuffle partition must not share a block.
    dealt = (members.join(shape, "gram").withColumn("_h", F.xxhash64("node", F.lit(5)))
             .withColumn("_l", F.when(F.col("by_stray"), F.col("stray")).otherwise(F.col("orphan"))))
    rights = dealt.select("gram", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"),
                          F.pmod("_h", "rights").cast("int").alias("j"), F.lit(False).alias("is_left"), "node", "label")
    lefts = dealt.where("_l").select("gram", F.pmod("_h", "lefts").cast("int").alias("i"),
                                     F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"),
                                     F.lit(True).alias("is_left"), "node", "label")
    rows = rights.unionByName(lefts).join(nodes.select("node", "n", "bits"), "node")

    def near(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        left, right = _sides(table)
        seen = np.zeros(len(left["node"]), bool), np.zeros(len(right["node"]), bool)
        for x, y, _ in _close(left, right, percent):
            seen[0][x] = seen[1][y] = True
        gram, i, j = (k.as_py() for k in key)
        for side, flags, is_left in ((left, seen[0], True), (right, seen[1], False)):
            at = np.flatnonzero(flags)
            if len(at):
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * n, pa.int64()), pa.array([i] * n, pa.int32()), pa.array([j] * n, pa.int32()),
                     pa.array([is_left] * n), pa.array(side["node"][at]), pa.array(side["label"][at]), pa.array(side["n"][at]),
                     pa.array([side["bits"][k] for k in at], pa.binary())],
                    names=["gram", "i", "j", "is_left", "node", "label", "n", "bits"])
    open_ = cut(rows.groupBy("gram", "i", "j").applyInArrow(
        near, "gram long, i int, j int, is_left boolean, node long, label long, n long, bits binary"))
    sets = (parts_of(open_.select("node").distinct()).groupBy("node")
            .agg(F.collect_list(F.struct("fragment", "grams")).alias("sets")))

    def confirm(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = _sides(pa.Table.from_batches(list(batches)))
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x
        cutsets: dict[tuple[int, int], dict[int, np.ndarray]] = {}

        def fragments(side: dict, which: int, at: int) -> dict[int, np.ndarray]:
            if (which, at) not in cutsets:
                cutsets[which, at] = {s["fragment"]: np.array(s["grams"], np.int64) for s in side["sets"][at]}
            return cutsets[which, at]
        out = []
        for x, y, apart in _close(left, right, percent):
            for k in np.argsort(apart, kind="stable"):
                a, b = x[k], y[k]
                ra, rb = find(int(left["label"][a])), find(int(right["label"][b]))
                if ra == rb:
                    continue
                one, two = fragments(left, 0, a), fragments(right, 1, b)
                need = required(int(left["n"][a]), int(right["n"][b]), percent)
                open_count = sum(min(len(g), len(two[f])) for f, g in one.items() if f in two)
                common = 0
                for f, g in one.items():
                    if open_count + common < need:
                        break
                    if f in two:
                        open_count -= min(len(g), len(two[f]))
                        common += len(np.intersect1d(g, two[f], assume_unique=True))
                if common >= need:
                    joined[ra] = rb
                    u, v = int(left["node"][a]), int(right["node"][b])
                    out.append((min(u, v), max(u, v)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())],
                                             names=["a", "b"])
    return open_.join(sets, "node").groupBy("gram", "i", "j").applyInArrow(confirm, "a long, b long").distinct()


def join_classes(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text",
                 fragments: int = FRAGMENTS) -> tuple[DataFrame, DataFrame]:
    """Rows (_k1, _k2, _k3, _id, node, n_shingles) and (node, label) of the classes that have links; label: the component."""
    base = keyed(docs, key, text).select(*KEYS, F.col(key).alias("_id"), F.col(text).alias("_text"))
    order = gram_order(docs, size, text, fragments)
    rows = cut(signatures(base, size, percent, order))
    nodes = cut(rows.where(F.size("prefix") > 0).groupBy("node").agg(F.first(F.struct("n_shingles", "prefix", "bits")).alias("s"))
                .select("node", F.col("s.n_shingles").alias("n"), "s.prefix", "s.bits"))
    each = nodes.select("node", F.explode("prefix").alias("gram"))
    # Tables that are joined to a crowded key are written first: then both sides are shuffled and the runtime can split it.
    common = cut(each.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram"))
    shared = each.join(common, "gram").groupBy("node").agg(F.count(F.lit(1)).alias("m"))
    # The least that the smallest set in reach shares.
    smallest = f"({percent} * n + 99) div 100"
    least = F.expr(f"({smallest} - ({percent} * ({smallest}) + 99) div 100 + 4) div 4")
    likely = cut(nodes.join(shared, "node").where(F.col("m") >= least).drop("m"))
    first = F.expr(f"slice(prefix, 1, int(n - ({percent} * n + 99) div 100 + 1))")
    each = likely.select("node", "n", F.posexplode(first).alias("place", "gram"))
    full = cut(each.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    earlier = Window.partitionBy("node").orderBy("place")
    crowded = cut(each.join(full, "gram").withColumn("before", F.lag("gram").over(earlier))
                  .withColumn("neighbours", F.sum("m").over(Window.partitionBy("node"))).drop("m", "place"))
    nodes = likely.drop("prefix")
    centres = cut(crowded.groupBy("gram").agg(F.max(F.struct("neighbours", "node", "n", "before")).alias("c"))
                  .select("gram", F.col("c.node").alias("c"), F.col("c.n").alias("nc"), F.col("c.before").alias("parent")))
    pairs = (crowded.join(centres, "gram").where(f"node <> c AND 100 * n >= {percent} * nc AND 100 * nc >= {percent} * n")
             .select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct())
    found = cut(can_link(pairs, nodes, percent))
    where = rows.where(F.size("prefix") > 0).groupBy("node").agg(F.min(F.struct(*KEYS)).alias("k")).select("node", "k.*")

    def parts_of(some: DataFrame) -> DataFrame:
        """Segments of the given nodes, from the text of one row of each; which one does not matter, as their sets are equal."""
        return cut(segments(base, cut(where.join(some, "node")), size, order))
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = cut(counted(found, parts_of(ends)))
    labels = components(links)
    hidden = cut(hidden_links(crowded.select("gram", "node"), centres, nodes, labels, parts_of, percent))
    if hidden.limit(1).count():
        labels = components(cut(links.unionByName(hidden)))
    return rows.select(*KEYS, "_id", "node", "n_shingles"), labels


def assign(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text",
           fragments: int = FRAGMENTS) -> DataFrame:
    """One row for each row of `docs`: _k1, _k2, _k3, _id, n_shingles, group (null without words), component_id."""
    rows, labels = join_classes(docs, size, percent, key, text, fragments)
    named = (rows.join(labels, "node", "left")
             .withColumn("group", F.when(F.col("node") != 0, F.coalesce("label", "node"))).drop("node", "label"))
    least = cut(named.where("group IS NOT NULL").groupBy("group").agg(F.min("_id").alias("component_id")))
    return (named.join(least, "group", "left")
            .withColumn("component_id", F.when(F.col("group").isNull(), F.col("_id")).otherwise(F.col("component_id"))))


@passing_through(*KEYS)
def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with n_shingles, group (null without words) and component_id (least id that can be reached by links)."""
    base = keyed(docs.drop("n_shingles", "group", "component_id"), key, text)
    found = assign(docs, size, percent, key, text).drop("_id").distinct()
    return base.join(found, KEYS).drop(*KEYS)
