"""Hard negatives by inner product, from cover trees over norm-augmented vectors.

A vector x of norm |x| gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and a query gets 0. Then
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so a ball of augmented vectors bounds inner products from both sides.

1. *Cells.* PIVOTS vectors far from each other, chosen from the SAMPLE rows with the least hash of their key, are the top of the tree. Every
   row goes to its nearest pivot. A cell with more than SHARD_ROWS rows is dealt to several shards.
2. *Cover trees.* A task builds the tree of a shard: a node's children are centres that lie more than half of its covering radius
   apart and reach all its rows within that half. Every node knows the largest distance of its own rows and the label that they share, if any.
3. *Search.* A query has windows of scores. The sample gives each window a first threshold. Cells, then nodes, whose bounds lie outside all
   windows are skipped, as are nodes of one label that does not count. Nodes are opened best first by their upper bound; the rows of
   leaves are scored exactly. Every shard returns its best rows, and the best of these are kept.
4. Positives are one open window over rows of the anchor's label; each positive's score is the window of its negatives.

Each row is in one shard; anchors meet a shard in blocks of BLOCK. The sample only places rows and starts thresholds: every row is
indexed and results are exact.

Defined results: rows with a null label, a null or empty vector, any null or non-finite component, or another length than most rows take no part, nor do rows
with a scaled component of 2^22 or more, for which scores would not be exact. A row with a null key is no anchor and comes last among equal scores.
Repeated rows are rows of their own. A positive without a negative in its window gives no row; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from floegrid.llm.tables import cut

PIVOTS = 16
SAMPLE = 4096
SHARD_ROWS = 8192
BLOCK = 4096
LEAF = 24
OPENED = 32
LARGEST = 1 << 22
NO_KEY = np.iinfo(np.int64).max
NO_LABEL = np.iinfo(np.int64).min


class Tree(NamedTuple):
    """Rows in the order of the tree and, for each node, its row range, centre row, radius, common label, and children (none: a leaf)."""
    vectors: np.ndarray
    rid: np.ndarray
    key: np.ndarray
    label: np.ndarray
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    common: np.ndarray
    child: np.ndarray
    children: np.ndarray


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest - (vectors * vectors).sum(axis=1), 0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def build(vectors: np.ndarray, rid: np.ndarray, key: np.ndarray, label: np.ndarray, largest: float) -> Tree:
    points = augmented(vectors, largest)
    order, nodes = [], []

    def split(rows: np.ndarray, apart: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Groups of rows around centres more than half the radius apart; each group's first row is its centre."""
        reach, out = apart.max() / 2, []
        near = apart <= reach
        out.append((rows[near], apart[near]))
        left = rows[~near]
        while len(left):
            d = distances(points[left], points[left[0]])
            near = d <= reach
            out.append((left[near], d[near]))
            left = left[~near]
        return out
    start = distances(points, points[0])
    # Nodes in the order of their levels; the row range of a node is that of its children.
    level = [(np.arange(len(points)), start)]
    flat: list[dict] = []
    parents: list[list[int]] = []
    while level:
        below = []
        for rows, apart in level:
            node = {"rows": rows, "radius": float(apart.max()), "kids": []}
            flat.append(node)
            if len(rows) > LEAF and node["radius"] > 0:
                below += [(node, *part) for part in split(rows, apart)]
        level = []
        for node, rows, apart in below:
            node["kids"].append(len(flat) + len(level))
            level.append((rows, apart))
    low, high = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    stack = [0]
    while stack:
        i = stack.pop()
        kids = flat[i]["kids"]
        if kids:
            stack += reversed(kids)
        else:
            low[i] = len(order)
            order += flat[i]["rows"].tolist()
            high[i] = len(order)
    for i in range(len(flat) - 1, -1, -1):
        kids = flat[i]["kids"]
        if kids:
            low[i], high[i] = low[kids].min(), high[kids].max()
    order = np.array(order, np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sorted_label = label[order]
    common = np.array([sorted_label[a] if (sorted_label[a:b] == sorted_label[a]).all() else NO_LABEL for a, b in zip(low, high)], np.int64)
    counts = np.array([len(n["kids"]) for n in flat])
    return Tree(vectors[order], rid[order], key[order], sorted_label, low, high, place[[n["rows"][0] for n in flat]],
                np.array([n["radius"] for n in flat]), common, np.concatenate(([0], np.cumsum(counts))),
                np.array([k for n in flat for k in n["kids"]], np.int64))


def bounds(score: np.ndarray, radius: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product in balls whose centres have these inner products; total: |q|^2 + M^2."""
    away = np.sqrt(np.maximum(total - 2 * score, 0))
    slack = 1e-3 + 1e-9 * total
    return (total - (away + radius) ** 2) / 2 - slack, (total - np.maximum(away - radius, 0) ** 2) / 2 + slack


def descend(tree: Tree, query: np.ndarray, label: int, rid: int, largest: float, same: bool, lows: np.ndarray, highs: np.ndarray,
            k: int) -> list[tuple[int, int, int]]:
    """(window, row, score) of the best k rows of each window of scores, by score and key."""
    total = float(query @ query) + largest
    floors = lows.copy()
    found_rows: list[np.ndarray] = []
    found_scores: list[np.ndarray] = []
    held: list[np.ndarray] = [np.zeros(0)] * len(lows)
    nodes = np.zeros(1, np.int64)
    least, most = bounds(tree.vectors[tree.centre[:1]] @ query, tree.radius[:1], total)
    while len(nodes):
        useful = ((most[:, None] >= floors) & (least[:, None] <= highs)).any(axis=1)
        useful &= (tree.common[nodes] == NO_LABEL) | ((tree.common[nodes] == label) == same)
        nodes, least, most = nodes[useful], least[useful], most[useful]
        if len(nodes) > OPENED:
            best = np.argpartition(-most, OPENED)[:OPENED]
            rest = np.ones(len(nodes), bool)
            rest[best] = False
        else:
            best, rest = np.arange(len(nodes)), np.zeros(len(nodes), bool)
        opened = nodes[best]
        nodes, least, most = nodes[rest], least[rest], most[rest]
        leaves = tree.child[opened] == tree.child[opened + 1]
        if leaves.any():
            at = np.concatenate([np.arange(tree.low[i], tree.high[i]) for i in opened[leaves]])
            at = at[((tree.label[at] == label) == same) & (tree.rid[at] != rid)]
            score = tree.vectors[at] @ query
            inside = ((score[:, None] >= floors) & (score[:, None] <= highs)).any(axis=1)
            found_rows.append(at[inside])
            found_scores.append(score[inside])
            for j in range(len(lows)):
                fit = score[(score >= floors[j]) & (score <= highs[j])]
                if len(fit):
                    held[j] = -np.sort(-np.concatenate((held[j], fit)))[:k]
                    if len(held[j]) == k:
                        floors[j] = max(floors[j], held[j][-1])
        inner = opened[~leaves]
        if len(inner):
            kids = np.concatenate([tree.children[tree.child[i]:tree.child[i + 1]] for i in inner])
            a, b = bounds(tree.vectors[tree.centre[kids]] @ query, tree.radius[kids], total)
            nodes, least, most = np.concatenate((nodes, kids)), np.concatenate((least, a)), np.concatenate((most, b))
    out = []
    if found_rows:
        rows, scores = np.concatenate(found_rows), np.concatenate(found_scores)
        for j in range(len(lows)):
            fit = np.flatnonzero((scores >= floors[j]) & (scores <= highs[j]))
            fit = fit[np.lexsort((tree.rid[rows[fit]], tree.key[rows[fit]], -scores[fit]))][:k]
            out += [(j, int(rows[f]), int(scores[f])) for f in fit]
    return out


class Index(NamedTuple):
    """The bounded top of the index, known to all tasks, and the trees of the shards."""
    pivots: np.ndarray
    radius: np.ndarray
    shards: np.ndarray
    largest: float
    sample: np.ndarray
    sample_rid: np.ndarray
    sample_label: np.ndarray
    trees: DataFrame


def prepared(rows: DataFrame, key: str, vector: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    """_rid, _key, _label, _anchor and _v, the whole-number components, of the rows that take part."""
    parts = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST / scale))
    usable = (rows.withColumn("_l", label).where(F.col("_l").isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & parts)
              .select(F.monotonically_increasing_id().alias("_rid"), F.col(key).cast("long").alias("_key"), F.xxhash64("_l").alias("_label"),
                      F.coalesce(anchor & F.col(key).isNotNull(), F.lit(False)).alias("_anchor"),
                      F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("_v")))
    # Written, so that row numbers stay what they are.
    kept = cut(usable)
    wide = kept.groupBy(F.size("_v").alias("w")).count().agg(F.max(F.struct("count", "w"))["w"]).first()[0]
    return kept.where(F.size("_v") == (wide or 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def index(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> Index | None:
    """Every row of `prepared` in the tree of its shard; None without rows."""
    spark = rows.sparkSession
    square = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    largest = rows.agg(F.max(square)).first()[0]
    if largest is None:
        return None
    some = rows.orderBy(F.xxhash64("_key", "_v"), "_rid").limit(sample).select("_rid", "_label", "_v").toArrow()
    vectors = _matrix(some.column("_v"))
    points = augmented(vectors, largest)
    chosen, apart = [0], distances(points, points[0])
    while len(chosen) < pivots and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, distances(points, points[chosen[-1]]))
    tops = spark.sparkContext.broadcast((points[chosen], largest))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, m = tops.value
        for batch in batches:
            if batch.num_rows:
                x = augmented(_matrix(batch.column("_v")), m)
                gap = np.stack([distances(x, c) for c in centres], axis=1)
                cell = gap.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(gap[np.arange(len(x)), cell]),
                     *[batch.column(c) for c in ("_rid", "_key", "_label", "_v")]], names=["cell", "apart", "_rid", "_key", "_label", "_v"])
    placed = cut(rows.select("_rid", "_key", "_label", "_v").mapInArrow(
        place, "cell int, apart double, _rid long, _key long, _label long, _v array<int>"))
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.max("apart").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    radius = np.array([cells[c]["radius"] if c in cells else -1.0 for c in range(len(chosen))])
    shards = np.array([-(-cells[c]["n"] // shard_rows) if c in cells else 0 for c in range(len(chosen))])
    wide = F.element_at(F.array(*[F.lit(int(max(s, 1))) for s in shards]), F.col("cell") + 1)

    def grow(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        tree = build(_matrix(table.column("_v")), table.column("_rid").to_numpy(), table.column("_key").fill_null(NO_KEY).to_numpy(),
                     table.column("_label").to_numpy(), tops.value[1])
        columns = [tree.vectors.astype(np.int32).reshape(-1), *tree[1:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
             *[pa.array([c.tobytes()], pa.binary()) for c in columns]], names=["cell", "shard", *Tree._fields])
    trees = cut(placed.withColumn("shard", F.pmod(F.xxhash64("_rid", F.lit(3)), wide).cast("int")).groupBy("cell", "shard").applyInArrow(
        grow, "cell int, shard int, " + ", ".join(f"{c} binary" for c in Tree._fields)))
    return Index(points[chosen], radius, shards, largest, vectors, some.column("_rid").to_numpy(), some.column("_label").to_numpy(), trees)


def _tree(row: dict) -> Tree:
    types = (np.int32, np.int64, np.int64, np.int64, np.int64, np.int64, np.int64, np.float64, np.int64, np.int64, np.int64)
    columns = [np.frombuffer(row[c], t) for c, t in zip(Tree._fields, types)]
    columns[0] = columns[0].astype(np.float64).reshape(len(columns[1]), -1)
    return Tree(*columns)


def search(queries: DataFrame, made: Index, same: bool, k: int) -> DataFrame:
    """rid, spot (place of the window), found_rid, found_key and score: the best k rows for each window of each query.

    queries: _rid, _label, _v and the windows as arrays `lows` and `highs`. same: whether rows of the query's label or all others count.
    """
    spark = queries.sparkSession
    tops = spark.sparkContext.broadcast(tuple(made[:-1]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radius, shards, largest, sample, rids, labels = tops.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q, rid, label = _matrix(batch.column("_v")), batch.column("_rid").to_numpy(), batch.column("_label").to_numpy()
            at, cell, part, lows = [], [], [], []
            for i in range(0, len(q), 512):
                known = q[i:i + 512] @ sample.T
                centre = q[i:i + 512] @ pivots[:, :-1].T
                for j in range(len(known)):
                    low, high = (np.array(batch.column(c)[i + j].as_py(), np.float64) for c in ("lows", "highs"))
                    rows = known[j][((labels == label[i + j]) == same) & (rids != rid[i + j])]
                    for w in range(len(low)):
                        fit = rows[(rows >= low[w]) & (rows <= high[w])]
                        if len(fit) >= k:
                            low[w] = np.partition(fit, len(fit) - k)[-k]
                    least, most = bounds(centre[j], np.maximum(radius, 0), float(q[i + j] @ q[i + j]) + largest)
                    for c in np.flatnonzero(((most[:, None] >= low) & (least[:, None] <= high)).any(axis=1) & (shards > 0)):
                        for s in range(shards[c]):
                            at.append(i + j)
                            cell.append(c)
                            part.append(s)
                            lows.append(low)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(part, pa.int32()), *[taken.column(c) for c in ("_rid", "_label", "_v")],
                 pa.array(lows, pa.list_(pa.float64())), taken.column("highs")], names=["cell", "shard", "_rid", "_label", "_v", "lows", "highs"])
    routed = cut(queries.select("_rid", "_label", "_v", "lows", "highs").mapInArrow(
        route, "cell int, shard int, _rid long, _label long, _v array<int>, lows array<double>, highs array<double>"))
    blocks = cut(routed.groupBy("cell", "shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    asked = routed.join(blocks, ["cell", "shard"]).withColumn("block", F.pmod(F.xxhash64("_rid", F.lit(9)), "blocks").cast("int")).drop("blocks")
    trees = made.trees.join(blocks, ["cell", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            tree, largest = _tree(right.to_pylist()[0]), tops.value[3]
            q, rid, label = _matrix(left.column("_v")), left.column("_rid").to_numpy(), left.column("_label").to_numpy()
            lows, highs = left.column("lows").to_pylist(), left.column("highs").to_pylist()
            for i in range(len(q)):
                out += [(rid[i], j, tree.rid[row], tree.key[row], score) for j, row, score in descend(
                    tree, q[i], label[i], rid[i], largest, same, np.array(lows[i], np.float64), np.array(highs[i], np.float64), k)]
        cols = list(zip(*out)) or [[]] * 5
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("rid", "spot", "found_rid", "found_key", "score"), cols,
                                                             (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))})
    each = asked.groupBy("cell", "shard", "block").cogroup(trees.groupBy("cell", "shard", "block")).applyInArrow(
        answer, "rid long, spot int, found_rid long, found_key long, score long")
    best = Window.partitionBy("rid", "spot").orderBy(F.desc("score"), F.asc("found_key"), F.asc("found_rid"))
    return (each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .withColumn("found_key", F.when(F.col("found_key") != NO_KEY, F.col("found_key"))))


def mine(rows: DataFrame, anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 256, positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, **sizes: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x). `anchor` marks the anchors. For each of an anchor's first `positives` other rows of its label:
    the first `negatives` rows of other labels with a score of `low` to `high` per cent of the positive's. `sizes` go to `index`.
    """
    base = prepared(rows, key, vector, label, anchor, scale)
    made = index(base, **sizes)
    if made is None:
        return base.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    anchors = base.where("_anchor").select("_rid", "_key", "_label", "_v")
    every = F.array(F.lit(float("-inf"))).alias("lows"), F.array(F.lit(float("inf"))).alias("highs")
    close = cut(search(anchors.select("_rid", "_label", "_v", *every), made, True, positives)
                .select(F.col("rid").alias("_rid"), F.col("rank").alias("place"), F.col("found_key").alias("positive_id"),
                        F.col("score").alias("positive_score")))
    # Windows in the order of the positives; a negative score has none, as its lower limit lies above the upper one.
    windows = (close.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
               .select("_rid", F.transform("p", lambda p: F.ceil(p["positive_score"] * low / 100).cast("double")).alias("lows"),
                       F.transform("p", lambda p: F.floor(p["positive_score"] * high / 100).cast("double")).alias("highs")))
    far = search(anchors.join(windows, "_rid"), made, False, negatives).select(
        F.col("rid").alias("_rid"), (F.col("spot") + 1).alias("place"), "rank", F.col("found_key").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return (far.join(close, ["_rid", "place"]).join(anchors.select("_rid", F.col("_key").alias("anchor_id")), "_rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
