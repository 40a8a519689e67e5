"""Benchmark text in documents, found by winnowing.

Texts are sequences of lower-case words. Of each WINNOW consecutive grams of GRAM words the one with the least hash is kept as a
fingerprint, so any shared span of GRAM + WINNOW - 1 = 13 words shares one. Document and benchmark fingerprints are
joined and every hit is extended to both sides as far as the words agree; a span of 13 words or more is contamination.
An item of fewer words is looked for as a whole: its only gram has all its words.

A filter of fixed size over the benchmark's fingerprints reaches the tasks that read documents, so only grams that
may hit are shuffled, each with the few words around it. The join itself is exact and by shuffle; hot fingerprints are split by the
runtime. Documents with equal texts share one set of hits.

Words are compared by 64-bit hashes. Defined results: a null text or item has no words; an item without words is never found;
a text without words has no hits; repeated rows get equal results; items with a null id count as items but add no id
to the list. Other columns are passed through, `n_words`, `n_hit`, `n_items`, `item_ids`, `hit_spans` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from floegrid.llm.tables import cut, passing_through, text_key
from floegrid.llm.text import MIX_A, chunks, mix, packed, texts_words, word_table

SPAN = 13
GRAM = 5
WINNOW = SPAN - GRAM + 1
REACH = SPAN - GRAM
FILTER_BITS = 22


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each word on, over the whole sequence."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * MIX_A + words[i:i + n])
    return h


def winnowed(words: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of all texts; a text of fewer than SPAN words has none."""
    grams = gram_hashes(words, GRAM)
    if len(grams) < WINNOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(grams, WINNOW)
    at = np.arange(len(view))
    valid = owner[at] == owner[at + SPAN - 1]
    places = np.unique((at + view.argmin(axis=1))[valid])
    return places, grams[places]


def short_grams(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    grams = gram_hashes(words, size)
    at = np.arange(len(grams))
    places = at[owner[at] == owner[at + size - 1]]
    return places, grams[places]


ITEM_SCHEMA = "item_id string, item long, size int, print long, at int, words array<long>"


def item_prints(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Fingerprints of the items with the REACH words to both sides; size: words of a short item, or SPAN."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            words, owner, bounds = texts_words(batch.column("_text"), word_table(), True)
            ids = batch.column("_id").to_pylist()
            places, prints = winnowed(words, owner, bounds)
            sizes = np.diff(bounds)
            rows = [(owner[p], SPAN, h, p) for p, h in zip(places, prints)]
            for i in np.flatnonzero((sizes > 0) & (sizes < SPAN)):
                own = words[bounds[i]:bounds[i + 1]]
                rows.append((i, int(sizes[i]), gram_hashes(own, int(sizes[i]))[0], bounds[i]))
            out = []
            for i, size, h, p in rows:
                low = max(bounds[i], p - REACH) if size == SPAN else bounds[i]
                high = min(bounds[i + 1], p + GRAM + REACH) if size == SPAN else bounds[i + 1]
                out.append((ids[i], int(mix(words[bounds[i]:bounds[i + 1]]).sum().view(np.int64)), size, int(h.view(np.int64)),
                            int(p - low), words[low:high].view(np.int64)))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], k) for j, k in enumerate(kinds)],
                                             names=["item_id", "item", "size", "print", "at", "words"])
    return items.select(F.col(key).cast("string").alias("_id"), F.col(text).alias("_text")).mapInArrow(run, ITEM_SCHEMA)


def filter_words(prints: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit map of fixed size with the fingerprints' leading bits, and the sizes of short items (at most SPAN - 1)."""
    shift = 64 - FILTER_BITS
    bits = (prints.select(F.shiftrightunsigned("print", shift).alias("b"))
            .groupBy(F.floor(F.col("b") / 32).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, int(b % 32))")).alias("m"))).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[bits.column("w").to_numpy()] = bits.column("m").to_numpy().astype(np.uint32)
    sizes = [r[0] for r in prints.where(F.col("size") < SPAN).select("size").distinct().collect()]
    return out, sorted(sizes)


def may_hit(prints: np.ndarray, bits: np.ndarray) -> np.ndarray:
    b = prints >> np.uint64(64 - FILTER_BITS)
    return (bits[(b >> np.uint64(5)).astype(np.int64)] >> (b & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def document_hits(docs: DataFrame, bits: np.ndarray, sizes: list[int], text: str) -> DataFrame:
    """k1, k2, n_words and the grams that may hit, each with its place and the words around it, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, sizes))
    kind = pa.list_(pa.struct([("size", pa.int32()), ("print", pa.int64()), ("place", pa.int32()), ("at", pa.int32()),
                               ("words", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sizes = shared.value
        for batch in chunks(batches, "_text"):
            words, owner, bounds = texts_words(batch.column("_text"), word_table(), True)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for size in [SPAN, *sizes]:
                places, prints = winnowed(words, owner, bounds) if size == SPAN else short_grams(words, owner, size)
                hit = may_hit(prints, bits)
                for p, h in zip(places[hit].tolist(), prints[hit].view(np.int64).tolist()):
                    i = owner[p]
                    low = max(bounds[i], p - REACH) if size == SPAN else p
                    high = min(bounds[i + 1], p + GRAM + REACH) if size == SPAN else p + size
                    found[i].append({"size": size, "print": h, "place": int(p - bounds[i]), "at": int(p - low),
                                     "words": words[low:high].view(np.int64)})
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k1"), batch.column("_k2"), pa.array(np.diff(bounds)), pa.array(found, kind)],
                names=["_k1", "_k2", "n_words", "grams"])
    keys = dict(zip(("_k1", "_k2"), text_key(F.col("_text"))))
    return docs.select(F.col(text).alias("_text")).withColumns(keys).mapInArrow(
        run, "_k1 long, _k2 long, n_words long, "
             "grams array<struct<size:int,print:long,place:int,at:int,words:array<long>>>")


def extended(pairs: DataFrame) -> DataFrame:
    """Hit words (first, last) of a document for pairs of equal fingerprints, in SQL functions.

    dw and iw are the words around the gram, da and ia its place in them; agreement is counted outwards from the gram.
    """
    def agree(step: int) -> F.Column:
        if step < 0:
            left, right, room = "reverse(slice(dw, 1, da))", "reverse(slice(iw, 1, ia))", "least(da, ia)"
        else:
            left, right = f"slice(dw, da + {GRAM} + 1, {REACH})", f"slice(iw, ia + {GRAM} + 1, {REACH})"
            room = f"least(size({left}), size({right}))"
        return F.expr(f"aggregate(zip_with(slice({left}, 1, {room}), slice({right}, 1, {room}), (a, b) -> a = b), "
                      "struct(0 AS n, true AS go), (s, e) -> struct(s.n + int(s.go AND e) AS n, s.go AND e AS go), s -> s.n)")
    same_gram = F.expr(f"slice(dw, da + 1, {GRAM}) = slice(iw, ia + 1, {GRAM})")
    long = (pairs.where(F.col("size") == SPAN).where(same_gram)
            .withColumns({"_l": agree(-1), "_r": agree(1)})
            .where(F.col("_l") + F.col("_r") + GRAM >= SPAN)
            .withColumns({"first": F.col("place") - F.col("_l"), "last": F.col("place") + GRAM - 1 + F.col("_r")}))
    short = (pairs.where((F.col("size") < SPAN) & (F.col("dw") == F.col("iw")))
             .withColumns({"first": F.col("place"), "last": F.col("place") + F.col("size") - 1}))
    names = ["_k1", "_k2", "item_id", "item", "first", "last"]
    return long.select(*names).unionByName(short.select(*names))


@passing_through("_k1", "_k2")
def find_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """`docs` with n_words, n_hit, n_items, item_ids (sorted) and hit_spans (first and last word of maximal hits)."""
    made = ["n_words", "n_hit", "n_items", "item_ids", "hit_spans"]
    prints = cut(item_prints(items, item_key, item_text))
    grams = cut(document_hits(docs, *filter_words(prints), text))
    each = (grams.where(F.size("grams") > 0).select("_k1", "_k2", F.explode("grams").alias("g"))
            .select("_k1", "_k2", "g.*").withColumnsRenamed({"words": "dw", "at": "da"})
            .dropDuplicates(["_k1", "_k2", "size", "print", "place"]))
    pairs = each.join(prints.withColumnsRenamed({"words": "iw", "at": "ia"}), ["size", "print"])
    found = extended(pairs).groupBy("_k1", "_k2").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"), F.countDistinct(F.struct("item", "item_id")).alias("n_items"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    # Sorted spans folded into maximal ones; a span that touches the one before extends it.
    merged = F.expr("""aggregate(array_sort(spans), cast(array() AS array<struct<first:int,last:int>>), (acc, s) ->
        if(size(acc) > 0 AND s.first <= element_at(acc, -1).last + 1,
           concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).first AS first,
                  greatest(element_at(acc, -1).last, s.last) AS last))),
           concat(acc, array(s))))""")
    hits = (found.withColumn("hit_spans", merged).drop("spans")
            .withColumn("n_hit", F.expr("aggregate(hit_spans, 0L, (n, s) -> n + s.last - s.first + 1)")))
    counted = grams.select("_k1", "_k2", "n_words").dropDuplicates(["_k1", "_k2"])
    # Written, so that the join with the documents shuffles both sides and the runtime can split a text of very many copies.
    results = cut(counted.join(hits, ["_k1", "_k2"], "left")
               .select("_k1", "_k2", F.col("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                       F.coalesce("item_ids", F.expr("cast(array() AS array<string>)")).alias("item_ids"), "hit_spans"))
    keyed = docs.drop(*made).withColumns(dict(zip(("_k1", "_k2"), text_key(F.col(text)))))
    return keyed.join(results, ["_k1", "_k2"]).drop("_k1", "_k2")


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
