"""Collocations: phrases of two and three words that occur far more often than their parts explain, by direct-address tiling.

1. Words are counted for each language. Frequent words (FLOOR or more) are ranked by language and count; a rank is an id.
2. *Pair tiles.* The table of (first id, second id) is cut into tiles of SIDE x SIDE cells, and a cell's address is its number, so counting
   needs no hashing: a task counts the cells of a tile that it meets often by `numpy.bincount` on a dense block, those of a sparse tile as
   sorted coordinates with counts. Tiles are added up the same way. A tile in which much may fall, by the counts of its rows and columns,
   is cut into strips of cells, so no task adds up a large share of the corpus.
3. *Recursion.* Frequent pairs are ranked like words, and (pair id, word id) is tiled again for phrases of three words. Only triples of
   which both pairs are frequent are counted, as no other one can be.

Ids are given to at most HEAD words and HEAD pairs, so what is broadcast is bounded. All other frequent words and pairs are told by a
bitmap of fixed size, which lets through some that are not frequent, and are counted as sorted coordinates of their hashes. What is counted is the
same; the threshold is applied to full counts.

Defined results: a null text has no words; a null language is `und`; repeated rows count each; ties in the ranking go to the phrase that is
smaller in UTF-8 byte order; an empty table gives no phrases. Words are told apart by 64-bit hashes of language and bytes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from floegrid.llm.tables import cut, key_bitmap, may_hold
from floegrid.llm.text import chunks, lower_table, pair, packed, word_hashes, word_spans, word_table

HEAD = 1 << 20
SIDE = 2048
FLOOR = 10
STRIP_MASS = 1 << 24
FLUSH = 2_000_000
BREAKS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"


class Ranked(NamedTuple):
    """Keys with an id, sorted by key, with their ids, the key of each id, the mass of each SIDE ids, and a bitmap of the other frequent keys."""
    keys: np.ndarray
    ids: np.ndarray
    by_id: np.ndarray
    mass: np.ndarray
    rest: np.ndarray
    rest_mass: int

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The id of each key or -1, and whether the key may be frequent."""
        if len(self.keys):
            at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
            ids = np.where(self.keys[at] == keys, self.ids[at], -1)
        else:
            ids = np.full(len(keys), -1, np.int64)
        likely = ids >= 0
        if self.rest_mass:
            likely |= may_hold(self.rest, keys)
        return ids, likely


def language_hash(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big"))


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and keys of all words of (_text, _lang), and whether each word and the next are neighbours of one piece."""
    data, offsets = packed(batch.column("_text"))
    data = lower_table()[data]
    starts, ends = word_spans(data, offsets, word_table(b" \t" + BREAKS)[data])
    owner = np.searchsorted(offsets, starts, "right") - 1
    names = batch.column("_lang").dictionary_encode()
    by_name = np.array([language_hash(n) for n in names.dictionary.to_pylist()] or [0], np.uint64)
    keys = pair(by_name[names.indices.to_numpy()][owner], word_hashes(data, starts, ends)) if len(starts) else np.zeros(0, np.uint64)
    broken = np.cumsum(~word_table(BREAKS)[data])[starts] if len(starts) else starts
    return data, starts, ends, keys, (owner[1:] == owner[:-1]) & (broken[1:] == broken[:-1])


def word_counts(docs: DataFrame) -> DataFrame:
    """key, lang, word and n of every word of every language; docs has _text and _lang."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in chunks(batches, "_text"):
            data, starts, ends, keys, _ = words_of(batch)
            if not len(keys):
                continue
            one, first, n = np.unique(keys, return_index=True, return_counts=True)
            order = np.argsort(first)
            at = first[order]
            # Words and the bytes between them in turn, so that offsets ascend; then every second is taken.
            edges = np.empty(2 * len(at), np.int64)
            edges[::2], edges[1::2] = starts[at], ends[at]
            both = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
            words = both.take(pa.array(np.arange(0, len(edges), 2))).cast(pa.binary())
            row = np.searchsorted(packed(batch.column("_text"))[1], starts[at], "right") - 1
            held.append((one[order], n[order], words, batch.column("_lang").take(pa.array(row))))
            size += len(one)
            if size > 500_000:
                yield _summed(held)
                held, size = [], 0
        if held:
            yield _summed(held)
    rows = docs.mapInArrow(run, "key long, n long, word binary, lang string")
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.first(F.struct("word", "lang")).alias("s")).select(
        "key", F.col("s.lang").alias("lang"), F.col("s.word").cast("string").alias("word"), "n")


def _summed(held: list[tuple]) -> pa.RecordBatch:
    keys, n = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
    one, first, which = np.unique(keys, return_index=True, return_inverse=True)
    at = pa.array(first)
    return pa.RecordBatch.from_arrays(
        [pa.array(one.view(np.int64)), pa.array(np.bincount(which, weights=n).astype(np.int64)),
         pa.concat_arrays([h[2] for h in held]).take(at), pa.concat_arrays([h[3] for h in held]).take(at)],
        names=["key", "n", "word", "lang"])


def ranked(counts: DataFrame, head: int, side: int) -> Ranked:
    """Ids by group and descending count for the most frequent keys of (key, grp, n), `head` at most."""
    step = F.floor(16 * F.log2("n")).cast("int")
    sizes = sorted(((r["step"], r["rows"], r["mass"]) for r in counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("mass")).collect()), reverse=True)
    least, total = 1 << 20, 0
    for s, rows, _ in sizes:
        total += rows
        if total > head:
            break
        least = s
    rest_mass = sum(m for s, _, m in sizes if s < least)
    table = counts.where(step >= least).select("key", "grp", "n").toArrow()
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    group = table.column("grp").combine_chunks().dictionary_encode().indices.to_numpy() if len(n) else np.zeros(0, np.int64)
    order = np.lexsort((keys, -n, group))
    by_id = keys[order]
    sort = np.argsort(by_id, kind="stable")
    mass = np.add.reduceat(n[order], np.arange(0, len(n), side)) if len(n) else np.zeros(0, np.int64)
    rest = key_bitmap(counts.where(step < least)) if rest_mass else np.zeros(1, np.uint8)
    return Ranked(by_id[sort], sort.astype(np.int64), by_id, mass, rest, int(rest_mass))


def _pack(*columns: np.ndarray) -> bytes:
    head = np.array([len(columns[0])], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(c.tobytes() for c in columns))


def _unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _counted(cells: np.ndarray, weights: np.ndarray | None, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Different cells in ascending order with their counts: by direct address where the tile is dense, else by sorting."""
    if len(cells) * 16 >= wide:
        total = np.bincount(cells, weights, wide)
        found = np.flatnonzero(total)
        return found, total[found].astype(np.int64)
    if weights is None:
        return np.unique(cells, return_counts=True)
    order = np.argsort(cells, kind="stable")
    cells, weights = cells[order], weights[order]
    begin = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    return cells[begin], np.add.reduceat(weights, begin)


class _Strips:
    """Numbers of strips of each tile, from the most that can fall into it; STRIP_MASS in a strip, of 64 cells at least."""

    def __init__(self, first: Ranked, second: Ranked, side: int, mass: int):
        self.first, self.second, self.side, self.mass = first.mass, second.mass, side, mass

    def cells(self, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
        """Cells of one strip of each tile, a power of two."""
        most = np.minimum(self.first[t1], self.second[t2])
        strips = 1 << np.ceil(np.log2(np.maximum(most / self.mass, 1))).astype(np.int64)
        return np.minimum(np.maximum(self.side * self.side // strips, 64), self.side * self.side)


def neighbour_counts(docs: DataFrame, words: Ranked, pairs: Ranked | None, floor: int, side: int = SIDE, flush: int = FLUSH,
                     strip_mass: int = STRIP_MASS) -> DataFrame:
    """key, first, second and n of neighbours that occur `floor` times or more.

    Without `pairs`, first and second are word keys; with them, first is the key of a pair and second the word that follows it.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tuple(words), tuple(pairs) if pairs else None))
    firsts = pairs or words
    tails = 1 + (words.rest_mass + firsts.rest_mass) // (strip_mass // 4)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, p = shared.value
        w, p = Ranked(*w), Ranked(*p) if p else None
        strips = _Strips(p or w, w, side, strip_mass)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        loose: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in chunks(batches, "_text"):
            _, _, _, keys, joined = words_of(batch)
            if len(keys) < 2:
                continue
            ids, likely = w.find(keys)
            at = np.flatnonzero(joined & likely[:-1] & likely[1:])
            if p is None:
                a, b, first, second = ids[at], ids[at + 1], keys[at], keys[at + 1]
            else:
                both = pair(keys[at], keys[at + 1])
                pid, good = p.find(both)
                # A triple starts where this pair and the next word's pair are frequent.
                place = np.flatnonzero(good[:-1] & good[1:] & (at[1:] == at[:-1] + 1))
                a, b, first, second = pid[place], ids[at[place] + 2], both[place], keys[at[place] + 2]
            ranked_ = (a >= 0) & (b >= 0)
            held.append((a[ranked_].astype(np.int32), b[ranked_].astype(np.int32)))
            if not ranked_.all():
                loose.append((first[~ranked_], second[~ranked_]))
            size += len(a)
            if size > flush:
                yield from _tiles(held, loose, strips, side, tails)
                held, loose, size = [], [], 0
        if size:
            yield from _tiles(held, loose, strips, side, tails)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t1, t2, strip = (k.as_py() for k in key)
        blobs = [b for batch in batches for b in batch.column("blob").to_pylist()]
        if t1 < 0:
            f, s, n = (np.concatenate(c) for c in zip(*(_unpack(b, np.uint64, np.uint64, np.int64) for b in blobs)))
            first, second, total = _pair_sums(f, s, n)
        else:
            w, p = shared.value
            w, p = Ranked(*w), Ranked(*p) if p else None
            wide = int(_Strips(p or w, w, side, strip_mass).cells(np.array([t1]), np.array([t2]))[0])
            cells, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
            # Blocks are folded in by groups of about a million entries, so memory follows the strip and not the number of tasks.
            part, size = [], 0
            for k, blob in enumerate(blobs):
                part.append(_unpack(blob, np.uint32, np.uint32))
                size += len(part[-1][0])
                if size > 1_000_000 or k + 1 == len(blobs):
                    cells, total = _counted(np.concatenate([cells, *(c.astype(np.int64) for c, _ in part)]),
                                            np.concatenate([total, *(n.astype(np.int64) for _, n in part)]), wide)
                    part, size = [], 0
            keep = total >= floor
            cells, total = cells[keep] + strip * wide, total[keep]
            first, second = (p or w).by_id[t1 * side + cells // side], w.by_id[t2 * side + cells % side]
        keep = total >= floor
        first, second, total = first[keep], second[keep], total[keep]
        if len(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair(first, second).view(np.int64)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(total)],
                names=["key", "first", "second", "n"])
    return (docs.mapInArrow(scan, "t1 int, t2 int, strip int, blob binary").groupBy("t1", "t2", "strip")
            .applyInArrow(add, "key long, first long, second long, n long"))


def _pair_sums(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((second, first))
    first, second, n = first[order], second[order], n[order]
    begin = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))[:len(first)])
    return first[begin], second[begin], np.add.reduceat(n, begin) if len(begin) else n


def _tiles(held: list, loose: list, strips: _Strips, side: int, tails: int) -> Iterator[pa.RecordBatch]:
    """A block of counts for each strip of each tile met, and blocks of coordinates for what has no id."""
    rows: list[tuple[int, int, int, bytes]] = []
    a, b = (np.concatenate(c) for c in zip(*held))
    tile = ((a // side).astype(np.int64) << 32) | (b // side)
    order = np.argsort(tile, kind="stable")
    a, b, tile = a[order], b[order], tile[order]
    begin = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1]))[:len(tile)])
    t1, t2 = tile[begin] >> 32, tile[begin] & 0xFFFFFFFF
    wides = strips.cells(t1, t2) if len(begin) else begin
    for i, (lo, hi) in enumerate(zip(begin, [*begin[1:], len(tile)])):
        cells, n = _counted((a[lo:hi] % side) * side + b[lo:hi] % side, None, side * side)
        wide = int(wides[i])
        edges = np.searchsorted(cells, np.arange(0, side * side + 1, wide))
        for strip in np.flatnonzero(edges[1:] > edges[:-1]):
            x = slice(edges[strip], edges[strip + 1])
            rows.append((int(t1[i]), int(t2[i]), int(strip), _pack((cells[x] - strip * wide).astype(np.uint32), n[x].astype(np.uint32))))
    if loose:
        first, second = (np.concatenate(c) for c in zip(*loose))
        first, second, n = _pair_sums(first, second, np.ones(len(first), np.int64))
        part = (pair(first, second) % np.uint64(tails)).astype(np.int64)
        for k in np.unique(part):
            x = part == k
            rows.append((-1, -1, int(k), _pack(first[x], second[x], n[x])))
    for lo in range(0, len(rows), 2000):
        cols = list(zip(*rows[lo:lo + 2000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                         names=["t1", "t2", "strip", "blob"])


def score(a: str, left: str, right: str) -> str:
    """floor(1,000,000 * a * a / (left * right)) in exact decimals, for counts of up to 15 digits."""
    wide = "CAST({} AS DECIMAL(15, 0))"
    return f"(1000000 * ({wide.format(a)} * {wide.format(a)})) div ({wide.format(left)} * {wide.format(right)})"


def collocations(docs: DataFrame, top: int = 2000, floor: int = FLOOR, text: str = "text", lang: str = "lang", head: int = HEAD,
                 side: int = SIDE, flush: int = FLUSH, strip_mass: int = STRIP_MASS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best `top` phrases of each language.

    a: occurrences of the phrase; l and r: of its parts at the cut with the least score; n: words of the language. A phrase goes
    if a longer one around it has at least half of its occurrences.
    """
    base = docs.select(F.col(text).alias("_text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_lang"))
    every = cut(word_counts(base))
    sizes = every.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every.where(F.col("n") >= floor)
    ids = ranked(words.withColumn("grp", F.col("lang")), head, side)
    pairs = cut(neighbour_counts(base, ids, None, floor, side, flush, strip_mass))
    grouped = pairs.join(words.select(F.col("key").alias("first"), F.col("lang").alias("grp")), "first")
    triples = cut(neighbour_counts(base, ids, ranked(grouped, head, side), floor, side, flush, strip_mass)
                  .select(F.col("first").alias("pair"), F.col("second").alias("third"), F.col("n").alias("a")))

    def named(prefix: str, *names: str) -> DataFrame:
        return words.select(*[F.col(c).alias(prefix if c == "key" else f"{prefix}_{c}") for c in ("key", *names)])
    two = (pairs.select("first", "second", F.col("n").alias("a"), F.col("key").alias("pair"))
           .join(named("first", "lang", "word", "n"), "first").join(named("second", "word", "n"), "second"))
    three = (triples.join(pairs.select(F.col("key").alias("pair"), "first", "second", F.col("n").alias("n12")), "pair")
             .join(pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("n").alias("n23"),
                                F.col("key").alias("pair23")), ["second", "third"]))
    longer = cut(three.select("pair", "a").unionByName(three.select(F.col("pair23").alias("pair"), "a"))
                 .groupBy("pair").agg(F.max("a").alias("longer")))
    pieces = ["lang", "phrase", "a", "l", "r", "score"]
    short = (two.join(longer, "pair", "left").where("longer IS NULL OR 100 * longer < 50 * a")
             .withColumns({"lang": F.col("first_lang"), "phrase": F.concat_ws(" ", "first_word", "second_word"), "l": F.col("first_n"),
                           "r": F.col("second_n"), "score": F.expr(score("a", "first_n", "second_n"))}).select(*pieces))
    cuts = (three.join(named("first", "lang", "word", "n"), "first").join(named("second", "word"), "second").join(named("third", "word", "n"), "third")
            .withColumns({"s1": F.expr(score("a", "first_n", "n23")), "s2": F.expr(score("a", "n12", "third_n"))}))
    early = F.col("s1") <= F.col("s2")
    long = cuts.withColumns({
        "lang": F.col("first_lang"), "phrase": F.concat_ws(" ", "first_word", "second_word", "third_word"),
        "l": F.when(early, F.col("first_n")).otherwise(F.col("n12")), "r": F.when(early, F.col("n23")).otherwise(F.col("third_n")),
        "score": F.least("s1", "s2")}).select(*pieces)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (short.unionByName(long).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                        F.col("total").alias("n"), "score"))
