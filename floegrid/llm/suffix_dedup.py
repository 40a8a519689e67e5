"""Removal of long repeated byte strings by a distributed merge sort of sparse suffixes.

A byte goes if it is covered by a string of `length` bytes that also starts anywhere else. Sorting every suffix
would exchange many times the corpus, so only some suffixes are sorted:

1. *Anchors.* The anchor of a start is, among it and the next `window` - 1 starts, the one whose `gram` bytes have the least
   hash. Both follow from `length` (`anchor_shape`). It lies inside the string of `length` bytes and depends on its bytes alone, so equal strings have it at the
   same place. Consecutive starts mostly share their anchor.
2. *Duplicate detection.* Anchors are counted by a fingerprint of their bytes. A stretch of repeated anchors that
   is too short to hold a string of `length` bytes between two unrepeated ones is left out. This bounds what is exchanged by the
   repeated part of the corpus.
3. *Merge sort.* Tasks sort the suffixes that start at the remaining anchors, cut after `length` bytes, and send
   one front-coded run for each range: per suffix the length of the prefix shared with the one before, then the
   rest, compressed. The receiving task merges its runs with a loser tree that carries shared-prefix lengths: two suffixes are
   compared only from the first byte that is not known to be equal. Sorted neighbours and their shared
   prefixes give the classes of suffixes that may share a string.
4. *Strings of a class.* For a class, the strings that start in the gaps before its anchors are told apart by their back
   context and the shared prefix; strings that occur twice are marked.

The order is by fingerprint first and bytes second, so ranges are equal parts of the fingerprint space and need no sample on the
driver; their number follows from the count of suffixes, about RANGE_ROWS in each, so a task's share does not grow with the corpus.
A fingerprint with more than RANGE_ROWS suffixes is dealt to several tasks; strings that occur once in a task
there are counted across tasks by hash. Equal texts are worked on once, with their number of copies.
Strings are told apart by 64-bit hashes of all their bytes.

Defined results: a null or short text has nothing to remove; repeated rows are separate documents, so a text of `length` bytes
or more that occurs twice goes altogether; matches never cross documents. Other columns are passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from floegrid.llm.tables import cut, cut_by, passing_through, text_key
from floegrid.llm.text import BYTE_VALUE, MIX_A, chunks, mix, packed, pair

LENGTH = 400
RANGE_ROWS = 8_000


def anchor_shape(length: int) -> tuple[int, int]:
    """Bytes of a gram and starts of a window, powers of two: about a sixth and at most three quarters of the length."""
    if length < 16:
        raise ValueError("length must be at least 16")
    return 1 << (length // 6).bit_length() - 1, 1 << (3 * length // 4).bit_length() - 1


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of the `gram` bytes from each start, by doubling; it only chooses anchors."""
    h = (BYTE_VALUE[data] >> np.uint64(32)).astype(np.uint32)
    n = 1
    while n < gram:
        h = (h[:-n] * np.uint32(0x9E3779B1)) ^ (h[n:] + np.uint32(n))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
        n *= 2
    return h ^ (h >> np.uint32(13))


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the least key in each window of `width` keys."""
    n = len(keys)
    placed = (keys.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = placed
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    back = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    least = np.minimum(ahead[:n - width + 1], back[width - 1:n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, the first start of each, and its text; windows never cross texts."""
    gram, window = anchor_shape(length)
    need = gram + window - 1
    if len(data) < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = sliding_argmin(gram_hashes(data, gram), window)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - need + 1, 0)
    firsts = np.repeat(offsets[:-1], windows)
    starts = firsts + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    chosen = least[starts]
    fresh = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1]))[:len(chosen)])
    places = chosen[fresh]
    return places, starts[fresh], np.searchsorted(offsets, places, "right") - 1


def fingerprints(data: np.ndarray, places: np.ndarray, gram: int) -> np.ndarray:
    h = np.zeros(len(places), np.uint64)
    for i in range(gram):
        h = h * MIX_A + BYTE_VALUE[data[places + i]]
    return mix(h)


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """k1, k2, copies, n_bytes, and place, first start and fingerprint of each of a text's anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = packed(batch.column("text"))
            places, lows, owner = anchors(data, offsets, length)
            prints = fingerprints(data, places, anchor_shape(length)[0])
            bounds = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            base = offsets[owner]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), batch.column("copies"), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(bounds, pa.array((places - base).astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array((lows - base).astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array(prints.view(np.int64)))],
                names=["k1", "k2", "copies", "n_bytes", "places", "lows", "prints"])
    return texts.mapInArrow(
        run, "k1 long, k2 long, copies long, n_bytes long, places array<int>, lows array<int>, prints array<long>")


def front_code(suffixes: list[bytes]) -> bytes:
    """A sorted run: per suffix the shared prefix with the one before, the rest's length and the rest."""
    shared, rests, before = [], [], b""
    for s in suffixes:
        n = common_prefix(before, s, 0)
        shared.append(n)
        rests.append(s[n:])
        before = s
    head = np.array([len(suffixes), *shared, *map(len, rests)], np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(rests))


def front_decode(blob: bytes) -> tuple[list[bytes], list[int]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    head = np.frombuffer(raw, np.uint32, 2 * n, 4)
    shared, sizes = head[:n].tolist(), head[n:].tolist()
    at, before, out = 4 + 8 * n, b"", []
    for keep, size in zip(shared, sizes):
        before = before[:keep] + raw[at:at + size]
        out.append(before)
        at += size
    return out, shared


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = 16
    while a[known:known + step] == b[known:known + step]:
        known += step
        step *= 2
    while step > 1:
        step //= 2
        if a[known:known + step] == b[known:known + step]:
            known += step
    return known


class LoserTree:
    """Merges sorted runs; every run's head carries the length of its common prefix with the last one given out.

    Of two heads, the one with the longer prefix in common with the last output is smaller, and bytes are looked at
    only if both lengths are equal, from that length on.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.k = 1
        while self.k < len(runs):
            self.k *= 2
        self.lcp = [0] * self.k
        self.loser = [-1] * self.k
        winners = [i if i < len(runs) and runs[i][0] else -1 for i in range(self.k)]
        level = self.k
        nodes = winners
        while level > 1:
            level //= 2
            nodes = [self._play(level + j, nodes[2 * j], nodes[2 * j + 1]) for j in range(level)]
        self.winner = nodes[0]

    def _play(self, node: int, a: int, b: int) -> int:
        """The loser stays at the node with its common prefix with the winner; the winner goes up."""
        if a < 0 or b < 0:
            self.loser[node] = -1
            return b if a < 0 else a
        la, lb = self.lcp[a], self.lcp[b]
        if la == lb:
            x, y = self.runs[a][0][self.at[a]], self.runs[b][0][self.at[b]]
            n = common_prefix(x, y, la)
            if x[n:n + 1] <= y[n:n + 1]:
                self.lcp[b] = n
                self.loser[node] = b
                return a
            self.lcp[a] = n
            self.loser[node] = a
            return b
        if la > lb:
            self.loser[node] = b
            return a
        self.loser[node] = a
        return b

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, place in the run, common prefix with the one given before), in sorted order."""
        while self.winner >= 0:
            run = self.winner
            yield run, self.at[run], self.lcp[run]
            self.at[run] += 1
            here = self.at[run]
            alive = here < len(self.runs[run][0])
            if alive:
                self.lcp[run] = self.runs[run][1][here]
            best = run if alive else -1
            node = (run + self.k) // 2
            while node >= 1:
                best = self._play(node, best, self.loser[node])
                node //= 2
            self.winner = best


def run_rows(found: DataFrame, ranges: int, length: int) -> DataFrame:
    """Sorted front-coded runs, one for each range and task; `found` has k1, k2, copies, text and anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple]] = {}
        size = 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("k1", "k2", "copies", "text", "anchors")]
            for k1, k2, copies, text, marks in zip(*cols):
                raw = (text or "").encode()
                for g in marks:
                    at, low, p, parts = g["at"], g["low"], g["print"] & 0xFFFFFFFFFFFFFFFF, g["parts"]
                    key = (p * ranges >> 64, (k1 ^ at) % parts if parts > 1 else -1)
                    body = p.to_bytes(8, "big") + raw[at:at + length]
                    held.setdefault(key, []).append((body, raw[low:at], k1, k2, at, at - g["high"], copies))
                    size += 400 + length + at - low
            if size > 96 << 20:
                yield from _flush(held)
                held, size = {}, 0
        yield from _flush(held)
    return found.mapInArrow(run, RUN_SCHEMA)


RUN_SCHEMA = ("part long, salt int, run binary, back binary, k1 array<long>, k2 array<long>, place array<int>, "
              "deep array<int>, near array<int>, copies array<long>")


def _flush(held: dict[tuple[int, int], list[tuple]]) -> Iterator[pa.RecordBatch]:
    for (part, salt), rows in held.items():
        rows.sort(key=lambda r: r[:2])
        back = zstandard.ZstdCompressor(level=3).compress(b"".join(r[1] for r in rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([salt], pa.int32()),
             pa.array([front_code([r[0] for r in rows])], pa.binary()), pa.array([back], pa.binary()),
             pa.array([[r[2] for r in rows]], pa.list_(pa.int64())), pa.array([[r[3] for r in rows]], pa.list_(pa.int64())),
             pa.array([[r[4] for r in rows]], pa.list_(pa.int32())), pa.array([[len(r[1]) for r in rows]], pa.list_(pa.int32())),
             pa.array([[r[5] for r in rows]], pa.list_(pa.int32())), pa.array([[r[6] for r in rows]], pa.list_(pa.int64()))],
            names=["part", "salt", "run", "back", "k1", "k2", "place", "deep", "near", "copies"])


def class_strings(bodies: list[bytes], backs: list[bytes], nears: list[int],
                  length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Member, distance of the start before the anchor, and hash of every string of `length` bytes of the members.

    A string is the last d bytes of the back context and the first length - d bytes of the suffix. Both parts are hashed from the
    anchor outwards, so all d cost one pass each.
    """
    n = len(bodies)
    sizes = np.array([len(b) for b in bodies])
    gaps = np.array([len(b) for b in backs])
    wide, deep = max(int(sizes.max()), 1), int(gaps.max())
    front = np.zeros((n, wide), np.uint8)
    front[np.arange(wide) < sizes[:, None]] = np.frombuffer(b"".join(bodies), np.uint8)
    rear = np.zeros((n, max(deep, 1)), np.uint8)
    if deep:
        rear[np.arange(deep) < gaps[:, None]] = np.frombuffer(b"".join(b[::-1] for b in backs), np.uint8)
    powers = np.full(max(wide, deep) + 1, MIX_A, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    ahead = np.cumsum(BYTE_VALUE[front] * powers[:wide], axis=1, dtype=np.uint64)
    behind = np.cumsum(BYTE_VALUE[rear] * powers[:rear.shape[1]], axis=1, dtype=np.uint64)
    member, d = np.nonzero((np.arange(deep + 1)[None, :] <= gaps[:, None])
                           & (np.arange(deep + 1)[None, :] >= np.array(nears)[:, None])
                           & (length - np.arange(deep + 1)[None, :] <= sizes[:, None]))
    first = ahead[member, length - d - 1]
    last = np.where(d > 0, behind[member, np.maximum(d - 1, 0)], np.uint64(0))
    return member, d, pair(mix(first), mix(last) ^ d.astype(np.uint64))


def merge_ranges(runs: DataFrame, length: int) -> DataFrame:
    """Repeated strings of each range: rows (k1, k2, first, last, h, n); h is null for starts that are known to repeat.

    Rows with h are strings of a fingerprint that several tasks share; their occurrences `n` in this task are to be summed.
    """
    core = length - anchor_shape(length)[1] + 8

    def run(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = [r for b in batches for r in b.to_pylist()]
        if not inputs:
            return
        shared = inputs[0]["salt"] >= 0
        sorted_runs = [front_decode(r["run"]) for r in inputs]
        backs = []
        for r in inputs:
            raw, at, own = zstandard.ZstdDecompressor().decompress(r["back"]) if sum(r["deep"]) else b"", 0, []
            for g in r["deep"]:
                own.append(raw[at:at + g])
                at += g
            backs.append(own)
        members, out = [], _Found()

        def close() -> None:
            if members:
                _resolve([(sorted_runs[r][0][i], backs[r][i], inputs[r], i) for r, i in members], length, shared, out)
        for r, i, lcp in LoserTree(sorted_runs):
            if lcp < core:
                close()
                members = []
            members.append((r, i))
        close()
        yield from out.batches()
    return runs.groupBy("part", "salt").applyInArrow(run, "k1 long, k2 long, first int, last int, h long, n long")


class _Found:
    def __init__(self) -> None:
        self.rows: list[tuple[np.ndarray, ...]] = []

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.rows.append(columns)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            k1, k2, first, last, h, n = (np.concatenate(c) for c in zip(*self.rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                 pa.array(h.view(np.int64), mask=n == 0), pa.array(n)], names=["k1", "k2", "first", "last", "h", "n"])


def _resolve(members: list[tuple], length: int, shared: bool, out: _Found) -> None:
    """Strings of one class of suffixes, by slices of gaps so that memory stays bounded for a large class."""
    if len(members) == 1 and not shared and members[0][2]["copies"][members[0][3]] < 2:
        return
    k1 = np.array([m[2]["k1"][m[3]] for m in members], np.int64)
    k2 = np.array([m[2]["k2"][m[3]] for m in members], np.int64)
    place = np.array([m[2]["place"][m[3]] for m in members], np.int64)
    copies = np.array([m[2]["copies"][m[3]] for m in members], np.int64)
    parts = [class_strings([m[0][8:] for m in some], [m[1] for m in some], [m[2]["near"][m[3]] for m in some], length)
             for some in (members[i:i + 1024] for i in range(0, len(members), 1024))]
    member = np.concatenate([p[0] + 1024 * i for i, p in enumerate(parts)])
    if not len(member):
        return
    d = np.concatenate([p[1] for p in parts])
    h = np.concatenate([p[2] for p in parts])
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(which, weights=copies[member]).astype(np.int64)
    known = total[which] >= 2
    start = place[member] - d
    # Known starts as runs of consecutive starts of a member.
    m, s = member[known], start[known]
    order = np.lexsort((s, m))
    m, s = m[order], s[order]
    if len(m):
        fresh = np.concatenate(([True], (m[1:] != m[:-1]) | (s[1:] != s[:-1] + 1)))
        begin = np.flatnonzero(fresh)
        end = np.concatenate((begin[1:], [len(m)])) - 1
        none = np.zeros(len(begin), np.int64)
        out.add(k1[m[begin]], k2[m[begin]], s[begin], s[end], none.view(np.uint64), none)
    if shared:
        # One row for each string: a single occurrence asks for the other tasks' count, the rest only tells its own.
        m, s = member[one], start[one]
        out.add(k1[m], k2[m], s, s, h[one], total[which[one]])


def repeated_starts(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs (k1, k2, first, last) of starts of strings of `length` bytes that occur elsewhere too.

    `texts` has one row for each different text: k1, k2, text, copies. It is read twice and best kept in buckets of its key.
    """
    rows = cut(anchor_rows(texts.where(F.octet_length("text") >= length), length))
    each = rows.select("k1", "k2", "copies", F.posexplode("prints").alias("i", "print"))
    # Written, so that the join below shuffles both sides and the runtime can split a print that a third of the texts have.
    often = cut(each.groupBy("print").agg(F.sum("copies").alias("_n"), F.count(F.lit(1)).alias("_rows"))
                .where(F.col("_n") > 1)
                .select("print", F.ceil(F.col("_rows") / RANGE_ROWS).cast("int").alias("parts")))
    hits = (each.select("k1", "k2", "i", "print").join(often, "print")
            .groupBy("k1", "k2").agg(F.collect_list(F.struct("i", "parts")).alias("hits")))
    kept = cut(hits.join(rows, ["k1", "k2"]).mapInArrow(
        _stretches(length), "k1 long, k2 long, copies long, "
        "anchors array<struct<at:int,low:int,high:int,print:long,parts:int>>"))
    ranges = 1 + (kept.agg(F.sum(F.size("anchors"))).first()[0] or 0) // RANGE_ROWS
    found = kept.join(texts.select("k1", "k2", "text"), ["k1", "k2"])
    merged = cut(merge_ranges(run_rows(found, ranges, length), length))
    sure = merged.where(F.col("h").isNull()).select("k1", "k2", "first", "last")
    open_ = merged.where(F.col("h").isNotNull())
    wide = open_.groupBy("h").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_tasks")).where(
        (F.col("_n") > 1) & (F.col("_tasks") > 1)).select("h")
    return sure.unionByName(open_.where(F.col("n") == 1).join(wide, "h").select("k1", "k2", "first", "last"))


def _stretches(length: int):
    """Anchors that a repeated string may have, with the first and last such start of each.

    All anchors of the starts within a repeated string's first bytes are repeated themselves, so a string starts only
    where a stretch of repeated anchors goes on for `more` starts.
    """
    gram, window = anchor_shape(length)
    need = gram + window - 1
    more = length - need
    kind = pa.list_(pa.struct([("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("print", pa.int64()),
                               ("parts", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                places, lows, prints = row["places"], row["lows"], row["prints"]
                highs = [low - 1 for low in lows[1:]] + [row["n_bytes"] - need]
                parts = {h["i"]: h["parts"] for h in row["hits"]}
                marks, i, n = [], 0, len(places)
                while i < n:
                    if i not in parts:
                        i += 1
                        continue
                    j = i
                    while j + 1 < n and j + 1 in parts:
                        j += 1
                    last = highs[j] - more
                    marks += [{"at": places[x], "low": lows[x], "high": min(highs[x], last), "print": prints[x],
                               "parts": parts[x]} for x in range(i, j + 1) if lows[x] <= last]
                    i = j + 1
                out.append(marks)
            kept = [k for k, m in enumerate(out) if m]
            if kept:
                part = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), part.column("copies"), pa.array([out[k] for k in kept], kind)],
                    names=["k1", "k2", "copies", "anchors"])
    return run


def _remove(raw: bytes, starts: list[tuple[int, int]], length: int) -> tuple[bytes, int, int]:
    """Kept bytes, number of removed bytes and of maximal removed runs."""
    kept, removed, spans, at = [], 0, 0, 0
    end = -1
    for first, last in sorted(starts):
        stop = last + length
        if first > end:
            spans += 1
            kept.append(raw[at:first])
            removed += stop - first
            at = end = stop
        elif stop > end:
            removed += stop - end
            at = end = stop
    kept.append(raw[at:])
    return b"".join(kept), removed, spans


@passing_through("_k1", "_k2")
def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, `kept_text`.

    `kept_text` is the remaining bytes as text; what a removed span left of a character cut in two is not in it.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else [])]
    base = docs.drop(*names).withColumns(dict(zip(("_k1", "_k2"), text_key(F.col(text)))))
    texts = cut_by(base.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.coalesce(F.col(text), F.lit("")).alias("text"))
                .groupBy("k1", "k2").agg(F.max("text").alias("text"), F.count(F.lit(1)).alias("copies")),
                   "k1", "k2")
    spans = repeated_starts(texts, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out = []
            for value, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                raw = value.encode()
                kept, removed, n = _remove(raw, [(s["first"], s["last"]) for s in starts or ()], length)
                out.append((len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            made = [pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())[:len(names)])]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *made], names=["_k1", "_k2", *names])
    types = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    results = texts.join(spans, ["k1", "k2"], "left").select("k1", "k2", "text", "starts").mapInArrow(
        run, f"_k1 long, _k2 long, {types}")
    return base.join(results, ["_k1", "_k2"]).drop("_k1", "_k2")
