"""Small tables with the awkward rows that every operator must take, and brute-force twins."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward(rng: random.Random) -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, ids that clash."""
    long = sentence(rng, 6000)
    return [(1000, None, "en", "s", 0), (1001, "", None, "s", 0), (1002, " \t\n\x0b ", "en", None, None),
            (1003, long, "en", "s", len(long)), (1004, "ß漢字 é 🙂 naïve", "de", "s", 3), (None, "only a text", "en", "s", 1),
            (None, None, None, None, None), (1005, "twice the same row", "en", "s", 1), (1005, "twice the same row", "en", "s", 1),
            (1006, "x", "en", "s", 1), (1007, "aaaaaaaa" * 200, "en", "s", 1600), (1008, "\x00 zero", "en", "s", 1)]


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)


def spaced_words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def plain_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def removed_brute(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    return [(n, gone, spans, hashlib.sha256(kept).hexdigest()) for n, gone, spans, kept in cut_brute(texts, length)]


def cut_brute(texts: list[str | None], length: int) -> list[tuple[int, int, int, bytes]]:
    """Bytes, removed bytes, removed runs and what is left of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((len(x), sum(gone), spans, kept))
    return out


def shingles(text: str | None, size: int) -> frozenset:
    w = spaced_words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def components_brute(docs: list[tuple], size: int, percent: int = 80) -> dict[int, tuple[int, int, bool]]:
    """doc_id to (n_shingles, component_id, kept), by all pairs; ids must be unique."""
    sets = {i: shingles(t, size) for i, t in docs}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def contamination_brute(docs: list[tuple], items: list[tuple], span: int = 13) -> dict[int, tuple]:
    windows = defaultdict(set)
    for key, text in items:
        w = plain_words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add(str(key))
    out = {}
    for key, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out[key] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w))
    return out
