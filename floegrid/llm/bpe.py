"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece of text there is exactly one last token of its encoding. The tokens
that end at a position are found by an automaton over the whole vocabulary. One of them is
the last token exactly if it and the last token of the remaining prefix stay apart when the two are
encoded together; that is tested by undoing the later of the two merges step by step. Following
the back-pointers from the end gives the ids. Time is linear in the length of a piece.

Pieces come from the vocabulary's pre-tokenizer pattern and repeat a great deal, so each worker keeps the
ids of pieces and the tests of pairs that it has met, up to a fixed number. Rows are independent: there is no shuffle.

Defined results: a null text is an empty text, which has no ids and decodes to an empty text; the
special token's own text in a document is encoded as that token, as the tokenizers library does;
repeated rows and all other columns are passed through, and the three output columns replace columns of these names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from floegrid.llm.text import chunks, once_per_worker

# Fixed value: the pre-tokenizer pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_PIECES = 400_000
CACHED_PAIRS = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class Vocabulary:
    """Tokens as bytes by id, merges in the order of their rank, and special tokens by text."""

    tokens: list[bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    @staticmethod
    def from_json(content: str) -> Vocabulary:
        spec = json.loads(content)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for text, i in ids.items():
            tokens[i] = bytes(alphabet[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        merges = []
        for m in spec["model"]["merges"]:
            left, right = m if isinstance(m, list) else m.split(" ")
            merges.append((ids[left], ids[right], ids[left + right]))
        return Vocabulary(tokens, merges, special)


class Encoder:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.special = vocabulary.special
        # A token's age is the rank of the merge that first makes it; single bytes have none.
        self.joined: dict[tuple[int, int], int] = {}
        self.age: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right, whole) in enumerate(vocabulary.merges):
            self.joined.setdefault((left, right), rank)
            if whole not in self.parts:
                self.parts[whole] = (left, right)
                self.age[whole] = rank
        special = set(self.special.values())
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens):
            if token and i not in special:
                self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.findall = regex.compile(PATTERN).findall
        self.split = (regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split
                      if self.special else None)
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.tested: dict[int, bool] = {}

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether `left` followed by `right` is what encoding their joint text gives.

        Merges happen in order of rank. The boundary is crossed if a merge of the tokens that touch it comes before the
        merges that bury them, so the younger side is opened again and again, and each touching pair is looked up.
        """
        age, parts, joined = self.age, self.parts, self.joined
        # Rank from which on the pair now at the boundary no longer exists, as one side has been merged away.
        until = len(joined) + 1
        while True:
            rank = joined.get((left, right))
            if rank is not None and rank < until:
                return False
            a, b = age.get(left, -1), age.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                until, left = a, parts[left][1]
            else:
                # Of two merges with one rank the left one comes first: the right side exists through rank b.
                until, right = b + 1, parts[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        n = len(piece)
        last: list[int] = [-1] * (n + 1)
        size = [0] * (n + 1)
        tested, done = self.tested, 0
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if end == done:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                both = before << 24 | token
                apart = tested.get(both)
                if apart is None:
                    if len(tested) >= CACHED_PAIRS:
                        tested.clear()
                    apart = tested[both] = self.stay_apart(before, token)
                if not apart:
                    continue
            last[end], size[end], done = token, length, end
        ids = []
        while n:
            if last[n] < 0:
                raise ValueError("the vocabulary lacks a single byte of this text")
            ids.append(last[n])
            n -= size[n]
        return ids[::-1]

    def entry(self, piece: str) -> tuple[str, int, bytes]:
        """Decimal ids, number of ids and decoded bytes of a piece."""
        found = self.known.get(piece)
        if found is None:
            ids = self.encode_piece(piece.encode())
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            found = (",".join(map(str, ids)), len(ids), self.decode_bytes(ids))
            if len(piece) <= 64:
                self.known[piece] = found
        return found

    def entries(self, text: str) -> list[tuple[str, int, bytes]]:
        out = []
        for run in (self.split(text) if self.split else [text]):
            if run in self.special:
                i = self.special[run]
                out.append((str(i), 1, self.tokens[i]))
            elif run:
                known, entry = self.known, self.entry
                out += [known.get(p) or entry(p) for p in self.findall(run)]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _, _ in self.entries(text) for i in ids.split(",")]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read on the driver and sent to the workers; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encoder(content: str) -> Encoder:
    key = ("bpe", hashlib.sha256(content.encode()).hexdigest())
    return once_per_worker(key, lambda: Encoder(Vocabulary.from_json(content)))


def _output_schema(docs: DataFrame, names: dict[str, str]) -> str:
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name not in names]
    return T.StructType([*kept, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in names.items()]])


def encode_documents(docs: DataFrame, vocabulary_path: str, ids: bool = True, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens`, `ids_sha256`, `decoded_sha256` and, if asked for, `token_ids` (array of int).

    The decoded text is made from the ids and its digest is taken over its UTF-8 bytes.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    names = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if ids:
        names["token_ids"] = "array<int>"
    schema = _output_schema(docs, names)
    kept = [f.name for f in schema.fields if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in chunks(batches, text):
            counts, id_digests, text_digests, id_lists = [], [], [], []
            for value in batch.column(text).to_pylist():
                found = encoder.entries(value or "")
                decimal = ",".join([f[0] for f in found])
                decoded = b"".join([f[2] for f in found]).decode("utf-8", "replace")
                counts.append(sum([f[1] for f in found]))
                id_digests.append(hashlib.sha256(decimal.encode()).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                if ids:
                    id_lists.append([int(i) for i in decimal.split(",")] if decimal else [])
            made = [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            if ids:
                made.append(pa.array(id_lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=[*kept, *names])
    return docs.mapInArrow(run, schema)
