"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Encodings of adjacent texts form a monoid: the halves of a match are encoded by recursion, and two
neighbours are joined by encoding again a window at their border that grows until the tokens outside
provably stay. The proof is the pair test: a row of tokens is the encoding of its bytes if and only if
each two neighbours are the encoding of theirs, so a window that fits both tokens beside it changes
nothing further out. Decoding concatenates up the same tree.

Texts fall into matches of the pattern, and a match never crosses a space that stands before a
character other than white space; so texts are cut there first, and equal words are encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import Recent, by_batch, plain_texts

#: Letters and numbers that the pattern's \p{L} and \p{N} don't know (the tokenizer's library has Unicode 16, `regex` a later one).
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_NEWER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER) + "]")
NEVER = 1 << 62
LEAF, SCAN = 24, 64


class Encoder:
    """Encoder and decoder of one file of ranks; matches of `pattern` are encoded separately."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(i) for a, i in map(bytes.split, filter(None, f.read().splitlines()))}
        self.bytes = {i: b for b, i in self.rank.items()}
        self.pairs: dict[int, bool] = {}
        self.pattern = regex.compile(pattern)
        self.words = Recent(self._word, "byte_bpe")

    def merged(self, b: bytes) -> list[int]:
        """The definition itself: the pair of least rank is joined, the leftmost first."""
        rank = self.rank.get
        if len(b) <= SCAN:
            parts = [b[i : i + 1] for i in range(len(b))]
            ranks = [rank(b[i : i + 2], NEVER) for i in range(len(b) - 1)]
            while ranks and (least := min(ranks)) != NEVER:
                k = ranks.index(least)
                parts[k] += parts.pop(k + 1)
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = rank(parts[k] + parts[k + 1], NEVER)
                if k:
                    ranks[k - 1] = rank(parts[k - 1] + parts[k], NEVER)
            return [self.rank[p] for p in parts]
        # A long window: parts are linked by where they begin, and a heap holds the pairs; those that no longer stand are passed over.
        after, before = list(range(1, len(b) + 1)), list(range(-1, len(b) - 1))
        heap = [(r, i, i + 2) for i in range(len(b) - 1) if (r := rank(b[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            mid = after[i]
            if mid < 0 or mid >= len(b) or after[mid] != end:
                continue
            after[i], after[mid] = end, -1
            if end < len(b):
                before[end] = i
                if (r := rank(b[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if before[i] >= 0 and (r := rank(b[before[i] : end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        ids, i = [], 0
        while i < len(b):
            ids.append(self.rank[b[i : after[i]]])
            i = after[i]
        return ids

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens, joined, encode to just these two."""
        found = self.pairs.get(a << 32 | b)
        if found is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            found = self.pairs[a << 32 | b] = self.merged(self.bytes[a] + self.bytes[b]) == [a, b]
        return found

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation: the encoding of two neighbours' bytes from the encodings of both."""
        i, j = min(1, len(left)), min(1, len(right))
        while True:
            window = self.merged(self.decode(left[len(left) - i :] + right[:j]))
            wider_left = i < len(left) and not self.fits(left[-i - 1], window[0])
            wider_right = j < len(right) and not self.fits(window[-1], right[j])
            if not (wider_left or wider_right):
                return left[: len(left) - i] + window + right[j:]
            i, j = min(len(left), 2 * i) if wider_left else i, min(len(right), 2 * j) if wider_right else j

    def matches(self, text: str) -> list[str]:
        """The pattern's matches; characters newer than the library's classes are neither letters nor numbers to it."""
        if text.isascii() or not _NEWER.search(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(_NEWER.sub("\U0010fffe", text))]

    def match(self, b: bytes) -> list[int]:
        """Ids of a match. Halves are of a length that is a power of two, so that runs of one character fall alike on both sides."""
        if (whole := self.rank.get(b)) is not None:
            return [whole]
        if len(b) <= LEAF:
            return self.merged(b)
        half = 1 << (len(b) - 1).bit_length() - 1
        return self.joined(self.match(b[:half]), self.match(b[half:]))

    def encode(self, text: str) -> list[int]:
        """Ids without special tokens."""
        return [i for m in self.matches(text) for i in self.match(m.encode())]

    def decode(self, ids: Sequence[int]) -> bytes:
        """Bytes of ids, halves concatenated up the tree; ids outside the ranks are an error."""
        if len(ids) <= 1024:
            return b"".join([self.bytes[i] for i in ids])
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])

    def _word(self, word: str) -> bytes:
        """Ids of a word behind one space, each with a comma; b"" where the cut before it isn't one, or if they don't decode to it."""
        if not word or word[0].isspace():
            return b""
        ids = self.encode(" " + word)
        return b"".join([b"%d," % i for i in ids]) if self.decode(ids) == b" " + word.encode() else b""

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded bytes)."""
        first, *words = text.split(" ")
        each = list(map(self.words.__getitem__, words))
        start = self.encode(first)
        if b"" not in each and self.decode(start) == first.encode():  # every word decodes to itself, so the text does
            ids = b"".join([*(b"%d," % i for i in start), *each])
            return ids.count(b","), hashlib.sha256(ids[:-1]).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        found = self.encode(text)
        return len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(self.decode(array("L", found))).hexdigest()


_LOADED: dict[tuple[str, str], Encoder] = {}


def load(path: str, pattern: str) -> Encoder:
    """The encoder of a file, once a process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): null and empty texts give no ids; repeated rows stay, extra columns are left aside."""

    def one(b: pa.RecordBatch) -> pa.Table:
        e = load(path, pattern)
        return pa.table({"doc_id": b.column(0), "ids": pa.array([e.encode(x) for x in plain_texts(b.column(1))], pa.list_(pa.int32()))})

    return by_batch(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), one, "doc_id long, ids array<int>", "byte_bpe")


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded binary): null or no ids give no bytes; ids outside the ranks are an error."""

    def one(b: pa.RecordBatch) -> pa.Table:
        e = load(path, pattern)
        return pa.table({"doc_id": b.column(0), "decoded": pa.array([e.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())})

    return by_batch(encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")), one, "doc_id long, decoded binary", "byte_bpe")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, whole texts.

    Null and empty texts have no ids; repeated rows and doc_ids are kept as they are, a null doc_id
    stays null, an empty table gives an empty result and extra columns are left aside.
    """

    def one(b: pa.RecordBatch) -> pa.Table:
        e = load(path, pattern)
        n, a, d = zip(*map(e.digest, plain_texts(b.column(1))), strict=True)
        return pa.table({"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": list(a), "decoded_sha256": list(d)})

    return by_batch(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), one,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "byte_bpe",
    )
