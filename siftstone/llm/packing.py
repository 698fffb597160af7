"""Vector best-fit packing of token pieces into sequences.

A bin has three capacities: tokens, documents, and attention cost (the sum of squared lengths). An
item goes to the open bin that takes it under every capacity and scores best, by the weighted
dot-product of item and residual ("dot") or by the weighted norm of what would be left ("norm").
Items go longest first. Only the histogram of lengths decides the packing: bins of equal tokens and like documents and
attention are one kind, so the plan is made on counts (at most `tokens` lengths, whatever the number of documents) and
says which ranks of a length go to which run of sequences, at which offset. Documents then find their
place by rank among the pieces of their length, counted over salted parts; no group of pieces comes
together in one task.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftstone.llm.common import Recent, by_batch, durable, plain_texts, unused

END = 1
NONE = np.iinfo(np.int64).max // 4  # used by bins that aren't there
#: Letters below U+0100, then marks that no contraction begins with.
CORE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?%$#*&]*)")
#: What stands for each byte in a byte-level vocabulary: itself if printable, else the next free character from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_CHARACTERS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(_OTHERS)}


@dataclass(frozen=True)
class Capacity:
    """None: not limited. Weights scale the three resources in the score.

    The defaults bound all three: as many documents as tokens, and twice the attention of one full document.
    """

    tokens: int = 4096
    documents: int | None = 4096
    attention: int | None = 2 * 4096 * 4096
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)

    def band(self, load: tuple[int, int, int]) -> tuple[int, int, int]:
        """Bins of equal tokens and like documents and attention are one kind; a kind has the most that one of its bins has."""
        documents = load[1] if load[1] < 8 else 4 + 2 * load[1].bit_length() + (load[1] >> (load[1].bit_length() - 2) & 1)
        return load[0], documents, load[2] * 64 // self.attention if self.attention else 0


class Words:
    """Ids of texts by a tokenizer file, with the ids of white-space separated parts kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = Recent(self._ids, "packing", 120_000)
        self.cores = Recent(self._core, "packing", 150_000)

    def _core(self, word: str) -> bytes:
        """A lower-case word of Latin letters: one unit of the splitting, unchanged by normalization."""
        unit = word if word.isascii() else "".join([BYTE_CHARACTERS[b] for b in word.encode()])
        return np.array([t.id for t in self.tokenizer.model.tokenize(unit)], "<u4").tobytes()

    def _ids(self, part: str) -> bytes:
        m = CORE.fullmatch(part)
        if m:  # letters and what follows them are split apart in any case, so they are kept apart
            return self.cores[m[1].lower()] + (self.parts[m[2]] if m[2] else b"")
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a text. This vocabulary's splitting never joins across a space or line feed."""
        parts = chain.from_iterable(x.split(" ") for x in text.split("\n")) if "\n" in text else text.split(" ")
        return b"".join(map(self.parts.__getitem__, parts))


_LOADED: dict[str, Words] = {}


def load(path: str) -> Words:
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, size: int = 4096, end: int = END, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents with their end id, cut only if longer than size."""
    final = np.array([end], "<u4").tobytes()

    def one(b: pa.RecordBatch) -> pa.Table:
        w = load(path)
        rows: list[list] = [[], [], [], [], [], []]
        for doc, x in zip(b.column(0).to_pylist(), plain_texts(b.column(1)), strict=True):
            ids = w.encode(x) + final
            for k, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at : at + 4 * size]
                for column, v in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None), strict=True):
                    column.append(v)
        made = {"doc_id": pa.array(rows[0], pa.int64()), "piece": pa.array(rows[1], pa.int32())}
        made |= {n: pa.array(rows[i], pa.int64()) for i, n in ((2, "start"), (3, "length"), (4, "ids_crc32"))}
        if keep_ids:
            made["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32()))
        return pa.table(made)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return by_batch(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), one, schema, "packing")


def plan(histogram: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset): a run of equal pieces, one to each of a run of sequences."""
    full = np.array([capacity.tokens, capacity.documents or 0, capacity.attention or 0], float)
    limited = np.array([True, capacity.documents is not None, capacity.attention is not None])
    unit = np.where(limited, np.asarray(capacity.weights, float) / np.maximum(full, 1), 0.0)
    used = np.zeros((0, 3), np.int64)  # of the kinds of open bins; a kind: runs of sequences
    runs: list[list[tuple[int, int]]] = []
    kinds: dict[tuple[int, int, int], int] = {}
    out, sequences = [], 0

    def put(load: tuple[int, int, int], first: int, n: int) -> int:
        nonlocal used
        name = capacity.band(load)
        k = kinds.get(name)
        if k is None:
            k = kinds[name] = len(runs)
            runs.append([])
            if len(runs) > len(used):
                used = np.vstack([used, np.full((max(64, len(used)), 3), NONE)])
        used[k] = load if not runs[k] else np.maximum(used[k], load)
        runs[k].append((first, n))
        return k

    def scored(rest: np.ndarray) -> np.ndarray:
        """Less is better; rest: what the item would leave of each capacity."""
        if capacity.rule == "dot":
            return -((rest + item) * unit) @ (item * unit)
        return np.linalg.norm(rest * unit, axis=1)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        item = np.array([length, 1, length * length], np.int64)
        if np.any((item > full) & limited):
            raise ValueError(f"a piece of {length} tokens fits no empty sequence")
        rank, left = 0, histogram[length]
        tracked = np.where(limited, item, 0)
        rest = full - used[: len(runs)] - item
        at = np.flatnonzero(np.all((rest >= 0) | ~limited, axis=1))
        best = sorted(zip(scored(rest[at]).tolist(), at.tolist(), strict=True))  # a sorted list is a heap
        while left:
            while best and not (runs[best[0][1]] and scored((full - used[best[0][1]] - item)[None])[0] == best[0][0]):
                heappop(best)  # its bins have gone or have changed
            if best:
                k = best[0][1]
                load = tuple(int(x) for x in used[k] + tracked)
                first, n = runs[k].pop()
                m = min(n, left)
                if m < n:
                    runs[k].append((first + m, n - m))
                if not runs[k]:
                    used[k] = NONE  # an empty kind takes nothing
                offset = load[0] - length
            else:  # new sequences, each filled with as many of this length as fit
                load, first, offset = tuple(int(x) for x in tracked), sequences, 0
                each = capacity.tokens // length
                if capacity.documents is not None:
                    each = min(each, capacity.documents)
                if capacity.attention is not None:
                    each = min(each, capacity.attention // (length * length))
                m = -(-left // max(each, 1))
                m = min(m, left)
                sequences += m
            out.append((length, rank, m, first, offset))
            k = put(load, first, m)
            rest = full - used[k] - item
            if np.all((rest >= 0) | ~limited):
                heappush(best, (float(scored(rest[None])[0]), k))
            rank, left = rank + m, left - m
    return out


def pack(cut: DataFrame, capacity: Capacity = Capacity(), salts: int | None = None) -> DataFrame:
    """Adds sequence_id and offset to rows (doc_id, piece, length, ...): gapless from 0 in each sequence.

    Rows of equal doc_id and piece (repeated documents) are packed as items of their own. An empty
    table gives an empty result. Null doc_ids are packed like others; pieces of one length, doc_id and number
    are alike, so which of them goes where is open. Other columns are kept, whatever their names. The histogram, of at most
    `tokens` rows, is all that the driver reads. salts: parts that a length's pieces are counted in, by default
    one for 32,768 pieces, 64 at least.
    """
    cut = durable(cut)
    salts = salts or max(64, cut.count() >> 15)
    salt, inner, earlier, rank = unused(cut.columns, "_salt", "_in", "_before", "_rank")
    names = cut.columns
    cut = cut.withColumn(salt, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = cut.groupBy("length", salt).agg(F.count("*").alias("n"))
    before = counts.select("length", salt, (F.sum("n").over(Window.partitionBy("length").orderBy(salt)) - F.col("n")).alias(earlier))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, capacity)
    at: dict[int, list] = {}
    for length, first_rank, _, first, offset in rows:
        at.setdefault(length, []).append((first_rank, first, offset))
    places = cut.sparkSession.sparkContext.broadcast({k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in at.items()})
    ranked = (
        cut.withColumn(inner, F.row_number().over(Window.partitionBy("length", salt).orderBy("doc_id", "piece")).cast("long") - 1)
        .join(durable(before), ["length", salt])
        .select(*names, (F.col(inner) + F.col(earlier)).alias(rank))
    )

    def one(b: pa.RecordBatch) -> pa.Table:
        lengths, ranks = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", rank))
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for length in np.unique(lengths):
            here = lengths == length
            ranks_at, first, offsets = places.value[int(length)]
            k = np.searchsorted(ranks_at, ranks[here], side="right") - 1
            sequence[here] = first[k] + ranks[here] - ranks_at[k]
            offset[here] = offsets[k]
        made = {c: b.column(b.schema.get_field_index(c)) for c in names}
        return pa.table(made | {"sequence_id": sequence, "offset": offset})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*names).schema) + ", sequence_id long, offset long"
    return by_batch(ranked, one, schema)


def pack_documents(docs: DataFrame, path: str, capacity: Capacity = Capacity(), keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every document.

    Null and empty texts are one piece of the end id alone; texts of any length are read whole. Repeated rows
    are packed each. Extra columns are left aside.
    """
    return pack(pieces(docs, path, capacity.tokens, END, keep_ids, doc_id, text), capacity)
