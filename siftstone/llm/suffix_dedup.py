"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of `length` bytes that covers it also starts in a document of smaller id.

Whole corpora do not fit one suffix array, so strings are first dealt out so that equal ones meet. In
every window of `length` bytes the gram of least hash is the string's anchor; equal strings have equal
anchors. Anchors that occur in one document only are dropped after a first exchange of their hashes. A
run of starts with one anchor is a context: the bytes that its strings cover. Equal contexts are combined,
first within a batch of documents (the larger ids lose theirs there) and then within a shard, where each
stands once, for its least document; a context that is alone with its anchor then meets no other string.
A shard's contexts are
taken in parts of its anchors, so what a worker makes of them at a time is bounded.
All other contexts of a part are sorted as suffix arrays of bounded size: sorting refines groups by doubling (Larsson-Sadakane), common prefixes are taken in one pass in text order
(Kasai), and the arrays' strings are merged two by two by binary search of those of one in the other. What
is removed follows from the least document of each string. Contexts of an anchor met in very many documents
are cut into single strings, dealt out by their first and last bytes. Shards are as many as the bytes need.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siftstone.llm.common import by_batch, partitions, raw_texts, trim, unused

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PLACE = np.uint64(22)  # bits of a place within a step of `_STEP` positions
_STEP = 1 << 17
BUCKET = 8 << 20  # bytes of text for which there is a bucket


@dataclass(frozen=True)
class Settings:
    """gram: of the anchors; crowd: documents beyond which an anchor's contexts are cut up; array: bytes of one suffix array; part: bytes of contexts looked up at a time."""

    length: int = 50
    gram: int = 20
    crowd: int = 5000
    array: int = 1 << 21
    part: int = 1 << 20


def _words(a: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as little-endian numbers."""
    b, out = a.tobytes(), np.empty(max(len(a) - 7, 0), np.uint64)
    for r in range(min(8, len(out))):
        n = len(out[r::8])
        out[r::8] = np.frombuffer(b, "<u8", n, r)
    return out


def _grams(a: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k (8 at least) bytes from each position."""
    w, n = _words(a), len(a) - k + 1
    h = w[:n] * _M[0]
    h ^= h >> np.uint64(29)
    for at in [*range(8, k - 7, 8), *([k - 8] if k % 8 else [])]:
        h += w[at : at + n]
        h *= _M[1]
        h ^= h >> np.uint64(31)
    h *= _M[2]
    h ^= h >> np.uint64(30)
    return h


def anchors(whole: bytes, sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first start, end of starts) of the runs of starts with one anchor in texts of the given sizes.

    whole: the texts put together; places are counted in it. A short text has no start.
    """
    parts = []
    wide = s.length - s.gram + 1
    ends = np.cumsum(sizes)
    flat = np.frombuffer(whole, np.uint8)
    for at in range(0, max(len(whole) - s.length + 1, 0), _STEP):
        h = _grams(flat[at : at + _STEP + s.length - 1], s.gram)
        key = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
        least, w = key, 1
        while 2 * w <= wide:
            least = np.minimum(least[:-w], least[w:])
            w *= 2
        n = len(key) - wide + 1
        if w < wide:
            least = np.minimum(least[:n], least[wide - w : wide - w + n])
        own = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        new = np.r_[True, own[1:] != own[:-1]]
        new[ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + n)] - at] = True  # a text begins
        first = np.flatnonzero(new)
        text = np.searchsorted(ends, first + at, "right")
        end = np.minimum(np.append(first[1:], n) + at, ends[text] - s.length + 1)  # what reaches into the next text is no string
        inside = end > first + at
        parts.append((text[inside], h[own[first[inside]]], first[inside] + at, end[inside]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def _alike(whole: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, head): the pieces of whole in an order that brings equal ones together, those of a kind as they came, and where each kind begins.

    Pieces are ordered by a hash; equal bytes decide.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    wide = -(-int(size.max()) // 8) * 8
    flat = np.frombuffer(whole if at.max() + wide <= len(whole) else whole + bytes(wide), np.uint8)
    piece = np.lib.stride_tricks.sliding_window_view(flat, wide)[at]
    piece[np.arange(wide) >= size[:, None]] = 0
    words = piece.view(np.uint64)
    h = size.astype(np.uint64) * _M[2]
    for k in range(words.shape[1]):
        h ^= words[:, k]
        h *= _M[k % 2]
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    h = h[order]
    head = np.r_[True, h[1:] != h[:-1]]
    same = np.flatnonzero(~head)
    a, b = order[same], order[same - 1]
    head[same] = (size[a] != size[b]) | (words[a] != words[b]).any(axis=1)
    return order, head


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions sorted by the bytes from each to the end; groups that agree so far are sorted by the ranks behind."""
    n = len(text)
    key = _words(np.concatenate([text, np.zeros(7, np.uint8)]))[:n].byteswap()
    sa = np.argsort(key)
    k = key[sa]
    head = np.r_[True, k[1:] != k[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    h = 8
    while True:
        size = np.diff(np.append(np.flatnonzero(head), n))
        open_ = np.flatnonzero(np.repeat(size > 1, size))  # places in groups that are still unsorted
        if not len(open_):
            break
        p = sa[open_]
        after = np.where(p + h < n, rank[np.minimum(p + h, n - 1)], n - p - h - 1)  # suffixes that end here: shorter first
        both = rank[p] * (n + h + 2) + (after + h + 1)  # one number for the group and what comes behind
        order = np.argsort(both)
        sa[open_] = p = p[order]
        both = both[order]
        split = np.r_[True, both[1:] != both[:-1]]
        head[open_] |= split
        rank[p] = open_[np.maximum.accumulate(np.where(split, np.arange(len(p)), 0))] + 1
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int, run: int = 16) -> np.ndarray:
    """For each place of the array, the common prefix with the place before it, `depth` at most.

    Kasai's pass: a position's prefix is at least that of the position before it less one, so comparison goes
    on from there. The text is cut into runs of positions, which are passed over side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    w = _words(np.concatenate([text, np.zeros(depth + 8, np.uint8)]))
    lcp = np.zeros(n, np.int64)
    h = np.zeros(-(-n // run), np.int64)
    for k in range(run):
        at = np.arange(k, n, run)
        last = before[at]
        h = np.where(last >= 0, np.maximum(h[: len(at)] - 1, 0), 0)
        live = np.flatnonzero((last >= 0) & (h < depth))
        while len(live):
            x = w[at[live] + h[live]] ^ w[last[live] + h[live]]
            h[live] += np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3  # equal bytes before the first that differs
            live = live[(x == 0) & (h[live] < depth)]
        h = np.minimum(h, np.where(last >= 0, np.minimum(n - np.maximum(at, last), depth), 0))
        lcp[at] = h
    return lcp[sa]


def _sorted_strings(contexts: list[bytes], starts: np.ndarray, docs: np.ndarray, length: int):
    """One suffix array: the distinct strings of its contexts in order, the least document of each, and the string of each start."""
    sizes = np.array([len(c) for c in contexts])
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    owner = np.full(len(text), -1, np.int64)
    each = _spread(base, starts)
    owner[each] = np.repeat(np.arange(len(contexts)), starts)
    sa = suffix_array(text)
    group = np.cumsum(common_prefixes(text, sa, length) < length)
    of = np.empty(len(text), np.int64)
    of[sa] = group
    mine, group = owner[each], of[each]
    met = np.zeros(group.max(initial=0) + 1, bool)
    met[group] = True
    string = (np.cumsum(met) - 1)[group]
    least = np.full(int(met.sum()), np.iinfo(np.int64).max)
    np.minimum.at(least, string, docs[mine])
    at = np.empty(len(least), np.int64)
    at[string] = each
    strings = np.lib.stride_tricks.sliding_window_view(text, length)[at].copy().view(f"S{length}").ravel()
    return strings, least, string


def _merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays' strings in order, each once, with its least document: the strings of one are sought in the other."""
    if not len(x[0]) or not len(y[0]):
        return x if len(x[0]) else y
    k = np.searchsorted(x[0], y[0])
    same = x[0][np.minimum(k, len(x[0]) - 1)] == y[0]
    least = x[1].copy()
    least[k[same]] = np.minimum(least[k[same]], y[1][same])
    return np.insert(x[0], k[~same], y[0][~same]), np.insert(least, k[~same], y[1][~same])


def least_documents(contexts: list[bytes], starts: np.ndarray, docs: np.ndarray, s: Settings) -> np.ndarray:
    """For each start of each context, in order, the least document that holds its string: by suffix arrays of bounded size, merged two by two."""
    shards, at, size = [], [0], 0
    for i, c in enumerate(contexts):
        if size and size + len(c) > s.array:
            at.append(i)
            size = 0
        size += len(c)
    at.append(len(contexts))
    for a, b in zip(at, at[1:], strict=False):
        shards.append(_sorted_strings(contexts[a:b], starts[a:b], docs[a:b], s.length))
    level = [(x[0], x[1]) for x in shards]
    while len(level) > 1:
        level = [_merged(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    strings, least = level[0]
    return np.concatenate([least[np.searchsorted(strings, x[0])][x[2]] if len(shards) > 1 else x[1][x[2]] for x in shards])


def parts_of(keys: np.ndarray, sizes: np.ndarray, s: Settings) -> list[np.ndarray]:
    """The places of contexts by parts of their keys, about `part` bytes in each; contexts of one key, which alone may meet, stay together."""
    n = -(-int(sizes.sum()) // s.part)
    if n < 2:
        return [np.arange(len(keys))]
    part = (keys.astype(np.uint64) * np.uint64(n) >> np.uint64(32)).astype(np.int64)  # keys are hashes of 32 bits
    order = np.argsort(part, kind="stable")
    return [x for x in np.split(order, np.searchsorted(part[order], np.arange(1, n))) if len(x)]


def least_of_kinds(
    whole: bytes, keys: np.ndarray, counts: np.ndarray, docs: np.ndarray, s: Settings, at: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, first, number, least): the kind of each context, and for each kind the place and number of its starts in least, the least documents of their strings.

    whole: the contexts put together, or what holds them at the given places; keys: of their anchors. Equal contexts are a kind and are looked up once, for their
    least document. Equal strings have equal keys, so a kind that is alone with its key has no string of another kind;
    all others go into the suffix arrays.
    """
    sizes = counts - 1 + s.length
    at = np.cumsum(sizes) - sizes if at is None else at
    order, head = _alike(whole, at, sizes)
    begin = np.flatnonzero(head)
    one, doc = order[begin], np.minimum.reduceat(docs[order], begin)
    by_key = np.argsort(keys[one], kind="stable")
    kind = np.empty(len(order), np.int64)
    place = np.empty(len(one), np.int64)
    place[by_key] = np.arange(len(one))
    kind[order] = place[np.cumsum(head) - 1]
    one, doc = one[by_key], doc[by_key]
    number = counts[one]
    first = np.cumsum(number) - number
    least = np.repeat(doc, number)
    new = keys[one[1:]] != keys[one[:-1]]
    met = np.flatnonzero(~(np.r_[True, new] & np.r_[new, True]))
    if len(met):
        parts = [whole[a : a + n] for a, n in zip(at[one[met]].tolist(), sizes[one[met]].tolist(), strict=True)]
        least[_spread(first[met], number[met])] = least_documents(parts, number[met], doc[met], s)
    return kind, first, number, least


def _split_counts(docs: np.ndarray, hashes: np.ndarray, kind: str) -> pa.Table:
    """Rows (doc_id, hashes) from parallel arrays, without a Python object for each."""
    order = np.argsort(docs, kind="stable")
    docs, hashes = docs[order], hashes[order]
    at = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[at, len(docs)].astype(np.int32)), pa.array(hashes.view(np.int32)))
    return pa.table({"doc_id": docs[at], kind: lists})


def spans(
    docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", carry: str | None = None,
    then: Callable[[pa.Table], pa.Table] | None = None, shape: Callable[[StructField], StructType] | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, starts array<long>, ends array<long>, z binary, carried): removed runs in order, z the text packed by zstd.

    carry: a column of any type to hand on with each row. then: what to make of these rows in the same task, which then has one
    Python worker instead of two; shape: the fields of what it makes, given that of carried.

    Repeated doc_ids never take from each other (neither is smaller) but take alike from smaller ones; a null
    doc_id neither takes nor gives.
    """
    s = settings
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = min(max(partitions(spark, 32), size // BUCKET), 1 << 19)
    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (F.col(carry) if carry else F.lit(None).cast("string")).alias("carried"))
    carried = StructField("carried", t.schema["carried"].dataType)
    fields = lambda ddl: StructType([*StructType.fromDDL(ddl).fields, carried])
    t = t.withColumn("h", F.xxhash64("text"))  # tells rows of one doc_id apart

    def hashed(b: pa.RecordBatch) -> pa.Table:
        texts = raw_texts(b.column(1))
        row, h, _, _ = anchors(b"".join(texts), np.array([len(x) for x in texts]), s)
        # Shard, row of the batch (fewer than 4096) and what is sent of the hash are one number: sorted, each once.
        k = np.sort((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(44) | row.astype(np.uint64) << np.uint64(32) | h & np.uint64(0xFFFFFFFF))
        k = k[np.r_[True, k[1:] != k[:-1]]] if len(k) else k
        bucket, h = (k >> np.uint64(44)).astype(np.int64), k.astype(np.uint32)
        d = b.column(0).to_numpy()[(k >> np.uint64(32) & np.uint64(0xFFF)).astype(np.int64)]
        rows: list[list] = [[], [], [], []]
        for k, a, e in zip(*_groups(bucket), strict=True):
            own = np.flatnonzero(np.r_[True, d[a + 1 : e] != d[a : e - 1]])
            rows[0].append(int(k))
            rows[1].append(_small(d[a:e][own]))
            rows[2].append(_small(np.diff(np.append(own, e - a)).astype(np.int32)))
            rows[3].append(h[a:e].tobytes())
        return pa.table({"bucket": pa.array(rows[0], pa.int32()), "docs": pa.array(rows[1], pa.binary()), "counts": pa.array(rows[2], pa.binary()), "hashes": pa.array(rows[3], pa.binary())})

    def shared(table: pa.Table) -> pa.Table:
        docs_, counts, hashes = (table.column(c).to_pylist() for c in ("docs", "counts", "hashes"))
        d = np.concatenate([np.repeat(_large(x, np.int64), _large(c, np.int32)) for x, c in zip(docs_, counts, strict=True)])
        h = np.concatenate([np.frombuffer(x, np.uint32) for x in hashes])
        order = np.argsort(h)
        h, d = h[order], d[order]
        at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.append(at, len(h)))
        size = np.repeat(size, size)
        many = size > s.crowd
        some = _split_counts(d[size > 1], h[size > 1], "shared")
        hot = _split_counts(d[many], h[many], "hot")
        kind = pa.list_(pa.int32())
        trim()
        return pa.concat_tables(
            [some.append_column("hot", pa.nulls(len(some), kind)), pa.table({"doc_id": hot.column(0), "shared": pa.nulls(len(hot), kind), "hot": hot.column(1)})]
        ).cast(pa.schema([("doc_id", pa.int64()), ("shared", kind), ("hot", kind)]))

    packed = by_batch(t.filter("doc_id IS NOT NULL").select("doc_id", "text"), hashed, "bucket int, docs binary, counts binary, hashes binary")
    lists = packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(shared, "doc_id long, shared array<int>, hot array<int>")
    lists = lists.groupBy("doc_id").agg(F.flatten(F.collect_list("shared")).alias("shared"), F.flatten(F.collect_list("hot")).alias("hot"))

    def zipped(b: pa.RecordBatch) -> pa.Table:
        z = zstandard.ZstdCompressor(level=1)
        made = {"doc_id": b.column(0), "h": b.column(1), "z": pa.array([z.compress(x) for x in raw_texts(b.column(2))], pa.binary())}
        return pa.table(made | ({"carried": b.column(3)} if b.num_columns > 3 else {}))

    def contexts(b: pa.RecordBatch) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        ids, prints = b.column(0).to_numpy(), b.column(1).to_numpy()
        texts = [unzip.decompress(z) for z in b.column(2).to_pylist()]
        whole, lengths = b"".join(texts), np.array([len(x) for x in texts])
        del texts
        base = np.cumsum(lengths) - lengths
        row, h, first, end = anchors(whole, lengths, s)
        low = row << 32 | (h & np.uint64(0xFFFFFFFF)).astype(np.int64)

        def among(low: np.ndarray, lists: pa.ListArray) -> np.ndarray:
            return np.isin(low, np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy()) << 32 | lists.flatten().to_numpy().view(np.uint32).astype(np.int64))

        some = among(low, b.column(3))
        row, h, first, n, low = row[some], h[some], first[some], (end - first)[some], low[some]
        crowded = among(low, b.column(4))
        size, doc = n - 1 + s.length, ids[row]
        order, head = _alike(whole, first, size)
        least = np.minimum.reduceat(doc[order], np.flatnonzero(head)) if len(order) else doc
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(head) - 1
        local = doc > least[kind]
        # A document's own repeats are looked up once and share the answer.
        mine = order[~local[order]]
        lead = np.r_[True, (kind[mine][1:] != kind[mine][:-1]) | (row[mine][1:] != row[mine][:-1])] if len(mine) else np.zeros(0, bool)
        origin = mine[np.maximum.accumulate(np.where(lead, np.arange(len(mine)), 0))][~lead]
        twin = mine[~lead]
        by_row = np.argsort(twin)
        twin, origin = twin[by_row], origin[by_row]
        sent = np.sort(mine[lead])
        cut = sent[crowded[sent]]
        sent = sent[~crowded[sent]]
        made = [x for i in cut.tolist() for x in _cut(whole, int(first[i]), int(n[i]), int(row[i]), s.length)]
        extra = [np.array(c, k) for c, k in zip(zip(*made, strict=True) if made else ((), (), ()), (np.uint64, np.int64, np.int64), strict=True)]
        key, who, at = (np.concatenate(x) for x in ((h[sent], extra[0]), (row[sent], extra[1]), (first[sent], extra[2])))
        m = np.concatenate([n[sent], np.ones(len(made), np.int64)])
        bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, key, who, at, m = bucket[order], key[order].astype(np.uint32), who[order], at[order], m[order]
        pieces = [whole[a:e] for a, e in zip(at.tolist(), (at + m - 1 + s.length).tolist(), strict=True)]
        rows = [{"bucket": k, "keys": _small(key[a:e]), "counts": _small(m[a:e].astype(np.int16)), "docs": _small(ids[who[a:e]]), "prints": _small(prints[who[a:e]]),
                 "at": _small((at - base[who])[a:e]), "bytes": zstandard.compress(b"".join(pieces[a:e]), 1)} for k, a, e in zip(*_groups(bucket), strict=True)]
        own = np.flatnonzero(local)
        a, e = first[own], (first + size)[own]
        new = np.r_[True, (a[1:] > e[:-1]) | (row[own][1:] != row[own][:-1])] if len(own) else np.zeros(0, bool)
        a, e, of = a[new], e[np.r_[new[1:], True]] if len(own) else e, row[own][new]
        runs = np.stack([a - base[of], e - base[of]], axis=1)
        again = np.stack([first[origin] - base[row[origin]], first[twin] - base[row[twin]], size[twin]], axis=1)
        edges, edges_of_twins = (np.searchsorted(x, np.arange(len(ids) + 1)) for x in (of, row[twin]))
        for k in np.flatnonzero((np.diff(edges) > 0) | (np.diff(edges_of_twins) > 0)).tolist():
            rows.append({"bucket": -1 - int(ids[k]) % buckets, "doc_id": int(ids[k]), "h": int(prints[k]), "local": _small(runs[edges[k] : edges[k + 1]]), "twins": _small(again[edges_of_twins[k] : edges_of_twins[k + 1]])})
        kind = pa.schema([(n, getattr(pa, k)()) for n, k in _MIXED])
        return pa.table({n: [r.get(n) for r in rows] for n, _ in _MIXED}, schema=kind)

    wanted = t.filter("doc_id IS NOT NULL").select("doc_id", "h", "text")
    joined = by_batch(wanted, zipped, "doc_id long, h long, z binary").join(lists.filter(F.size("shared") > 0), "doc_id")
    mixed = by_batch(joined.select("doc_id", "h", "z", "shared", "hot"), contexts, ", ".join(f"{n} {_SQL[k]}" for n, k in _MIXED))

    def compared(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:  # runs that are settled already
            none = pa.nulls(len(table), pa.list_(pa.int64()))
            return pa.table({"doc_id": table.column("doc_id"), "h": table.column("h"), "a": none, "e": none, "local": table.column("local"), "twins": table.column("twins")})
        keys, counts, docs_, prints, at = (np.concatenate([_large(x, d) for x in table.column(c).to_pylist()]) for c, d in (("keys", np.uint32), ("counts", np.int16), ("docs", np.int64), ("prints", np.int64), ("at", np.int64)))
        counts = counts.astype(np.int64)
        whole = b"".join([*(zstandard.decompress(x) for x in table.column("bytes").to_pylist()), bytes(2 * s.length)])  # windows of the last contexts end inside
        sizes = counts - 1 + s.length
        inside = np.cumsum(sizes) - sizes

        def removed(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            kind, first, number, least = least_of_kinds(whole, keys[own], counts[own], docs_[own], s, inside[own])
            furthest, nearest = np.maximum.reduceat(least, first), np.minimum.reduceat(least, first)
            all_ = furthest[kind] < docs_[own]
            part = np.flatnonzero(~all_ & (nearest[kind] < docs_[own]))  # some of their strings only
            who = np.repeat(own[part], number[kind[part]])
            gone = least[_spread(first[kind[part]], number[kind[part]])] < docs_[who]
            start = _spread(at[own[part]], number[kind[part]])
            edge = np.r_[True, who[1:] != who[:-1]] if len(who) else np.zeros(0, bool)
            opens = gone & (edge | ~np.r_[False, gone[:-1]][: len(gone)])
            closes = gone & (np.r_[edge[1:], True][: len(gone)] | ~np.r_[gone[1:], False][: len(gone)])
            all_ = own[all_]
            return np.concatenate([all_, who[opens]]), np.concatenate([at[all_], start[opens]]), np.concatenate([at[all_] + sizes[all_], start[closes] + s.length])

        who, a, e = (np.concatenate(x) for x in zip(*map(removed, parts_of(keys, sizes, s)), strict=True))
        del whole
        order = np.lexsort((a, prints[who], docs_[who]))
        who, a, e = who[order], a[order], e[order]
        first = np.flatnonzero(np.r_[True, (docs_[who][1:] != docs_[who][:-1]) | (prints[who][1:] != prints[who][:-1])]) if len(who) else np.zeros(0, np.int64)
        edges = pa.array(np.r_[first, len(who)].astype(np.int32))
        trim()
        none = pa.nulls(len(first), pa.binary())
        return pa.table({"doc_id": docs_[who[first]], "h": prints[who[first]], "a": pa.ListArray.from_arrays(edges, pa.array(a)), "e": pa.ListArray.from_arrays(edges, pa.array(e)), "local": none, "twins": none})

    # Boxes and settled runs are read once, by the same exchange, so nothing of them is kept beside it.
    runs = mixed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(compared, "doc_id long, h long, a array<long>, e array<long>, local binary, twins binary")
    per_row = runs.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("a")).alias("a"), F.flatten(F.collect_list("e")).alias("e"), F.collect_list("local").alias("local"), F.collect_list("twins").alias("twins"))
    final = by_batch(t.select("doc_id", "h", "text", "carried"), zipped, fields("doc_id long, h long, z binary")).join(per_row, ["doc_id", "h"], "left")

    def joined_runs(b: pa.RecordBatch) -> pa.Table:
        starts, ends, sizes = [], [], []
        for z, a, e, local, twins in zip(b.column(1).to_pylist(), b.column(3), b.column(4), b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True):
            sizes.append(zstandard.frame_content_size(z))
            mine = list(zip(a.values.to_pylist(), e.values.to_pylist(), strict=True)) if a.is_valid else []
            found = list(mine)
            if twins:
                mine.sort()
                begins, longest = [p for p, _ in mine], max((q - p for p, q in mine), default=0)
            for x in local or []:
                found += [tuple(r) for r in _large(x, np.int64).reshape(-1, 2).tolist()]
            for x in twins or []:
                for lo, to, size in _large(x, np.int64).reshape(-1, 3).tolist():
                    # only runs of strings of this context move with it
                    near = mine[bisect_left(begins, lo + s.length - longest) : bisect_right(begins, lo + size - s.length)]
                    found += [(max(p, lo) + to - lo, min(q, lo + size) + to - lo) for p, q in near if min(q, lo + size) - max(p, lo) >= s.length]
            found = _join(found)
            starts.append([p for p, _ in found])
            ends.append([q for _, q in found])
        kind = pa.list_(pa.int64())
        return pa.table({"doc_id": b.column(0), "n_bytes": pa.array(sizes, pa.int64()), "starts": pa.array(starts, kind), "ends": pa.array(ends, kind), "z": b.column(1), "carried": b.column(2)})

    rows = final.select("doc_id", "z", "carried", "a", "e", "local", "twins")
    if then:
        return by_batch(rows, lambda b: then(joined_runs(b)), shape(carried))
    return by_batch(rows, joined_runs, fields("doc_id long, n_bytes long, starts array<long>, ends array<long>, z binary"))


def _small(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def _large(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


_MIXED = [("doc_id", "int64"), ("h", "int64"), ("local", "binary"), ("twins", "binary"), ("bucket", "int32"), ("keys", "binary"),
          ("counts", "binary"), ("docs", "binary"), ("prints", "binary"), ("at", "binary"), ("bytes", "binary")]
_SQL = {"int32": "int", "int64": "long", "binary": "binary", "string": "string"}


def _groups(x: np.ndarray) -> tuple[list, list, list]:
    if not len(x):
        return [], [], []
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return x[at].tolist(), at.tolist(), np.append(at[1:], len(x)).tolist()


def _cut(whole: bytes, at: int, n: int, row: int, length: int):
    """(key, row, place) of a context's strings one by one, keyed by their first and last bytes."""
    for i in range(at, at + n):
        x = whole[i : i + length]
        yield int.from_bytes(hashlib.blake2b(x[:16] + x[-16:], digest_size=8).digest(), "little"), row, i


def _join(runs: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, e in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [tuple(x) for x in out]


def _kept(z: bytes, starts: list[int], ends: list[int]) -> bytes:
    x, at, out = zstandard.ZstdDecompressor().decompress(z), 0, []
    for a, e in zip(starts, ends, strict=True):
        out.append(x[at:a])
        at = e
    return b"".join([*out, x[at:]])


def digests(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; a null or empty text has no bytes.

    Rows of one doc_id keep what no smaller doc_id has, and a null doc_id keeps all. Texts of any length are
    read whole. Extra columns are left aside, whatever their names; an empty table gives an empty result.
    """

    def one(b: pa.Table) -> pa.Table:
        starts, ends = b.column(2).to_pylist(), b.column(3).to_pylist()
        sha = [hashlib.sha256(_kept(z, a, e)).hexdigest() for z, a, e in zip(b.column(4).to_pylist(), starts, ends, strict=True)]
        removed = [sum(e) - sum(a) for a, e in zip(starts, ends, strict=True)]
        return pa.table({"doc_id": b.column(0), "n_bytes": b.column(1), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array([len(a) for a in starts], pa.int64()), "kept_sha256": sha})

    made = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return spans(docs, settings, doc_id, text, then=one, shape=lambda carried: made)


def remaining(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with what is left of each text, other columns as they were; a character cut in two becomes nothing, a null text empty."""
    rest = [c for c in docs.columns if c not in (doc_id, text)]
    (carry,) = unused(docs.columns, "_carried")
    packed = docs.withColumn(carry, F.struct(*rest) if rest else F.lit(None).cast("string"))

    def one(b: pa.Table) -> pa.Table:
        starts, ends = b.column(2).to_pylist(), b.column(3).to_pylist()
        left = [_kept(z, a, e).decode("utf-8", "ignore") for z, a, e in zip(b.column(4).to_pylist(), starts, ends, strict=True)]
        return pa.table({"doc_id": b.column(0), "text": pa.array(left, pa.string()), "carried": b.column(5)})

    left = spans(packed, settings, doc_id, text, carry, one, lambda carried: StructType([*StructType.fromDDL("doc_id long, text string").fields, carried]))
    own = {doc_id: F.col("doc_id").cast(docs.schema[doc_id].dataType), text: F.col("text")}
    return left.select(*[(own[c] if c in own else F.col("carried")[c]).alias(c) for c in docs.columns])
