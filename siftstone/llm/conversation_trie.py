"""Prefix trie of conversations by Patricia construction.

Conversations are cut into spans of 64 turns, so that no row or task has to hold a whole one. A span
starts at a node that stands for all turns before it; spans of one start are sorted by their turns, and
common prefixes of neighbours give a compressed tree: only branch, end and leaf points, with edges
between them. Sorted spans are dealt out by ranges; a task learns from the prefixes at the borders of
its range (one row a task) at which depths others branch off its first and last path. Sums are taken
over the compressed tree, and nodes with one child come back by suffix sums along its edges.

A node is known by the XOR of hashes of its turns and their places, two of 64 bits. With n members of W
words in all, b words a member before the node and D words in the distinct nodes of its subtree, what
sharing saves in the subtree is W - n * b - D: every part of it is a plain sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.llm.common import durable, partitions

SPAN, BLOCK, CHUNK = 64, 1024, 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def earlier(rows: DataFrame, key: str, block: str, order: list, sums: dict[str, tuple[Callable, str, Callable]]) -> DataFrame:
    """rows and, for each name, the aggregate of a column over all earlier rows of the key, 0 if there are none.

    sums: name -> (aggregate, column, how two aggregates join). Rows meet within their block only;
    blocks meet as one row each.
    """
    inner = Window.partitionBy(key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    each = rows.groupBy(key, block).agg(*(agg(c).alias(f"_{n}") for n, (agg, c, _) in sums.items()))
    before = each.select(key, block, F.row_number().over(Window.partitionBy(key).orderBy(block)).alias("_at"), *(agg(f"_{n}").over(outer).alias(f"_{n}") for n, (agg, _, _) in sums.items()))
    within = rows.withColumns({n: F.coalesce(agg(c).over(inner), F.lit(0)) for n, (agg, c, _) in sums.items()})
    joined = within.join(before.filter("_at > 1").drop("_at"), [key, block], "left")
    return joined.withColumns({n: join(F.col(n), F.coalesce(F.col(f"_{n}"), F.lit(0))) for n, (_, _, join) in sums.items()}).drop(*(f"_{n}" for n in sums))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def in_order(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): each turn's place from 0, a 128-bit digest of role and text, and its words.

    Turns go in order of turn, null first, equal ones by their digest; null role or text is empty; rows
    of a null conv_id belong to no conversation.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    t = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    t = t.withColumns({"block": F.coalesce(F.expr(f"turn div {SPAN}"), F.lit(-1 << 62)), "one": F.lit(1).cast("long")})
    placed = earlier(t, "conv_id", "block", [F.col("turn").asc_nulls_first(), "key"], {"pos": (F.sum, "one", _plus)})
    return placed.select("conv_id", "pos", "key", "words")


def with_openings(t: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, pos, key, words) of conversations that open like others, and a row without key for each conversation.

    Conversation c starts with the first h turns of conversation c - c % every (all if it has fewer, none
    if there is no such conversation), h being crc32(c) % most, and goes on with its own after its first h.
    """
    lead = F.col("conv_id") - F.col("conv_id") % every
    openings = t.filter((F.col("conv_id") == lead) & (F.col("pos") < most - 1)).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("opening"))
    h = F.when(F.col("conv_id") == lead, F.lit(0)).otherwise(F.crc32(F.col("conv_id").cast("string")) % most)
    convs = t.select("conv_id").distinct().select("conv_id", lead.alias("lead"), h.alias("h"))
    convs = convs.join(openings.withColumnRenamed("conv_id", "lead"), "lead", "left")
    taken = F.coalesce(F.filter("opening", lambda x: x["pos"] < F.col("h")), F.slice("opening", 1, 0), F.array())
    convs = durable(convs.select("conv_id", "h", taken.alias("taken")))
    own = t.join(convs.select("conv_id", "h", F.size("taken").alias("n")), "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "key", "words")
    opening = convs.select("conv_id", F.inline("taken")).select("conv_id", "pos", "key", "words")
    return own.unionByName(opening).unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"), F.lit(0).alias("words")))


def spans_of(letters: DataFrame, span: int) -> DataFrame:
    """A row for each conversation and span: its turns, the nodes where it starts and ends, words before it and in all, and whether more follow."""
    there = F.col("key").isNotNull()
    x, y = F.when(there, F.xxhash64("pos", "key")), F.when(there, F.xxhash64("key", "pos"))
    one = letters.withColumns({"x": x, "y": y, "k": F.expr(f"pos div {span}")}).groupBy("conv_id", "k").agg(
        F.array_sort(F.collect_list(F.when(there, F.struct("pos", "x", "y", "words")))).alias("turns"),
        F.coalesce(F.bit_xor("x"), F.lit(0)).alias("dx"), F.coalesce(F.bit_xor("y"), F.lit(0)).alias("dy"), F.sum(F.col("words").cast("long")).alias("dw"),
    )
    one = one.withColumns({"turns": F.transform("turns", lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"), s["words"].alias("w"))), "block": F.expr(f"k div {BLOCK}")})
    started = earlier(one, "conv_id", "block", ["k"], {"sx": (F.bit_xor, "dx", _xor), "sy": (F.bit_xor, "dy", _xor), "before": (F.sum, "dw", _plus)})
    whole = one.groupBy("conv_id").agg(F.max("k").alias("last"), F.sum("dw").alias("total"))
    return started.join(whole, "conv_id").select(
        "conv_id", "k", "turns", "sx", "sy", _xor(F.col("sx"), F.col("dx")).alias("ex"), _xor(F.col("sy"), F.col("dy")).alias("ey"), "before", "total", (F.col("k") < F.col("last")).alias("more")
    )


def _common(a: tuple, b: tuple) -> int:
    """Turns that two spans have in common; -1 if they don't start at one node."""
    if a[0] != b[0]:
        return -1
    n = min(len(a[1]), len(b[1]))
    differ = np.flatnonzero((a[1][:n] != b[1][:n]) | (a[2][:n] != b[2][:n]))
    return int(differ[0]) if len(differ) else n


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """((sx, sy), x, y, words, the other columns) of each row."""
    for b in batches:
        turns = b.column("turns")
        flat, ends = turns.flatten(), np.cumsum(np.r_[0, turns.value_lengths().to_numpy(zero_copy_only=False)])
        x, y, w = (np.asarray(flat.field(i).to_numpy(zero_copy_only=False), np.int64) for i in range(3))
        for i, r in enumerate(b.drop_columns(["turns"]).to_pylist()):
            at = slice(ends[i], ends[i + 1])
            yield (r["sx"], r["sy"]), x[at], y[at], w[at], r


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What other tasks have to know of a sorted range: its first and last span, the least common prefix, and where its paths branch."""
    first = last = None
    low, left, right = SPAN * SPAN, [], []
    for row in _rows(batches):
        if last is None:
            first = row
        else:
            n = _common(last, row)
            if 0 <= n < low:
                right = [*right, n]
            low, left = min(low, n), [q for q in left if q < n] + [n] * (n >= 0)
            if low < 0:
                low = -1
        last = row
    if first is not None:
        side = lambda r: [{"x": [r[0][0], *r[1].tolist()], "y": [r[0][1], *r[2].tolist()]}]
        kind = pa.struct([("x", pa.list_(pa.int64())), ("y", pa.list_(pa.int64()))])
        ints = pa.list_(pa.int32())
        yield pa.record_batch({
            "id": pa.array([TaskContext.get().partitionId()], pa.int32()), "first": pa.array(side(first), kind), "last": pa.array(side(last), kind),
            "low": pa.array([low], pa.int32()), "left": pa.array([left], ints), "right": pa.array([right], ints),
        })


def borders(spans: DataFrame) -> dict[int, tuple[int, list[int], int, list[int]]]:
    """By range: turns in common with the span before it and depths of branches on its first path, and both for what follows its last."""
    side = "struct<x:array<long>,y:array<long>>"
    found = spans.select("sx", "sy", "turns").mapInArrow(_summaries, f"id int, first {side}, last {side}, low int, left array<int>, right array<int>").collect()
    found.sort(key=lambda r: r.id)
    ends = [tuple(((s.x[0], s.y[0]), np.array(s.x[1:], np.int64), np.array(s.y[1:], np.int64)) for s in (r.first, r.last)) for r in found]
    n = [-1, *(_common(a[1], b[0]) for a, b in zip(ends, ends[1:], strict=False)), -1]
    out = {r.id: [n[i], [], n[i + 1], []] for i, r in enumerate(found)}
    path: list[int] = []
    for i, r in enumerate(found):  # branches to the left, on the first path
        out[r.id][1] = path = [q for q in path if q < n[i]] + [n[i]] if n[i] >= 0 else []
        path = [q for q in path if q < r.low] + list(r.left)
    path = []
    for i, r in reversed(list(enumerate(found))):  # and to the right, on the last one
        out[r.id][3] = path = [q for q in path if q < n[i + 1]] + [n[i + 1]] if n[i + 1] >= 0 else []
        path = sorted({*r.right, *(q for q in path if q < r.low)})
    return {k: tuple(v) for k, v in out.items()}


class _Point:
    """A point on the current path; its sums are of what has been closed below it."""

    __slots__ = ("depth", "seen", "n", "conv_id", "total", "leaves", "distinct", "below")

    def __init__(self, depth: int, seen: bool = False):
        self.depth, self.seen = depth, seen  # seen: the task before has the edge above
        self.n = self.total = self.leaves = self.distinct = 0
        self.conv_id: int | None = None
        self.below: list[dict] = []  # where spans end that others follow

    def add(self, n: int, conv_id: int | None, total: int, leaves: int, distinct: int, below: list[dict]) -> None:
        self.n, self.total, self.leaves, self.distinct = self.n + n, self.total + total, self.leaves + leaves, self.distinct + distinct
        self.conv_id = conv_id if self.conv_id is None else self.conv_id if conv_id is None else min(self.conv_id, conv_id)
        self.below += below


POINT = pa.schema([
    ("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("px", pa.int64()), ("py", pa.int64()), ("rest", pa.list_(pa.int64())), ("before", pa.int64()),
    ("n", pa.int64()), ("conv_id", pa.int64()), ("total", pa.int64()), ("leaves", pa.int64()), ("distinct", pa.int64()), ("below", pa.list_(pa.struct([("x", pa.int64()), ("y", pa.int64())]))),
])
POINT_SQL = "depth long, x long, y long, px long, py long, rest array<long>, before long, n long, conv_id long, total long, leaves long, distinct long, below array<struct<x:long,y:long>>"


def _patricia(edges: dict[int, tuple], span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Points of a sorted range: a point goes out once the order has left its subtree. rest: suffix sums of words along its edge, without itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, left, follows, right = edges.get(TaskContext.get().partitionId(), (-1, [], -1, []))
        path: list[_Point] = []
        out: list[dict] = []
        last = None

        def close(to: int) -> None:
            """Points deeper than `to` go out; there is one at that depth then."""
            start, x, y, w, r = last[:5]
            while path and path[-1].depth > to:
                p = path.pop()
                if to >= 0 and path[-1].depth < to:
                    path.append(_Point(to, p.seen))
                up = path[-1].depth if path else -1
                words = w[max(up, 0) : p.depth]
                own, edge = (0, 0) if p.seen or not len(words) else (int(words[-1]), int(words.sum()))
                node = lambda d: (int(x[:d][-1]) if d else start[0], int(y[:d][-1]) if d else start[1])
                out.append(dict(zip(POINT.names, (
                    r["k"] * span + p.depth, *node(p.depth), *(node(up) if path else (None, None)), (words[::-1].cumsum()[::-1] - words[-1:]).tolist(),
                    r["before"] + int(w[: max(p.depth - 1, 0)].sum()), p.n, p.conv_id, p.total, p.leaves, p.distinct + own, p.below,
                ), strict=True)))
                if path:
                    path[-1].add(p.n, p.conv_id, p.total, p.leaves, p.distinct + edge, p.below)

        def settle(n: int) -> None:
            """The last span is a leaf unless it is a prefix of what follows, or goes on."""
            if not last[4]["more"] and n != len(last[1]):
                path[-1].leaves += 1

        for start, x, y, w, r in _rows(batches):
            row = (start, x, y, w, r)
            if last is None:
                path += [_Point(q, True) for q in sorted({0, *left})] if shared >= 0 else [_Point(0)]
            else:
                n = _common((last[0], last[5], last[6]), row)
                settle(n)
                close(n)
                if n < 0:
                    path.append(_Point(0))
            if len(x) > path[-1].depth:
                path.append(_Point(len(x)))
            path[-1].add(r["n"], r["conv_id"], r["total"], 0, 0, [{"x": r["ex"], "y": r["ey"]}] if r["more"] else [])
            # Hashes of the nodes on the path, and the turns themselves for the next comparison.
            last = (start, np.bitwise_xor.accumulate(x) ^ start[0], np.bitwise_xor.accumulate(y) ^ start[1], w, r, x, y)
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, POINT)
                out.clear()
        if last is not None:
            settle(follows)
            for q in right:
                at = next((i for i, p in enumerate(path) if p.depth >= q), len(path))
                if at == len(path) or path[at].depth > q:
                    path.insert(at, _Point(q, at < len(path) and path[at].seen))
            close(-1)
            yield pa.RecordBatch.from_pylist(out, POINT)

    return run


def ends_of(conversations: DataFrame) -> DataFrame:
    """(x, y, ends_sha256): the digest of the ids that end at a node, ascending and comma-joined.

    The digest of a list is one stream by definition. Ids are sorted by ranges and joined to pieces of up
    to CHUNK ids; then pieces of a node go through one task in order, which holds one piece at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, c = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.r_[True, (np.diff(x) != 0) | (np.diff(y) != 0)]) if len(x) else []
            cuts = [i for a, e in zip(cuts, [*cuts[1:], len(x)], strict=True) for i in range(a, e, CHUNK)]
            texts = [",".join(map(str, c[a:e].tolist())) for a, e in zip(cuts, [*cuts[1:], len(x)], strict=True)]
            yield pa.record_batch({"x": x[cuts], "y": y[cuts], "least": c[cuts], "ids": pa.array(texts, pa.string())}) if texts else pa.record_batch({"x": x, "y": y, "least": c, "ids": pa.array([], pa.string())})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, schema = None, None, pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
        for b in batches:
            done = []
            for x, y, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (x, y) != at:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = (x, y), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True) if done else ([], [], []), schema, strict=True)], schema=schema)
        if at:
            yield pa.RecordBatch.from_pylist([{"x": at[0], "y": at[1], "ends_sha256": state.hexdigest()}], schema)

    n = partitions(conversations.sparkSession)
    sorted_ids = conversations.repartitionByRange(n, "x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id")
    pieces = sorted_ids.mapInArrow(joined, "x long, y long, least long, ids string")
    return pieces.repartition(n, "x", "y").sortWithinPartitions("x", "y", "least").mapInArrow(hashed, "x long, y long, ends_sha256 string")


def deeper(points: DataFrame, spans: DataFrame) -> DataFrame:
    """(x, y, leaves, distinct) to add to points above the end of a span that others follow: what lies under that end.

    Sums of the spans that start at a node are credited to the least conversation through it; what lies
    under a node is then the sum, over the conversations through it, of their credits from there on.
    """
    starts = spans.filter("k > 0").select("conv_id", "k", F.col("sx").alias("x"), F.col("sy").alias("y"))
    within = points.filter("px IS NULL AND depth > 0").groupBy("x", "y").agg(F.sum("leaves").alias("leaves"), F.sum("distinct").alias("distinct"))
    credit = starts.groupBy("x", "y").agg(F.min("conv_id").alias("conv_id")).join(within, ["x", "y"])
    each = starts.join(credit, ["x", "y", "conv_id"], "left").fillna(0, ["leaves", "distinct"]).withColumns({"back": -F.col("k"), "block": F.expr(f"-(k div {BLOCK})")})
    ahead = earlier(each, "conv_id", "block", ["back"], {"more_leaves": (F.sum, "leaves", _plus), "more_distinct": (F.sum, "distinct", _plus)})
    under = ahead.groupBy(F.col("x").alias("bx"), F.col("y").alias("by")).agg(F.sum(F.col("leaves") + F.col("more_leaves")).alias("leaves"), F.sum(F.col("distinct") + F.col("more_distinct")).alias("distinct"))
    pairs = points.filter("px IS NOT NULL OR depth = 0").select("x", "y", F.explode("below").alias("b")).select("x", "y", F.col("b.x").alias("bx"), F.col("b.y").alias("by"))
    return pairs.join(under, ["bx", "by"]).groupBy("x", "y").agg(F.sum("leaves").alias("more_leaves"), F.sum("distinct").alias("more_distinct"))


def nodes(letters: DataFrame, span: int = SPAN) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every trie node.

    letters: (conv_id, pos, key, words) with places from 0 without gaps, and a row of null key and pos 0 for
    each conversation, which keeps those without turns. No conversations give no nodes.
    """
    n = partitions(letters.sparkSession)
    spans = durable(spans_of(letters, span))
    # Equal spans are one row; which node a span ends at tells all turns before it too.
    rows = spans.groupBy("k", "ex", "ey").agg(
        F.first("sx").alias("sx"), F.first("sy").alias("sy"), F.first("turns").alias("turns"), F.first("before").alias("before"),
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("total"), F.max("more").alias("more"),
    )
    rows = durable(rows.repartitionByRange(n, "sx", "sy", "turns").sortWithinPartitions("sx", "sy", "turns"))
    points = durable(rows.mapInArrow(_patricia(borders(rows), span), POINT_SQL))
    # A point on the border of two ranges has sums from both.
    merged = points.filter("px IS NOT NULL OR depth = 0").groupBy("x", "y").agg(
        F.first("depth").alias("depth"), F.first("px").alias("px"), F.first("py").alias("py"), F.first("rest").alias("rest"), F.first("before").alias("before"),
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("total"), F.sum("leaves").alias("leaves"), F.sum("distinct").alias("distinct"),
    )
    merged = durable(merged.join(deeper(points, spans), ["x", "y"], "left"))
    children = merged.filter("px IS NOT NULL").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("children"))
    ends = ends_of(spans.filter("NOT more").select(F.col("ex").alias("x"), F.col("ey").alias("y"), "conv_id"))
    above = merged.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("above"))
    saved = F.col("total") - F.col("n") * F.col("before") - F.col("distinct") - F.coalesce("more_distinct", F.lit(0))
    whole = merged.join(above, ["px", "py"], "left").join(children, ["x", "y"], "left").join(ends, ["x", "y"], "left")
    edge = whole.select("*", saved.alias("saved"), F.posexplode(F.when(F.size("rest") > 0, F.col("rest")).otherwise(F.array(F.lit(0).cast("long")))).alias("i", "along"))
    m = F.greatest(F.size("rest"), F.lit(1))
    end = F.col("i") == m - 1
    return edge.select(
        "conv_id", (F.col("depth") - m + 1 + F.col("i")).alias("depth"), F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(end, F.coalesce("children", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_children"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("along")).alias("saved_tokens"),
        F.when(end, F.coalesce("ends_sha256", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, every: int = 20, most: int = 4, span: int = SPAN) -> DataFrame:
    """Nodes of the trie of conversations with shared openings (`with_openings`, `nodes`).

    Turns are ordered by `in_order`, where nulls, ties and repeated rows have their place; extra columns
    are left aside. Each distinct sequence of first turns (role, text) is a node, from the textless root.
    """
    return nodes(with_openings(durable(in_order(turns)), every, most), span)
