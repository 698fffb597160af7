"""Near-duplicate vectors by collision-counting projections.

Unit vectors are projected on many random lines. A single line separates little, so a window over a
whole sorted line holds a constant share of all rows; lines are therefore read in groups: rows meet
where they fall into the same slab of every line of a group. Within a meeting the lines of a further
family are sorted, each row's window (centred on it) is laid over every sorted line, and collisions are
counted for each pair. Pairs that pass the count are verified by their cosine in double precision. Slab
width, number of groups and the count follow from the wanted recall for a pair just at the threshold. A
larger table has more lines a group, so that meetings of unrelated vectors don't grow with it.

A pair that meets in several groups is counted in the first only, so numbers of links add up without a
list of pairs, and each meeting passes on a linear number of links for the classes. Equal vectors are
one row with a weight. A meeting of many rows is dealt out as tasks of two parts each.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import lru_cache
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import by_batch, durable, partitions
from siftstone.llm.components import components
from siftstone.llm.vectors import matrix, takes_part, unit, vectors

TASK = 1 << 15  # rows that one task is dealt


@dataclass(frozen=True)
class Settings:
    """lines: of a group, for tables up to `rows`; slab: their width; recall: wanted at the threshold; counted: lines of the counting family."""

    threshold: float = 0.9
    lines: int = 8
    rows: int = 1 << 16
    slab: float = 2.0
    recall: float = 0.985
    counted: int = 24
    window: float = 1.0
    part: int = 2048
    seed: int = 11

    @property
    def spread(self) -> float:
        """Standard deviation of the distance on a line of two unit vectors at the threshold."""
        return sqrt(max(2 - 2 * self.threshold, 1e-9))

    def for_rows(self, n: int) -> Settings:
        """So many more lines a group for a larger table that unrelated vectors share a slab of all as seldom; recall is as before."""
        apart = sqrt(2.0)
        x = self.slab / apart
        same = erf(x / sqrt(2)) - sqrt(2 / pi) / x * (1 - exp(-x * x / 2))
        return replace(self, lines=self.lines + max(0, ceil(log(max(n, 1) / self.rows) / -log(same))))

    @property
    def groups(self) -> int:
        """Enough groups that a pair at the threshold meets with the wanted probability."""
        x = self.slab / self.spread
        same = erf(x / sqrt(2)) - sqrt(2 / pi) / x * (1 - exp(-x * x / 2))
        n, missed = 0, 1.0
        while missed > 1 - self.recall:
            n, missed = n + 1, missed * (1 - same**self.lines)
        return n

    @property
    def least_count(self) -> int:
        """Largest count that a pair at the threshold reaches with probability 0.999 at least."""
        p, n = erf(self.window / self.spread / sqrt(2)), self.counted
        below, c, term = 0.0, 0, (1 - p) ** n
        while c < n and below + term <= 0.001:
            below += term
            term *= (n - c) / (c + 1) * p / max(1 - p, 1e-12)
            c += 1
        return c


@lru_cache(maxsize=4)
def _lines(d: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    meet = rng.standard_normal((d, s.groups * s.lines))
    shift = rng.uniform(0, s.slab, s.groups * s.lines)
    return meet, shift, rng.standard_normal((d, s.counted))


def cells(x: np.ndarray, s: Settings) -> np.ndarray:
    """A 64-bit number of the slabs that each unit vector falls into, for each group."""
    meet, shift, _ = _lines(x.shape[1], s)
    slab = np.floor((x @ meet + shift) / s.slab).astype(np.int64).reshape(len(x), s.groups, s.lines)
    out = np.full((len(x), s.groups), 1469598103934665603, np.uint64)
    for i in range(s.lines):
        out = (out ^ (slab[:, :, i] & 0xFFFF).astype(np.uint64)) * np.uint64(1099511628211)
    return out.view(np.int64)


def _counted(lines: np.ndarray, left: np.ndarray, right: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a in left, b in right) whose windows collide on enough lines."""
    orders = np.argsort(lines[right], axis=0, kind="stable")
    sorted_lines = np.take_along_axis(lines[right], orders, axis=0)
    place = np.empty_like(orders)  # of each row on each sorted line
    np.put_along_axis(place, orders, np.arange(len(right))[:, None], axis=0)
    place = place.T.astype(np.uint16 if len(right) < 1 << 16 else np.uint64)  # unsigned, so that one comparison tells a run's both ends
    found = []
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        count = np.zeros((len(rows), len(right)), np.uint8)
        for k in range(s.counted):  # each row's window covers a run of the sorted line
            lo = np.searchsorted(sorted_lines[:, k], lines[rows, k] - s.window, "left").astype(place.dtype)
            hi = np.searchsorted(sorted_lines[:, k], lines[rows, k] + s.window, "right").astype(place.dtype)
            count += (place[k][None, :] - lo[:, None]) < (hi - lo)[:, None]
        a, b = np.nonzero(count >= s.least_count)
        found.append((rows[a], right[b]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _links(ids: np.ndarray, x: np.ndarray, codes: np.ndarray, lines: np.ndarray, left: np.ndarray, right: np.ndarray, group: int, s: Settings):
    """Verified pairs of two parts of a meeting that meet in no earlier group."""
    a, b = _counted(lines, left, right, s)
    keep = ids[a] < ids[b] if left is right else ids[a] != ids[b]
    a, b = a[keep], b[keep]
    if group:
        keep = ~(codes[a, :group] == codes[b, :group]).any(axis=1)
        a, b = a[keep], b[keep]
    near = [np.einsum("ij,ij->i", x[a[i : i + 65536]], x[b[i : i + 65536]]) >= s.threshold for i in range(0, len(a), 65536)]
    keep = np.concatenate(near) if near else np.zeros(0, bool)
    return a[keep], b[keep]


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the least place that links reach."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        if (root[a] == root[b]).all():
            return root


def near_duplicates(rows: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, zero or hold null or non-finite components, and vectors of another length than
    their partner, link with nothing. Rows of a null vec_id are kept and link with nothing. Rows of a
    repeated vec_id are vectors of their own: each has its links, and its class's least vec_id. Extra columns
    are left aside; an empty table gives an empty result.
    """
    base = vectors(rows, vec_id, embedding)
    part = F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))
    # Two hashes of 64 bits name a vector; equal vectors are one node with a weight.
    named = base.filter(part).select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    same = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    same = durable(same.withColumn("d", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()))
    s = settings.for_rows(same.count())

    def coded(b: pa.RecordBatch):
        d = b.column(3).to_numpy()
        for n in np.unique(d):
            take = b.take(pa.array(np.flatnonzero(d == n)))
            yield take, cells(unit(matrix(take.column(2), int(n))), s)

    def listed(b: pa.RecordBatch) -> pa.Table:
        """Codes alone, a row for each vector and group."""
        out = [pa.table({"d": np.repeat(t.column(3).to_numpy(), s.groups), "g": pa.array(np.tile(np.arange(s.groups), t.num_rows), pa.int32()), "cell": code.ravel()}) for t, code in coded(b)]
        return pa.concat_tables(out)

    def meet(b: pa.RecordBatch) -> pa.Table:
        out = []
        for t, code in coded(b):
            for g in range(s.groups):
                out.append(pa.table({"node": t.column(0), "weight": t.column(1), "embedding": t.column(2), "d": t.column(3), "g": pa.array([g] * t.num_rows, pa.int32()), "cell": code[:, g]}))
        return pa.concat_tables(out)

    source = same.select("node", "weight", "embedding", "d")
    kind = source.schema["embedding"].dataType.simpleString()
    key = ["d", "g", "cell"]
    sizes = durable(by_batch(source, listed, "d int, g int, cell long").groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").withColumn("parts", F.ceil(F.col("n") / s.part).cast("int")))
    keyed = by_batch(source, meet, f"node long, weight long, embedding {kind}, d int, g int, cell long")
    crowded = keyed.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = crowded.withColumn("other", F.explode(every)).withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))

    def found(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).to_numpy()
        ids, weights, d, part = (column(c) for c in ("node", "weight", "d", "part"))
        links = np.zeros(len(ids), np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
        meeting = table.select(["d", "g", "cell", "lo", "hi"]).to_pandas().groupby(["d", "g", "cell", "lo", "hi"]).indices
        for n in np.unique(d):
            of = np.flatnonzero(d == n)
            x = np.zeros((len(ids), int(n)))
            x[of] = unit(matrix(table.column("embedding").take(pa.array(of)), int(n)))
            codes, lines = cells(x, s), x @ _lines(int(n), s)[2]
            for (m, g, _, lo, hi), at in meeting.items():
                if m != n:
                    continue
                left = at[part[at] == lo]
                right = left if lo == hi else at[part[at] == hi]
                a, b = _links(ids, x, codes, lines, left, right, int(g), s)
                np.add.at(links, a, weights[b])
                np.add.at(links, b, weights[a])
                pairs.append((a, b))
        to = _joined(len(ids), *(np.concatenate(p) for p in zip(*pairs, strict=True)))
        keep = (links > 0) | (to != np.arange(len(ids)))
        return pa.table({"node": ids[keep], "links": links[keep], "other": ids[to][keep]})

    work = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("parts")), F.lit(0))).first()[0]
    task = F.pmod(F.xxhash64(*key, "lo", "hi"), F.lit(max(4 * partitions(rows.sparkSession), work // TASK)))
    linked = durable(dealt.groupBy(task.alias("task")).applyInArrow(found, "node long, links long, other long"))
    number = linked.groupBy("node").agg(F.sum("links").alias("links"))
    class_of = components(linked.filter("node <> other"), "node", "other")
    per_node = durable(
        same.select("node", "h1", "h2", "least", "weight").join(number, "node", "left").join(class_of, "node", "left")
        .select("h1", "h2", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("c"))
    )
    least = per_node.groupBy("c").agg(F.min("least").alias("component_id"))
    result = named.select("vec_id", "h1", "h2").join(per_node.join(least, "c").select("h1", "h2", "n_links", "component_id"), ["h1", "h2"])
    rest = base.filter(~part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.select("vec_id", "n_links", "component_id").unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
