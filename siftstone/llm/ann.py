"""Nearest vectors by largest cosine: four-bit codes with a score-aware loss, table scans, exact reranking within proved bounds.

Each component of a unit vector is coded by one of sixteen levels of its dimension. Levels and codes are
fitted to an anisotropic loss: the part of the residual along the vector itself, which moves the inner
product with near queries most, costs `parallel` times as much as the part across it. Levels are fitted
on a bounded sample; every distinct vector is coded, and its distance from its code kept beside it. A bounded
number of queries at a time is sent to all tasks, which scan their codes, two a byte, by table look-ups. A cosine
exceeds its score in codes by no more than that distance, so a vector is left aside only if it can't be among a query's
nearest, and all others are reranked on the original vectors in the same task: what is found is exact for any rows.
A task returns a few nodes a query; copies come in with their ids at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from siftstone.llm.common import by_batch, by_task, durable
from siftstone.llm.vectors import matrix, unit, valid


@dataclass(frozen=True)
class Settings:
    """sample: vectors that levels are fitted on, those of least hash; rerank: vectors of a block whose exact cosines are
    taken first, so that fewer of the others can still be nearer; queries: that are sent to every task at once."""

    top: int = 5
    sample: int = 16384
    parallel: float = 4.0
    rounds: int = 6
    rerank: int = 32
    queries: int = 32768


class Codes:
    """Sixteen levels a dimension, fitted to unit vectors."""

    def __init__(self, x: np.ndarray, s: Settings):
        self.parallel, d = s.parallel, x.shape[1]
        self.levels = np.quantile(x, (np.arange(16) + 0.5) / 16, axis=0).T.copy()  # d x 16
        for _ in range(s.rounds):
            code = self.code(x)
            near = np.stack([self.levels[j, code[:, j]] for j in range(d)], axis=1)
            along = ((x - near) * x).sum(axis=1)
            for j in range(d):
                # least squares of a level under the loss, the other dimensions held: a gradient step with exact curvature
                r, xj = x[:, j] - near[:, j], x[:, j]
                pull = np.bincount(code[:, j], r + (self.parallel - 1) * along * xj, 16)
                push = np.bincount(code[:, j], 1 + (self.parallel - 1) * xj * xj, 16)
                step = np.where(push > 0, pull / np.maximum(push, 1e-12), 0)
                self.levels[j] += step
                moved = step[code[:, j]]
                near[:, j] += moved
                along -= moved * xj
            self.levels.sort(axis=1)

    def code(self, x: np.ndarray) -> np.ndarray:
        """The nearest levels, then for each dimension in turn the level of least anisotropic loss."""
        d = x.shape[1]
        code = np.stack([np.abs(x[:, j, None] - self.levels[j]).argmin(axis=1) for j in range(d)], axis=1)
        near = np.stack([self.levels[j, code[:, j]] for j in range(d)], axis=1)
        along = ((x - near) * x).sum(axis=1)
        for j in range(d):
            rest = along - (x[:, j] - near[:, j]) * x[:, j]
            r = x[:, j, None] - self.levels[j]
            loss = r * r + (self.parallel - 1) * (rest[:, None] + r * x[:, j, None]) ** 2
            code[:, j] = loss.argmin(axis=1)
            near[:, j] = self.levels[j, code[:, j]]
            along = rest + (x[:, j] - near[:, j]) * x[:, j]
        return code.astype(np.uint8)

    def pack(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, two a byte; for each unit vector how much a cosine with it may exceed its score at most)."""
        code, d = self.code(x), x.shape[1]
        away = np.sqrt(((x - self.levels[np.arange(d), code]) ** 2).sum(axis=1))
        reach = away + (d + 4) * 2.0**-22 * (1 + away)  # and what sums in single precision may lose
        if d % 2:
            code = np.hstack([code, np.zeros((len(code), 1), np.uint8)])
        return code[:, ::2] | code[:, 1::2] << 4, np.nextafter(reach.astype(np.float32), np.float32(np.inf))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query and byte of a code, the score of each of its 256 values: queries x bytes x 256."""
        one = q[:, :, None] * self.levels[None]
        if one.shape[1] % 2:
            one = np.concatenate([one, np.zeros((len(q), 1, 16))], axis=1)
        return (one[:, 1::2, :, None] + one[:, ::2, None, :]).reshape(len(q), -1, 256).astype(np.float32)


def nearest(rows: DataFrame, is_query, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query(column) selects, its nearest other rows.

    Vectors null, zero or with null or non-finite components take no part; vectors of another length than
    the query's are no candidates of it. Rows of a query's own vec_id are never its candidates; of repeated
    vec_ids one row of the least vector takes part. Ties go to the smaller vec_id. Fewer candidates than
    wanted give them all; an empty table gives an empty result. Extra columns are left aside.
    """
    s = settings
    ok = valid(rows, vec_id, embedding).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # Two hashes of 64 bits name a vector; copies are scanned once.
    ok = durable(ok.withColumns({"d": F.size("embedding"), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")}))
    nodes = durable(ok.groupBy("h1", "h2").agg(F.first("embedding").alias("embedding"), F.first("d").alias("d")).withColumn("node", F.monotonically_increasing_id()))
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")  # of copies, the least ids that a query may want: one may be its own
    ids = ok.select("h1", "h2", "vec_id", F.row_number().over(first).alias("r")).filter(F.col("r") <= s.top + 1)
    ids = durable(ids.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("node", "vec_id", "r"))
    nodes = nodes.join(ids.filter("r = 1").select("node", F.col("vec_id").alias("least")), "node")
    sizes = {r["d"]: r["n"] for r in ok.filter(is_query(F.col("vec_id"))).groupBy("d").agg(F.count("*").alias("n")).collect()}  # a row for each vector length
    out = None
    for d, n in sorted(sizes.items()):
        here = nodes.filter(F.col("d") == d).select("node", "embedding", "least")
        sample = here.orderBy(F.xxhash64("embedding"), "node").limit(s.sample).select("embedding").toArrow()
        codes = rows.sparkSession.sparkContext.broadcast(Codes(unit(matrix(sample.column(0), d)), s))  # d x 16 numbers
        coded = durable(_coded(here, codes, d))
        asked = ok.filter(is_query(F.col("vec_id")) & (F.col("d") == d)).select("vec_id", "embedding")
        parts = -(-n // s.queries)
        for k in range(parts):  # so many queries at once as every task can hold; one part up to `queries`
            some = asked if parts == 1 else asked.filter(F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(parts)) == k)
            got = _answered(some, coded, ids, codes, d, s)
            out = got if out is None else out.unionByName(got)
    if out is None:
        return ok.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return out


def _coded(nodes: DataFrame, codes, d: int) -> DataFrame:
    """(nodes, least, codes, reach, vectors): blocks of nodes, a row for each batch."""
    kind = np.float32 if nodes.schema["embedding"].dataType.elementType == FloatType() else np.float64

    def block(b: pa.RecordBatch) -> pa.Table:
        x = matrix(b.column(1), d)
        packed, reach = codes.value.pack(unit(x))
        parts = {"nodes": b.column(0).to_numpy(), "least": b.column(2).to_numpy(), "codes": packed, "reach": reach, "vectors": x.astype(kind)}
        return pa.table({k: pa.array([v.tobytes()], pa.binary()) for k, v in parts.items()})

    return by_batch(nodes, block, "nodes binary, least binary, codes binary, reach binary, vectors binary")


def _answered(asked: DataFrame, coded: DataFrame, ids: DataFrame, codes, d: int, s: Settings) -> DataFrame:
    table = asked.orderBy("vec_id").toArrow()  # about s.queries rows
    q_ids, q = table.column(0).to_numpy(), unit(matrix(table.column(1), d)) if len(table) else np.zeros((0, d))
    shared = asked.sparkSession.sparkContext.broadcast((q_ids, q))
    kept = s.top + 1  # of nodes: one may be the query's own

    def scan(batches):
        """The nearest nodes of all blocks of a task for each query, by exact cosine and then least id."""
        q_ids, q = shared.value
        best_score, best, best_id = np.full((len(q_ids), kept), -np.inf), np.full((len(q_ids), kept), -1, np.int64), np.full((len(q_ids), kept), np.iinfo(np.int64).max)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                node, least, reach = (np.frombuffer(x, kind) for x, kind in zip((row[0], row[1], row[3]), (np.int64, np.int64, np.float32), strict=True))
                packed = np.frombuffer(row[2], np.uint8).reshape(len(node), -1).T.copy()
                u = unit(np.frombuffer(row[4], np.float32 if len(row[4]) == 4 * d * len(node) else np.float64).reshape(-1, d).astype(float))

                def rerank(k: int, who: np.ndarray) -> None:
                    exact = np.concatenate([best_score[k], np.einsum("ij,j->i", u[who], q[k])])
                    name, first = np.concatenate([best[k], node[who]]), np.concatenate([best_id[k], least[who]])
                    keep = np.lexsort((first, -exact))[:kept]
                    best_score[k], best[k], best_id[k] = exact[keep], name[keep], first[keep]

                for at in range(0, len(q_ids), 64):
                    tables = codes.value.tables(q[at : at + 64])
                    for i in range(len(tables)):
                        k, most = at + i, reach.copy()
                        for j, byte in enumerate(packed):
                            most += tables[i, j][byte]
                        over = np.flatnonzero(most >= best_score[k, -1])
                        if len(over) > s.rerank:
                            front = np.argpartition(-most[over], s.rerank)[: s.rerank]
                            rerank(k, over[front])
                            over = np.delete(over, front)
                            over = over[most[over] >= best_score[k, -1]]
                        if len(over):
                            rerank(k, over)
        found = best >= 0
        if found.any():
            columns = [np.repeat(q_ids, found.sum(axis=1)), best[found], best_id[found], best_score[found]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "node", "least", "score"])

    scored = by_task(coded, scan, "query_id long, node long, least long, score double")
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "least")
    near = scored.withColumn("k", F.row_number().over(top)).filter(F.col("k") <= kept).select("query_id", "node", "score")
    each = near.join(ids.select("node", "vec_id"), "node").filter("vec_id <> query_id")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= s.top).select("query_id", "rank", "vec_id", "score")
