"""Compression of vectors to codes of sixteen parts, with partial-distance search of the nearest entries.

A codebook of a part is small and goes to every task; sums and counts of an assignment come back as
at most one row a part and entry. The search takes the dimensions of a part in descending variance of
its codebook and blocks of entries one after the other; an entry leaves the search of a row as soon as
its integer distance so far strictly exceeds the row's best complete distance, so ties stay until the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from siftstone.llm.common import by_batch, by_task, durable
from siftstone.llm.vectors import matrix


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64
    scale: int = 256
    rounds: int = 2
    block: int = 16  # entries searched before a row's best distance is brought up to date


def searched(x: np.ndarray, book: np.ndarray, block: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry of each row, the lower one of equals; whole numbers throughout."""
    order = np.argsort(-book.var(axis=0), kind="stable")
    x, book, n = x[:, order], book[:, order], len(x)
    # The first complete distance: the entry that is nearest in the leading dimension.
    by = np.argsort(book[:, 0], kind="stable")
    right = np.searchsorted(book[by, 0], x[:, 0]).clip(0, len(by) - 1)
    left = (right - 1).clip(0)
    entry = by[np.where(np.abs(x[:, 0] - book[by[left], 0]) <= np.abs(x[:, 0] - book[by[right], 0]), left, right)]
    best = ((x - book[entry]) ** 2).sum(axis=1)
    for first in range(0, len(book), block):
        some = book[first : first + block]
        so_far = (x[:, :1] - some[:, 0]) ** 2
        row, of = np.nonzero(so_far <= best[:, None])
        so_far = so_far[row, of]
        for k in range(1, x.shape[1]):
            so_far = so_far + (x[row, k] - some[of, k]) ** 2
            stay = so_far <= best[row]
            row, of, so_far = row[stay], of[stay], so_far[stay]
        if len(row):  # rows ascend, and within a row entries do
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(so_far, starts)
            at = row[starts]
            tied = np.where(so_far == np.repeat(least, np.diff(np.append(starts, len(row)))), first + of, np.iinfo(np.int64).max)
            lowest = np.minimum.reduceat(tied, starts)
            nearer, same = least < best[at], least == best[at]
            entry[at] = np.where(nearer, lowest, np.where(same, np.minimum(entry[at], lowest), entry[at]))
            best[at] = least
    return entry, best


def _whole(column: pa.Array, d: int, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(column, d)).astype(np.int64)


def taking_part(rows: DataFrame, s: Settings, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, int]:
    """((vec_id, embedding, label) of the rows that are coded, their length); the length is 0 if there are none."""
    of = rows.schema[embedding].dataType
    single = of in (ArrayType(FloatType(), True), ArrayType(FloatType(), False))
    out = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("embedding"), F.col(label).alias("label"))
    x = F.col("embedding")
    n = F.size(x)
    # Squared distances of n components below 2^29 / sqrt(n) fit 64 bits.
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(float(1 << 29)) / F.sqrt(n) / s.scale))
    out = out.filter(F.coalesce(x.isNotNull() & ~odd & (n > 0) & (n % s.parts == 0), F.lit(False)))
    first = out.select(n.alias("n"), "vec_id").orderBy(F.col("vec_id").asc_nulls_last(), "n").limit(1).collect()
    d = first[0].n if first else 0
    return out.filter(n == d), d


def fitted(rows: DataFrame, d: int, s: Settings) -> np.ndarray:
    """Codebooks (parts, entries, dimensions of a part) after all rounds, by sums and counts of all rows."""
    few = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(s.entries).select("embedding").collect()
    start = np.floor(s.scale * np.array([r.embedding for r in few], float)).astype(np.int64)
    books = start.reshape(len(few), s.parts, d // s.parts).transpose(1, 0, 2).copy()
    for _ in range(s.rounds):

        def sums(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
            for b in batches:
                x = _whole(b.column(0), d, s.scale).reshape(-1, s.parts, d // s.parts)
                for part, book in enumerate(books):
                    entry, _ = searched(x[:, part], book, s.block)
                    np.add.at(total[part], entry, x[:, part])
                    count[part] += np.bincount(entry, minlength=len(book))
            part, entry = np.nonzero(count)
            yield pa.record_batch({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": count[part, entry], "total": pa.array(list(total[part, entry]), pa.list_(pa.int64()))})

        each = by_task(rows.select("embedding"), sums, "part int, entry int, n long, total array<long>")
        # A sum of components may pass 64 bits in very large tables; decimals hold it.
        grouped = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[k].cast("decimal(20,0)")).alias(f"t{k}") for k in range(d // s.parts)))
        books = books.copy()
        for r in grouped.collect():  # at most parts x entries rows
            books[r.part, r.entry] = [int(r[f"t{k}"]) // r.n for k in range(d // s.parts)]
    return books


def compress(
    rows: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row whose vector takes part.

    A component x becomes floor(scale * x). Codebooks start as the parts of the rows of smallest vec_id
    (equal ones by vector, null last) and are refined by `rounds` assignments of all rows; an entry that
    nothing is nearest to stays. code: two hex digits a part; error: the sum of squared distances;
    label_error: the errors of all rows of the label, null being one. Left out: vectors that are null,
    empty, hold null or non-finite components, aren't of the length of the smallest vec_id's, or whose
    length isn't a multiple of the parts, and those with a component so large that squared distances don't
    fit 64 bits (2^29 / (scale * sqrt(length)); 262,144 for 64 dimensions). Repeated rows are coded each; with fewer rows than
    entries, codebooks are that small. An empty table gives no rows; extra columns are left aside.
    """
    s = settings
    schema = "vec_id long, label " + rows.schema[label].dataType.simpleString() + ", code string, error long"
    part_in, d = taking_part(rows, s, vec_id, embedding, label)
    if not d:
        return rows.sparkSession.createDataFrame([], schema).select("vec_id", "code", "error", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = fitted(part_in, d, s)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    hexed = np.array([f"{k:02x}" for k in range(max(s.entries, 1))])

    def coded(b: pa.RecordBatch) -> pa.RecordBatch:
        x = _whole(b.column(1), d, s.scale).reshape(-1, s.parts, d // s.parts)
        code, error = np.full(len(x), "", dtype=f"<U{2 * s.parts}"), np.zeros(len(x), np.int64)
        for part, book in enumerate(books):
            entry, off = searched(x[:, part], book, s.block)
            code = np.char.add(code, hexed[entry])
            error += off
        return pa.record_batch({"vec_id": b.column(0), "label": b.column(2), "code": pa.array(code.tolist(), pa.string()), "error": error})

    codes = durable(by_batch(part_in, coded, schema))
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return codes.alias("c").join(by_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label"))).select(
        "c.vec_id", "c.code", "c.error", "l.label_error", F.lit(digest).alias("codebooks_sha256")
    )
