"""Seeded samples, splits, caps and shards, by hash order and so alike on every cluster."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.operators.rows import bounds, range_of, ranked_within
from siftstone.sources.scratch import once


def order_of(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    return rows.orderBy(order_of(key, seed), key).limit(n)


def first(rows: DataFrame, n: int, key: str) -> DataFrame:
    return rows.orderBy(key).limit(n)


def cap_per_class(rows: DataFrame, label: str, caps: dict[int, int], key: str, seed: int = 42, salts: int = 32) -> DataFrame:
    """At most caps[c] rows of class c, those of least hash; rows of other classes go.

    Each of many parts of a class keeps its least rows first, so no task orders a whole class.
    """
    limit = F.coalesce(*[F.when(F.col(label) == c, F.lit(n)) for c, n in caps.items()])
    by = [order_of(key, seed), F.col(key)]
    some = rows.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(salts)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy(label, "_s").orderBy(*by))).filter(F.col("_r") <= limit)
    ranked = some.withColumn("_r", F.row_number().over(Window.partitionBy(label).orderBy(*by)))
    return ranked.filter(F.col("_r") <= limit).select(*rows.columns)


def split(rows: DataFrame, share: float, key: str, seed: int = 42) -> DataFrame:
    """Adds part: "valid" for the rows of least hash, a `share` of all and at least one, else "train"."""
    n = max(1, int(share * rows.count()))
    edge = sample(rows.select(key), n, key, seed).agg(F.max(F.struct(order_of(key, seed).alias("h"), F.col(key).alias("k"))).alias("e"))
    here = F.struct(order_of(key, seed).alias("h"), F.col(key).alias("k"))
    return rows.crossJoin(F.broadcast(edge)).withColumn("part", F.when(here <= F.col("e"), "valid").otherwise("train")).drop("e")  # one row


def shards(rows: DataFrame, n: int, key: str) -> DataFrame:
    """Adds shard: contiguous blocks of ceil(rows / n) rows in key order; rows of equal keys in any order.

    Ranks come from counts of ranges of the key, whose bounds are read once, then from order within a
    range: no task holds all rows, and every run gives the same shards.
    """
    per = max(1, -(-rows.count() // n))
    parts = max(n, 8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.withColumn("_p", range_of(F.col(key), bounds(rows, key, parts)))
    sizes = {r["_p"]: r["n"] for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect()}  # a row a range
    before, at = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(at)]
        at += sizes[p]
    offset = F.element_at(F.create_map(*before), F.col("_p")) if before else F.lit(0)
    numbered = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(key)))
    return numbered.withColumn("shard", F.floor((F.col("_i") - 1 + offset) / per).cast("int")).select(*rows.columns, "shard")


def cap_checked(rows: DataFrame, n: int, key: str, check: Callable[[DataFrame], DataFrame], seed: int = 42, first_rate: float = 0.8) -> DataFrame:
    """The n rows of least hash among those that an expensive check lets pass; few others are checked.

    check(rows) gives the rows that pass, with their columns. Rows are ranked once; batches of them, in order, are
    checked until n have passed, each batch as large as the share that has passed so far makes it likely to
    need (a tenth more, and at least twice what is missing after an empty batch). Without n rows that pass, all
    that pass are returned. Null and repeated keys are rows like others.
    """
    by = rows.withColumns({"_order": F.concat(order_of(key, seed), F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit(""))), "_all": F.lit(0)})
    ranked = once(ranked_within(by, "_all", "_order", "_rank"))
    total, at, passed, found = ranked.count(), 0, 0, []
    while at < total and passed < n:
        rate = passed / at if at and passed else first_rate / (1 + at)
        size = max(1, min(total - at, int((n - passed) / rate * 1.1) + 1, max(2 * at, int(2 * n / first_rate))))
        batch = ranked.filter((F.col("_rank") >= at) & (F.col("_rank") < at + size))
        good = once(check(batch.select(*rows.columns, "_rank")).select(*rows.columns, "_rank"))
        found.append(good)
        passed += good.count()
        at += size
    if not found:
        return ranked.select(*rows.columns).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.orderBy("_rank").limit(n).select(*rows.columns)
