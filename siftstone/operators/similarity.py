"""64-bit perceptual hashes: packing, similarity, and matching with a library."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.sources.scratch import once

#: (width of a block in bits, bits that differ within it) of each round of `best_match`. Hashes that differ in at most
#: blocks * (bits + 1) - 1 bits agree in some block but for that many; the last rounds reach every distance.
ROUNDS = ((16, 0), (16, 1), *((8, k) for k in range(1, 9)))


def pack_bits(values: Column) -> Column:
    """Bit i, most significant first, is set where value i exceeds the median of the 64 values."""
    s = F.sort_array(values)
    # The median is the one element of an array, so that it is bound once and not worked out again for each bit.
    median = F.array((F.element_at(s, 32) + F.element_at(s, 33)) / 2)
    bits = lambda m: F.aggregate(
        values, F.lit(0).cast("long"), lambda h, v: F.call_function("shiftleft", h, F.lit(1)).bitwiseOR(F.when(v > m, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    )
    return F.element_at(F.transform(median, bits), 1)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def similarity(a: Column, b: Column) -> Column:
    return F.coalesce(1 - distance(a, b) / F.lit(64.0), F.lit(0.0))


def unsigned(h: Column) -> Column:
    return F.when(h < 0, h.cast("decimal(20,0)") + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(h.cast("decimal(20,0)"))


def signed(u: Column) -> Column:
    """A decimal from 0 to 2^64-1 as the long of the same bits."""
    return F.when(u >= F.lit("9223372036854775808").cast("decimal(20,0)"), u - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(u).cast("long")


def match_library(items: DataFrame, library: DataFrame, key: str, hash_: str = "phash", most: int = 1) -> DataFrame:
    """(key, library_similarity) of items with a library hash at most `most` bits away.

    most + 1 bands: two hashes that near agree on one band at least, so bands are equi-join keys.
    """
    n = most + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]

    def banded(df: DataFrame, h: str, *keep: str) -> DataFrame:
        def band(i: int) -> Column:
            width = cuts[i + 1] - cuts[i]
            x = F.call_function("shiftrightunsigned", F.col(h), F.lit(cuts[i]))
            return x if width == 64 else x.bitwiseAND(F.lit((1 << width) - 1))

        bands = F.array(*[F.struct(F.lit(i).alias("i"), band(i).alias("v")) for i in range(n)])
        return df.filter(F.col(h).isNotNull()).select(*keep, F.col(h).alias(f"_{h}"), F.explode(bands).alias("b")).select(*keep, f"_{h}", "b.i", "b.v")

    left = banded(items, hash_, key)
    right = banded(library.select(F.col("hash")).distinct(), "hash")
    near = left.join(right, ["i", "v"]).withColumn("d", distance(F.col(f"_{hash_}"), F.col("_hash"))).filter(F.col("d") <= most)
    return near.groupBy(key).agg((1 - F.min("d") / F.lit(64.0)).alias("library_similarity"))


def _blocks(h: str, width: int) -> Column:
    """Blocks of a hash as (i, v)."""
    part = lambda i: F.call_function("shiftrightunsigned", F.col(h), F.lit(width * i)).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
    return F.array(*[F.struct(F.lit(i).alias("i"), part(i).alias("v")) for i in range(64 // width)])


def best_match(items: DataFrame, library: DataFrame, key: str, hash_: str = "phash") -> DataFrame:
    """(key, best_similarity) of every item: the greatest similarity to any library hash, 0 for a null hash or an empty library.

    Multi-index hashing with a growing radius. Distinct hashes are cut into blocks; a round looks up each
    block's values that differ in so many bits, which finds every library hash up to a distance. A hash that
    has found one within it is settled and leaves; the others go on to the next round, and the last knows all.
    Candidates are reduced to the least distance where they are found. Repeated keys and rows keep their rows.
    """
    asked = once(items.filter(F.col(hash_).isNotNull()).select(F.col(hash_).alias("h")).distinct())
    known = once(library.filter(F.col("hash").isNotNull()).select(F.col("hash").alias("l")).distinct())
    left, found, width_before = asked.withColumn("best", F.lit(None).cast("int")), [], 0
    indexed = None
    for width, bits in ROUNDS if not known.isEmpty() else ():
        if width != width_before:
            indexed = once(known.select("l", F.inline(_blocks("l", width))))
        # A new width begins with all values of fewer bits too.
        shells = range(bits + 1) if width != width_before else (bits,)
        masks = [sum(1 << b for b in c) for k in shells for c in combinations(range(width), k)]
        width_before = width
        probes = left.select("h", F.inline(_blocks("h", width))).select("h", "i", F.explode(F.array(*map(F.lit, masks))).alias("m"), "v").select("h", "i", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
        near = probes.join(indexed, ["i", "v"]).groupBy("h").agg(F.min(distance(F.col("h"), F.col("l"))).cast("int").alias("d"))
        radius = (64 // width) * (bits + 1) - 1
        now = once(left.join(near, "h", "left").select("h", F.least("best", "d").alias("best")))
        settled = F.coalesce(F.col("best") <= radius, F.lit(False))
        found.append(now.filter(settled))
        left = now.filter(~settled)
        if left.isEmpty():
            break
    best = left
    for f in found:
        best = best.unionByName(f)
    rows = items.select(key, F.col(hash_).alias("h")).join(best, "h", "left")
    return rows.select(key, F.coalesce(1 - F.col("best") / F.lit(64.0), F.lit(0.0)).alias("best_similarity"))
