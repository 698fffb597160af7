"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints.

A fingerprint is cut into d + 2 blocks; two fingerprints that differ in at most d bits agree on two
of them at least, so each pair of blocks is a join key. Rows are first reduced to distinct
fingerprints. Keys of few fingerprints are joined and every pair's distance is verified. A key of
more than `small` fingerprints is never expanded into pairs: its members differ only in the other
bits, so there each one lists itself and the values one bit away, and those that list a value in
common differ in two bits at most (for d = 2: exactly those). Linking all that list a value to the
least of them is linear and gives the same classes.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import by_batch, durable, raw_texts
from siftstone.llm.components import components

SEED = 42
DISTANCE = 2


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; no word gives 0."""
    words = text.lower().split()  # on bytes: A-Z only, white space 09-0D and 20
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))
    total, n = np.zeros(64, np.int64), len(shingles)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = shingles[i : i + (1 << 16)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, fp long): null and empty texts have fingerprint zero. Other columns are left aside."""

    def one(b: pa.RecordBatch) -> pa.Table:
        fp = np.array([fingerprint(x, size) for x in raw_texts(b.column(1))], np.uint64).view(np.int64)
        return pa.table({"doc_id": b.column(0).cast(pa.int64()), "fp": fp})

    return by_batch(docs.select(F.col(doc_id).cast("long"), text), one, "doc_id long, fp long")


def link_fingerprints(distinct: DataFrame, distance: int = DISTANCE, small: int = 64) -> DataFrame:
    """Links (a, b) between distinct values of column fp that give the classes of `distance` <= 2."""
    if not 0 <= distance <= 2:
        raise ValueError("distance is 0, 1 or 2")
    n = distance + 2
    edges_at = [round(64 * i / n) for i in range(n + 1)]
    tables = []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        mask = sum(((1 << edges_at[x + 1]) - (1 << edges_at[x])) for x in (i, j))
        mask -= (1 << 64) * (mask >> 63)
        tables.append(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"), F.lit(mask).alias("mask")))
    keyed = durable(distinct.select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", "k.*"))
    sizes = durable(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"))
    few = keyed.join(sizes.filter(F.col("n") <= small), ["t", "key"]).select("t", "key", "fp")
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b"), ["t", "key"])
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    near = F.when(F.lit(distance) == 0, F.array("fp")).otherwise(
        F.concat(
            F.array("fp"),
            F.transform(F.filter(bit, lambda m: m.bitwiseAND(F.col("mask")) == 0), lambda m: m.bitwiseXOR(F.col("fp"))),
        )
    )
    many = keyed.join(sizes.filter(F.col("n") > small), ["t", "key"])
    listed = many.select("t", "key", "fp", F.explode(near).alias("value"))
    if distance == 1:  # a common value one bit away would allow two bits: keep those that are listed themselves
        listed = listed.join(many.select("t", "key", F.col("fp").alias("value")), ["t", "key", "value"], "left_semi")
    least = listed.groupBy("t", "key", "value").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a <> z")
    starred = durable(listed).join(durable(least.select("t", "key", "value", "a")), ["t", "key", "value"]).filter("fp <> a")
    return pairs.unionByName(starred.select("a", F.col("fp").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the least reachable doc_id.

    Null and empty texts share fingerprint zero and are linked like any other. Repeated doc_ids give
    repeated rows. A null doc_id keeps its row but can't be a class's representative unless all are null.
    An empty table gives an empty result; extra columns are left aside.
    """
    prints = durable(fingerprints(docs, doc_id, text, size))
    distinct = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(link_fingerprints(distinct.select("fp"), distance))
    classes = durable(
        distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    )
    least = durable(classes.groupBy("c").agg(F.min("first").alias("component_id")))
    of_print = durable(classes.join(least, "c").select("fp", "component_id"))
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
