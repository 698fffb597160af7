"""Keyed operations on row logs: keep-last, upsert, duplicate propagation, names for clashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L


def keep_last(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key, with _first, the sequence number of its first. Rows without a key go."""
    others = F.struct(*[c for c in rows.columns if c != key])
    best = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(others, seq).alias("r"), F.min(seq).alias("_first"))
    return best.select(key, "r.*", "_first").select(*rows.columns, "_first")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and those of old whose key new does not have."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def propagate(decided: DataFrame, key: str = "md5") -> DataFrame:
    """In a group of two rows or more with one key, one MOVE moves all; adds changed.

    Rows that move so have the rule for duplicates, the key's head as evidence and score 1. Groups are
    reduced to a flag and a count before they meet the rows, so a key of any size is no task of its own;
    a row without a key (null or empty) stays as it is. decided is read twice: give it a table or a
    checkpoint where it is costly.
    """
    groups = (
        decided.filter(F.col(key) != "").groupBy(key)
        .agg(F.max(F.col("decision") == "MOVE").alias("_any"), F.count("*").alias("_n"))
        .filter("_any AND _n > 1").select(key, F.lit(True).alias("_moves"))
    )
    d = decided.join(groups, key, "left").withColumn("changed", F.coalesce(F.col("_moves"), F.lit(False)) & (F.col("decision") != "MOVE"))
    to = {"rule": F.lit("duplicate"), "score": F.lit(1.0), "decision": F.lit("MOVE")}
    if "evidence" in decided.columns:
        to["evidence"] = F.array(F.concat(F.lit(L.EVIDENCE["duplicate"]), F.substring(key, 1, 12), F.lit("…）")))
    return d.withColumns({k: F.when(F.col("changed"), v).otherwise(F.col(k)) for k, v in to.items()}).select(*decided.columns, "changed")


def ranked_within(rows: DataFrame, group: str, order: str, out: str, salts: int = 32) -> DataFrame:
    """Adds out: the row's place from 0 among the rows of its group in the order of a column.

    The order is cut into ranges by bounds that are read off a sample once; ranks are counted within a
    group and range and added up over the ranges before, so a group of any size is many tasks.
    """
    cuts = bounds(rows, order, salts)
    r = rows.withColumn("_range", range_of(F.col(order), cuts))
    counts = r.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = counts.select(group, "_range", (F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")).alias("_before"))
    inner = r.withColumn("_in", F.row_number().over(Window.partitionBy(group, "_range").orderBy(order)) - 1)
    before = before.withColumnRenamed(group, "_group")
    joined = inner.join(before, inner[group].eqNullSafe(before["_group"]) & (inner["_range"] == before["_range"]))
    return joined.select(*[inner[c] for c in rows.columns], (F.col("_in") + F.col("_before")).alias(out))


def bounds(rows: DataFrame, key: str, parts: int, size: int = 4096) -> list:
    """Values of the key that cut it into about equal ranges: quantiles of the rows of least hash, so alike in every run."""
    seen = rows.select(F.col(key).alias("k")).filter("k IS NOT NULL").orderBy(F.xxhash64("k"), "k").limit(size).collect()  # at most `size` values
    values = sorted(r["k"] for r in seen)
    return sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []


def range_of(key: Column, cuts: list) -> Column:
    """How many of the bounds are not beyond the key; nulls come first."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= key)), F.lit(0))


def clash_names(moves: DataFrame, name: str = "filename", order: str = "path", taken: DataFrame | None = None) -> DataFrame:
    """Adds target: the name, or name_1, name_2 ... before the extension for later rows of one name.

    taken: a column `name` of what stands at the target already; a row whose first name is taken goes on from _1,
    and names that are taken are passed over.
    """
    n = "_rank"
    ranked = ranked_within(moves, name, order, n)
    stem, ext = F.regexp_extract(name, r"(?s)^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"(?s)^(.*?)(\.[^.]*)?$", 2)
    numbered = lambda i: F.when(i == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), i.cast("string"), ext))
    if taken is None:
        return ranked.withColumn("target", numbered(F.col(n))).drop(n)
    # Names that are taken, by the name they stem from and their number: bounded by the names on disk.
    there = taken.select(F.col(name).alias("_there")).distinct()
    number = F.try_to_number(F.regexp_extract("_there", r"_([0-9]{1,9})(\.[^.]*)?$", 1), F.lit("999999999"))
    base = F.regexp_replace("_there", r"_[0-9]{1,9}(?=(\.[^.]*)?$)", "")
    used = there.select(F.col("_there").alias("_base"), F.lit(0).alias("_i")).unionByName(there.filter(number.isNotNull()).select(base.alias("_base"), number.cast("int").alias("_i")))
    lists = used.groupBy("_base").agg(F.array_sort(F.collect_set("_i")).alias("_used"))
    d = ranked.join(lists, ranked[name] == lists["_base"], "left")
    # The place among the free numbers: each number taken that isn't beyond moves it on by one.
    place = F.aggregate(F.coalesce("_used", F.expr("CAST(array() AS array<int>)")), F.col(n).cast("int"), lambda i, u: F.when(u <= i, i + 1).otherwise(i))
    return d.withColumn("_place", place).withColumn("target", numbered(F.col("_place"))).select(*moves.columns, "target")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def unseen(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done; a null key is never done."""
    return rows.join(done.select(key).distinct(), key, "left_anti").select(*rows.columns)


def present(rows: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among those there."""
    return rows.join(there.select(key).distinct(), key, "left_semi").select(*rows.columns)


def with_original(items: DataFrame, index: DataFrame) -> DataFrame:
    """Adds orig_path: the index's path of the item's filename, else its own. The index has a row a filename."""
    known = index.select("filename", F.col("orig_path").alias("_orig"))
    return items.join(known, "filename", "left").withColumn("orig_path", F.coalesce("_orig", "path")).select(*items.columns, "orig_path")


def fingerprinted(rows: DataFrame, content: str, length: int = 32) -> DataFrame:
    """Adds fingerprint: the first characters of the content's MD5; null for null."""
    return rows.withColumn("fingerprint", F.substring(F.md5(content), 1, length))


def duplicate_groups(rows: DataFrame, key: str = "md5") -> DataFrame:
    """(key, n) of keys that several rows have; rows without a key are no group."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def newest_first(rows: DataFrame, path: str = "path") -> DataFrame:
    """Rows in falling order of path, as runs take them."""
    return rows.orderBy(F.desc(path))
