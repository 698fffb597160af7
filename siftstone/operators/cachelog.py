"""A cache as an append-only log in buckets, with a small filter of what each bucket of each append holds.

Saving appends what is new; nothing is rewritten. A batch of keys first asks the filters (a byte a key, one
hash) which buckets of which appends may hold any of them, and only those are read. All steps are DataFrame
functions; the files are ordinary Parquet, partitioned by append and bucket.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = 32768  # bits of one stored bitmap


def _hash(key: str) -> Column:
    return F.xxhash64(key)


def _position(h: Column, bits: Column) -> Column:
    """A place from 1 to bits, from other bits of the hash than the bucket's."""
    return F.pmod(F.call_function("shiftrightunsigned", h, F.lit(20)), bits) + 1


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def appends(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the appends whose writing was finished: the filter is written last."""
    found = _read(spark, f"{path}/filter")
    return sorted(r.append for r in found.select("append").distinct().collect()) if found is not None else []


def append(rows: DataFrame, path: str, key: str = "path", value: str = "lines", buckets: int = 64) -> int:
    """Adds (key, value) rows to the log; returns the append's number. One writer at a time; a lost append is written anew by the next.

    Of repeated keys in one append, which row counts is left open; keys that are null are left out. The number of
    buckets is that of the first append.
    """
    spark = rows.sparkSession
    known = _read(spark, f"{path}/filter")
    if known is not None:
        buckets = known.first().buckets
    number = max(appends(spark, path), default=-1) + 1
    kept = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value")).withColumn("bucket", F.pmod(_hash("key"), F.lit(buckets)).cast("int"))
    kept.repartition("bucket").sortWithinPartitions("bucket", "key").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/log/append={number}")
    written = spark.read.schema("key string, bucket int").parquet(f"{path}/log/append={number}")
    most = written.groupBy("bucket").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    bits = WORD * max(1, -(-8 * (most or 0) // WORD))
    at = _position(_hash("key"), F.lit(bits))
    maps = written.select("bucket", F.bitmap_bucket_number(at).alias("word"), F.bitmap_bit_position(at).alias("bit")).groupBy("bucket", "word").agg(F.bitmap_construct_agg("bit").alias("bits_set"))
    maps.select("bucket", "word", "bits_set", F.lit(bits).cast("long").alias("bits"), F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/filter/append={number}")
    return number


def places(keys: DataFrame, path: str, key: str = "path") -> DataFrame:
    """(append, bucket) that may hold any of the keys: all that do, and a few that don't."""
    known = _read(keys.sparkSession, f"{path}/filter")
    if known is None:
        return keys.sparkSession.createDataFrame([], "append int, bucket int")
    sizes = known.select("append", "bits", "buckets").distinct()  # a row an append
    asked = keys.filter(F.col(key).isNotNull()).select(_hash(key).alias("h")).distinct().join(F.broadcast(sizes))
    at = _position(F.col("h"), F.col("bits"))
    asked = asked.select("append", F.pmod("h", F.col("buckets")).cast("int").alias("bucket"), F.bitmap_bucket_number(at).alias("word"), F.bitmap_bit_position(at).alias("bit")).distinct()
    byte = F.conv(F.hex(F.substring("bits_set", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.call_function("getbit", byte, F.pmod("bit", F.lit(8)).cast("int")) == 1
    return asked.join(known.select("append", "bucket", "word", "bits_set"), ["append", "bucket", "word"]).filter(there).select("append", "bucket").distinct()


def lookup(keys: DataFrame, path: str, key: str = "path", value: str = "lines", value_type: str = "string") -> tuple[DataFrame, int]:
    """((key, value) of the keys that the log has, each with its last value; how many buckets of appends are read)."""
    spark = keys.sparkSession
    found = [(r.append, r.bucket) for r in places(keys, path, key).collect()]  # appends x buckets at most
    if not found:
        return spark.createDataFrame([], keys.select(key).schema.add(value, value_type)), 0
    files = [f"{path}/log/append={a}/bucket={b}" for a, b in found]
    rows = spark.read.option("basePath", f"{path}/log").schema(f"key string, value {value_type}, append int, bucket int").parquet(*files)
    last = rows.join(keys.select(F.col(key).alias("key")).distinct(), "key", "left_semi").groupBy("key").agg(F.max_by("value", "append").alias("value"))
    return last.select(F.col("key").alias(key), F.col("value").alias(value)), len(files)


def missing(keys: DataFrame, path: str, key: str = "path") -> DataFrame:
    """The rows of keys that the log doesn't have, null keys among them."""
    found, _ = lookup(keys, path, key)
    return keys.join(found.select(key), key, "left_anti").select(*keys.columns)
