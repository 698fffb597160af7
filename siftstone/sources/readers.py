"""Readers of the engine's inputs as DataFrames; every file goes through Spark's sources."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.operators.rows import basename, keep_last
from siftstone.sources.pictures import files, filesystem, names


def _numbered(df: DataFrame) -> DataFrame:
    """Adds seq: files in order of name, lines in order within a file."""
    return df.withColumn("seq", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")))


def images(spark: SparkSession, folder: str, recursive: bool = True, extensions: tuple[str, ...] = L.IMAGE_EXTENSIONS, skipped: tuple[str, ...] = L.SKIPPED_FOLDERS) -> DataFrame:
    """(path, filename, bytes): files of the wanted endings outside of skipped folders, in order of path; contents aren't read."""
    found = names(spark, folder, recursive, extensions, skipped)
    return found.select("path", basename(F.col("path")).alias("filename"), F.col("length").alias("bytes")).orderBy("path")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(filename, orig_path): two tab-separated fields, or a lone path known by its last part; the last line of a name wins."""
    lines = _numbered(spark.read.text(path)).filter("trim(value) <> ''")
    parts = F.split("value", "\t")
    rows = lines.select(
        F.when(F.size(parts) > 1, F.trim(parts[0])).otherwise(basename(F.trim("value"))).alias("filename"),
        F.when(F.size(parts) > 1, F.trim(F.try_element_at(parts, F.lit(2)))).otherwise(F.trim("value")).alias("orig_path"), "seq",
    )
    return keep_last(rows, "filename", "seq").select("filename", "orig_path")


def user_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(filename, want): rows that speak of moving or of keeping; the last of a name wins."""
    rows = _numbered(spark.read.option("header", True).csv(path))
    said = F.col("用户决定")
    want = F.when(F.contains(said, F.lit("移动")), "MOVE").when(F.contains(said, F.lit("保留")), "KEEP")
    return keep_last(rows.select(F.trim("文件名").alias("filename"), want.alias("want"), "seq").filter("want IS NOT NULL"), "filename", "seq").select("filename", "want")


def json_lines(spark: SparkSession, path: str, schema: str, key: str | None = None, bad: str = "DROPMALFORMED") -> DataFrame:
    """Rows of a JSON log; with a key, the last row of each. bad: DROPMALFORMED skips bad lines, FAILFAST raises on one, EMPTY empties the whole.

    Rows without a key (null or empty) go.
    """
    if bad == "EMPTY":
        lines = spark.read.text(path).filter("trim(value) <> ''")
        parsed = lines.select("*", F.from_json("value", f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"), "_metadata")
        broken = not parsed.filter("r._corrupt_record IS NOT NULL").isEmpty()
        rows = parsed.filter(F.lit(not broken)).select("r.*", "_metadata").drop("_corrupt_record")
        return rows.drop("_metadata") if key is None else keep_last(_numbered(rows).drop("_metadata").filter(F.col(key) != ""), key, "seq").drop("seq", "_first")
    rows = spark.read.schema(schema).option("mode", bad).json(path)
    return rows if key is None else keep_last(_numbered(rows).filter(F.col(key) != ""), key, "seq").drop("seq", "_first")


def row_log(spark: SparkSession, path: str, schema: str, path_key: str = "_path", name_key: str = "文件名") -> DataFrame:
    """Rows of the report's log with place: the last row of each path (or name, if it has no path) stands where the first stood.

    Bad and blank lines are skipped; rows with neither come first, in their order.
    """
    rows = _numbered(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path))
    known = F.coalesce(F.when(F.col(path_key) != "", F.col(path_key)), F.when(F.col(name_key) != "", F.col(name_key)))
    r = rows.withColumn("_key", known)
    keyed = keep_last(r, "_key", "seq").drop("seq", "_key").withColumn("place", F.struct(F.lit(1).alias("keyed"), F.col("_first").alias("seq"))).drop("_first")
    rest = r.filter("_key IS NULL").withColumn("place", F.struct(F.lit(0).alias("keyed"), F.col("seq"))).drop("seq", "_key")
    return rest.unionByName(keyed.select(*rest.columns))


def cached_lines(spark: SparkSession, path: str, bad: str = "EMPTY") -> DataFrame:
    """(path, lines) of a cache of recognized lines; each line is a pair [text, confidence]."""
    raw = json_lines(spark, path, "path string, lines array<array<string>>", "path", bad)
    pair = lambda x: F.struct(F.try_element_at(x, F.lit(1)).alias("text"), F.try_element_at(x, F.lit(2)).try_cast("double").alias("conf"))
    return raw.select("path", parsed_lines(F.transform(F.coalesce("lines", F.expr("CAST(array() AS array<array<string>>)")), pair)).alias("lines"))


def parsed_lines(lines: Column) -> Column:
    """Recognized lines as they are kept: stripped, without empty texts and broken pairs."""
    kept = F.transform(lines, lambda x: F.struct(F.regexp_replace(x["text"], r"(?U)^\s+|\s+$", "").alias("text"), x["conf"].alias("conf")))
    return F.filter(kept, lambda x: F.coalesce((x["text"] != "") & x["conf"].isNotNull(), F.lit(False)))


def path_set(spark: SparkSession, path: str) -> DataFrame:
    """(path): distinct strings of a JSON array; none if it can't be read as one."""
    return spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "array<string>")).alias("path")).filter("path IS NOT NULL").distinct()


def library(spark: SparkSession, path: str) -> DataFrame:
    """(hash): distinct values of a JSON array of unsigned 64-bit numbers, as longs of the same bits."""
    from siftstone.operators.similarity import signed

    values = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "array<decimal(20,0)>")).alias("u"))
    return values.select(signed(F.col("u")).alias("hash")).filter("hash IS NOT NULL").distinct()


def path_list(spark: SparkSession, path: str, present: DataFrame | None = None) -> DataFrame:
    """(path): nonblank lines; present: only those that stand in it."""
    rows = spark.read.text(path).select(F.trim("value").alias("path")).filter("path <> ''")
    return rows if present is None else rows.join(present.select("path").distinct(), "path", "left_semi")


def newest(spark: SparkSession, pattern: str, chars: int) -> DataFrame:
    """(path, tail): of the files that match, the one changed last, and its last characters; contents of others aren't read.

    pattern: a folder and a name with * and ?; a task lists the folder and returns one name. Other patterns are left to Spark's source,
    whose listing goes through the driver.
    """
    folder, _, name = pattern.rpartition("/")
    if folder and not re.search(r"[*?\[\]{}\\]", folder) and not re.search(r"[\[\]{}\\]", name):
        one = _last_changed(spark, folder, name).first()
        pattern = re.sub(r"([*?\[\]{}\\])", r"\\\1", f"{folder}/{one['name']}") if one else pattern
    found = spark.read.format("binaryFile").load(pattern)
    last = found.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).limit(1)
    text = F.decode("content", "UTF-8")
    return found.join(F.broadcast(last.select("path")), "path").select("path", F.when(F.length(text) > chars, F.substring(text, -chars, chars)).otherwise(text).alias("tail"))  # one row


def _last_changed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(name): of a folder's files that match and hold a byte, the last changed to the millisecond, then the last by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = re.compile(fnmatch.translate(name))
        for _ in batches:
            fs, base = filesystem(folder)
            found = ((int(x.mtime_ns // 1_000_000), x.base_name) for x in fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True)) if x.type == pyarrow.fs.FileType.File and x.size and x.base_name[0] not in "._" and fits.match(x.base_name))
            last = max(found, default=None)
            yield pa.record_batch({"name": pa.array([last[1]] if last else [], pa.string())})

    return spark.createDataFrame([("",)], "x string").coalesce(1).mapInArrow(run, "name string")


def reference_names(spark: SparkSession, *folders: str) -> DataFrame:
    """(filename): distinct lower-case names of all files below the folders."""
    found = files(spark, folders[0])
    for folder in folders[1:]:
        found = found.unionByName(files(spark, folder))
    return found.select(F.lower(basename(F.col("path"))).alias("filename")).distinct()


def report(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a report: results of a .json file, or a CSV file of strings."""
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path).select(F.explode("results").alias("r")).select("r.*")
    return spark.read.option("header", True).csv(path)


def json_field(column: str, field: str, kind: str) -> Column:
    """A field of a JSON text; null where the text or the field isn't there or isn't of the kind."""
    return F.get_json_object(column, f"$.{field}").try_cast(kind)


def iso_time(column: str) -> Column:
    """A time to the second as reports and logs write it."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def extension(path: Column) -> Column:
    """The lower-case ending with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
