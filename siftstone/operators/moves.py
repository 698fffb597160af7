"""Moving files in two phases, so that a run that is lost halfway can be run again.

First the intended moves are written down, those left out whose place is taken or that share one; then
tasks rename the files, and what each has done is written down as well. A rename that a lost task had
already made is found by its target and isn't made again. Taking a run back is the same the other way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from siftstone.sources.pictures import filesystem

JOURNAL = "src string, dst string"
DONE = "src string, dst string, outcome string"


def _there(rows: DataFrame, root: str, column: str) -> DataFrame:
    """Adds _there: whether the file of a path below the root is there."""
    schema = StructType([*rows.schema.fields, StructField("_there", BooleanType())])
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        for b in batches:
            names = b.column(at).to_pylist()
            found = fs.get_file_info([f"{base}/{n}" for n in names]) if names else []
            there = [x.type == pyarrow.fs.FileType.File for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(there, pa.bool_())], names=[*b.schema.names, "_there"])

    return rows.mapInArrow(run, schema)


def intend(moves: DataFrame, root: str, journal: str) -> None:
    """Writes down the moves (src, dst, both below the root) of a new run; a journal that is already there stays as it is.

    Repeated moves are one. Left out: moves with a null, onto themselves, whose target is taken, and of several moves
    with one source or one target all but the first in order of their names.
    """
    if _read(moves.sparkSession, f"{journal}/intent", JOURNAL) is not None:
        return
    m = moves.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()
    m = m.withColumn("_a", F.row_number().over(Window.partitionBy("dst").orderBy("src"))).filter("_a = 1").drop("_a")
    m = m.withColumn("_a", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).filter("_a = 1").drop("_a")
    _there(m, root, "dst").filter("NOT _there").select("src", "dst").write.mode("overwrite").parquet(f"{journal}/intent")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table whose writing was finished, else None."""
    fs, at = filesystem(path)
    if fs.get_file_info(f"{at}/_SUCCESS").type != pyarrow.fs.FileType.File:
        return None
    return spark.read.schema(schema).parquet(path)


def _renamed(moves: DataFrame, root: str, fail: Callable[[str], None] | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        made: set[str] = set()
        for b in batches:
            said = []
            for src, dst in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a, z = fs.get_file_info([f"{base}/{src}", f"{base}/{dst}"])
                if a.type == pyarrow.fs.FileType.File:
                    if fail:
                        fail(src)
                    parent = f"{base}/{dst}".rsplit("/", 1)[0]
                    if parent not in made:
                        fs.create_dir(parent, recursive=True)
                        made.add(parent)
                    try:
                        fs.move(a.path, z.path)
                    except FileNotFoundError:  # a task of a failed run, still at work, was first
                        pass
                    z = fs.get_file_info(z.path)
                # Without a source, the target is there if a lost task had moved it.
                said.append("moved" if z.type == pyarrow.fs.FileType.File else "missing")
            yield pa.record_batch({"src": b.column(0), "dst": b.column(1), "outcome": pa.array(said, pa.string())})

    return moves.mapInArrow(run, DONE)


def carry_out(spark: SparkSession, root: str, journal: str, fail: Callable[[str], None] | None = None) -> DataFrame:
    """(src, dst, outcome: moved or missing) of a journal's moves; those that aren't yet written down as done are made now.

    Call it again with the same journal after a failure. fail: called before each rename, for tests.
    """
    intent, done = _read(spark, f"{journal}/intent", JOURNAL), _read(spark, f"{journal}/done", DONE)
    if intent is None:
        raise AnalysisException(f"no finished journal at {journal}")
    if done is None:
        _renamed(intent.repartition(spark.sparkContext.defaultParallelism, "src"), root, fail).write.mode("overwrite").parquet(f"{journal}/done")
        done = _read(spark, f"{journal}/done", DONE)
    return done


def take_back(spark: SparkSession, root: str, journal: str, undo: str) -> DataFrame:
    """Moves the files of a finished run back, where their old place is free; (src, dst, outcome) of the way back, kept in a journal of its own."""
    done = _read(spark, f"{journal}/done", DONE)
    if done is None:
        raise AnalysisException(f"no finished run at {journal}")
    intend(done.filter("outcome = 'moved'").select(F.col("dst").alias("src"), F.col("src").alias("dst")), root, undo)
    return carry_out(spark, root, undo)


def counts(done: DataFrame) -> DataFrame:
    """One row: moved, skipped_missing."""
    return done.agg(F.count_if(F.col("outcome") == "moved").alias("moved"), F.count_if(F.col("outcome") == "missing").alias("skipped_missing"))
