"""Incremental runs: a file stream that takes up where the last run ended, item by item.

Which files have been read, and which items are done, is in the checkpoint: offsets, and a state store
that holds each item's key. A batch is written to a folder of its own number, so that a batch that is
run again after a failure replaces what the failed one left, and the state and the files agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def large_state(spark: SparkSession) -> None:
    """State of streams started from now on is kept on disk beside the executors, with changes in the checkpoint: it may outgrow memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class Halted(Exception):
    """A run has done as many rows as it may."""


def run_available(
    spark: SparkSession, source: str, schema: str, judge: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
    key: str | None = None, rows_per_run: int | None = None, files_per_batch: int = 1000,
) -> int:
    """Judges what no earlier run with this checkpoint has judged; returns how many rows this run has written.

    key: items of a key are judged once, whichever files hold them and in whichever run (rows of a null key
    are one item). rows_per_run: the run ends before the first batch that would begin with so many rows
    written; the next run goes on with that batch. A new checkpoint and a new sink start over. `results`
    reads the sink.
    """
    large_state(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    items = stream if key is None else stream.dropDuplicates([key])
    written = 0

    def put(batch: DataFrame, number: int) -> None:
        nonlocal written
        if rows_per_run is not None and written >= rows_per_run:
            raise Halted
        at = f"{sink}/batch={number}"
        judge(batch).write.mode("overwrite").parquet(at)
        written += spark.read.schema(judge(batch).schema).parquet(at).count()

    query = items.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if rows_per_run is None or written < rows_per_run:
            raise
    return written


def results(spark: SparkSession, sink: str) -> DataFrame:
    """All rows that runs have written."""
    return spark.read.parquet(sink).drop("batch")


def progress(spark: SparkSession, sink: str, total: DataFrame) -> DataFrame:
    """One row: done, total, percent; done counts rows of the sink, total those of a table."""
    done = results(spark, sink).agg(F.count("*").alias("done"))
    return done.crossJoin(total.agg(F.count("*").alias("total"))).withColumn("percent", F.coalesce(F.round(100 * F.try_divide("done", "total"), 1), F.lit(0.0)))  # one row and one row
