"""What the operators share: table access, checkpoints, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_pattern() -> str:
    """The pattern whose matches the byte-level tokenizers encode separately."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset and the master is local (tests), a temporary one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siftstone-"))
    return sc._jsc.sc().getCheckpointDir().get()


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder of tables that nothing reads any more, by the file system that holds it."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Rows of df, computed once and kept in the shared folder; what the driver has freed by then goes back to the system."""
    shared_folder(df.sparkSession)
    kept = df.checkpoint(eager=True)
    trim()
    return kept


def partitions(spark: SparkSession, least: int = 16) -> int:
    """How many buckets to deal rows into: the session's shuffle width."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def by_task(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, owner: str = "", keep: bool = True) -> DataFrame:
    """mapInArrow with a function of a task's batches.

    owner: whose word caches f uses; a worker frees all others first. Batches are cut to BATCH rows here:
    whole documents would make batches of Spark's size too large for a worker. keep: whether word caches outlive the
    task; an executor has more workers than tasks after a stage with two in a row, and those that wait would keep theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Recent.work_for(owner)
        yield from f(b.slice(at, BATCH) for b in batches for at in range(0, b.num_rows, BATCH))
        if not keep:
            Recent.work_for("")
        trim()

    return df.mapInArrow(run, schema)


def by_batch(df: DataFrame, f: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch], schema, owner: str = "", keep: bool = True) -> DataFrame:
    """mapInArrow with a function of one batch; batches without rows are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = f(b)
            yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return by_task(df, run, schema, owner, keep)


def trim() -> None:
    """Gives freed memory back to the system: a worker lives on between tasks beside others of its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def plain_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def release(spark: SparkSession) -> None:
    """Tables and exchanges that nothing refers to any more give their files back now, not when the driver next collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened until no column has them (Spark's columns are told apart without regard to case)."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def text_col(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


class Recent(dict):
    """What `make` gives for a key, kept for the keys met lately (at most twice `size` of them).

    A Python worker outlives a stage and may serve several operators; `work_for` frees what the others
    had kept, so a worker's memory is that of one operator.
    """

    _all: list[Recent] = []

    def __init__(self, make: Callable, owner: str, size: int = 200_000, longest: int = 48):
        super().__init__()
        self.make, self.owner, self.size, self.longest, self.old = make, owner, size, longest, {}
        Recent._all.append(self)

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = self.copy()
                self.clear()
            self[key] = found
        return found

    @staticmethod
    def work_for(owner: str) -> None:
        others = [r for r in Recent._all if r.owner != owner and (r or r.old)]
        for r in others:
            r.clear()
            r.old = {}
