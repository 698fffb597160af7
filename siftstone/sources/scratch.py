"""Tables that are computed once and kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset and the master is local (tests), a temporary one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siftstone-"))
    return sc._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def once(df: DataFrame) -> DataFrame:
    """The rows of df, computed now and kept, for plans that read them more than once."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)
