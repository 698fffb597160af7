"""What the vector operators share: which vectors take part, and cosine in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def takes_part(v: Column) -> Column:
    """Whether a vector is there, isn't zero and has finite components only."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0.0), F.lit(False))


def vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding): components of single precision stay so, all others are of double precision."""
    kind = rows.schema[embedding].dataType
    v = F.col(embedding) if kind == ArrayType(FloatType(), True) or kind == ArrayType(FloatType(), False) else F.col(embedding).cast("array<double>")
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("embedding"))


def valid(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding, d) of vectors that take part: with an id, not null, not zero, all components finite."""
    return vectors(rows, vec_id, embedding).filter(F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))).withColumn("d", F.size("embedding"))


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of a list column of length d each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, d)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their length, without overflow for very large or small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
