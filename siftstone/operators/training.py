"""Training a scorer of items by epochs of distributed gradient steps, with validation figures an epoch and resumption.

Each step is one Spark job: tasks add up the gradient of their rows, Spark adds the tasks' sums, and the
driver, which holds only the weights, takes the step. Rows contribute whole numbers (multiples of 2^-30),
so a sum is the same in any order and layout: a run that was interrupted ends where a whole one does. After
each epoch the state is a row on disk; a run takes up the last epoch of the same data and settings.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators.evaluate import ratio
from siftstone.operators.sampling import split
from siftstone.sources.scratch import once

ONE = float(1 << 30)
EPOCH = (
    "epoch int, data string, settings string, weights array<double>, mean array<double>, square array<double>, steps int, "
    "train_loss double, n_train long, n_valid long, tp long, fp long, fn long, tn long, valid_loss double"
)


@dataclass(frozen=True)
class Settings:
    """Moving means of gradient and square (`keep`, `keep_square`) scale each step; `share` of the rows validates."""

    steps: int = 8  # an epoch
    rate: float = 0.05
    keep: float = 0.9
    keep_square: float = 0.999
    shrink: float = 1e-4
    share: float = 0.15
    seed: int = 42
    threshold: float = 0.5


def signature(rows: DataFrame) -> str:
    """Names a table's rows, whatever their order and layout."""
    r = rows.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), *rows.columns)).alias("y")).first()
    return f"{r.n}:{r.x}:{r.y}"


def prepared(rows: DataFrame, key: str, features: str, label: str) -> DataFrame:
    """(key, features, label) of rows that can be learned from: finite features of one length, the most frequent one, and a label of 0 or 1."""
    x = F.col(features).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = rows.select(F.col(key).alias("key"), x.alias("features"), F.col(label).cast("int").alias("label")).filter(F.col("features").isNotNull() & ~odd & (F.size("features") > 0) & F.col("label").isin(0, 1))
    n = good.groupBy(F.size("features").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return good.filter(F.size("features") == (n[0].n if n else 0))


def _sums(rows: DataFrame, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(loss, rows, tp, fp, fn, tn; gradient) summed over rows (features, label); tasks send one row each."""
    d = len(weights)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, total = np.zeros(6, object), np.zeros(d, object)
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column(0).flatten().to_numpy(zero_copy_only=False), float).reshape(b.num_rows, d - 1)
                y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
                z = (x * weights[:-1]).sum(axis=1) + weights[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                loss = np.logaddexp(0, z) - y * z
                off = np.rint(np.c_[x, np.ones(len(x))] * (p - y)[:, None] * ONE).astype(np.int64)
                said = p >= threshold
                told += np.array([int(np.rint(loss * ONE).astype(np.int64).sum()), len(x), int((said & (y == 1)).sum()), int((said & (y == 0)).sum()), int((~said & (y == 1)).sum()), int((~said & (y == 0)).sum())], object)
                total += off.sum(axis=0).astype(object)
        yield pa.record_batch({"told": pa.array([[str(v) for v in told]]), "total": pa.array([[str(v) for v in total]])})

    sums = rows.select("features", "label").mapInArrow(each, "told array<string>, total array<string>")
    whole = lambda c, n: [F.sum(F.col(c)[k].cast("decimal(38,0)")).alias(f"{c}{k}") for k in range(n)]
    r = sums.agg(*whole("told", 6), *whole("total", d)).first()
    return np.array([int(r[f"told{k}"] or 0) for k in range(6)], object), np.array([int(r[f"total{k}"] or 0) / ONE for k in range(d)])


def epochs(spark: SparkSession, folder: str) -> DataFrame:
    """The epochs that are kept in a folder, none if there is no such folder."""
    try:
        return spark.read.schema(EPOCH).parquet(f"{folder}/*.epoch")
    except AnalysisException:
        return spark.createDataFrame([], EPOCH)


def train(rows: DataFrame, folder: str, n_epochs: int = 5, settings: Settings = Settings(), key: str = "id", features: str = "features", label: str = "label") -> DataFrame:
    """The epochs' rows (EPOCH) after training a linear scorer of sigmoid output up to n_epochs.

    Epochs of the same data and settings that the folder has are not run again; epochs of others are
    replaced. Rows that can't be learned from (`prepared`) are left aside; without any, there is no epoch.
    """
    spark, s = rows.sparkSession, settings
    good = once(split(prepared(rows, key, features, label), s.share, "key", s.seed))
    data, said = signature(good.select("key", "features", "label")), json.dumps(asdict(s), sort_keys=True)
    any_row = good.select(F.size("features").alias("n")).limit(1).collect()
    if not any_row:
        return spark.createDataFrame([], EPOCH)
    learn, check = good.filter("part = 'train'"), good.filter("part = 'valid'")
    known = [r for r in epochs(spark, folder).filter((F.col("data") == data) & (F.col("settings") == said)).orderBy("epoch").collect()]
    known = [r for k, r in enumerate(known, 1) if r.epoch == k]  # without gaps
    d = any_row[0].n + 1
    weights, mean, square, steps = (np.array(known[-1].weights), np.array(known[-1].mean), np.array(known[-1].square), known[-1].steps) if known else (np.zeros(d), np.zeros(d), np.zeros(d), 0)
    for epoch in range(len(known) + 1, n_epochs + 1):
        for _ in range(s.steps):
            told, gradient = _sums(learn, weights, s.threshold)
            gradient = gradient / max(int(told[1]), 1) + s.shrink * np.r_[weights[:-1], 0.0]
            steps += 1
            mean, square = s.keep * mean + (1 - s.keep) * gradient, s.keep_square * square + (1 - s.keep_square) * gradient**2
            weights = weights - s.rate * (mean / (1 - s.keep**steps)) / (np.sqrt(square / (1 - s.keep_square**steps)) + 1e-8)
        checked, _ = _sums(check, weights, s.threshold)
        row = (
            epoch, data, said, weights.tolist(), mean.tolist(), square.tolist(), steps, int(told[0]) / ONE / max(int(told[1]), 1), int(told[1]), *(int(v) for v in checked[1:]),
            int(checked[0]) / ONE / max(int(checked[1]), 1),
        )
        spark.createDataFrame([row], EPOCH).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{epoch:05d}.epoch")
    return epochs(spark, folder).filter((F.col("data") == data) & (F.col("settings") == said) & (F.col("epoch") <= n_epochs))


def metrics(trained: DataFrame) -> DataFrame:
    """(epoch, n_valid, precision, recall, f1, accuracy, valid_loss) of each epoch; a ratio of nothing is 0."""
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return trained.select(
        "epoch", "n_valid", p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"), ratio(F.col("tp") + F.col("tn"), F.col("n_valid")).alias("accuracy"), "valid_loss"
    )


def scored(rows: DataFrame, weights: list[float], features: str = "features", name: str = "prob") -> DataFrame:
    """Adds the scorer's probability, within the JVM; null for features that are null, hold a null or no number, or have another length."""
    x = F.col(features).cast("array<double>")
    dot: Column = F.aggregate(F.zip_with(x, F.array(*map(F.lit, weights[:-1])), lambda a, b: a * b), F.lit(float(weights[-1])), lambda s, v: s + v)
    return rows.withColumn(name, F.when((F.size(x) == len(weights) - 1) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)), 1 / (1 + F.exp(-F.greatest(F.least(dot, F.lit(500.0)), F.lit(-500.0))))))
