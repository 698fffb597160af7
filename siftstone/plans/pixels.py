"""Registered queries over pictures: the 64 values of each vector are a grey picture of 8 x 8, written as a file and read back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators import pixels as P
from siftstone.plans.standin import grey, table
from siftstone.sources import pictures
from siftstone.sources.scratch import new_folder

QUERIES: dict = {}
ORACLE: dict = {}
#: The grey values, and how each file is made: PNG with a filter by row, BMP, or broken in one of four ways.
_GREY = "g AS (SELECT vec_id, [CAST(floor(greatest(0, least(255, 128 + 64 * x))) AS INTEGER) FOR x IN embedding] AS g, vec_id % 10 AS kind FROM embeddings)"


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLE[name] = query, sql


def files(s: SparkSession, d: str, scale: int = 1) -> DataFrame:
    """(path, content): a file for each vector, in ten folders; scale: how many times wider and higher than 8 pixels."""
    v = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), grey(x)))).cast("int"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, bodies = [], []
            for i, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.kron(np.array(values, np.uint8).reshape(8, 8), np.ones((scale, scale), np.uint8))
                kind = i % 10
                body = pictures.encode_bmp(x) if kind == 7 else pictures.encode_png(x, lambda y: y % 3)
                if kind == 3:
                    body = body[:60]
                elif kind == 5:
                    body = body[:50] + bytes([body[50] ^ 1]) + body[51:]
                elif kind == 9:
                    body = b"GIF89a"
                elif kind == 8:
                    body = b"" if i % 20 == 8 else pictures.encode_bmp(x)[:100]
                names.append(f"{kind}/v{i}.{'bmp' if kind in (7, 8) else 'png'}")
                bodies.append(body)
            yield pa.record_batch({"path": names, "content": pa.array(bodies, pa.binary())})

    return table(s, d, "embeddings").select("vec_id", v.alias("v")).mapInArrow(made, "path string, content binary")


def read(s: SparkSession, d: str, scale: int = 1) -> DataFrame:
    """The files, written below the shared folder and read by Spark's source; vec_id is in their names."""
    folder = new_folder(s, "pictures")
    pictures.write_files(files(s, d, scale), folder).write.format("noop").mode("overwrite").save()
    found = pictures.pictures(s, folder)
    return found.withColumn("vec_id", F.regexp_extract("filename", r"v(\d+)\.", 1).cast("long"))


_WHY = "CASE kind WHEN 3 THEN 'chunk ends early' WHEN 5 THEN 'checksum of IDAT' WHEN 9 THEN 'no decoder for this format' WHEN 8 THEN CASE WHEN vec_id % 20 = 8 THEN 'empty file' ELSE 'pixel data ends early' END END"
_GOOD = "kind NOT IN (3, 5, 8, 9)"
_add(
    "p1_p2_pictures", lambda s, d: read(s, d).select("vec_id", "filename", "ok", "error", "w", "h", F.md5("rgb").alias("rgb_md5")),
    f"WITH {_GREY} SELECT vec_id, 'v' || vec_id || CASE WHEN kind IN (7, 8) THEN '.bmp' ELSE '.png' END AS filename, {_GOOD} AS ok, {_WHY} AS error, CASE WHEN {_GOOD} THEN 8 END AS w, CASE WHEN {_GOOD} THEN 8 END AS h, "
    f"CASE WHEN {_GOOD} THEN md5(unhex(list_reduce(list_transform(g, lambda v: repeat(printf('%02x', v), 3)), lambda a, b: a || b))) END AS rgb_md5 FROM g",
)


def _shrunk(s: SparkSession, d: str) -> DataFrame:
    rows = P.grey_statistics(P.greyed(read(s, d).filter("ok")), most=4)
    return rows.select("vec_id", F.round("lum_mean", 6).alias("lum_mean"), F.round("lum_std", 6).alias("lum_std"))


#: Weights of a triangle filter from 8 values to m.
_TRIANGLE = lambda m: (
    f"raw AS (SELECT i, j, greatest(0, 1 - abs(j + 0.5::DOUBLE - (i + 0.5::DOUBLE) * 8 / {m}) / greatest(8.0::DOUBLE / {m}, 1)) AS w FROM range({m}) a(i), range(8) b(j)), "
    "tri AS (SELECT i, j, w / sum(w) OVER (PARTITION BY i) AS w FROM raw)"
)
_CELLS = f"cell AS (SELECT vec_id, (k - 1) // 8 AS y, (k - 1) % 8 AS x, g[k]::DOUBLE AS v FROM g, range(1, 65) t(k) WHERE {_GOOD})"
_add(
    "p3_shrunk", _shrunk,
    f"WITH {_GREY}, {_CELLS}, {_TRIANGLE(4)}, "
    "rows_ AS (SELECT vec_id, r.i AS y, c.x, sum(r.w * c.v) AS v FROM cell c JOIN tri r ON r.j = c.y GROUP BY 1, 2, 3), "
    "small AS (SELECT vec_id, r.y, t.i AS x, sum(t.w * r.v) AS v FROM rows_ r JOIN tri t ON t.j = r.x GROUP BY 1, 2, 3) "
    "SELECT vec_id, round(avg(v), 6) AS lum_mean, round(stddev_pop(v), 6) AS lum_std FROM small GROUP BY vec_id",
)
_add(
    "p14_picture_hash", lambda s, d: P.hashed(P.greyed(read(s, d).filter("ok"))).select("vec_id", "phash"),
    f"WITH {_GREY}, {_CELLS}, {_TRIANGLE(32)}, "
    "basis AS (SELECT n, k, cos((2 * n + 1) * k * pi() / 64) * CASE WHEN k = 0 THEN sqrt(1.0::DOUBLE / 32) ELSE sqrt(2.0::DOUBLE / 32) END AS c FROM range(32) a(n), range(8) b(k)), "
    "joint AS (SELECT k, j, sum(c * w) AS w FROM basis JOIN tri ON tri.i = basis.n GROUP BY 1, 2), "
    "half AS (SELECT vec_id, b.k AS fy, c.x, sum(b.w * c.v) AS v FROM cell c JOIN joint b ON b.j = c.y GROUP BY 1, 2, 3), "
    "freq AS (SELECT vec_id, h.fy, b.k AS fx, sum(b.w * h.v) AS v FROM half h JOIN joint b ON b.j = h.x GROUP BY 1, 2, 3), "
    "bits AS (SELECT vec_id, fy * 8 + fx AS p, v > median(v) OVER (PARTITION BY vec_id) AS b FROM freq), "
    "u AS (SELECT vec_id, sum(CASE WHEN b THEN power(2::HUGEINT, 63 - p)::HUGEINT ELSE 0 END)::HUGEINT AS u FROM bits GROUP BY vec_id) "
    "SELECT vec_id, CAST(CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END AS BIGINT) AS phash FROM u",
)
_feature = lambda s, d: P.collected(read(s, d, 8))
#: At 64 x 64 each value is a square of 8 x 8, so brightness is that of the values; other features are held by tests.
QUERIES["p12_features"] = lambda s, d: _feature(s, d).select("vec_id", "ok", "w", "h", "lum_mean", "lum_std", "edge_mean", "uniform_pct", "ncolors16", F.round("blur_var", 6).alias("blur_var"), "transparent_score", "logo_score", "phash")
_add(
    "p10_p12_brightness", lambda s, d: _feature(s, d).select("vec_id", "ok", "w", F.col("transparent_score").isNotNull().alias("scored"), "lum_mean"),
    f"WITH {_GREY} SELECT vec_id, {_GOOD} AS ok, CASE WHEN {_GOOD} THEN 64 END AS w, {_GOOD} AS scored, CASE WHEN {_GOOD} THEN round_even(list_avg(g), 2) END AS lum_mean FROM g",
)
