"""Features of pictures, from arrays of pixels or from decoded files (`sources/pictures.py`).

A picture is a row (pixels array<double> in row order, w, h). Whole batches of pictures go to numpy by Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType


def shrunk(g: np.ndarray, most: int = 512) -> np.ndarray:
    """A grey picture scaled down, by bilinear area weights, to `most` on its longer side; smaller ones stay as they are."""
    h, w = g.shape
    scale = most / max(h, w, 1)
    return g if scale >= 1 else resized(g, max(1, int(h * scale)), max(1, int(w * scale)))


def _weights(n: int, m: int) -> np.ndarray:
    """m x n weights of a triangle filter whose width follows the scale."""
    scale = n / m
    reach = max(scale, 1.0)
    centre = (np.arange(m) + 0.5) * scale
    away = np.abs(np.arange(n)[None, :] + 0.5 - centre[:, None]) / reach
    w = np.maximum(1 - away, 0)
    return w / w.sum(axis=1, keepdims=True)


def resized(g: np.ndarray, h: int, w: int) -> np.ndarray:
    return _weights(g.shape[0], h) @ g @ _weights(g.shape[1], w).T


def statistics(g: np.ndarray) -> dict[str, float]:
    """Mean and spread of brightness, mean gradient, share of pixels near the mean."""
    gy, gx = (np.gradient(g, axis=a) if g.shape[a] > 1 else np.zeros_like(g) for a in (0, 1))
    mean = float(g.mean())
    return {"lum_mean": mean, "lum_std": float(g.std()), "edge_mean": float(np.sqrt(gx**2 + gy**2).mean()), "uniform_pct": float((np.abs(g - mean) < 6).mean())}


def laplacian(g: np.ndarray) -> np.ndarray:
    """Sum of the four neighbours less four times the pixel; beyond the edge the picture is mirrored at its last row."""
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g


def box_mean(g: np.ndarray, size: int) -> np.ndarray:
    """Mean of the size x size pixels about each, mirrored at the edges."""
    r = size // 2
    s = np.pad(np.pad(g, r, mode="reflect").cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (s[size:, size:] - s[:-size, size:] - s[size:, :-size] + s[:-size, :-size]) / (size * size)


def edges(g: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Edge pixels: steep ones, thinned across the slope, and fainter ones that hang together with a steep one."""
    p = np.pad(g, 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    m = np.abs(gx) + np.abs(gy)
    q = np.pad(m, 1)
    at = lambda dy, dx: q[1 + dy : 1 + dy + m.shape[0], 1 + dx : 1 + dx + m.shape[1]]
    flat, steep = np.abs(gy) < 0.4142 * np.abs(gx), np.abs(gy) > 2.4142 * np.abs(gx)
    same = gx * gy >= 0
    before = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(same, at(-1, -1), at(-1, 1))))
    after = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(same, at(1, 1), at(1, -1))))
    thin = (m > before) & (m >= after)
    weak, found = thin & (m > low), thin & (m > high)
    while True:
        q = np.pad(found, 1)
        grown = weak & (q[:-2, :-2] | q[:-2, 1:-1] | q[:-2, 2:] | q[1:-1, :-2] | q[1:-1, 1:-1] | q[1:-1, 2:] | q[2:, :-2] | q[2:, 1:-1] | q[2:, 2:])
        if (grown == found).all():
            return found
        found = grown


def mark_scores(g: np.ndarray) -> tuple[float | None, float | None]:
    """(score of see-through marks, score of graphic marks); none of pictures under 40 on a side."""
    h, w = g.shape
    if h < 40 or w < 40:
        return None, None
    bright = edges(np.where(g > 210, 255.0, 0.0)).mean()
    spread = np.sqrt(np.maximum(box_mean(g**2, 21) - box_mean(g, 21) ** 2, 0))
    through = 0.5 * (bright > 0.015) + 0.3 * ((spread < 3.0).mean() > 0.5)
    e = edges(g)
    ratio, bh, bw = e.mean(), h // 4, w // 4
    shares = np.array([e[y : y + bh, x : x + bw].mean() for y in range(0, h - bh, bh // 2) for x in range(0, w - bw, bw // 2)])
    graphic = 0.3 * (shares.max(initial=0.0) > 0.15) + 0.3 * (((shares > 3 * ratio) & (shares > 0.05)).sum() >= 3) + 0.2 * (laplacian(g).var() > 500) + 0.2 * (ratio > 0.08)
    return round(float(through), 3), round(float(graphic), 3)


def _waves(n: int, size: int) -> np.ndarray:
    """8 x n weights: n values scaled to `size`, then their 8 lowest cosine frequencies. Sums go term by term, as SQL's do."""
    at = np.arange(size)
    basis = np.cos(np.outer(2 * at + 1, np.arange(8)) * np.pi / (2 * size)) * np.sqrt(2.0 / size)
    basis[:, 0] = np.sqrt(1.0 / size)
    return (basis[:, :, None] * _weights(n, size)[:, None, :]).sum(axis=0)


def frequencies(g: np.ndarray, size: int = 32) -> np.ndarray:
    """The 8 x 8 lowest cosine frequencies of the picture at size x size.

    Weights of both steps are joined first, then rows and then columns are summed in their order: where two frequencies tie
    about the median the last places decide, so they follow SQL's terms.
    """
    down, across = (_waves(n, size) for n in g.shape)
    half = np.stack([(w[:, None] * g).sum(axis=0) for w in down])
    return (half.T[:, :, None] * across.T[:, None, :]).sum(axis=0)


def perceptual_hash(g: np.ndarray) -> int:
    """64 bits, first to last most significant first, as a signed number: set where a frequency exceeds the median."""
    f = frequencies(g).ravel()
    h = int("".join("1" if x else "0" for x in f > np.median(f)), 2)
    return h - (1 << 64) * (h >> 63)


def colours16(pixels: np.ndarray) -> int:
    """How many of 16 colours a picture (rows x columns x 3) of 32 x 32 needs: cells are split at the median of their widest channel."""
    small = np.stack([resized(pixels[:, :, c].astype(float), 32, 32) for c in range(3)], axis=2).round().reshape(-1, 3)
    cells = [small]
    while len(cells) < 16:
        wide = [np.ptp(c, axis=0).max() if len(c) else 0 for c in cells]
        k = int(np.argmax(wide))
        if wide[k] == 0:
            break
        c = cells.pop(k)
        channel = int(np.argmax(np.ptp(c, axis=0)))
        c = c[np.argsort(c[:, channel], kind="stable")]
        cut = np.searchsorted(c[:, channel], c[len(c) // 2, channel])
        cut = cut if cut else np.searchsorted(c[:, channel], c[0, channel], side="right")
        cells += [c[:cut], c[cut:]]
    return len(cells)


def _per_picture(rows: DataFrame, f: Callable[[np.ndarray], dict], fields: list[StructField]) -> DataFrame:
    """rows without pixels, with what f says of each picture; a picture without pixels has nulls."""
    at = {c: i for i, c in enumerate(rows.columns)}
    kept = [c for c in rows.columns if c != "pixels"]
    names = [x.name for x in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in names}
            for x, w, h in zip(b.column(at["pixels"]), b.column(at["w"]).to_pylist(), b.column(at["h"]).to_pylist(), strict=True):
                good = x.is_valid and w and h and len(x) == w * h
                said = f(np.asarray(x.values.to_numpy(zero_copy_only=False), float).reshape(h, w)) if good else {}
                for n in names:
                    out[n].append(said.get(n))
            made = [pa.array(out[x.name], pa.int64() if isinstance(x.dataType, LongType) else pa.float64()) for x in fields]
            yield pa.RecordBatch.from_arrays([*(b.column(at[c]) for c in kept), *made], names=[*kept, *names])

    return rows.mapInArrow(run, StructType([*rows.select(*kept).schema.fields, *fields]))


def grey_statistics(rows: DataFrame, most: int = 512) -> DataFrame:
    """Adds lum_mean, lum_std, edge_mean, uniform_pct and blur_var of pictures at `most` on the longer side, unrounded."""
    names = ("lum_mean", "lum_std", "edge_mean", "uniform_pct", "blur_var")

    def of(g: np.ndarray) -> dict:
        small = shrunk(g, most)
        return statistics(small) | {"blur_var": float(laplacian(small).var())}

    return _per_picture(rows, of, [StructField(n, DoubleType()) for n in names])


def hashed(rows: DataFrame) -> DataFrame:
    """Adds phash."""
    return _per_picture(rows, lambda g: {"phash": perceptual_hash(g)}, [StructField("phash", LongType())])


def marked(rows: DataFrame) -> DataFrame:
    """Adds transparent_score and logo_score."""
    return _per_picture(rows, lambda g: dict(zip(("transparent_score", "logo_score"), mark_scores(g), strict=True)), [StructField(n, DoubleType()) for n in ("transparent_score", "logo_score")])


def luma(rgb: np.ndarray) -> np.ndarray:
    """Grey values of rows x columns x 3, rounded to whole numbers as picture libraries do."""
    r, g, b = (rgb[:, :, c].astype(np.int64) for c in range(3))
    return ((19595 * r + 38470 * g + 7471 * b + 32768) >> 16).astype(float)


def _of_files(rows: DataFrame, f: Callable[[np.ndarray], dict], fields: list[StructField]) -> DataFrame:
    """Decoded pictures without rgb, with what f says of each; a broken file has nulls."""
    kept = [c for c in rows.columns if c != "rgb"]
    schema = StructType([*rows.select(*kept).schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {x.name: [] for x in fields}
            for rgb, w, h in zip(b.column("rgb"), b.column("w").to_pylist(), b.column("h").to_pylist(), strict=True):
                good = rgb.is_valid and w and h
                said = f(np.frombuffer(rgb.as_buffer(), np.uint8).reshape(h, w, 3)) if good else {}
                for x in fields:
                    out[x.name].append(said.get(x.name))
            made = [pa.array(out[x.name], _ARROW[x.dataType.simpleString()]) for x in fields]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *made], names=[*kept, *out])

    return rows.mapInArrow(run, schema)


_ARROW = {"double": pa.float64(), "bigint": pa.int64(), "int": pa.int32(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def greyed(rows: DataFrame) -> DataFrame:
    """Decoded pictures with pixels array<double>, their grey values row after row, in place of rgb."""
    return _of_files(rows, lambda x: {"pixels": luma(x).ravel()}, [StructField("pixels", ArrayType(DoubleType()))])


def collected(rows: DataFrame, most: int = 512) -> DataFrame:
    """All quick features of decoded pictures in one pass: rows without rgb, with lum_mean, lum_std, edge_mean, uniform_pct
    (rounded as reports show them), ncolors16, blur_var at `most` pixels on the longer side, transparent_score and logo_score
    of the whole picture, and phash. A broken file has nulls. A task holds one picture beside its batch."""

    def of(x: np.ndarray) -> dict:
        grey = luma(x)
        scale = most / max(grey.shape)
        to = (max(1, int(grey.shape[0] * scale)), max(1, int(grey.shape[1] * scale)))
        small = x if scale >= 1 else np.stack([resized(x[:, :, c].astype(float), *to) for c in range(3)], axis=2).round()
        g = luma(small)
        s = statistics(g)
        through, graphic = mark_scores(grey)
        return {
            "lum_mean": round(s["lum_mean"], 2), "lum_std": round(s["lum_std"], 2), "edge_mean": round(s["edge_mean"], 3), "uniform_pct": round(s["uniform_pct"], 4),
            "ncolors16": colours16(small), "blur_var": float(laplacian(g).var()), "transparent_score": through, "logo_score": graphic, "phash": perceptual_hash(grey),
        }

    doubles = ("lum_mean", "lum_std", "edge_mean", "uniform_pct", "blur_var", "transparent_score", "logo_score")
    return _of_files(rows, of, [*(StructField(n, DoubleType()) for n in doubles), StructField("ncolors16", IntegerType()), StructField("phash", LongType())])
