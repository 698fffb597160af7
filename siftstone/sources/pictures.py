"""Pictures: files of pixels as rows, and rows of content as files.

Contents come through Spark's binary source, which packs them into tasks by their bytes; listings without
contents are made by tasks. PNG and BMP are decoded here, other
formats by a function of the caller's. A broken file is a row that says why, and stops no other.
"""

from __future__ import annotations

import itertools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.sources.scratch import once

PICTURE = "path string, filename string, bytes long, ok boolean, error string, w int, h int, rgb binary"
FLUSH = 16 << 20  # bytes of pixels that a task holds before they go out
LISTED = 5000  # names of a folder that go out at once
MOST = 1 << 28  # pixels of a picture: more is an error of the file, not of the job


def _hidden(name: str) -> bool:
    """What Spark's file sources take for no data."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(fs: pyarrow.fs.FileSystem, folder: str) -> Iterator[list[tuple[str, bool]]]:
    """(name, whether it is a folder) of what a folder holds, some thousands at a time where the store is local."""
    if fs.type_name == "local":
        try:
            with os.scandir(folder) as found:
                while some := list(itertools.islice(found, LISTED)):
                    yield [(x.name, x.is_dir()) for x in some]
        except FileNotFoundError:  # gone since its parent was listed
            pass
    else:
        found = fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        for at in range(0, len(found), LISTED):
            yield [(x.base_name, x.type == pyarrow.fs.FileType.Directory) for x in found[at : at + LISTED]]


def files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of the files of a folder, also empty ones; what begins with a dot or a line below is no data.

    Spark's file sources list a folder in the driver and deal out its files by a fixed cost each, thousands of tasks for
    small ones, and pass over empty files. Here tasks list folders, level by level, and look at files dealt out evenly;
    nothing of the listing reaches the driver.
    """
    fs, base = filesystem(folder)
    if fs.get_file_info(base).type != pyarrow.fs.FileType.Directory:  # a file, a pattern, or nothing at all: as Spark has it
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime", "length")
    top = f"file:{base}" if fs.type_name == "local" else folder.rstrip("/")
    dealt = spark.sparkContext.defaultParallelism

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for b in batches:
            for below in b.column(0).to_pylist():
                for some in _entries(fs, base + below):
                    some = [x for x in some if not _hidden(x[0])]
                    yield pa.record_batch({"below": pa.array([f"{below}/{name}" for name, _ in some], pa.string()), "folder": pa.array([f for _, f in some], pa.bool_())})

    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for b in batches:
            below = b.column(0).to_pylist()
            found = fs.get_file_info([base + x for x in below]) if below else []
            there = [(top + x, f.mtime, f.size) for x, f in zip(below, found, strict=True) if f.type == pyarrow.fs.FileType.File]
            columns = zip(*there, strict=True) if there else ((), (), ())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.timestamp("us", "UTC"), pa.int64()), strict=True)], names=["path", "modificationTime", "length"])

    level, out = spark.createDataFrame([("",)], "below string"), []
    while not level.isEmpty():
        seen = once(level.repartition(dealt).mapInArrow(entries, "below string, folder boolean"))
        out.append(seen.filter("NOT folder").select("below"))
        level = seen.filter("folder").select("below") if recursive else level.limit(0)
    rows = out[0]
    for o in out[1:]:
        rows = rows.unionByName(o)
    return rows.repartition(dealt).mapInArrow(looked_at, "path string, modificationTime timestamp, length long")


def empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime, length, content) of files without a byte, which Spark's file sources pass over."""
    return files(spark, folder).filter("length = 0").withColumn("content", F.lit(b""))


def _wanted(found: DataFrame, folder: str, recursive: bool, extensions: tuple[str, ...], skipped: tuple[str, ...]) -> DataFrame:
    top = folder.rstrip("/")
    below = F.expr(f"substring(path, {len(top) + 1} + greatest(locate('{top}', path) - 1, 0))")
    parts = F.split(F.regexp_replace(below, "^/", ""), "/")
    folders = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda x: F.lower(x))
    found = found if recursive else found.filter(F.size(parts) == 1)
    found = found.filter(~F.exists(folders, lambda x: x.isin(*skipped))) if skipped else found
    return found.filter(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*extensions))


def names(spark: SparkSession, folder: str, recursive: bool = True, extensions: tuple[str, ...] = L.IMAGE_EXTENSIONS, skipped: tuple[str, ...] = L.SKIPPED_FOLDERS) -> DataFrame:
    """(path, modificationTime, length): as `listed`, where no content is wanted."""
    return _wanted(files(spark, folder, recursive), folder, recursive, extensions, skipped)


def listed(spark: SparkSession, folder: str, recursive: bool = True, extensions: tuple[str, ...] = L.IMAGE_EXTENSIONS, skipped: tuple[str, ...] = L.SKIPPED_FOLDERS) -> DataFrame:
    """(path, modificationTime, length, content): files of the wanted endings outside of skipped folders, also empty ones."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).unionByName(empty_files(spark, folder))
    return _wanted(found, folder, recursive, extensions, skipped)


def _unfiltered(raw: bytes, rows: int, size: int, step: int) -> np.ndarray:
    """Bytes of a PNG's rows, each filtered by its neighbour to the left (step bytes before), above, or both."""
    if len(raw) < rows * (size + 1):
        raise ValueError("pixel data ends early")
    out, above = np.zeros((rows, size), np.uint8), np.zeros(size, np.uint8)
    for y in range(rows):
        kind, line = raw[y * (size + 1)], np.frombuffer(raw, np.uint8, size, y * (size + 1) + 1)
        if kind == 0:
            now = line
        elif kind == 1:
            now = np.empty(size, np.uint8)
            for c in range(step):
                now[c::step] = np.cumsum(line[c::step], dtype=np.uint8)
        elif kind == 2:
            now = line + above
        elif kind in (3, 4):
            up, row = above.tolist(), line.tolist()
            for i in range(size):
                a, b = (row[i - step] if i >= step else 0), up[i]
                if kind == 3:
                    by = (a + b) >> 1
                else:
                    c = up[i - step] if i >= step else 0
                    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    by = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                row[i] = (row[i] + by) & 255
            now = np.array(row, np.uint8)
        else:
            raise ValueError(f"row filter {kind}")
        out[y] = above = now
    return out


def _samples(rows: np.ndarray, w: int, channels: int, depth: int) -> np.ndarray:
    """(rows, w, channels) of samples of 1 to 16 bits; 16 bits keep their upper half."""
    if depth == 16:
        return rows[:, ::2].reshape(len(rows), w, channels)
    if depth == 8:
        return rows.reshape(len(rows), w, channels)
    bits = np.unpackbits(rows, axis=1)[:, : w * depth].reshape(len(rows), w, depth)
    return np.packbits(bits, axis=2)[:, :, 0].reshape(len(rows), w, 1) >> (8 - depth)


def png(content: bytes) -> np.ndarray:
    """Rows x columns x 3 of a PNG; transparency is left aside. Checksums, sizes and filters are verified."""
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG signature")
    at, head, palette, data = 8, None, None, []
    while at + 8 <= len(content):
        (size,), kind = struct.unpack_from(">I", content, at), content[at + 4 : at + 8]
        body = content[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(content):
            raise ValueError("chunk ends early")
        if zlib.crc32(kind + body) != struct.unpack_from(">I", content, at + 8 + size)[0]:
            raise ValueError(f"checksum of {kind.decode('latin-1')}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None:
        raise ValueError("no header")
    w, h, depth, colour, _, _, interlaced = head
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colour)
    if channels is None or depth not in (1, 2, 4, 8, 16) or not 0 < w * h <= MOST:
        raise ValueError("header out of range")
    raw = zlib.decompressobj().decompress(b"".join(data), h * (w * channels * 2 + 8) + (h + 64) * 16)
    out, read = np.zeros((h, w, channels), np.uint8), 0
    # Interlaced pictures are seven smaller ones: first row and column, and the steps to the next.
    passes = [(0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)] if interlaced else [(0, 0, 1, 1)]
    for y, x, dy, dx in passes:
        part = out[y::dy, x::dx]
        if part.size:
            size = (part.shape[1] * channels * depth + 7) // 8
            lines = _unfiltered(raw[read:], len(part), size, max(1, channels * depth // 8))
            part[:] = _samples(lines, part.shape[1], channels, depth)
            read += len(part) * (size + 1)
    if colour == 3:
        if palette is None or out.max() >= len(palette):
            raise ValueError("palette too small")
        return palette[out[:, :, 0]]
    if channels < 3:
        grey = out[:, :, :1].astype(np.int64) * 255 // ((1 << depth) - 1) if depth < 8 else out[:, :, :1]
        return np.repeat(grey, 3, axis=2).astype(np.uint8)
    return out[:, :, :3]


def bmp(content: bytes) -> np.ndarray:
    """Rows x columns x 3 of an uncompressed BMP of 1, 4, 8, 24 or 32 bits a pixel."""
    if content[:2] != b"BM" or len(content) < 54:
        raise ValueError("no BMP header")
    start, size, w, h, _, depth, packed = struct.unpack_from("<I4x", content, 10)[0], *struct.unpack_from("<IiiHHI", content, 14)
    upside, h = h > 0, abs(h)
    if packed or depth not in (1, 4, 8, 24, 32) or w <= 0 or not 0 < w * h <= MOST:
        raise ValueError("compressed BMP or header out of range")
    stride = (w * depth + 31) // 32 * 4
    if len(content) < start + stride * h:
        raise ValueError("pixel data ends early")
    rows = np.frombuffer(content, np.uint8, stride * h, start).reshape(h, stride)
    if depth <= 8:
        many = struct.unpack_from("<I", content, 46)[0] or 1 << depth
        palette = np.frombuffer(content, np.uint8, 4 * many, 14 + size).reshape(-1, 4)[:, 2::-1]
        index = _samples(rows[:, : (w * depth + 7) // 8], w, 1, depth)[:, :, 0]
        if index.max() >= len(palette):
            raise ValueError("palette too small")
        out = palette[index]
    else:
        out = rows[:, : w * depth // 8].reshape(h, w, depth // 8)[:, :, 2::-1]
    return out[::-1] if upside else out


def decode(content: bytes) -> np.ndarray:
    if content[:2] == b"BM":
        return bmp(content)
    if content[:4] == b"\x89PNG":
        return png(content)
    raise ValueError("no decoder for this format" if content else "empty file")


def decoded(files: DataFrame, decoder: Callable[[bytes], np.ndarray] = decode) -> DataFrame:
    """(path, filename, bytes, ok, error, w, h, rgb) of rows (path, content); rgb holds three bytes a pixel, row after row.

    What the decoder raises is the error; w, h and rgb are null then. A null content is an empty file,
    a null path stays null, repeated rows are decoded each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("filename", pa.string()), ("bytes", pa.int64()), ("ok", pa.bool_()), ("error", pa.string()), ("w", pa.int32()), ("h", pa.int32()), ("rgb", pa.binary())])
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                content = content.as_py() or b""
                name = path.rsplit("/", 1)[-1] if path is not None else None
                try:
                    x = decoder(content)
                    rows.append((path, name, len(content), True, None, x.shape[1], x.shape[0], np.ascontiguousarray(x).tobytes()))
                except Exception as e:  # whatever a decoder raises on a broken file
                    rows.append((path, name, len(content), False, str(e) or type(e).__name__, None, None, None))
                held += len(rows[-1][-1] or b"")
                if held > FLUSH or len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.select("path", "content").mapInArrow(run, PICTURE)


def pictures(spark: SparkSession, folder: str, recursive: bool = True, extensions: tuple[str, ...] = L.IMAGE_EXTENSIONS, skipped: tuple[str, ...] = L.SKIPPED_FOLDERS, decoder: Callable[[bytes], np.ndarray] = decode) -> DataFrame:
    """Decoded pictures of a folder; see `listed` and `decoded`."""
    return decoded(listed(spark, folder, recursive, extensions, skipped), decoder)


def encode_png(x: np.ndarray, row_filter: Callable[[int], int] = lambda y: 0) -> bytes:
    """A PNG of 8 bits a sample: rows x columns (grey) or rows x columns x 3; row_filter: 0 to 2, the filter of a row."""
    rows = x.reshape(len(x), -1)
    step = 1 if x.ndim == 2 else 3
    lines = []
    for y, row in enumerate(rows):
        kind = row_filter(y)
        before = {0: 0, 1: np.r_[np.zeros(step, np.uint8), row[:-step]], 2: rows[y - 1] if y else 0}[kind]
        lines.append(bytes([kind]) + (row - before).astype(np.uint8).tobytes())
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", x.shape[1], x.shape[0], 8, 0 if step == 1 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


def encode_bmp(x: np.ndarray) -> bytes:
    """A BMP of 24 bits a pixel, bottom row first."""
    x = np.repeat(x[:, :, None], 3, axis=2) if x.ndim == 2 else x
    h, w = x.shape[:2]
    rows = np.zeros((h, (3 * w + 3) // 4 * 4), np.uint8)
    rows[:, : 3 * w] = x[::-1, :, ::-1].reshape(h, -1)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 0, 0, 0, 0) + rows.tobytes()


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path there) of a folder, for work in tasks; paths without a scheme are local ones."""
    bare = folder.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(f"file:///{bare.lstrip('/')}" if bare.startswith("/") else folder)


def write_files(rows: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """(path, bytes) of files that tasks have written below a folder, one for each row; nothing is written before the result is read.

    A file is written beside its place and then put there, so that a task that runs twice leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = filesystem(folder)
        made: set[str] = set()
        for b in batches:
            sizes = []
            for name, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                at, body = f"{top}/{name}", body.as_py() or b""
                parent = at.rsplit("/", 1)[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                with fs.open_output_stream(f"{at}.writing") as out:
                    out.write(body)
                fs.move(f"{at}.writing", at)
                sizes.append(len(body))
            yield pa.record_batch({"path": b.column(0), "bytes": pa.array(sizes, pa.int64())})

    return rows.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content")).mapInArrow(run, "path string, bytes long")
