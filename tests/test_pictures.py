"""Picture files: every kind of PNG and BMP against plain encoders, broken files, and files written by tasks."""

import struct
import zlib

import numpy as np
import pytest

from siftstone.operators import pixels
from siftstone.sources import pictures, readers


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def filtered(rows, step, kinds):
    """Rows of bytes, filtered byte by byte as the format says."""
    out = b""
    for y, row in enumerate(rows):
        kind, line = kinds(y), []
        for i, v in enumerate(row):
            a, b = (int(row[i - step]) if i >= step else 0), (int(rows[y - 1][i]) if y else 0)
            c = int(rows[y - 1][i - step]) if y and i >= step else 0
            p = a + b - c
            best = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((int(v) - (0, a, b, (a + b) // 2, best)[kind]) % 256)
        out += bytes([kind, *line])
    return out


def packed(x, depth):
    """Rows of samples as bytes, most significant first."""
    if depth == 16:
        return [b"".join(bytes([v, 77]) for v in row) for row in x.reshape(len(x), -1)]
    return [bytes(np.packbits(np.array([[(v >> k) & 1 for k in range(depth - 1, -1, -1)] for v in row], np.uint8).ravel())) for row in x.reshape(len(x), -1).tolist()]


def encode(x, colour, depth, kinds=lambda y: y % 5, palette=None, interlaced=False):
    channels = x.shape[2]
    step = max(1, channels * depth // 8)
    passes = [(0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)] if interlaced else [(0, 0, 1, 1)]
    raw = b"".join(filtered(packed(x[a::c, b::d], depth), step, kinds) for a, b, c, d in passes if x[a::c, b::d].size)
    body = zlib.compress(raw)
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", x.shape[1], x.shape[0], depth, colour, 0, 0, int(interlaced)))
    return b"\x89PNG\r\n\x1a\n" + head + (chunk(b"PLTE", palette.tobytes()) if palette is not None else b"") + chunk(b"tEXt", b"k\0v") + chunk(b"IDAT", body[:7]) + chunk(b"IDAT", body[7:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("interlaced", [False, True])
@pytest.mark.parametrize(("colour", "depth"), [(0, 1), (0, 2), (0, 4), (0, 8), (0, 16), (2, 8), (2, 16), (3, 1), (3, 4), (3, 8), (4, 8), (4, 16), (6, 8), (6, 16)])
def test_png(colour, depth, interlaced):
    rng = np.random.default_rng(colour * 100 + depth)
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    top = min(depth, 8)
    for h, w in ((1, 1), (7, 5), (13, 19)):
        x = rng.integers(0, 1 << top, (h, w, channels)).astype(np.uint8)
        palette = rng.integers(0, 256, (1 << top, 3)).astype(np.uint8) if colour == 3 else None
        want = palette[x[:, :, 0]] if colour == 3 else x[:, :, :3] if channels > 2 else np.repeat(x[:, :, :1].astype(int) * 255 // ((1 << top) - 1), 3, axis=2)
        assert (pictures.png(encode(x, colour, depth, palette=palette, interlaced=interlaced)) == want).all()


def test_bmp_and_own_encoders():
    rng = np.random.default_rng(2)
    for h, w in ((1, 1), (6, 7), (9, 4)):
        x = rng.integers(0, 256, (h, w, 3)).astype(np.uint8)
        assert (pictures.bmp(pictures.encode_bmp(x)) == x).all() and (pictures.png(pictures.encode_png(x, lambda y: y % 3)) == x).all()
        for depth in (1, 4, 8):
            palette = rng.integers(0, 256, (1 << depth, 4)).astype(np.uint8)
            index = rng.integers(0, 1 << depth, (h, w))
            rows = [r + b"\0" * (-len(r) % 4) for r in packed(index[::-1], depth)]
            body = b"BM" + struct.pack("<IHHI", 0, 0, 0, 54 + palette.size) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, depth, 0, 0, 0, 0, 0, 0) + palette.tobytes() + b"".join(rows)
            assert (pictures.bmp(body) == palette[index][:, :, 2::-1]).all()
        down = pictures.encode_bmp(x[::-1])
        assert (pictures.bmp(down[:22] + struct.pack("<i", -h) + down[26:]) == x).all()


def test_broken_files_are_rows(spark):
    good = pictures.encode_png(np.arange(64, dtype=np.uint8).reshape(8, 8))
    bad = {
        "empty": b"", "null": None, "half": good[:60], "sum": good[:45] + b"\0" + good[46:], "gif": b"GIF89a", "no header": good[:8], "huge": good[:16] + b"\x7f\xff\xff\xff" * 2 + good[24:],
        "short": good[:8] + good[8:33] + chunk(b"IDAT", zlib.compress(b"\0" * 9)) + chunk(b"IEND", b""), "filter": good[:33] + chunk(b"IDAT", zlib.compress((b"\7" + b"\0" * 8) * 8)) + chunk(b"IEND", b""),
        "bmp": pictures.encode_bmp(np.zeros((4, 4), np.uint8))[:60], "not zlib": good[:33] + chunk(b"IDAT", b"abc") + chunk(b"IEND", b""),
    }
    rows = [(f"/x/{k}", v, 1) for k, v in bad.items()] + [("/x/good", good, 1), ("/x/good", good, 1), (None, good, 1)]
    got = pictures.decoded(spark.createDataFrame(rows, "path string, content binary, ok int")).collect()
    assert len(got) == len(rows) and sum(r.ok for r in got) == 3 and all(bool(r.error) != r.ok and (r.rgb is None) != r.ok for r in got)
    by = {r.filename: r for r in got}
    assert by["sum"].error == "checksum of IDAT" and by["half"].error == "chunk ends early" and by["short"].error == "pixel data ends early" and by["filter"].error == "row filter 7"
    assert (by["good"].w, by["good"].h, by["good"].bytes, by["empty"].bytes) == (8, 8, len(good), 0)
    own = pictures.decoded(spark.createDataFrame([("a", b"\x02\x01\x05\x06", 1)], "path string, content binary, w int"), lambda c: np.frombuffer(c[2:], np.uint8).reshape(c[1], c[0], 1).repeat(3, axis=2)).first()
    assert bytes(own.rgb) == b"\5\5\5\6\6\6"


def test_files_and_features(spark, tmp_path):
    rng = np.random.default_rng(3)
    noise, large = rng.integers(0, 256, (48, 64, 3)).astype(np.uint8), np.kron(rng.integers(0, 256, (8, 16)), np.ones((128, 64))).astype(np.uint8)
    rows = [("a/noise.png", pictures.encode_png(noise)), ("b/c/large.PNG", pictures.encode_png(large)), ("ERR/x.png", b"x"), ("none.png", b""), ("_no/none.png", b""), ("b/none.txt", b""), ("bad.bmp", b"BM")]
    done = pictures.write_files(spark.createDataFrame(rows, "path string, content binary"), str(tmp_path))
    assert {r.path: r.bytes for r in done.collect()} == {p: len(c) for p, c in rows}
    assert done.count() == len(rows)  # a second time, over the same files
    assert sorted(r.filename for r in readers.images(spark, str(tmp_path)).collect()) == ["bad.bmp", "large.PNG", "noise.png", "none.png"]
    got = {r.filename: r for r in pixels.collected(pictures.pictures(spark, str(tmp_path))).collect()}
    assert got["none.png"].error == "empty file" and not got["bad.bmp"].ok and got["bad.bmp"].lum_mean is None
    grey = pixels.luma(noise)
    assert got["noise.png"].lum_mean == round(float(grey.mean()), 2) and got["noise.png"].ncolors16 == 16 and got["noise.png"].logo_score == pixels.mark_scores(grey)[1]
    small = got["large.PNG"]  # scaled to half its size, in which the squares stay
    plain = large[::2, ::2].astype(float)
    assert (small.w, small.h) == (1024, 1024) and abs(small.lum_mean - plain.mean()) < 0.5 and abs(small.lum_std - plain.std()) < 2
    pixel = pixels.greyed(pictures.pictures(spark, str(tmp_path)).filter("ok")).filter("filename = 'noise.png'").first()
    assert pixel.pixels == grey.ravel().tolist() and pixels.collected(pictures.decoded(spark.createDataFrame([], "path string, content binary"))).count() == 0


def test_luma_rounds_as_whole_numbers():
    x = np.array([[[255, 255, 255], [0, 0, 0], [10, 200, 30]]], np.uint8)
    assert pixels.luma(x).tolist() == [[255.0, 0.0, float((19595 * 10 + 38470 * 200 + 7471 * 30 + 32768) >> 16)]]
