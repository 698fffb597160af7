"""Pictures whose 32nd and 33rd frequency are equal but for rounding: the hash follows the terms of its SQL."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from siftstone.operators.pixels import frequencies
from siftstone.plans import pixels

GREY = {
    144: "78837a85787d78918e7c88718486827e8594748683797b6e7b83837e838a7d8c817a807d6f858184817b807e788a84787f757b80837c7a7e79877f7b82747595",
    4372: "8e9381837677877f80847c8d807b837d7a7f7a79797a837c758381868479817b7e8f7b808a82728f8684868284776d787e7b807f7b819287727e957f797a7c82",
    10364: "6f888780848386957e84897888867c8c797b87768981788475847e81867b9187867f8278777b8078817a89827e7b7d8986878c8b817479807c88877f817d928d",
    18181: "78807c877c7e8689737578837e81867e83758585737e807c7c7e7793938383877b827a728c7c7f877b85817c7a7a85818e84828977758b8b82767d877d767f69",
}


def test_hash_of_ties_about_the_median(spark, tmp_path):
    values = [[(x - 128) / 64 for x in bytes.fromhex(g)] for g in GREY.values()]
    pq.write_table(pa.table({"vec_id": list(GREY), "embedding": pa.array(values, pa.list_(pa.float32()))}), tmp_path / "embeddings.parquet")
    got = pixels.QUERIES["p14_picture_hash"](spark, str(tmp_path))
    con = duckdb.connect(config={"threads": 1})  # with more, the SQL adds in another order and differs from itself on such pictures
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.execute(f"SELECT vec_id, phash FROM ({pixels.ORACLE['p14_picture_hash']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_frequencies_of_pictures_of_any_shape():
    for shape in ((8, 8), (1, 5), (40, 7), (64, 100)):
        g = np.arange(shape[0] * shape[1], dtype=float).reshape(shape) % 251
        n, k = np.arange(32), np.arange(8)
        basis = np.cos(np.outer(2 * n + 1, k) * np.pi / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))
        assert np.allclose(frequencies(g), basis.T @ pixels.P.resized(g, 32, 32) @ basis, atol=1e-9)
