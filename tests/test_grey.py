"""Grey values of the stand-in pictures against SQL, also where single precision rounds to the next whole number."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siftstone.plans import files, pixels


@pytest.mark.parametrize("name", ["p4_p7_grey", "p5_edges", "p8_blur", "p1_p2_pictures", "p3_shrunk", "p14_picture_hash"])
def test_values_just_below_a_whole_number(spark, tmp_path, name):
    rows = [[(i * 37 + j * j * 11) % 97 / 64 for j in range(64)] for i in range(4)]
    rows[1][5], rows[2][40], rows[2][7] = -1e-9, -3e-9, 1 / 64 - 1e-10
    pq.write_table(pa.table({"vec_id": [0, 1, 2, 4], "embedding": pa.array(rows, pa.list_(pa.float32()))}), tmp_path / "embeddings.parquet")
    queries, sql = files.QUERIES | pixels.QUERIES, files.ORACLE | pixels.ORACLE
    got = queries[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
