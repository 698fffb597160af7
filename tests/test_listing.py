"""Listings by tasks: what Spark's own listing gives, and empty files too, without a task for every 32 files."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siftstone.sources import pictures, readers


def _tree(top):
    for name in ("a.png", "b c%20.PNG", "_x.png", ".y.png", "sub/d.png", "sub/deep/e.png", "_no/f.png", "_k=1/g.png", "sub/ERR/h.png", "z.txt"):
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(b"x" * len(name))
    (top / "none.png").write_bytes(b"")


def test_tasks_list_what_spark_lists(spark, tmp_path):
    _tree(tmp_path)
    want = {(r.path, r.length) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "length").collect()}
    rows = pictures.files(spark, str(tmp_path)).collect()
    assert {(r.path, r.length) for r in rows} == want | {(f"file:{tmp_path}/none.png", 0)}
    assert all(r.modificationTime is not None for r in rows)
    assert [r.path.rsplit("/", 1)[1] for r in pictures.files(spark, str(tmp_path), False).orderBy("path").collect()] == ["a.png", "b c%20.PNG", "none.png", "z.txt"]
    assert [r.filename for r in readers.images(spark, f"{tmp_path}/", True).collect()] == [r.filename for r in readers.images(spark, str(tmp_path)).collect()]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(40 * spark.sparkContext.defaultParallelism):
        (tmp_path / f"f{i}.png").write_bytes(b"x")
    found = readers.images(spark, str(tmp_path), False)
    parts = pictures.names(spark, str(tmp_path)).rdd.getNumPartitions()
    assert found.count() == 40 * spark.sparkContext.defaultParallelism and parts <= spark.sparkContext.defaultParallelism
    assert "binaryFile" not in found._jdf.queryExecution().toString()  # its listing is the driver's


def test_a_folder_of_more_names_than_go_out_at_once(spark, tmp_path, monkeypatch):
    for i in range(7):
        os.mkdir(tmp_path / f"s{i}")
        (tmp_path / f"s{i}" / "x.png").write_bytes(b"x")
    fs, base = pictures.filesystem(str(tmp_path))
    monkeypatch.setattr(pictures, "LISTED", 3)
    some = list(pictures._entries(fs, base))
    assert [len(x) for x in some] == [3, 3, 1] and all(folder for x in some for _, folder in x)
    assert list(pictures._entries(fs, f"{base}/gone")) == []
    assert pictures.files(spark, str(tmp_path)).agg(F.count("*")).first()[0] == 7


def test_a_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.images(spark, str(tmp_path / "nowhere")).collect()
