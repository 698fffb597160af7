"""The newest log is found without every file's name going to the driver."""

import os

import pytest

from siftstone.sources import readers


def test_newest_reads_one_file(spark, tmp_path, monkeypatch):
    for i in range(60):
        (tmp_path / f"run_{i}.log").write_text(f"tail {i}")
        os.utime(tmp_path / f"run_{i}.log", (1000 + i % 50, 1000 + i % 50))
    (tmp_path / "run_98.log").write_text("")
    (tmp_path / "other.txt").write_text("later")
    loaded, load = [], type(spark.read).load
    monkeypatch.setattr(type(spark.read), "load", lambda self, path, *a, **k: loaded.append(path) or load(self, path, *a, **k))
    assert [tuple(r) for r in readers.newest(spark, f"{tmp_path}/run_*.log", 3).select("tail").collect()] == [(" 49",)]
    assert loaded == [f"{tmp_path}/run_49.log"]


@pytest.mark.parametrize("name", ["a[1].log", "a{x}.log"])
def test_newest_of_a_name_that_reads_like_a_pattern(spark, tmp_path, name):
    (tmp_path / name).write_text("hello")
    assert [r.tail for r in readers.newest(spark, f"{tmp_path}/*.log", 9).collect()] == ["hello"]
