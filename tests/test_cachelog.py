"""The cache's log against a plain dictionary, and how little of it a small batch reads."""

from siftstone.operators import cachelog


def test_log_by_plain_dictionary(spark, tmp_path):
    path, known = str(tmp_path / "cache"), {}
    keys = spark.createDataFrame([(f"p{i}", i) for i in range(0, 4000, 3)] + [("p3", 3), (None, 0)], "path string, lines int")
    assert cachelog.lookup(keys, path)[0].count() == 0 and cachelog.missing(keys, path).count() == keys.count() and cachelog.appends(spark, path) == []
    for n, (low, high) in enumerate([(0, 1500), (1000, 1800), (5000, 5001)]):
        part = {f"p{i}": f"{n}:{i}" if i % 5 else None for i in range(low, high)}
        rows = spark.createDataFrame([(k, v, 1) for k, v in part.items()] + [(None, "x", 1)], "path string, lines string, bucket int")
        assert cachelog.append(rows, path, buckets=16 if n == 0 else 99) == n
        known |= part
    found, read = cachelog.lookup(keys, path)
    assert {r.path: r.lines for r in found.collect()} == {f"p{i}": known[f"p{i}"] for i in range(0, 4000, 3) if f"p{i}" in known}
    assert cachelog.appends(spark, path) == [0, 1, 2]
    few = spark.createDataFrame([("p7",), ("none",), ("nothing",)], "path string")
    got, read_few = cachelog.lookup(few, path)
    assert [tuple(r) for r in got.collect()] == [("p7", "0:7")] and 1 <= read_few <= 3 < read <= 33
    assert sorted(r.path for r in cachelog.missing(few, path).collect()) == ["none", "nothing"]
    assert cachelog.lookup(few.limit(0), path)[1] == 0
    # A lost append, without its filter, isn't seen and is written anew.
    spark.createDataFrame([("p7", "lost", 0)], "key string, value string, bucket int").write.partitionBy("bucket").parquet(f"{path}/log/append=3")
    assert [tuple(r) for r in cachelog.lookup(few, path)[0].collect()] == [("p7", "0:7")]
    assert cachelog.append(spark.createDataFrame([("p7", "new")], "path string, lines string"), path) == 3
    assert [tuple(r) for r in cachelog.lookup(few, path)[0].collect()] == [("p7", "new")]
