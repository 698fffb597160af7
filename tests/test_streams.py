"""Resumed runs, stalls and the best match against plain versions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from siftstone.operators import similarity
from siftstone.streaming import resume, stalls


def deliver(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_runs_take_up_where_the_last_ended(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema, judge = "path string, n int", lambda rows: rows.withColumn("twice", F.col("n") * 2)
    for low in range(0, 40, 10):
        deliver(spark, source, [(f"p{i}", i) for i in range(low, low + 12)], schema)
    run = lambda f=judge, limit=None: resume.run_available(spark, source, schema, f, sink, check, "path", limit, 1)
    assert run(limit=15) == 22  # two batches: 12, and 10 that are new
    assert sorted(r.n for r in resume.results(spark, sink).collect()) == list(range(22))

    def broken(rows):
        judge(rows).write.mode("overwrite").parquet(f"{sink}/batch=2")  # what a lost run may have left
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(broken)
    assert run() == 20 and run() == 0
    assert sorted((r.n, r.twice) for r in resume.results(spark, sink).collect()) == [(i, 2 * i) for i in range(42)]
    deliver(spark, source, [("p0", 0), ("p99", 99), (None, 1), (None, 2)], schema)
    assert run() == 2  # a new item, and one without a key
    total = spark.createDataFrame([(i,) for i in range(88)], "n int")
    got = resume.progress(spark, sink, total).first()
    assert (got.done, got.total, got.percent) == (44, 88, 50.0) and resume.progress(spark, sink, total.limit(0)).first().percent == 0.0
    again = resume.run_available(spark, source, schema, judge, f"{sink}-2", f"{check}-2", "path")  # a new checkpoint starts over
    assert again == 44
    assert resume.run_available(spark, source, schema, judge, f"{sink}-3", f"{check}-3") == 52  # without a key every row counts


def test_stalls_by_plain_loops(spark, tmp_path):
    rng, start = random.Random(4), datetime.datetime(2024, 5, 1, tzinfo=datetime.timezone.utc)
    rows = [(f"f{i}", start + datetime.timedelta(seconds=t)) for i in range(12) for t in sorted(rng.sample(range(0, 90_000, 7), rng.choice([1, 3, 40])))]
    rows += [rows[0], rows[0], (None, start), ("gone", None)]
    source = str(tmp_path / "in")
    for low in (0, 30_000, 60_000):  # deliveries in order of time, items in any
        part = [r for r in rows if r[1] is not None and low <= (r[1] - start).total_seconds() < low + 30_000]
        rng.shuffle(part)
        deliver(spark, source, part + [("gone", None)], "item string, at timestamp")
    last, patience = max(t for _, t in rows if t), datetime.timedelta(hours=2)
    want = set()
    for item in {i for i, t in rows if t}:
        times = sorted(t for i, t in rows if i == item and t)
        ends = [*times[1:], last - datetime.timedelta(minutes=1)]
        stalled = [t + patience for t, e in zip(times, ends, strict=True) if e - t > patience]
        if len(stalled) > 1:
            want.add((item, stalled[1], 2))
    signs = spark.readStream.schema("item string, at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    found = stalls.quarantined(signs, "2 hours", 2, "1 minute")
    found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("item", F.unix_micros("at").alias("us"), "stalls").collect()
    assert len(want) > 3 and {(r.item, r.us, r.stalls) for r in got} == {(i, int(t.timestamp()) * 1_000_000, n) for i, t, n in want}


def test_best_match_at_any_distance(spark):
    rng = random.Random(5)
    signed = lambda h: h - (1 << 64) * (h >> 63)
    known = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    asked = [known[0], known[1] ^ 1, known[2] ^ 0x8000000000000001, *(k ^ sum(1 << b for b in rng.sample(range(64), n)) for k, n in zip(known[3:20], range(3, 20), strict=False)), *(rng.getrandbits(64) for _ in range(30))]
    items = spark.createDataFrame([(i, signed(h), 1) for i, h in enumerate(asked)] + [(0, signed(asked[0]), 1), (900, None, 1), (None, signed(asked[5]), 1)], "id long, phash long, best int")
    library = spark.createDataFrame([(signed(k),) for k in known + known[:3]] + [(None,)], "hash long")
    got = similarity.best_match(items, library, "id").collect()
    best = lambda h: max(1 - (h ^ k).bit_count() / 64 for k in known)
    assert sorted(((r.id is None, r.id or 0), r.best_similarity) for r in got) == sorted([((False, i), best(h)) for i, h in enumerate(asked)] + [((False, 0), best(asked[0])), ((False, 900), 0.0), ((True, 0), best(asked[5]))])
    far = spark.createDataFrame([(1, 0)], "id long, phash long")
    for h, s in ((-1, 0.0), (0, 1.0), ((1 << 40) - 1, 1 - 40 / 64)):
        assert [r.best_similarity for r in similarity.best_match(far, spark.createDataFrame([(h,)], "hash long"), "id").collect()] == [s]
    assert similarity.best_match(far, library.limit(0), "id").first().best_similarity == 0.0 and similarity.best_match(items.limit(0), library, "id").count() == 0
