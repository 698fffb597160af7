"""Training, capped checks and moves of files against plain loops."""

import hashlib

import numpy as np
import pytest

from siftstone.operators import moves, sampling, training
from siftstone.sources import pictures


def plain_training(x, y, valid, n_epochs, s):
    """The same steps on whole arrays."""
    d = x.shape[1] + 1
    w, mean, square, steps, out = np.zeros(d), np.zeros(d), np.zeros(d), 0, []
    a = np.c_[x, np.ones(len(x))]
    for _ in range(n_epochs):
        for _ in range(s.steps):
            p = 1 / (1 + np.exp(-(a[~valid] @ w)))
            g = (a[~valid] * (p - y[~valid])[:, None]).mean(axis=0) + s.shrink * np.r_[w[:-1], 0]
            steps += 1
            mean, square = s.keep * mean + (1 - s.keep) * g, s.keep_square * square + (1 - s.keep_square) * g**2
            w = w - s.rate * (mean / (1 - s.keep**steps)) / (np.sqrt(square / (1 - s.keep_square**steps)) + 1e-8)
        said = 1 / (1 + np.exp(-(a[valid] @ w))) >= s.threshold
        t = y[valid] == 1
        out.append((int((said & t).sum()), int((said & ~t).sum()), int((~said & t).sum()), int((~said & ~t).sum()), w.copy()))
    return out


def test_training_by_plain_steps_and_resumed(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 6)).round(3)
    y = (x[:, 0] - 0.5 * x[:, 3] + rng.normal(0, 0.3, 400) > 0.2).astype(int)
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(400)]
    odd = [(900, None, 1), (901, [1.0, None] * 3, 1), (902, [float("nan")] * 6, 0), (903, [1.0], 1), (904, [1.0] * 6, None), (905, [1.0] * 6, 2), (906, [], 1)]
    df = spark.createDataFrame(rows + odd, "id int, features array<double>, label int")
    s = training.Settings(steps=5, rate=0.1)
    whole = training.train(df, str(tmp_path / "a"), 4, s).orderBy("epoch").collect()
    order = sorted(range(400), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    valid = np.zeros(400, bool)
    valid[order[:60]] = True
    for r, (tp, fp, fn, tn, w) in zip(whole, plain_training(x, y, valid, 4, s), strict=True):
        assert (r.tp, r.fp, r.fn, r.tn, r.n_train, r.n_valid) == (tp, fp, fn, tn, 340, 60) and np.allclose(r.weights, w, atol=1e-6)
    training.train(df.repartition(7), str(tmp_path / "b"), 2, s)
    resumed = training.train(df.repartition(3, "label"), str(tmp_path / "b"), 4, s).orderBy("epoch").collect()
    assert [tuple(r) for r in resumed] == [tuple(r) for r in whole]  # to the last bit, in another layout
    figures = training.metrics(training.epochs(spark, str(tmp_path / "b"))).orderBy("epoch").collect()
    assert figures[-1].accuracy > 0.85 and figures[-1].valid_loss < figures[0].valid_loss
    other = training.train(df.filter("id <> 3"), str(tmp_path / "b"), 1, s).collect()  # other data start over
    assert len(other) == 1 and other[0].n_train + other[0].n_valid == 399

    assert training.train(df.limit(0), str(tmp_path / "d"), 2, s).count() == 0
    p = {r.id: r.prob for r in training.scored(df, whole[-1].weights).collect()}
    assert all(abs(p[i] - 1 / (1 + np.exp(-(x[i] @ whole[-1].weights[:-1] + whole[-1].weights[-1])))) < 1e-12 for i in range(400)) and p[900] is None and all(p[i] is None for i in (901, 902, 903, 906))


def test_capped_after_a_check(spark):
    order = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    df = spark.createDataFrame([(i, i % 11) for i in range(3000)], "id int, _rank2 int")
    for rule, good, n, most in ((f"id % {7} <> 0", lambda i: i % 7, 200, 320), ("id % 10 = 0", lambda i: i % 10 == 0, 50, 1200), ("id < 0", lambda i: False, 5, 3000), ("true", lambda i: True, 5000, 3000), ("true", lambda i: True, 0, 0)):
        asked = []

        def check(rows, rule=rule, asked=asked):
            asked.append(rows.count())
            return rows.filter(rule)

        got = [r.id for r in sampling.cap_checked(df, n, "id", check).collect()]
        assert sorted(got) == sorted([i for i in order if good(i)][:n]) and sum(asked) <= most, (rule, asked)
    assert sampling.cap_checked(df.limit(0), 3, "id", lambda r: r).count() == 0


def test_moves_survive_a_fault(spark, tmp_path):
    root, journal = str(tmp_path / "files"), str(tmp_path / "journal")
    rows = [(f"a/f{i}", f"body {i}") for i in range(60)] + [("b/taken", "old")]
    pictures.write_files(spark.createDataFrame(rows, "path string, content string"), root).collect()
    plan = [(f"a/f{i}", f"c/{i % 4}/f{i}") for i in range(40)] + [("a/none", "c/none"), ("a/f50", "b/taken"), ("a/f51", "c/same"), ("a/f52", "c/same"), ("a/f53", "a/f53"), (None, "x"), ("a/f1", "c/other"), ("a/f0", "c/0/f0")]
    moves.intend(spark.createDataFrame(plan, "src string, dst string"), root, journal)

    def fault(src):
        if src.endswith("7"):
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        moves.carry_out(spark, root, journal, fault)
    before = {str(p.relative_to(root)) for p in (tmp_path / "files").rglob("f*") if p.is_file()}
    assert any(p.startswith("c/") for p in before) and any(p.startswith("a/") for p in before)
    done = moves.carry_out(spark, root, journal)
    said = {r.src: (r.dst, r.outcome) for r in done.collect()}
    assert said == {f"a/f{i}": (f"c/{i % 4}/f{i}", "moved") for i in range(40)} | {"a/none": ("c/none", "missing"), "a/f51": ("c/same", "moved")}
    assert tuple(moves.counts(done).first()) == (41, 1) and (tmp_path / "files/c/3/f7").read_text() == "body 7" and (tmp_path / "files/b/taken").read_text() == "old"
    moves.intend(spark.createDataFrame([("a/f55", "c/late")], "src string, dst string"), root, journal)  # the journal stands
    assert moves.carry_out(spark, root, journal).count() == 42 and (tmp_path / "files/a/f55").exists()
    (tmp_path / "files/a/f2").write_text("new")  # a place taken since stays as it is
    back = moves.take_back(spark, root, journal, str(tmp_path / "undo"))
    assert tuple(moves.counts(back).first()) == (40, 0) and (tmp_path / "files/a/f2").read_text() == "new" and (tmp_path / "files/c/2/f2").exists() and (tmp_path / "files/a/f7").read_text() == "body 7"
    with pytest.raises(Exception, match="no finished"):
        moves.carry_out(spark, root, str(tmp_path / "nowhere"))


def test_batches_and_small_tables(spark, tmp_path, monkeypatch):
    from siftstone.operators import evaluate, rows
    from siftstone.sources import batches, readers, sinks

    (tmp_path / "one/images").mkdir(parents=True)
    (tmp_path / "two/Pass").mkdir(parents=True)
    (tmp_path / "three").mkdir()
    at = str(tmp_path)
    assert batches.resolve(f"{at}/one/") == (f"{at}/one/images", f"{at}/one") and batches.resolve(f"{at}/one/images") == (f"{at}/one/images", f"{at}/one")
    assert batches.resolve(f"{at}/two/Pass") == (f"{at}/two/Pass", f"{at}/two") and batches.resolve(f"{at}/three") == (f"{at}/three", f"{at}/three")
    with pytest.raises(NotADirectoryError):
        batches.resolve(f"{at}/none")
    (tmp_path / "batch.txt").write_text(f"{at}/three\n")
    assert batches.current(spark, f"{at}/batch.txt", "SOME_BATCH", "/d") == f"{at}/three" and batches.current(spark, f"{at}/none.txt", None, "/d") == "/d"
    monkeypatch.setenv("SOME_BATCH", f"{at}/one")
    assert batches.current(spark, f"{at}/batch.txt", "SOME_BATCH") == f"{at}/one"
    paths = spark.createDataFrame([("b",), ("a",), ("a",), (None,), (" ",)], "path string")
    sinks.write_paths(paths, f"{at}/list")
    assert [r.path for r in readers.path_list(spark, f"{at}/list").orderBy("path").collect()] == ["a", "b"]
    ours, theirs = spark.createDataFrame([("A",), ("b",), (None,)], "filename string"), spark.createDataFrame([("B",), ("c",)], "filename string")
    sides = evaluate.compared(ours, theirs)
    assert {r.filename: r.side for r in sides.collect()} == {"a": "ours", "b": "both", "c": "theirs"} and tuple(evaluate.retrospect(sides).first()) == (2, 2, 1, 0.5)
    assert evaluate.status(paths, paths.limit(0), "path").first().pct == 0 and evaluate.status(paths.limit(0), paths, "path").first().pct == 0
    assert [r.path for r in rows.unseen(paths, spark.createDataFrame([("a",)], "path string"), "path").collect() if r.path and r.path != " "] == ["b"]
    assert [tuple(r) for r in rows.duplicate_groups(paths, "path").collect()] == [("a", 2)] and rows.present(paths, paths.limit(0), "path").count() == 0


@pytest.mark.parametrize("per_pass", [None, 3])
def test_the_loop_is_that_of_judging_all_again(spark, per_pass):
    from siftstone.operators import learning

    rng = np.random.default_rng(8)
    centres = rng.integers(0, 1 << 62, 12)
    hashes = [int(centres[i % 12]) ^ (1 << int(rng.integers(62)) if rng.random() < 0.6 else 0) if rng.random() < 0.9 else None for i in range(160)]
    rows = [(f"f{i}", ["KEEP", "MOVE", "REVIEW"][int(rng.integers(3))], h, bool(rng.random() < 0.5)) for i, h in enumerate(hashes)]
    human, library = {f"f{i}" for i in range(0, 160, 3)} | {"other"}, {hashes[1] or 5, 77}
    df = spark.createDataFrame(rows, "filename string, decision string, phash long, said boolean")
    out, known, n = learning.learn(df, spark.createDataFrame([(x,) for x in human], "filename string"), spark.createDataFrame([(x,) for x in library], "hash long"), per_pass)
    state, lib, learned, passes = {k: d for k, d, _, _ in rows}, set(library), {}, 0
    while True:
        new = {h for k, _, h, s in rows if state[k] != "MOVE" and k in human and s and h is not None} - lib
        if per_pass is not None:
            new = set(sorted(new, key=lambda h: (hashlib.md5(f"42:{h}".encode()).hexdigest(), h))[:per_pass])
        if not new:
            break
        passes += 1
        lib |= new
        for k, _, h, _ in rows:  # everything is judged again
            if state[k] != "MOVE" and h is not None and any((h ^ x).bit_count() <= 1 for x in new):
                state[k], learned[k] = "MOVE", passes
    assert {r.filename: (r.decision, r.learned_in) for r in out.collect()} == {k: (d, learned.get(k)) for k, d in state.items()}
    assert {r.hash for r in known.collect()} == lib and n == passes > 0
