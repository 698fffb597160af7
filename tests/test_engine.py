"""The rule engine against expected verdicts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.functions import lexicon
from siftstone.functions import text as T
from siftstone.operators import decide, evaluate, offline, pixels, rows, sampling, similarity
from siftstone.sources import readers, scratch, sinks

CASES = [
    ("visit https://acme.example/x", "KEEP", "none"), ("https://acme.com/x free shipping", "MOVE", "url"), ("19@mail5.example.com", "MOVE", "url"),
    ("info@acme.com", "MOVE", "contact"), ("call 800-555-1234", "MOVE", "contact"), ("tel: 123-456-7890", "KEEP", "none"), ("price $12.50", "MOVE", "price"),
    ("$0100120", "KEEP", "none"), ("Special Price today", "MOVE", "promo"), ("fast shipping worldwide", "KEEP", "none"), ("worldwide shipping", "KEEP", "none"),
    ("Genuine eBay parts", "MOVE", "ecommerce"), ("shutterstock", "MOVE", "watermark"), ("sample copyright", "REVIEW", "review"),
    ("authorized dealer", "MOVE", "overlay"), ("https://acme.com authorized dealer", "KEEP", "none"), ("warehouse 12", "REVIEW", "review"), ("MFG.CO", "KEEP", "none"),
    ("overall width 12 mm", "KEEP", "none"), ("现货供应", "MOVE", "watermark"), ("微信号 abc", "MOVE", "contact"), ("whatsapp me", "KEEP", "none"),
    ("13812345678", "KEEP", "none"), ("only 3 left", "KEEP", "none"), ("only $3 left", "MOVE", "price"), ("dealmed rf-performance", "KEEP", "none"), ("20 USD", "MOVE", "price"),
]
ITEM = "id int, ok boolean, w int, h int, lum_std double, uniform_pct double, ncolors16 int, qr array<string>, lines array<struct<text:string,conf:double>>"


def item(i, line=None, conf=0.9, ok=True, w=800, h=800, std=60.0, uniform=0.5, colours=16, qr=(), lines=None):
    return (i, ok, w, h, std, uniform, colours, list(qr), lines if lines is not None else [(line, conf)] if line else [])


def test_text_cases(spark):
    got = decide.decide(spark.createDataFrame([item(i, t) for i, (t, _, _) in enumerate(CASES)], ITEM)).select("id", "decision", "rule").collect()
    assert {CASES[r.id][0]: (r.decision, r.rule) for r in got} == {t: (d, r) for t, d, r in CASES}


def test_a_match_is_judged_whole_and_shown_short(spark):
    """What decides is the whole match; reports have 80 characters of it. Digits are those of any script."""
    lines = ["$" + "1" * 90 + ".50", "$" + "1" * 90, "电话：１３８１２３４５６７８", "tel: １２３４５６７８９０", "https://" + "a" * 100 + ".com/x"]
    df = spark.createDataFrame([(i, [(x, 0.9)]) for i, x in enumerate(lines)], "id int, lines array<struct<text:string,conf:double>>")
    got = {r.id: r for r in T.analyzed(df).select("id", F.col("_a_prices").alias("prices"), F.col("_a_contacts").alias("contacts"), F.col("_a_urls").alias("urls")).collect()}
    assert len(got[0].prices) >= 1 and all(len(p) <= 80 for p in got[0].prices) and not got[1].prices
    assert any("１３８１２３４５６７８" in c for c in got[2].contacts)
    assert [len(u) for u in got[4].urls] == [80] * len(got[4].urls) and got[4].urls


def test_feature_cases(spark):
    made = [
        (item(0, ok=False), "MOVE"), (item(1, w=79), "MOVE"), (item(2, w=80, h=99), "MOVE"), (item(3, w=80, h=100), "REVIEW"), (item(4, std=4.99, uniform=0.97), "MOVE"),
        (item(5, std=5.0, uniform=0.97), "REVIEW"), (item(6, qr=["x"]), "REVIEW"), (item(7, "ACME", colours=3), "MOVE"), (item(8, "free shipping", conf=0.5), "KEEP"),
        (item(9, lines=[("x", 0.9)] * 60 + [("free shipping", 0.9)]), "KEEP"), (item(10, lines=None), "KEEP"),
    ]
    got = {r.id: r.decision for r in decide.decide(spark.createDataFrame([x for x, _ in made], ITEM)).collect()}
    assert got == {x[0]: d for x, d in made}


def test_model_and_duplicates(spark):
    d = spark.createDataFrame([(i, "KEEP", "none", ["e"], 0.0, p) for i, p in enumerate([0.3, 0.29999, 0.15, 0.14999, None])], "id int, decision string, rule string, evidence array<string>, score double, prob double")
    assert [r.decision for r in decide.refine_by_model(d).orderBy("id").collect()] == ["MOVE", "REVIEW", "REVIEW", "KEEP", "KEEP"]
    g = spark.createDataFrame([("m1", "MOVE"), ("m1", "KEEP"), ("m2", "KEEP"), ("m2", "REVIEW"), (None, "MOVE"), (None, "KEEP"), ("m3", "KEEP")], "md5 string, decision string")
    out = rows.propagate(g.withColumns({"rule": F.lit("r"), "score": F.lit(0.0), "evidence": F.array(F.lit("e"))})).collect()
    assert sum(r.changed for r in out) == 1 and sum(r.decision == "MOVE" for r in out) == 3
    (moved,) = [r for r in out if r.changed]
    assert (moved.rule, moved.score, moved.evidence) == ("duplicate", 1.0, ["与同指纹图片联动（MD5 m1…）"]) and lexicon.RULES["duplicate"] == "重复图片(指纹联动)"


@pytest.mark.parametrize("flip, near", [(0, True), (1, True), (3, False)])
def test_library(spark, flip, near):
    items = spark.createDataFrame([(1, -5 ^ flip)], "id long, phash long")
    assert (similarity.match_library(items, spark.createDataFrame([(-5,)], "hash long"), "id").count() == 1) is near


def test_metrics_without_moves(spark):
    none = spark.createDataFrame([("TN",), ("FN",)], "outcome string")
    assert evaluate.metrics(none).first().asDict() == {"tp": 0, "fp": 0, "fn": 1, "tn": 1, "precision": 0.0, "recall": 0.0, "f1": 0.0, "agreement": 0.5}


def test_keep_last_log(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"k":"a","v":1}\nbad\n{"k":"b","v":2}\n{"k":"a","v":3}\n')
    got = readers.json_lines(spark, str(tmp_path / "log.jsonl"), "k string, v int", "k").collect()
    assert {(r.k, r.v) for r in got} == {("a", 3), ("b", 2)}


def test_resume(spark, tmp_path):
    from siftstone.streaming.resume import run_available

    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.range(5).write.parquet(src)
    for _ in range(2):
        run_available(spark, src, "id long", lambda d: d.withColumn("x", F.col("id") * 2), out, ck)
    assert spark.read.parquet(out).count() == 5


def test_hits_are_stripped_and_cut(spark):
    d = spark.createDataFrame([(1, [("tel: 555 867 1234 now", 0.9)]), (2, [("see www." + "a" * 100 + ".com", 0.9)])], "id int, lines array<struct<text:string,conf:double>>")
    got = {r.id: r for r in T.analyzed(d).collect()}
    assert got[1]["_a_contacts"] == ["tel: 555 867 1234"] and len(got[2]["_a_urls"][0]) == 80


def test_evidence_and_order(spark):
    made = [item(1, lines=[("write to b@c.org", 0.9), ("or a@b.org, it's wechat", 0.9)]), item(2, w=79), item(3, "sample copyright"), item(4, std=4.5, uniform=0.98), item(5, "ACME", colours=3)]
    got = {r.id: r.evidence for r in decide.decide(spark.createDataFrame(made, ITEM)).collect()}
    assert got[2] == ["尺寸过小 79x800"] and got[3] == ["疑似水印(弱信号): ['copyright', 'sample']"] and got[4] == ["纯色/空白图 std=4.50 uniform=98.00%"]
    assert got[5] == ["纯LOGO/品牌图（文字简短、色彩少 ncolors=3）"] and got[1] == ["联系方式: ['b@c.org', 'a@b.org', 'wechat']"]
    unsure = decide.decide(spark.createDataFrame([item(1, "sample copyright")], ITEM), review_moves=True).first()
    assert (unsure.decision, unsure.rule, unsure.score) == ("MOVE", "unsure", 1.0)
    failed = decide.rescue(decide.decide(spark.createDataFrame([item(1)], ITEM)).withColumn("error", F.lit("x"))).first()
    assert (failed.decision, failed.rule, failed.evidence) == ("MOVE", "failed", ["异常: x"])


def test_shards_are_the_same_in_every_layout(spark):
    ids = spark.range(200_000).select((F.xxhash64("id") % 10**12).alias("k")).repartition(8)
    for _ in range(2):
        got = np.array([(r.k, r.shard) for r in sampling.shards(ids, 32, "k").collect()])
        got = got[np.argsort(got[:, 0], kind="stable")]
        assert (got[:, 1] == np.arange(200_000) // 6250).all()
    assert sampling.shards(ids.limit(0), 3, "k").count() == 0
    assert sampling.split(ids.limit(3), 0.1, "k").filter("part = 'valid'").count() == 1


def test_caps_of_large_classes(spark):
    d = spark.range(5000).select("id", (F.col("id") % 3).alias("y"))
    got = sampling.cap_per_class(d, "y", {0: 7, 1: 2000}, "id")
    assert {r.y: r["count"] for r in got.groupBy("y").count().collect()} == {0: 7, 1: 1667}


def test_names_that_clash_on_disk(spark):
    moves = spark.createDataFrame([(f"/p{i}", n) for i, n in enumerate(["a.jpg", "a.jpg", "a.jpg", "b", "c.tar.gz", "c.tar.gz"])], "path string, filename string")
    taken = spark.createDataFrame([("a.jpg",), ("a_2.jpg",), ("zz",)], "filename string")
    assert [r.target for r in rows.clash_names(moves, taken=taken).orderBy("path").collect()] == ["a_1.jpg", "a_3.jpg", "a_4.jpg", "b", "c.tar.gz", "c.tar_1.gz"]
    assert [r.target for r in rows.clash_names(moves).orderBy("path").collect()] == ["a.jpg", "a_1.jpg", "a_2.jpg", "b", "c.tar.gz", "c.tar_1.gz"]


def test_logs_and_caches(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"path":"p","lines":[["a ",0.9],["",1],["b"],["c","x"]]}\n\n{"path":"q","lines":null}\n')
    got = {r.path: [x.text for x in r.lines] for r in readers.cached_lines(spark, str(tmp_path / "c.jsonl")).collect()}
    assert got == {"p": ["a"], "q": []}
    (tmp_path / "d.jsonl").write_text('{"path":"p","lines":[]}\n{bad\n')
    assert readers.cached_lines(spark, str(tmp_path / "d.jsonl")).count() == 0 and readers.cached_lines(spark, str(tmp_path / "d.jsonl"), "DROPMALFORMED").count() == 1
    with pytest.raises(Exception):  # noqa: B017
        readers.json_lines(spark, str(tmp_path / "d.jsonl"), "path string", bad="FAILFAST").collect()


def test_report_round_trip(spark, tmp_path):
    judged = decide.decide(spark.createDataFrame([item(1, "free shipping"), item(2), item(3, w=100)], ITEM)).withColumns({"filename": F.concat(F.lit("f"), "id"), "orig_path": F.concat(F.lit("/o/"), "id")})
    sinks.write_report(judged, str(tmp_path), "2026-01-01T00:00:00")
    back = {r["文件名"]: r["决策"] for r in readers.report(spark, str(tmp_path / "report.csv")).collect()}
    assert back == {"f1": "MOVE", "f2": "KEEP", "f3": "REVIEW"} and [r.path for r in readers.path_list(spark, str(tmp_path / "move_plan.txt")).collect()] == ["/o/1"]
    s = spark.read.json(str(tmp_path / "summary.json")).first()
    assert s.generated_at == "2026-01-01T00:00:00" and s.summary.moved == 1 and s.summary.by_rule.asDict() == {"5-促销/免费配送信息": 1}


def test_pixels(spark):
    rng = np.random.default_rng(1)
    flat, noisy = np.full((60, 80), 90.0), rng.integers(0, 256, (60, 80)).astype(float)
    lined = np.full((64, 64), 100.0)
    lined[20:44, 20:44] = 255
    pictures = [(1, flat.ravel().tolist(), 80, 60), (2, noisy.ravel().tolist(), 80, 60), (3, None, None, None), (4, lined.ravel().tolist(), 64, 64), (5, [1.0], 3, 3)]
    df = spark.createDataFrame(pictures, "id int, pixels array<double>, w int, h int")
    got = {r.id: r for r in pixels.grey_statistics(df).collect()}
    assert got[1].lum_std == 0 and got[1].uniform_pct == 1 and got[1].blur_var == 0 and got[3].lum_mean is None and got[5].lum_mean is None
    assert abs(got[2].lum_std - noisy.std()) < 1e-9
    direct = sum((noisy[y, x] - noisy.mean()) ** 2 for y in range(60) for x in range(80)) / 4800
    assert abs(got[2].lum_std ** 2 - direct) < 1e-6
    near = lambda p: pixels.perceptual_hash(p)
    assert {r.id: r.phash for r in pixels.hashed(df).collect()}[2] == near(noisy) and near(noisy) == near(noisy + 3)
    assert pixels.shrunk(np.zeros((1024, 10))).shape == (512, 5) and pixels.mark_scores(np.zeros((39, 100))) == (None, None)
    edge = pixels.edges(lined)
    assert edge.any() and not edge[28:36, 28:36].any() and not pixels.edges(flat).any()
    scores = {r.id: r for r in pixels.marked(df).collect()}
    assert scores[1].transparent_score == 0.3 and scores[1].logo_score == 0
    assert pixels.colours16(np.zeros((40, 40, 3))) == 1 and pixels.colours16(rng.integers(0, 256, (64, 64, 3))) == 16
    two = np.zeros((32, 32, 3))
    two[:, 16:] = 200
    assert pixels.colours16(two) == 2


def test_offline_parts(spark):
    items_ = spark.createDataFrame([("f1", "/x/f1"), ("f2", "/x/f2"), ("f3", "/x/f3")], "filename string, path string")
    present = spark.createDataFrame([("/x/f1",), ("/b/f1",), ("/b/f2",)], "path string")
    got = {r.filename: r.found for r in offline.first_present(items_, present, [F.col("path"), F.concat(F.lit("/b/"), "filename")]).collect()}
    assert got == {"f1": "/x/f1", "f2": "/b/f2", "f3": None}
    assert scratch.once(items_).count() == 3 and sinks.quarantined(items_.union(items_).select("path")).count() == 3
