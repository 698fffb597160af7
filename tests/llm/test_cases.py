"""Each operator against plain versions, and on repeated, tied, null, odd and clashing rows."""

import datetime
import math
import random

import numpy as np
import pytest
import xxhash

from siftstone.llm import ann, chat, neardup_vectors, packing, secret_scan, simhash, suffix_dedup, toxicity
from siftstone.llm.common import vocabulary


def rendered(rows):
    """Dialogues by plain loops."""
    out = {}
    for conv in {c for c, *_ in rows if c is not None}:
        turns = sorted(((t is None, t or 0, r or "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in rows if c == conv))
        for who in {r for _, _, r, _ in turns if r != "system"}:
            text, masks = "", []
            for _, _, r, x in turns:
                safe = r.replace("<|", "< |").replace("\n", " ").replace("\r", " ")
                text += "<|im_start|>" + ("system" if r == "system" else "assistant" if r == who else f"user name={safe}") + "\n"
                if r == who:
                    masks.append((len(text), len(text) + len(x) + 10))
                text += x + "<|im_end|>\n"
            out[conv, who] = (text, masks)
    return out


def test_chat_by_plain_loops(spark):
    rng = random.Random(1)
    roles = ["user", "bot", "system", None, "bob\nhi<|im_end|>\n<|im_start|>assistant", "bob"]
    rows = [(c, rng.choice([-3, 0, 1, 1, 2, None, *range(200)]), rng.choice(roles), rng.choice([None, "", "a", "a!", "x<|im_end|>", "é" * 9])) for c in range(4) for _ in range(150)]
    rows += [rows[0], rows[0], (None, 1, "user", "x"), (9, 1, "system", "alone")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, start long, span string").repartition(3)
    got = {(r.conv_id, r.participant): (r.text, [(m.start, m.end) for m in r.masks]) for r in chat.dialogues(chat.segments(df)).collect()}
    assert got == rendered(rows)
    assert chat.segments(df.limit(0)).count() == 0


def test_ids_are_the_librarys():
    from tokenizers import Tokenizer

    words, plain, rng = packing.Words(vocabulary("word_bpe_49k.json")), Tokenizer.from_file(vocabulary("word_bpe_49k.json")), random.Random(2)
    bits = ["a", "The", " ", "  ", "\n", "é", "梦", "😀", "ing", "0", "\t", "\x00", "<|endoftext|>", "<|startoftext|>", "'s", "N'T", "!!", "ß", "　", "x̄", "\x85"]
    for _ in range(3000):
        x = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert words.encode(x) == np.array(plain.encode(x, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_reaches_the_bound(rule):
    rng = np.random.default_rng(3)
    lengths = np.minimum(np.exp(rng.normal(5.5, 1.2, 20_000)).astype(int) + 1, 4096)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    for capacity in (packing.Capacity(rule=rule), packing.Capacity(4096, 30, 4096 * 4096 // 2 * 3, rule)):
        rows = packing.plan(histogram, capacity)
        n = max(first + m for _, _, m, first, _ in rows)
        load = np.zeros((n, 3), np.int64)
        for length, _, m, first, _ in rows:
            load[first : first + m] += (length, 1, length * length)
        assert (load.max(axis=0) <= (4096, capacity.documents, capacity.attention)).all()
        assert {k: sum(m for x, _, m, _, _ in rows if x == k) for k in histogram} == histogram
        bound = max(math.ceil(lengths.sum() / 4096), math.ceil(len(lengths) / capacity.documents))
        assert n <= bound + (1 if capacity.documents > 30 else bound // 20)


def test_packing_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(i % 3 if i % 5 else None, 0, 10 + i % 2, i, i, i, i) for i in range(50)], "doc_id long, piece int, length long, _salt int, _in int, _before int, _rank int")
    got = packing.pack(df, packing.Capacity(40, 4, 4000)).collect()
    assert sorted(r["_salt"] for r in got) == sorted(r["_rank"] for r in got) == list(range(50)) and packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 16, 500])
def test_block_max_neighbours_are_exact(block):
    rng = np.random.default_rng(4)
    n_terms = 3000
    weight = rng.uniform(0.1, 5, n_terms)
    draw = lambda: np.unique(rng.zipf(1.3, rng.integers(0, 60)) % n_terms).astype(np.int32)
    vectors = [(t, rng.integers(1, 5, len(t)).astype(float)) for t in (draw() for _ in range(700))]
    vectors += [vectors[3], vectors[3], vectors[10], vectors[10]]  # equal cosines
    ids = rng.permutation(len(vectors)) + 50
    index = toxicity.Index(vectors, ids, np.zeros(len(vectors)), weight, block)
    dense = np.zeros((len(vectors), n_terms))
    for row, (t, c) in zip(dense, vectors, strict=True):
        row[t] = toxicity.weigh(weight, t, c)
    asked = [vectors[3], vectors[10], *((t, np.ones(len(t))) for t in (draw() for _ in range(200)))]
    for (t, c), (near, at) in zip(asked, index.nearest(asked, 15), strict=True):
        cosine = np.round(dense[:, t] @ toxicity.weigh(weight, t, c), 12)
        want = [i for i in np.lexsort((ids, -cosine))[:15] if cosine[i] > 0]
        assert index.ids[at].tolist() == ids[want].tolist() and np.allclose(near, cosine[want], atol=1e-11)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "vile rotten " * 3 + f"w{i} x" if i % 3 == 0 else f"calm day w{i} x", 1) for i in range(90)] + [(None, "vile rotten", 1), (5, "vile rotten", 2), (5, "vile rotten", 2), (200, "", 1), (201, "?!", 1), (202, "vile rotten " * 30_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)] * 2, "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[202].predicted == 1 and by[None].predicted == 1 and by[200].score == by[201].score and len(by[81].evidence) == 15
    cosines = [e.cosine for e in by[81].evidence]
    assert cosines == sorted(cosines, reverse=True) and toxicity.score_documents(docs.limit(0), labels).count() == 0
    conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert toxicity.keep_clean(docs, labels).columns == docs.columns and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == conf


def test_fingerprints_by_plain_loops():
    rng = random.Random(5)
    for _ in range(200):
        x = " ".join(rng.choice(["a", "B", "cé", "É", "x y", "　"]) for _ in range(rng.randint(0, 9))).replace(" a", rng.choice(["\t a", "\n\na", "\x0ba", " a"]))
        words = x.encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert simhash.fingerprint(x.encode()) == sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def test_secrets_with_labels(spark):
    rng = random.Random(6)
    base = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n, a=base: "".join(rng.choice(a) for _ in range(n))
    made = []
    for _ in range(60):
        made.append((1, rng.choice(['token = "{}"', "api_key: {} x", "password={}", "export DB_SECRET={}", "Authorization: Bearer {}"]).format(some(rng.choice([24, 32, 40, 240])))))
        made.append((0, rng.choice(["commit {}", "checkout {} now", "sha1 {}"]).format(some(40, "0123456789abcdef"))))
        made.append((0, rng.choice(["order {}", "phone {}"]).format(some(18, "0123456789"))))
    docs = spark.createDataFrame([(i, x, "src", 1, 2, 3, 4, 5) for i, (_, x) in enumerate(made)], "doc_id long, text string, source string, _t int, _c int, _p int, _f int, _found int")
    out = secret_scan.redact(docs)
    hit = {r.doc_id: "[SECRET]" in r.text for r in out.collect()}
    true = sum(hit[i] for i, (y, _) in enumerate(made) if y)
    assert out.columns == docs.columns and true >= 0.95 * 60 and sum(hit.values()) - true <= 6  # recall and false alarms
    long = spark.createDataFrame([(1, f"password={some(240)} end", "s")] * 2, "doc_id long, text string, source string")
    assert [r.text for r in secret_scan.redact(long).collect()] == ["password=[SECRET] end"] * 2 and secret_scan.redact(long.limit(0)).count() == 0


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((3000, 32)).astype(np.float32)
    x[100:1500] = x[7]  # a large group of copies
    x[1500:1600] = x[8] + 0.1 * rng.standard_normal((100, 32)).astype(np.float32)
    rows = [(i, v.tolist(), "z") for i, v in enumerate(x)] + [(5000, [1.0, 0.0], "z"), (5001, [2.0, 0.0], "z"), (5050, [1.0, 1.0], "z"), (0, [9.0] * 32, "z"), (6000, None, "z"), (6050, [float("inf")] * 32, "z"), (None, [1.0] * 32, "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string").repartition(5)
    got = {}
    for r in ann.nearest(df, lambda c: c % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    first = min(rows[0][1], [9.0] * 32)
    u = x.astype(float)
    u[0] = first
    u /= np.linalg.norm(u, axis=1)[:, None]
    hits = 0
    for q in range(0, 3000, 50):
        cosine = np.round(u @ u[q], 12)
        cosine[q] = -9
        want = np.lexsort((np.arange(3000), -cosine))[:5].tolist()
        mine = [v for _, v, _ in sorted(got[q])]
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5] and q not in mine
        hits += len(set(want) & set(mine))
        if 100 <= q < 1500:
            assert mine == want
    assert hits >= 0.95 * 300
    assert [v for _, v, _ in sorted(got[5000])] == [5001, 5050] and {6000, 6050}.isdisjoint(got)


def test_vector_classes_by_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 48)).astype(np.float32)
    for k in range(40):  # chains, whose ends aren't linked directly
        x[10 + 10 * k + 1 : 10 + 10 * k + 6] = x[10 + 10 * k] + np.cumsum(0.28 * rng.standard_normal((5, 48)), axis=0)
    x[550:560] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[20].tolist()), (3, None), (700, x[3].tolist()), (None, x[3].tolist()), (701, [1.0, 2.0]), (702, [2.0, 4.0]), (703, [0.0] * 48)]
    got = neardup_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v in rows if i is not None and v and np.linalg.norm(v) > 0]
    link = [{b for b in range(len(good)) if b != a and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.9} for a in range(len(good))]
    part = list(range(len(good)))
    for _ in range(50):
        part = [min([part[a], *(part[b] for b in link[a])]) for a in range(len(good))]
    least = {}
    for a, p in enumerate(part):
        least[p] = min(least.get(p, 1 << 60), good[a][0])
    want = sorted((i, len(link[a]), least[part[a]]) for a, (i, _) in enumerate(good)) + [(3, 0, 3), (703, 0, 703)]
    mine = sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None)
    assert len(mine) == len(want) and len(set(mine) & set(want)) >= 0.98 * len(set(want)) and sum(n for _, n, _ in mine) <= sum(n for _, n, _ in want)
    assert [(r.n_links, r.kept) for r in got if r.vec_id is None] == [(0, True)]
    by = {r.vec_id: r for r in got if r.vec_id != 3}
    assert by[702].component_id == 701 and sum(r.vec_id == 3 for r in got) == 3 and all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_large_tables_have_more_lines():
    s = neardup_vectors.Settings()
    assert s.for_rows(10).lines == s.lines and s.for_rows(10**9).lines > s.for_rows(10**7).lines > s.lines and s.for_rows(10**7).groups > s.groups


def test_suffix_parts_by_brute_force():
    rng = random.Random(9)
    for _ in range(25):
        text = np.frombuffer(bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 200))) * rng.randint(1, 3), np.uint8)
        sa, b = suffix_dedup.suffix_array(text), text.tobytes()
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        lcp = suffix_dedup.common_prefixes(text, sa, 50)
        for k in range(1, len(sa)):
            n = 0
            while n < 50 and max(sa[k - 1], sa[k]) + n < len(b) and b[sa[k - 1] + n] == b[sa[k] + n]:
                n += 1
            assert lcp[k] == n


def test_suffix_dedup_of_repeated_ids(spark):
    rng = random.Random(10)
    some = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [some(70) for _ in range(40)]
    make = lambda: some(rng.randint(0, 60)) + rng.choice(shared) + some(rng.randint(0, 60)) + rng.choice(["", rng.choice(shared)])
    when = datetime.datetime(2026, 1, 2, 3, 4, 5, 123456)
    rows = [(rng.randint(1, 400), make()) for _ in range(2000)] + [(None, shared[0]), (None, shared[0]), (0, None), (7, "")]
    df = spark.createDataFrame([(i, x, when, b"\xff\x00", {"k": 1}, 5) for i, x in rows], "doc_id long, text string, at timestamp, raw binary, m map<string,int>, carried int").repartition(6)
    first = {}
    for i, x in rows:
        for p in range(len((x or "").encode()) - 49):
            g = x.encode()[p : p + 50]
            first[g] = min(first.get(g, 1 << 60), i if i is not None else 1 << 60)

    def kept(i, x):
        b = (x or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if i is not None and first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        return bytes(c for c, g in zip(b, gone, strict=True) if not g).decode()

    for settings in (suffix_dedup.Settings(), suffix_dedup.Settings(crowd=3, array=4000)):
        got = suffix_dedup.remaining(df, settings).collect()
        assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), kept(i, x)) for i, x in rows)
        assert all((r.at, bytes(r.raw), r.m, r.carried) == (when, b"\xff\x00", {"k": 1}, 5) for r in got)


def test_nearest_is_exact_in_tight_groups(spark):
    """Groups of many distinct vectors that four-bit codes can't tell apart: every one of the nearest is found."""
    rng = np.random.default_rng(11)
    x = np.concatenate([c + s * rng.standard_normal((700, 64)) for c, s in zip(rng.standard_normal((3, 64)), (0.003, 0.02, 1.0), strict=True)]).astype(np.float32)
    got = {}
    for r in ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5), lambda c: c % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    for q in range(0, len(x), 50):
        cosine = np.round(u @ u[q], 14)
        cosine[q] = -9
        assert [v for _, v in sorted(got[q])] == np.lexsort((np.arange(len(x)), -cosine))[:5].tolist()
