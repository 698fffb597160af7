"""Conversation trie, vector codes and byte-level BPE against plain versions, on odd, tied, repeated and clashing rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from siftstone.llm import byte_bpe, conversation_trie, near_copies, vector_codes


def plain_trie(rows):
    """Nodes by plain loops over whole conversations."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()[:16], (r, x)))
    own = {c: [y for _, _, y in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, mine in own.items():
        lead, h = c - int(abs(c) % 20) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(lead, [])[:h] + mine[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not children[p]
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_rows(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize(("convs", "span", "longest"), [(120, 2, 9), (60, 3, 12), (25, 64, 200)])
def test_trie_by_plain_loops(spark, convs, span, longest):
    rng = random.Random(convs)
    rows, base = [], [[(rng.choice(["u", "b", None]), rng.choice(["a b", "c", "", "x y z", None, "q\x0bw"])) for _ in range(longest)] for _ in range(3)]
    for c in rng.sample(range(-60, 3 * convs), convs):
        turns = list(rng.choice(base))[: rng.randint(0, longest)]
        if rng.random() < 0.5 and turns:
            turns[rng.randrange(len(turns))] = ("u", rng.choice(["m n", "o"]))
        rows += [(c, t if rng.random() > 0.05 else rng.choice([None, t]), r, x) for t, (r, x) in enumerate(turns)]
    rows += [(None, 1, "u", "z"), rows[0], rows[0], (-77, None, "u", "only"), (-78, 1, "u", "word " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos long, key string").repartition(3)
    assert trie_rows(conversation_trie.prefix_trie(df, span=span)) == plain_trie(rows)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(400) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(conversation_trie.prefix_trie(df, span=2)) == plain_trie(rows)
    assert conversation_trie.prefix_trie(df.limit(0)).count() == 0
    alone = [(7, 1, "u", "x")]  # rebuilt without turns if its first h are dropped
    assert trie_rows(conversation_trie.prefix_trie(spark.createDataFrame(alone, df.schema))) == plain_trie(alone)


def test_ids_of_a_node_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 7)
    ids = [*range(-50, 3000), 10**15]
    df = spark.createDataFrame([(1, 2, c) for c in ids] + [(3, 4, 5)], "x long, y long, conv_id long").repartition(5)
    got = {(r.x, r.y): r.ends_sha256 for r in conversation_trie.ends_of(df).collect()}
    assert got == {(1, 2): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (3, 4): hashlib.sha256(b"5").hexdigest()}


def plain_codes(rows, entries=64, rounds=2):
    """Codes by whole distances, row after row."""
    kept = [(i, [int(np.floor(256.0 * x)) for x in v], label) for i, v, label in rows if v is not None and len(v) == 32 and all(x is not None and np.isfinite(x) and abs(x) < 100_000 for x in v)]
    parts = np.array([v for _, v, _ in kept]).reshape(len(kept), 16, 2)
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    books = parts[order[:entries]].transpose(1, 0, 2).copy()
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (((x - books[p][e]) ** 2).sum(), e))
    for _ in range(rounds):
        to = [[nearest(p, x) for x in parts[:, p]] for p in range(16)]
        for p in range(16):
            for e in set(to[p]):
                mine = parts[[k for k, t in enumerate(to[p]) if t == e], p]
                books[p][e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = []
    for (i, _, label), v in zip(kept, parts, strict=True):
        e = [nearest(p, v[p]) for p in range(16)]
        out.append((i, "".join(f"{x:02x}" for x in e), int(sum(((v[p] - books[p][e[p]]) ** 2).sum() for p in range(16))), label))
    by = defaultdict(int)
    for _, _, error, label in out:
        by[label] += error
    return sorted(((i, code, error, by[label], digest) for i, code, error, label in out), key=repr)


def code_rows(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


def test_codes_by_plain_loops(spark):
    rng = np.random.default_rng(6)
    draw = lambda: [float(np.float32(x)) for x in rng.normal(0, 0.1, 32).round(2)]
    rows = [(int(i), draw(), int(rng.integers(3)) if i % 7 else None) for i in rng.permutation(150) - 20]
    same = draw()
    rows += [(500 + i, same, 1) for i in range(60)] + [rows[0], rows[0]]  # copies and repeated rows
    odd = [(300, None, 1), (301, [None, *same[1:]], 1), (302, [float("nan"), *same[1:]], 2), (303, [float("inf"), *same[1:]], 2), (304, [], 1), (305, same[:16], 1), (306, same[:5], None), (None, same, 1), (307, [1e30, *same[1:]], 1)]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows + odd], "vec_id long, embedding array<float>, label int, code int, part string").repartition(3)
    assert code_rows(vector_codes.compress(df)) == plain_codes(rows + odd)
    few = [r for r in rows if r[0] < 10]  # fewer rows than entries
    assert code_rows(vector_codes.compress(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int"))) == plain_codes(few)
    for nothing in (df.limit(0), df.filter("vec_id = 300")):
        assert vector_codes.compress(nothing).count() == 0


def test_partial_distances_are_exact():
    rng = np.random.default_rng(7)
    for _ in range(200):
        d = rng.integers(1, 9)
        x, book = rng.integers(-4, 5, (rng.integers(1, 80), d)) * rng.choice([1, 1000]), rng.integers(-4, 5, (rng.integers(1, 70), d))
        entry, best = vector_codes.searched(x, book, int(rng.integers(1, 20)))
        whole = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        assert (whole.argmin(axis=1) == entry).all() and (whole.min(axis=1) == best).all()


PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bytes_encode_as_the_library_does(library):
    own, rng = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN), random.Random(8)
    for low in range(0, 0x110000, 64):
        x = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000)
        assert own.encode(x) == library.encode_ordinary(x), hex(low)
    bits = ["a", "aa", " ", "  ", "\n", "\r\n", "\t", " \n", "'s", "'ll", "é", "梦", "한국", "😀", "ing", "0", "12", "\x1c", "\x85", "\xa0", "　", "x̄", "!!", "<|endoftext|>", "the", "ab", "-", "=="]
    for _ in range(8000):
        some = rng.sample(bits, rng.choice([1, 2, 3, 8, len(bits)]))
        x = "".join(rng.choice(some) for _ in range(rng.randint(0, rng.choice([5, 14, 60]))))
        ids = library.encode_ordinary(x)
        assert own.encode(x) == ids and own.decode(ids) == x.encode()
        assert own.digest(x) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(x.encode()).hexdigest()), repr(x)
    for x in ("a" * 100_001, "ab" * 40_000 + "a", " " * 77_777 + "x", "的" * 30_000, "".join(rng.choice("abcde") for _ in range(90_000)), "word " * 40_000):
        assert own.encode(x) == library.encode_ordinary(x)


def test_joining_is_associative(library):
    own, rng = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN), random.Random(9)
    for _ in range(2000):
        a, b, c = (bytes(rng.choice(b"aeinst") for _ in range(rng.randint(0, 40))) for _ in range(3))
        whole = own.merged(a + b + c)
        assert own.joined(own.joined(own.merged(a), own.merged(b)), own.merged(c)) == own.joined(own.merged(a), own.joined(own.merged(b), own.merged(c))) == whole
        long = a * 9 + b * 5 + c * 7
        assert own.decode(own.match(long)) == long and own.match(long) == (library._encode_single_piece(long) if long else [])


def test_byte_tables_of_odd_rows(spark):
    rows = [(1, "It's  a\n test", 1, "a"), (1, "It's  a\n test", 1, "a"), (None, None, 2, "b"), (2, "", 3, None), (3, "x" * 300_000, 4, "c"), (4, "😀 <|endoftext|>", 5, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    got = byte_bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in got) == sorted((i or 0, hashlib.sha256((x or "").encode()).hexdigest()) for i, x, *_ in rows)
    assert [(r.n_tokens, r.ids_sha256) for r in got if r.doc_id in (None, 2)] == [(0, empty)] * 2
    back = byte_bpe.decode(byte_bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in back.collect()) == sorted((i or 0, x or "") for i, x, *_ in rows)
    assert byte_bpe.round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("box", [400, 3000])
def test_near_copies_in_boxes_by_brute_force(spark, monkeypatch, box):
    """A large class is cut by size and into parts that meet two by two; classes are those of all pairs."""
    monkeypatch.setattr(near_copies, "BOX", box)
    rng = random.Random(box)
    words = [f"w{i}" for i in range(4000)]
    lead = " ".join(words[:40])  # a template that many share, in texts of several sizes
    texts = []
    for base in range(6):
        body = [rng.choice(words) for _ in range(rng.choice([15, 40, 90]))]
        for _ in range(45):
            mine = list(body)
            for _ in range(rng.choice([0, 0, 1, 2, 9])):
                mine[rng.randrange(len(mine))] = rng.choice(words)
            texts.append(lead + " " + " ".join(mine[: rng.choice([len(mine), len(mine) - 2])]))
    texts += [lead + f" {a}" for a in words[:80]] + [texts[0], texts[0], "", None, "lone"]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, x, "x") for i, x in enumerate(texts)] + [(None, "lone", "y")], "doc_id long, text string, component string")
    sets = [set(near_copies.shingles((x or "").encode()).tolist()) for x in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    assert {r.doc_id: r.component_id for r in near_copies.classes(df).collect()} == {i: top(i) for i in range(len(texts))}
