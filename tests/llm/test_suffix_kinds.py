"""What goes into op8's suffix arrays, and that answers stay those of a plain comparison."""

import numpy as np

from siftstone.llm import suffix_dedup as S


def _contexts(texts, s):
    """(whole, keys, counts, docs) of all contexts of texts, documents numbered by place."""
    joined = b"".join(texts)
    row, h, first, end = S.anchors(joined, np.array([len(x) for x in texts]), s)
    whole = b"".join(joined[a : e - 1 + s.length] for a, e in zip(first.tolist(), end.tolist(), strict=True))
    return whole, h.astype(np.uint32), end - first, row


def test_contexts_that_are_alone_with_their_anchor_are_not_sorted(monkeypatch):
    rng, s = np.random.default_rng(5), S.Settings()
    passage = rng.integers(97, 123, 4000, np.uint8).tobytes()
    texts = [rng.integers(97, 123, 300, np.uint8).tobytes() + passage for _ in range(20)]
    sorted_bytes = []
    plain = S.suffix_array
    monkeypatch.setattr(S, "suffix_array", lambda t: sorted_bytes.append(len(t)) or plain(t))
    whole, keys, counts, docs = _contexts(texts, s)
    kind, first, number, least = S.least_of_kinds(whole, keys, counts, docs, s)
    assert sum(sorted_bytes) < len(passage)  # the passage's inner contexts are alike in all documents
    size, at, seen = counts - 1 + s.length, 0, {}
    strings = []
    for n, m, d in zip(size.tolist(), counts.tolist(), docs.tolist(), strict=True):
        for i in range(m):
            x = whole[at + i : at + i + s.length]
            strings.append(x)
            seen[x] = min(seen.get(x, d), d)
        at += n
    got = np.concatenate([least[first[k] : first[k] + number[k]] for k in kind])
    assert got.tolist() == [seen[x] for x in strings]


def test_texts_put_together_have_the_anchors_of_each_alone():
    rng, s = np.random.default_rng(6), S.Settings()
    texts = [rng.integers(97, 100, n, np.uint8).tobytes() for n in (0, 49, 50, 51, 700, 0, 5000)]
    joined = S.anchors(b"".join(texts), np.array([len(x) for x in texts]), s)
    base = 0
    for k, x in enumerate(texts):
        mine = [c[joined[0] == k] for c in joined[1:]]
        _, h, first, end = S.anchors(x, np.array([len(x)]), s)
        assert (mine[0] == h).all() and (mine[1] - base == first).all() and (mine[2] - base == end).all()
        assert (end - first).sum() == max(len(x) - s.length + 1, 0)
        base += len(x)


def test_a_shard_is_looked_up_in_parts_of_its_anchors(spark):
    rng = np.random.default_rng(7)
    words = [rng.integers(97, 123, 60, np.uint8).tobytes().decode() for _ in range(40)]
    docs = spark.createDataFrame([(i, "".join(rng.permutation(words)[:12])) for i in range(300)], "doc_id long, text string")
    whole = sorted(map(tuple, S.digests(docs).collect()))
    assert sum(r[2] for r in whole) > 100_000
    assert sorted(map(tuple, S.digests(docs, S.Settings(part=1 << 10)).collect())) == whole

    s = S.Settings(part=1 << 12)
    passage = rng.integers(97, 123, 4000, np.uint8).tobytes()
    bytes_, keys, counts, ids = _contexts([rng.integers(97, 123, 3000, np.uint8).tobytes() + passage for _ in range(20)], s)
    sizes = counts - 1 + s.length
    parts = S.parts_of(keys, sizes, s)
    assert sorted(np.concatenate(parts).tolist()) == list(range(len(keys)))
    assert max(int(sizes[p].sum()) for p in parts) < sizes.sum() / 8
    assert sum(len(set(keys[p].tolist())) for p in parts) == len(set(keys.tolist()))  # an anchor is in one part only
    at = np.cumsum(sizes) - sizes
    kind, first, number, least = S.least_of_kinds(bytes_, keys, counts, ids, s)
    plain = [least[first[k] : first[k] + number[k]].tolist() for k in kind]
    for p in parts:
        kind, first, number, least = S.least_of_kinds(bytes_, keys[p], counts[p], ids[p], s, at[p])
        assert [least[first[k] : first[k] + number[k]].tolist() for k in kind] == [plain[i] for i in p.tolist()]
