"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are all lower-case words and the first letters of longer ones; no vocabulary is chosen. A term is a
number below `terms`, its hash, so document frequencies are one array of that length, counted over all
documents. A term weighs (1 + log of its count) times its idf times a learned factor of one or more, which
is larger for terms that labelled rows hold oftener with label 1 than chance would; no term weighs less
for it. Lengths are those of the whole vectors, so the cosine is that of whole documents.

Examples lie in blocks; for each term and block the index keeps the block's largest weight, so a document's
cosine with any example of a block is bounded by a sum of a few numbers; blocks of large bound are read
first, and of the others those whose bound the k-th best does not beat. The neighbours' labels vote with weights that fall with
distance. A part of the labelled rows stays out of the index and out of the factors; votes are calibrated
by isotonic regression on the labels of those rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import Recent, by_batch, by_task, durable, plain_texts, trim

WORD = re.compile(r"[^\W\d_]+")
PARTS = 64  # an array of frequencies travels in so many pieces
COMMON = 512  # terms that the most examples hold, scored as a matrix
QUERIES = 256  # documents scored at once


@dataclass(frozen=True)
class Settings:
    """examples: at most so many labelled rows are learned from (those of least hash), a `calibrate`th of them for calibration."""

    examples: int = 4096
    calibrate: int = 4
    terms: int = 1 << 20
    prefix: int = 5
    neighbours: int = 15
    block: int = 512
    softness: float = 0.05
    threshold: float = 0.3


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(the numbers of x in order, each once; where each stands first among all, sorted; how many all are)."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    first = new.nonzero()[0]
    return x[first], first, len(x)


class Terms:
    """Numbers of a text's terms; those of white-space separated tokens met lately are kept."""

    def __init__(self, s: Settings):
        self.s, self.of = s, Recent(self._of, "toxicity", 100_000)

    def _of(self, token: str) -> bytes:
        low, out, n, terms, crc = token.lower(), b"", self.s.prefix, self.s.terms, zlib.crc32
        for w in (low,) if low.isalpha() else WORD.findall(low):
            x = w.encode()
            out += (crc(x) % terms).to_bytes(4, "little")
            if len(w) >= n:
                out += (crc(b"-" + (x[:n] if len(x) == len(w) else w[:n].encode())) % terms).to_bytes(4, "little")
        return out

    def all(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.of.__getitem__, text.split())), np.int32)

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(terms in order, how often each stands in the text)."""
        terms, first, n = _distinct(self.all(text))
        return terms, np.diff(first, append=n).astype(float)


_TERMS: dict[Settings, Terms] = {}


def terms_of(s: Settings) -> Terms:
    if s not in _TERMS:
        _TERMS[s] = Terms(s)
    return _TERMS[s]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def weigh(weight: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * weight[terms]
    norm = np.sqrt((w * w).sum())
    return w / norm if norm else w


class Index:
    """Block-max inverted index of example vectors; all arithmetic in double precision.

    The few terms that the most examples hold are rows of a matrix, which scores many documents at once; all
    others have postings, sorted by term and place. A block's bound is what the matrix gives its best example
    and the sum of its largest weights under the other terms. An entry is a term's run of postings in one block.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, labels: np.ndarray, weight: np.ndarray, block: int):
        self.weight, self.block, n = weight, block, len(vectors)
        weighed = [weigh(weight, *v) for v in vectors]
        held = np.bincount(np.concatenate([np.zeros(0, np.int32), *(t for t, _ in vectors)]), minlength=len(weight))
        # Examples of like vectors share blocks: by the heaviest term that others have too.
        lead = [int(t[np.argmax(w * (held[t] > 3))]) if len(t) else -1 for (t, _), w in zip(vectors, weighed, strict=True)]
        order = np.lexsort((ids, lead))
        self.ids, self.labels = ids[order], labels[order].astype(float)
        self.empty = np.array([len(vectors[i][0]) == 0 for i in order], bool)
        self.blocks = -(-max(n, 1) // block)
        sizes = np.array([len(vectors[i][0]) for i in order], np.int64)
        terms = np.concatenate([np.zeros(0, np.int32), *(vectors[i][0] for i in order)])
        place, value = np.repeat(np.arange(n), sizes), np.concatenate([np.zeros(0), *(weighed[i] for i in order)])
        common = np.argsort(-held, kind="stable")[:COMMON]
        self.column = np.full(len(weight), -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), n))
        at = self.column[terms]
        self.dense[at[at >= 0], place[at >= 0]] = value[at >= 0]
        by_term = np.flatnonzero(at < 0)
        by_term = by_term[np.argsort(terms[by_term], kind="stable")]  # places stay in order within a term
        terms, self.place, self.value = terms[by_term], place[by_term].astype(np.int32), value[by_term]  # small numbers: every worker holds an index
        blocks = self.place // block
        first = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])]) if len(terms) else np.zeros(0, np.int64)
        self.start = np.append(first, len(terms))  # of an entry's postings
        self.of_block = blocks[first].astype(np.int32)
        self.most = np.maximum.reduceat(self.value, first) if len(first) else np.zeros(0)
        known, at = np.unique(terms[first], return_index=True)
        self.entry = np.append(at, len(first))  # of a known term's entries
        self.slot = np.full(len(weight), -1, np.int32)
        self.slot[known] = np.arange(len(known))

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int):
        """For each vector (cosines, places) of its k nearest examples of cosine over zero, nearest first.

        Cosines that agree to 12 digits go by the smaller id.
        """
        for at in range(0, len(vectors), QUERIES):
            asked = [(t, weigh(self.weight, t, c)) for t, c in vectors[at : at + QUERIES]]
            q = np.zeros((len(asked), len(self.dense)))
            for row, (t, w) in zip(q, asked, strict=True):
                col = self.column[t]
                row[col[col >= 0]] = w[col >= 0]
            score = q @ self.dense
            for (t, w), s in zip(asked, score, strict=True):
                yield self._nearest(t, w, s, k) if len(self.ids) else (np.zeros(0), np.zeros(0, np.int64))

    def _nearest(self, terms: np.ndarray, q: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """score: what the common terms give; the postings of the others are added."""
        slot = self.slot[terms]
        q, slot = q[slot >= 0], slot[slot >= 0]
        size = self.entry[slot + 1] - self.entry[slot]
        entries, weight = _spread(self.entry[slot], size), np.repeat(q, size)
        blocks = self.of_block[entries]
        bound = np.maximum.reduceat(score, np.arange(0, len(score), self.block)) + np.bincount(blocks, weight * self.most[entries], self.blocks)
        read, least, first = np.zeros(len(score), bool), 0.0, bound >= np.median(bound)
        for now in (first, ~first):  # the blocks of larger bound, then those of the others that can still beat the k-th best
            now = now & (bound > 0) & (bound >= least - 1e-11)  # a hair of slack for rounding; equal cosines are read, since ties go by id
            if now.any():
                mine = now[blocks]
                e = entries[mine]
                size = self.start[e + 1] - self.start[e]
                p = _spread(self.start[e], size)
                score += np.bincount(self.place[p], np.repeat(weight[mine], size) * self.value[p], len(score))
                read |= np.repeat(now, self.block)[: len(score)]
                if read.sum() > k:
                    least = max(np.partition(score[read], read.sum() - k)[read.sum() - k], 0.0)
        found = np.flatnonzero(read & (score > 1e-12) & (score >= least - 1e-11))
        near = np.round(score[found], 12)
        order = np.lexsort((self.ids[found], -near))[:k]
        return near[order], found[order]


class Model:
    def __init__(self, index: Index, settings: Settings):
        self.index, self.settings = index, settings
        n = len(index.labels)
        self.prior = float((index.labels.sum() + 0.5) / (n + 1)) if n else 0.0
        self.none = float((index.labels[index.empty].sum() + self.prior) / (index.empty.sum() + 1))
        self.grid = self.level = np.zeros(0)

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        """For each vector (share of votes for label 1, cosines, places)."""
        for (terms, _), (near, at) in zip(vectors, self.index.nearest(vectors, self.settings.neighbours), strict=True):
            w = 1 / (1 - np.minimum(near, 1.0) + self.settings.softness)
            yield float(((w * self.index.labels[at]).sum() + self.prior) / (w.sum() + 1)) if len(terms) else self.none, near, at

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Isotonic regression (pooled neighbours) of labels on votes."""
        pools: list[list[float]] = []
        for x in np.unique(votes):
            here = votes == x
            pools.append([labels[here].sum(), here.sum(), x])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                s, n, _ = pools.pop()
                pools[-1][0] += s
                pools[-1][1] += n
        self.grid = np.array([p[2] for p in pools])
        self.level = np.array([(p[0] + self.prior) / (p[1] + 1) for p in pools])

    def score(self, raw: float) -> float:
        """Calibrated and then kept strictly increasing by a hundredth of the raw vote."""
        if not len(self.grid):
            return raw
        return float(0.99 * np.interp(raw, self.grid, self.level) + 0.01 * raw)


def frequencies(docs: DataFrame, settings: Settings, text: str = "text") -> tuple[np.ndarray, int]:
    """(in how many documents each term stands, number of documents), over all rows; `terms` numbers reach the driver."""
    n = settings.terms
    size = -(-n // PARTS)

    def counted(batches):
        total, rows, terms = np.zeros(size * PARTS, np.int32), 0, terms_of(settings)
        for b in batches:
            for x in plain_texts(b.column(0)):
                total[_distinct(terms.all(x))[0]] += 1
            rows += b.num_rows
        if rows:
            parts = [zstandard.compress(x.tobytes(), 1) for x in total.reshape(PARTS, size)]
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(PARTS), pa.int32()), "n": pa.array([rows] * PARTS, pa.int64()), "counts": pa.array(parts, pa.binary())})

    def summed(batches):
        total: dict[int, list] = {}
        for b in batches:
            for part, rows, x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                mine = total.setdefault(part, [0, np.zeros(size, np.int64)])
                mine[0] += rows
                mine[1] += np.frombuffer(zstandard.decompress(x), np.int32)
        for part, (rows, x) in total.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([rows], pa.int64()), "counts": pa.array([zstandard.compress(x.tobytes(), 1)], pa.binary())})

    shape = "part int, n long, counts binary"
    each = by_task(docs.select(text), counted, shape, "toxicity", keep=False)
    whole = by_task(each.repartition(PARTS, "part"), summed, shape, "toxicity").collect()  # PARTS rows, `terms` numbers
    df, rows = np.zeros((PARTS, size), np.int64), 0
    for r in whole:
        df[r["part"]] = np.frombuffer(zstandard.decompress(r["counts"]), np.int64)
        rows = r["n"]
    return df.ravel(), rows


def factors(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n: int) -> np.ndarray:
    """For each term 1, or more if rows that hold it have label 1 oftener than chance: 1 plus the excess in standard deviations."""
    rate = labels.mean() if len(labels) else 0.0
    none = [np.zeros(0, np.int32)]
    held = np.bincount(np.concatenate(none + [t for t, _ in vectors]), minlength=n)
    hit = np.bincount(np.concatenate(none + [t for (t, _), y in zip(vectors, labels, strict=True) if y]), minlength=n)
    return 1 + np.maximum((hit - held * rate) / np.sqrt(held * (rate * (1 - rate)) + 1), 0)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """The model of the labelled rows; None without any."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chosen = durable(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.examples)
    )  # at most settings.examples rows of two numbers: small enough to broadcast

    def vectors(b: pa.RecordBatch) -> pa.Table:
        found = [terms_of(settings).vector(x) for x in plain_texts(b.column(1))]
        kind = pa.list_(pa.int32())
        return pa.table({"doc_id": b.column(0), "y": b.column(2), "terms": pa.array([t.astype(np.int32) for t, _ in found], kind), "counts": pa.array([n.astype(np.int32) for _, n in found], kind)})

    shape = "doc_id long, y int, terms array<int>, counts array<int>"
    rows = by_batch(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"), vectors, shape, "toxicity")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "y")).alias("x")).select("doc_id", "x.*")
    rows = rows.toArrow().sort_by("doc_id").combine_chunks()  # bounded as chosen; columns, since Python objects would take the driver far more memory
    if not len(rows):
        return None
    df, n_docs = frequencies(docs, settings)
    terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
    at, flat, number = (x.to_numpy() for x in (terms.offsets, terms.values, counts.values))
    every = [(flat[i:j], number[i:j].astype(float)) for i, j in zip(at, at[1:], strict=False)]
    ids, y = rows.column("doc_id").to_numpy(), rows.column("y").to_numpy()
    aside = np.array([zlib.crc32(b"calibrate %d" % i) % settings.calibrate == 0 for i in ids.tolist()])
    if aside.all():
        aside[:] = False
    index_of, rest = np.flatnonzero(~aside), np.flatnonzero(aside)
    mine = [every[i] for i in index_of]
    weight = np.log((1 + n_docs) / (1 + df[: settings.terms])) * factors(mine, y[index_of], settings.terms)
    model = Model(Index(mine, ids[index_of], y[index_of], np.maximum(weight, 0.0), settings.block), settings)
    model.calibrate(np.array([v for v, _, _ in model.votes([every[i] for i in rest])]), y[rest].astype(float))
    del rows, every, mine, terms, counts, flat, number
    trim()
    return model


def score_documents(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """(doc_id, score, predicted, evidence) of every row; evidence: all voters' (doc_id, cosine, label), nearest first.

    labels: (doc_id, label 0/1) of the rows to learn from; rows with a null in either, and labels of
    documents that aren't there, are left aside; of repeated labels the larger counts. Without any label
    every score is 0. A text without words (empty, null) gets the rate of the examples without any, a text
    that shares no term with an example the rate of all. Cosines equal to 12 digits go by the smaller doc_id. Texts of
    any length are read whole. Repeated rows are scored alike; a null doc_id stays null; extra columns are
    left aside, whatever their names.
    """
    model = fit(docs, labels, settings, doc_id, text, label)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shape = "array<struct<doc_id:bigint,cosine:double,label:int>>"
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.expr(f"CAST(array() AS {shape})").alias("evidence"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(b: pa.RecordBatch) -> pa.Table:
        m, scores, ends, near, who = shared.value, [], [0], [], []
        for raw, cosines, at in m.votes(list(map(terms_of(settings).vector, plain_texts(b.column(1))))):
            scores.append(m.score(raw))
            near.append(cosines)
            who.append(at)
            ends.append(ends[-1] + len(at))
        at = np.concatenate(who).astype(np.int64)
        voters = pa.StructArray.from_arrays([pa.array(m.index.ids[at]), pa.array(np.concatenate(near)), pa.array(m.index.labels[at].astype(np.int32))], ["doc_id", "cosine", "label"])
        made = {"doc_id": b.column(0), "score": scores, "predicted": pa.array([int(s >= settings.threshold) for s in scores], pa.int32())}
        return pa.table(made | {"evidence": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), voters)})

    return by_batch(docs, score, f"doc_id long, score double, predicted int, evidence {shape}", "toxicity")


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The rows of docs, all columns kept, whose score stays under the threshold; scored as they are read, without a shuffle of texts."""
    model = fit(docs, labels, settings, doc_id, text, label)
    if model is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def clean(b: pa.RecordBatch) -> pa.RecordBatch:
        m, terms = shared.value, terms_of(settings)
        few = (plain_texts(b.column(at).slice(i, QUERIES)) for i in range(0, b.num_rows, QUERIES))  # as many vectors at a time as are scored at once
        return b.filter(pa.array([m.score(raw) < settings.threshold for texts in few for raw, _, _ in m.votes(list(map(terms.vector, texts)))], pa.bool_()))

    return by_batch(docs, clean, docs.schema, "toxicity", keep=False)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels may not be learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
