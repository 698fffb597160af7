"""SentencePiece encoding and decoding of merge-type (BPE) models by a prefix table.

For each prefix of a text the encoding ends in exactly one token. It is a vocabulary entry that ends
there (an automaton lists those) and that may follow the last token of the prefix before it: the pair
must encode to itself. The table of last tokens is filled from left to right in linear time, and the
ids are read from it backwards. Characters outside the vocabulary never merge; they split the text and
become byte tokens. As no entry has a word mark behind another character, texts are also split where
a run of word marks begins, and equal parts are encoded once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import Recent, by_batch, plain_texts

MARK = "▁"


class Pieces:
    """Encoder and decoder of one model file; only its table of entries and scores is used."""

    def __init__(self, path: str):
        import sentencepiece

        table = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text: list[str] = [table.id_to_piece(i) for i in range(table.get_piece_size())]
        self.bytes: list[bytes] = [b""] * len(self.text)
        self.of_byte, self.rank = [table.unk_id()] * 256, {}
        for i, x in enumerate(self.text):
            if table.is_byte(i):
                self.of_byte[int(x[3:5], 16)] = i
                self.bytes[i] = bytes([int(x[3:5], 16)])
            elif table.is_unknown(i):
                self.bytes[i] = " ⁇ ".encode()
            elif not table.is_control(i):
                self.rank[x] = (-table.get_score(i), i)
                self.bytes[i] = x.replace(MARK, " ").encode()
        self.known = {x for x in self.rank if len(x) == 1}
        self.pairs: dict[int, bool] = {}
        # An entry that its own text does not encode to never ends a prefix.
        self.whole = {i for x, (_, i) in self.rank.items() if self._merge(x) == [i]}
        # When an entry is formed (0: a character), and the two entries that its last merge joins.
        self.order = [0.0] * len(self.text)
        self.split = [(0, 0)] * len(self.text)
        scores = [r for r, _ in self.rank.values()]
        tied = {r for r, n in Counter(scores).items() if n > 1}
        self.tied = {i for x, (r, i) in self.rank.items() if len(x) > 1 and r in tied}
        lowest = self.lowest = min(scores, default=0)
        for x, (r, i) in self.rank.items():
            if len(x) > 1 and i in self.whole:
                self.order[i] = r - lowest + 1
                k = self._last_merge(x)
                self.split[i] = self.rank[x[:k]][1], self.rank[x[k:]][1]
        self.automaton = ahocorasick.Automaton()
        for x, (_, i) in self.rank.items():
            if i in self.whole:
                self.automaton.add_word(x, (len(x), i))
        self.automaton.make_automaton()
        joins = any(MARK in x.lstrip(MARK) for x in self.rank)
        self.parts = None if joins else re.compile(f"{MARK}+[^{MARK}]*")
        self.comma = [b"%d," % i for i in range(len(self.text))]
        self.words = Recent(self._word, "pieces")

    def _merge(self, text: str) -> list[int] | None:
        """The definition itself, for short texts: join the best-scored pair, leftmost first."""
        s = list(text)
        if any(x not in self.rank for x in s):
            return None
        while len(s) > 1:
            best = min(((self.rank[x + y][0], k) for k, (x, y) in enumerate(zip(s, s[1:], strict=False)) if x + y in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            s[k : k + 2] = [s[k] + s[k + 1]]
        return [self.rank[x][1] for x in s]

    def _last_merge(self, text: str) -> int:
        """Length of the left half when the last merge of an entry happens."""
        s = list(text)
        while len(s) > 2:
            _, k = min((self.rank[x + y][0], k) for k, (x, y) in enumerate(zip(s, s[1:], strict=False)) if x + y in self.rank)
            s[k : k + 2] = [s[k] + s[k + 1]]
        return len(s[0])

    def _unbroken(self, a: int, b: int) -> bool:
        """follows() for entries of distinct scores, by undoing the later of both entries' last merges.

        Going back in time, the two tokens at the border are what stood there before; had their join been
        in the vocabulary and come earlier than the merge just undone, it would have been made instead.
        """
        text, rank, order, split = self.text, self.rank, self.order, self.split
        until = float("inf")
        while True:
            join = rank.get(text[a] + text[b])
            if join is not None and join[0] - self.lowest + 1 < until:
                return False
            if order[a] > order[b]:
                until = order[a]
                a = split[a][1]
            elif order[b]:
                until = order[b] + 0.5  # of equal scores the left one goes first
                b = split[b][0]
            else:
                return True

    def follows(self, a: int, b: int) -> bool:
        """Whether the texts of tokens a and b, joined, encode to a and b."""
        found = self.pairs.get(a << 20 | b)
        if found is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            found = self.pairs[a << 20 | b] = (
                self._merge(self.text[a] + self.text[b]) == [a, b] if a in self.tied or b in self.tied else self._unbroken(a, b)
            )
        return found

    def _table(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        n = len(text)
        last, size = [-1] * n, [0] * n
        pairs = self.pairs
        for end, (length, token) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            at = end - length
            if at >= 0:
                before = last[at]
                if before < 0:
                    continue
                ok = pairs.get(before << 20 | token)
                if not (self.follows(before, token) if ok is None else ok):
                    continue
            last[end], size[end] = token, length
        ids, at = [], n - 1
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids

    def _part(self, text: str) -> list[int]:
        if self.known.issuperset(text):
            return self._table(text)
        ids, run = [], []
        for x in text:
            if x in self.known:
                run.append(x)
            else:
                if run:
                    ids += self._table("".join(run))
                    run = []
                ids += [self.of_byte[c] for c in x.encode()]
        return ids + (self._table("".join(run)) if run else [])

    def _split(self, text: str) -> list[str]:
        """Parts with their word marks; no merge crosses their borders."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        return self.parts.findall(marked) if self.parts else [marked] * bool(marked)

    def _word(self, word: str) -> bytes:
        """Ids of a word behind one mark, each with a comma; b"" if they don't decode to it."""
        ids = self._part(MARK + word)
        exact = b"".join([self.bytes[i] for i in ids]) == b" " + word.encode()
        return b"".join([self.comma[i] for i in ids]) if exact else b""

    def encode(self, text: str) -> list[int]:
        """Ids without begin or end ids."""
        return [i for p in self._split(text) for i in self._part(p)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the mark before the first word is dropped, broken byte runs become U+FFFD."""
        whole = b"".join([self.bytes[i] for i in ids])
        first = next((self.text[i] for i in ids if self.bytes[i]), "")
        return (whole[1:] if first.startswith(MARK) else whole).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of their decoding)."""
        if self.parts and text and MARK not in text:
            words = text.split(" ")
            if "" not in words:
                each = list(map(self.words.__getitem__, words))
                if b"" not in each:  # every word decodes to itself, so the text does
                    ids = b"".join(each)
                    return ids.count(b","), hashlib.sha256(ids[:-1]).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        ids = self.encode(text)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The model of a file, once a process."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): null and empty texts give no ids."""

    def one(b: pa.RecordBatch) -> pa.Table:
        p = load(path)
        return pa.table({"doc_id": b.column(0), "ids": pa.array([p.encode(x) for x in plain_texts(b.column(1))], pa.list_(pa.int32()))})

    return by_batch(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), one, "doc_id long, ids array<int>", "pieces")


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text): null or no ids give an empty text; ids outside the model are an error."""

    def one(b: pa.RecordBatch) -> pa.Table:
        p = load(path)
        return pa.table({"doc_id": b.column(0), "text": pa.array([p.decode(x or []) for x in b.column(1).to_pylist()], pa.string())})

    return by_batch(encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")), one, "doc_id long, text string", "pieces")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, whole texts.

    Null and empty texts have no ids; repeated rows and doc_ids are kept as they are, a null doc_id
    stays null, an empty table gives an empty result and extra columns are left aside.
    """

    def one(b: pa.RecordBatch) -> pa.Table:
        p = load(path)
        n, a, d = zip(*map(p.digest, plain_texts(b.column(1))), strict=True)
        return pa.table({"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": list(a), "decoded_sha256": list(d)})

    return by_batch(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), one,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "pieces",
    )
