"""Main text of web pages by wrappers inferred for each host.

A page is read as a balanced stream of tags and texts. Streams of one host are aligned one after another
into a union-free regular expression: equal tags are matched, neighbours that repeat become a repeated
group, tags that only one side has become an optional group, and texts that differ become slots. Alignment
is done in parts: parts of a host's pages give wrappers that are then aligned with each other, so a
host of any size is spread over many tasks.

The wrapper decides which of its groups hold the article. For each group it knows on how many pages it
stands, whether its texts vary or all pages share them, whether it is optional, how much of its text is
links and how long its texts are; these are weighed with what its tag and names suggest, and no name
decides against a group that holds nearly all that varies. Pages that mark an article up are read there;
others in the smallest group that holds most of the text that is left.
"""

from __future__ import annotations

import html
import json
import re
import sys
import zlib
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import by_batch, by_task, durable, partitions, plain_texts

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Opening one of these ends an open one of the same list.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
AWAY = frozenset("nav footer aside form head menu button select label dialog fieldset input".split()) | RAW
#: What a name suggests: 2 if one of these is the whole of it, 1 if one of the further ones is, or a part of it.
TELLING = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored sidebar side-bar comments comment-list disqus cookies consent gdpr newsletter subscribe "
    "navbar navigation breadcrumb breadcrumbs masthead topbar site-header page-header site-footer page-footer sharing pagination pager complementary contentinfo".split()
)
HINTING = frozenset("ad ads advert sponsored promo banner sidebar comment comments cookie consent notice alert popup modal newsletter menu nav footer share sharing social related recommended widget login search toolbar breadcrumb pager pagination".split())
DEPTH = 512  # elements nested deeper count as part of their ancestor, as in browsers
MANY = 64  # children of one group beyond which those of one kind are one repeated group
SMALL = 8 << 20  # characters of decisions that are sent to every executor
PART = 4096  # pages of a host that are read with one copy of its decisions
BIG = 1 << 16  # most hosts that are split


def host_of(url: str) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def key_of(tag: str, attributes: str) -> str:
    """The tag, how telling its names are, and its classes; numbers in them don't tell groups apart."""
    if not attributes:
        return tag
    found = [(a[0].lower(), (a[1] or a[2] or a[3]).lower().split()) for a in _ATTRIBUTE.findall(attributes) if a[0].lower() in ("class", "id", "role")]
    names = [x for _, words in found for x in words]
    if not names:
        return tag
    hint = 2 if any(x in TELLING for x in names) else 1 if any(w in HINTING for x in names for w in re.split("[-_]+", x)) else 0
    classes = sorted({re.sub("[0-9]+", "#", x) for kind, words in found if kind == "class" for x in words})
    return f"{tag}!{hint}.{' '.join(classes)}"


def tag_of(key: str) -> str:
    return key.partition("!")[0]


def hint_of(key: str) -> int:
    return int(key.partition("!")[2][:1] or 0)


class Paths:
    """Numbers paths of keys: 0 is the root, others are known by parent and key."""

    def __init__(self):
        self.number: dict[tuple[int, str], int] = {}
        self.key, self.parent = [""], [-1]

    def child(self, parent: int, key: str) -> int:
        n = self.number.get((parent, key))
        if n is None:
            n = self.number[parent, key] = len(self.key)
            self.key.append(key)
            self.parent.append(parent)
        return n


def texts(page: str, paths: Paths) -> list[tuple[int, int, int, str]]:
    """(path, element number, block number, text) of every text in page order, in one pass over the page.

    Raw elements and comments are left out. A tag that never ends takes the rest of the page with it; a
    quote that never ends is a character like any other.
    """
    out: list[tuple[int, int, int, list[str]]] = []
    stack: list[tuple[str, int, int]] = []  # tag, path, element number
    open_: dict[str, int] = {}
    at, block, n, elements, deep = 0, 0, len(page), 0, 0
    last = {'"': page.rfind('"'), "'": page.rfind("'")}

    def cut(i: int) -> None:
        for tag, _, _ in stack[i:]:
            open_[tag] -= 1
        del stack[i:]

    def back(tags: set[str] | frozenset[str], until: tuple[str, ...] = ()) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in until:
                return -1
        return -1

    def say(x: str) -> None:
        path, element = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
        if out and out[-1][1] == element and out[-1][2] == block:
            out[-1][3].append(x)
        else:
            out.append((path, element, block, [x]))

    while at < n:
        lt = page.find("<", at)
        if lt != at:
            say(page[at : lt if lt >= 0 else n])
            if lt < 0:
                break
            at = lt
        after = page[at + 1 : at + 2]
        if after in ("!", "?"):
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", at)
                at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        m = _NAME.match(page, at + 1 + closing)
        if m is None:
            say("<")
            at += 1
            continue
        tag, end = m[0].lower(), m.end()
        while (q := _STOP.search(page, end)) is not None and q[0] != ">":
            end = page.find(q[0], q.end()) + 1 if q.start() < last[q[0]] else q.end()
        if q is None:
            break
        attributes, at = page[m.end() : q.start()], q.end()
        if closing:
            if open_.get(tag):
                cut(back({tag}))
            block += tag in BLOCK
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                end_tag = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = end_tag.end() if end_tag else n
            continue
        if tag in BLOCK:
            block += 1
            if open_.get("p"):
                cut(back({"p"}))  # a block ends an open paragraph
            if tag in CLOSES and (i := back(CLOSES[tag], ("ul", "ol", "dl", "table", "select"))) >= 0:
                cut(i)
        elif tag == "br":
            say(" ")
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        elements += 1
        parent = stack[-1][1] if stack else 0
        if len(stack) < DEPTH:
            stack.append((tag, paths.child(parent, key_of(tag, attributes)), elements))
        else:
            stack.append((tag, parent, elements))
        open_[tag] = open_.get(tag, 0) + 1
    return [(*where, "".join(parts)) for *where, parts in out]


# A wrapper node: [key, text ("" none, hash, or "*" for a slot), optional, repeated, children, pages, characters of its own texts]


def stream(page: str) -> list:
    """The page as a wrapper of itself, its repeated neighbours already one group."""
    paths = Paths()
    root = ["", "", 0, 0, [], 1, 0]
    said = texts(page, paths)
    open_: list[tuple[int, list]] = [(0, root)]  # path, node
    place = {0: 0}  # of an open path
    element_of: dict[int, list] = {}
    for path, element, _, text in said:
        new = []
        while path not in place:
            new.append(path)
            path = paths.parent[path]
        k = place[path]
        if not new and k and element not in element_of and open_[k][1][6]:
            new, k = [path], k - 1  # a further element of the same path
        for p, _ in open_[k + 1 :]:
            del place[p]
        del open_[k + 1 :]
        for p in reversed(new):
            node = [paths.key[p], "", 0, 0, [], 1, 0]
            open_[-1][1][4].append(node)
            place[p] = len(open_)
            open_.append((p, node))
        node = element_of.setdefault(element, open_[-1][1]) if element else root
        if t := " ".join(html.unescape(text).split()):
            node[1] = f"{zlib.crc32(t.encode()):x}" if not node[1] else "*"
            node[6] += len(t)
    _fold(root)
    return root


def _fold(node: list) -> None:
    """Neighbours of equal keys become one repeated group; so do all children of a key where there are very many."""
    for c in node[4]:
        _fold(c)
    node[4] = _grouped(node[4])


def _grouped(nodes: list[list]) -> list[list]:
    out: list[list] = []
    for c in nodes:
        if out and out[-1][0] == c[0]:
            out[-1] = align(out[-1], c, True)
            out[-1][3] = 1
        else:
            out.append(c)
    if len(out) <= MANY:
        return out
    of_key: dict[str, list] = {}
    for c in out:
        if c[0] in of_key:
            of_key[c[0]] = align(of_key[c[0]], c, True)
            of_key[c[0]][3] = 1
        else:
            of_key[c[0]] = c
    return list(of_key.values())


def align(a: list, b: list, within: bool = False) -> list:
    """One wrapper that both fit; within: they are repeats in one page, so their pages don't add up."""
    text = a[1] if a[1] == b[1] else "*" if a[1] and b[1] else a[1] or b[1]
    x, y = [c[0] for c in a[4]], [c[0] for c in b[4]]
    if x == y:
        children = [align(c, d, within) for c, d in zip(a[4], b[4], strict=True)]
    else:
        children = []
        for what, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
            if what == "equal":
                children += [align(c, d, within) for c, d in zip(a[4][i:j], b[4][k:m], strict=True)]
            else:
                children += [[*c[:2], 1, *c[3:]] for c in [*a[4][i:j], *b[4][k:m]]]
        children = _grouped(children)  # an optional group beside its like: one repeated group
    return [a[0], text, a[2] | b[2], a[3] | b[3], children, max(a[5], b[5]) if within else a[5] + b[5], a[6] + b[6]]


def expression(node: list) -> str:
    """The wrapper as a regular expression over tags; # is a slot, = a text that all pages share."""
    tag = tag_of(node[0])
    inner = {"": "", "*": "#"}.get(node[1], "=") + "".join(expression(c) for c in node[4])
    whole = f"<{tag}>{inner}</>" if tag else inner
    return f"({whole})" + ("*" if node[2] and node[3] else "?" if node[2] else "+") if node[2] or node[3] else whole


def decisions(wrapper: list) -> list[tuple[int, str, int]]:
    """(depth, key, use) of every group in order: use 1 if its texts are part of a marked article, 2 of an unmarked one, 0 of none."""
    sums: dict[int, tuple[int, int, int, int]] = {}  # characters, of these in links, shared by all pages, number of texts

    def add(node: list, linked: bool, away: bool) -> tuple[int, int, int, int]:
        tag = tag_of(node[0])
        linked, away = linked or tag == "a", away or tag in AWAY
        own = 0 if away else node[6]
        total = [own, own * linked, own * (node[1] not in ("", "*") and node[5] >= 3), (node[5] if own else 0)]
        for c in node[4]:
            total = [x + y for x, y in zip(total, add(c, linked, away), strict=True)]
        sums[id(node)] = tuple(total)
        return sums[id(node)]

    whole = add(wrapper, False, False)
    template = whole[2] <= whole[0] / 2  # else its pages are copies, and what they share is no template
    varies = whole[0] - whole[2] if template else whole[0]

    def gone(c: list, inside: bool) -> bool:
        """Whether the evidence, as a sum of log-odds, speaks against a group."""
        tag = tag_of(c[0])
        if tag in AWAY or tag == "header" and not inside:
            return True
        chars, links, shared, runs = sums[id(c)]
        if tag not in BLOCK or not chars:
            return False
        constant = template and shared > 0.9 * chars
        prose = not constant and links < 0.2 * chars and chars >= 80 * runs
        whole_page = not inside and chars - shared * template > 0.9 * varies
        odds = (0.0, 0.8, 3.0)[hint_of(c[0])] + 1.5 * (links > chars / 2) + 2.5 * constant + 0.5 * c[2] * (hint_of(c[0]) > 0) - 1.0 * inside - 1.0 * prose
        return odds >= 1.0 and not whole_page

    kept: dict[int, tuple[bool, bool]] = {}  # whether a group's own texts may be used, whether it is marked
    mass: dict[int, int] = {}

    def judge(node: list, inside: bool, away: bool) -> int:
        total = 0
        for c in node[4]:
            within = inside or tag_of(c[0]) in ("article", "main") and not away
            out = away or gone(c, inside)
            kept[id(c)] = not out, within
            total += 0 if out or within else c[6]
            total += judge(c, within, out)
        mass[id(node)] = total
        return total

    judge(wrapper, False, False)
    unmarked = mass[id(wrapper)] + wrapper[6]
    box = wrapper  # the smallest group that holds most of the unmarked text that is left
    while (inner := next((c for c in box[4] if mass[id(c)] + c[6] * kept[id(c)][0] >= 0.7 * unmarked and tag_of(c[0]) in BLOCK and kept[id(c)][0]), None)) is not None and unmarked:
        if inner[3] or tag_of(inner[0]) in ("p", "li", "td"):
            break
        box = inner
    out: list[tuple[int, str, int]] = [(0, "", 2 if box is wrapper else 0)]

    def say(node: list, depth: int, boxed: bool) -> None:
        for c in node[4]:
            good, marked = kept[id(c)]
            here = boxed or c is box
            out.append((depth, c[0], 0 if not good else 1 if marked else 2 if here or tag_of(c[0]) == "h1" else 0))
            say(c, depth + 1, here)

    say(wrapper, 1, box is wrapper)
    return out


def _numbered(decided: list) -> tuple[Paths, list[int]]:
    """Decisions by path; where a path stands for several groups, its texts are used if one of them is."""
    paths, use, up = Paths(), [0], [0]
    for depth, key, code in decided:
        if depth == 0:
            use[0] = code
            continue
        del up[depth:]
        n = paths.child(up[-1], key)
        if n == len(use):
            use.append(code)
        else:
            use[n] = code if not use[n] else min(use[n], code or use[n])
        up.append(n)
    return paths, use


def main_text(page: str, decided: list | None = None, known: tuple[Paths, list[int]] | None = None) -> str:
    """Texts of the article's groups, block by block; decided: of the page alone, if not given."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEPTH))
    paths, use = known or _numbered(decisions(stream(page)) if decided is None else decided)
    said = texts(page, paths)
    of = [use[path] if path < len(use) else 0 for path, _, _, _ in said]
    wanted = 1 if any(u == 1 and t.strip() for u, (_, _, _, t) in zip(of, said, strict=True)) else 2
    blocks: list[str] = []
    last, parts = None, []
    for code, (_, _, block, text) in zip(of, said, strict=True):
        if code != wanted:
            continue
        if block != last:
            blocks.append("".join(parts))
            last, parts = block, []
        parts.append(html.unescape(text))
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper, pages): one wrapper for each host, as JSON; pages without a host share the empty host."""
    parts_of = max(32, partitions(pages.sparkSession))

    def streams(b: pa.RecordBatch) -> pa.Table:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEPTH))
        seen: dict[tuple[str, str], int] = {}
        for u, h in zip(b.column(0).to_pylist(), plain_texts(b.column(1)), strict=True):
            key = host_of(u), json.dumps(stream(h), separators=(",", ":"))
            seen[key] = seen.get(key, 0) + 1
        folded: dict[tuple[str, int], list] = {}
        number: dict[tuple[str, int], int] = {}
        for (host, w), n in seen.items():  # equal streams are aligned once
            key = host, zlib.crc32(w.encode()) % parts_of
            folded[key] = align(folded[key], json.loads(w)) if key in folded else json.loads(w)
            number[key] = number.get(key, 0) + n
        made = {"host": [h for h, _ in folded], "part": pa.array([p for _, p in folded], pa.int32())}
        return pa.table(made | {"wrapper": [json.dumps(w, separators=(",", ":")) for w in folded.values()], "pages": pa.array(list(number.values()), pa.int64())})

    def joined(table: pa.Table) -> pa.Table:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEPTH))
        ws = sorted(set(table.column("wrapper").to_pylist()))
        whole = json.loads(ws[0])
        for w in ws[1:]:
            whole = align(whole, json.loads(w))
        made = {"host": table.column("host").slice(0, 1), "part": pa.array([0], pa.int32()), "wrapper": [json.dumps(whole, separators=(",", ":"))]}
        return pa.table(made | {"pages": pa.array([sum(table.column("pages").to_pylist())], pa.int64())})

    shape = "host string, part int, wrapper string, pages long"
    parts = by_batch(pages.select(F.col(url).alias("url"), F.col(page).alias("html")), streams, shape)
    first = parts.groupBy("host", "part").applyInArrow(joined, shape)
    return first.groupBy("host").applyInArrow(joined, shape).select("host", "wrapper", "pages")


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", small: int = SMALL, part: int = PART) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; a null or empty page, or one without article, has an empty text.

    Repeated rows are kept; a null url belongs to the empty host; extra columns are left aside. Pages of any
    length and depth are read whole, in time that grows with their length. A host's decisions are sent to
    every executor if all hosts' are `small`; else they travel once for each `part` pages of the host.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1), F.lit("")))
    kept = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")).withColumn("host", host)

    def decide(b: pa.RecordBatch) -> pa.Table:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * DEPTH))
        said = [json.dumps(decisions(json.loads(w)), separators=(",", ":")) for w in b.column(1).to_pylist()]
        return pa.table({"host": b.column(0), "decided": said, "pages": b.column(2)})

    found = durable(by_batch(wrappers(pages, url, page), decide, "host string, decided string, pages long"))
    total = found.agg(F.coalesce(F.sum(F.length("host") + F.length("decided")), F.lit(0)).alias("size"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")).first()
    kind = pages.schema[page_id].dataType.simpleString()
    shape = f"page_id {kind}, url string, text string, n_chars long"

    def result(b: pa.RecordBatch, out: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"page_id": b.column(0), "url": b.column(1), "text": pa.array(out, pa.string()), "n_chars": pa.array([len(x) for x in out], pa.int64())})

    if total["size"] <= small:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["decided"] for r in found.toLocalIterator()})
        memo: dict[str, tuple[Paths, list[int]]] = {}

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for u, h in zip(plain_texts(b.column(3)), plain_texts(b.column(2)), strict=True):
                if u not in memo:
                    memo[u] = _numbered(json.loads(shared.value[u])) if u in shared.value else None
                out.append(main_text(h, known=memo[u]))
            return result(b, out)

        return by_batch(kept, one, shape)

    per = max(part, -(-total["pages"] // BIG))
    split = F.broadcast(found.filter(F.col("pages") > per).select("host", F.ceil(F.col("pages") / per).cast("int").alias("n")))  # at most BIG rows
    numbered = kept.join(split, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("n", F.lit(1))).cast("int"))
    copies = found.select("host", "decided", F.explode(F.sequence(F.lit(0), F.ceil(F.greatest(F.col("pages") / per, F.lit(1.0))).cast("int") - 1)).alias("part"))
    rows = numbered.select("page_id", "url", "html", "host", "part", F.lit(None).cast("string").alias("decided"))
    heads = copies.select(F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "host", "part", "decided")
    sent = rows.unionByName(heads).repartition("host", "part").sortWithinPartitions("host", "part", F.col("decided").desc_nulls_last())

    def ordered(batches):
        known = None
        for b in batches:
            out, good = [], []
            for h, d in zip(plain_texts(b.column(2)), b.column(5).to_pylist(), strict=True):
                good.append(d is None)
                if d is not None:  # a host's decisions come before its pages
                    known = _numbered(json.loads(d))
                else:
                    out.append(main_text(h, known=known))
            yield result(b.filter(pa.array(good)), out)

    return by_task(sent, ordered, shape)
