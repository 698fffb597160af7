"""Main text: what a wrapper decides that a page alone can't, hostile pages, both ways of sending decisions."""

import json
import random
import time

import pytest

from siftstone.llm import html_text as H

SCHEMA = "page_id long, url string, html string"


def prose(rng, n=30):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def wrapper_of(pages):
    whole = None
    for x in sorted({json.dumps(H.stream(p)) for p in pages}):
        whole = json.loads(x) if whole is None else H.align(whole, json.loads(x))
    return whole


def plain_host(rng, n=6):
    """Pages without article or telling names: menu, a shared notice, heading, paragraphs, link list, shared foot."""
    pages, want = [], []
    for i in range(n):
        body = [prose(rng) for _ in range(rng.randint(2, 5))]
        title = prose(rng, 4)
        pages.append(
            "<html><body><div class=a><a href=/>Home</a> <a href=/b>Blog</a></div>"
            f"<div class=c><h1>{title}</h1><div class=b>We have moved our offices to a new street in the old town, come by and see us there some day.</div>" + "".join(f"<p>{x}</p>" for x in body) + f"</div><ul class=d><li><a href=/{i}>{prose(rng, 5)}</a></li><li><a href=/x>{prose(rng, 5)}</a></li></ul><div class=e>All rights reserved by us</div></body></html>"
        )
        want.append("\n".join([title, *body]))
    return pages, want


def test_wrapper_tells_shared_text_from_slots():
    pages, want = plain_host(random.Random(1))
    decided = H.decisions(wrapper_of(pages))
    assert [H.main_text(p, decided) for p in pages] == want
    assert all(H.main_text(p) != w for p, w in zip(pages, want, strict=True))  # a page alone can't know that the notice is no text of its own


def test_shared_notice_within_articles():
    rng = random.Random(2)
    body = [prose(rng) for _ in range(5)]
    pages = [f"<article><h1>{x[:5].strip()}</h1><p>{x}</p><div class=z>Tell your friends about us</div></article>" for x in body]
    decided = H.decisions(wrapper_of(pages))
    assert [H.main_text(p, decided) for p in pages] == [f"{x[:5].strip()}\n{x}" for x in body]
    assert "Tell" in H.main_text(pages[0])


def test_templates_of_one_host_are_read_apart():
    rng = random.Random(3)
    plain, want = plain_host(rng)
    marked = [f"<body><nav>m</nav><article><p>{x}</p></article></body>" for x in [prose(rng) for _ in range(4)]]
    decided = H.decisions(wrapper_of(plain + marked))
    assert [H.main_text(p, decided) for p in plain] == want
    assert all(H.main_text(p, decided) == p[p.index("<p>") + 3 : p.index("</p>")] for p in marked)


def test_names_are_evidence_only():
    long = " ".join(f"{'x' * 8}{i}" for i in range(12))
    page = f'<article><p>one</p><div id="notice-period">two</div><div class="social history">three</div><div class="{long} sidebar">no</div><div class=ads>buy</div><section class=comments><p>{long}</section></article>'
    assert H.main_text(page) == "one\ntwo\nthree"
    assert H.main_text("<body class=sidebar><p>" + "word " * 50 + "</p></body>") == ("word " * 50).strip()


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>a" + "<b>" * 5000 + "deep" + "</b>" * 5000 + "</article>", "adeep"),
        ("<article>" + "<div>x" * 5000, "\n".join(["x"] * 5000)),
        ("<article><p>a</p>" + '<a href="x ' * 90_000, "a"),
        ("<article><p>a</p>" + "<a b='\">c" * 50_000, None),
        ("<article><p>a</p>" + "<" * 1_000_000, None),
        ("<article><p>a</p>" + "<!-" * 300_000, "a"),
        ("<article>" + "<p>a<div>b" * 50_000, None),
        ("<article><p>a</p>" + "</b>" * 200_000 + "</article>", "a"),
    ],
)
def test_hostile_pages(page, want):
    began = time.process_time()
    got = H.main_text(page)
    assert (want is None or got == want) and time.process_time() - began < 15


def test_wrappers_do_not_grow_with_pages():
    rng = random.Random(4)
    pages = [f"<body><div id=post-{i} class='post-{i} entry'><p>{prose(rng)}</p></div></body>" for i in range(400)]
    assert len(json.dumps(wrapper_of(pages))) < 300


def test_main_texts_both_ways(spark):
    rng = random.Random(5)
    hosts = [plain_host(rng) for _ in range(4)]
    rows = [(100 * k + i, f"http://h{k}.org/{i}", p) for k, (pages, _) in enumerate(hosts) for i, p in enumerate(pages)]
    want = {(100 * k + i): w for k, (_, ws) in enumerate(hosts) for i, w in enumerate(ws)} | {900: "", 901: "", 902: "T\ntext of no host"}
    rows += [(900, None, None), (901, "http://h0.org/e", ""), (902, None, "<article><h1>T</h1>text of no host</article>"), rows[0]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", host string, decided int").repartition(3)
    for small, part in ((H.SMALL, H.PART), (0, H.PART), (0, 2)):
        got = H.main_texts(df, small=small, part=part).collect()
        assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert H.main_texts(df.limit(0)).count() == 0 and H.main_texts(df.limit(0), small=-1).count() == 0
