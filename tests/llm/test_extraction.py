"""Page extraction: the reader on odd markup, the cut against brute force, whole tables against their
own article elements, and pages of other makes."""

from __future__ import annotations

import html
import itertools
import random
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from plain import SMALL

from tillwise.llm import extraction
from tillwise.llm.html_blocks import blocks_of
from tillwise.llm.queries import QUERIES


def texts(page):
    return [b.text for b in blocks_of(page)]


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("a<br>b", ["a b"]), ("<b>a</b>b", ["ab"]),
    ("<p>a &amp; b&nbsp;&lt;c&#233; &copy &unknown; &am", ["a & b <cé © &unknown; &am"]),
    ("<p>1 < 2 and 3>2</p>", ["1 < 2 and 3>2"]), ("x<!-- <p>no</p> -->y", ["xy"]), ("x<!-->y", ["xy"]),
    ("a<!-- open", ["a"]), ("<p>a</p><p class='x", ["a"]), ("<p title='a>b' x=\"c>d\">e</p>", ["e"]),
    ("<script>var t='</p>';</script><p>a", ["a"]), ("<style>p{}</style >a", ["a"]), ("<SCRIPT>x</sCrIpT>a", ["a"]),
    ("<script>never ends <p>a", []), ("<head><title>t</title></head><body>a", ["a"]), ("<title>t</title>a", ["a"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("</p></div>a</x>", ["a"]), ("<svg><text>no</text></svg>a", ["a"]), ("<p don't>a</p>it's", ["a", "it's"]),
    ("<p>\t a \n\r b \x0b</p>", ["a b"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("<p/>a<p>é́ 日本</p>", ["a", "é́ 日本"]),
])
def test_reader(page, want):
    assert texts(page) == want


def test_reader_is_linear():
    for part in ("<p>a", "<b>", "<div class='x'>a", "</p>", "<!--", "<a b=\"", "<svg>", "<li>a<ul>", "&amp;", "<", "<script>"):
        started = time.perf_counter()
        blocks_of(part * (400_000 // len(part)))
        assert time.perf_counter() - started < 8, part


def test_cut_is_the_least():
    draw = random.Random(5)
    for _ in range(400):
        n = draw.randint(1, 9)
        odds = np.array([draw.choice([-2, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(n)], float)
        joined = {p: draw.choice([0.25, 0.5, 1.0, 2.0]) for p in itertools.combinations(range(n), 2) if draw.random() < 0.5}

        def cost(labels):
            against = sum(abs(o) for o, kept in zip(odds, labels) if (o > 0) != kept and o)
            return against + sum(w for (i, j), w in joined.items() if labels[i] != labels[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(extraction.minimum_cut(odds, joined).tolist()) == pytest.approx(best)


def test_cut_of_a_long_page():
    n = 30_000
    rng = np.random.default_rng(1)
    joined = {(i, i + 1): 1.0 for i in range(n - 1)} | {(i, i + 3): 0.5 for i in range(n - 3)}
    started = time.perf_counter()
    extraction.minimum_cut(rng.normal(0, 1, n), joined)
    assert time.perf_counter() - started < 30


def article(page):
    """The article element of the test pages, block by block."""
    inner = re.search("<article>(.*?)</article>", page, re.S).group(1).replace("<br>", " ")
    parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", inner))
    return " ".join(x for x in parts if x)


def test_query_on_the_whole_table(spark):
    table = pq.read_table(f"{SMALL}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, SMALL).collect()}
    assert len(got) == len(table)
    for row in table:
        r = got[row["page_id"]]
        assert (r.url, r.text, r.n_chars) == (row["url"], article(row["html"]), len(article(row["html"])))


P = [
    "The harbour was rebuilt after the storm, and the new walls, made of granite, still stand today.",
    "Nobody expected the work to last for eleven years, but money was short and the winters were hard.",
    "In the end, the town paid half of the price; the rest came from the sailors' fund.",
]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = " ".join(P)
CASES = {
    "sections": (f"<header><a href=/>Site</a></header><main><h1>Walls</h1>{BODY}</main><aside><p>Read our best stories of the year, chosen by readers.</p></aside><footer>© 2020 Site</footer>", f"Walls {TEXT}"),
    "named parts": (f"<div class='site-header'>Daily</div><div id='content'><h2>Walls</h2>{BODY}</div><div class='sidebar'><h3>Popular</h3><p>A long story about the sea, and the people who live by it.</p></div><div id=footer>Contact us</div>", f"Walls {TEXT}"),
    "comments in the article": (f"<article>{BODY}<section class='comments'><h3>2 comments</h3><article class='comment'><p>I think the walls are ugly, but who asked me.</p></article><p>So do I, and I live there.</p></section></article>", TEXT),
    "advert between": (f"<article><p>{P[0]}</p><div class='ad-slot'><p>Buy boots now, the best in town.</p></div><p>{P[1]}</p><p>{P[2]}</p></article>", TEXT),
    "form and notice": (f"<div role=alert>We use cookies, and so do our partners, to make the site better.</div><div class=cookie-notice><p>Accept all cookies to go on.</p></div><main>{BODY}<form><p>Sign up for our letter, it is free.</p><label>Mail</label><input></form></main>", TEXT),
    "no marks": (f"<div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport</a></div><div><h1>Walls</h1>{BODY}</div><div><a href=4>About</a> <a href=5>Terms</a></div>", f"Walls {TEXT}"),
    "table layout": (f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a><td>{BODY}</table>", TEXT),
    "list and quote": (f"<article><p>{P[0]}</p><ul><li>granite</li><li>oak</li></ul><blockquote>{P[1]}</blockquote><table><tr><td>1901<td>12</table></article>", f"{P[0]} granite oak {P[1]} 1901 12"),
    "article header": (f"<body class='has-sidebar no-comments'><article class='post category-harbour'><header class=entry-header><h1>Walls</h1></header>{BODY}<footer class=entry-footer>Tagged: sea</footer></article><nav><p>Next: the old mill, and what became of it.</p></nav>", f"Walls {TEXT}"),
    "hidden": (f"<main>{BODY}<p hidden>Not to be seen, ever.</p><div style='display: none'><p>Nor this, of course.</p></div></main>", TEXT),
    "named wrapper": (f"<div class='page with-sidebar'><div class='entry-content'>{BODY}</div><div class=related-posts><p>Another story about walls, this time in the hills.</p></div></div>", TEXT),
    "links in the text": (f"<main><p>{P[0]} <a href=1>See the plan</a>, which is long.</p>{BODY}</main>", f"{P[0]} See the plan, which is long. {TEXT}"),
    "nothing": ("<nav><a href=1>Home</a></nav><footer>© Site</footer>", ""),
}


@pytest.fixture(scope="module")
def trained():
    pages = [blocks_of(r["html"]) for r in pq.read_table(f"{SMALL}/pages.parquet").to_pylist()]
    x, y = (np.concatenate(z) for z in zip(*map(extraction.training_rows, pages)))
    return extraction.fit_weights(x, y)


@pytest.mark.parametrize("name", CASES)
def test_other_makes(name, trained):
    page, want = CASES[name]
    blocks = blocks_of(f"<!DOCTYPE html><html><head><title>t</title></head><body>{page}</body></html>")
    for weights in (trained, np.array(list(extraction.PRIOR.values()))):
        kept = extraction.main_blocks(blocks, extraction.features(blocks) @ weights)
        assert " ".join(b.text for b, k in zip(blocks, kept) if k) == want


def test_odd_and_empty_tables(spark):
    schema = "page_id long, html string, text int, url string"
    rows = [(1, None, 1, "u"), (None, "", 2, None), (2, CASES["sections"][0], 3, "u"), (2, CASES["sections"][0], 3, "u"),
            (3, f"<article>{'<p>A long page has many parts, all of them kept.</p>' * 20_000}</article>", 4, None)]
    pages = spark.createDataFrame(rows, schema)
    weights = extraction.fit_extractor(pages)
    got = extraction.with_main_text(pages, weights)
    assert sorted(got.columns) == sorted(pages.columns)
    found = sorted((r.page_id or 0, len(r.text), r.url or "") for r in got.collect())
    size = len(CASES["sections"][1])
    assert found == [(0, 0, ""), (1, 0, "u"), (2, size, "u"), (2, size, "u"), (3, 46 * 20_000 - 1, "")]
    none = spark.createDataFrame([], schema)
    assert extraction.fit_extractor(none).tolist() == list(extraction.PRIOR.values())
    assert extraction.with_main_text(none, weights).count() == 0
