"""Main text of pages: the cut against all cuts, made-up pages, and the page table."""

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import maincontent as mc
from breathline.llm import queries

NONE = np.zeros(mc.FEATURES)
LONG = "This is a long enough sentence of the article, with some commas, that tells a story. "


def test_cut_is_the_least_of_all_cuts():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(1, 8)
        odds = [rng.choice([-9.0, -1.5, -0.5, 0.7, 2.0, 4.0]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.3, 0.9, 1.5])) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(keep, odds=odds, edges=edges):
            unary = sum(-x if k and x < 0 else x if not k and x > 0 else 0 for x, k in zip(odds, keep, strict=True))
            return unary + sum(c for a, b, c in edges if keep[a] != keep[b])

        got = mc.minimum_cut(odds, edges)
        assert cost(got) == pytest.approx(min(cost(k) for k in itertools.product([False, True], repeat=n)))


def test_cut_of_a_long_chain():
    odds = [4.0] * 3000 + [-0.5] + [4.0] * 3000 + [-9.0] * 2000
    keep = mc.minimum_cut(odds, [(i, i + 1, 1.5) for i in range(len(odds) - 1)])
    assert keep == [True] * 6001 + [False] * 2000
    assert mc.minimum_cut([], []) == []


@pytest.mark.parametrize("page,text", [
    ("", ""),
    ("<html><body></body></html>", ""),
    (f"<article><h1>Title &amp; more</h1><p>{LONG}<p>Short.<p>{LONG}</article>", f"Title & more\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
    (f"<nav><a href=x>Home</a></nav><main><p>{LONG}</p><div class='ad'>Buy {LONG}</div><p>End.</p></main><footer>&copy; us</footer>",
     f"{LONG.strip()}\n\nEnd."),
    (f"<body><header><h1>Site</h1></header><article><header><h1>Own title</h1></header><p>{LONG}</p><section id=comments><p>{LONG}</p></section></article>",
     f"Own title\n\n{LONG.strip()}"),
    (f"<div id='content' class='has-sidebar'><article><p>{LONG}</p></article><div class='sidebar'><p>{LONG}</p></div></div>", LONG.strip()),
    (f"<article><p>a <b>b<br>c</b>\n\t d&nbsp;e</p><p>{LONG}<!-- <p>no</p> --><script>var t='</p><p>no</p>';</script></p></article>", f"a b c d e\n\n{LONG.strip()}"),
    (f"<article><p>1 &lt; 2 <3 and 5 > 4</p><p title='a > b'>{LONG}</p><ul><li>one<li>two</ul></article>", f"1 < 2 <3 and 5 > 4\n\n{LONG.strip()}\n\none\n\ntwo"),
    (f"<body class='comments-open'><main><div class='entry-header'><h1>Own</h1></div><p style='overflow: hidden'>{LONG}</p>"
     f"<div role=navigation>no</div><div class='cookie-notice'><p>{LONG}</p></div></main>", f"Own\n\n{LONG.strip()}"),
    (f"<form id=aspnet><article><p>{LONG}</p></article><form><p>Search</p><input value=x></form></form>", LONG.strip()),
    (f"<article><p>{LONG}</p><table><tr><td>a<td>b</tr><tr><td>c<td>d</table><p hidden>no</p><p>Cut off <b", f"{LONG.strip()}\n\na b\n\nc d\n\nCut off"),
    (f"<title>no</title><style>p {{}}</style><noscript><p>no</p></noscript><article><p>{LONG}</p><!-- open", LONG.strip()),
    (f"<article><p>{LONG}</p><p>&#233;&#xe9;&eacute; &bogus; &am</p></article>", f"{LONG.strip()}\n\nééé &bogus; &am"),
])
def test_made_up_pages(page, text):
    assert mc.main_text(page, NONE) == text


def test_text_alone_decides_without_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = mc.fit_text_model(pages)
    links = "".join(f"<div><a href={i}>Link {i}</a></div>" for i in range(6))
    body = "".join(f"<div>{LONG * 2}</div>" for _ in range(4))
    assert mc.main_text(f"<body>{links}{body}{links}", weights) == "\n\n".join([(LONG * 2).strip()] * 4)
    assert not mc.fit_text_model(pages.limit(0)).any()


def test_odd_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "v", ""),
            (3, "w", "<p>" + LONG * 20_000), (4, "x", "<" * 5000 + "<div>" * 3000 + "deep"), (5, "y", "<a title=\"open>" + LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("id", "page", "text", "n_chars", "x", "y", "count"):
        pages = pages.withColumn(name, F.lit("z"))
    got = mc.extract(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[1] == LONG.strip() and texts[2] == texts[None] == "" and texts[3] == (LONG * 20_000).strip()
    assert mc.extract(pages.limit(0)).count() == 0


def test_query_gives_the_articles_of_the_page_table(spark):
    sf, wrong = "/root/testdata/sf0.01", []
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op10_main_text(spark, sf).collect()
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]]["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        if r["text"] != "\n\n".join(p for p in parts if p) or r["url"] != pages[r["page_id"]]["url"]:
            wrong.append(r["page_id"])
    assert not wrong and len(got) == len(pages)
