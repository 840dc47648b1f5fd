"""Main text of pages, and the cut against all labellings."""

from __future__ import annotations

import itertools
import os
import random
import re
import time

import pytest

from feedmart.llm import html_main
from feedmart.llm.common import ship
from feedmart.llm.html_main import main_text, minimum_cut

WORDS = "The council met on Monday and talked for hours about the old bridge, which has to be closed soon. "


def cost(labels, costs, edges):
    paid = sum(abs(c) for c, content in zip(costs, labels) if (c > 0) != content)
    return paid + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randrange(1, 9)
        costs = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 8)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        least = min(cost(x, costs, edges) for x in itertools.product([False, True], repeat=n))
        assert cost(minimum_cut(costs, edges), costs, edges) == least


def test_long_chains_end():
    n = 20000
    labels = minimum_cut([5 if i == 0 else -4 if i == n - 1 else 0 for i in range(n)], [(i, i + 1, 9) for i in range(n - 1)])
    assert len(set(labels)) == 1


PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="ad">Buy now. {WORDS}</div><!-- <p>not here</p> -->
<article><h1>Bridge &amp; River</h1><p><b>{WORDS}<br><p>Second&nbsp;one   is
 <i>sh</i>ort.<p>Les.</p><form><p>Your name {WORDS}</p></form><div class="comments"><p>I say {WORDS}</p></div></article>
<aside><p>{WORDS}</p></aside><div id="cookie-notice"><p>{WORDS}</p></div><footer>&copy; 2020 somebody. {WORDS}</footer></body></html>"""


def test_article_page():
    assert main_text(PAGE) == "\n\n".join(["Bridge & River", WORDS.strip(), "Second one is short.", "Les."])


def test_page_without_marks():
    links = "".join(f'<div><a href="/{k}">Link {k}</a></div>' for k in range(8))
    paragraphs = "".join(f"<div>{WORDS * k}</div>" for k in (1, 2, 3))
    got = main_text(f"<body>{links}<div>{paragraphs}<div>Short.</div>{paragraphs}</div>{links}</body>")
    assert "Link" not in got and got.count("council") == 12 and "Short." in got


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "header-fixed", "share-enabled", "story", "with-nav page"])
def test_names_of_the_layout_lose_nothing(name):
    body = f"<h2>Title</h2><p>{WORDS}</p><p>{WORDS * 2}</p>"
    plain = main_text(f"<body><div>{body}</div></body>")
    assert main_text(f'<body><div class="{name}">{body}</div></body>') == plain and plain.count("council") == 3
    assert main_text(f'<body><div class="{name}"><div class="entry-content">{body}</div></div></body>') == plain


def test_named_text_counts_inside_what_is_no_main_text():
    page = f'<div class="sidebar">Links here<div class="entry-content"><p>{WORDS * 2}</p></div></div>'
    assert main_text(page) == (WORDS * 2).strip()
    replies = f'<article><p>{WORDS}</p></article><div id="comments"><article class="comment"><div class="entry-content"><p>{WORDS * 3}</p></div></article></div>'
    assert main_text(replies) == WORDS.strip()


def test_the_cut_can_outvote_a_name():
    rich = WORDS * 5
    page = f"<body><div><p>{rich}</p><p>{rich}</p><p class='notice'>{rich}</p><p>{rich}</p><p>{rich}</p></div></body>"
    assert main_text(page).count("council") == 25
    assert html_main.leaning(html_main.blocks(f"<p class='notice'>{rich}</p>")[0]) < 0


def test_formulas_and_buttons_are_text():
    assert main_text(f"<article><p>{WORDS}<math><mi>x</mi></math> <button>and more</button></p></article>") == f"{WORDS}x and more"


def test_open_quotes_leave_no_markup():
    got = main_text(f'<article><p class="a>{WORDS}</p></article>')
    assert got == WORDS.strip()


def test_time_grows_with_the_page():
    def taken(page):
        begin = time.perf_counter()
        main_text(page)
        return time.perf_counter() - begin

    for make in (
        lambda n: f"<div>{WORDS}" * n,
        lambda n: "<svg>" * n + WORDS,
        lambda n: "<div>" * n + "x</section>" * n,
        lambda n: "<div>" * n + "x" + "</div>" * n,
    ):
        taken(make(500))
        assert taken(make(20_000)) < 14 * taken(make(2_500)) + 0.05


def test_odd_pages():
    for page in (None, "", "   ", "<", "<p", "<!-- open", "<script>x", "a < b", "<p>x</p></div></b>", "<a href='>'>" * 50):
        assert isinstance(main_text(page), str)
    assert main_text("<p>" * 3000 + WORDS) == WORDS.strip()
    assert len(main_text("<article>" + f"<p>{WORDS}</p>" * 20000 + "</article>")) > 20000 * 90


def test_table(spark):
    ship(spark)
    pages = spark.createDataFrame([(1, "u", None, 0), (2, "v", PAGE, 0), (2, "v", PAGE, 0)], "page_id long, url string, html string, n_chars int")
    got = sorted(map(tuple, html_main.extract(pages).collect()))
    assert got[0] == (1, "u", "", 0) and got[1] == got[2] and got[1][3] == len(got[1][2])
    assert html_main.extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_given_pages_keep_their_article(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(re.sub(r"<[^>]*>", " ", p).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        import html

        assert main_text(r["html"]) == "\n\n".join(html.unescape(p) for p in parts if p)
