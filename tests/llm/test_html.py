from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rivulet.llm.html import extract, main_text, stretches

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p > a {}</style><script>var t = "</p><p>no";</script></head>
<body class="has-sidebar menu"><header><p>Site name</p></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="ad">Buy now <div>really</div> today</div><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First
  par<i>agraph</i>&nbsp;here.<br>Same block</p><p>Second &lt;b&gt; one.
<aside>Side bar</aside><div class="advert">Ad inside</div><ul><li>Item one</li><li><a href="x">Item two</a></li></ul>
<form><input value="x"><label>Name</label></form><p>Last.</p></article>
<section id="comments"><article class="comment"><p>I like it very much, indeed.</p></article></section>
<footer>&copy; nobody</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == "\n\n".join(["Head & line", "First paragraph here. Same block", "Second <b> one.", "Item one",
                                            "Item two", "Last."])


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a", "a"), ("<nav>x", ""), ("a < b", "a < b"), ("<p>x</p", "x"),
    ("<p>one<p>two", "one\n\ntwo"), ("<script>x", ""), ("<!-- x", ""), ("<article></article><p>out</p>", "out"),
    ("<nav><a>m</a><article>t</article>", "t"), ("<p title='a>b'>c</p>", "c"), ("<p title='a>b>c</p>", "b>c"),
    ("<div>&#233;&eacute;&unknown;&amp;amp;</div>", "éé&unknown;&amp;"), ("<TABLE><TR><TD>a</TD><td>b", "a\n\nb")])
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_pages_without_a_marked_article():
    long = "This is the text of the page, and it goes on for quite a while in this way. " * 3
    page = (f"<div><a href=/1>One</a> <a href=/2>Two</a></div><div class=menu>x</div><div><h2>Title</h2><p>{long}</p>"
            f"<div class=ad>no</div><p>{long}</p></div><div class=share>y</div><div>tiny</div>")
    assert main_text(page) == "\n\n".join(["Title", long.strip(), long.strip()])


def test_surge_and_dive():
    assert stretches([0, 5, 0, 0, 7, 0, 0, 0, 2], 3) == [(1, 5), (8, 9)]
    assert stretches([], 3) == [] and stretches([0, 0], 3) == []


def test_long_page():
    assert main_text("<article>" + "<p>word " * 200_000).count("word") == 200_000
    assert main_text("<div>" * 50_000 + "x") == "x"


def test_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .withColumns({c: F.lit(7) for c in ("text", "n_chars", "lines")})
    got = [(r.page_id, r.url, r.text, r.n_chars, r.lines) for r in extract(pages).collect()]
    want = main_text(PAGE)
    assert sorted(got, key=str) == sorted([(1, "u", want, len(want), 7)] * 2 + [(2, None, "", 0, 7), (None, "v", "", 0, 7)], key=str)
    assert extract(pages.where("false")).count() == 0


def test_every_page_gives_its_article(spark):
    import html as H
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(H.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", inside))
        assert got[r.page_id] == "\n\n".join(x for x in blocks if x)


def test_the_stretches_choose_also_where_articles_are_marked():
    long = "This is the text of the page, and it goes on for quite a while in this way. " * 3
    teaser = "<article><h3>Next</h3><p>More about it.</p></article>"
    assert main_text(f"<body><div><h1>Title</h1><p>{long}</p></div>{teaser}{teaser}</body>") == f"Title\n\n{long.strip()}"
    assert main_text(f"<body><p>out</p><article><p>{long}</p><aside>x</aside><p>End.</p></article></body>") == f"{long.strip()}\n\nEnd."


LONG = "This is the text of the page, and it goes on for quite a while in this way. " * 3


@pytest.mark.parametrize("mark", ['class="content has-sidebar"', 'class="elementor-widget-container"', 'id="page-with-toc"',
                                  'class="no-comments"', 'class="search-result-page"'])
def test_wrappers_keep_their_text(mark):
    inner = f"<h1>Title</h1><p>{LONG}</p><div class='cookie-notice'>We use cookies</div><div class=ad>x</div>"
    want = f"Title\n\n{LONG.strip()}"
    assert main_text(f"<body><nav>n</nav><div {mark}>{inner}</div><footer>f</footer></body>") == want
    assert main_text(f"<body><article><div {mark}>{inner}</div></article></body>") == want
    assert main_text(f"<body><div {mark}><div {mark}>{inner}</div></div></body>") == want


def test_short_stretches_of_the_text_stay():
    for cut in ("<div class=ad>buy</div>", "<aside>a</aside>"):
        body = f"<h1>Title</h1>{cut}<p>{LONG}</p>{cut}<p>Short.</p>{cut}<p>{LONG}</p>{cut}<p>End.</p>"
        want = "\n\n".join(["Title", LONG.strip(), "Short.", LONG.strip(), "End."])
        assert main_text(f"<body>{body}</body>") == want
        assert main_text(f"<body><div>{body}</div>{cut}<div>tiny</div></body>") == want
        assert main_text(f"<body><div><h1>Title</h1>{cut}<div><p>{LONG}</p></div></div></body>") == f"Title\n\n{LONG.strip()}"


def test_many_nested_wrappers():
    assert main_text("<div class=widget-area>" * 20_000 + LONG) == LONG.strip()


def test_the_line_blocks_choose_without_marks_or_classes(spark):
    """With the check of marked articles off and only menu and form words listed, every page gives the same text."""
    few = frozenset(["nav", "navbar", "navigation", "menu", "form"])
    for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect():
        assert main_text(r.html, few, check_marked=False) == main_text(r.html)


@pytest.mark.parametrize("wrapper", ['<form id="aspnetForm" action="/x">', '<div class="widget">', '<div role="form">', '<aside>',
                                     '<div class="comments">'])
def test_an_element_round_the_whole_page_takes_nothing_out(wrapper):
    name = wrapper[1:].split()[0].rstrip(">")
    inner = (f"<div class=ad>Buy</div><h1>Title</h1><p>{LONG}</p><form><input><label>Name</label></form><p>{LONG}</p>"
             f"<div class='newsletter'>Get our letter</div>")
    want = f"Title\n\n{LONG.strip()}\n\n{LONG.strip()}"
    assert main_text(f"<body><nav>n</nav>{wrapper}{inner}</{name}></body>") == want
    assert main_text(f"<body>{wrapper}<article>{inner}</article></{name}></body>") == want
    assert main_text(f"<body>{wrapper}{wrapper}<p>{LONG}" + "</p>" + f"</{name}>" * 2 + "</body>") == LONG.strip()


def test_unmarked_menus_and_footers_go():
    menu = "".join(f"<div><a href=/{w}>{w}</a></div>" for w in ("Home", "News", "Sport", "Weather"))
    plain = "".join(f"<div>{w}</div>" for w in ("Home", "News", "Sport", "Weather", "Contact us"))
    items = "<ul>" + "".join(f"<li>{w}</li>" for w in ("Home", "News", "Sport", "Weather")) + "</ul>"
    foot = "<div><span>Example Ltd</span></div><div>12 High Street</div><div>All rights reserved</div>"
    text = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>The end.</p>"
    want = "\n\n".join(["Title", LONG.strip(), "Short.", LONG.strip(), "The end."])
    for before in (menu, plain, items, f"<div>{plain}</div>", f"<div>{menu}{plain}</div>"):
        for after in ("", foot, f"<div>{foot}</div>", items):
            assert main_text(f"<body>{before}{text}{after}</body>") == want, (before, after)
            assert main_text(f"<body>{before}<div><div>{text}</div></div>{after}</body>") == want, (before, after)


def block_sums(lines, window=3, surge=60):
    """Lines inside some window that holds enough text, by trying every window."""
    lengths = [len(x) for x in lines]
    inside = set()
    for i in range(1 - window, len(lines)):
        at = range(max(i, 0), min(i + window, len(lines)))
        if sum(lengths[k] for k in at) >= surge:
            inside |= {k for k in at if lengths[k]}
    return inside


def test_surges_by_brute_force():
    """Plain pages of bare lines: what lies in a window with enough text is between the first surge and the last dive."""
    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.choice([0, 0, 5, 20, 45, 90, 150]) for _ in range(rng.randint(0, 25))]
        inside = block_sums(["x" * n for n in lengths])
        found = stretches(lengths, 3, 60, 10)
        covered = {k for a, b in found for k in range(a, b) if lengths[k]}
        assert inside <= covered
        assert all(a < b and lengths[a] and lengths[b - 1] for a, b in found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
        assert bool(found) == bool(inside)
        for a, b in found:  # no dive inside: every window that ends between surge and dive holds something
            for end in range(a + 3, b):
                assert sum(lengths[end - 2:end + 1]) >= 10 or not any(lengths[end:b])
