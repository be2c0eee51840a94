import time

import pytest
from pyspark.sql import Row

from usagelens.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>Out</title><style>p{}</style></head>
<body class="with-sidebar"><header><a href="/">Home</a> Site name</header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div id="cookie-notice"><p>We use cookies here, do accept them.</p></div>
<div class="wrap"><div class="post"><h1>A  title</h1><p>First &lt;b&gt; paragraph with <b>bold</b>&nbsp;words &amp; more of them.
<p>Second one,<br>over two lines and some words.</p><script>if (a < b) document.write("</p>")</script>
<div class="ad">Buy a thing now</div><ul><li>item one of the list</li><li>item two</ul></div>
<form><label>Name</label><button>Send</button></form></div>
<section id="comments"><p>I liked this a great deal, thank you for it.</p></section>
<aside>See also</aside><footer>All rights reserved</footer></body></html>"""
TEXT = (
    "A title\n\nFirst <b> paragraph with bold words & more of them.\n\n"
    "Second one, over two lines and some words.\n\nitem one of the list\n\nitem two"
)


def test_article_only():
    assert pages.main_text(PAGE, dict(pages.FIRST_WEIGHTS)) == TEXT


def test_large_boilerplate_is_no_wrapper():
    weights = dict(pages.FIRST_WEIGHTS)
    article = " ".join(f"word{k}" for k in range(20))
    other = " ".join(f"reply{k}" for k in range(50))
    for start in (
        'section id="comments"', 'div class="cookie-notice"', 'div class="related sidebar"', 'div id="respond"',
        'div class="advert"', 'div id="sidebar"', 'div role="complementary"',
    ):
        name = start.split()[0]
        inner = f"<p>{other}</p>" if "sidebar" in start else f"<div><h1></h1><p>{other}</p></div>"
        page = f"<body><div><p>{article}</p></div><{start}>{inner}</{name}></body>"
        assert pages.main_text(page, weights) == article, start
    for inner in (f"<h1>Title</h1><p>{other}</p>", f"<div><p>Title</p><p>{other}</p></div>"):
        page = f'<body><div class="with-sidebar">{inner}</div></body>'
        assert pages.main_text(page, weights).split() == ["Title", *other.split()]


LONG = " ".join(f"word{k}" for k in range(30))
FIRST = dict(pages.FIRST_WEIGHTS)


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<p title="a < b > c">{LONG}</p>', LONG),
        (f"<p title='a < b > c'>{LONG}<img alt=\"x < y\"> end</p>", f"{LONG} end"),
        (f'<p title="never closed>{LONG}</p>', LONG),
        (f'<div data-id="related"><p>{LONG} <a href="/p?id=ad">linked words</a> {LONG}</p></div>', f"{LONG} linked words {LONG}"),
        (f'<article><h1><a href="/">A linked title</a></h1><p>{LONG}</p></article>', f"A linked title\n\n{LONG}"),
        (f'<div><h1><a href="/">A linked title</a></h1><p>{LONG}</p></div>', f"A linked title\n\n{LONG}"),
        (
            "<main><p>" + LONG + "</p><ul>" + "<li><a>some link text here</a></li>" * 12 + f"</ul><p>{LONG}</p><nav>out</nav></main>",
            "\n\n".join([LONG, *["some link text here"] * 12, LONG]),
        ),
        (f'<h2 class="share-price">Prices</h2><p id="search">{LONG}</p>', f"Prices\n\n{LONG}"),
        (f'<p>{LONG}</p><p style="color:red; display: none">unseen</p><div hidden>unseen</div><p aria-hidden="true">x</p>', LONG),
        (f'<p>{LONG}</p><div class="discussion"><p>{LONG}</p></div>', LONG),
        (f'<p>{LONG}</p><ul><li class="ad">buy</li><li class="ad-hoc">{LONG}</li></ul>', f"{LONG}\n\n{LONG}"),
    ],
)
def test_markup_that_misled(page, text):
    assert pages.main_text(f"<body>{page}</body>", FIRST) == text


def test_hints_are_learnt_from_labelled_pages():
    def page(k, box):
        return f'<body><div class="{box}"><p>{LONG}</p></div><article><div class="lead"><p>{LONG} {k}</p></div></article></body>'

    weights = pages.learn([page(k, "zebra") for k in range(6)] + [page(k, f"own{chr(97 + k)}") for k in range(4)])
    assert "hint zebra" in weights and not {"hint lead", "hint own", "hint owna"} & set(weights)
    unmarked = f'<body><div class="zebra"><p>{LONG} x</p></div><div class="lead"><p>{LONG}</p></div></body>'
    assert pages.main_text(unmarked, weights) == LONG


@pytest.mark.parametrize(
    "unit", ['<div class="ad">x', "<b>", "<p><b>", "<li><i>x", "</div>x", '<a "', "<td><ul>", "<article>x", '<p title="', "<h1><a>x"]
)
def test_a_large_hostile_page_takes_little_time(unit):
    page = unit * (1_000_000 // len(unit))
    start = time.perf_counter()
    pages.main_text(page, FIRST)
    assert time.perf_counter() - start < 20


def test_region_equals_brute_force():
    tokens, _ = pages.parse(PAGE)
    weights = dict(pages.FIRST_WEIGHTS)
    value = [pages.weight(weights, f) * n for f, n, _, _ in tokens]
    best = max(sum(value[i:j]) for i in range(len(value)) for j in range(i, len(value) + 1))
    start, end = pages.best_region(tokens, weights)
    assert abs(sum(value[start:end]) - best) < 1e-9


def test_marked_articles_are_recovered(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = pages.fit(raw)
    assert all(v > 0 if k == "word" or k.startswith("hint") else v < 0 for k, v in weights.items())
    wrong = 0
    for row in pages.extract(raw, weights).collect():
        tokens, mark = pages.parse(row["html"])
        first, last = mark
        words = " ".join("".join(t if not b else " " for f, _, t, b in tokens[first:last]).split())
        wrong += words.split() != row["text"].split()
    assert wrong <= 0.01 * raw.count()


def test_hostile_pages(spark):
    rows = [
        Row(page_id=1, url=None, html=None, text="old"),
        Row(page_id=1, url="u", html="", text="old"),
        Row(page_id=None, url="u", html="<p", text="old"),
        Row(page_id=2, url="u", html="just words", text="old"),
        Row(page_id=3, url="u", html="<!-- open", text="old"),
        Row(page_id=4, url="u", html="<script>never closed", text="old"),
        Row(page_id=5, url="u", html="</div></p><p>fine <b>words</p> &#x41;&bogus;", text="old"),
        Row(page_id=6, url="u", html="<div>" * 3000 + "deep words here" * 5, text="old"),
        Row(page_id=7, url="u", html='<a "' * 20000, text="old"),
        Row(page_id=8, url="u", html="<p>long " + "word " * 200000, text="old"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = pages.extract(df, pages.fit(df))
    assert out.columns == ["page_id", "url", "html", "text"]
    got = {r["page_id"]: r["text"] for r in out.collect() if r["page_id"] not in (1, None)}
    assert got[2] == "just words" and got[3] == got[4] == ""
    assert got[5] == "fine words\n\nA&bogus;" and len(got[8].split()) == 200001
    assert pages.extract(df.filter("false"), pages.fit(df.filter("false"))).collect() == []
