"""Neighbours against all pairs; main text of pages of several makes."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import html_text, neighbours


def brute_force(rows, k, asked):
    usable = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    result = []
    for i, v in usable:
        if not asked(i):
            continue
        scores = []
        for j, w in usable:
            if i != j and len(v) == len(w):
                dot = a = b = 0.0
                for x, y in zip(v, w):
                    dot, a, b = dot + x * y, a + x * x, b + y * y
                scores.append((-max(-1.0, min(1.0, dot / math.sqrt(a * b))), j))
        result += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(result)


def vectors():
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=8).astype("float32").tolist()) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(150)]  # a vector that many share
    rows += [(400 + i, (2 * np.float32(rows[7][1])).tolist()) for i in range(3)]
    rows += [(500, None), (505, []), (510, [0.0] * 8), (515, [1.0] * 7 + [None]), (520, [math.nan] * 8), (525, [math.inf] + [1.0] * 7), (530, [1.0, 2.0]), (535, [1.0, 2.5]), (540, [1.0]), (None, [1.0] * 8)]
    return rows


@pytest.mark.parametrize("blocks", [(2048, 16_384), (10, 30)])
def test_neighbours(spark, blocks):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, size string").repartition(4)
    got = neighbours.nearest(df, F.col("vec_id") % 5 == 0, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 5, lambda i: i % 5 == 0)


def test_small_steps_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "STEP", 7)
    monkeypatch.setattr(neighbours, "PAIRS", 11)
    draw = random.Random(5)
    rows = [(i, [draw.choice([1.0, 2.0, -1.0]) * 2.0**300 for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == brute_force([(i, [x / 2.0**300 for x in v]) for i, v in rows], 3, lambda i: i % 20 == 0)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(df, F.col("vec_id") % 5 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(one, F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("blocks", [(2048, 16_384), (3, 20)])
def test_repeated_queries_ask_once(spark, blocks):
    draw = np.random.default_rng(9)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    rows += [rows[0]] * 8 + [rows[20]] * 3  # more than k times
    rows += [(70 + i, rows[0][1]) for i in range(9)] + [(61, rows[20][1])] * 7  # as a query's, at other ids
    rows += [(40, draw.normal(size=4).tolist())]  # a second vector of a query's id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, query_block=blocks[0], candidate_block=blocks[1])
    expected = []
    for i, v in {(i, tuple(v)) for i, v in rows if i % 20 == 0}:
        expected += [r for r in brute_force([(i, v)] + [r for r in rows if r[0] != i], 5, lambda x, i=i: x == i)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_bounds_hold():
    draw = np.random.default_rng(1)
    a = draw.normal(size=(200, 16)) * draw.lognormal(sigma=2, size=(200, 16))
    codes, scales, lost = neighbours.quantised(a)
    near = (codes.astype(int) @ codes.T.astype(int)) * scales[:, None] * scales[None, :]
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    assert (np.abs(near - unit @ unit.T) <= lost[:, None] + (1 + lost[:, None]) * lost[None, :] + 1e-9).all()


LONG = "This sentence, which is long enough to count, goes on and on, with commas, for the score."
PAGES = {
    f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
    f"<!-- ad --><div class='ad'>Buy, now, cheap, things, here, today!</div><article><h1>Head</h1><p><b>{LONG}<br><p>Two &amp; two\n  lines</p><p>Sh.</p></article>"
    f"<footer>&copy; x</footer></body></html>": f"Head\n{LONG}\nTwo & two lines\nSh.",
    f"<div id=wrap><div class=sidebar><p>{LONG}</p></div><div class=content><p>{LONG}<p>&eacute;&#233;&#xe9; more text in here</p>"
    f"<ul><li>one<li>two</ul></div><div id=comments><p>{LONG} {LONG}</p></div></div>": f"{LONG}\nééé more text in here\none\ntwo",
    f"<body><header><p>Site, header, with, commas, and words.</p></header><main><section><p>{LONG}</p></section><section><p>{LONG}</p><form><p>Mail, me, please, at once, today.</p></form></section></main>"
    "<aside><p>Aside, aside, aside, aside, aside.</p></aside>": f"{LONG}\n{LONG}",
    f"<body><div class='cookie-notice'>We use cookies, you know, for all, sorts, of things.</div><table><tr><td>{LONG}</td></tr></table>": LONG,
    f"<body><div><p>{LONG}</p><ul><li><a href=a>link, one, two, three</a></li><li><a href=b>link, four, five</a></li></ul></div>": LONG,
    "": "", "   ": "", "<p>": "", "plain text only": "plain text only", "<article><p>Short.</p></article><p>Other.</p>": "Short.",
    "<script>never ends <p>x</p>": "", "a &lt;b&gt; c": "a <b> c",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert html_text.main_text(html) == PAGES[html]


MANY = [f"{LONG} {i}" for i in range(40)]
TEXT = "".join(f"<p>{x}</p>" for x in MANY)
PARTS = f"<div class=lead><p>A short intro</p></div><div class=text>{TEXT}</div><blockquote>Quoted.</blockquote><ul><li>one<li>two</ul><table><tr><td>cell</table><pre>code</pre><div><h2>Later</h2><p>Short section</p></div>"
WHOLE = "\n".join(["A short intro", *MANY, "Quoted.", "one", "two", "cell", "code", "Later", "Short section"])


@pytest.mark.parametrize("page", [
    "<article>{}</article>", "<main>{}</main>", "<body><div class=post>{}</div></body>",
    "<nav><a href=/>Home</a></nav><div><div class=post>{}</div></div><footer>Foot, of, the, page, and, more, of, it.</footer>",
    "<div class=row><div class=sidebar><p>Side.</p></div><div class=post>{}</div></div>",
    "<main><article>{}</article><div><a href=a>Another page</a> <a href=b>One more page</a></div></main>",
])
def test_all_parts_of_an_article_stay(page):
    assert html_text.main_text(page.format(PARTS)) == WHOLE


def test_sections_of_unequal_length():
    for page in ("<main>{}</main>", "<div class=post>{}</div>", "<main>{}</main>".replace("{}", "<div>{}</div>")):
        sections = f"<section><h2>A</h2>{TEXT}</section><section><h2>B</h2><div>Brief</div></section>"
        assert html_text.main_text(page.format(sections)) == "\n".join(["A", *MANY, "B", "Brief"])
    several = f"<main><article>{TEXT}</article><article><div>Brief</div></article></main>"
    assert html_text.main_text(several) == "\n".join([*MANY, "Brief"])


@pytest.mark.parametrize("page", [
    "<div class='content has-sidebar'>{}</div>", "<div class='site no-sidebar'><article>{}</article></div>",
    "<div class='layout-with-header'><div>{}</div></div>", "<div class='page nav-open'><article>{}</article></div>",
    "<div id=modal class=search>{}</div>", "<div class=popup><div class=sidebar><main>{}</main></div><div class=comments><article><p>A comment, of some length, but no more.</p></article></div></div>",
    "<form action=/><input value=x><select><option>o</select>{}<button>Send</button></form>", "<form><div class=menu><ul><li><a href=/>Home</a></ul></div><article>{}</article></form>",
    "<div class='site-header'><p>Tagline, of the site, and so on, and on.</p></div><div role=form>{}</div>",
    "<header>{}</header>", "<article>{}</article><div id=comments><article><p>" + LONG * 50 + "</p></article></div>",
])
def test_marks_on_what_holds_the_page(page):
    assert html_text.main_text(page.format(TEXT)) == "\n".join(MANY)


def test_marked_parts_within_an_article():
    parts = f"<div class=section-header><h2>Work</h2></div><div class=related-work><p>{LONG}</p></div><div class=notice><p>Mind this.</p></div>"
    out = f"<div class=related><a href=a>More of this</a></div><div class=ad>Buy</div><form><label>Mail</label></form><div class=share>Tell, all, of your friends, of this.</div>"
    for page in ("<article>{}</article>", "<main>{}</main>"):
        assert html_text.main_text(page.format(TEXT + parts + out)) == "\n".join([*MANY, "Work", LONG, "Mind this."])
    assert html_text.main_text(f"<div class=post>{TEXT}{parts.replace('notice', 'x')}</div>") == "\n".join([*MANY, "Work", LONG, "Mind this."])


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 3000 + LONG) == LONG
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(3000))
    assert html_text.main_text(f"<article>{many}</article>").count("\n") == 2999


def test_extract(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, next(iter(PAGES))), (None, "v", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    text = next(iter(PAGES.values()))
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (2, None, text, len(text)), (None, "v", "x", 1)], key=str)
    assert html_text.extract(pages.filter("page_id > 5")).collect() == []
