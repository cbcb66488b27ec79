"""Which parts of a page belong to its article: pages put together from parts that are known to be text or not."""

from __future__ import annotations

import random

import pytest

from tallyhouse.llm.html_text import main_text

SAID = "A sentence of the article, long enough to read like text, with commas, and with a full stop at its end."
TEXT = "".join(f"<p>{SAID} {i}</p>" for i in range(12))
LINES = [f"{SAID} {i}" for i in range(12)]

#: Parts of an article whose names hold a word for something else, and their lines.
OWN = [
    (f"<section id='search'><h2>Search trees</h2><p>{SAID} s</p></section>", ["Search trees", f"{SAID} s"]),
    (f"<div class='subscription-models'><p>{SAID} m</p></div>", [f"{SAID} m"]),
    (f"<div class='social-history'><h3>Of the people</h3><p>{SAID} h</p></div>", ["Of the people", f"{SAID} h"]),
    (f"<section id='discussion'><h2>Discussion</h2><p>{SAID} d</p></section>", ["Discussion", f"{SAID} d"]),
    ("<h2>References</h2><ul><li><a href=a>First source</a></li><li><a href=b>Second source</a></li></ul>",
     ["References", "First source", "Second source"]),
    ("<section><h2>Notes</h2><ol><li><a href=a>A note</a></li></ol></section>", ["Notes", "A note"]),
    (f"<blockquote>{SAID} q</blockquote>", [f"{SAID} q"]),
    ("<table><tr><td>cell<td>another</table>", ["cell", "another"]),
]
#: Parts that belong to no article.
FOREIGN = [
    "<div class='in-article-ad'><p>Buy one of these, for they are the best of all, and get another one for nothing at all, today.</p></div>",
    "<div class='reader-comments'><div class=post><p>I do not agree with this at all, as I have said before, and shall say again.</p></div></div>",
    f"<div id='discussion'><div class='post'><p>{SAID} r</p></div><div class='post'><p>Nor do I, friend.</p></div></div>",
    f"<p style='display: none'>{SAID} n</p>",
    f"<div aria-hidden='true'><p>{SAID} a</p></div>",
    "<div class='search'><input name=q><button>Find</button></div>",
    "<div class='share'>Tell, all, of your friends, of this.</div>",
    f"<div class='newsletter-box'><p>{SAID} w</p><form><input name=mail></form></div>",
    "<ul><li><a href=a>Home</a></li><li><a href=b>Away</a></li></ul>",
]
PAGES = ["<article>{}</article>", "<main>{}</main>", "<div class=post>{}</div>", "<body>{}</body>"]


@pytest.mark.parametrize("page", PAGES)
@pytest.mark.parametrize("part, lines", OWN)
def test_parts_of_the_article(page, part, lines):
    assert main_text(page.format(TEXT + part + TEXT)) == "\n".join([*LINES, *lines, *LINES])


@pytest.mark.parametrize("page", PAGES)
@pytest.mark.parametrize("part", FOREIGN)
def test_parts_of_no_article(page, part):
    assert main_text(page.format(TEXT + part + TEXT)) == "\n".join([*LINES, *LINES])


def test_headings_that_announce_further_pages():
    links = "<ul><li><a href=a>Another page</a></li><li><a href=b>One more</a></li></ul>"
    got = main_text(f"<article>{TEXT}<h3>Related articles</h3>{links}</article>")
    assert "Another page" not in got


def test_lines_beside_the_text():
    page = (
        "<div class=page><div class=top>My Site Name</div><div class=head><h1>Heading</h1></div><div class=who>By someone</div>"
        f"<div class=text>{TEXT}</div><div>All rights reserved</div></div>"
    )
    assert main_text(page) == "\n".join(["Heading", "By someone", *LINES])
    named = f"<div><div class=site-title>Site</div><div class=title>Heading</div><div class=text>{TEXT}</div></div>"
    assert main_text(named) == "\n".join(["Heading", *LINES])


def test_comments_as_articles():
    said = f"<article class=comment><p>{SAID} c</p></article>"
    assert main_text(f"<article>{TEXT}{said}</article>") == "\n".join(LINES)
    assert main_text(f"<article>{TEXT}</article>{said}{said}") == "\n".join(LINES)


def test_hidden_parts_that_are_the_page():
    assert main_text(f"<body><div style='visibility:hidden'>{TEXT}</div></body>") == "\n".join(LINES)
    assert main_text(f"<p>{SAID}<span style='display:none'> unseen</span></p>") == SAID


@pytest.mark.parametrize("seed", range(60))
def test_pages_of_known_parts(seed):
    """Any order of text and known parts, in any page, gives the text and the parts that belong to it."""
    draw = random.Random(seed)
    html, lines = [], []
    for i in range(draw.randrange(3, 25)):
        n = draw.randrange(1, 4)
        said = [f"{SAID} {i}.{j}" for j in range(n)]
        html.append("".join(f"<p>{x}</p>" for x in said))
        lines += said
        if draw.random() < 0.4:
            part, own = draw.choice(OWN)
            html.append(part)
            lines += own
        elif draw.random() < 0.3:
            html.append(draw.choice(FOREIGN))
            html.append(f"<p>{SAID} {i}.9</p>")
            lines.append(f"{SAID} {i}.9")
    page = draw.choice(["<article>{}</article>", "<main>{}</main>", "<div><div class=post>{}</div></div>"])
    around = draw.choice(["{}", "<header><p>My site, of many pages, and of many more words.</p></header>{}<footer>All of it is ours.</footer>"])
    assert main_text(around.format(page.format("".join(html)))) == "\n".join(lines)
