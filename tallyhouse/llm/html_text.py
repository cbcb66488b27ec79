"""Main text of web pages by tree scoring.

A page is parsed into a tree, leniently: open paragraphs and list items end where a browser ends them, and
missing end tags close at the end. Parts that are no article by their kind (scripts, styles, navigation,
form controls and the like) or role are left out. Forms and parts with a word in their class or id that marks
them (advert, cookie, comments and the like) are left out unless they hold the page's articles or most of its
paragraphs, or stand in an article and read like text. A name is read as English reads a compound, its last word
says what it is: ``in-article-ad`` is an advert, ``search-trees`` is not a search box. A discussion is one of readers
if it consists of posts. Hidden parts are left out unless they hold nearly all paragraphs. Every block of text passes points for its length and its commas to its container, half of them to
the next ancestor and less further up; a container's points are discounted by the share of its text that
is links. The article is all that remains of the article or main element around the best container, or else of the
highest ancestor of it that is not made of links and has no menus or the like beside it, without short lines
before and after all that reads like text; siblings of the best container that score well, or read like paragraphs,
belong to it. A list of links is part of the article if it follows a heading of it that announces no further pages.

Each page is parsed on its own in one pass by tasks that stream over Arrow batches, so memory follows the
longest page.

Defined results: a null or empty page, or one without text outside the parts left out, gives an empty text.
Repeated rows are extracted each for itself. An empty table gives an empty result. White space inside a block,
line breaks included, becomes one space; blocks are joined by one newline. The article's own headings are
part of it. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import whole_text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = frozenset(
    "script style noscript template head title nav footer aside button select textarea input iframe object "
    "embed svg canvas audio video dialog menu datalist".split()
)
#: Elements left out that stand beside an article rather than in it.
LAYOUT = frozenset("nav footer aside header".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())


def _words(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{words})(?=$|[\s_-])")


_CONTROLS = r"social|share|sharing|search"
_COMMENTS = r"comments?|replies|respond|disqus"
_FOREIGN_WORDS = (
    rf"ad|ads|adv|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscri\w+|login|signin|"
    rf"signup|{_CONTROLS}|{_COMMENTS}"
)
#: Words in a class or id that mark a part as no article.
FOREIGN = _words(_FOREIGN_WORDS)
#: Of these, words for parts that hold no paragraphs: what has some is named after its subject.
CONTROLS = re.compile(_CONTROLS)
COMMENTS = _words(_COMMENTS)
#: A word of a name that marks a part, or says no more than that it is a part.
_FOREIGN_WORD = re.compile(_FOREIGN_WORDS)
_PART_WORD = re.compile(
    r"\d*|area|bar|block|body|bottom|box|boxes|btn|buttons?|card|col|column|container|content|form|group|holder|icons?|inner|"
    r"inline|items?|js|labels?|left|links?|lists?|main|outer|panel|panes?|parts?|placeholder|popover|region|right|rows?|"
    r"sections?|slots?|text|threads?|titles?|tools?|top|units?|view|widgets?|wrap|wrapper|zone"
)
#: Names of parts in which readers talk, if such children stand in them.
THREADS = _words(r"discussions?|conversations?|threads?|feedback|reactions|responses|reviews|talkback|opinions")
POSTS = _words(r"posts?|comments?|reply|replies|responses?|messages?|reviews?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Headings of lists of other pages.
FURTHER = re.compile(
    r"(?:see also|also|related|more|read (?:more|next|on|also)|recommended|popular|trending|latest|most|top stories|you (?:may|might)|"
    r"share|tags?|topics?|categories|keep reading|continue reading|next|previous|archives?)\b", re.IGNORECASE
)
#: Names of short lines that belong to an article, and of those that belong to its site.
OWN_LINES = _words(r"title|headline|subtitle|lead|lede|standfirst|dek|summary|intro|byline|author|dateline|date|caption|footnotes?|notes?")
SITE_LINES = _words(r"site|brand|logo|copyright|legal|top|bottom")
#: Words that mark a part as no article, unless it stands in one and reads like text.
BESIDE = _words(
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|footer|masthead|banner|related|recommend\w*|widget|toolbar|pagination|pager"
)
#: The same, also where it stands in a main element.
BOXES = _words(r"header|notice|notification|alert")
#: What these say of an element is not what it is: it has or lacks a part, or heads a section.
MODIFIERS = re.compile(
    r"(?:^|(?<=[\s_-]))(?:(?:has|no|not|with|without)[_-]\S*|(?:section|article|entry|post|chapter)[_-]+header|"
    r"related[_-]+(?:works?|literature|research))(?=$|[\s_-])"
)
#: Kinds of marks. A form is one too, as pages may stand in one. Names: foreign words that need not be meant so.
_FOREIGN, _FORM, _BESIDE, _BOX, _NAME, _THREAD = 1, 2, 3, 4, 5, 6
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An end of the keys' elements is implied before an element of the values.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_LISTS = frozenset("ul ol dl table tr tbody thead".split())
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "out", "layout", "mark", "words", "controls", "reads", "points", "length", "links")

    def __init__(
        self, tag: str, parent: Node | None, out: bool, layout: bool = False, mark: int = 0, words: str = ""
    ) -> None:
        self.tag, self.parent, self.out, self.layout, self.mark, self.words = tag, parent, out, layout, mark, words
        self.controls = self.reads = False
        self.children: list[Node | str] = []
        self.points, self.length, self.links = 0.0, 0, 0


def _mark_of(words: str) -> int:
    if not words.strip():
        return 0
    words = MODIFIERS.sub(" ", words)
    if FOREIGN.search(words):
        return _FOREIGN if any(map(_is_foreign, words.split())) else _NAME
    if BESIDE.search(words):
        return _BESIDE
    return _BOX if BOXES.search(words) else _THREAD if THREADS.search(words) else 0


def _is_foreign(name: str) -> bool:
    """Whether the last word of a name that says anything marks a foreign part, other than one of controls."""
    for word in reversed(re.split("[_-]+", name)):
        if _FOREIGN_WORD.fullmatch(word):
            return not CONTROLS.fullmatch(word)
        if not _PART_WORD.fullmatch(word):
            return False
    return False


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("root", None, False)
        self.marked: list[Node] = []  # in page order
        self.articles = False

    def _end(self, node: Node) -> None:
        """Close everything up to and including ``node``."""
        self.at = node.parent or self.root

    def _open(self, tags: frozenset | set, borders: frozenset | set) -> Node | None:
        node = self.at
        while node is not self.root and node.tag not in borders:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):
            return
        if tag not in INLINE:
            paragraph = self._open({"p"}, _BORDERS)
            if paragraph is not None:
                self._end(paragraph)
        for open_tag, closers in CLOSED_BY.items():
            if tag in closers:
                same = self._open({open_tag}, _LISTS if open_tag not in ("td", "th", "tr") else {"table"})
                if same is not None:
                    self._end(same)
        if tag in HEADINGS:
            heading = self._open(HEADINGS, _BORDERS)
            if heading is not None:
                self._end(heading)
        out = self.at.out or tag in LEFT_OUT
        layout, mark, words = tag in LAYOUT, 0, ""
        if tag in ("input", "select", "textarea", "button"):
            for node in _ancestors(self.at):
                node.controls = True
        if not out and attrs:
            named = dict(attrs)
            hidden = HIDDEN.search((named.get("style") or "").lower()) or (named.get("aria-hidden") or "").lower() == "true"
            if tag in INLINE:
                out = bool(hidden) or "hidden" in named
            else:
                role = (named.get("role") or "").lower()
                words = f"{named.get('class') or ''} {named.get('id') or ''}".lower()
                if role in ROLES or "hidden" in named:
                    out, layout = True, role in ROLES
                elif hidden:
                    mark = _FOREIGN
                elif tag == "article":
                    mark = _FOREIGN if self.articles and COMMENTS.search(words) else 0
                elif tag != "main":
                    mark = _mark_of(words) or (_FORM if role == "form" else 0)
        if not out and not mark:
            if tag == "header" and not self._open({"article", "main"}, set()):
                mark = _BESIDE
            elif tag == "form":
                mark = _FORM
        self.articles = self.articles or tag in ("article", "main") and not out and not mark
        node = Node(tag, self.at, out, out and layout, mark, words)
        if mark:
            self.marked.append(node)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not self.root:
            if node.tag == tag:
                return self._end(node)
            if tag in INLINE and node.tag not in INLINE:
                return None  # the end of a line element does not close a block
            node = node.parent
        return None

    def handle_data(self, data: str) -> None:
        if not self.at.out:
            self.at.children.append(data)


_BORDERS = frozenset("td th table button object".split())


class Block:
    """A run of text within one block element; ``owner`` is that element."""

    __slots__ = ("owner", "text", "links")

    def __init__(self, owner: Node, text: str, links: int) -> None:
        self.owner, self.text, self.links = owner, text, links


def blocks_of(root: Node) -> list[Block]:
    """The tree's blocks in page order, without parts left out; an explicit stack bears any depth."""
    found: list[Block] = []
    run: list[str] = []
    links = 0

    def flush(owner: Node) -> None:
        nonlocal links
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            found.append(Block(owner, text, min(links, len(text))))
        run.clear()
        links = 0

    stack: list[tuple[Node, Node, int, int]] = [(root, root, 0, 0)]  # element, block it is in, next child, links around
    while stack:
        node, owner, i, inside = stack.pop()
        if i == len(node.children):
            if node is owner:
                flush(owner)
            continue
        stack.append((node, owner, i + 1, inside))
        child = node.children[i]
        if isinstance(child, str):
            run.append(child)
            links += len(child.strip()) if inside else 0
        elif child.tag == "br":
            run.append(" ")
        elif not child.out:
            if child.tag in INLINE:
                stack.append((child, owner, 0, inside + (child.tag == "a")))
            elif not child.children:
                flush(owner)
            else:
                flush(owner)
                stack.append((child, child, 0, inside))
        elif child.tag not in INLINE:
            flush(owner)
    return found


def _ancestors(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _links_share(node: Node) -> float:
    return node.links / node.length if node.length else 0.0


def leave_out(marked: list[Node], blocks: list[Block]) -> None:
    """Decide for each marked part whether it is left out, by the text of the page that it holds.

    A part stays if it holds the page's only articles, or most of the page's paragraphs (nearly all, if its mark
    is of a foreign kind or the page has an article elsewhere), or stands in an article and reads like text. One with
    a foreign word in its name reads like text if it holds a paragraph of 80 characters and no controls; for it and for
    discussions, paragraphs beside it are as good as an article. Discussions that hold no posts stay.
    """
    prose, length, links, longest = ({id(m): 0 for m in marked} for _ in range(4))
    total = 0
    articles: dict[tuple[int, ...], int] = {}  # text of articles by the marked parts around them
    for b in blocks:
        reads = len(b.text) if len(b.text) >= 25 and b.owner.tag not in HEADINGS and 2 * b.links < len(b.text) else 0
        total += reads
        around, in_article = [], False
        for node in _ancestors(b.owner):
            if node.tag in ("article", "main") and not node.mark:
                in_article = in_article or not around
            elif node.mark:
                around.append(id(node))
                longest[id(node)] = max(longest[id(node)], reads)
                prose[id(node)] += reads
                length[id(node)] += len(b.text)
                links[id(node)] += b.links
        if in_article:
            articles[tuple(around)] = articles.get(tuple(around), 0) + reads
    stays: set[int] = set()
    elsewhere = articles.get((), 0) > 0
    if not elsewhere:
        most = max(articles.values(), default=0)
        for around, n in articles.items():
            if 2 * n >= most:
                stays.update(around)
    for m in marked:
        if id(m) in stays:
            continue
        share = 0.9 if elsewhere or m.mark == _FOREIGN else 0.5
        kinds = ("article",) if m.mark == _BESIDE else ("article", "main") if m.mark in (_BOX, _NAME, _THREAD) else ()
        text = length[id(m)] and links[id(m)] < 0.3 * length[id(m)]
        within = any(x.tag in kinds for x in _ancestors(m.parent))
        if m.mark == _NAME:
            text = text and longest[id(m)] >= 80 and not m.controls
            within = within or _stands_in_text(m)
        elif m.mark == _THREAD:
            posts = any(isinstance(x, Node) and (x.tag == "article" or POSTS.search(x.words)) for x in m.children)
            text, within = not posts, True
        if prose[id(m)] > share * total or text and within:
            continue
        m.out, m.layout = True, m.mark in (_BESIDE, _BOX)


def _stands_in_text(node: Node) -> bool:
    """Whether paragraphs stand right beside a part."""
    beside = node.parent.children if node.parent else []
    return any(
        isinstance(x, Node) and x.tag == "p" and not x.out
        and sum(len(y) for y in x.children if isinstance(y, str)) >= 25
        for x in beside
    )


def article(blocks: list[Block]) -> list[Block]:
    """The blocks of the best container and of the siblings that belong to it."""
    for b in blocks:
        reads = b.owner.tag in HEADINGS or len(b.text) >= 25 and 2 * b.links < len(b.text)
        for node in _ancestors(b.owner):
            node.length += len(b.text)
            node.links += b.links
            node.reads = node.reads or reads
    scored: dict[int, Node] = {}
    for b in blocks:
        if len(b.text) < 25 or b.owner.tag in HEADINGS:
            continue
        points = 1 + b.text.count(",") + b.text.count("，") + min(len(b.text) // 100, 3)
        first = b.owner.parent if b.owner.tag in PARAGRAPHS and b.owner.parent else b.owner
        while first.tag in PARAGRAPHS and first.parent is not None:
            first = first.parent
        for level, node in enumerate(_ancestors(first)):
            if id(node) not in scored:
                scored[id(node)] = node
                node.points = 25.0 if node.tag in ("article", "main") else 0.0
            node.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
    if not scored:
        named = [b for b in blocks if any(n.tag in ("article", "main") for n in _ancestors(b.owner))]
        return named or blocks
    best = max(scored.values(), key=lambda n: n.points * (1 - _links_share(n)))
    least = max(10.0, 0.2 * best.points * (1 - _links_share(best)))
    chosen = {id(best)}
    for sibling in best.parent.children if best.parent else []:
        if isinstance(sibling, str) or sibling is best or sibling.out:
            continue
        score = sibling.points * (1 - _links_share(sibling)) if id(sibling) in scored else 0.0
        reads = sibling.tag == "p" and (
            sibling.length > 80 and _links_share(sibling) < 0.25
            or 0 < sibling.length <= 80 and not sibling.links
        )
        if score >= least or reads or sibling.tag in HEADINGS and sibling.length:
            chosen.add(id(sibling))
    whole, edges = _whole(best)
    gained = {id(whole), *(id(x) for x in _articles_beside(whole))}
    announced = _announced(blocks)
    kept = []
    for b in blocks:
        menu = linked = inside = False
        for node in _ancestors(b.owner):
            if id(node) in edges:
                break
            if id(node) in chosen or id(node) in gained and not linked:
                inside = True
                break
            if id(node) in announced:
                menu = linked = False
                continue
            heavy = node.links > 0.6 * node.length
            menu = menu or heavy and node.tag in _LISTS
            # beside the best container, whatever is made of links is a menu
            linked = linked or heavy and node.tag not in PARAGRAPHS
        if inside and not menu:
            kept.append(b)
    return kept


def _announced(blocks: list[Block]) -> set[int]:
    """Lists of links right after a heading that stands in an article or beside paragraphs and announces no further
    pages, with the section of the two if they are all of it."""
    found: set[int] = set()
    for before, b in zip(blocks, blocks[1:]):
        heading = before.owner
        if heading.tag not in HEADINGS or not b.links or FURTHER.match(before.text) or heading.parent is None:
            continue
        for node in _ancestors(b.owner):
            if node.parent is heading.parent:
                section = heading.parent
                parts = [x for x in section.children if isinstance(x, Node) and x.length]
                alone = all(x is node or x is heading for x in parts) and not any(map(str.strip, filter(_is_text, section.children)))
                within = any(x.tag in ("article", "main") for x in _ancestors(heading)) or _stands_in_text(heading)
                if node.tag in _LISTS and (within or alone and _stands_in_text(section)):
                    found.update(id(x) for x in (node, *_inner_lists(node)))
                    if alone:
                        found.add(id(section))
                break
    return found


def _is_text(child: Node | str) -> bool:
    return isinstance(child, str)


def _inner_lists(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        for x in stack.pop().children:
            if isinstance(x, Node) and not x.out:
                if x.tag in _LISTS:
                    yield x
                stack.append(x)


def _whole(best: Node) -> tuple[Node, set[int]]:
    """The article around the best container: the enclosing article or main, or else the highest ancestor that
    is not made of links and has no menus or the like beside what holds the container. Then also what does not belong
    to it: the short parts without a heading before and after all that reads like text, unless named as its lines."""
    for node in _ancestors(best):
        if node.tag in ("article", "main"):
            return node, set()
    node = best
    edges: set[int] = set()
    while node.parent is not None and _links_share(node.parent) < 0.3 and not any(
        x is not node and isinstance(x, Node) and x.layout for x in node.parent.children
    ):
        parts = [x for x in node.parent.children if isinstance(x, Node) and not x.out and x.tag not in INLINE]
        for side in (parts, parts[::-1]):
            for x in side:
                if x is node or x.reads:
                    break
                own = x.tag in PARAGRAPHS or OWN_LINES.search(x.words) and not SITE_LINES.search(x.words)
                if not own and not any(isinstance(y, Node) and y.tag in PARAGRAPHS for y in x.children):
                    edges.add(id(x))
        node = node.parent
    return node, edges


def _articles_beside(node: Node) -> list[Node]:
    """The parts of an article that its page cuts into several."""
    if node.tag != "article" or node.parent is None:
        return []
    return [
        x for x in node.parent.children
        if isinstance(x, Node) and x.tag == "article" and not x.out and x.length and _links_share(x) < 0.3
    ]


def main_text(html: str) -> str:
    """The article of a page, a line per block."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    blocks = blocks_of(builder.root)
    if builder.marked:
        leave_out(builder.marked, blocks)
        blocks = blocks_of(builder.root)
    return "\n".join(b.text for b in article(blocks))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                texts = [main_text(x) for x in rows.column(2).to_pylist()]
                counts = pa.array([len(x) for x in texts], pa.int64())
                cells = [rows.column(0), rows.column(1), pa.array(texts, pa.string()), counts]
                yield pa.RecordBatch.from_arrays(cells, ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), whole_text(html_col).alias("html")
    )
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long").withColumnRenamed("page_id", id_col)
