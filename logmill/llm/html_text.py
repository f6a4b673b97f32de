"""Operator 10: main text of web pages by composite text density.

Every node of a page's tree gets a density, its characters per tag, adjusted for the share
of them inside links. A node's density sum is the sum of its children's densities. The node
with the largest sum lies in the article; the smallest density on the path from it up to the
body is the threshold. From the body down, every node that reaches the threshold marks, in
its subtree, the node with the largest sum. What is marked is the main text. Elements inside
a line (bold, links) are no nodes of their own here: their text is a part of the block's,
which enters the block's sum as one more child.

Elements that are never main text are left out before, and so are blocks whose class or id names
another part of the page, and forms, whatever their length. Only a name that pages also give to a
wrapper of everything says nothing where the block is one: it holds the page's only article, or
no prose stands outside (``set_aside``).
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import batched, rows_of, table

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*))")
_QUOTED = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_SPACE = re.compile(r"\s+")

#: Names that HTML itself defines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never main text.
NOT_TEXT = frozenset(
    "head script style noscript template nav footer aside button select textarea input iframe object embed "
    "svg math canvas audio video map dialog menu title xmp noembed noframes".split()
)
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar status".split()
)
#: Words in a class or id that name a part which isn't main text: reader comments and consent
#: notices, which never hold the article; parts that hold it only as an <article>; and parts
#: whose names wrappers of a whole page have, too.
NEVER = frozenset(
    "comment comments commentlist disqus respond reply replies discussion cookie cookies consent gdpr".split()
)
PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "breadcrumb breadcrumbs crumbs pager pagination notice notices notification alert newsletter subscribe signup "
    "login search searchbox related recommended recommendations copyright disclaimer skip".split()
)
WRAPPERS = frozenset(
    "banner nav navbar navigation menu menus submenu sidebar side aside rail header masthead topbar footer foot bottom "
    "popup modal overlay form share sharing social widget widgets toolbar legal hidden".split()
)
NOT_TEXT_WORDS = NEVER | PARTS | WRAPPERS
#: Words after which a class tells of the page ("no-sidebar", "page-with-header"), and those
#: which end a class that tells a state ("comments-open").
TOLD_OF = frozenset("no not non without with has".split())
STATES = frozenset("open opened closed enabled disabled on off print".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What closes an open element of the same kind: opening one ends the other.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_KEEP = frozenset({"html", "body", "article", "main"})
#: How little a block's name leaves it: 3 never main text, 2 only with an article, 1 maybe a wrapper.
_GONE, _PART, _WRAPPER, _TEXT = 3, 2, 1, 0
#: Words outside links from which on a block's text is prose, and what is none.
PROSE = 6
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.I)


class Node:
    __slots__ = (
        "name", "parent", "children", "skip", "aside", "paragraph", "in_article", "own",
        "chars", "tags", "link_chars", "link_tags", "density", "total", "best",
    )

    def __init__(self, name: str, parent: Node | None, skip: bool):
        self.name, self.parent, self.skip, self.aside = name, parent, skip, _TEXT
        self.own: int | None = None
        self.children: list[Node | str] = []
        # the open paragraph that a block here would end
        self.paragraph: Node | None = self if name == "p" else None if parent is None or name in BLOCK else parent.paragraph
        self.in_article: bool = name in ("article", "main") or parent is not None and parent.in_article


def _names_other(value: str) -> int:
    """How much a class or id names a part of the page that isn't main text."""
    most = _TEXT
    for one in value.split():
        words = _WORDS.findall(_CAMEL.sub(" ", one).lower())
        if NOT_TEXT_WORDS.isdisjoint(words) or words[-1] in STATES:
            continue
        told = next((k for k, w in enumerate(words) if w in TOLD_OF), len(words))
        # "hidden-xs" is hidden at times
        named = {w for k, w in enumerate(words[:told]) if w != "hidden" or k == len(words) - 1}
        for words_of, level in ((NEVER, _GONE), (PARTS, _PART), (WRAPPERS, _WRAPPER)):
            if not named.isdisjoint(words_of):
                most = max(most, level)
    return most


def _kind(name: str, rest: str, parent: Node) -> tuple[bool, int]:
    """Whether an element is never main text, and how much its name says so."""
    if name in NOT_TEXT or name == "header" and not parent.in_article:
        return True, _TEXT
    other = _WRAPPER if name == "form" else _TEXT
    if "=" not in rest and "hidden" not in rest or name in ("html", "body"):
        return False, other
    keep = name in _KEEP
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id"):
            other = max(other, _names_other(value))
        elif key == "role" and value.lower() == "form":
            other = max(other, _WRAPPER)
        elif keep:
            continue
        elif key == "role" and value.lower() in NOT_TEXT_ROLES:
            return True, _TEXT
        elif key == "aria-hidden" and value.lower() == "true":
            return True, _TEXT
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, _TEXT
    hidden = not keep and re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", _ATTRIBUTE.sub(" ", rest))
    return bool(hidden), other


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Texts and tags in order: kind (text, open or close), then the text, or name and the rest of the tag.

    A tag ends at the first ``>`` outside quotes. Where there is none up to the page's end, its
    ``<`` is text, and from there on quotes don't count: so no part of a page is searched twice
    for the same thing, however broken it is.
    """
    at, text, end, quotes = 0, 0, len(page), True
    while (found := _OPEN.search(page, at)) is not None:
        start = found.start()
        if found["name"]:
            close = _QUOTED.match(page, found.end()).end() if quotes else page.find(">", found.end())
            if not 0 <= close < end or page[close] != ">":
                if not quotes:
                    break
                quotes, at = False, start + 1
                continue
            token, at = ("close" if found["close"] else "open", found["name"].lower(), page[found.end() : close]), close + 1
        else:
            stop = {"<!--": "-->", "<![CDATA[": "]]>"}.get(found[0], ">")
            close = page.find(stop, found.end())
            token, at = None, end if close < 0 else close + len(stop)
        if text < start:
            yield "text", page[text:start], ""
        if token:
            yield token
            if token[0] == "open" and token[1] in RAW:
                close_tag = _RAW_ENDS[token[1]].search(page, at)
                at = close_tag.end() if close_tag else end
        text = at
    if text < end:
        yield "text", page[text:], ""


_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


def parse(page: str) -> Node:
    """The tree of a page. Open elements end where HTML lets them; stray end tags are ignored."""
    root = Node("html", None, False)
    here = root
    body: Node | None = None
    opened: Counter[str] = Counter()  # open elements by name

    def up(to: Node) -> None:
        nonlocal here
        while here is not to:
            opened[here.name] -= 1
            here = here.parent

    for kind, name, rest in _tokens(page):
        if kind == "text":
            here.children.append(name)
            continue
        if kind == "close":
            node: Node | None = here if opened[name] else None
            while node is not None and node.name != name:
                node = None if name not in BLOCK and node.name in BLOCK else node.parent
            if node is not None and node.parent is not None and name not in ("html", "body"):
                up(node.parent)
            elif name == "p":
                here.children.append(Node("p", here, False))
            continue
        if name == "html":
            continue
        if name == "body":
            if body is None:
                here = body = Node("body", root, False)
                opened.clear()
                opened["body"] = 1
                root.children.append(body)
            continue
        if name in BLOCK and here.paragraph is not None:
            up(here.paragraph.parent)
        if name in CLOSES:
            own, within = CLOSES[name]
            node = here if any(opened[n] for n in own) else None
            while node is not None and node.name not in within:
                if node.name in own and node.parent is not None:
                    up(node.parent)
                    if name != "tr":
                        break
                node = node.parent
        if here.name in HEADINGS and name in HEADINGS:
            up(here.parent)
        new = Node(name, here, here.skip)
        if not new.skip:
            new.skip, new.aside = _kind(name, rest, here)
        here.children.append(new)
        if name not in RAW and name not in VOID and not rest.endswith("/"):
            here = new
            opened[name] += 1
    return root


def _body(root: Node) -> Node:
    return next((c for c in root.children if isinstance(c, Node) and c.name == "body"), root)


def _length(text: str) -> int:
    return len(_SPACE.sub(" ", html.unescape(text) if "&" in text else text).strip())


def _own(node: Node) -> int:
    """Characters of a node's text outside its children."""
    if node.own is None:
        node.own = sum(_length(c) for c in node.children if isinstance(c, str))
    return node.own


def _words(text: str) -> int:
    return 0 if _RIGHTS.search(text) else len(text.split())


def set_aside(body: Node) -> None:
    """Blocks whose names say that they are none of the text are skipped.

    Their length is no evidence: a short article can have many comments. One stays only if it wraps
    the text: as long as no article (nor main element) stands outside named blocks, the one with an
    article and most text comes back; where the page has no article, and no prose outside either
    (``PROSE`` words in a block, links and rights left out), the largest of those with a wrapper's
    name does. What is in a block that came back counts as outside, and named blocks in it are
    judged in turn. Reader comments and consent notices never come back, and an article in them is
    none.
    """
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        if not node.skip:
            order.append(node)
            stack += [c for c in node.children if isinstance(c, Node)]
    if not any(node.aside for node in order):
        return
    chars: dict[Node, int] = {}  # of all text within
    words: dict[Node, int] = {}  # of a block's own lines, outside links
    inner: dict[Node, list[Node]] = {}  # the outermost named blocks within
    loose_article: set[Node] = set()  # with an article, or with prose, in no inner named block
    loose_prose: set[Node] = set()
    article: set[Node] = set()  # with an article anywhere within that may come back
    for node in reversed(order):
        below = [c for c in node.children if isinstance(c, Node) and not c.skip]
        named = [c for c in below if c.aside and c.name not in _KEEP]
        plain = [c for c in below if not c.aside or c.name in _KEEP]
        chars[node] = _own(node) + sum(chars[c] for c in below)
        own = 0 if node.name == "a" else sum(_words(c) for c in node.children if isinstance(c, str))
        words[node] = own + sum(words[c] for c in plain if c.name not in BLOCK)
        inner[node] = named + [x for c in plain for x in inner.pop(c)]
        is_article = bool(chars[node]) and (node.name == "main" or node.name == "article" and not node.aside)
        if is_article or any(c in loose_article for c in plain):
            loose_article.add(node)
        if node.name in BLOCK and words[node] >= PROSE or any(c in loose_prose for c in plain):
            loose_prose.add(node)
        if node.aside != _GONE and (node in loose_article or any(x in article for x in inner[node])):
            article.add(node)
    has_article, has_prose = body in loose_article, body in loose_prose
    queue, count = [], 0
    held = [body]
    while held:
        for node in inner[held.pop()]:
            if node.aside == _GONE:
                node.skip = True
            else:
                heapq.heappush(queue, (node not in article, node.aside, -chars[node], count, node))
                count += 1
        if not queue:
            break
        without, level, size, _, node = queue[0]
        back = not has_article if not without else not has_article and not has_prose and level == _WRAPPER and size < 0
        if not back:
            for *_, node in queue:
                node.skip = True
            break
        heapq.heappop(queue)
        held.append(node)
        has_article |= node in loose_article
        has_prose |= node in loose_prose


def weigh(body: Node) -> None:
    """Characters, tags, density and density sum of every node, children first."""
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        if node.skip:
            continue
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        chars, tags, link_chars, link_tags = _own(node), 0, 0, 0
        for c in node.children:
            if not isinstance(c, str) and not c.skip:
                chars += c.chars
                tags += 1 + c.tags
                link_chars += c.chars if c.name == "a" else c.link_chars
                link_tags += (c.name == "a") + c.link_tags
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    all_chars, all_links = body.chars, body.link_chars
    for node in reversed(order):
        node.density = _density(node, all_chars, all_links)
        inner = [c for c in node.children if isinstance(c, Node) and not c.skip]
        parts = [c for c in inner if c.name in BLOCK]
        node.total = sum(c.density for c in parts)
        if own := node.chars - sum(c.chars for c in parts):
            node.total += node.density * own / node.chars
        node.best = max([node, *(c.best for c in inner if c.chars and c.name in BLOCK)], key=lambda n: n.total)


def _density(node: Node, all_chars: int, all_links: int) -> float:
    if not node.chars:
        return 0.0
    tags = max(node.tags, 1)
    if node.name == "a" or node.link_chars >= node.chars:
        return 0.0
    chars, links, link_tags = node.chars, max(node.link_chars, 1), max(node.link_tags, 1)
    plain = chars - node.link_chars
    base = math.log(chars / plain * node.link_chars + all_links / max(all_chars, 1) * chars + math.e)
    return chars / tags * math.log(max(chars / links * tags / link_tags, math.e), max(base, 1.1))


def main_nodes(body: Node, slack: float = 0.25) -> set[int]:
    """Identities of the marked nodes. ``slack``: the share of the threshold that a node must reach."""
    weigh(body)
    if not body.chars:
        return set()
    node = body.best
    threshold = node.density
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    threshold *= slack
    marked, stack = [], [body]
    while stack:
        node = stack.pop()
        if node.skip or not node.chars or node.density < threshold:
            continue
        marked.append(node.best if node.best.total else node)
        stack += [c for c in node.children if isinstance(c, Node) and c.name in BLOCK]
    return {id(n) for n in marked} | {id(n) for n in _articles(marked)}


def _articles(nodes: list[Node]) -> list[Node]:
    """The outermost article elements that hold the nodes: all of an article is its text."""
    above: dict[Node, Node | None] = {}
    for node in nodes:
        path = []
        at: Node | None = node
        while at is not None and at not in above:
            path.append(at)
            at = at.parent
        found = above[at] if at is not None else None
        for one in reversed(path):
            found = found or (one if one.name == "article" and not one.aside else None)
            above[one] = found
    return list({id(a): a for a in (above[n] for n in nodes) if a}.values())


def blocks(body: Node, marked: set[int]) -> list[str]:
    """Texts of blocks inside marked nodes, in page order."""
    found: list[str] = []
    held: list[str] = []

    def flush():
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            held.clear()
            if text:
                found.append(text)

    stack: list[tuple[Node | str | None, bool, bool]] = [(body, False, False)]
    whole = id(body) in marked
    while stack:
        item, inside, article = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if inside:
                held.append(html.unescape(item) if "&" in item else item)
        elif item.name == "br":
            if inside:
                held.append(" ")
        elif not item.skip and not (_menu(item) and (whole or not found) and not article):
            inside = inside or id(item) in marked
            article = article or item.name == "article" and inside
            if item.name in BLOCK:
                flush()
                stack.append((None, inside, article))
            stack += [(c, inside, article) for c in reversed(item.children)]
    flush()
    return found


def _menu(node: Node) -> bool:
    """A block of three links or more and next to no other text. It is one of the page's menus where
    the page as a whole is marked, or where it stands before all text; elsewhere it is the article's."""
    return node.name in BLOCK and node.link_tags >= 3 and node.link_chars >= 0.9 * node.chars


def extract(page: str) -> list[str]:
    body = _body(parse(page))
    set_aside(body)
    return blocks(body, main_nodes(body))


def main_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``doc`` and ``text``: the main text of each page, its blocks joined by newlines.

    A null or empty page, and one without text outside menus and the like, has an empty text.
    Rows are independent: repeated rows and null ids pass through. A page of any length is
    read whole; the tree is walked without recursion. Other columns are not read.
    """

    def make():
        def each(batch):
            for rows in rows_of(batch):
                yield {
                    "doc": rows["doc"],
                    "text": ["\n".join(extract(page or "")) for page in rows["text"].to_pylist()],
                }

        return each

    source = df.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{html_col}`").alias("text"))
    return batched(source, f"doc {source.schema['doc'].dataType.simpleString()}, text string", make)


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    ids = "named_struct('page_id', page_id, 'url', url)"
    text = main_text(pages.select(F.expr(ids).alias("page"), "html"), "page")
    return text.select("doc.page_id", "doc.url", "text", F.char_length("text").cast("long").alias("n_chars"))
