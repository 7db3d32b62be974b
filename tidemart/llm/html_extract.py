"""Main text of web pages by a minimum cut over their text blocks.

A page is read once into blocks: the text between two block-level tags, with
the elements around it. A fixed linear classifier gives each block the log odds
of being article text from what its elements are (tags, roles, class and id
words), its length and its share of link text. The two sides of these odds are
the capacities of the block's edges to the terminals "article" and "rest".
Neighbouring blocks are joined by smoothness edges, stronger the closer they
stand in the element tree, and all blocks directly below one element are joined
through a node of that element. A maximum flow (Dinic) cuts the cheapest set of
edges; the blocks on the article's side are the text. Evidence of an element's
role is heavier than all smoothness edges of a block together, so smoothing
settles unmarked blocks and never carries an advert into the article.

Names in class, id and role are weaker than tags. An element whose names speak
of comments, menus, adverts... or a form is a region. Where the page has text
outside all regions that reads like an article, each block of a region counts
as rest, however long it is (a form's only if that text is not short beside it).
Where it has none, length may speak: the region is then a node of its own that
costs ``MARK`` once if it is on the article's side, and its blocks, which have
only their own odds, can be there only with it. Regions of unsure names, which
parts of articles have too, are always such nodes. Names of an article on the
same element outweigh those names, and the tags article and main are tested
before any name.

One page is one row and one flow; no shuffle. The graph has a constant number
of edges per block.

Defined cases: null or empty html gives an empty text and 0 blocks; text
outside any tag is a block; unclosed and stray tags are tolerated; null ids,
null urls and repeated rows pass through; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.common import map_texts

# HTML element kinds.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg",
       "select", "button"}
SILENT = {"script", "style", "noscript", "template"}  # leave no gap in the text around them
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "picture", "source", "map", "area", "object", "canvas",
          "audio", "video", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msup", "msub",
          "msubsup", "munder", "mover", "munderover", "mstyle", "mpadded", "mtable", "mtr", "mtd", "semantics",
          "annotation"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
            "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
            "th": {"tr", "table"}, "option": {"select"}}
PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "td", "th", "dd", "dt", "figcaption"}
# Words of class, id and role that tell what an element is.
REST_WORDS = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|sidebar\w*|side|aside|"
    r"footer\w*|header\w*|masthead|topbar|breadcrumb\w*|pagination|pager|cookies?|consent|gdpr|notices?|notification\w*|"
    r"alert\w*|popup|modal|dialog|overlay|newsletter|subscri\w*|signup|login|signin|register|search\w*|share|sharing|"
    r"social|related|recommend\w*|widget\w*|toolbar|copyright|legal|disclaimer|contentinfo|complementary|form|skip|"
    r"tags?|trending|outbrain|taboola|paywall)\Z")
COMMENT_WORDS = re.compile(r"(?:comments?|commentlist|commentary|disqus|repl(?:y|ies)|discussion|respond|responses?|reviews?)\Z")
MAIN_WORDS = re.compile(r"(?:article\w*|main|content|contents|post|posts|entry|story|body|text|prose|maincontent|hentry)\Z")
UNSURE_WORDS = {"discussion", "response", "responses", "review", "reviews", "legal", "notice", "notices", "tag", "tags",
                "form", "search", "register", "side", "header", "copyright"}  # also names of parts of articles
WITHOUT = {"has", "no", "with", "without"}  # a name that begins so tells of something else
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)?(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
READ = {"class", "id", "role", "style", "hidden", "aria-hidden"}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

MARK = 6.0  # an element's role, in log odds
NEAR = 1.0  # smoothness of blocks below one element
OUTSIDE = 2.5  # against text outside the article's element, where the page has one
AROUND = 0.25  # of a block and the node of its element
UNSURE = 4.0  # of an element with names that parts of articles have, too (MARK with others)
NEVER = 1e9  # no cut goes through: a block on the article's side takes its element along
LONG_WORDS = 8  # of a block that reads like a paragraph
FORM_SHARE = 0.2  # of a form's words that text around it has at least when the form is not the article's
HINT = 1.0  # names of an article below an element whose names speak against it

OUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType()),
                    T.StructField("n_main", T.LongType())])


def extract_main_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html",
                      keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """id, kept columns, text (main text, "" if none), n_blocks, n_main: one row per input row."""
    return map_texts(df, [id_col, *keep], html_col, extract_batch, OUT)


def extract_batch(pages: list[bytes]) -> dict:
    made = [extract(p.decode("utf-8", "replace")) for p in pages]
    return {c: [m[i] for m in made] for i, c in enumerate(("text", "n_blocks", "n_main"))}


def extract(page: str) -> tuple[str, int, int]:
    blocks = read_blocks(page)
    main = cut(blocks)
    return " ".join(b.text for b, m in zip(blocks, main) if m), len(blocks), sum(main)


class Region:
    """An element whose names speak against it: what it costs once, the region around it, whether in marked text."""

    __slots__ = ("cost", "parent", "inside", "comment", "form", "words")

    def __init__(self, cost: float, parent: "Region | None", inside: bool, comment: bool, form: bool):
        self.cost, self.parent, self.inside, self.comment, self.form = cost, parent, inside, comment, form
        self.words = 0


class Element:
    """An open element: the one around it, and what it and those around it say about the text inside."""

    __slots__ = ("tag", "up", "depth", "odds", "closed", "article", "link", "region")

    def __init__(self, tag: str, parent: "Element | None", attributes: tuple = ()):
        self.tag, self.up, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.odds = parent.odds if parent else 0.0
        self.closed = parent.closed if parent else False  # inside a menu, footer...: nothing reopens it
        self.article = parent.article if parent else ""  # the tag, article or main, around it
        self.link = (parent.link if parent else False) or tag == "a"
        self.region = parent.region if parent else None
        if parent is None or tag in INLINE and not attributes:
            return
        main, against, hidden = False, [], False
        if attributes and tag not in ("html", "body"):
            for name, value in attributes:
                if name in ("class", "id", "role"):
                    for token in value.split():
                        words = [w.lower() for w in WORDS.findall(token)]
                        if not words or words[0] in WITHOUT:
                            continue
                        comment = [w for w in words if COMMENT_WORDS.match(w)]
                        rest = [w for w in words if REST_WORDS.match(w)]
                        own = any(MAIN_WORDS.match(w) for w in words)
                        if comment or rest and not (own and self.article and UNSURE_WORDS.issuperset(rest)):
                            against += comment + rest
                        elif own:
                            main = True
                elif name == "style":
                    hidden |= bool(HIDDEN.search(value))
                else:
                    hidden |= name == "hidden" or value.lower() == "true"
        comment = any(COMMENT_WORDS.match(w) for w in against)
        if tag in ("nav", "aside", "footer", "menu", "dialog") or hidden:
            self.closed = True
        elif tag == "header" and not self.article:
            self.closed = True
        elif tag in ("article", "main") and not (self.region and self.region.comment) and not (
                against and not main and self.article == "article"):
            self.odds, self.article, self.region = MARK, tag if self.article != "article" else "article", None
        elif tag == "form" or against and not main:
            cost = UNSURE if against and UNSURE_WORDS.issuperset(against) else MARK
            comment |= bool(self.region and self.region.comment)
            self.region = Region(cost, self.region, self.article or self.odds > 0, comment, not against)
            self.odds = 0.0
        elif main and self.region:
            self.odds = HINT
        elif main:
            self.odds = max(self.odds, MARK / 2)


class Block:
    __slots__ = ("text", "place", "odds", "article", "region")

    def __init__(self, text: str, place: Element, odds: float, article: bool, region: Region | None = None):
        self.text, self.place, self.odds, self.article, self.region = text, place, odds, article, region


def read_blocks(page: str) -> list[Block]:
    """Blocks in page order with the elements they stand in and their log odds of being article text."""
    root = Element("", None)
    stack, blocks = [root], []
    parts: list[str] = []
    linked = 0
    marked = [False]
    owner: Element = root
    place: Element = root

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, place, log_odds(owner, text, linked), bool(owner.article) and not owner.closed,
                                    None if owner.closed else owner.region))
                marked[0] |= owner.odds > 0 and not owner.closed and owner.region is None
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, owner, place
        if not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        if not parts:
            if not text.strip():
                return
            k = len(stack) - 1
            while (k and stack[k].tag in INLINE and stack[k].odds == stack[k - 1].odds
                   and stack[k].region is stack[k - 1].region):
                k -= 1
            owner = stack[k]
            place = owner.up if owner.tag in PARAGRAPHS else owner
        parts.append(text)
        if stack[-1].link:
            linked += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = TAG.match(page, lt)
        if tag is None:
            add("<")
            at = lt + 1
            continue
        end, attributes = scan_tag(page, tag.end())
        at, name = end + 1, tag.group(2).lower()
        if tag.group(1):
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k].tag not in INLINE:
                    break  # a stray inline end does not close blocks
            continue
        if name == "br":
            add(" ") if parts else None
            continue
        if name in RAW:
            if name not in SILENT:
                flush()
            if page[end - 1] != "/" or name != "svg":
                close = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                at = n if close is None else scan_tag(page, close.end() - 1)[0] + 1
            continue
        if name not in INLINE:
            flush()
            if name in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if stack[k].tag not in INLINE:
                        break
            if name in SIBLINGS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == name or {stack[k].tag, name} <= {"dt", "dd"} or {stack[k].tag, name} <= {"td", "th"}:
                        del stack[k:]
                        break
                    if stack[k].tag in SIBLINGS[name]:
                        break
        if name not in VOID:
            stack.append(Element(name, stack[-1], attributes))
    flush()
    if any(b.article for b in blocks):  # then text that no element marks is rather not of it
        for b in blocks:
            if not b.article:
                b.odds -= OUTSIDE
    elif marked[0]:  # nor is text whose names speak against it, outside marked text
        for b in blocks:
            if b.region and not b.region.inside:
                b.odds -= OUTSIDE
    close_regions(blocks)
    return blocks


def close_regions(blocks: list[Block]) -> None:
    """Blocks of regions count as rest where the page has an article's text outside of them."""
    outside = sum(n for b in blocks if b.region is None and b.odds > 0 and (n := b.text.count(" ") + 1) >= LONG_WORDS)
    if not outside:
        return
    for b in blocks:
        region = b.region
        while region:
            region.words += b.text.count(" ") + 1
            region = region.parent
    for b in blocks:
        region = b.region
        while region:
            if region.cost == MARK and not (region.form and FORM_SHARE * region.words > outside):
                b.odds, b.region = -MARK, None
                break
            region = region.parent


def scan_tag(page: str, at: int) -> tuple[int, list[tuple[str, str]]]:
    """Place of the '>' that closes a tag (the page's end if there is none) and the attributes that are read.

    Names, '=' and values as in the HTML standard; a quote that is never closed is part of an unquoted value.
    """
    found: list[tuple[str, str]] = []
    if page.startswith(">", at):
        return at, found
    while True:
        m = ATTRIBUTE.match(page, at)
        name, at = m.group(1), m.end()
        if not name:
            return at, found
        value = ""
        if m.group(2):
            quote = page[at:at + 1]
            close = page.find(quote, at + 1) if quote in ("'", '"') else -1
            if close < 0:
                stop = UNQUOTED.match(page, at).end()
                value, at = page[at:stop], stop
            else:
                value, at = page[at + 1:close], close + 1
        name = name.lower()
        if name in READ:
            found.append((name, value))


def log_odds(element: Element, text: str, linked: int) -> float:
    """Positive: article text. Roles first, then length, link share and a leading copyright sign."""
    if element.closed:
        return -MARK
    words = text.count(" ") + 1
    own = min(2.0, 0.4 * words ** 0.5) - 0.3 - 3.0 * min(1.0, linked / len(text))
    if element.tag in ("h1", "h2", "h3"):
        own += 0.6
    if text[0] in "©®" or text.lower().startswith(("copyright", "all rights reserved")):
        own -= 0.0 if element.article else 2.0
    if element.odds == MARK:
        return MARK + max(own, -1.0)
    return element.odds + own


def cut(blocks: list[Block]) -> list[bool]:
    """True for the blocks on the article's side of the minimum cut."""
    n = len(blocks)
    regions: dict[int, tuple[int, Region]] = {}
    if all(b.odds > 0 and not b.region for b in blocks) or all(b.odds <= 0 for b in blocks):
        return [b.odds > 0 for b in blocks]
    members: dict[int, list[int]] = {}
    edges: list[tuple[int, int, float]] = []
    for i, b in enumerate(blocks):
        members.setdefault(id(b.place), []).append(i)
        if i:
            edges.append((i - 1, i, NEAR / (1 + tree_distance(blocks[i - 1].place, b.place))))
    node = n
    for group in members.values():
        if len(group) > 2:
            edges += [(node, i, AROUND) for i in group]
            node += 1
    for b in blocks:
        region = b.region
        while region and id(region) not in regions:
            regions[id(region)] = node, region
            node, region = node + 1, region.parent
    flow = Flow(node + 2)
    source, sink = node, node + 1
    for i, b in enumerate(blocks):
        if b.odds > 0:
            flow.edge(source, i, b.odds, 0.0)
        elif b.odds < 0:
            flow.edge(i, sink, -b.odds, 0.0)
        if b.region:
            flow.edge(i, regions[id(b.region)][0], NEVER, 0.0)
    for k, region in regions.values():
        flow.edge(k, sink, region.cost, 0.0)
        if region.parent:
            flow.edge(k, regions[id(region.parent)][0], NEVER, 0.0)
    for a, b, w in edges:
        flow.edge(a, b, w, w)
    side = flow.source_side(source, sink)
    return [side[i] for i in range(n)]


def tree_distance(a: Element, b: Element) -> int:
    """Steps from one element to another."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


class Flow:
    """Maximum flow by Dinic's levels and blocking paths."""

    def __init__(self, n: int):
        self.to: list[int] = []
        self.left: list[float] = []
        self.out: list[list[int]] = [[] for _ in range(n)]

    def edge(self, a: int, b: int, forward: float, back: float) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.left.append(forward)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.left.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.left[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            nxt = [0] * len(self.out)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    push = min(self.left[e] for e in path)
                    for k, e in enumerate(path):
                        self.left[e] -= push
                        self.left[e ^ 1] += push
                    k = next(k for k, e in enumerate(path) if self.left[e] <= 1e-9)
                    a = self.to[path[k] ^ 1]
                    del path[k:]
                    continue
                while nxt[a] < len(self.out[a]):
                    e = self.out[a][nxt[a]]
                    if self.left[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    nxt[a] += 1
                if nxt[a] < len(self.out[a]):
                    e = self.out[a][nxt[a]]
                    path.append(e)
                    a = self.to[e]
                elif path:
                    e = path.pop()
                    a = self.to[e ^ 1]
                    nxt[a] += 1
                else:
                    break
