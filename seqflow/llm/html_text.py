"""Main text of HTML pages by composite text density.

For every DOM node: characters per tag, adjusted by the share of link characters and link tags (composite
text density), and the sum of its children's densities. Elements that are boilerplate by tag or role are pruned
first; a class or id prunes only what holds a lesser share of the page's prose, and a form the same way. The
node with the largest sum marks the content; the smallest density on its path to the body is the threshold, and
further subtrees that reach it are content as well. Where the `article` and `main` elements hold a fair share of
the prose under the marked node, the choice is made inside these and widened to the one that holds the best.

Scale: a page is handled by itself, in one pass; nothing is shuffled.

Defined cases: null or empty html gives an empty text; unclosed, stray and crossed tags are read as browsers
do in the common cases (a block start ends an open paragraph, a stray end tag is ignored, an unclosed script
runs to the end); white space, no-break spaces included, becomes one space; null ids and URLs are passed
on; repeated rows give repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img""".split())
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hr main menu nav ol p pre section table ul""".split())
#: an open element of the second kind ends when the first starts, unless one of the third is in between
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
           "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
           "option": (("option",), ("select",))}
DROP_TAGS = frozenset("""script style noscript template iframe svg canvas object embed audio video head title textarea button select
nav footer aside dialog menu noembed noframes xmp""".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
DROP_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner
banners sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice
notices newsletter subscribe subscription signup comment comments commentlist respond reply replies disqus related recommended
recommendations share sharing social widget widgets popup modal overlay login search toolbar pagination pager copyright disclaimer
skip""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: words that may follow the one that says what an element is: `comment-list`, `sidebar-left`, `ad-slot`
CARRIERS = frozenset("""area articles bar block body bottom box btn button buttons card cell col column container content digits
element feed footer group head header heading holder icon icons inner input item items label left line link links list main message
module outer panel posts region right row section sections slot space stories tab text thread title top unit wrap wrapper
zone""".split())
#: words before it that make the name one of a layout: `has-sidebar`
MODIFIERS = frozenset("has have is no not with without hide hidden show".split())
#: shares of the page's prose above which a name doesn't prune; the second for forms, and where an article or heading is elsewhere
LESSER, MOST = 0.5, 0.9
#: share of the prose under the marked node from which `article` and `main` elements are trusted
FAIR = 0.25


class _Page:
    """The DOM of a page: nodes in page order, so that the subtree of a node is a range."""

    def __init__(self, source: str):
        self.tag, self.parent, self.last, self.drop, self.attrs = ["#root"], [-1], [0], [False], [""]
        self.items: list[tuple[int, str | None]] = []  # (node, text, or None where a block starts or ends)
        self.places: dict[str, list[int]] = {}  # tag: where it is on the stack of open elements
        self._read(source)

    def _open(self, stack: list[int], tag: str, attrs: str) -> int:
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.last.append(n)
        self.attrs.append(attrs)
        return n

    def _close(self, stack: list[int], depth: int) -> None:
        """Ends the open elements from `depth` on."""
        while len(stack) > depth:
            n = stack.pop()
            self.places[self.tag[n]].pop()
            self.last[n] = len(self.tag) - 1
            if self.tag[n] not in INLINE:
                self.items.append((n, None))

    def _find(self, stack: list[int], tags, until=()) -> int:
        """Place of the innermost open element of `tags` with none of `until` inside it; 0: none."""
        innermost = lambda names: max((self.places[t][-1] for t in names if self.places.get(t)), default=0)
        d = innermost(tags)
        return d if d > innermost(until) else 0

    def _read(self, source: str) -> None:
        stack, at, end = [0], 0, len(source)
        items, tags = self.items, self.tag
        has_body = False
        while at < end:
            m = TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                items.append((stack[-1], source[at:stop]))
            if not m:
                break
            at = m.end()
            name = m.group(2) or m.group(5)
            if name is None:
                continue
            name, closing = name.lower(), bool(m.group(1) or m.group(4))
            if closing:
                if name == "br" or name in VOID:
                    items.append((stack[-1], " "))
                    continue
                d = self._find(stack, (name,), () if name not in INLINE else ENDS_P)
                if d:
                    self._close(stack, d)
                continue
            if name in ENDS_P and self.places.get("p"):
                d = self._find(stack, ("p",), ("button", "td", "th", "article", "section", "div"))
                if d:
                    self._close(stack, d)
            if name in IMPLIED:
                d = self._find(stack, *IMPLIED[name])
                if d:
                    lowest = d
                    while name == "tr" and lowest > 1 and tags[stack[lowest - 1]] in ("tr", "td", "th"):
                        lowest -= 1
                    self._close(stack, lowest)
            attrs = m.group(3) if m.group(2) else m.group(6)
            if name == "body":
                if has_body:
                    continue
                has_body = True
            if name in VOID:
                items.append((stack[-1], " " if name in ("br", "hr") else ""))
                continue
            n = self._open(stack, name, attrs)
            if name not in INLINE:
                items.append((n, None))
            if name in RAW:
                e = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = e.end() if e else end
                if name not in INLINE:
                    items.append((n, None))
                continue
            if attrs.endswith("/") and name in ("svg", "path", "use"):
                continue
            self.places.setdefault(name, []).append(len(stack))
            stack.append(n)
        self._close(stack, 1)
        self.last[0] = len(tags) - 1


def _role_words(name: str) -> str | None:
    """The word of DROP_WORDS that says what an element of this class or id is, if there is one."""
    words = [w for w in SPLIT.split(CAMEL.sub(" ", name).lower()) if w]
    if not words or words[0] in MODIFIERS:
        return None
    while len(words) > 1 and words[-1] not in DROP_WORDS and (words[-1] in CARRIERS or words[-1][0].isdigit()):
        words.pop()
    return words[-1] if words[-1] in DROP_WORDS else None


def _named(attrs: str) -> tuple[bool, bool, bool]:
    """(hidden or of a boilerplate role, boilerplate by class or id, comments by class or id) by the attributes of a tag."""
    sure, found = False, set()
    for k, *v in ATTR.findall(attrs):
        k, v = k.lower(), "".join(v)
        if k in ("class", "id"):
            found.update(w for name in v.split() if (w := _role_words(name)))
        elif k == "role":
            sure |= v.strip().lower() in DROP_ROLES
        elif k == "hidden" or k == "aria-hidden" and v.lower() == "true":
            sure = True
        elif k == "style":
            sure |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v, re.I))
    return sure, bool(found), not COMMENT_WORDS.isdisjoint(found)


def _prose(p: _Page, dead: list[bool]) -> list[int]:
    """Characters outside links in every subtree, without those of dead nodes."""
    n = len(p.tag)
    prose, linked = [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = linked[p.parent[i]] or p.tag[i] == "a"
    for i, t in p.items:
        if t and not dead[i] and not linked[i]:
            prose[i] += len(t.strip())
    for i in range(n - 1, 0, -1):
        prose[p.parent[i]] += prose[i]
    return prose


def _pruned(p: _Page) -> list[bool]:
    """Which nodes are boilerplate or inside it.

    Tags, roles and hidden elements are. A class, an id or a form only suggests it: it doesn't prune what holds the
    article or the heading, nor what holds more of the page's prose than LESSER (MOST for forms, and where the article
    or its heading is elsewhere; all of it for comments).
    """
    n = len(p.tag)
    sure, named, comments, holds, has_article = [False] * n, [False] * n, [False] * n, [False] * n, [False] * n
    in_article = [False] * n
    for i in range(1, n):
        in_article[i] = in_article[p.parent[i]] or p.tag[i] in ("article", "main")
    for i in range(n - 1, 0, -1):
        t = p.tag[i]
        has_article[p.parent[i]] |= has_article[i] or t == "article"
        by_role, named[i], comments[i] = _named(p.attrs[i]) if p.attrs[i].strip() else (False, False, False)
        if t in ("html", "body"):
            by_role = named[i] = False
        if t == "header":  # stays if it has the heading of the article it is in, or the article itself
            by_role |= not (holds[i] and (in_article[i] or has_article[i]))
        sure[i] = by_role or t in DROP_TAGS
        if not sure[i] and not (named[i] and t == "article") and (holds[i] or t in ("article", "main", "h1")):
            holds[p.parent[i]] = True
    for i in range(1, n):
        sure[i] = sure[i] or sure[p.parent[i]]
    prose, dead = _prose(p, sure), sure
    anchored = holds[0]  # an article or heading somewhere; not in the nodes asked below unless they are articles themselves
    for i in range(1, n):
        if dead[p.parent[i]]:
            dead[i] = True
        elif not dead[i] and (named[i] or p.tag[i] == "form") and (p.tag[i] == "article" or not holds[i]):
            most = MOST if anchored or p.tag[i] == "form" else LESSER
            dead[i] = prose[i] < prose[0] if comments[i] else prose[i] <= most * prose[0]
    return dead


def densities(p: _Page, dead: list[bool], texts: list[tuple[int, str]], body: int) -> tuple[list[float], list[float]]:
    """Composite text density of every node, and the sum of its children's (its own where it has none).

    characters / tags * log(characters / link characters * tags / link tags), the logarithm to a base that
    grows with the node's links against the page's; bases below e count as e.
    """
    n = len(p.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[p.parent[i]] or p.tag[i] == "a"
    for i, t in texts:
        chars[i] += len(t)
        if linked[i]:
            links[i] += len(t)
    for i in range(n - 1, 0, -1):
        if not dead[i]:
            q = p.parent[i]
            chars[q] += chars[i]
            links[q] += links[i]
            tags[q] += tags[i] + 1
            link_tags[q] += link_tags[i] + (p.tag[i] == "a")
    share = links[body] / max(chars[body], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        c = chars[i]
        if dead[i] or not c:
            continue
        t, lc, lt, rest = max(tags[i], 1), max(links[i], 1), max(link_tags[i], 1), max(c - links[i], 1)
        base = math.log(c / rest * links[i] + share * c + math.e)
        density[i] = c / t * max(math.log(c / lc * t / lt), 1e-6) / math.log(max(base, math.e))
    leaf = [True] * n
    for i in range(1, n):
        if not dead[i] and density[i]:
            sums[p.parent[i]] += density[i]
            leaf[p.parent[i]] = False
    return density, [density[i] if leaf[i] else sums[i] for i in range(n)]


def _content(p: _Page, density: list[float], sums: list[float], dead: list[bool], body: int) -> list[int]:
    """Roots of the subtrees that are content, in page order."""
    nodes = range(body, p.last[body] + 1)
    best = max(nodes, key=lambda i: (sums[i], -i), default=body)
    if not density[best]:
        return []
    articles = [i for i in nodes if p.tag[i] in ("article", "main") and not dead[i] and density[i]]
    if articles:
        prose, outer, end = _prose(p, dead), [], -1
        for i in articles:
            if i > end:
                outer.append(i)
                end = p.last[i]
        if any(i <= best <= p.last[i] for i in outer) or sum(prose[i] for i in outer if best <= i <= p.last[best]) >= FAIR * prose[best]:
            best = max((j for i in outer for j in range(i, p.last[i] + 1)), key=lambda i: (sums[i], -i))
            inner = [i for i in articles if i <= best <= p.last[i]]
            return [next((i for i in reversed(inner) if p.tag[i] == "article"), inner[0])]
    path, i = [], best
    while i >= body:
        path.append(i)
        i = p.parent[i]
    threshold = min(density[i] for i in path)
    roots, i = [], body
    on_path = set(path)
    while i <= p.last[body]:  # down the path to the marked node; beside it, whole subtrees that reach the threshold
        if i == best or i not in on_path and not dead[i] and density[i] >= threshold:
            roots.append(i)
            i = p.last[i] + 1
        elif i in on_path:
            i += 1
        else:
            i = p.last[i] + 1
    return roots


def extract(source: str | None) -> str:
    """The main text of a page."""
    if not source:
        return ""
    p = _Page(source)
    dead = _pruned(p)
    body = p.tag.index("body") if "body" in p.tag else 0
    texts = [(n, s) for n, t in p.items if t and not dead[n] and (s := t.strip())]
    density, sums = densities(p, dead, texts, body)
    roots = _content(p, density, sums, dead, body)
    kept = [False] * len(p.tag)
    for r in roots:
        kept[r:p.last[r] + 1] = [True] * (p.last[r] + 1 - r)
    blocks, now = [], []
    for n, t in p.items:
        if t is None:
            if now:
                blocks.append("".join(now))
                now = []
        elif t and kept[n] and not dead[n]:
            now.append(html_lib.unescape(t) if "&" in t else t)
    if now:
        blocks.append("".join(now))
    return " ".join(" ".join(blocks).split())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
