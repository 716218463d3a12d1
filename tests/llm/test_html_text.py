import random
import re

import pytest

from seqflow.llm.html_text import extract, extract_text

from .data import prose

HEAD = '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>";</script></head><body>'
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
FOOT = '<footer>&copy; site &middot; imprint text of the site</footer></body></html>'


@pytest.mark.parametrize("before, after", [
    ("", ""),
    ('<div class="ad">Buy this now, it is a good thing to buy for all.</div>', '<aside>Side text, quite long, beside the page.</aside>'),
    ('<header><h1>Site name</h1><p>Slogan of the site here</p></header>', '<section id="comments"><article class="comment"><p>Great article, thank you for it, I liked it.</p></article></section>'),
    ('<div class="cookie-notice">We use cookies on this site, please accept all of them.</div>', '<form><p>Subscribe to this</p><input></form>'),
    ('<div role="banner">Banner text</div><!-- <p>not this</p> -->', '<div id="sidebar"><p>Related things to read on this site, many.</p></div>'),
])
@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main><div>", "</div></main>"), ('<div class="post has-sidebar"><div>', "</div></div>")])
def test_article_without_boilerplate(before, after, wrap):
    rng = random.Random(1)
    paras = [prose(rng, 40) for _ in range(4)]
    body = f"<h1>{paras[0]}</h1><p>{paras[1]} &amp;&nbsp;<b>bo<i>ld</i></b>\n  x &#233;<p>{paras[2]}<br>{paras[3]}<ul><li>one<li>two</ul>"
    exp = f"{paras[0]} {paras[1]} & bold x é {paras[2]} {paras[3]} one two"
    assert extract(HEAD + NAV + before + wrap[0] + body + wrap[1] + after + FOOT) == exp


def test_broken_and_empty_pages():
    assert [extract(x) for x in (None, "", "   ", "<html>", "<script>x", "<!-- a", "<p")] == ["", "", "", "", "", "", "<p"]
    assert extract("plain text &lt;b&gt;") == "plain text <b>"
    assert extract("<p>a<p>b</div></p>c") == "a b c"
    assert extract("<table><tr><td>a<td>b<tr><td>c</table>") == "a b c"
    deep = "<div>" * 3000 + "deep text" + "</div>" * 10
    assert extract(deep) == "deep text"
    assert extract("<article><p>" + "long words " * 30_000 + "</p></article>") == ("long words " * 30_000).strip()
    assert extract('<article><p title="a > b">x</p><p class=">y</p></article>').startswith("x")


def test_many_dense_parts_without_article():
    rng = random.Random(2)
    paras = [prose(rng, 50) for _ in range(5)]
    page = HEAD + NAV + "".join(f'<div class="entry"><p>{p}</p></div>' for p in paras) + FOOT
    assert extract(page) == " ".join(paras)


def test_rows(spark):
    rows = [(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, None), (2, None, "<p>ü\U0001f600</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, None, "ü\U0001f600", 2)], key=repr)
    assert extract_text(df.limit(0)).count() == 0


def test_matches_the_article_element_of_the_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        a = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h\d|br|div|li|ul)\b[^>]*>", " ", a))
        assert texts[r["page_id"]] == " ".join(html.unescape(a).split())


TEXT = "Some long prose text of the article is here, with a fair number of words in it. " * 4


@pytest.mark.parametrize("open_, close", [
    ('<div class="content has-sidebar">', "</div>"), ('<div id="page" class="menu-open">', "</div>"), ('<form id="aspnetForm"><div>', "</div></form>"),
    ('<h1>Title</h1><div class="wrapper sidebar">', "</div>"), ('<article><h1>Title</h1><p class="notice-board">', "</article>"),
])
def test_names_of_wrappers_do_not_drop_the_article(open_, close):
    page = f"{HEAD}{NAV}{open_}<p>{TEXT}</p><p>{TEXT}</p>{close}{FOOT}"
    title = "Title " if "<article>" in open_ else ""  # a heading beside the content is below the threshold
    assert extract(page) == title + " ".join([TEXT.strip()] * 2)


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "ad-slot-300x250", "cookieNotice", "comment-list", "related-posts", "share_buttons", "page__sidebar--left"])
def test_names_of_boilerplate_drop_it(name):
    page = f'{HEAD}<div class="text"><p>{TEXT}</p><p>{TEXT}</p></div><div class="{name}"><p>{TEXT}</p></div>{FOOT}'
    assert extract(page) == " ".join([TEXT.strip()] * 2)


def test_many_comments_under_a_short_article():
    assert extract(f'<article><h1>T</h1><p>{TEXT}</p></article><section id="comments"><p>{TEXT * 40}</p></section>') == "T " + TEXT.strip()


def test_teaser_article_beside_the_content():
    page = f"<div><div>{''.join(f'<p>{TEXT}</p>' for _ in range(9))}</div><article><p>A short teaser.</p></article></div>"
    assert extract(page).startswith(" ".join([TEXT.strip()] * 9))


@pytest.mark.parametrize("page", ["<div>" * 8000 + "x", "<article>" * 4000 + "x", "<table><tr><td>" * 3000 + "x", "<header>" * 4000 + "<article>x</article>", "<body>" * 8000 + "x"])
def test_deep_pages_take_linear_time(page):
    import time

    start = time.process_time()
    assert extract(page) == "x"
    assert time.process_time() - start < 2


def test_densities_against_the_definition():
    import math

    from seqflow.llm.html_text import _Page, densities

    rng = random.Random(8)

    def tree(depth):
        """(tag, children: trees or texts)"""
        kids = [tree(depth - 1) if depth and rng.random() < 0.6 else "w" * rng.randint(1, 40) for _ in range(rng.randint(1, 4))]
        return rng.choice(["div", "section", "a", "b"]), kids

    def write(t):
        return t if isinstance(t, str) else f"<{t[0]}>{''.join(map(write, t[1]))}</{t[0]}>"

    def counts(t, linked):
        """characters, link characters, tags below, link tags below"""
        if isinstance(t, str):
            return len(t), len(t) * linked, 0, 0
        parts = [counts(k, linked or t[0] == "a") for k in t[1]]
        inner = [k for k in t[1] if not isinstance(k, str)]
        c, lc, n, ln = (sum(x) for x in zip(*parts))
        return c, lc, n + len(inner), ln + sum(k[0] == "a" for k in inner)

    def walk(t, linked, share):
        c, lc, n, ln = counts(t, linked)
        n, rest = max(n, 1), max(c - lc, 1)
        base = math.log(c / rest * lc + share * c + math.e)
        own = c / n * max(math.log(c / max(lc, 1) * n / max(ln, 1)), 1e-6) / math.log(max(base, math.e))
        below = [walk(k, linked or t[0] == "a", share) for k in t[1] if not isinstance(k, str)]
        return [(own, sum(b[0][0] for b in below) if below else own)] + [x for b in below for x in b]

    for _ in range(30):
        body = ("body", [("div", [tree(4) for _ in range(3)])])
        c, lc, *_ = counts(body, False)
        exp = walk(body, False, lc / c)
        p = _Page(write(body))
        got = densities(p, [False] * len(p.tag), [(n, t) for n, t in p.items if t], 1)
        assert len(exp) == len(p.tag) - 1
        assert list(zip(*got))[1:] == [pytest.approx(x) for x in exp]
