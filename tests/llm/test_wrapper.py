from __future__ import annotations

import html
import random
import re
import time

import pytest

from cloakframe.llm import wrapper
from cloakframe.llm.queries import QUERIES
from cloakframe.operators import hot_keys
from cloakframe.sources.tables import load_table


def test_query_against_given_layout(spark, data_dir):
    """The given pages keep their text in an article of headings and paragraphs."""
    pages = {p.page_id: p for p in load_table(spark, data_dir, "pages").collect()}
    rows = QUERIES["op9_wrapper"](spark, data_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner)
        ]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def size_of_best(a, b):
    """Simple tree matching as defined, without short cuts."""
    if a.label != b.label:
        return 0
    x, y = a.children, b.children
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x, 1):
        for j, q in enumerate(y, 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size_of_best(p, q))
    return m[-1][-1] + 1


def test_matching_is_largest():
    random.seed(9)

    def tree(depth):
        tag = random.choice(["div", "section", "ul"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(random.randint(0, 3)) if depth) + f"</{tag}>"

    for _ in range(150):
        one, two = (f"<body>{tree(3)}{tree(2)}{tree(2)}</body>" for _ in range(2))
        matcher = wrapper.Matcher(one)
        root, matched = matcher.page(two)
        assert len(matched) == size_of_best(root, matcher.root)
        assert len(set(matched.values())) == len(matched)


def extract(spark, pages):
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, text int")
    return {r.page_id: r.text for r in wrapper.extract(df).collect()}


def test_layout_without_article(spark):
    def page(i):
        return (
            f"<body><div class=top>My site</div><div class='side-bar sidebar'>links {i}</div><div id=c><div class=note>Read more "
            f"below</div><h1>T{i}</h1><p>First &lt;{i}&gt; of\n<b>b</b>old<p>Second {i * 7}<div class='comments'><p>reader {i}</div></div>"
            f"<div>(c) all of us</div><form>f{i}</form></body>"
        )

    got = extract(spark, [(i, "https://u@a.example/x", page(i)) for i in range(6)])
    assert got == {i: f"T{i}\n\nFirst <{i}> of bold\n\nSecond {i * 7}" for i in range(6)}


def test_single_page_and_odd_rows(spark):
    rows = [
        (1, "http://one/", "<nav>n</nav><main><header><h1>H</h1></header><p>a&nbsp; b&amp;c<!-- x --><script>if(a<b)</script> d</p></main><footer>f</footer>"),
        (2, None, None), (3, "", ""), (4, "http://two/", "plain < text &am"), (5, "http://three/", "<p>open <i>never closed <a href='x>y'>z"),
        (6, "http://four/", "<p class='x"), (7, "http://five/", "<article><p>x</p><aside>y</aside><article class=comment>z</article></article>"),
        (8, "http://six/", "<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table>"),
        (9, "http://seven/", "<!-- never closed <p>x</p>"),
    ]
    assert extract(spark, rows) == {
        1: "H\n\na b&c d", 2: "", 3: "", 4: "plain < text &am", 5: "open never closed z", 6: "", 7: "x",
        8: "a\n\nb\n\nc\n\nd\n\n1\n\n2\n\n3", 9: "",
    }


def test_copies_stay(spark):
    rows = [(i, "http://h/", "<body><div>menu</div><article><p>same text</p></article></body>") for i in range(5)]
    assert set(extract(spark, [*rows, rows[0]]).values()) == {"same text"}


def test_template_alone_is_not_dropped(spark):
    rows = [(i, "http://h/", "<body><div>all the same</div></body>") for i in range(5)]
    assert set(extract(spark, rows).values()) == {"all the same"}


@pytest.mark.parametrize("text", ["<p>" * 20_000, "<div>" * 20_000 + "x", "<a \"" * 3_000, "<" * 100_000, "<p>x</p>" * 20_000])
def test_hostile_markup_ends_soon(text):
    start = time.time()
    matcher = wrapper.Matcher("<body><p>a</p><div>b</div></body>")
    matcher.wrapper = ([], wrapper.induce(matcher, []))
    wrapper.main_text(matcher, text)
    assert time.time() - start < 20


@pytest.mark.parametrize("one_in", [2, 10_000])
def test_large_wrappers_give_the_same(spark, monkeypatch, one_in):
    rows = [(i, f"http://h{i % 3 // 2}/", f"<body><div>menu</div><div><p>text {i}</p><p>more {i}</p></div></body>") for i in range(30)]
    want = extract(spark, rows)
    monkeypatch.setattr(wrapper, "SMALL_BYTES", -1)
    monkeypatch.setattr(hot_keys, "HOT_ONE_IN", one_in)
    assert extract(spark, rows) == want and want[4] == "text 4\n\nmore 4"


def test_empty(spark):
    assert extract(spark, []) == {}


LONG = "A long text of the body that goes on and on. " * 20


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_headline_outside_the_body(spark, around):
    def page(i):
        return (
            f"<body><div>My site</div><{around}><h1>Title {i}</h1><p>Intro {i}</p><div class=body><p>{i} {LONG}</p><p>{LONG} {i}</p>"
            f"</div></{around}><div>(c) all of us</div></body>"
        )

    got = extract(spark, [(i, "http://h/", page(i)) for i in range(5)])
    assert got == {i: f"Title {i}\n\nIntro {i}\n\n{i} {LONG.strip()}\n\n{LONG}{i}" for i in range(5)}


def test_teasers_beside_a_body_without_article(spark):
    def page(i):
        return f"<body><div><h1>T{i}</h1><div><p>{i} {LONG}</p></div></div><div><article><p>teaser {i}</p></article></div></body>"

    got = extract(spark, [(i, "http://h/", page(i)) for i in range(5)])
    assert all(got[i].startswith(f"T{i}\n\n{i} A long") for i in range(5))


@pytest.mark.parametrize(
    "page,want",
    [
        ("<div class='content-sidebar-wrap'><main><p>x</p></main></div>", "x"),
        ("<div class='site no-sidebar'><p>x</p><div class='widget'>w</div></div>", "x"),
        ("<form><nav>n</nav><div><p>a long enough text</p></div><footer>f</footer></form>", "a long enough text"),
        ("<div class=sidebar><main><p>x y z</p><form>f</form></main></div>", "x y z"),
        ("<div class=widget><article><p>x</p></article></div><div>y</div>", "x"),
        ("<main><h1>h</h1><form><article>x</article></form></main>", "h\n\nx"),
        ("<article><p>x</p></article><div class=comments><article>z</article></div>", "x"),
        ("<article><h2 id='related-work'>r</h2><h2 id=related>s</h2><section id='social'>t</section></article>", "r\n\ns\n\nt"),
        ("<div class='site-footer'>f</div><div class='Comment_List'>c</div><div id=sidebar>s</div><p>x</p>", "x"),
        ("<div class=widget><p>x</p></div><nav>n</nav>", "x"), ("<nav>n</nav>", "n"),
        (f"<div title='{'a>' * 6_000}'>x</div><p data-x=\"{'b>' * 6_000}\">y", "x\n\ny"),
    ],
)
def test_marks_do_not_hide_the_text(page, want):
    matcher = wrapper.Matcher(page)
    matcher.wrapper = ([], wrapper.induce(matcher, []))
    assert wrapper.main_text(matcher, f"<body>{page}</body>") == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_copies_make_no_template(spark, monkeypatch, broadcast):
    """Only the reference and its copies have the last paragraphs, and they keep them."""

    def page(i, more=""):
        return f"<body><div>menu</div><div><p>text {i} {'.' * (0 if more else i % 2 * 200)}</p>{more}</div></body>"

    more = "".join(f"<p>paragraph {k}</p>" for k in range(5))
    rows = [(i, "http://h/", page(i)) for i in range(20)] + [(100 + i, "http://h/", page("copied", more)) for i in range(6)]
    if not broadcast:
        monkeypatch.setattr(wrapper, "COPIES_SHIPPED", -1)
    chosen = {r.reference for r in wrapper.references(spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")).collect()}
    assert chosen == {rows[-1][2]}
    got = extract(spark, rows)
    assert all(got[100 + i] == "\n\n".join(["text copied", *(f"paragraph {k}" for k in range(5))]) for i in range(6))
    assert got[1] == f"text 1 {'.' * 200}"


ARTICLE = "<article><h1>Headline</h1><p>First of it.</p><p>Second of it.</p>{}</article>{}"
SAID = "<p>I liked it.</p><p>So did I.</p>"
COMMENTS = [
    f'<section id="comments">{SAID}</section>', f'<section class="post__comments">{SAID}</section>',
    f'<div class="comment-thread">{SAID}</div>', f'<ol class="commentlist"><li>{SAID}</li></ol>', f'<ul id="comment-list"><li>{SAID}</ul>',
    f'<div class="Article__Comments--open">{SAID}</div>', f'<section id="readerComments" class=x><div class="comment-thread">{SAID}</div></section>',
    f'<div id="disqus_thread">{SAID}</div>', f'<div class="story comments-area">{SAID}</div>', f'<div class="cookieBanner">{SAID}</div>',
    f'<section class="comments"><article class="comment">{SAID}</article></section>',
]


CASES = [ARTICLE.format(*((c, "") if inside else ("", c))) for c in COMMENTS for inside in (True, False)]


def test_reader_comments_stay_out():
    for page in CASES:
        alone = wrapper.Matcher(page)
        alone.wrapper = ([], wrapper.induce(alone, []))
        assert wrapper.main_text(alone, page) == "Headline\n\nFirst of it.\n\nSecond of it.", page


@pytest.mark.parametrize("tag", ["article", "div"])
def test_reader_comments_stay_out_of_wrappers(spark, tag):
    rows, want = [], {}
    for k, case in enumerate(CASES):
        for i in range(6):
            html = case.replace("Headline", f"Headline {i}").replace("First", f"{i}. First").replace("Second", f"{i}. Second")
            html = html.replace("liked", f"liked {i} of").replace("So did", f"So did {i}")
            if tag == "div":
                html = html.replace("<article><h1>", "<div><h1>").replace("</article>", "</div>")
            rows.append((k * 10 + i, f"http://h{k}/", f"<body>{html}</body>"))
            want[k * 10 + i] = f"Headline {i}\n\n{i}. First of it.\n\n{i}. Second of it."
    got = extract(spark, rows)
    assert {i: t for i, t in got.items() if t != want[i]} == {}


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article><div data-id='related'><p>x</p></div><div data-class=\"menu\">y</div><p title='set class=menu here'>z</p></article>", "x\n\ny\n\nz"),
        ("<article><div aria-label='a' hidden data-role=navigation>x</div><div CLASS = 'menu' >y</div>z</article>", "x\n\nz"),
        ("<p>super<wbr>cali and a<img src=x>b<input>c<br>d</p>", "supercali and abc d"),
        ("<p>a<svg><svg><text>in</text></svg><text>still in</text></svg>b<svg/>c</p>", "abc"),
        ("<p>a<script>if (a < b) '</p>'</script >b</p><style>x", "ab"),
        ("<p>1 < 2 and 3 <4</p>", "1 < 2 and 3 <4"), ("<p>x</p><a href='never ends", "x"), ("<p title=don't>x</p><p title='it is'>y", "x\n\ny"),
        ("<p>x<!-- never ends <p>y", "x"), ("<section id='related-work'>x</section><section id=history>y</section>", "x\n\ny"),
        ("<div class='shareholder social-history adfree menu-of-the-day'>x</div>", "x"),
    ],
)
def test_attributes_and_marks(page, want):
    matcher = wrapper.Matcher(page)
    matcher.wrapper = ([], wrapper.induce(matcher, []))
    assert wrapper.main_text(matcher, f"<body>{page}</body>") == want


HOSTILE = {
    "open tags": "<a ", "end tags": "</x ", "quotes": "<a b='", "other quotes": '<p c="d', "divs": "<div>", "closed divs": "<div>x</div>",
    "quotes and ends": "<a b='>\"", "items": "<li><blockquote>", "cells": "<td><p>", "comments": "<!--", "equals": "<a = = =", "script": "</script ",
    "raw": "<script>", "svg": "<svg>", "ends of divs": "</div>", "paragraphs": "<p>", "names": "<p a a a", "spaces": "<p =       ", "less": "<<<", "and": "&amp",
    "forms": "<form><section>",
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_broken_markup_takes_linear_time(name):
    def seconds(size):
        text = "<article><p>kept</p>" + HOSTILE[name] * (size // len(HOSTILE[name]))
        matcher = wrapper.Matcher("<body><p>a</p><div>b</div></body>")
        matcher.wrapper = ([], wrapper.induce(matcher, []))
        begun = time.process_time()
        assert wrapper.main_text(matcher, text).startswith("kept")
        return time.process_time() - begun

    seconds(1000)
    small, large = min(seconds(50_000) for _ in range(2)), min(seconds(100_000) for _ in range(2))
    assert large < 1.5 and large < 3.2 * small + 0.05


def test_deep_pages_align():
    deep, deeper = ("<div class=a>" * n + "<p>x</p>" for n in (3000, 9000))
    matcher = wrapper.Matcher(deep)
    assert wrapper.observe(matcher, deeper)
