"""Site style tree: exact text of article pages, entropy on pages that name nothing."""

import math
import random
import re
import time
from collections import Counter, defaultdict
from html import unescape

import pytest
from pyspark.sql import functions as F

from stockrisk.llm.dom import read_blocks
from stockrisk.llm.style_tree import (
    branch_importance,
    enclosing_importance,
    main_text,
    node_importance,
    page_report,
    read_page,
    read_pages,
    removed_blocks,
)


def kept(html):
    return [b.text for b in read_blocks(html)[0] if b.zone == 1]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><h1>T &amp; x</h1><p><b>one<br>two<p>three</p> tail <i>it</i></article>", ["T & x", "one two", "three", "tail it"]),
        ("<header>h</header><main>a<header>b</header><aside>c</aside><footer>d</footer></main>", ["a", "b"]),
        ("<article>x<div class='user-comments'>c<p>d</div>y<p>z</article>w", ["x", "y", "z"]),
        ("<article>a<script>if (a</b>) '<p>'</script>b<style>p{}</style><!-- <p>no --> c</article>", ["ab c"]),
        ("<article>a &lt;p&gt; &#233;&eacute;&am &nbsp; x</article>", ["a <p> éé&am x"]),
        ("<article><p title='>'>q</p><form>f</form><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", ["q", "1", "2", "3", "4"]),
        ("<article>" + "<p>a" * 3000 + "</article><p>no", ["a"] * 3000),
        ("<nav>n</nav><article>a < b <5 <", ["a < b <5 <"]),
        ('<div class="cookie-notice"><article>x</article></div><article id="a1">y</article>', ["y"]),
    ],
)
def test_blocks(html, want):
    assert kept(html) == want


@pytest.mark.parametrize(
    ("html", "want"),
    [
        # Elements that close themselves, or never end, hide nothing behind them.
        ('<article><p>one</p><svg class="i"/><p>two</p><p>three</p></article>', ["one", "two", "three"]),
        ("<article><p>one</p><button>Go <p>two</p><p>three</p></article><footer><button>x</button></footer>", ["one", "Go", "two", "three"]),
        ("<article>a<button><b>Go</b></button>b<object>x<object>y</object>z</object>c<svg><g><svg>q</svg></g>r</svg>d</article>", ["abcd"]),
        ("<article>a<noscript><p>no</noscript>b<select><option>1<option>2</select>c<template><p>t</p></template></article>", ["abc"]),
        ("<article>a<SCRIPT>'</scriptx>'</SCRIPT >b<textarea></p><p></textarea>c<math/>d", ["abcd"]),
        ("<article><p>a<title>unclosed <p>b", ["a"]),
        # A word beside a subject is a subject.
        ('<article>a<div class="social-policy">b</div><section id="related-work">c</section><p class="notice-period">d</p></article>', ["a", "b", "c", "d"]),
        ('<article>a<div class="comment-list">b</div><div class="page-sidebar">c</div><div class="Share Buttons">d</div>e</article>', ["a", "e"]),
        # References are decoded between two tags, not across them.
        ("<article>AT&<b>amp;</b>T &amp;lt; &#x41;</article>", ["AT&amp;T &lt; A"]),
        ("<article><table><tr><td>1<p>2<tr><td>3<table><tr><td>4</table>5</table>6</article>", ["1", "2", "3", "4", "5", "6"]),
        ("<article><b>a<p><i>b</b>c</i>d<a href=x>e<div>f</div></a></p>g</article>", ["a", "bcde", "f", "g"]),
        ("<article><p x=\"1' <b>a</b></article>", ["a"]),
        ('<article><a title="x > y">k</a><p title=\'"\'>l</article>', ["k", "l"]),
    ],
)
def test_reader_rules(html, want):
    assert kept(html) == want


HOSTILE = {
    "nested": "<div>" * 200_000 + "x",
    "stray ends": "<div>" * 1000 + "</section>" * 100_000 + "</i>" * 10_000,
    "odd quotes": "<p x=\"1' <" * 100_000,
    "open quotes": "<p x='\">a" * 120_000,
    "misnested": "<b><div>" * 60_000 + "</b>" * 60_000 + "</div>" * 60_000,
    "blocks in deep divs": "<div>" * 100_000 + "<p>a" * 100_000,
    "controls": "<button>" * 120_000 + "<svg>" * 20_000,
    "brackets": "<" * 1_000_000,
    "items": "<ul><li>" * 60_000 + "<li>a" * 60_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_reading_is_linear(name):
    html = HOSTILE[name]
    took = []
    for part in (html[: len(html) // 4], html):
        started = time.perf_counter()
        read_page(part)
        took.append(time.perf_counter() - started)
    assert took[1] < 12 and (took[1] < 1 or took[1] < 10 * took[0])


LONG = "The text of the page, which is longer than all that stands around it. " * 5


@pytest.mark.parametrize(
    "html",
    [
        f'<div class="wrap has-sidebar"><article>{LONG}</article><div class="sidebar">s</div></div>',
        f'<div class="site header-fixed"><div id="header">h</div><article>{LONG}</article></div>',
        f'<article class="post comments-open">{LONG}<div class="comments">c</div></article>',
        f'<form id="aspnet"><nav>n</nav><article>{LONG}</article><footer>f</footer></form>',
        f'<form><div class="page-sidebar">x<article><h1>T</h1>{LONG}<div class="share">s</div></article></div></form>',
        f'<article><h1>T</h1><form>{LONG}</form></article>',
        f'<article>{LONG}</article><ol class="comment-list"><li><article>{LONG}</article><li><article>{LONG}</article></ol>',
    ],
)
def test_layout_words_and_forms_hide_no_article(html):
    assert [t for t in kept(html) if t not in ("T", "x")] == [LONG.strip()]


def test_a_form_around_a_page_without_article():
    blocks = read_blocks(f'<form><div class="ad">a</div><div>{LONG}</div><form>')[0]
    assert [(b.text, b.zone) for b in blocks] == [("a", 0), (LONG.strip(), 2)]


def plain_article(html):
    inner = re.search(r"<article>(.*)</article>", html, re.S).group(1)
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    got = page_report(pages).collect()
    assert len(got) == len(want)
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def soup(n):
    """A page whose template is divs without names: a menu, a notice, the text, a last line."""
    text = "".join(f"<div class=b><span>Sentence {n} {k} of its own.</span></div>" for k in range(1 + n % 4))
    return f"<body><div class=x>Home | About</div><div class=y>We use files. OK?</div><div class=t>{text}</div><div class=z>All rights kept</div></body>"


def test_entropy_removes_a_nameless_template(spark):
    rows = [(n, "http://a.example/p%d" % n, soup(n)) for n in range(8)] + [(50, "http://b.example:80/", soup(9))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    for n in range(8):
        assert got[n] == "\n".join(f"Sentence {n} {k} of its own." for k in range(1 + n % 4))
    assert got[50].startswith("Home | About\n")  # one page of a host: no template to learn
    tree = {r.importance for r in node_importance(read_pages(pages)).where("host = 'a.example'").collect()}
    assert min(tree) < 0.01 and max(tree) > 0.9


def test_copies_of_a_nameless_page_are_no_template(spark):
    rows = [(n, "http://c.example/p", soup(1)) for n in range(6)] + [(9, "http://c.example/q", soup(2))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert len(got) == 7 and all("Sentence 1 0 of its own." in got[n] for n in range(6))
    assert {r.pages for r in node_importance(read_pages(pages)).collect()} == {2.0}


def story(n, around=""):
    return f"<body>{around}<article><p>Story {n} begins.<p>And story {n} ends.<div class=b>Pass this on</div><p>Read us daily</article></body>"


def test_templates_in_articles_go_and_copied_articles_stay(spark):
    rows = [(n, f"http://d.example/{n}", story(n)) for n in range(9)]
    rows += [(n, f"http://d.example/{n}", story(0, f"<div>menu {n}</div>")) for n in range(20, 60)]
    rows += [(n, f"http://e.example/{n}", f"<article><p>One text.<p>Two.</article><div>{n}</div>") for n in range(100, 120)]
    rows += [(n, f"http://f.example/{n}", story(7).replace("daily", f"on day {n}")) for n in range(200, 203)]
    rows += [(n, f"http://g.example/{n}", f"<article><ul><li><a href=/{n}>Link {n}</a></ul></article>") for n in range(300, 310)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert all(got[n] == f"Story {n} begins.\nAnd story {n} ends." for n in range(9))
    assert all(got[n] == "Story 0 begins.\nAnd story 0 ends." for n in range(20, 60))
    assert all(got[n] == "One text.\nTwo." for n in range(100, 120))
    assert all(got[n] == f"Story 7 begins.\nAnd story 7 ends.\nPass this on\nRead us on day {n}" for n in range(200, 203))
    assert all(got[n] == f"Link {n}" for n in range(300, 310))


def test_nameless_pages_lose_by_generated_names(spark):
    """Nodes of one page each are judged by links; a page loses its own, whatever their number on the host."""
    rows = [(n, f"http://h.example/{n}", f"<div class=x{chr(97 + n)}q><a href=/>Link {n}</a></div>" + soup(n)) for n in range(20)]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in main_text(pages).collect())
    want = [(n, "\n".join(f"Sentence {n} {k} of its own." for k in range(1 + n % 4))) for n in range(20)]
    assert got == sorted(want + want[:1])
    lost = removed_blocks(read_pages(pages), 0.3, 0.9, 3).collect()
    assert len(lost) == 20 and all(len(r["_removed"]) == 4 for r in lost)  # of its own blocks, not the host's paths


def plain_tree(htmls):
    """One host's merged tree by plain sums, pages being distinct: importance, branch and around by path; kept texts by page."""
    read = [read_blocks(h) for h in htmls]
    pages, styles, texts, weight, linked, above = Counter(), defaultdict(Counter), defaultdict(Counter), Counter(), Counter(), {}
    for blocks, children, around in read:
        above |= around
        pages.update(set(around))
        for path in around:
            styles[path][" ".join(children[path])] += 1
        held = defaultdict(list)
        for b in blocks:
            held[b.path, b.text].append(b)
        for (path, text), many in held.items():
            texts[path][text] += 1
            weight[path, text] += sum(len(b.text) for b in many)
            linked[path] += sum(b.linked for b in many)
    importance, mass = {}, {}
    for path, m in pages.items():
        mass[path] = sum(weight[path, t] for t in texts[path])
        scale = math.log(m) or 1
        style = -sum(n / m * math.log(n / m) for n in styles[path].values()) / scale
        content = 1 - sum(weight[path, t] * math.log(n) for t, n in texts[path].items()) / mass[path] / scale if mass[path] else 1
        links = linked[path] / mass[path] if mass[path] else 0
        importance[path] = (0.1 * min(style, 1) + 0.9 * content if m >= 3 else 1) * (1 - links)

    def stands_in(path, branch):
        while path not in (branch, above[path]):
            path = above[path]
        return path == branch

    branch = {}
    for path in pages:
        inside = [p for p in pages if mass[p] and stands_in(p, path)]
        branch[path] = sum(mass[p] * importance[p] for p in inside) / sum(mass[p] for p in inside) if inside else 1
    around = {}
    for path in pages:
        up = path
        while pages[up] < 3 and up != above[up]:
            up = above[up]
        if pages[path] < 3 <= pages[up]:
            around[path] = branch[up]
    worth = {p: min(importance[p], around.get(p, 1)) for p in pages}
    return importance, branch, around, ["\n".join(b.text for b in blocks if b.zone == 2 and worth[b.path] >= 0.3) for blocks, _, _ in read]


def test_against_a_plain_style_tree(spark):
    """Random nested pages: fixed and own texts under fixed and generated names."""
    draw = random.Random(5)

    def branch(n, depth):
        name = draw.choice(["q", "r", "s", "g" + "".join(chr(97 + int(d)) for d in str(n))])
        if depth == 0 or draw.random() < 0.3:
            text = draw.choice(["Home and more", "All rights kept by us", f"Own words of page {n}, {draw.random()}"])
            return f"<div class={name}>{text}</div>"
        return f"<div class={name}>" + "".join(branch(n, depth - 1) for _ in range(draw.randint(1, 3))) + "</div>"

    hosts = {f"{c}.example": [f"<body>{n}" + "".join(branch(n, 5) for _ in range(3)) for n in range(k)] for c, k in (("a", 30), ("b", 4), ("c", 2))}
    rows = [(f"{h}/{n}", f"http://{h}/{n}", html) for h, htmls in hosts.items() for n, html in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    tree = node_importance(read_pages(pages))
    got = {(r.host, r.path + 2**63): r.importance for r in tree.collect()}
    branches = {(r.host, r.path + 2**63): r.branch for r in branch_importance(tree).collect()}
    around = {(r.host, r.path + 2**63): r.around for r in enclosing_importance(tree).collect()}
    texts = {r.page_id: r.text for r in main_text(pages).collect()}
    plain = {h: plain_tree(htmls) for h, htmls in hosts.items()}
    for found, at in ((got, 0), (branches, 1), (around, 2)):
        assert found == pytest.approx({(h, p): v for h in hosts for p, v in plain[h][at].items()}, abs=1e-8)
    assert texts == {f"{h}/{n}": t for h in hosts for n, t in enumerate(plain[h][3])}
    assert len(around) > 50


def test_generated_names_go_with_the_branch_around_them(spark):
    """A menu's item under a name of its own is no content; a page's own text under such a name is."""

    def page(n):
        own = "".join(chr(97 + int(d)) for d in f"{n:02d}")
        menu = f"<div class=m><p>Home, news and all the other sections of this place</p><div class=k{own}><div class=j{own}>Item</div></div></div>"
        return f"<body>{menu}<div class=t{own}><h1>Title {n}</h1><span>{'Words of its own. ' * 5}{n}</span></div></body>"

    pages = spark.createDataFrame([(n, f"http://i.example/{n}", page(n)) for n in range(40)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert got == {n: f"Title {n}\n{'Words of its own. ' * 5}{n}" for n in range(40)}


def test_very_deep_pages_of_a_host(spark):
    deep = "<div>" * 3000
    pages = spark.createDataFrame([(n, f"http://j.example/{n}", f"<p>same{deep}<p>own {n}") for n in range(6)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_text(pages).collect()} == {n: f"own {n}" for n in range(6)}


def test_edge_rows(spark):
    rows = [(1, None, None), (None, "http://h/", ""), (3, "no url", "<p>x"), (3, "no url", "<p>x"), (4, "http://h/q", "<article>same</article>"),
            (5, "http://h/r", "<article>same</article>"), (6, "http://h/s", "<article>same</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("t"))
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in page_report(pages).collect()))
    assert got == [(0, "", 0), (1, "", 0), (3, "x", 1), (3, "x", 1), (4, "same", 4), (5, "same", 4), (6, "same", 4)]
    assert page_report(pages.limit(0)).count() == 0
