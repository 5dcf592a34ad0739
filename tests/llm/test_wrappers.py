"""Main text against plain cutting of the article, alignment against a plain recursion."""

import html as entities
import random
import re

import pytest

from placetime.llm import wrappers


def plain_text(html):
    article = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
    parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(p for p in parts if p)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in pages.collect()}
    got = wrappers.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == plain_text(rows[r.page_id].html) and r.url == rows[r.page_id].url


def tree(chance, depth=0):
    node = [chance.choice("abc"), 1, 0, 0, 0, 0, False, []]
    if depth < 3:
        node[wrappers.CHILDREN] = [tree(chance, depth + 1) for _ in range(chance.randrange(4))]
    return node


def plain_matching(a, b):
    if a[0] != b[0]:
        return 0

    def lists(xs, ys):
        if not xs or not ys:
            return 0
        return max(lists(xs[1:], ys), lists(xs, ys[1:]), lists(xs[1:], ys[1:]) + plain_matching(xs[0], ys[0]) if xs[0][0] == ys[0][0] else 0)

    return 1 + lists(a[-1], b[-1])


def size(t):
    return 1 + sum(map(size, t[-1]))


@pytest.mark.parametrize("seed", range(12))
def test_simple_tree_matching(seed):
    chance = random.Random(seed)
    a, b = tree(chance), tree(chance)
    a[0] = b[0] = "r"
    best = plain_matching(a, b)
    assert wrappers.matching(a, b) == best
    assert size(wrappers.merge(a, b)) == size(a) + size(b) - best


LAYOUT = "<html><body><div class='m1'><p>Our site</p></div><div class='c{n}'><h2>{title}</h2><p>{text}</p><aside>x</aside></div><div class='z'><p>All rights</p></div></body></html>"


def test_layout_without_landmarks(spark):
    rows = [(i, f"http://Host.example:80/{i}", LAYOUT.format(n=i, title=f"T{i}", text=f"body {i} text")) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract(pages).collect()} == {i: f"T{i}\n\nbody {i} text" for i in range(5)}


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("<p>a<p>b &amp c&#33;<br>d", "a\n\nb & c! d"), ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\n\nb\n\n1\n\n2"),
    ("<article>x<script>if(a<b){}</script>y<!-- z --><div class='ad-box'>k</div><section id=comments>c</section></artic", "xy"),
    ("<div>a <b>b</b>c<div>d</div>e</div>", "a bc\n\nd\n\ne"), ("<nav>n</nav><form><p>f</p></form><p class='cookie-notice'>n</p>t", "t"), ("<p>" + "w " * 100_000, " ".join(["w"] * 100_000)),
    ("<div>" * 3_000 + "deep", "deep"),
])
def test_markup(html, want):
    assert wrappers.main_text(html, [None]) == want
    wrappers.template(wrappers.parse(html))


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "no url", "<p>a", "x"), (2, "http://h/1", "", "x"), (3, "http://h/2", "<article><p>same</article>", "x"), (4, "http://h/3", "<article><p>same</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted(((r.page_id, r.text) for r in wrappers.extract(pages).collect()), key=str)
    assert got == sorted([(1, ""), (1, ""), (None, "a"), (2, ""), (3, "same"), (4, "same")], key=str)
    assert wrappers.extract(pages.limit(0)).collect() == []


def test_names_inside_the_content_root(spark):
    page = (
        "<body><article><header><h1>T{n}</h1></header><h2 id='side-effects'>Effects {n}</h2><p class='notice'>text {n} <span class='hljs-comment'># why</span> end</p>"
        "<section id='related-work'><p>work {n}</p></section><div class='ad'>buy {n}</div></article></body>"
    )
    docs = spark.createDataFrame([(i, f"http://h/{i}", page.format(n=i)) for i in range(4)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract(docs).collect()} == {i: f"T{i}\n\nEffects {i}\n\ntext {i} # why end\n\nwork {i}" for i in range(4)}


def test_comments_notices_and_adverts_inside_the_content_root(spark):
    page = (
        "<body><article><header class='site'>My site {n}</header><header><h1>T{n}</h1></header><p>body {n}</p><p class='advert'>buy {n}</p>"
        "<section id='cookie-banner'>we use {n} cookies</section><div class='relatedPosts'><a href=x>more {n}</a></div><div class='post-header'>by someone {n}</div>"
        "<div id='social-history'><p>history {n}</p></div><div id='comments'><p>first! {n}</p></div><ul class='shareButtons'><li>share {n}</li></ul></article></body>"
    )
    docs = spark.createDataFrame([(i, f"http://h/{i}", page.format(n=i)) for i in range(4)], "page_id long, url string, html string")
    want = {i: f"T{i}\n\nbody {i}\n\nby someone {i}\n\nhistory {i}" for i in range(4)}
    assert {r.page_id: r.text for r in wrappers.extract(docs).collect()} == want


@pytest.mark.parametrize("name,unwanted", [
    ("comments", True), ("cookie-banner", True), ("relatedPosts", True), ("ad-box2", True), ("related-work", False), ("side-effects", False), ("content", False),
    ("main-content", False), ("post-header", False), ("hljs-comment", False), ("", False), ("Sidebar left", True), ("search-algorithms", False),
])
def test_names(name, unwanted):
    assert wrappers.marks_unwanted(name) is unwanted
