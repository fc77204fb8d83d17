import random
import re
import time
from html.parser import HTMLParser

import pytest

from meridian.llm import html_diff as H


def _lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [6, 1 << 26])
def test_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(H, "TABLE_BITS", bits)
    rng = random.Random(2)
    for _ in range(1500):
        k = rng.choice([1, 2, 3, 8])
        a, b = ([rng.randrange(k) for _ in range(rng.randrange(14))] for _ in range(2))
        kept = sorted(H.common(a, b))
        rest = iter(b)
        assert all(a[i] in rest for i in kept) and len(kept) == _lcs(a, b)


def test_lines_and_states():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
    <nav><ul><li><a href="/x">One</a><li>Two</ul></nav><div class="cookie-notice">C<p>D</p></div><p>Plain &amp; <b>bold</b></p>
    <article class="post"><header><h1>Head&nbsp;line</h1></header><p>A<br>b <i>c</i>d<p>E &lt;tag&gt; &copy
    <script>var x = "</p>";</script><aside>Side</aside><!-- gone <p> --><ul><li>1<li>2</ul><div class=comments>Said</div>
    <table><tr><td>x<td>y</table></article><form>F<input></form><footer>Foot</footer></body>"""
    assert H.lines(page) == [
        ("T", H.MARKED), ("Site", H.MARKED), ("One", H.MARKED), ("Two", H.MARKED), ("C", H.MARKED), ("D", H.MARKED),
        ("Plain & bold", H.PLAIN), ("Head line", H.MAIN), ("A b cd", H.MAIN), ("E <tag> ©", H.MAIN), ("Side", H.MARKED),
        ("1", H.MAIN), ("2", H.MAIN), ("Said", H.MARKED), ("x", H.MAIN), ("y", H.MAIN), ("F", H.MARKED), ("Foot", H.MARKED)]
    assert H.lines(None) == H.lines("") == H.lines("<script>x") == []
    assert H.lines("a < b <3 & c") == [("a < b <3 & c", H.PLAIN)]
    assert H.lines('<div title="a>b">q</div>') == [("q", H.PLAIN)]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, own string")


def test_unmarked_pages_lose_what_the_nearest_page_shares(spark):
    def page(*own):
        return "<div>Menu A</div><div>Menu B</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>All rights</div>"

    rows = [(1, "http://h/a/1", page("one", "both")), (2, "http://h/a/2", page("two", "both")), (3, "http://H/b/3", page("three")),
            (4, "http://alone/x", page("four")), (5, None, None), (6, "", ""), (7, "http://h/c", "<article>Menu A</article>")]
    got = {r.page_id: r for r in H.extract(spark, _table(spark, rows)).collect()}
    assert [got[i].text for i in (1, 2, 3)] == ["one", "two", "three"]
    assert got[4].text == "Menu A\n\nMenu B\n\nfour\n\nAll rights"
    assert got[5].text == got[6].text == "" and got[5].n_chars == 0
    assert got[7].text == "Menu A" and got[7].url == "http://h/c" and got[7].n_chars == 6


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_task_ends_do_not_change_the_result(spark, parts):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        lines = [f"line {rng.randrange(6)}" for _ in range(rng.randrange(6))]
        rows.append((i, f"http://h{rng.randrange(3)}/{rng.choice('ab')}/{rng.randrange(30)}", "".join(f"<p>{x}</p>" for x in lines)))
    outside, first = {}, {}
    for i, url, html in rows:
        host, path = H.split_url(url)
        outside[i] = host, H._digest(H.lines(html)), H.lines(html)
        if html:
            key = outside[i][:2]
            first[key] = min(first.get(key, (path, None)), (path, None))[0], outside[i][2]
    pages = sorted((host, path, digest, own) for (host, digest), (path, own) in first.items())
    cuts = {}
    for k, page in enumerate(pages):
        near = H._nearest(page, pages[k - 1] if k else None, pages[k + 1] if k + 1 < len(pages) else None)
        cuts[page[H.HOST], page[H.DIGEST]] = H.shared_lines(page[H.OWN], near)
    want = {i: H.main_text(own, cuts.get((host, digest))) for i, (host, digest, own) in outside.items()}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.page_id: r.text for r in H.extract(spark, _table(spark, rows)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want


def test_repeated_rows_long_page_and_empty_table(spark):
    long = "<p>" + "</p><p>".join(f"l{i % 700}" for i in range(20_000)) + "</p>"
    rows = [(1, "http://h/1", "<p>x</p>")] * 2 + [(2, "http://g/1", long), (3, "http://g/2", long + "<p>end</p>")]
    got = sorted((r.page_id, r.text) for r in H.extract(spark, _table(spark, rows)).collect())
    whole = "\n\n".join(f"l{i % 700}" for i in range(20_000))
    assert got == [(1, "x"), (1, "x"), (2, whole), (3, whole + "\n\nend")]
    assert H.extract(spark, _table(spark, [])).count() == 0


@pytest.mark.parametrize("page", [
    "<body class='single has-sidebar'><article>A</article></body>",
    "<html id=page class='menu'><body class='widget nav'><article>A</article></body></html>",
    "<article class='post comment-open'>A</article>", "<article class=notice>A</article>", "<main class=widget>A</main>",
    "<form><article>A</article></form>", "<form><div class=widget><main>A</main></div></form>",
    "<div class=sidebar><article>A</article></div>", "<div class=widget><form><article>A</article></form></div>",
    "<article><section class='related-work'>A</section></article>", "<article><section id='share-prices'>A</section></article>"])
def test_articles_are_never_marked_by_what_surrounds_or_names_them(page):
    assert H.lines(page) == [("A", H.MAIN)]


def test_site_elements_beside_or_inside_the_article_stay_marked():
    for name in ("comment", "post related", "cookie-notice", "site-footer", "share_buttons", "Comment-List"):
        assert H.lines(f"<article>A<div class='{name}'>S</div></article>") == [("A", H.MAIN), ("S", H.MARKED)]
    page = "<aside>S<article>T</article></aside><form>F<article>A<div id=comments><article>C</article></div></article></form>"
    assert H.lines(page) == [("S", H.MARKED), ("T", H.MARKED), ("F", H.PLAIN), ("A", H.MAIN), ("C", H.MARKED)]
    assert H.lines("<form>F<main>A</main></form><form>G</form>") == [("F", H.PLAIN), ("A", H.MAIN), ("G", H.MARKED)]


class _Plain(HTMLParser):
    """An independent reading of the given pages: the blocks of the article, by their markup alone."""

    def __init__(self):
        super().__init__()
        self.depth, self.skip, self.blocks, self.held = 0, [], [], []

    def cut(self):
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        names = f"{dict(attrs).get('class') or ''} {dict(attrs).get('id') or ''}"
        if tag not in ("b", "i", "em", "strong", "a", "span", "code", "br", "img"):
            self.cut()
        if self.skip or tag in ("aside", "nav", "form", "script", "style") or re.search(r"\b(ad|advert|share|related|comments?)\b", names):
            if tag not in ("br", "img", "input", "hr", "meta", "link"):
                self.skip.append(tag)
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        if tag not in ("b", "i", "em", "strong", "a", "span", "code"):
            self.cut()
        if self.skip:
            while self.skip and self.skip.pop() != tag:
                pass
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth > 0 and not self.skip:
            self.held.append(data)


def test_given_pages_against_an_independent_parse(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(spark, pages).collect()}
    for p in pages.collect():
        parser = _Plain()
        parser.feed(p.html or "")
        parser.close()
        parser.cut()
        want = "\n\n".join(parser.blocks)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want)), p.page_id


def test_copies_keep_their_texts_and_still_lose_the_site(spark):
    def page(*own):
        return "<div>Menu A</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>All rights</div>"

    body = ["a first block of this article that goes on for a while", "and a second one that is as long as the first"]
    near = [*body, "plus one word"]
    rows = [(i, f"http://h/copy/{i}", page(*body)) for i in range(8)] + [(20, "http://h/other", page("something else entirely, at some length"))]
    rows += [(30, "http://g/1", page(*body * 4)), (31, "http://g/2", page(*body * 4, "x"))]
    rows += [(40, "http://f/1", page(*near)), (41, "http://f/2", page("a quite different text, and none of theirs"))]
    got = {r.page_id: r.text for r in H.extract(spark, _table(spark, rows)).collect()}
    assert {got[i] for i in range(8)} == {"\n\n".join(body)} and got[20] == "something else entirely, at some length"
    assert got[30].startswith("Menu A") and body[1] in got[30] and got[31].count(body[0]) == 4  # near copies alone on a host
    assert got[40] == "\n\n".join(near)


@pytest.mark.parametrize("page", ["<a x" * 250_000, "<a \"" * 250_000 + ">", "<b>" * 200_000 + "</i>" * 200_000, "<b>" * 200_000 + "<hr>" * 200_000,
                                  "</p>" * 300_000, "<!--" * 250_000, "<p><b>" * 150_000, "<div class='" * 80_000, "<" * 1_000_000])
def test_broken_pages_take_linear_time(page):
    start = time.process_time()
    H.lines(page)
    assert time.process_time() - start < 4


def test_tags_that_never_end():
    assert H.lines("<p>a <b and more") == [("a <b and more", H.PLAIN)]
    assert H.lines('<p title="x>a</p><p>b</p>') == [("a", H.PLAIN), ("b", H.PLAIN)]
    assert H.lines("<p>a</p><!-- never closed <p>b</p>") == [("a", H.PLAIN)]
    assert H.lines("<article>A<div class='ad-slot'>S</div></article>") == [("A", H.MAIN), ("S", H.MARKED)]
