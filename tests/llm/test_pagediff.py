"""Page differencing: lines, alignment, pairs, and whole results against a
plain version over all pages at once."""

import random
import re
from html import unescape

import pytest

from corvid.llm import pagediff
from corvid.session import table


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", True) for p, u, h in rows],
                                 "page_id long, url string, html string, lines string, own boolean")


FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style></head><body class="home nav-open">
<header><h1>Site</h1><nav><ul><li>Home<li>About</ul></nav></header><div id="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>
 text&nbsp;here.<br>Next</p><div class="ad">Buy</div><p>Second &lt;x&gt; 1 < 2</p><form>Mail <input></form>
<script>var a="</p>";</script><ul><li>item one</li><li>item two</li></ul><section class="comments"><article>nice!</article>
</section><!-- <p>no</p> --><p>Last<aside>side</aside></article></main><footer>&copy; us</footer></body></html>"""


def test_lines_of_a_full_page():
    lines, kinds = pagediff.text_lines(FULL)
    assert pagediff.main_lines(lines, kinds, None) == [
        "Title & more", "First bold text here. Next", "Second <x> 1 < 2", "item one", "item two", "Last"]


@pytest.mark.parametrize("html,want", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b</p>", ["a", "b"]), ("<nav>menu<article><p>x</p></article>", ["x"]),
    ("<p>unclosed <b>bold", ["unclosed bold"]), ("<script>no end", []), ("<div class='x\"y'>q</div>", ["q"]),
    ('<p title="a>b">t</p>', ["t"]), ("<p title='open>t</p>", ["t"]), ("<div class=ad>x</div><p>y", ["y"]),
    ("<div class='ad'><div>in</div>still</div>out", ["out"]), ("a<br/>b", ["a b"]), ("<!-- x", []), ("1 < 2 & 3", ["1 < 2 & 3"])])
def test_lines_of_fragments(html, want):
    assert pagediff.main_lines(*pagediff.text_lines(html), None) == want


@pytest.mark.parametrize("html", [
    '<article class="post category-social"><p>text</p></article>', '<main class="has-sidebar"><p>text</p></main>',
    '<article class="ad menu"><p>text</p></article>', '<main id="top" class="sidebar"><p>text</p></main>',
    '<div id="content" class="no-sidebar"><p>text</p></div>', '<section id="discussion"><p>text</p></section>',
    '<h2 id="related-work">text</h2>', '<p class="side-effects">text</p>', '<p class="ad">text</p>',
    '<article><section id="discussion"><p>text</p></section></article>', '<div data-id="ad">text</div>',
    '<article><h2 class="related">text</h2></article>', '<article><div class="notice">text</div></article>',
    '<div class="sidebar layout"><article><p>text</p></article></div>', '<form id="page"><main><p>text</p></main></form>',
    '<div class="headline topNews">text</div>', '<li class="comment-free">text</li>'])
def test_names_alone_delete_no_text(html):
    other = ["a neighbour's line"]
    for beside in (None, other):
        assert pagediff.main_lines(*pagediff.text_lines(html), beside) == ["text"]


def test_suspected_elements_go_if_the_alignment_confirms_them():
    page = ("<div class='menu main-menu'><li>Home<li>Sports and games<li>own link</div><section id='discussion'><p>Our long "
            "text on results</p><p>Home</p></section><p>And some more text here</p><div class='ads'>Buy</div>")
    lines, kinds = pagediff.text_lines(page)
    want = ["Our long text on results", "And some more text here"]
    assert pagediff.main_lines(lines, kinds, ["Home", "Sports and games", "another link", "Home", "other text"]) == want
    assert pagediff.main_lines(lines, kinds, ["no line of it"]) == [x for x in lines if x != "Buy"]


def shop_page(i, wrap):
    body = "".join(f"<p>own story {i} part {k} of some length {i * k}</p>" for k in range(1, 5))
    return wrap.format(body=body, i=i)


@pytest.mark.parametrize("wrap", [
    "<div>Site top</div>{body}<div>Kept rights</div>",
    "<main><p>Share this</p>{body}<p>Kept rights</p></main>",
    "<div role=main><div>Share this</div>{body}</div><p>outside {i}</p>",
    "<article><div>Share this</div>{body}<ul><li>Mail</li></ul></article>",
    "<main><div>Share this</div><article>{body}</article><p>Read on</p></main>",
    "<p>Site top</p>{body}<div><article><p>Card</p></article></div>",
])
def test_alignment_decides_with_the_mark_as_a_prior(spark, wrap):
    rows = [(i, f"http://s.example/{i}", shop_page(i, wrap)) for i in range(1, 5)]
    for r in pagediff.extract(pages(spark, rows)).collect():
        assert r.text.split("\n") == [f"own story {r.page_id} part {k} of some length {r.page_id * k}" for k in range(1, 5)]


def test_an_unshared_card_keeps_the_text_outside():
    html = shop_page(1, "<p>Site top</p>{body}<article><p>Next: card</p></article>")
    got = pagediff.main_lines(*pagediff.text_lines(html), ["Site top"])
    assert len(got) == 5 and got[:4] == pagediff.text_lines(shop_page(1, "{body}"))[0]


def test_quotes_and_copies_in_articles_stay():
    html = shop_page(1, "<article>{body}<p>A quoted line.</p></article><div>x</div>")
    lines, kinds = pagediff.text_lines(html)
    assert pagediff.main_lines(lines, kinds, ["A quoted line.", "other"]) == lines[:5]
    lines, kinds = pagediff.text_lines(shop_page(1, "<main>{body}</main>"))
    assert pagediff.main_lines(lines, kinds, lines) == lines


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 20))] for _ in range(2))
        found = pagediff.common_lines(a, b)
        assert len(found) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found) and found == sorted(set(found))


def template_page(host, i, rng):
    body = "".join(f"<p>{host} story {i} part {k} {rng.random()}</p>" for k in range(rng.randint(2, 5)))
    return f"<html><body><div>Welcome to {host}</div>{body}<div>All rights kept by {host}</div></body></html>"


def brute(rows):
    key = lambda r: (*pagediff.url_key(r[1]), pagediff._NO_ID if r[0] is None else r[0])
    order = sorted(rows, key=key)
    out = []
    for n, (p, u, h) in enumerate(order):
        same = []
        for m in (n - 1, n + 1):
            if 0 <= m < len(order) and key(order[m])[0] == key(order[n])[0]:
                a, b = key(order[m])[1], key(order[n])[1]
                common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905
                same.append((-common, m))
        other = pagediff.text_lines(order[min(same)[1]][2] or "")[0] if same else None
        text = "\n".join(pagediff.main_lines(*pagediff.text_lines(h or ""), other))
        out.append((p, u, text, len(text)))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes", [1 << 30, 3000, 300])
def test_equals_one_pass_over_all_pages(spark, range_bytes):
    rng = random.Random(2)
    rows = []
    for i in range(80):
        host = rng.choice(["hot.example", "hot.example", "hot.example", "b.example", "c.example"])
        rows.append((i, f"https://{host}/{rng.choice(['a', 'b'])}/{rng.randint(1, 40)}", template_page(host, i, rng)))
    rows += [(200, None, "<p>no url</p>"), (201, "http://[bad", FULL), (202, "http://x.example/", None),
             (None, "http://hot.example/a/1", FULL), (203, "http://x.example/", ""), rows[0]]
    got = pagediff.extract(pages(spark, rows), range_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    # the hot host also has a copy and a page of another template as neighbours
    assert not any("Welcome" in r.text for r in got if "b.example" in (r.url or ""))
    assert all("story" in r.text for r in got if r.page_id is not None and r.page_id < 80)


def test_copies_of_an_article_stay(spark):
    body = "<div>Top</div><p>" + "the same long story " * 20 + "</p>"
    got = pagediff.extract(pages(spark, [(1, "http://a/1", body), (2, "http://a/2", body)])).collect()
    assert all("story" in r.text for r in got)


def test_marked_articles_come_out_whole(spark, sf_dir):
    data = table(spark, sf_dir, "pages")
    got = {r.page_id: r.text for r in pagediff.extract(data).collect()}
    for row in data.collect():
        inner = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|br)>", " ", inner))
        want = [" ".join(unescape(b).split()) for b in blocks]
        assert got[row.page_id] == "\n".join(w for w in want if w)


def test_empty_table(spark):
    assert pagediff.extract(pages(spark, [])).count() == 0
