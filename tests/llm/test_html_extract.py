import random
import time

import pytest

from warband.llm.html_extract import ARTICLE, extract_main_text, main_text, page_lines, shared_lines, url_order


def test_article_without_its_frame():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body class="no-sidebar">
    <header><p>Site</p></header><nav><ul><li>Home</ul></nav><!-- ad --><div class="ad">Buy</div><div id="cookie-notice">We use</div>
    <main><article><header><h1>Head &amp; line</h1></header><p><b>One two<br>three<p>Four&nbsp;five <i>six</i>
    seven<ul><li>x<li>y</ul><form><p>f</p></form><aside>s</aside><table><tr><td>a<td>b</table></article>
    <section class="userComments"><article class="comment"><p>c1</p></article></section></main><footer>&copy; f"""
    assert page_lines(page) == [(t, ARTICLE) for t in ("Head & line", "One two three", "Four five six seven", "x", "y", "a b")]


def test_broken_and_odd_pages():
    assert page_lines("") == [] and page_lines("plain < text > here") == [("plain < text > here", 0)]
    assert page_lines("<p>a<script>never closed <p>b") == [("a", 0)]
    assert page_lines("<p>a</div></p></b>b<![CDATA[ c&d ]]>") == [("a", 0), ("b c&d", 0)]
    assert page_lines("<div hidden><p>x</p></div><p style='display: none'>y</p><p>z") == [("z", 0)]
    assert len(page_lines("<p>x" * 20_000)) == 20_000


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(0, 14))]
        got = [a[i] for i in sorted(shared_lines(a, b))]
        assert len(got) == longest(a, b) == longest(got, b)


def test_url_order():
    assert url_order("HTTPS://A.Example/x/y?q#z") == ("a.example", "/x/y") and url_order(None) == ("", "") and url_order("x?y") == ("", "x")


def test_pages_without_marks_lose_what_siblings_share(spark):
    frame = "<div>Site name</div><p>Welcome</p>{}<p>All rights</p>"
    rows = [(k, f"http://h.com/a/{k}", frame.format(f"<p>Story {k}</p><p>Body {k}</p>"), "x") for k in range(40)]
    rows += [(100, "http://one.com/", "<p>only page</p>", None), (101, None, None, None), (102, "http://h.com/a/1", "", None),
             (103, "http://m.com/1", "<article><p>kept</p></article>", ""), (103, "http://m.com/1", "<article><p>kept</p></article>", ""),
             (104, "http://m.com/2", "<article><p>kept</p></article>", "")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5))
    by = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(rows)
    assert by[0] == "Story 0\nBody 0" and by[39] == "Story 39\nBody 39" and by[1] == "Story 1\nBody 1"
    assert by[100] == "only page" and by[101] == "" and by[102] == "" and by[103] == by[104] == "kept"
    assert {r.n_chars for r in got.where("page_id = 0").collect()} == {14}
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def text_of(source):
    lines = page_lines(source)
    return main_text([t for t, _ in lines], [v for _, v in lines], [], None)


@pytest.mark.parametrize("source,want", [
    ('<div id=content class="col no-sidebar"><p>body text</p></div>', "body text"),
    ('<article class="post comments-open"><p>body</p></article>', "body"),
    ('<article class="entry share-enabled has-footer"><p>body</p></article>', "body"),
    ('<main><h1>Title</h1><p>a body that is longer</p><article class=tweet><p>quote</p></article></main>', "Title\na body that is longer\nquote"),
    ('<main><p>teaser</p><article><p>the body of the article</p></article><p>more</p></main>', "the body of the article"),
    ('<article><p>outer</p><article><p>inner</p></article></article>', "outer\ninner"),
    ('<nav><a>menu</a><article><p>kept</p></article>', "kept"),
    ('<form id=page><nav>x</nav><article><p>in form</p></article></form>', "in form"),
    ('<article><h2 class="related-work">Related work</h2><p class="ad-lib">ad lib</p><p>z</p></article>', "Related work\nad lib\nz"),
    ("<article><p title=it's>hello</p></article>", "hello"),
    ('<article><p title="a > b">hello</p></article>', "hello"),
    ('<article><p>a</p><div class="cookie-notice">c</div><div class="ad-slot-2">d</div><div id="commentList">e</div><div class="sideBar post-share">f</div></article>', "a"),
    ('<article><script>if (a<b) x("</p>")</script><p>t &amp; u</p><![CDATA[<v>]]></article>', "t & u\n<v>"),
    ("<article><p>open quote <a href=\"x>y</a> z</p></article>", "open quote y z"),
])
def test_structures(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize("source", ['<a b="' * 170_000, "<b><i>" * 8_000 + "x", "<div>" * 20_000 + "</b>" * 20_000, "<p>" + "<b><div></div>" * 8_000,
                                    "<a b='" * 100_000 + '"', "<" * 500_000, "<!--" * 100_000, "<p>x</i>" * 50_000, "<ul>" + "<li>a" * 50_000])
def test_bad_pages_take_linear_time(source):
    start = time.time()
    page_lines(source)
    assert time.time() - start < 10


@pytest.mark.parametrize("seed", [1, 2])
def test_differencing_equals_brute_force(spark, seed):
    """Pages without marks: the nearest page of the host by path, and the plain table of longest common subsequences."""
    rng = random.Random(seed)
    pages = []
    for h in range(3):
        frame = [f"frame {h} {k}" for k in range(4)]
        for k in range(14):
            own = [f"own {h} {k} {i}" for i in range(rng.randint(0, 3))]
            lines = frame[:2] + own + frame[2:]
            if k in (5, 6, 7):                       # copies under adjacent addresses
                lines = frame[:2] + [f"copied {h}"] + frame[2:]
            path = f"/{'abc'[rng.randrange(3)]}/{'xy'[rng.randrange(2)]}/{k:02d}"
            pages.append((h * 100 + k, f"http://Host{h}.org{path}?q={k}", "".join(f"<p>{t}</p>" for t in lines), lines, f"host{h}.org", path))
    pages.append((900, "http://alone.org/", "<p>only</p>", ["only"], "alone.org", "/"))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    first = {}
    for i, _, _, lines, host, path in sorted(pages, key=lambda p: (p[4], p[5], p[0])):
        first.setdefault((host, tuple(lines)), (host, path, i, tuple(lines)))
    order = sorted(first.values())
    want = {}
    for i, _, _, lines, host, _ in pages:
        at = order.index(first[host, tuple(lines)])
        near = [(common(order[at][1], order[j][1]), j) for j in (at - 1, at + 1) if 0 <= j < len(order) and order[j][0] == host]
        gone = set()
        if near:
            best = max(near, key=lambda x: (x[0], -x[1]))
            gone = set(lines) & set(order[best[1]][3])          # lines are distinct and in one order: the shared ones are the subsequence
        want[i] = "\n".join(t for t in lines if t not in gone)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert got == want
