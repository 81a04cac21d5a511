"""Pages that mark their article are aligned with their sibling, too."""

from warband.llm.html_extract import extract_main_text

BOX = "".join(f'<article><p>Teaser number {k} of the site, the same on each of its pages.</p></article>' for k in range(4))


def test_boxes_that_repeat_are_not_the_article(spark):
    rows = [(k, f"http://h.com/a/{k}", f"<main><h1>Story {k}</h1><p>Its own text, told {'over and ' * (k + 30)}over.</p>{BOX}</main>") for k in range(6)]
    by = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert by == {k: f"Story {k}\nIts own text, told {'over and ' * (k + 30)}over." for k in range(6)}


def test_copied_article_text_stays(spark):
    body = "<p>A long copied paragraph that many pages hold.</p><article><p>and its quote, copied with it</p></article>"
    want = "A long copied paragraph that many pages hold.\nand its quote, copied with it"
    rows = [(k, f"http://h.com/a/{k}", f"<nav>x</nav><p>Frame</p><main>{body}<p>v{k // 2}</p></main>") for k in range(6)]
    rows += [(k, f"http://i.com/a/{k}", f"<p>Frame {k}</p><article><h1>Head {k}</h1><p>Common line.</p></article>") for k in range(10, 13)]
    rows += [(k, f"http://j.com/a/{k}", f"<main><article><p>Copied story of a fair length.</p></article><p>at {k}</p></main>") for k in range(20, 23)]
    by = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert by == {**{k: f"{want}\nv{k // 2}" for k in range(6)}, **{k: f"Head {k}\nCommon line." for k in range(10, 13)},
                  **dict.fromkeys(range(20, 23), "Copied story of a fair length.")}
