"""Copies under adjacent URLs lose the site's frame like other pages."""

from warband.llm.html_extract import extract_main_text


def test_all_copies_of_a_run_lose_the_frame(spark):
    frame = "<div>Site name</div><p>Welcome</p>{}<p>All rights</p>"
    rows = [(k, f"http://h.com/a/{k:02}", frame.format(f"<p>Story {k}</p>" if k in (0, 9) else "<p>Copied story</p>")) for k in range(10)]
    rows += [(20, "http://c.com/1", "<p>Same</p>"), (21, "http://c.com/2", "<p>Same</p>"), (22, "http://c.com/2", "<p>Same</p>")]
    rows += [(30, "http://d.com/1", frame.format("<p>One</p>")), (31, "http://d.com/2", "<article>" + frame.format("<p>Copied</p>") + "</article>"),
             (32, "http://d.com/3", frame.format("<p>Copied</p>")), (32, "http://d.com/3", frame.format("<p>Copied</p>"))]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert [by[k] for k in range(10)] == ["Story 0"] + ["Copied story"] * 8 + ["Story 9"]
    assert by[20] == by[21] == by[22] == "Same" and by[30] == "One" and by[32] == "Copied" and by[31].startswith("Site name")
