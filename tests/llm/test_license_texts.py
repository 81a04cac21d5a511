"""Whole notices with changed words, and licenses that differ in a word."""

import random

from tests.llm.test_dedup import duck_rows
from warband.llm import license_scan


def test_notices_with_changed_words_are_found_and_neighbours_are_not(spark):
    rng = random.Random(4)
    pad = lambda n: " ".join(f"pad{rng.randint(0, 10 ** 6)}" for _ in range(n))
    rows, expected = [], {}
    for k, (name, text) in enumerate(license_scan.TEMPLATES):
        rows.append((k, f"{pad(30)}\n{text}\n{pad(300)}"))
        words = text.split()
        changed = rng.sample(range(len(words)), len(words) // 40)        # a changed word in 40 leaves seven eighths of the shingles
        for i in changed:
            words[i] = "Acme"
        rows.append((100 + k, f"{pad(7)} {' '.join(words)} {pad(20)}"))
        expected[k] = (name, bool(changed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.template): r for r in license_scan.scan_licenses(docs).collect()}
    for k, (name, _) in expected.items():
        assert got[k, k].containment == 1.0 and got[k, k].first_shingle == 30 and (100 + k, k) in got
    gnu = {k for k, (name, _) in expected.items() if "GPL" in name and "version 3 of" in license_scan.TEMPLATES[k][1] or name in ("GPL-2.0", "LGPL-2.1")}
    cc = {k for k, (name, _) in expected.items() if name.startswith("CC-BY") and "Creative" in license_scan.TEMPLATES[k][1]}
    for family in (gnu, cc):
        assert len(family) >= 4 and all((a, b) not in got for a in family for b in family if a != b)
    want = {(r[0], r[1]): tuple(r) for r in duck_rows("SELECT doc_id, template, license, containment, first_shingle, windows FROM ("
                                                      + license_scan.oracle_sql() + ")", documents=docs.toPandas())}
    assert {k: tuple(r) for k, r in got.items()} == want
