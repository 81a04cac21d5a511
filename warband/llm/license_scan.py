"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

A template of ``m`` five-word shingles (a shorter one is a single shingle of all its words) is looked for in
windows of ``m + stride`` consecutive shingles, ``stride = max(1, m // 4)`` apart, so every run of ``m``
shingles lies whole in some window. Such a window that holds at least 0.8 of the template's shingles has a
Jaccard similarity of 0.8·m / (m + stride + 0.2·m) >= 0.4 with it (0.55 for large ``m``). With ``BANDS`` bands of
one row each, none agrees with probability (1 − 0.4)^32 < 1e-7. Every retrieved (window, template) pair is
verified by exact containment.

A band's minimum agrees with a template's only where the window's smallest shingle is one of the
template's. So windows that hold no template shingle can collide with none and are not built: texts are
scanned once for template shingles, and only windows around those are hashed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from warband.llm.common import row_key
from warband.session import materialize

SHINGLE, BANDS = 5, 32
CONTAINED = 0.8
# Notices and whole short texts as the licenses word them.
_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
          "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
          "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
          "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
          "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
          "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.")
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
            '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", f"{_BSD} {_AS_IS}"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
            "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
            "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
            "THIS SOFTWARE."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
                   "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-2.1", "the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring "
                "rights to this work."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
                  "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
                  "by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
             "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely"),
]


def word_list(text: Column) -> Column:
    """Lower-cased ASCII words: runs of letters, digits and the characters . + -, dots and dashes at their ends cut."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9.+-]+|[.-]+(?=[^a-z0-9.+-]|$)", " ")), " +")
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.filter(words, lambda w: w != ""))


def shingle_list(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all ``size``-word shingles in text order; of the whole list if it is shorter."""
    at = lambda i, k: F.get(words, i + k)
    full = F.transform(F.sequence(F.lit(0), F.size(words) - size),
                       lambda i: F.xxhash64(*[at(i, k) for k in range(size)]))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, full).when(F.size(words) > 0, F.array(F.xxhash64(*[F.get(words, F.lit(k)) for k in range(size)]))).otherwise(none)


def band_keys(window: Column) -> Column:
    """The smallest of each band's hashes over a window's shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.array_min(F.transform(window, lambda h: F.xxhash64(h, b))))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template int, license string, text string").repartition(1)
    t = t.withColumn("words", word_list(F.col("text")))
    t = t.withColumn("shingles", F.array_distinct(shingle_list(F.col("words"))))
    m = F.size("shingles")
    return t.select("template", "license", "shingles", m.alias("m"), F.greatest(F.lit(1), F.floor(m / 4)).cast("int").alias("stride"),
                    band_keys(F.col("shingles")).alias("bands"))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", contained: float = CONTAINED) -> DataFrame:
    """One row per (document, template) found: id, ``template`` (number), ``license``, ``containment`` of its best window,
    ``first_shingle`` (position of that window's first template shingle), ``windows`` (windows that hold it).

    Texts that are null, empty or hold no template give no row. A text shorter than a shingle is one shingle.
    Of windows that hold equally much the first counts. Rows that repeat id and text are one document.
    Other columns are not read. An empty table gives an empty result. ``templates`` is a list kept by the
    caller and is broadcast; documents are not.
    """
    spark = docs.sparkSession
    known = materialize(template_table(spark, TEMPLATES if templates is None else templates), "license-templates")
    parts = F.broadcast(known.select("m", "stride", F.explode("shingles").alias("h")).distinct())
    mine = sorted(r["h"] for r in parts.select("h").distinct().collect())      # the caller's templates
    # One-element arrays are exploded to pass words and shingles on: Spark moves no filter and no expression
    # through a generator, so neither is made anew for each shingle or a second time for the filter.
    base = (docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.explode_outer(F.array(word_list(F.col(text_col)))).alias("words"))
            .select("k1", "k2", "id", F.explode_outer(F.array(shingle_list(F.col("words")))).alias("sh"))
            .where(F.arrays_overlap("sh", F.lit(mine).cast("array<bigint>"))))
    base = materialize(base, "license-documents")
    found = base.select("k1", "k2", F.posexplode("sh").alias("pos", "h")).join(parts, "h").select("k1", "k2", "m", "stride", "pos").distinct()
    found = materialize(found, "license-hits")
    # windows that hold a hit, by its template's own length and stride
    span = F.col("m") + F.col("stride")
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - span + 1) / F.col("stride"))).cast("int")
    windows = (found.select("k1", "k2", "m", "stride", F.explode(F.sequence(first, F.floor(F.col("pos") / F.col("stride")).cast("int"))).alias("w"))
               .distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("m", "stride", "w")).alias("ws")))
    texts = base.join(windows, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    cut = texts.select("k1", "k2", "id", "sh", F.explode("ws").alias("w")).select(
        "k1", "k2", "id", F.col("w.m").alias("m"), (F.col("w.w") * F.col("w.stride")).alias("start"),
        F.slice("sh", F.col("w.w") * F.col("w.stride") + 1, F.col("w.m") + F.col("w.stride")).alias("window"))
    cut = materialize(cut.withColumn("bands", band_keys(F.col("window"))), "license-windows")
    probes = cut.select("k1", "k2", "m", "start", F.posexplode("bands").alias("band", "key"))
    keys = F.broadcast(known.select("template", "m", F.posexplode("bands").alias("band", "key")))
    near = probes.join(keys, ["m", "band", "key"]).select("k1", "k2", "m", "start", "template").distinct()
    full = F.broadcast(known.select("template", "license", "shingles", F.col("m").alias("tm")))
    shared = F.array_intersect("window", "shingles")
    held = (near.join(cut.select("k1", "k2", "id", "m", "start", "window"), ["k1", "k2", "m", "start"]).join(full, "template")
            .withColumn("n", F.size(shared)).where(F.col("n") >= F.ceil(F.col("tm") * contained))
            .withColumn("at", F.col("start") + F.array_min(F.transform("shingles", lambda h: F.nullif(F.array_position("window", h), F.lit(0)))) - 1))
    best = F.max(F.struct("n", (-F.col("start")).alias("s"), (-F.col("at")).alias("a")))
    return (held.groupBy("k1", "k2", "template", "license", "tm").agg(F.first("id").alias("id"), best.alias("best"), F.count("*").alias("windows"))
            .select(F.col("id").alias(id_col), "template", "license", F.round(F.col("best.n") / F.col("tm"), 6).alias("containment"),
                    (-F.col("best.a")).cast("bigint").alias("first_shingle"), "windows"))


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """The same result from containment of every window, without hashing."""
    rows = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(templates))

    def words(col: str) -> str:
        return (f"list_filter(string_split_regex(trim(regexp_replace(regexp_replace(lower({col}), '[^a-z0-9.+-]+', ' ', 'g'), "
                f"'[.-]+( |$)', ' ', 'g')), ' +'), lambda x: x <> '')")

    def shingles(w: str) -> str:
        return (f"CASE WHEN len({w}) >= {SHINGLE} THEN list_transform(generate_series(1, len({w}) - {SHINGLE - 1}), "
                f"lambda i: array_to_string({w}[i:i + {SHINGLE - 1}], ' ')) WHEN len({w}) > 0 THEN [array_to_string({w}, ' ')] ELSE [] END")

    return f"""
WITH t0 AS (SELECT * FROM (VALUES {rows}) v(template, license, text)),
t1 AS (SELECT template, license, {words('text')} AS ws FROM t0),
t2 AS (SELECT template, license, list_distinct({shingles('ws')}) AS sh FROM t1),
t AS (SELECT template, license, sh, len(sh) AS m, greatest(1, len(sh) // 4) AS stride FROM t2),
ts AS (SELECT template, m, stride, unnest(sh) AS h FROM t),
d0 AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
d1 AS (SELECT doc_id, {words('text')} AS ws FROM d0),
d2 AS (SELECT doc_id, {shingles('ws')} AS sh FROM d1),
d AS (SELECT doc_id, unnest(sh) AS h, generate_subscripts(sh, 1) - 1 AS pos FROM d2),
hit AS (SELECT doc_id, template, m, stride, h, pos FROM d JOIN ts USING (h)),
win AS (SELECT *, unnest(generate_series(CAST(greatest(0, ceil((pos - m - stride + 1) / CAST(stride AS DOUBLE))) AS BIGINT),
                                         CAST(pos // stride AS BIGINT))) AS w FROM hit),
c AS (SELECT doc_id, template, m, w * stride AS start, COUNT(DISTINCT h) AS n, MIN(pos) AS place FROM win GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY n DESC, start, place) AS nth,
             COUNT(*) OVER (PARTITION BY doc_id, template) AS windows FROM c WHERE n >= ceil(m * {CONTAINED}))
SELECT k.doc_id, k.template, t.license, ROUND(k.n / CAST(k.m AS DOUBLE), 6) AS containment, CAST(k.place AS BIGINT) AS first_shingle,
       CAST(k.windows AS BIGINT) AS windows
FROM k JOIN t USING (template) WHERE nth = 1"""
