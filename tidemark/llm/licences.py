"""Licence scans: texts against licence notices and whole licences by the Dice coefficient of their word bigrams, natively.

Text is normalised to lower-case ASCII words (A-Z, a-z, 0-9; all else parts words).  What is compared is a set of distinct pairs of
neighbouring words (of a single word, that word).  With c common pairs of a and b, Dice is 2c / (a + b).  Three kinds of piece are judged:

* units: each line, and as number 0 the whole of a text of several lines; of each the best template, if it reaches the threshold.
  At a threshold t only templates with t / (2 - t) * a <= b <= (2 - t) / t * a can reach it; units outside the bounds of all
  templates go before their pairs are made (a unit has fewer words than pairs + 2, and no more different words than different pairs
  + 1).  The rest meet the templates by their pairs, in a broadcast join with a table as large as the template list (checked).
* windows over the words of the whole text, across line ends, for notices that are wrapped or stand amid other sentences.  A template's
  windows have as many words as it has (fewer at the text's end) and begin with one of its pairs; a window that reaches the threshold holds
  t / (2 - t) * b of its pairs at least, and only where so many stand close enough together is it compared.  The
  windows with the most common pairs are taken first (then highest Dice, first template, first start); those that overlap a taken one go.

Of any t / (2 - t) * b pairs of a template one is in any choice of b - t / (2 - t) * b + 1 pairs; of such a choice, that of the
pairs with the longest words, a piece must hold one of these words.  Texts and lines without any go first, before anything is made of them.

Cases: null and empty texts have no piece; ties go to the first template name among units; repeated rows
of one document are reported once; a null doc_id is reported as null; an empty table gives an empty result; extra columns are ignored;
a template of one word has no window.  All windows of a text are found in its own row, whatever its length.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import let
from .words import ascii_lower

THRESHOLD = 0.8
MOST_PAIRS = 1_000_000

# Paragraphs that licences share.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

# Licence notices as projects print them and short licences whole, by SPDX identifier.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", _BSD_GRANT),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD", f"{_BSD_GRANT} 1. {_BSD_SOURCE} 2. {_BSD_BINARY} {_BSD_DISCLAIMER}"),
    ("BSD", f"{_BSD_GRANT} 1. {_BSD_SOURCE} 2. {_BSD_BINARY} 3. {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)


def pairs_of(text: str) -> list[str]:
    """A template's word pairs, as ``word_pairs`` makes them of a column."""
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or set(words))


def word_pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    both = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) < 2, words).otherwise(F.array_distinct(both))


def _whole(lines: Column) -> Column:
    """All words of a text of several lines; of one line nothing, since the line stands for itself."""
    return F.when(F.size(lines) > 1, F.array_remove(F.flatten(lines), "")).otherwise(F.array(F.lit("")))


def telling_words(sets: list[list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold with some template holds one."""
    found = set()
    for pairs in sets:
        least = math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9)
        longest = {p: max(p.split(), key=lambda w: (len(w), w)) for p in pairs}
        chosen = sorted(pairs, key=lambda p: (-len(longest[p]), p))[: len(pairs) - least + 1]
        found |= {longest[p] for p in chosen}
    return sorted(found)


def _normal(text: Column, keep: str = "") -> Column:
    return F.regexp_replace(ascii_lower(text), f"[^a-z0-9{keep}]+", " ")


def scan_units(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line, licence, dice): the best template of each unit that reaches the threshold; line 0 is the whole text."""
    spark = docs.sparkSession
    sets = [(name, number, pairs_of(text)) for number, (name, text) in enumerate(templates)]
    rows = [(name, number, len(pairs), pair) for name, number, pairs in sets for pair in pairs]
    if len(rows) > MOST_PAIRS:
        raise ValueError(f"templates have {len(rows)} word pairs; at most {MOST_PAIRS} are broadcast")
    known = spark.createDataFrame(rows, "licence string, template int, theirs int, pair string")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = min(low * len(p) for _, _, p in sets), max(high * len(p) for _, _, p in sets)
    telling = F.lit(telling_words([p for _, _, p in sets], threshold))
    lines = F.transform(F.split(_normal(F.col("text"), r"\n"), "\n"), lambda x: F.split(F.trim(x), " "))
    u = docs.where(F.arrays_overlap(F.split(_normal(F.col("text")), " "), telling))
    u = u.select(F.col("doc_id").cast("long").alias("doc_id"), lines.alias("lines"))
    u = u.select("doc_id", F.posexplode(F.concat(F.array(_whole(F.col("lines"))), F.col("lines"))).alias("line", "words"))
    u = u.where(F.arrays_overlap("words", telling) & (F.size("words") >= least)).where(F.size(F.array_distinct("words")) <= most + 1)
    u = u.select("doc_id", "line", F.xxhash64("words").alias("unit"), word_pairs(F.col("words")).alias("pairs"))
    u = u.withColumn("ours", F.size("pairs")).where(F.col("ours").between(least, most))
    p = u.select("doc_id", "line", "unit", "ours", F.explode("pairs").alias("pair"))
    met = p.join(F.broadcast(known), "pair").where((F.col("theirs") >= low * F.col("ours")) & (F.col("theirs") <= high * F.col("ours")))
    common = met.groupBy("doc_id", "line", "unit", "ours", "licence", "template", "theirs").agg(F.count_distinct("pair").alias("common"))
    scored = common.withColumn("dice", 2.0 * F.col("common") / (F.col("ours") + F.col("theirs"))).where(F.col("dice") >= threshold)
    first = Window.partitionBy("doc_id", "line", "unit").orderBy(F.desc("dice"), "licence", "template")
    best = scored.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return best.select("doc_id", F.col("line").cast("long").alias("line"), "licence", "dice")


def _quoted(pairs: list[str]) -> str:
    return ", ".join(f"'{p}'" for p in pairs)


def _windows(words: Column, number: int, name: str, text: str, threshold: float) -> Column:
    """A template's windows that reach the threshold, as structs in the order they are taken; column ``hits`` has (pair, at) in order."""
    pairs, n = pairs_of(text), len(re.findall("[a-z0-9]+", text.lower()))
    least = math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9)
    own = F.expr(f"transform(filter(hits, h -> h.pair IN ({_quoted(pairs)})), h -> h.at)")
    theirs = F.split(F.lit(",".join(pairs)), ",")  # a literal once folded

    def scored(at: Column) -> Column:
        size = let(word_pairs(F.slice(words, at + 1, F.lit(n))), lambda m: F.struct(F.size(F.array_intersect(m, theirs)).alias("common"), F.size(m).alias("ours")))
        return let(size, lambda c: ranked(c["common"], c["ours"], at))

    def ranked(common: Column, ours: Column, at: Column) -> Column:
        return F.struct(
            (-common).alias("common"),
            (-2.0 * common / (ours + len(pairs))).alias("loss"),
            F.lit(number).alias("template"),
            at.alias("start"),
            F.least(at + n, F.size(words)).alias("end"),
            F.lit(name).alias("licence"),
        )

    # Hit k begins a window that may do if the hit `least` - 1 places on is in it, too.
    dense = lambda own: F.filter(own, lambda at, k: F.get(own, k + (least - 1)) - at <= n - 2)
    return F.filter(F.transform(let(own, dense), scored), lambda w: w["loss"] <= -threshold)


def _apart(windows: Column) -> Column:
    """Windows in their order, without those that overlap a taken one."""
    none = F.filter(windows, lambda w: F.lit(False))
    free = lambda taken, w: ~F.exists(taken, lambda t: (t["start"] < w["end"]) & (w["start"] < t["end"]))
    return F.aggregate(F.array_sort(windows), none, lambda taken, w: F.when(free(taken, w), F.concat(taken, F.array(w))).otherwise(taken))


def scan_windows(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, end, licence, dice): windows of words that reach the threshold, none of which overlap; words count from 0."""
    many = [(i, name, text) for i, (name, text) in enumerate(templates) if len(re.findall("[a-z0-9]+", text.lower())) > 1]
    telling = F.lit(telling_words([pairs_of(text) for _, _, text in many], threshold))
    known = sorted({pair for _, _, text in many for pair in pairs_of(text)})
    words = F.split(F.trim(_normal(F.col("text"))), " ")
    d = docs.where(F.arrays_overlap(words, telling))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), words.alias("words"))
    two = F.zip_with("words", F.slice("words", F.lit(2), F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b))
    d = d.select("doc_id", "of", "words", F.transform(two, lambda p, i: F.struct(p.alias("pair"), i.alias("at"))).alias("pairs"))
    d = d.select("doc_id", "of", "words", F.expr(f"filter(pairs, h -> h.pair IN ({_quoted(known)}))").alias("hits"))
    found = F.flatten(F.array(*[_windows(F.col("words"), i, name, text, threshold) for i, name, text in many]))
    w = d.select("doc_id", "of", F.explode(let(found, _apart)).alias("w")).select("doc_id", "of", "w.*")
    w = w.dropDuplicates(["doc_id", "of", "start", "end"])
    return w.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "licence", (-F.col("loss")).alias("dice"))


def scan_licences(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line, start, end, licence, dice): units have a line, windows the places of their words."""
    units, windows = scan_units(docs, templates, threshold), scan_windows(docs, templates, threshold)
    nothing = F.lit(None).cast("long")
    units = units.select("doc_id", "line", nothing.alias("start"), nothing.alias("end"), "licence", "dice")
    return units.unionByName(windows.select("doc_id", nothing.alias("line"), "start", "end", "licence", "dice"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_VALUES = ", ".join("('{}', {}, '{}')".format(name, i, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
OP10_SQL = rf"""
WITH l AS (
  SELECT doc_id, string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^a-z0-9\n]+', ' ', 'g'), chr(10)) AS l
  FROM documents),
s AS (SELECT doc_id, unnest(range(0, len(l) + 1)) AS line, l FROM l),
u AS (SELECT doc_id, line, list_filter(string_split(CASE WHEN line > 0 THEN l[line] WHEN len(l) > 1 THEN array_to_string(l, ' ') ELSE '' END, ' '), lambda x: x <> '') AS w FROM s),
t AS (SELECT name, n, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {_VALUES}) v(name, n, text)),
ub AS (SELECT doc_id, line, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS p FROM u WHERE len(w) > 0),
tb AS (SELECT name, n, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS p FROM t),
d AS (SELECT doc_id, line, name, n, 2.0::DOUBLE * len(list_intersect(ub.p, tb.p)) / (len(ub.p) + len(tb.p)) AS dice
      FROM ub JOIN tb ON len(tb.p) >= 0.8 / 1.2 * len(ub.p) AND len(tb.p) <= 1.2 / 0.8 * len(ub.p)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, name, n) AS k FROM d WHERE dice >= 0.8),
wd AS (SELECT doc_id, list_filter(string_split(array_to_string(l, ' '), ' '), lambda x: x <> '') AS w FROM l),
wp AS (SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: {{'p': w[i] || ' ' || w[i + 1], 'pos': i}})) AS x FROM wd),
tp AS (SELECT tb.n, tb.name, len(t.w) AS nw, len(tb.p) AS theirs, unnest(tb.p) AS pair FROM tb JOIN t USING (n) WHERE len(t.w) > 1),
h AS (SELECT doc_id, n, nw, theirs, x.pos AS pos FROM wp JOIN tp ON x.p = pair),
hc AS (SELECT *, count(*) OVER (PARTITION BY doc_id, n ORDER BY pos RANGE BETWEEN CURRENT ROW AND nw - 2 FOLLOWING) AS near FROM h),
c AS (SELECT doc_id, n, pos, hc.nw, least(pos - 1 + hc.nw, len(w)) AS e, w[pos:pos + hc.nw - 1] AS w FROM hc JOIN wd USING (doc_id) WHERE near >= 0.8 / 1.2 * theirs - 1e-9),
cp AS (SELECT c.*, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM c),
cd AS (SELECT doc_id, cp.n, name, pos - 1 AS s, e, len(list_intersect(cp.p, tb.p)) AS common, 2.0::DOUBLE * len(list_intersect(cp.p, tb.p)) / (len(cp.p) + len(tb.p)) AS dice FROM cp JOIN tb USING (n)),
cl AS (SELECT doc_id, list([{{'s': s, 'e': e, 'name': name, 'dice': dice}}] ORDER BY common DESC, dice DESC, n, s) AS l FROM cd WHERE dice >= 0.8 GROUP BY doc_id),
cw AS (SELECT doc_id, unnest(list_reduce(l, lambda taken, x: CASE WHEN len(list_filter(taken, lambda a: a.s < x[1].e AND x[1].s < a.e)) = 0 THEN taken || x ELSE taken END)) AS x FROM cl)
SELECT doc_id, line::BIGINT AS line, NULL::BIGINT AS "start", NULL::BIGINT AS "end", name AS licence, dice FROM r WHERE k = 1
UNION ALL
SELECT doc_id, NULL::BIGINT, x.s::BIGINT, x.e::BIGINT, x.name, x.dice FROM cw
"""
