"""License scans with DataFrame functions only: lines against licence templates by the Dice coefficient of word bigrams.

A text's lines are normalised (lower case, runs of ASCII characters other than letters and digits to one space) and cut into distinct word bigrams. A line of n bigrams can reach the threshold d only with templates of n d / (2 - d) to
n (2 - d) / d of them; other templates, and lines no template fits, are never compared. Nor are texts and lines without
any of a few words that every such line must have. Of what is left, bigrams meet the templates' in one equi-join with a
small fixed table, and shared ones are counted for each line and template.

The query also compares runs of words, across line breaks and inside longer lines: for each template the runs that begin and
end in one of its bigrams, up to the longest admissible. Of a run, template bigrams count once, others as often as they stand.
Of overlapping matches of one template only the best is kept (from left to right), at the line where it begins.

Null and empty texts match nothing. Rows with equal doc_id and text count once. Empty tables give no rows. A line of one
word has that word as its only "bigram". Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Licence notices as they stand in texts and source files (fixed values; well-known public wordings).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
_BSD = TEMPLATES["BSD-2-Clause"] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {}"
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Whole licence texts, which the query looks for beside the notices.
TEXTS = {
    "BSD-2-Clause-text": _BSD.format("") + _BSD_END,
    "BSD-3-Clause-text": _BSD.format(_BSD_THIRD) + _BSD_END,
    "ISC-text": TEMPLATES["ISC"] + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT-text": TEMPLATES["MIT-grant"] + ', including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
}
THRESHOLD = 0.8


def _words(line: Column) -> Column:
    """Normalised words: lower case, cut at ASCII characters that are neither letters nor digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(line), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " ", -1), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """Distinct bigrams; the words are bound first, as a lambda would evaluate their expression for each element."""

    def of(ws: Column) -> Column:
        pairs = F.transform(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(ws, i), w))
        return F.array_distinct(F.when(F.size(ws) == 1, ws).otherwise(pairs))

    return F.transform(F.array(words), of)[0]


def anchors(told: dict[str, str], threshold: float) -> list[str]:
    """Words of which a line has at least one, as part of its text, if it reaches ``threshold`` with any template.

    Such a line shares at least d / (2 - d) of a template's bigrams; so it has one of any set of more than the rest, and with it
    a word of it. Words are taken greedily, long ones far before short ones, which stand in most texts.
    """
    open_ = []
    for notice in told.values():
        ws = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", notice.lower()).split()
        grams = set(zip(ws, ws[1:], strict=False)) if len(ws) > 1 else {tuple(ws)}
        open_.append([grams, len(grams) * (1 - threshold / (2 - threshold))])
    chosen: list[str] = []
    while open_:
        words = sorted({w for grams, _ in open_ for g in grams for w in g})
        best = max(words, key=lambda w: sum(min(sum(any(w in x for x in g) for g in grams), need + 1) / (need + 1) for grams, need in open_) * len(w) ** 4)
        chosen.append(best)
        for x in open_:
            touched = {g for g in x[0] if any(best in w for w in g)}
            x[0] -= touched
            x[1] -= len(touched)
        open_ = [x for x in open_ if x[1] >= 0]  # covered once more than the rest is touched
    return [w for w in chosen if not any(o != w and o in w for o in chosen)]


def templates(spark: SparkSession, told: dict[str, str] | None = None) -> DataFrame:
    """license, bigram, size: one row for each distinct bigram of each template. ``told`` is a fixed table of notices."""
    rows = spark.createDataFrame(sorted((told or TEMPLATES).items()), "license string, notice string")
    grams = rows.select("license", _words(F.col("notice")).alias("w")).select("license", _bigrams(F.col("w")).alias("g"))
    return grams.select("license", F.size("g").alias("size"), F.explode("g").alias("bigram"))


def _near(text: Column, words: list[str]) -> Column:  # lower-cased once, then searched
    return F.exists(F.array(F.lower(text)), lambda t: reduce(or_, (t.contains(w) for w in words)))


def _lines(docs: DataFrame, told: dict[str, str] | None, threshold: float) -> DataFrame:
    """doc_id, row (md5 of the text), line, license, dice of every line and template that reach ``threshold``."""
    spark = docs.sparkSession
    told = told or TEMPLATES
    known = templates(spark, told)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # no more than there are templates
    least, most = int(min(sizes) * low), int(max(sizes) * high) + 1
    words = anchors(told, threshold)

    whole = docs.select("doc_id", "text").where(_near(F.col("text"), words))
    lines = whole.select("doc_id", F.md5("text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("line", "body")).where(_near(F.col("body"), words))

    def fitting(g: Column) -> Column:  # a line's bigrams, each with their number, or none if no template can fit
        return F.when(F.size(g).between(least, most), F.transform(g, lambda x: F.struct(F.size(g).alias("n"), x.alias("bigram"))))

    grams = lines.select("doc_id", "row", "line", F.inline(F.transform(F.array(_bigrams(_words(F.col("body")))), fitting)[0]))
    # bounded by the fixed table of notices, a few hundred bigrams
    met = grams.join(F.broadcast(known), "bigram")
    met = met.where((F.col("size") >= F.col("n") * low) & (F.col("size") <= F.col("n") * high))
    shared = met.groupBy("doc_id", "row", "line", "license", "n", "size").agg(F.count_distinct("bigram").alias("shared"))
    scored = shared.select("doc_id", "row", F.col("line").cast("long").alias("line"), "license", F.round(2.0 * F.col("shared") / (F.col("n") + F.col("size")), 6).alias("dice"))
    return scored.where(F.col("dice") >= threshold)


def scan(docs: DataFrame, told: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, line (from 0), license, dice of every line and template that reach ``threshold``."""
    return _lines(docs, told, threshold).drop("row")


def _placed(line: Column, at: Column) -> Column:
    return F.shiftleft(line.cast("long"), 32) + at


def _runs(docs: DataFrame, told: dict[str, str], threshold: float) -> DataFrame:
    """doc_id, row, license, at, to, dice: the best run of words from each bigram of a template that reaches ``threshold``.

    ``at`` and ``to`` are places of the first and last word: line * 2^32 + word of the line.
    """
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    known = templates(docs.sparkSession, told)
    whole = docs.select("doc_id", "text").where(_near(F.col("text"), anchors(told, threshold)))
    words = F.flatten(F.transform(F.split("text", "\n", -1), lambda x, k: F.transform(_words(x), lambda w, i: F.struct(w.alias("w"), _placed(k, i).alias("at")))))

    def pairs(ws: Column) -> Column:
        then = F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0)))
        return F.transform(then, lambda x, i: F.struct(F.concat_ws(" ", F.get(ws, i)["w"], x["w"]).alias("bigram"), i.alias("pos"), F.get(ws, i)["at"].alias("at"), x["at"].alias("to")))

    grams = whole.select("doc_id", F.md5("text").alias("row"), F.inline(F.transform(F.array(words), pairs)[0]))
    met = grams.join(F.broadcast(known), "bigram")  # the fixed table of notices and texts
    key = ["doc_id", "row", "license", "size"]
    each = met.groupBy(*key, "bigram").agg(F.array_sort(F.collect_set(F.struct("pos", "at", "to"))).alias("p"))
    # with each place, the one before that has the same bigram
    each = each.withColumn("p", F.transform("p", lambda x, i: F.struct(x["pos"].alias("pos"), x["at"].alias("at"), x["to"].alias("to"), F.when(i > 0, F.get("p", i - 1)["pos"]).otherwise(-1).alias("before"))))
    hits = each.groupBy(*key).agg(F.count("*").alias("kinds"), F.array_sort(F.flatten(F.collect_list("p"))).alias("hits"))
    need, most = F.ceil(F.col("size") * low - 1e-9).cast("int"), F.floor(F.col("size") * high + 1e-9).cast("int")
    hits = hits.withColumns({"need": need, "most": most}).where("kinds >= need")

    def best(x: Column, i: Column) -> Column:  # over the ends of runs from x
        def step(s: Column, y: Column) -> Column:
            kinds = s["kinds"] + F.when(y["before"] < x["pos"], 1).otherwise(0)
            seen = s["seen"] + 1
            foreign = y["pos"] - x["pos"] + 1 - seen
            dice = F.round(2.0 * kinds / (foreign + kinds + F.col("size")), 6)
            better = dice > s["dice"]
            return F.struct(
                kinds.alias("kinds"), seen.alias("seen"), F.when(better, dice).otherwise(s["dice"]).alias("dice"), F.when(better, y["to"]).otherwise(s["to"]).alias("to")
            )

        ends = F.filter(F.slice("hits", i + 1, F.col("most")), lambda y: y["pos"] < x["pos"] + F.col("most"))
        start = F.struct(F.lit(0).alias("kinds"), F.lit(0).alias("seen"), F.lit(0.0).alias("dice"), F.lit(0).cast("long").alias("to"))
        found = F.aggregate(ends, start, step, lambda s: F.struct(x["at"].alias("at"), s["to"].alias("to"), s["dice"].alias("dice")))
        enough = F.get("hits", i + F.col("need") - 1)["pos"] < x["pos"] + F.col("most")
        return F.when(enough, found)

    return hits.select("doc_id", "row", "license", F.explode(F.transform("hits", best)).alias("m")).select("doc_id", "row", "license", "m.*").where(F.col("dice") >= threshold)


def scan_text(docs: DataFrame, told: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row, line (where it begins), license, dice of every match, be it a line, a part of one or a run over several."""
    told = told or TEMPLATES | TEXTS
    line = F.col("line")
    lines = _lines(docs, told, threshold).select("doc_id", "row", "license", _placed(line, F.lit(0)).alias("at"), _placed(line, F.lit((1 << 32) - 1)).alias("to"), "dice")
    every = lines.unionByName(_runs(docs, told, threshold)).groupBy("doc_id", "row", "license").agg(F.array_sort(F.collect_set(F.struct("at", "to", "dice"))).alias("m"))

    def step(kept: Column, x: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        apart = (F.size(kept) == 0) | (x["at"] > last["to"])
        return F.when(apart, F.concat(kept, F.array(x))).when(x["dice"] > last["dice"], F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(x))).otherwise(kept)

    kept = F.aggregate("m", F.array().cast("array<struct<at:long,to:long,dice:double>>"), step)
    return every.select("doc_id", "row", "license", F.explode(kept).alias("m")).select("doc_id", "row", F.shiftright("m.at", 32).alias("line"), "license", "m.dice")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """Each document's licences, with the first line where it begins, on how many lines it does and the best coefficient."""
    found = scan_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.groupBy("doc_id", "license").agg(F.min("line").alias("first_line"), F.count_distinct("row", "line").alias("n_lines"), F.max("dice").alias("dice"))


def _sql() -> str:
    """The scan as nested loops: every run of each template from one of its bigrams to another, and every line."""
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted((TEMPLATES | TEXTS).items()))
    words = r"list_filter(string_split(regexp_replace(lower({}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = "list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])) END)"
    low, high, place = f"{THRESHOLD} / (2 - {THRESHOLD})", f"(2 - {THRESHOLD}) / {THRESHOLD}", 1 << 32
    return f"""
WITH RECURSIVE t AS (
  SELECT license, len(g) AS size, g FROM (
    SELECT license, {grams} AS g FROM (SELECT license, {words.format("notice")} AS w FROM (VALUES {rows}) v(license, notice)) x) y
), d AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL) x
), l AS (
  SELECT r, doc_id, line, {words.format("body")} AS w FROM (
    SELECT r, doc_id, unnest(range(len(s))) AS line, unnest(s) AS body FROM (SELECT r, doc_id, string_split(text, chr(10)) AS s FROM d) x) y
), lines AS (
  SELECT r, doc_id, license, line * {place} AS a, line * {place} + {place - 1} AS b, round(2.0 * len(list_intersect(g.g, t.g)) / (len(g.g) + t.size), 6) AS dice
  FROM (SELECT r, doc_id, line, {grams} AS g FROM l WHERE len(w) > 0) g JOIN t ON t.size >= len(g.g) * {low} AND t.size <= len(g.g) * {high}
), w AS (
  SELECT r, doc_id, word, line * {place} + i AS place, row_number() OVER (PARTITION BY r ORDER BY line, i) AS pos
  FROM (SELECT r, doc_id, line, unnest(range(len(w))) AS i, unnest(w) AS word FROM l) x
), p AS (
  SELECT r, doc_id, pos, place AS a, lead(place) OVER n AS b, concat(word, ' ', lead(word) OVER n) AS bigram, lead(word) OVER n IS NOT NULL AS whole FROM w WINDOW n AS (PARTITION BY r ORDER BY pos)
), h AS (
  SELECT p.*, license, size, coalesce(lag(pos) OVER (PARTITION BY r, license, p.bigram ORDER BY pos), 0) AS before
  FROM p JOIN (SELECT license, size, unnest(g) AS bigram FROM t) k ON p.bigram = k.bigram WHERE whole
), able AS (
  SELECT r, license FROM h GROUP BY r, license, size HAVING count(DISTINCT bigram) >= ceil(size * {low} - 1e-9)
), e AS (
  SELECT x.r, x.doc_id, x.license, x.pos AS first, x.a, y.b, y.pos AS last, x.size, row_number() OVER n AS seen, sum(CASE WHEN y.before < x.pos THEN 1 ELSE 0 END) OVER n AS kinds
  FROM h x JOIN able USING (r, license) JOIN h y ON x.r = y.r AND x.license = y.license AND y.pos BETWEEN x.pos AND x.pos + floor(x.size * {high} + 1e-9) - 1
  WINDOW n AS (PARTITION BY x.r, x.license, x.pos ORDER BY y.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), runs AS (
  SELECT r, doc_id, license, a, b, dice FROM (SELECT *, round(2.0 * kinds / (last - first + 1 - seen + kinds + size), 6) AS dice FROM e) x
  QUALIFY row_number() OVER (PARTITION BY r, license, first ORDER BY dice DESC, last) = 1
), m AS (
  SELECT *, row_number() OVER (PARTITION BY r, license ORDER BY a, b, dice) AS n
  FROM (SELECT * FROM lines WHERE dice >= {THRESHOLD} UNION SELECT * FROM runs WHERE dice >= {THRESHOLD}) x
), kept AS (
  SELECT r, doc_id, license, n, 1 AS chain, a, b, dice FROM m WHERE n = 1
  UNION ALL
  SELECT m.r, m.doc_id, m.license, m.n, chain + CASE WHEN m.a > k.b THEN 1 ELSE 0 END, CASE WHEN m.a > k.b OR m.dice > k.dice THEN m.a ELSE k.a END,
         CASE WHEN m.a > k.b OR m.dice > k.dice THEN m.b ELSE k.b END, CASE WHEN m.a > k.b OR m.dice > k.dice THEN m.dice ELSE k.dice END
  FROM kept k JOIN m ON m.r = k.r AND m.license = k.license AND m.n = k.n + 1
), best AS (
  SELECT r, doc_id, license, a // {place} AS line, dice FROM kept QUALIFY row_number() OVER (PARTITION BY r, license, chain ORDER BY n DESC) = 1
)
SELECT doc_id, license, min(line) AS first_line, count(DISTINCT concat(r, '.', line)) AS n_lines, max(dice) AS dice FROM best GROUP BY doc_id, license
"""


SQL_OP2 = _sql()
