"""License scans: Dice coefficient of word bigrams against licence templates.

A text, each of its lines, and runs of its lines are units.  A unit is normalised (lower case; what is
neither a letter nor a digit becomes a space) and turned into its set of word
bigrams.  With a and b bigrams, Dice's coefficient 2 c / (a + b) can reach t only
if the smaller number is at least t / (2 - t) of the larger, so templates out of
these bounds are dropped before any overlap is counted.

For whole texts and lines, the bounds are an equi-join: each template is listed under
every size that fits it, a small table that the given templates alone determine.
A run of lines needs t / (2 - t) of the template's bigrams, and so does its document:
only documents with that many are looked into, from each line where a bigram of the
template begins.  The units never leave their row; only the matches are shuffled, to
choose the best of each unit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.license_texts import BSD_2_CLAUSE, BSD_3_CLAUSE, CC0, GPL_3_NOTICE, ISC, UNLICENSE

THRESHOLD = 0.8

# Short licences and notices, as published.  Beginnings of a licence that stand alone as a notice come
# before the full text.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License."""],
    "MIT": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE."""],
    "BSD-2-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED
        BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        BSD_2_CLAUSE],
    "BSD-3-Clause": [BSD_3_CLAUSE],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS.""",
        ISC],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
        """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
        of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
        GPL_3_NOTICE],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                CC0],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  UNLICENSE],
}


def word_list(text: Column) -> Column:
    """Words of the normalised text: lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def bigrams(words: Column) -> Column:
    """Hashes of the distinct pairs of neighbouring words (none for fewer than two words)."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.xxhash64(a, b)))


def _once(value: Column) -> Column:
    """A row's value through a one-element array: the optimizer then keeps it, and doesn't work it out wherever it is used."""
    return F.explode(F.array(value))


def _templates(spark: SparkSession, templates: dict[str, list[str]], least: float) -> DataFrame:
    """``(n, license, template, known)``: each template once for every unit size n that could match it.

    A few rows per bigram of the given templates, whatever the size of the corpus.
    """
    rows = [(name, i, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    known = spark.createDataFrame(rows, "license string, template int, text string") \
        .select("license", "template", bigrams(word_list(F.col("text"))).alias("known")).filter(F.size("known") > 0)
    size = F.size("known")
    fits = F.sequence(F.ceil(least * size - 1e-9).cast("int"), F.floor(size / least + 1e-9).cast("int"))
    return known.select(F.explode(fits).alias("n"), "license", "template", "known")


def _runs(docs: DataFrame, known: DataFrame, threshold: float, least: float) -> DataFrame:
    """``doc_id, text_key, first, last, license, template, dice, size``: of the runs of lines that begin at a line, the best one.

    A run is two or more lines, not counting those without words; its first line has the beginning
    of a bigram of the template, and it has at most twice as many words as the largest
    matching unit has bigrams.  ``docs``: doc_id, text_key, lines.
    """
    rows = known.agg(F.array_distinct(F.flatten(F.collect_list("known"))).alias("every"),
                     F.min(F.ceil(least * F.size("known") - 1e-9)).alias("fewest"))
    words = F.flatten("lines")
    pairs = F.zip_with(F.slice(words, F.lit(1), n := F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), n),
                       lambda a, b: F.xxhash64(a, b))
    held = docs.filter(F.size("lines") > 1).select("doc_id", "text_key", "lines", _once(pairs).alias("pairs")) \
        .crossJoin(F.broadcast(rows)) \
        .select("doc_id", "text_key", "lines", "pairs", "fewest", _once(F.array_intersect("every", "pairs")).alias("held")) \
        .filter(F.size("held") >= F.col("fewest"))
    # the line of each word, and the places where lines begin
    of_word = F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.size(x))))
    new_line = F.filter(F.sequence(F.lit(0), F.size("of_word") - 1), lambda p: (p == 0) | (
        F.get("of_word", p) != F.get("of_word", F.greatest(p - 1, F.lit(0)))))
    placed = held.select("doc_id", "text_key", "pairs", "held", _once(of_word).alias("of_word")) \
        .select("doc_id", "text_key", "pairs", "held", "of_word", _once(F.concat(new_line, F.array(F.size("of_word")))).alias("begin"))
    need, bound = F.ceil(least * F.size("known") - 1e-9), 2 * F.floor(F.size("known") / least + 1e-9).cast("int")
    fits = placed.crossJoin(F.broadcast(known.select("license", "template", "known"))) \
        .filter(F.size(F.array_intersect("known", "held")) >= need) \
        .select("*", bound.alias("bound"), F.array_intersect("known", "held").alias("shared"))
    starts = fits.select("*", F.posexplode("begin").alias("k", "at")).filter(F.col("k") < F.size("begin") - 2) \
        .filter(F.arrays_overlap("shared", F.slice("pairs", F.col("at") + 1, F.get("begin", F.col("k") + 1) - F.col("at")))) \
        .select("doc_id", "text_key", "license", "template", "known", "of_word", "at",
                F.slice("pairs", F.col("at") + 1, F.col("bound")).alias("window"),
                F.filter(F.slice("begin", F.col("k") + 3, F.col("bound")), lambda e: e - F.col("at") <= F.col("bound")).alias("ends")) \
        .filter(F.size(F.array_intersect("known", "window")) >= need)

    def judged(end: Column) -> Column:
        own = F.array_distinct(F.slice("window", F.lit(1), end - F.col("at") - 1))
        return F.struct((2 * F.size(F.array_intersect(own, "known")) / (F.size(own) + F.size("known"))).alias("dice"), (-end).alias("end"))

    best = starts.select("*", _once(F.array_max(F.transform("ends", judged))).alias("best")).filter(F.col("best.dice") >= threshold)
    return best.select("doc_id", "text_key", F.get("of_word", F.col("at")).alias("first"), F.get("of_word", -F.col("best.end") - 1).alias("last"),
                       "license", "template", "best.dice", F.size("known").alias("size"))


def _chosen(units: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, line, license, template, dice``: all whole texts and lines, and the runs that no better unit overlaps.

    A run goes if a line in it is as good, or if the whole text matches a template that has
    half of the run's template.  Of overlapping runs, the best stays (then that of the largest template).
    """
    a, b = (known.select(*(F.col(c).alias(f"{c}_{s}") for c in ("license", "template", "known"))) for s in "ab")
    parts = a.crossJoin(b).filter(2 * F.size(F.array_intersect("known_a", "known_b")) >= F.size("known_a")) \
        .groupBy("license_a", "template_a").agg(F.collect_list(F.struct("license_b", "template_b")).alias("within"))
    unit = F.struct("dice", "size", (F.col("first") - F.col("last")).alias("less"), (-F.col("first")).alias("before"), "first", "last",
                    "license", "template", "within")
    listed = units.join(F.broadcast(parts), (F.col("license") == F.col("license_a")) & (F.col("template") == F.col("template_a")), "left") \
        .groupBy("doc_id", "text_key").agg(
        F.collect_list(F.when(F.col("first") == F.col("last"), unit)).alias("lines"),
        F.reverse(F.array_sort(F.collect_list(F.when(F.col("first") < F.col("last"), unit)))).alias("runs"))
    free = F.filter("runs", lambda r: ~F.exists("lines", lambda x: F.when(
        x["first"] < 0, F.exists(r["within"], lambda w: (w["license_b"] == x["license"]) & (w["template_b"] == x["template"]))).otherwise(
        (x["first"] >= r["first"]) & (x["first"] <= r["last"]) & (x["dice"] >= r["dice"]))))
    apart = F.aggregate("free", F.slice("free", 1, 0), lambda done, r: F.when(
        F.exists(done, lambda x: (x["first"] <= r["last"]) & (r["first"] <= x["last"])), done).otherwise(F.concat(done, F.array(r))))
    return listed.select("doc_id", "lines", _once(free).alias("free")) \
        .select("doc_id", F.explode(F.concat("lines", apart)).alias("x")) \
        .select("doc_id", F.col("x.first").alias("line"), "x.license", "x.template", "x.dice")


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, list[str]] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit that a template matches: ``doc_id, line, license, template, dice``.

    ``line`` is the number of the unit's first line (from 0), or -1 for the whole text of more than
    one line.  A unit has its best template: the largest coefficient, then the
    last by (license, template).  Whole texts and lines always count; a run of lines (a notice
    wrapped over several) counts if no line in it and no run that overlaps it is better, and if it isn't a
    part of the licence that the whole text is.  Of units that begin at one line, the best has the row.

    Defined cases: null and empty texts and units of fewer than two words match
    nothing; rows with a null id and repeated rows are scanned like any others (rows
    that are equal give one row per unit); an empty table or no templates give no
    rows; other columns are ignored.
    """
    least = threshold / (2 - threshold)
    known = _templates(docs.sparkSession, TEMPLATES if templates is None else templates, least)
    each = known.dropDuplicates(["license", "template"])
    most = max((row[0] for row in known.agg(F.max("n")).collect() if row[0]), default=0)
    lines = F.transform(F.split(text := F.coalesce(F.col(text_col), F.lit("")), "\n"), word_list)
    several = F.size("lines") > 1
    texts = docs.filter(text != "").select(F.col(id_col).alias("doc_id"), _once(lines).alias("lines")) \
        .select("doc_id", _once(F.xxhash64("lines")).alias("text_key"), "lines")
    units = texts.select(
        "doc_id", "text_key", F.when(several, -1).otherwise(0).alias("first"),
        F.posexplode(F.when(several, F.concat(F.array(F.flatten("lines")), F.col("lines"))).otherwise(F.col("lines"))).alias("at", "words"))
    # more bigrams in a unit's beginning than any template allows: it is out, whatever follows
    begin = bigrams(F.slice("words", F.lit(1), F.lit(2 * most + 2)))
    grams = units.filter(F.size("words") > 1) \
        .select("doc_id", "text_key", (F.col("at") + F.col("first")).alias("line"), "words", _once(begin).alias("begin")) \
        .filter(F.size("begin") <= most) \
        .select("doc_id", "text_key", "line",
                _once(F.when(F.size("words") <= 2 * most + 2, F.col("begin")).otherwise(bigrams(F.col("words")))).alias("grams"))
    both = F.size(F.array_intersect("grams", "known"))
    single = grams.join(F.broadcast(known), F.size("grams") == F.col("n")) \
        .select("doc_id", "text_key", F.col("line").alias("first"), F.col("line").alias("last"), "license", "template",
                (2 * both / (F.size("grams") + F.size("known"))).alias("dice"), F.size("known").alias("size")) \
        .filter(F.col("dice") >= threshold)
    return _chosen(single.unionByName(_runs(texts, each, threshold, least)), each) \
        .groupBy("doc_id", "line").agg(F.max(F.struct("dice", "license", "template")).alias("best")) \
        .select("doc_id", "line", "best.license", "best.template", "best.dice")


def template_rows_sql(templates: dict[str, list[str]] = TEMPLATES) -> str:
    """The templates as an SQL VALUES list, for the oracle."""
    rows = [(name, i, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    return reduce(lambda a, b: f"{a}, {b}", (f"('{n}', {i}, '{t.replace(chr(39), chr(39) * 2)}')" for n, i, t in rows))
