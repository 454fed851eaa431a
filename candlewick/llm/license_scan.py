"""Licence texts and notices: Dice coefficient of word bigrams against templates.

Units of a text are its lines, its paragraphs of several lines, the whole of a text of several
paragraphs, and windows as long as a template, which find a notice wherever it stands in a longer line.  A unit of
n distinct bigrams and a template of m reach the coefficient t only if they share t / (2 - t) of the larger
number.  So the smaller number is at least that part of the larger one, and of any set of template bigrams larger than
the rest the unit has at least one.  Each template has such a set, its anchors: texts without an anchor are dropped before their
units are listed, a window starts where an anchor puts the start of its template, and other units are compared
with the templates whose size fits.

All of it is DataFrame expressions within the row; only hits are shuffled.  The templates are an argument and stand in
the plan as literals, so they are as many as the caller passes.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_or_empty

THRESHOLD = 0.8

# --- fixed values: names of licences, forms of notices, and texts as their licensors word them ---

#: What a licence is called after "under".
NAMES: dict[str, list[str]] = {
    "MIT": ["the MIT License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GPLv3"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "EPL-2.0": ["the Eclipse Public License 2.0"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "ISC": ["the ISC License"],
    "Zlib": ["the zlib License"],
    "Unlicense": ["the Unlicense"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": [
        "CC BY-NC-SA 4.0",
        "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ],
    "CC-BY-NC-ND-4.0": [
        "CC BY-NC-ND 4.0",
        "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    ],
    "CC0-1.0": ["CC0 1.0 Universal"],
}

FORMS = [
    "Licensed under {}",
    "Released under {}",
    "Distributed under {}",
    "Available under {}",
    "This project is licensed under {}",
    "This work is licensed under {}",
    "This software is licensed under {}",
]

TAG = "SPDX-License-Identifier: {}"

MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the Software), to deal in the Software without restriction, including without limitation the"
    " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
    " permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
    " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
    " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
    " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:"
)
BSD_CONDITIONS = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)
BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
    " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies."
)
ISC_REST = (
    "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
    " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
    " PERFORMANCE OF THIS SOFTWARE."
)
GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published"
    " by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)

#: Full texts, and notices worded otherwise than the forms.
TEXTS: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0."
        " Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See"
        " the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [MIT_GRANT, f"{MIT_GRANT} {MIT_REST}"],
    "GPL-2.0": [GPL_NOTICE.format("General Public License", "2")],
    "GPL-3.0": [GPL_NOTICE.format("General Public License", "3")],
    "LGPL-2.1": [GPL_NOTICE.format("Lesser General Public License", "2.1")],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        GPL_NOTICE.format("Lesser General Public License", "3"),
    ],
    "AGPL-3.0": [GPL_NOTICE.format("Affero General Public License", "3")],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD-2-Clause": [f"{BSD_GRANT} {BSD_CONDITIONS} {BSD_REST}"],
    "BSD-3-Clause": [
        BSD_GRANT,
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        f"{BSD_GRANT} {BSD_CONDITIONS} {BSD_THIRD} {BSD_REST}",
    ],
    "ISC": [ISC_GRANT, f"{ISC_GRANT} {ISC_REST}"],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
}

# --- end of the fixed values ---------------------------------------------------------

TEMPLATES: dict[str, list[str]] = {
    license: [form.format(name) for name in names for form in FORMS] + [TAG.format(license)] + TEXTS.get(license, [])
    for license, names in NAMES.items()
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def word_pairs(words: Sequence[str]) -> list[str]:
    return [" ".join(pair) for pair in zip(words, words[1:])]


class Template(NamedTuple):
    license: str
    words: list[str]
    bigrams: list[str]  # distinct


def compiled(templates: Mapping[str, Sequence[str]]) -> list[Template]:
    """By licence, then in the given order; texts of fewer than two words, and repeated ones, are left out."""
    parts = [(name, template_words(text)) for name in sorted(templates) for text in dict.fromkeys(templates[name])]
    return [Template(name, words, sorted(set(word_pairs(words)))) for name, words in parts if len(words) > 1]


def anchors(known: Sequence[Template], threshold: float = THRESHOLD) -> dict[str, list[tuple[int, int]]]:
    """Bigrams of which every unit that reaches the threshold with a template has one: where each stands in which template.

    Such a unit shares at least t / (2 - t) of the template's bigrams, so it has one of any set larger than the
    rest; those of the fewest licences are taken, longer ones first.
    """
    spread: dict[str, set[str]] = {}
    for t in known:
        for g in t.bigrams:
            spread.setdefault(g, set()).add(t.license)
    places: dict[str, list[tuple[int, int]]] = {}
    for number, t in enumerate(known):
        missing = math.floor(len(t.bigrams) * (1 - threshold / (2 - threshold)) + 1e-9)
        ordered = sorted(t.bigrams, key=lambda g: (len(spread[g]), -len(g), g))
        chosen = set(ordered[: missing + 1])
        for at, g in enumerate(word_pairs(t.words)):
            if g in chosen:
                places.setdefault(g, []).append((number, at))
    return places


def read_templates(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Each ``.txt`` file of a folder as a full text, named by the file; for :func:`find` beside or instead of ``TEMPLATES``."""
    files = spark.read.text(f"{folder}/*.txt", wholetext=True).select(F.input_file_name().alias("path"), "value")
    name = F.regexp_extract(F.url_decode("path"), r"([^/]+)\.txt$", 1)
    return {r["name"]: [r["value"]] for r in files.select(name.alias("name"), "value").collect()}


def _constant(value: list | dict, kind: str) -> Column:
    """A literal of any type, which the optimizer evaluates once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _words(c: Column) -> Column:
    return F.array_remove(F.split(c, " "), "")


def _joined_hits(hits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of hits of one kind that overlap in a row, the best; ``start`` and ``end`` are in words or unit numbers."""
    order = Window.partitionBy("key", "row", "unit", *by).orderBy("start", "end", "license")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("opens", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fields = ["license", "shared", "n_bigrams", "n_template", "dice", "start", "end"]
    rank = F.struct((-F.col("dice")).alias("a"), (-F.col("n_template")).alias("b"), F.col("template").alias("c"), F.col("start").alias("d"))
    best = runs.groupBy("key", "row", "unit", *by, "run").agg(F.min(F.struct(rank.alias("rank"), F.struct("template", *fields).alias("h"))).alias("m"))
    return best.select("key", "row", "unit", "m.h.*")


def find(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row for each unit that reaches the threshold, with its best licence.

    Columns: the key, ``unit`` (line, paragraph, document or window), ``unit_no`` (from 0, within its kind; the first word of
    a window), ``license``, ``shared``, ``n_bigrams``, ``n_template`` and ``dice``.  Of equally good templates the larger, then the
    first by licence and order stays; of overlapping windows the best.  A notice that fills a line is found as a line and as a window.
    A null or empty text has no units; an empty table gives no rows; repeated rows give repeated results; other columns play no part.
    """
    known = compiled(templates)
    if not known:
        raise ValueError("no template of two words or more")
    places = anchors(known, threshold)
    sizes = [len(t.bigrams) for t in known]
    ratio = threshold / (2 - threshold)

    # Each step is a column that the next refers to more than once, and rows are dropped by generators over null
    # arrays: a filter would be pushed below and compute the texts again.
    plain = F.lower(F.regexp_replace(text_or_empty(docs[text]), r"[^\p{L}\p{N}\n]+", " "))
    rows = docs.select(docs[key].alias("key"), F.monotonically_increasing_id().alias("row"), plain.alias("plain"))
    worded = rows.select("key", "row", "plain", _words(F.translate("plain", "\n", " ")).alias("words"))
    firsts = sorted({g.split()[0] for g in places})
    at = F.transform(
        "words",
        lambda w, i: F.when(w.isin(firsts) & F.concat(w, F.lit(" "), F.get("words", i + 1)).isin(list(places)), i),
    )
    anchored = worded.select("key", "row", "plain", "words", F.array_compact(at).alias("at"))
    some = F.when(F.size("at") > 0, F.array(F.struct("plain", "words", "at")))
    kept = anchored.select("key", "row", F.inline(some))

    # A window is where an anchor puts its template: the start and the template in one number.
    n = len(known)
    starts = _constant({g: [{"t": t, "o": o} for t, o in spots] for g, spots in places.items()}, "map<string,array<struct<t:int,o:int>>>")
    shifted = F.transform(
        "at",
        lambda i: F.transform(
            F.element_at(starts, F.concat(F.get("words", i), F.lit(" "), F.get("words", i + 1))),
            lambda s: F.greatest(i - s["o"], F.lit(0)).cast("bigint") * n + s["t"],
        ),
    )
    lengths = _constant([len(t.words) for t in known], "array<int>")
    parted = kept.select(
        "key",
        "row",
        "plain",
        "words",
        F.array_distinct(F.flatten(shifted)).alias("windows"),
        F.split("plain", "\n").alias("lines"),
        F.split("plain", r"\n *\n").alias("paragraphs"),
    )

    def unit(kind: str, number: Column, body: Column, only: Column | None = None) -> Column:
        only = F.lit(None).cast("int") if only is None else only
        return F.struct(F.lit(kind).alias("unit"), number.cast("int").alias("unit_no"), body.alias("body"), only.alias("only"))

    def window(w: Column) -> Column:
        start, number = F.floor(w / n).cast("int"), F.pmod(w, F.lit(n)).cast("int")
        return unit("window", start, F.slice("words", start + 1, F.get(lengths, number)), number)

    nothing = F.array().cast("array<struct<unit:string,unit_no:int,body:array<string>,only:int>>")
    blocks = F.filter(
        F.transform("paragraphs", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"].contains("\n")
    )
    units = F.concat(
        F.transform("lines", lambda x, i: unit("line", i, _words(x))),
        F.transform(blocks, lambda p: unit("paragraph", p["i"], _words(F.translate(p["x"], "\n", " ")))),
        F.when(F.size("paragraphs") > 1, F.array(unit("document", F.lit(0), F.col("words")))).otherwise(nothing),
        F.transform("windows", window),
    )
    listed = parted.select("key", "row", F.inline(units))
    n_words = F.size("body")
    pairs = F.zip_with(
        F.slice("body", F.lit(1), n_words - 1),
        F.slice("body", F.lit(2), n_words - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    # Distinct bigrams are fewer than the words.
    grams = F.when(n_words > max(1, ratio * min(sizes)), F.array_distinct(pairs))
    counted = listed.select("key", "row", "unit", "unit_no", "only", grams.alias("grams"))
    # Windows have an anchor; other units may not.
    able = F.size("grams").between(ratio * min(sizes), max(sizes) / ratio) & (
        F.col("only").isNotNull() | F.exists("grams", lambda g: g.isin(list(places)))
    )
    fit = counted.select("key", "row", "unit", "unit_no", F.inline(F.when(able, F.array(F.struct("only", "grams")))))
    table = _constant(
        [{"t": i, "m": len(t.bigrams), "g": t.bigrams} for i, t in enumerate(known)],
        "array<struct<t:int,m:int,g:array<string>>>",
    )
    size = F.size("grams")
    rivals = F.filter(
        F.when(F.col("only").isNull(), table).otherwise(F.array(F.get(table, F.col("only")))),
        lambda k: (size >= k["m"] * ratio) & (size * ratio <= k["m"]),
    )
    shared = F.transform(
        rivals,
        lambda k: F.struct(k["t"].alias("t"), k["m"].alias("m"), F.size(F.array_intersect("grams", k["g"])).alias("s")),
    )
    ranked = F.transform(
        shared,
        lambda x: F.struct(
            (-F.round(2 * x["s"] / (size + x["m"]), 6)).alias("worst"),
            (-x["m"]).alias("m"),
            x["t"].alias("t"),
            x["s"].alias("s"),
        ),
    )
    scored = fit.select("key", "row", "unit", "unit_no", size.alias("n_bigrams"), F.array_min(ranked).alias("best"))
    reached = F.when(F.col("best.worst") <= -threshold, F.array("best"))
    hits = scored.select("key", "row", "unit", "unit_no", "n_bigrams", F.inline(reached)).select(
        "key",
        "row",
        "unit",
        F.get(_constant([t.license for t in known], "array<string>"), F.col("t")).alias("license"),
        F.col("t").alias("template"),
        F.col("s").cast("bigint").alias("shared"),
        "n_bigrams",
        (-F.col("m")).alias("n_template"),
        (-F.col("worst")).alias("dice"),
        F.col("unit_no").alias("start"),
        (F.col("unit_no") + F.when(F.col("unit") == "window", F.get(lengths, F.col("t"))).otherwise(1)).alias("end"),
    )
    # Shifted windows first, so that those left of neighbouring notices no longer overlap.
    best = _joined_hits(_joined_hits(hits.repartition("row"), ["license"]), [])
    return best.select(
        F.col("key").alias(key), "unit", F.col("start").alias("unit_no"), "license", "shared", "n_bigrams", "n_template", "dice"
    )
