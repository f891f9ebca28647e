"""License scans: lines, runs of lines and whole texts against notices and short licenses.

A unit (a line, a run of lines, or the whole text) is normalised to lower-case words of letters and digits
and compared to every template by the Dice coefficient over the sets of word bigrams. With
sizes a and b, 2 |A and B| / (a + b) >= t needs a t / (2 - t) <= b <= a (2 - t) / t, and a t / (2 - t)
of the template's bigrams in the unit. A text holds the bigrams of all its units, so most
texts meet no template at all and are not cut into units. DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.tables import settled
from postsift.operators.once import computed_once

#: The parts that short licenses share.
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\""
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)

#: Notices as they are commonly put into files, and whole short licenses (fixed values): name, text.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", f"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_AS_IS} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD[0] + _BSD[2]),
    ("BSD-3-Clause", "".join(_BSD)),
)


#: Runs of lines of a text that start in one row.
STARTS = 64


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: tuple[str, ...]

    def bounds(self, least: float) -> tuple[int, int]:
        """Smallest and largest number of bigrams of a unit that can reach `least`."""
        # In fractions: a float quotient can come out below the whole number it stands for.
        a, t = len(self.bigrams), Fraction(str(least))
        return math.ceil(a * t / (2 - t)), math.floor(a * (2 - t) / t)


def normalised(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def build_templates(texts=TEMPLATES) -> tuple[Template, ...]:
    out = []
    for name, text in texts:
        words = normalised(text)
        out.append(Template(name, tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))))
    return tuple(out)


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def bigrams_of(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.array_distinct(pairs)


def single_units(texts: DataFrame) -> DataFrame:
    """doc_id, known, line, last and words of the lines and whole texts."""
    # Unit 0 is the whole text, if it has several lines. Unfolding computes each step once.
    whole = F.array(F.when(F.contains("text", F.lit("\n")), F.col("text")))
    units = F.transform(F.concat(whole, F.split("text", "\n")), words_of)
    return texts.select("doc_id", "known", F.posexplode(units).alias("line", "words")).select("doc_id", "known", "line", F.col("line").alias("last"), "words")


def run_units(texts: DataFrame, most: int) -> DataFrame:
    """doc_id, known, line, last and words of the runs of two lines or more with `most` words at most.

    Lines without a word do not count, so a run has `most` lines at most. It starts in a line
    where a bigram of `known` starts; one that does not matches no better than its rest.
    """
    lines = F.transform(F.split("text", "\n"), words_of)
    numbered = F.transform(lines, lambda words, i: F.struct((i + 1).alias("line"), F.slice(words, 1, most + 1).alias("words")))
    spoken = computed_once(texts, lines=F.filter(numbered, lambda x: F.get(x["words"], F.lit(0)) != ""))
    # A block has the lines of STARTS runs; the rows of the runs do not carry the whole text.
    blocks = F.transform(F.sequence(F.lit(0), F.size("lines"), F.lit(STARTS)), lambda k: F.slice("lines", k + 1, STARTS + most))
    block = spoken.select("doc_id", "known", F.explode(blocks).alias("block")).where(F.size("block") > 1)

    def hopeful(k: Column) -> Column:
        after = F.get("block", k + 1)["words"]
        return after.isNotNull() & F.arrays_overlap(bigrams_of(F.concat(F.get("block", k)["words"], F.slice(after, 1, 1))), F.col("known"))

    starts = F.filter(F.sequence(F.lit(0), F.least(F.size("block"), F.lit(STARTS)) - 1), hopeful)
    started = block.select("doc_id", "known", "block", F.explode(starts).alias("k")).select("doc_id", "known", F.slice("block", F.col("k") + 1, most).alias("run"))

    def longer(so_far: Column, x: Column) -> Column:
        total = so_far["total"] + F.size(x["words"])
        end = F.struct(x["line"].alias("last"), total.alias("size"))
        return F.struct(total.alias("total"), F.when(total <= most, F.concat(so_far["ends"], F.array(end))).otherwise(so_far["ends"]).alias("ends"))

    nothing = F.struct(F.lit(0).alias("total"), F.array().cast("array<struct<last: int, size: int>>").alias("ends"))
    ended = computed_once(started, ends=F.aggregate("run", nothing, longer)["ends"]).where(F.size("ends") > 1)
    joined = computed_once(ended, words=F.flatten(F.transform(F.slice("run", 1, F.size("ends")), lambda x: x["words"])), line=F.get("run", F.lit(0))["line"])
    each = joined.select("doc_id", "known", "line", "words", F.explode(F.slice("ends", 2, most)).alias("end"))
    return each.select("doc_id", "known", "line", F.col("end.last").alias("last"), F.slice("words", F.lit(1), F.col("end.size")).alias("words"))


def license_scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: tuple[Template, ...] | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, license, dice, line and n_matches for every document.

    `license` is the template name with the highest coefficient of at least `least` in any
    unit (ties: the first line, then the earlier template), `dice` its value to six places,
    and `line` the line in which the unit starts, from 1, or 0 for the whole text. Units are
    the lines, the whole text, and all runs of lines with no more words than the largest
    unit that can match has bigrams, and one; they find notices that are wrapped.

    `n_matches` is the number of places with a unit that reaches `least`: the whole text, each
    line, and of runs as many as overlap neither each other nor such a line, none if the
    whole text is a place. Without a match license, dice and line are null and n_matches is
    0; so for null and empty texts. Units of one word have no bigram. Rows that repeat a
    doc_id give one row with what any of them holds. Other columns are not read.

    Texts that share too few bigrams with every template go first, then units are cut down by
    size; the grouping moves only what matched.
    """
    templates = templates or build_templates()
    bounds = [t.bounds(least) for t in templates]
    lowest, highest = min(lo for lo, _ in bounds), max(hi for _, hi in bounds)
    known = sorted({b for t in templates for b in t.bigrams})
    given = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))

    def shared(bigrams: str, template: Template) -> Column:
        return F.size(F.array_intersect(bigrams, F.array(*map(F.lit, template.bigrams))))

    worded = computed_once(given, words=words_of(F.col("text"))).where(F.size("words") > lowest)
    hinted = computed_once(worded, known=F.array_intersect(bigrams_of(F.col("words")), F.array(*map(F.lit, known)))).where(F.size("known") >= lowest)
    hopeful = F.array_contains(F.array(*[shared("known", t) >= lo for t, (lo, _) in zip(templates, bounds, strict=True)]), True)
    # Few texts are left; they are dealt anew, as cutting them is the work.
    # Both kinds of units are cut from them, so they are written down and searched for once.
    chosen = settled(hinted.where(hopeful).select("doc_id", "text", "known")).repartition("doc_id", "text")

    units = single_units(chosen).unionByName(run_units(chosen, highest + 1))
    # A unit has fewer bigrams than words, and at least as many as different words less one.
    likely = units.where((F.size("words") > lowest) & (F.size(F.array_distinct("words")) <= highest + 1))
    paired = computed_once(likely, bigrams=bigrams_of(F.col("words"))).select("doc_id", "known", "line", "last", "bigrams")
    near = paired.where(F.size("bigrams").between(lowest, highest)).where(F.arrays_overlap("bigrams", "known"))

    def match(i: int, template: Template) -> Column:
        a, (lo, hi) = len(template.bigrams), bounds[i]
        dice = F.lit(2.0) * shared("bigrams", template) / (F.size("bigrams") + a)
        found = F.struct((-dice).alias("minus"), F.lit(i).alias("template"))
        return F.when(F.size("bigrams").between(lo, hi) & (dice >= least), found)

    best = F.array_min(F.array_compact(F.array(*[match(i, t) for i, t in enumerate(templates)])))
    matched = near.select("doc_id", "line", "last", best.alias("best")).where("best IS NOT NULL")
    # Places by their ends, the shortest first: one counts if it begins behind the one before.
    place = F.struct("last", (-F.col("line")).alias("minus"))
    per_doc = matched.groupBy("doc_id").agg(F.min(F.struct(F.col("best.minus"), F.col("line"), F.col("best.template"))).alias("top"), F.collect_set(place).alias("places"))

    def count(so_far: Column, place: Column) -> Column:
        return F.when(-place["minus"] > so_far["end"], F.struct(place["last"].alias("end"), (so_far["n"] + 1).alias("n"))).otherwise(so_far)

    is_whole = F.exists("places", lambda p: p["last"] == 0)
    counted = F.filter("places", lambda p: ~is_whole | (p["last"] == -p["minus"]))
    n_matches = F.aggregate(F.sort_array(counted), F.struct(F.lit(-1).alias("end"), F.lit(0).cast("bigint").alias("n")), count)["n"]
    found = per_doc.select(F.col("doc_id").alias("p_id"), "top", n_matches.alias("n_matches"))

    names = F.array(*[F.lit(t.name) for t in templates])
    every = given.select("doc_id").distinct()
    return every.join(found, F.col("doc_id").eqNullSafe(F.col("p_id")), "left").select(
        "doc_id",
        F.get(names, F.col("top.template")).alias("license"),
        F.round(-F.col("top.minus"), 6).alias("dice"),
        F.col("top.line").alias("line"),
        F.coalesce("n_matches", F.lit(0).cast("bigint")).alias("n_matches"),
    )
