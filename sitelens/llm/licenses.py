"""License scans: Dice coefficient of word bigrams against license templates.

A document is compared as a whole and by its blocks (between blank lines), lines
and sentences.  A unit matches a template if ``2 * common / (unit + template)``
over their distinct word bigrams is at least ``THRESHOLD``.

``windowed`` adds the notices that are in no unit of their own, wrapped over the
lines of a comment or paragraph: every template is also compared with the windows
of its own number of words that begin at one of its bigrams, over the whole text
with any marks (so comment leaders too) as gaps between words.  A window must hold
the least number of shared bigrams, which the bigrams' positions tell beforehand.
A license's score is that of its best unit or window.

Three prunings lose nothing.  Size: a template is tried only on units with between
``t / (2 - t)`` and ``(2 - t) / t`` times its bigrams.  Words: a match shares so
many bigrams with its template that it must hold one of the template's chosen
words; documents without any of these words aren't cut into units at all.  Bigrams:
a template is tried only on documents that have its least number of shared bigrams.

The operator is native and has no shuffle: a row's result depends on that row.

Defined cases: null text is the empty text; units of fewer than two words match
nothing; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_END = r"[.!?][\x20\x09-\x0D]+"
#: Of windows: marks of any script, and the leaders of comment lines that are words.
GAPS = r"[^\p{L}\p{M}\p{N}]+"
LEADERS = r"(?im)^[^\p{L}\p{M}\p{N}\n]*(?:rem|dnl)(?=[\x20\x09])"

# The notices by which public licenses are declared.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "bsd": "Redistributed under the BSD License.",
    "bsd-2-clause-terms": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    # usual variants of the notices, and telling paragraphs of the licenses themselves
    "agpl": "GNU Affero General Public License",
    "apache-2.0-grant": (
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor "
        "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
        "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
        "sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    "apache-2.0-license": "Licensed under the Apache License 2.0.",
    "apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "apache-2.0-short": "under the Apache 2.0 license",
    "bsd-2-clause": "BSD 2-Clause License",
    "bsd-2-clause-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "bsd-3-clause": "BSD 3-Clause License",
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission."),
    "bsd-3-clause-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "bsd-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
        "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF"
        " THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "bsd-licensed": "Licensed under the BSD License.",
    "bsd-released": "Released under the BSD License.",
    "bsd-style": "governed by a BSD-style license",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "bsl-1.0-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
        "display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
        "Software, and to permit third-parties to whom the Software is furnished to do so"),
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-name": "Creative Commons Attribution-NonCommercial 4.0",
    "cc-by-nc-sa-4.0-name": "Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
    "cc-by-nd-4.0-name": "Creative Commons Attribution-NoDerivatives 4.0",
    "cc-by-sa-4.0-name": "Creative Commons Attribution-ShareAlike 4.0",
    "cc0-1.0-deed": (
        "The person who associated a work with this deed has dedicated the work to the public domain by "
        "waiving all of his or her rights to the work worldwide under copyright law, including all related "
        "and neighboring rights, to the extent allowed by law."),
    "cc0-1.0-name": "CC0 1.0 Universal",
    "epl-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License"),
    "gpl-2.0-body": (
        "This License applies to any program or other work which contains a notice placed by the copyright "
        "holder saying it may be distributed under the terms of this General Public License."),
    "gpl-2.0-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users."),
    "gpl-2.0-short": "under the GNU GPL v2",
    "gpl-2.0-spdx": "SPDX-License-Identifier: GPL-2.0",
    "gpl-2.0-v2": "under the GPLv2",
    "gpl-3.0-preamble": (
        "The licenses for most software and other practical works are designed to take away your freedom to "
        "share and change the works. By contrast, the GNU General Public License is intended to guarantee "
        "your freedom to share and change all versions of a program--to make sure it remains free software "
        "for all its users."),
    "gpl-3.0-short": "under the GNU GPL v3",
    "gpl-3.0-spdx": "SPDX-License-Identifier: GPL-3.0",
    "gpl-3.0-v3": "under the GPLv3",
    "gpl-3.0-version": "GNU General Public License v3.0",
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."),
    "isc-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE"
        " OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."),
    "isc-licensed": "Licensed under the ISC License.",
    "isc-spdx": "SPDX-License-Identifier: ISC",
    "lgpl": "GNU Lesser General Public License",
    "lgpl-2.0": "GNU Library General Public License",
    "lgpl-2.1-body": (
        "This License Agreement applies to any software library or other program which contains a notice "
        "placed by the copyright holder or other authorized party saying it may be distributed under the "
        "terms of this Lesser General Public License (also called \"this License\")."),
    "lgpl-3.0-body": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of "
        "version 3 of the GNU General Public License, supplemented by the additional permissions listed "
        "below."),
    "mit-available": "Available under the MIT License.",
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES"
        " OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
        " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "mit-distributed": "Distributed under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "mit-terms": "under the terms of the MIT License",
    "mpl-2.0-grant": (
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: (a) under "
        "intellectual property rights (other than patent or trademark) Licensable by such Contributor to use,"
        " reproduce, make available, modify, display, perform, distribute, and otherwise exploit its "
        "Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work"),
    "mpl-2.0-spdx": "SPDX-License-Identifier: MPL-2.0",
    "unlicense-body": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means."),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software."),
}


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def least_shared(n_bigrams: int, threshold: float) -> int:
    """Bigrams of a template that a match holds at least."""
    return math.ceil(threshold / (2 - threshold) * n_bigrams - 1e-9)


#: Words that any text may hold; they are chosen last.
COMMON = frozenset("a an and any as at be by for from in is may not of on or that the this to under use with you".split())


def needed_words(bigrams: list[str], threshold: float) -> set[str]:
    """Words of which a matching unit has at least one, telling and long ones first.

    A match shares at least ``t / (2 - t)`` of the template's bigrams, so it can
    avoid no set of bigrams larger than the rest."""
    least = least_shared(len(bigrams), threshold)
    chosen: set[str] = set()
    for word in sorted({w for b in bigrams for w in b.split()}, key=lambda w: (w in COMMON, -len(w), w)):
        if sum(bool(chosen & set(b.split())) for b in bigrams) > len(bigrams) - least:
            break
        chosen.add(word)
    return chosen


def bigrams_of(text: Column, gaps: str) -> Column:
    """The bigrams in order, with repeats."""
    words = F.array_remove(F.split(F.lower(text), gaps, -1), "")
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def unit_bigrams(unit: Column) -> Column:
    return F.array_distinct(bigrams_of(unit, SEPARATORS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def units(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    return F.array_distinct(F.concat(
        F.array(text), F.split(text, r"\n[\x20\x09\x0D]*\n", -1), lines,
        F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_END, -1)))))


def known_templates(templates: dict[str, str], threshold: float) -> Column:
    """Array of ``license, bigrams, least, span``; a window has ``span`` bigrams with repeats."""
    table = {name: template_bigrams(body) for name, body in sorted(templates.items())}
    return F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, b)).alias("bigrams"),
                              F.lit(least_shared(len(b), threshold)).alias("least"),
                              F.lit(len(template_words(templates[name])) - 1).alias("span"))
                     for name, b in table.items() if b])


def all_bigrams(templates: dict[str, str]) -> Column:
    return F.array(*map(F.lit, sorted(set().union(*map(template_bigrams, templates.values())))))


def nearby(common: Column, known: Column) -> Column:
    """The templates of which the text has enough bigrams anywhere; no other has a match in it."""
    return F.filter(known, lambda t: F.size(F.array_intersect(common, t["bigrams"])) >= t["least"])


def window_scores(text: Column, templates: dict[str, str], threshold: float) -> Column:
    """Array of ``license, score``: the best window of every template that has one of ``threshold``."""
    kind = "array<struct<license:string,score:double>>"
    known, every = known_templates(templates, threshold), all_bigrams(templates)

    def dice(window: Column, t: Column) -> Column:
        return (F.lit(2.0) * F.size(F.array_intersect(window, t["bigrams"]))
                / (F.size(F.array_distinct(window)) + F.size(t["bigrams"])))

    def best(grams: Column, hits: Column, t: Column) -> Column:
        def of(places: Column) -> Column:
            # the least number of hits lies within the window's span
            full = F.filter(places, lambda p, j: F.coalesce(
                F.get(places, j + t["least"] - 1) < p + t["span"], F.lit(False)))
            starts = F.array_distinct(F.transform(full, lambda p: F.greatest(
                F.least(p, F.size(grams) - t["span"]), F.lit(0))))
            return F.array_max(F.transform(starts, lambda p: dice(F.slice(grams, p + 1, t["span"]), t)))
        mine = F.filter(hits, lambda h: F.array_contains(t["bigrams"], h["gram"]))
        return F.struct(t["license"].alias("license"), F.coalesce(
            bound(F.transform(mine, lambda h: h["place"]), of), F.lit(0.0)).alias("score"))

    def scores(grams: Column, common: Column, near: Column) -> Column:
        hits = F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("place"), g.alias("gram"))),
                        lambda h: F.array_contains(common, h["gram"]))
        return F.filter(bound(hits, lambda hits_: F.transform(near, lambda t: best(grams, hits_, t))),
                        lambda m: m["score"] >= threshold).cast(kind)

    def of_grams(grams: Column) -> Column:
        return bound(F.array_intersect(grams, every), lambda common: bound(
            nearby(common, known), lambda near: F.when(F.size(near) > 0, scores(grams, common, near)).otherwise(F.array().cast(kind))))

    return bound(bigrams_of(F.regexp_replace(text, LEADERS, " "), GAPS), of_grams)


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
             windowed: bool = False) -> DataFrame:
    """``doc_id, licenses`` (array of ``license, score`` in order of the license) of every row."""
    templates = TEMPLATES if templates is None else templates
    kind = "array<struct<license:string,score:double>>"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    table = {name: template_bigrams(body) for name, body in sorted(templates.items())}
    words = sorted(set().union(*(needed_words(b, threshold) for b in table.values() if b)))
    if not words:
        return rows.select("doc_id", F.array().cast(kind).alias("licenses"))
    narrow, wide = threshold / (2 - threshold), (2 - threshold) / threshold
    known, every = known_templates(templates, threshold), all_bigrams(templates)

    def best(units_: Column):
        def of(t: Column) -> Column:
            size = F.size(t["bigrams"])
            fitting = F.filter(units_, lambda u: (F.size(u) >= size * narrow - 1e-9) & (F.size(u) <= size * wide + 1e-9))
            dice = F.transform(fitting, lambda u: F.lit(2.0) * F.size(F.array_intersect(u, t["bigrams"]))
                               / (F.size(u) + size))
            return F.struct(t["license"].alias("license"), F.coalesce(F.array_max(dice), F.lit(0.0)).alias("score"))
        return of

    holds_word = F.regexp_like(F.lower("text"), F.lit(r"(?<![0-9a-z])(?:" + "|".join(words) + ")(?![0-9a-z])"))
    scanned = rows.withColumn("near", F.when(holds_word, bound(
        F.array_intersect(bigrams_of(F.col("text"), SEPARATORS), every), lambda common: nearby(common, known))))
    scanned = scanned.withColumn("units", F.when(F.size("near") > 0, F.filter(
        F.transform(units(F.col("text")), unit_bigrams), lambda u: F.size(u) > 0)))
    scored = F.filter(F.transform("near", best(F.col("units"))), lambda m: m["score"] >= threshold).cast(kind)
    scored = F.when(F.size("near") > 0, scored).otherwise(F.array().cast(kind))
    if windowed:
        scored = bound(F.concat(scored, window_scores(F.col("text"), templates, threshold)), _best_of_each)
    return scanned.select("doc_id", F.when(F.col("near").isNull(), F.array().cast(kind))
                          .otherwise(scored).alias("licenses"))


def _best_of_each(found: Column) -> Column:
    """One element a license, with its highest score, in order of the license."""
    return F.array_sort(F.filter(F.array_distinct(found), lambda m: ~F.exists(
        found, lambda o: (o["license"] == m["license"]) & (o["score"] > m["score"]))))
