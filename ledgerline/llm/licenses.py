"""Licence scans in built-in column expressions only.

A text's units are its lines, its blocks between blank lines and the whole
text.  A unit, reduced to lower-case words, is compared to licence templates by
the Dice coefficient of their sets of word bigrams.  Two bounds keep templates
and units from being compared, and neither loses a match:

- size: for sets of n and t bigrams the coefficient is at most
  2 * min(n, t) / (n + t);
- anchors: a match must share at least ``t * least / (2 - least)`` bigrams, so
  it contains one of a few words per template that touch more bigrams than may
  be missing.

With ``windows``, the whole text is also searched for word windows of each
template's length, at every place where one of its bigrams starts, so a licence
with blank lines inside or a notice within a longer line is found; of windows
that overlap the best is kept, and SPDX identifier lines are read.  Each licence
that no unit has is then listed once.  Only templates are tried that share
enough bigrams with the text for a match.

Defined cases: a null or empty text has no units; of templates that score
equal the first listed is taken; repeated rows are scanned one by one; texts of
any length are scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, let

LEAST = 0.8

# Texts and names of public licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "LGPL-3.0": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any
        later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License
        for more details. You should have received a copy of the GNU Lesser General Public License along with this library. If
        not, see <https://www.gnu.org/licenses/>.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License
        for more details. You should have received a copy of the GNU Affero General Public License along with this program. If
        not, see <https://www.gnu.org/licenses/>.""",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
        this software to the public domain worldwide. This software is distributed without any warranty. You should have
        received a copy of the CC0 Public Domain Dedication along with this software. If not, see
        <http://creativecommons.org/publicdomain/zero/1.0/>.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
        this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for
        the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
        overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
        OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
    following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
    the following disclaimer in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED
    BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER
    OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
    LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
    AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
    WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS |= {"BSD-2-Clause": _BSD.format(""), "BSD-3-Clause": _BSD.format(
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. ")}
NAMES = {
    "MIT": ["the MIT License"],
    "Apache-2.0": ["the Apache License, Version 2.0"],
    "GPL-3.0": ["the GNU General Public License, version 3"],
    "GPL-2.0": ["the GNU General Public License, version 2"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "ISC": ["the ISC License"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
}
FORMS = ("Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.",
         "This file is licensed under {}.", "This project is licensed under {}.")
# An SPDX line's expression, its identifiers, and what is cut from their ends.
SPDX_LINE, SPDX_ID, SPDX_END = r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]++)", "[A-Za-z0-9.-]+", "(?i)-(only|or-later)$"
# Common words, which make poor anchors.
COMMON = frozenset("a an and any as at be by for from in is it its may not of on or that the this to under was with you".split())


class Template(NamedTuple):
    license: str
    bigrams: list[str]
    anchors: set[str]
    length: int


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams_of(words: list[str]) -> list[str]:
    """Distinct word pairs, in order; a single word is its own."""
    return list(dict.fromkeys(map(" ".join, zip(words, words[1:])))) if len(words) > 1 else words


def template(name: str, text: str, least: float) -> Template:
    grams = bigrams_of(words_of(text))
    may_miss = len(grams) - ceil(len(grams) * least / (2 - least) - 1e-9)
    left, anchors = set(grams), set()
    for word in sorted(set(words_of(text)), key=lambda w: (w in COMMON, -len(w), w)):
        touched = {g for g in left if word in g.split(" ")}
        if touched:
            anchors.add(word)
            left -= touched
        if len(grams) - len(left) > may_miss:
            break
    return Template(name, grams, anchors, max(len(words_of(text)) - 1, 1))


def templates(least: float = LEAST) -> list[Template]:
    return [template(k, t, least) for k, t in TEXTS.items()] \
        + [template(k, form.format(n), least) for k, names in NAMES.items() for n in names for form in FORMS]


def best_match(unit: Column, known: list[Template], least: float) -> Column:
    """Struct (dice, license) of the best template, or null."""
    sizes = [len(t.bigrams) for t in known]
    fewest, most = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    anchors = sorted(set().union(*(t.anchors for t in known)))
    table = F.array(*[F.struct(F.lit(-i).alias("rank"), F.lit(t.license).alias("license"), F.lit(len(t.bigrams)).alias("t"),
                               F.split(F.lit("\n".join(t.bigrams)), "\n").alias("grams")) for i, t in enumerate(known)])

    def compare(words: Column) -> Column:
        grams = F.when(F.size(words) < 2, words).otherwise(F.array_distinct(F.zip_with(
            F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
            lambda a, b: F.concat(a, F.lit(" "), b))))

        def scored(g: Column) -> Column:
            n = F.size(g)
            fit = F.filter(table, lambda t: 2 * F.least(n, t["t"]) >= least * (n + t["t"]))
            dice = F.transform(fit, lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(g, t["grams"])) / (n + t["t"])).alias("dice"),
                t["rank"].alias("rank"), t["license"].alias("license")))
            return F.array_max(F.filter(dice, lambda d: d["dice"] >= least))

        likely = (F.size(words) >= fewest) & F.exists(words, lambda w: w.isin(anchors))
        return F.when(likely, let(grams, lambda g: F.when(F.size(g) <= most, scored(g))))

    return let(F.filter(F.split(unit, "[^\\p{L}\\p{N}]+"), lambda w: w != ""), compare)


def units(text: Column) -> Column:
    """Distinct lines, blocks and whole text, in lower case."""
    def cut(t: Column) -> Column:
        lines = F.split(t, "\n")
        blocks = F.filter(F.split(t, "\n[ \t\r]*\n"), lambda b: F.contains(F.trim(b), F.lit("\n")))
        return F.array_distinct(F.concat(lines, blocks, F.array(t)))
    return let(F.lower(F.coalesce(text.cast("string"), F.lit(""))), cut)


def window_matches(text: Column, known: list[Template], least: float) -> Column:
    """Array of (dice, t, rank, license, s, e): the best window of each template that matches, less those that a
    better one overlaps.  Windows are in bigrams, the end exclusive."""
    table = F.array(*[F.struct(F.lit(-i).alias("rank"), F.lit(t.license).alias("license"), F.lit(len(t.bigrams)).alias("t"),
                               F.lit(t.length).alias("length"), F.split(F.lit("\n".join(t.bigrams)), "\n").alias("grams"))
                      for i, t in enumerate(known)])
    every = sorted(set().union(*(t.bigrams for t in known)))
    fewest = min(len(t.bigrams) for t in known) * least / (2 - least)

    def at(grams: Column, t: Column, i: Column) -> Column:
        def score(w: Column) -> Column:
            return F.struct((2.0 * F.size(F.array_intersect(w, t["grams"])) / (F.size(w) + t["t"])).alias("dice"), t["t"].alias("t"),
                            t["rank"].alias("rank"), t["license"].alias("license"), i.alias("s"), (i + t["length"]).alias("e"))
        return let(F.array_distinct(F.slice(grams, i, t["length"])), score)

    def search(grams: Column) -> Column:
        def of_shared(shared: Column) -> Column:
            def enough(t: Column) -> Column:
                need = t["t"] * (least / (2 - least)) - 1e-9
                return (F.size(shared) >= need) & (F.size(F.array_intersect(t["grams"], shared)) >= need)

            def best(t: Column) -> Column:
                starts = F.filter(F.sequence(F.lit(1), F.size(grams)), lambda i: F.array_contains(t["grams"], F.get(grams, i - 1)))
                return F.array_max(F.transform(starts, lambda i: at(grams, t, i)))

            tried = F.transform(F.filter(table, enough), best)
            return F.when(F.size(shared) >= fewest, let(F.filter(tried, lambda x: x["dice"] >= least), lambda found: F.filter(
                found, lambda x: ~F.exists(found, lambda y: (y > x) & (y["s"] < x["e"]) & (x["s"] < y["e"])))))
        return let(F.array_distinct(F.filter(grams, lambda g: g.isin(every))), of_shared)

    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return let(words, lambda w: F.when(F.size(w) > 1, let(F.zip_with(
        F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)), search)))


def spdx_ids(text: Column, known: list[Template]) -> Column:
    """Known licences that SPDX lines name."""
    names = {t.license.lower(): t.license for t in known}
    ids = F.flatten(F.transform(F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPDX_LINE), F.lit(1)),
                                lambda x: F.regexp_extract_all(x, F.lit(SPDX_ID), F.lit(0))))
    of = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.transform(ids, lambda x: F.element_at(of, F.lower(F.regexp_replace(x, SPDX_END, ""))))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, windows: bool = False) -> DataFrame:
    """``id_col`` and ``found``: an array of (license, dice) with one entry per unit that matches a template; with
    ``windows``, also one per licence that only a window or an SPDX line has."""
    known = templates(least)
    hits = F.filter(F.transform(units(col(text_col)), lambda u: best_match(u, known, least)), lambda h: h.isNotNull())
    found = F.transform(hits, lambda h: F.struct(h["license"].alias("license"), h["dice"].alias("dice")))
    if windows:
        named = F.transform(spdx_ids(col(text_col), known), lambda x: F.struct(x.alias("license"), F.lit(1.0).alias("dice")))
        inside = F.transform(F.coalesce(window_matches(col(text_col), known, least), F.array()),
                             lambda x: F.struct(x["license"].alias("license"), x["dice"].alias("dice")))

        def more(have: Column) -> Column:
            def once(extra: Column) -> Column:
                new = F.filter(F.array_distinct(extra["license"]), lambda n: ~F.array_contains(have["license"], n))
                return F.concat(have, F.transform(new, lambda n: F.struct(n.alias("license"), F.array_max(F.transform(
                    F.filter(extra, lambda x: x["license"] == n), lambda x: x["dice"])).alias("dice"))))
            return let(F.concat(named, inside), once)
        found = let(found, more)
    return docs.select(col(id_col).alias(id_col), found.alias("found"))


def summary(scanned: DataFrame) -> DataFrame:
    """Entries found, the licences' names and the best coefficient, per document."""
    found = col("found")
    return scanned.select(
        *[col(c) for c in scanned.columns if c != "found"], F.size(found).cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(found["license"])), ",").alias("licenses"),
        F.coalesce(F.array_max(found["dice"]), F.lit(0.0)).alias("best_dice"))
