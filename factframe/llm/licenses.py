"""Licence notices in texts: Dice coefficient over word bigrams against templates, in DataFrame functions only."""

from __future__ import annotations

import math
import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices by SPDX id: fixed values.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/ SPDX-License-Identifier: EPL-2.0",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD-2-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ],
    "BSD-3-Clause": [
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this work may be reproduced without permission."],
}


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def _bigrams(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates() -> list[tuple[str, list[str]]]:
    """(licence, its distinct bigrams), a template each."""
    return [(name, _bigrams(text)) for name, texts in TEMPLATES.items() for text in texts]


#: Bigrams of a template's start by which a line begins a run of lines, and words from which templates are met across lines.
OPENING, RUN_WORDS = 4, 2


def openings() -> list[tuple[int, list[str]]]:
    """(words, bigrams of the start) of each template; no bigrams for those too short to be wrapped."""
    out = []
    for texts in TEMPLATES.values():
        for text in texts:
            words = _words(text)
            out.append((len(words), [f"{a} {b}" for a, b in zip(words, words[1 : OPENING + 1])] if len(words) >= RUN_WORDS else []))
    return out


def _anchors(known: list[tuple[str, list[str]]], dice: float) -> list[str]:
    """Words of which any text within `dice` of a template holds one at least.

    Such a text shares s bigrams with s >= dice (n + m) / 2 and m >= s, so
    s >= dice n / (2 - dice): it lacks at most n - s of a template's n. Words
    that lie in n - s + 1 of them, whichever those are, can't all be missing.
    Long words that lie in many bigrams are taken first.
    """
    chosen: list[str] = []
    open_ = [(grams, len(grams) - math.ceil(dice * len(grams) / (2 - dice) - 1e-9) + 1) for _, grams in known]
    while left := [[g for g in grams if not any(w in g for w in chosen)] for grams, need in open_ if sum(any(w in g for w in chosen) for g in grams) < need]:
        words = sorted({w for grams in left for g in grams for w in g.split()})
        chosen.append(max(words, key=lambda w: (len(w) >= 6, len(w) >= 4, sum(w in g for grams in left for g in grams), len(w))))
    return chosen


def normalised(text: Column) -> Column:
    """ASCII words and numbers of a lower-case text, one space between."""
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", dice: float = 0.8) -> DataFrame:
    """One row a document: (key, n_matches, licenses, best_license, best_dice, matches).

    A document's units are its lines, where it has more than one the whole of
    it, and runs of lines: for each template of RUN_WORDS words or more, a
    line that holds one of the first OPENING bigrams of it starts the shortest
    run of two lines or more that has as many words, or what is left of the
    text. So a notice is met however it is wrapped, whatever stands round it,
    as long as one of those bigrams stands in one line. Of a unit's matches
    the best one stays, with those equal to it, as templates of a licence's
    versions differ by a word.
    A unit is normalised; only one with an anchor word and a bigram count m
    within some template's size bounds, n dice / (2 - dice) to n (2 - dice) /
    dice, is compared, and only with the templates whose bounds hold, a run
    with its own: others can't reach the coefficient. matches has (unit,
    license, dice) of every template that does, unit 0 being the whole text,
    lines counting from 1 and a run having its first line's number; licenses
    is the sorted set. Null, empty and unmatched texts have 0 matches and null
    best ones; of equal coefficients the first unit, then name, is best.
    Repeated rows give repeated rows; no rows, no result. Other columns are
    ignored, whatever their names. Nothing is shuffled.
    """
    known, opened = templates(), openings()
    least, most = dice / (2 - dice) - 1e-9, (2 - dice) / dice + 1e-9  # room for rounding: a bound may be met exactly
    low, high = min(len(g) for _, g in known) * least, max(len(g) for _, g in known) * most
    # A chain of plain searches is several times quicker than one pattern of alternatives.
    holds = lambda x, parts: reduce(operator.or_, [F.contains(x, F.lit(p)) for p in parts])
    anchored = lambda lowered: holds(lowered, anchors)
    anchors = _anchors(known, dice)
    anchors = [a for a in anchors if not any(b != a and b in a for b in anchors)]  # what holds a longer one holds the shorter
    entry = lambda i: F.struct(F.lit(known[i][0]).alias("license"), F.lit(len(known[i][1])).alias("n"), F.array(*map(F.lit, known[i][1])).alias("grams"))
    library = F.array(*[entry(i) for i in range(len(known))])
    long = [i for i, (_, start) in enumerate(opened) if start]
    starts = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(opened[i][0]).alias("words"), F.array(*map(F.lit, opened[i][1])).alias("start")) for i in long])
    first = sorted({f" {g} " for i in long for g in opened[i][1]})
    bare = lambda lowered: F.concat(F.lit(" "), normalised(lowered), F.lit(" "))

    # Most texts hold no anchor at all, and are done with here.
    rows = docs.select(F.col(key).alias("__key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__low"))
    split = F.split(F.col("__low"), "\n", -1)
    found = rows.withColumn("__lines", F.when(anchored(F.col("__low")), split))
    # What is searched many times is a column of its own, as it would be made anew for every search.
    found = found.withColumn("__bare", F.when(F.size("__lines") > 1, bare(F.col("__low"))))
    found = found.withColumn("__opens", F.coalesce(holds(F.col("__bare"), first), F.lit(False)))
    worded = lambda x: F.filter(F.split(normalised(x), " ", -1), lambda w: w != "")
    none = F.expr("cast(array() as array<struct<unit: int, t: int, words: array<string>>>)")
    single = F.filter(F.transform("__lines", lambda line, i: F.when(anchored(line), F.struct((i + 1).alias("unit"), F.lit(-1).alias("t"), worded(line).alias("words")))), lambda u: u.isNotNull())
    whole = F.when(F.size("__lines") > 1, F.array(F.struct(F.lit(0).alias("unit"), F.lit(-1).alias("t"), worded(F.col("__low")).alias("words"))))
    found = found.select("__key", "__opens", F.when(F.col("__opens"), F.col("__lines")).alias("__lines"), F.when(F.col("__lines").isNotNull(), F.concat(F.coalesce(whole, none), single)).alias("units"))

    # Runs: all words in a row, the line of each, and the lines that hold a template's start.
    found = found.withColumn("__lines", F.transform("__lines", bare))
    found = found.withColumn("__by_line", F.transform("__lines", lambda line: F.filter(F.split(line, " ", -1), lambda w: w != "")))
    found = found.withColumns({"__words": F.flatten("__by_line"), "__of": F.flatten(F.transform("__by_line", lambda ws, i: F.array_repeat(i, F.size(ws))))})
    pairs_of = lambda ws: F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(ws, i + 1)))
    # Only lines that hold some start are looked at, and their bigrams are made once for all templates.
    begun = F.transform(F.filter(F.transform("__lines", lambda line, i: F.struct(i.alias("line"), holds(line, first).alias("begins"))), lambda b: b["begins"]), lambda b: F.struct(b["line"].alias("line"), F.get("__by_line", b["line"]).alias("words")))
    found = found.withColumn("__begun", F.when(F.col("__opens"), begun))
    found = found.withColumn("__begun", F.transform("__begun", lambda b: F.struct(b["line"].alias("line"), pairs_of(b["words"]).alias("pairs"))))
    fitting = lambda b: F.transform(F.filter(starts, lambda t: F.arrays_overlap(b["pairs"], t["start"])), lambda t: F.struct(b["line"].alias("line"), t["t"].alias("t"), t["words"].alias("words")))
    found = found.withColumn("__runs", F.flatten(F.transform("__begun", fitting)))
    last = F.size("__of")
    placed = F.transform("__runs", lambda r: F.struct(r["line"].alias("line"), r["t"].alias("t"), F.array_position("__of", r["line"]).cast("int").alias("a"), r["words"].alias("words")))
    ended = F.transform(placed, lambda r: F.struct(r["line"].alias("line"), r["t"].alias("t"), r["a"].alias("a"), F.element_at("__of", F.least(r["a"] + r["words"] - 1, last)).alias("end")))
    multi = F.filter(ended, lambda r: r["end"] > r["line"])
    bounded = F.transform(multi, lambda r: F.struct((r["line"] + 1).alias("unit"), r["t"].alias("t"), F.slice("__words", r["a"], (last - F.array_position(F.reverse("__of"), r["end"]) + 2).cast("int") - r["a"]).alias("words")))
    found = found.select("__key", F.concat(F.coalesce("units", none), F.coalesce(bounded, none)).alias("units"))

    grams = lambda u: F.struct(u["unit"].alias("unit"), u["t"].alias("t"), F.array_distinct(pairs_of(u["words"])).alias("grams"))
    sized = F.filter(F.transform("units", grams), lambda u: F.size(u["grams"]).between(low, high))

    def against(u: Column) -> Column:
        m = F.size(u["grams"])
        near = F.filter(F.when(u["t"] < 0, library).otherwise(F.slice(library, u["t"] + 1, 1)), lambda t: m.between(t["n"] * least, t["n"] * most))
        scored = F.transform(
            near,
            lambda t: F.struct(u["unit"].alias("unit"), t["license"].alias("license"), (2.0 * F.size(F.array_intersect(u["grams"], t["grams"])) / (m + t["n"])).alias("dice")),
        )
        return F.filter(scored, lambda s: s["dice"] >= dice - 1e-12)

    out = found.select("__key", sized.alias("units")).select("__key", F.flatten(F.transform("units", against)).alias("matches"))
    beaten = lambda m: F.exists("matches", lambda o: (o["unit"] == m["unit"]) & (o["dice"] > m["dice"]))
    out = out.withColumn("matches", F.filter("matches", lambda m: ~beaten(m)))
    best = F.array_min(F.transform("matches", lambda s: F.struct((-s["dice"]).alias("less"), s["unit"].alias("unit"), s["license"].alias("license"))))
    return out.select(
        F.col("__key").alias(key),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda s: s["license"]))), ",").alias("licenses"),
        best["license"].alias("best_license"),
        (-best["less"]).alias("best_dice"),
        "matches",
    )
