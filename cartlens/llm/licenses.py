"""License scan: passages compared with license templates by the Dice coefficient over word bigrams.
DataFrame functions only.

A document's passages are its lines, sentences, blocks (between blank lines), its whole text and all runs of
neighbouring pieces, which are parted by ends of lines or sentences. Dice of two sets of sizes a and b is at most
2 min(a, b) / (a + b), so a passage is compared only with templates whose size lies within bounds of its own. Shared bigrams are counted by joining the
passages' bigrams with the broadcast bigrams of the templates, which the size condition prunes
in the join; only counts of matching passages are shuffled.

Runs are looked at only where one can match: in documents that have, all in all, as many of a template's bigrams
as a match needs. There one walk over the pieces finds the best run, in time linear in the text and in memory
bounded by the text and the template.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.common import picked, whole_text
from cartlens.session import materialize

SIMILARITY = 0.8
BROADCAST_BIGRAMS = 1_000_000
NORMAL_WORD = "[a-z0-9]+"
PIECE_END = r"(?<=[.!?])\s+|\r?\n"
# Bigrams in the order of words.
ORDERED = (
    "case when size(w) > 1 then transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1])) "
    "else cast(array() as array<bigint>) end"
)
# of every piece: its bigrams, and the one that its last word forms with the next piece
IN_PIECES = (
    "transform(pieces, (p, k) -> struct(case when size(p) > 1 then transform(sequence(0, size(p) - 2), "
    "i -> xxhash64(p[i], p[i + 1])) else cast(array() as array<bigint>) end as inside, "
    "case when k < size(pieces) - 1 then array(xxhash64(p[size(p) - 1], pieces[k + 1][0])) "
    "else cast(array() as array<bigint>) end as across))"
)
# Entries of the lists below, told by their last two bits: 0 a bigram, 1 one of the template, 2 the end of a piece.
MARKED = "x -> x & -4L | if(array_contains(near.t, x), 1L, 0L)"

# Public notices and license texts, as published.
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)


def _gnu_notice(kind: str, version: str) -> str:
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."
    )


TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT (licensed under)": "Licensed under the MIT License.",
    "MIT (text)": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC (text)": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS."
    ),
    "ISC (full text)": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause (conditions)": _BSD_CONDITIONS,
    "BSD-2-Clause (text)": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "BSD-3-Clause (conditions)": f"{_BSD_CONDITIONS} {_BSD_NAMES}",
    "BSD-3-Clause (text)": f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "Zlib (text)": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "Unlicense (text)": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
        "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for "
        "the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
        "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "GPL-3.0-or-later (whole notice)": _gnu_notice("General Public License", "3"),
    "GPL-2.0-or-later (whole notice)": _gnu_notice("General Public License", "2"),
    "LGPL-3.0-or-later (whole notice)": _gnu_notice("Lesser General Public License", "3"),
    "AGPL-3.0-or-later (whole notice)": _gnu_notice("Affero General Public License", "3"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0-or-later (notice)": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."
    ),
    "MPL-2.0 (notice)": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense (notice)": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "Copyright. All rights reserved.",
}
CREATIVE_COMMONS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CREATIVE_COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def templates() -> dict[str, str]:
    """The built-in templates; the Creative Commons notices follow one form."""
    cc = {f"CC-{k}-{v}": f"Licensed under CC {k} {v}." for k in CREATIVE_COMMONS for v in CREATIVE_COMMONS_VERSIONS}
    return TEMPLATES | cc


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(NORMAL_WORD), F.lit(0))


def _bigrams(words: str) -> Column:
    """Distinct bigrams, as hashes; of one word, the word itself; none without words."""
    pairs = f"transform(sequence(0, size({words}) - 2), i -> xxhash64({words}[i], {words}[i + 1]))"
    return F.expr(
        f"array_distinct(case when size({words}) > 1 then {pairs} when size({words}) = 1 then array(xxhash64({words}[0])) "
        "else cast(array() as array<bigint>) end)"
    )


def template_bigrams(spark: SparkSession, texts: Mapping[str, str]) -> DataFrame:
    """license, size, bigram."""
    rows = spark.createDataFrame(list(texts.items()), "license string, text string")
    rows = rows.withColumn("w", normal_words(F.col("text"))).withColumn("b", _bigrams("w"))
    return rows.select("license", F.size("b").alias("size"), F.explode("b").alias("bigram"))


def passages(text: Column) -> Column:
    """Lines, sentences, blocks and the whole text; each once."""
    parts = [F.split(text, r"\r?\n"), F.split(text, r"(?<=[.!?])\s+"), F.split(text, r"\n\s*\n"), F.array(text)]
    return F.array_distinct(F.concat(*parts))


def _best_run(factor: float) -> Column:
    """The highest Dice of a run of `grams` to the template `near`, 0 if none comes near.

    From the last piece to the first, a list of the distinct bigrams from there on in order of their first
    occurrence, with ends of pieces between them, is carried along: what stands before an end are the bigrams of
    the run up to it. Bigrams beyond those that a match may have can be forgotten, as they never move forward, and
    of ends without a new bigram between them the first is enough. So the list is as long as
    the template allows, however long the text is and however often it repeats.
    """
    most = f"cast(2 * floor(near.size / {factor}D) + 5 as int)"
    joined = "array_distinct(concat(transform(g.inside, {m}), array(g.place), transform(g.across, {m}), s.list))".format(m=MARKED)
    short = f"slice(filter(a, (x, i) -> (x & 3L) <> 2 or i = 0 or (a[i - 1] & 3L) <> 2), 1, {most})"
    scan = (
        "aggregate(l, struct(0L as n, 0L as shared, 0D as dice), (r, x) -> case when (x & 3L) = 2 "
        "then struct(r.n as n, r.shared as shared, greatest(r.dice, 2D * r.shared / (r.n + near.size)) as dice) "
        "else struct(r.n + 1 as n, r.shared + (x & 3L) as shared, r.dice as dice) end).dice"
    )
    score = f"case when size(filter(l, x -> (x & 3L) = 1)) >= near.size * {factor}D then {scan} else 0D end"
    # transform over an array of one value gives the value a name
    step = f"transform(transform(array({joined}), a -> {short}), l -> struct(l as list, greatest(s.dice, {score}) as dice))[0]"
    placed = "reverse(transform(grams, (g, k) -> struct(g.inside, g.across, shiftleft(cast(k as bigint), 2) | 2L as place)))"
    return F.expr(
        f"aggregate({placed}, struct(cast(array() as array<bigint>) as list, 0D as dice), "
        f"(s, g) -> case when s.dice >= 1 then s else {step} end).dice"
    )


def run_matches(rows: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """doc_id, text_hash, license, dice: the best run for each template of two words or more, if at least so similar.

    rows: doc_id, text_hash, text. Map-only: every document meets one broadcast row with the templates.
    """
    factor = similarity / (2 - similarity)
    table = grams.groupBy("license", "size").agg(F.collect_set("bigram").alias("t"))
    table = table.agg(F.collect_list(F.struct("license", "size", "t")).alias("templates"))
    table = table.crossJoin(grams.agg(F.collect_set("bigram").alias("every")))

    def made(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
        # an explode of one value, as expressions are not merged across it: it is made once
        return df.select(*keep, F.explode(F.array(value)).alias(name))

    key = ("doc_id", "text_hash")
    rows = made(rows.filter(F.length("text") > 2), "w", normal_words(F.col("text")), *key, "text")
    rows = made(rows, "b", F.expr(ORDERED), *key, "text").crossJoin(F.broadcast(table))
    rows = made(rows, "met", F.array_intersect("b", "every"), *key, "text", "templates").filter(F.size("met") > 0)
    near = F.filter("templates", lambda t: F.size(F.array_intersect(F.col("met"), t["t"])) >= t["size"] * F.lit(factor))
    rows = made(rows, "near", near, *key, "text").filter(F.size("near") > 0)
    pieces = F.filter(F.transform(F.split("text", PIECE_END), normal_words), lambda p: F.size(p) > 0)
    rows = made(rows, "pieces", pieces, *key, "near").filter(F.size("pieces") > 1)
    rows = made(rows, "grams", F.expr(IN_PIECES), *key, "near").select(*key, "grams", F.explode("near").alias("near"))
    rows = made(rows, "dice", F.round(_best_run(factor), 6), *key, "near")
    return rows.select(*key, "near.license", "dice").filter(F.col("dice") >= similarity)


def matches(
    docs: DataFrame,
    texts: Mapping[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """doc_id, text_hash, passage, license, dice for every passage and template at least so similar; of the runs
    the best for each template, without a number."""
    grams = template_bigrams(docs.sparkSession, texts or templates())
    bounds = grams.agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high")).first()
    if bounds["n"] > BROADCAST_BIGRAMS:
        raise ValueError("the templates have more bigrams than one broadcast may hold; scan in several calls")
    factor = similarity / (2 - similarity)
    low, high = (bounds["low"] or 0) * factor, (bounds["high"] or 0) / factor
    rows = picked(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(passages(whole_text())).alias("number", "passage")
    )
    # n distinct bigrams need more than n characters
    rows = rows.filter(F.length("passage") > F.lit(low))
    # words and bigrams are made once: expressions are not merged, nor filters moved, across an explode
    rows = rows.select("doc_id", "text_hash", "number", F.explode(F.array(normal_words(F.col("passage")))).alias("w"))
    rows = rows.select("doc_id", "text_hash", "number", F.explode(F.array(_bigrams("w"))).alias("b")).withColumn("n", F.size("b"))
    rows = rows.filter((F.col("n") >= F.lit(low)) & (F.col("n") <= F.lit(high)) & (F.col("n") > 0))
    rows = rows.select("doc_id", "text_hash", "number", "n", F.explode("b").alias("bigram"))
    table = F.broadcast(grams.withColumnRenamed("bigram", "t_bigram"))
    fits = (F.col("size") >= F.col("n") * F.lit(factor)) & (F.col("size") * F.lit(factor) <= F.col("n"))
    met = rows.join(table, (F.col("bigram") == F.col("t_bigram")) & fits)
    # rows that repeat id and text count a bigram several times
    shared = met.groupBy("doc_id", "text_hash", "number", "license", "n", "size").agg(F.count_distinct("bigram").alias("shared"))
    dice = 2 * F.col("shared") / (F.col("n") + F.col("size"))
    found = shared.withColumn("dice", F.round(dice, 6)).filter(F.col("dice") >= similarity)
    found = found.select("doc_id", "text_hash", F.col("number").alias("passage"), "license", "dice")
    whole = picked(docs, doc_id=doc_id, text=text).select("doc_id", F.xxhash64("text").alias("text_hash"), whole_text().alias("text"))
    runs = run_matches(whole, grams, similarity)
    return found.unionByName(runs.withColumn("passage", F.lit(None).cast("int")))


def scan(
    docs: DataFrame,
    texts: Mapping[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per input row: doc_id, license (the most similar; ties go to the first name), dice, n_licenses,
    licenses (all found, sorted).

    Documents without a match, null and empty texts have a null license, dice 0 and no licenses. Rows that
    repeat id and text are reported each; other columns are ignored.
    """
    found = matches(docs, texts, doc_id, text, similarity)
    per = found.groupBy("doc_id", "text_hash", "license").agg(F.max("dice").alias("dice"))
    per_doc = per.groupBy("doc_id", "text_hash").agg(
        F.min(F.struct((-F.col("dice")).alias("order"), "license")).alias("best"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
    )
    # written, so that its size is known and the few matches are broadcast if they are few
    per_doc = materialize(
        per_doc.select(
            F.struct("doc_id", "text_hash").alias("key"), F.col("best.license").alias("license"),
            (-F.col("best.order")).alias("dice"), "licenses",
        ),
        "licenses",
    )
    rows = picked(docs, doc_id=doc_id, text=text).select("doc_id", F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("key"))
    return rows.join(per_doc, rows["key"].eqNullSafe(per_doc["key"]), "left").select(
        "doc_id",
        "license",
        F.coalesce("dice", F.lit(0.0)).alias("dice"),
        F.when(F.col("licenses").isNull(), 0).otherwise(F.size("licenses")).cast("bigint").alias("n_licenses"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
    )
