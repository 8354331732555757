"""Licence scan by canonical digest lookup (operator 7), DataFrame functions only.

A text is reduced to a canonical form (A-Z in lower case, copyright lines out,
equivalent spellings made one, punctuation and white space to single spaces)
and hashed; the digest is joined to the digests of known licence texts.  The
whole text is looked up, and so is each of its lines and paragraphs as a text
of its own, since notices stand in documents as lines.  The known texts are a
fixed, small table, which is broadcast; a user's own can be added.

Defined results: null and empty texts match nothing; repeated rows are looked
up once per row and yield one row per (doc_id, text); null ids yield a row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from claimlens.llm.common import keyed, lower_ascii

# Public licence texts and customary notices, by SPDX identifier.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_SHORT = (
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "SPDX-License-Identifier: ISC"),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
)
_BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
              "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
              "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
              "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _bsd(clauses: int, numbered: bool, holders: str = "HOLDERS") -> str:
    terms = [f"{i}. {t}" if numbered else f"* {t}" for i, t in enumerate(_BSD_TERMS[1:clauses + 1], 1)]
    return "\n\n".join([_BSD_TERMS[0], *terms, _BSD_DISCLAIMER.replace("HOLDERS", holders)])


_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN = _SHORT + tuple(
    (f"BSD-{n}-Clause", title + _bsd(n, numbered, holders)) for n, titles in ((2, ("", "BSD 2-Clause License\n\n", "The 2-Clause BSD License\n\n")),
                                                                               (3, ("", "BSD 3-Clause License\n\n", "The 3-Clause BSD License\n\n")))
    for title in titles for numbered in (False, True) for holders in ("HOLDERS", "HOLDER")) + (
    ("Unlicense", _UNLICENSE), ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org/>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org>"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("BSL-1.0", _BSL), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + _BSL), ("BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("Apache-2.0", _APACHE),
)
#: Spellings that count as one: pattern on the lower-cased text, replacement.
SPELLINGS = (
    (r"licence", "license"), (r"sub-license", "sublicense"), (r"non-infringement", "noninfringement"), (r"non-commercial", "noncommercial"),
    (r"copyright owner", "copyright holder"), (r"acknowledgement", "acknowledgment"), (r"merchantibility", "merchantability"),
    (r"creative commons attribution-noncommercial", "cc by-nc"), (r"creative commons attribution", "cc by"),
    (r"4\.0 international license", "4.0"), (r"gnu gpl", "gnu general public license"), (r"version 3(\.0)?|\bv3(\.0)?", "version 3"),
    (r"\bv2\.0\b", "version 2.0"), (r"licensed under the cc ", "licensed under cc "), (r"https?://", ""),
)
#: Lines that are notices: a sign, a year, 'by' or a holder follows.  A wrapped
#: licence text has lines like 'copyright notice and this permission notice ...' too.
NO_HOLDER = (r"(notices?|holders?|owners?|laws?|licen[cs]es?|statements?|interests?|protection|infringement|rights?|claims?|works?|treat(y|ies)|acts?|disclaimers?|"
             r"and|or|in|to|is|of|for|as|on|at|with|from|that|this|may|must|shall|will|are|under|subsisting)\b")
NOTICE_LINE = (rf"^[^a-z0-9\n]*(copyright[ \t:,]*(\(c\)|\x{{00A9}}|[0-9])|copyright[ \t:]+(?!{NO_HOLDER})"
               r"[^ \t\n,.;]|\(c\)|\x{00A9}|all rights reserved)[^\n]*$")
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{00A0}\x{00A9}\x{2010}-\x{2015}\x{2018}-\x{201F}\x{2022}\x{2026}]+"


#: Every known text holds one of these, and no rule above makes or breaks one,
#: so a text without them needs no canonical form.
SIGNS = ("licen", "permission", "redistributions", "unencumbered")


def _may_match(text: Column) -> Column:
    low = F.lower(text)
    return reduce(or_, [low.contains(sign) for sign in SIGNS])


def canonical(text: Column) -> Column:
    """The canonical form of a text; '' when nothing but notices is left."""
    out = F.regexp_replace(lower_ascii(text), "(?md)" + NOTICE_LINE, "")
    for pattern, one in SPELLINGS:
        out = F.regexp_replace(out, pattern, one)
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, licence) of known texts (licence, text)."""
    forms = known.select("licence", canonical(F.col("text")).alias("form")).where("form <> ''")
    return forms.select(F.sha2("form", 256).alias("digest"), "licence").distinct()


def licences(df: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, whole_licence (of the entire text, or
    null), licences (of the text, its paragraphs and lines; sorted, joined by
    commas, '' for none), notices (how many of its parts match).  ``more`` has
    known texts (licence, text) besides ``KNOWN``; with it every part's canonical
    form is made, as its texts need not hold one of ``SIGNS``."""
    docs = keyed(df)
    known = F.broadcast(known_digests(df.sparkSession.createDataFrame(list(KNOWN), "licence string, text string")))
    may_match = _may_match
    if more is not None:
        known = known.union(known_digests(more)).distinct()
        may_match = lambda text: F.lit(True)
    # Parts: the whole text (0), paragraphs and lines; a text of one line is one part.
    lines, paragraphs = F.split("text", "\n"), F.split("text", r"\n[ \t]*\n")
    parts = F.when(F.instr("text", "\n") == 0, F.array("text")).when(F.size(paragraphs) == 1, F.concat(F.array("text"), lines)).otherwise(
        F.concat(F.array("text"), paragraphs, F.filter(lines, lambda x: F.length(x) > 0)))
    found = docs.where(may_match(F.col("text"))).select("key", "part", F.posexplode(parts).alias("pos", "piece"))
    found = found.where(may_match(F.col("piece"))).withColumn("form", canonical(F.col("piece")))
    found = found.where("form <> ''").select("key", "part", "pos", F.sha2("form", 256).alias("digest")).join(known, "digest")
    found = found.groupBy("key", "part").agg(F.max(F.when(F.col("pos") == 0, F.col("licence"))).alias("whole_licence"),
                                             F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"), F.countDistinct("pos").alias("notices"))
    rows = docs.select("doc_id", "key", "part").distinct()
    return rows.join(found, ["key", "part"], "left").select("doc_id", "whole_licence", F.coalesce("licences", F.lit("")).alias("licences"),
                                                            F.coalesce("notices", F.lit(0)).cast("long").alias("notices"))


def oracle() -> str:
    """The same in DuckDB SQL (rows of unique ids), whose patterns have no
    lookahead: a line is a notice if it starts like one and no such word follows."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    starts = lambda line, pattern: f"regexp_matches({line}, {quote('^[^a-z0-9]*' + pattern)})"
    plain = starts("x", r"(copyright[ \t:,]*(\(c\)|\x{00A9}|[0-9])|copyright[ \t:]+:|\(c\)|\x{00A9}|all rights reserved)")
    named = f"{starts('x', '(copyright[ \\t:]+[^ \\t:,.;])')} AND NOT {starts('x', '(copyright[ \\t:]+' + NO_HOLDER + ')')}"

    def form(x: str) -> str:
        low = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        out = f"array_to_string(list_transform(string_split({low}, chr(10)), lambda x: CASE WHEN {plain} OR ({named}) THEN '' ELSE x END), chr(10))"
        for pattern, one in SPELLINGS:
            out = f"regexp_replace({out}, {quote(pattern)}, {quote(one)}, 'g')"
        return f"trim(regexp_replace({out}, {quote(PUNCTUATION)}, ' ', 'g'))"

    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in KNOWN)
    signs = " OR ".join(f"contains(lower(piece), '{sign}')" for sign in SIGNS)
    return f"""
WITH known AS (SELECT DISTINCT licence, sha256({form('t')}) AS digest FROM (VALUES {values}) v(licence, t)),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS (
  SELECT doc_id, CASE WHEN instr(text, chr(10)) = 0 THEN [text]
      WHEN len(regexp_split_to_array(text, '\\n[ \\t]*\\n')) = 1 THEN [text] || string_split(text, chr(10))
      ELSE [text] || regexp_split_to_array(text, '\\n[ \\t]*\\n') || list_filter(string_split(text, chr(10)), lambda x: length(x) > 0) END AS pieces FROM docs),
parts AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS pos FROM lists),
found AS (
  SELECT doc_id, max(CASE WHEN pos = 0 THEN licence END) AS whole_licence, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(DISTINCT pos) AS notices
  FROM (SELECT doc_id, pos, {form('piece')} AS form FROM parts WHERE {signs}) JOIN known ON sha256(form) = digest WHERE form <> '' GROUP BY doc_id)
SELECT d.doc_id, f.whole_licence, coalesce(f.licences, '') AS licences, coalesce(f.notices, 0) AS notices FROM docs d LEFT JOIN found f USING (doc_id)"""
