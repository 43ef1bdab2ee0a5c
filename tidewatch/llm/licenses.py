"""Licence scans by canonical digests, in DataFrame functions only.

A text is put into canonical form: lower case, copyright lines gone, punctuation and white space
as single blanks, equivalent spellings as one. Its digest, and that of each of its lines, is then
looked up among the digests of known licence texts and notices by a hash join. Only whole texts
and whole lines match; a licence name within a sentence does not.
"""

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that licence texts use for the same word, and the one kept.
SPELLINGS = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("centre", "center"),
    ("cancelled", "canceled"), ("capitalisation", "capitalization"), ("catalogue", "catalog"), ("favour", "favor"),
    ("fulfil ", "fulfill "), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("whilst", "while"), ("wilful", "willful"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("https", "http"),
]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_ISC = f"""{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.

{_ISC_END}"""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:"""
_BSD_TERMS = ["""Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.""", """Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
              """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""]
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_TERMS_END = "END OF TERMS AND CONDITIONS"


def _bsd(clauses: int) -> list[str]:
    """The text with numbers or bullets, with or without its title and the reserved rights."""
    heads = [t + r for t in ("", f"BSD {clauses}-Clause License\n\n", f"The {clauses}-Clause BSD License\n\n")
             for r in ("", "All rights reserved.\n\n")]
    marks = [[f"{k + 1}. " for k in range(clauses)], ["* "] * clauses]
    return [head + "\n\n".join([_BSD_GRANT, *(m + t for m, t in zip(mark, _BSD_TERMS, strict=False)), _BSD_END])
            for head in heads for mark in marks]


def _gnu_header(kind: str, version: str, thing: str, exact: bool) -> str:
    """The notice that the GNU licences ask to put at the top of each file."""
    terms = f"version {version} of the License"
    terms = f"{terms}." if exact else f"either {terms}, or (at your option) any later version."
    return f"""This {thing} is free software{":" if version[0] == "3" else ";"} you can redistribute it and/or modify it
under the terms of the {kind} as published by the Free Software Foundation, {terms}

This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {kind} for more details.

You should have received a copy of the {kind} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."""


def _full_texts() -> list[tuple[str, str]]:
    """The files of ``license_texts``: named by licence and edition; with and without what follows the terms."""
    out = []
    for file in sorted(resources.files("tidewatch.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        name = name.removesuffix(".spdx").removesuffix(".regents")
        out.append((name, text))
        if _TERMS_END in text:
            out.append((name, text[:text.index(_TERMS_END) + len(_TERMS_END)]))
            out.append((name, text[:text.index(_TERMS_END)]))
    return out


#: Known licences with their public texts and one-line notices.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_END}"), ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("BSL-1.0", _BOOST), ("MPL-2.0", _MPL),
]
KNOWN += [(f"BSD-{k}-Clause", text) for k in (2, 3) for text in _bsd(k)]
KNOWN += [
    (f"{short}-{version}", _gnu_header(kind, version[0] if version.endswith(".0") else version, thing, exact))
    for short, kind, versions in (("GPL", "GNU General Public License", ("2.0", "3.0")),
                                  ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
                                  ("AGPL", "GNU Affero General Public License", ("3.0",)))
    for version in versions for thing in ("program", "library") for exact in (False, True)]
KNOWN += _full_texts()
KNOWN += [(name, f"SPDX-License-Identifier: {name}") for name in (
    "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "MPL-1.1", "MPL-2.0",
    "OFL-1.1", "Unicode-3.0", "Unlicense", "Zlib")]
KNOWN += [(name, f"SPDX-License-Identifier: {name}{end}") for name in (
    "AGPL-3.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
    for end in ("", "-only", "-or-later")]

_COPYRIGHT = r"^[ \t]*(?:copyright\b|\(c\)|©)[^\n]*"
_GAPS = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The non-empty lines of a text in canonical form."""
    own = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "(?md)" + _COPYRIGHT, "")
    own = F.regexp_replace(own, _GAPS, " ")
    for other, kept in SPELLINGS:
        own = F.replace(own, F.lit(other), F.lit(kept))
    return F.filter(F.transform(F.split(own, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digests(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_whole``, the digest of the whole text, and ``_lines``, those of its lines."""
    rows = rows.withColumn("_canonical", canonical_lines(F.col(text)))
    return rows.withColumns({
        "_whole": F.sha2(F.array_join("_canonical", " "), 256),
        "_lines": F.transform("_canonical", lambda x: F.sha2(x, 256))}).drop("_canonical")


def registry(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """Digest and name of each known licence; as many rows as the list has."""
    rows = spark.createDataFrame(known, "license string, text string")
    return digests(rows, "text").select(F.col("_whole").alias("digest"), "license").distinct()


def scan(documents: DataFrame, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``doc_id``, ``whole_license``, ``licenses`` and ``n_notices`` of every document.

    ``whole_license`` is set if the entire text is a known licence; ``licenses`` lists, sorted and
    comma-joined, those of which an entire line is a notice, and ``n_notices`` counts such lines.
    Needs ``doc_id`` and ``text``; other columns are left out. Null and empty texts have none.
    Repeated rows stay: they are counted with their digest and returned as often.
    """
    rows = digests(documents.select("doc_id", "text"), "text").select(
        "doc_id", "_whole", F.explode(F.concat(
            F.array(F.struct(F.lit(True).alias("whole"), F.col("_whole").alias("digest"))),
            F.transform("_lines", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("digest"))))).alias("unit"))
    names = registry(documents.sparkSession, known)
    found = rows.select("doc_id", "_whole", "unit.*").join(F.broadcast(names), "digest", "left")
    # Units of one document are in one task, so one row per document is shuffled.
    whole, line = F.col("whole"), ~F.col("whole") & F.col("license").isNotNull()
    each = found.filter(whole | line).groupBy("doc_id", "_whole").agg(
        F.count_if(whole).alias("_copies"), F.max(F.when(whole, F.col("license"))).alias("whole_license"),
        F.array_join(F.sort_array(F.collect_set(F.when(line, F.col("license")))), ",").alias("licenses"),
        F.count_if(line).alias("_notices"))
    return each.select(
        "doc_id", "whole_license", "licenses", (F.col("_notices") / F.col("_copies")).cast("long").alias("n_notices"),
        F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_n")).drop("_n")


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def scan_sql(known: list[tuple[str, str]] = KNOWN) -> str:
    """The same result in SQL."""

    def lines(text: str) -> str:
        own = f"regexp_replace(lower(coalesce({text}, '')), {_quoted('(?m)' + _COPYRIGHT)}, '', 'g')"
        own = f"regexp_replace({own}, {_quoted(_GAPS)}, ' ', 'g')"
        for other, kept in SPELLINGS:
            own = f"replace({own}, {_quoted(other)}, {_quoted(kept)})"
        return f"list_filter(list_transform(string_split({own}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"

    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    return f"""
WITH known AS (
  SELECT DISTINCT name, sha256(array_to_string({lines('body')}, ' ')) AS digest FROM (VALUES {values}) AS t(name, body)),
canon AS (SELECT row_number() OVER () AS rid, doc_id, {lines('text')} AS parts FROM documents),
units AS (
  SELECT rid, doc_id, TRUE AS whole, sha256(array_to_string(parts, ' ')) AS digest FROM canon
  UNION ALL SELECT rid, doc_id, FALSE, sha256(part) FROM (SELECT rid, doc_id, unnest(parts) AS part FROM canon))
SELECT doc_id, max(CASE WHEN whole THEN name END) AS whole_license,
  coalesce(string_agg(DISTINCT CASE WHEN NOT whole THEN name END, ',' ORDER BY CASE WHEN NOT whole THEN name END), '') AS licenses,
  count(CASE WHEN NOT whole AND name IS NOT NULL THEN 1 END) AS n_notices
FROM units LEFT JOIN known USING (digest) GROUP BY rid, doc_id"""
