"""License scans: canonical forms of whole texts, and of their lines, looked up by digest among known licenses.

All of it is DataFrame functions. Each step exists as SQL text too, so that another engine can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.llm import license_texts

# Spellings that count as the same, after case and punctuation have gone.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
    ("redistributions", "redistribution"), ("copyright owner", "copyright holder"), ("per cent", "percent"),
    ("non commercial", "noncommercial"), ("whilst", "while"), ("https", "http"))

#: A line with a copyright mark, a year or a holder; a wrapped line that begins with the word alone stays.
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(?:(?:copyright[ \t]*)?(?:\(c\)|©)|copyright[ \t]+(?:[0-9<\[{]|by )|all rights reserved)[^\n]*$"
#: ASCII punctuation, white space but the line feed, and common typographic signs.
PUNCTUATION = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f“”‘’„«»–—…©®™ ]+"

_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
             "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
            "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
            "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
            "DAMAGE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
            "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
            "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
            "USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
           "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
           "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
           "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
           "governing permissions and limitations under the License.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY +
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.")
_ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
         "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
         "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
         "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
         "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
         "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
         "the original software. 3. This notice may not be removed or altered from any source distribution.")

# Titles that short licenses carry above their text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "MIT"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "2-Clause BSD License",
                     "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License", "The BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "3-Clause BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "Modified BSD License", "BSD License",
                     "The BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC License (ISCL)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "Zero Clause BSD License",
             "BSD Zero Clause License (0BSD)", "0BSD License", "0BSD"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License")}
_APPENDIX = "END OF TERMS AND CONDITIONS"


def _forms(name: str, text: str) -> list[tuple[str, str]]:
    """A short license with and without its titles, and with marks in the place of the numbers of its clauses."""
    bare = text
    for number in ("1. ", "2. ", "3. "):
        bare = bare.replace(number, "")
    return [(name, f"{title} {form}".strip()) for form in dict.fromkeys((text, bare)) for title in ("", *TITLES[name])]


def _published(name: str, text: str) -> list[tuple[str, str]]:
    """A long license as published, without the line that ends its terms and what follows, and with that line only."""
    terms = text.split(_APPENDIX)[0]
    return [(name, form) for form in dict.fromkeys((text, terms, terms + _APPENDIX if _APPENDIX in text else text))]


# Texts of known licenses and usual notices, by license identifier.
KNOWN = (
    *_forms("MIT", _MIT), *_forms("BSD-2-Clause", _BSD + _BSD_END),
    *_forms("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
            "endorse or promote products derived from this software without specific prior written permission. " + _BSD_END),
    *_forms("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_END),
    *_forms("0BSD", _ISC + ". " + _ISC_END), *_forms("Zlib", _ZLIB),
    *_published("Apache-2.0", license_texts.APACHE_2_0), *_published("GPL-2.0", license_texts.GPL_2_0),
    *_published("GPL-3.0", license_texts.GPL_3_0), *_published("LGPL-2.1", license_texts.LGPL_2_1),
    *_published("LGPL-3.0", license_texts.LGPL_3_0), *_published("MPL-2.0", license_texts.MPL_2_0),
    *_published("CC0-1.0", license_texts.CC0_1_0), *_published("Unlicense", license_texts.UNLICENSE), ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."))


def _spelled(text: Column) -> Column:
    for other, usual in SPELLINGS:
        text = F.replace(text, F.lit(other), F.lit(usual))
    return text


def canonical_lines(text: Column) -> Column:
    """The text in lower case without copyright lines and punctuation, its lines kept apart."""
    plain = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), COPYRIGHT_LINE, " ")
    return F.regexp_replace(plain, PUNCTUATION, " ")


def canonical_whole(lines: Column) -> Column:
    return _spelled(F.trim(F.regexp_replace(lines, "[ \n]+", " ")))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """(id, digest, license, notices), one row for each row of `docs`.

    digest is the SHA-256 of the canonical whole text; license is the known license with that digest, else null; notices
    are the licenses whose notice is a whole line of the text, distinct, sorted and comma-joined, else empty. The list of
    known texts is a parameter; its digests are broadcast. Null texts count as empty and have no license; repeated rows
    and null ids come back as they are.
    """
    spark = docs.sparkSession
    lines = canonical_lines(F.col("text"))
    listed = spark.createDataFrame([(n, t) for n, t in known], "name string, text string").select(
        "name", canonical_whole(lines).alias("canon")).where("canon <> ''")
    digests = listed.groupBy(F.sha2("canon", 256).alias("k_digest")).agg(F.min("name").alias("license"))
    by_notice = {r["canon"]: r["name"] for r in listed.orderBy(F.desc("name")).collect()}
    lengths = sorted({len(c) for c in by_notice})
    marked = docs.select(docs[id_column].alias("__id"), canonical_lines(docs[text_column]).alias("lines"))
    marked = marked.select("__id", F.sha2(canonical_whole(F.col("lines")), 256).alias("digest"),
                           F.transform(F.split("lines", "\n"), lambda x: _spelled(F.trim(x))).alias("each"))
    names = F.create_map(*[F.lit(v) for pair in sorted(by_notice.items()) for v in pair]) if by_notice else None
    if names is None:
        notices = F.lit("")
    else:
        short = F.filter("each", lambda x: F.length(x).isin(lengths))
        found = F.filter(F.transform(short, lambda x: names[x]), lambda x: x.isNotNull())
        notices = F.array_join(F.array_sort(F.array_distinct(found)), ",")
    return marked.join(F.broadcast(digests), F.col("digest") == F.col("k_digest"), "left").select(
        F.col("__id").alias(id_column), "digest", "license", notices.alias("notices"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spelled_sql(text: str) -> str:
    for other, usual in SPELLINGS:
        text = f"replace({text}, {_quoted(other)}, {_quoted(usual)})"
    return text


def scan_sql(known: Sequence[tuple[str, str]] = KNOWN, source: str = "documents") -> str:
    """The same scan of a table with doc_id and text, in SQL."""
    lines = (f"regexp_replace(regexp_replace(lower(coalesce(text, '')), {_quoted(COPYRIGHT_LINE)}, ' ', 'g'), "
             f"{_quoted(PUNCTUATION)}, ' ', 'g')")
    whole = _spelled_sql(r"trim(regexp_replace(lines, '[ \n]+', ' ', 'g'))")
    values = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in known)
    line = _spelled_sql("trim(x)")
    return f"""
        WITH listed AS (SELECT name, {whole} AS canon FROM (SELECT name, {lines} AS lines FROM (VALUES {values}) v(name, text))),
        known AS (SELECT canon, min(name) AS name FROM listed WHERE canon <> '' GROUP BY canon),
        marked AS (SELECT row_number() OVER () AS n, doc_id, {lines} AS lines FROM {source}),
        spread AS (SELECT n, unnest(string_split(lines, chr(10))) AS x FROM marked),
        found AS (SELECT n, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
                  FROM (SELECT n, {line} AS canon FROM spread) s JOIN known USING (canon) GROUP BY n)
        SELECT doc_id, digest, name AS license, coalesce(notices, '') AS notices
        FROM (SELECT n, doc_id, {whole} AS canon, sha256({whole}) AS digest FROM marked) m
        LEFT JOIN known USING (canon) LEFT JOIN found USING (n)"""
