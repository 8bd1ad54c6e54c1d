"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text is made canonical (lower case, copyright lines out, punctuation to
spaces, one spelling of equivalent words), its SHA-256 is taken, and the
digest is looked up among those of known licence texts and notices.  Whole
texts are looked up, and every line of a text as a text of its own, so a
notice inside a document is found too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that licence texts spell in more than one way, and the spelling kept.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("merchantibility", "merchantability"), ("per cent", "percent"), ("noninfringement", "non infringement"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("favour", "favor"),
    ("whilst", "while"), ("behaviour", "behavior"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
]

# Known licence texts and notices, as published.
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
    'to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n'
    'The above copyright notice and this permission notice shall be included in all copies or substantial portions of '
    'the Software.\n\n'
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    'THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE '
    'AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
    'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS '
    'IN THE SOFTWARE.')
_BSD_HEAD = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
    'following conditions are met:\n\n'
    '1. Redistributions of source code must retain the above copyright notice, this list of conditions and the '
    'following disclaimer.\n\n'
    '2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the '
    'following disclaimer in the documentation and/or other materials provided with the distribution.\n\n')
_BSD_THIRD = (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote '
    'products derived from this software without specific prior written permission.\n\n')
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
    'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
    'SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
    'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, '
    'WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE '
    'USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.')
_ISC_TAIL = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    'ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, '
    'DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, '
    'WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE '
    'USE OR PERFORMANCE OF THIS SOFTWARE.')
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    'liable for any damages arising from the use of this software.\n\n'
    'Permission is granted to anyone to use this software for any purpose, including commercial applications, and to '
    'alter it and redistribute it freely, subject to the following restrictions:\n\n'
    '1. The origin of this software must not be misrepresented; you must not claim that you wrote the original '
    'software. If you use this software in a product, an acknowledgment in the product documentation would be '
    'appreciated but is not required.\n\n'
    '2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original '
    'software.\n\n'
    '3. This notice may not be removed or altered from any source distribution.')
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    'with the License. You may obtain a copy of the License at\n\n'
    'http://www.apache.org/licenses/LICENSE-2.0\n\n'
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
    'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
    'the specific language governing permissions and limitations under the License.')
KNOWN = [
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission notice "
            "appear in all copies.\n\n" + _ISC_TAIL),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted.\n\n" + _ISC_TAIL),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
]

#: A line that only says who holds the copyright.
COPYRIGHT_LINE = r"(?m)^[ \t]*((copyright[ \t]+)?(\(c\)|©)|copyright[ \t]+(by|[0-9<\[{]))[^\n]*"
WORD_GAP = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Canonical form: lower-case words with one space between, equivalent spellings unified."""
    x = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    # two spaces between words, so that each word can be replaced together with a space on either side
    x = F.concat(F.lit(" "), F.regexp_replace(x, WORD_GAP, "  "), F.lit(" "))
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.replace(x, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """One row per distinct canonical digest of the known texts and of ``more``: (known_digest, license)."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in KNOWN]))
    texts = spark.range(1).select(rows.alias("r")).select("r.license", "r.text")
    if more is not None:
        more = more.select(F.col("license").cast("string"), F.col("text").cast("string"))
        texts = texts.unionByName(more.where((canonical(F.col("text")) != "") & F.col("license").isNotNull()))
    return texts.groupBy(digest(F.col("text")).alias("known_digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, text_digest, license, line_licenses, n_license_lines.

    ``license`` is the known licence that the whole text is (null: none),
    ``line_licenses`` the licences of which a line is a known notice, sorted
    and joined by commas (empty: none), ``n_license_lines`` how many lines
    are.  Null texts have a null digest and no licence; empty ones have the
    digest of nothing and no licence.  Repeated rows are returned as often as
    they occur, each with its own count.  An empty table gives no rows; other
    columns are ignored.

    ``more`` (license, text) holds known licences besides ``KNOWN``, such as
    the full texts of the Apache and GNU licences.  The built-in list is
    broadcast; with ``more``, Spark chooses the join.
    """
    known = known_digests(docs.sparkSession, more)
    known = F.broadcast(known) if more is None else known
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    lines = d.select("doc_id", F.xxhash64("text").alias("_text"),
                     F.posexplode(F.transform(F.split("text", "\n"), digest)).alias("line", "_digest"))
    hits = lines.join(known, F.col("_digest") == F.col("known_digest")) \
        .groupBy(F.col("doc_id").alias("_id"), "_text") \
        .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"),
             F.count_distinct("line").alias("n_license_lines"))
    whole = d.select("doc_id", F.xxhash64("text").alias("_of"), digest(F.col("text")).alias("text_digest")) \
        .join(known, F.col("text_digest") == F.col("known_digest"), "left")
    return whole.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_text")), "left") \
        .select("doc_id", "text_digest", "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
                F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_digest(x: str) -> str:
    x = f"regexp_replace(lower({x}), {_sql_text(COPYRIGHT_LINE)}, ' ', 'g')"
    x = f"' ' || regexp_replace({x}, {_sql_text(WORD_GAP)}, '  ', 'g') || ' '"
    for old, new in SPELLINGS:
        x = f"replace({x}, {_sql_text(' ' + old.replace(' ', '  ') + ' ')}, {_sql_text(' ' + new.replace(' ', '  ') + ' ')})"
    return f"sha256(trim(replace({x}, '  ', ' ')))"


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB SQL."""
    values = ", ".join(f"({_sql_text(k)}, {_sql_text(t)})" for k, t in KNOWN)
    return f"""
WITH known AS (SELECT {_sql_digest('t')} AS d, min(k) AS license FROM (VALUES {values}) v(k, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS n, doc_id, text FROM documents),
lines AS (SELECT n, unnest(string_split(text, chr(10))) AS line FROM docs WHERE text IS NOT NULL),
hits AS (SELECT n, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_license_lines
         FROM (SELECT n, {_sql_digest('line')} AS d FROM lines) x JOIN known USING (d) GROUP BY n),
whole AS (SELECT n, doc_id, {_sql_digest('text')} AS text_digest FROM docs)
SELECT doc_id, text_digest, known.license AS license, coalesce(line_licenses, '') AS line_licenses,
       CAST(coalesce(n_license_lines, 0) AS BIGINT) AS n_license_lines
FROM whole LEFT JOIN known ON text_digest = known.d LEFT JOIN hits ON whole.n = hits.n"""
