"""License scans by canonical digest: texts that differ in case, punctuation, copyright lines or spelling share a digest. Native."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound
from .license_digests import DIGESTS

#: Spellings that count as equal, in lower case. Fixed values.
SPELLINGS = {
    "licence": "license",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "sub license": "sublicense",
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorisation": "authorization",
    "authorised": "authorized",
    "favour": "favor",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "noninfringement": "non infringement",
    "organisation": "organization",
    "percent": "per cent",
    "recognise": "recognize",
    "whilst": "while",
    "copyright holder": "copyright owner",
    "copyright holders": "copyright owners",
    "https": "http",
}

#: Known licences: canonical short texts. Fixed values.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
}

#: Title lines under which the known texts are usually stored. Fixed values.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "This software is released under the MIT license:"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD-0-Clause License", "0BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
}

#: A known table of at most so many rows is sent to every executor (a digest and a name each); a larger one is shuffled.
MAX_BROADCAST = 100_000
#: A line that begins with a copyright mark and its owner, or with a reservation of rights, or that is the mark and
#: `the`, a name and `authors` or the like and no more; not one that a licence's sentence was wrapped into, such as COPYRIGHT HOLDERS BE LIABLE.
_COPYRIGHT = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:©|\(c\)|by[ \t]|:|[0-9]{4})|©|\(c\)[ \t]*[0-9]{4}|all rights reserved|copyright[ \t]+the[ \t][^\n]*(?:authors|contributors|developers|project|team|foundation)[^\p{L}\p{N}\n]*$)[^\n]*$"

#: The mark that begins a copyright statement, anywhere in a line.
_MARK = r"(?i)(?<![\p{L}\p{N}])copyright[ \t]*(?:©|\(c\)|by[ \t]|:|[0-9]{4})|©|\(c\)[ \t]*[0-9]{4}"
#: How the known licences' own sentences begin. Fixed values.
OPENINGS = (
    "permission is hereby granted", "permission to use copy", "redistribution and use in", "this software is provided", "licensed under the", "licensed under cc",
    "this work is licensed under", "everyone is permitted to copy", "terms and conditions for use", "this is free and unencumbered",
)
_OPENING = r"(?i)(?=(?<![\p{L}\p{N}])(?:" + "|".join(o.replace(" ", r"[^\p{L}\p{N}]+") for o in OPENINGS) + "))"


#: What a text holds, in lower case, if one of the two patterns above is to find anything. Fixed values.
_SIGNS = ("copyright", "©", "(c)", "all rights reserved")


def _signed(text: Column) -> Column:
    """Whether a pattern may find anything: a plain search, by which most texts are spared the patterns."""
    return bound(F.lower(text), lambda low: reduce(or_, [low.contains(sign) for sign in _SIGNS]))


def canonical(text: Column) -> Column:
    """Copyright lines dropped, lower case, runs of anything but letters and digits as one space, equivalent spellings as one.

    Null is the empty text. Words stand between two spaces of their own while spellings are replaced, so that
    neighbours are replaced both; each spelling is looked for once, in the order of the table.
    """
    whole = F.coalesce(text, F.lit(""))
    kept = F.when(_signed(whole), F.regexp_replace(whole, _COPYRIGHT, "")).otherwise(whole)
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(kept), r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    for old, new in SPELLINGS.items():
        words = F.replace(words, F.lit(_apart(old)), F.lit(_apart(new)))
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def _apart(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def canonical_sql(text: str) -> str:
    """canonical() for DuckDB."""
    kept = f"regexp_replace(coalesce({text}, ''), '{_COPYRIGHT}', '', 'g')"
    words = rf"' ' || trim(regexp_replace(lower({kept}), '[^\p{{L}}\p{{N}}]+', '  ', 'g')) || ' '"
    for old, new in SPELLINGS.items():
        words = f"replace({words}, '{_apart(old)}', '{_apart(new)}')"
    return f"trim(replace({words}, '  ', ' '))"


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def without_statement(text: Column) -> Column:
    """The text without what stands from its first copyright mark to the licence's opening words in the same line; null if
    there is no such mark or opening. A licence stored as one line is otherwise dropped as a copyright line, or keeps its owner.
    """
    parts = F.split(text, _MARK, 2)

    def of(halves: Column) -> Column:
        return bound(F.split(F.concat(F.lit(" "), F.get(halves, F.lit(1))), _OPENING, 2), lambda rest: F.when((F.size(rest) == 2) & ~rest[0].contains("\n"), F.concat(halves[0], F.lit("\n"), F.get(rest, F.lit(1)))))

    return F.when(_signed(text) & text.rlike(_MARK), bound(parts, of))


def known_licenses(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """license_id, text of the fixed short licences, or of those given."""
    return spark.createDataFrame(sorted((known or KNOWN).items()), "license_id string, text string")


def common_licenses(spark: SparkSession) -> DataFrame:
    """canonical_sha256, license_id: the known texts under their titles, and the common full licence texts."""
    titled = [(name, f"{title}\n\n{KNOWN[name]}") for name, titles in TITLES.items() for title in titles]
    texts = spark.createDataFrame(titled, "license_id string, text string").select(digest(F.col("text")).alias("canonical_sha256"), "license_id")
    return texts.union(spark.createDataFrame([(d, name) for name, ds in DIGESTS.items() for d in ds], "canonical_sha256 string, license_id string"))


def scan(docs: DataFrame, known: DataFrame, max_broadcast: int = MAX_BROADCAST, digests: DataFrame | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license_id (null: no known licence is the whole text) for every row of docs (doc_id, text).

    Known texts that share a digest are one licence, the first id by code point. An empty canonical text matches
    nothing. Null texts are empty; repeated rows stay; extra columns are ignored. The known table is sent to executors
    only if a count of its rows stays within max_broadcast; else both sides meet by digest. Licences whose digests are
    known already (canonical_sha256, license_id) may be given beside the texts. A text that matches nothing is tried again
    without its copyright statement alone; canonical_sha256 is that of the whole text.
    """
    table = known.select(digest(F.col("text")).alias("canonical_sha256"), "license_id").where(canonical(F.col("text")) != "")
    rows = known.select("license_id")
    if digests is not None:
        table, rows = table.union(digests.select("canonical_sha256", "license_id")), rows.union(digests.select("license_id"))
    table = table.groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))
    few = rows.limit(max_broadcast + 1).count() <= max_broadcast
    again = bound(without_statement(F.col("text")), lambda t: F.when(t.isNotNull(), digest(t)))
    # the whole text's digest once a row, whatever the optimizer merges
    both = F.transform(F.array(digest(F.col("text"))), lambda whole: F.struct(whole.alias("canonical_sha256"), F.coalesce(again, whole).alias("_again")))
    found = docs.select("doc_id", "text").select("doc_id", F.inline(both))
    again = table.select(F.col("canonical_sha256").alias("_again"), F.col("license_id").alias("_license"))
    if few:
        table, again = F.broadcast(table), F.broadcast(again)
    return found.join(table, "canonical_sha256", "left").join(again, "_again", "left").select("doc_id", "canonical_sha256", F.coalesce("license_id", "_license").alias("license_id"))


def matches(found: DataFrame) -> DataFrame:
    """license_id, n, n_docs: the texts of a scan that are a known licence, and the documents that they are of.

    Texts without a licence, nulls among them, count nowhere; repeated rows count each in n, documents of a null id not in
    n_docs. Nothing found, or an empty table: no rows.
    """
    return found.where("license_id is not null").groupBy("license_id").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


def _known_sql(known: dict[str, str] | None = None) -> str:
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted((known or KNOWN).items()))
    return f"""known(license_id, text) as (values {values}),
k as (select sha256({canonical_sql('text')}) as canonical_sha256, min(license_id) as license_id from known group by 1)"""


def oracle(known: dict[str, str] | None = None) -> str:
    return f"""
with {_known_sql(known)},
d as (select doc_id, sha256({canonical_sql('text')}) as canonical_sha256 from documents)
select d.doc_id, d.canonical_sha256, k.license_id from d left join k using (canonical_sha256)
"""


def lines_oracle(known: dict[str, str] | None = None) -> str:
    return f"""
with {_known_sql(known)},
d as (select doc_id, unnest(string_split(text, chr(10))) as text from documents),
f as (select doc_id, sha256({canonical_sql('text')}) as canonical_sha256 from d)
select license_id, count(*) as n, count(distinct doc_id) as n_docs from f join k using (canonical_sha256) group by 1
"""
