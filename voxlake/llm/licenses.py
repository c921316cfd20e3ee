"""License scan by canonical digests, with DataFrame functions only.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent spellings,
white space) and hashed; a hash join finds the texts, and the single lines, that are a known licence
or notice as a whole. The known texts pass through the same expressions: ``KNOWN`` and the whole
licences in ``license_texts``, a file each, named after its id.

Every text is hashed. Of the lines only those that have the length of a known text once respelled are, and those of
more than 1.5 times the longest are not even respelled: no respelling shortens a text below two
thirds, so that the limits drop no match. ``known`` is a
catalogue; Spark broadcasts it only below its size threshold.

Defined cases: a null or empty text has the digest of an empty one and no licence; equal rows get equal results; a line that several
licences share reports the first id; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch

#: Equivalent words: the first is replaced by the second. None is longer than 1.5 times its replacement.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("initialisation", "initialization"),
    ("labour", "labor"),
    ("modernisation", "modernization"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("https", "http"),
)
COPYRIGHT_MARKS = ("copyright", "(c)", "all rights reserved")
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|all rights reserved)[^\n]*$"
#: Punctuation in ASCII, typographic quotes, dashes and the copyright sign, and white space other than line feeds.
SEPARATORS = r"!-/:-@\[-`{-~\x{2018}\x{2019}\x{201C}\x{201D}\x{2013}\x{2014}\x{00A9} \t\x0B\f\r"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: Known texts by licence id: whole licences, file headers and one-line notices. A licence has as many texts as it has forms.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)


def whole_licenses() -> list[tuple[str, str]]:
    """License id and text of the files in license_texts."""
    texts = (f for f in files("voxlake.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in texts)


def plain(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation; lines stay. Most single spaces are left untouched."""
    t = F.lower(text)
    marked = reduce(lambda x, y: x | y, (F.contains(t, F.lit(m)) for m in COPYRIGHT_MARKS))
    t = F.when(marked, F.regexp_replace(t, COPYRIGHT_LINE, "")).otherwise(t)
    others = SEPARATORS.replace(" ", "")
    t = F.regexp_replace(t, f"(?:[{others}]| (?=[{SEPARATORS}]))[{SEPARATORS}]*", " ")
    return F.trim(F.regexp_replace(t, r" ?\n[ \n]*", "\n"))


def folded(text: Column) -> Column:
    """A plain text on one line."""
    return F.trim(F.replace(text, F.lit("\n"), F.lit(" ")))


def respelled(text: Column) -> Column:
    out = text
    for old, new in SPELLINGS:
        out = F.regexp_replace(out, rf"\b{old}\b", new)
    words = "|".join(old for old, _ in SPELLINGS)
    return F.when(text.rlike(rf"\b(?:{words})\b"), out).otherwise(text)


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """digest, license_id, chars of the known texts, one row per digest."""
    known = known if known is not None else spark.createDataFrame([*KNOWN, *whole_licenses()], "license_id string, text string")
    text = respelled(folded(plain(F.col("text"))))
    rows = known.select("license_id", F.sha2(text, 256).alias("digest"), F.length(text).alias("chars"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.first("chars").alias("chars"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every document with the digest of its canonical text, its licence, and the licences whose whole text is one of its lines."""
    spark = docs.sparkSession
    catalogue = known_digests(spark, known)
    sizes = {r.chars for r in catalogue.select("chars").distinct().collect()}  # lengths of known texts
    most = max(sizes, default=0)
    if known is None:  # a row for each text in KNOWN and license_texts
        catalogue = F.broadcast(catalogue)
    catalogue = catalogue.drop("chars")

    def digest(t: Column) -> Column:
        u = respelled(t)
        return F.when((F.length(t) <= 1.5 * most) & F.length(u).isin(sizes), F.sha2(u, 256))

    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64(text).alias("text_key"), plain(text).alias("plain"))
    short = F.filter(F.split("plain", "\n"), lambda x: F.length(x).between(1, math.ceil(1.5 * most)))
    found = Scratch(spark, "licenses").save(
        base.select("doc_id", "text_key", F.length("plain").cast("long").alias("n_chars"), F.sha2(respelled(folded(F.col("plain"))), 256).alias("digest"), F.filter(F.transform(short, lambda x: digest(F.trim(x))), lambda d: d.isNotNull()).alias("lines")), "digests"
    )
    whole = found.select("doc_id", "text_key", "n_chars", "digest").join(catalogue, "digest", "left")
    lines = found.select("doc_id", "text_key", F.explode("lines").alias("digest"))
    notices = lines.join(catalogue, "digest").groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("license_id")).alias("notices"))
    notices = notices.withColumnsRenamed({"doc_id": "n_id", "text_key": "n_key"})
    out = whole.join(notices, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("text_key") == F.col("n_key")), "left")
    return out.select("doc_id", "n_chars", "digest", "license_id", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, and those of its lines."""
    out = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.withColumn("notices", F.array_join("notices", ";"))


def _sql() -> str:
    q = lambda s: s.replace("'", "''")

    def plain_sql(t: str) -> str:
        t = f"regexp_replace(lower({t}), '{q(COPYRIGHT_LINE)}', '', 'g')"
        t = f"regexp_replace({t}, '[{q(SEPARATORS)}]+', ' ', 'g')"
        return rf"trim(regexp_replace({t}, ' ?\n[ \n]*', chr(10), 'g'))"

    def respelled_sql(t: str) -> str:
        for old, new in SPELLINGS:
            t = rf"regexp_replace({t}, '\b{old}\b', '{new}', 'g')"
        return t

    fold = lambda t: f"trim(replace({t}, chr(10), ' '))"
    values = ", ".join(f"('{q(i)}', '{q(t)}')" for i, t in (*KNOWN, *whole_licenses()))
    return f"""
WITH k0 AS (SELECT v.id AS license_id, {respelled_sql(fold(plain_sql('v.t')))} AS t FROM (VALUES {values}) v(id, t)),
k AS (SELECT sha256(t) AS digest, min(license_id) AS license_id FROM k0 GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, {plain_sql("coalesce(text, '')")} AS p FROM documents),
whole AS (SELECT r, doc_id, length(p)::BIGINT AS n_chars, sha256({respelled_sql(fold('p'))}) AS digest FROM d),
lines AS (SELECT r, sha256({respelled_sql('l')}) AS digest FROM (SELECT r, trim(unnest(string_split(p, chr(10)))) AS l FROM d) WHERE l <> ''),
n AS (SELECT r, array_to_string(list_sort(list(DISTINCT license_id)), ';') AS notices FROM lines JOIN k USING (digest) GROUP BY r)
SELECT doc_id, n_chars, digest, license_id, coalesce(notices, '') AS notices FROM whole LEFT JOIN k USING (digest) LEFT JOIN n USING (r)
"""


OP6_SQL = _sql()
