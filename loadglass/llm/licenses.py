"""License scans by lookup of canonical digests.

A text is brought into canonical form: lower case, no copyright lines, equivalent
spellings made one, punctuation and white space collapsed. Two copies of a licence that
differ in these only have the same digest. Digests of whole texts are joined with those of
known licences and notices; a whole text is the document, each of its paragraphs (what
stands between blank lines) and each of its lines.

The full texts of licences are found anywhere, from the beginning of a line on, however
they are wrapped: where a line begins like one of them, as many characters as it has are
digested too.
"""

import pkgutil
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadglass.llm.common import TEXT_HASH, match, text_hash, written

# ---- Fixed values: published licences, their names, and equivalent spellings ------
LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License.""",
}

# Names that notices use.
NAMES = {
    "MIT": ["the MIT License", "MIT License", "MIT"],
    "Apache-2.0": [
        "the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0",
        "Apache-2.0",
    ],
    "GPL-2.0": [
        "the GNU General Public License, version 2", "the GNU GPL, version 2", "GPLv2", "GPL-2.0",
    ],
    "GPL-3.0": [
        "the GNU General Public License, version 3", "the GNU GPL, version 3", "GPLv3", "GPL-3.0",
    ],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "BSD-3-Clause"],
    "ISC": ["the ISC License", "ISC"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
}

# Each notice is one of these before one of the names.
LEADS = [
    "Licensed under", "Released under", "Distributed under", "Available under",
    "This work is licensed under", "This software is licensed under",
    "This project is licensed under", "SPDX-License-Identifier:",
]

# Spelling, and the one that it counts as.
SPELLINGS = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("organisation", "organization"), ("authorise", "authorize"), ("honour", "honor"),
    ("recognise", "recognize"), ("analogue", "analog"), ("artefact", "artifact"),
    ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"), ("https:", "http:"),
]
# ----------------------------------------------------------------------------------

# In either dialect of patterns: only \n ends a line.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(?:copyright|\(c\)|©)[^\n]*"
# A statement of copyright, and no line of prose that the word begins.
STATEMENT = (
    r"(^|\n)[ \t*#/;-]*(?:copyright[ \t]*(?:\(c\)|©|by\b|[0-9]{4}|\[yyyy\])"
    r"|\(c\)[ \t]*(?:copyright|[0-9]{4})|©)[^\n]*"
)
# File name, where its terms begin and what comes after them; none: as the file does.
FULL_TEXTS = [
    ("Apache-2.0", "TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS"),
    ("GPL-2.0", "Everyone is permitted", "END OF TERMS AND CONDITIONS"),
    ("GPL-3.0", "Everyone is permitted", "END OF TERMS AND CONDITIONS"),
    ("LGPL-2.1", "Everyone is permitted", "END OF TERMS AND CONDITIONS"),
    ("LGPL-3.0", "This version of the GNU Lesser", None),
    ("MPL-2.0", "1. Definitions", "Exhibit A - Source"),
    ("CC0-1.0", "Statement of Purpose", None),
    ("Unlicense", None, None),
    ("BSD-2-Clause", None, None),
    ("BSD-3-Clause", None, None),
    ("BSD-3-Clause.regents", "Redistribution and use", None),
]
# Canonical lines that may stand before the terms.
TITLES = [
    "(?:the )?(?:mit|isc|zlib|bsd|apache|mozilla public)(?: [23] clause)?(?: (?:license|mit|isc|zlib))*",
    "(?:the )?(?:new |modified |simplified |[23] clause )?bsd(?: [23] clause)? license(?: .{0,30})?",
    "gnu (?:lesser )?general public license", "mozilla public license version 2 0",
    "version [0-9][a-z0-9 ]{0,25}", "http www apache org licenses", "(?:the )?unlicense",
    "creative commons legal code", "cc0 1 0 universal", "license", "all rights reserved",
]
TITLE_LINES = rf"^(?:(?:{'|'.join(TITLES)})\n)+"
# Spellings whose words may be on two lines.
TERM_SPELLINGS = [
    ("holder", "owner"), ("noncommercial", "non commercial"), ("sublicens", "sub licens"),
]
# A word that each full text has.
LICENSE_WORD = "(?i)software|licen[sc]e"
ANCHOR_WORDS = 3
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def canonical_lines(text: Column, gone: str = COPYRIGHT_LINE) -> Column:
    """The canonical lines of a text; lines without words are empty."""
    lower = F.translate(text, UPPER, UPPER.lower())
    kept = F.regexp_replace(lower, gone, "$1")
    spelled = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, kept)
    spaced = F.regexp_replace(spelled, PUNCTUATION, " ")
    return F.transform(F.split(spaced, "\n", -1), lambda line: F.trim(line))


def _joined(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def _units(lines: Column) -> Column:
    """64-bit digests of the document, its paragraphs and its lines, each once: there is
    one for every line of the corpus, and one for a few hundred known texts."""
    paragraphs = F.split(F.regexp_replace(F.array_join(lines, "\n"), r"\n\n+", "\x00"), "\x00", -1)
    units = F.transform(
        F.concat(F.array(_joined(lines)), lines, F.transform(paragraphs, lambda part: F.replace(part, F.lit("\n"), F.lit(" ")))),
        lambda unit: F.trim(unit),
    )
    return F.array_distinct(
        F.transform(F.filter(units, lambda unit: unit != ""), lambda unit: F.xxhash64(unit))
    )


def _terms(text: Column) -> Column:
    """The canonical lines with words of a text that may be a licence, without titles,
    statements of copyright and reserved rights."""
    lines = F.filter(canonical_lines(text, STATEMENT), lambda line: line != "")
    lines = F.filter(lines, lambda line: line != "all rights reserved")
    # Spellings of several words, which a line may end in, by words of their own.
    whole = F.array_join(lines, "\n")
    for old, new in TERM_SPELLINGS:
        whole = F.replace(whole, F.lit(old), F.lit(new))
    return F.split(F.regexp_replace(whole, F.lit(TITLE_LINES), ""), "\n", -1)


def _runs(terms: Column, texts: list[tuple[str, int, int]]) -> Column:
    """Digests of what begins with a line of ``terms`` and is as long as one of ``texts``
    (text, characters, words) that begins like it."""
    anchors = {tuple(text.split(" ")[:ANCHOR_WORDS]) for text, _, _ in texts}
    begins = "|".join("(?: |$)(?:$|".join(words) + "(?: |$)" + ")" * (len(words) - 1) for words in anchors)
    sizes = F.array(
        *(
            F.struct(
                F.lit(" ".join(text.split(" ")[:ANCHOR_WORDS])).alias("anchor"),
                F.lit(chars).alias("chars"), F.lit(words).alias("words"),
            )
            for text, chars, words in sorted(texts)
        )
    )
    starts = F.filter(
        F.transform(
            terms,
            lambda line, at: F.when(F.rlike(line, F.lit(f"^(?:{begins})")), at + 1),
        ),
        lambda at: at.isNotNull(),
    )
    # Each line has a word at least, so a text has no more lines than words.
    runs = F.flatten(
        F.transform(
            starts,
            lambda at: F.transform(
                F.filter(
                    sizes,
                    lambda size: F.array_join(
                        F.slice(terms, at, F.lit(ANCHOR_WORDS)), " "
                    ).startswith(size["anchor"]),
                ),
                lambda size: F.struct(
                    F.array_join(F.slice(terms, at, size["words"]), " ").alias("run"),
                    size["chars"].alias("chars"),
                ),
            ),
        )
    )
    whole = F.filter(
        runs, lambda x: F.substr(x["run"], x["chars"] + 1, F.lit(1)).isin("", " ")
    )
    return F.transform(whole, lambda x: F.xxhash64(F.substr(x["run"], F.lit(1), x["chars"])))


def full_texts() -> list[tuple[str, str, bool]]:
    """(name, text, whether it is nothing but the terms) of the published full texts, with
    and without what comes before and after the terms."""
    found = [(name, text, True) for name, text in LICENSES.items()]
    for file, begin, after in FULL_TEXTS:
        text = pkgutil.get_data(__package__, f"license_texts/{file}.txt").decode("utf-8")
        name = file.removesuffix(".regents")
        first = text.index(begin) if begin else 0
        last = text.index(after, first) if after else len(text)
        # Lists of conditions are numbered or not.
        terms = text[first:last]
        listed = [terms]
        if name.startswith("BSD"):
            plain = re.sub(r"(?m)^ *(?:\*|[123]\.)", "", terms)
            numbers = iter("123")
            listed = [plain, re.sub(
                r"(?m)^ *(?=Redistributions of|Redistributions in|Neither)",
                lambda m: f"{next(numbers)}. ", plain,
            )]
        found += [(name, part, True) for part in listed]
        found += [(name, text[:last], False), (name, text, False)]
        if after and after.startswith("END"):
            found.append((name, text[:last] + after, False))
    return found


def known_texts() -> list[tuple[str, str]]:
    """(name, text) of the known licences and notices."""
    notices = [
        (spdx, f"{lead} {name}.")
        for spdx, names in NAMES.items()
        for name in names
        for lead in LEADS
    ]
    return list(LICENSES.items()) + notices


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, unit, license) of the known texts, by MD5 and 64-bit digest; a few hundred
    constant rows."""

    def digests(texts: list[tuple], canonical: Column) -> DataFrame:
        return _constants(spark, texts).select(
            F.md5(canonical).alias("digest"), F.xxhash64(canonical).alias("unit"), "license"
        )

    return (
        digests(known_texts(), _joined(canonical_lines(F.col("text"))))
        .unionByName(digests(full_texts(), F.array_join(_terms(F.col("text")), " ")))
        .distinct()
    )


def _constants(spark: SparkSession, texts: list[tuple]) -> DataFrame:
    """(license, text) of some texts."""
    quoted = ", ".join(
        "('{}', '{}')".format(name, text.replace("\\", "\\\\").replace("'", "\\'"))
        for name, text, *_ in texts
    )
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(license, text)")


def _sizes(spark: SparkSession) -> list[tuple[str, int, int]]:
    """(text, characters, words) of the canonical terms of the full texts."""
    texts = _constants(spark, [text for text in full_texts() if text[2]])
    rows = texts.select(F.array_join(_terms(F.col("text")), " ").alias("text")).collect()
    return sorted({(row["text"], len(row["text"]), row["text"].count(" ") + 1) for row in rows})


def scan_licenses(documents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, ``digest`` of the canonical text,
    ``license`` that the whole text is, but for titles and statements of copyright (null
    if none), ``licenses`` (all that it, its paragraphs or its lines are, and all whose
    full text it holds; sorted) and their number.

    Null and empty texts have the digest of nothing, which is no licence. Repeated rows
    have equal results. A digest of two licences gives the smaller name as ``license``.
    Very long texts are read whole. Only doc_id and text are read, so other columns may have
    any name. ``known`` (digest, unit, license) are the built-in texts unless given; no rows
    give no rows.
    """
    known = (known or known_digests(documents.sparkSession)).select(
        F.col("digest").alias("known_digest"), "unit", "license"
    )
    lines = canonical_lines(F.coalesce("text", F.lit("")))
    key = ["doc_id", TEXT_HASH]
    digests = documents.select(
        "doc_id", text_hash().alias(TEXT_HASH), lines.alias("lines"),
        F.when(F.rlike("text", F.lit(LICENSE_WORD)), _terms(F.col("text"))).alias("terms"),
    )
    terms, joined = F.col("terms"), F.array_join("terms", " ")
    found = F.when(
        terms.isNotNull(),
        F.concat(F.array(F.xxhash64(joined)), _runs(terms, _sizes(documents.sparkSession))),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))
    whole = written(
        digests.select(
            *key,
            F.md5(_joined(F.col("lines"))).alias("digest"),
            F.md5(joined).alias("terms_digest"),
            F.array_union(_units(F.col("lines")), found).alias("units"),
        ),
        "licenses",
    )
    found = (
        whole.select(*key, "digest", "terms_digest", F.explode("units").alias("unit"))
        .join(known, "unit")
        .groupBy(*key)
        .agg(
            F.min(
                F.when(F.col("known_digest").isin(F.col("digest"), F.col("terms_digest")), F.col("license"))
            ).alias("license"),
            F.array_sort(F.collect_set("license")).alias("licenses"),
        )
    )
    none = F.expr("cast(array() as array<string>)")
    return match(whole.select(*key, "digest"), found, key).select(
        "doc_id", "digest", "license",
        F.coalesce("licenses", none).alias("licenses"),
        F.size(F.coalesce("licenses", none)).cast("long").alias("n_licenses"),
    )


def scan_sql(documents: str = "documents") -> str:
    """:func:`scan_licenses` in DuckDB's SQL, with the lists joined by commas, and with texts
    themselves in place of their 64-bit digests."""

    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canonical(text: str, gone: str = COPYRIGHT_LINE) -> str:
        text = f"translate({text}, '{UPPER}', '{UPPER.lower()}')"
        text = f"regexp_replace({text}, {quote(gone)}, '\\1', 'g')"
        for old, new in SPELLINGS:
            text = f"replace({text}, {quote(old)}, {quote(new)})"
        text = f"regexp_replace({text}, {quote(PUNCTUATION)}, ' ', 'g')"
        return f"list_transform(string_split({text}, chr(10)), lambda x: trim(x))"

    def terms(text: str) -> str:
        lines = (
            f"list_filter({canonical(text, STATEMENT)}, "
            "lambda x: x <> '' AND x <> 'all rights reserved')"
        )
        whole = f"array_to_string({lines}, chr(10))"
        for old, new in TERM_SPELLINGS:
            whole = f"replace({whole}, '{old}', '{new}')"
        return f"string_split(regexp_replace({whole}, {quote(TITLE_LINES)}, ''), chr(10))"

    def values(texts: list[tuple]) -> str:
        return ", ".join(f"({', '.join(map(quote, map(str, row)))})" for row in texts)

    digest = "md5(array_to_string(list_filter(lines, lambda x: x <> ''), ' '))"
    return f"""
WITH known_terms AS (
    SELECT DISTINCT license, alone = 'True' AS alone, array_to_string({terms('text')}, ' ') AS t
    FROM (VALUES {values(full_texts())}) AS t(license, text, alone)
), known AS (
    SELECT license, {digest} AS digest FROM (
        SELECT license, {canonical('text')} AS lines
        FROM (VALUES {values(known_texts())}) AS t(license, text))
    UNION
    SELECT license, md5(t) FROM known_terms
), canonical AS (
    SELECT row_number() OVER () AS row_no, doc_id, {canonical("coalesce(text, '')")} AS lines,
        CASE WHEN regexp_matches(text, {quote(LICENSE_WORD)}) THEN {terms('text')} END AS terms
    FROM {documents}
), whole AS (
    SELECT row_no, doc_id, {digest} AS digest, md5(array_to_string(terms, ' ')) AS terms_digest,
        terms, list_concat(lines, list_transform(
            regexp_split_to_array(array_to_string(lines, chr(10)), '\\n\\n+'),
            lambda x: replace(x, chr(10), ' '))) AS units
    FROM canonical
), units AS (
    SELECT row_no, digest FROM whole
    UNION ALL
    SELECT row_no, terms_digest FROM whole WHERE terms IS NOT NULL
    UNION ALL
    SELECT row_no, md5(trim(unit)) FROM (SELECT row_no, unnest(units) AS unit FROM whole)
    WHERE trim(unit) <> ''
), runs AS (
    SELECT row_no, license
    FROM (SELECT row_no, terms, unnest(range(1, len(terms) + 1)) AS place FROM whole)
    JOIN known_terms ON alone AND split_part(terms[place], ' ', 1) = split_part(t, ' ', 1)
    WHERE starts_with(array_to_string(terms[place:], ' ') || ' ', t || ' ')
), found AS (
    SELECT row_no, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
        count(DISTINCT license) AS n
    FROM (SELECT row_no, license FROM units JOIN known USING (digest)
          UNION ALL SELECT row_no, license FROM runs)
    GROUP BY row_no
), exact AS (
    SELECT row_no, min(license) AS license
    FROM whole w JOIN known k ON k.digest = w.digest OR k.digest = w.terms_digest
    GROUP BY row_no
)
SELECT doc_id, digest, license, coalesce(licenses, '') AS licenses,
    CAST(coalesce(n, 0) AS BIGINT) AS n_licenses
FROM whole LEFT JOIN found USING (row_no) LEFT JOIN exact USING (row_no)"""
