"""Licence scans: canonical digests looked up among those of known licence texts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import StagingArea
from .common import read_table, scratch
from .licence_digests import TEXT_DIGESTS

# Known licence texts and notices.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
    "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
    "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
)
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n",
    "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.\n",
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE {0} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    "EVENT SHALL THE {1} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
    "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
    "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _bsd(clauses: int, owners: str, owner: str, name: str, numbered: bool) -> str:
    marks = [f"{i + 1}. " if numbered else "* " for i in range(clauses)]
    parts = [mark + clause.format(name) for mark, clause in zip(marks, _BSD_CLAUSES)]
    return _BSD_HEAD + "".join(parts) + _BSD_TAIL.format(owners, owner)


_BSD = {
    f"BSD-{clauses}-Clause": [
        _bsd(clauses, *who, numbered)
        for who in (
            ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER", "the copyright holder"),
            ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER", "the copyright holder"),
            ("REGENTS", "REGENTS", "the University"),
        )
        for numbered in (True, False)
    ]
    for clauses in (2, 3)
}
# Whole texts besides those of KNOWN, each with its usual headings.
_HEADED = {
    "MIT": (("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"), [_MIT]),
    "ISC": (("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"), [_ISC]),
    "BSD-2-Clause": (("", "BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"), _BSD["BSD-2-Clause"]),
    "BSD-3-Clause": (("", "BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"), _BSD["BSD-3-Clause"]),
    "Unlicense": (
        ("", "The Unlicense", "Unlicense"),
        [_UNLICENSE + end for end in ("", "\n\nFor more information, please refer to <https://unlicense.org>", "\n\nFor more information, please refer to <https://unlicense.org/>", "\n\nFor more information, please refer to <http://unlicense.org>")],
    ),
}
WHOLE = [(licence, "text", f"{head}\n\n{text}") for licence, (heads, texts) in _HEADED.items() for head in heads for text in texts]
_NAMES = {
    "MIT": ("the MIT License", "the MIT license", "MIT"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0", "Apache-2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GPL, version 2", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GPL, version 3", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "MPL-2.0"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "BSD-3-Clause"),
    "ISC": ("the ISC License", "ISC"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "CC-BY-ND-4.0"),
    "Unlicense": ("the Unlicense", "Unlicense"),
}
_NOTICES = (
    "Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.",
    "This software is licensed under {}.", "This project is licensed under {}.", "SPDX-License-Identifier: {}",
)
KNOWN = [("MIT", "text", _MIT), ("MIT", "text", "MIT License\n\n" + _MIT), ("ISC", "text", _ISC), ("ISC", "text", "ISC License\n\n" + _ISC)] + [
    (licence, "notice", notice.format(name)) for licence, names in _NAMES.items() for name in names for notice in _NOTICES
]

# A copyright statement, from the start of a line to the end of its sentence, in small letters. The word
# or sign is followed by another sign, a year (or its placeholder), 'by' or the name of a body: lines that only begin with
# 'copyright notice' or a list's '(c)' are text. The point of an abbreviation or initial ends no sentence.
_YEAR = r"(?:\d{4}\b|years?\b|yyyy\b)"
_BODY = r"(?:authors|contributors|developers|regents of the university of california|inc|ltd|llc|corporation|foundation)"
_SENTENCE = (
    r"(?:(?<!\b(?:inc|ltd|co|corp|llc|jr|sr|st|dr|[a-z]))\.(?=\s)"
    r"|\.(?=\s+(?:licen[sc]ed|released|distributed|permission|this|spdx|all rights)\b)|(?=\beveryone is permitted)|$)"
)
COPYRIGHT = (
    r"(?dm)^[^\p{L}\p{N}\n]*(?:"
    r"copyright(?=[^\p{L}\p{N}\n]*(?:c\)|" + _YEAR + r"|by\b)|[^\S\n]*©|[^\S\n]+(?!(?:notice|holder|owner))[^\n.]*\b" + _BODY + r"\b[^\p{L}\p{N}\n]*$)"
    r"|\(c\)(?=[^\p{L}\p{N}\n]*(?:" + _YEAR + r"|copyright\b[^\p{L}\p{N}\n]*" + _YEAR + r"))"
    r"|©(?=[^\p{L}\p{N}\n]*(?:" + _YEAR + r"|by\b|copyright\b[^\p{L}\p{N}\n]*" + _YEAR + r"))"
    r")[^\n]*?" + _SENTENCE + r"(?:\s*all rights reserved\b\.?)?"
)
# The address of the Free Software Foundation has changed several times, and so have forms of links.
ADDRESS = r"\b(?:51 franklin st|59 temple place|675 mass ave)[\s\S]{0,80}?\busa\b|\bhttps?://(?:www\.)?"

# Pattern and replacement, in this order, applied to text in small letters.
# The first is that of the SQL; `canonical` has the patterns above in its place.
# No pattern may need a character that another match of it has used.
STEPS = (
    (r"(^|\n)[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*", "\n"),
    (r"licenc", "licens"),
    (r"sub-licens", "sublicens"),
    (r"non-infringement", "noninfringement"),
    (r"merchantibility", "merchantability"),
    (r"&", " and "),
    (r"(^|[^a-z0-9])v(ersion|ers|er)?[. ]*([0-9])", r"${1}version ${3}"),
    (r"[^\p{L}\p{N}]+", " "),
)


# The steps after the first as `canonical` does them: plain text is replaced as such, and a match of the version begins at its
# letter, for the character before it is only looked at.
_PLAIN = (("licenc", "licens"), ("sub-licens", "sublicens"), ("non-infringement", "noninfringement"), ("merchantibility", "merchantability"), ("&", " and "))
_VERSION = (r"v(?<![a-z0-9]v)(?:ersion|ers|er)?[. ]*([0-9])", "version $1")
_APART = r"[^\p{L}\p{N}]+"


def _has(low: Column, *parts: str) -> Column:
    return functools.reduce(Column.__or__, [F.contains(low, F.lit(p)) for p in parts])


def canonical(text: Column) -> Column:
    """Small letters, no copyright statement, one spelling, and one space for all else but letters and digits."""
    low = F.lower(text)
    # The two long patterns are only tried where a text has one of the words that any match needs.
    out = F.when(_has(low, "://", "51 franklin st", "59 temple place", "675 mass ave"), F.regexp_replace(low, ADDRESS, " ")).otherwise(low)
    out = F.when(_has(low, "copyright", "(c)", "©"), F.regexp_replace(out, COPYRIGHT, "")).otherwise(out)
    for part, to in _PLAIN:
        out = F.replace(out, F.lit(part), F.lit(to))
    return F.trim(F.regexp_replace(F.regexp_replace(out, *_VERSION), _APART, " "))


# Every known text has all the parts of one of these rows, in letters that `canonical` leaves as they are
# (it puts spaces between words and none within, and makes 'licens' of 'licenc').
_SIGNS = (
    ("licens",), ("licenc",), ("released", "under"), ("distributed", "under"),
    ("permission", "software"), ("redistribution", "disclaimer"), ("unencumbered", "anyone"),
)


def may_be_known(text: Column) -> Column:
    """False only for texts that are none of KNOWN, WHOLE and TEXT_DIGESTS. Null for null."""
    low = F.lower(text)
    return functools.reduce(Column.__or__, [functools.reduce(Column.__and__, [F.contains(low, F.lit(p)) for p in row]) for row in _SIGNS])


def known_digests(spark: SparkSession, known=KNOWN + WHOLE, digests=TEXT_DIGESTS) -> DataFrame:
    """(digest, licence, kind) of the known texts, a fixed list of a few hundred rows."""
    rows = spark.createDataFrame(known, "licence string, kind string, text string")
    rows = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence", "kind")
    stored = spark.createDataFrame([(d, licence, "text") for licence, d in digests], "digest string, licence string, kind string")
    return rows.union(stored).distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, area: StagingArea | None = None) -> DataFrame:
    """doc_id, text_licence, licences (sorted), n_notices for every row of `docs`.

    A unit is the entire text, or an entire line of it; its canonical digest is joined to
    the known ones. text_licence is the licence of the entire text, null if unknown. Null
    and empty texts and texts without a letter or digit match nothing. Rows of equal
    doc_id and text are alike; repeated rows are repeated. Other columns are ignored.
    """
    spark = docs.sparkSession
    area = scratch(spark, area)
    # Only the fixed list has a known size and known words; another one may be of any size, and each unit is looked up in it.
    wanted = may_be_known if known is None else lambda text: F.lit(True)
    known = F.broadcast(known_digests(spark)) if known is None else known
    named = docs.select("doc_id", F.xxhash64("text").alias("content"), F.col("text"))
    # A text has all that its lines have.
    units = named.where(wanted(F.col("text"))).select(
        "doc_id", "content", F.posexplode(F.concat(F.array("text"), F.split("text", "\n"))).alias("unit", "body")
    )
    digests = units.where(wanted(F.col("body"))).select("doc_id", "content", "unit", F.sha2(canonical(F.col("body")), 256).alias("digest"))
    found = area.stage(digests.join(known, "digest").distinct(), "licences")
    by_doc = found.groupBy(F.col("doc_id").alias("of_doc"), F.col("content").alias("of_content")).agg(
        F.min(F.when(F.col("unit") == 0, F.col("licence"))).alias("text_licence"),
        F.sort_array(F.collect_set("licence")).alias("licences"),
        F.count_distinct(F.when(F.col("unit") > 0, F.col("unit"))).alias("n_notices"),
    )
    by_doc = area.stage(by_doc, "licences-by-document")
    joined = named.select("doc_id", "content").join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("content") == F.col("of_content")), "left"
    )
    return joined.select(
        "doc_id", "text_licence", F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("n_notices", F.lit(0).cast("bigint")).alias("n_notices"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text_licence", F.array_join("licences", ",").alias("licences"), "n_notices")


def _sql_canonical(value: str) -> str:
    out = f"lower({value})"
    for pattern, to in STEPS:
        replacement = to.replace("${1}", r"\1").replace("${3}", r"\3").replace("\n", "' || chr(10) || '")
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return f"trim({out})"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP6_SQL = f"""
WITH known AS (
    SELECT DISTINCT sha256({_sql_canonical('text')}) AS digest, licence
    FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, _, t in KNOWN)}) AS k(licence, text)
), unit AS (
    SELECT doc_id, 0 AS unit, text AS body FROM documents WHERE text IS NOT NULL
    UNION ALL
    SELECT doc_id, i, parts[i] FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    unnest(range(1, len(parts) + 1)) AS t(i)
), found AS (
    SELECT doc_id, unit, licence FROM unit JOIN known ON sha256({_sql_canonical('body')}) = digest
), total AS (
    SELECT doc_id, min(CASE WHEN unit = 0 THEN licence END) AS text_licence,
           array_to_string(list_sort(list(DISTINCT licence)), ',') AS licences,
           count(DISTINCT CASE WHEN unit > 0 THEN unit END) AS n_notices
    FROM found GROUP BY doc_id
)
SELECT d.doc_id, text_licence, coalesce(licences, '') AS licences, coalesce(n_notices, 0) AS n_notices
FROM documents d LEFT JOIN total ON d.doc_id = total.doc_id
"""
