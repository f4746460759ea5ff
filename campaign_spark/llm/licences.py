"""Licence scan by canonical digest, in DataFrame functions only.

A text is put into canonical form - lower case, copyright lines out, equivalent
spellings made one, punctuation and white space to single blanks - and its
SHA-256 digest is joined with the digests of known licences, put into the same
form. The whole text, each of its lines and, for known texts of several lines,
every place where their first words stand are looked up: a licence is found as a
document and inside a longer one, however its lines are wrapped. Known texts are a
parameter; up to ``BROADCAST_ROWS`` digests are broadcast, so that the lines of the
documents are not shuffled. Lines that only title a licence ('MIT License') are left out like
copyright lines.

Defined cases: a null text is empty; an empty canonical form has no licence;
every row gives a row, repeated ones the same; a null doc_id stays null; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Short licence texts and notices as their publishers give them.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0 notice": "Released under CC0 1.0.",
}

_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of whole licences besides KNOWN; a licence met in several forms has a row for each."""
    out = [(p.stem, p.read_text("utf-8", "replace")) for p in sorted(Path(__file__).with_name("licence_texts").glob("*.txt"))]
    out += [("Unlicense", _UNLICENSE)] + [("Unlicense", f"{_UNLICENSE}\nFor more information, please refer to <http://unlicense.org{x}>") for x in ("", "/")]
    for name, parts in (("BSD-2-Clause", (_BSD_1, _BSD_2)), ("BSD-3-Clause", (_BSD_1, _BSD_2, _BSD_3))):
        for mark in ("{}. ", "({}) ", "* "):
            out.append((name, "\n".join([_BSD_HEAD, *(mark.format(i) + x for i, x in enumerate(parts, 1)), _BSD_END])))
    return out + [(k, t.replace("http://", "https://")) for k, t in out if "http://" in t]


# Spellings held to be equivalent, as whole words.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
             "noncommercial": "non commercial", "noninfringement": "non infringement", "whilst": "while",
             "favour": "favor", "organisation": "organization", "judgement": "judgment"}


_COPYRIGHT = r"^\s*(?i:copyright\b|\(c\)|©)"
# A line by a year, (c) or a holder; 'copyright notice', 'COPYRIGHT HOLDERS' and so on only continue a sentence.
_CREDIT = (r"^\s*(?:(?i:\(c\)|©)|(?i:copyright)\b[\s:,-]*(?:(?i:\(c\)|©|by\b|[\[<{(]|\d{4})|(?!(?i:notices?|holders?|owners?|laws?"
           r"|licen[sc]es?|statements?|interests?|rights?|disclaimers?|and|or|in|is|of|as|to|protection|status|claims?)\b)\p{Lu}))")
# Canonical lines that only title a licence.
_TITLE = r"^(the )?((mit|isc|expat|unlicense) license( mit| isc)?|(new |simplified |modified )?bsd ([0-3]|two|three|zero) clause license|bsd zero clause license|zero clause bsd( license)?)$"
# This sentence goes with the copyright line before it; elsewhere it is text.
_RESERVED = r"(?m)(^\s*(?i:copyright|\(c\)|©)[^\n]*)\n[ \t]*(?i:all rights reserved)\.?[ \t\r]*$"
ANCHOR = 60  # characters by which a known text is looked for inside a document
BROADCAST_ROWS = 100_000  # digests of known texts that are sent to every task; more are joined by a shuffle
SIGN = 7  # letters that a word needs to tell licences from prose
_NOT_WORD = r"[^\p{L}\p{N}]+"
_ANY_SPELLING = r"\b(" + "|".join(SPELLINGS) + r")\b"


def canonical(line: Column) -> Column:
    """Canonical form of one line; a copyright or title line becomes empty."""
    low = F.trim(F.regexp_replace(F.lower(line), _NOT_WORD, " "))
    same = low
    for old, new in SPELLINGS.items():
        same = F.regexp_replace(same, rf"\b{old}\b", new)
    form = F.when(low.rlike(_ANY_SPELLING), same).otherwise(low)
    return F.when(line.rlike(_CREDIT), F.lit("")).when((F.length(low) < 50) & form.rlike(_TITLE), F.lit("")).otherwise(form)


def canonical_lines(text: Column) -> Column:
    text = F.when(text.rlike(r"(?i)all rights reserved"), F.regexp_replace(text, _RESERVED, "$1")).otherwise(text)
    return F.filter(F.transform(F.split(text, "\n"), canonical), lambda x: x != "")


def _digest(lines: Column) -> Column:
    return F.sha2(F.array_join(lines, " "), 256)


def _signs(starts: set[str]) -> list[str]:
    """Words, as few as a greedy choice needs, of which every start holds one whole; long ones, so that prose has few."""
    left = {s: {w for w in f"{s}|".split(" ")[1:-1] if w} for s in starts}
    left = {s: {w for w in ws if len(w) >= SIGN} or {max(ws, key=len)} for s, ws in left.items() if ws}
    out = []
    while left:
        words = sorted({w for ws in left.values() for w in ws})
        best = max(words, key=lambda w: sum(w in ws for ws in left.values()))
        out.append(best)
        left = {s: ws for s, ws in left.items() if best not in ws}
    return out


def _inside(forms: list[str], text: Column) -> Column:
    """Digests of the stretches of ``text`` (blank before and after) that start as a known text does and are as long."""
    starts = set()
    for form in forms:
        n = ANCHOR
        while form.find(form[:n], 1) >= 0:  # a text that holds its own start once more needs a longer one
            n *= 2
        starts.add((form[:n], len(form)))
    if not starts:
        return F.array().cast("array<string>")
    known = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(n).alias("n")) for a, n in sorted(starts)))
    met = F.filter(known, lambda k: (F.length(text) > k["n"]) & F.contains(text, k["start"]))
    stretches = F.flatten(F.transform(met, lambda k: F.transform(
        F.split(text, F.concat(F.lit("(?="), k["start"], F.lit(")"))), lambda x: F.sha2(F.left(F.concat(x, F.lit(" ")), k["n"]), 256))))
    # A text without any of these words holds no start: the starts themselves are looked for in few texts.
    signs = _signs({a for a, _ in starts})
    whole = all(any(f" {w} " in a for w in signs) for a, _ in starts)
    if not whole:
        return stretches
    sign = functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(f" {w} ")) for w in signs])
    return F.when(sign, stretches).otherwise(F.array().cast("array<string>"))


def licence_scan(docs: DataFrame, known: dict[str, str] | None = None) -> DataFrame:
    """doc_id, text_digest, license_id (the whole text), notice_ids (those found as one of its lines or, known texts
    of several lines, inside the longer text; sorted, joined by commas)."""
    spark = docs.sparkSession
    given = list(known.items()) if known is not None else [*KNOWN.items(), *whole_texts()]
    texts = [(r["license_id"], r["lines"]) for r in spark.createDataFrame(given, "license_id string, text string").select(
        "license_id", canonical_lines(F.col("text")).alias("lines")).collect()]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    long = [(k, f" {' '.join(x)} ") for k, x in texts if len(x) > 1]
    schema = "license_id string, digest string"
    table_ = spark.createDataFrame([(k, digest(" ".join(x))) for k, x in texts], schema).dropDuplicates(["digest"])
    parts = spark.createDataFrame([(k, digest(" ".join(x))) for k, x in texts] + [(k, digest(f)) for k, f in long], schema)
    forms = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    whole = forms.select("doc_id", F.when(F.size("lines") > 0, _digest(F.col("lines"))).alias("text_digest"), "lines")
    text = F.concat(F.lit(" "), F.array_join("lines", " "), F.lit(" "))
    found = whole.select("doc_id", "text_digest", "lines", text.alias("text"))
    parts = parts.distinct()
    if len(texts) + len(long) <= BROADCAST_ROWS:  # counted here: the known texts come from the driver
        table_, parts = F.broadcast(table_), F.broadcast(parts)
    # Never null: a filter on nulls would be pushed below the lines, which would be made a second time for it.
    lines = found.select("doc_id", F.coalesce("text_digest", F.lit("")).alias("text_digest"), F.explode(F.concat(
        F.transform(F.array_distinct("lines"), lambda x: F.sha2(x, 256)), _inside([f for _, f in long], F.col("text")))).alias("digest"))
    notices = (lines.join(parts, "digest").groupBy("doc_id", "text_digest")
               .agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notice_ids"))  # known ones only
               .withColumnsRenamed({"doc_id": "d", "text_digest": "t"}))
    out = whole.drop("lines").join(table_, F.col("text_digest") == F.col("digest"), "left")
    return (out.join(notices, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_digest") == F.col("t")), "left")
            .select("doc_id", "text_digest", "license_id", F.coalesce("notice_ids", F.lit("")).alias("notice_ids")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    same = "l"
    for old, new in SPELLINGS.items():
        same = f"regexp_replace({same}, '\\b{old}\\b', '{new}', 'g')"
    known = ", ".join(f"({text(k)}, {text(v)})" for k, v in KNOWN.items())
    lines = f"""SELECT k, i, CASE WHEN regexp_matches(raw, '{_COPYRIGHT}') THEN '' ELSE {same} END AS line FROM
        (SELECT k, i, raw, trim(regexp_replace(lower(raw), '{_NOT_WORD}', ' ', 'g')) AS l FROM
          (SELECT k, generate_subscripts(string_split(t, chr(10)), 1) AS i, unnest(string_split(t, chr(10))) AS raw FROM src))"""
    return f"""
WITH known(license_id, t) AS (VALUES {known}),
kl AS ({lines.replace("FROM src", "FROM (SELECT license_id AS k, t FROM known)")}),
kd AS (SELECT k AS license_id, sha256(string_agg(line, ' ' ORDER BY i)) AS digest FROM kl WHERE line <> '' GROUP BY k),
docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
dl AS ({lines.replace("FROM src", "FROM docs")}),
whole AS (SELECT k, sha256(string_agg(line, ' ' ORDER BY i)) AS text_digest FROM dl WHERE line <> '' GROUP BY k),
notices AS (SELECT k, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
            FROM dl JOIN kd ON sha256(line) = digest WHERE line <> '' GROUP BY k)
SELECT doc_id, text_digest, license_id, coalesce(notice_ids, '') AS notice_ids
FROM docs LEFT JOIN whole USING (k) LEFT JOIN kd ON digest = text_digest LEFT JOIN notices USING (k)
"""


OP3_SQL = _sql()
