"""Licence scan by canonical digests of entire texts, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence texts and notices whose canonical forms are known.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN_TEXTS = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
# Spellings that count as one another, as whole words of the normalised text.
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"), ("noncommercial", "non commercial"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"))
#: A line that only names a copyright holder.
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*$"


def canonical(text: Column) -> Column:
    """Lower case without copyright lines, punctuation and white space differences, in one spelling."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for old, new in SPELLINGS:
        out = F.regexp_replace(out, rf"(^| ){old}( |$)", f"$1{new}$2")
    return out


def marker(canonical_text: str) -> str:
    """The longest word of a canonical text that no other spelling can stand for: each text of that form has it."""
    spelt = {w for pair in SPELLINGS for side in pair for w in side.split()}
    return max((w for w in canonical_text.split() if w not in spelt), key=lambda w: (len(w), w), default="")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def license_scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN_TEXTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, digest, license, n_notices, notices) of each row.

    license names the known text, of the same canonical digest, that the entire text is; null if none. notices are the licences
    of the single lines, of any length, that are known texts, sorted, and n_notices counts these lines. A null text has a null digest and no notices. Null ids, repeated rows and
    empty tables pass; other columns are ignored. The known digests, one row for each text of `known`, are broadcast.
    """
    spark = docs.sparkSession
    forms = spark.createDataFrame(list(known), "license string, text string").select(canonical(F.col("text")).alias("form"), "license")
    listed = forms.select(F.sha2("form", 256).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))
    names = {r["digest"]: r["license"] for r in listed.collect()}
    table = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]) if names else F.create_map().cast("map<string,string>")
    text = F.col(text_column).cast("string")
    # Only lines that have the marker of a known text can be one; the others need no canonical form.
    markers = "|".join(sorted({marker(r["form"]) for r in forms.collect()}))
    lines = F.filter(F.split(text, "\n"), lambda line: F.lower(line).rlike(markers))
    notices = F.filter(F.transform(lines, lambda line: F.try_element_at(table, digest(line))), lambda name: name.isNotNull())
    scanned = docs.select(F.col(id_column).alias("doc_id"), digest(text).alias("digest"), F.coalesce(notices, F.array().cast("array<string>")).alias("found"))
    joined = scanned.join(F.broadcast(listed), "digest", "left")
    return joined.select("doc_id", "digest", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"))
