"""Licence scans: canonical digests of entire texts, hash-joined to those of known licences."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Known licence statements and short licences, as published.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("MIT", """MIT License
Copyright (c) <year> <copyright holders>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Copyright <year> <owner>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]
TEXTS = Path(__file__).resolve().parent / "license_texts"
# The full texts in TEXTS, and how many paragraphs at their begin are a heading.
FULL = {"Apache-2.0": 1, "GPL-2.0": 1, "GPL-3.0": 1, "LGPL-2.1": 1, "LGPL-3.0": 1, "MPL-2.0": 1, "CC0-1.0": 2, "Unlicense": 0}
# Headings in use over the licences that are published without one.
HEADINGS = {
    "MIT": ["", "MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["", "ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["", "BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["", "BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "Unlicense": ["The Unlicense"],
}
END = "END OF TERMS AND CONDITIONS"


def full_texts() -> list[tuple[str, str]]:
    """Whole licences with and without heading and appendix, wrapped as published and with a line for each paragraph.

    Lines that begin with "copyright" are no part of the canonical form, so it differs between the two ways to wrap.
    """
    bodies = {name: text.split("\n", 1)[1] for name, text in KNOWN if "\n" in text}
    bodies |= {p.stem: p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    out: list[tuple[str, str]] = []
    for name, body in bodies.items():
        forms = [f"{heading}\n{more}\n{body}" for heading in HEADINGS.get(name, ()) for more in ("", "All rights reserved.")]
        if name in FULL:
            parts = body.split("\n\n")
            forms += [body, "\n\n".join(parts[FULL[name]:])]
            forms += [form[:form.index(END) + len(END)] for form in forms if END in form]
        if name == "MIT":
            forms = [form.replace("Copyright (c) <year> <copyright holders>\n", "") for form in forms]
        elif name == "ISC":
            forms += [form.replace("above copyright notice", "above\ncopyright notice") for form in forms]
        elif name.startswith("BSD"):
            forms += [re.sub(r"(?m)^[0-9]\. ", "* ", form) for form in forms]
        out += [(name, form) for form in forms]
        out += [(name, "\n".join(" ".join(part.split()) for part in form.split("\n\n"))) for form in forms]
    return list(dict.fromkeys(out))


KNOWN += [("All-rights-reserved", "All rights reserved.")]
KNOWN += full_texts()
# Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = [
    ("licence", "license"), ("non-commercial", "noncommercial"), ("sub-license", "sublicense"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("organisation", "organization"), ("©", "copyright"),
]
# Removed with the line they begin (after lower case).
COPYRIGHT_LINE = "(^|\\n)[ \\t]*(copyright|©|\\(c\\))[^\\n]*"


def canonical(text: Column) -> Column:
    """Lower case, one spelling, no copyright lines, runs of anything but letters and digits as one space."""
    out = F.lower(text)
    out = F.regexp_replace(out, F.lit(COPYRIGHT_LINE), F.lit("\n"))
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.trim(F.regexp_replace(out, F.lit("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), F.lit(" ")))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``license``, ``digest`` of each known text; as many rows as the list has at most."""
    rows = spark.createDataFrame(known, "license string, text string")
    return rows.select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``doc_id``, ``digest``, ``license``, ``line_licenses``, ``n_license_lines`` for each row of ``docs``.

    ``license`` is that of the known text which the entire text of the document equals in canonical form, else null.
    Each line is an entire text of its own, too: ``line_licenses`` joins the distinct licences of the lines that equal
    a known text, sorted, by commas (empty if none). Only columns and built-in functions; the known digests are a
    broadcast of fixed size, so neither texts nor lines are shuffled and a hot licence is no key of an exchange.

    Null and empty texts have the digest of the empty text and no licence. Rows that repeat a ``doc_id`` are scanned
    each; a null ``doc_id`` stays null. Other columns are ignored.
    """
    digests = known_digests(docs.sparkSession, known)
    # As many entries as the list of known texts has: a constant of the plan.
    table = F.create_map(*[F.lit(x) for row in digests.collect() for x in (row["digest"], row["license"])])
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: table[F.sha2(canonical(x), 256)]),
                     lambda x: x.isNotNull())
    return (docs.select("doc_id", F.sha2(canonical(F.coalesce("text", F.lit(""))), 256).alias("digest"), lines.alias("found"))
            .join(F.broadcast(digests), "digest", "left")
            .select("doc_id", "digest", "license", F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_licenses"),
                    F.size("found").cast("long").alias("n_license_lines")))


def oracle(known: list[tuple[str, str]] = KNOWN) -> str:
    """The same in DuckDB."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def canon(column: str) -> str:
        out = f"regexp_replace(lower({column}), {quoted('(^|' + chr(10) + ')[ ' + chr(9) + ']*(copyright|©|' + chr(92) + '(c' + chr(92) + '))[^' + chr(10) + ']*')}, chr(10), 'g')"
        for other, one in SPELLINGS:
            out = f"replace({out}, {quoted(other)}, {quoted(one)})"
        return f"trim(regexp_replace({out}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'))"

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known)
    return f"""
WITH k AS (SELECT sha256({canon('t')}) AS digest, min(l) AS license FROM (VALUES {values}) AS v(l, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
x AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
h AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n
      FROM (SELECT r, sha256({canon('line')}) AS digest FROM x) JOIN k USING (digest) GROUP BY r)
SELECT d.doc_id, sha256({canon('d.text')}) AS digest, k.license AS license, coalesce(h.line_licenses, '') AS line_licenses,
       coalesce(h.n, 0) AS n_license_lines
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN k ON k.digest = sha256({canon('d.text')})"""
