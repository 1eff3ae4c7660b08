"""Licence scan: digests of canonical texts are looked up among those of known licences, in SQL expressions only.

A text is canonical in lower case, without copyright lines, with equivalent spellings made one and punctuation and white
space as single blanks. Whole texts are looked up, and so are their lines, for notices that name a licence.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Spellings that count as one (fixed values).
EQUIVALENT = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("copyright holder", "copyright owner"),
              ("organisation", "organization"), ("favour", "favor"), ("per cent", "percent"), ("https", "http"), ("whilst", "while"), ("fulfil ", "fulfill "),
              ("judgement", "judgment"), ("merchantibility", "merchantability"))
#: As the SQL takes lines out: every line that starts so. scan uses COPYRIGHT below.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: A copyright line has the word and then (c), a sign or a year; wording that wraps to a line start has not. It ends with the
#: line, or where the licence begins on the same line; what follows neither within 400 characters is no copyright line.
BEGINS = r"(?:permission (?:is|to)\b|redistribution and use|(?:this (?:project|work|software) is )?(?:licen[cs]ed|released) under|(?:the )?mit licen[cs]e|isc licen[cs]e|bsd zero clause)"
COPYRIGHT = (r"(?m)^[ \t]*(?:copyright[ \t,:]*(?:\(c\)|©|(?:19|20)[0-9]{2})|\(c\)[ \t,:]*(?:copyright\b|(?:19|20)[0-9]{2})|©"
             rf"|all rights reserved)[^\n]{{0,400}}?(?=[ \t.]*$|[ \t]+{BEGINS})")
#: Punctuation, controls, blanks and quotation marks, but no line ends. Single signs below 256 and a range around the others
#: spare the regexp engine most comparisons.
SIGNS = "".join(rf"\x{c:02X}" for c in (*range(0x0A), *range(0x0B, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)))
SEPARATORS = rf"[{SIGNS}«»[‐-‰&&[“”‘’„—–…]]]+"
LINE_ENDS = r" ?\n[ \n]*"
KNOWN_ROWS = 50_000  # known digests, about 100 bytes each, that are sent to every executor; more are joined by shuffle

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."""
ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
#: Licence texts and notices that name one (fixed values). A caller may give other (licence, text) rows.
KNOWN = (
    ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT), ("ISC", ISC + "\n" + ISC_END), ("ISC", "ISC License\n" + ISC + "\n" + ISC_END),
    ("0BSD", ZERO_BSD + "\n" + ISC_END), ("0BSD", "BSD Zero Clause License\n" + ZERO_BSD + "\n" + ISC_END),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
)


def even_lines(text: Column) -> Column:
    """Lower case without copyright lines, separators as single blanks; line ends stay."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, ""), SEPARATORS, " ")


def one_spelling(even: Column) -> Column:
    for other, one in EQUIVALENT:
        even = F.replace(even, F.lit(other), F.lit(one))
    return even


def whole_form(even: Column) -> Column:
    return F.trim(one_spelling(F.regexp_replace(even, LINE_ENDS, " ")))


def sha(form: Column) -> Column:
    """SHA-256 of a canonical text; of none and of null the empty text, so that Spark need not compute it twice to find nulls."""
    return F.coalesce(F.sha2(form, 256), F.lit(""))


NOTHING = hashlib.sha256(b"").hexdigest()


def digest(text: Column) -> Column:
    """The canonical text's SHA-256; null if nothing is left."""
    return F.nullif(F.sha2(whole_form(even_lines(text)), 256), F.lit(NOTHING))


def known_licences(spark: SparkSession, rows: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    given = spark.createDataFrame(list(rows), "licence string, text string")
    return given.select("licence", digest(F.col("text")).alias("digest")).dropna().distinct()


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """For each row of documents: doc_id, digest of the whole canonical text, licence (that the whole text is) and notices,
    the sorted licences that single lines are.

    known has licence and digest; if several licences share a digest, a whole text gets the first by name. Null texts and
    those of nothing but copyright lines and punctuation have no digest. Rows of equal text get equal results, repeated
    rows are all returned. Other columns are left out. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    by_digest = known.groupBy("digest").agg(F.array_sort(F.collect_set("licence")).alias("licences"))
    few = known.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS
    even = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("body"), even_lines(text).alias("even"))
    # the whole text comes first, then its lines; an outer generator, so that Catalyst does not cut them once more in a filter
    forms = F.concat(F.array(whole_form(F.col("even"))), F.array_distinct(F.split(one_spelling(F.col("even")), "\n")))
    looked_up = (even.select("doc_id", "body", F.posexplode_outer(forms).alias("at", "form"))
                 .select("doc_id", "body", (F.coalesce("at", F.lit(0)) == 0).alias("whole"), sha(F.trim("form")).alias("digest"))
                 .join(F.broadcast(by_digest) if few else by_digest, "digest", "left").filter(F.col("whole") | F.col("licences").isNotNull()))
    found = looked_up.groupBy("doc_id", "body").agg(
        F.count_if("whole").alias("n"), F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("licences")[0])).alias("licence"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("whole"), F.col("licences")))))).alias("notices"))
    return found.select("doc_id", "digest", "licence", "notices", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("row")).select(
        "doc_id", F.when(~F.col("digest").isin("", NOTHING), F.col("digest")).alias("digest"), "licence", "notices")
