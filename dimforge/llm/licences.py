"""Licence scan by canonical digests.

Texts are brought to a canonical form (case, punctuation, copyright lines,
equivalent spellings), and the digests of whole texts, and of single lines as
licence notices, are looked up in the digests of known licences by hash join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimforge.llm.common import literal_rows, materialise, row_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything in ASCII but letters, digits and the line feed, and typographic
# quotes and dashes.
MARKS = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{201C}\x{201D}\x{2018}\x{2019}\x{2013}\x{2014}]+"
# Spellings taken as equal, the second being the canonical one.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"), ("organisation", "organization"),
    ("programme", "program"), ("recognised", "recognized"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"), ("version", "v"),
)
COPYRIGHT_LINE = r"^(copyright( |$)|©|c [0-9]|all rights reserved$)"
COPYRIGHT_TERMS = r"^copyright (notice|holder|owner|law|license|statement|disclaimer|interest|and |or |in )"

# Published licence texts and notices, by SPDX identifier.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.\n\n")
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n")
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE.")
TEXTS = (
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted.\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAME + _BSD_TAIL),
)
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text: A-Z lower-cased, marks and white space as one
    space, equivalent spellings replaced; without empty lines and copyright
    lines. A null text has none."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    # Two spaces between words, so that each word has two of its own.
    t = F.regexp_replace(F.regexp_replace(t, MARKS, "  "), "\n", "  \n  ")
    t = F.concat(F.lit("  "), F.regexp_replace(t, " {2,}", "  "), F.lit("  "))
    for old, new in EQUIVALENT:
        t = F.replace(t, F.lit(f" {old} "), F.lit(f" {new} "))
    t = F.regexp_replace(F.regexp_replace(t, " {2,}", " "), " ?\n ?", "\n")
    return F.filter(F.split(F.trim(t), "\n"), lambda x: (x != "") & (
        ~x.rlike(COPYRIGHT_LINE) | x.rlike(COPYRIGHT_TERMS)))


def _whole(lines: Column) -> Column:
    return F.array_join(lines, " ")


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, kind, license): one row per known digest; its size is that of
    TEXTS and NOTICES."""
    rows = [{"kind": "text", "license": n, "text": t} for n, t in TEXTS]
    rows += [{"kind": "notice", "license": n, "text": t} for n, t in NOTICES]
    known = literal_rows(spark, rows, "kind: string, license: string, text: string")
    return (known.select("kind", "license", F.md5(_whole(canonical_lines(F.col("text")))).alias("digest"))
            .groupBy("digest", "kind").agg(F.min("license").alias("license")))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, digest, license, notices, n_notices`` for every row of ``docs``.

    ``digest`` is the MD5 of the whole canonical text and ``license`` the known
    licence with that digest (else null); ``notices`` the sorted names of
    licences of which some line is a notice, and ``n_notices`` their number.
    A null or empty text has the digest of no words and no licence. Null ids
    and repeated rows are scanned like any other; other columns are not read;
    an empty table gives an empty result.
    """
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"),
                       canonical_lines(F.col(text_col)).alias("lines"))
    # Written once: both look-ups below need the costly canonical form.
    rows = materialise(rows.select("id", "k1", "k2", F.md5(_whole(F.col("lines"))).alias("digest"),
                                   F.array_distinct(F.transform("lines", lambda x: F.unhex(F.md5(x)))).alias("lines")),
                       "licence-digests")
    known = known_digests(docs.sparkSession)
    texts = F.broadcast(known.filter("kind = 'text'").select("digest", "license"))
    notices = F.broadcast(known.filter("kind = 'notice'").select(F.unhex("digest").alias("line"),
                                                                    F.col("license").alias("notice")))
    found = (rows.select("k1", "k2", F.explode("lines").alias("line")).join(notices, "line")
             .groupBy("k1", "k2").agg(F.collect_set("notice").alias("notices")))
    whole = rows.select("id", "k1", "k2", "digest").join(texts, "digest", "left")
    names = F.coalesce(F.array_sort("notices"), F.array().cast("array<string>"))
    return (whole.join(found, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col), "digest", "license",
                    names.alias("notices"), F.size(names).cast("long").alias("n_notices")))
