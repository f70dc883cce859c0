"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

All DataFrame code. Words are lower-cased runs of letters and digits; shingles
are five words (a template of fewer words is one shingle of all its words).
Templates are grouped by shingle size and by a length class; a class with at
most L shingles a template is scanned by windows of 2 L shingles at a stride of
L, so each whole occurrence lies inside one window. A template of that class
has over L / 2 shingles, hence a Jaccard similarity of 0.2 or more with a window
that holds 0.8 of it. With bands of one MinHash each and BANDS of them such a
pair meets with a probability of 1 - 0.8^48 = 0.99998; the whole template alone
(similarity 0.25) with 0.999999. The containment of each pair retrieved is then
counted exactly. Shingles that no template has leave first, and windows without
any other with them, which loses nothing and makes windows only more similar: while
all templates have at most LITERALS shingles these stand in the plan as a set; with
more, they are joined.

Templates are a table; the planner broadcasts their bands only while their size
is below its own threshold, else the band join is a shuffle join.

Defined edge cases: null, empty and blank texts hold no template and give no
row; a text shorter than a window is one window; repeated rows of a doc_id give
one result row per (doc_id, license_id); with no documents or templates the
result is empty; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

SHINGLE = 5
#: Containment, in percent of the template's distinct shingles.
CONTAINED_PERCENT = 80
BANDS = 48
#: Most shingles of all templates that are written into the plan.
LITERALS = 20_000

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: License notices, and the full texts of the short licenses: id and text.
TEMPLATES = (
    ("apache-2.0-short", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-short", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-short", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-short", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-short", "Licensed under CC BY-SA 4.0."),
    ("mit-short", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd-2-clause", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("bsd-3-clause", f"{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}"),
    ("isc", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_AS_IS}"),
    ("0bsd", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_AS_IS}"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license_id string, text string")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def shingles(w: Column, size: int) -> Column:
    """A 64-bit hash for each run of `size` words, in order."""
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))


def minhashes(h: Column) -> Column:
    """BANDS MinHashes of an array of hashes."""
    band = lambda j: F.array_min(F.transform(h, lambda x: F.xxhash64(x, F.lit(j))))
    return F.array(*[band(j) for j in range(BANDS)])


def prepare(found: DataFrame) -> DataFrame:
    """license_id, size (words a shingle), class (at most 2^class shingles), h (distinct shingles)."""
    t = found.withColumn("w", tokens(F.col("text"))).where(F.size("w") > 0).withColumn("size", F.least(F.lit(SHINGLE), F.size("w")))
    whole = F.array_distinct(F.coalesce(*[F.when(F.col("size") == s, shingles(F.col("w"), s)) for s in range(1, SHINGLE + 1)]))
    return t.select("license_id", "size", whole.alias("h")).withColumn("class", F.ceil(F.log2(F.size("h"))).cast("int"))


def _hits(docs: DataFrame, t: DataFrame, sizes: list[int]) -> DataFrame:
    """row, doc_id, size, m (the text's shingles of that size), i, x: the place and hash of each shingle that some template has."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", tokens(F.col("text")).alias("w"))
    known = t.select("size", F.explode("h").alias("x")).distinct()
    few = t.agg(F.sum(F.size("h"))).first()[0] <= LITERALS
    kept: Column = F.lit(True)
    if few:
        of: dict[int, list[int]] = {s: [] for s in sizes}
        for r in known.sort("size", "x").collect():
            of[r.size].append(r.x)
        # one expression for all: a literal for each would be a call of the JVM for each
        values = {s: ", ".join(f"bigint('{x}')" for x in of[s]) for s in sizes}
        kept = reduce(or_, [F.arrays_overlap(f"s{s}", F.expr(f"array({values[s]})")) for s in sizes])
    rows = rows.select("row", "doc_id", *[shingles(F.col("w"), s).alias(f"s{s}") for s in sizes]).where(kept)
    if few:
        rows = rows.select("row", "doc_id", *[F.struct(F.lit(s).alias("size"), F.size(f"s{s}").alias("m"), F.expr(f"filter(transform(s{s}, (x, i) -> struct(i, x)), e -> e.x IN ({values[s]}))").alias("h")).alias(f"h{s}") for s in sizes])
        hits = rows.select("row", "doc_id", F.explode(F.array(*[f"h{s}" for s in sizes])).alias("e")).select("row", "doc_id", "e.size", "e.m", F.explode("e.h").alias("e"))
        return materialize(hits.select("row", "doc_id", "size", "m", F.col("e")["i"].alias("i"), F.col("e")["x"].alias("x")), "licensed")
    each = [rows.select("row", "doc_id", F.lit(s).alias("size"), F.size(f"s{s}").alias("m"), F.posexplode(f"s{s}").alias("i", "x")) for s in sizes]
    return materialize(reduce(DataFrame.unionByName, each).join(known, ["size", "x"], "left_semi"), "licensed")


def scan(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, license_id, shared (most distinct shingles of the template in one window), n_template, first_word (where the first window begins, from 0)."""
    spark = docs.sparkSession
    t = materialize(prepare(found), "licenses")
    kinds = [tuple(r) for r in t.select("size", "class").distinct().sort("size", "class").collect()]  # a pair for each length class at most
    if not kinds:
        return spark.createDataFrame([], "doc_id long, license_id string, shared long, n_template long, first_word long")
    sizes = sorted({s for s, _ in kinds})
    classes = F.coalesce(*[F.when(F.col("size") == s, F.array(*[F.lit(c) for n, c in kinds if n == s])) for s in sizes])
    hits = _hits(docs, t, sizes).withColumn("class", F.explode(classes)).withColumn("stride", F.expr("shiftleft(1, class)"))
    at = F.floor(F.col("i") / F.col("stride"))
    windows = hits.select("row", "doc_id", "size", "class", "stride", "m", "x", F.explode(F.array(at, at - 1)).alias("b"))
    windows = windows.where((F.col("b") == 0) | (F.col("b") > 0) & (F.col("b") * F.col("stride") <= F.col("m") - 1 - F.col("stride")))
    windows = windows.groupBy("row", "doc_id", "size", "class", "stride", "b").agg(F.collect_set("x").alias("x"))  # at most 2 * stride
    windows = windows.select("doc_id", "size", "class", (F.col("b") * F.col("stride")).alias("first_word"), "x", F.posexplode(minhashes(F.col("x"))).alias("band", "m"))
    bands = t.select("license_id", "size", "class", "h", F.posexplode(minhashes(F.col("h"))).alias("band", "m"))
    pairs = windows.join(bands, ["size", "class", "band", "m"]).select("doc_id", "license_id", "first_word", F.size(F.array_intersect("x", "h")).alias("shared"), F.size("h").alias("n_template"))
    pairs = pairs.where(100 * F.col("shared") >= CONTAINED_PERCENT * F.col("n_template"))
    long = lambda c: F.col(c).cast("long")
    return pairs.groupBy("doc_id", "license_id").agg(F.max(long("shared")).alias("shared"), F.max(long("n_template")).alias("n_template"), F.min(long("first_word")).alias("first_word"))


def oracle() -> str:
    """Every template against every window by brute force, without MinHashes."""
    rows = ", ".join("('%s', '%s')" % (i, x.replace("'", "''")) for i, x in TEMPLATES)
    return f"""
WITH t0(license_id, text) AS (VALUES {rows}),
t1 AS (SELECT license_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM t0),
t2 AS (SELECT license_id, w, least({SHINGLE}, len(w)) AS size FROM t1),
t AS (SELECT license_id, size, list_distinct(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i+size-1], ' '))) AS h FROM t2),
tc AS (SELECT *, len(h) AS n, CAST(ceil(log2(len(h))) AS INTEGER) AS k FROM t),
ts AS (SELECT license_id, size, n, k, unnest(h) AS g FROM tc),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
s AS (SELECT doc_id, size, len(w) - size + 1 AS m, unnest(list_transform(range(1, len(w) - size + 2), lambda i: struct_pack(i := i - 1, g := array_to_string(w[i:i+size-1], ' '))), recursive := true) FROM d, (SELECT DISTINCT size FROM tc)),
hit AS (SELECT doc_id, license_id, n, k, m, i, g FROM s JOIN ts USING (size, g)),
win AS (SELECT *, unnest([i // (1 << k), i // (1 << k) - 1]) AS b FROM hit),
c AS (SELECT doc_id, license_id, n, b * (1 << k) AS first_word, count(DISTINCT g) AS shared FROM win WHERE b >= 0 AND (b = 0 OR b * (1 << k) <= m - 1 - (1 << k)) GROUP BY ALL)
SELECT doc_id, license_id, CAST(max(shared) AS BIGINT) AS shared, CAST(max(n) AS BIGINT) AS n_template, CAST(min(first_word) AS BIGINT) AS first_word FROM c WHERE 100 * shared >= {CONTAINED_PERCENT} * n GROUP BY doc_id, license_id
"""
