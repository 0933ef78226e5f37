"""License scans: normalised text against templates by the Dice coefficient.

A unit (a line, a paragraph or the whole text) and a template are reduced to
their distinct word bigrams. Their Dice coefficient can reach ``t`` only if
the sizes are within ``t / (2 - t)`` of each other, so a unit is compared with
the templates of fitting size only.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table
from hirelens.llm.decontaminate import words

LEAST = 0.85

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
          "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
          "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. ")
_BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
            "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
            "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
            "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
            "DAMAGE.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version {0} of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.")
# License identifiers and the wording of their notices and texts.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GNU.format("2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GNU.format("3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. " + _AS_IS),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software."),
)


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    """Distinct pairs of neighbouring words (A-Z lower-cased; every byte that
    is no ASCII letter or digit parts words, others beyond ASCII don't)."""
    found: set[tuple[bytes, bytes]] = set()
    last: list[bytes] = []
    for piece in words(text):
        found.update(zip(last + piece, piece if last else piece[1:]))
        last = piece[-1:] or last
    return found


class Templates:
    """Templates by their number of bigrams, for lookups by size."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        found = sorted(((len(b), name, b) for name, text in templates if (b := bigrams(text.encode()))),
                       key=lambda x: x[:2])
        self.sizes = [n for n, _, _ in found]
        self.found, self.least = found, least
        self.narrow, self.wide = least / (2 - least), (2 - least) / least
        self.fewest = min(self.sizes, default=0) * self.narrow

    def best(self, text: bytes) -> tuple[float, str] | None:
        """The template of the highest coefficient, if ``least`` or more (ties
        to the smaller name). Too few bytes for the smallest size: none."""
        if len(text) < 4 * self.fewest:
            return None
        unit = bigrams(text)
        n, top = len(unit), None
        if not n:
            return None
        low, high = bisect_left(self.sizes, n * self.narrow - 1e-9), bisect_right(self.sizes, n * self.wide + 1e-9)
        for size, name, template in self.found[low:high]:
            dice = 2 * len(unit & template) / (n + size)
            if dice >= self.least and (top is None or (-dice, name) < (-top[0], top[1])):
                top = dice, name
        return top

    def scan(self, text: bytes) -> list[dict]:
        """Matches of the lines, the paragraphs of several lines and, if it
        has several paragraphs, the whole text; places in bytes."""
        out = []

        def add(start: int, unit: bytes) -> None:
            if found := self.best(unit):
                out.append({"license": found[1], "dice": found[0], "start": start, "end": start + len(unit)})

        at = 0
        paragraphs = text.split(b"\n\n")
        for paragraph in paragraphs:
            line_at = at
            lines = paragraph.split(b"\n")
            for line in lines:
                add(line_at, line)
                line_at += len(line) + 1
            if len(lines) > 1:
                add(at, paragraph)
            at += len(paragraph) + 2
        if len(paragraphs) > 1:
            add(0, text)
        return out


_KIND = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()),
                                  T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()),
                             ("end", pa.int64())]))


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST,
                  text: str = "text", out: str = "licenses") -> DataFrame:
    """``docs`` with an array column ``out``: each unit's best match with a
    coefficient of ``least`` or more (``license, dice, start, end``; places in
    the text's UTF-8 bytes, in order of the text; lines before the paragraph
    and the text around them).

    Null, empty and one-word texts match nothing. All rows and columns stay (a
    column named like ``out`` is replaced). Every row is looked at by itself,
    so repeated rows and common notices move no data.
    """
    @F.arrow_udf(_KIND)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Templates(templates, least)
        for batch in batches:
            yield pa.array([known.scan(t.as_py() or b"") for t in batch], _ARROW)

    return docs.withColumn(out, of.asNondeterministic()(F.col(text).cast("binary")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the licenses found (sorted, comma-joined), the number of
    matching units, the best coefficient and its license."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    top = F.array_min(F.transform("licenses", lambda m: F.struct((-m["dice"]).alias("d"), m["license"].alias("l"))))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"]))), ",").alias("licenses"),
        F.round(F.coalesce(-top["d"], F.lit(0.0)), 6).alias("best_dice"), top["l"].alias("best_license"))


def _oracle() -> str:
    def pairs(column: str) -> str:
        return (f"list_distinct(list_transform(range(1, len({column})), lambda i: "
                f"{column}[i] || ' ' || {column}[i + 1]))")

    def cut(column: str) -> str:
        return ("regexp_extract_all(translate(" + column + ", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    return f"""
WITH template AS (
  SELECT name, {pairs("w")} AS b FROM (SELECT name, {cut("t")} AS w FROM (VALUES {rows}) v(name, t))),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
para AS (SELECT r, unnest(string_split(text, chr(10) || chr(10))) AS u FROM doc),
unit AS (
  SELECT r, unnest(string_split(u, chr(10))) AS u FROM para
  UNION ALL SELECT r, u FROM para WHERE contains(u, chr(10))
  UNION ALL SELECT r, text FROM doc WHERE contains(text, chr(10) || chr(10))),
gram AS (
  SELECT k, r, {pairs("w")} AS b FROM (SELECT row_number() OVER () AS k, r, {cut("u")} AS w FROM unit) WHERE len(w) > 1),
dice AS (
  SELECT k, r, name, 2.0::DOUBLE * len(list_intersect(gram.b, template.b)) / (len(gram.b) + len(template.b)) AS d
  FROM gram JOIN template ON len(gram.b) BETWEEN 0.5 * len(template.b) AND 2 * len(template.b)),
best AS (
  SELECT r, name, d FROM dice WHERE d >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY d DESC, name) = 1),
per AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(d) AS top,
    first(name ORDER BY d DESC, name) AS top_name FROM best GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(names, '') AS licenses,
  round(coalesce(top, 0.0), 6)::DOUBLE AS best_dice, top_name AS best_license
FROM doc LEFT JOIN per USING (r)
"""


ORACLE = _oracle()
