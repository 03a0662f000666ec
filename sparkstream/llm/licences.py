"""Operator 7: licence scans by canonical digests, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import ready

# Equivalent spellings, as licence matching guidelines list them; the left one becomes the right one,
# wherever blanks stand for marks and line ends.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authoris", "authoriz"), ("centre", "center"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("judgement", "judgment"), ("labelled", "labeled"),
    ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"), ("whilst", "while"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("https", "http"),
)

#: A copyright line: after comment marks at most, it opens with the sign, or with the word or a bracketed c and has a sign, a year or
#: a place for one, or reserves rights. A line that a wrap makes begin with the word is none, nor is an item (c) of a list.
COPYRIGHT = (
    r"(^|\n)[ \t*#/;-]*(©|copyright[^\n]*(©|\(c\)|[12][0-9][0-9][0-9]|[\[<{](year|yyyy)|rights reserved)"
    r"|\(c\)[ \t]*(copyright|[\[<{(]?(year|yyyy|[12][0-9][0-9][0-9])))[^\n]*"
)
#: Each known text holds one of these, so a text without any is none of them.
KEY = r"licen[cs]|rights|permission|public domain|warrant|redistribution"

_WITHOUT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
_BSD_REST = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
    "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
    "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
    "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
    "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
    "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
    "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
    "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
    "altered from any source distribution."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
    "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)


def _gnu_header(name: str, version: str) -> str:
    """The notice that the GNU licences ask for at the head of a file."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the "
        f"Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        f"or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along "
        "with this program. If not, see <https://www.gnu.org/licenses/>."
    )


# Identifiers and texts of licences and of the notices that point to them.
_TEXTS = (
    ("MIT", _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software. " + _WITHOUT_WARRANTY),
    ("MIT", "MIT License\n" + _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software. " + _WITHOUT_WARRANTY),
    ("MIT-0", _MIT_GRANT + ". " + _WITHOUT_WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_REST),
    ("0BSD", _ISC_GRANT + ". " + _ISC_REST),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an "
                   '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
                   "language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain."),
    ("reserved", "All rights reserved."),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_REST),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_GRANT + _BSD_REST),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAME + _BSD_REST),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_GRANT + _BSD_NAME + _BSD_REST),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + " For more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + " For more information, please refer to <https://unlicense.org/>"),
    ("Zlib", _ZLIB),
    ("MPL-2.0", _MPL),
    ("GPL-2.0-or-later", _gnu_header("GNU General Public License", "2")),
    ("GPL-3.0-or-later", _gnu_header("GNU General Public License", "3")),
    ("LGPL-3.0-or-later", _gnu_header("GNU Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _gnu_header("GNU Affero General Public License", "3")),
)

# Identifiers that a tag line may name, and the names of licences in notices of one sentence.
TAGGED = (
    "MIT", "MIT-0", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "Unlicense", "Zlib", "BSL-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)
NAMED = (
    ("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache 2.0 License"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("MPL-2.0", "Mozilla Public License, version 2.0"), ("Unlicense", "Unlicense license"),
    ("GPL-2.0", "GNU General Public License v2.0"), ("GPL-3.0", "GNU General Public License v3.0"),
    ("LGPL-3.0", "GNU Lesser General Public License v3.0"), ("AGPL-3.0", "GNU Affero General Public License v3.0"),
)
NOTICES = ("Licensed under the {}.", "Released under the {}.", "Distributed under the {}.", "This project is licensed under the {}.")

KNOWN = (
    *_TEXTS,
    *[(name, f"SPDX-License-Identifier: {name}") for name in TAGGED],
    *[(name, notice.format(title)) for name, title in NAMED for notice in NOTICES],
)


def canonical(text) -> F.Column:
    """Lower case, no copyright lines, one blank for whatever is no letter or digit, and one of each equivalent spelling."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "\n")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return out


def canonical_sql(text: str) -> str:
    """The same in SQL, for an expression ``text``."""
    out = f"regexp_replace(lower({text}), '{COPYRIGHT}', chr(10), 'g')"
    out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for one, other in SPELLINGS:
        out = f"replace({out}, '{one}', '{other}')"
    return out


def known_table(spark, known=KNOWN) -> DataFrame:
    """Known texts as rows: ``licence`` and the ``digest`` of the canonical text."""
    rows = [F.struct(F.lit(name).alias("licence"), F.lit(text).alias("known")) for name, text in known]
    texts = spark.range(1).select(F.inline(F.array(*rows)))
    return texts.select("licence", F.sha2(canonical(F.col("known")).cast("binary"), 256).alias("digest")).distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, key: str = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per id: ``doc_id``, ``licence`` of the whole text or null, ``notices`` (names of the licences that single
    lines are, sorted, with commas between; empty without any), ``n_notices`` (how many lines that is).

    A text, or a line of one, is taken as a whole: brought to its canonical form, hashed, and joined to the digests of
    ``known`` (``licence``, ``digest``). Texts and lines without the pattern ``key`` are none of the known ones and are
    not hashed; if ``known`` has texts without it, give another. Null and empty texts match nothing. Rows with the same
    id count as one document; of several licences of a whole text the first by name is given.

    The one shuffle is an aggregate by id with partial results. The known digests are few by default; a table of them
    is joined as Spark sees fit by its size.
    """
    spark = ready(docs.sparkSession)
    known = known_table(spark) if known is None else known
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("body"))
    asked = F.coalesce(F.lower("body").rlike(key), F.lit(False))
    lines = F.filter(F.split("body", "\n"), lambda x: F.lower(x).rlike(key))
    units = F.when(
        asked,
        F.concat(
            F.array(F.struct(F.lit(True).alias("whole"), F.col("body").alias("unit"))),
            F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))),
        ),
    )
    hashed = rows.select("doc_id", F.explode_outer(units).alias("u")).select(
        "doc_id", "u.whole", F.sha2(canonical(F.col("u.unit")).cast("binary"), 256).alias("digest")
    )
    found = hashed.join(known.select("licence", "digest"), "digest", "left")
    return found.groupBy("doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("licence")))), ",").alias("notices"),
        F.count_if(~F.col("whole") & F.col("licence").isNotNull()).alias("n_notices"),
    )


def scan_sql(known=KNOWN) -> str:
    """The registered query in SQL: the same canonical form, held against the known texts' own."""
    values = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in known)
    return f"""
    WITH known AS (
      SELECT DISTINCT licence, {canonical_sql("body")} AS canon FROM (VALUES {values}) AS v(licence, body)
    ), units AS (
      SELECT doc_id, TRUE AS whole, text AS unit FROM documents
      UNION ALL
      SELECT doc_id, FALSE, unnest(string_split(text, chr(10))) FROM documents
    ), found AS (
      SELECT doc_id, whole, licence FROM units LEFT JOIN known ON {canonical_sql("unit")} = canon
    )
    SELECT doc_id, min(CASE WHEN whole THEN licence END) AS licence,
      coalesce(string_agg(DISTINCT CASE WHEN NOT whole THEN licence END, ',' ORDER BY CASE WHEN NOT whole THEN licence END), '') AS notices,
      count(CASE WHEN NOT whole THEN licence END) AS n_notices
    FROM found GROUP BY doc_id
    """
