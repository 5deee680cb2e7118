"""License scans by canonical digests: texts and their lines are normalised as a whole and looked up by hash join.

Canonical form: lower case, copyright lines out, runs of marks and white space to single spaces, equivalent spellings to
one. A text is normalised by byte tables and splits, line by line; the patterns for spellings run only on texts that hold
one of their stems. The known texts are a table like any other; the built-in one has a few dozen rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark.llm import shared

# Patterns of the canonical form, in the order they are applied, in a syntax that Java, RE2 and Python share.
COPYRIGHT_STARTS = ("copyright", "(c)", "©")
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
MARKS = r"[\x00-/:-@\[-`{-\x7f‘’“”–—•]+"
SPELLINGS = (
    (r"\b(sub|re)?licenc(e|es|ed|ing)\b", r"\1licens\2"),
    (r"\b(author|organ|recogn|real|util|initial)is(e|es|ed|ing|ation|ations)\b", r"\1iz\2"),
    (r"\b(fav|behavi|col|hon)our(s|ed|able)?\b", r"\1or\2"),
    (r"\backnowledgement(s)?\b", r"acknowledgment\1"),
    (r"\bcopyright owner(s)?\b", r"copyright holder\1"),
    (r"\bnon commercial\b", r"noncommercial"),
)
STEMS = ("licenc", "authoris", "organis", "recognis", "realis", "utilis", "initialis", "favour", "behaviour", "colour", "honour", "acknowledgement", "copyright owner", "non commercial")
WIDE_MARKS = "‘’“”–—•"

# Known notices and licence texts by identifier.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = BSD_2.replace(
    "\nTHIS SOFTWARE",
    """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
THIS SOFTWARE""",
)
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <{address}>"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: The notice of the GNU licences in the head of a file; {name} and {version} are filled in below.
GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General
Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any
later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details.
You should have received a copy of the GNU {name} General Public License along with this program. If not, see
<{address}>."""
GNU = (("GPL-2.0-or-later", "", "2"), ("GPL-3.0-or-later", "", "3"), ("LGPL-2.1-or-later", "Lesser", "2.1"), ("LGPL-3.0-or-later", "Lesser", "3"), ("AGPL-3.0-or-later", "Affero", "3"))
KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2),
    ("BSD-2-Clause", "All rights reserved.\n" + BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\nAll rights reserved.\n" + BSD_2),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
    ("BSD-3-Clause", "All rights reserved.\n" + BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License\nAll rights reserved.\n" + BSD_3),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("Zlib", ZLIB),
    ("Zlib", "zlib License\n" + ZLIB),
    ("Unlicense", UNLICENSE.format(address="https://unlicense.org")),
    ("Unlicense", UNLICENSE.format(address="http://unlicense.org/")),
    ("BSL-1.0", BOOST),
    *((spdx, GNU_NOTICE.format(name=name, version=version, address=f"{scheme}://www.gnu.org/licenses/")) for spdx, name, version in GNU for scheme in ("http", "https")),
)
#: Whole texts too long to stand here, as digests of their canonical forms.
LONG_TEXTS = (
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("GFDL-1.2-only", "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f"),
    ("GFDL-1.3-only", "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
)
#: More rows than this join by shuffle instead of a broadcast.
BROADCAST_ROWS = 10_000


#: A notice: copyright with a sign, a year or a name. Licence sentences wrap before the word, and lists have an item (c).
PROSE = rb"(?:holders?|owners?|notices?|laws?|licen[cs]e[sd]?|statements?|interests?|protection|treaty|treaties|disclaimers?|permissions?|and|or|is|are|in|of|on|to|for|that|by the|as|the above)"
NOTICE = re.compile(rb"(?:\xc2\xa9|\(c\)\W*(?:copyright|\d{4}|year)|copyright(?![a-z])(?!\s*$)(?!\s+" + PROSE + rb"\b))")
_TO_SPACE = bytes(b if b >= 0x80 or b == 0x0A or chr(b).isalnum() else 0x20 for b in range(256))
_STARTS = tuple(x.encode() for x in COPYRIGHT_STARTS)
_STEMS = tuple(x.encode() for x in STEMS)
_WIDE = tuple(x.encode() for x in WIDE_MARKS)
_SPELLINGS = tuple((re.compile(p.encode()), s.encode()) for p, s in SPELLINGS)


def _spelled(text: bytes) -> bytes:
    if any(stem in text for stem in _STEMS):
        for pattern, spelling in _SPELLINGS:
            text = pattern.sub(spelling, text)
    return text


def canonical_lines(text: str) -> list[bytes]:
    """Every line without marks, spaces single, spellings as they are; copyright notices are empty."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    plain = raw
    if b"\xe2\x80" in plain:
        for mark in _WIDE:
            plain = plain.replace(mark, b" ")
    lines = [b" ".join(line.split()) for line in plain.translate(_TO_SPACE).split(b"\n")]
    if any(x in raw for x in _STARTS):
        starts = [NOTICE.match(line.lstrip(b" \t")) is not None for line in raw.split(b"\n")]
        lines = [b"" if own else line for line, own in zip(lines, starts, strict=True)]
    return lines


def canonical(lines: list[bytes]) -> bytes:
    """Canonical form of a whole text from its lines."""
    return _spelled(b" ".join(filter(None, lines)))


def known_digests(known=KNOWN) -> list[tuple[str, str]]:
    """Distinct (digest, license_id), of equal canonical texts the first."""
    out: dict[str, str] = {}
    for name, text in known:
        out.setdefault(hashlib.sha256(canonical(canonical_lines(text))).hexdigest(), name)
    if known is KNOWN:
        for name, digest in LONG_TEXTS:
            out.setdefault(digest, name)
    return list(out.items())


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_digests(), "digest string, license_id string")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, license_id, n_license_lines, line_licenses) of every row.

    digest: SHA-256 of the whole text's canonical form; license_id: the known licence with this digest, else null. Lines
    are texts too: how many of a text's lines are known licences or notices, and which, sorted and joined by commas. Null
    texts have null digests and no lines; texts without a word or only with copyright lines have the digest of the empty
    text, which is never a licence. known: (digest, license_id), digests distinct. Equal rows come back each; other columns
    play no part.
    """
    known = known.where(F.col("digest") != hashlib.sha256(b"").hexdigest())
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    shared.tune(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, each = [], []
            for text in batch.column(2):
                if not text.is_valid:
                    whole.append(None), each.append([])
                    continue
                lines = canonical_lines(text.as_py())
                whole.append(hashlib.sha256(canonical(lines)).hexdigest())
                each.append([hashlib.sha256(_spelled(x)).digest() for x in lines if x])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(whole, pa.string()), pa.array(each, pa.list_(pa.binary()))], names=["k", "doc_id", "digest", "lines"])

    source = docs.select(shared.row_key(id_col, text_col).alias("k"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hashed = shared.written(source.mapInArrow(shared.tidy(digests), f"k long, doc_id {kind}, digest string, lines array<binary>"), "digests")
    line = hashed.select("k", F.explode("lines").alias("line")).join(known.select(F.unhex("digest").alias("line"), "license_id"), "line")
    lines = line.groupBy("k", "license_id").agg(F.count("*").alias("n")).groupBy("k").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list("license_id")), ",").alias("line_licenses"))
    # equal rows share k and were counted together
    equal = hashed.select("k").join(lines, "k", "left_semi").groupBy("k").agg(F.count("*").alias("rows"))
    lines = lines.join(equal, "k").select("k", F.expr("n div rows").alias("n_license_lines"), "line_licenses")
    whole = hashed.select("k", "doc_id", "digest").join(known, "digest", "left")
    return whole.join(lines, "k", "left").select("doc_id", "digest", "license_id", F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"), F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))


def scan_sql(source: str = "documents", known=KNOWN) -> str:
    """DuckDB SQL with the same rows for tables whose rows differ, and whose lines that start with copyright, (c) or © are notices."""

    def form(column: str) -> str:
        out = f"regexp_replace(lower({column}), '{COPYRIGHT_LINE}', chr(10), 'g')"
        out = f"regexp_replace({out}, '{MARKS}', ' ', 'g')"
        for pattern, spelling in SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{spelling}', 'g')"
        return f"sha256(trim({out}, ' '))"

    values = ", ".join(f"('{d}', '{n}')" for d, n in known_digests(known))
    return f"""WITH known(digest, license_id) AS (VALUES {values}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {source}),
hits AS (SELECT doc_id, license_id, count(*) AS n FROM (SELECT doc_id, {form("line")} AS digest FROM lines) JOIN known USING (digest) GROUP BY ALL),
per AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, string_agg(license_id, ',' ORDER BY license_id) AS line_licenses FROM hits GROUP BY doc_id),
whole AS (SELECT doc_id, {form("text")} AS digest FROM {source})
SELECT w.doc_id, w.digest, k.license_id, coalesce(p.n, 0) AS n_license_lines, coalesce(p.line_licenses, '') AS line_licenses
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN per p ON p.doc_id = w.doc_id"""
