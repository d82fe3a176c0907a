"""Licences by digest: canonical texts, hashed whole and joined to the digests of known licences.

A text is made canonical before hashing: lower case, no copyright lines, one spelling of
words that licences spell two ways, and only letters and digits, one space between words.
"""

from __future__ import annotations

import re
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.llm.repeats import id_of, keyed
from lustra.llm.stored import stored

# --- fixed values -----------------------------------------------------------------
#: Words that licence texts spell two ways: what is met, what is kept.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("sub licensed", "sublicensed"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated'
    ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
    " to permit persons to whom the Software is furnished to do so"
)
_MIT_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO'
    " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
    " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
    " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
    " IN THE SOFTWARE."
)
_MIT = (
    f"{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be"
    f" included in all copies or substantial portions of the Software.\n\n{_MIT_REST}"
)
_BSD_FIRST = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission.\n\n"
)
_BSD_LAST = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
    " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted"
)
_ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL'
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
    " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
    " PERFORMANCE OF THIS SOFTWARE."
)
_ISC = (
    f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_REST}"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
    " liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this"
    " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to"
    " the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that"
    " you wrote the original software. If you use this software in a product, an acknowledgment in the product"
    " documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as"
    " such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or"
    " altered from any source distribution."
)
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
    " the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless"
    " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
    ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the'
    " specific language governing permissions and limitations under the License."
)
_GPL3_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
    " later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
    " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
    " License for more details.\n\nYou should have received a copy of the GNU General Public License along with this"
    " program. If not, see <https://www.gnu.org/licenses/>."
)
#: Known texts by licence: whole licences, the notices put into files, and one-line notices.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT-0", f"{_MIT_GRANT}.\n\n{_MIT_REST}"),
    ("MIT-0", f"MIT No Attribution\n\n{_MIT_GRANT}.\n\n{_MIT_REST}"),
    ("BSD-2-Clause", _BSD_FIRST + _BSD_LAST),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_FIRST + _BSD_LAST),
    ("BSD-3-Clause", _BSD_FIRST + _BSD_THIRD + _BSD_LAST),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_FIRST + _BSD_THIRD + _BSD_LAST),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_REST}"),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("GPL-3.0-or-later", _GPL3_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines that only say who holds the rights.
COPYRIGHT_LINE = (
    r"(^|\n)[^a-z0-9\n(©]*((copyright[ \t:]*)?(\(c\)|©)|copyright[ \t:,]*([0-9<\[{]|by )|all rights reserved)[^\n]*"
)
_ANY_SPELLING = " (" + "|".join(met for met, _ in SPELLINGS) + ") "


def _bare(text: Column) -> Column:
    """Words of a-z and 0-9, a space before and after each, without copyright lines."""
    lower = F.translate(text, _UPPER, _LOWER)
    words = F.regexp_replace(F.regexp_replace(lower, COPYRIGHT_LINE, "\n"), "[^a-z0-9]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _one_spelling(bare: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")), SPELLINGS, bare)


def _spelled(bare: Column) -> Column:
    """One spelling of each word."""
    return F.when(bare.rlike(_ANY_SPELLING), _one_spelling(bare)).otherwise(bare)


def canonical(text: Column) -> Column:
    """The form that is hashed."""
    return _spelled(_bare(text))


def with_digest(df: DataFrame, text: str) -> DataFrame:
    """A column of texts replaced by ``digest``: SHA-256 of the canonical form, NULL for NULL and texts without a word.

    Each step is a column of its own, so that it is computed once.
    """
    bare = df.withColumn("digest", _bare(F.col(text))).drop(text)
    form = bare.withColumn("digest", _spelled(F.col("digest")))
    hashed = F.when(F.length("digest") > 2, F.sha2(F.col("digest").cast("binary"), 256))
    return form.withColumn("digest", hashed)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest`` and ``licence`` of the known texts, one row a digest."""
    texts = spark.createDataFrame(list(known), "licence string, text string")
    return with_digest(texts, "text").groupBy("digest").agg(F.min("licence").alias("licence"))


# --- the same form in tasks ----------------------------------------------------

_KEPT = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789\n")
_SMALL = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORDS = bytes(b if b in _KEPT else 0x20 for b in range(256))
_RIGHTS = re.compile(COPYRIGHT_LINE)
#: What a copyright line has, for a quick look.
_SIGNS = tuple(sign.encode() for sign in ("copyright", "(c)", "©", "all rights reserved"))
_SPELLINGS = tuple((f" {met} ".encode(), f" {kept} ".encode()) for met, kept in SPELLINGS)
_FIRST_WORDS = frozenset(met.split()[0].encode() for met, _ in SPELLINGS)


def _form(words: list[bytes]) -> bytes:
    form = b" " + b" ".join(words) + b" "
    if not _FIRST_WORDS.isdisjoint(words):
        for met, kept in _SPELLINGS:
            form = form.replace(met, kept)
    return form


def text_digests(text: bytes) -> tuple[str | None, set[str]]:
    """SHA-256 of the canonical forms of a text (None without a word) and of its lines: as :func:`canonical` has them."""
    text = text.translate(_SMALL)
    if any(sign in text for sign in _SIGNS):
        text = _RIGHTS.sub("\n", text.decode()).encode()
    text = text.translate(_WORDS)
    lines = {sha256(_form(words)).hexdigest() for line in text.split(b"\n") if (words := line.split())}
    words = text.split()
    return sha256(_form(words)).hexdigest() if words else None, lines


def _digests(wanted: frozenset[str] | None):
    """Digests of whole texts and of their distinct lines; of lines only those wanted, if that is given."""

    def of(batches):
        for batch in batches:
            whole, lines = [], []
            for text in batch.column("text"):
                digest, own = text_digests(text.as_buffer().to_pybytes()) if text.is_valid else (None, set())
                whole.append(digest)
                lines.append(sorted(own if wanted is None else own & wanted))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("rid"),
                    pa.array(whole, pa.string()),
                    pa.array(lines, pa.list_(pa.string())),
                ],
                names=["doc", "rid", "digest", "lines"],
            )

    return of


_FOUND = "doc long, rid long, digest string, lines array<string>"


def scan_licences(documents: DataFrame, known: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """Per row: doc_id, digest, licence (of the whole text) and notices (licences of whole lines).

    Needs ``doc_id`` and ``text``; further columns are ignored. ``known`` has digest and
    licence, one row a digest. Up to ``broadcast_rows`` of them are handed to the tasks, and only lines that
    have one of these digests leave them; beyond that the digests of all lines are shuffled. Whole texts and
    single lines are looked up alike; notices are distinct, sorted and joined by commas, NULL if there are none.

    NULL texts and texts without a word have no digest. Repeated rows get equal results. An
    empty table gives an empty result. A text is held as a whole by its task, however long.
    """
    known = stored(known.select("digest", "licence"), "known")
    few = known.count() <= broadcast_rows
    wanted = frozenset(r.digest for r in known.select("digest").collect()) if few else None
    if few:
        known = F.broadcast(known)
    read = keyed(documents).mapInArrow(_digests(wanted), _FOUND)
    # Read by both sides below, so that the texts are read once.
    read = stored(read, "digests")
    notices = (
        read.select("doc", "rid", F.explode_outer("lines").alias("digest"))
        .join(known, "digest")
        .groupBy("doc", "rid")
        .agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"))
    )
    return (
        read.select("doc", "rid", "digest")
        .join(known, "digest", "left")
        .join(notices, ["doc", "rid"], "left")
        .select(id_of(F.col("doc")).alias("doc_id"), "digest", "licence", "notices")
    )


def oracle_sql(known: tuple[tuple[str, str], ...] = KNOWN) -> str:
    """The same in SQL: one expression for the canonical form, used on texts, lines and known licences."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def form(column: str) -> str:
        lower = f"translate({column}, '{_UPPER}', '{_LOWER}')"
        bare = f"regexp_replace({lower}, {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        out = f"' ' || trim(regexp_replace({bare}, '[^a-z0-9]+', ' ', 'g')) || ' '"
        for met, kept in SPELLINGS:
            out = f"replace({out}, ' {met} ', ' {kept} ')"
        return out

    def hashed(column: str) -> str:
        return f"CASE WHEN length({form(column)}) > 2 THEN sha256({form(column)}) END"

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in known)
    return f"""
WITH known AS (SELECT {hashed('text')} AS digest, min(licence) AS licence FROM (VALUES {rows}) AS v(licence, text)
 GROUP BY 1),
whole AS (SELECT doc_id, text, {hashed('text')} AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
notices AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT licence)), ',') AS notices FROM (
 SELECT doc_id, {hashed('line')} AS digest FROM lines) AS hashed JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, digest, licence, notices FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)"""
