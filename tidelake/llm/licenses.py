"""Licence scans by canonical digests: DataFrame functions alone.

A text is made canonical: A-Z in lower case, copyright lines dropped, equivalent spellings made
one, everything but letters and digits to single spaces. Its SHA-256 is joined to the digests of
known licences. Documents are looked up whole; so is each of their lines, for one-line notices.

Known are the texts below and the published ones in license_texts, one file for each SPDX name, in
the forms that licence files have: with and without title, with "All rights reserved" under the
copyright line, without the appendix on how to apply the licence, with one line a paragraph and,
for short licences, wrapped at any usual width (a wrapped line may begin with the word copyright,
which makes it a copyright line).

Null and empty texts, and texts of punctuation or copyright lines alone, match nothing; repeated
rows give repeated results; rows without doc_id are looked up like others."""

from __future__ import annotations

import hashlib
import os
import re
import textwrap
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, table

# One-line notices and whole licences in their published wording.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
    "Proprietary": ["All rights reserved."],
}
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
}
#: Published texts, one file for each.
FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
#: Titles of licences whose terms begin without one.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}
#: Licences of which a text without its first words, up to these, is the same.
TERMS = {
    "Apache-2.0": ["TERMS AND CONDITIONS FOR USE", "1. Definitions."],
    "BSL-1.0": ["Permission is hereby granted"],
    "CC0-1.0": ["CC0 1.0 Universal", "Statement of Purpose"],
    "GFDL-1.2": ["0. PREAMBLE"],
    "GFDL-1.3": ["0. PREAMBLE"],
    "GPL-1.0": ["Everyone is permitted to copy", "Preamble"],
    "GPL-2.0": ["Everyone is permitted to copy", "Preamble"],
    "GPL-3.0": ["Everyone is permitted to copy", "Preamble"],
    "LGPL-2.0": ["Everyone is permitted to copy", "Preamble"],
    "LGPL-2.1": ["Everyone is permitted to copy", "Preamble"],
    "LGPL-3.0": ["Everyone is permitted to copy", "This version of the GNU Lesser"],
    "MPL-1.1": ["1. Definitions."],
    "MPL-2.0": ["1. Definitions"],
}
#: Where the appendix begins that files often leave out, and the line before it that they may keep.
APPENDIX = [(r"\n[^\n]*APPENDIX: How to apply", "END OF TERMS AND CONDITIONS"), (r"\n[^\n]*How to Apply These Terms", "END OF TERMS AND CONDITIONS"), (r"\n[^\n]*ADDENDUM: How to use this License", ""), (r"\nExhibit A - Source Code Form", "")]
#: The address of the Free Software Foundation in its licences.
ADDRESSES = ["51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "<https://fsf.org/>", ""]
#: Texts up to this size are known at all widths.
SHORT = 4096
WIDTHS = range(48, 121)
#: Lines that begin so name the holder of the rights, not the terms.
COPYRIGHT = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
#: Equivalent spellings, applied to canonical words in this order.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("http ", "https "),
    ("the apache software license", "the apache license"),
    ("apache license version 2 0", "apache license 2 0"),
    ("general public license version 3", "general public license 3"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _equal_spellings(words: Column) -> Column:
    """Whole words alone: each word has a space on both sides."""
    padded = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    padded = reduce(lambda t, pair: F.replace(t, F.lit(_padded(pair[0])), F.lit(_padded(pair[1]))), SPELLINGS, padded)
    return F.trim(F.replace(padded, F.lit("  "), F.lit(" ")))


def _padded(words: str) -> str:
    return f" {'  '.join(words.split())} "


def canonical(text: Column) -> Column:
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT, "")
    return _equal_spellings(F.trim(F.regexp_replace(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")))


def canonical_lines(text: Column) -> Column:
    """The lines of a text, all made canonical at once but for their spellings."""
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT, "")
    spaced = F.regexp_replace(plain, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.transform(F.split(spaced, "\n", -1), lambda line: F.trim(line))


def digest(text: Column) -> Column:
    """Null where nothing is left of the text."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c, 256))


def known(spark: SparkSession, entries: dict[str, list[str]]) -> DataFrame:
    """licence, digest of each text given: as many rows as the caller lists."""
    rows = [(name, text) for name, texts in entries.items() for text in texts]
    return spark.createDataFrame(rows, "license string, text string").select("license", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def _paragraphs(text: str) -> list[str]:
    return [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text.strip()) if p.strip()]


def _form(text: str) -> str:
    """Equal for texts that are equal once canonical: spares the table most of the forms."""
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(COPYRIGHT, "", text.lower())))


def forms(name: str, text: str) -> list[str]:
    """The text of a licence as licence files have it, each form once."""
    bodies = [text]
    for begin, closing in APPENDIX:
        if m := re.search(begin, text):
            head = text[: m.start()]
            bodies += [head, head.replace(closing, "")] if closing else [head]
    bodies += [re.sub(r"51 Franklin Street,[^\n]*", a, b) for b in bodies if "51 Franklin Street," in b for a in ADDRESSES]
    bodies += [b[b.index(start) :] for b in bodies for start in TERMS.get(name, ()) if start in b]
    short = len(text) <= SHORT
    if short:  # items may have no numbers
        bodies += [re.sub(r"(?m)^[ \t]*\d\.[ \t]", "", b) for b in bodies]
    out: dict[str, str] = {}
    for body in bodies:
        paragraphs = _paragraphs(body)
        layouts = [body, "\n\n".join(paragraphs)]
        if short:
            for width in WIDTHS:
                for hanging in (0, 2, 3, 4):
                    layouts.append("\n\n".join(textwrap.fill(p, width, subsequent_indent=" " * hanging if re.match(r"\d\. |Redistribut|Neither", p) else "", break_long_words=False, break_on_hyphens=False) for p in paragraphs))
        for layout in {_form(x): x for x in layouts}.values():
            for title in ("", *TITLES.get(name, ())):
                for rights in ("", "All rights reserved.") if name.startswith("BSD-") else ("",):
                    whole = "\n\n".join(x for x in (title, rights, layout) if x)
                    out.setdefault(_form(whole), whole)
    return list(out.values())


@cache
def published() -> dict[str, list[str]]:
    """All forms of the whole licences, by SPDX name."""
    texts = dict(TEXTS)
    for file in sorted(os.listdir(FOLDER)):
        with open(os.path.join(FOLDER, file), encoding="utf-8") as f:
            texts[file.removesuffix(".txt")] = f.read()
    return {name: forms(name, text) for name, text in texts.items()}


def scan(docs: DataFrame, licenses: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, digest, license (of the whole text, or null), notices (licences of its lines, sorted,
    comma-joined), n_notices (lines that are notices) of every row. The lists of known licences are
    arguments, of a size that a program holds anyway, and are broadcast (some 1,000 digests for the
    built-in ones), so that a text or line with many copies goes nowhere. Only lines of a notice's length are hashed; texts are read once."""
    spark = docs.sparkSession
    texts = licenses if licenses is not None else {k: [*NOTICES.get(k, []), *([TEXTS[k]] if k in TEXTS else [])] for k in {**NOTICES, **TEXTS}}
    whole = known(spark, texts if licenses is not None else {k: [*texts.get(k, []), *published().get(k, [])] for k in {**texts, **published()}})
    notices = known(spark, {k: [t for t in v if "\n" not in t] for k, v in texts.items()}).filter("digest is not null")
    lengths = sorted({n for v in texts.values() for t in v if "\n" not in t for n in _lengths(t)})
    none = F.array().cast("array<string>")
    of_length = F.filter(canonical_lines(F.col("text")), lambda x: F.length(x).isin(lengths)) if lengths else none
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", digest(F.col("text")).alias("digest"), F.coalesce(of_length, none).alias("lines")), "canonical")
    line = F.sha2(_equal_spellings(F.col("line")), 256).alias("digest")
    found = rows.filter(F.size("lines") > 0).select("row", F.explode("lines").alias("line")).select("row", line).join(F.broadcast(notices), "digest")
    per_row = found.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"), F.count(F.lit(1)).alias("n_notices"))
    joined = rows.drop("lines").join(F.broadcast(whole.filter("digest is not null")), "digest", "left").join(per_row, "row", "left")
    return joined.select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))


def _lengths(notice: str) -> set[int]:
    """Lengths that a line can have which is this notice but for its spellings."""
    out: set[str] = set()
    new = {" ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", notice.lower()))}
    pairs = [tuple(" ".join(x.split()) for x in pair) for pair in SPELLINGS]
    while new:
        out |= new
        new = {re.sub(rf"(?<![^ ]){x}(?![^ ])", y, w, count=1) for w in new for a, b in pairs for x, y in ((a, b), (b, a))} - out
    return {len(w) for w in out}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents."""
    return scan(table(spark, sf_dir, "documents"))


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '(?m)^[ \\t]*(copyright|\\(c\\)|©)[^\\n]*$', '', 'g')"
    out = f"' ' || replace(trim(regexp_replace({out}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' ', '  ') || ' '"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{_padded(a)}', '{_padded(b)}')"
    return f"trim(replace({out}, '  ', ' '))"


def _digest(text: str) -> str:
    words = _padded(_form("".join(c.lower() if c.isascii() else c for c in text)))
    for a, b in SPELLINGS:
        words = words.replace(_padded(a), _padded(b))
    return hashlib.sha256(" ".join(words.split()).encode()).hexdigest()


def sql() -> str:
    """DuckDB SQL for query(), which knows whole texts by their digests."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    lines = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, v in NOTICES.items() for t in v)
    digests: dict[str, str] = {}
    for k, v in [*NOTICES.items(), *((k, [t]) for k, t in TEXTS.items()), *published().items()]:
        for t in v:
            d = _digest(t)
            digests[d] = min(k, digests.get(d, k))
    values = ", ".join(f"('{k}', '{d}')" for d, k in digests.items())
    return f"""
WITH known(license, digest) AS (VALUES {values}),
notices AS (SELECT sha256({_sql_canonical('t')}) AS digest, min(k) AS license FROM (VALUES {lines}) v(k, t) GROUP BY 1),
canon AS (SELECT doc_id, text, row_number() OVER () AS rn, {_sql_canonical('text')} AS c FROM documents),
lines AS (SELECT rn, unnest(string_split(text, chr(10))) AS line FROM canon),
notes AS (SELECT l.rn, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices, count(*) AS n
          FROM (SELECT rn, sha256({_sql_canonical('line')}) AS digest FROM lines WHERE {_sql_canonical('line')} <> '') l JOIN notices k USING (digest) GROUP BY l.rn)
SELECT c.doc_id, CASE WHEN c.c <> '' THEN sha256(c.c) END AS digest, k.license, coalesce(n.notices, '') AS notices, coalesce(n.n, 0) AS n_notices
FROM canon c LEFT JOIN known k ON c.c <> '' AND k.digest = sha256(c.c) LEFT JOIN notes n ON n.rn = c.rn
"""
