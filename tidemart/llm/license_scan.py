"""License scan: canonical digests of entire texts, hash-joined to known licences.

A text is normalised line by line: A-Z lower-cased, only runs of ASCII letters, digits and
non-ASCII characters kept, equivalent spellings mapped to one, copyright lines (the word,
``(c)`` or the sign at the beginning, and a year or another of them) dropped.  Its digest is the SHA-256
of the words that are left.  A document is joined to the known licences as a whole, and each
of its lines as a notice of its own.

Up to ``MAX_KNOWN`` known digests (the library has a few hundred) are counted and broadcast:
lines are looked up where they are read, so that a row per document leaves a task and nothing
is shuffled.  More are joined by a shuffle of all digests, in which the rows of one digest go
to ``SALTS`` places.

Edge cases: NULL or empty texts, and texts of copyright lines alone, have the digest of
nothing and match nothing; repeated rows are scanned each; texts of any length are read
whole; known texts that normalise alike are one digest with the first name; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import read
from .words import slices

# fixed values: equivalent spellings of published licence matching guidelines
SPELLINGS = {
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments", "analogue": "analog",
    "analyse": "analyze", "artefact": "artifact", "artefacts": "artifacts", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor",
    "licence": "license", "licenced": "licensed", "licences": "licenses", "licencing": "licensing",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

{}Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
{}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {} BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_NAMES = """{}Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""
#: who is named in the third condition, and who disclaims and is not liable
BSD_OWNERS = ("the copyright holder", "the copyright holders", "the copyright owner", "the author", "the University")
BSD_PARTIES = (("the copyright holders and contributors", "the copyright holder or contributors"),
               ("the copyright holders and contributors", "the copyright owner or contributors"),
               ("the copyright holders and contributors", "the copyright holders or contributors"),
               ("the copyright holder and contributors", "the copyright holder or contributors"),
               ("the author and contributors", "the author or contributors"), ("the author", "the author"),
               ("the regents and contributors", "the regents or contributors"))
_GNU = """This {what} is free software{sign} you can redistribute it and/or modify it under the terms of the GNU {gpl} as
published by the Free Software Foundation{either} version {v} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {gpl} for more details.

You should have received a copy of the GNU {gpl} along with this {what}{end}"""
_WRITE = "; if not, write to the Free Software Foundation, Inc., "
#: endings of the notices of the GNU licences
GNU_ENDS = (". If not, see <https://www.gnu.org/licenses/>.", ". If not, see <http://www.gnu.org/licenses/>.",
            _WRITE + "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
            _WRITE + "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA.",
            _WRITE + "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA")
GNU_NOTICES = (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
               ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
               ("AGPL-3.0", "Affero General Public License", "3"))
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

{}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/."""
#: licences whose full text is a file of the folder ``licenses``, as their publishers have it
FILES = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense")
_END = "END OF TERMS AND CONDITIONS"
#: (identifier, name) of licences whose usual one-line notices are known
NOTICES = (("MIT", "MIT License"), ("Apache-2.0", "Apache License, Version 2.0"), ("ISC", "ISC License"),
           ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
           ("GPL-2.0", "GNU General Public License, version 2"), ("GPL-3.0", "GNU General Public License, version 3"),
           ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
           ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
           ("AGPL-3.0", "GNU Affero General Public License, version 3"), ("MPL-2.0", "Mozilla Public License, Version 2.0"),
           ("Unlicense", "Unlicense"), ("CC0-1.0", "CC0 1.0"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
           ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("CC-BY-ND-4.0", "CC BY-ND 4.0"), ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
           ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"))
SAYINGS = ("Released under {}.", "Licensed under {}.", "This work is licensed under {}.",
           "This software is licensed under {}.", "Distributed under {}.", "Published under {}.")
MAX_KNOWN = 1 << 18  # known digests that are broadcast
SALTS = 16           # places of one digest where more are joined
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_COPYRIGHT = re.compile(r"[ \t]*(?:copyright|©|\(c\)).*?(?:[^0-9](?:19|20)[0-9]{2}(?:[^0-9]|$)|©|\(c\))", re.S)
_LOWER = {i: i + 32 for i in range(65, 91)}


def known_licenses() -> list[tuple[str, str]]:
    """(name, text) of full licences and of the usual notices of NOTICES, by rule."""
    out = [("MIT", MIT), ("MIT", f"MIT License\n\n{MIT}"), ("ISC", ISC), ("ISC", f"ISC License\n\n{ISC}")]
    out += _bsd() + _published() + _file_notices()
    for name, title in NOTICES:
        out += [(name, s.format(article + title)) for s in SAYINGS for article in ("", "the ", "a ")]
    return out


def _bsd() -> list[tuple[str, str]]:
    """Both BSD licences, with and without numbers, a title and the usual line below the copyright line."""
    out = []
    for disclaimer in BSD_PARTIES:
        for one, two, three in (("1. ", "2. ", "3. "), ("", "", "")):
            kinds = [("2", "Simplified", "")] + [("3", x, BSD_NAMES.format(three, owner)) for owner in BSD_OWNERS
                                                for x in ("New", "Revised")]
            for n, other, names in kinds:
                text = BSD.format(one, two, names, *disclaimer)
                out += [(f"BSD-{n}-Clause", head + rights + text) for rights in ("", "All rights reserved.\n\n")
                        for head in ("", f"BSD {n}-Clause License\n\n", "BSD License\n\n", f"The BSD {n}-Clause License\n\n",
                                     f'BSD {n}-Clause "{other}" License\n\n')]
    return out


def _published() -> list[tuple[str, str]]:
    """The texts of FILES, and those with terms that end before instructions without these."""
    out = []
    for name in FILES:
        text = resources.files(__package__).joinpath("licenses", f"{name}.txt").read_text("utf-8")
        out.append((name, text))
        terms, end, _ = text.partition(_END)
        out += [(name, terms), (name, terms + end)] if end else []
    text = out[-1][1]
    return out + [("Unlicense", text.replace("http://", "https://")), ("Unlicense", text[: text.index("For more information")])]


def _file_notices() -> list[tuple[str, str]]:
    """Notices of several lines that stand at the head of files."""
    out = [(name, text.format(scheme)) for name, text in (("Apache-2.0", APACHE_NOTICE), ("MPL-2.0", MPL_NOTICE))
           for scheme in ("http", "https")]
    for name, gpl, v in GNU_NOTICES:
        out += [(name, _GNU.format(what=what, sign=sign, gpl=gpl, either=either, v=v, end=end)) for end in GNU_ENDS
                for what in ("program", "library", "software", "file") for sign in (":", ";") for either in ("; either", ", either")]
    return out


def normal_line(line: str) -> str:
    line = line.translate(_LOWER)
    if _COPYRIGHT.match(line):
        return ""
    return " ".join([SPELLINGS.get(w, w) for w in _WORDS.findall(line)])


def digest(normal: str) -> bytes:
    return hashlib.sha256(normal.encode()).digest()


def normal_text(text: str | None) -> str:
    return " ".join(x for x in map(normal_line, (text or "").split("\n")) if x)


def _normal_units(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A text as a whole, and (number, normalised line) of each line with words."""
    lines = [(i, x) for i, x in enumerate(map(normal_line, (text or "").split("\n"))) if x]
    return " ".join(x for _, x in lines), lines


def _units(batches):
    """Rows (row, doc_id, line, digest): a text as a whole (line -1), and each line with words."""
    for batch in batches:
        for part in slices(batch, "text"):
            out = {"row": [], "doc_id": [], "line": [], "digest": []}
            for row, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                whole, lines = _normal_units(text)
                out["row"] += [row] * (len(lines) + 1)
                out["doc_id"] += [doc_id] * (len(lines) + 1)
                out["line"] += [-1, *(i for i, _ in lines)]
                out["digest"] += [digest(whole), *(digest(x) for _, x in lines)]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("row", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32()), ("digest", pa.binary())]))


def _found(shared):
    """Rows (doc_id, digest, n_notices, notices): a text as a whole, and the known ones among its lines."""
    def run(batches):
        names = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                digests, counts, notices = [], [], []
                for text in part.column("text").to_pylist():
                    whole, lines = _normal_units(text)
                    known = [n for n in (names.get(digest(x)) for _, x in lines) if n is not None]
                    digests.append(digest(whole))
                    counts.append(len(known))
                    notices.append(",".join(sorted(set(known), key=str.encode)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()),
                     pa.array(notices, pa.string())], names=["doc_id", "digest", "n_notices", "notices"])
    return run


def known_digests(known: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """(digest, license): first name of each distinct normalised text that is not empty."""
    return (known.select(F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("doc_id"),
                         F.col(text).alias("text"), F.col(name).alias("name"))
            .mapInArrow(_named, "name string, digest binary")
            .groupBy("digest").agg(F.min("name").alias("license")))


def _named(batches):
    for batch in batches:
        rows = [(n, normal_text(t)) for n, t in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist())]
        rows = [(n, digest(t)) for n, t in rows if t]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.string()),
                                          pa.array([d for _, d in rows], pa.binary())], names=["name", "digest"])


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
         name: str = "name", known_text: str = "text") -> DataFrame:
    """doc_id, digest, license (of the whole text), n_notices and notices (of single lines) of every row."""
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(known_licenses(), "name string, text string")
        name, known_text = "name", "text"
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = known_digests(known, name, known_text)
    few = names.limit(MAX_KNOWN + 1).toArrow()
    if few.num_rows > MAX_KNOWN:
        return _scan_joined(texts, names)
    shared = spark.sparkContext.broadcast(dict(zip(few.column("digest").to_pylist(), few.column("license").to_pylist())))
    found = texts.mapInArrow(_found(shared), "doc_id long, digest binary, n_notices long, notices string")
    return (found.join(F.broadcast(spark.createDataFrame(few, names.schema)), "digest", "left")
            .select("doc_id", F.lower(F.hex("digest")).alias("digest"), "license", "n_notices", "notices"))


def _scan_joined(texts: DataFrame, names: DataFrame) -> DataFrame:
    """The rows of ``scan`` where the known digests are too many for a broadcast."""
    units = (texts.withColumn("row", F.monotonically_increasing_id())
             .mapInArrow(_units, "row long, doc_id long, line int, digest binary")
             .withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")))
    dealt = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = units.join(dealt, ["digest", "salt"], "left")
    whole = F.col("line") == -1
    return (found.groupBy("row", "doc_id")
            .agg(F.max(F.when(whole, F.lower(F.hex("digest")))).alias("digest"),
                 F.max(F.when(whole, F.col("license"))).alias("license"),
                 F.count(F.when(~whole, F.col("license"))).alias("n_notices"),
                 F.concat_ws(",", F.array_sort(F.collect_set(F.when(~whole, F.col("license"))))).alias("notices"))
            .drop("row"))


def query(spark, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def _sql() -> str:
    known: dict[str, str] = {}
    for name, text in known_licenses():
        if normal := normal_text(text):
            key = digest(normal).hex()
            known[key] = min(name, known.get(key, name))
    values = ", ".join(f"('{k}', '{v}')" for k, v in known.items())
    spelling = ", ".join(f"'{k}': '{v}'" for k, v in SPELLINGS.items())
    return rf"""
WITH known(digest, license) AS (VALUES {values}),
ln AS (
  SELECT doc_id, i, translate(list_extract(l, i), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
norm AS (
  SELECT doc_id, i,
    CASE WHEN regexp_matches(line, '^[ \t]*(copyright|©|\(c\))(?s:.*?)([^0-9](19|20)[0-9]{{2}}([^0-9]|$)|©|\(c\))') THEN ''
    ELSE array_to_string(list_transform(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
         lambda w: coalesce(map_extract_value(MAP {{{spelling}}}, w), w)), ' ') END AS s
  FROM ln),
whole AS (SELECT doc_id, coalesce(string_agg(s, ' ' ORDER BY i) FILTER (s <> ''), '') AS s FROM norm GROUP BY doc_id),
notice AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM norm JOIN known ON sha256(norm.s) = known.digest WHERE norm.s <> '' GROUP BY doc_id)
SELECT whole.doc_id, sha256(whole.s) AS digest, known.license AS license,
       CAST(coalesce(n_notices, 0) AS BIGINT) AS n_notices, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON sha256(whole.s) = known.digest LEFT JOIN notice ON whole.doc_id = notice.doc_id
"""


SQL = _sql()
