"""Whole texts and file notices of the licences that the one-line notices name."""

from tidemart.llm import license_scan

BSD = """Copyright (c) 2016-present, Somebody, Inc. All rights reserved.

Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

 * Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

 * Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """
 * Neither the name of the copyright holder nor the names of its contributors may
   be used to endorse or promote products derived from this software without
   specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {0} as published by
the Free Software Foundation, either version {1} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {0} for more details.

You should have received a copy of the GNU {0}
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""


def test_texts_of_the_named_licences(spark):
    cases = [("BSD-2-Clause", BSD.format("")), ("BSD-3-Clause", BSD.format(THIRD)), ("MPL-2.0", MPL),
             ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD.format("").replace(" * Re", "1. Re", 1).replace(" * Re", "2. Re", 1)),
             ("GPL-3.0", GPL.format("General Public License", 3)), ("AGPL-3.0", GPL.format("Affero General Public License", 3))]
    for name, text in license_scan._published():
        cases.append((name, "\n".join(text.upper().splitlines()) + "\n"))
    apache = next(t for n, t in license_scan._published() if n == "Apache-2.0")
    cases.append(("Apache-2.0", "Copyright 2020 X\n\n" + apache[apache.index("   Licensed under the Apache License, V"):]))
    assert {n for n, _ in cases} >= {"BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
                                     "LGPL-3.0", "MPL-2.0", "Unlicense", "CC0-1.0"}
    cases.append((None, BSD.format("").replace("source code", "the source")))
    table = spark.createDataFrame(list(enumerate(t for _, t in cases)), "doc_id long, text string")
    got = {r.doc_id: r.license for r in license_scan.scan(table).collect()}
    assert [got[i] for i in range(len(cases))] == [n for n, _ in cases]


def test_no_exchange_where_known_digests_are_broadcast_and_the_same_rows_beyond(spark, monkeypatch):
    table = spark.createDataFrame([(1, license_scan.MIT), (1, license_scan.MIT), (2, "Released under the MIT Licence!\n" * 50),
                                   (None, "q\nReleased under the MIT licence\nz"), (3, None), (4, "")], "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([("A", "released under the MIT license"), ("0", "Released under the MIT licence."), (None, "q"),
                                   ("M", license_scan.MIT), ("E", "")], "name string, text string")
    narrow = license_scan.scan(table, known)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    rows = sorted(map(str, narrow.collect()))
    monkeypatch.setattr(license_scan, "MAX_KNOWN", 1)
    wide = license_scan.scan(table, known)
    assert wide.columns == narrow.columns and sorted(map(str, wide.collect())) == rows
    got = {r.doc_id: (r.license, r.n_notices, r.notices) for r in wide.collect()}
    assert got == {1: ("M", 0, ""), 2: (None, 50, "0"), None: (None, 1, "0"), 3: (None, 0, ""), 4: (None, 0, "")}
