"""Licence texts as they are usually laid out."""

import itertools
import random
import re._parser as parser
import time

from pyspark.sql import functions as F

from spark_elt.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2001, The Regents of the
University of Somewhere
All rights reserved
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above
   copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
{endorse}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL DAMAGES (INCLUDING SUBSTITUTE GOODS OR SERVICES; LOSS OF USE).
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission."""
GPL = """Copyright (C) 1999 Somebody
This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {n} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License along
with this program; if not, see <https://www.gnu.org/licenses/>.
"""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the notice stays.
"""
WRAPPED = [
    (MIT, "MIT", "MitName,Copyright,MitGrant,MitNotice,SoftAsIs,SoftNoLiability"),
    (BSD.format(endorse=""), "BSD-2-Clause", "Copyright,AllRights,BsdGrant,BsdSource,BsdBinary,BsdAsIs,BsdNoLiability"),
    (BSD.format(endorse=ENDORSE), "BSD-3-Clause", "Copyright,AllRights,BsdGrant,BsdSource,BsdBinary,BsdEndorse,BsdAsIs,BsdNoLiability"),
    (GPL.format(n=2), "GPL-2.0-or-later", "Copyright,Gpl2Later,GnuNoWarranty,GplDetails,GplCopy"),
    (GPL.format(n=3), "GPL-3.0-or-later", "Copyright,Gpl3Later,GnuNoWarranty,GplDetails,GplCopy"),
    (APACHE, "Apache-2.0", "Copyright,Apache2Grant,Apache2Comply,Apache2Copy,Apache2AsIs,Apache2Limits"),
    (ISC, "ISC", "IscGrant"),
]
LEADERS = ("", "# ", " * ", "// ", "dnl ", ";; ", "! ")


def found(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return [r for _, r in sorted((r.doc_id, r) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())]


def test_wrapped_texts(spark):
    cases = [(end.join(leader + x for x in t.split("\n")), name, ids) for leader in LEADERS for end in ("\n", "\r\n") for t, name, ids in WRAPPED]
    for r, (text, name, ids) in zip(found(spark, [t for t, _, _ in cases]), cases, strict=True):
        assert (r.licenses, r.sentence_ids, r.unknown) == (name, ids, False), text


def test_clauses_and_lines_still_count(spark):
    texts = ["Licensed under the MIT License; licensed under CC BY-SA 4.0", "Copyright 2020 X\nLicensed under the MIT License\nLicensed under CC BY 4.0", "CC BY 4.0\nCC BY-NC 4.0"]
    assert [r.licenses for r in found(spark, texts)] == ["MIT,CC-BY-SA", "MIT,CC-BY", "CC-BY-NC,CC-BY"]


TAGS = [
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT", "Spdx:MIT", False),
    ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", "GPL-2.0-only WITH Linux-syscall-note", "Spdx:GPL-2.0-only WITH Linux-syscall-note", False),
    ("# spdx-license-identifier: (mit OR apache-2.0) and BSD-3-Clause\n", "MIT,Apache-2.0,BSD-3-Clause", "Spdx:MIT,Spdx:Apache-2.0,Spdx:BSD-3-Clause", False),
    ("<!-- SPDX-License-Identifier : GPL-2.0+ -->", "GPL-2.0-or-later", "Spdx:GPL-2.0-or-later", False),
    ("This file: SPDX-License-Identifier: EUPL-1.2. Nothing more.", "EUPL-1.2", "Spdx:EUPL-1.2", False),
    ("SPDX-License-Identifier:GPL-3.0", "GPL-3.0-only", "Spdx:GPL-3.0-only", False),
    ("SPDX-License-Identifier: LicenseRef-Own", "", "SpdxTag", True),
    ("SPDX-License-Identifier: DocumentRef-a:LicenseRef-b", "", "SpdxTag", True),
    ("SPDX-License-Identifier:", "", "SpdxTag", True),
    ("# Copyright 2020 X\n# SPDX-License-Identifier: MIT\n# Licensed under the ISC license", "ISC,MIT", "Copyright,Spdx:MIT,IscRef", False),
    ("SPDX-License-Identifier: MIT see the file", "MIT", "Spdx:MIT", False),
]


def test_spdx_tags(spark):
    for r, (text, name, ids, unknown) in zip(found(spark, [x[0] for x in TAGS]), TAGS, strict=True):
        assert (r.licenses, r.sentence_ids, r.unknown, r.n_sentences) == (name, ids, unknown, ids.count(",") + 1), text


def expanded(parsed):
    """Every text a pattern stands for, with optional parts left out where they can be."""
    ways = []
    for op, value in parsed:
        if op is parser.LITERAL:
            ways.append([chr(value)])
        elif op is parser.BRANCH:
            ways.append([x for branch in value[1] for x in expanded(branch)])
        elif op is parser.SUBPATTERN:
            ways.append(expanded(value[-1]))
        elif op is parser.IN:
            ways.append([chr(v) if o is parser.LITERAL else "1" for o, v in value])
        elif op is parser.MAX_REPEAT:
            ways.append([""] if value[0] == 0 else [x * value[0] for x in expanded(value[2])])
        else:
            assert op is parser.ANY, op
            ways.append(["x"])
    return ["".join(x) for x in itertools.product(*ways)]


def test_every_alternative_has_a_hint():
    for name, pattern in licenses.SENTENCES:
        for text in expanded(parser.parse(pattern)):
            assert any(h in text for h in licenses.HINTS), (name, text)


def test_attribution_names(spark):
    texts = [
        "Attribution-NonCommercial-ShareAlike 4.0 International", "Attribution-NonCommercial-NoDerivatives 4.0 International",
        "Attribution-Non-Commercial-Share Alike 3.0", "Attribution-Non-Commercial-No Derivatives 3.0",
    ]
    assert [r.licenses for r in found(spark, texts)] == ["CC-BY-NC-SA", "CC-BY-NC-ND"] * 2


def test_every_alternative_has_a_key():
    for name, pattern in licenses.SENTENCES:
        for text in expanded(parser.parse(pattern)):
            assert any(k in text for k in licenses.keys(pattern)), (name, text)


def test_linear_forms_match_the_same(spark):
    rng = random.Random(3)
    parts = (
        "licensed under", "license under", "unlicensed under", "license", "terms", "termsx", "affero general public license", "gnu general public license",
        "version 3", "version 31", "either version 2", "either version 2any later version", "either version 3", "any later version", "x",
    )
    rows = [(" ".join(rng.choice(parts) for _ in range(rng.randint(2, 9))),) for _ in range(8000)]
    both = {n: (F.col("s").rlike(f"^(?:{dict(licenses.SENTENCES)[n]})$"), F.col("s").rlike(f"^(?:{p})$")) for n, p in licenses.LINEAR.items()}
    found = spark.createDataFrame(rows, "s string").select(
        *(F.count_if(a != b).alias(f"{n} differs") for n, (a, b) in both.items()), *(F.count_if(a).alias(n) for n, (a, _) in both.items())
    ).first().asDict()
    assert all(v == 0 if "differs" in n else 10 < v < 8000 for n, v in found.items()), found


def test_long_sentences_end(spark):
    """One sentence of 1 MB that begins a licence again and again, or is all marks (the square of its length before)."""
    texts = [x * (1_000_000 // len(x)) + "x" for x in ("licensed under the a ", "gnu general public license either version 2 ", "affero general public license ")]
    texts += [f"MIT License\n{mark * 1_000_000}x" for mark in ".;"]
    began = time.monotonic()
    assert [r.sentence_ids for r in found(spark, texts)] == ["", "GplAny", "", "MitName", "MitName"]
    assert time.monotonic() - began < 60


def test_marks_after_a_tag(spark):
    rows = [("SPDX-License-Identifier:. MIT",), ("SPDX-License-Identifier: MIT",), ("a.. b",), ("a..b",), ("a?!",), ("SPDX-License-Identifier\t:: MIT",)]
    cut = spark.createDataFrame(rows, "t string").select(licenses._sentences(F.col("t")).alias("s")).collect()
    assert [[x for x in r.s if x] for r in cut] == [
        ["SPDX-License-Identifier:", " MIT"], ["SPDX-License-Identifier: MIT"], ["a", " b"], ["a..b"], ["a"], ["SPDX-License-Identifier\t:", " MIT"],
    ]
