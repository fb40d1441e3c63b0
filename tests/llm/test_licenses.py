import os
import random
import re

from corpusflow.llm.licenses import TEMPLATES, license_scan

WORD = re.compile(r"[^\W_]+")


def grams(text):
    own = WORD.findall(text.lower())
    return set(zip(own, own[1:], strict=False))


def brute(docs, threshold):
    known = [(n, i, grams(t)) for n, texts in TEMPLATES.items() for i, t in enumerate(texts)]
    out = set()
    for d, text in docs:
        lines = (text or "").split("\n")
        for at, unit in ([(-1, text)] if len(lines) > 1 else []) + list(enumerate(lines)):
            own = grams(unit)
            best = max(((2 * len(own & g) / (len(own) + len(g)), n, i) for n, i, g in known if own), default=(0,))
            if best[0] >= threshold:
                out.add((d, at, best[1], best[2], round(best[0], 12)))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(4)
    docs = [(0, None), (1, ""), (2, "\n\n"), (3, "one"), (4, "mit\nlicense"), (5, "word " * 300_000), (6, "a b " * 200_000)]
    every = [t for texts in TEMPLATES.values() for t in texts]
    for i in range(10, 150):
        own = rnd.choice(every).split()
        for _ in range(rnd.randrange(len(own) // 6 + 1)):
            own[rnd.randrange(len(own))] = rnd.choice(["foo", "THE", "Bär", "x-y"])
        text = " ".join(own)
        if rnd.random() < 0.4:
            text = "some prose before\n" + text + rnd.choice(["", "\nmore", "\n\n"])
        elif rnd.random() < 0.3:
            text = text.replace(" the ", "\nthe\n").upper()
        docs.append((i, text))
    for threshold in (0.8, 0.55):
        rows = license_scan(spark.createDataFrame(docs, "doc_id long, text string"), threshold).collect()
        got = {(r.doc_id, r.line, r.license, r.template, round(r.dice, 12)) for r in rows}
        assert len(got) == len(rows) and got == brute(docs, threshold)


def test_edges_of_the_input(spark):
    schema = "line string, doc_id long, text string, n int, license string, grams string"
    assert license_scan(spark.createDataFrame([], schema)).collect() == []
    text = TEMPLATES["MIT"][0]
    df = spark.createDataFrame([("x", 1, text, 1, "l", "g"), ("x", 1, text, 1, "l", "g"), (None, None, text, None, None, None)], schema)
    got = sorted(map(str, license_scan(df).collect()))
    assert len(got) == 2
    assert license_scan(df, templates={}).collect() == []


def test_no_python_on_the_main_path(spark):
    plan = license_scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))


# Published texts, written apart from TEMPLATES, with a copyright line and wrapped as in the files.
BSD_2 = """BSD 2-Clause License

Copyright (c) 2019, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
ISC = """ISC License

Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")
Copyright (c) 1995-2003 by Internet Software Consortium

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND ISC DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL ISC BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>
"""


def test_full_licence_texts_as_published(spark):
    docs = [(1, BSD_2), (2, BSD_2.replace("THIS SOFTWARE IS PROVIDED", THIRD + "THIS SOFTWARE IS PROVIDED").replace("2-Clause", "3-Clause")),
            (3, ISC), (4, UNLICENSE)]
    published = "/usr/share/common-licenses/CC0-1.0"
    if os.path.exists(published):
        with open(published) as f:
            docs.append((5, f.read()))
    rows = license_scan(spark.createDataFrame(docs, "doc_id long, text string")).filter("line = -1").collect()
    want = {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "ISC", 4: "Unlicense", 5: "CC0-1.0"}
    assert {r.doc_id: r.license for r in rows} == {d: want[d] for d, _ in docs}
    assert all(r.dice > 0.85 for r in rows)


APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def test_notices_wrapped_inside_longer_documents(spark):
    code = "\n".join(f"def f{i}(x{i}): return x{i} * {i} + g{i}(x{i})" for i in range(200)) + "\n"
    mit = BSD_2.split("\n", 4)[4]
    docs = [(1, "# coding\n" + APACHE + "\n" + code), (2, "/*\n" + GPL + " */\n" + code), (3, code + "\n" + ISC + "\n" + code),
            (4, code + APACHE + code + UNLICENSE), (5, code + mit + "\n\n" + APACHE + code), (6, BSD_2 + "\nParts are\n" + APACHE),
            (7, code + "Licensed under\nCC BY 4.0.\n" + code), (8, code), (9, BSD_2), (10, code + "\r\n".join(APACHE.split("\n")))]
    df = spark.createDataFrame([*docs, (None, docs[0][1]), (1, docs[0][1])], "doc_id long, text string")
    got = {}
    for r in license_scan(df).collect():
        got.setdefault(r.doc_id, []).append((r.line, r.license, r.dice > 0.9))
    at = {d: text.split("\n") for d, text in docs}

    def line(d, begin, nth=0):
        return [i for i, x in enumerate(at[d]) if x.strip(" #*").startswith(begin)][nth]

    apache, gpl = "Licensed under the Apache", "This program is free"
    assert sorted(got[1]) == [(1, "Apache-2.0", True)] == sorted(got[None])
    assert sorted(got[2]) == [(1, "GPL-3.0", True)]
    assert [(x, ok) for _, x, ok in got[3]] == [("ISC", True)]
    assert {(line(4, apache), "Apache-2.0", True)} <= set(got[4]) and {x for _, x, _ in got[4]} == {"Apache-2.0", "Unlicense"}
    assert sorted(x for _, x, _ in got[5]) == ["Apache-2.0", "BSD-2-Clause"]
    assert {x for _, x, _ in got[6]} == {"Apache-2.0", "BSD-2-Clause"}
    assert got[7] == [(line(7, "Licensed under"), "CC-BY-4.0", True)]
    assert 8 not in got and got[9] == [(-1, "BSD-2-Clause", True)]
    assert got[10] == [(200, "Apache-2.0", True)]
    assert line(2, gpl) == 1
