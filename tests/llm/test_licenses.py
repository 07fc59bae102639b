"""Licence scans against comparing every passage with every template in plain Python."""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt

from fixtures import prose, rows

from eventlake.llm import licenses

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
FILES = [
    ("LICENSE", MIT),
    ("a/x.txt", "plain words"),
    ("a/LICENSE.md", "some text\n" + GPL.upper() + "\nmore"),
    ("a/b/c/y.txt", None),
    ("a/b/c/z.txt", prose(1, 50) + ".\n" + "Licensed under CC BY-NC 4.0."),
    ("a/COPYING", MIT + " " + MIT),
    ("other/file", "The licence of a driver is not a licence for software at all, they said to the officer."),
    ("top", ""),
    (None, "words"),
    (None, MIT),
    ("a/x.txt", "plain words"),
]


def table(spark, data):
    return spark.createDataFrame([(i, *f, "x") for i, f in enumerate(data)], "id int, path string, text string, cue string")


def plain_best(texts, passage):
    words = lambda t: Counter(re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower()))
    wanted = {t for w in licenses.TEMPLATES.values() for x in w for t in words(x)}
    idf = lambda t: log((1 + len(texts)) / (1 + sum(t in words(x or "") for x in texts) * (t in wanted))) + 1
    vector = lambda t: {w: n * idf(w) for w, n in words(t).items()}
    length = lambda v: sqrt(sum(x * x for x in v.values()))
    mine = vector(passage)
    scored = []
    for name, wordings in licenses.TEMPLATES.items():
        for other in map(vector, wordings):
            dot = sum(x * other.get(w, 0) for w, x in mine.items())
            scored.append((dot / (length(mine) * length(other)), name))
    return max(scored)


def test_cosines_are_those_of_plain_python(spark):
    texts = [text for _, text in FILES]
    counts, docs = licenses.document_counts(table(spark, FILES), "text", licenses.TEMPLATES)
    matcher = licenses.Matcher(licenses.TEMPLATES, counts, docs)
    assert docs == len(FILES)
    for passage in (MIT, GPL, "Licensed under CC BY-NC 4.0.", "under the licence of a license", FILES[6][1]):
        cosine, name = matcher.best(licenses.terms(passage.encode()))
        expected, wanted = plain_best(texts, passage)
        assert (round(cosine, 9), name) == (round(expected, 9), wanted)


def test_scan_and_inheritance(spark):
    found = {r["id"]: (r["licence"], r["inherited_from"]) for r in licenses.scan(table(spark, FILES)).collect()}
    assert found == {
        0: ("MIT", None),
        1: ("GPL-3.0", "a"),
        2: ("GPL-3.0", None),
        3: ("GPL-3.0", "a"),
        4: ("CC-BY-NC-4.0", None),
        5: ("MIT", None),
        6: ("MIT", ""),
        7: ("MIT", ""),
        8: (None, None),
        9: ("MIT", None),
        10: ("GPL-3.0", "a"),
    }


def test_whole_texts_and_several_licences(spark):
    text = prose(2, 20_000) + ".\n" + MIT + "\n" + prose(3, 20_000) + ".\n" + GPL
    (found,) = licenses.own_licences(table(spark, [("p", text)])).collect()
    assert [x["licence"] for x in found["licences"]] == ["GPL-3.0", "MIT"]


def test_empty_table(spark):
    assert rows(licenses.scan(table(spark, []))) == []


GNU = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the {1} as published by
the Free Software Foundation{2} either version {3} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{1} for more details.

You should have received a copy of the {1}
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
HEADERS = {
    "GPL-2.0": GNU.format(";", "GNU General Public License", ";", "2"),
    "GPL-3.0": GNU.format(":", "GNU General Public License", ",", "3"),
    "LGPL-2.1": GNU.format(";", "GNU Lesser General Public License", ";", "2.1"),
    "LGPL-3.0": GNU.format(":", "GNU Lesser General Public License", ",", "3"),
    "AGPL-3.0": GNU.format(":", "GNU Affero General Public License", ",", "3"),
    "BSD-2-Clause": BSD,
    "BSD-3-Clause": BSD
    + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def test_each_header_is_its_own_licence_and_no_neighbours(spark):
    """As they stand in files: wrapped, commented, with other text around."""
    data = []
    for text in HEADERS.values():
        commented = "\n".join("# " + line for line in text.splitlines())
        data += [("a", text), ("b", f"/* Copyright 2020 Somebody\n{text}\n*/\n{prose(4, 300)}"), ("c", prose(5, 80) + ".\n" + commented)]
    data += [("d", prose(i, 60)) for i in range(30)]
    found = sorted(licenses.own_licences(table(spark, data)).collect(), key=lambda r: r["id"])
    for i, name in enumerate(n for n in HEADERS for _ in range(3)):
        assert [x["licence"] for x in found[i]["licences"]][:1] == [name], (name, found[i]["licences"])
        assert {x["licence"] for x in found[i]["licences"]} == {name}, (name, found[i]["licences"])


def test_identifiers(spark):
    names = list(licenses.TEMPLATES)
    forms = [(n, f"// SPDX-License-Identifier: {n}\nint main;") for n in names]
    forms += [("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0-only"), ("LGPL-2.1", "spdx-license-identifier:LGPL-2.1+ ")]
    forms += [("AGPL-3.0", "x\n * SPDX-License-Identifier:\tAGPL-3.0-or-later\n */"), (None, "SPDX-License-Identifier: Unheard-Of")]
    found = sorted(licenses.own_licences(table(spark, [("p", t) for _, t in forms])).collect(), key=lambda r: r["id"])
    for (name, text), row in zip(forms, found):
        assert [x["licence"] for x in row["licences"]] == ([name] if name else []), text


def test_passages_are_those_of_trying_all(spark):
    """Growing passages piece by piece gives the cosines of taking each one whole."""
    matcher = licenses.Matcher(licenses.TEMPLATES, {"license": 3, "the": 9}, 10)
    pieces = [licenses.terms(line.encode()) for line in HEADERS["GPL-3.0"].splitlines()]
    for first in range(len(pieces)):
        for last, cosine, name in matcher.growing(pieces, first):
            whole = matcher.best([w for piece in pieces[first : last + 1] for w in piece])
            if whole:
                assert (round(cosine, 9), name) == (round(whole[0], 9), whole[1])
            else:
                assert cosine == 0


def test_inheritance_over_random_trees(spark):
    import random

    rng = random.Random(6)
    notices = {"MIT": MIT, "GPL-3.0": GPL, "ISC": "Licensed under the ISC License."}
    files = []
    for i in range(150):
        folder = [rng.choice("abc") for _ in range(rng.randrange(4))]
        name = rng.choice(["LICENSE", "COPYING.txt", f"f{i}.c", f"g{i}.c"])
        files.append(("/".join([*folder, name]), rng.choice([*notices.values(), "nothing here", None])))
    files += files[:20] + [(None, None), (None, "words")]
    owned = [next((n for n, t in notices.items() if t == text), None) for _, text in files]
    given = {}
    for (path, _), name in zip(files, owned):
        if path and name and path.rpartition("/")[2] in ("LICENSE", "COPYING.txt"):
            given.setdefault(path.rpartition("/")[0], []).append(name)
    found = {r["id"]: (r["licence"], r["inherited_from"]) for r in licenses.scan(table(spark, files)).collect()}
    for i, ((path, _), name) in enumerate(zip(files, owned)):
        if name or path is None:
            assert found[i] == (name, None)
            continue
        folder = path.rpartition("/")[0]
        while folder not in given and folder:
            folder = folder.rpartition("/")[0]
        # Several files of one directory match about equally well; one of them counts.
        licence, holder = found[i]
        assert holder == (folder if folder in given else None)
        assert licence in given.get(folder, [None])
