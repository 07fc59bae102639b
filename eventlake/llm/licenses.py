"""Licence scans: TF-IDF cosine of passages to templates, then inheritance along directories."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import Shipped, byte_blocks, map_batches, map_blocks, materialised

_GNU = (
    "This program is free software{0} you can redistribute it and/or modify it under the terms of the {1} as published "
    "by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version."
)
_GNU_MORE = (
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_CC = "licensed under a Creative Commons {} 4.0 International License."


def _gnu(name: str, version: str, title: str) -> tuple[str, ...]:
    """Notices of a GNU licence: the standard header alone and in full, a short form, and the head of its text."""
    marks = (";", name, ";", version) if version.startswith("2") else (":", name, ",", version)
    header = _GNU.format(*marks)
    short = f"This work is licensed under the {name}, version {version}."
    return short, header, header + _GNU_MORE.format(*marks), f"{name} Version {title}"


# Licences by SPDX name and wordings of their notices.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "GPL-2.0": _gnu("GNU General Public License", "2", "2, June 1991"),
    "GPL-3.0": _gnu("GNU General Public License", "3", "3, 29 June 2007"),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1", "2.1, February 1999"),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "3, 29 June 2007"),
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", "3, 19 November 2007"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", _BSD_TWO),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met.",
        _BSD_TWO + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Eclipse Public License - v 2.0",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work under CC0 1.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "Licensed under a Creative Commons Attribution 4.0 License.",
        "This work is " + _CC.format("Attribution"),
    ),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is " + _CC.format("Attribution-ShareAlike")),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 License.",
        "This work is " + _CC.format("Attribution-NonCommercial"),
    ),
}
#: What may follow a licence's name in an SPDX identifier.
SPDX_FORMS = ("", "-only", "-or-later", "+")
#: A passage is looked at if it holds one of these, in any case.
CUES = "licen[cs]e|permission|redistribut|free software|copyright"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
THRESHOLD = 0.75
#: A passage has at most so many times the terms of the longest template; a cosine near the threshold needs fewer.
LONGEST = 2
_TERM = re.compile(rb"[a-z0-9]+(?:[.-][a-z0-9]+)*\+?")
_END = re.compile(rb"[\r\n]+|(?<=[.;:!?])[ \t]+")
_CUE = re.compile(CUES.encode())
_SPDX = re.compile(rb"spdx-license-identifier:[ \t]*")


def _plain(text: bytes) -> bytes:
    """In lower case; an SPDX tag and the name it gives become one term."""
    return _SPDX.sub(b"spdx-license-identifier-", text.lower())


def terms(text: bytes) -> list[bytes]:
    return _TERM.findall(_plain(text))


def _wordings(templates: Mapping[str, Iterable[str]]) -> list[tuple[str, bytes]]:
    """(licence, wording) of every template, SPDX identifiers included."""
    found = [(name, wording.encode()) for name, wordings in templates.items() for wording in wordings]
    return found + [(n, f"SPDX-License-Identifier: {n}{form}".encode()) for n in templates for form in SPDX_FORMS]


class Matcher:
    """Cosines of passages to the templates; terms of no template weigh as never seen."""

    def __init__(self, templates: Mapping[str, Iterable[str]], found: Mapping[str, int], docs: int):
        self.unseen = log(1 + docs) + 1
        self.weights = {t.encode(): log((1 + docs) / (1 + n)) + 1 for t, n in found.items()}
        self.names, lengths, sizes = [], [], []
        #: Of each term, the templates that hold it, with its value there over the template's length.
        self.holding: dict[bytes, list[tuple[int, float]]] = {}
        for name, wording in _wordings(templates):
            words = Counter(terms(wording))
            vector = {t: n * self._weight(t) for t, n in words.items()}
            lengths.append(sqrt(sum(v * v for v in vector.values())))
            sizes.append(words.total())
            for term, value in vector.items():
                self.holding.setdefault(term, []).append((len(self.names), value / lengths[-1]))
            self.names.append(name)
        self.limit = LONGEST * max(sizes, default=0)

    def _weight(self, term: bytes) -> float:
        return self.weights.get(term, self.unseen)

    def best(self, words: list[bytes]) -> tuple[float, str] | None:
        """Highest cosine and its licence, ties to the smaller name."""
        *_, last = self.growing([words], 0)
        return last[1:] if last[1] else None

    def growing(self, pieces: list[list[bytes]], first: int) -> Iterator[tuple[int, float, str]]:
        """(last, cosine, licence) of the passages that begin with piece ``first``; a single piece is one at any length."""
        dots, counts, squared, size = [0.0] * len(self.names), Counter(), 0.0, 0
        for last in range(first, len(pieces)):
            size += len(pieces[last])
            if last > first and size > self.limit:
                break
            for term in pieces[last]:
                weight = self._weight(term)
                squared += weight * weight * (2 * counts[term] + 1)
                counts[term] += 1
                for i, value in self.holding.get(term, ()):
                    dots[i] += weight * value
            top = max(dots, default=0.0)
            name = min((self.names[i] for i, d in enumerate(dots) if d > top * (1 - 1e-12)), default="") if top else ""
            yield last, top / sqrt(squared) if squared else 0.0, name

    def licences(self, text: bytes | None, threshold: float) -> list[tuple[str, float]]:
        """Licences of a whole text with their best cosines, the best first.

        Of passages that overlap the best counts, of about equal ones the longest: a part of one
        licence's notice can be the whole of another's.
        """
        raw = _END.split(_plain(text or b""))
        cued = [i for i, piece in enumerate(raw) if _CUE.search(piece)]
        pieces = [_TERM.findall(piece) for piece in raw] if cued else []
        seen, near = [], 0
        for first in range(len(pieces)):
            while near < len(cued) and cued[near] < first:
                near += 1
            if near == len(cued):
                break
            # Pieces between a passage's beginning and its first cue must fit into it.
            if cued[near] > first and sum(map(len, pieces[first : cued[near] + 1])) > self.limit:
                continue
            for last, cosine, name in self.growing(pieces, first) if pieces[first] else ():
                if last >= cued[near] and cosine >= threshold:
                    seen.append((-round(cosine, 2), first - last, -cosine, name, first, last))
        found: dict[str, float] = {}
        taken: list[tuple[int, int]] = []
        for _, _, cosine, name, first, last in sorted(seen):
            if all(last < a or first > b for a, b in taken):
                taken.append((first, last))
                found[name] = max(found.get(name, 0.0), -cosine)
        return sorted(found.items(), key=lambda x: (-round(x[1], 12), x[0]))


def document_counts(files: DataFrame, text: str, templates: Mapping[str, Iterable[str]]) -> tuple[dict[str, int], int]:
    """In how many of all texts each template term occurs, and how many texts there are.

    A task returns one row for each such term, so what comes to the driver has a fixed size.
    """
    wanted = {t for _, wording in _wordings(templates) for t in terms(wording)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for block in byte_blocks(batch, 0):
                for raw in block.column(0).cast(pa.large_binary()).to_pylist():
                    seen[b""] += 1
                    seen.update(wanted.intersection(terms(raw or b"")))
        rows = [pa.array([t.decode() for t in seen]), pa.array(seen.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, names=["term", "n"])

    counted = map_batches(files.select(text), count, "term string, n bigint")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"))
    found = {row["term"]: row["n"] for row in counted.collect()}
    docs = found.pop("", 0)
    return {t.decode(): found.get(t.decode(), 0) for t in wanted}, docs


def own_licences(
    files: DataFrame,
    text: str = "text",
    templates: Mapping[str, Iterable[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All columns of ``files`` but the text, and ``licences`` (name, cosine) of each whole text, best first.

    A passage, that is sentences or lines that follow each other and hold a cue, of up to ``LONGEST`` times the terms of
    the longest template, is a licence's if its best cosine reaches the threshold. Term weights come from
    all texts. Null and empty texts have no licence, long ones are read whole, repeated rows come back as often as they
    come. ``files`` must not have a column of this name; others stay.
    """
    shared = Shipped(files.sparkSession, Matcher(templates, *document_counts(files, text, templates)))
    kind = pa.list_(pa.struct([("licence", pa.string()), ("cosine", pa.float64())]))

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        found = [shared.value.licences(t, threshold) if t else [] for t in texts]
        return {"licences": pa.array([[{"licence": n, "cosine": c} for n, c in f] for f in found], kind)}

    cued = F.when(F.lower(text).rlike(CUES), F.col(text))
    added = "licences array<struct<licence:string,cosine:double>>"
    return map_blocks(files.withColumn(text, cued), text, run, added).drop(text)


def _parent(path: Column) -> Column:
    """Directory of a path; null has none."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Mapping[str, Iterable[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All columns of ``files`` but the text, ``licences``, ``licence``, ``cosine`` and ``inherited_from``.

    A file's licence is its own best one. Without one it has that of the nearest directory, its
    own or one above, that holds a licence file in which a licence was found; of several such
    files the best match counts, ties to the smaller licence. ``inherited_from`` is the directory, the
    empty string at the top, null for own licences. Files with a null path inherit nothing.
    Directories, not files, are joined to their ancestors: one row per level of a path.
    """
    own = materialised(own_licences(files, text, templates, threshold))
    own = own.withColumn("_dir", _parent(F.col(path)))
    named = F.regexp_extract(F.col(path), "([^/]*)$", 1).rlike(LICENCE_FILE) & (F.size("licences") > 0)
    first = F.element_at("licences", 1)
    given = (
        own.filter(named)
        .select(F.col("_dir").alias("holder"), (-first["cosine"]).alias("c"), first["licence"].alias("l"))
        .groupBy("holder")
        .agg(F.min(F.struct("c", "l"))["l"].alias("given"))
    )
    levels = F.split(F.col("_dir"), "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(levels)), lambda n: F.array_join(F.slice(levels, F.lit(1), n), "/")
    )
    above = F.array_distinct(F.concat(F.array(F.lit("")), above))
    dirs = own.filter((F.size("licences") == 0) & F.col("_dir").isNotNull()).select("_dir").distinct()
    nearest = (
        dirs.select("_dir", F.posexplode(above).alias("depth", "holder"))
        .join(given, "holder")
        .groupBy("_dir")
        .agg(F.max(F.struct("depth", "holder", "given")).alias("near"))
        .select(F.col("_dir").alias("_for"), "near")
    )
    bare = F.size("licences") == 0
    with_own = own.filter(~bare).select(
        "*", first["licence"].alias("licence"), first["cosine"].alias("cosine"), F.lit(None).cast("string").alias("inherited_from")
    )
    without = (
        own.filter(bare)
        .join(nearest, F.col("_dir") == F.col("_for"), "left")
        .select(
            *own.columns,
            F.col("near.given").alias("licence"),
            F.lit(None).cast("double").alias("cosine"),
            F.col("near.holder").alias("inherited_from"),
        )
    )
    return with_own.unionByName(without).drop("_dir")
