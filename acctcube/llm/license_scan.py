"""License scan by conditional compression.

Texts that hold a license word are candidates. The words of a whole candidate are looked at, across
lines, so a notice may be wrapped, stand in comments or inside a longer line. A notice is looked for
around each place of one of its key words (the words that tell the license from its siblings, and
numbers): few words may be missing or added there, and the key words must all be there. The place found
is compressed alone and with the notice as a raw dictionary, both in lower case; the dictionary must save
a share of the size alone. In a list of licenses (``MIT OR Apache-2.0``) the ones before an ``or`` or ``and``
are passed over for the ones after it, and the other way round, so each is found. Of notices that claim the same key words the one with the fewest differing words stays, then
the longer one, then the one that saves more. Each notice left gives one row, with the line of its first word.

Work per row only: a scan and a map, no shuffle. A candidate is read whole.

Defined results: missing and empty texts give no row; repeated rows give their rows each; equal
savings rank by license name; extra columns are not looked at; an empty table gives no row.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Notices as their licenses recommend them, several wordings to a license.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
CANDIDATE = r"(?i)licen[sc]e|spdx|permission\W+is\W+hereby|hereby\W+granted|redistribution\W+and|and\W+use\W+in\W+source|public\W+domain|mozilla\W+public"

MIN_SAVING = 0.25
MAX_DIFFERENCE = 0.2
#: Words of a list of licenses that may stand between the words of a notice.
LISTED = 12
JOINING = ("or", "and")
LEVEL = 3

_WORDS = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
#: Comment marks that are words, at the start of a line.
_MARKS = re.compile(r"^([^\S\n]*)(rem|dnl)\b", re.MULTILINE)


def _plain(word: str) -> str:
    return word.removesuffix(".0") if word[0].isdigit() else word


def wording(text: str) -> list[str]:
    """Lower-cased words and version numbers; a trailing .0 of a version does not count."""
    return [_plain(w) for w in _WORDS.findall(text.lower())]


def _size(data: bytes, dictionary: zstandard.ZstdCompressionDict | None = None) -> int:
    return len(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary).compress(data))


def _follow(words: list[str], template: list[str], most: int, back: bool) -> tuple[int, list[int], list[int]] | None:
    """Words missing or added when ``template`` follows from the first word on, the places of those
    that are there, and the places passed over as other licenses of a list; None if more than ``most``.

    With ``back`` both are read from the end.
    """
    n, m = min(len(words), len(template) + most + LISTED), len(template)
    cost, passed = [list(range(m + 1))], {}
    for i in range(1, n + 1):
        row, above, w = [i], cost[-1], words[i - 1]
        for j in range(1, m + 1):
            best = min(above[j], row[j - 1]) + 1
            row.append(above[j - 1] if w == template[j - 1] and above[j - 1] < best else best)
        # a list before its last "or": the run that is passed over ends with it
        for k in range(max(0, i - LISTED), i - 1):
            if words[k if back else i - 1] in JOINING:
                for j in range(m):
                    if cost[k][j] < row[j]:
                        row[j], passed[i, j] = cost[k][j], k
        cost.append(row)
    end = min(range(n + 1), key=lambda i: (cost[i][m], i))
    if cost[end][m] > most:
        return None
    places, over, i, j = [], [], end, m
    while i and (j or (i, j) in passed):
        if (i, j) in passed:
            over.extend(range(passed[i, j], i))
            i = passed[i, j]
        elif words[i - 1] == template[j - 1] and cost[i][j] == cost[i - 1][j - 1]:
            i, j = i - 1, j - 1
            places.append(i)
        elif cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
    return cost[end][m], places[::-1], over


class Scanner:
    """Templates as raw dictionaries, with the words that tell them apart."""

    def __init__(self, templates: dict[str, tuple[str, ...]], min_saving: float, max_difference: float):
        self.min_saving, self.max_difference = min_saving, max_difference
        names: dict[str, set[str]] = {}
        for name in templates:
            for w in (w for text in templates[name] for w in wording(text)):
                names.setdefault(w, set()).add(name)
        self.entries = []
        for name in sorted(templates):
            for text in templates[name]:
                # a raw dictionary needs eight bytes at least
                raw = zstandard.ZstdCompressionDict(text.lower().encode().ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                words = wording(text)
                # words of the notices of three licenses or more tell nothing
                keys = {w for w in words if w[0].isdigit() or len(names[w]) < 3}
                self.entries.append((name, raw, words, keys))
        self.known: dict[tuple, tuple[int, list[int], list[int]] | None] = {}

    def _around(self, words: list[str], at: int, template: list[str]) -> tuple[int, list[int], list[int]] | None:
        """Fewest differing words of the template around the place ``at`` of one of its words, and the
        places of its words and of those passed over there."""
        most, m = int(self.max_difference * len(template)), len(template)
        reach = m + most + LISTED
        start = max(0, at - reach)
        near = tuple(words[start : at + reach + 1])
        key = (id(template), at - start, near)
        if key not in self.known:
            best = None
            for j in (j for j, w in enumerate(template) if w == words[at]):
                before = _follow(near[: at - start][::-1], template[:j][::-1], most, True)
                after = before and _follow(near[at - start + 1 :], template[j + 1 :], most - before[0], False)
                if after and (best is None or before[0] + after[0] < best[0]):
                    here = at - start
                    left, right = ([here - 1 - p for p in x] for x in before[1:]), ([here + 1 + p for p in x] for x in after[1:])
                    places, over = ([*x, *y] for x, y in zip(left, right, strict=True))
                    best = (before[0] + after[0], sorted([*places, here]), over)
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[key] = best
        found = self.known[key]
        return found and (found[0], *([start + p for p in x] for x in found[1:]))

    def scan(self, text: str) -> list[tuple[int, str, float, int]]:
        """Line, license, saving and number of differing words of each notice, in order."""
        low = _MARKS.sub(lambda m: m[1] + " " * len(m[2]), text.lower())
        spots = [(m.start(), m.end()) for m in _WORDS.finditer(low)]
        words = [_plain(low[a:b]) for a, b in spots]
        where: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            where.setdefault(w, []).append(i)
        claims = []
        for name, raw, template, keys in self.entries:
            if not keys <= where.keys():
                continue
            # any key word must be there, so the places of the least frequent one are enough
            anchors = where[min(keys, key=lambda w: (len(where[w]), w))] if keys else range(len(words))
            for at in anchors:
                found = self._around(words, at, template)
                if not found:
                    continue
                differ, places, over = found
                inside = [p for p in range(places[0], places[-1] + 1) if p not in over]
                if not keys <= {words[p] for p in inside}:
                    continue
                block = " ".join(low[a:b] for a, b in _lines(spots, inside, low)).encode()
                alone = _size(block)
                saving = (alone - _size(block, raw)) / alone
                if saving >= self.min_saving:
                    held = {p for p in inside if words[p] in keys}
                    claims.append((differ, -len(places), -saving, name, places[0], held))
        taken: set[int] = set()
        out = []
        for differ, _, saving, name, first, held in sorted(claims, key=lambda c: c[:5]):
            if not taken & held:
                taken |= held
                out.append((low.count("\n", 0, spots[first][0]), name, round(-saving, 4), differ, first))
        return [x[:4] for x in sorted(out, key=lambda x: (x[4], x[1]))]


def _lines(spots: list[tuple[int, int]], inside: list[int], text: str) -> list[tuple[int, int]]:
    """Stretches of the text that hold the words ``inside``, without what stands between lines."""
    out = [spots[inside[0]]]
    for before, p in zip(inside, inside[1:]):
        a, b = spots[p]
        if p > before + 1 or "\n" in text[out[-1][1] : a]:
            out.append((a, b))
        else:
            out[-1] = (out[-1][0], b)
    return out


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] | None = None,
    min_saving: float = MIN_SAVING,
    max_difference: float = MAX_DIFFERENCE,
) -> DataFrame:
    """``doc_id, line, license, saving, n_differ``: one row per notice; lines count from 0."""
    chosen = templates or TEMPLATES
    schema = "doc_id long, line int, license string, saving double, n_differ int"

    def run(batches):
        scanner = Scanner(chosen, min_saving, max_difference)
        for b in batches:
            rows = [(i, *found) for i, text in zip(*(c.to_pylist() for c in b.columns), strict=True) for found in scanner.scan(text)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "line", "license", "saving", "n_differ"]
            )

    return docs.where(F.col("text").rlike(CANDIDATE)).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
