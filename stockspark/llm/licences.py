"""Licence scans: passages of normalised text against licence templates by the Dice coefficient.

Text is lower-cased and cut into sentences and lines; a passage is a run of these. Its word bigrams are
compared with those of every template by Dice's coefficient 2 * shared / (passage + template). For a
coefficient of ``least`` a passage of m bigrams needs a template of n with
least / (2 - least) <= m / n <= (2 - least) / least, so runs stop growing at the upper bound, and only
runs that begin and end with a sentence holding a bigram of the template are tried. All others have
nothing to gain: a sentence without shared bigrams at either end lowers the coefficient.
Where no run matches, windows of words are compared in the same way, so a notice inside a longer sentence
or across lines is found, too.

Scanning is row by row in Arrow batches; templates are a parameter of known size.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from stockspark.llm.common import map_rows

LEAST = 0.75

# Public licence notices.
TEMPLATES = {
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
    ),
    "Apache-2.0": (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        'This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.',
    ),
    "BSD-3-Clause": (
        'Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.',
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.',
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.',
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.',
    ),
    "CC-BY-NC-SA-4.0": (
        'Licensed under CC BY-NC-SA 4.0.',
        'This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.',
    ),
    "CC-BY-ND-4.0": (
        'Licensed under CC BY-ND 4.0.',
        'This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.',
    ),
    "CC-BY-NC-ND-4.0": (
        'Licensed under CC BY-NC-ND 4.0.',
        'This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.',
    ),
    "AGPL-3.0": (
        'This work is licensed under the GNU Affero General Public License, version 3.',
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.',
    ),
    "LGPL-2.1": (
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.',
    ),
    "ISC": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.',
    ),
    "EPL-2.0": (
        'This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/',
    ),
    "Unlicense": (
        'This is free and unencumbered software released into the public domain.',
        'Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.',
    ),
    "CC0-1.0": ("Released into the public domain under CC0 1.0.",),
}

_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"\n+|(?<=[.!?;:])\s+")


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    """Pairs of neighbouring words; a single word pairs with the empty one."""
    return list(zip(words, words[1:])) if len(words) > 1 else [(w, "") for w in words]


class Templates:
    """Templates as bags of bigrams, and for each bigram the templates that hold it."""

    def __init__(self, texts: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.bags = [(name, Counter(bigrams(_WORD.findall(t.lower())))) for name, ts in texts.items() for t in ts]
        self.sizes = [sum(b.values()) for _, b in self.bags]
        self.where: dict[tuple[str, str], list[int]] = {}
        for k, (_, bag) in enumerate(self.bags):
            for b in bag:
                self.where.setdefault(b, []).append(k)

    def sentences(self, text: str) -> list[tuple[int, int, list[str]]]:
        """(start, end, words) of all sentences with words."""
        found, at = [], 0
        for stop, following in [*((m.start(), m.end()) for m in _BREAK.finditer(text)), (len(text), len(text))]:
            words = _WORD.findall(text[at:stop].lower())
            if words:
                found.append((at, stop, words))
            at = following
        return found

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(licence, start, end, coefficient) of the passages that match, the best of overlapping ones."""
        if not text:
            return []
        parts = self.sentences(text)
        touched: dict[int, list[int]] = {}
        before = None
        for i, (_, _, words) in enumerate(parts):
            pairs = bigrams(words) + ([(before, words[0])] if before else [])
            for k in {k for b in pairs if b in self.where for k in self.where[b]}:
                touched.setdefault(k, []).append(i)
            before = words[-1]
        found = []
        for k, places in touched.items():
            name, bag = self.bags[k]
            low, high = self.sizes[k] * self.least / (2 - self.least), self.sizes[k] * (2 - self.least) / self.least
            holds = set(places)
            # A run may begin one sentence ahead: the bigram across the border is the only one it shares.
            for i in sorted({j for p in places for j in (p - 1, p) if j >= 0}):
                words: list[str] = []
                for j in range(i, len(parts)):
                    words = words + parts[j][2]
                    if len(words) - 1 > high:
                        break
                    if j not in holds or len(words) - 1 < low and len(words) > 1:
                        continue
                    mine = Counter(bigrams(words))
                    value = 2 * sum((mine & bag).values()) / (sum(mine.values()) + self.sizes[k])
                    if value >= self.least:
                        found.append((-value, parts[i][0], parts[j][1], name))
        chosen: list[tuple[str, int, int, float]] = []
        for value, s, e, name in sorted(found):
            if not any(s < b and a < e for _, a, b, _ in chosen):
                chosen.append((name, s, e, -value))
        for value, s, e, name in sorted(self.windows(text)):
            if not any(s < b and a < e for _, a, b, _ in chosen):
                chosen.append((name, s, e, -value))
        return sorted(chosen, key=lambda c: c[1])

    def windows(self, text: str) -> list[tuple[float, int, int, str]]:
        """(-coefficient, start, end, licence) of word windows that match, wherever sentences or lines break.

        A window begins and ends with a bigram of the template; one that reaches ``least`` shares at least
        the lower size bound, so starts with fewer bigrams of the template ahead of them are passed over.
        """
        spans = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
        pairs = [(a[2], b[2]) for a, b in zip(spans, spans[1:])]
        hits: dict[int, list[int]] = {}
        for i, pair in enumerate(pairs):
            for k in self.where.get(pair, ()):
                hits.setdefault(k, []).append(i)
        found = []
        for k, at in hits.items():
            (name, bag), size = self.bags[k], self.sizes[k]
            low, high = size * self.least / (2 - self.least), size * (2 - self.least) / self.least
            ahead = math.ceil(low - 1e-9) - 1
            for x in range(len(at) - ahead):
                if at[x + ahead] - at[x] + 1 > high:
                    continue
                mine: Counter = Counter()
                shared = 0
                for y in range(x, len(at)):
                    length = at[y] - at[x] + 1
                    if length > high:
                        break
                    pair = pairs[at[y]]
                    if mine[pair] < bag[pair]:
                        mine[pair] += 1
                        shared += 1
                    value = 2 * shared / (length + size)
                    if value >= self.least:
                        found.append((-value, spans[at[x]][0], spans[at[y] + 1][1], name))
        return found


def find(docs: DataFrame, templates: Templates | None = None, text: str = "text") -> DataFrame:
    """``docs`` with __licences, an array of (licence, s, e, dice) by start.

    Null and empty texts have none; repeated rows are scanned alike; an empty table stays empty.
    """
    used = templates or Templates()

    def run(columns: list[list]) -> list[list]:
        return [[[dict(zip(("licence", "s", "e", "dice"), f)) for f in used.scan(t)] for t in columns[0]]]

    return map_rows(docs, [text], run, StructType.fromDDL("__licences array<struct<licence:string,s:int,e:int,dice:double>>"))
