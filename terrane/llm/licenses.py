"""License scanning: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are public notices, short and long, a fixed and small list. Their winnowed k-gram
fingerprints form an inverted index (hash to template and place). A text's
winnowed fingerprints that occur in the index vote for a template and a
diagonal; each such place is aligned with the template in a band round the
diagonal, and the share of template words that the alignment matches is the
coverage. A place counts only if the words that tell licenses of a family apart
(versions; lesser, share-alike and the like) are the same on both sides.
Every whole text is scanned in one pass without a shuffle.

Defined results
    null or empty text   no match, no row
    repeated rows        each gives its rows
    ties                 of overlapping places the one with more matched words, then the larger share, then the first
    empty table          no rows
    very long texts      work grows with the text; alignment is done at candidate places only
    extra columns        ignored
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names and texts of public license notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "CC0-1.0": ["To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "Use, modification and distribution are subject to the Boost Software License, Version 1.0."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ],
    "Zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely",
    ],
}
#: Words that tell one license of a family from another, beside numbers.
TELLING = frozenset("lesser library affero sharealike sa noncommercial nc noderivatives nd apache mit gnu mozilla eclipse boost".split())

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def telling(tokens: list[str]) -> set[str]:
    """The words that decide between licenses of a family: names of kinds, and versions, without a leading v."""
    return {w.lstrip("v") if w[-1].isdigit() else w for w in tokens if w in TELLING or re.fullmatch(r"v?[0-9]+(\.[0-9]+)?", w)}


def winnow(tokens: list[str], k: int, window: int) -> list[tuple[int, int]]:
    """``(hash, place)``: of every ``window`` k-grams in a row the least hash, the last of equal ones."""
    grams = [xxhash.xxh64_intdigest(" ".join(tokens[i : i + k])) for i in range(len(tokens) - k + 1)]
    if not grams:
        return []
    out: dict[int, int] = {}
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i : i + window]
        least = min(part)
        out[i + len(part) - 1 - part[::-1].index(least)] = least
    return [(h, at) for at, h in sorted(out.items())]


def align(template: list[str], text: list[str], at: int, band: int) -> tuple[int, int, int]:
    """Matched template words and their span in ``text``, by an alignment within ``band`` of the diagonal that starts at ``at``.

    The text's ends are free. Most matches win, then the shortest span.
    """
    best: dict[int, tuple[int, int, int]] = {}  # by offset from the diagonal: matches, start, end
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for d in range(-band, band + 1):
            j = at + i + d
            options = [best[d]] if d in best else []  # the template word is replaced
            if d + 1 in best:
                options.append(best[d + 1])  # ... or missing in the text
            if d - 1 in row:
                options.append(row[d - 1])  # the text has a word more
            if 0 <= j < len(text) and text[j] == word:
                n, start, _ = best.get(d, (0, j, j))
                options.append((n + 1, start if n else j, j + 1))
            if options:
                row[d] = max(options)  # of equal matches the later start, which makes the shorter span
        best = row
    return max(best.values(), key=lambda x: (x[0], x[1] - x[2]), default=(0, 0, 0))


class Index:
    def __init__(self, templates: dict[str, list[str]], k: int, window: int):
        self.k, self.window = k, window
        self.templates = [(name, words(t)) for name, texts in templates.items() for t in texts]
        self.telling = [telling(w) for _, w in self.templates]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, (_, w) in enumerate(self.templates):
            for h, at in winnow(w, k, window):
                self.places.setdefault(h, []).append((t, at))
        #: A k-gram with a word that no template has cannot be in the index.
        self.known = {x for _, w in self.templates for x in w}


def scan_text(text: str | None, index: Index, least: float, band: int) -> list[tuple[str, float, int, int]]:
    """``license, coverage, start, end`` (word offsets) of the places that cover at least ``least`` of a template."""
    w = words(text)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    # Only runs of template words are fingerprinted: a fingerprint outside them is in no template.
    i = 0
    marks: list[tuple[int, int]] = []
    known = index.known
    while i < len(w):
        if w[i] not in known:
            i += 1
            continue
        j = i
        while j < len(w) and w[j] in known:
            j += 1
        if j - i >= index.k:
            marks += [(h, i + at) for h, at in winnow(w[i:j], index.k, index.window)]
        i = j
    tried: set[tuple[int, int]] = set()
    for h, at in marks:
        for t, place in index.places.get(h, ()):
            start = at - place
            if any((t, start + d) in tried for d in range(-band // 2, band // 2 + 1)):
                continue
            tried.add((t, start))
            template = index.templates[t][1]
            n, begin, end = align(template, w, start, band)
            # Near ties are no ties: a version or kind that differs makes another license.
            if n >= least * len(template) and index.telling[t] == telling(w[begin:end]):
                key = (t, begin)
                found[key] = max(found.get(key, (0, 0, 0)), (n, -end, end))
    # Where places overlap, the one with more matched words tells.
    ranked = sorted((-n, -n / len(index.templates[t][1]), begin, end, index.templates[t][0]) for (t, begin), (n, _, end) in found.items())
    out: list[tuple[str, float, int, int]] = []
    for _, less, begin, end, name in ranked:
        h = (name, -less, begin, end)
        if all(h[3] <= o[2] or o[3] <= h[2] for o in out):
            out.append(h)
    return sorted(out, key=lambda x: (x[2], x[0]))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    least: float = 0.8,
    k: int = 3,
    window: int = 2,
    band: int = 6,
) -> DataFrame:
    """One row per match: id, ``license``, ``coverage``, ``start_word`` and ``end_word``."""
    chosen = TEMPLATES if templates is None else templates

    @F.pandas_udf("array<struct<license:string,coverage:double,start_word:int,end_word:int>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(chosen, k, window)
        for batch in texts:
            yield pd.Series([[dict(zip(("license", "coverage", "start_word", "end_word"), x, strict=True)) for x in scan_text(t, index, least, band)] for t in batch])

    found = docs.select(F.col(id_col), F.explode(scan(F.col(text_col))).alias("_m"))
    return found.select(id_col, "_m.license", F.round("_m.coverage", 6).alias("coverage"), "_m.start_word", "_m.end_word")
