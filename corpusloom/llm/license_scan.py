"""License scans by patience alignment of documents with license templates.

Anchors are the words that occur once in both the text and the template; the longest
increasing subsequence of their places is kept, and the gaps between anchors are aligned the
same way. The share of a template's words that end up aligned is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing, text_or_empty

by_value(__name__)

#: Share of a template's words that must be aligned.
COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")
OUTPUT = ("license", "coverage", "first_word", "last_word", "licenses")

# Notices of public licenses, as their texts ask to state them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License.",
    "Apache-2.0-name": "This work is licensed under the Apache License, version 2.0.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-or-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-name": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction.",
    "MIT-name": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "All-rights-reserved": "All rights reserved. No part of this work may be reproduced without permission.",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _increasing(places: Sequence[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting; of several the piles decide."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(places)
    for i, place in enumerate(places):
        pile = bisect_left(tops, place)
        below[i] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(place)
            piles.append(i)
        else:
            tops[pile], piles[pile] = place, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = below[at]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """(place in text, place in template) of the aligned words, in order.

    Equal words at both ends of a gap are aligned first; the rest is anchored on words that
    are unique on both sides. A gap without such words aligns no further.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        wanted = {w: i for w, i in zip(template[c:d], range(c, d), strict=True)}
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        found: dict[str, int] = {}
        twice = set()
        for i in range(a, b):
            w = text[i]
            if w in once:
                if w in found:
                    twice.add(w)
                found[w] = i
        anchors = sorted((i, wanted[w]) for w, i in found.items() if w not in twice)
        kept = [anchors[i] for i in _increasing([j for _, j in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _places(words: Sequence[str], counts: Counter, template: Sequence[str], least: int) -> list[int]:
    """Places in the text that every sufficient copy of the template has one of.

    A copy may miss ``len(template) - least`` words, so it has one of the template's
    ``len(template) - least + 1`` rarest words.
    """
    rare = set(sorted(template, key=lambda w: (counts[w], w))[: len(template) - least + 1])
    return [i for i, w in enumerate(words) if w in rare] if any(counts[w] for w in rare) else []


def _longest_common(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """(place in text, place in template) of a longest common subsequence, in order."""
    best = [[0] * (len(template) + 1) for _ in range(len(text) + 1)]
    for i in range(len(text) - 1, -1, -1):
        for j in range(len(template) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if text[i] == template[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(text) and j < len(template):
        if text[i] == template[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _among_copies(
    words: Sequence[str], places: Sequence[int], template: Sequence[str], least: int, best: list[tuple[int, int]]
) -> list[tuple[int, int]]:
    """A better alignment than ``best``, or ``best``: of stretches little longer than the template, each by exact LCS.

    Where copies stand close together no word of theirs is unique. A stretch leaves as many
    words to both sides of where a copy with that place would be as a copy may miss.
    """
    counts, slack = Counter(template), len(template) - least
    lows = {i - j - slack for i in places for j, w in enumerate(template) if w == words[i]}
    for low in sorted(lows):
        stretch = words[max(0, low) : max(0, low + len(template) + 2 * slack)]
        possible = sum(min(n, counts[w]) for w, n in Counter(stretch).items())
        if possible >= max(least, len(best) + 1):
            found = _longest_common(stretch, template)
            if len(found) > len(best):
                best = [(i + max(0, low), j) for i, j in found]
        if len(best) == len(template):
            break
    return best


def scan(text: str | None, templates: Mapping[str, Sequence[str]], coverage: float = COVERAGE) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, last word) of each template that is covered, best first.

    The template is aligned with the stretches of the text around each place that a copy must
    have; a stretch reaches the template's length, and as much again, to both sides. In a whole
    long text its words would not be unique. If that leaves words of the template unaligned, as
    where copies stand close together, short stretches are aligned exactly. Templates of which the text has too few words are
    passed over before any alignment; that loses none.
    """
    words = words_of(text or "")
    counts = Counter(words)
    out = []
    for name, template in templates.items():
        least = max(1, ceil(coverage * len(template)))
        if not template or sum(min(n, counts[w]) for w, n in Counter(template).items()) < least:
            continue
        reach, seen, best = 2 * len(template), set(), []
        places = _places(words, counts, template, least)
        for place in places:
            low = max(0, place - reach)
            stretch = tuple(words[low : place + reach])
            if stretch in seen:
                continue
            seen.add(stretch)
            found = align(stretch, template)
            if len(found) > len(best):
                best = [(i + low, j) for i, j in found]
        if len(best) < len(template):
            best = _among_copies(words, places, template, least, best)
        if len(best) >= least:
            out.append((name, len(best) / len(template), best[0][0], best[-1][0]))
    return sorted(out, key=lambda x: (-x[1], -len(templates[x[0]]), x[0]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``docs`` with the best covered ``license``, its ``coverage`` and words, and all ``licenses`` found.

    Whole texts are scanned, where they are read; nothing is shuffled. Templates are
    configuration. Of equally covered ones the longer wins, then the first by name. Null and
    empty texts, and texts without a license, have null and an empty array. Input columns named
    like an added one are replaced.
    """
    split = {name: words_of(t) for name, t in sorted(templates.items())}

    @F.pandas_udf("license string, coverage double, first_word int, last_word int, licenses array<string>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for content in texts:
                found = scan(content, split, coverage)
                rows.append((*(found[0] if found else (None, None, None, None)), [f[0] for f in found]))
            frame = pd.DataFrame(rows, columns=list(OUTPUT))
            yield frame.astype({"first_word": "Int32", "last_word": "Int32", "coverage": "float64"})

    rows = drop_clashing(docs, *OUTPUT)
    return rows.withColumn("__op_found", scanned(text_or_empty(text))).select(*(F.col(f"`{c}`") for c in rows.columns), "__op_found.*")
