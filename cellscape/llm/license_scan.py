"""License scans: winnowed template fingerprints pick candidates, banded alignment reports coverage and spans.

Templates are few and fixed, so their inverted index (fingerprint to template and place) goes to every
task. A document is looked up by all its k-grams. A template of up to ``WHOLE`` words is indexed by every
gram, of two words below ten words and of three from there on: however a fifth of its words is changed or left
out, a gram stays, so one hit makes a candidate. Longer ones are winnowed, and a candidate needs a share of
their fingerprints near one diagonal. A candidate region that hasn't enough of the template's words, whatever their order,
is left there, as no alignment of it could do; any other is aligned, word by word, in a band around the diagonals of its hits. Where templates contain one another, as licenses and their variants do, the one that
explains most words of a place, and of equals the one covered best, is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_WORDS = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

#: Templates of up to so many words are indexed by every gram.
WHOLE = 40

# Notices by which works state their license.
NOTICES = {
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
}


def license_texts(folder: str | Path = Path(__file__).parent / "licenses") -> dict[str, str]:
    """Whole texts of licenses by name, from a folder of text files."""
    return {p.stem: p.read_text() for p in sorted(Path(folder).glob("*.txt"))}


TEMPLATES = NOTICES | license_texts()


def winnow(hashes: np.ndarray, window: int) -> list[int]:
    """Places of the least hash (the last, where equal) of every window; of all where there are fewer."""
    if not len(hashes):
        return []
    picked = set()
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i : i + window]
        picked.add(i + len(part) - 1 - int(np.argmin(part[::-1])))
    return sorted(picked)


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k word ids; a run with an unknown word (0) has hash 0."""
    if len(ids) < k:
        return np.zeros(0, np.uint64)
    n = len(ids) - k + 1
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(k):
        part = ids[i : i + n]
        known &= part > 0
        out = (out ^ part) * _MULTIPLIER
    return np.where(known, out | np.uint64(1), np.uint64(0))


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(words matched, first, last place in ``text``) of the longest common subsequence near the diagonals low to high.

    A row of the table holds, for each place, the words matched and where the match began as one number, the later
    start being the better; what a place outside the band held before stays, as it is still an alignment.
    """
    one = np.int64(1) << 32
    best = np.zeros(len(text) + 1, np.int64)
    places = np.arange(len(text), dtype=np.int64)
    for i, word in enumerate(template):
        a, z = max(0, i + low), min(len(text), i + high + 1)
        if a < z:
            before = best[a:z]
            met = np.where(text[a:z] == word, np.where(before > 0, before + one, one | places[a:z]), 0)
            best[a + 1 : z + 1] = np.maximum.accumulate(np.maximum(best[a + 1 : z + 1], met))
    matched = best[1:] >> 32
    most = int(matched.max(initial=0))
    if not most:
        return 0, 0, -1
    ends = np.flatnonzero(matched == most)
    starts = best[1:][ends] & (one - 1)
    k = int(np.argmin(ends - starts))
    return most, int(starts[k]), int(ends[k])


class Scanner:
    """Finds templates in a text; built once a task."""

    def __init__(self, templates: Mapping[str, str], window: int = 3, coverage: float = 0.8, share: float = 0.15):
        self.coverage, self.names = coverage, sorted(templates)
        self.vocabulary: dict[str, int] = {}
        self.templates = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _WORDS.findall(templates[n].lower())], np.int64) for n in self.names]
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.need: list[int] = []
        for t, ids in enumerate(self.templates):
            k = min(len(ids), 2 if len(ids) < 10 else 3)
            h = grams(ids.astype(np.uint64), k) if k else np.zeros(0, np.uint64)
            places = range(len(h)) if len(ids) <= WHOLE else winnow(h, window)
            self.need.append(1 if len(ids) <= WHOLE else max(2, int(share * len(places))))
            for place in places:
                self.index.setdefault(k, {}).setdefault(int(h[place]), []).append((t, place))
        self.counts = [np.bincount(ids, minlength=len(self.vocabulary) + 1) for ids in self.templates]
        self.keys = {k: np.array(sorted(x), np.uint64) for k, x in self.index.items()}

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, least, greatest diagonal) of each group of hits whose diagonals are near one another."""
        met: dict[int, list[tuple[int, int]]] = {}
        for k, keys in self.keys.items():
            h = grams(ids, k)
            for at in np.flatnonzero(np.isin(h, keys)).tolist() if h.any() else ():
                for t, place in self.index[k][int(h[at])]:
                    met.setdefault(t, []).append((at - place, place))
        for t, hits in sorted(met.items()):
            band, group = self.band(t), []
            for hit in [*sorted(hits), None]:
                if group and (hit is None or hit[0] - group[-1][0] > band or hit[0] - group[0][0] > 4 * band):
                    if len({place for _, place in group}) >= self.need[t]:
                        yield t, group[0][0], group[-1][0]
                    group = []
                if hit is not None:
                    group.append(hit)

    def band(self, t: int) -> int:
        return max(8, len(self.templates[t]) // 16)

    def places(self, t: int, text: np.ndarray, low: int, high: int, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(words matched, first, last place) of alignments near the diagonals that don't overlap, between begin and end."""
        template, todo = self.templates[t], [(begin, end)]
        while todo:
            begin, end = todo.pop()
            if end - begin < self.coverage * len(template):
                continue
            words, times = np.unique(text[begin:end], return_counts=True)
            if np.minimum(self.counts[t][words], times).sum() < self.coverage * len(template):
                continue
            matched, first, last = align(template, text[begin:end], low - begin, high - begin)
            if matched >= self.coverage * len(template):
                yield matched, begin + first, begin + last
                todo += [(begin, begin + first), (begin + last + 1, end)]

    def found(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, words matched, first, last place) of all templates, those that overlap too."""
        out, text = set(), ids.astype(np.int64)
        for t, low, high in self.candidates(ids):
            band, n = self.band(t), len(self.templates[t])
            for x in self.places(t, text, low - band, high + band, max(0, low - band), min(len(text), high + n + band)):
                out.add((t, *x))
        return sorted(out)

    def __call__(self, text: str | None) -> list[tuple[str, float, int, int, int, int]]:
        """(license, coverage, words matched, template words, start, end) by start; spans in code points, end exclusive."""
        text = text or ""
        lower = text.lower()
        get = self.vocabulary.get
        same = len(lower) == len(text)  # else lower-casing moved places, so words are cut from the text as it is
        ids = np.array([get(w, 0) for w in _WORDS.findall(lower)] if same else [get(w.lower(), 0) for w in _WORDS.findall(text)], np.uint64)
        found = self.found(ids)
        if not found:
            return []
        words, out, taken = list(_WORDS.finditer(text)), [], np.zeros(len(ids), bool)
        for t, n, first, last in sorted(found, key=lambda x: (-x[1], -x[1] / len(self.templates[x[0]]), self.names[x[0]], x[2])):
            if 2 * taken[first : last + 1].sum() <= last + 1 - first:
                taken[first : last + 1] = True
                size = len(self.templates[t])
                out.append((self.names[t], n / size, n, size, words[first].start(), words[last].end()))
        return sorted(out, key=lambda x: (x[4], x[5], x[0]))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", coverage: float = 0.8) -> DataFrame:
    """(id, license, coverage, matched, template_words, start, end): one row for each place at which a template is found.

    Null and empty texts have none. Texts of any length are scanned whole. Rows that repeat an id, or have none, are
    each scanned. Of templates that tie for a place the first by name is reported. Other columns aren't read.
    """
    small_batches(docs.sparkSession)

    def scanned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = Scanner(templates, coverage=coverage)
        for part in parts:
            yield pd.DataFrame(
                [(i, *x) for i, t in zip(part["id"].astype("Int64"), part["t"]) for x in tool(t)],
                columns=["id", "license", "coverage", "matched", "template_words", "start", "end"],
            ).astype({"id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInPandas(scanned, "id long, license string, coverage double, matched long, template_words long, start long, end long").withColumnRenamed("id", id_col)
