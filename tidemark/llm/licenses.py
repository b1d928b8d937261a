"""License scans: templates retrieved by MinHash bands over overlapping windows, verified by containment.

A template of n words matches where some stretch of 2n shingles, wherever it begins, holds the share LEAST
of its shingles. A text is read in windows of 3n shingles that begin n apart, so that every such stretch
lies whole in a window. A window with the share c of the template's shingles has a Jaccard similarity of at
least c / (4 - c) with it; bands of one register each, looked up in a table from band and value to
templates, then miss it with probability (1 - c / (4 - c)) ** BANDS, 1e-8 at c = 0.8. In a window that the
table returns, every stretch that begins with a shingle of the template is counted exactly.

Notices of one family share most of their words. Where a template's shingles are, but for some, those of
another template too, a match has to hold one of these, about where the template has it: GPL version 2
isn't GPL version 3, and a version that no template knows is neither.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, distinct, map_rows, pick, shingles

#: Bands of one register each, words of a shingle, and the share of a template's shingles that a match has.
BANDS, WORDS, LEAST = 64, 3, 0.8
#: Bytes of templates that a scan takes; they go to every task.
TEMPLATE_BYTES = 16 << 20
#: Shingles of a text that are looked up at once.
BLOCK = 4096

# Notices of public licenses, as they are commonly written in short form.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_GNU = {
    "GPL-1.0": ("General", "1"), "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.0": ("Library General", "2"), "LGPL-2.1": ("Lesser General", "2.1"),
    "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3"),
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_SHARED = "you can redistribute it and/or modify it under the terms of the GNU"

# Neighbouring versions and families of the above, and other licenses that are common.
FAMILIES = {
    **{n: f"This work is licensed under the GNU {kind} Public License, version {v}" for n, (kind, v) in _GNU.items()},
    **{
        f"{n}-notice": f"This {'library' if n.startswith('LGPL') else 'program'} is free software: {_SHARED} {kind} Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version"
        for n, (kind, v) in _GNU.items()
    },
    **{
        f"{n}-only-notice": f"This {'library' if n.startswith('LGPL') else 'program'} is free software; {_SHARED} {kind} Public License version {v} as published by the Free Software Foundation"
        for n, (kind, v) in _GNU.items()
    },
    **{f"CC-{n}-4.0-notice": f"This work is licensed under a Creative Commons {full} 4.0 International License" for n, full in _CC.items()},
    **{f"CC-{n}-3.0-notice": f"This work is licensed under a Creative Commons {full.replace('Derivatives', 'Derivs')} 3.0 Unported License" for n, full in _CC.items()},
    **{f"CC-{n}-{v}": f"Licensed under CC {n} {v}" for n in _CC for v in ("3.0", "4.0")},
    "CC0-1.0": "Licensed under CC0 1.0 Universal",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1",
    "MIT-licensed": "Licensed under the MIT License",
    "BSD-released": "Released under the BSD License",
    "ISC": "Released under the ISC License",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0BSD-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
    "Zlib-text": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "WTFPL": "Do What The Fuck You Want To Public License",
    "Artistic-2.0": "Released under the Artistic License 2.0",
}
#: All that a scan knows. A name that is in TEMPLATES keeps its wording, and a wording its first name.
KNOWN = TEMPLATES | {n: t for n, t in FAMILIES.items() if n not in TEMPLATES and t not in TEMPLATES.values()}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").lower()) if text else []


class Matcher:
    """Templates by length, with their MinHash values per band."""

    def __init__(self, templates: Mapping[str, str], bands: int = BANDS, k: int = WORDS, least: float = LEAST, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.k, self.least, self._hashes = k, least, WordHashes()
        self._times = draw.integers(0, 1 << 32, bands, np.uint32) | np.uint32(1)
        self._plus = draw.integers(0, 1 << 32, bands, np.uint32)
        self.by_length: dict[int, dict[str, np.ndarray]] = defaultdict(dict)
        self._offsets: dict[str, np.ndarray] = {}
        for name, text in sorted(templates.items()):
            words = words_of(text)
            if words:
                self.by_length[len(words)][name], self._offsets[name] = np.unique(shingles(words, k, self._hashes), return_index=True)
        every = {name: s for group in self.by_length.values() for name, s in group.items()}
        self._all = distinct(np.concatenate([*every.values()])) if every else np.empty(0, np.uint64)
        #: Of each template, its shingles that tell it from another one that has at least the share ``least`` of them, but not all.
        self._own = {name: [own for other, o in every.items() if other != name and (own := ~np.isin(s, o)).any() and own.mean() <= 1 - least + 1e-9] for name, s in every.items()}
        self._names = {n: list(group) for n, group in self.by_length.items()}
        self._table = {n: self._banded(group) for n, group in self.by_length.items()}
        self._fewest = {n: least * min(map(len, group.values())) for n, group in self.by_length.items()}

    def _values(self, hashes: np.ndarray) -> np.ndarray:
        """A row of band values for each hash."""
        return (hashes >> np.uint64(32)).astype(np.uint32)[:, None] * self._times + self._plus

    def _keys(self, hashes: np.ndarray) -> np.ndarray:
        """Of a set: the least value of each band, with the band's number above it."""
        return self._values(hashes).min(axis=0).astype(np.uint64) | (np.arange(len(self._times), dtype=np.uint64) << np.uint64(32))

    def _banded(self, group: Mapping[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The table from band and value to templates: sorted keys, and the template of each."""
        keys = np.concatenate([self._keys(s) for s in group.values()])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.repeat(np.arange(len(group)), len(self._times))[order]

    def _retrieved(self, n: int, window: np.ndarray) -> list[str]:
        """Templates of n words that share a band with the window."""
        keys, which = self._table[n]
        mine = self._keys(window)
        low, high = np.searchsorted(keys, mine), np.searchsorted(keys, mine, "right")
        return [self._names[n][i] for i in sorted({i for a, b in zip(low.tolist(), high.tolist(), strict=True) for i in which[a:b].tolist()})]

    def _stretches(self, name: str, n: int, window: np.ndarray) -> Iterator[tuple[int, float]]:
        """(begin, share) of the stretches of 2n shingles with enough of the template; each begins with a shingle of it."""
        mine = self.by_length[n][name]
        slot = np.minimum(np.searchsorted(mine, window), len(mine) - 1)
        at = np.nonzero(mine[slot] == window)[0]
        slot = slot[at]
        ends = np.searchsorted(at, at + 2 * n)
        for i in np.nonzero((at < n) & (ends - np.arange(len(at)) >= self.least * len(mine) - 1e-9))[0].tolist():
            share = len(np.unique(slot[i : ends[i]])) / len(mine)
            if share >= self.least:
                yield int(at[i]), share

    def _known(self, h: np.ndarray) -> np.ndarray:
        """Places whose shingle some template has."""
        out = []
        for at in range(0, len(h), BLOCK):
            part = h[at : at + BLOCK]
            slot = np.searchsorted(self._all, part)
            slot[slot == len(self._all)] = 0
            out.append(np.nonzero(self._all[slot] == part)[0] + at)
        return np.concatenate(out)

    def _told(self, name: str, n: int, window: np.ndarray) -> bool:
        """Whether the window has, for each template much like this one, a shingle that the other lacks, in line with half of its shingles."""
        if not self._own[name]:
            return True
        mine = self.by_length[n][name]
        slot = np.searchsorted(mine, window)
        slot[slot == len(mine)] = 0
        place = np.nonzero(mine[slot] == window)[0]
        slot = slot[place]
        shift = place - self._offsets[name][slot]
        for at in np.unique(shift):
            here = np.unique(slot[np.abs(shift - at) <= max(2, n // 4)])
            if 2 * len(here) >= len(mine) and all(own[here].any() for own in self._own[name]):
                return True
        return False

    def matches(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(name, first word, last word exclusive, containment) of the best verified stretch per template, the first of equal ones.

        A window with fewer known shingles than a match must have can't hold one, so only the others are sketched.
        """
        words = words_of(text)
        if len(words) < self.k or not len(self._all):
            return []
        h = shingles(words, self.k, self._hashes)
        known = self._known(h)
        best: dict[str, tuple[str, int, int, float]] = {}
        for n in self.by_length:
            if len(known) < self._fewest[n]:
                continue
            held = np.bincount(known // n, minlength=-(-len(h) // n) + 2)
            for first in (np.nonzero(held[:-2] + held[1:-1] + held[2:] >= self._fewest[n])[0] * n).tolist():
                window = h[first : first + 3 * n]
                for name in self._retrieved(n, window):
                    for at, share in self._stretches(name, n, window):
                        if (name not in best or share > best[name][3]) and self._told(name, n, window[at : at + 2 * n]):
                            best[name] = (name, first + at, min(len(words), first + at + 2 * n + self.k - 1), share)
        return [best[n] for n in sorted(best)]


def templates_of(table: DataFrame, name_col: str = "name", text_col: str = "text") -> dict[str, str]:
    """Templates from a table (name, text) such as full license texts; raises beyond TEMPLATE_BYTES. Null names and texts are left out."""
    rows = pick(table, name=name_col, text=text_col).dropna()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates; a scan takes {TEMPLATE_BYTES}")
    return {r.name: r.text for r in rows.orderBy("name", "text").collect()}


def scan(docs: DataFrame, templates: Mapping[str, str] = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_licenses, licenses, best) for each row: matched names in order, comma-joined, and the best containment.

    Whole texts. Null and empty texts and those of fewer words than a shingle match nothing (best 0). No
    shuffle: the templates, of bounded size, go to every task; templates_of reads them from a table. Rows
    may repeat; other columns aren't looked at.
    """

    def make():
        matcher = Matcher(templates)

        def step(c):
            found = [matcher.matches(t) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "n_licenses": [len(x) for x in found],
                "licenses": [",".join(m[0] for m in x) for x in found],
                "best": [max((m[3] for m in x), default=0.0) for x in found],
            }

        return step

    return map_rows(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, n_licenses long, licenses string, best double")
