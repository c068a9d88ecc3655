"""Licence scans: MinHash bands over text windows, exact containment (operator 8).

Words are parted by anything but digits, letters and non-ASCII characters, and
shingles have five of them. Templates are put into size classes of 2, 4, 8
... shingles; the windows of a class are half as long again as its largest
template and start every half of it, so each occurrence lies whole in one
window. A window retrieves a template when one of 64 MinHash samples (bands of
one row) agrees. A window that holds at least 0.8 of a template's shingles has
a Jaccard similarity to it of 0.25 or more, so it is missed with probability
0.75 ** 64 = 1e-8 at most. What is retrieved is verified by exact containment
of the template's shingles.
"""

from __future__ import annotations

from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import column, mix64, read, slices, utf8
from corpusflow.llm.decontaminate import words_of

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
#: shingles of the smallest size class
SMALLEST = 2
WORDS_KEPT = 400_000
#: characters of templates that are sent to every task
TABLE_CHARS = 32 << 20

# Notices and headers; whole texts are in license_texts
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
            "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
            "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
            "following restrictions",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
               "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
               "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
               "third-parties to whom the Software is furnished to do so",
}
_GNU = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License "
        "as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.")
TEMPLATES |= {
    "GPL-2.0": _GNU.format("program", ";", "", ";", "2"),
    "LGPL-2.0": _GNU.format("library", ";", "Library ", ";", "2"),
    "LGPL-2.1": _GNU.format("library", ";", "Lesser ", ";", "2.1"),
    "LGPL-3.0": _GNU.format("program", ":", "Lesser ", ",", "3"),
    "AGPL-3.0": _GNU.format("program", ":", "Affero ", ",", "3"),
}
_BSD = [
    TEMPLATES["BSD"] + ":",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution.",
    "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."]
TEMPLATES |= {name: " ".join(f"{i}. {_BSD[k]}" if i else _BSD[k] for i, k in enumerate(parts)) for name, parts in
              {"BSD-2-Clause": (0, 1, 2), "BSD-3-Clause": (0, 1, 2, 4), "BSD-4-Clause": (0, 1, 2, 3, 4)}.items()}
TEMPLATES |= {f"{f.name[:-4]}-text": f.read_text("utf-8") for f in
              sorted(files("corpusflow.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}

_rng = np.random.default_rng(17)
_MULTIPLY = _rng.integers(0, 1 << 32, BANDS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS, dtype=np.uint32)
_NONE = np.uint32(0xFFFFFFFF)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(words: list[bytes], hashes: dict) -> np.ndarray:
    """64-bit hashes of the shingles, in text order; fewer than five words are one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h, m = np.fromiter(map(hashes.__getitem__, words), np.uint64, n), min(SHINGLE, n)
    s = np.full(n - m + 1, m, np.uint64)
    for i in range(m):
        s = mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[i:n - m + 1 + i])
    return s


def _halves(s: np.ndarray) -> np.ndarray:
    """MinHash samples (blocks x bands) of each run of ``SMALLEST / 2`` shingles."""
    size = SMALLEST // 2
    out = np.full((-(-len(s) // size), BANDS), _NONE, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        v = x[at:at + 2048, None] * _MULTIPLY + _ADD
        out[at // size:(at + len(v) + size - 1) // size] = np.minimum.reduceat(v, np.arange(0, len(v), size), axis=0)
    return out


class Library:
    """Templates by size class with their samples and shingle sets."""

    def __init__(self, templates: dict[str, str]):
        self.classes: dict[int, list] = {}
        self.sets: dict[str, np.ndarray] = {}
        self.offsets: dict[str, np.ndarray] = {}  # places in the template, -1 where there are several
        hashes = _Hashes()
        for name, text in sorted(templates.items()):
            whole = shingles(words_of(text.encode()), hashes)
            s, first, times = np.unique(whole, return_index=True, return_counts=True)
            if not len(s):
                continue
            self.sets[name], self.offsets[name] = s, np.where(times == 1, first, -1)
            size = SMALLEST
            while size < len(s):
                size *= 2
            self.classes.setdefault(size, []).append((name, s, _halves(s).min(axis=0)))

    def windows(self, s: np.ndarray, retrieve: bool = True):
        """(class, start, end, templates to verify) of every window; all templates without ``retrieve``."""
        half, size = _halves(s), SMALLEST
        for top in sorted(self.classes):
            while size < top:  # runs of the next class: two of these
                half = np.minimum.reduceat(half, np.arange(0, len(half), 2), axis=0)
                size *= 2
            count = max(1, len(half) - 2)
            seen = half[:count].copy()
            for k in (1, 2):
                rest = half[k:k + count]
                np.minimum(seen[:len(rest)], rest, out=seen[:len(rest)])
            step = size // 2
            hit: dict[int, list] = {}
            for t in self.classes[top]:
                for w in np.flatnonzero((seen == t[2]).any(axis=1)) if retrieve else range(count):
                    hit.setdefault(int(w), []).append(t)
            yield top, count, [(w * step, min(len(s), (w + 3) * step), ts) for w, ts in sorted(hit.items())]

    def _copies(self, name: str, part: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """``at``, the template's shingles in a window, parted where the template begins anew."""
        want = self.sets[name]
        offset = self.offsets[name][np.searchsorted(want, part[at])]
        sure = np.flatnonzero(offset >= 0)
        anew = sure[1:][np.diff(offset[sure]) < -len(want) / 2]
        if len(want) == 1:
            anew = np.arange(1, len(at))
        return np.split(at, anew)

    def places(self, s: np.ndarray, retrieve: bool = True) -> tuple[int, list]:
        """Number of windows, and all verified places (license, shared, of, start, end) in shingles, sorted.

        Places of one licence do not overlap: of those that do the one with
        most shingles stays, of equal ones the first. Where places of licences
        that have half of the smaller one's shingles in common overlap, the
        licence stays of whose other shingles the larger part is there.
        """
        n, by = 0, {}
        if not len(s):
            return 0, []
        for _, count, hit in self.windows(s, retrieve):
            n += count
            for a, b, ts in hit:
                for name, want, _ in ts:
                    part = s[a:b]
                    at = np.flatnonzero(np.isin(part, want))
                    if len(at) < CONTAINED * len(want):
                        continue
                    copies = [(len(np.unique(part[x])), x) for x in self._copies(name, part, at)]
                    good = [(k, x) for k, x in copies if k >= CONTAINED * len(want)]
                    if not good and (k := len(np.unique(part[at]))) >= CONTAINED * len(want):
                        good = [(k, at)]
                    by.setdefault(name, set()).update((-k, a + int(x[0]), a + int(x[-1]) + 1) for k, x in good)
        every = []
        for name, found in sorted(by.items()):
            mine: list = []
            for k, a, b in sorted(found):
                if all(b <= c or d <= a for _, c, d in mine):
                    mine.append((k, a, b))
            every += [(name, -k, len(self.sets[name]), a, b) for k, a, b in mine]
        return n, sorted((x for x in every if not any(self._beats(y, x, s) for y in every)), key=lambda x: (x[0], x[3]))

    def _beats(self, y: tuple, x: tuple, s: np.ndarray) -> bool:
        if x[0] == y[0] or y[4] <= x[3] or x[4] <= y[3]:
            return False
        mine, other = self.sets[x[0]], self.sets[y[0]]
        if 2 * len(np.intersect1d(mine, other, True)) < min(len(mine), len(other)):
            return False
        here = np.unique(s[min(x[3], y[3]):max(x[4], y[4])])

        def part(one: np.ndarray, two: np.ndarray) -> float:
            own = np.setdiff1d(one, two, True)
            return float(np.isin(own, here).mean()) if len(own) else 0.5

        return (part(other, mine), y[1] / y[2], y[0]) > (part(mine, other), x[1] / x[2], x[0])

    def scan(self, s: np.ndarray, retrieve: bool = True) -> tuple[int, dict]:
        """Number of windows, and by template the best place (shared, of, start, end) in shingles."""
        n, every = self.places(s, retrieve)
        found: dict = {}
        for name, *place in every:
            if name not in found or place[0] > found[name][0]:
                found[name] = tuple(place)
        return n, found


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, n_windows, matches`` for every row of ``docs(doc_id, text)``.

    ``matches`` is an array of ``license, shared, of, start, end``, sorted by
    licence and start, of all places that do not overlap: the template's
    distinct shingles there, how many it has, and the words from its first to
    its last (end exclusive). Of like templates in one place the one stays whose
    own words are there. Null, empty and blank texts have no window; a
    null doc_id stays null; repeated rows give repeated results; other columns
    are not looked at; texts of any length are scanned whole. ``templates`` is
    a table of fixed text, sent to every task.
    """
    table = TEMPLATES if templates is None else templates
    if (size := sum(map(len, table.values()))) > TABLE_CHARS:
        raise ValueError(f"templates of {size} characters; {TABLE_CHARS} at most are sent to the tasks")
    library = docs.sparkSession.sparkContext.broadcast(Library(table))
    names = ("license", "shared", "of", "start", "end")
    kind = pa.list_(pa.struct([("license", pa.string()), *((n, pa.int32()) for n in names[1:])]))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes, lib = _Hashes(), library.value
        for b in slices(batches):
            words, windows, matches = [], [], []
            for text in utf8(b, "text"):
                w = words_of(text)
                n, found = lib.places(shingles(w, hashes))
                words.append(len(w))
                windows.append(n)
                matches.append([dict(zip(names, (*v[:4], min(len(w), v[4] + SHINGLE - 1)))) for v in found])
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(words, pa.int64()), pa.array(windows, pa.int64()),
                                              pa.array(matches, kind)], names=["doc_id", "n_words", "n_windows", "matches"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_windows long, "
             "matches array<struct<license:string,shared:int,of:int,start:int,end:int>>")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"], m["shared"], m["of"]))
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_windows", F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
        F.array_join(line, ",").alias("matches"))


QUERIES = {"op8_license_scan": op8_license_scan}
ORACLE: dict[str, str] = {}
