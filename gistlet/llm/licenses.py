"""License scan by patience alignment.

Text and template are aligned on the words that occur once in each of them: of these the
longest sequence that ascends in both is taken, and the stretches between its words are aligned
in the same way. Coverage is the share of the template's words that are aligned. A document is
first narrowed to the stretches that hold enough different words of a template, and these to
windows of bounded reach that hold no word (or, for altered copies, few) more often than the
template does. Each window is aligned by itself, so that the words of a notice are not made
common by the rest of the text or by a second copy beside it. A stretch without a find in
its windows is aligned as a whole.

Much of a notice's wording is shared by licenses, so a find must also hold the template's deciding phrases
(``DECIDES``: name, kind, version), each aligned as it stands, and none of the phrases that would make it
another license, in the aligned stretch and ``BEYOND`` words after it. Templates of fewer than ``SHORT`` words must be
aligned whole, whatever the coverage asked for.

Words are runs of letters and digits, lower-cased (A-Z). Null and empty texts hold no
license. Overlapping finds of templates are reduced to the one with more aligned words, then the higher
coverage, then the smaller name. Repeated rows are scanned each for itself.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import ALNUM, LOWER, bound_batches, row_slices, span_hashes, text_bytes, word_spans

COVERAGE = 0.8
SHORT = 12          # words below which a template must be aligned whole
BEYOND = 40         # words after a find in which a phrase can still make it another license

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.")


def _gnu(name: str, version: str) -> str:
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) "
            "any later version.")


# The wording of license notices. A name is that of the license, with the wording's kind after it.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-notice": _gnu("GNU Affero General Public License", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "Apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "BSD-2-Clause-notice": _BSD,
    "BSD-2-Clause-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "BSD-3-Clause-notice": _BSD + (
        " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "BSD-3-Clause-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": _gnu("GNU General Public License", "2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-grant": _gnu("GNU Lesser General Public License", "3"),
    "LGPL-3.0-notice": _gnu("GNU Lesser General Public License", "3") + (
        " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MIT-spdx": "SPDX-License-Identifier: MIT",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense-notice": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}

# Phrases that a find must hold ("|": either), and after "not" those that it must not. The GNU, Creative Commons and
# version phrases stand as they do in the wording, so that "Lesser" or "NoDerivatives" between their words decides, too.
DECIDES = {
    "AGPL-3.0": "affero general, version 3",
    "AGPL-3.0-notice": "affero general, version 3",
    "Apache-2.0": "apache license, version 2 0",
    "Apache-2.0-notice": "apache license | apache org, version 2 0 | license 2 0",
    "Apache-2.0-spdx": "identifier apache 2 0",
    "BSD-2-Clause-notice": "redistributions of source, redistributions in binary not endorse or promote, advertising materials",
    "BSD-2-Clause-spdx": "identifier bsd 2 clause not clause patent",
    "BSD-3-Clause-notice": "redistributions of source, redistributions in binary, endorse or promote not advertising materials",
    "BSD-3-Clause-spdx": "identifier bsd 3 clause not clause clear, clause attribution, clause no, clause lbnl, clause modification",
    "CC-BY-4.0": "commons attribution 4 0",
    "CC-BY-4.0-short": "by 4 0",
    "CC-BY-NC-4.0": "by nc 4 0",
    "CC-BY-NC-4.0-long": "attribution noncommercial 4 0",
    "CC-BY-NC-ND-4.0": "noncommercial noderivatives 4 0",
    "CC-BY-NC-ND-4.0-short": "by nc nd 4 0",
    "CC-BY-NC-SA-4.0": "noncommercial sharealike 4 0",
    "CC-BY-NC-SA-4.0-short": "by nc sa 4 0",
    "CC-BY-ND-4.0": "attribution noderivatives 4 0",
    "CC-BY-ND-4.0-short": "by nd 4 0",
    "CC-BY-SA-3.0": "attribution sharealike 3 0",
    "CC-BY-SA-4.0": "attribution sharealike 4 0",
    "CC-BY-SA-4.0-short": "by sa 4 0",
    "CC0-1.0-notice": "waived all copyright",
    "GPL-2.0": "gnu general, version 2",
    "GPL-2.0-notice": "gnu general, version 2",
    "GPL-3.0": "gnu general, version 3",
    "GPL-3.0-notice": "gnu general, version 3",
    "ISC-notice": "with or without fee",
    "LGPL-2.1-notice": "lesser general, version 2 1",
    "LGPL-3.0": "lesser general, version 3",
    "LGPL-3.0-grant": "lesser general, version 3",
    "LGPL-3.0-notice": "lesser general, version 3",
    "MIT": "mit license not apache, bsd, gnu, gpl, isc, mozilla, zlib, artistic, no attribution",
    "MIT-licensed": "mit license not apache, bsd, gnu, gpl, isc, mozilla, zlib, artistic, no attribution",
    "MIT-notice": "free of charge, without restriction",
    "MIT-spdx": "identifier mit not mit 0, mit advertising, mit cmu, mit feh, mit modern",
    "MPL-2.0-notice": "mozilla public license v 2 0",
    "Unlicense-notice": "free and unencumbered, public domain",
}

FOUND = "doc_id long, license string, coverage double, start long, stop long"


def words_of(text: str) -> list[str]:
    low = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_spans(ALNUM[low], np.array([0, len(low)]))
    raw = low.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of ``pairs`` (ascending in the first) that ascends in the second, by patience piles."""
    tops: list[int] = []
    heads: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(heads[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            heads.append(i)
        else:
            tops[pile], heads[pile] = b, i
    out = []
    i = heads[-1] if heads else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned (text, template) positions, ascending in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        # equal ends need no anchor
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            out.append((b - 1, d - 1))
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if there[w] == 1}
        anchors = ascending([(i, place[w]) for i, w in enumerate(text[a:b], a) if here[w] == 1 and w in place])
        out += anchors
        if anchors:
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            work += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def stretches(at: np.ndarray, word: np.ndarray, need: int, reach: int) -> list[tuple[int, int, int]]:
    """Disjoint ranges of positions in which ``need`` different template words stand within ``reach``.

    Of each its first position, the first without words that come again in it, and its end.
    """
    seen: Counter = Counter()
    found: list[list[int]] = []
    i = 0
    for j in range(len(at)):
        seen[word[j]] += 1
        while at[j] - at[i] >= reach:
            seen[word[i]] -= 1
            if not seen[word[i]]:
                del seen[word[i]]
            i += 1
        if len(seen) >= need:
            first = int(at[i])
            # drop what the range does not need at its start, so that it begins at the notice
            while seen[word[i]] > 1:
                seen[word[i]] -= 1
                i += 1
            lo, hi = int(at[i]), int(at[j]) + 1
            if found and lo < found[-1][2]:
                found[-1][2] = hi
            else:
                found.append([max(first, found[-1][2] if found else 0), lo, hi])
    return [(a, b, c) for a, b, c in found]


def windows(words: list[int], limit: dict[int, int], need: int, reach: int, spare: int) -> Iterator[tuple[int, int]]:
    """The longest ranges of ``words`` within ``reach`` in which at most ``spare`` words go beyond ``limit``.

    Words that are not in ``limit`` are free, and ranges with fewer than ``need`` different words are left out. A range
    begins and ends with a word of ``limit``. The start that is sent back, if any, is where the next range may begin.
    """
    seen: Counter = Counter()
    over = i = 0
    floor = 0
    last = -1                    # end of the range that stands open, if it was not given out yet

    def drop() -> None:
        nonlocal i, over
        w = words[i]
        if w in limit:
            over -= seen[w] > limit[w]
            seen[w] -= 1
            if not seen[w]:
                del seen[w]
        i += 1

    j = 0
    while j <= len(words):
        w = words[j] if j < len(words) else None
        if w is not None and w not in limit:
            j += 1
            continue
        full = w is None or j - i >= reach or over + (seen[w] >= limit[w]) > spare
        if full and last > i and len(seen) >= need:
            while i < last and words[i] not in limit:
                i += 1
            floor = yield i, last
            last = -1
            while floor is not None and i < min(floor, j):
                drop()
        if w is None:
            return
        while i < j and (j - i >= reach or over + (seen[w] >= limit[w]) > spare):
            drop()
        over += seen[w] >= limit[w]
        seen[w] += 1
        j += 1
        last = j


def phrases(text: str) -> list[list[list[str]]]:
    """The phrases between commas, each as its wordings."""
    return [[w.split() for w in p.split("|")] for p in text.split(",") if p.strip()]


def stands(phrase: list[int], words: Callable[[int], int], places: Iterable[int]) -> bool:
    """Whether ``phrase`` begins at one of ``places``."""
    return any(all(words(p + i) == w for i, w in enumerate(phrase)) for p in places)


def aligned(words: list[int], lead: int, template: list[int], need: int, least: float,
            fits: Callable = lambda pairs: True) -> list[tuple[int, float, int, int]]:
    """(aligned words, coverage, start, stop) of the finds in a stretch, which may overlap; ``lead`` words may be left out.

    ``fits`` says of the aligned (stretch, template) positions whether they may be a find.
    """
    limit = Counter(template)
    out = []

    def align(a: int, b: int) -> tuple[int, float, int, int] | None:
        pairs = patience(words[a:b], template)
        share = len(pairs) / len(template)
        if share < least or not fits([(a + p, q) for p, q in pairs]):
            return None
        return len(pairs), share, a + pairs[0][0], a + pairs[-1][0] + 1

    for spare in sorted({0, int(len(template) * (1 - least) + 1e-9)}):
        ranges = windows(words, limit, need, 2 * len(template), spare)
        found = next(ranges, None)
        while found:
            find = align(*found)
            if find:
                out.append(find)
            # an unaltered copy is closed: nothing aligns better, and the next begins after it
            whole = find and find[0] == len(template) == find[3] - find[2]
            try:
                found = ranges.send(find[3] if whole else None)
            except StopIteration:
                break
    if not out:
        find = align(lead, len(words))
        out = [find] if find else []
    return sorted(set(out))


class Scanner:
    """Templates as numbered words; made in each task."""

    def __init__(self, templates: dict[str, str], coverage: float, decides: dict[str, str] | None = None):
        self.names = sorted(templates)
        lists = [words_of(templates[k]) for k in self.names]
        rules = [(DECIDES if decides is None else decides).get(k, "").partition(" not ") for k in self.names]
        must, never = [phrases(r[0]) for r in rules], [phrases(r[2]) for r in rules]
        vocabulary = sorted({w for x in lists for w in x} | {w for x in [*must, *never] for p in x for either in p for w in either})
        number = {w: i for i, w in enumerate(vocabulary)}
        raw = "".join(vocabulary).encode()
        ends = np.cumsum([len(w.encode()) for w in vocabulary])
        h = span_hashes(np.frombuffer(raw, np.uint8), np.append(0, ends[:-1]), ends)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.templates = [[number[w] for w in x] for x in lists]
        self.must, self.never = ([[[[number[w] for w in either] for either in p] for p in x] for x in side] for side in (must, never))
        self.least = [1.0 if len(x) < SHORT else coverage for x in lists]
        member = np.zeros((len(lists), len(vocabulary)), bool)
        for k, x in enumerate(self.templates):
            member[k, x] = True
        self.member = member
        # enough different words to reach the coverage, whichever of the repeated words are missing
        self.need = []
        for x, least in zip(self.templates, self.least, strict=True):
            spare = int(len(x) * (1 - least) + 1e-9)
            sizes = sorted(Counter(x).values())
            gone = 0
            while sizes and spare >= sizes[0]:
                spare -= sizes.pop(0)
                gone += 1
            self.need.append(max(1, len(set(x)) - gone))

    def fits(self, t: int, pairs: list[tuple[int, int]], word_at: Callable[[int], int]) -> bool:
        """Whether the find of template ``t`` is of its license: ``pairs`` of (text, template) places; words of the text."""
        template, meet = self.templates[t], {q: p for p, q in pairs}

        def whole(phrase: list[int]) -> bool:
            own = [q for q in range(len(template)) if template[q:q + len(phrase)] == phrase]
            return any(all(meet.get(q + i) == meet[q] + i for i in range(len(phrase))) for q in own if q in meet)

        if not all(any(whole(w) for w in wordings) for wordings in self.must[t]):
            return False
        a, b = pairs[0][0], pairs[-1][0] + 1
        return not any(stands(w, word_at, range(a, b + BEYOND)) for wordings in self.never[t] for w in wordings)

    def rows(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, str, float, int, int]]:
        """(row, license, coverage, start, stop) of all finds; start and stop are words of the row."""
        low = LOWER[data]
        starts, ends, first = word_spans(ALNUM[low], offs)
        h = span_hashes(low, starts, ends)
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[k] == h)
        word = self.order[k[at]]
        row = np.searchsorted(first, at, "right") - 1
        n = len(offs) - 1
        kinds = np.zeros((n, self.member.shape[1]), bool)
        kinds[row, word] = True
        have = kinds.astype(np.int32) @ self.member.T.astype(np.int32)
        out = []
        for r in np.flatnonzero((have >= self.need).any(axis=1)).tolist():
            lo, hi = np.searchsorted(row, [r, r + 1])
            here, own = at[lo:hi] - first[r], word[lo:hi]
            finds = []
            every = {int(p): int(w) for p, w in zip(here, own, strict=True)}

            def word_at(p: int, every: dict = every) -> int:
                return every.get(p, -1)

            for t in np.flatnonzero(have[r] >= self.need).tolist():
                template = self.templates[t]
                m = self.member[t][own]
                text = {int(p): int(w) for p, w in zip(here[m], own[m], strict=True)}
                for a, lo, b in stretches(here[m], own[m], self.need[t], 2 * len(template)):
                    words = [text.get(p, -1) for p in range(a, b)]
                    def fits(pairs: list, t: int = t, a: int = a, word_at: Callable = word_at) -> bool:
                        return self.fits(t, [(a + p, q) for p, q in pairs], word_at)

                    for n_words, share, c, d in aligned(words, lo - a, template, self.need[t], self.least[t], fits):
                        finds.append((-n_words, -share, self.names[t], a + c, a + d))
            taken: list[tuple[int, int]] = []
            for _, share, name, a, b in sorted(finds):
                if all(b <= c or d <= a for c, d in taken):
                    taken.append((a, b))
                    out.append((r, name, -share, a, b))
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, finds (license, coverage, start, stop; by start) of every row; ``templates`` is a bounded parameter."""
    bound_batches(docs.sparkSession)
    known = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known, coverage)
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            finds: list[list] = [[] for _ in range(batch.num_rows)]
            for i, j in row_slices(offs):
                for r, name, share, a, b in scanner.rows(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]):
                    finds[i + r].append({"license": name, "coverage": share, "start": a, "stop": b})
            for x in finds:
                x.sort(key=lambda f: f["start"])
            kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()),
                                       ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(finds, kind)], names=["doc_id", "finds"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "doc_id long, finds array<struct<license:string,coverage:double,start:long,stop:long>>")


def licensed(found: DataFrame) -> DataFrame:
    """doc_id, n_finds, licenses (sorted names, comma-joined), coverage (the best, null without a find)."""
    names = F.array_sort(F.array_distinct(F.col("finds.license")))
    return found.select("doc_id", F.size("finds").cast("long").alias("n_finds"),
                        F.array_join(names, ",").alias("licenses"), F.array_max(F.col("finds.coverage")).alias("coverage"))
