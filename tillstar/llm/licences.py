"""Licence scan by matching statistics on a generalised suffix automaton of licence tokens."""

from __future__ import annotations

from importlib import resources
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.common import alnum_words, annotate, memory, runs_of

#: Phrases of the base and their labels (fixed values of the contract).
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Well-known licence notices, openings and short texts, by label. Those of Creative Commons are
#: made below and long texts read from `licence_texts`; together they are the method's templates.
TEMPLATES = {
    "agpl": [
        "GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0", "Apache-2.0", "Apache Software License",
        "Apache License 2.0", "under the Apache License",
    ],
    "artistic": ["the Artistic License", "Artistic License 2.0"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "This software is provided by the copyright holders and contributors \"as is\" and any "
        "express or implied warranties",
        "Released under the BSD License", "under the BSD License",
        *[f"{kind} BSD License" for kind in ("New", "Modified", "Simplified", "Revised")],
        *[f"BSD {n}{mark}Clause" for n in (2, 3, 4) for mark in " -"],
        "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "boost": ["Boost Software License", "SPDX-License-Identifier: BSL-1.0"],
    "cc-by": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0",
    ],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc0": [
        "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0",
        "creativecommons.org/publicdomain/zero", "under the CC0 license", "licensed under CC0",
        "released under CC0", "SPDX-License-Identifier: CC0-1.0",
    ],
    "epl": [
        "Eclipse Public License",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License",
        "SPDX-License-Identifier: EPL-1.0", "SPDX-License-Identifier: EPL-2.0",
    ],
    "gfdl": ["GNU Free Documentation License"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this "
        "program",
        "SPDX-License-Identifier: GPL-2.0", "SPDX-License-Identifier: GPL-3.0",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. The software is provided \"as is\" and the "
        "author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness. In no event shall the author be liable for "
        "any special, direct, indirect, or consequential damages or any damages whatsoever "
        "resulting from loss of use, data or profits, whether in an action of contract, "
        "negligence or other tortious action, arising out of or in connection with the use or "
        "performance of this software.",
        "the ISC License", "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "GNU Lesser General Public License", "GNU Library General Public License",
        "SPDX-License-Identifier: LGPL-2.1", "SPDX-License-Identifier: LGPL-3.0",
    ],
    "mit": [
        "Released under the MIT License", "under the MIT License", "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. The software is provided \"as is\", "
        "without warranty of any kind, express or implied, including but not limited to the "
        "warranties of merchantability, fitness for a particular purpose and noninfringement. In "
        "no event shall the authors or copyright holders be liable for any claim, damages or "
        "other liability, whether in an action of contract, tort or otherwise, arising from, out "
        "of or in connection with the software or the use or other dealings in the software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "MPL-2.0", "MPL-1.1", "Mozilla Public License", "mozilla.org/MPL", "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "proprietary": ["All rights reserved"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "released under the Unlicense", "licensed under the Unlicense",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "the zlib License", "zlib/libpng License", "SPDX-License-Identifier: Zlib",
        "The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software",
    ],
}
#: How the parts of Creative Commons licences are spelled, and the kind that goes with a version.
PARTS = {
    "by": ["Attribution"], "sa": ["ShareAlike", "Share Alike"],
    "nc": ["NonCommercial", "Non Commercial"],
    "nd": ["NoDerivatives", "NoDerivs", "No Derivatives", "No Derivs", "No Derivative Works"],
}
VERSIONS = {
    "1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported",
    "4.0": "International",
}
for _parts in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
    _own = TEMPLATES.setdefault(f"cc-{_parts}", [])
    _own += [f"{way} under CC {_parts}" for way in ("Licensed", "Released", "Available")]
    _own += [f"creativecommons.org/licenses/{_parts}", f"licensed under a CC {_parts}"]
    _own += [f"CC {_parts} {v}" for v in VERSIONS]
    if _parts != "by":
        _own.append(f"CC {_parts}")
    for _name in map(" ".join, product(*[PARTS[p] for p in _parts.split("-")])):
        _own.append(f"Creative Commons {_name}")
        for _v, _kind in VERSIONS.items():
            _own += [f"Creative Commons {_name} {_v} {_kind}", f"{_name} {_v} {_kind}"]
for _kind, _versions in {"gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("3.0",)}.items():
    for _v in _versions:
        TEMPLATES[_kind] += [f"{_kind}-{_v}{_tail}" for _tail in ("", "-only", "-or-later")]
    for _v in sorted({v[0] for v in _versions}):
        TEMPLATES[_kind] += [f"GNU {_kind} v{_v}", f"GNU {_kind} version {_v}", f"{_kind} version {_v}"]
#: Words that tell licences of like texts apart: a template that has one must find it, and a
#: text that has one of the rarer ones isn't one of a template without it.
TELLING = "by attribution library".split()
RARE = (
    "lesser affero sa sharealike nc noncommercial nd noderivatives noderivs lgpl agpl".split()
)
for _file in sorted(resources.files(__package__).joinpath("licence_texts").iterdir(), key=str):
    if _file.name.endswith(".txt"):  # label--version.txt
        TEMPLATES.setdefault(_file.name.split("--")[0], []).append(_file.read_text("utf-8"))
#: Matches shorter than this say nothing, words that a chain may skip, and the share of a
#: template, or else the words of it, that a chain must cover for its label.
LEAST, GAP, COVER, LONG = 3, 3, 0.8, 30


class Automaton:
    """Generalised suffix automaton of token sequences; each state knows where it ends."""

    def __init__(self, sequences: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        last_states = []
        for number, tokens in enumerate(sequences):
            last = 0
            for at, token in enumerate(tokens):
                last = self._extend(last, token)
                self.ends[last].add((number, at + 1))
            last_states.append(last)
        #: sequences that end a state whole, and the nearest state up the links that has any
        self.whole: dict[int, list[int]] = {}
        for number, state in enumerate(last_states):
            self.whole.setdefault(state, []).append(number)
        self.above = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=lambda s: self.length[s]):
            link = self.link[state]
            self.above[state] = link if link in self.whole else self.above[link]
        self.size = [len(tokens) for tokens in sequences]
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, token: int) -> int:
        """The state that p reaches by token, as one of length one more than p's."""
        q = self.step[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(token) == q:
            self.step[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.step[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.step[p]:
            self.step[p][token] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, token)
        return new

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of the matching statistics that can't grow to the right."""
        state = length = 0
        found = []
        for at, token in enumerate(tokens):
            if length >= least and token not in self.step[state]:
                found.append((at, length, state))
            while state and token not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.step[state]:
                state, length = self.step[state][token], length + 1
            else:
                state = length = 0
        if length >= least:
            found.append((len(tokens), length, state))
        return found


    def wholes(self, tokens: list[int]) -> list[tuple[int, int]]:
        """(end, sequence) of all places of whole sequences."""
        state = length = 0
        found = []
        for at, token in enumerate(tokens, 1):
            while state and token not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if token not in self.step[state]:
                state = length = 0
                continue
            state, length = self.step[state][token], length + 1
            own = state
            while own:
                for number in self.whole.get(own, ()):
                    if self.size[number] <= length:
                        found.append((at, number))
                own = self.above[own]
        return found


class Scanner:
    def __init__(self, templates: dict[str, list[str]], base: dict[str, str]):
        self.ids: dict[bytes, int] = {}

        def numbered(text):
            return [self.ids.setdefault(w, len(self.ids)) for w in alnum_words(text)]

        every = [(label, text) for label in sorted(templates) for text in templates[label]]
        long = [COVER * len(alnum_words(text)) >= LONG for _, text in every]
        self.base = {tuple(numbered(phrase)): label for phrase, label in base.items()}
        self.rare = {numbered(word)[0] for word in RARE}
        self.telling = self.rare | {numbered(word)[0] for word in TELLING}
        # notices have an automaton of their own: a longer match in a text must not hide theirs
        self.groups = []
        for kind in (False, True):
            own = [pair for pair, is_long in zip(every, long, strict=True) if is_long == kind]
            sequences = [numbered(text) for _, text in own]
            if sequences:
                least = min(LEAST, *map(len, sequences))
                known = len(self.ids)
                self.groups.append(
                    (kind, least, known, [label for label, _ in own], sequences,
                     Automaton(sequences))
                )

    def scan(self, words: list[bytes]):
        """Places of base phrases with labels, and the covered spans (start, end, label, share,
        words covered).

        A word that no template or phrase has parts all matches, so that only runs of known words
        are looked at. Of templates of fewer than LONG / COVER words all chains are given, of
        longer ones those that may cover LONG words.
        """
        ids = self.ids
        known = np.fromiter((ids.get(w, -1) for w in words), np.int32, len(words))
        places, spans = [], []
        for phrase, label in self.base.items():
            last = len(known) - len(phrase) + 1
            if last > 0:
                here = known[:last] == phrase[0]
                for shift, word in enumerate(phrase[1:], 1):
                    here &= known[shift : last + shift] == word
                places += [(i, label) for i in np.flatnonzero(here).tolist()]
        for long, least, count, labels, sequences, automaton in self.groups:
            hits: dict[int, set] = {}
            inside = (known >= 0) & (known < count)
            found = []
            for first, end in zip(*runs_of(inside, least), strict=True):
                tokens, first = known[first:end].tolist(), int(first)
                found += [(first + at, n, s) for at, n, s in automaton.matches(tokens, least)]
                for at, number in [] if long else automaton.wholes(tokens):
                    size = len(sequences[number])
                    hits.setdefault(number, set()).add((first + at - size, first + at, 0, size))
            for at, length, state in clusters(found) if long else found:
                for number, stop in automaton.ends[state]:
                    span = (at - length, at, stop - length, stop)
                    hits.setdefault(number, set()).add(span)
            for number, some in sorted(hits.items()):
                for start, end, covered, low, high in placed_chains(sorted(some)):
                    sequence = sequences[number]
                    share = covered / len(sequence)
                    if share < COVER or not long:
                        here = set(known[start:end].tolist())
                        there = set(sequence[low:high]) if long else set(sequence)
                        wanted = self.rare if long else self.telling
                        if not (here & self.rare <= there and there & wanted <= here):
                            share, covered = 0.0, 0  # another licence of a like text
                    spans.append((start, end, labels[number], share, covered))
        return sorted(places), spans


def clusters(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches (end, length, state) among neighbours that could cover LONG words in one chain."""
    kept, some, reach = [], [], 0
    for match in [*sorted(found, key=lambda m: m[0] - m[1]), None]:
        if match is None or match[0] - match[1] > reach + GAP:
            if sum(m[1] for m in some) >= LONG:
                kept += some
            some, reach = [], 0
        if match is not None:
            some.append(match)
            reach = max(reach, match[0])
    return kept


def labelled(spans: list[tuple[int, int, str, float, int]]) -> list[tuple]:
    """Spans that give their label: by share or by words.

    One gives way to a span that covers more words, or as many of a shorter template, and holds
    half of it or more: a notice quoted in a licence, or `CC BY` in `CC BY-SA`. Of one label, the
    first of equal ones stays.
    """
    spans = [s for s in spans if s[3] >= COVER or s[4] >= LONG]
    kept: list[tuple] = []
    for span in sorted(spans, key=lambda s: (-s[4], -s[3], s)):
        start, end, label, share, covered = span
        for other in kept:
            over = min(end, other[1]) - max(start, other[0])
            above = (other[4], other[3]) > (covered, share) or other[2] == label
            if above and 2 * over >= end - start:
                break
        else:
            kept.append(span)
    return sorted(kept)


def chains(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, template words covered) of the chains of matches."""
    return [chain[:3] for chain in placed_chains(matches)]


def placed_chains(
    matches: list[tuple[int, int, int, int]],
) -> list[tuple[int, int, int, int, int]]:
    """Matches (start, end, template start, template end) joined in order of both texts.

    Matches come in order of start. One continues a chain if it begins at the chain's end or at
    most GAP words after it, in both texts; of several, the one that covers most, then the latest.
    Gives (start, end, template words covered, template start, template end).
    """
    out: list[list[int]] = []  # start, end, template end, covered, number, template start
    ending: dict[int, list[list[int]]] = {}  # chains by template end
    for start, end, low, high in matches:
        best = None
        for at in range(low - GAP, low + 1):
            if at in ending:
                ending[at] = [c for c in ending[at] if start - c[1] <= GAP]
                for chain in ending[at]:
                    if chain[1] <= start and (best is None or chain[3:5] > best[3:5]):
                        best = chain
        if best is not None:
            ending[best[2]] = [c for c in ending[best[2]] if c is not best]
            best[1], best[2], best[3] = end, high, best[3] + high - low
        else:
            best = [start, end, high, high - low, len(out), low]
            out.append(best)
        ending.setdefault(high, []).append(best)
    return [(c[0], c[1], c[3], c[5], c[2]) for c in out]


_scanners: dict[str, Scanner] = memory(__name__)


def found(texts, templates, base, with_spans):
    key = repr((templates, base))
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(templates, base)
    scanner, rows, spans = _scanners[key], [], []
    for text in texts:
        words = alnum_words(text)
        places, covered = scanner.scan(words)
        basic = sorted({label for _, label in places})
        kept = labelled(covered)
        more = {label for _, _, label, _, _ in kept}
        rows.append((
            len(words), len(places),
            places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(basic), ",".join(sorted({*basic, *more})),
            min(1.0, max((share for *_, share, _ in covered), default=0.0)),
        ))
        spans.append([
            {"start": s, "end": e, "label": label, "share": share}
            for s, e, label, share, _ in kept
        ])
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    if with_spans:
        kind = {"start": pa.int64(), "end": pa.int64(), "label": pa.string(), "share": pa.float64()}
        made.append(pa.array(spans, pa.list_(pa.struct(list(kind.items())))))
    return made


def licences(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    templates: dict[str, list[str]] = TEMPLATES,
    base: dict[str, str] = BASE,
    with_spans: bool = True,
) -> DataFrame:
    r"""Find licence phrases and templates in every whole text.

    Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` with A-Z in lower case, counted from 0. Adds
    n_words; n_base, first_word, last_word and base_labels for the places of base phrases;
    labels, which also has the templates of which a chain of long matches covers 80 % or LONG
    words; score, the largest share of a template that a chain covers (of a template of more than
    LONG / COVER words, by LONG words where its matches allow them); and spans (start, end, label,
    share). A span gives way to one that covers more words and holds half of it.

    Without a place, first_word and last_word are null and the labels empty strings. A null or
    empty text has no words. Places that overlap all count. Repeated rows are scanned each
    alone; an empty table stays empty. Input columns named like a new column give way to it.
    """
    fields = (
        "n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    span = "struct<start: long, end: long, label: string, share: double>"
    fields += f", spans array<{span}>" * with_spans
    return annotate(df, text, keep, fields, found, templates, base, with_spans)
