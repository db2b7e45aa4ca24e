"""License scans by patience alignment of text stretches with licence templates.

Words that are unique in both the stretch and the template are anchors; the longest increasing subsequence of their
positions is kept, and the gaps between anchors are aligned in the same way, after matching equal words at their ends.
Coverage is the share of the template's words that are aligned.

Only stretches that can reach the wished coverage are aligned: a stretch of twice the template's length, laid at every
template length, or one of the template's length laid where one of its rare words stands, must hold enough of the
template's words; the second kind holds one copy of a notice that stands back to back with others. Documents are read in
one pass without a shuffle.

Notices of different licences differ in one or two words, so coverage is not enough: the words that name a licence and its
version (``REQUIRED``) must be aligned, and words that make it another one of its family (``FOREIGN``) must not lie within.
Versions are compared without ``.0`` and ``v``. A text that a longer text begins with (``PART_OF``) gives way to it.

Defined results: NULL and empty texts hold no licence; every stretch that covers a template is reported, overlapping ones
of one template as the best (then the first) of them; repeated rows are reported each.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE = 80

# Notices as their licences are commonly cited.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                    "the following conditions are met",
}

#: Words of a template that must be aligned, and words that must not lie in its stretch.
REQUIRED: dict[str, tuple[str, ...]] = {"MIT": ("mit",), "MIT-text": (), "Apache-2.0": ("apache", "2"), "Apache-2.0-header": ("apache", "2")}
FOREIGN: dict[str, tuple[str, ...]] = {}
PART_OF = {"BSD-2-Clause": ("BSD-3-Clause-text", "BSD-4-Clause-text")}


def _add(name: str, text: str, required: str, foreign: str = "") -> None:
    TEMPLATES.setdefault(name, text)
    REQUIRED[name], FOREIGN[name] = tuple(required.split()), tuple(foreign.split())


_CC = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
for _kind in ("by", "by nc", "by nc nd", "by nc sa", "by nd", "by sa"):
    _short, _other = _kind.replace(" ", "-").upper(), [k for k in _CC if k not in _kind.split()]
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _n = _v.removesuffix(".0")
        _add(f"CC-{_short}-{_v}", f"Licensed under CC {_short} {_v}.", f"cc {_kind} {_n}", " ".join(_other))
        _long = [_CC[k] for k in _kind.split()]
        _add(f"CC-{_short}-{_v}-name", f"This work is licensed under a Creative Commons {'-'.join(_long)} {_v} International License.",
             f"creative commons {' '.join(_long).lower()} {_n}", " ".join(_CC[k].lower() for k in _other))
_add("CC0-1.0", "Released under the CC0 1.0 Universal license.", "cc0 1")
_add("CC0-1.0-text", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE "
                     "LEGAL SERVICES.", "cc0 1")
for _code, _name, _versions in (("GPL", "", "1 2 3"), ("LGPL", "Lesser ", "2 2.1 3"), ("LGPL", "Library ", "2"), ("AGPL", "Affero ", "1 3")):
    _other = " ".join(w for w in ("lesser", "library", "affero") if w != _name.strip().lower())
    for _v in _versions.split():
        _id = f"{_code}-{_v if '.' in _v else _v + '.0'}" + ("-library" if _name == "Library " else "")
        _must = f"gnu {_name.lower()} general public {_v}"
        _add(_id, f"This work is licensed under the GNU {_name}General Public License, version {_v}.", _must, _other)
        _add(f"{_id}-header", f"it under the terms of the GNU {_name}General Public License as published by the Free Software Foundation; "
                              f"either version {_v} of the License, or (at your option) any later version.", _must, _other)
for _id, _title, _date in (
        ("GPL-1.0", "", "Version 1, February 1989"), ("GPL-2.0", "", "Version 2, June 1991"), ("GPL-3.0", "", "Version 3, 29 June 2007"),
        ("LGPL-2.0", "LIBRARY ", "Version 2, June 1991"), ("LGPL-2.1", "LESSER ", "Version 2.1, February 1999"),
        ("LGPL-3.0", "LESSER ", "Version 3, 29 June 2007"), ("AGPL-3.0", "AFFERO ", "Version 3, 19 November 2007")):
    _add(f"{_id}-text", f"GNU {_title}GENERAL PUBLIC LICENSE {_date} Copyright (C) Free Software Foundation, Inc.",
         f"gnu {_title.lower()} general public {_date.split()[1].strip(',')} {_date.split()[-1]}",
         " ".join(w for w in ("lesser", "library", "affero") if w != _title.strip().lower()))
for _v in ("1.0", "1.1"):
    _add(f"Apache-{_v}", f"Licensed under the Apache License, Version {_v}.", f"apache {_v.removesuffix('.0')}")
_add("Apache-2.0-text", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
                        "AND DISTRIBUTION", "apache 2 2004")
for _v in ("1.0", "1.1", "2.0"):
    _add(f"MPL-{_v}", f"Licensed under the Mozilla Public License, Version {_v}.", f"mozilla public {_v.removesuffix('.0')}")
    _add(f"MPL-{_v}-text", f"Mozilla Public License Version {_v} 1. Definitions", f"mozilla public {_v.removesuffix('.0')} definitions")
_add("MPL-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                       "distributed with this file, You can obtain one at", "mozilla public 2")
_add("BSD", "Released under the BSD License.", "bsd license", "clause")
for _v in "234":
    _add(f"BSD-{_v}-Clause-notice", f"Released under the BSD {_v}-Clause License.", f"bsd {_v} clause")
_add("ISC", "Released under the ISC License.", "isc")
_add("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies.", "fee granted")
_BSD = TEMPLATES["BSD-2-Clause"] + (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. ")
_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission.")
_add("BSD-3-Clause-text", f"{_BSD} 3. {_ENDORSE}", "endorse promote", "advertising")
_add("BSD-4-Clause-text", f"{_BSD} 3. All advertising materials mentioning features or use of this software must display the following "
                          f"acknowledgement: This product includes software developed by the organization. 4. {_ENDORSE}",
     "endorse promote advertising")

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _plain(words: list[str]) -> list[str]:
    """Versions without ``.0`` and ``v``."""
    short = [w[:-2] if w.endswith(".0") else w for w in words]
    return [w[1:] if w[0] == "v" and w[1:2].isdigit() else w for w in short]


def _increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect.bisect_left(tails, v)
        back[i] = ends[k - 1] if k else -1
        tails[k:k + 1], ends[k:k + 1] = [v], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs (position in text, position in template) of the patience alignment, in order."""
    pairs: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if in_text[w] == 1}
        anchors = [(at[w], j) for j, w in enumerate(template[c:d], c) if in_template[w] == 1 and w in at]
        if not anchors:
            continue
        kept = [anchors[i] for i in _increasing([i for i, _ in anchors])]
        pairs.extend(kept)
        edges = [(a - 1, c - 1), *kept, (b, d)]
        work.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]))
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: int):
        self.coverage = coverage
        self.templates = [(name, _plain(words_of(t))) for name, t in templates.items() if words_of(t)]
        own = [templates[name] == TEMPLATES.get(name) for name, _ in self.templates]
        self.required = [set(REQUIRED.get(name, ())) if o else set() for (name, _), o in zip(self.templates, own)]
        self.foreign = [set(FOREIGN.get(name, ())) if o else set() for (name, _), o in zip(self.templates, own)]
        self.bags = [Counter(t) for _, t in self.templates]
        # A stretch that reaches the coverage holds one of any more words of the template than it may miss.
        self.markers = [self._rarest(t) for _, t in self.templates]
        self.any = set().union(*self.markers) if self.markers else set()

    def _rarest(self, template: list[str]) -> set[str]:
        """Words of which a stretch with enough coverage must hold one: longest first, until the rest is too little."""
        chosen: set[str] = set()
        for word in sorted(set(template), key=lambda w: (-len(w), w)):
            if 100 * sum(w in chosen for w in template) > (100 - self.coverage) * len(template):
                break
            chosen.add(word)
        return chosen

    def find(self, text: str | None) -> list[tuple[str, int, int, int]]:
        """(licence, coverage percent, first word, end word) of every covered stretch."""
        words = _plain(words_of(text)) if text else []
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.any:
                places.setdefault(w, []).append(i)
        if not places:
            return []
        out, have = [], set(words)
        for (name, template), bag, markers, required, foreign in zip(
                self.templates, self.bags, self.markers, self.required, self.foreign):
            if not required <= have:
                continue
            size = len(template)
            at = [i for w in markers for i in places.get(w, ())]
            windows = {(max(0, i // size - k) * size, 2 * size) for i in at for k in (0, 1)}
            windows |= {(max(0, i - j), size) for j, w in enumerate(template) if w in markers for i in places.get(w, ())}
            found = []
            for start, width in windows:
                stretch = words[start:start + width]
                held = sum((Counter(stretch) & bag).values())
                if 100 * held < self.coverage * size:
                    continue
                pairs = align(stretch, template)
                if 100 * len(pairs) < self.coverage * size or not required <= {template[j] for _, j in pairs}:
                    continue
                low, high = start + pairs[0][0], start + pairs[-1][0] + 1
                if foreign.isdisjoint(words[low:high]):
                    found.append((-len(pairs), low, high))
            taken: list[tuple[int, int]] = []
            for score, low, high in sorted(found):
                if all(high <= a or low >= b for a, b in taken):
                    taken.append((low, high))
                    out.append((name, 100 * -score // size, low, high))
        return [h for h in out if not any(
            o[0] in PART_OF.get(h[0], ()) and o[2] < h[3] and h[2] < o[3] for o in out)]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
         coverage: int = COVERAGE) -> DataFrame:
    """(key, license, coverage, first_word, end_word) of every stretch that covers a template."""
    chosen = templates or TEMPLATES
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("license", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("coverage", "first_word", "end_word")]])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(chosen, coverage)
        for batch in batches:
            rows = [(k, *hit) for k, t in zip(batch["_key"], batch["_text"]) for hit in scanner.find(t)]
            yield pd.DataFrame(rows, columns=schema.names)

    return docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInPandas(find, schema)
