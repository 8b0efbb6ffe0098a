"""Licence texts in documents, by Dice coefficient over word bigrams.

The units of a document are its lines, its paragraphs (between blank lines, where they have several lines) and the whole.
Unit and template are normalised: small letters, only letters and digits, single blanks. The coefficient is ``2 common / (a + b)``
over multisets of adjacent word pairs. At a limit ``t`` the smaller side must have at least ``t / (2 - t)`` of the larger
one's pairs; units beyond these bounds of all templates are left out, the others look up their pairs in an index of the
templates' pairs. Templates are the usual wordings of notices, titles and, from ``license_texts``, whole licence texts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame

from shelfspark.llm.common import id_type, map_rows, texts_of
from shelfspark.llm.decontamination import words_of

#: Whole licence texts, one file each, named by SPDX id; read where the job is made, and sent to tasks with it.
TEXTS = {f.stem: f.read_text(encoding="utf-8") for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def gnu(name: str, version: str, only: str, later: str) -> dict[str, tuple[str, ...]]:
    """Wordings for one version of a GNU licence."""
    short = "".join(w[0] for w in name.split())
    v = version.removesuffix(".0")
    sentence = (
        "you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, "
        "either version {} of the License, or (at your option) any later version.")
    return {
        only: (
            f"This work is licensed under the {name}, version {v}.", f"Licensed under the {name}, version {v}.", f"Licensed under the {name} v{version}.",
            f"Released under the {name}, version {v}.", f"Licensed under the {short} version {v}.", f"Licensed under the {short} v{v}.",
            f"This program is licensed under the terms of the {name} version {v}.", f"SPDX-License-Identifier: {only}"),
        later: (
            f"This program is free software: {sentence.format(name, v)}", f"This program is free software; {sentence.format(name, version)}",
            f"This library is free software; {sentence.format(name, version)}", f"Licensed under the {name}, version {v} or later.",
            f"This work is licensed under the {name}, version {v} or any later version.", f"SPDX-License-Identifier: {later}"),
    }


def named(name: str, spdx: str) -> tuple[str, ...]:
    """The usual one-sentence wordings that give a licence by its name."""
    return (
        f"Licensed under the {name}.", f"Released under the {name}.", f"This work is licensed under the {name}.", f"This project is licensed under the {name}.",
        f"Distributed under the {name}.", f"This software is released under the {name}.", f"SPDX-License-Identifier: {spdx}")


def creative(kind: str, name: str, version: str) -> tuple[str, ...]:
    long = f"Creative Commons {name} {version} International License"
    return (
        f"Licensed under CC {kind} {version}.", f"This work is licensed under CC {kind} {version}.", f"This work is licensed under a {long}.",
        f"This work is licensed under the {long}.", f"Licensed under the {long}.",
        f"This work is licensed under a {long}. To view a copy of this license, visit https://creativecommons.org/licenses/{kind.lower()}/{version}/.",
        f"SPDX-License-Identifier: CC-{kind}-{version}")


# Notices by which public licences are named in files, by SPDX id.
NOTICES = {
    "Apache-2.0": (
        *named("Apache License, Version 2.0", "Apache-2.0"), *named("Apache 2.0 License", "Apache-2.0"),
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "MIT": (
        *named("MIT License", "MIT"), "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    ),
    "ISC": named("ISC License", "ISC"),
    "Zlib": named("zlib License", "Zlib"),
    "0BSD": named("Zero-Clause BSD License", "0BSD"),
    "BSL-1.0": (*named("Boost Software License, Version 1.0", "BSL-1.0"), "Boost Software License - Version 1.0 - August 17th, 2003"),
    "Unlicense": (*named("Unlicense", "Unlicense"), "This is free and unencumbered software released into the public domain."),
    "BSD-2-Clause": (*named("BSD 2-Clause License", "BSD-2-Clause"), *named("Simplified BSD License", "BSD-2-Clause")),
    "BSD-3-Clause": (
        *named("BSD 3-Clause License", "BSD-3-Clause"), *named("New BSD License", "BSD-3-Clause"),
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    **gnu("GNU General Public License", "2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    **gnu("GNU General Public License", "3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    **gnu("GNU Lesser General Public License", "2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    **gnu("GNU Lesser General Public License", "3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    **gnu("GNU Affero General Public License", "3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "AGPL-3.0": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",),
    "GPL-2.0": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "GPL-3.0": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "LGPL-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",),
    "LGPL-3.0": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "MPL-2.0": (
        *named("Mozilla Public License 2.0", "MPL-2.0"), *named("Mozilla Public License, Version 2.0", "MPL-2.0"), "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0": (*named("Eclipse Public License 2.0", "EPL-2.0"), *named("Eclipse Public License, Version 2.0", "EPL-2.0")),
    "CC-BY-4.0": creative("BY", "Attribution", "4.0"),
    "CC-BY-SA-4.0": creative("BY-SA", "Attribution-ShareAlike", "4.0"),
    "CC-BY-NC-4.0": creative("BY-NC", "Attribution-NonCommercial", "4.0"),
    "CC-BY-ND-4.0": creative("BY-ND", "Attribution-NoDerivatives", "4.0"),
    "CC-BY-NC-SA-4.0": creative("BY-NC-SA", "Attribution-NonCommercial-ShareAlike", "4.0"),
    "CC-BY-NC-ND-4.0": creative("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives", "4.0"),
    "CC0-1.0": (
        "Released under CC0 1.0.", "Licensed under CC0 1.0.", "This work is licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.", "SPDX-License-Identifier: CC0-1.0"),
}
#: Licences whose first paragraph tells them from others, for copies inside longer texts.
OPENINGS = ("MIT", "ISC", "Unlicense", "BSL-1.0")


def opening(text: str) -> str:
    """The first paragraph of a text that is no title or copyright line."""
    return next(p for p in text.split("\n\n") if len(words_of(p)) > 20)


TEMPLATES = {
    name: (*dict.fromkeys(NOTICES.get(name, ())), *([opening(TEXTS[name])] if name in OPENINGS else []), *([TEXTS[name]] if name in TEXTS else []))
    for name in sorted({*NOTICES, *TEXTS})
}


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:]))


def units(text: str) -> list[tuple[int, str]]:
    """(first line, text) of each line, of each paragraph of several lines, and of the whole of several lines."""
    lines, out, block = text.split("\n"), [], []
    for i, line in enumerate([*lines, ""]):
        if line.strip():
            out.append((i, line))
            block.append(line)
        else:
            if len(block) > 1:
                out.append((i - len(block), "\n".join(block)))
            block = []
    if len(out) > 1 and not (len(out) - 1 == len(lines) and out[-1][0] == 0):
        out.append((0, text))
    return out


#: Notices up to so many word pairs are told apart by their numbers: one pair more or less hardly changes the coefficient.
NOTICE = 40
_DENIED = (b"licensed", b"released", b"distributed", b"available", b"covered")


def numbers(words: list[bytes]) -> set[bytes]:
    """Version numbers and other words of digits, without a leading ``v``."""
    return {w.lstrip(b"v") for w in words if w.lstrip(b"v").isdigit()}


def denied(words: list[bytes]) -> bool:
    return any(a == b"not" and b in _DENIED for a, b in zip(words, words[1:]))


class LicenseScanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], limit: float):
        self.limit = limit
        made = [(name, words_of(t)) for name, texts in sorted(templates.items()) for t in texts]
        made = [(bigrams(w).total(), name, w) for name, w in made if len(w) > 1]
        # By size: the templates that a unit of n pairs may reach the limit with are neighbours.
        made.sort(key=lambda m: m[:2])
        self.sizes = [n for n, _, _ in made]
        self.names = [name for _, name, _ in made]
        self.numbers = [numbers(w) if n <= NOTICE else set() for n, _, w in made]
        self.denied = [denied(w) for _, _, w in made]
        self.least = limit / (2 - limit)
        self.small = min(self.sizes, default=1) * self.least
        self.large = max(self.sizes, default=0) / self.least
        self.pruned = 0
        self.holders: dict[tuple[bytes, bytes], tuple[list[int], list[int]]] = {}
        for t, (_, _, words) in enumerate(made):
            for pair, times in bigrams(words).items():
                own, counts = self.holders.setdefault(pair, ([], []))
                own.append(t)
                counts.append(times)

    def candidates(self, n: int) -> tuple[int, int]:
        """Templates whose size lets a unit of ``n`` pairs reach the limit, as a range: both sizes sum to 2 * common / limit, and
        no more than the smaller one is common."""
        return bisect_left(self.sizes, n * self.least * 0.999), bisect_right(self.sizes, n / self.least * 1.001)

    def scan(self, text: str) -> list[tuple[int, str, float]]:
        """(first line, licence, coefficient) of each unit's best template at or over the limit."""
        found = set()
        for line, unit in units(text):
            words = words_of(unit)
            n = len(words) - 1
            if not self.small <= n <= self.large:
                continue
            pairs = bigrams(words)
            # Pairs in common with each template, from the pairs of the unit that any template holds. At the limit these are
            # at least ``least`` of the unit's own.
            shared = pairs.keys() & self.holders.keys()
            if sum(pairs[p] for p in shared) < self.least * n * 0.999:
                continue
            first, last = self.candidates(n)
            self.pruned += len(self.sizes) - (last - first)
            common: Counter = Counter()
            for pair in shared:
                times = pairs[pair]
                own, counts = self.holders[pair]
                for k in range(bisect_left(own, first), bisect_left(own, last)):
                    common[own[k]] += min(times, counts[k])
            digits, is_denied = numbers(words), denied(words)
            best = None
            for t in sorted(common, key=lambda t: (self.names[t], t)):
                score = 2 * common[t] / (n + self.sizes[t])
                # A notice of another version, or one that is denied, is not that licence, however alike.
                if score < self.limit or digits and not self.numbers[t] <= digits or is_denied and not self.denied[t]:
                    continue
                if best is None or score > best[2]:
                    best = (line, self.names[t], score)
            if best:
                found.add(best)
        return sorted(found)


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, limit: float = 0.8) -> DataFrame:
    """Per row: ``doc_id, licenses`` (sorted names, each once), ``best`` (largest coefficient, 0 without) and ``matches``.

    ``matches`` lists (line, license, score). Equal scores of several templates go to the first name. Null and empty texts
    match nothing; every row of ``docs`` gives one row.
    """
    chosen = TEMPLATES if templates is None else templates

    def rows(batches):
        scanner = LicenseScanner(chosen, limit)
        for b in batches:
            found = [scanner.scan(t) for t in b["text"]]
            yield {
                "doc_id": b["doc_id"], "licenses": [sorted({m[1] for m in f}) for f in found],
                "best": [max((m[2] for m in f), default=0.0) for f in found],
                "matches": [[{"line": a, "license": n, "score": s} for a, n, s in f] for f in found],
            }

    schema = f"doc_id {id_type(docs)}, licenses array<string>, best double, matches array<struct<line:bigint,license:string,score:double>>"
    return map_rows(texts_of(docs), rows, schema)
