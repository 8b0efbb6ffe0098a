import re
from collections import Counter

from shelfspark.llm import licenses as L
from shelfspark.llm import queries
from shelfspark.llm.decontamination import words_of
from tests.llm.conftest import EDGE, SF_DIR, prose, same


def agrees(unit, notice):
    """Numbers of a short notice must be in a unit that has numbers; what a unit denies, the notice must deny."""
    plain = lambda words: {w.decode().lstrip("v") for w in words if w.decode().lstrip("v").isdigit()}
    no = lambda words: re.search(r"\bnot (licensed|released|distributed|available|covered)\b", " ".join(w.decode() for w in words))
    if len(notice) <= 41 and plain(unit) and plain(notice) - plain(unit):
        return False
    return not no(unit) or bool(no(notice))


def brute(text, limit=0.8):
    """Every unit against every template, without size bounds."""
    found = set()
    for line, unit in L.units(text or ""):
        a, best = Counter(zip(words_of(unit), words_of(unit)[1:])), None
        for name, notices in sorted(L.TEMPLATES.items()):
            for notice in notices:
                b = Counter(zip(words_of(notice), words_of(notice)[1:]))
                score = 2 * (a & b).total() / max(1, a.total() + b.total())
                if score >= limit and agrees(words_of(unit), words_of(notice)) and (best is None or score > best[2]):
                    best = (line, name, score)
        if best:
            found.add(best)
    return sorted(found)


TEXTS = [
    (1, "Intro.\nLicensed under the Apache License, version 2.0\nmore text"), (2, "Licensed under CC BY-NC 4.0."), (3, "licensed under cc by 4.0"),
    (4, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation files.\n\nX"),
    (5, "Licensed under the\n\nApache License"), (6, None), (7, ""), (8, "Licensed " * 20_000), (9, "Licensed under CC BY-SA 4.0. Licensed under CC BY-SA 4.0."),
]


def test_same_without_pruning(spark, edge, small):
    for rows, frame in ((TEXTS, spark.createDataFrame(TEXTS, "doc_id bigint, text string")), (EDGE, edge), (small[1], small[0])):
        got = [(r.doc_id, [tuple(m) for m in r.matches]) for r in L.license_scan(frame).collect()]
        same(got, [(d, brute(t)) for d, t in rows])


def test_names():
    scanner = L.LicenseScanner(L.TEMPLATES, 0.8)
    assert {m[1] for m in scanner.scan(TEXTS[0][1])} == {"Apache-2.0"}
    assert [m[1] for m in scanner.scan(TEXTS[1][1])] == ["CC-BY-NC-4.0"]
    assert {m[1] for m in scanner.scan(TEXTS[3][1])} == {"MIT"}


def test_query(spark, small, empty):
    got = [(r.doc_id, r.n_matches, r.licenses) for r in queries.op3_license_scan(spark, SF_DIR).collect()]
    same(got, [(d, len(m), ",".join(sorted({x[1] for x in m}))) for d, m in ((d, brute(t)) for d, t in small[1])])
    assert any(n for _, n, _ in got)
    assert L.license_scan(empty).collect() == []


def names(text):
    return {m[1] for m in L.LicenseScanner(L.TEMPLATES, 0.8).scan(text)}


def test_usual_wordings_are_found():
    for line, name in (
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-only"),
        ("Released under the MIT License.", "MIT"), ("This project is licensed under the MIT License", "MIT"),
        ("Licensed under the GNU Affero General Public License v3.0.", "AGPL-3.0-only"), ("Licensed under the BSD 2-Clause License.", "BSD-2-Clause"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1-only"), ("Released under the ISC License.", "ISC"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
    ):
        assert names(f"{prose(3, 90)}\n{line}\n{prose(4, 90)}") == {name}, line
    assert names("\n".join(prose(i, 60) for i in range(50))) == set()


def test_whole_texts_are_found():
    for name, text in L.TEXTS.items():
        assert (0, name) in {m[:2] for m in L.LicenseScanner(L.TEMPLATES, 0.8).scan(f"Copyright (c) 2024 Some One\n\n{text}")}, name
    lines = L.TEXTS["MIT"].split("\n")
    assert names("\n".join([prose(1, 400), "", "Copyright (c) 2024 Some One", "", *lines, "", prose(2, 400)])) == {"MIT"}
    assert names("\n".join([prose(1, 40), *(f"# {x}" for x in lines), prose(2, 20)])) == {"MIT"}


def test_versions_are_told_apart():
    for line, wrong in (
        ("This work is licensed under a Creative Commons Attribution 3.0 International License.", "CC-BY-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under the GNU General Public License, version 1.", "GPL-2.0-only"),
        ("This work is licensed under the GNU General Public License, version 1.", "GPL-3.0-only"),
        ("This project is not licensed under the MIT License.", "MIT"), ("It is not released under the MIT License.", "MIT"),
    ):
        assert wrong not in names(line), line
    assert names("Licensed under the Apache License, Version 2.0") == {"Apache-2.0"}


def test_size_bounds_leave_out_templates_but_no_match():
    scanner = L.LicenseScanner(L.TEMPLATES, 0.8)
    line = "This work is licensed under the GNU General Public License, version 3."
    assert names(line) == {"GPL-3.0-only"}
    scanner.scan(line)
    assert scanner.pruned > len(scanner.sizes) / 2
    for n in range(1, 3000, 7):
        first, last = scanner.candidates(n)
        outside = scanner.sizes[:first] + scanner.sizes[last:]
        assert all(2 * min(n, size) / (n + size) < 0.8 for size in outside)
