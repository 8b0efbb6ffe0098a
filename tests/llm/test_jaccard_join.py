import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import jaccard_join as J
from shelfspark.llm import queries
from shelfspark.llm.components import components
from tests.llm.conftest import EDGE, SF_DIR, prose, same


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n, num, den):
    sets = [grams(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and root(i) != root(j):
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    firsts = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            firsts[root(i)] = min(d, firsts.get(root(i), d))
    return [(d, len(sets[i]), d if not sets[i] else firsts.get(root(i))) for i, (d, _) in enumerate(rows)]


def edited(text, n, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        at = r.randrange(len(words))
        words[at : at + 1] = r.choice([[], [words[at], "new"], [f"other{seed}"]])
    return " ".join(words)


def family(size=60):
    """Copies of a few texts with more and more changes, so that chains and near misses occur, between unrelated texts."""
    rows = []
    for base, n in ((1, 250), (2, 90), (3, 30), (4, 12)):
        text = prose(base, n)
        for k in range(size // 4):
            text = edited(text, 1, k) if k % 3 else text
            rows.append((len(rows) * 7 % 1000 + 1, edited(text, k % 6, k)))
    return rows + [(2000 + k, prose(100 + k, 40)) for k in range(20)]


@pytest.mark.parametrize(("n", "num", "den"), [(3, 90, 100), (5, 80, 100), (2, 70, 100)])
def test_same_as_brute_force(spark, edge, n, num, den):
    rows = family()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for got, want in ((J.jaccard_join(frame, n, num, den), brute(rows, n, num, den)), (J.jaccard_join(edge, n, num, den), brute(EDGE, n, num, den))):
        same([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], want)


def test_blocks_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "PROBES", 3)
    rows = family(80)
    got = J.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90, 100).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got], brute(rows, 3, 90, 100))


def test_query_on_driver_tables(spark, small):
    found = queries.op8_jaccard_join(spark, SF_DIR).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in found], brute(small[1], 3, 90, 100))
    assert sorted((True, r.doc_id, r.n_links) for r in found) == degrees(small[1], 3, 90, 100)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.sampled_from([(90, 100), (80, 100)]))
def test_linked_sets_share_an_entry_that_neither_may_spare(seed, size, limit):
    """The pigeonhole rule with the costliest subsets dropped, for any costs."""
    num, den = limit
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
    allowed = int((2 * len(a)) * (den - num) / (den + num)) + 1
    gone, new = r.integers(0, allowed + 1), r.integers(0, allowed + 1)
    b = np.unique(np.concatenate([r.permutation(a)[: max(1, len(a) - gone)], r.integers(0, 2**63, new, dtype=np.uint64)]))
    if not J.linked(a, b, num, den) or (len(a) == len(b) and (a == b).all()):
        return
    bands = J.Bands(num, den)
    sig_a, sig_b = (set(bands.signatures(x).tolist()) for x in (a, b))
    cost = lambda s: (-(hash((s, seed)) % 50), s)

    def kept(mine, shared):
        out = set()
        for g in {s >> 1 & 0xFF for s in mine}:
            plain = sorted((s for s in mine & shared if s >> 1 & 0xFF == g and not s & 1), key=cost)
            out |= set(plain[bands.spared[g] :]) | {s for s in mine if s & 1 and s >> 1 & 0xFF == g}
        return out

    # At worst everything of a set is shared with others.
    assert kept(sig_a, sig_a) & kept(sig_b, sig_b)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 175)]
    got = dict(components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 175: 150, 200: 150}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_empty(empty):
    assert J.jaccard_join(empty).collect() == []


def degrees(rows, n, num, den):
    """Number of other rows each row is linked with."""
    sets = [(d, J.Shingler(n).tokens(t or "")) for d, t in rows]
    return sorted((d is not None, d or 0, sum(
        1 for j, (_, b) in enumerate(sets) if j != i and len(a) and len(b) and J.linked(a, b, num, den))) for i, (d, a) in enumerate(sets))


@pytest.mark.parametrize("counted", [500, 2_000_000])
def test_links_of_every_row_are_counted(spark, edge, monkeypatch, counted):
    monkeypatch.setattr(J, "COUNTED", counted)
    rows = family(60) + [(9000 + i, " ".join(f"w{k}" for k in range(200) if k != i)) for i in range(6)]
    rows += rows[:5] + [(None, rows[3][1])]
    for frame, plain in ((spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), rows), (edge, EDGE)):
        got = J.jaccard_join(frame, 3, 90, 100).collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_links) for r in got) == degrees(plain, 3, 90, 100)


def test_rows_without_id_fetch_their_own_text_only(spark):
    rows = [(None, prose(i, 40) + (f" tail{i}" if i % 2 else "")) for i in range(700)] + [(None, prose(i, 40)) for i in range(1, 700, 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = J.shingled(frame, 5, 80, 100)
    sets = J.sets_of(frame, plain, plain.select("cls").distinct(), 5)
    assert sets.count() == sets.select("cls").distinct().count() == len({t for _, t in rows})
    assert J.jaccard_join(frame, 5, 80, 100).count() == len(rows)
