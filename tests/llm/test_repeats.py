"""Repeated byte strings against a plain index of all windows, and the suffix sort against sorting."""

import hashlib
import random

import numpy as np
import pytest

from shelfspark.llm import queries, repeats
from tests.llm.conftest import EDGE, SF_DIR, prose, same


def expected(rows, length=50):
    least = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w not in least or least[w] is None or doc_id is not None and doc_id < least[w]:
                least[w] = doc_id
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            low = least[data[i : i + length]]
            if low is not None and (doc_id is None or low < doc_id):
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        starts = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), starts, kept))
    return out


def pieced(seed, n):
    """Texts made of passages that others hold as well, changed here and there, and of one-letter runs."""
    r = random.Random(seed)
    stock = [prose(100 + i, 14) for i in range(12)] + ["z" * 260, "ab" * 90, "é" * 70]
    out = []
    for i in range(n):
        text = " ".join(r.choice(stock)[r.randrange(20) :] if r.random() < 0.6 else prose(1000 + 10 * i + j, 9) for j in range(r.randrange(1, 7)))
        for _ in range(r.randrange(3)):
            at = r.randrange(len(text))
            text = text[:at] + r.choice("xyz ") + text[at + r.randrange(2) :]
        out.append((r.choice([i, i, i, None, i % 7]), text))
    return out


@pytest.mark.parametrize("hot", [1, 4096])
def test_awkward_documents(spark, edge, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "CHUNK", 3000)
    monkeypatch.setattr(repeats, "BUCKETS", 2000)
    more = pieced(4, 120)
    docs = edge.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    same(repeats.without_repeats(docs).collect(), expected(EDGE + more))


@pytest.mark.parametrize("length", [1, 7, 8, 20, 64])
def test_other_lengths(spark, length):
    rows = pieced(length, 25)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(repeats.without_repeats(docs, length).collect(), expected(rows, length))


def test_text_ids(spark):
    rows = [(None if d is None else f"d{d:03}", t) for d, t in pieced(9, 30)]
    same(repeats.without_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect(), expected(rows))


def test_empty_table(empty):
    assert repeats.without_repeats(empty).collect() == []


def test_query(spark, small):
    want = [(*r[:-1], hashlib.sha256(r[-1]).hexdigest()) for r in expected(small[1])]
    same(queries.op12_repeated_spans(spark, SF_DIR).collect(), want)


@pytest.mark.parametrize("shallow", [0, 8, 24, 100])
def test_deep_shallow_sorts(shallow):
    r = random.Random(shallow)
    data = "".join(r.choice(["a" * 40, "ab" * 30, "abcde" * 11, "x", "yz", chr(r.randrange(97, 123)) * 3]) for _ in range(80)).encode()
    starts = np.array(r.sample(range(len(data) - 50), 900))
    groups = np.sort(np.array([r.randrange(5) for _ in starts]))
    order, fresh = repeats.deep_shallow(data, starts, groups, 50, shallow)
    key = lambda i: (groups[i], data[starts[i] : starts[i] + 50])
    keys = [key(i) for i in order]
    assert keys == sorted(map(key, range(len(starts)))) and sorted(order) == list(range(len(starts)))
    assert fresh.tolist() == [i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))]


def test_blind_trie():
    r = random.Random(8)
    keys = [r.randrange(1 << r.choice([3, 60, 208])) for _ in range(500)] + [0, 0, 7]
    trie = repeats.BlindTrie()
    for i, k in enumerate(keys):
        trie.insert(k, i)
    classes = [[keys[i] for i in c] for c in trie.classes()]
    assert [c[0] for c in classes] == sorted(set(keys)) and all(len(set(c)) == 1 for c in classes)
    assert list(repeats.BlindTrie().classes()) == []


def test_segments_hold_every_window_once():
    texts = [b"", b"q" * 49, b"q" * 50, b"q" * 5000, prose(3, 400).encode(), b"ab" * 2000]
    found = {}
    for i, _, places in repeats.segments_of(texts, 50):
        for p in places.tolist():
            found.setdefault(i, []).extend(range(p >> repeats.RUN_BITS, (p >> repeats.RUN_BITS) + (p & 127)))
    assert found == {i: list(range(len(t) - 49)) for i, t in enumerate(texts) if len(t) >= 50}
