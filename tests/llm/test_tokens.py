"""Token counts, binary output, packing and the word-wise encoder."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfspark.llm import counts, packing, planes, queries
from shelfspark.llm.encoding import WordEncoder
from shelfspark.session import work_path
from tests.llm.conftest import EDGE, SF_DIR, same

WORD = queries.tokenizer_path(queries.WORD_BPE)
PIECE = queries.tokenizer_path(queries.PIECE_BPE)


def library_ids(texts, path=WORD):
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array(e.ids, dtype="<u4") for e in encoded]


def test_word_encoder_is_the_library():
    r = random.Random(3)
    parts = [*"abcDEFé'.,!<|> \n\t\x0b\x1c\x85　́Σσςİıß漢字😀0123²½_-", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "ll ", "don't", "​", "\x00"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(4000)] + ["x" * 500 + ". y", "word, " * 50]
    encoder = WordEncoder(WORD, limit=300)
    for i in range(0, len(texts), 50):
        assert encoder.encode(texts[i : i + 50]) == [a.tobytes() for a in library_ids(texts[i : i + 50])]


def test_whole_text_encoder():
    path = queries.tokenizer_path(queries.BYTE_BPE)
    assert WordEncoder(path).encode(["a b  c"]) == [library_ids(["a b  c"], path)[0].tobytes()]


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    for ids in ([], [0], [1, 2**32 - 1, 5], list(range(1000)), [49407] * 777):
        a = np.array(ids, dtype="<u4")
        data, starts, used = planes.pack_chunk(a, 100, unit, 3)
        assert (planes.unpack_chunk(data, starts, used, len(a), 100, unit) == a).all()


def in_order(rows):
    out, at = [], 0
    rows = sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0]))
    for (_, (doc_id, _)), ids in zip(rows, library_ids([t for _, (_, t) in rows])):
        coded = ids.tobytes() + np.array([2], "<u4").tobytes()
        out.append((doc_id, at, len(ids) + 1, zlib.crc32(coded)))
        at += len(ids) + 1
    return out


def test_binary_output_query(spark, small):
    same(queries.op6_binary_output(spark, SF_DIR).collect(), in_order(small[1]))


@pytest.mark.parametrize("options", [{}, {"block": 64, "chunk_ids": 500, "unit": "bit"}])
def test_binary_output_of_awkward_rows(spark, edge, options):
    got = planes.binary_output(edge, work_path(spark, "t"), WORD, 2, **options).collect()
    # Rows of one id may come in either order, so their places are compared as a set of gapless stretches.
    want = in_order(EDGE)
    same([(r[0], r[2], r[3]) for r in got], [(r[0], r[2], r[3]) for r in want])
    ends = 0
    for _, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == ends
        ends += n
    ids = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def check_packing(rows, got, tokens=4096):
    want = []
    for (doc_id, _), ids in zip(rows, library_ids([t for _, t in rows])):
        ids = np.append(ids, np.uint32(1)).astype("<u4")
        for k, i in enumerate(range(0, len(ids), tokens)):
            part = ids[i : i + tokens]
            want.append((doc_id, k, i, len(part), zlib.crc32(part.tobytes())))
    same([tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got], want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return len(bins), sum(w[3] for w in want)


def test_packing_query(spark, small):
    bins, total = check_packing(small[1], queries.op9_packing(spark, SF_DIR).collect())
    assert bins <= -(-total // 4096) + 2


def test_packing_of_awkward_rows(edge):
    for options in ({}, {"group": 3}, {"rule": "dot", "weights": (1.0, 0.5, 0.2)}):
        check_packing(EDGE, packing.packed(edge, WORD, 1, **options).collect())


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    r = np.random.default_rng(1)
    lengths = r.integers(1, 400, 500)
    bins, offset = packing.vector_best_fit(lengths, 1000, 5, 250_000, (1.0, 0.3, 0.5), rule)
    for b in range(bins.max() + 1):
        mine = np.flatnonzero(bins == b)
        assert lengths[mine].sum() <= 1000 and len(mine) <= 5 and (lengths[mine] ** 2).sum() <= 250_000
        order = mine[np.argsort(offset[mine])]
        assert (offset[order] == np.cumsum(lengths[order]) - lengths[order]).all()
    with pytest.raises(ValueError):
        packing.vector_best_fit(np.array([600]), 1000, 5, 250_000, (1, 1, 1), rule)


def plain_best_fit(lengths, room, weights, rule):
    """Sequence contents piece by piece, every sequence looked at; the first of equally good ones by number of its opening."""
    sequences = []
    for n in sorted(lengths, reverse=True):
        need, best = (n, 1, n * n), None
        for s in sequences:
            left = [r - sum(p[i] for p in s) for i, r in enumerate(room)]
            if all(x >= d for x, d in zip(left, need)):
                if rule == "dot":
                    score = -sum(w * (x / r) * (d / r) for w, x, d, r in zip(weights, left, need, room))
                else:
                    score = sum(w * ((x - d) / r) ** 2 for w, x, d, r in zip(weights, left, need, room))
                if best is None or score < best[0] - 1e-15:
                    best = (score, s)
        if best:
            best[1].append(need)
        else:
            sequences.append([need])
    return sequences


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("weights", [(1.0, 0.3, 0.5), packing.TIES])
def test_sequences_are_as_many_as_plain_best_fit_makes(rule, weights):
    r = np.random.default_rng(7)
    for _ in range(8):
        lengths = r.choice(np.arange(1, 500), 160)
        room = (1000, 6, 400_000)
        bins, _ = packing.vector_best_fit(lengths, *room, weights, rule)
        got = sorted(tuple(sorted(lengths[bins == b].tolist())) for b in range(bins.max() + 1))
        want = plain_best_fit(lengths.tolist(), room, weights, rule)
        assert abs(len(got) - len(want)) <= 1
        assert [sum(map(sum, got))] == [sum(p[0] for s in want for p in s)]


def test_ties_by_documents_and_attention_make_no_more_sequences():
    r = np.random.default_rng(9)
    for _ in range(6):
        lengths = np.minimum(4096, (r.pareto(1.1, 3000) * 300 + 1).astype(np.int64))
        plain, _ = packing.vector_best_fit(lengths, 4096, 4096, 4096 * 4096, (1.0, 0.0, 0.0), "norm")
        tied, _ = packing.vector_best_fit(lengths, 4096, 4096, 4096 * 4096, packing.TIES, "norm")
        assert tied.max() <= plain.max()


def piece_counts(texts):
    import sentencepiece

    return [len(i) for i in sentencepiece.SentencePieceProcessor(model_file=PIECE).encode([t or "" for t in texts])]


def test_token_counts_query(spark, small):
    want = [(d, len(t.encode()), n, n > 4096) for (d, t), n in zip(small[1], piece_counts([t for _, t in small[1]]))]
    same(queries.op10_token_counts(spark, SF_DIR).collect(), want)


def test_cache_is_used_and_versioned(spark, edge, empty, monkeypatch):
    path = work_path(spark, "cache")
    want = [(d, len((t or "").encode()), n) for (d, t), n in zip(EDGE, piece_counts([t for _, t in EDGE]))]
    same([r[:3] for r in counts.token_counts(edge, PIECE, path).collect()], want)
    cache = spark.read.parquet(path)
    assert cache.count() == cache.select("digest").distinct().count() == len({t or "" for _, t in EDGE})
    monkeypatch.setattr(counts, "counter", lambda p: lambda texts: [1 // 0 for _ in texts])  # nothing is encoded again
    same([r[:3] for r in counts.token_counts(edge, PIECE, path).collect()], want)
    monkeypatch.undo()
    counts.token_counts(edge, WORD, path).collect()
    assert spark.read.parquet(path).select("version").distinct().count() == 2
    assert counts.token_counts(empty, PIECE, path).collect() == []
    assert packing.packed(empty, WORD, 1).collect() == []
    assert planes.binary_output(empty, work_path(spark, "t"), WORD, 2).collect() == []


def test_words_with_marks_are_put_together():
    """Each word and each row of marks is learnt once, by itself; the library is not asked for whole pieces that are made of both."""
    letters = [chr(i) for i in range(0xAA, 0x250) if chr(i).isalpha()]
    words = [f"{a}x{b}" for a in [*letters, "A", "q"] for b in ("", "é", ".", "'", "'s", "<|", "...,'", "_", "%%%")] + ["x" * 90 + ".,", "a'S", "...", "a1."]
    encoder = WordEncoder(WORD)
    asked = []
    library = encoder._library
    encoder._library = lambda texts: asked.extend(texts) or library(texts)
    assert encoder.encode(words) == [a.tobytes() for a in library_ids(words)]
    assert "qx%%%" not in asked and "éx...,'" not in asked and "%%%" in asked and "İx." in asked
    assert b"x" * 90 not in encoder.memo and b"qx" in encoder.memo
