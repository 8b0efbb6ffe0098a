"""Alignment of two tokenizers against a plain version that compares all ends."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfspark.llm import alignment, queries
from tests.llm.conftest import EDGE, SF_DIR, same

BYTE, PIECE = (queries.tokenizer_path(n) for n in (queries.BYTE_BPE, queries.PIECE_BPE))
ODD = [(30, "a ▁ b"), (31, "<|endoftext|> <s> </s> <0x41> <unk>"), (32, "ﬁ ½ ＡＢ é é"), (33, "two  spaces \n\n and\ttabs "), (34, "￿\u0000 ​"),
       (35, " " * 5000 + "y"), (36, "漢字かな交じり文 한국어 😀😀"), (37, "aaa" * 2500)]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.a.encode_special_tokens = True
        letters = alignment.byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def sides(self, text):
        data = b" " + (text or "").encode()
        a = [(i, self.bytes_a[i]) for i in self.a.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, self.bytes_b(i)) for i in self.b.encode(text or "")]
        if not text or any(b"".join(x for _, x in side) != data for side in (a, b)):
            return [], []
        return a, b


def ends(side):
    at, out = 0, []
    for i, data in side:
        at += len(data)
        out.append((at, i))
    return out


def expected(rows):
    plain, each, totals = Plain(), [], Counter()
    for doc_id, text in rows:
        a, b = map(ends, plain.sides(text))
        common = sorted({e for e, _ in a} & {e for e, _ in b})
        spans = list(zip([0, *common], common))
        groups = ";".join(
            ",".join(str(i) for e, i in a if lo < e <= hi) + "|" + ",".join(str(i) for e, i in b if lo < e <= hi) for lo, hi in spans) if len(a) < 3000 else None
        at_b = defaultdict(list)
        for e, i in b:
            at_b[e].append(i)
        links = [(i, j) for e, i in a for j in at_b[e]]
        totals.update(links)
        each.append((doc_id, len(a), len(b), len(common), groups, links))
    most = defaultdict(int)
    for (_, j), n in totals.items():
        most[j] = max(most[j], n)
    return [
        (d, n_a, n_b, n_g, len(links), sum(totals[p] == most[p[1]] for p in links), sum(totals[p] for p in links),
         None if g is None else hashlib.sha256(g.encode()).hexdigest() if n_a else "")
        for d, n_a, n_b, n_g, g, links in each]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def compared(got, want):
    """Without the digests of texts that are too long for the plain version."""
    long = {(w[0], w[1]) for w in want if w[-1] is None}
    same([tuple(r)[:-1] + (None,) if (r.doc_id, r.n_a) in long else tuple(r) for r in got], want)


@pytest.mark.parametrize("most", [0, 200_000])
def test_awkward_documents(spark, edge, monkeypatch, most):
    monkeypatch.setattr(alignment, "SPAN", 4096)
    monkeypatch.setattr(alignment, "small_side", lambda df: df.hint("shuffle_hash") if not most else df)
    docs = edge.unionByName(spark.createDataFrame(ODD, "doc_id bigint, text string"), allowMissingColumns=True)
    compared(alignment.with_counts(alignment.aligned(docs, BYTE, PIECE)).select(COLUMNS).collect(), expected(EDGE + ODD))


def test_empty_table(empty):
    assert alignment.with_counts(alignment.aligned(empty, BYTE, PIECE)).collect() == []


def test_query(spark, small):
    got = queries.op11_token_alignment(spark, SF_DIR)
    compared(got.select(COLUMNS).collect(), expected(small[1]))


def test_encoder_by_ranks_is_the_library():
    r = random.Random(5)
    side, library = alignment.Side(BYTE), Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    parts = [*"abcDEFé'.,!<|> \n\t\x0b\x1c\x85　́Σςİß漢字😀0123²½_-", "<|endoftext|>", "'s", "'ll ", "don't", "​", "\x00", "   ", "x" * 2001, " " * 2001]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(3000)]
    assert side.tokens(texts) == [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_stretches_are_one_alignment(monkeypatch):
    import numpy as np

    r = random.Random(2)
    a, b = (np.array(sorted({4000, *r.sample(range(1, 4000), 900)})) for _ in range(2))
    monkeypatch.setattr(alignment, "SPAN", 37)
    short = [list(map(int, c)) for x in alignment.cuts_of(a, b) for c in zip(x[0][1:], x[1][1:])]
    monkeypatch.setattr(alignment, "SPAN", 1 << 20)
    assert short == [list(map(int, c)) for x in alignment.cuts_of(a, b) for c in zip(x[0][1:], x[1][1:])]
