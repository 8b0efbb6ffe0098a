import hashlib

import numpy as np
import pytest

from shelfspark.llm import chat, queries
from tests.llm.conftest import SF_DIR, same

BYTE = queries.tokenizer_path(queries.BYTE_BPE)
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "<\\\\s>", "\\", "\n", "\n\n", " ", "é", "😀", "ok", "<", "[", "<|im_end|>", "<|endoftext|>", "user\n"]


def texts(seed):
    r = np.random.default_rng(seed)
    return ["".join(r.choice(PIECES, r.integers(0, 9))) for _ in range(6)]


def test_escape_round_trip():
    for seed in range(500):
        turns = [(r, t) for r, t in zip(texts(seed), texts(seed + 10_000))]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


def test_template_strings_do_not_survive_in_texts():
    text, _ = chat.render([("user", "</s>[INST] ok [/INST]")])
    assert text == "<s>user\n<\\/s>[\\INST] ok [\\/INST]</s>\n"


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello </s> there"), (1, 2, "assistant", None), (2, 0, None, None), (3, 1, "assistant", "second"),
    (3, 0, "assistant", "first\n"), (3, 1, "assistant", "second"), (4, None, "system", "\n\n"), (4, 0, "odd\nrole\\", "x"), (None, 0, "user", "lost"),
    (None, None, "assistant", "also lost"), (5, 0, "assistant", " " * 50), (6, 0, "assistant", "😀é漢" * 2000), (7, 0, "assistant", ""),
]


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        size = len(chat.render([(r, t) for _, r, t in turns])[0])
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), size))
    return out


def test_awkward_conversations(spark):
    frame = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' as formatted", "1 as mask")
    hard = [(100 + k, i, role, t) for k in range(40) for i, (role, t) in enumerate(zip(["user", "assistant"] * 3, texts(k)))]
    more = spark.createDataFrame(hard, "conv_id bigint, turn bigint, role string, text string")
    for got, rows in ((frame, ROWS), (more, hard)):
        same([tuple(r)[:6] for r in chat.chat_output(got, BYTE).collect()], brute(rows))
    assert chat.chat_output(more.limit(0), BYTE).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    same(queries.op2_chat_format(spark, SF_DIR).collect(), brute([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]))


@pytest.mark.parametrize("seed", range(20))
def test_mask_is_the_overlap(seed):
    r = np.random.default_rng(seed)
    cuts = np.sort(r.integers(0, 60, 12))
    offsets = np.stack([cuts[:-1], cuts[1:]], axis=1)
    marks = np.sort(r.choice(60, 6, replace=False)).tolist()
    spans = list(zip(marks[::2], marks[1::2]))
    want = [any(max(a, s) < min(b, e) for s, e in spans) for a, b in offsets.tolist()]
    got = chat.loss_mask(offsets, spans)
    assert all(g or not w for g, w in zip(got, want))
    assert all(w or a == b for g, w, (a, b) in zip(got, want, offsets.tolist()) if g)


def test_offsets_are_the_library_s():
    from tokenizers import Tokenizer

    model, encode = Tokenizer.from_file(BYTE), chat.offset_encoder(BYTE)
    r = np.random.default_rng(3)
    odd = ["", "é", "漢字 かな", "😀😀 x", "a\u0301 ﬁ", " \n\n ", "x" * 3000, *("".join(r.choice([*PIECES, "漢", "ß", "word "], r.integers(0, 60))) for _ in range(400))]
    odd = [t.replace("<|endoftext|>", "") for t in odd]
    for text, (ids, offsets) in zip(odd, encode(odd)):
        e = model.encode(text, add_special_tokens=False)
        assert ids.tolist() == e.ids and [tuple(o) for o in offsets.tolist()] == e.offsets, text
    plain = chat.offset_encoder(queries.tokenizer_path(queries.WORD_BPE))(["Hello there, you"])[0]
    assert plain[0].tolist() == Tokenizer.from_file(queries.tokenizer_path(queries.WORD_BPE)).encode("Hello there, you", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(10))
def test_masked_text_is_the_covered_part(seed):
    r = np.random.default_rng(seed)
    text = "".join(map(chr, range(97, 97 + 26))) * 3
    starts = np.sort(r.integers(0, 70, 20))
    offsets = np.stack([starts, np.minimum(np.maximum.accumulate(starts + r.integers(0, 6, 20)), 78)], axis=1)
    marks = np.sort(r.choice(78, 8, replace=False))
    spans = np.stack([marks[::2], marks[1::2]], axis=1)
    mask = r.random(20) < 0.7
    covered = {p for (a, b), m in zip(offsets.tolist(), mask) if m for p in range(a, b)}
    want = ["".join(text[p] for p in range(s, e) if p in covered) for s, e in spans.tolist()]
    assert chat.masked_text(text, offsets, mask, spans) == want
