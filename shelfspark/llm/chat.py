"""Conversations as training text, with a loss mask aligned to the turns by offsets.

A turn is ``<s>role``, a line end, the text and ``</s>``, a line end. In texts and roles a backslash goes after the opening
bracket of anything that looks like a control string, also of other templates, and one more where there already are some; so
taking one backslash away restores them. Line ends and backslashes in a role are written as ``\\n`` and ``\\\\``.

A conversation is rendered as a whole and encoded once, with offsets. The turns' spans and the tokens' spans both ascend, so
binary search finds the tokens of each assistant turn. A token that reaches over the edge of a turn is part of the mask;
the mask's text is the intersection of the two spans.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.alignment import byte_level
from shelfspark.llm.common import id_type, map_rows, ready, stored

OPEN, CLOSE = "<s>", "</s>\n"
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)")
TURN = re.compile(r"<s>([^\n]*)\n(.*?)</s>\n", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where each turn's text lies in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape_role(role)}\n", escape(text)
        out += [head, body, CLOSE]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(CLOSE)
    return "".join(out), spans


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet any of the ascending spans; ``offsets`` are the tokens' ascending (start, end)."""
    mask = np.zeros(len(offsets), dtype=bool)
    if len(offsets):
        first = np.searchsorted(offsets[:, 1], [s for s, _ in spans], "right")
        last = np.searchsorted(offsets[:, 0], [e for _, e in spans], "left")
        for a, b, (s, e) in zip(first.tolist(), last.tolist(), spans, strict=True):
            if s < e:
                mask[a:b] = True
    return mask


def masked_text(text: str, offsets: np.ndarray, mask: np.ndarray, spans: np.ndarray) -> list[str]:
    """For each of the ascending spans, what the masked tokens cover of it."""
    chosen = offsets[mask]
    if not len(chosen):
        return [""] * len(spans)
    # Tokens that touch or overlap make one stretch; those of one turn mostly do.
    reach = np.maximum.accumulate(chosen[:, 1])
    fresh = np.flatnonzero(np.append(True, chosen[1:, 0] > reach[:-1]))
    starts, stops = chosen[fresh, 0], reach[np.append(fresh[1:] - 1, len(reach) - 1)]
    first, last = np.searchsorted(stops, spans[:, 0], "right"), np.searchsorted(starts, spans[:, 1], "left")
    out = []
    for a, b, (s, e) in zip(first.tolist(), last.tolist(), spans.tolist(), strict=True):
        out.append("".join([text[max(s, x) : min(e, y)] for x, y in zip(starts[a:b].tolist(), stops[a:b].tolist())]))
    return out


def offset_encoder(path: str):
    """``texts -> [(ids, offsets)]``: ids, and the code points (start, end) of each as rows of an array.

    A byte-level tokenizer's ids spell the text's bytes, so their offsets are sums of their lengths: a token starts with the
    character of its first byte and ends with that of its last one. Other tokenizers give the offsets themselves.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") is not None or split.get("type") != "ByteLevel" or split.get("add_prefix_space"):
        model = Tokenizer.from_file(path)

        def library(texts: list[str]):
            made = model.encode_batch(texts, add_special_tokens=False)
            return [(np.array(e.ids, dtype=np.uint32), np.array(e.offsets, dtype=np.int32).reshape(-1, 2)) for e in made]

        return library
    table, encode, _ = byte_level(path)
    lengths = np.array([len(b) for b in table], dtype=np.int32)

    def by_bytes(texts: list[str]):
        out = []
        for text, found in zip(texts, encode(texts), strict=True):
            ids = np.array(found, dtype=np.uint32)
            ends = np.cumsum(lengths[ids], dtype=np.int32)
            data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
            if len(data) == len(text):
                out.append((ids, np.stack([ends - lengths[ids], ends], axis=1)))
                continue
            character = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32) - 1
            out.append((ids, np.stack([character[ends - lengths[ids]], character[ends - 1] + 1], axis=1)))
        return out

    return by_bytes


def packed(spans: list[tuple[int, int]] | np.ndarray) -> bytes:
    return np.array(spans, dtype="<i4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """Rows (start, end) of ``packed`` spans or offsets."""
    return np.frombuffer(data, dtype="<i4").reshape(-1, 2)


def format_chats(conversations: DataFrame, tokenizer: str, learnt: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_tokens, ids, offsets, mask, turn_spans, loss_spans``.

    Rows go by turn, then role, then text, nulls first; a null text or role is an empty one; rows without ``conv_id`` make
    one conversation. Repeated rows are repeated turns. Ids are little-endian unsigned 32-bit numbers; offsets and spans are pairs
    (start, end) of signed ones, in code points (``unpacked`` reads them); the mask has one bit a token, first bit highest.
    """
    ready(conversations.sparkSession)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def rows(batches):
        encode = offset_encoder(tokenizer)
        for b in batches:
            out = {n: [] for n in ("conv_id", "formatted", "n_tokens", "ids", "offsets", "mask", "turn_spans", "loss_spans")}
            made = [render([(t["role"], t["text"]) for t in turns]) for turns in b["turns"]]
            for conv_id, turns, (text, spans), (ids, offsets) in zip(b["conv_id"], b["turns"], made, encode([t for t, _ in made]), strict=True):
                loss = [s for s, t in zip(spans, turns, strict=True) if t["role"] == learnt]
                for name, value in zip(out, (
                        conv_id, text, len(ids), ids.astype("<u4").tobytes(), packed(offsets), np.packbits(loss_mask(offsets, loss)).tobytes(),
                        packed(spans), packed(loss)), strict=True):
                    out[name].append(value)
            yield out

    schema = (
        f"conv_id {id_type(conversations, 'conv_id')}, formatted string, n_tokens bigint, ids binary, offsets binary, mask binary, "
        "turn_spans binary, loss_spans binary"
    )
    return map_rows(whole, rows, schema, batch=50)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation, as they were."""
    return [(unescape_role(role), unescape(text)) for role, text in TURN.findall(formatted)]


def digests(formatted: DataFrame) -> DataFrame:
    """Read back from the output: turns and the text under the mask, as counts and digests."""

    def rows(batches):
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens")
        for b in batches:
            out = {n: [] for n in names}
            for k, conv_id in enumerate(b["conv_id"]):
                text, offsets = b["formatted"][k], unpacked(b["offsets"][k])
                mask = np.unpackbits(np.frombuffer(b["mask"][k], dtype=np.uint8), count=b["n_tokens"][k]).astype(bool)
                turns = parse(text)
                loss = "".join(map(unescape, masked_text(text, offsets, mask, unpacked(b["loss_spans"][k]))))
                lines = "".join(f"{role}\n{said}\n" for role, said in turns)
                for name, value in zip(names, (
                    conv_id, len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(text), len(mask), int(mask.sum())), strict=True):
                    out[name].append(value)
            yield out

    schema = (
        f"conv_id {id_type(formatted, 'conv_id')}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint"
    )
    needed = formatted.select("conv_id", "formatted", "n_tokens", "offsets", "mask", "loss_spans")
    return map_rows(needed, rows, schema, batch=50)


def chat_output(conversations: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Format, store, and read the stored rows back."""
    return digests(stored(format_chats(conversations, tokenizer, **options), "chats"))
