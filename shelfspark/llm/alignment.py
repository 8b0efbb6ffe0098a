"""Two tokenizers' ids of the same text, aligned at the byte offsets where tokens of both end.

The ends of each side's tokens are cumulative sums of token bytes. A dictionary per side leads from an end to the index of its
token; the intersection of both key sets, sorted, is where both id lists are cut. Each slice is a group, and the occurrence
pairs of a slice whose bytes end together are its links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import id_type, map_rows, small_side, stored, texts_of

#: Bytes of text whose ends are in the dictionaries at a time; a long text is aligned stretch by stretch.
SPAN = 1 << 13
# Fixed value: how byte-level files with their own pattern cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class Side:
    """Ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        #: The library for ``.model`` files puts a space before the text by itself.
        self.adds_space = path.endswith(".model")
        if self.adds_space:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.table = [piece_bytes(model, i) for i in range(model.get_piece_size())]
            self.encode, self.lossless = lambda texts: model.encode(texts, num_threads=1), False
        else:
            self.table, self.encode, self.lossless = byte_level(path)
        self.lengths = np.array([len(b) for b in self.table], dtype=np.int64)
        self.size = len(self.table)

    def tokens(self, texts: list[str]) -> list[list[int]]:
        """Ids of the texts, a space before each."""
        return self.encode(texts if self.adds_space else [" " + t for t in texts])

    def spells(self, ids: list[int], data: bytes) -> bool:
        """Whether the tokens' bytes in a row are ``data``; byte-level ids by rank are made of the text's own bytes."""
        return self.lossless or b"".join(map(self.table.__getitem__, ids)) == data


def byte_level(path: str):
    """Bytes of each id, the encoder, and whether it encodes by ranks, of a byte-level ``.json`` file; strings of special tokens are plain text.

    Where the file's merges make its ids in their order, the encoder by ranks gives the same ids in a third of the time;
    texts with very long words or gaps, which its patterns are slow on, and all other files go to the file's own library.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    letters = byte_letters()
    vocabulary = tokenizer.get_vocab()
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

    def library(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split, added = spec["model"], spec.get("pre_tokenizer") or {}, {t["content"] for t in spec.get("added_tokens") or []}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
    in_order = (
        spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") is True and not split.get("add_prefix_space")
        and model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        and not any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merged)) and len(model["vocab"].keys() - added) == 256 + len(merged))
    if not in_order:
        return table, library, False
    import tiktoken

    ranks = {table[i]: i for token, i in model["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("by-rank", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    return table, lambda texts: [library([t])[0] if LONG_RUN.search(t) else fast.encode_ordinary(t) for t in texts], True


def piece_bytes(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


def cuts_of(ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where both id lists are cut, per stretch of the text: the first index of each group and the end of the last one.

    A stretch runs to its last common end; what is left over starts the next one.
    """
    at_a = at_b = top = 0
    total = int(ends_a[-1]) if len(ends_a) else 0
    while top < total:
        top = min(total, top + SPAN)
        last_a, last_b = (int(np.searchsorted(e, top, "right")) for e in (ends_a, ends_b))
        index_a = dict(zip(ends_a[at_a:last_a].tolist(), range(at_a + 1, last_a + 1)))
        index_b = dict(zip(ends_b[at_b:last_b].tolist(), range(at_b + 1, last_b + 1)))
        common = sorted(index_a.keys() & index_b.keys())
        if common:
            cuts_a = np.array([at_a, *map(index_a.__getitem__, common)])
            cuts_b = np.array([at_b, *map(index_b.__getitem__, common)])
            yield cuts_a, cuts_b
            at_a, at_b = int(cuts_a[-1]), int(cuts_b[-1])


class Writer:
    """Groups as text, ``a1,a2|b1;...``."""

    def __init__(self, sizes: int):
        # Every id with each mark that may follow it, in one array of short byte strings.
        ids = np.arange(sizes).astype(f"S{len(str(sizes))}")
        self.marked = np.stack([np.char.add(ids, mark) for mark in (b",", b"|", b";")], axis=1).reshape(-1)

    def groups(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> bytes:
        """The slices of both id lists between the cuts, each with ``;`` after it."""
        n_a, n_b = np.diff(cuts_a), np.diff(cuts_b)
        start_a, start_b = cuts_a[0], cuts_b[0]
        # A group's A ids come before its B ids: an A id moves up by the B ids of earlier groups, a B id by the A ids up to its group.
        place_a = np.arange(n_a.sum()) + np.repeat(cuts_b[:-1] - start_b, n_a)
        place_b = np.arange(n_b.sum()) + np.repeat(cuts_a[1:] - start_a, n_b)
        codes = np.empty(len(place_a) + len(place_b), dtype=np.int64)
        codes[place_a], codes[place_b] = 3 * a[start_a : cuts_a[-1]], 3 * b[start_b : cuts_b[-1]]
        codes[place_a[cuts_a[1:] - start_a - 1]] += 1
        codes[place_b[cuts_b[1:] - start_b - 1]] += 2
        return self.marked[codes].tobytes().replace(b"\0", b"")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links``, stored.

    ``path_a`` names a byte-level tokenizer file, which gets the text with a space before it, ``path_b`` a ``.model`` file, whose
    library adds one. ``links`` has the distinct linked id pairs as (``pair, n``) with ``pair = a * size_b + b``. Texts that
    are null or empty, or that either side's bytes do not give back with a space before, have no tokens: all counts are zero and
    ``groups_sha256`` is the empty string. Repeated rows and ids keep a row each, other columns are left behind.
    """
    right = Side(path_b)
    size_b, sizes = right.size, Side(path_a).size * right.size

    def rows(batches):
        left, right = Side(path_a), Side(path_b)
        writer = Writer(max(left.size, right.size))
        for batch in batches:
            out = {n: [] for n in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            found, times = [], []
            texts = batch["text"]
            for text, a, b in zip(texts, left.tokens(texts), right.tokens(texts), strict=True):
                data = b" " + text.encode("utf-8")
                if not text or not left.spells(a, data) or not right.spells(b, data):
                    a, b = [], []
                ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
                digest, groups, pairs = hashlib.sha256(), 0, [np.zeros(0, dtype=np.int64)]
                for cuts_a, cuts_b in cuts_of(np.cumsum(left.lengths[ids_a]), np.cumsum(right.lengths[ids_b])):
                    written = writer.groups(ids_a, ids_b, cuts_a, cuts_b)
                    digest.update(b";" + written[:-1] if groups else written[:-1])
                    groups += len(cuts_a) - 1
                    # Every token has bytes, so of a slice only the last tokens of both sides end together.
                    pairs.append(ids_a[cuts_a[1:] - 1] * size_b + ids_b[cuts_b[1:] - 1])
                pair, n = np.unique(np.concatenate(pairs), return_counts=True)
                found.append(pair)
                times.append(n)
                for name, value in zip(out, (len(a), len(b), groups, int(n.sum()), digest.hexdigest() if len(a) else ""), strict=True):
                    out[name].append(value)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            fields = [np.concatenate([np.zeros(0, dtype=np.int64), *c]).astype(t) for c, t in ((found, code_type), (times, np.int32))]
            yield out | {"doc_id": batch["doc_id"], "links": pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(map(pa.array, fields)), ["pair", "n"]))}

    code, code_type = ("int", np.int32) if sizes < 1 << 31 else ("bigint", np.int64)
    schema = (f"doc_id {id_type(docs)}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              f"links array<struct<pair: {code}, n: int>>")
    found = map_rows(texts_of(docs), rows, schema, batch=200)
    # Stored with a key of each row; the vocabulary size goes along, so that an id can be read back from a pair.
    return stored(found.select(F.monotonically_increasing_id().alias("row"), "*", F.lit(size_b).alias("size_b")), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, total, best`` of every linked id pair: its links in all documents, and whether its B id has no pair with more."""
    each = rows.select("size_b", F.inline("links"))
    totals = stored(each.groupBy("pair", (F.col("pair") % F.col("size_b")).alias("b")).agg(F.sum("n").alias("total")), "pair-counts")
    most = totals.groupBy("b").agg(F.max("total").alias("_most"))
    return totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("_most")).alias("best"))


def with_counts(rows: DataFrame) -> DataFrame:
    """Rows of ``aligned`` with ``n_best``, the links whose pair is its B id's most frequent one, and ``count_sum`` over links."""
    known = small_side(stored(pair_counts(rows), "pairs"))
    each = rows.select("row", F.inline("links"))
    sums = each.join(known, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum"))
    whole = rows.join(sums, "row", "left").drop("row", "size_b")
    return whole.withColumns({n: F.coalesce(n, F.lit(0)).cast("bigint") for n in ("n_best", "count_sum")})
