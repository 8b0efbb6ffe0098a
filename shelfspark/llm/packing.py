"""Best-fit packing of token sequences under several capacities at once.

Each open sequence has residual capacities: tokens, documents, and attention cost (the sum of squared piece lengths). Pieces
go from the longest to the shortest; among the sequences with room in every capacity one is chosen by the weighted
dot product of the piece's demand and the residual (largest wins) or by the weighted norm of what would be left
(smallest wins). Demands and residuals are shares of their capacity.

The pieces are dealt evenly over groups of bounded size and each group is packed on its own, so a corpus of any size costs
at most about one half-empty sequence a group more than packing it in one place.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import id_type, map_rows, stored, texts_of
from shelfspark.llm.encoding import worker_encoder


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, tokens: int) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``. Only documents over ``tokens`` ids are cut.

    A null text is empty; it still has its end id. ``_task`` and ``_row`` number the rows that a task has written.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(batches):
        encoder = worker_encoder(tokenizer)
        for b in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            for doc_id, coded in zip(b["doc_id"], encoder.encode(b["text"]), strict=True):
                coded += end
                for k in range(0, len(coded), 4 * tokens):
                    part = coded[k : k + 4 * tokens]
                    ids.append(doc_id)
                    piece.append(k // (4 * tokens))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield {"doc_id": ids, "piece": piece, "start": start, "length": length, "ids_crc32": crc}

    schema = f"doc_id {id_type(docs)}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_rows(texts_of(docs), rows, schema, batch=500).withColumn("_row", F.monotonically_increasing_id())


#: Tokens decide; among sequences with as many left, documents and attention cost do. The least difference that one token makes in
#: the norm is about 1e-7, so these weights never outweigh it and the number of sequences stays that of tokens alone.
TIES = (1.0, 1e-9, 1e-9)


def vector_best_fit(
    lengths: np.ndarray, tokens: int, documents: int, attention: int, weights: tuple[float, float, float], rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece. ``rule``: ``"norm"`` or ``"dot"``."""
    n = len(lengths)
    demand = np.stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2], axis=1).astype(np.float64)
    room = np.array([tokens, documents, attention], dtype=np.float64)
    if n and (demand.max(axis=0) > room).any():
        raise ValueError("a piece alone is over a capacity")
    scaled_weights = np.asarray(weights, dtype=np.float64)
    residual = np.empty((max(n, 1), 3))
    open_bins = np.empty(max(n, 1), dtype=np.int64)  # sequences that may still take the shortest piece
    n_open = n_bins = 0
    least = demand.min(axis=0) if n else room
    bin_of, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        d = demand[i]
        left = residual[open_bins[:n_open]] - d
        fits = np.flatnonzero((left >= 0).all(axis=1))
        if len(fits):
            if rule == "dot":
                score = -((left[fits] + d) / room * (d / room)) @ scaled_weights
            else:
                score = ((left[fits] / room) ** 2) @ scaled_weights
            at = fits[np.argmin(score)]
            b = open_bins[at]
        else:
            b, at = n_bins, n_open
            residual[b] = room
            open_bins[n_open] = b
            n_bins, n_open = n_bins + 1, n_open + 1
        bin_of[i], offset[i] = b, tokens - residual[b, 0]
        residual[b] -= d
        if (residual[b] < least).any():
            n_open -= 1
            open_bins[at] = open_bins[n_open]
    return bin_of, offset


def pack(
    pieces: DataFrame, tokens: int = 4096, documents: int | None = None, attention: int | None = None,
    weights: tuple[float, float, float] = TIES, rule: str = "norm", group: int = 8192,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (stored rows with ``length`` and ``_row``).

    ``documents`` and ``attention`` limit the pieces of a sequence and the sum of their squared lengths; by default they are
    as large as ``tokens`` allows, so that as few sequences as possible are made, and only settle ties. ``group`` is the usual number of pieces
    packed together.
    """
    groups = max(1, -(-pieces.count() // group))
    documents, attention = documents or tokens, attention or tokens * tokens
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def one(key, table):
        import pyarrow as pa

        lengths = table.column("length").to_numpy().astype(np.int64)
        bins, offset = vector_best_fit(lengths, tokens, documents, attention, weights, rule)
        number = (np.int64(key[0].as_py()) << np.int64(32)) + bins
        return table.drop_columns(["_group"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(one, f"{schema}, sequence_id bigint, offset bigint")


def packed(docs: DataFrame, tokenizer: str, end_id: int, tokens: int = 4096, **options) -> DataFrame:
    """Pieces of ``docs`` with the sequence and the place of each; every row of ``docs``, repeated or not, is packed."""
    pieces = stored(cut_pieces(docs, tokenizer, end_id, tokens), "pieces")
    return pack(pieces, tokens, **options).drop("_row")
