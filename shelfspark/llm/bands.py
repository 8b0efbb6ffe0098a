"""Quality rules on word, symbol, line and repetition counts, and compression bands.

A text is compressed by zstandard as a whole and in fixed chunks. Repetitive text compresses far better than prose, noise
worse: printable noise only by its small alphabet, so the limits lie close to prose. How far depends on the length, so they are
given by length. A text fails if its whole ratio is out of its band, or if more than ``max_bad_chunks`` of its full chunks are
out of theirs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from shelfspark.llm.common import id_type, map_rows, texts_of

#: (bytes up to, least ratio, largest ratio) for whole texts. The largest lie just above what prose reaches at the band's
#: shorter end (given documents, licence texts, technical notes) and below base64 and random words at its longer end; hex, at 0.50
#: to 0.52, is out from 8192 bytes on. Below 64 bytes the frame's own bytes weigh so much that prose and noise are alike.
BANDS = (
    (64, 0.20, 9.0), (128, 0.20, 1.16), (256, 0.20, 0.98), (384, 0.25, 0.86), (512, 0.25, 0.79), (1024, 0.25, 0.74), (2048, 0.25, 0.68),
    (4096, 0.25, 0.60), (8192, 0.22, 0.545), (32_768, 0.22, 0.50), (1 << 62, 0.20, 0.46))
CHUNK, CHUNK_BAND, MAX_BAD_CHUNKS = 4096, (0.22, 0.56), 0.25
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, inverse, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def in_band(raw: bytes, press, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND, max_bad=MAX_BAD_CHUNKS) -> bool:
    if not raw:
        return True
    ratio = len(press.compress(raw)) / len(raw)
    low, high = next((a, b) for top, a, b in bands if len(raw) < top)
    if not low <= ratio <= high:
        return False
    full = len(raw) // chunk
    ratios = (len(press.compress(raw[i * chunk : (i + 1) * chunk])) / chunk for i in range(full))
    bad = sum(not chunk_band[0] <= r <= chunk_band[1] for r in ratios)
    return bad <= max_bad * full


def quality_rules(docs: DataFrame, bands=BANDS, chunk: int = CHUNK, chunk_band=CHUNK_BAND, max_bad=MAX_BAD_CHUNKS, level: int = 3) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed``, ``in_band`` and ``kept``.

    A null or empty text has no words and fails the base rule; every row of ``docs`` gives one row, in whatever number.
    """

    def rows(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=level)
        for b in batches:
            out = {n: [] for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "in_band", "kept")}
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                raw = text.encode("utf-8", "replace")
                words = raw.split()
                n = len(words)
                lines = [s for s in text.split("\n") if s.strip(BLANKS)]
                repeat = repeated_words(words)
                failed = n < 50 or 100 * repeat > 50 * n
                fits = in_band(raw, press, bands, chunk, chunk_band, max_bad)
                for name, value in (
                    ("doc_id", doc_id), ("n_words", n), ("word_chars", len(text) - sum(text.count(c) for c in BLANKS)),
                    ("n_symbols", sum(text.count(c) for c in SYMBOLS)), ("n_dup_lines", len(lines) - len(set(lines))),
                    ("n_repeat_words", repeat), ("base_failed", failed), ("in_band", fits), ("kept", not failed and fits),
                ):
                    out[name].append(value)
            yield out

    schema = (
        f"doc_id {id_type(docs)}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, in_band boolean, kept boolean"
    )
    return map_rows(texts_of(docs), rows, schema)
