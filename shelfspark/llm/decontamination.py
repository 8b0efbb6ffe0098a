"""Benchmark passages in documents, through a positional inverted index.

The index is split by documents: a segment holds a bounded number of words, and a posting list is the sorted word positions
of one term in one segment, with a gap between documents. A window of test words is looked up from its rarest term: that
term's lists name the segments worth a look, and there the lists, each shifted back by the term's place in the window, are
intersected from the rarest to the most frequent, until nothing is left. With ``near`` > 0 a term may stand up to that many
words away from its place; such proximity matches are told apart from exact phrases.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import id_type, map_rows, ready, stored, texts_of

#: Byte to byte: small letters for capitals, a blank for every other ASCII character that is no letter or digit.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Terms of the test set that may be sent to all tasks; beyond it the index takes all terms.
VOCABULARY_BYTES = 8 << 20
#: Words by which a term may stand away from its place where proximity matches count: two words put into a window.
NEAR = 2


def words_of(text: str) -> list[bytes]:
    """Runs of digits, ASCII letters (made small) and characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def test_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``window, item_id, terms``: each run of ``size`` words of an item once; a shorter item is one window."""
    ready(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))

    def rows(batches):
        for b in batches:
            for item, text in zip(b["item_id"], b["text"], strict=True):
                words = [w.decode() for w in words_of(text)]
                runs = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
                yield {"item_id": [item] * len(runs), "terms": runs}

    found = map_rows(items, rows, "item_id string, terms array<string>").distinct()
    return stored(found.withColumn("window", F.monotonically_increasing_id()), "windows")


def vocabulary_of(windows: DataFrame, most: int = VOCABULARY_BYTES) -> list[str] | None:
    """The distinct terms if they are few enough to be sent to tasks, else None."""
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return [r[0] for r in terms.collect()] if size <= most else None


def build_index(docs: DataFrame, vocabulary: list[str] | None = None, segment_words: int = 262_144, gap: int = 1) -> DataFrame:
    """Store the posting lists of ``docs``: ``segment, term, n, positions`` (differences as 32-bit integers).

    The row of each segment without a term lists its documents (``doc_ids``, ``sizes``). ``vocabulary`` limits the terms.
    A document longer than ``segment_words`` has a segment of its own.
    """
    known = None if vocabulary is None else {t.encode(): i for i, t in enumerate(vocabulary)}
    kind = id_type(docs)

    def rows(batches):
        part, number = 0, 0
        ids, sizes, lists, held = [], [], [], 0
        terms = known if known is not None else {}

        def segment():
            base, all_ids, all_at = 0, [], []
            for codes, n in zip(lists, sizes, strict=True):
                at = np.flatnonzero(codes >= 0)
                all_ids.append(codes[at])
                all_at.append((at + base).astype(np.int32))
                base += n + gap
            codes, at = np.concatenate(all_ids), np.concatenate(all_at)
            order = np.argsort(codes, kind="stable")
            codes, at = codes[order], at[order]
            cuts = np.flatnonzero(np.diff(codes)) + 1
            starts = np.concatenate([[0], cuts]) if len(codes) else np.zeros(0, dtype=np.int64)
            step = np.diff(at, prepend=0)
            step[starts] = at[starts]
            data, names = step.astype("<i4").tobytes(), list(terms)
            ends = [*starts[1:].tolist(), len(codes)]
            firsts, k = starts.tolist(), len(starts)
            return {
                "segment": [(part << 32) + number] * (k + 1), "term": [None, *(names[c].decode() for c in codes[starts].tolist())],
                "n": [base, *(b - a for a, b in zip(firsts, ends))],
                "positions": [None, *(data[4 * a : 4 * b] for a, b in zip(firsts, ends))],
                "doc_ids": [ids, *[None] * k], "sizes": [sizes, *[None] * k],
            }

        for b in batches:
            if b["_part"]:
                part = b["_part"][0]
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                words = words_of(text)
                if known is None:
                    codes = np.array([terms.setdefault(w, len(terms)) for w in words], dtype=np.int32)
                else:
                    codes = np.array([terms.get(w, -1) for w in words], dtype=np.int32)
                ids.append(doc_id)
                sizes.append(len(words))
                lists.append(codes)
                held += len(words) + gap
                if held >= segment_words:
                    yield segment()
                    number, held, ids, sizes, lists = number + 1, 0, [], [], []
                    terms = known if known is not None else {}
        if ids:
            yield segment()

    schema = f"segment bigint, term string, n bigint, positions binary, doc_ids array<{kind}>, sizes array<bigint>"
    return stored(map_rows(texts_of(docs).withColumn("_part", F.spark_partition_id()), rows, schema, batch=1000), "postings")


def rarest_first(windows: DataFrame, index: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with ``plan``: (n, place, term), the rarest term of the corpus first."""
    counts = index.where("term is not null").groupBy("term").agg(F.sum("n").alias("n"))
    places = windows.select("window", "item_id", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    return (
        places.join(counts, "term").groupBy("window", "item_id", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "place", "term"))).alias("plan"))
        .where(F.size("plan") == F.col("size"))
    )


def starts_of(plan: list[dict], lists: dict[str, np.ndarray], near: int) -> np.ndarray:
    """Where the window starts in a segment: lists shifted back by their place and intersected, the rarest first."""
    starts = None
    for step in plan:
        at = lists.get(step["term"])
        if at is None:
            return np.zeros(0, dtype=np.int64)
        at = at - step["place"]
        if starts is None:
            starts = at
        else:
            left = np.searchsorted(at, starts - near)
            starts = starts[(left < len(at)) & (at[np.minimum(left, len(at) - 1)] <= starts + near)]
        if not len(starts):
            break
    return starts


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, near: int = 0, segment_words: int = 262_144, vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, item_ids, spans``.

    ``n_hit`` counts the words inside exact occurrences, each once; ``item_ids`` are the items with such windows as sorted
    strings; ``spans`` lists (item_id, first, words, exact) of all matches, proximity ones with ``exact`` false (their
    start is that of the rarest term's place). Null and empty texts, on either side, have no words and no matches; repeated
    rows are looked at one by one; null ids keep their rows.
    """
    windows = test_windows(benchmark, window)
    index = build_index(docs, vocabulary_of(windows, vocabulary_bytes), segment_words, gap=1 + near)
    plans = stored(rarest_first(windows, index), "plans")
    lists = index.where("term is not null")
    candidates = (
        plans.withColumn("term", F.col("plan")[0]["term"]).join(lists.select("term", "segment"), "term")
        .select(F.col("segment").alias("at"), "item_id", "size", F.transform("plan", lambda p: F.struct(p["place"].alias("place"), p["term"].alias("term"))).alias("plan"))
    )

    def verify(postings, wanted):
        import pyarrow as pa

        out = {"segment": [], "place": [], "n_hit": [], "item_ids": [], "spans": []}
        if wanted.num_rows:
            lists, sizes = {}, []
            for term, data, own in zip(*(postings.column(c).to_pylist() for c in ("term", "positions", "sizes")), strict=True):
                if term is None:
                    sizes = own
                else:
                    lists[term] = np.cumsum(np.frombuffer(data, dtype="<i4"), dtype=np.int64)
            sizes = np.array(sizes, dtype=np.int64)
            bases = np.cumsum(sizes + 1 + near) - sizes - 1 - near
            hits: dict[int, list[tuple[int, int, str, bool]]] = {}
            for item, size, plan in zip(*(wanted.column(c).to_pylist() for c in ("item_id", "size", "plan")), strict=True):
                exact = starts_of(plan, lists, 0)
                found = [(exact, True)]
                if near:
                    found.append((np.setdiff1d(starts_of(plan, lists, near), exact), False))
                for starts, is_exact in found:
                    for doc, first in zip((np.searchsorted(bases, starts, "right") - 1).tolist(), starts.tolist()):
                        hits.setdefault(max(doc, 0), []).append((first, size, item, is_exact))
            segment = postings.column("segment")[0].as_py()
            for doc, spans in hits.items():
                base, covered, reach = int(bases[doc]), 0, -1
                spans.sort(key=lambda s: (s[0], s[1], s[2] or ""))
                for first, size, _, is_exact in spans:
                    if is_exact:
                        covered += max(0, first + size - max(first, reach))
                        reach = max(reach, first + size)
                out["segment"].append(segment)
                out["place"].append(doc)
                out["n_hit"].append(covered)
                out["item_ids"].append(sorted({s[2] for s in spans if s[3] and s[2] is not None}))
                out["spans"].append([{"item_id": i, "first": f - base, "words": n, "exact": e} for f, n, i, e in spans])
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (
            pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()),
            pa.list_(pa.struct([("item_id", pa.string()), ("first", pa.int64()), ("words", pa.int32()), ("exact", pa.bool_())]))), strict=True)})

    found = index.select("segment", "term", "positions", "sizes").groupBy("segment").cogroup(candidates.groupBy("at")).applyInArrow(
        verify, "segment bigint, place int, n_hit bigint, item_ids array<string>, spans array<struct<item_id:string,first:bigint,words:int,exact:boolean>>")
    rows = index.where("term is null").select("segment", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("place", "doc"))
    return rows.join(found, ["segment", "place"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"), F.col("doc.sizes").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans")


def near_spans(size: int = 10) -> Column:
    """The proximity matches among ``spans``. Those of items shorter than a window do not count: two or three words meet
    near each other in any text."""
    none = F.array().cast("array<struct<item_id:string,first:bigint,words:int,exact:boolean>>")
    return F.filter(F.coalesce("spans", none), lambda s: ~s["exact"] & (s["words"] >= size))
