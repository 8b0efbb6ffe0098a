"""Byte strings that several documents share, found by sorting suffixes bucket by bucket.

Every ``length``-byte window of a text is the head of one suffix. A window belongs to the bucket of its anchor: the place of the
smallest hash of a few bytes in it, taken modulo ``w``, is where a string of ``length + 1 - w`` bytes starts, more than half the
window, whose hash is the anchor. Equal windows have equal anchors, and neighbours mostly share theirs, so a text falls into
segments, runs of windows of one bucket. Buckets that only one document has hold no repeat; they are told by a grouped minimum
and maximum of ids and never leave their document. The segments of the others are brought together with their bytes, equal
ones combined, and the suffixes that start in them are sorted deep-shallow: multikey quicksort on eight-byte characters orders
each group of equals by its next character down to ``SHALLOW`` bytes, and what is then still tied goes into a blind trie each,
which looks at the bits where keys part and compares a key once. Equal neighbours in that order are the repeats.

A bucket with more than ``HOT`` different segments is cut finer, into windows; equal ones are combined before they are dealt, so
that no task holds such a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import discard, finished_shuffles_freed, give_back, id_type, ready, small_side, stored
from shelfspark.session import work_path

SHALLOW = 24
HOT = 4096
#: A segment has at most so many windows; its start and their number share one integer.
RUN, RUN_BITS = 100, 7
#: Bytes hashed, and bytes sorted, at a time: what fits a core's cache.
CHUNK, BUCKETS = 1 << 16, 1 << 18


def windows_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """A 64-bit hash of each string of ``k`` bytes, for each ``k`` of ``sizes``, put together from strings of 1, 2, 4, ... bytes."""
    factor = 0x9E3779B97F4A7C15
    power, have = data.astype(np.uint64) + np.uint64(1), 1
    made: list = [(None, 0)] * len(sizes)
    while True:
        shift = np.uint64(pow(factor, have, 1 << 64))
        for i, k in enumerate(sizes):
            if k & have:
                out, done = made[i]
                n = len(data) - done - have + 1
                if out is None:
                    made[i] = power.copy(), have
                else:
                    out = out[:n]
                    out *= shift
                    out += power[done : done + n]
                    made[i] = out, done + have
        if 2 * have > max(sizes):
            break
        longer = power[: len(power) - have] * shift
        longer += power[have:]
        power = longer
        have *= 2
    for out, _ in made:
        out ^= out >> np.uint64(30)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return [out for out, _ in made]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors_of(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor of each window of ``data`` (at most ``2**21`` bytes)."""
    if length < 8:
        return windows_hashes(data, length)[0]
    w = (length - 4) // 2
    few = length + 1 - 2 * w
    low = np.uint64((1 << 21) - 1)
    hashes, anchors = windows_hashes(data, few, length + 1 - w)
    # The first of the smallest hashes of a window: places in the lowest bits settle ties.
    hashes &= ~low
    hashes |= np.arange(len(hashes), dtype=np.uint64)
    first = (sliding_minimum(hashes, length + 1 - few) & low).astype(np.int32)
    at = np.arange(len(first), dtype=np.int32)
    first -= at
    first %= w
    first += at
    return anchors[first]


def segments_of(texts: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(text index, anchors, places)`` of stretches of the texts; a place is start and number of windows in one integer."""

    def cut(first: int, sizes: list[int], data: np.ndarray, base: int):
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[: len(data) - length + 1]
        inside = np.ones(len(owner), dtype=bool)
        for end in ends[:-1].tolist():
            inside[max(0, end - length + 1) : end] = False
        anchors = anchors_of(data, length)
        fresh = np.ones(len(anchors), dtype=bool)
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
        stops = np.append(np.flatnonzero(fresh | ~inside), len(owner))
        starts = np.flatnonzero(fresh & inside)
        runs = stops[np.searchsorted(stops, starts, "right")] - starts
        if len(runs) and runs.max() > RUN:
            parts = -(-runs // RUN)
            rank = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            runs = np.minimum(np.repeat(runs, parts) - rank * RUN, RUN)
            starts = np.repeat(starts, parts) + rank * RUN
        local = starts - (ends - sizes)[owner[starts]] + base
        places = (local << RUN_BITS) | runs
        bounds = np.searchsorted(owner[starts], np.arange(len(sizes) + 1))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                yield first + i, anchors[starts[a:b]].view(np.int64), places[a:b]

    first, waiting, size = 0, [], 0
    for i, text in enumerate([*texts, None]):
        if waiting and (text is None or size + len(text) > CHUNK):
            if size >= length:
                yield from cut(first, [len(t) for t in waiting], np.frombuffer(b"".join(waiting), dtype=np.uint8), 0)
            waiting, size = [], 0
        if text is None:
            continue
        if len(text) > CHUNK:
            for base in range(0, len(text) - length + 1, CHUNK):
                part = np.frombuffer(text, dtype=np.uint8)[base : base + CHUNK + length - 1]
                yield from cut(i, [len(part)], part, base)
            continue
        if not waiting:
            first = i
        waiting.append(text)
        size += len(text)
    # A text too long for a chunk empties the waiting ones first, so the waiting ones are always neighbours.


class BlindTrie:
    """Keys in order, equal ones together. An inner node knows the bit where its keys part, nothing of what lies before."""

    def __init__(self):
        self.root = None

    def insert(self, key: int, member: int) -> None:
        if self.root is None:
            self.root = (key, [member])
            return
        node = self.root
        while len(node) == 3:
            node = node[1 + (key >> node[0] & 1)]
        apart = key ^ node[0]
        if not apart:
            node[1].append(member)
            return
        bit, above, node = apart.bit_length() - 1, None, self.root
        while len(node) == 3 and node[0] > bit:
            above, side = node, 1 + (key >> node[0] & 1)
            node = node[side]
        leaf = (key, [member])
        inner = [bit, node, leaf] if key >> bit & 1 else [bit, leaf, node]
        if above is None:
            self.root = inner
        else:
            above[side] = inner

    def classes(self) -> Iterator[list[int]]:
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if len(node) == 3:
                stack += (node[2], node[1])
            else:
                yield node[1]


def characters(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number, zeros after the end."""
    wide = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        wide = (wide[: len(wide) - step] << np.uint64(8 * step)) | wide[step:]
    return wide[: len(data)]


def deep_shallow(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ``length``-byte windows at ``starts`` within their ``groups`` (ascending), and which of them begin a class of
    equal ones in that order."""
    wide = characters(np.frombuffer(data, dtype=np.uint8))

    def character(at: np.ndarray, depth: int) -> np.ndarray:
        over = depth + 8 - length
        return wide[at + depth] >> np.uint64(8 * over) if over > 0 else wide[at + depth]

    order = np.arange(len(starts))
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = groups[1:] != groups[:-1]
    depth, shallow = 0, min(shallow, length)
    tied = tied_of(fresh)
    while len(tied) and depth < shallow:
        label = np.cumsum(fresh)[tied]
        key = character(starts[order[tied]], depth)
        by = np.lexsort((key, label))
        order[tied] = order[tied[by]]
        key, label = key[by], label[by]
        fresh[tied[1:]] |= (key[1:] != key[:-1]) & (label[1:] == label[:-1])
        depth += 8
        tied = tied_of(fresh)
    if depth < length and len(tied):
        firsts = np.flatnonzero(fresh[tied])
        at, members = starts[order[tied]].tolist(), order[tied].tolist()
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(tied)]):
            trie = BlindTrie()
            for i in range(a, b):
                trie.insert(int.from_bytes(data[at[i] + depth : at[i] + length], "big"), members[i])
            place = int(tied[a])
            for same in trie.classes():
                fresh[place] = True
                order[place : place + len(same)] = same
                place += len(same)
    return order, fresh


def tied_of(fresh: np.ndarray) -> np.ndarray:
    """Places of all members of classes with more than one."""
    alone = fresh & np.append(fresh[1:], True)
    return np.flatnonzero(~alone)


def by_arrow(df: DataFrame, columns, schema: str) -> DataFrame:
    """``mapInArrow`` over ``{column: Arrow array}``; ``columns`` takes all batches of a task and yields column dicts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in columns({n: b[n] for n in b.schema.names} for b in batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in ((out[f.name], f) for f in fields)]
            yield pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, fields)], [f.name for f in fields])
        give_back()

    return df.mapInArrow(run, schema)


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, the bytes of the text, and a hash of them; both name what a result belongs to."""
    ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("hash"), text.cast("binary").alias("data"))


def anchored(docs: DataFrame, length: int) -> DataFrame:
    """``row, doc_id, hash, anchors`` (distinct) of each text; ``row`` is a key of the row once it is stored."""

    def rows(batches):
        for b in batches:
            found = [[np.zeros(0, dtype=np.int64)] for _ in range(len(b["data"]))]
            for i, anchors, _ in segments_of(b["data"].to_pylist(), length):
                found[i].append(anchors)
            each = [np.unique(np.concatenate(f)) for f in found]
            ends = pa.array(np.cumsum([0, *map(len, each)]).astype(np.int32))
            yield {"doc_id": b["doc_id"], "hash": b["hash"], "anchors": pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *each])))}

    schema = f"doc_id {id_type(docs)}, hash bigint, anchors array<bigint>"
    return by_arrow(texts_of(docs), rows, schema).select(F.monotonically_increasing_id().alias("row"), "*")


def several_ids(doc_id: str = "doc_id") -> Column:
    """Aggregate: whether some row has an id that is smaller than that of another; no id is the largest."""
    return (F.min(doc_id) < F.max(doc_id)) | (F.bool_or(F.col(doc_id).isNull()) & F.min(doc_id).isNotNull())


def shared_anchors(rows: DataFrame) -> DataFrame:
    """``row, doc_id, hash, anchors`` of ``anchored`` rows, less the anchors that only one document has, stored."""
    each = rows.select("row", "doc_id", F.explode("anchors").alias("anchor"))
    shared = stored(each.groupBy("anchor").agg(several_ids().alias("_shared")).where("_shared").select("anchor"), "shared")
    wanted = stored(each.select("row", "anchor").join(small_side(shared), "anchor"), "wanted")
    wanted = wanted.groupBy("row").agg(F.collect_list("anchor").alias("anchors"))
    # Repeated rows have the same result, so one of them stands for all.
    names = rows.groupBy("doc_id", "hash").agg(F.min("row").alias("row"))
    return stored(wanted.join(names, "row").select("row", "doc_id", "hash", "anchors"), "shared-anchors")


def met(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """The texts with what ``lists`` has for their ``doc_id, hash``."""
    lists = lists.withColumnsRenamed({"doc_id": "_id", "hash": "_hash"}).hint("shuffle_hash")
    texts = texts_of(docs)
    return texts.join(lists, texts["doc_id"].eqNullSafe(lists["_id"]) & (texts["hash"] == lists["_hash"])).drop("_id", "_hash", "hash")


def pieces_of(text: bytes, places: np.ndarray, length: int) -> list[bytes]:
    return [text[s : s + r + length - 1] for s, r in zip((places >> RUN_BITS).tolist(), (places & ((1 << RUN_BITS) - 1)).tolist())]


def occurrences(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``row, doc_id, anchor, place, print`` (a hash of its bytes) of each segment with a shared anchor."""

    def cut(batches):
        import xxhash

        for b in batches:
            data, lists = b["data"].to_pylist(), b["anchors"]
            flat, bounds = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()]).tolist()
            empty = np.zeros(0, dtype=np.int64)
            owners, anchors, places, prints = [empty], [empty], [empty], []
            for i, found, at in segments_of(data, length):
                keep = np.isin(found, flat[bounds[i] : bounds[i + 1]])
                at = at[keep]
                anchors.append(found[keep])
                places.append(at)
                owners.append(np.full(len(at), i))
                prints += map(xxhash.xxh3_64_intdigest, pieces_of(data[i], at, length))
            owner, anchor, place = (pa.array(np.concatenate(c)) for c in (owners, anchors, places))
            printed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield {"row": b["row"].take(owner), "doc_id": b["doc_id"].take(owner), "anchor": anchor, "place": place, "print": printed}

    return by_arrow(met(docs, wanted), cut, f"row bigint, doc_id {id_type(docs)}, anchor bigint, place bigint, print bigint")


SEGMENT = ("anchor", "print", "low", "high", "open")


def with_bytes(docs: DataFrame, chosen: DataFrame, names: DataFrame, length: int) -> DataFrame:
    """``chosen`` segments (row, place and ``SEGMENT``) with their ``bytes``."""
    lists = chosen.groupBy("row").agg(F.collect_list(F.struct("place", *SEGMENT)).alias("segments")).join(names, "row").drop("row")

    def cut(batches):
        for b in batches:
            found, pieces, at = b["segments"].flatten(), [], 0
            places = found.field("place").to_numpy()
            for text, n in zip(b["data"], b["segments"].value_lengths().to_pylist()):
                pieces += pieces_of(text.as_py(), places[at : at + n], length)
                at += n
            yield {c: found.field(c) for c in SEGMENT} | {"bytes": pa.array(pieces, pa.binary())}

    ids = id_type(docs)
    return by_arrow(met(docs, lists).select("data", "segments"), cut, f"anchor bigint, print bigint, low {ids}, high {ids}, open boolean, bytes binary")


def sorted_buckets(segments: DataFrame, length: int, ids: str) -> DataFrame:
    """``anchor, print, first, last, low``: runs of windows of a segment, counted from its first, and the smallest id that has them.

    ``segments``: ``SEGMENT`` (smallest and largest id that have it, and whether rows without id do) and bytes, each once. Runs that
    no larger id has are left out.
    """

    def rows(batches):
        held, size = [], 0
        for b in batches:
            cols = [b[c].to_pylist() for c in ("anchor", "print", "bytes", "low", "high", "open")]
            for row in zip(*cols, strict=True):
                if size > BUCKETS and row[0] != held[-1][0]:
                    yield sorted_runs(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield sorted_runs(held, length)

    dealt = segments.select("anchor", "print", "bytes", "low", "high", "open").repartition("anchor").sortWithinPartitions("anchor")
    return by_arrow(dealt, rows, f"anchor bigint, print bigint, first int, last int, low {ids}")


def sorted_runs(held: list[tuple], length: int) -> dict[str, list]:
    anchor, prints, pieces, low, high, open_ = zip(*held, strict=True)
    names = sorted({i for i in (*low, *high) if i is not None})
    code = {i: k for k, i in enumerate(names)}
    last = len(names)
    lows = np.array([last if i is None else code[i] for i in low])
    highs = np.array([last if o or i is None else code[i] for i, o in zip(high, open_, strict=True)])
    runs = np.array([len(p) - length + 1 for p in pieces])
    owner = np.repeat(np.arange(len(held)), runs)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    offsets = np.cumsum([0, *map(len, pieces)])[:-1]
    smallest = lows[owner]
    group = np.cumsum(np.append(0, np.diff(np.array(anchor)) != 0))
    several = np.bincount(group)[group] > 1
    rows = np.flatnonzero(several[owner])
    if len(rows):
        order, fresh = deep_shallow(b"".join(pieces), (offsets[owner] + inside)[rows], group[owner[rows]], length)
        firsts = np.flatnonzero(fresh)
        least = np.minimum.reduceat(smallest[rows[order]], firsts)
        smallest[rows[order]] = np.repeat(least, np.diff(np.append(firsts, len(order))))
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (smallest[1:] != smallest[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(owner)) - 1
    keep = smallest[begin] < highs[owner[begin]]
    begin, end = begin[keep], end[keep]
    of = owner[begin].tolist()
    return {"anchor": [anchor[i] for i in of], "print": [prints[i] for i in of], "first": inside[begin], "last": inside[end],
            "low": [names[k] for k in smallest[begin].tolist()]}


def grouped_windows(segments: DataFrame, length: int) -> DataFrame:
    """``sorted_buckets`` for buckets of any size: their windows one by one, equal ones combined before they are dealt."""
    first = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("first")
    each = segments.select("anchor", "print", "low", "high", "open", "bytes", first)
    each = each.withColumn("window", F.substring(F.col("bytes"), F.col("first") + 1, F.lit(length))).drop("bytes")
    least = each.groupBy("window").agg(F.min("low").alias("_low"))
    return each.join(least, "window").where("_low < high OR open AND _low IS NOT NULL").select(
        "anchor", "print", "first", F.col("first").alias("last"), F.col("_low").alias("low"))


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, hash, spans``: where strings of ``length`` bytes start that a document with a smaller id has too, stored.

    ``spans`` are (``start``, ``stop``) in bytes of what such strings cover, in no order; they may overlap. Texts without any are left out.
    """
    with finished_shuffles_freed(ready(docs.sparkSession)):
        return _repeated_spans(docs, length)


def _repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    spark = docs.sparkSession

    def put(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = work_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    rows, rows_path = put(anchored(docs, length), "anchored")
    wanted = shared_anchors(rows)
    names = stored(wanted.select("row", "doc_id", "hash"), "names")
    discard(spark, rows_path)  # by far the largest tables go as soon as they are used
    found = stored(occurrences(docs, wanted, length), "occurrences")
    # Equal segments are one, with an occurrence that stands for it.
    distinct = stored(found.groupBy("anchor", "print").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bool_or(F.col("doc_id").isNull()).alias("open"),
        F.min("row").alias("row"), F.min_by("place", "row").alias("place")), "distinct")
    sizes = stored(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    # A bucket of one segment needs no sorting: all its windows have the segment's documents.
    alone = distinct.join(sizes.hint("shuffle_hash"), "anchor", "left_anti").where("low < high OR open AND low IS NOT NULL")
    alone = alone.select("anchor", "print", F.lit(0).alias("first"), (F.col("place").bitwiseAND(F.lit((1 << RUN_BITS) - 1)) - 1).cast("int").alias("last"), "low")
    chosen = distinct.join(sizes.hint("shuffle_hash"), "anchor")
    segments, segments_path = put(with_bytes(docs, chosen, names, length), "segments")
    hot = small_side(stored(sizes.where(F.col("n") > HOT).select("anchor"), "hot"))
    plain = sorted_buckets(segments.join(hot, "anchor", "left_anti"), length, id_type(docs))
    runs = stored(alone.unionByName(plain).unionByName(grouped_windows(segments.join(hot, "anchor", "left_semi"), length)), "runs")
    discard(spark, segments_path)
    start = F.shiftright("place", RUN_BITS)
    repeated = found.join(runs, ["anchor", "print"]).where("low < doc_id OR doc_id IS NULL")
    spans = repeated.groupBy("row").agg(F.collect_list(F.struct(
        (start + F.col("first")).alias("start"), (start + F.col("last") + length).alias("stop"))).alias("spans"))
    return stored(spans.join(names, "row").drop("row"), "spans")


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    Each byte goes that a ``length``-byte string covers which also starts in a document with a smaller id; ``n_spans`` counts
    maximal removed runs. Texts are judged as they came in. Null texts are empty, texts shorter than ``length`` stay whole, rows
    that share an id never take from each other, a row without id counts as larger than all ids, so rows without id keep
    what only they share. Repeated rows give repeated rows, an empty table gives an empty result, other columns are left
    behind. Ids must be of a type that Spark and Python order alike.
    """
    spans = repeated_spans(docs, length).withColumnsRenamed({"doc_id": "_id", "hash": "_hash"}).hint("shuffle_hash")
    texts = texts_of(docs)
    judged = texts.join(spans, texts["doc_id"].eqNullSafe(spans["_id"]) & (texts["hash"] == spans["_hash"]), "left")

    def rows(batches):
        for b in batches:
            out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept")}
            for data, found in zip(b["data"].to_pylist(), b["spans"]):
                n_spans, removed, kept = 0, 0, data
                if found.is_valid:
                    pairs = found.values
                    starts, stops = (pairs.field(f).to_numpy(zero_copy_only=False) for f in ("start", "stop"))
                    by = np.argsort(starts, kind="stable")
                    starts, reach = starts[by], np.maximum.accumulate(stops[by])
                    fresh = np.append(True, starts[1:] > reach[:-1])
                    begin = starts[fresh].tolist()
                    end = reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)].tolist()
                    n_spans, removed = len(begin), sum(end) - sum(begin)
                    kept = b"".join([data[i:j] for i, j in zip([0, *end], [*begin, len(data)])])
                for name, value in zip(out, (len(data), removed, n_spans, kept), strict=True):
                    out[name].append(value)
            yield out | {"doc_id": b["doc_id"]}

    schema = f"doc_id {id_type(docs)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return by_arrow(judged.select("doc_id", "data", "spans"), rows, schema)
