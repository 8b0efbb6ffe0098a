"""Documents whose sets of word n-grams are similar, found by partitioning the universe of n-grams.

A document is the set of its hashed n-grams; equal sets form one class. Two sets of sizes ``s1 <= s2`` with Jaccard
similarity of at least ``num / den`` differ in at most ``(s1 + s2) (den - num) / (den + num)`` elements, and
``s1 >= s2 num / den``. Sizes are cut into bands such that such a pair lies in one band or in two adjacent ones; group ``k``
holds the sets of bands ``k`` and ``k + 1`` and allows for ``H`` differences between a set of band ``k`` and its partners.

In a group the universe of hashes is cut into segments, the same for all its sets. Segment 0, the lead, is wide; a set is
indexed there by its subset and by each subset with one element deleted, which finds all partners that differ by one element
in it. In the other ``H + s - 1`` segments a set is indexed by its subset alone. A pair that is not found in the lead has at
least two of its differences there, hence at most ``H - 2`` in the others, so at least ``s + 1`` of these are equal. That
leaves ``s`` segments to save: of its subsets that others share, each set drops the ``s`` with the longest lists. Lists of equal
subsets are equally long, so both sets of a pair rank them alike and never drop more than ``s`` of the ``s + 1``.

What meets in a list is checked exactly. First every set is checked with one set of each list, its centre. Then, for lists
whose sets have not yet come together, the sets of smaller components are checked with those of larger ones, in blocks of
sets that have the same smallest centre. No list is ever expanded into its pairs. Sketches of 256 counts, which bound the
number of differences from below, come first; only the sets of pairs that they leave are made again and compared.

Hashes have 64 bits: two different n-grams of a pair coincide with a chance below 1e-12, two of all sets of 3e10 documents with
one of about 1e-9 a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import discard, finished_shuffles_freed, id_type, map_rows, ready, small_side, stored, texts_of
from shelfspark.llm.components import components
from shelfspark.llm.encoding import LOWER
from shelfspark.session import work_path

#: Sets compared at a time in a block of a large component, and probes that share one copy of a block.
BLOCK, PROBES = 256, 512
LEAD_ELEMENTS = 8
#: A group with H differences spares each set 1 + H / SPARED of its subsets: what sets without partners share by chance.
SPARED = 8
MEMO = 250_000
#: A signature keeps its group and whether it is of the lead in the lowest bits.
LOW_BITS = 9


def mix(z: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word ``size``-grams of a text; a shorter text is one gram of all its words."""

    def __init__(self, size: int):
        import xxhash

        self.size, self.hash, self.memo = size, xxhash.xxh3_64_intdigest, {}

    def tokens(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").translate(LOWER).split()
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = self.hash(w)
        h = np.fromiter((memo[w] for w in words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(h))
        if not size:
            return h
        grams = mix(h[: len(h) - size + 1] + np.uint64(size))
        for k in range(1, size):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
        return np.unique(grams)


def class_of(tokens: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


class Bands:
    """The size bands and segment plans of a similarity ``num / den``."""

    def __init__(self, num: int, den: int, largest: int = 1 << 40):
        self.starts = [1, 2]
        while self.starts[-1] <= largest:
            last = self.starts[-1]
            self.starts.append(max(last + 1, (last - 1) * den // num + 1))
        self.starts = np.array(self.starts, dtype=np.int64)
        self.differences, self.spared = [], []
        for top in (self.starts[1:] - 1).tolist():
            h = (top + top * den // num) * (den - num) // (den + num)
            self.differences.append(h)
            self.spared.append(1 + h // SPARED)
        self.edges: dict[int, np.ndarray] = {}

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def edges_of(self, group: int) -> np.ndarray:
        """Upper hash bounds of the segments of a group but for the last, the lead's first."""
        if group not in self.edges:
            segments = self.differences[group] + self.spared[group]
            smallest = int(self.starts[group])
            share = min(0.75, max(1 / segments, LEAD_ELEMENTS / smallest))
            rest = np.arange(segments - 1) / max(1, segments - 1)
            self.edges[group] = ((share + (1 - share) * rest) * 2.0**63).astype(np.uint64) * np.uint64(2)
        return self.edges[group]

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """All index entries of a set: in the group of its band and in the one below."""
        own = self.band(len(tokens))
        spread = mix(tokens)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(spread, dtype=np.uint64)])
        out = [np.zeros(0, dtype=np.uint64)]
        for group in (own - 1, own):
            if group < 0 or not self.differences[group]:
                continue
            cuts = np.concatenate([[0], np.searchsorted(tokens, self.edges_of(group)), [len(tokens)]])
            subsets = sums[cuts[1:]] - sums[cuts[:-1]]
            seed = np.uint64((group + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            lead = np.concatenate([subsets[:1], subsets[0] - spread[: cuts[1]]])
            places = np.arange(1, len(subsets), dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
            low = np.uint64((group & 0xFF) << 1)
            keep = ~np.uint64((1 << LOW_BITS) - 1)
            out += [(mix(lead + seed) & keep) | low | np.uint64(1), (mix(mix(subsets[1:] + seed) + places) & keep) | low]
        return np.concatenate(out)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) * den < num * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return den * both >= num * (len(a) + len(b) - both)


def sketch_of(tokens: np.ndarray) -> bytes:
    """How many elements fall on each of 256 residues, up to 255: the sum of differences of two such vectors is a lower
    bound of the number of elements in which the sets differ."""
    return np.minimum(np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def shingled(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Per row: ``doc_id, hash`` (of the text), ``n_shingles, cls`` and, at the first row of a class in a task, its signatures and sketch."""

    def rows(batches):
        shingler, bands, seen = Shingler(size), Bands(num, den), set()
        for b in batches:
            n, cls, sigs, sketches = [], [], [], []
            for text in b["text"]:
                tokens = shingler.tokens(text)
                n.append(len(tokens))
                cls.append(class_of(tokens) if len(tokens) else None)
                if len(tokens) and cls[-1] not in seen:
                    seen.add(cls[-1])
                    sigs.append(bands.signatures(tokens).view(np.int64))
                    sketches.append(sketch_of(tokens))
                else:
                    sigs.append(None)
                    sketches.append(None)
            yield {"doc_id": b["doc_id"], "hash": b["hash"], "n_shingles": n, "cls": cls, "sigs": sigs, "sketch": sketches}

    schema = f"doc_id {id_type(docs)}, hash bigint, n_shingles bigint, cls bigint, sigs array<bigint>, sketch binary"
    return map_rows(hashed(docs), rows, schema, batch=250)


def hashed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).withColumn("hash", F.xxhash64("text"))


def group_of(sig: Column) -> Column:
    return F.shiftright(sig, 1).bitwiseAND(F.lit(0xFF))


def lists(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Index entries that more than one class has, less those each class may spare: ``sig, cls, center, n``.

    ``center`` is the smallest class that keeps the entry, ``n`` the number of entries kept.
    """
    entries = rows.where("sigs is not null").select("cls", F.explode("sigs").alias("sig"))
    # Facts of an entry are combined before the shuffle; only entries that several classes have meet their classes again, and a
    # join splits a hot one.
    facts = entries.groupBy("sig").agg(F.min("cls").alias("_low"), F.max("cls").alias("_top"), F.count("*").alias("n"))
    facts = stored(facts.where("_low <> _top").select("sig", "n"), "facts")
    shared = entries.join(facts.hint("shuffle_hash"), "sig")
    costly = Window.partitionBy("cls", "_group").orderBy(F.desc("n"), "sig")
    bands = Bands(num, den)
    spared = F.array(*[F.lit(s) for s in bands.spared[:256]])
    kept = (
        stored(shared, "shared")
        .withColumn("_group", F.shiftleft(group_of(F.col("sig")), 1) + F.col("sig").bitwiseAND(F.lit(1)))
        .withColumn("_rank", F.dense_rank().over(costly))
        .where((F.col("sig").bitwiseAND(F.lit(1)) == 1) | (F.col("_rank") > F.get(spared, group_of(F.col("sig")).cast("int"))))
        .select("sig", "cls")
    )
    kept = stored(kept, "kept")
    left = kept.groupBy("sig").agg(F.min("cls").alias("center"), F.max("cls").alias("_top"), F.count("*").alias("n"))
    return stored(kept.join(left.where("center <> _top").drop("_top"), "sig"), "lists")


def sets_of(docs: DataFrame, rows: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``cls, tokens`` of the given classes, once each, made again from one text of each.

    A text is fetched by its row's id and its hash, so rows that share an id, or have none, bring no more than their own text.
    """
    chosen = rows.join(classes, "cls").groupBy("cls").agg(F.min(F.struct("doc_id", "hash")).alias("_of"))
    chosen = small_side(stored(chosen.select(F.col("cls").alias("_cls"), F.col("_of.doc_id").alias("_id"), F.col("_of.hash").alias("_hash")), "chosen"))
    texts = hashed(docs)
    wanted = texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["_id"]) & (texts["hash"] == chosen["_hash"])).select("_cls", "text")

    def again(batches):
        shingler, seen = Shingler(size), set()
        for b in batches:
            fresh = [(c, t) for c, t in zip(b["_cls"], b["text"], strict=True) if c not in seen]
            made = {c: t for c, t in ((c, shingler.tokens(t)) for c, t in dict(fresh).items()) if len(t) and class_of(t) == c}
            seen.update(made)
            yield {"cls": list(made), "tokens": [t.tobytes() for t in made.values()]}

    made = stored(map_rows(wanted, again, "cls bigint, tokens binary", batch=250), "sets")
    # Repeated rows may have been met in several tasks.
    repeated = made.groupBy("cls").count().where("count > 1")
    return made if repeated.isEmpty() else made.dropDuplicates(["cls"])


def meet(probes: DataFrame, targets: DataFrame, payload: DataFrame, compare, name: str) -> DataFrame:
    """Pairs ``a, b`` of probes with targets of the same ``key, part`` for which ``compare`` holds.

    Both have columns ``key, part, cls, rank``; ``payload`` has the rest of each ``cls``. The targets of a key and part must
    be few; they are held while its probes pass by. ``compare(probe, held)`` yields the places of the held rows that fit.
    """
    both = targets.select("key", "part", F.lit(0).alias("kind"), "cls", "rank").union(
        probes.select("key", "part", F.lit(1).alias("kind"), "cls", "rank"))
    dealt = both.join(payload, "cls").repartition("key", "part").sortWithinPartitions("key", "part", "kind")
    columns = ("key", "part", "kind", *payload.columns, "rank")

    def rows(batches: Iterator[dict]):
        at, held = None, []
        for b in batches:
            out_a, out_b = [], []
            for key, part, kind, *row in zip(*(b[c] for c in columns), strict=True):
                if (key, part) != at:
                    at, held = (key, part), []
                if kind == 0:
                    held.append(row)
                else:
                    for k in compare(row, held):
                        out_a.append(row[0])
                        out_b.append(held[k][0])
            yield {"a": out_a, "b": out_b}

    return stored(map_rows(dealt, rows, "a bigint, b bigint", batch=500).distinct(), name)


def maybe_linked(num: int, den: int):
    """Compare rows ``cls, n, sketch, rank``: targets of larger rank that sizes and sketches do not rule out."""
    last: list = [None, 0, None, None, None]

    def compare(probe, held):
        if not held:
            return []
        if last[0] is not held or last[1] != len(held):
            last[:] = [
                held, len(held), np.frombuffer(b"".join(h[2] for h in held), dtype=np.uint8).reshape(-1, 256).astype(np.int16),
                np.array([h[1] for h in held]), np.array([(h[3]["size"], h[3]["label"]) for h in held])]
        _, _, sketches, sizes, ranks = last
        n, size, label = probe[1], probe[3]["size"], probe[3]["label"]
        fits = (ranks[:, 0] > size) | (ranks[:, 0] == size) & (ranks[:, 1] > label)
        fits &= np.minimum(sizes, n) * den >= num * np.maximum(sizes, n)
        at = np.flatnonzero(fits)
        if len(at):
            apart = np.abs(sketches[at] - np.frombuffer(probe[2], dtype=np.uint8).astype(np.int16)).sum(axis=1)
            at = at[apart * (den + num) <= (sizes[at] + n) * (den - num)]
        return at.tolist()

    return compare


def surely_linked(num: int, den: int):
    """Compare rows ``cls, tokens, rank``."""

    def compare(probe, held):
        tokens = np.frombuffer(probe[1], dtype=np.uint64)
        return [k for k, h in enumerate(held) if linked(tokens, np.frombuffer(h[1], dtype=np.uint64), num, den)]

    return compare


def rank_of(size: Column, label: Column) -> Column:
    return F.struct(size.cast("bigint").alias("size"), label.cast("bigint").alias("label"))


def meet_pairs(pairs: DataFrame, payload: DataFrame, compare, name: str) -> DataFrame:
    """``meet`` for single pairs ``a, b``; a ``b`` with many pairs is dealt over several parts."""
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("parts"))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    targets = parts.select(F.col("b").alias("key"), each, F.col("b").alias("cls"), rank_of(F.lit(1), F.lit(0)).alias("rank"))
    dealt = F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part")
    probes = pairs.join(parts, "b").select(F.col("b").alias("key"), dealt, F.col("a").alias("cls"), rank_of(F.lit(0), F.lit(0)).alias("rank"))
    return meet(probes, targets, payload, compare, name)


def star_candidates(entries: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Each class with the smallest one of each of its lists."""
    pairs = stored(entries.where("cls <> center").select(F.col("cls").alias("a"), F.col("center").alias("b")).distinct(), "pairs")
    return meet_pairs(pairs, sketches, maybe_linked(num, den), "star")


def rest_candidates(entries: DataFrame, labels: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The classes of lists that hold several components, each with what it shares such lists with.

    The home of a class is the smallest centre of its lists: the classes of one family have few homes. A class meets, block
    by block, all classes of the homes it shares a list with, and is compared with those of larger components.
    """
    homes = entries.groupBy("cls").agg(F.min("center").alias("home"))
    named = homes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    named = stored(named, "named")
    sizes = named.groupBy("label").agg(F.count("*").alias("size"))
    # In a list of two classes, each has met the other already.
    open_ = entries.where("n > 2").select("sig", "cls").join(named, "cls").join(sizes, "label")
    open_ = stored(open_.select("sig", "cls", "home", rank_of(F.col("size"), F.col("label")).alias("rank")), "open")
    largest = open_.groupBy("sig", "home").agg(F.max("rank").alias("top"))
    pairs = open_.select("sig", "cls", "rank").join(largest, "sig").where(F.col("top") > F.col("rank"))
    pairs = stored(pairs.select(F.col("home").alias("key"), "cls", "rank").distinct(), "pairs")
    members = named.join(sizes, "label").select(F.col("home").alias("key"), "cls", rank_of(F.col("size"), F.col("label")).alias("rank"))
    counts = pairs.groupBy("key").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("salts"))
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(counts, "key")

    def spread(salt: Column, block: Column) -> Column:
        return (salt * F.col("blocks") + block).cast("int").alias("part")

    salts, blocks = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("salts", "blocks"))
    probes = pairs.join(counts, "key").withColumn("_block", F.explode(blocks))
    probes = probes.select("key", spread(F.pmod(F.xxhash64("cls"), "salts"), F.col("_block")), "cls", "rank")
    targets = members.join(counts, "key").withColumn("_salt", F.explode(salts))
    targets = targets.select("key", spread(F.col("_salt"), F.pmod(F.xxhash64("cls"), "blocks")), "cls", "rank")
    return meet(probes, targets, sketches, maybe_linked(num, den), "rest")


#: Elements of the sets of a block while links are counted: what a task holds, and how seldom a set is sent anew.
COUNTED = 2_000_000


def counted_links(entries: DataFrame, sets: DataFrame, weights: DataFrame, num: int, den: int) -> DataFrame:
    """``cls, n_links``: rows of all other classes that each class is linked with.

    Two linked classes share a list. A class meets, block by block, the classes of the homes it shares lists with; a class has
    one home, so no pair meets twice. Pairs are counted where they meet and never written.
    """
    homes = entries.groupBy("cls").agg(F.min("center").alias("home"))
    pairs = entries.select("sig", "cls").join(homes, "cls")
    pairs = pairs.select("sig", F.col("home").alias("key")).distinct().join(entries.select("sig", "cls"), "sig").select("key", "cls").distinct()
    pairs = stored(pairs, "met")
    elements = sets.select("cls", (F.octet_length("tokens") / 8).alias("_size"))
    sizes = homes.join(elements, "cls").groupBy(F.col("home").alias("key")).agg(F.ceil(F.sum("_size") / COUNTED).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("cls"), "blocks").cast("int")
    targets = homes.withColumnRenamed("home", "key").join(sizes, "key").select("key", block.alias("part"), F.lit(0).alias("kind"), "cls")
    probes = pairs.join(sizes, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(1).alias("kind"), "cls")
    dealt = targets.union(probes).join(sets, "cls").join(weights, "cls").repartition("key", "part").sortWithinPartitions("key", "part", "kind")
    columns = ("key", "part", "kind", "cls", "tokens", "weight")

    def rows(batches: Iterator[dict]):
        at, held, index = None, [], None
        for b in batches:
            found, n = [], []
            for key, part, kind, cls, tokens, weight in zip(*(b[c] for c in columns), strict=True):
                if (key, part) != at:
                    at, held, index = (key, part), [], None
                tokens = np.frombuffer(tokens, dtype=np.uint64)
                if kind == 0:
                    held.append((cls, tokens, weight))
                elif held:
                    index = index or indexed(held)
                    found.append(cls)
                    n.append(linked_weight(cls, tokens, index, num, den))
            yield {"cls": found, "n": n}

    met = map_rows(dealt, rows, "cls bigint, n bigint", batch=500)
    return met.groupBy("cls").agg(F.sum("n").alias("n_links"))


def indexed(held: list[tuple[int, np.ndarray, int]]) -> tuple[np.ndarray, ...]:
    """All elements of the held sets in order, whose they are, and classes, sizes and weights of the sets."""
    sizes = np.array([len(t) for _, t, _ in held])
    elements, owner = np.concatenate([t for _, t, _ in held]), np.repeat(np.arange(len(held)), sizes)
    order = np.argsort(elements, kind="stable")
    return elements[order], owner[order], np.array([c for c, _, _ in held]), sizes, np.array([w for _, _, w in held])


def linked_weight(cls: int, tokens: np.ndarray, index: tuple[np.ndarray, ...], num: int, den: int) -> int:
    elements, owner, classes, sizes, weights = index
    low, high = np.searchsorted(elements, tokens, "left"), np.searchsorted(elements, tokens, "right")
    counts = high - low
    places = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    both = np.bincount(owner[places], minlength=len(classes))
    fits = (den * both >= num * (sizes + len(tokens) - both)) & (classes != cls)
    return int(weights[fits].sum())


def jaccard_join(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, links: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, cls, component_id`` and, if ``links``, ``n_links``.

    Rows link when ``den * intersection >= num * union`` of their sets; ``component_id`` is the smallest ``doc_id`` reachable by
    links, itself included. ``cls`` is the id of the set and ``n_links`` the number of other rows this one is linked with, those
    with the same set included. Documents without words (null, empty, blank) have no class, link with nothing and keep
    their own id; null ids take part in links but never name a component unless all its ids are null. Repeated rows are rows
    of one class.
    """
    with finished_shuffles_freed(ready(docs.sparkSession)):
        labelled, firsts, known = _joined(docs, size, num, den, links)
    component = F.when(F.col("_part").isNull(), F.col("doc_id")).otherwise(F.col("_first"))
    out = labelled.join(firsts, "_part", "left").select("doc_id", "n_shingles", "cls", component.alias("component_id"))
    if known is None:
        return out
    return out.join(known, "cls", "left").select("doc_id", "n_shingles", "cls", "component_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _joined(docs: DataFrame, size: int, num: int, den: int, links: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Stored: rows with the part they belong to, the smallest id of each part, and the links of each class."""
    spark = docs.sparkSession
    path = work_path(spark, "shingled")
    rows = shingled(docs, size, num, den)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    plain = stored(rows.select("doc_id", "hash", "n_shingles", "cls"), "classes")
    entries = lists(rows, num, den)
    sketches = rows.where("sketch is not null").join(entries.select("cls").distinct(), "cls")
    sketches = stored(sketches.groupBy("cls").agg(F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch")), "sketches")
    discard(spark, path)  # the index entries are by far the largest table

    def verified(pairs: DataFrame) -> DataFrame:
        classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        return meet_pairs(pairs, sets_of(docs, plain, classes, size), surely_linked(num, den), "links")

    found = verified(star_candidates(entries, sketches, num, den))
    found = stored(found.union(verified(rest_candidates(entries, components(found), sketches, num, den))), "all-links")
    labels = components(found).withColumnRenamed("node", "cls")
    named = stored(plain.join(labels, "cls", "left").withColumn("_part", F.coalesce("label", "cls")).drop("label"), "labelled")
    firsts = stored(named.where("_part is not null").groupBy("_part").agg(F.min("doc_id").alias("_first")), "firsts")
    if not links:
        return named, firsts, None
    weights = plain.where("cls is not null").groupBy("cls").agg(F.count("*").alias("weight"))
    # Only classes of some link are counted: the others are linked with rows of their own class alone.
    tied = labels.select("cls")
    sets = sets_of(docs, plain, tied, size)
    others = counted_links(entries.join(tied, "cls", "left_semi"), sets, weights, num, den)
    known = weights.join(others, "cls", "left").select("cls", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return named, firsts, stored(known, "degrees")
