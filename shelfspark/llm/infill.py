"""Fill-in-middle: documents cut into prefix, middle and suffix, and put together again in another order.

All work on texts is a pipeline of Arrow kernels over whole batches: units are split into list arrays, flattened with the index
of their parent, numbered inside it, filtered by role, gathered into lists again and joined into one piece per row.

A text's units are words with the white space before them, and trailing white space. Where it is cut and in which form it is
put together follow from SHA-256 over a seed and its ``doc_id``, so a repeated run gives the same output.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import give_back, id_type, texts_of

# The marks, and the pattern of a unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

#: Rows a batch is cut into; its bytes are bounded by ``common.BATCH_BYTES``, but for a single longer text.
ROWS = 1000


def drawn(seed: int, doc_id: Column, k: int) -> Column:
    """The ``k``-th 8-digit group of the hash of seed and id as an unsigned number; a missing id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")


def separator(texts: pa.Array) -> str:
    """A string that is in none of ``texts``. Its first character is in no other place of it, so wherever it is put between
    two pieces of them, no second occurrence arises across its ends."""
    n = 1
    while pc.any(pc.match_substring(texts, "\x00" + "\x01" * n)).as_py():
        n += 1
    return "\x00" + "\x01" * n


def units_of(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The units of all texts in a row, the index of the text each belongs to, its ordinal there, and the units per text."""
    mark = separator(texts)
    lists = pc.split_pattern(pc.replace_substring_regex(texts, UNIT, rf"\0{mark}"), mark)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # Each unit is followed by the mark, so what comes after the last one is an empty rest.
    counts = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    firsts = pc.subtract(pc.cumulative_sum(pc.add(counts, 1)), pc.add(counts, 1))
    ordinals = pc.subtract(pa.array(range_of(len(flat))), pc.take(firsts, parents))
    inside = pc.less(ordinals, pc.take(counts, parents))
    return flat.filter(inside), parents.filter(inside), ordinals.filter(inside), counts


def range_of(n: int):
    import numpy as np

    return np.arange(n, dtype=np.int64)


def joined(units: pa.Array, counts: pa.Array) -> pa.Array:
    """One string per text from its next ``counts`` units."""
    ends = pc.cumulative_sum(counts.cast(pa.int64()))
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units), pa.scalar("", pa.large_string()))


def glued(*pieces) -> pa.Array:
    parts = [pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in pieces]
    return pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))


def transformed(batch: pa.RecordBatch, plain_share: int, spm_share: int) -> dict[str, pa.Array]:
    """Columns of the output for rows with ``text`` and the numbers ``h1`` to ``h4``."""
    texts = batch["text"].cast(pa.large_string())
    flat, parents, ordinals, n = units_of(texts)
    divisor = pc.add(n, 1)
    one, two = (pc.subtract(batch[h], pc.multiply(pc.divide(batch[h], divisor), divisor)) for h in ("h1", "h2"))
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    in_prefix = pc.less(ordinals, pc.take(low, parents))
    in_suffix = pc.greater_equal(ordinals, pc.take(high, parents))
    prefix = joined(flat.filter(in_prefix), low)
    middle = joined(flat.filter(pc.invert(pc.or_(in_prefix, in_suffix))), pc.subtract(high, low))
    suffix = joined(flat.filter(in_suffix), pc.subtract(n, high))

    marked = pc.match_substring_regex(texts, "|".join((PREFIX, SUFFIX, MIDDLE)))
    of_hundred = lambda h: pc.subtract(batch[h], pc.multiply(pc.divide(batch[h], 100), 100))
    plain = pc.or_(pc.or_(pc.equal(pc.binary_length(texts), 0), marked), pc.greater_equal(of_hundred("h3"), 100 - plain_share))
    spm = pc.less(of_hundred("h4"), spm_share)
    large = lambda s: pa.scalar(s, pa.large_string())
    form = pc.if_else(plain, large("plain"), pc.if_else(spm, large("spm"), large("psm")))
    suffix_first = glued(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    prefix_first = glued(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    chars = lambda a: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(a).cast(pa.int64()))
    return {
        "n": n, "form": form, "prefix_chars": chars(prefix), "middle_chars": chars(middle),
        "output": pc.if_else(plain, texts, pc.if_else(spm, suffix_first, prefix_first))}


def rebuilt(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that ``transformed`` gave ``output`` and ``form`` for. No text holds a mark, and none starts inside another."""
    output = output.cast(pa.large_string())

    def text(one: str, two: str) -> pa.Array:
        found = pc.extract_regex(output, rf"(?s)\A{one}(?P<one>.*?){two}(?P<two>.*?){MIDDLE}(?P<middle>.*)\z")
        pieces = {k: pc.struct_field(found, [k]) for k in ("one", "two", "middle")}
        return glued(*(pieces[k] for k in (("one", "middle", "two") if one == PREFIX else ("two", "middle", "one"))))

    return pc.if_else(pc.equal(form, "psm"), text(PREFIX, SUFFIX), pc.if_else(pc.equal(form, "spm"), text(SUFFIX, PREFIX), output))


def by_arrow(df: DataFrame, columns, schema: str, drop: tuple[str, ...]) -> DataFrame:
    """``df`` without ``drop`` and with the columns that ``columns(batch)`` makes, batch by batch in Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                kept = {n: batch[n] for n in batch.schema.names if n not in drop}
                made = {n: c.cast(pa.string()) if c.type == pa.large_string() else c for n, c in columns(batch).items()}
                yield pa.RecordBatch.from_pydict(kept | made)
        give_back()

    return df.mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, seed: int = 42, plain_share: int = 50, spm_share: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts units. ``plain_share`` of a hundred texts stay as they are, ``spm_share`` of a hundred others lead with the
    suffix. Texts that are empty or null (taken as empty) or hold a mark are always plain; of plain texts the lengths are null.
    Repeated rows give repeated rows, rows without id are drawn as if their id had no digits, an empty table gives an empty
    result, and other columns are left behind.
    """
    rows = texts_of(docs).select("*", *[drawn(seed, F.col("doc_id"), k).alias(f"h{k}") for k in (1, 2, 3, 4)])
    schema = f"doc_id {id_type(docs)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return by_arrow(rows, lambda b: transformed(b, plain_share, spm_share), schema, drop=("text", "h1", "h2", "h3", "h4"))


def restored(made: DataFrame) -> DataFrame:
    """``fill_in_middle`` rows with ``restored``: the text before, read back from ``output`` and ``form`` alone."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema) + ", restored string"
    return by_arrow(made, lambda b: {"restored": rebuilt(b["output"], b["form"])}, schema, drop=())
