"""Grouped building blocks that keep a hot key out of any single task.

Group facts come from map-side combined aggregates joined back to the rows, so a
key with a third of the data is split by the adaptive skew join instead of being
sorted whole in one window partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegralType, StructField, StructType, TimestampNTZType, TimestampType

from shelfspark.session import written


def with_group_facts(df: DataFrame, keys: list[str], **facts: Column) -> DataFrame:
    """Attach per-group aggregates to every row."""
    return df.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in facts.items()]), keys)


def first_by(value: Column, order: Column) -> Column:
    """Aggregate: the first non-null value in ``order``."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def last_by(value: Column, order: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order))


def keyed(df: DataFrame) -> DataFrame:
    """``df`` stored once with ``_row``, a number of its own for each stored row."""
    return written(df.withColumn("_row", F.monotonically_increasing_id()), "keyed")


def few(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A stored table of a few numbers per row as the lesser side of a join: sent to all tasks up to ``most`` rows (a few MB),
    else hashed in shuffled parts, so that the wide side is never sorted."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df.hint("shuffle_hash")


_SPAN = Decimal(2**63)


def _ranked(df: DataFrame, order: str, last: bool = False, tie: str = "_row") -> Column:
    """Order and tie in one number, which a hash aggregate can compare; a missing order comes after (before) all others."""
    kind = df.schema[order].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        place = F.unix_micros(F.col(order).cast("timestamp"))
    elif isinstance(kind, DateType):
        place = F.unix_date(order)
    elif isinstance(kind, IntegralType):
        place = F.col(order).cast("bigint")
    else:
        raise TypeError(f"{order} must be a whole number, a date or a time, not {kind.simpleString()}")
    missing = -(2**63) if last else 2**63 - 1
    return F.coalesce(place, F.lit(missing)).cast("decimal(19,0)") * F.lit(_SPAN) + F.col(tie).cast("decimal(19,0)")


def extreme_rows(df: DataFrame, keys: list[str], order: str, last: bool = False, tie: str = "_row") -> DataFrame:
    """The whole first (last) row of each key in ``order``; of rows alike in it, the first (last) by the whole number ``tie``, or as stored.

    Late: a hash aggregate of numbers finds the row keys, and the rows are fetched by them. Wide values are neither sorted
    nor aggregated.
    """
    rows = keyed(df)
    pick = F.max_by if last else F.min_by
    found = rows.groupBy(*keys).agg(pick("_row", _ranked(df, order, last, tie)).alias("_row")).select("_row")
    return rows.join(few(written(found, "found")), "_row").select(*df.columns)


def first_values(df: DataFrame, keys: list[str], firsts: dict[str, Column], order: str, facts: dict[str, Column] | None = None) -> DataFrame:
    """One row per key: the first non-null value in ``order`` of each of ``firsts``, and the aggregates ``facts``.

    Late, as ``extreme_rows``: one hash aggregate finds the facts and the row of each first value; only those rows, at most one
    per value, are fetched and put together.
    """
    rows = keyed(df)
    rank = _ranked(df, order)
    marks = {n: f"_m{i}" for i, n in enumerate(firsts)}
    found = rows.groupBy(*keys).agg(
        F.min("_row").alias("_key"), *[F.min_by("_row", F.when(v.isNotNull(), rank)).alias(marks[n]) for n, v in firsts.items()],
        *[c.alias(n) for n, c in (facts or {}).items()])
    found = written(found, "found")
    wins = found.select("_key", F.explode(F.array_distinct(F.array_compact(F.array(*marks.values())))).alias("_row"))
    values = rows.select("_row", F.struct(*[v.alias(n) for n, v in firsts.items()]).alias("_values")).join(few(wins), "_row")
    listed = values.groupBy("_key").agg(F.collect_list(F.struct("_row", "_values")).alias("_rows"))

    def at(mark: str, name: str) -> Column:
        return F.get(F.filter("_rows", lambda r: r["_row"] == F.col(mark)), F.lit(0))["_values"][name]

    out = found.join(listed, "_key", "left")
    return out.select(*keys, *[at(m, n).alias(n) for n, m in marks.items()], *(facts or {}))


def with_prefix(counts: DataFrame, keys: list[str], index: str, size: str, out: str, base: int = 4096) -> DataFrame:
    """Sum of ``size`` over smaller ``index`` values of the same key, in two levels.

    ``counts`` has one row per key and integer index. Windows run inside blocks of
    ``base`` indexes and over the blocks, so no task sorts a whole hot key.
    """
    # A block that cannot be null spares null filters that would keep Spark from reusing the counts.
    blocks = counts.withColumn("_block", F.coalesce(F.floor(F.col(index) / base), F.lit(0)))
    inner = Window.partitionBy(*keys, "_block").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocks.groupBy(*keys, "_block").agg(F.sum(size).alias("_total"))
        .withColumn("_above", F.coalesce(F.sum("_total").over(outer), F.lit(0)))
        .drop("_total")
    )
    inside = blocks.withColumn("_inside", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    return (
        inside.join(totals, [*keys, "_block"])
        .withColumn(out, F.col("_above") + F.col("_inside"))
        .drop("_above", "_inside", "_block")
    )


#: Columns of sliced rows: slice, place in the slice, place in the key's run there, and whether the slice ends with the row.
SLICED = {"_slice": "int", "_at": "bigint", "_rn": "bigint", "_ends": "boolean"}


def _differs(column: pa.Array, before: pa.Array) -> np.ndarray:
    """Per row whether two columns differ; nulls are equal to each other, and so are NaNs."""
    if pa.types.is_nested(column.type):
        return np.array([x != y for x, y in zip(column.to_pylist(), before.to_pylist(), strict=True)], dtype=bool)
    same = pc.equal(column, before)
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.and_(pc.is_nan(column), pc.is_nan(before)))
    same = pc.fill_null(same, False)
    return ~pc.or_(same, pc.and_(column.is_null(), before.is_null())).to_numpy(zero_copy_only=False)


def _with_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one slice with ``_at``, ``_rn`` and ``_ends``, batch by batch; only the last row's keys are carried on."""
    last, at, run, held = None, 0, 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        fresh = np.zeros(n, dtype=bool)
        for k in keys:
            before = batch[k].slice(0, n - 1) if last is None else pa.concat_arrays([last[k], batch[k].slice(0, n - 1)])
            fresh[n - len(before):] |= _differs(batch[k].slice(n - len(before)), before)
        fresh[0] |= last is None
        places = np.arange(n, dtype=np.int64)
        # ``run`` rows of the current key came before this batch.
        starts = np.maximum.accumulate(np.where(fresh, places, -run))
        rn = places - starts
        if held is not None:
            yield held
        ends = np.zeros(n, dtype=bool)
        made = {"_at": places + at, "_rn": rn, "_ends": ends}
        held = pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made.values())], [*batch.schema.names, *made])
        last, at, run = {k: batch[k].slice(n - 1, 1) for k in keys}, at + n, int(rn[-1]) + 1
    if held is not None:
        ends = pa.array(np.arange(held.num_rows) == held.num_rows - 1)
        yield held.set_column(held.num_columns - 1, "_ends", ends)


def sliced(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in slices of a range partitioning by key and order, numbered in one pass while each slice is written, with ``_shift``.

    A slice goes on with at most one key of the slices before it, its first; ``_shift`` is the number of rows that key has there
    (0 for all other keys). The table of shifts has one row per slice, which is why it is sent to all tasks.
    """
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_slice", F.spark_partition_id())
    fields = [*spread.schema.fields, *StructType.fromDDL("_at bigint, _rn bigint, _ends boolean").fields]
    rows = written(spread.mapInArrow(lambda batches: _with_runs(batches, keys), StructType(fields)), "sliced")
    # First and last row of each slice; the last one tells how many rows of its key the slice has.
    edges = rows.where("_at = 0 OR _ends").groupBy(*keys, "_slice").agg(
        F.max(F.when(F.col("_ends"), F.col("_rn") + 1)).alias("_n"), F.bool_or(F.col("_at") == 0).alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = edges.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where("_first AND _shift > 0").select("_slice", "_shift")
    shift = F.when(F.col("_at") == F.col("_rn"), F.col("_shift"))
    return rows.join(F.broadcast(shifts), "_slice", "left").withColumn("_shift", F.coalesce(shift, F.lit(0)))


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """0-based position inside each key, exact for keys of any size.

    One shuffle: rows are range-partitioned by key and order, numbered slice by slice as they are written, and shifted by the rows
    of the same key in earlier slices.
    """
    rows = sliced(df, keys, order)
    return rows.withColumn(out, F.col("_rn") + F.col("_shift")).drop(*SLICED, "_shift")


def _listed(batches: Iterator[pa.RecordBatch], keys: list[str], value: str, size: int, out: str) -> Iterator[pa.RecordBatch]:
    """Pieces of lists from numbered rows: keys, chunk, the place of the first value, the values, and whether nothing is missing.

    A piece is whole if it begins with its chunk and is full, or the next row of the same slice belongs to another key.
    """
    rest = None
    for batch in _and_end(batches):
        if batch is not None and not batch.num_rows:
            continue
        rows = batch if rest is None else rest if batch is None else pa.concat_batches([rest, batch])
        if rows is None:
            return
        slice_, at, rn, pos = (rows[c].to_numpy() for c in ("_slice", "_at", "_rn", "_pos"))
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = (slice_[1:] == slice_[:-1]) & (at[1:] == at[:-1] + 1)
        begins = np.flatnonzero(~follows | (rn == 0) | (pos % size == 0))
        ends = np.append(begins[1:], len(at))
        done = len(begins) if batch is None else len(begins) - 1
        stop = int(ends[done - 1]) if done else 0
        rest = rows.slice(stop)
        begins, ends = begins[:done], ends[:done]
        other = np.append(follows & (rn == 0), False)[ends]
        whole = (pos[begins] % size == 0) & ((ends - begins == size) | other)
        values = rows[value].slice(0, stop)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, stop).astype(np.int32)), values)
        take = pa.array(begins)
        columns = {k: rows[k].take(take) for k in keys} | {
            "chunk": pa.array(pos[begins] // size), "_from": pa.array(pos[begins]), "_whole": pa.array(whole), out: lists}
        yield pa.RecordBatch.from_pydict(columns)
        if batch is None:
            return


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def chunked_lists(df: DataFrame, keys: list[str], order: list[str], value: str, size: int, out: str) -> DataFrame:
    """Ordered values of each key as arrays of at most ``size``, numbered from chunk 0.

    Lists are made where the numbered rows lie. Only a list that a slice, or a part of it that a task reads, cuts in two is put
    together by a grouping, of at most two pieces per part.
    """
    rows = sliced(df.select(*keys, *[o for o in order if o not in keys], F.col(value).alias("_value")), keys, order)
    placed = rows.withColumn("_pos", F.col("_rn") + F.col("_shift")).select(*keys, "_slice", "_at", "_rn", "_pos", "_value")
    fields = {f.name: f for f in placed.schema}
    schema = StructType([
        *[fields[k] for k in keys], *StructType.fromDDL("chunk bigint, _from bigint, _whole boolean").fields,
        StructField(out, ArrayType(fields["_value"].dataType))])
    pieces = written(placed.mapInArrow(lambda batches: _listed(batches, keys, "_value", size, out), schema), "lists")
    parts = F.sort_array(F.collect_list(F.struct("_from", F.col(out).alias("_part"))))
    joined = pieces.where("NOT _whole").groupBy(*keys, "chunk").agg(F.flatten(F.transform(parts, lambda p: p["_part"])).alias(out))
    return pieces.where("_whole").select(*keys, "chunk", out).unionByName(joined)


def where_once(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on expensive columns that is not pushed below them, where they would be computed twice."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.array_compact(F.array(F.when(condition, row)))))


def fallback(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``primary`` where a key has any, else those of ``secondary``."""
    return primary.unionByName(secondary.join(primary.select(*keys).distinct(), keys, "left_anti"))
