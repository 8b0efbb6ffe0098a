"""Stateful fragment merge (ST1), the streaming twin of ``operators.merge``.

Fragments: guid, ts, kind ('request' or 'response'), fingerprint, initial, ok, seq and one
text column per field. An item leaves as soon as nothing is outstanding; one that stays
silent leaves incomplete when its time is over, so no state is kept for ever.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

#: Open items of a bucket: requests, last event time, open requests by fingerprint, and the first value of each field with its place.
STATE = ("items array<struct<guid: string, requests: bigint, seen: bigint, open: map<string, bigint>, "
         "best: map<string, struct<seq: bigint, value: string>>>>")

#: Buckets of items by their key; all runs over one checkpoint use the same number.
BUCKETS = 1024


def outstanding(open_: dict[str, int]) -> int:
    return sum(n for n in open_.values() if n > 0)


def fold(items: dict[str, list], rows: pd.DataFrame, fields: list[str], now: int) -> set[str]:
    """Bring ``items`` (requests, seen, open, best by guid) up to date with fragments of any of them; the guids that were met."""
    met = set()
    columns = (rows[c].tolist() for c in ("guid", "_ms", "kind", "fingerprint", "initial", "ok", "seq", *fields))
    for guid, ms, kind, name, initial, ok, seq, *values in zip(*columns):
        if guid not in met:
            met.add(guid)
            item = items.setdefault(guid, [0, now, {}, {}])
            item[1] = max(item[1], now)
        item = items[guid]
        if ms > item[1]:
            item[1] = ms
        open_, best = item[2], item[3]
        if kind == "request":
            item[0] += 1
            open_[name] = open_.get(name, 0) + 1
        elif ok or not initial:
            # A failed answer settles a request, except the initial one.
            open_[name] = open_.get(name, 0) - 1
        if not open_.get(name, 1):
            del open_[name]
        if kind == "response" and ok:
            for field, value in zip(fields, values):
                if value is not None and (field not in best or seq < best[field][0]):
                    best[field] = (seq, value)
    return met


def merged_stream(fragments: DataFrame, fields: list[str], silence: int = 3600, delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """guid, complete, outstanding and the fields; ``silence`` in seconds of event time.

    A fragment delivered again (same item, kind, fingerprint, place and time) within ``delay`` is left out before the merge. Items
    are merged a bucket at a time, since a call of its own costs an item far more than its fragments do. The open items of a bucket
    travel with its rows, typed, and are read and written once a micro-batch; finished ones leave no state.
    """
    schema = StructType([StructField("guid", StringType()), StructField("complete", BooleanType()), StructField("outstanding", LongType())]
                        + [StructField(f, StringType()) for f in fields])
    wait = silence * 1000

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        items = {guid: [requests, seen, dict(open_), dict(best)] for guid, requests, seen, open_, best in state.get[0]} if state.exists else {}
        met = set()
        if not state.hasTimedOut:
            for rows in batches:
                met |= fold(items, rows, fields, now)
        left = [(guid, True) for guid in met if items[guid][0] and not outstanding(items[guid][2])]
        # Silence counts from the item's own last event: the watermark is still 0 in the first micro-batch.
        left += [(guid, False) for guid, item in items.items() if guid not in met and item[1] + wait <= now]
        out = []
        for guid, complete in left:
            _, _, open_, best = items.pop(guid)
            out.append((guid, complete, outstanding(open_), *(best[f][1] if f in best else None for f in fields)))
        if out:
            yield pd.DataFrame(out, columns=schema.names)
        if items:
            state.update(([(guid, *item) for guid, item in items.items()],))
            state.setTimeoutTimestamp(min(item[1] for item in items.values()) + wait)
        elif state.exists:
            state.remove()

    rows = fragments.select("guid", F.col("ts").cast("timestamp").alias("ts"), "kind", "fingerprint", "initial", "ok", "seq", *fields)
    rows = rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["guid", "kind", "fingerprint", "seq", "ts"])
    # Numbers without nulls stay whole in pandas; an answer without a place comes last.
    rows = rows.withColumns({
        "_ms": F.coalesce(F.unix_millis("ts"), F.lit(0)), "seq": F.coalesce("seq", F.lit(2**63 - 1)), "_bucket": F.pmod(F.xxhash64("guid"), F.lit(buckets))})
    return rows.groupBy("_bucket").applyInPandasWithState(merge, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
