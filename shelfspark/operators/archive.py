"""Response archive as a table: eligibility, as-of lookups, last writes, statistics.

Archive: site, fingerprint, url, body, headers, response_class, status, crawl_date, put_ts, ttl_s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.groups import extreme_rows
from shelfspark.operators.messages import SPIDER_SUFFIX

# Seconds a response lives by default, and the bytes of a stored number.
DEFAULT_TTL = 432000
NUMBER_BYTES = 8


def set_name(spider: Column) -> Column:
    """Spider name up to its last suffix; null when it has none."""
    return F.when(spider.contains(SPIDER_SUFFIX), F.regexp_extract(spider, rf"(?s)^(.*){SPIDER_SUFFIX}", 1))


def eligible(responses: DataFrame, sites: list[str], enabled: bool = True) -> DataFrame:
    """Responses the archive takes part in (FIL7): listed site, no summary run."""
    on = F.lit(enabled) & F.col("site").isin(sites) & ~F.coalesce("summary", F.lit(False))
    return responses.where(on)


def storable(responses: DataFrame) -> DataFrame:
    """Fresh answers with status 200 (SRC3)."""
    return responses.where((F.col("status") == 200) & ~F.coalesce("cached", F.lit(False)))


def not_stored(responses: DataFrame, archive: DataFrame) -> DataFrame:
    """Responses whose fingerprint the archive lacks."""
    return responses.join(with_keys(archive, responses).select("fingerprint"), "fingerprint", "left_anti")


#: Up to so many keys are written into a scan's filter, where statistics, page indexes and bloom filters can use them.
SCAN_KEYS = 200


def bucket_of(fingerprint: Column, spread: int) -> Column:
    return F.pmod(F.xxhash64(fingerprint), F.lit(spread)).cast("int")


def with_keys(archive: DataFrame, wanted: DataFrame, spread: int | None = None) -> DataFrame:
    """Archive rows with a fingerprint of ``wanted``. A few keys are pushed into the scan, with the buckets they lie in where the
    archive is stored in ``spread`` buckets; more keys meet the rows in a join."""
    keys = wanted.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
    few = [r.fingerprint for r in keys.limit(SCAN_KEYS + 1).collect()]
    if len(few) > SCAN_KEYS:
        return archive.join(keys, "fingerprint", "left_semi")
    # Equalities, since a long IN list reaches the scan as its smallest and largest value only.
    rows = archive.where(any_of([F.col("fingerprint") == k for k in few]))
    if spread is None:
        return rows
    buckets = wanted.sparkSession.range(1).select(*[bucket_of(F.lit(k), spread) for k in few]).first() if few else []
    return rows.where(F.col("bucket").isin(sorted(set(buckets))))


def any_of(conditions: list[Column]) -> Column:
    """One OR of many conditions, no deeper than needed."""
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) // 2 * 2 :]
    return conditions[0] if conditions else F.lit(False)


def last_writes(puts: DataFrame, order: str = "put_ts", tie: str = "_row") -> DataFrame:
    """One row per fingerprint, the last one written (WIN9); ``tie`` settles equal times, else the order in which rows were stored.
    Only row keys are aggregated; bodies are fetched for the rows that stay."""
    return extreme_rows(puts, ["fingerprint"], order, last=True, tie=tie)


def as_of(lookups: DataFrame, puts: DataFrame, bucket_s: int = 3600) -> DataFrame:
    """Latest put at or before each lookup of the same fingerprint (``put_ts``, ``ttl_s``).

    ``lookups``: lookup_id, fingerprint, ts. Both sides are cut into time buckets: windows
    run inside one bucket of one fingerprint, and over the one row per bucket that carries
    its last put forward. A hot fingerprint spreads over its buckets.
    """
    bucket = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / bucket_s)
    put = F.struct(F.col("put_ts"), F.col("ttl_s"))
    stored = puts.select("fingerprint", F.col("put_ts").alias("ts"), "put_ts", F.coalesce("ttl_s", F.lit(None).cast("bigint")).alias("ttl_s"))
    marks = stored.select("fingerprint", "ts", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("lookup_id"), put.alias("_put")).unionByName(
        lookups.select("fingerprint", "ts", F.lit(1).alias("_kind"), F.col("lookup_id").cast("bigint").alias("lookup_id"),
                       F.lit(None).cast(stored.select(put.alias("p")).schema["p"].dataType).alias("_put"))
    ).withColumn("_bucket", bucket)
    inside = Window.partitionBy("fingerprint", "_bucket").orderBy("ts", "_kind", "_put.ttl_s").rowsBetween(Window.unboundedPreceding, 0)
    near = marks.withColumn("_near", F.last("_put", ignorenulls=True).over(inside)).where("_kind = 1")
    last = marks.groupBy("fingerprint", "_bucket").agg(F.max("_put").alias("_last"))
    before = Window.partitionBy("fingerprint").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    rows = near.join(carried, ["fingerprint", "_bucket"]).withColumn("_hit", F.coalesce("_near", "_carried"))
    return rows.select("lookup_id", "fingerprint", "ts", F.col("_hit.put_ts").alias("put_ts"), F.col("_hit.ttl_s").alias("ttl_s"))


def lookup_outcome(found: DataFrame, today: Column) -> DataFrame:
    """hit, fetch or expired (JN14). ``found``: as-of rows with crawl_date and never_expire.

    A record without ``ttl_s`` never expires. A miss is fetched today, or when the request
    never expires; for a past date it is expired.
    """
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("put_ts").cast("timestamp"))
    alive = F.col("put_ts").isNotNull() & (F.col("ttl_s").isNull() | (age < F.col("ttl_s") * 1000000))
    fetch = (F.col("crawl_date") == today) | F.coalesce("never_expire", F.lit(False))
    return found.withColumn("outcome", F.when(alive, "hit").when(fetch, "fetch").otherwise("expired"))


def stored_bytes(*columns: Column) -> Column:
    """Bytes of a record: texts by length."""
    total = F.lit(0).cast("bigint")
    for c in columns:
        total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total


def statistics(accesses: DataFrame) -> DataFrame:
    """Reads and writes per site with bytes (AGG14). ``accesses``: site, op, n_bytes, n_numbers."""
    size = F.col("n_bytes") + F.col("n_numbers") * NUMBER_BYTES
    return accesses.groupBy("site").agg(
        F.count_if(F.col("op") == "get").alias("get_count"), F.coalesce(F.sum(F.when(F.col("op") == "get", size)), F.lit(0)).alias("get_bytes"),
        F.count_if(F.col("op") == "put").alias("put_count"), F.coalesce(F.sum(F.when(F.col("op") == "put", size)), F.lit(0)).alias("put_bytes"))
