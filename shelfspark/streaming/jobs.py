"""Streaming job log (ST3), the twin of ``operators.joblog.job_log``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators.groups import extreme_rows, first_values
from shelfspark.operators.joblog import fold_columns, settle
from shelfspark.streaming.runs import drain_batches


def folded_stream(events: DataFrame, horizon: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Partial folds per job and horizon; state leaves once the watermark passes the horizon."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    folds = [c.alias(n) for n, c in fold_columns(F.col("ord")).items()]
    return timed.groupBy("job_id", F.window("ts", horizon).alias("horizon")).agg(*folds).withColumn("horizon", F.col("horizon.start"))


#: Batches that may wait to be merged into the settled folds.
MERGE_AFTER = 8
_FOLD = ["job_id", "horizon"]


def run_job_log(events: DataFrame, path: str, checkpoint: str, horizon: str = "1 day") -> None:
    """Keep the last version of each fold (ST3).

    A micro-batch stores its changed folds by number; writing a batch again replaces it. After ``MERGE_AFTER`` batches, and when
    the run ends, the last versions become one new base and what it supersedes goes, so storage grows with the jobs, not with
    their changes.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id % MERGE_AFTER == MERGE_AFTER - 1:
            merge_folds(spark, path)

    drain_batches(folded_stream(events, horizon), write, checkpoint, mode="update")
    merge_folds(spark, path)


def _parts(spark: SparkSession, path: str) -> dict[int, tuple[bool, str]]:
    """Finished folders by batch number: whether it is a base, and its place. Batches up to the last base are superseded by it."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, tuple[bool, str]] = {}
    for status in files.listStatus(root) if files.exists(root) else []:
        kind, _, number = status.getPath().getName().partition("=")
        place = f"{path}/{kind}={number}"
        if kind in ("base", "batch") and files.exists(jvm.Path(f"{place}/_SUCCESS")):
            found[int(number)] = max(found.get(int(number), (False, "")), (kind == "base", place))
    last = max((n for n, (base, _) in found.items() if base), default=-1)
    return {n: part for n, part in found.items() if n >= last}


def _folds(spark: SparkSession, parts: dict[int, tuple[bool, str]]) -> DataFrame:
    """Last version of each fold."""
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(place).withColumn("batch", F.lit(n)) for n, (_, place) in sorted(parts.items())])
    return extreme_rows(rows, _FOLD, "batch", last=True).drop("batch")


def merge_folds(spark: SparkSession, path: str) -> None:
    """One base of all finished batches; a broken merge leaves no finished base, and the batches stay."""
    parts = _parts(spark, path)
    if len(parts) > 1 or parts and not next(iter(parts.values()))[0]:
        _folds(spark, parts).write.mode("overwrite").parquet(f"{path}/base={max(parts)}")
    kept = {place for _, place in _parts(spark, path).values()}
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(root) if files.exists(root) else []:
        if f"{path}/{status.getPath().getName()}" not in kept:
            files.delete(status.getPath(), True)


def settled_log(spark: SparkSession, path: str) -> DataFrame:
    """The folds of one job joined in time order, then the final record."""
    last = _folds(spark, _parts(spark, path))
    whole = {"scraped": F.bool_or("scraped"), "validation_failures": F.sum("validation_failures"), "started": F.min("started"), "finished": F.max("finished")}
    firsts = {n: F.col(n) for n in last.columns if n not in whole and n not in _FOLD}
    return settle(first_values(last, ["job_id"], firsts, "horizon", whole))
