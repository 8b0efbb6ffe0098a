"""Streaming task intake (ST5): dialect routing, validity and unknown spiders in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.messages import DIALECTS, Dialect, checked, routed, split_valid, tasks
from shelfspark.streaming.runs import drain_batches


def run_intake(raw: DataFrame, spiders: DataFrame, good_path: str, reject_path: str, checkpoint: str,
               dialects: dict[str, Dialect] = DIALECTS) -> None:
    """Write tasks to ``good_path`` and (msg_id, reason, body) to ``reject_path``.

    Each batch replaces its own folder, so a repeated batch leaves no second copy.
    """
    known = spiders.select("spider").distinct().withColumn("_known", F.lit(True))

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = checked(routed(batch, dialects), dialects).persist()
        valid, rejected = split_valid(messages)
        marked = tasks(valid, dialects).join(known, "spider", "left")
        good = marked.where("_known").drop("_known")
        unknown = marked.where("_known IS NULL").select("msg_id", F.lit("unknown_spider").alias("reason"), F.lit(None).cast("string").alias("body"))
        good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        refused = rejected.select("msg_id", F.col("reject_reason").alias("reason"), "body").unionByName(unknown)
        refused.write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")
        messages.unpersist()

    drain_batches(raw, write, checkpoint)
