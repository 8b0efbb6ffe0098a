"""Partial responses of one item merged into one row (JN1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.groups import extreme_rows, first_values


def outstanding(requested: DataFrame, received: DataFrame) -> DataFrame:
    """Requests per guid that still lack an answer.

    ``requested``: guid, fingerprint, initial. ``received``: guid, fingerprint, ok. A failed
    answer settles a request, except the initial one. A request sent twice needs two answers.
    """
    asked = requested.groupBy("guid", "fingerprint").agg(F.count("*").alias("_asked"), F.bool_or("initial").alias("_initial"))
    answers = received.groupBy("guid", "fingerprint").agg(F.count("*").alias("_any"), F.count_if("ok").alias("_ok"))
    rows = asked.join(answers, ["guid", "fingerprint"], "left")
    usable = F.coalesce(F.when(F.col("_initial"), F.col("_ok")).otherwise(F.col("_any")), F.lit(0))
    open_ = F.col("_asked") - F.least("_asked", usable)
    return rows.groupBy("guid").agg(F.sum("_asked").alias("requests"), F.sum(open_).alias("outstanding"))


def merged_items(requested: DataFrame, received: DataFrame, fields: list[str], order: str = "seq") -> DataFrame:
    """One row per guid: first non-null value of each field over good answers, and whether it is complete."""
    values = first_values(received.where("ok"), ["guid"], {f: F.col(f) for f in fields}, order)
    rows = outstanding(requested, received).join(values, "guid", "left")
    return rows.withColumn("complete", F.col("outstanding") == 0)


def merged_fragments(fragments: DataFrame, order: str = "seq") -> DataFrame:
    """(guid, field, value): first non-null value, for fields stored as rows."""
    return extreme_rows(fragments.where("ok AND value IS NOT NULL"), ["guid", "field"], order).select("guid", "field", "value")
