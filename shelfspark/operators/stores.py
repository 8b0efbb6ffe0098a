"""Store selection by postal code (JN15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_postal_code(code: Column) -> Column:
    return F.lower(F.replace(code, F.lit(" "), F.lit("")))


def store_choice(wanted: DataFrame, stores: DataFrame) -> DataFrame:
    """Adds ``store_id``: the first store with the wanted postal code, else the first listed place if it is a store.

    ``wanted``: area, postal_code. ``stores``: area, pos, store_id, is_store, postal_code.
    """
    code = normal_postal_code(F.col("postal_code")).alias("_code")
    matches = stores.where("is_store").groupBy("area", code).agg(F.min_by("store_id", "pos").alias("_match"))
    first = stores.groupBy("area").agg(F.min_by(F.when(F.col("is_store"), F.col("store_id")), "pos").alias("_first"))
    rows = wanted.withColumn("_code", normal_postal_code(F.col("postal_code")))
    rows = rows.join(matches, ["area", "_code"], "left").join(first, "area", "left")
    return rows.withColumn("store_id", F.coalesce("_match", "_first")).drop("_code", "_match", "_first")
