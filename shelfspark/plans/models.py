"""Driver tables mapped to the model frames, once for Spark and once as SQL text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.plans.registry import Tables

HOUSE_ID = 0
HOUSE_LABEL = "House"
CENTS = "decimal(12,2)"

# Line items as offers of an order ("product page"): ord is unique per page.
OFFERS_SQL = """
offers AS (
  SELECT l_orderkey AS product_id, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS offer_id,
    CASE WHEN l_suppkey % 10 = 1 THEN NULL WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey END AS seller_id,
    l_linenumber * 100000000000000000 + l_partkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS ord,
    CASE WHEN l_linenumber = 7 THEN NULL
         WHEN l_linestatus = 'F' THEN CASE l_linenumber % 3 WHEN 0 THEN 'STORE_ONLY' WHEN 1 THEN 'ONLINE_AND_STORE' ELSE 'NON_TRANSACTABLE_STORE_ONLY' END
         ELSE CASE l_linenumber % 3 WHEN 0 THEN 'ONLINE_ONLY' WHEN 1 THEN 'DISPLAY_ONLY' ELSE 'ONLINE_AND_STORE' END END AS offer_type,
    CASE WHEN l_quantity < 3 THEN NULL WHEN l_returnflag = 'A' THEN 'IN_STOCK' WHEN l_returnflag = 'N' THEN 'OUT_OF_STOCK' ELSE 'RETIRED' END AS availability,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(12,2)) + 10 END AS was_price,
    CASE WHEN l_discount > 0.02 THEN CAST(l_extendedprice AS DECIMAL(12,2)) + 20 END AS list_price,
    CASE WHEN l_discount > 0.05 THEN CAST(10 AS DECIMAL(12,2)) END AS savings,
    CASE WHEN l_tax >= 0.04 THEN true WHEN l_tax < 0.02 THEN NULL ELSE false END AS shippable,
    l_linenumber % 2 = 0 AS pickupable,
    CASE WHEN l_quantity = 50 THEN 'PICK_UP_TODAY' END AS pickup_method,
    l_discount >= 0.1 AS rollback
  FROM lineitem),
sellers AS (SELECT s_suppkey AS seller_id, CASE WHEN s_suppkey = 0 THEN 'House Store' WHEN s_suppkey % 11 = 2 THEN '' ELSE s_name END AS display_name FROM supplier)
"""

REFERENCE_SQL = """
reference AS (
  SELECT o_orderkey AS product_id, CASE o_orderstatus WHEN 'O' THEN m.top WHEN 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS reference_price
  FROM orders LEFT JOIN (SELECT l_orderkey, max(CAST(l_extendedprice AS DECIMAL(12,2))) AS top FROM lineitem GROUP BY 1) m ON l_orderkey = o_orderkey)
"""


def cents(name: str):
    return F.col(name).cast(CENTS)


def offers(t: Tables) -> DataFrame:
    n, disc = F.col("l_linenumber"), F.col("l_discount")
    price = cents("l_extendedprice")
    store = F.when(n % 3 == 0, "STORE_ONLY").when(n % 3 == 1, "ONLINE_AND_STORE").otherwise("NON_TRANSACTABLE_STORE_ONLY")
    online = F.when(n % 3 == 0, "ONLINE_ONLY").when(n % 3 == 1, "DISPLAY_ONLY").otherwise("ONLINE_AND_STORE")
    flag = F.col("l_returnflag")
    plus = lambda x: (price + F.lit(x).cast(CENTS)).cast(CENTS)
    return t.lineitem.select(
        F.col("l_orderkey").alias("product_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string")).alias("offer_id"),
        F.when(F.col("l_suppkey") % 10 == 1, None).when(F.col("l_suppkey") % 3 == 0, HOUSE_ID)
        .otherwise(F.col("l_suppkey")).cast("bigint").alias("seller_id"),
        (n.cast("bigint") * 100000000000000000 + F.col("l_partkey") * 100000000
         + F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("ord"),
        F.when(n == 7, None).when(F.col("l_linestatus") == "F", store).otherwise(online).alias("offer_type"),
        F.when(F.col("l_quantity") < 3, None).when(flag == "A", "IN_STOCK").when(flag == "N", "OUT_OF_STOCK")
        .otherwise("RETIRED").alias("availability"),
        price.alias("price"),
        F.when(disc > 0.05, plus(10)).alias("was_price"),
        F.when(disc > 0.02, plus(20)).alias("list_price"),
        F.when(disc > 0.05, F.lit(10).cast(CENTS)).alias("savings"),
        F.when(F.col("l_tax") >= 0.04, True).when(F.col("l_tax") < 0.02, None).otherwise(False).alias("shippable"),
        (n % 2 == 0).alias("pickupable"),
        F.when(F.col("l_quantity") == 50, "PICK_UP_TODAY").alias("pickup_method"),
        (disc >= 0.1).alias("rollback"),
    )


def sellers(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    return t.supplier.select(
        key.alias("seller_id"),
        F.when(key == 0, "House Store").when(key % 11 == 2, "").otherwise(F.col("s_name")).alias("display_name"))


def reference(t: Tables) -> DataFrame:
    top = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(cents("l_extendedprice")).alias("top"))
    status = F.col("o_orderstatus")
    return t.orders.join(top, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("product_id"),
        F.when(status == "O", F.col("top")).when(status == "P", cents("o_totalprice")).alias("reference_price"))


def in_double(df: DataFrame) -> DataFrame:
    """Decimal columns as double for comparison outside Spark."""
    return df.select(*[F.col(n).cast("double").alias(n) if k.startswith("decimal") else F.col(n) for n, k in df.dtypes])


def site_union(frames: list[DataFrame]) -> DataFrame:
    """Frames with site-specific columns as one wide frame (PRJ9)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
