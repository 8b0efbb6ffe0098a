"""Offer queries (FIL8, FIL9, JN2-JN6, JN21, JN23, AGG6-AGG10, WIN5, SET5) and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import select
from shelfspark.operators import offers as op
from shelfspark.operators.groups import chunked_lists
from shelfspark.plans import models as m
from shelfspark.plans.registry import query

_STOCKED = "coalesce(availability, '') NOT IN ('OUT_OF_STOCK', 'RETIRED')"

_ELIGIBLE_SQL = f"""
f AS (SELECT *, {_STOCKED} AS stocked, coalesce(contains(offer_type, 'ONLINE'), false) AS online,
        coalesce(offer_type NOT IN ('NON_TRANSACTABLE_STORE_ONLY', 'DISPLAY_ONLY'), true) AS valid,
        coalesce(seller_id <> 0, false) AS market FROM offers LEFT JOIN reference USING (product_id)),
w AS (SELECT *, bool_or(stocked) OVER p AS any_stocked, bool_or(stocked AND online) OVER p AS any_online,
        bool_or(valid) OVER p AS any_valid, min(ord) OVER p AS first_ord FROM f WINDOW p AS (PARTITION BY product_id)),
k AS (SELECT *, market AND NOT stocked AND coalesce(reference_price, 0) <> 0 AND NOT any_stocked AND online AND price = reference_price AS stops,
        CASE WHEN market AND coalesce(reference_price, 0) = 0 THEN false
             WHEN market AND NOT stocked THEN NOT any_stocked AND online AND price = reference_price
             WHEN NOT stocked AND any_online AND NOT {{include}} THEN false
             WHEN NOT valid THEN NOT any_valid AND ord = first_ord ELSE true END AS keep FROM w),
e AS (SELECT * FROM (SELECT *, min(CASE WHEN stops THEN ord END) OVER (PARTITION BY product_id) AS stop_ord FROM k)
      WHERE keep AND (stop_ord IS NULL OR ord <= stop_ord))
"""


def _eligible_sql(include: str) -> str:
    return f"WITH {m.OFFERS_SQL}, {m.REFERENCE_SQL}, {_ELIGIBLE_SQL.format(include=include)}"


@query("flagship_marketplace_summary", _eligible_sql("false") + """,
n AS (SELECT e.*, display_name FROM e JOIN sellers USING (seller_id) WHERE display_name <> '' AND NOT contains(display_name, 'House'))
SELECT product_id, CAST(min(price) AS DOUBLE) AS lowest_price, count(*) AS offer_count, count(DISTINCT seller_id) AS seller_count,
       bool_or(stocked) AS in_stock, arg_min(display_name, ord) AS top_seller, CAST(arg_min(price, ord) AS DOUBLE) AS top_price
FROM n GROUP BY product_id
""")
def _(t):
    kept = op.eligible_offers(m.offers(t), m.reference(t), m.HOUSE_ID)
    rows = op.named_sellers(kept, m.sellers(t), m.HOUSE_LABEL)
    return m.in_double(rows.groupBy("product_id").agg(
        F.min("price").alias("lowest_price"), F.count("*").alias("offer_count"),
        F.countDistinct("seller_id").alias("seller_count"), F.bool_or("in_stock").alias("in_stock"),
        F.min_by("display_name", "ord").alias("top_seller"), F.min_by("price", "ord").alias("top_price")))


@query("fil8_eligible_offers", _eligible_sql("false") + "SELECT product_id, offer_id, ord, CAST(price AS DOUBLE) AS price FROM e")
def _(t):
    kept = op.eligible_offers(m.offers(t), m.reference(t), m.HOUSE_ID)
    return m.in_double(kept.select("product_id", "offer_id", "ord", "price"))


@query("fil8_eligible_with_out_of_stock", _eligible_sql("true") + "SELECT product_id, offer_id, ord, CAST(price AS DOUBLE) AS price FROM e")
def _(t):
    kept = op.eligible_offers(m.offers(t), m.reference(t), m.HOUSE_ID, include_oos=True)
    return m.in_double(kept.select("product_id", "offer_id", "ord", "price"))


@query("fil9_marketplace_rows", f"""
WITH {m.OFFERS_SQL}, a AS (SELECT *, (coalesce(pickupable, false) OR coalesce(shippable, false)) AND coalesce(availability, '') <> 'OUT_OF_STOCK' AS ok FROM offers),
w AS (SELECT *, bool_or(ok) OVER (PARTITION BY product_id) AS any_ok, row_number() OVER (PARTITION BY product_id ORDER BY ord) AS rn FROM a)
SELECT product_id, offer_id, ord FROM w WHERE ok OR (NOT any_ok AND rn = 1)
""")
def _(t):
    return op.marketplace_rows(m.offers(t)).select("product_id", "offer_id", "ord")


_NAMED_SQL = f"""WITH {m.OFFERS_SQL}, n AS (
SELECT o.*, display_name, {_STOCKED} AS in_stock FROM offers o JOIN sellers USING (seller_id)
WHERE display_name <> '' AND NOT contains(display_name, 'House'))
"""


@query("jn2_named_sellers", _NAMED_SQL + """
SELECT product_id, offer_id, ord, display_name, CAST(price AS DOUBLE) AS price, in_stock FROM n""")
def _(t):
    rows = op.named_sellers(m.offers(t), m.sellers(t), m.HOUSE_LABEL)
    return m.in_double(rows.select("product_id", "offer_id", "ord", "display_name", "price", "in_stock"))


@query("jn3_seller_labels", f"""
WITH {m.OFFERS_SQL}, s AS (SELECT o.*, offer_type IS NOT NULL AS fetched, coalesce(display_name, '') AS nm FROM offers o LEFT JOIN sellers USING (seller_id))
SELECT product_id, offer_id, ord, CASE WHEN fetched THEN nm END AS name,
       CASE WHEN fetched THEN CASE WHEN contains(nm, 'House') THEN 'site' ELSE 'marketplace' END END AS seller_type FROM s
""")
def _(t):
    fetched = m.offers(t).withColumn("status", F.when(F.col("offer_type").isNull(), "NOT_FETCHED"))
    return op.seller_labels(fetched, m.sellers(t), m.HOUSE_LABEL).select("product_id", "offer_id", "ord", "name", "seller_type")


_KEYED_SQL = "keyed AS (SELECT offer_id, min(product_id) AS product_id, arg_min(price, ord) AS price, min(ord) AS ord FROM offers GROUP BY offer_id)"


def _keyed_offers(t):
    """Offers as a keyed lookup: the first one of a repeated id."""
    return m.offers(t).groupBy("offer_id").agg(
        F.min("product_id").alias("product_id"), F.min_by("price", "ord").alias("price"), F.min("ord").alias("ord"))


@query("jn4_listed_offers", f"""
WITH {m.OFFERS_SQL}, {_KEYED_SQL},
p AS (SELECT o_orderkey AS product_id, i, o_orderkey::VARCHAR || '-' || (7 - i)::VARCHAR AS offer_id FROM orders, unnest(range(0, 7)) AS r(i))
SELECT p.product_id, i::INTEGER AS pos, offer_id, CAST(price AS DOUBLE) AS price FROM p JOIN keyed USING (offer_id)
""")
def _(t):
    ids = F.transform(F.sequence(F.lit(7), F.lit(1)), lambda n: F.concat_ws("-", F.col("o_orderkey").cast("string"), n.cast("string")))
    products = t.orders.select(F.col("o_orderkey").alias("product_id"), ids.alias("offer_ids"))
    return m.in_double(op.listed_offers(products, _keyed_offers(t)).select("product_id", "pos", "offer_id", "price"))


@query("jn5_external_order", f"""
WITH {m.OFFERS_SQL}
SELECT product_id, offer_id, ord, CAST(CASE WHEN o.o_orderkey IS NULL THEN 0
   WHEN split_part(offer_id, '-', 2)::INTEGER BETWEEN 3 AND 6 THEN 6 - split_part(offer_id, '-', 2)::INTEGER ELSE 4 END AS INTEGER) AS sort_key
FROM offers LEFT JOIN orders o ON o_orderkey = product_id
""")
def _(t):
    ids = F.transform(F.sequence(F.lit(6), F.lit(3)), lambda n: F.concat_ws("-", F.col("o_orderkey").cast("string"), n.cast("string")))
    orders = t.orders.select(F.col("o_orderkey").alias("product_id"), ids.alias("preferred_ids"))
    return op.by_external_order(m.offers(t), orders).select("product_id", "offer_id", "ord", "sort_key")


@query("jn6_source_fallback", f"""
WITH {m.OFFERS_SQL}, a AS (SELECT * FROM offers WHERE availability = 'IN_STOCK'), b AS (SELECT * FROM offers WHERE availability IS DISTINCT FROM 'IN_STOCK')
SELECT product_id, offer_id, ord FROM a UNION ALL
SELECT product_id, offer_id, ord FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.product_id = b.product_id)
""")
def _(t):
    rows = m.offers(t).select("product_id", "offer_id", "ord", "availability")
    return op.offers_or_fallback(rows.where("availability = 'IN_STOCK'"), rows.where("NOT (availability <=> 'IN_STOCK')")).drop("availability")


@query("agg6_marketplace_rollup", _NAMED_SQL + """
SELECT product_id, CAST(bool_or(in_stock) AS INTEGER) AS marketplace_in_stock, CAST(NOT bool_or(in_stock) AS INTEGER) AS marketplace_out_of_stock,
       CAST(min(price) AS DOUBLE) AS marketplace_lowest_price, count(*) FILTER (WHERE price <> 0) AS price_count, count(*) AS seller_count
FROM n GROUP BY product_id""")
def _(t):
    rows = op.named_sellers(m.offers(t), m.sellers(t), m.HOUSE_LABEL)
    return m.in_double(op.marketplace_rollup(rows))


@query("agg6_marketplace_lists", _NAMED_SQL + """,
r AS (SELECT product_id, display_name, price, row_number() OVER (PARTITION BY product_id ORDER BY ord) - 1 AS pos FROM n)
SELECT product_id, pos // 2 AS chunk, string_agg(display_name, ',' ORDER BY pos) AS sellers FROM r GROUP BY 1, 2""")
def _(t):
    rows = op.named_sellers(m.offers(t), m.sellers(t), m.HOUSE_LABEL).select("product_id", "ord", "display_name")
    lists = chunked_lists(rows, ["product_id"], ["ord"], "display_name", 2, "sellers")
    return lists.withColumn("sellers", F.array_join("sellers", ","))


@query("agg7_offer_flags", f"""
WITH {m.OFFERS_SQL}, g AS (SELECT product_id, coalesce(bool_or(shippable), false) AS shipping, coalesce(bool_or(availability = 'IN_STOCK'), false) AS stocked,
   coalesce(bool_or(contains(offer_type, 'NON_TRANSACTABLE_STORE_ONLY')), false) AS pickup_only, coalesce(bool_or(starts_with(offer_type, 'ONLINE')), false) AS online,
   coalesce(bool_or(pickup_method = 'PICK_UP_TODAY'), false) AS today, coalesce(bool_or(rollback), false) AS rollback FROM offers GROUP BY 1)
SELECT o_orderkey AS product_id, coalesce(shipping, false) AS shipping, NOT coalesce(stocked, false) AS is_out_of_stock,
   coalesce(pickup_only, false) AS is_pickup_only,
   coalesce(pickup_only, false) OR coalesce(CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END, NOT coalesce(online, false)) AS is_in_store_only,
   coalesce(today, false) AS pickup_today, coalesce(rollback, false) AS rollback
FROM orders LEFT JOIN g ON o_orderkey = product_id
""")
def _(t):
    hint = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "P", False)
    products = t.orders.select(F.col("o_orderkey").alias("product_id"), hint.alias("in_store_hint"))
    return op.offer_flags(products, m.offers(t))


_CHANNEL_SQL = f"""WITH {m.OFFERS_SQL}, g AS (SELECT product_id, count(*) AS n, arg_min(coalesce(contains(offer_type, 'STORE'), false), ord) AS first_store,
   bool_or(coalesce(contains(offer_type, 'STORE'), false) AND {_STOCKED}) AS store_ok,
   bool_or((seller_id IS NULL OR seller_id = 0) AND coalesce(offer_type <> 'STORE_ONLY', true)) AS online,
   bool_or(coalesce(contains(offer_type, 'ONLINE'), false) AND {_STOCKED}) AS online_ok FROM offers GROUP BY 1),
b AS (SELECT o_orderkey AS product_id, coalesce(online, false) AS site_online, coalesce(first_store, false) AS in_stores, online_ok, store_ok,
   (coalesce(online, false) AND o_orderkey % 5 = 0) OR n IS NULL AS no_longer_available FROM orders LEFT JOIN g ON o_orderkey = product_id),
c AS (SELECT product_id, site_online, CASE WHEN site_online THEN no_longer_available OR NOT online_ok END AS site_online_out_of_stock, in_stores,
   CASE WHEN in_stores THEN no_longer_available OR NOT store_ok END AS in_stores_out_of_stock, no_longer_available FROM b)
"""


def _channel(t):
    price = F.when(F.col("o_orderkey") % 5 != 0, m.cents("o_totalprice"))
    products = t.orders.select(F.col("o_orderkey").alias("product_id"), price.alias("price"))
    return op.channel_stock(products, m.offers(t), m.HOUSE_ID)


@query("agg8_channel_stock", _CHANNEL_SQL + "SELECT * FROM c")
def _(t):
    return _channel(t)


@query("agg9_channel_matrix", _CHANNEL_SQL + """,
d AS (SELECT *, CASE product_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS mk, CASE WHEN product_id % 4 = 0 THEN product_id % 8 = 0 END AS own FROM c)
SELECT product_id, CASE WHEN mk IS NOT NULL THEN CAST(NOT site_online AND mk AND in_stores AS INTEGER) END AS in_stores_only,
  CASE WHEN mk IS NOT NULL THEN CAST((site_online OR mk) AND NOT in_stores AS INTEGER) END AS online_only,
  CAST(coalesce(own, site_online OR in_stores) AS INTEGER) AS owned,
  CAST(NOT site_online_out_of_stock AS INTEGER) AS site_online_in_stock, CAST(NOT in_stores_out_of_stock AS INTEGER) AS in_stores_in_stock FROM d""")
def _(t):
    k = F.col("product_id")
    market = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    owned = F.when(k % 4 == 0, k % 8 == 0)
    matrix = select.channel_matrix(F.col("site_online"), F.col("in_stores"), market, F.col("site_online_out_of_stock"),
                                   F.col("in_stores_out_of_stock"), owned)
    return _channel(t).select("product_id", *[c.alias(n) for n, c in matrix.items()])


@query("agg10_price_ranges", f"""
WITH {m.OFFERS_SQL}, g AS (SELECT product_id, min(price) AS lo, max(price) AS hi FROM offers GROUP BY 1)
SELECT o_orderkey AS product_id, CASE WHEN o_orderstatus = 'P' THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ' - $' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 5 AS DECIMAL(12,2))::VARCHAR
   WHEN lo < hi THEN '$' || lo::VARCHAR || ' - $' || hi::VARCHAR ELSE format('${{:,.2f}}', CAST(lo AS DOUBLE)) END AS price
FROM orders LEFT JOIN g ON o_orderkey = product_id
""")
def _(t):
    total = m.cents("o_totalprice")
    bundle = F.col("o_orderstatus") == "P"
    products = t.orders.select(
        F.col("o_orderkey").alias("product_id"), F.when(bundle, total).alias("bundle_min"),
        F.when(bundle, (total + F.lit(5).cast(m.CENTS)).cast(m.CENTS)).alias("bundle_max"))
    return op.price_ranges(products, m.offers(t))


@query("win5_top_offer", f"""
WITH {m.OFFERS_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ord) AS rn FROM offers)
SELECT product_id, coalesce(seller_id, 0) AS seller_id, CAST(coalesce(nullif(was_price, 0), list_price) AS DOUBLE) AS was_price, CAST(price AS DOUBLE) AS now_price,
       CAST(list_price AS DOUBLE) AS list_price, CAST(savings AS DOUBLE) AS save_amount FROM f WHERE rn = 1
""")
def _(t):
    return m.in_double(op.top_offer(m.offers(t), m.HOUSE_ID))


@query("set5_online_in_stock", f"""
WITH {m.OFFERS_SQL} SELECT product_id, offer_id, ord FROM offers WHERE contains(offer_type, 'ONLINE') AND {_STOCKED}
""")
def _(t):
    return op.online_in_stock(m.offers(t)).select("product_id", "offer_id", "ord")


@query("jn21_owned_brand", """
WITH s AS (SELECT s_suppkey, 'BRAND#' || (s_suppkey % 25)::VARCHAR AS seller FROM supplier)
SELECT p_partkey, seller, coalesce(lower(p_brand) = lower(seller), false) AS owned, NOT coalesce(lower(p_brand) = lower(seller), false) AS marketplace
FROM part LEFT JOIN s ON s_suppkey = p_partkey % 40
""")
def _(t):
    sellers = t.supplier.select(F.col("s_suppkey").alias("_k"), F.concat(F.lit("BRAND#"), (F.col("s_suppkey") % 25).cast("string")).alias("seller"))
    rows = t.part.join(sellers, F.col("p_partkey") % 40 == F.col("_k"), "left")
    owned = F.coalesce(F.lower("p_brand") == F.lower("seller"), F.lit(False))
    return rows.select("p_partkey", "seller", owned.alias("owned"), (~owned).alias("marketplace"))


@query("jn23_canonical_product", """
WITH pr AS (SELECT l_orderkey AS page_id, l_partkey AS product_id, l_linenumber AS public_id FROM lineitem),
pg AS (SELECT o_orderkey AS page_id, o_orderkey % 9 AS url_id, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS selected_id,
         CASE WHEN o_orderstatus = 'F' THEN 'FETCHED' ELSE 'PENDING' END AS st, o_custkey + 1 AS last_id FROM orders),
c AS (SELECT pg.page_id, coalesce((SELECT min(product_id) FROM pr WHERE pr.page_id = pg.page_id AND public_id = url_id),
         CASE WHEN st = 'FETCHED' THEN selected_id END, last_id) AS product_id FROM pg)
SELECT page_id, product_id, CASE WHEN EXISTS (SELECT 1 FROM pr WHERE pr.page_id = c.page_id AND pr.product_id = c.product_id) THEN product_id ELSE -1 END AS content_id FROM c
""")
def _(t):
    products = t.lineitem.select(F.col("l_orderkey").alias("page_id"), F.col("l_partkey").alias("product_id"),
                                 F.col("l_linenumber").cast("bigint").alias("public_id"))
    pages = t.orders.select(
        F.col("o_orderkey").alias("page_id"), (F.col("o_orderkey") % 9).alias("url_id"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("selected_id"),
        F.when(F.col("o_orderstatus") == "F", "FETCHED").otherwise("PENDING").alias("selected_status"),
        (F.col("o_custkey") + 1).alias("last_fetched_id"), F.lit(-1).cast("bigint").alias("primary_id"))
    return op.canonical_product(pages, products).select("page_id", "product_id", "content_id")
