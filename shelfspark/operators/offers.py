"""Seller offers: eligibility, sellers, stock and price facts per product.

Offer columns: product_id, offer_id, seller_id, ord, offer_type, availability, price,
was_price, list_price, savings, shippable, pickupable, pickup_method, rollback.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import flags
from shelfspark.functions.select import truthy
from shelfspark.operators.groups import fallback, with_group_facts

# Offer types.
INVALID_TYPES = ("NON_TRANSACTABLE_STORE_ONLY", "DISPLAY_ONLY")
STORE_ONLY = "STORE_ONLY"
PICKUP_TODAY = "PICK_UP_TODAY"

KEY = ["product_id"]


def _type_has(word: str) -> Column:
    return F.coalesce(F.col("offer_type").contains(word), F.lit(False))


def _any(c: Column) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def eligible_offers(offers: DataFrame, reference: DataFrame, house_id, include_oos: bool = False) -> DataFrame:
    """Offers a product page shows (FIL8).

    ``reference`` holds (product_id, reference_price), one row per product. A marketplace offer needs a
    reference price. One that is out of stock is kept only if nothing is in stock, it
    is online and its price equals the reference; the first such offer ends the list.
    """
    stocked = flags.in_stock(F.col("availability"))
    online = _type_has("ONLINE")
    valid = ~F.coalesce(F.col("offer_type").isin(*INVALID_TYPES), F.lit(False))
    marketplace = F.coalesce(F.col("seller_id") != house_id, F.lit(False))
    offers = offers.withColumns({"_stocked": stocked, "_online": online, "_valid": valid, "_market": marketplace})
    priced = reference.where(F.col("reference_price") != 0)
    stops = F.col("_market") & F.col("_online") & ~F.col("_stocked") & (F.col("price") == F.col("reference_price"))
    # All facts of a product in one aggregate, which brings the reference price back to the rows as well.
    facts = offers.join(priced, KEY, "left").groupBy(*KEY).agg(
        F.bool_or("_stocked").alias("_any_stocked"),
        F.bool_or(F.col("_stocked") & F.col("_online")).alias("_any_online"),
        F.bool_or("_valid").alias("_any_valid"),
        F.min("ord").alias("_first"),
        F.max("reference_price").alias("reference_price"),
        F.min(F.when(stops, F.col("ord"))).alias("_stop"),
    )
    facts = facts.withColumn("_stop", F.when(~F.col("_any_stocked"), F.col("_stop")))
    c = F.col
    has_ref = c("reference_price").isNotNull()
    ends_list = ~c("_any_stocked") & c("_online") & F.coalesce(c("price") == c("reference_price"), F.lit(False))
    own_rule = F.when(c("_valid"), True).otherwise(~c("_any_valid") & (c("ord") == c("_first")))
    listed = F.lit(True) if include_oos else c("_stocked") | ~c("_any_online")
    keep = (
        F.when(c("_market") & ~has_ref, False)
        .when(c("_market") & ~c("_stocked"), ends_list)
        .otherwise(listed & own_rule)
    )
    before_stop = c("_stop").isNull() | (c("ord") <= c("_stop"))
    kept = offers.join(facts, KEY).where(keep & before_stop)
    return kept.drop("_stocked", "_online", "_valid", "_market", "_any_stocked", "_any_online", "_any_valid", "_first", "_stop")


def marketplace_rows(offers: DataFrame) -> DataFrame:
    """Available offers, else only the first offer of the product (FIL9)."""
    available = (
        (F.coalesce(F.col("pickupable"), F.lit(False)) | F.coalesce(F.col("shippable"), F.lit(False)))
        & (F.coalesce(F.col("availability"), F.lit("")) != "OUT_OF_STOCK")
    )
    offers = offers.withColumn("_ok", available)
    facts = with_group_facts(offers, KEY, _any_ok=F.bool_or("_ok"), _first=F.min("ord"))
    kept = facts.where(F.col("_ok") | (~F.col("_any_ok") & (F.col("ord") == F.col("_first"))))
    return kept.drop("_ok", "_any_ok", "_first")


def named_sellers(offers: DataFrame, sellers: DataFrame, house_label: str) -> DataFrame:
    """Offers of named sellers other than the house, with stock flag (JN2)."""
    named = sellers.select("seller_id", "display_name")
    rows = offers.join(named, "seller_id", "left").where(
        (F.col("display_name") != "") & ~F.col("display_name").contains(house_label))
    return rows.withColumn("in_stock", flags.in_stock(F.col("availability")))


def seller_labels(offers: DataFrame, sellers: DataFrame, house_label: str) -> DataFrame:
    """Seller name and kind; both null when the offer was not fetched (JN3)."""
    rows = offers.join(sellers.select("seller_id", "display_name"), "seller_id", "left")
    fetched = F.coalesce(F.col("status") != "NOT_FETCHED", F.lit(True))
    name = F.coalesce(F.col("display_name"), F.lit(""))
    return rows.withColumns({
        "name": F.when(fetched, name),
        "seller_type": F.when(fetched, F.when(name.contains(house_label), "site").otherwise("marketplace")),
    }).drop("display_name")


def listed_offers(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Offers named by each product's ``offer_ids`` list, with list position (JN4)."""
    wanted = products.select("product_id", F.posexplode("offer_ids").alias("pos", "offer_id"))
    return wanted.join(offers.drop("product_id"), "offer_id")


def by_external_order(offers: DataFrame, orders: DataFrame) -> DataFrame:
    """``sort_key`` from each product's preference list; unknown offers sort last (JN5)."""
    ranked = orders.select("product_id", F.posexplode("preferred_ids").alias("_at", "offer_id"))
    # A repeated id counts at its first place in the list.
    first = ranked.groupBy("product_id", "offer_id").agg(F.min("_at").alias("_at"))
    sizes = orders.select("product_id", F.size("preferred_ids").alias("_n"))
    rows = offers.join(first, ["product_id", "offer_id"], "left").join(sizes, "product_id", "left")
    return rows.withColumn("sort_key", F.coalesce("_at", "_n", F.lit(0))).drop("_at", "_n")


def offers_or_fallback(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Primary source's offers of a product, else the secondary's (JN6)."""
    return fallback(primary, secondary, KEY)


def marketplace_rollup(rows: DataFrame) -> DataFrame:
    """Stock and lowest price over the marketplace rows of a product (AGG6)."""
    return rows.groupBy(*KEY).agg(
        F.bool_or("in_stock").cast("int").alias("marketplace_in_stock"),
        (~F.bool_or("in_stock")).cast("int").alias("marketplace_out_of_stock"),
        F.min("price").alias("marketplace_lowest_price"),
        F.count_if(F.col("price") != 0).alias("price_count"),
        F.count_if(F.col("display_name") != "").alias("seller_count"),
    )


def offer_flags(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Product flags from its offers; a product without offers is out of stock (AGG7).

    ``products`` holds (product_id, in_store_hint), the hint null when unknown.
    """
    facts = offers.groupBy(*KEY).agg(
        _any(F.col("shippable")).alias("shipping"),
        _any(F.col("availability") == "IN_STOCK").alias("_stocked"),
        _any(_type_has(INVALID_TYPES[0])).alias("is_pickup_only"),
        _any(F.col("offer_type").startswith("ONLINE")).alias("_online"),
        _any(F.col("pickup_method") == PICKUP_TODAY).alias("pickup_today"),
        _any(F.col("rollback")).alias("rollback"),
    )
    rows = products.join(facts, KEY, "left")
    no = F.lit(False)
    pickup_only = F.coalesce("is_pickup_only", no)
    return rows.select(
        "product_id",
        F.coalesce("shipping", no).alias("shipping"),
        (~F.coalesce("_stocked", no)).alias("is_out_of_stock"),
        pickup_only.alias("is_pickup_only"),
        (pickup_only | F.coalesce(F.col("in_store_hint"), ~F.coalesce("_online", no))).alias("is_in_store_only"),
        F.coalesce("pickup_today", no).alias("pickup_today"),
        F.coalesce("rollback", no).alias("rollback"),
    )


def channel_stock(products: DataFrame, offers: DataFrame, house_id) -> DataFrame:
    """Online and store channel flags (AGG8). ``products`` holds (product_id, price)."""
    stocked = flags.in_stock(F.col("availability"))
    own = F.coalesce(F.col("seller_id") == house_id, F.lit(True))
    not_store_only = F.coalesce(F.col("offer_type") != STORE_ONLY, F.lit(True))
    facts = offers.groupBy(*KEY).agg(
        F.count("*").alias("_n"),
        F.min_by(_type_has("STORE"), F.col("ord")).alias("_first_store"),
        F.bool_or(_type_has("STORE") & stocked).alias("_store_ok"),
        F.bool_or(own & not_store_only).alias("_online"),
        F.bool_or(_type_has("ONLINE") & stocked).alias("_online_ok"),
    )
    rows = products.join(facts, KEY, "left")
    online = F.coalesce("_online", F.lit(False))
    in_stores = F.coalesce("_first_store", F.lit(False))
    gone = (online & truthy(F.col("price"), "number").isNull()) | F.col("_n").isNull()
    return rows.select(
        "product_id",
        online.alias("site_online"),
        F.when(online, gone | ~F.coalesce("_online_ok", F.lit(False))).alias("site_online_out_of_stock"),
        in_stores.alias("in_stores"),
        F.when(in_stores, gone | ~F.coalesce("_store_ok", F.lit(False))).alias("in_stores_out_of_stock"),
        gone.alias("no_longer_available"),
    )


def top_offer(offers: DataFrame, house_id) -> DataFrame:
    """Seller and prices of the first offer (WIN5)."""
    first = lambda c: F.min_by(c, F.col("ord"))
    was = F.coalesce(truthy(F.col("was_price"), "number"), F.col("list_price"))
    return offers.groupBy(*KEY).agg(
        first(F.coalesce(F.col("seller_id"), F.lit(house_id))).alias("seller_id"),
        first(was).alias("was_price"),
        first(F.col("price")).alias("now_price"),
        first(F.col("list_price")).alias("list_price"),
        first(F.col("savings")).alias("save_amount"),
    )


def price_ranges(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Price text: bundle range, else range over offers, else the single price (AGG10).

    ``products`` holds (product_id, bundle_min, bundle_max).
    """
    facts = offers.groupBy(*KEY).agg(F.min("price").alias("_min"), F.max("price").alias("_max"))
    text = lambda low, high: F.concat(F.lit("$"), low.cast("string"), F.lit(" - $"), high.cast("string"))
    bundle = (F.col("bundle_min") != 0) & (F.col("bundle_max") != 0)
    single = F.concat(F.lit("$"), F.format_number("_min", 2))
    return products.join(facts, KEY, "left").select(
        "product_id",
        F.when(bundle, text(F.col("bundle_min"), F.col("bundle_max")))
        .when(F.col("_min") < F.col("_max"), text(F.col("_min"), F.col("_max")))
        .otherwise(single).alias("price"),
    )


def online_in_stock(offers: DataFrame) -> DataFrame:
    """Offers that are both online and in stock (SET5)."""
    return offers.where(_type_has("ONLINE") & flags.in_stock(F.col("availability")))


def canonical_product(pages: DataFrame, products: DataFrame) -> DataFrame:
    """Product a page stands for (JN23).

    ``pages``: page_id, url_id, selected_id, selected_status, last_fetched_id, primary_id.
    ``products``: page_id, product_id, public_id.
    """
    matched = products.groupBy("page_id", F.col("public_id").alias("url_id")).agg(F.min("product_id").alias("_by_url"))
    rows = pages.join(matched, ["page_id", "url_id"], "left")
    selected = F.when(F.col("selected_status") == "FETCHED", F.col("selected_id"))
    rows = rows.withColumn("product_id", F.coalesce("_by_url", selected, "last_fetched_id"))
    known = products.select("page_id", "product_id").distinct().withColumn("_known", F.lit(True))
    rows = rows.join(known, ["page_id", "product_id"], "left")
    return rows.withColumn("content_id", F.when(F.col("_known"), F.col("product_id")).otherwise(F.col("primary_id"))).drop("_by_url", "_known")
