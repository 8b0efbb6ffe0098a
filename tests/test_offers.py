import random

from pyspark.sql import functions as F

from shelfspark.operators import offers as op

SCHEMA = ("product_id int, offer_id int, seller_id int, ord int, offer_type string, availability string, price decimal(12,2), "
          "was_price decimal(12,2), list_price decimal(12,2), savings decimal(12,2), shippable boolean, pickupable boolean, pickup_method string, rollback boolean")
HOUSE = 1
OUT = ("OUT_OF_STOCK", "RETIRED")
INVALID = ("NON_TRANSACTABLE_STORE_ONLY", "DISPLAY_ONLY")


def expected(offers, reference, include_oos):
    """Ids a page shows, from sets over one product's ordered offers."""
    places = range(len(offers))
    stocked = {i for i in places if offers[i]["availability"] not in OUT}
    online = {i for i in places if "ONLINE" in (offers[i]["offer_type"] or "")}
    market = {i for i in places if offers[i]["seller_id"] not in (None, HOUSE)}
    valid = {i for i in places if offers[i]["offer_type"] not in INVALID}
    at_reference = {i for i in places if reference and offers[i]["price"] == reference}
    # Sold-out marketplace offers show only as a last resort, and the first one ends the page.
    last_resort = set() if stocked else market & online & at_reference
    end = min(last_resort, default=len(offers))
    own = valid if valid else {0}
    listed = set(places) if include_oos or not stocked & online else stocked
    ordinary = (listed & own) - (market - stocked if reference else market)
    return [offers[i]["offer_id"] for i in places if i <= end and (i in ordinary or i == end)]


def test_facts_of_a_product_are_one_aggregate(spark):
    rows = spark.createDataFrame([], "product_id int, offer_id string, seller_id int, ord int, offer_type string, availability string, price int")
    kept = op.eligible_offers(rows, spark.createDataFrame([], "product_id int, reference_price int"), HOUSE)
    plan = kept._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Join ") == 2


def random_offers(seed, products=300):
    rnd = random.Random(seed)
    out, refs = [], {}
    for p in range(products):
        refs[p] = rnd.choice([None, 0, 10, 20])
        sold_out = rnd.random() < 0.5
        for n in range(rnd.randint(1, 6)):
            out.append(dict(
                product_id=p, offer_id=p * 10 + n, seller_id=rnd.choice([None, HOUSE, 2, 3]), ord=n,
                offer_type=rnd.choice([None, "ONLINE_ONLY", "ONLINE_AND_STORE", "STORE_ONLY", *INVALID]),
                availability=rnd.choice(OUT) if sold_out else rnd.choice([None, "IN_STOCK", *OUT]), price=rnd.choice([10, 20]),
                was_price=rnd.choice([None, 0, 30]), list_price=rnd.choice([None, 40]), savings=None, shippable=rnd.choice([None, True, False]),
                pickupable=rnd.choice([True, False]), pickup_method=None, rollback=False))
    return out, refs


def frames(spark, rows, refs):
    from decimal import Decimal

    names = [f.split()[0] for f in SCHEMA.replace("decimal(12,2)", "decimal").split(", ")]
    money = {"price", "was_price", "list_price", "savings"}
    data = [tuple(Decimal(r[n]) if n in money and r[n] is not None else r[n] for n in names) for r in rows]
    reference = spark.createDataFrame([(p, None if v is None else Decimal(v)) for p, v in refs.items()], "product_id int, reference_price decimal(12,2)")
    return spark.createDataFrame(data, SCHEMA).repartition(5), reference


def test_eligible_offers_match_the_sets(spark):
    rows, refs = random_offers(7)
    offers, reference = frames(spark, rows, refs)
    for include in (False, True):
        got = {}
        for r in op.eligible_offers(offers, reference, HOUSE, include).orderBy("product_id", "ord").collect():
            got.setdefault(r.product_id, []).append(r.offer_id)
        want = {p: expected([r for r in rows if r["product_id"] == p], refs[p], include) for p in refs}
        assert got == {p: ids for p, ids in want.items() if ids}


def test_marketplace_rows_fall_back_to_the_first(spark):
    rows, refs = random_offers(11)
    offers, _ = frames(spark, rows, refs)
    got = {r.offer_id for r in op.marketplace_rows(offers).collect()}
    want = set()
    for p in refs:
        mine = [r for r in rows if r["product_id"] == p]
        good = [r["offer_id"] for r in mine if (r["pickupable"] or r["shippable"]) and r["availability"] != "OUT_OF_STOCK"]
        want.update(good or [mine[0]["offer_id"]])
    assert got == want


def test_product_without_offers(spark):
    offers, _ = frames(spark, [], {0: None})
    products = spark.createDataFrame([(1, None), (2, True)], "product_id int, in_store_hint boolean")
    flags = {r.product_id: r for r in op.offer_flags(products, offers).collect()}
    assert flags[1].is_out_of_stock and not flags[1].shipping and flags[1].is_in_store_only
    priced = spark.createDataFrame([(1, 5.0)], "product_id int, price double")
    row = op.channel_stock(priced, offers, HOUSE).first()
    assert (row.site_online, row.site_online_out_of_stock, row.in_stores, row.no_longer_available) == (False, None, False, True)


def test_top_offer_uses_list_price_when_was_price_is_zero(spark):
    rows, refs = random_offers(3)
    offers, _ = frames(spark, rows, refs)
    for r in op.top_offer(offers, HOUSE).collect():
        first = next(x for x in rows if x["product_id"] == r.product_id)
        assert r.seller_id == (first["seller_id"] if first["seller_id"] is not None else HOUSE)
        assert (None if r.was_price is None else int(r.was_price)) == (first["was_price"] or first["list_price"])


def test_external_order_puts_unknown_offers_last(spark):
    offers, _ = frames(spark, random_offers(5, 3)[0], {0: None})
    orders = spark.createDataFrame([(0, [2, 0, 2])], "product_id int, preferred_ids array<int>")
    keys = {r.offer_id: r.sort_key for r in op.by_external_order(offers.where("product_id = 0"), orders).collect()}
    assert keys.get(0, 1) == 1 and keys.get(2, 0) == 0 and all(v == 3 for k, v in keys.items() if k not in (0, 2))


def test_bundle_range_comes_first(spark):
    offers, _ = frames(spark, random_offers(5, 2)[0], {0: None})
    products = offers.select("product_id").distinct().select("product_id", F.lit(1).cast("decimal(12,2)").alias("bundle_min"), F.lit(2).cast("decimal(12,2)").alias("bundle_max"))
    assert {r.price for r in op.price_ranges(products, offers).collect()} == {"$1.00 - $2.00"}
