"""The nested export record and its companions (PRJ2, PRJ3, PRJ4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfspark.functions import prices, select
from shelfspark.functions.dates import stamp_text
from shelfspark.functions.flags import job_outcome
from shelfspark.functions.text import bullet_columns, term_in_title
from shelfspark.operators.groups import chunked_lists
from shelfspark.operators.pages import attribute, attribute_values
from shelfspark.sources.schemas import PRODUCT, conform

LIST_CHUNK = 1000

SUMMARY_COLUMNS = ("product_id", "title", "shipping", "shipping_speed", "wupc", "brand", "price", "price_currency", "temp_price_cut", "is_out_of_stock")


def _len(name: str) -> Column:
    return F.coalesce(F.length(name), F.lit(0))


def _size(c: Column | str) -> Column:
    return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _or_empty(name: str, kind: str = "array<string>") -> Column:
    return F.coalesce(F.col(name), F.array().cast(kind))


def _listed(name: str) -> Column:
    """A declared list, empty when it is missing."""
    return _or_empty(name, StructType.fromDDL(PRODUCT)[name].dataType.simpleString()).alias(name)


def _headings() -> Column:
    """Heading texts by tag, an empty object when there are none."""
    tags = F.create_map(F.lit("h1"), F.col("htags.h1"), F.lit("h2"), F.col("htags.h2"))
    return F.map_filter(tags, lambda _, v: v.isNotNull()).alias("htags")


def _page_attributes() -> Column:
    c, flag = F.col, select.flag
    shown = lambda v: v["selected"] & (F.size(v["properties"]) > 0)
    chosen = F.get(F.filter("variants", shown), F.lit(0))
    any_rich = [flag(c(n)) for n in ("wc_360", "wc_emc", "wc_pdf", "wc_prodtour", "wc_video")]
    counts = [_or_zero(f"webcollage_{n}_count") for n in ("images", "pdfs", "videos")]
    return F.struct(
        F.when(c("bundle"), 1).alias("bundle"),
        c("meta.canonical_url").alias("canonical_link"),
        c("collection_availability"), _or_zero("collection_count").alias("collection_count"), c("how_to_measure"), _headings(),
        _or_empty("image_alts").alias("image_alt_text"),
        F.transform(_or_empty("image_alts"), lambda a: F.coalesce(F.length(a), F.lit(0))).alias("image_alt_text_len"),
        _listed("image_colors"), _size("image_urls").alias("image_count"), _listed("image_dimensions"), _listed("image_res"), _or_empty("image_urls").alias("image_urls"),
        c("meta.keywords").alias("keywords"), c("_loaded_in_seconds").alias("loaded_in_seconds"), c("price_lowest").alias("lowest_item_price"),
        c("meta.description").alias("meta_description"), F.coalesce(F.length("meta.description"), F.lit(0)).alias("meta_description_count"),
        _size("meta.meta_tags").alias("meta_tags_count"), F.transform("meta.meta_tags", attribute_values).alias("meta_tags"),
        _size("pdf_urls").alias("pdf_count"), _or_empty("pdf_urls").alias("pdf_urls"),
        _or_zero("questions_total").alias("questions_total"), _or_zero("questions_unanswered").alias("questions_unanswered"),
        flag(c("_redirect")).alias("redirect"),
        F.array_join(F.map_values(chosen["properties"]), " ").alias("selected_variant"),
        flag(c("sellpoints")).alias("sellpoints"), _listed("swatches"), _listed("variants"),
        _or_empty("video_urls").alias("video_urls"), _size("video_urls").alias("video_count"),
        *[flag(c(n)).alias(n) for n in ("wc_360", "wc_emc", "wc_pdf", "wc_prodtour", "wc_video")],
        (F.greatest(*any_rich, *counts) > 0).cast("int").alias("webcollage"),
        _or_empty("webcollage_image_urls").alias("webcollage_image_urls"),
        *[n.alias(a) for n, a in zip(counts, ("webcollage_images_count", "webcollage_pdfs_count", "webcollage_videos_count"))],
        _listed("zoom_image_dimensions"),
    )


def _product_info() -> Column:
    c, flag = F.col, select.flag
    model = F.get(F.filter("meta.meta_tags", lambda m: (attribute(m, "itemprop") == "model") & (attribute(m, "content") != "")), F.lit(0))
    return F.struct(
        *[v.alias(n) for n, v in bullet_columns(c("bullets")).items()], c("bullets"),
        c("short_description").alias("description"), _len("short_description").alias("description_len"), c("details"), c("directions"),
        _or_empty("features").alias("features"), _size("features").alias("feature_count"), c("gtin"),
        _or_empty("ingredients").alias("ingredients"), _size("ingredients").alias("ingredient_count"),
        c("long_description"), _len("long_description").alias("long_description_len"), c("model"), attribute(model, "content").alias("model_meta"), c("mta"),
        flag(c("no_longer_available")).alias("no_longer_available"), _or_zero("nutrition_fact_count").alias("nutrition_fact_count"),
        select.truthy(c("nutrition_fact_text_health"), "number").alias("nutrition_fact_text_health"),
        c("title").alias("product_name"), c("title").alias("product_title"), flag(c("rich_content")).alias("rich_content"),
        c("shelf_description"), _len("shelf_description").alias("shelf_description_len"), c("shipping").cast("int").alias("shipping"), c("shipping_speed"),
        c("specs"), flag(c("temporary_unavailable")).alias("temporary_unavailable"), c("meta.browser_title").alias("title_seo"),
        _len("title").alias("title_len"), c("ugc"), c("upc"), c("warnings"), c("wupc"),
    )


def _reviews() -> tuple[Column, Column]:
    """(voted, block): whether any star has votes, and the export block."""
    stars = F.col("buyer_reviews.stars")
    voted = F.coalesce(F.exists(F.map_values(stars), lambda v: v > 0), F.lit(False))
    keys = F.map_keys(F.map_filter(stars, lambda k, v: v > 0))
    pairs = F.sort_array(F.map_entries(stars), asc=False)
    listed = F.transform(pairs, lambda e: F.array(e["key"].cast("bigint"), e["value"]))
    return voted, F.struct(
        select.truthy(F.col("buyer_reviews.average"), "number").alias("average_review"), F.array_max(keys).alias("max_review"),
        F.array_min(keys).alias("min_review"), F.coalesce("buyer_reviews.count", F.lit(0)).alias("review_count"),
        F.when(voted, listed).alias("reviews"))


def _sellers() -> Column:
    c = F.col
    # Facts come from all rows of the product where they were aggregated, else from the list at hand.
    rows, facts = c("marketplace"), c("marketplace_facts")
    has_rows = F.coalesce(facts["rows"] > 0, F.size(rows) > 0, F.lit(False))
    in_stock = F.when(has_rows, F.when(facts.isNotNull(), facts["in_stock"]).otherwise(F.exists(rows, lambda r: r["in_stock"])))
    lowest = F.when(facts.isNotNull(), facts["lowest_price"]).otherwise(F.array_min(F.transform(rows, lambda r: r["price"])))
    prices_of, names_of = F.transform(rows, lambda r: r["price"]), F.transform(rows, lambda r: r["name"])
    # An empty marketplace list is known to be empty; a null one is unknown.
    matrix = select.channel_matrix(c("site_online"), c("in_stores"), F.when(rows.isNotNull() | facts.isNotNull(), has_rows),
                                   c("site_online_out_of_stock"), c("in_stores_out_of_stock"), c("owned"))
    gone = F.coalesce("_out_of_stock", F.lit(False))
    return F.struct(
        F.coalesce(c("in_stock").cast("int"), F.when(gone, 0).otherwise(1)).alias("in_stock"),
        c("in_stores").cast("int").alias("in_stores"), *[v.alias(n) for n, v in matrix.items()],
        c("in_stores_out_of_stock"), (F.coalesce("marketplace_bool", F.lit(False)) | has_rows).cast("int").alias("marketplace"),
        in_stock.cast("int").alias("marketplace_in_stock"), (~in_stock).cast("int").alias("marketplace_out_of_stock"),
        lowest.alias("marketplace_lowest_price"),
        F.coalesce(F.filter(prices_of, lambda p: p != 0), F.array().cast("array<double>")).alias("marketplace_prices"),
        F.coalesce(F.filter(names_of, lambda n: n != ""), F.array().cast("array<string>")).alias("marketplace_sellers"),
        F.coalesce(select.truthy(c("price"), "string"), prices.price_text(c("price_amount"))).alias("price"),
        prices.seller_price(c("price_amount"), c("price")).alias("price_amount"),
        prices.currency_or_default(c("price_currency")).alias("price_currency"),
        c("primary_seller"), c("seller_id"), c("site_online").cast("int").alias("site_online"), c("site_online_out_of_stock"),
        c("subscribe_discount"), c("subscribe_price"), c("temp_price_cut"), c("us_seller_id"),
    )


def export_records(items: DataFrame) -> DataFrame:
    """Flat product items as nested export records (PRJ2)."""
    c = F.col
    df = conform(items)
    df = df.withColumn("_out_of_stock", F.when(c("no_longer_available"), True).otherwise(c("is_out_of_stock")))
    voted, reviews = _reviews()
    status, failure = job_outcome(c("invalid_url"), c("not_found"), c("redirect"), c("temporary_unavailable"))
    searched = (c("search_term") != "") & (c("title") != "")
    match = term_in_title(c("search_term"), c("title"))
    own_id = F.coalesce(select.truthy(c("site_product_id"), "string"), c("reseller_id"))
    crawled = stamp_text(c("_date"))
    computed = {
        "image_url": select.main_image(c("image_url"), c("image_urls")), "buyer_reviews": F.when(voted, c("buyer_reviews")), "crawled_at": crawled,
        "classification": F.struct(c("brand"), _or_empty("departments").alias("categories"), c("department").alias("category_name"), crawled.alias("date")),
        "page_attributes": _page_attributes(), "site_product_id": own_id, "reseller_id": own_id, "product_info": _product_info(),
        "price_amount": prices.flat_price(c("price_amount"), c("price")), "price_currency": prices.currency_or_default(c("price_currency")),
        "was_now": prices.was_now(c("now_price"), c("was_price")), "reviews": reviews, "sellers": _sellers(),
        "is_out_of_stock": F.when(~c("shipping"), True).otherwise(c("_out_of_stock")), "site_version": F.lit(2),
        "status_code": c("_response_code"), "status": status, "failure_type": failure,
        "proxy_service": F.lit(None).cast("string"), **{f"search_term_in_title_{n}": F.when(searched, v) for n, v in match.items()},
    }
    # All item fields stay on the top level, next to and below the computed ones.
    flat = [n for n in df.columns if n not in computed and n not in ("_out_of_stock", "marketplace_facts")]
    return df.select(*flat, *[v.alias(n) for n, v in computed.items()])


#: Keys that every record has, null or not; search flags only come with a term and a title.
RECORD_KEYS = (
    "department", "image_url", "buyer_reviews", "crawled_at", "classification", "page_attributes", "product_id", "site_product_id",
    "reseller_id", "product_info", "proxy_service", "price_amount", "price_currency", "was_now", "reviews", "sellers", "is_out_of_stock",
    "site_version", "status", "status_code", "walmart_no", "failure_type",
)


def without_nulls(record: Column) -> Column:
    """JSON text of an item without its null fields (PRJ3)."""
    return F.to_json(record, {"ignoreNullFields": "true"})


def record_json(records: DataFrame) -> Column:
    """One JSON object per record: item fields without nulls, and all ``RECORD_KEYS``, also those that are null."""
    item = without_nulls(F.struct(*[F.col(f"`{n}`") for n in records.columns if n not in RECORD_KEYS], F.lit(None).cast("string").alias("_")))
    fixed = F.to_json(F.struct(*[F.col(n) for n in RECORD_KEYS]), {"ignoreNullFields": "false"})
    return F.when(item == "{}", fixed).otherwise(F.concat(F.left(item, F.length(item) - 1), F.lit(","), F.substring(fixed, F.lit(2), F.length(fixed))))


def summary_items(items: DataFrame) -> DataFrame:
    """The few columns of a summary run (PRJ4); the rest is never computed."""
    return conform(items).select(*SUMMARY_COLUMNS)


def with_marketplace(items: DataFrame, rows: DataFrame, order: list[str], chunk: int = LIST_CHUNK) -> tuple[DataFrame, DataFrame]:
    """Items with their marketplace, and the parts of long lists that follow as a table of their own.

    ``rows``: product_id, name, price, currency, in_stock and the order columns. Number of rows, stock and lowest price
    are aggregates over all rows of a product, however long its list. The item holds the first ``chunk`` rows; the second
    table (product_id, part from 1 on, marketplace) holds all others, so that no record grows without bound.
    """
    facts = rows.groupBy(F.col("product_id").cast("string").alias("product_id")).agg(
        F.struct(F.count("*").alias("rows"), F.bool_or("in_stock").alias("in_stock"), F.min("price").cast("double").alias("lowest_price")).alias("marketplace_facts"))
    entry = rows.select("product_id", *order, F.struct("name", "price", "currency", "in_stock").alias("_entry"))
    lists = chunked_lists(entry, ["product_id"], order, "_entry", chunk, "marketplace").withColumnRenamed("chunk", "part")
    lists = lists.withColumn("product_id", F.col("product_id").cast("string"))
    first = lists.where("part = 0").drop("part")
    return items.join(facts, "product_id", "left").join(first, "product_id", "left"), lists.where("part > 0")
