"""Variants, options, specs, swatches, images and collections of a product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import codes, flags
from shelfspark.functions.select import first_truthy, truthy
from shelfspark.operators.groups import numbered


def reprice(variants: DataFrame, feed: DataFrame) -> DataFrame:
    """Variant prices replaced by the feed's last price of the sku (JN7)."""
    latest = feed.groupBy("sku").agg(F.max_by("price", "ord").alias("_new"))
    return variants.join(latest, "sku", "left").withColumn("price", F.coalesce("_new", "price")).drop("_new")


def main_price(products: DataFrame, feed: DataFrame) -> DataFrame:
    """Product price from its own sku in the feed. ``products``: product_id, sku."""
    latest = feed.groupBy("sku").agg(F.max_by("price", "ord").alias("price_amount"))
    return products.join(latest, "sku", "left")


def with_details(variants: DataFrame, details: DataFrame, only_unselected: bool = False) -> DataFrame:
    """Price and stock of a variant taken from its detail record (JN8); of several for a sku, the largest by ``ord`` if there is one."""
    found = details.select("sku", F.col("price").alias("_price"), F.coalesce("add_to_cart", F.lit(False)).alias("_stock"),
                           (F.col("ord") if "ord" in details.columns else F.lit(0)).alias("_ord"))
    last = F.max(F.struct("_ord", "_price", "_stock")).alias("_last")
    found = found.groupBy("sku").agg(last).select("sku", "_last._price", "_last._stock")
    rows = variants.join(found, "sku", "left")
    hit = F.col("_stock").isNotNull()
    if only_unselected:
        hit = hit & ~F.coalesce("selected", F.lit(False))
    return rows.withColumns({
        "price": F.when(hit, F.col("_price")).otherwise(F.col("price")),
        "in_stock": F.when(hit, F.col("_stock")).otherwise(F.col("in_stock")),
    }).drop("_price", "_stock")


def color_sizes(colors: DataFrame, sizes: DataFrame) -> DataFrame:
    """One variant per colour and size option of that colour (JN9)."""
    return colors.join(sizes, "code").withColumn("in_stock", F.coalesce(F.col("stock_level") != 0, F.lit(False)))


def sku_properties(values: DataFrame, names: DataFrame) -> DataFrame:
    """(sku, property, value), the last value of a repeated property (JN10).

    ``values``: category_id, name, skus, ord. ``names``: category_id, category.
    """
    rows = values.select("category_id", "name", "ord", F.explode("skus").alias("sku"))
    rows = rows.join(names, "category_id").withColumn("property", F.lower("category"))
    return rows.groupBy("sku", "property").agg(F.max_by("name", "ord").alias("value"))


def option_combinations(products: DataFrame, options: dict[str, Column], keys: list[str]) -> DataFrame:
    """Every combination of a product's own option lists (JN19); a row-local expansion, no join."""
    rows = products.select(*keys, *[c.alias(n) for n, c in options.items()])
    for n in options:
        rows = rows.withColumn(n, F.explode(n))
    return rows


def zipped(names: Column, values: Column, same_size: bool = True) -> Column:
    """array<struct<name,value>> by position; null when sizes must agree but do not (JN20)."""
    size = F.least(F.size(names), F.size(values))
    pairs = F.slice(F.arrays_zip(names.alias("name"), values.alias("value")), F.lit(1), size)
    if not same_size:
        return pairs
    return F.when((F.size(names) == F.size(values)) & (size > 0), pairs)


def upc_of_page(products: DataFrame, variants: DataFrame) -> DataFrame:
    """UPC of the first variant whose url holds the page's id, else from the GTIN (JN24)."""
    pairs = variants.select("product_id", "url", "upc", "pos").join(products.select("product_id", "site_id"), "product_id")
    hits = pairs.where(F.col("url").contains(F.col("site_id")))
    first = hits.groupBy("product_id").agg(F.min_by("upc", "pos").alias("_upc"))
    gtin = codes.gtin14(F.col("code"))
    return products.join(first, "product_id", "left").select(
        "product_id",
        F.coalesce(truthy(F.col("_upc"), "string"), codes.upc12(gtin)).alias("upc"),
        F.when(truthy(F.col("_upc"), "string").isNull(), gtin).alias("gtin"))


def spec_rows(specs: DataFrame) -> DataFrame:
    """(product_id, name, value), the last value of a repeated name (AGG16)."""
    return specs.groupBy("product_id", "name").agg(F.max_by("value", "ord").alias("value"))


def displayed_attributes(attributes: Column) -> Column:
    """map<name, value> of shown attributes with a key and a value; null when none (FIL12)."""
    shown = F.filter(attributes, lambda a: a["display"] & (F.length(a["name"]) > 0) & (F.length(a["value"]) > 0))
    # A later attribute of the same name replaces the earlier one.
    names = F.array_distinct(F.transform(shown, lambda a: a["name"]))
    last = lambda n: F.element_at(F.filter(shown, lambda a: a["name"] == n), -1)["value"]
    return F.when(F.size(names) > 0, F.map_from_arrays(names, F.transform(names, last)))


def property_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """One row per sku with a column per property (AGG17). ``rows``: sku, property, value, ord."""
    pick = lambda n: F.max_by("value", F.when(F.col("property") == n, F.col("ord")))
    return rows.groupBy("sku").agg(*[pick(n).alias(n) for n in names])


def collection_rollup(children: DataFrame) -> DataFrame:
    """Child count and how many are in stock (AGG19). ``children``: product_id, name, availability, ord."""
    return children.groupBy("product_id").agg(
        F.count("*").alias("collection_count"),
        F.count_if(F.coalesce(F.col("availability") == "IN_STOCK", F.lit(False))).alias("available_count"))


def collection_members(children: DataFrame, order: list[str]) -> DataFrame:
    """Position, name and availability of every child, in page order (AGG19)."""
    placed = numbered(children, ["product_id"], order, "pos")
    return placed.select("product_id", "pos", "name", F.coalesce(F.col("availability") == "IN_STOCK", F.lit(False)).alias("available"))


# Conditions a game may be sold in, in order of preference.
CONDITIONS = {"price_new": "New", "price_preowned": "Pre-Owned", "price_download": "Digital", "price_regular": "Refurbished"}


def condition_prices(rows: DataFrame) -> DataFrame:
    """Last price per condition and the first non-zero one as main price (AGG20)."""
    last = lambda name: F.max_by("price", F.when((F.col("condition") == name) & F.col("price").isNotNull(), F.col("ord")))
    wide = rows.groupBy("product_id").agg(*[last(v).alias(k) for k, v in CONDITIONS.items()])
    return wide.withColumn("price_amount", first_truthy("number", *[F.col(k) for k in CONDITIONS]))


def swatch_rows(variants: DataFrame, placeholder: str) -> DataFrame:
    """Swatch name, hero image list without the placeholder, and its size (AGG23)."""
    shown = variants.where((F.col("type") == "SWATCH") & F.col("name").isNotNull())
    image = F.col("image_url")
    real = (image != "") & (image != placeholder)
    images = F.when(real, F.array(image)).otherwise(F.array().cast("array<string>"))
    return shown.withColumn("hero_image", images).withColumn("hero", F.size("hero_image"))


def first_per_value(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """First position of each distinct value, the order-preserving de-duplication (WIN8)."""
    return rows.groupBy(*keys, value).agg(F.min(order).alias(order))


def rendition_flags(renditions: DataFrame) -> DataFrame:
    """Whether the raw image is larger than its 500 and 1500 px renditions (AGG24).

    ``renditions``: product_id, image_no, rendition, bytes. Equal bytes, also both
    missing, mean the raw image is not larger.
    """
    size = lambda name: F.max(F.when(F.col("rendition") == name, F.col("bytes")))
    wide = renditions.groupBy("product_id", "image_no").agg(
        size("raw").alias("raw"), size("x500").alias("x500"), size("x1500").alias("x1500"))
    larger = lambda name: (~F.col("raw").eqNullSafe(F.col(name))).cast("int")
    return wide.select("product_id", "image_no", larger("x500").alias("image_dimension"), larger("x1500").alias("zoom_dimension"))


def selected_variant(variants: DataFrame) -> DataFrame:
    """Joined properties of the first selected variant, and price of the first one with a price (WIN4)."""
    shown = F.when(F.col("selected") & (F.size("property_values") > 0), F.col("pos"))
    priced = F.when(F.col("selected") & (F.col("price") != 0), F.col("pos"))
    return variants.groupBy("product_id").agg(
        F.min_by(F.array_join("property_values", " "), shown).alias("selected_variant"),
        F.min_by("price", priced).alias("price_amount"))


def largest_assets(assets: DataFrame) -> DataFrame:
    """Widest rendition per image with large and zoom flags (WIN7). ``assets``: product_id, image, asset."""
    side = lambda i: F.regexp_extract("asset", r"^IMAGE_SIZE_(\d+)_(\d+)", i).try_cast("bigint")
    sized = assets.withColumns({"_w": side(1), "_h": side(2)})
    # One sortable number instead of a struct keeps the aggregate in a hash table.
    packed = F.max(F.col("_w") * 2**31 + F.col("_h"))
    rows = sized.groupBy("product_id", "image").agg(
        F.coalesce(packed, F.lit(0)).alias("_top"), F.bool_or(F.col("asset") == "zoom").cast("int").alias("zoom"))
    rows = rows.withColumns({"width": F.floor(F.col("_top") / 2**31).cast("bigint"), "height": F.col("_top") % 2**31})
    return rows.withColumn("large", flags.large_either(F.col("width"), F.col("height"))).drop("_top")


def best_seller(ranks: DataFrame) -> DataFrame:
    """Rank and category path of the first listed rank (WIN6). ``ranks``: product_id, pos, rank, path."""
    return ranks.groupBy("product_id").agg(
        F.min_by(F.coalesce("rank", F.lit(0)), "pos").alias("bestseller_rank"), F.min_by("path", "pos").alias("path"))


def other_skus(variants: DataFrame, products: DataFrame) -> DataFrame:
    """Variant skus without one occurrence of the product's own sku (SET3)."""
    return variants.select("product_id", "sku").exceptAll(products.select("product_id", "sku"))


def leaf_counts(nodes: DataFrame, pinned) -> DataFrame:
    """Leaves below every root of a forest (AGG21). ``nodes``: id, parent_id (null at a root), each id once.

    A node whose parent is not among the nodes is a root as well. Nodes on or below a cycle have no root and are left out
    (``rootless`` names them). ``pinned`` cuts the lineage per round.
    """
    inner = nodes.select(F.col("parent_id").alias("id")).where("id IS NOT NULL").distinct()
    leaves = _rooted(nodes, pinned)[0].join(inner, "id", "left_anti")
    return leaves.groupBy(F.col("root").alias("id")).agg(F.count("*").alias("leaves"))


def rootless(nodes: DataFrame, pinned) -> DataFrame:
    """Nodes on or below a cycle."""
    return _rooted(nodes, pinned)[1]


def _rooted(nodes: DataFrame, pinned) -> tuple[DataFrame, DataFrame]:
    """(id, root) of every node that has a root, and the ids of those that have none.

    Pointers double: a node knows the ancestor 1, 2, 4, ... levels above, and in each round takes over what that one knows, so
    rounds grow with the logarithm of the depth. Only nodes still on their way are stored again. A round that brings
    no node to a root ends it: depths have no gaps, so what is left lies on or below cycles.
    """
    known = nodes.select(F.col("id").alias("_id")).distinct()
    first = nodes.join(known, nodes["parent_id"] == known["_id"], "left")
    first = pinned(first.select("id", F.coalesce("_id", "id").alias("up"), F.col("_id").isNull().alias("at_root")))
    done, open_ = first.where("at_root"), first.where("NOT at_root")
    while not open_.isEmpty():
        above = done.unionByName(open_).select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("at_root").alias("_at_root"))
        moved = pinned(open_.drop("at_root").join(above, "up").select("id", F.col("_up").alias("up"), F.col("_at_root").alias("at_root")))
        arrived, open_ = moved.where("at_root"), moved.where("NOT at_root")
        if arrived.isEmpty():
            break
        done = done.unionByName(arrived)
    return done.select("id", F.col("up").alias("root")), open_.select("id")
