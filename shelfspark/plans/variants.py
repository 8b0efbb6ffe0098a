"""Variant, spec, image and collection queries (JN7-JN10, JN19, JN20, JN24, AGG16-AGG24, WIN4, WIN6-WIN8, SET3, SRT6, FIL12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import prices
from shelfspark.operators import variants as op
from shelfspark.operators.groups import chunked_lists
from shelfspark.plans import models as m
from shelfspark.plans.registry import query
from shelfspark.session import pinned

_VARIANTS_SQL = """variants AS (SELECT p_brand AS product_id, p_partkey AS sku, p_partkey AS pos, p_size % 7 = 0 AS selected,
  CASE WHEN p_size % 5 <> 0 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS price, p_size % 2 = 0 AS in_stock,
  split_part(p_name, ' ', 1) AS color, split_part(p_name, ' ', 2) AS item FROM part)"""
_ORD_SQL = "l_linenumber * 100000000000000000 + l_orderkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT)"
_FEED_SQL = f"""feed AS (SELECT l_partkey AS sku, arg_max(CAST(l_extendedprice AS DECIMAL(12,2)), {_ORD_SQL}) AS price
  FROM lineitem GROUP BY 1)"""


def _variants(t):
    words = F.split("p_name", " ")
    return t.part.select(
        F.col("p_brand").alias("product_id"), F.col("p_partkey").alias("sku"), F.col("p_partkey").alias("pos"), (F.col("p_size") % 7 == 0).alias("selected"),
        F.when(F.col("p_size") % 5 != 0, m.cents("p_retailprice")).alias("price"), (F.col("p_size") % 2 == 0).alias("in_stock"),
        F.get(words, F.lit(0)).alias("color"), F.get(words, F.lit(1)).alias("item"))


def _ord():
    return (F.col("l_linenumber").cast("bigint") * 100000000000000000 + F.col("l_orderkey") * 100000000
            + F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def _feed(t):
    return t.lineitem.select(
        F.col("l_partkey").alias("sku"), m.cents("l_extendedprice").alias("price"), _ord().alias("ord"))


@query("jn7_variant_prices", f"WITH {_VARIANTS_SQL}, {_FEED_SQL} SELECT product_id, sku, CAST(coalesce(f.price, v.price) AS DOUBLE) AS price FROM variants v LEFT JOIN feed f USING (sku)")
def _(t):
    return m.in_double(op.reprice(_variants(t), _feed(t)).select("product_id", "sku", "price"))


@query("jn7_main_price", f"""WITH {_VARIANTS_SQL}, {_FEED_SQL}, p AS (SELECT product_id, min(sku) AS sku FROM variants GROUP BY 1)
SELECT product_id, sku, CAST(price AS DOUBLE) AS price_amount FROM p LEFT JOIN feed USING (sku)""")
def _(t):
    products = _variants(t).groupBy("product_id").agg(F.min("sku").alias("sku"))
    return m.in_double(op.main_price(products, _feed(t)).select("product_id", "sku", "price_amount"))


_DETAIL_SQL = """detail AS (SELECT l_partkey AS sku, CASE WHEN count(*) > 1 THEN min(CAST(l_extendedprice AS DECIMAL(12,2))) END AS price,
  CASE WHEN count(*) > 2 THEN bool_or(l_linestatus = 'O') END AS stock FROM lineitem GROUP BY 1)"""


def _details(t):
    return t.lineitem.groupBy(F.col("l_partkey").alias("sku")).agg(
        F.when(F.count("*") > 1, F.min(m.cents("l_extendedprice"))).alias("price"),
        F.when(F.count("*") > 2, F.bool_or(F.col("l_linestatus") == "O")).alias("add_to_cart"))


@query("jn8_variant_details", f"""WITH {_VARIANTS_SQL}, {_DETAIL_SQL}
SELECT product_id, sku, CAST(CASE WHEN d.sku IS NOT NULL AND NOT selected THEN d.price ELSE v.price END AS DOUBLE) AS price,
  CASE WHEN d.sku IS NOT NULL AND NOT selected THEN coalesce(stock, false) ELSE in_stock END AS in_stock FROM variants v LEFT JOIN detail d USING (sku)""")
def _(t):
    rows = op.with_details(_variants(t), _details(t), only_unselected=True)
    return m.in_double(rows.select("product_id", "sku", "price", "in_stock"))


@query("jn9_color_sizes", """WITH c AS (SELECT p_brand AS code, min(split_part(p_name, ' ', 1)) AS color FROM part GROUP BY 1)
SELECT code, color, p_partkey AS sku, p_size AS size, p_partkey % 3 <> 0 AS in_stock FROM c JOIN part ON p_brand = code""")
def _(t):
    colors = t.part.groupBy(F.col("p_brand").alias("code")).agg(F.min(F.substring_index("p_name", " ", 1)).alias("color"))
    sizes = t.part.select(F.col("p_brand").alias("code"), F.col("p_partkey").alias("sku"), F.col("p_size").alias("size"), (F.col("p_partkey") % 3).alias("stock_level"))
    return op.color_sizes(colors, sizes).select("code", "color", "sku", "size", "in_stock")


@query("jn10_sku_properties", """WITH x AS (SELECT p_partkey AS ord, p_brand AS name, lower(r_name) AS property, unnest([p_partkey, p_partkey + 1, p_partkey + 5]) AS sku
  FROM part JOIN region ON r_regionkey = p_size % 6) SELECT sku, property, arg_max(name, ord) AS value FROM x GROUP BY 1, 2""")
def _(t):
    key = F.col("p_partkey")
    values = t.part.select((F.col("p_size") % 6).alias("category_id"), F.col("p_brand").alias("name"), F.array(key, key + 1, key + 5).alias("skus"), key.alias("ord"))
    names = t.region.select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category"))
    return op.sku_properties(values, names)


@query("jn19_option_combinations", """SELECT p_partkey, c AS color, s AS size FROM part, unnest(string_split(p_name, ' ')) AS a(c),
  unnest(CASE p_size % 3 WHEN 0 THEN ['S', 'M', 'L'] WHEN 1 THEN ['One'] ELSE CAST([] AS VARCHAR[]) END) AS b(s)""")
def _(t):
    size = F.col("p_size") % 3
    sizes = F.when(size == 0, F.array(F.lit("S"), F.lit("M"), F.lit("L"))).when(size == 1, F.array(F.lit("One"))).otherwise(F.array().cast("array<string>"))
    return op.option_combinations(t.part, {"color": F.split("p_name", " "), "size": sizes}, ["p_partkey"])


@query("jn20_positional_zip", r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
x AS (SELECT doc_id, a, list_transform(a, lambda s: length(s)) AS b, len(a) AS n FROM l),
g AS (SELECT doc_id, i, a[i] AS name, CAST(b[i] AS BIGINT) AS size FROM x, unnest(range(1, n + 1)) AS r(i) WHERE doc_id % 5 <> 0)
SELECT doc_id, i - 1 AS pos, name, size FROM g""")
def _(t):
    lines = F.split("text", "\n")
    sizes = F.transform(lines, lambda s: F.length(s).cast("bigint"))
    uneven = F.when(F.col("doc_id") % 5 == 0, F.concat(sizes, F.array(F.lit(0).cast("bigint")))).otherwise(sizes)
    rows = t.documents.select("doc_id", F.posexplode(op.zipped(lines, uneven)).alias("pos", "pair"))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("pair.name").alias("name"), F.col("pair.value").alias("size"))


@query("jn24_upc_choice", """WITH p AS (SELECT p_brand AS product_id, (min(p_partkey) + 12)::VARCHAR AS site_id, (600000000000 + min(p_partkey))::VARCHAR AS code FROM part GROUP BY 1),
v AS (SELECT p_brand AS product_id, p_partkey AS pos, 'https://shop.example/ip/' || p_partkey::VARCHAR AS url, CASE WHEN p_size % 2 = 0 THEN lpad(p_partkey::VARCHAR, 12, '0') END AS upc FROM part),
h AS (SELECT product_id, upc, row_number() OVER (PARTITION BY product_id ORDER BY pos) AS rn FROM p JOIN v USING (product_id) WHERE contains(url, site_id))
SELECT product_id, coalesce(upc, lpad(code, 12, '0')) AS upc, CASE WHEN upc IS NULL THEN lpad(code, 14, '0') END AS gtin
FROM p LEFT JOIN (SELECT * FROM h WHERE rn = 1) f USING (product_id)""")
def _(t):
    low = F.min("p_partkey")
    products = t.part.groupBy(F.col("p_brand").alias("product_id")).agg((low + 12).cast("string").alias("site_id"), (low + 600000000000).cast("string").alias("code"))
    variants = t.part.select(
        F.col("p_brand").alias("product_id"), F.col("p_partkey").alias("pos"), F.concat(F.lit("https://shop.example/ip/"), F.col("p_partkey").cast("string")).alias("url"),
        F.when(F.col("p_size") % 2 == 0, F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("upc"))
    return op.upc_of_page(products, variants)


@query("agg16_spec_map", "SELECT p_brand AS product_id, p_type AS name, arg_max(p_name, p_partkey) AS value FROM part GROUP BY 1, 2")
def _(t):
    return op.spec_rows(t.part.select(F.col("p_brand").alias("product_id"), F.col("p_type").alias("name"), F.col("p_name").alias("value"), F.col("p_partkey").alias("ord")))


@query("fil12_displayed_attributes", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 0 THEN p_brand END AS brand,
  CASE WHEN p_size % 5 <> 0 THEN p_name WHEN p_size % 2 = 0 THEN p_type END AS label,
  CASE WHEN NOT (p_size % 2 = 0 AND p_size % 3 <> 0) AND NOT (p_size % 5 <> 0 OR p_size % 2 = 0) THEN NULL
       ELSE (p_size % 2 = 0 AND p_size % 3 <> 0)::INTEGER + (p_size % 5 <> 0 OR p_size % 2 = 0)::INTEGER END AS n FROM part""")
def _(t):
    cell = lambda name, value, shown: F.struct(F.lit(name).alias("name"), value.alias("value"), shown.alias("display"))
    size = F.col("p_size")
    attributes = F.array(
        cell("brand", F.when(size % 3 != 0, F.col("p_brand")), size % 2 == 0), cell("label", F.col("p_type"), size % 2 == 0),
        cell("label", F.col("p_name"), size % 5 != 0), cell("", F.col("p_name"), F.lit(True)))
    rows = t.part.select("p_partkey", op.displayed_attributes(attributes).alias("a"))
    return rows.select("p_partkey", F.try_element_at("a", F.lit("brand")).alias("brand"), F.try_element_at("a", F.lit("label")).alias("label"), F.size("a").alias("n")) \
        .withColumn("n", F.when(F.col("n") > 0, F.col("n")))


@query("agg17_property_columns", """SELECT p_partkey AS sku, split_part(p_name, ' ', 1) AS color, CASE WHEN p_size % 2 = 0 THEN p_type ELSE split_part(p_name, ' ', 2) END AS item,
  CASE WHEN p_size % 3 = 0 THEN p_size::VARCHAR END AS size FROM part""")
def _(t):
    cell = lambda p, v, o: F.struct(F.lit(p).alias("property"), v.alias("value"), F.lit(o).alias("ord"))
    size = F.col("p_size")
    cells = F.array(cell("color", F.substring_index("p_name", " ", 1), 0), cell("item", F.substring_index("p_name", " ", -1), 1),
                    cell("item", F.when(size % 2 == 0, F.col("p_type")), 2), cell("size", F.when(size % 3 == 0, size.cast("string")), 3))
    rows = t.part.select(F.col("p_partkey").alias("sku"), F.inline(cells)).where("value IS NOT NULL")
    return op.property_columns(rows, ["color", "item", "size"])


@query("agg18_option_prices", """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(CAST(p_retailprice AS DECIMAL(12,2)) + CAST(CAST(l_tax AS DECIMAL(4,2)) * l_linenumber AS DECIMAL(12,2)) AS DOUBLE) AS price
FROM lineitem JOIN part ON p_partkey = l_partkey""")
def _(t):
    delta = (F.col("l_tax").cast("decimal(4,2)") * F.col("l_linenumber")).cast(m.CENTS)
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return m.in_double(rows.select("l_orderkey", "l_linenumber", "l_suppkey", prices.option_price(m.cents("p_retailprice"), delta).alias("price")))


def _children(t):
    status = F.when(F.col("l_returnflag") == "A", "IN_STOCK").when(F.col("l_returnflag") == "N", "OUT_OF_STOCK")
    ord_ = F.col("l_linenumber").cast("bigint") * 100000000000000000 + F.col("l_partkey") * 100000000 + F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return t.lineitem.join(t.orders.select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_orderkey").alias("product_id"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"), status.alias("availability"), ord_.alias("ord"))


@query("agg19_collection_rollup", "SELECT l_orderkey AS product_id, count(*) AS collection_count, count(*) FILTER (WHERE l_returnflag = 'A') AS available_count FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def _(t):
    return op.collection_rollup(_children(t))


@query("agg19_collection_members", """SELECT l_orderkey AS product_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) - 1 AS pos,
  'part ' || l_partkey::VARCHAR AS name, l_returnflag = 'A' AS available FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(t):
    return op.collection_members(_children(t), ["ord"])


@query("agg20_condition_prices", f"""WITH x AS (SELECT l_partkey AS product_id, CASE WHEN l_linenumber = 7 THEN 'Digital' WHEN l_returnflag = 'A' THEN 'New' WHEN l_returnflag = 'N' THEN 'Pre-Owned' ELSE 'Refurbished' END AS c,
  CASE WHEN l_quantity > 25 THEN CAST(l_extendedprice AS DECIMAL(12,2)) WHEN l_quantity > 10 THEN 0 END AS price, {_ORD_SQL} AS ord FROM lineitem),
w AS (SELECT product_id, arg_max(price, ord) FILTER (WHERE c = 'New' AND price IS NOT NULL) AS a, arg_max(price, ord) FILTER (WHERE c = 'Pre-Owned' AND price IS NOT NULL) AS b,
  arg_max(price, ord) FILTER (WHERE c = 'Digital' AND price IS NOT NULL) AS d, arg_max(price, ord) FILTER (WHERE c = 'Refurbished' AND price IS NOT NULL) AS r FROM x GROUP BY 1)
SELECT product_id, CAST(a AS DOUBLE) AS price_new, CAST(b AS DOUBLE) AS price_preowned, CAST(d AS DOUBLE) AS price_download, CAST(r AS DOUBLE) AS price_regular,
  CAST(coalesce(nullif(a, 0), nullif(b, 0), nullif(d, 0), nullif(r, 0)) AS DOUBLE) AS price_amount FROM w""")
def _(t):
    condition = F.when(F.col("l_linenumber") == 7, "Digital").when(F.col("l_returnflag") == "A", "New").when(F.col("l_returnflag") == "N", "Pre-Owned").otherwise("Refurbished")
    price = F.when(F.col("l_quantity") > 25, m.cents("l_extendedprice")).when(F.col("l_quantity") > 10, F.lit(0).cast(m.CENTS))
    rows = t.lineitem.select(F.col("l_partkey").alias("product_id"), condition.alias("condition"), price.alias("price"), _ord().alias("ord"))
    return m.in_double(op.condition_prices(rows))


@query("agg21_leaf_counts", """WITH RECURSIVE n AS (SELECT 'r' || r_regionkey AS id, NULL AS parent_id FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer),
w(id, root) AS (SELECT id, id FROM n WHERE parent_id IS NULL UNION ALL SELECT n.id, w.root FROM n JOIN w ON n.parent_id = w.id)
SELECT root AS id, count(*) AS leaves FROM w WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.parent_id = w.id) GROUP BY 1""")
def _(t):
    name = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    nodes = (t.region.select(name("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"))
             .unionByName(t.nation.select(name("n", "n_nationkey").alias("id"), name("r", "n_regionkey").alias("parent_id")))
             .unionByName(t.customer.select(name("c", "c_custkey").alias("id"), name("n", "c_nationkey").alias("parent_id"))))
    return op.leaf_counts(nodes, pinned)


@query("agg23_swatches", """SELECT p_brand AS product_id, p_partkey AS sku, split_part(p_name, ' ', 1) AS color,
  CASE WHEN p_size % 3 = 2 THEN 'img/' || p_partkey::VARCHAR END AS hero_image, (p_size % 3 = 2)::INTEGER AS hero FROM part WHERE p_type IN ('PROMO', 'SMALL')""")
def _(t):
    size = F.col("p_size") % 3
    rows = t.part.select(
        F.col("p_brand").alias("product_id"), F.col("p_partkey").alias("sku"), F.substring_index("p_name", " ", 1).alias("name"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), "SWATCH").otherwise("LIST").alias("type"),
        F.when(size == 0, "none.jpg").when(size == 2, F.concat(F.lit("img/"), F.col("p_partkey").cast("string"))).alias("image_url"))
    out = op.swatch_rows(rows, "none.jpg")
    return out.select("product_id", "sku", F.col("name").alias("color"), F.get("hero_image", F.lit(0)).alias("hero_image"), "hero")


@query("agg24_rendition_flags", """SELECT p_partkey // 10 AS product_id, p_partkey % 10 AS image_no, (p_size % 3 <> 0)::INTEGER AS image_dimension,
  (p_size % 4 <> 0)::INTEGER AS zoom_dimension FROM part""")
def _(t):
    size = F.col("p_size")
    cell = lambda n, b: F.struct(F.lit(n).alias("rendition"), b.cast("bigint").alias("bytes"))
    raw = F.when(size % 5 != 0, size * 100)
    cells = F.array(cell("raw", raw), cell("x500", F.when(size % 3 == 0, raw).otherwise(F.lit(7))), cell("x1500", F.when(size % 4 == 0, raw).otherwise(F.lit(9))))
    rows = t.part.select(F.floor(F.col("p_partkey") / 10).alias("product_id"), (F.col("p_partkey") % 10).alias("image_no"), F.inline(cells))
    return op.rendition_flags(rows)


@query("win4_selected_variant", f"""WITH {_VARIANTS_SQL} SELECT product_id, arg_min(color || ' ' || item, pos) FILTER (WHERE selected AND sku % 4 <> 0) AS selected_variant,
  CAST(arg_min(price, pos) FILTER (WHERE selected AND price <> 0) AS DOUBLE) AS price_amount FROM variants GROUP BY 1""")
def _(t):
    values = F.when(F.col("sku") % 4 != 0, F.array("color", "item")).otherwise(F.array().cast("array<string>"))
    return m.in_double(op.selected_variant(_variants(t).withColumn("property_values", values)))


@query("win6_best_seller", f"""WITH r AS (SELECT l_partkey AS product_id, {_ORD_SQL} AS pos, CASE WHEN l_quantity > 10 THEN l_quantity::BIGINT END AS rank, l_returnflag || '>' || l_linestatus AS path FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY pos) AS rn FROM r) SELECT product_id, coalesce(rank, 0) AS bestseller_rank, path FROM f WHERE rn = 1""")
def _(t):
    ranks = t.lineitem.select(F.col("l_partkey").alias("product_id"), _ord().alias("pos"), F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("bigint")).alias("rank"),
                              F.concat_ws(">", "l_returnflag", "l_linestatus").alias("path"))
    return op.best_seller(ranks)


@query("win7_largest_assets", """WITH a AS (SELECT p_brand AS product_id, p_partkey // 4 AS image, p_size * 20 AS w, (51 - p_size) * 15 AS h, p_size % 6 = 0 AS bad, p_size % 5 = 0 AS zoom FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id, image ORDER BY bad, w DESC, h DESC) AS rn, max(zoom AND bad) OVER (PARTITION BY product_id, image) AS any_zoom FROM a)
SELECT product_id, image, (CASE WHEN bad THEN 0 ELSE w END)::BIGINT AS width, (CASE WHEN bad THEN 0 ELSE h END)::BIGINT AS height, any_zoom::INTEGER AS zoom,
  (NOT bad AND (w >= 500 OR h >= 500))::INTEGER AS large FROM r WHERE rn = 1""")
def _(t):
    size = F.col("p_size")
    sized = F.concat(F.lit("IMAGE_SIZE_"), (size * 20).cast("string"), F.lit("_"), ((F.lit(51) - size) * 15).cast("string"))
    asset = F.when((size % 6 == 0) & (size % 5 == 0), "zoom").when(size % 6 == 0, "main").otherwise(sized)
    rows = op.largest_assets(t.part.select(F.col("p_brand").alias("product_id"), F.floor(F.col("p_partkey") / 4).alias("image"), asset.alias("asset")))
    return rows.select("product_id", "image", "width", F.col("height").cast("bigint").alias("height"), "zoom", "large")


@query("win8_first_per_value", f"WITH {_VARIANTS_SQL} SELECT product_id, color, min(pos) AS pos FROM variants GROUP BY 1, 2")
def _(t):
    return op.first_per_value(_variants(t), ["product_id"], "color", "pos")


@query("set3_other_skus", """SELECT p_brand AS product_id, p_partkey // 3 AS sku FROM part EXCEPT ALL SELECT p_brand, min(p_partkey // 3) FROM part GROUP BY 1""")
def _(t):
    variants = t.part.select(F.col("p_brand").alias("product_id"), F.floor(F.col("p_partkey") / 3).alias("sku"))
    return op.other_skus(variants, variants.groupBy("product_id").agg(F.min("sku").alias("sku")))


@query("srt6_price_call_batches", """WITH r AS (SELECT p_brand, p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 25 AS chunk FROM part)
SELECT p_brand, chunk, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS skus FROM r GROUP BY 1, 2""")
def _(t):
    lists = chunked_lists(t.part.select("p_brand", "p_partkey"), ["p_brand"], ["p_partkey"], "p_partkey", 25, "skus")
    return lists.withColumn("skus", F.array_join("skus", ","))
