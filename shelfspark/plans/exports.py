"""Export, sink, brand and deep-search queries (PRJ2-PRJ4, SNK1-SNK3, SRC2, SRC3, SRC4, SRT3, SRT4, SET2, JN13, UDF1, UDF6, FN28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import codes, prices, select
from shelfspark.operators import brands, deepsearch, export, joblog
from shelfspark.operators import reviews as review_op
from shelfspark.plans import intake
from shelfspark.plans import models as m
from shelfspark.plans.registry import query
from shelfspark.session import work_path
from shelfspark.sources import tables

# ---- items and export -----------------------------------------------------

_ITEMS_SQL = f"""{m.OFFERS_SQL},
rev AS (SELECT l_partkey AS k, count(*) AS n, CAST(sum(least(l_linenumber, 5)) AS BIGINT) AS p, min(least(l_linenumber, 5)) AS lo, max(least(l_linenumber, 5)) AS hi FROM lineitem GROUP BY 1),
mk AS (SELECT l_partkey AS k, count(*) AS mn, bool_or(l_returnflag = 'A') AS stocked, min(CAST(l_extendedprice AS DECIMAL(12,2))) AS low FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
items AS (SELECT *, CASE WHEN p_size % 3 = 0 THEN format('${{:,.2f}}', p_retailprice) END AS price, CASE WHEN p_size % 3 <> 1 THEN p_retailprice + 1 END AS price_amount,
  CASE WHEN p_size % 4 = 0 THEN p_size % 8 = 0 END AS shipping, CASE WHEN p_size % 6 = 0 THEN true END AS gone, p_size % 2 = 0 AS online, p_size % 10 < 5 AS stores
  FROM part LEFT JOIN rev ON rev.k = p_partkey LEFT JOIN mk ON mk.k = p_partkey)"""


def base_items(t):
    """Parts as product items."""
    size, key = F.col("p_size"), F.col("p_partkey")
    return t.part.select(
        key.cast("string").alias("product_id"), F.concat(F.lit("https://shop.example/ip/"), key.cast("string")).alias("url"),
        F.col("p_name").alias("title"), F.when(size % 5 != 0, F.col("p_brand")).alias("brand"), F.array("p_type", "p_brand").alias("departments"), F.col("p_type").alias("department"),
        F.when(size % 3 == 0, prices.price_text(F.col("p_retailprice"))).alias("price"), F.when(size % 3 != 1, F.col("p_retailprice") + 1).alias("price_amount"),
        F.when(size % 4 == 0, size % 8 == 0).alias("shipping"), F.when(size % 6 == 0, True).alias("no_longer_available"), (size % 2 == 0).alias("site_online"),
        (size % 10 < 5).alias("in_stores"), F.when(size % 7 == 0, F.lit("red ring")).alias("search_term"), F.split("p_name", " ").alias("image_urls"),
        F.regexp_replace("p_name", " ", "\n").alias("bullets"), F.lit(200).alias("_response_code"), F.lit("2024-03-05 06:07:08").cast("timestamp_ntz").alias("_date"),
        F.when(size % 11 == 0, True).alias("not_found"))


def export_items(t, chunk=export.LIST_CHUNK):
    """Product items with reviews and marketplace rows from line items, and the further parts of long lists."""
    rated = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.least("l_linenumber", F.lit(5)).alias("rating"))
    wide = review_op.star_counts(rated)
    stars = F.map_from_arrays(F.array(*[F.lit(s) for s in review_op.STARS]), F.array(*[F.col(f"star_{s}") for s in review_op.STARS]))
    summary = m.in_double(review_op.summary(review_op.star_rows(wide)))
    reviews = wide.join(summary, "product_id").select(
        F.col("product_id").cast("string").alias("product_id"),
        F.struct(F.col("min_star").alias("min"), F.col("max_star").alias("max"), stars.alias("stars"), F.col("review_count").alias("count"), "average",
                 F.lit(None).cast("date").alias("last_review_date")).alias("buyer_reviews"))
    rows = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("l_partkey").alias("product_id"), F.col("s_name").alias("name"), F.col("l_extendedprice").alias("price"), F.lit("USD").alias("currency"),
        (F.col("l_returnflag") == "A").alias("in_stock"), "l_orderkey", "l_linenumber", "l_extendedprice")
    return export.with_marketplace(base_items(t).join(reviews, "product_id", "left"), rows, ["l_orderkey", "l_linenumber", "l_extendedprice"], chunk)


def export_record_rows(t, chunk=export.LIST_CHUNK):
    """Export records with the number of all their marketplace rows, beyond those that the record lists."""
    items = export_items(t, chunk)[0]
    return export.export_records(items.withColumn("marketplace_rows", F.coalesce("marketplace_facts.rows", F.lit(0))))


@query("prj2_export_record", f"""WITH {_ITEMS_SQL} SELECT p_partkey::VARCHAR AS product_id, p_name AS title, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand, p_type || '>' || p_brand AS categories, '2024-03-05 06:07:08' AS crawled_at,
  split_part(p_name, ' ', 1) AS image_url, 2 AS image_count, length(p_name) AS title_len, split_part(p_name, ' ', 2) AS bullet_feature_2, 2 AS bullet_feature_count,
  shipping::INTEGER AS shipping, coalesce(gone, false)::INTEGER AS no_longer_available,
  coalesce(price_amount, TRY_CAST(replace(regexp_extract(price, '[0-9.,]+'), ',', '') AS DOUBLE)) AS price_amount,
  CASE WHEN n IS NOT NULL THEN CAST((200 * p + n) // (2 * n) AS DOUBLE) / 100 END AS average_review, coalesce(n, 0) AS review_count, lo AS min_review, hi AS max_review,
  coalesce(price, format('${{:,.2f}}', price_amount)) AS seller_price, coalesce(TRY_CAST(replace(regexp_extract(price, '[0-9.,]+'), ',', '') AS DOUBLE), price_amount) AS seller_price_amount,
  CASE WHEN gone THEN 0 ELSE 1 END AS in_stock, coalesce(mn > 0, false)::INTEGER AS marketplace, stocked::INTEGER AS marketplace_in_stock, CAST(low AS DOUBLE) AS marketplace_lowest_price, coalesce(mn, 0) AS marketplace_rows,
  CASE WHEN mn IS NOT NULL THEN (NOT online AND stores)::INTEGER END AS in_stores_only, CASE WHEN mn IS NOT NULL THEN (NOT stores)::INTEGER END AS online_only, (online OR stores)::INTEGER AS owned,
  CASE WHEN shipping = false THEN true ELSE gone END AS is_out_of_stock, CASE WHEN p_size % 11 = 0 THEN 'failure' ELSE 'success' END AS status, CASE WHEN p_size % 11 = 0 THEN '404' END AS failure_type,
  CASE WHEN p_size % 7 = 0 THEN p_name = 'red ring' END AS term_exactly FROM items""")
def _(t):
    r = export_record_rows(t)
    c = F.col
    return r.select(
        "product_id", "title", c("classification.brand").alias("brand"), F.array_join("classification.categories", ">").alias("categories"), "crawled_at", "image_url",
        c("page_attributes.image_count").alias("image_count"), c("product_info.title_len").cast("bigint").alias("title_len"), c("product_info.bullet_feature_2").alias("bullet_feature_2"),
        c("product_info.bullet_feature_count").alias("bullet_feature_count"), c("product_info.shipping").alias("shipping"), c("product_info.no_longer_available").alias("no_longer_available"),
        "price_amount", c("reviews.average_review").alias("average_review"), c("reviews.review_count").alias("review_count"), c("reviews.min_review").alias("min_review"),
        c("reviews.max_review").alias("max_review"), c("sellers.price").alias("seller_price"), c("sellers.price_amount").alias("seller_price_amount"), c("sellers.in_stock").alias("in_stock"),
        c("sellers.marketplace").alias("marketplace"), c("sellers.marketplace_in_stock").alias("marketplace_in_stock"), c("sellers.marketplace_lowest_price").alias("marketplace_lowest_price"),
        "marketplace_rows", c("sellers.in_stores_only").alias("in_stores_only"), c("sellers.online_only").alias("online_only"),
        c("sellers.owned").alias("owned"), "is_out_of_stock", "status", "failure_type", c("search_term_in_title_exactly").alias("term_exactly"))


@query("prj3_null_free_json", """SELECT p_partkey, 'p_partkey' || CASE WHEN p_size % 5 <> 0 THEN ',p_brand' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN ',p_name' ELSE '' END AS keys FROM part""")
def _(t):
    size = F.col("p_size")
    record = F.struct("p_partkey", F.when(size % 5 != 0, F.col("p_brand")).alias("p_brand"), F.when(size % 3 == 0, F.col("p_name")).alias("p_name"))
    return t.part.select("p_partkey", F.array_join(F.json_object_keys(export.without_nulls(record)), ",").alias("keys"))


@query("prj4_summary_items", f"""WITH {_ITEMS_SQL} SELECT p_partkey::VARCHAR AS product_id, p_name AS title, shipping, NULL::VARCHAR AS shipping_speed, NULL::VARCHAR AS wupc, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand, price, NULL::VARCHAR AS price_currency,
  NULL::BOOLEAN AS temp_price_cut, NULL::BOOLEAN AS is_out_of_stock FROM items""")
def _(t):
    return export.summary_items(base_items(t))


@query("udf1_converter", "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, reverse(o_orderpriority)) AS kept FROM orders")
def _(t):
    old = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", select.first_set(old, F.col("o_orderpriority"), conv=F.reverse).alias("kept"))


# ---- sinks ----------------------------------------------------------------

def write_export_files(t, chunk=export.LIST_CHUNK):
    """Write the records, and the further parts of long marketplace lists beside them; the path of both.

    The run is named, and started a second time, which adds nothing.
    """
    path = work_path(t.spark, "export")
    items, parts = export_items(t, chunk)
    records = export.export_records(items)
    day = F.make_date(F.lit(2024), F.col("_size") % 3 + 1, F.lit(5))
    sized = records.join(t.part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_size").alias("_size")), "product_id")
    for _ in range(2):
        tables.write_export(sized.withColumn("_day", day).drop("_size"), path, F.col("_day"), run="all-parts", marketplace=parts, compression="gzip")
    return path


def exported_marketplace(t, chunk=export.LIST_CHUNK):
    """Marketplace rows in the files, by product and part: part 0 is the record's own list."""
    path = write_export_files(t, chunk)
    rows = "marketplace array<struct<name:string>>"
    first = tables.read_export(t.spark, path, f"product_id string, {rows}").select("product_id", F.lit(0).cast("bigint").alias("part"), "marketplace")
    rest = tables.read_export(t.spark, path, f"product_id string, part bigint, {rows}", part="marketplace")
    names = F.col("marketplace.name")
    return first.unionByName(rest).where(F.size("marketplace") > 0).select(
        "product_id", "part", F.size("marketplace").cast("bigint").alias("n"), F.element_at(names, 1).alias("first_name"), F.element_at(names, -1).alias("last_name"))


@query("snk1_export_files", f"""WITH {_ITEMS_SQL} SELECT p_partkey::VARCHAR AS product_id, p_name AS title, '2024' AS y, lpad((1 + p_size % 3)::VARCHAR, 2, '0') AS m, '05' AS d, coalesce(n, 0) AS review_count FROM items""")
def _(t):
    path = write_export_files(t)
    schema = "product_id string, title string, reviews struct<review_count:bigint>, y string, m string, d string"
    return tables.read_export(t.spark, path, schema).select("product_id", "title", "y", "m", "d", F.col("reviews.review_count").alias("review_count"))


@query("snk1_export_marketplace", f"""WITH r AS (SELECT l_partkey, s_name, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) - 1 AS p FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey IN (SELECT p_partkey FROM part))
SELECT l_partkey::VARCHAR AS product_id, (p // {export.LIST_CHUNK})::BIGINT AS part, count(*) AS n, arg_min(s_name, p) AS first_name, arg_max(s_name, p) AS last_name FROM r GROUP BY 1, 2""")
def _(t):
    return exported_marketplace(t)


@query("snk2_result_files", intake.ORACLE_SNK2_FILES)
def _(t):
    path = work_path(t.spark, "messages")
    tables.write_messages(intake.result_messages_of(t), path)
    return t.spark.read.schema("value string, queue string").text(path).groupBy("queue").agg(
        F.count("*").alias("n"), F.count_if(F.get_json_object("value", "$.status") == "success").alias("successes"))


@query("snk3_job_log_files", f"SELECT job_id, response_time, failure_cause, status, s3_filepath, duration FROM ({intake.JOB_LOG_SQL})")
def _(t):
    path = work_path(t.spark, "joblog")
    tables.write_job_logs(joblog.job_log(intake.job_events(t.events)), path)
    return t.spark.read.schema("job_id string, response_time double, failure_cause string, status string, s3_filepath string, duration double").json(path)


_ARCHIVE_SITES = ["blog.ththan.example.net", "therha.example.com", "therer.example.com", "therrin.example.net"]
_ARCHIVE_SQL = """WITH a AS (SELECT page_id, replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '') AS site, sha1(url) AS fingerprint, url, 1 + page_id % 3 AS day FROM pages WHERE page_id % 8 > 2 AND page_id % 5 <> 0)
SELECT fingerprint, url, site FROM a WHERE site IN ('blog.ththan.example.net', 'therha.example.com', 'therer.example.com', 'therrin.example.net')"""


def _day_archive(t):
    """All pages as answers of three days, stored."""
    path = work_path(t.spark, "archive")
    k = F.col("page_id")
    rows = t.pages.select(
        codes.domain(F.col("url")).alias("site"), F.make_date(F.lit(2024), F.lit(5), (k % 3 + 1).cast("int")).alias("crawl_date"), F.sha1(F.col("url").cast("binary")).alias("fingerprint"),
        "url", F.col("html").alias("body"), F.when(k % 8 > 2, 200).otherwise(404).alias("status"), (k % 5 == 0).alias("cached"))
    tables.append_archive(rows, path)
    return path


@query("src2_archive_scan", f"{_ARCHIVE_SQL} AND day IN (1, 3)")
def _(t):
    return tables.read_archive(t.spark, _day_archive(t), _ARCHIVE_SITES, ["2024-05-01", "2024-05-03"]).select("fingerprint", "url", "site")


@query("src2_archive_lookup", f"""{_ARCHIVE_SQL} AND url IN (SELECT min(url) FROM pages GROUP BY regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))""")
def _(t):
    first = t.pages.groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)).agg(F.min("url").alias("url"))
    wanted = first.select(F.sha1(F.col("url").cast("binary")).alias("fingerprint"))
    return tables.read_archive(t.spark, _day_archive(t), _ARCHIVE_SITES, ["2024-05-01", "2024-05-02", "2024-05-03"], wanted).select("fingerprint", "url", "site")


@query("src3_archive_append", """WITH a AS (SELECT page_id, sha1(url) AS fingerprint, page_id % 8 > 2 AND page_id % 5 <> 0 AS fresh FROM pages)
SELECT fingerprint, count(*) AS copies FROM a WHERE fresh GROUP BY 1""")
def _(t):
    path = work_path(t.spark, "archive")
    k = F.col("page_id")
    rows = t.pages.select(
        k, codes.domain(F.col("url")).alias("site"), F.lit("2024-05-01").cast("date").alias("crawl_date"), F.sha1(F.col("url").cast("binary")).alias("fingerprint"),
        "url", F.when(k % 8 > 2, 200).otherwise(404).alias("status"), (k % 5 == 0).alias("cached"))
    tables.append_archive(rows.where(k % 2 == 0), path)
    tables.append_archive(rows, path, t.spark.read.parquet(path))
    return t.spark.read.parquet(path).groupBy("fingerprint").agg(F.count("*").alias("copies"))


# ---- brands ---------------------------------------------------------------

_LINES_SQL = """names AS (SELECT DISTINCT p_name FROM part), lines AS (SELECT p_name, split_part(p_name, ' ', 2) AS grp, split_part(p_name, ' ', 1) AS word FROM names),
cells AS (SELECT p_name AS line_no, grp, unnest([grp, p_name, word, 'the ' || word || ', ' || grp]) AS alias FROM lines),
aliases AS (SELECT alias, arg_max(grp, line_no) AS brand_group FROM cells GROUP BY 1)"""


def _aliases(t):
    """Dictionary written as text lines in name order, then scanned."""
    path = work_path(t.spark, "brands")
    names = t.part.select("p_name").distinct()
    word, group = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    line = F.concat(group, F.lit(" ,"), F.col("p_name"), F.lit(","), word, F.lit(',"the '), word, F.lit(", "), group, F.lit('", '))
    names.orderBy("p_name").select(line.alias("value")).write.text(path)
    return brands.alias_table(brands.read_brand_lines(t.spark, path))


@query("src4_brand_dictionary", f"WITH {_LINES_SQL} SELECT alias, brand_group FROM aliases")
def _(t):
    return _aliases(t)


def _brand_lists(t):
    first = t.part.select(F.when(F.col("p_size") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("brand"))
    return first, t.part.select(F.col("p_type").alias("brand"))


_BRAND_LISTS_SQL = "a AS (SELECT CASE WHEN p_size % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS brand FROM part), b AS (SELECT p_type AS brand FROM part)"


@query("srt3_sorted_brands", f"WITH {_BRAND_LISTS_SQL}, u AS (SELECT brand FROM a UNION SELECT brand FROM b) SELECT brand FROM u ORDER BY lower(brand), brand")
def _(t):
    return brands.sorted_brands(*_brand_lists(t))


@query("set2_added_brands", f"WITH {_BRAND_LISTS_SQL}, c AS (SELECT brand FROM b UNION ALL SELECT brand FROM a) SELECT brand FROM a UNION ALL SELECT DISTINCT brand FROM c WHERE brand NOT IN (SELECT brand FROM a)")
def _(t):
    first, second = _brand_lists(t)
    return brands.added_brands(first, second.union(first))


@query("srt4_longest_alias", "WITH m AS (SELECT p_brand, max(length(p_name)) AS n FROM part GROUP BY 1) SELECT part.p_brand, min(p_name) AS alias FROM part JOIN m ON m.p_brand = part.p_brand AND length(p_name) = n GROUP BY 1")
def _(t):
    return brands.longest(t.part.select("p_brand", F.col("p_name").alias("alias")), ["p_brand"])


def _titles(t):
    """Part names with typing errors, brand words inside, or no brand at all."""
    kind = F.col("p_size") % 5
    word, last = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    title = (F.when(kind == 0, F.concat(F.left(last, F.lit(3)), F.substring(last, F.lit(3), F.lit(99)), F.lit(" deluxe")))
             .when(kind == 1, F.concat(F.lit("Super "), last, F.lit(" in "), word))
             .when(kind == 2, F.concat(F.lit("«"), F.upper(last), F.lit("» pack")))
             .when(kind == 3, F.concat(F.lit("unbranded thing "), F.col("p_size").cast("string"))).otherwise("The"))
    return t.part.select("p_partkey", title.alias("title"))


# Short keys only, as in the fixture: up to two deletions per side reach every pair of up to 15 characters.
_TOKENS = "list_sort(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9_]+'), lambda x: x <> ''))"
_GUESS_SQL = rf"""WITH {_LINES_SQL}, t AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN substr(split_part(p_name, ' ', 2), 1, 3) || substr(split_part(p_name, ' ', 2), 3) || ' deluxe'
  WHEN 1 THEN 'Super ' || split_part(p_name, ' ', 2) || ' in ' || split_part(p_name, ' ', 1) WHEN 2 THEN '«' || upper(split_part(p_name, ' ', 2)) || '» pack'
  WHEN 3 THEN 'unbranded thing ' || p_size ELSE 'The' END AS title FROM part),
w AS (SELECT DISTINCT split_part(title, ' ', 1) AS word, array_to_string({_TOKENS.format("split_part(title, ' ', 1)")}, ' ') AS k FROM t),
al AS (SELECT alias, brand_group, array_to_string({_TOKENS.format('alias')}, ' ') AS k FROM aliases),
ks AS (SELECT DISTINCT k FROM (SELECT k FROM w UNION ALL SELECT k FROM al) WHERE k <> ''),
v1 AS (SELECT k, substr(k, 1, i - 1) || substr(k, i + 1) AS v FROM ks, unnest(range(1, length(k) + 1)) AS r(i)),
v2 AS (SELECT k, substr(v, 1, i - 1) || substr(v, i + 1) AS v FROM v1, unnest(range(1, length(v) + 1)) AS r(i)),
vs AS (SELECT k, k AS v FROM ks UNION SELECT * FROM v1 UNION SELECT * FROM v2),
p1 AS (SELECT DISTINCT word, alias, brand_group, floor(200.0 * length(a.v) / (length(w.k) + length(al.k)) + 0.5) AS score FROM w JOIN vs a ON a.k = w.k JOIN vs b ON b.v = a.v JOIN al ON al.k = b.k),
s1 AS (SELECT word, brand_group FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY score DESC, length(alias) DESC, alias) AS rn FROM p1 WHERE score >= 90) WHERE rn = 1),
p2 AS (SELECT p_partkey, alias, brand_group FROM t, al WHERE list_has_all({_TOKENS.format('title')}, {_TOKENS.format('alias')}) OR list_has_all({_TOKENS.format('alias')}, {_TOKENS.format('title')})),
s2 AS (SELECT p_partkey, brand_group FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY length(alias) DESC, alias) AS rn FROM p2) WHERE rn = 1)
SELECT t.p_partkey, title, coalesce(s1.brand_group, s2.brand_group) AS brand FROM t LEFT JOIN s1 ON s1.word = split_part(title, ' ', 1) LEFT JOIN s2 ON s2.p_partkey = t.p_partkey"""


@query("jn13_brand_guess", _GUESS_SQL)
def _(t):
    return brands.guess_brands(_titles(t), _aliases(t)).select("p_partkey", "title", "brand")


@query("jn13_contained_brand", rf"""WITH {_LINES_SQL}, t AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Super ' || split_part(p_name, ' ', 2) || ' in ' || split_part(p_name, ' ', 1) WHEN 1 THEN 'the' ELSE 'nothing ' || p_size END AS title FROM part),
tt AS (SELECT p_partkey, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9_]+'), lambda x: x <> '')) AS tw FROM t),
aa AS (SELECT alias, brand_group, list_distinct(list_filter(regexp_split_to_array(lower(alias), '[^a-z0-9_]+'), lambda x: x <> '')) AS aw FROM aliases),
p AS (SELECT p_partkey, alias FROM tt, aa WHERE list_has_all(tw, aw) OR list_has_all(aw, tw)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY length(alias) DESC, alias) AS rn FROM p)
SELECT p_partkey, alias FROM r WHERE rn = 1""")
def _(t):
    kind = F.col("p_size") % 3
    word, last = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    title = (F.when(kind == 0, F.concat(F.lit("Super "), last, F.lit(" in "), word)).when(kind == 1, "the")
             .otherwise(F.concat(F.lit("nothing "), F.col("p_size").cast("string"))))
    titles = t.part.select("p_partkey", title.alias("title"))
    found = brands.contained_matches(titles, _aliases(t))
    return titles.withColumn("title_key", brands.title_key(F.col("title"))).join(found, "title_key").select("p_partkey", "alias")


@query("udf6_similarity", """WITH s AS (SELECT s_suppkey, s_suppkey % 11 = 0 AS other, length(s_name) AS n, s_suppkey % 5 AS cut, s_suppkey % 7 AS added FROM supplier)
SELECT s_suppkey, CASE WHEN other THEN 0 ELSE CAST(floor(200.0 * (n - cut) / (2 * n - cut + added) + 0.5) AS INTEGER) END AS score FROM s""")
def _(t):
    # A name against itself without its first letters and with letters it lacks at the end; or against nothing it shares.
    name, k = F.lower("s_name"), F.col("s_suppkey")
    near = F.concat(F.substring(name, (k % 5 + 1).cast("int"), F.length(name)), F.repeat(F.lit("x"), (k % 7).cast("int")))
    return t.supplier.select("s_suppkey", brands.similarity_udf(name, F.when(k % 11 == 0, "!!").otherwise(near)).alias("score"))


# ---- deep search ----------------------------------------------------------

@query("fn28_deep_key_search", """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders)
SELECT k, 0 AS pos, '{"code":"' || s || '","upc":"hidden"}' AS value FROM o WHERE k % 3 = 0
UNION ALL SELECT k, 0, '"' || p || '"' FROM o WHERE k % 3 = 1 UNION ALL SELECT k, 1, k::VARCHAR FROM o WHERE k % 3 = 1""")
def _(t):
    k = F.col("o_orderkey")
    key = k.cast("string")
    nested = F.concat(F.lit('{"product":{"a":[1,{"upc":{"code":"'), F.col("o_orderstatus"), F.lit('","upc":"hidden"},"list":[{"upc":"sibling"}]}]}}'))
    listed = F.concat(F.lit('[{"upc":"'), F.col("o_orderpriority"), F.lit('"},{"x":{"y":{"upc":'), key, F.lit('}}},{"z":null}]'))
    document = F.when(k % 3 == 0, nested).when(k % 3 == 1, listed).otherwise(F.concat(F.lit('{"note":"upc","broken":'), key))
    rows = deepsearch.with_deep_values(t.orders.select(k.alias("k"), document.alias("document")), "document", "upc", "v").drop("document")
    return rows.select("k", F.posexplode("v").alias("pos", "value"))
