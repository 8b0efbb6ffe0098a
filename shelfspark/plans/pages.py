"""Page queries (SRC5, PAG1-PAG8, PRJ5, FIL3-FIL5, AGG11, AGG12, UDF3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import codes
from shelfspark.functions.text import between
from shelfspark.operators import pages as op
from shelfspark.plans.registry import query

_UN = ("replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')")
_DOMAIN = "replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '')"

# Pages with the markup the crawl lacks, built from the page's own id, url and title.
_RICH_SQL = """rich AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)', 1) AS title, html || CASE page_id % 4
  WHEN 0 THEN '<link rel="canonical" href="https://shop.example/ip/' || page_id || '"><meta name="keywords" content="k' || page_id || '"><meta name=''description''  content="d ' || page_id || '">'
  WHEN 1 THEN '<h2>part <i>' || page_id || '</i></h2><meta itemprop="model" content="m' || page_id || '"><img class="a wc-image" src="/i/' || page_id || '.jpg"><a href="doc' || page_id || '.pdf">pdf</a>'
  WHEN 2 THEN '<script>window.__STATE__ = {"product": {"id": ' || page_id || ', "price": "9.' || (page_id % 90 + 10) || '"}};</script><video src="//cdn.example/' || page_id || '.mp4"></video>'
  ELSE '<script type="application/ld+json">{"sku": "s' || page_id || '", "offers": {"price": ' || page_id || '.5}}</script><div data-section-tag="360-view"></div>' END AS html FROM pages)"""


def _rich(t):
    key = F.col("page_id").cast("string")
    kind = F.col("page_id") % 4
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    extra = (
        F.when(kind == 0, text('<link rel="canonical" href="https://shop.example/ip/', key, '"><meta name="keywords" content="k', key,
                               '"><meta name=\'description\'  content="d ', key, '">'))
        .when(kind == 1, text("<h2>part <i>", key, '</i></h2><meta itemprop="model" content="m', key, '"><img class="a wc-image" src="/i/', key,
                              '.jpg"><a href="doc', key, '.pdf">pdf</a>'))
        .when(kind == 2, text('<script>window.__STATE__ = {"product": {"id": ', key, ', "price": "9.', (F.col("page_id") % 90 + 10).cast("string"),
                              '"}};</script><video src="//cdn.example/', key, '.mp4"></video>'))
        .otherwise(text('<script type="application/ld+json">{"sku": "s', key, '", "offers": {"price": ', key, '.5}}</script><div data-section-tag="360-view"></div>')))
    return t.pages.select("page_id", "url", between(F.col("html"), "<title>", "</title>").alias("title"), F.concat("html", extra).alias("html"))


@query("src5_page_scan", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def _(t):
    return t.pages.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query("pag1_meta_table", f"""WITH {_RICH_SQL} SELECT page_id, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
  CASE WHEN page_id % 4 = 0 THEN 'https://shop.example/ip/' || page_id END AS canonical_url, {_UN.format('title')} AS browser_title,
  CASE WHEN page_id % 4 = 0 THEN 'k' || page_id END AS keywords, CASE WHEN page_id % 4 = 0 THEN 'd ' || page_id END AS description,
  array_to_string(list_transform(regexp_extract_all(html, '<meta[^>]*>'), lambda x: regexp_replace(x, '\\s+', ' ', 'g')), '|') AS meta_tags FROM rich""")
def _(t):
    return op.meta_table(_rich(t)).withColumn("meta_tags", F.array_join("meta_tags", "|"))


@query("pag2_heading_rows", f"""WITH {_RICH_SQL}, a AS (SELECT page_id, 1 AS level, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS t FROM rich)
SELECT page_id, level, 0 AS pos, {_UN.format('t')} AS text FROM a WHERE t <> ''
UNION ALL SELECT page_id, 2, 0, 'part ' FROM rich WHERE page_id % 4 = 1 UNION ALL SELECT page_id, 2, 1, page_id::VARCHAR FROM rich WHERE page_id % 4 = 1""")
def _(t):
    return op.heading_rows(_rich(t))


@query("pag2_heading_arrays", f"""WITH {_RICH_SQL} SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1, CASE WHEN page_id % 4 = 1 THEN 'part |' || page_id ELSE '' END AS h2 FROM rich""")
def _(t):
    return op.heading_arrays(_rich(t)).select("page_id", F.array_join("h1", "|").alias("h1"), F.array_join("h2", "|").alias("h2"))


@query("pag3_meta_attributes", f"""WITH {_RICH_SQL} SELECT page_id, 0 AS tag_no, 0 AS pos, 'charset' AS name, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS value FROM rich
UNION ALL SELECT page_id, 1, 0, 'name', 'keywords' FROM rich WHERE page_id % 4 = 0 UNION ALL SELECT page_id, 1, 1, 'content', 'k' || page_id FROM rich WHERE page_id % 4 = 0
UNION ALL SELECT page_id, 2, 0, 'name', 'description' FROM rich WHERE page_id % 4 = 0 UNION ALL SELECT page_id, 2, 1, 'content', 'd ' || page_id FROM rich WHERE page_id % 4 = 0
UNION ALL SELECT page_id, 1, 0, 'itemprop', 'model' FROM rich WHERE page_id % 4 = 1 UNION ALL SELECT page_id, 1, 1, 'content', 'm' || page_id FROM rich WHERE page_id % 4 = 1""")
def _(t):
    return op.meta_attributes(_rich(t))


@query("pag3_meta_model", "SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'm' || page_id END AS model_meta FROM pages")
def _(t):
    return op.meta_model(_rich(t))


@query("pag4_inline_json", """SELECT page_id, CASE WHEN page_id % 4 = 2 THEN page_id END AS state_id, CASE WHEN page_id % 4 = 2 THEN '9.' || (page_id % 90 + 10) END AS state_price,
  CASE WHEN page_id % 4 = 3 THEN 's' || page_id END AS ld_sku, CASE WHEN page_id % 4 = 3 THEN page_id + 0.5::DOUBLE END AS ld_price FROM pages""")
def _(t):
    df = _rich(t).select("page_id", op.inline_json(F.col("html"), r"window\.__STATE__").alias("state"), op.json_ld(F.col("html")).alias("ld"))
    return df.select("page_id", F.try_variant_get("state", "$.product.id", "bigint").alias("state_id"),
                     F.try_variant_get("state", "$.product.price", "string").alias("state_price"),
                     F.try_variant_get("ld", "$.sku", "string").alias("ld_sku"), F.try_variant_get("ld", "$.offers.price", "double").alias("ld_price"))


_PROFILES = [
    op.Candidate("*", "title", "regex", r"<h1>([^<]*)</h1>"),
    op.Candidate("*", "lang", "attribute", "html@lang"),
    op.Candidate("*", "sku", "json_ld", "$.sku", 0),
    op.Candidate("*", "sku", "regex", r'itemprop="model" content="([^"]*)"', 1),
    op.Candidate("spam-farm.example.org", "title", "constant", "spam"),
    op.Candidate("cheap-pills.example.com", "title", "regex", r"<h2>(.*?)</h2>", 0),
    op.Candidate("cheap-pills.example.com", "title", "regex", r"<title>([^<]*)</title>", 1),
]


@query("pag5_profile_fields", f"""WITH {_RICH_SQL}, s AS (SELECT *, {_DOMAIN} AS site FROM rich)
SELECT page_id, site, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
  CASE page_id % 4 WHEN 3 THEN 's' || page_id WHEN 1 THEN 'm' || page_id END AS sku,
  CASE site WHEN 'spam-farm.example.org' THEN 'spam'
    WHEN 'cheap-pills.example.com' THEN coalesce(nullif(regexp_extract(html, '<h2>(.*?)</h2>', 1), ''), nullif(title, ''))
    ELSE nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') END AS title FROM s""")
def _(t):
    return op.extract_fields(_rich(t), t.spark.createDataFrame(_PROFILES, op.PROFILE_SCHEMA))


@query("udf3_site_hooks", f"""SELECT page_id, {_DOMAIN} AS site, CASE WHEN {_DOMAIN} = 'casino-win.example.org' THEN length(html) END AS size,
  CASE WHEN {_DOMAIN} = 'spam-farm.example.org' THEN split_part(url, '?', 1) END AS bare FROM pages""")
def _(t):
    hooks = {
        "casino-win.example.org": lambda: {"size": F.length("html").cast("bigint")},
        "spam-farm.example.org": lambda: {"bare": codes.without_query(F.col("url"))},
    }
    return op.apply_site_hooks(t.pages, hooks, default=dict)


@query("pag6_listing_links", """WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages)
SELECT page_id, i - 1 AS pos, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || a[i] AS link FROM l, unnest(range(1, len(a) + 1)) AS r(i)""")
def _(t):
    return op.listing_links(t.pages).withColumn("pos", F.col("pos").cast("bigint"))


@query("pag7_rich_content", """SELECT page_id, page_id % 4 = 3 AS wc_360, false AS wc_emc, false AS wc_pdf, false AS wc_prodtour, false AS wc_video,
  (page_id % 4 = 1)::INTEGER AS images_count, 0 AS pdfs_count, 0 AS videos_count, false AS rich_content FROM pages""")
def _(t):
    return op.rich_content(_rich(t))


@query("agg12_rich_content_flag", "SELECT page_id, (page_id % 4 IN (1, 3))::INTEGER AS webcollage FROM pages")
def _(t):
    return op.rich_content_flag(op.rich_content(_rich(t)))


@query("pag8_media_lists", """SELECT page_id, CASE WHEN page_id % 4 = 1 THEN regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '[^/]*$', '') || 'doc' || page_id || '.pdf' ELSE '' END AS pdf_urls,
  CASE WHEN page_id % 4 = 2 THEN regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example/' || page_id || '.mp4' ELSE '' END AS video_urls,
  CASE WHEN page_id % 4 = 1 THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/i/' || page_id || '.jpg' ELSE '' END AS image_urls FROM pages""")
def _(t):
    show = lambda n: F.array_join(n, ",").alias(n)
    return op.media_lists(_rich(t)).select("page_id", show("pdf_urls"), show("video_urls"), show("image_urls"))


@query("prj5_technical_columns", """SELECT page_id, '2024-01-01 00:00:00' AS crawled_at, page_id % 5 = 1 AS redirected, CASE page_id % 5 WHEN 0 THEN 404 WHEN 1 THEN 302 ELSE 200 END AS response_code, url,
  CASE WHEN page_id % 6 <> 5 THEN CASE WHEN page_id % 3 = 0 THEN 'site-' || page_id % 10 ELSE lower(r_name) || '.example' END END AS site, CASE WHEN page_id % 2 = 0 THEN 'p' || page_id END AS product_id
FROM pages LEFT JOIN region ON r_regionkey = page_id % 6""")
def _(t):
    key = F.col("page_id")
    responses = t.pages.select(
        "page_id", "url", F.when(key % 5 == 0, 404).when(key % 5 == 1, 302).otherwise(200).alias("status"),
        F.when(key % 3 == 0, F.concat(F.lit("site-"), (key % 10).cast("string"))).when(key % 3 == 1, "").alias("message_site"),
        F.when(key % 2 == 0, F.concat(F.lit("p"), key.cast("string"))).alias("message_product_id"), (key % 6).alias("spider"))
    sites = t.region.select(F.col("r_regionkey").alias("spider"), F.concat(F.lower("r_name"), F.lit(".example")).alias("allowed_domain"))
    return op.technical_columns(responses, sites, F.lit("2024-01-01 00:00:00"))


@query("fil3_valid_urls", f"""SELECT page_id, {_DOMAIN} AS site, CASE WHEN {_DOMAIN} LIKE '%.org' THEN regexp_matches(lower(url), '^(https?://)?[a-z.-]+/[a-z]+/[0-9]+')
  WHEN {_DOMAIN} LIKE '%.net' THEN regexp_matches(lower(url), '/en/') ELSE false END AS valid_url FROM pages""")
def _(t):
    site = codes.domain(F.col("url"))
    rules = t.pages.select(site.alias("site")).distinct().select(
        "site", F.when(F.col("site").endswith(".org"), r"^(https?://)?[a-z.-]+/[a-z]+/\d+").when(F.col("site").endswith(".net"), "/en/").alias("pattern"))
    return op.valid_urls(t.pages, rules.where("pattern IS NOT NULL"))


_FINAL_SQL = "CASE WHEN page_id % 3 = 0 THEN regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '[^/]*$', '') || '999' ELSE url END"
_LEAF = "split_part(regexp_extract({}, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/', -1)"


def _final_url():
    bare = F.substring_index(F.substring_index("url", "?", 1), "#", 1)
    return F.when(F.col("page_id") % 3 == 0, F.concat(F.regexp_replace(bare, "[^/]*$", ""), F.lit("999"))).otherwise(F.col("url"))


@query("fil4_redirects", f"WITH u AS (SELECT page_id, url, {_FINAL_SQL} AS final_url FROM pages) SELECT page_id, {_LEAF.format('url')} <> {_LEAF.format('final_url')} AS redirect FROM u")
def _(t):
    return t.pages.select("page_id", codes.is_redirect(F.col("url"), _final_url()).alias("redirect"))


@query("fil5_response_routes", f"""WITH u AS (SELECT page_id, url, {_FINAL_SQL} AS final_url, CASE page_id % 7 WHEN 0 THEN 520 WHEN 1 THEN 404 WHEN 2 THEN 400 ELSE 200 END AS status FROM pages)
SELECT page_id, status, CASE WHEN NOT url LIKE 'https%' THEN 'invalid_url' WHEN {_LEAF.format('url')} <> {_LEAF.format('final_url')} THEN 'redirect' WHEN status = 520 THEN 'temporary_unavailable'
  WHEN status IN (404, 400) OR page_id % 5 = 0 THEN 'not_found' END AS route FROM u""")
def _(t):
    key = F.col("page_id")
    rows = t.pages.select(
        "page_id", F.col("url").startswith("https").alias("url_ok"), F.col("url").alias("first_url"), _final_url().alias("final_url"),
        F.when(key % 7 == 0, 520).when(key % 7 == 1, 404).when(key % 7 == 2, 400).otherwise(200).alias("status"), (key % 5 != 0).alias("has_payload"))
    return op.routed_responses(rows, (404, 400)).select("page_id", "status", "route")


@query("agg11_completeness", f"""WITH {_RICH_SQL}, d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)
SELECT page_id, (page_id % 4 = 1)::INTEGER AS image_count, (page_id % 4 = 2)::INTEGER AS video_count, (page_id % 4 = 1)::INTEGER AS pdf_count,
  coalesce(len(l), 0) AS feature_count, coalesce(len(string_split(text, ',')), 0) AS ingredient_count, len(regexp_extract_all(html, '<meta')) AS meta_tags_count,
  length({_UN.format('title')}) AS title_len, coalesce(length(text), 0) AS description_len, 0 AS long_description_len, 0 AS shelf_description_len,
  CASE WHEN page_id % 4 = 0 THEN 2 + length(page_id::VARCHAR) ELSE 0 END AS meta_description_count,
  CASE WHEN page_id % 4 = 1 THEN length({_UN.format('title')})::VARCHAR ELSE '' END AS image_alt_text_len
FROM rich LEFT JOIN d ON doc_id = page_id""")
def _(t):
    rich = _rich(t)
    docs = t.documents.select(F.col("doc_id").alias("page_id"), F.split("text", "\n").alias("features"), F.split("text", ",").alias("ingredients"), F.col("text").alias("short_description"))
    df = rich.select("page_id").join(op.media_lists(rich), "page_id").join(op.meta_table(rich), "page_id").join(docs, "page_id", "left")
    df = df.withColumns({
        "title": F.col("browser_title"), "meta_description": F.col("description"), "image_alts": F.transform("image_urls", lambda u: F.col("browser_title")),
        "long_description": F.lit(None).cast("string"), "shelf_description": F.lit(None).cast("string")})
    out = op.completeness(df)
    wide = ("feature_count", "ingredient_count", "meta_tags_count", "title_len", "description_len", "meta_description_count")
    out = out.withColumns({n: F.col(n).cast("bigint") for n in wide})
    return out.withColumn("image_alt_text_len", F.array_join(F.transform("image_alt_text_len", lambda n: n.cast("string")), ","))
