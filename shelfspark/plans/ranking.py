"""Search and shelf queries (WIN1-WIN3, SRT1, SRT7, SET1, JN11, JN12, FIL13, PRJ9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions.select import is_single_result
from shelfspark.operators import ranking as op
from shelfspark.plans import models as m
from shelfspark.plans.registry import query

# Orders as search hits: the priority is the term, order keys give pages of 40 and places on them.
_HITS_SQL = """hits AS (SELECT o_orderpriority AS term, o_orderkey // 40 AS page, o_orderkey % 40 AS pos, o_orderkey AS hit FROM orders),
ranked AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY page, pos) AS ranking, count(*) OVER (PARTITION BY term, page) AS results_per_page FROM hits)"""


def _hits(t):
    key = F.col("o_orderkey")
    return t.orders.select(F.col("o_orderpriority").alias("term"), F.floor(key / 40).alias("page"), (key % 40).alias("pos"), key.alias("hit"))


@query("win1_search_ranking", f"WITH {_HITS_SQL} SELECT term, hit, ranking FROM ranked")
def _(t):
    return op.ranked_hits(_hits(t)).select("term", "hit", "ranking")


@query("win2_shelf_ranking", f"""WITH {_HITS_SQL}, f AS (SELECT term, count(*) AS n FROM hits h WHERE page = (SELECT min(page) FROM hits g WHERE g.term = h.term) GROUP BY 1),
l AS (SELECT term, CASE WHEN term LIKE '1%' THEN 25 WHEN term LIKE '2%' THEN n * 7 ELSE n END AS lim FROM f)
SELECT term, hit, ranking FROM ranked JOIN l USING (term) WHERE ranking <= lim""")
def _(t):
    term = F.col("o_orderpriority")
    pages = t.orders.select(term.alias("term")).distinct().select(
        "term", F.when(F.col("term").startswith("1"), 25).alias("quantity"), F.when(F.col("term").startswith("2"), 7).alias("pages_count"))
    return op.shelf_results(_hits(t), pages).select("term", "hit", "ranking")


@query("win3_page_sizes", f"WITH {_HITS_SQL}, n AS (SELECT term, count(*) AS total_matches FROM hits GROUP BY 1) SELECT term, hit, results_per_page, total_matches, false AS is_single_result FROM ranked JOIN n USING (term)")
def _(t):
    hits = _hits(t)
    totals = hits.groupBy("term").agg(F.count("*").alias("total_matches"))
    rows = op.ranked_hits(hits).join(totals, "term")
    return rows.select("term", "hit", "results_per_page", "total_matches", is_single_result(F.lit("search")).alias("is_single_result"))


@query("srt1_capped_results", f"WITH {_HITS_SQL} SELECT term, hit, ranking FROM ranked WHERE ranking <= CASE WHEN term LIKE '3%' THEN 250 ELSE 100 END")
def _(t):
    quantities = t.orders.select(F.col("o_orderpriority").alias("term")).distinct().where("term LIKE '3%'").withColumn("quantity", F.lit(250))
    return op.search_results(_hits(t), quantities).select("term", "hit", "ranking")


@query("jn11_hit_prefill", """SELECT 'u/' || c_custkey::VARCHAR AS url, coalesce(CASE WHEN h.k % 2 = 0 THEN 'hit ' || h.k::VARCHAR END, c_mktsegment) AS title, h.k AS ranking
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY 1) h ON o_custkey = c_custkey""")
def _(t):
    url = lambda c: F.concat(F.lit("u/"), F.col(c).cast("string"))
    products = t.customer.select(url("c_custkey").alias("url"), F.col("c_mktsegment").alias("title"))
    hits = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("ranking"))
    hits = hits.select(url("o_custkey").alias("url"), F.when(F.col("ranking") % 2 == 0, F.concat(F.lit("hit "), F.col("ranking").cast("string"))).alias("title"), "ranking")
    return op.with_hit_columns(products, hits, ["title", "ranking"])


@query("jn12_hit_flags", """WITH f AS (SELECT o_orderpriority AS term, CASE WHEN o_orderpriority NOT LIKE '5%' THEN min(o_orderkey) END AS featured_id FROM orders GROUP BY 1)
SELECT o_orderkey AS hit, o_orderstatus = 'P' AS is_sponsored, (CASE WHEN o_orderkey % 10 <> 9 THEN o_orderkey END) IS NOT DISTINCT FROM featured_id AS is_featured,
  CASE WHEN o_orderkey % 3 = 0 THEN true END AS is_best_seller, CASE WHEN o_orderkey % 3 = 1 THEN true END AS is_new FROM orders JOIN f ON term = o_orderpriority""")
def _(t):
    key = F.col("o_orderkey")
    hits = t.orders.select(
        F.col("o_orderpriority").alias("term"), key.alias("hit"), F.when(key % 10 != 9, key).alias("hit_id"),
        F.when(F.col("o_orderstatus") == "P", "ad").when(F.col("o_orderstatus") == "O", "").alias("ad"),
        F.when(key % 3 == 0, "bestseller").when(key % 3 == 1, "new").otherwise("sale").alias("badge"))
    featured = t.orders.groupBy(F.col("o_orderpriority").alias("term")).agg(F.min("o_orderkey").alias("featured_id"))
    featured = featured.withColumn("featured_id", F.when(~F.col("term").startswith("5"), F.col("featured_id")))
    return op.hit_flags(hits, featured).select("hit", "is_sponsored", "is_featured", "is_best_seller", "is_new")


@query("fil13_direct_landings", """SELECT c_custkey AS term, true AS redirect, 1::BIGINT AS total_matches FROM customer WHERE c_custkey % 4 <> 0
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority LIKE '1%')""")
def _(t):
    kind = F.when(F.col("c_custkey") % 4 == 0, "search?kw=").otherwise("pr/")
    terms = t.customer.select(F.col("c_custkey").alias("term"), F.concat(F.lit("https://shop.example/"), kind, F.col("c_custkey").cast("string")).alias("url"))
    landed = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("1")
    hits = t.orders.select(F.when(landed, F.col("o_custkey")).alias("term"))
    return op.direct_landings(terms, hits, r"^https://shop\.example/pr/.*?$").select("term", "redirect", "total_matches")


@query("srt7_page_frontier", """WITH n AS (SELECT o_custkey AS key, count(*) AS total FROM orders GROUP BY 1)
SELECT key, page FROM n, unnest(range(2, CAST(ceil(total / 4.0) AS BIGINT) + 1)) AS r(page)""")
def _(t):
    return op.page_frontier(t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("total")), 4)


@query("srt7_offset_frontier", """WITH n AS (SELECT o_custkey AS key, count(*) AS total FROM orders GROUP BY 1)
SELECT key, 8 + 3 * i AS "offset" FROM n, unnest(range(0, CAST(ceil(greatest(total - 8, 0) / 3.0) AS BIGINT))) AS r(i)""")
def _(t):
    return op.offset_frontier(t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("total")), 8, 3)


@query("set1_topic_union", """SELECT o_custkey AS shelf, o_orderkey AS topic, i::INTEGER AS pos, string_split(o_orderpriority, '-')[i + 1] AS item FROM orders, unnest(range(0, len(string_split(o_orderpriority, '-')))) AS r(i)""")
def _(t):
    topics = t.orders.select(F.col("o_custkey").alias("shelf"), F.col("o_orderkey").alias("topic"), F.split("o_orderpriority", "-").alias("items"))
    return op.merged_topics(topics)


@query("prj9_site_union", """SELECT 'supplier' AS site, s_suppkey AS id, s_name AS title, s_acctbal AS balance, NULL AS brand, NULL AS segment FROM supplier
UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_brand, NULL FROM part UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal, NULL, c_mktsegment FROM customer""")
def _(t):
    frames = [
        t.supplier.select(F.lit("supplier").alias("site"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), F.col("s_acctbal").alias("balance")),
        t.part.select(F.lit("part").alias("site"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand")),
        t.customer.select(F.lit("customer").alias("site"), F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")),
    ]
    return m.site_union(frames)
