"""Review queries (AGG1-AGG5, SRT2, JN22, UDF2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import reviews as op
from shelfspark.plans import models as m
from shelfspark.plans.registry import query

_REVIEWS_SQL = """reviews AS (SELECT l_partkey AS product_id, least(l_linenumber, 5) AS rating, CAST(l_shipdate AS DATE) AS review_date,
  l_linenumber * 100000000000000000 + l_orderkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS pos FROM lineitem)"""
_WIDE_SQL = f"""{_REVIEWS_SQL}, wide AS (SELECT product_id, count(*) FILTER (WHERE rating = 1 AND product_id % 4 <> 0) AS star_1,
  count(*) FILTER (WHERE rating = 2) AS star_2, count(*) FILTER (WHERE rating = 3) AS star_3, count(*) FILTER (WHERE rating = 4) AS star_4,
  count(*) FILTER (WHERE rating = 5 AND product_id % 5 <> 0) AS star_5 FROM reviews GROUP BY 1)"""


def _reviews(t):
    pos = (F.col("l_linenumber").cast("bigint") * 100000000000000000 + F.col("l_orderkey") * 100000000
           + F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return t.lineitem.select(F.col("l_partkey").alias("product_id"), F.least("l_linenumber", F.lit(5)).alias("rating"),
                             F.col("l_shipdate").cast("date").alias("review_date"), pos.alias("pos"))


def _wide(t):
    """Histogram with some stars left without votes."""
    r = _reviews(t)
    gone = ((F.col("rating") == 1) & (F.col("product_id") % 4 == 0)) | ((F.col("rating") == 5) & (F.col("product_id") % 5 == 0))
    return op.star_counts(r.withColumn("rating", F.when(~gone, F.col("rating"))))


@query("agg1_star_histogram", f"""WITH {_REVIEWS_SQL} SELECT product_id, count(*) FILTER (WHERE rating = 1) AS star_1,
  count(*) FILTER (WHERE rating = 2) AS star_2, count(*) FILTER (WHERE rating = 3) AS star_3,
  count(*) FILTER (WHERE rating = 4) AS star_4, count(*) FILTER (WHERE rating = 5) AS star_5 FROM reviews GROUP BY 1""")
def _(t):
    return op.star_counts(_reviews(t))


_AVG = "CASE WHEN {c} > 0 THEN CAST((200 * {p} + {c}) // (2 * {c}) AS DOUBLE) / 100 END"
_LONG_SQL = f"""{_WIDE_SQL}, h AS (SELECT product_id, s.star, s.votes FROM wide,
  unnest([{{'star': 1, 'votes': star_1}}, {{'star': 2, 'votes': star_2}}, {{'star': 3, 'votes': star_3}}, {{'star': 4, 'votes': star_4}}, {{'star': 5, 'votes': star_5}}]) AS u(s)),
own AS (SELECT product_id, CAST(sum(votes) AS BIGINT) AS c, CAST(sum(votes * star) AS BIGINT) AS p, min(star) AS lo, max(star) AS hi FROM h GROUP BY 1)"""


@query("agg2_review_summary", f"""WITH {_LONG_SQL}, g AS (SELECT *, CASE product_id % 3 WHEN 0 THEN 0 WHEN 1 THEN product_id + 10 END AS gc,
  CASE product_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 4.25 END AS ga FROM own), k AS (SELECT *, coalesce(nullif(gc, 0), c) AS cc FROM g)
SELECT product_id, cc AS review_count, coalesce(CAST(nullif(ga, 0) AS DOUBLE), {_AVG.format(c='cc', p='p')}) AS average, lo AS min_star, hi AS max_star FROM k""")
def _(t):
    k = F.col("product_id")
    wide = _wide(t)
    given = wide.select(
        "product_id", F.when(k % 3 == 0, 0).when(k % 3 == 1, k + 10).cast("bigint").alias("given_count"),
        F.when(k % 5 == 0, 0).when(k % 5 == 1, F.lit("4.25").cast("decimal(12,2)")).cast("decimal(12,2)").alias("given_average"))
    return m.in_double(op.summary(op.star_rows(wide), given))


@query("udf2_review_summary_override", f"""WITH {_LONG_SQL}, x AS (SELECT product_id, count(*) FILTER (WHERE votes > 0) AS c FROM h GROUP BY 1),
a AS (SELECT product_id, CAST(max(votes) AS DOUBLE) AS top FROM h GROUP BY 1)
SELECT product_id, x.c AS review_count, top AS average, lo AS min_star, hi AS max_star FROM own JOIN x USING (product_id) JOIN a USING (product_id)""")
def _(t):
    return m.in_double(op.summary(op.star_rows(_wide(t)), count=lambda votes, star: F.count_if(votes > 0),
                                  average=lambda votes, star, count: F.max(votes).cast("decimal(20,0)")))


_STARS_TEXT = "'5:' || star_5 || ' 4:' || star_4 || ' 3:' || star_3 || ' 2:' || star_2 || ' 1:' || star_1"


def _stars_text(c):
    return F.array_join(F.transform(c, lambda r: F.concat_ws(":", r["star"].cast("string"), r["votes"].cast("string"))), " ")


@query("agg3_export_reviews", f"""WITH {_WIDE_SQL} SELECT product_id, star_1 + star_2 + star_3 + star_4 + star_5 AS review_count,
  least(CASE WHEN star_1 > 0 THEN 1 END, CASE WHEN star_2 > 0 THEN 2 END, CASE WHEN star_3 > 0 THEN 3 END, CASE WHEN star_4 > 0 THEN 4 END, CASE WHEN star_5 > 0 THEN 5 END) AS min_review,
  greatest(CASE WHEN star_1 > 0 THEN 1 END, CASE WHEN star_2 > 0 THEN 2 END, CASE WHEN star_3 > 0 THEN 3 END, CASE WHEN star_4 > 0 THEN 4 END, CASE WHEN star_5 > 0 THEN 5 END) AS max_review,
  CASE WHEN star_1 + star_2 + star_3 + star_4 + star_5 > 0 THEN {_STARS_TEXT} END AS reviews FROM wide""")
def _(t):
    return op.export_block(_wide(t)).withColumn("reviews", _stars_text(F.col("reviews")))


@query("srt2_stars_descending", f"WITH {_WIDE_SQL} SELECT product_id, {_STARS_TEXT} AS stars FROM wide")
def _(t):
    rows = F.array(*[F.struct(F.lit(s).alias("star"), F.col(f"star_{s}").alias("votes")) for s in op.STARS])
    return _wide(t).select("product_id", _stars_text(F.sort_array(rows, asc=False)).alias("stars"))


@query("agg4_last_review", f"""WITH {_REVIEWS_SQL} SELECT product_id, strftime(max(review_date), '%Y-%m-%d') AS newest,
  strftime(arg_min(review_date, pos), '%Y-%m-%d') AS first_listed FROM reviews GROUP BY 1""")
def _(t):
    day = lambda n: F.date_format(n, "yyyy-MM-dd").alias(n)
    return op.last_review(_reviews(t)).select("product_id", day("newest"), day("first_listed"))


def _vendor_feed(t):
    """Vendor payloads built from the histogram: layout by product id."""
    k = F.col("product_id")
    base = _wide(t).join(_reviews(t).groupBy("product_id").agg(F.max("review_date").alias("last")), "product_id")
    stars = [F.col(f"star_{s}") for s in op.STARS]
    total = sum(stars[1:], stars[0])
    pair = lambda s: F.struct(F.lit(s).alias("RatingValue"), F.col(f"star_{s}").alias("Count"))
    stats = F.struct(
        F.array(*[pair(s) for s in (5, 4, 3, 2, 1)]).alias("RatingDistribution"), total.alias("TotalReviewCount"),
        F.lit(4.5).alias("AverageOverallRating"),
        F.concat(F.date_format("last", "yyyy-MM-dd"), F.lit("T10:00:00.000+00:00")).alias("LastSubmissionTime"))
    distribution = F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(stats.alias("ReviewStatistics"))).alias("Results")).alias("q0")).alias("BatchedResults")))
    bars = F.when(k % 4 == 3, F.array(*reversed(stars))).otherwise(F.array(*stars))
    roll = F.struct(bars.alias("rating_histogram"), (total + 1).alias("review_count"), F.lit(3.5).alias("average_rating"))
    metrics = F.when(k % 2 == 0, F.struct(F.lit(None).cast("array<bigint>").alias("rating_histogram"), F.lit(0).cast("bigint").alias("review_count"),
                                          F.lit(2.5).alias("average_rating")))
    histogram = F.to_json(F.struct(F.array(F.struct(roll.alias("rollup"), metrics.alias("metrics"))).alias("results")))
    cells = F.concat(
        F.lit('<div class="TTreviewCount">'), F.format_number(total, 0), F.lit(' Reviews</div><span id="TTreviewSummaryAverageRating">4.1 of 5</span>'),
        *[F.concat(F.lit(f'<div id="TTreviewSummaryBreakdown-{s}">'), F.col(f"star_{s}").cast("string"), F.lit("</div>")) for s in op.STARS])
    vendor = F.when(k % 3 == 0, "distribution").when((k % 3 == 1) & (k % 4 == 3), "histogram_descending").when(k % 3 == 1, "histogram").otherwise("cells")
    payload = F.when(k % 3 == 0, distribution).when(k % 3 == 1, histogram).otherwise(cells)
    return base.select("product_id", vendor.alias("vendor"), payload.alias("payload"))


@query("agg5_vendor_feeds", f"""WITH {_WIDE_SQL}, l AS (SELECT product_id, max(review_date) AS d FROM reviews GROUP BY 1),
b AS (SELECT *, star_1 + star_2 + star_3 + star_4 + star_5 AS n FROM wide JOIN l USING (product_id))
SELECT product_id, star_1, star_2, star_3, star_4, star_5,
  CASE WHEN product_id % 3 = 1 AND product_id % 2 = 1 THEN n + 1 ELSE n END AS review_count,
  CASE product_id % 3 WHEN 0 THEN 4.5::DOUBLE WHEN 1 THEN CASE WHEN product_id % 2 = 0 THEN 2.5 ELSE 3.5 END ELSE 4.1 END AS average,
  CASE WHEN product_id % 3 = 0 THEN strftime(d, '%Y-%m-%d') END AS last_review_date
FROM b WHERE product_id % 3 <> 2 OR n > 0""")
def _(t):
    return op.unified_feed(_vendor_feed(t)).withColumn("last_review_date", F.date_format("last_review_date", "yyyy-MM-dd"))


@query("jn22_review_feed_choice", """WITH c AS (SELECT l_orderkey AS product_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS priority,
  max(CASE WHEN l_quantity > 15 THEN CAST(l_shipdate AS DATE) END) AS d, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY d IS NULL, priority) AS rn FROM c)
SELECT product_id, priority, strftime(d, '%Y-%m-%d') AS last_review_date, n AS review_count FROM r WHERE rn = 1""")
def _(t):
    priority = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    candidates = t.lineitem.groupBy(F.col("l_orderkey").alias("product_id"), priority.alias("priority")).agg(
        F.max(F.when(F.col("l_quantity") > 15, F.col("l_shipdate").cast("date"))).alias("last_review_date"), F.count("*").alias("review_count"))
    return op.choose_feed(candidates).withColumn("last_review_date", F.date_format("last_review_date", "yyyy-MM-dd"))
