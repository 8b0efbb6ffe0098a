"""Review histograms, summaries and vendor feeds.

Reviews: product_id, rating, review_date, pos. Histogram rows: product_id, star, votes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.dates import any_date
from shelfspark.functions.select import truthy
from shelfspark.operators.groups import first_by, where_once

STARS = (1, 2, 3, 4, 5)
KEY = ["product_id"]


def star_counts(reviews: DataFrame) -> DataFrame:
    """One row per product with zero-filled star_1 .. star_5 (AGG1)."""
    return reviews.groupBy(*KEY).agg(*[F.count_if(F.col("rating") == s).alias(f"star_{s}") for s in STARS])


def star_rows(wide: DataFrame) -> DataFrame:
    """Wide histogram back to one row per product and star."""
    cells = F.array(*[F.struct(F.lit(s).alias("star"), F.col(f"star_{s}").alias("votes")) for s in STARS])
    return wide.select("product_id", F.inline(cells))


def vote_count(votes: Column, star: Column) -> Column:
    return F.sum(votes)


def vote_average(votes: Column, star: Column, count: Column) -> Column:
    """Σ star·votes / count; null without votes."""
    total = F.sum(star * votes).cast("decimal(20,0)")
    return F.try_divide(total, count.cast("decimal(20,0)"))


def summary(histogram: DataFrame, given: DataFrame | None = None,
            count: Callable[..., Column] = vote_count, average: Callable[..., Column] = vote_average) -> DataFrame:
    """Count, average to two places and key range (AGG2); given values win when not zero.

    ``count`` and ``average`` may be replaced by other aggregate expressions.
    """
    votes, star = F.col("votes"), F.col("star")
    own = histogram.groupBy(*KEY).agg(
        count(votes, star).alias("_count"),
        F.round(average(votes, star, count(votes, star)), 2).cast("decimal(12,2)").alias("_average"),
        F.sum(star * votes).cast("decimal(20,0)").alias("_points"),
        F.min("star").alias("min_star"),
        F.max("star").alias("max_star"),
    )
    if given is None:
        return own.select("product_id", F.col("_count").alias("review_count"), F.col("_average").alias("average"), "min_star", "max_star")
    rows = own.join(given.select("product_id", "given_count", "given_average"), KEY, "left")
    total = F.coalesce(truthy(F.col("given_count"), "number"), F.col("_count"))
    computed = F.when(F.col("given_count") != 0, F.round(F.try_divide("_points", total.cast("decimal(20,0)")), 2)).otherwise(F.col("_average"))
    return rows.select(
        "product_id", total.alias("review_count"),
        F.coalesce(F.round(truthy(F.col("given_average"), "number"), 2), computed).cast("decimal(12,2)").alias("average"),
        "min_star", "max_star")


def export_block(wide: DataFrame) -> DataFrame:
    """Voted range and the star list, best star first, null without votes (AGG3, SRT2)."""
    votes = {s: F.col(f"star_{s}") for s in STARS}
    total = sum(votes.values())
    voted = [F.when(v > 0, s) for s, v in votes.items()]
    listed = F.array(*[F.struct(F.lit(s).alias("star"), votes[s].alias("votes")) for s in sorted(STARS, reverse=True)])
    return wide.select(
        "product_id", total.alias("review_count"), F.least(*voted).alias("min_review"), F.greatest(*voted).alias("max_review"),
        F.when(total > 0, listed).alias("reviews"))


def last_review(reviews: DataFrame) -> DataFrame:
    """Newest date and first listed date (AGG4)."""
    return reviews.groupBy(*KEY).agg(
        F.max("review_date").alias("newest"), first_by(F.col("review_date"), F.col("pos")).alias("first_listed"))


def choose_feed(candidates: DataFrame) -> DataFrame:
    """Best review feed per product (JN22): first by priority with a last date, else first by priority.

    ``candidates``: product_id, priority, last_review_date, review_count.
    """
    order = F.col("priority") + F.when(F.col("last_review_date").isNull(), 1000).otherwise(0)
    pick = lambda name: F.min_by(F.col(name), order)
    return candidates.groupBy(*KEY).agg(*[pick(n).alias(n) for n in ("priority", "last_review_date", "review_count")])


# ---- vendor feeds ---------------------------------------------------------

# Keys and markup of the vendors' payloads, here and in the readers below.
_STATS = "struct<RatingDistribution:array<struct<RatingValue:int,Count:bigint>>,TotalReviewCount:bigint,AverageOverallRating:double,LastSubmissionTime:string>"
_DISTRIBUTION = f"BatchedResults struct<q0:struct<Results:array<struct<ReviewStatistics:{_STATS}>>>>"
_ROLL = "struct<rating_histogram:array<bigint>,review_count:bigint,average_rating:double>"
_HISTOGRAM = f"results array<struct<rollup:{_ROLL},metrics:{_ROLL}>>"


def _unified(stars: list[Column], count: Column, average: Column, last: Column, readable: Column) -> Column:
    """One histogram struct; null when the payload holds no reviews."""
    filled = [F.coalesce(c, F.lit(0)).cast("bigint") for c in stars]
    return F.when(readable, F.struct(
        *[c.alias(f"star_{s}") for s, c in zip(STARS, filled)],
        F.coalesce(truthy(count, "number"), sum(filled[1:], filled[0])).alias("review_count"),
        truthy(average, "number").alias("average"), last.alias("last_review_date")))


def _read_distribution(stats: Column) -> Column:
    pairs = stats["RatingDistribution"]

    def votes_of(star: int) -> Column:
        # The last pair of a star counts, as in a keyed assignment.
        return F.try_element_at(F.filter(pairs, lambda p: p["RatingValue"] == star), F.lit(-1))["Count"]

    last = any_date(F.substring(stats["LastSubmissionTime"], 1, 10), "yyyy-MM-dd")
    return _unified([votes_of(s) for s in STARS], stats["TotalReviewCount"], stats["AverageOverallRating"], last, stats.isNotNull())


def _read_histogram(first: Column, descending: bool = False) -> Column:
    bars = first["rollup"]["rating_histogram"]
    votes = [F.get(bars, F.lit(5 - s if descending else s - 1)) for s in STARS]
    # The rollup stands in for missing metrics.
    metrics = F.coalesce(first["metrics"], first["rollup"])
    return _unified(votes, metrics["review_count"], metrics["average_rating"], F.lit(None).cast("date"), first.isNotNull())


def _read_cells(payload: Column) -> Column:
    cell = lambda pattern: F.regexp_extract(payload, pattern, 1)
    votes = [cell(rf'<div id="TTreviewSummaryBreakdown-{s}"[^>]*>\s*(\d+)').try_cast("bigint") for s in STARS]
    count = F.replace(cell(r'<div class="TTreviewCount"[^>]*>[^<\d]*([\d,]+)'), F.lit(","), F.lit("")).try_cast("bigint")
    average = cell(r'<span id="TTreviewSummaryAverageRating"[^>]*>.*?(\d\.\d)').try_cast("double")
    # Both count and average must be shown.
    return _unified(votes, count, average, F.lit(None).cast("date"), (count != 0) & average.isNotNull())


@dataclass(frozen=True)
class Layout:
    """``parse`` runs once per payload; ``read`` makes the histogram struct from its result."""

    parse: Callable[[Column], Column]
    read: Callable[[Column], Column]


def _parse_histogram(payload: Column) -> Column:
    return F.get(F.from_json(payload, _HISTOGRAM)["results"], F.lit(0))


VENDOR_LAYOUTS: dict[str, Layout] = {
    # A list of (rating, count) pairs.
    "distribution": Layout(
        lambda payload: F.get(F.from_json(payload, _DISTRIBUTION)["BatchedResults"]["q0"]["Results"], F.lit(0))["ReviewStatistics"], _read_distribution),
    # Votes by star, worst star first, with metrics; and the same with the best star first.
    "histogram": Layout(_parse_histogram, _read_histogram),
    "histogram_descending": Layout(_parse_histogram, lambda first: _read_histogram(first, descending=True)),
    # One markup cell per star.
    "cells": Layout(lambda payload: payload, _read_cells),
}


def unified_feed(feed: DataFrame, layouts: dict[str, Layout] = VENDOR_LAYOUTS) -> DataFrame:
    """All vendor layouts as one histogram table in one scan (AGG5). ``feed``: product_id, vendor, payload."""
    mine = lambda name: F.col("vendor") == name
    parsed = feed.select("product_id", "vendor", *[F.when(mine(n), x.parse(F.col("payload"))).alias(f"_{n}") for n, x in layouts.items()])
    read = F.when(F.lit(False), None)
    for name, layout in layouts.items():
        read = read.when(mine(name), layout.read(F.col(f"_{name}")))
    rows = parsed.select("product_id", read.alias("_r"))
    return where_once(rows, F.col("_r").isNotNull()).select("product_id", "_r.*")
