"""Search and shelf ranking, hit flags and page frontiers.

Hits: term, page, pos and payload columns; ``page`` counts from 0 or 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.groups import with_prefix

DEFAULT_QUANTITY = 100
DEFAULT_PAGES = 1


def page_counts(hits: DataFrame) -> DataFrame:
    """Hits per page, with the hits of the earlier pages of the term in ``before``."""
    counts = hits.groupBy("term", "page").agg(F.count("*").alias("results_per_page"))
    return with_prefix(counts, ["term"], "page", "results_per_page", "before")


def unplaced_hits(hits: DataFrame) -> DataFrame:
    """Hits without term or page: they cannot be ranked and are handed back as rejects."""
    return hits.where(F.col("term").isNull() | F.col("page").isNull())


def with_page_facts(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """What the result pages say of themselves (WIN3). ``pages``: term, page, total_matches, scraped_results_per_page.

    The number a page claims to list, ``scraped_results_per_page``, stands next to ``results_per_page``, the number of hits found on it.
    """
    return hits.join(pages.select("term", "page", "total_matches", "scraped_results_per_page"), ["term", "page"], "left")


def placed_hits(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("term").isNotNull() & F.col("page").isNotNull())


def ranked_hits(hits: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Ranking across pages: hits on earlier pages plus the place on the own page (WIN1, WIN3); see ``unplaced_hits`` for the rest.

    ``pages``: the ``page_counts`` of the pages wanted, default all; hits of other pages are left out before they are sorted.
    """
    hits = placed_hits(hits)
    on_page = Window.partitionBy("term", "page").orderBy("pos")
    return (
        hits.join(page_counts(hits) if pages is None else pages, ["term", "page"])
        .withColumn("_at", F.row_number().over(on_page))
        .withColumn("ranking", F.col("before") + F.col("_at"))
        .drop("_at", "before")
    )


def search_results(hits: DataFrame, quantities: DataFrame | None = None, quantity: int = DEFAULT_QUANTITY) -> DataFrame:
    """The first ``quantity`` hits of each term (SRT1); ``quantities`` (term, quantity) overrides per term."""
    pages = page_counts(placed_hits(hits))
    if quantities is None:
        pages = pages.withColumn("_q", F.lit(quantity))
    else:
        wanted = quantities.select("term", F.col("quantity").alias("_q"))
        pages = pages.join(wanted, "term", "left").withColumn("_q", F.coalesce(F.nullif("_q", F.lit(0)), F.lit(quantity)))
    # Pages that start beyond the limit hold no result; there are few pages and many hits.
    return ranked_hits(hits, pages.where(F.col("before") < F.col("_q"))).where(F.col("ranking") <= F.col("_q")).drop("_q")


def shelf_results(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """Shelf hits up to the size of the first page times the number of pages (WIN2).

    ``pages``: term, quantity, pages_count; both may be null.
    """
    counts = hits.groupBy("term", "page").agg(F.count("*").alias("_n"))
    first = counts.groupBy("term").agg(F.min_by("_n", "page").alias("_first"))
    limit = F.coalesce(F.nullif("quantity", F.lit(0)), F.col("_first") * F.coalesce(F.nullif("pages_count", F.lit(0)), F.lit(DEFAULT_PAGES)))
    limits = first.join(pages, "term", "left").select("term", limit.alias("_limit"))
    pages_within = page_counts(placed_hits(hits)).join(limits, "term").where(F.col("before") < F.col("_limit"))
    return ranked_hits(hits, pages_within).where(F.col("ranking") <= F.col("_limit")).drop("_limit")


def with_hit_columns(products: DataFrame, hits: DataFrame, columns: list[str]) -> DataFrame:
    """Values the hit already carries win; the product page fills the rest (JN11)."""
    filled = hits.select("url", *[F.col(c).alias(f"_{c}") for c in columns])
    rows = products.join(filled, "url", "left")
    rows = rows.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) if c in products.columns else F.col(f"_{c}") for c in columns})
    return rows.drop(*[f"_{c}" for c in columns])


def hit_flags(hits: DataFrame, featured: DataFrame) -> DataFrame:
    """Sponsored, featured and badge flags (JN12). ``featured``: term, featured_id.

    A hit without id on a term without featured id counts as featured.
    """
    rows = hits.join(featured, "term", "left")
    return rows.withColumns({
        "is_sponsored": F.coalesce(F.col("ad") != "", F.lit(False)),
        "is_featured": F.col("featured_id").eqNullSafe(F.col("hit_id")),
        "is_best_seller": F.when(F.col("badge") == "bestseller", True),
        "is_new": F.when(F.col("badge") == "new", True),
    }).drop("featured_id")


def direct_landings(terms: DataFrame, hits: DataFrame, product_url: str) -> DataFrame:
    """Terms without hits that landed on a product page (FIL13). ``terms``: term, url."""
    alone = terms.join(hits.select("term").distinct(), "term", "left_anti").where(F.col("url").rlike(product_url))
    return alone.withColumns({"redirect": F.lit(True), "total_matches": F.lit(1).cast("bigint")})


def page_frontier(totals: DataFrame, size: int) -> DataFrame:
    """Pages still to read after the first. ``totals``: key, total (SRT7)."""
    last = F.ceil(F.col("total") / size).cast("bigint")
    more = totals.where(last >= 2)
    return more.select("key", F.explode(F.sequence(F.lit(2).cast("bigint"), last)).alias("page"))


def offset_frontier(totals: DataFrame, seen: int, size: int) -> DataFrame:
    """Offsets after the ``seen`` rows of the first response, ``size`` at a time (SRT7)."""
    steps = F.ceil((F.col("total") - seen) / size).cast("bigint")
    more = totals.where(F.col("total") > seen)
    return more.select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), steps - 1)).alias("_i")).select(
        "key", (F.col("_i") * size + seen).alias("offset"))


def merged_topics(topics: DataFrame) -> DataFrame:
    """Items of all topics of a mixed shelf in topic order (SET1). ``topics``: shelf, topic, items."""
    return topics.select("shelf", "topic", F.posexplode("items").alias("pos", "item"))
