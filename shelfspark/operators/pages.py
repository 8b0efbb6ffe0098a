"""Facts read from page markup with regular expressions, one scan per job.

Pages: page_id, url, html. Broken markup is normal here, so no XML reader is used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import codes, flags
from shelfspark.functions.select import truthy
from shelfspark.functions.text import collapse_spaces, unescape

_QUOTED = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside one tag's text, null when missing."""
    raw = F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*{_QUOTED}", 1)
    return F.when(raw != "", unescape(F.regexp_replace(raw, r"""^["']|["']$""", "")))


def tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)(<{name}\b[^>]*>)"), F.lit(1))


def _first(found: Column, keep: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    return value(F.get(F.filter(found, keep), F.lit(0)))


def meta_table(pages: DataFrame) -> DataFrame:
    """charset, canonical url, title, keywords, description and the list of meta tags (PAG1)."""
    df = pages.withColumns({"_meta": tags(F.col("html"), "meta"), "_link": tags(F.col("html"), "link")})
    meta = F.col("_meta")
    named = lambda n: _first(meta, lambda m: F.lower(attribute(m, "name")) == n, lambda m: attribute(m, "content"))
    return df.select(
        "page_id",
        _first(meta, lambda m: attribute(m, "charset").isNotNull(), lambda m: attribute(m, "charset")).alias("charset"),
        _first(F.col("_link"), lambda l: F.lower(attribute(l, "rel")) == "canonical", lambda l: attribute(l, "href")).alias("canonical_url"),
        truthy(unescape(F.regexp_extract("html", r"(?is)<title[^>]*>([^<]*)", 1)), "string").alias("browser_title"),
        named("keywords").alias("keywords"),
        named("description").alias("description"),
        F.transform(meta, collapse_spaces).alias("meta_tags"),
    )


def heading_rows(pages: DataFrame, levels: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Text nodes of headings with level and position (PAG2)."""
    blocks = lambda n: F.regexp_extract_all("html", F.lit(rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>"), F.lit(1))
    nodes = lambda n: F.filter(F.flatten(F.transform(blocks(n), lambda b: F.split(b, r"<[^>]*>"))), lambda s: s != "")
    found = F.array(*[F.struct(F.lit(n).alias("level"), nodes(n).alias("nodes")) for n in levels])
    rows = pages.select("page_id", F.inline(found))
    return rows.select("page_id", "level", F.posexplode("nodes").alias("pos", "raw")).select("page_id", "level", "pos", unescape(F.col("raw")).alias("text"))


def heading_arrays(pages: DataFrame) -> DataFrame:
    """h1 and h2 text lists per page (PAG2)."""
    nodes = lambda n: F.filter(F.flatten(F.transform(
        F.regexp_extract_all("html", F.lit(rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>"), F.lit(1)), lambda b: F.split(b, r"<[^>]*>"))), lambda s: s != "")
    return pages.select("page_id", nodes(1).alias("h1"), nodes(2).alias("h2"))


_PAIR = rf"""\s([\w:-]+\s*=\s*{_QUOTED})"""


def _pair_value(pair: Column) -> Column:
    return unescape(F.regexp_replace(F.regexp_replace(pair, r"^[\w:-]+\s*=\s*", ""), r"""^["']|["']$""", ""))


def attribute_values(tag: Column) -> Column:
    """Values of all attributes of one tag, in order."""
    return F.transform(F.regexp_extract_all(tag, F.lit(_PAIR), F.lit(1)), _pair_value)


def meta_attributes(pages: DataFrame) -> DataFrame:
    """Every attribute of every meta tag in page order (PAG3)."""
    rows = pages.select("page_id", F.posexplode(tags(F.col("html"), "meta")).alias("tag_no", "tag"))
    pairs = F.regexp_extract_all("tag", F.lit(_PAIR), F.lit(1))
    rows = rows.select("page_id", "tag_no", F.posexplode(pairs).alias("pos", "pair"))
    name = F.lower(F.regexp_extract("pair", r"^([\w:-]+)", 1))
    return rows.select("page_id", "tag_no", "pos", name.alias("name"), _pair_value(F.col("pair")).alias("value"))


def meta_model(pages: DataFrame) -> DataFrame:
    """First non-empty content of a meta tag with itemprop "model" (PAG3)."""
    found = F.filter(tags(F.col("html"), "meta"), lambda m: (attribute(m, "itemprop") == "model") & (attribute(m, "content") != ""))
    return pages.select("page_id", attribute(F.get(found, F.lit(0)), "content").alias("model_meta"))


def inline_json(html: Column, assigned_to: str) -> Column:
    """VARIANT of the object assigned to a script variable; null when missing or broken (PAG4)."""
    text = F.regexp_extract(html, rf"(?s){assigned_to}\s*=\s*(\{{.+?\}})\s*;\s*</script>", 1)
    return F.try_parse_json(truthy(text, "string"))


def json_ld(html: Column) -> Column:
    """VARIANT of the first JSON-LD script (PAG4)."""
    text = F.regexp_extract(html, r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)
    return F.try_parse_json(truthy(text, "string"))


@dataclass(frozen=True)
class Candidate:
    """One way to read one field on one site; a lower priority is tried first."""

    site: str
    field: str
    method: str
    expr: str
    priority: int = 0


def _attribute_candidate(html: Column, expr: str) -> Column:
    tag, name = expr.split("@")
    return attribute(F.get(tags(html, tag), F.lit(0)), name)


METHODS: dict[str, Callable[[Column, str], Column]] = {
    "regex": lambda html, expr: truthy(F.regexp_extract(html, expr, 1), "string"),
    "attribute": _attribute_candidate,
    "json_ld": lambda html, expr: F.try_variant_get(F.col("_ld"), expr, "string"),
    "constant": lambda html, expr: F.lit(expr),
}

DEFAULT_SITE = "*"


#: Columns of a profile table, one row per candidate.
PROFILE_SCHEMA = "site string, field string, method string, expr string, priority int"
#: A profile table is read whole by the driver, which compiles it; a larger one is refused.
MOST_CANDIDATES = 100_000


def read_profiles(profiles: DataFrame) -> list[Candidate]:
    """Candidates of a profile table (``PROFILE_SCHEMA``), checked."""
    rows = profiles.select("site", "field", "method", "expr", F.coalesce("priority", F.lit(0)).alias("priority")).limit(MOST_CANDIDATES + 1).collect()
    if len(rows) > MOST_CANDIDATES:
        raise ValueError(f"a profile table has at most {MOST_CANDIDATES} rows")
    unknown = sorted({str(r.method) for r in rows} - METHODS.keys())
    if unknown or any(v is None for r in rows for v in r):
        raise ValueError(f"profile rows need a site, a field, an expression and a known method; unknown: {unknown}")
    return [Candidate(*r) for r in rows]


Chain = tuple[tuple[str, str], ...]


def _families(candidates: list[Candidate]) -> dict[tuple[tuple[str, Chain], ...], list[str]]:
    """Sites with the same chain for every field, by these chains. The default's chains fill in for fields a site does not name."""
    chains: dict[str, dict[str, list]] = {}
    for c in sorted(candidates, key=lambda c: (c.priority, c.method, c.expr)):
        chains.setdefault(c.site, {}).setdefault(c.field, []).append((c.method, c.expr))
    shared = chains.get(DEFAULT_SITE, {})
    families: dict[tuple, list[str]] = {}
    for site in sorted(chains, key=lambda s: (s != DEFAULT_SITE, s)):
        whole = tuple(sorted((f, tuple(chain)) for f, chain in (shared | chains[site]).items()))
        families.setdefault(whole, []).append(site)
    return families


def _family_of(families: list[list[str]]) -> Column:
    """Number of the family that a row's site belongs to, that of ``DEFAULT_SITE`` for all others, -1 without one."""
    of = {site: i for i, sites in enumerate(families) for site in sites if site != DEFAULT_SITE}
    rest = F.lit(next((i for i, sites in enumerate(families) if DEFAULT_SITE in sites), -1))
    return F.coalesce(F.create_map(*[F.lit(x) for pair in of.items() for x in pair])[F.col("site")], rest) if of else rest


def _slot(method: str, exprs: dict[int, str], n: int) -> Column:
    """What ``method`` reads for rows of the families ``exprs`` names, each with its own expression; null for all others.

    Patterns and constants are looked up in an array by family, so that the compiled code does not grow with the number of
    sites; a pattern is made ready when a row's differs from that of the row before, so pages stored by site cost nothing.
    """
    family, html = F.col("_family"), F.col("html")
    if len(set(exprs.values())) > 1 and method in ("regex", "constant"):
        own = F.get(F.array(*[F.lit(exprs.get(i)).cast("string") for i in range(n)]), family)
        return own if method == "constant" else truthy(F.call_function("regexp_extract", html, own, F.lit(1)), "string")
    column = F.when(F.lit(False), F.lit(None).cast("string"))
    for expr in dict.fromkeys(exprs.values()):
        where = [i for i, e in exprs.items() if e == expr]
        column = column.when(family.isin(where), METHODS[method](html, expr).cast("string"))
    return column


def extract_fields(pages: DataFrame, profiles: list[Candidate] | DataFrame) -> DataFrame:
    """Profile-driven fields, one scan for all sites (PAG5). ``profiles``: candidates, or a table of them (``PROFILE_SCHEMA``).

    The first non-null candidate of a field wins, by priority. Sites with the same candidates throughout are one family, looked up
    once per row. Fields a site does not name, and sites without a profile, use the chains of ``DEFAULT_SITE``.
    """
    candidates = read_profiles(profiles) if isinstance(profiles, DataFrame) else profiles
    rows = pages.withColumn("site", codes.domain(F.col("url")))
    if any(c.method == "json_ld" for c in candidates):
        # Parsed once per page, however many candidates look into it.
        rows = rows.withColumn("_ld", json_ld(F.col("html")))
    families = _families(candidates)
    columns = []
    for field in sorted({c.field for c in candidates}):
        chains = {i: dict(whole).get(field, ()) for i, whole in enumerate(families)}
        slots = []
        for place in range(max(map(len, chains.values()))):
            tried = {i: chain[place] for i, chain in chains.items() if len(chain) > place}
            for method in dict.fromkeys(m for m, _ in tried.values()):
                slots.append(_slot(method, {i: e for i, (m, e) in tried.items() if m == method}, len(families)))
        columns.append(F.coalesce(*slots).alias(field))
    family = _family_of(list(families.values()))
    return rows.withColumn("_family", family).select("page_id", "site", *columns)


#: Columns that a site reads from ``page_id``, ``url``, ``html`` and ``site``.
SiteHook = Callable[[], dict[str, Column]]


def apply_site_hooks(pages: DataFrame, hooks: dict[str, SiteHook], default: SiteHook | None = None) -> DataFrame:
    """Each site's own columns on its pages (UDF3), all hooks in one pass over the pages where they are.

    Columns that a site's hook does not give are null; columns of one name need one type. Sites with the same hook share a branch.
    ``default`` gives the columns of all other sites; without it their pages are left out.
    """
    rows = pages.withColumn("site", codes.domain(F.col("url")))
    if default is None:
        rows = rows.where(F.col("site").isin(*hooks))
    families: dict[SiteHook, list[str]] = {}
    for site, hook in [*hooks.items(), *([(DEFAULT_SITE, default)] if default is not None else [])]:
        families.setdefault(hook, []).append(site)
    values = [hook() for hook in families]
    columns = []
    for name in dict.fromkeys(n for v in values for n in v):
        column = F.when(F.lit(False), F.lit(None))
        for i, own in enumerate(values):
            if name in own:
                column = column.when(F.col("_family") == i, own[name])
        columns.append(column.alias(name))
    return rows.withColumn("_family", _family_of(list(families.values()))).select("page_id", "site", *columns)


def listing_links(pages: DataFrame) -> DataFrame:
    """Absolute link urls with their position on the page (PAG6)."""
    rows = pages.select("page_id", "url", F.posexplode(tags(F.col("html"), "a")).alias("pos", "tag"))
    rows = rows.withColumn("href", attribute(F.col("tag"), "href")).where("href IS NOT NULL")
    return rows.select("page_id", "pos", codes.absolute_url(F.col("url"), F.col("href")).alias("link"))


# Markup that shows rich content sections.
_SECTION_360 = r'<div[^>]*\bdata-section-tag="360-view"'
_SECTION_EMC = r'<div[^>]*\bclass="[^"]*wc-responsive'
_WC_IMAGE = r'<img[^>]*\bclass="[^"]*wc-image[^"]*"[^>]*\bsrc="'
_WC_THUMB = r'(?s)<div[^>]*\bclass="[^"]*wc-gallery-thumb[^"]*"[^>]*>\s*<img[^>]*\bwcobj="'
_WC_PDF = r'<img[^>]*\bwcobj-type="application/pdf"'
_WC_TOUR = r'(?s)<div[^>]*\bclass="wc-json-data"[^>]*>[^<]*"tourViews"\s*:\s*(?:\[\s*[^\]\s]|\{\s*[^}\s]|"[^"]|[1-9t])'
_WC_VIDEO = r'<div[^>]*\bitemprop="video"[^>]*>\s*<meta[^>]*\bitemprop="contentUrl"[^>]*\bcontent="'


def rich_content(pages: DataFrame, marker_words: tuple[str, ...] = ("richcontext",)) -> DataFrame:
    """Rich-content flags and counts (PAG7). ``marker_words`` are texts that prove a rich block."""
    html = F.col("html")
    n = lambda pattern: F.regexp_count(html, F.lit(pattern))
    return pages.select(
        "page_id",
        html.rlike(_SECTION_360).alias("wc_360"), html.rlike(_SECTION_EMC).alias("wc_emc"), html.rlike(_WC_PDF).alias("wc_pdf"),
        html.rlike(_WC_TOUR).alias("wc_prodtour"), html.rlike(_WC_VIDEO).alias("wc_video"),
        (n(_WC_IMAGE) + n(_WC_THUMB)).alias("images_count"), n(_WC_PDF).alias("pdfs_count"), n(_WC_VIDEO).alias("videos_count"),
        F.coalesce(*[F.when(html.contains(w), True) for w in marker_words], F.lit(False)).alias("rich_content"),
    )


def rich_content_flag(rows: DataFrame) -> DataFrame:
    """1 when any of the five flags or three counts is set (AGG12)."""
    any_flag = F.greatest("wc_360", "wc_emc", "wc_pdf", "wc_prodtour", "wc_video")
    any_count = F.greatest("images_count", "pdfs_count", "videos_count") > 0
    return rows.select("page_id", (F.coalesce(any_flag, F.lit(False)) | F.coalesce(any_count, F.lit(False))).cast("int").alias("webcollage"))


def media_lists(pages: DataFrame) -> DataFrame:
    """Distinct pdf, video and image urls in page order, as absolute urls (PAG8)."""
    sources = lambda tag, attr, pattern: F.array_distinct(F.transform(
        F.filter(F.transform(tags(F.col("html"), tag), lambda x: attribute(x, attr)), lambda u: u.rlike(pattern)),
        lambda u: codes.absolute_url(F.col("url"), u)))
    return pages.select(
        "page_id", sources("a", "href", r"\.pdf").alias("pdf_urls"),
        F.array_union(sources("(?:video|source)", "src", "."), sources("a", "href", r"\.(?:mp4|webm)(?:\?|$)")).alias("video_urls"),
        sources("img", "src", ".").alias("image_urls"))


def technical_columns(responses: DataFrame, sites: DataFrame, crawled_at: Column) -> DataFrame:
    """Crawl time, redirect flag, status, url, site and product id (PRJ5).

    ``responses``: page_id, url, status, message_site, message_product_id, spider.
    ``sites``: spider, allowed_domain (the first one).
    """
    rows = responses.join(sites, "spider", "left")
    return rows.select(
        "page_id", crawled_at.alias("crawled_at"), (F.col("status") == 302).alias("redirected"), F.col("status").alias("response_code"), "url",
        F.when(F.col("allowed_domain").isNotNull(), F.coalesce(truthy(F.col("message_site"), "string"), F.col("allowed_domain"))).alias("site"),
        F.col("message_product_id").alias("product_id"))


def valid_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Url validity by the site's regular expression (FIL3). ``rules``: site, pattern."""
    rows = pages.withColumn("site", codes.domain(F.col("url"))).join(rules, "site", "left")
    return rows.select("page_id", "site", F.coalesce(codes.is_valid_url(F.col("url"), F.col("pattern")), F.lit(False)).alias("valid_url"))


def routed_responses(responses: DataFrame, missing_status: tuple[int, ...] = (404,)) -> DataFrame:
    """Route of every response (FIL5). ``responses``: page_id, url_ok, first_url, final_url, status, has_payload."""
    redirected = codes.is_redirect(F.col("first_url"), F.col("final_url"))
    return responses.withColumn("route", flags.response_route(F.col("url_ok"), redirected, F.col("status"), F.col("has_payload"), missing_status))


def completeness(pages: DataFrame) -> DataFrame:
    """Content counts and text lengths (AGG11).

    Takes the arrays image_urls, image_alts, video_urls, pdf_urls, features, ingredients,
    meta_tags and the texts title, short_description, long_description, shelf_description,
    meta_description; missing ones count 0.
    """
    size = lambda n: F.coalesce(F.size(n), F.lit(0))
    length = lambda n: F.coalesce(F.length(n), F.lit(0))
    lists = {"image": "image_urls", "video": "video_urls", "pdf": "pdf_urls", "feature": "features", "ingredient": "ingredients", "meta_tags": "meta_tags"}
    texts = {"title_len": "title", "description_len": "short_description", "long_description_len": "long_description",
             "shelf_description_len": "shelf_description", "meta_description_count": "meta_description"}
    return pages.select(
        "page_id", *[F.greatest(size(c), F.lit(0)).alias(f"{n}_count") for n, c in lists.items()], *[length(c).alias(n) for n, c in texts.items()],
        F.transform("image_alts", lambda a: F.coalesce(F.length(a), F.lit(0))).alias("image_alt_text_len"))
