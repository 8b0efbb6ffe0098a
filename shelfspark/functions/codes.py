"""Identifiers in codes and urls, and the request fingerprint (FN9-FN11, FN23, FIL3, FIL4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(code: Column, width: int) -> Column:
    """Left-pad with zeros; unlike ``lpad`` it never shortens."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def gtin14(code: Column) -> Column:
    return F.when(code.rlike(r"^\d+$"), zero_pad(code, 14))


def upc12(gtin: Column) -> Column:
    bare = F.regexp_replace(gtin, "^0+", "")
    return zero_pad(F.right(bare, F.lit(12)), 12)


def last_segment(url: Column) -> Column:
    return F.try_element_at(F.split(F.substring_index(url, "?", 1), "/"), F.lit(-1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def path_leaf(url: Column) -> Column:
    return F.try_element_at(F.split(url_path(url), "/"), F.lit(-1))


def product_id(url: Column) -> Column:
    """Last run of 3 to 20 digits that starts a path part, else the last segment."""
    ids = F.regexp_extract_all(url, F.lit(r"/([0-9]{3,20})"), F.lit(1))
    return F.coalesce(F.try_element_at(ids, F.lit(-1)), last_segment(url))


def id_by_pattern(url: Column, pattern: str) -> Column:
    """Site rule: first group of ``pattern``, null without a match."""
    return F.when(url.rlike(pattern), F.regexp_extract(url, pattern, 1))


def https(url: Column) -> Column:
    return F.regexp_replace(url, "^http://", "https://")


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def domain(url: Column) -> Column:
    return F.replace(host(url), F.lit("www."), F.lit(""))


def query_values(url: Column) -> Column:
    """map<key, array<value>> of the query string; blank values are dropped."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+"))
    plain = lambda c: F.try_url_decode(c)
    keys = F.array_distinct(F.transform(pairs, lambda p: plain(F.substring_index(p, "=", 1))))
    value = lambda p: plain(F.substring(p, F.instr(p, "=") + 1, F.length(p)))
    values = F.transform(
        keys,
        lambda k: F.transform(F.filter(pairs, lambda p: plain(F.substring_index(p, "=", 1)) == k), value),
    )
    return F.map_from_arrays(keys, values)


def is_valid_url(url: Column, pattern: Column) -> Column:
    """Site url rule as a regular expression column."""
    return F.regexp_like(F.lower(url), pattern)


def is_redirect(first_url: Column, final_url: Column) -> Column:
    return path_leaf(first_url) != path_leaf(final_url)


def sorted_chars(text: Column) -> Column:
    return F.array_join(F.array_sort(F.split(text, "")), "")


def fingerprint(url: Column, method: Column, encoding: Column, body: Column, date: Column | None = None) -> Column:
    """SHA-1 over url, method, encoding, sorted body characters and, unless it never expires, the date."""
    parts = [url, method, encoding, sorted_chars(F.coalesce(body, F.lit("")))]
    if date is not None:
        parts.append(F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("")))
    return F.sha1(F.concat(*parts).cast("binary"))


def absolute_url(base: Column, ref: Column) -> Column:
    """RFC 3986 join of a page url and a link, dot segments resolved."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = url_path(base)
    folder = F.regexp_replace(path, "[^/]*$", "")
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    ref_tail = F.substring(ref, F.length(ref_path) + 1, F.length(ref))
    joined = F.when(ref_path.startswith("/"), ref_path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), ref_path)
    )
    resolved = F.when(joined.rlike(r"(^|/)\.{1,2}(/|$)"), _resolve_dots(joined)).otherwise(joined)
    return (
        F.when(ref == "", F.regexp_replace(base, "#.*$", ""))
        .when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref.startswith("?"), F.concat(origin, path, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), ref))
        .otherwise(F.concat(origin, resolved, ref_tail))
    )


def _resolve_dots(path: Column) -> Column:
    parts = F.split(path, "/")
    leaf = F.element_at(parts, -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when((p == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(p == "..", acc)
        .otherwise(F.concat(acc, F.array(p))),
    )
    text = F.array_join(folded, "/")
    return F.when(leaf.isin(".", "..") & ~text.endswith("/"), F.concat(text, F.lit("/"))).otherwise(text)
