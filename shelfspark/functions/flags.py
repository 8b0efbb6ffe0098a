"""Stock, image and boolean-text flags (FIL10, FIL11, FN25, FN26, FN29, FIL5, FIL6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Availability codes.
OUT_OF_STOCK = ("OUT_OF_STOCK", "RETIRED")
NOT_IN_STORE = ("NOT_SOLD_IN_STORE", "OUT_OF_STOCK")

# Smallest side of a large image, in pixels.
LARGE_SIDE = 500


def in_stock(availability: Column) -> Column:
    """Unknown availability counts as in stock."""
    return ~F.coalesce(availability, F.lit("")).isin(*OUT_OF_STOCK)


def low_stock(message: Column) -> Column:
    return F.coalesce(message, F.lit("")).rlike(r"Only\s*\d+\s*left!")


def large_either(width: Column, height: Column) -> Column:
    return ((width >= LARGE_SIDE) | (height >= LARGE_SIDE)).cast("int")


def large_both(width: Column, height: Column) -> Column:
    return ((width >= LARGE_SIDE) & (height >= LARGE_SIDE)).cast("int")


def text_flag(text: Column) -> Column:
    """True for 'True', 'true' and '1'; anything else is false."""
    return F.coalesce(text.isin("True", "true", "1"), F.lit(False))


def option_values(options: Column) -> Column:
    """Command options with boolean texts folded to lower case; other values unchanged."""
    fold = lambda v: F.when(v.isin("True", "true"), "true").when(v.isin("False", "false"), "false").otherwise(v)
    return F.transform_values(options, lambda _, v: fold(v))


def network_availability(availability: Column, status: Column) -> dict[str, Column]:
    """Online flags from the ship-to-home network codes."""
    online = availability != "UNAVAILABLE"
    oos = F.when(online, status == "OUT_OF_STOCK")
    return {
        "site_online": online,
        "site_online_out_of_stock": oos,
        "in_stock": F.when(online, ~oos).otherwise(F.lit(False)),
    }


def store_availability(status: Column, locations: Column) -> dict[str, Column]:
    """Store flags from the product status and the status list of its locations."""
    sold = status != "OUT_OF_STOCK"
    return {
        "in_stores": sold,
        "in_stores_out_of_stock": F.when(sold, ~F.exists(locations, lambda s: ~s.isin(*NOT_IN_STORE))),
    }


def basket_out_of_stock(disabled: Column, pickup_status: Column, pickup: Column, home: Column, direct: Column) -> Column:
    """Out of stock when the basket is disabled, or online-only with no channel open."""
    closed = pickup.isin("NO", "NA") & home.isin("NO", "NA") & (direct == "NO")
    return F.coalesce(disabled, F.lit(False)) | F.coalesce((pickup_status == "onlineOnly") & closed, F.lit(False))


def response_route(url_ok: Column, redirected: Column, status: Column, has_payload: Column,
                   missing_status: tuple[int, ...] = (404,)) -> Column:
    """Ordered routing of one response; null means it can be read."""
    return (
        F.when(~F.coalesce(url_ok, F.lit(False)), "invalid_url")
        .when(F.coalesce(redirected, F.lit(False)), "redirect")
        .when(status == 520, "temporary_unavailable")
        .when(status.isin(*missing_status) | ~F.coalesce(has_payload, F.lit(False)), "not_found")
    )


def job_outcome(invalid_url: Column, not_found: Column, redirect: Column, temporary: Column) -> tuple[Column, Column]:
    """(status, failure_type); a temporary outage stays a success."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    failed = yes(invalid_url) | yes(not_found) | yes(redirect)
    kind = (
        F.when(yes(invalid_url), "Invalid url")
        .when(yes(not_found), "404")
        .when(yes(redirect), "Redirect")
        .when(yes(temporary), "Temporary unavailable")
    )
    return F.when(failed, "failure").otherwise("success"), kind
