"""First-non-null, truthy fallback and tri-state rules (PRJ1, PRJ6, PRJ8, PRJ10, PRJ11, AGG9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_set(existing: Column, *candidates: Column, conv: Callable[[Column], Column] | None = None) -> Column:
    """Keep ``existing`` unless null, else the first candidate; 0, false and '' count as values.

    ``conv`` is applied to candidates only, as the conditional set does.
    """
    conv = conv or (lambda c: c)
    return F.coalesce(existing, *[conv(c) for c in candidates])


def truthy(c: Column, kind: str) -> Column:
    """Null when the value is null, zero, empty or false."""
    empty = {
        "string": c == "",
        "number": c == 0,
        "boolean": ~c,
        "array": F.size(c) == 0,
    }[kind]
    return F.when(c.isNotNull() & ~empty, c)


def first_truthy(kind: str, *candidates: Column) -> Column:
    return F.coalesce(*[truthy(c, kind) for c in candidates])


def flag(c: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)


def tri_state(c: Column) -> Column:
    """1, 0 or null."""
    return c.cast("int")


def negated_tri_state(c: Column) -> Column:
    return (~c).cast("int")


def leaf_department(department: Column, departments: Column, shelf: Column) -> Column:
    return F.coalesce(department, F.try_element_at(departments, F.lit(-1)), shelf)


def main_image(image_url: Column, image_urls: Column) -> Column:
    return F.coalesce(truthy(image_url, "string"), F.get(image_urls, F.lit(0)))


def secondary_id(task_type: Column, *candidates: Column) -> Column:
    return F.when(task_type == "shelf", F.coalesce(*candidates))


def is_single_result(task_type: Column) -> Column:
    return task_type == "url"


def channel_matrix(site_online: Column, in_stores: Column, has_marketplace: Column,
                   online_oos: Column, stores_oos: Column, owned: Column) -> dict[str, Column]:
    """Channel flags; a null ``has_marketplace`` means the marketplace was never read."""
    unknown = site_online.isNull() | in_stores.isNull() | has_marketplace.isNull()
    only_stores = ~site_online & has_marketplace & in_stores
    only_online = (site_online | has_marketplace) & ~in_stores
    sold = F.coalesce(site_online, F.lit(False)) | F.coalesce(in_stores, F.lit(False))
    return {
        "in_stores_only": F.when(~unknown, only_stores.cast("int")),
        "online_only": F.when(~unknown, only_online.cast("int")),
        "owned": F.coalesce(owned, sold).cast("int"),
        "site_online_in_stock": negated_tri_state(online_oos),
        "in_stores_in_stock": negated_tri_state(stores_oos),
    }
