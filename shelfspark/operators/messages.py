"""Task messages in, result messages out.

Raw messages: msg_id, ts, body. A dialect is a set of field rules and a rewrite; more
can be added to ``DIALECTS``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.select import truthy
from shelfspark.operators.groups import where_once

# Message conventions.
SPIDER_SUFFIX = "_products"
SHELF_MARK = "_shelf_urls"
TOO_LARGE = "Response too large"

# Message fields stay VARIANT, so that the type each sender used can be checked.
FIELDS = ("response_format", "url", "searchterms_str", "quantity", "pages_count", "num_pages", "crawl_date", "summary",
          "site", "result_queue", "cmd_args", "task_id")
_SCHEMA = ", ".join(f"{n} variant" for n in FIELDS) + ", _broken string"
_OPTIONS = "map<string,string>"


def _kind(name: str) -> Column:
    """Type name of a message field; null when missing, VOID for a JSON null."""
    return F.schema_of_variant(F.col(f"m.{name}"))


def _text(name: str) -> Column:
    return F.try_variant_get(F.col(f"m.{name}"), "$", "string")


def _is_text(name: str) -> Column:
    return F.coalesce(_kind(name) == "STRING", F.lit(False))


def _none(name: str) -> Column:
    return F.coalesce(_kind(name) == "VOID", F.lit(True))


def _is_text_or_none(name: str) -> Column:
    return _is_text(name) | _none(name)


def _is_text_int_or_none(name: str) -> Column:
    return _is_text_or_none(name) | F.coalesce(_kind(name).isin("BIGINT", "BOOLEAN"), F.lit(False))


def _is_object(name: str) -> Column:
    return F.coalesce(_kind(name).startswith("OBJECT"), F.lit(False))


def _options() -> Column:
    return F.try_variant_get(F.col("m.cmd_args"), "$", _OPTIONS)


@dataclass(frozen=True)
class Dialect:
    """``rules``: field to condition, checked in order. ``rewrite``: output columns."""

    rules: Callable[[], dict[str, Column]]
    rewrite: Callable[[], dict[str, Column]]


def _plain_rules() -> dict[str, Column]:
    rules = {n: _is_text(n) for n in ("url", "site", "result_queue", "response_format")}
    return {**rules, "cmd_args": _is_object("cmd_args") | _none("cmd_args")}


def _plain_rewrite() -> dict[str, Column]:
    return {
        "url": _text("url"), "shelf_url": F.lit(None).cast("string"), "search_term": F.lit(None).cast("string"),
        "quantity": F.lit(None).cast("string"), "spider": F.concat(_text("site"), F.lit(SPIDER_SUFFIX)), "options": _options(),
    }


def _search_rules() -> dict[str, Column]:
    is_shelf = F.coalesce(_text("site").contains(SHELF_MARK), F.lit(False))
    return {
        "url": (_is_text("url") | _is_text("searchterms_str")) & (~is_shelf | _kind("url").isNotNull()),
        "quantity": _is_text_or_none("quantity"),
        "pages_count": _is_text_int_or_none("pages_count"),
        "num_pages": _is_text_int_or_none("num_pages"),
        "crawl_date": _is_text_or_none("crawl_date"),
        "summary": _is_text_or_none("summary"),
        **{n: _is_text(n) for n in ("site", "result_queue", "response_format")},
        # An explicit null has no options to read, unlike a missing field.
        "cmd_args": _is_object("cmd_args") | _kind("cmd_args").isNull(),
    }


def _search_rewrite() -> dict[str, Column]:
    shelf = _text("site").contains(SHELF_MARK)
    options = F.coalesce(_options(), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    date = truthy(_text("crawl_date"), "string")
    dated = F.map_concat(F.map_filter(options, lambda k, _: k != "crawl_date"), F.create_map(F.lit("crawl_date"), date))
    return {
        "url": F.when(~shelf, _text("url")),
        "shelf_url": F.when(shelf, _text("url")),
        "search_term": truthy(_text("searchterms_str"), "string"),
        "quantity": F.coalesce(truthy(F.try_element_at(options, F.lit("quantity")), "string"), _text("quantity")),
        "spider": F.concat(F.replace(_text("site"), F.lit(SHELF_MARK), F.lit("")), F.lit(SPIDER_SUFFIX)),
        "options": F.when(date.isNotNull(), dated).otherwise(options),
    }


DIALECTS: dict[str, Dialect] = {
    "ch": Dialect(_plain_rules, _plain_rewrite),
    "sc": Dialect(_search_rules, _search_rewrite),
}
DEFAULT_DIALECT = "sc"


def routed(raw: DataFrame, dialects: dict[str, Dialect] = DIALECTS) -> DataFrame:
    """Adds the parsed body ``m``, whether it is ``readable``, and its dialect (SRC1).

    A body that is no JSON object has no dialect. Without a known response format only a
    message without url gets the default one.
    """
    df = raw.withColumn("m", F.from_json("body", _SCHEMA, {"columnNameOfCorruptRecord": "_broken"}))
    is_object = F.col("body").rlike(r"^\s*\{")
    df = df.withColumn("readable", F.coalesce(is_object & F.col("m").isNotNull() & F.col("m._broken").isNull(), F.lit(False)))
    named = _text("response_format")
    no_url = truthy(_text("url"), "string").isNull()
    dialect = F.when(F.col("readable"), F.when(named.isin(*dialects), named).when(no_url, DEFAULT_DIALECT))
    return df.withColumn("dialect", dialect)


def _by_dialect(dialects: dict[str, Dialect], pick: Callable[[Dialect], Column]) -> Column:
    out = F.when(F.lit(False), None)
    for name, d in dialects.items():
        out = out.when(F.col("dialect") == name, pick(d))
    return out


def _first_broken(rules: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(~ok, n) for n, ok in rules.items()])


def checked(messages: DataFrame, dialects: dict[str, Dialect] = DIALECTS) -> DataFrame:
    """Adds ``reject_reason``: null for a valid message (FIL2)."""
    broken = _by_dialect(dialects, lambda d: _first_broken(d.rules()))
    reason = F.when(~F.col("readable"), "not_json").when(F.col("dialect").isNull(), "unknown_dialect").otherwise(broken)
    return messages.withColumn("reject_reason", reason)


def split_valid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) frames of checked messages."""
    bad = F.col("reject_reason").isNotNull()
    return where_once(messages, ~bad), messages.where(bad)


def tasks(valid: DataFrame, dialects: dict[str, Dialect] = DIALECTS) -> DataFrame:
    """Messages rewritten to tasks (FN27): shelf urls split off, options and quantity settled."""
    names = next(iter(dialects.values())).rewrite()
    rewritten = [_by_dialect(dialects, lambda d: d.rewrite()[n]).alias(n) for n in names]
    df = valid.select("*", *rewritten)
    kind = F.when(F.col("shelf_url").isNotNull(), "shelf").when(F.col("search_term").isNotNull(), "search").otherwise("url")
    return df.select(
        "msg_id", "dialect", _text("site").alias("site"), _text("result_queue").alias("result_queue"), _text("task_id").alias("task_id"),
        *names, kind.alias("task_type"))


def unknown_sites(tasks: DataFrame, spiders: DataFrame) -> DataFrame:
    """Tasks for a spider nobody runs. ``spiders``: spider."""
    return tasks.join(spiders.select("spider"), "spider", "left_anti")


def result_messages(tasks: DataFrame, results: DataFrame, spiders: DataFrame, bucket: str, now: Column) -> DataFrame:
    """One success or failure message per task (JN18).

    ``results``: msg_id, bucket_key (null after a failed upload). A task without result, of
    an unknown spider or without key fails. The plain dialect's pointer message carries the
    status its consumers expect, which is "failure" with a reason.
    """
    known = spiders.select("spider").withColumn("_known", F.lit(True))
    rows = tasks.join(results, "msg_id", "left").join(known, "spider", "left")
    key = F.when(F.col("_known"), F.col("bucket_key"))
    done = key.isNotNull()
    iso, stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(now, "yyyy-MM-dd HH:mm:ss")
    link = F.coalesce(truthy(F.col("url"), "string"), F.col("shelf_url"))
    search = [
        F.col("task_id").alias("msg_id"), iso.alias("utc_datetime"), F.when(done, "success").otherwise("failure").alias("status"),
        F.col("site"), link.alias("url"), F.col("search_term").alias("searchterms_str"),
    ]
    stored = [F.lit(bucket).alias("bucket_name"), key.alias("s3_key_data")]
    plain = [F.col("url"), stamp.alias("date"), F.lit("failure").alias("status")]
    pointer = [key.alias("s3_filepath"), F.lit(bucket).alias("bucket_name"), F.lit(TOO_LARGE).alias("failure_type")]
    as_json = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    is_search = F.col("dialect") == "sc"
    body = (F.when(is_search & done, as_json(search + stored)).when(is_search, as_json(search))
            .when(done, as_json(plain + pointer)).otherwise(as_json(plain)))
    return rows.select("msg_id", F.col("result_queue").alias("queue"), done.alias("delivered"), body.alias("value"))
