"""Messages, archive, merge, questions, stores, jobs and validation."""

import datetime as dt
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfspark.operators import archive, joblog, merge, messages, questions, stores

FULL = {"url": "u", "site": "shop", "result_queue": "q", "response_format": "ch"}
SEARCH = {"searchterms_str": "red ring", "site": "shop", "result_queue": "q", "response_format": "sc"}

BODIES = [
    ("plain", json.dumps(FULL), "ch", None),
    ("plain_bad_url", json.dumps({**FULL, "url": 5}), "ch", "url"),
    ("plain_null_options", json.dumps({**FULL, "cmd_args": None}), "ch", None),
    ("search", json.dumps(SEARCH), "sc", None),
    ("no_format_no_url", json.dumps({**SEARCH, "response_format": None}), "sc", "response_format"),
    ("unknown_format_no_url", json.dumps({**SEARCH, "response_format": "zz"}), "sc", None),
    ("unknown_format_with_url", json.dumps({**FULL, "response_format": "zz"}), None, "unknown_dialect"),
    ("quantity_number", json.dumps({**SEARCH, "quantity": 5}), "sc", "quantity"),
    ("pages_number", json.dumps({**SEARCH, "pages_count": 5}), "sc", None),
    ("pages_fraction", json.dumps({**SEARCH, "pages_count": 5.5}), "sc", "pages_count"),
    ("null_options", json.dumps({**SEARCH, "cmd_args": None}), "sc", "cmd_args"),
    ("list_options", json.dumps({**SEARCH, "cmd_args": []}), "sc", "cmd_args"),
    ("shelf_without_url", json.dumps({**SEARCH, "site": "shop_shelf_urls"}), "sc", "url"),
    ("array", "[1]", None, "not_json"),
    ("text", "oops", None, "not_json"),
    ("empty", "", None, "not_json"),
    ("null", None, None, "not_json"),
]


def raw(spark, bodies):
    return spark.createDataFrame(bodies, "msg_id string, body string")


def test_message_routing_and_validity(spark):
    df = messages.checked(messages.routed(raw(spark, [(n, b) for n, b, _, _ in BODIES])))
    got = {r.msg_id: (r.dialect, r.reject_reason) for r in df.collect()}
    assert got == {n: (d, reason) for n, _, d, reason in BODIES}


def test_message_rewrite(spark):
    shelf = {**SEARCH, "site": "shop_shelf_urls", "url": "s", "searchterms_str": None, "crawl_date": "2018-05-07", "quantity": "20", "cmd_args": {"quantity": "7", "a": True}}
    rows = raw(spark, [("shelf", json.dumps(shelf)), ("search", json.dumps({**SEARCH, "quantity": "20"})), ("plain", json.dumps(FULL))])
    valid, _ = messages.split_valid(messages.checked(messages.routed(rows)))
    got = {r.msg_id: r for r in messages.tasks(valid).collect()}
    assert (got["shelf"].url, got["shelf"].shelf_url, got["shelf"].spider, got["shelf"].quantity, got["shelf"].task_type) == (None, "s", "shop_products", "7", "shelf")
    assert got["shelf"].options == {"quantity": "7", "a": "true", "crawl_date": "2018-05-07"}
    assert (got["search"].search_term, got["search"].quantity, got["search"].task_type, got["search"].options) == ("red ring", "20", "search", {})
    assert (got["plain"].url, got["plain"].task_type) == ("u", "url")


def test_result_messages(spark):
    rows = raw(spark, [("a", json.dumps({**SEARCH, "task_id": "t"})), ("b", json.dumps(FULL)), ("c", json.dumps(FULL)), ("d", json.dumps({**FULL, "site": "nobody"}))])
    tasks = messages.tasks(messages.split_valid(messages.checked(messages.routed(rows)))[0])
    results = spark.createDataFrame([("a", "k1"), ("b", "k2"), ("c", None), ("d", "k4")], "msg_id string, bucket_key string")
    spiders = spark.createDataFrame([("shop_products",)], "spider string")
    out = {r.msg_id: (r.delivered, json.loads(r.value)) for r in messages.result_messages(tasks, results, spiders, "bk", F.lit("2018-05-07 01:02:03").cast("timestamp_ntz")).collect()}
    assert out["a"][1]["status"] == "success" and out["a"][1]["s3_key_data"] == "k1" and out["a"][1]["url"] is None
    # The plain dialect's pointer message keeps the status its readers know.
    assert out["b"][1] == {"url": "u", "date": "2018-05-07 01:02:03", "status": "failure", "s3_filepath": "k2", "bucket_name": "bk", "failure_type": "Response too large"}
    assert out["c"] == (False, {"url": "u", "date": "2018-05-07 01:02:03", "status": "failure"})
    assert out["d"][0] is False and set(out["d"][1]) == {"url", "date", "status"}


@pytest.mark.parametrize("status", [100, 101, 201, 250, 400, 404, 500, 504])
def test_only_200_is_stored(spark, status):
    rows = spark.createDataFrame([("a", status, False), ("b", 200, False), ("c", 200, True)], "fingerprint string, status int, cached boolean")
    assert [r.fingerprint for r in archive.storable(rows).collect()] == ["b"]


@pytest.mark.parametrize("enabled, summary, site, kept", [(True, False, "s", 1), (False, False, "s", 0), (True, True, "s", 0), (True, False, "other", 0), (True, None, "s", 1)])
def test_archive_eligibility(spark, enabled, summary, site, kept):
    rows = spark.createDataFrame([(site, summary)], "site string, summary boolean")
    assert archive.eligible(rows, ["s"], enabled).count() == kept


def test_archive_lookup_truth_table(spark):
    day = lambda d, h=0, m=0: dt.datetime(2018, 5, d, h, m)
    puts = spark.createDataFrame(
        [("hit", day(5), 3600), ("old", day(1), 3600), ("ever", day(1), None), ("twice", day(4), 10), ("twice", day(5, 0, 30), 3600)],
        "fingerprint string, put_ts timestamp_ntz, ttl_s bigint")
    cases = [
        (1, "hit", day(5, 0, 59), day(5), False, "hit"), (2, "hit", day(5, 1), day(5), False, "fetch"), (3, "hit", day(4, 23), day(4), False, "expired"),
        (4, "old", day(5), day(4), False, "expired"), (5, "old", day(5), day(5), False, "fetch"), (6, "ever", day(5), day(4), False, "hit"),
        (7, "none", day(5), day(5), False, "fetch"), (8, "none", day(5), day(4), False, "expired"), (9, "none", day(5), day(4), True, "fetch"),
        (10, "twice", day(5, 1), day(4), False, "hit"), (11, "twice", day(5, 0, 30), day(4), False, "hit"), (12, "twice", day(4, 12), day(4), False, "expired"),
    ]
    lookups = spark.createDataFrame([c[:5] for c in cases], "lookup_id bigint, fingerprint string, ts timestamp_ntz, d timestamp_ntz, never_expire boolean")
    extra = lookups.select("lookup_id", F.col("d").cast("date").alias("crawl_date"), "never_expire")
    for bucket in (600, 3600, 86400 * 30):
        found = archive.as_of(lookups, puts, bucket).join(extra, "lookup_id")
        got = {r.lookup_id: r.outcome for r in archive.lookup_outcome(found, F.lit("2018-05-05").cast("date")).collect()}
        assert got == {c[0]: c[5] for c in cases}


def test_set_name_cuts_the_last_suffix(spark):
    rows = spark.createDataFrame([("shop_products",), ("a_products_products",), ("plain",), (None,)], "s string")
    assert [r.n for r in rows.select(archive.set_name(F.col("s")).alias("n")).collect()] == ["shop", "a_products", None, None]


def test_fragment_merge_rules(spark):
    requested = spark.createDataFrame(
        [("done", "a", True), ("done", "b", False), ("waits", "a", True), ("waits", "b", False), ("late_fail", "a", True), ("late_fail", "b", False),
         ("first_fails", "a", True), ("twice", "a", True), ("twice", "a", False)], "guid string, fingerprint string, initial boolean")
    received = spark.createDataFrame(
        [("done", "b", True, 2, "second", 0), ("done", "a", True, 1, None, 5), ("waits", "a", True, 1, "x", None), ("late_fail", "a", True, 1, "x", None),
         ("late_fail", "b", False, 2, "bad", 1), ("first_fails", "a", False, 1, "bad", None), ("twice", "a", True, 1, "x", None)],
        "guid string, fingerprint string, ok boolean, seq int, title string, price int")
    got = {r.guid: (r.complete, r.outstanding, r.title, r.price) for r in merge.merged_items(requested, received, ["title", "price"]).collect()}
    assert got == {"done": (True, 0, "second", 5), "waits": (False, 1, "x", None), "late_fail": (True, 0, "x", None),
                   "first_fails": (False, 1, None, None), "twice": (False, 1, "x", None)}


def test_questions(spark):
    asked = spark.createDataFrame([("p", "q1", 0, 0), ("p", "q2", 0, 1), ("p", "q3", 1, 0)], "product_id string, question_id string, page bigint, pos int")
    answers = spark.createDataFrame([("q1", "a1", " Bob "), ("q1", "a2", None), ("q3", "a3", "bobby")], "question_id string, answer_id string, nickname string")
    assert questions.unanswered_counts(asked, answers).first()[1:] == (3, 1)
    assert [r.question_id for r in questions.answered_by(asked, answers, "BOB").collect()] == ["q1"]
    assert {r.question_id: r.place for r in questions.accumulated(asked).collect()} == {"q1": 1, "q2": 2, "q3": 3}


def test_store_fallback_needs_a_store_in_first_place(spark):
    places = spark.createDataFrame([(1, 0, "s0", True, "A1 B2"), (1, 1, "s1", True, "C3D4"), (2, 0, "w", False, "A1B2"), (2, 1, "s2", True, "Z9")],
                                   "area int, pos int, store_id string, is_store boolean, postal_code string")
    wanted = spark.createDataFrame([(1, 1, "c3 d4"), (2, 1, "none"), (3, 2, "a1b2"), (4, 2, "z 9")], "id int, area int, postal_code string")
    assert {r.id: r.store_id for r in stores.store_choice(wanted, places).collect()} == {1: "s1", 2: "s0", 3: None, 4: "s2"}


def events_of(spark, rows):
    return spark.createDataFrame(rows, "job_id string, ord bigint, ts timestamp_ntz, event string, value string, latency double")


def test_job_log(spark):
    t = lambda s: dt.datetime(2018, 5, 7, 0, 0, s)
    rows = [
        ("ok", 1, t(0), "spider_opened", None, None), ("ok", 2, t(1), "response_received", "200", 0.5), ("ok", 3, t(2), "response_received", "404", 0.9),
        ("ok", 4, t(3), "item_scraped", None, None), ("ok", 5, t(4), "bucket_uploaded", "f.jl", None), ("ok", 6, t(9), "spider_closed", None, None),
        ("late_error", 1, t(0), "item_scraped", None, None), ("late_error", 2, t(1), "bucket_uploaded", "f", None), ("late_error", 4, t(3), "request_dropped", None, None),
        ("late_error", 3, t(2), "spider_error", "boom", None), ("empty", 1, t(0), "spider_opened", None, None), ("empty", 2, t(1), "request_scheduled", None, None),
    ]
    got = {r.job_id: r for r in joblog.job_log(events_of(spark, rows)).collect()}
    assert (got["ok"].status, got["ok"].status_code, got["ok"].response_time, got["ok"].s3_filepath, got["ok"].duration) == ("ok", "200", 0.5, "f.jl", 9.0)
    assert (got["late_error"].status, got["late_error"].failure_cause, got["late_error"].s3_filepath) == ("failed", "boom", None)
    assert (got["empty"].status, got["empty"].failure_cause, got["empty"].proxy_service) == ("failed", "Item not scraped", "none")


def test_validation_counts_rejects(spark):
    flags = ", ".join(f"{n} boolean" for n in joblog.EXEMPT_FLAGS)
    none = [None] * 5
    rows = [("t", "", "url", *none), ("", "i", "url", *none), ("", None, "url", *none), (None, None, "search", *none), (None, None, "shelf", *none),
            (None, None, "url", True, *none[1:]), (None, None, "url", False, *none[1:])]
    items = spark.createDataFrame(rows, f"title string, image_url string, task_type string, {flags}")
    seen = Observation("validation")
    kept, rejected = joblog.validated(items, seen)
    assert kept.count() == 5
    assert seen.get == {"validation_failures_count": 2}
    assert rejected.count() == 2


def test_outcome_order(spark):
    rows = [(True, True, None, None), (None, True, True, None), (None, None, True, True), (None, None, None, True), (None, False, None, None)]
    items = spark.createDataFrame(rows, "invalid_url boolean, not_found boolean, redirect boolean, temporary_unavailable boolean")
    assert [(r.status, r.failure_type) for r in joblog.with_outcome(items).collect()] == [
        ("failure", "Invalid url"), ("failure", "404"), ("failure", "Redirect"), ("success", "Temporary unavailable"), ("success", None)]
