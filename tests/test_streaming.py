"""Streams over several files and batches against their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from shelfspark.operators import joblog, merge, messages
from shelfspark.streaming import fragments, intake, jobs, leases, runs

FRAGMENT = "guid string, ts timestamp_ntz, kind string, fingerprint string, initial boolean, ok boolean, seq bigint, title string, price string"


def at(minute, second=0):
    return dt.datetime(2018, 5, 7) + dt.timedelta(minutes=minute, seconds=second)


def written(spark, folder, *batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/tmp{i}")
        next((folder / f"tmp{i}").glob("part-*.parquet")).rename(folder / f"{i}.parquet")
    return runs.file_stream(spark, str(folder), "[0-9]*.parquet", spark.createDataFrame([], schema).schema, max_files=1)


def test_fragment_stream_over_batches(spark, tmp_path):
    first = [
        ("a", at(0), "request", "f1", True, None, None, None, None), ("a", at(0), "response", "f1", True, True, 5, "late", None), ("a", at(0), "request", "f2", False, None, None, None, None),
        ("b", at(0), "request", "f1", True, None, None, None, None), ("b", at(0), "response", "f1", True, False, 1, "bad", None),
        ("c", at(0), "request", "f1", True, None, None, None, None), ("c", at(0), "response", "f1", True, True, 1, "only", "1"),
    ]
    second = [("a", at(1), "response", "f2", False, False, 1, "ignored", "2"), ("d", at(1), "request", "f9", True, None, None, None, None)]
    third = [("z", at(300), "request", "f1", True, None, None, None, None)]
    fourth = [("z", at(301), "response", "f1", True, True, 1, "end", None)]
    stream = written(spark, tmp_path, first, second, third, fourth, schema=FRAGMENT)
    runs.drain_to_table(fragments.merged_stream(stream, ["title", "price"], silence=1800), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.guid: (r.complete, r.outstanding, r.title, r.price) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": (True, 0, "late", None), "c": (True, 0, "only", "1"), "z": (True, 0, "end", None),
                   "b": (False, 1, None, None), "d": (False, 1, None, None)}
    rows = spark.createDataFrame(first + second + third + fourth, FRAGMENT)
    twin = merge.merged_items(rows.where("kind = 'request'"), rows.where("kind = 'response'"), ["title", "price"])
    assert {r.guid: (r.complete, r.outstanding, r.title, r.price) for r in twin.collect()} == got


def test_a_late_answer_still_completes_its_item(spark, tmp_path):
    empty = (None, None, None, None)
    batches = [
        [("a", at(0), "request", "f", True, *empty)], [("other", at(15), "request", "g", True, *empty)],
        [("a", at(20), "response", "f", True, True, 1, "late", None)], [("end", at(300), "request", "h", True, *empty)], [("end", at(301), "response", "h", True, True, 1, None, None)],
    ]
    stream = written(spark, tmp_path, *batches, schema=FRAGMENT)
    runs.drain_to_table(fragments.merged_stream(stream, ["title", "price"], silence=3600), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.guid: (r.complete, r.title) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": (True, "late"), "other": (False, None), "end": (True, None)}


def test_repeated_deliveries_over_several_runs(spark, tmp_path):
    """Each run gets its files, and some of the last run's fragments once more; the result is that of the batch over distinct rows."""
    empty = (None, None, None)
    asked = [(f"g{i}", at(i % 50), "request", f"f{j}", j == 0, None, j, None, None) for i in range(60) for j in range(i % 3 + 1)]
    answers = [(g, at(t.minute + 1), "response", f, first, int(g[1:]) % 7 != 0 or first, 10 - j, f"t{j} {g}" if j else None, f"{j}") for g, t, _, f, first, _, j, *_ in asked if (int(g[1:]), j) != (4, 1)]
    end = [("z", at(900), "request", "f", True, *empty, None), ("z", at(900), "response", "f", True, True, 1, None, None)]
    runs_ = [asked, asked[::2] + answers[:40], answers[10:], answers[50:] + asked[-3:], end]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in runs_:
        spark.createDataFrame(rows, FRAGMENT).coalesce(1).write.mode("append").parquet(source)
        stream = runs.file_stream(spark, source, "*.parquet", spark.createDataFrame([], FRAGMENT).schema)
        runs.drain_to_table(fragments.merged_stream(stream, ["title", "price"], silence=1800, delay="3 hours"), out, state)
    got = {r.guid: (r.complete, r.outstanding, r.title, r.price) for r in spark.read.parquet(out).collect()}
    rows = spark.createDataFrame([r for part in runs_ for r in part], FRAGMENT).distinct()
    twin = merge.merged_items(rows.where("kind = 'request'"), rows.where("kind = 'response'"), ["title", "price"])
    want = {r.guid: (r.complete, r.outstanding, r.title, r.price) for r in twin.collect()}
    assert got == want and not got["g4"][0] and spark.read.parquet(out).count() == 61


def stored_rows(spark, path):
    return sum(spark.read.parquet(str(f)).count() for f in path.glob("b*=*"))


def test_job_log_storage_grows_with_jobs_not_with_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "MERGE_AFTER", 3)
    schema = "job_id string, ord bigint, ts timestamp_ntz, event string, value string, latency double"
    batches = [[(f"j{i}", 10 * n + i, at(n), "response_received" if n else "item_scraped", str(200 + n), float(n)) for i in range(5)] for n in range(8)]
    stream = written(spark, tmp_path, *batches, schema=schema)
    jobs.run_job_log(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    (base,) = (f.name for f in (tmp_path / "out").glob("b*=*"))
    assert stored_rows(spark, tmp_path / "out") == 5 and base in ("base=7", "base=8")
    twin = {r.job_id: r.asDict() for r in joblog.job_log(spark.createDataFrame([r for b in batches for r in b], schema)).collect()}
    assert {r.job_id: r.asDict() for r in jobs.settled_log(spark, str(tmp_path / "out")).collect()} == twin
    # A merge that broke off is no base, and an older batch that is written again changes nothing.
    (tmp_path / "out" / "base=99").mkdir()
    spark.read.parquet(str(tmp_path / "out" / base)).limit(1).write.parquet(str(tmp_path / "out" / "batch=2"))
    assert {r.job_id: r.asDict() for r in jobs.settled_log(spark, str(tmp_path / "out")).collect()} == twin
    jobs.merge_folds(spark, str(tmp_path / "out"))
    assert [f.name for f in (tmp_path / "out").glob("b*=*")] == [base]


def test_job_log_stream_joins_a_job_across_batches_and_horizons(spark, tmp_path):
    schema = "job_id string, ord bigint, ts timestamp_ntz, event string, value string, latency double"
    first = [("j", 1, at(0), "request_scheduled", None, None), ("j", 2, at(1), "response_received", "200", 0.5), ("k", 1, at(2), "item_scraped", None, None)]
    second = [("j", 3, at(70), "item_scraped", None, None), ("j", 4, at(71), "bucket_uploaded", "f.jl", None), ("k", 2, at(3), "spider_error", "boom", None)]
    stream = written(spark, tmp_path, first, second, schema=schema)
    jobs.run_job_log(stream, str(tmp_path / "out"), str(tmp_path / "state"), horizon="1 hour")
    got = {r.job_id: r.asDict() for r in jobs.settled_log(spark, str(tmp_path / "out")).collect()}
    twin = {r.job_id: r.asDict() for r in joblog.job_log(spark.createDataFrame(first + second, schema)).collect()}
    assert got == twin
    assert got["j"]["status"] == "ok" and got["k"]["failure_cause"] == "boom"


def test_a_silence_longer_than_the_lease_is_a_new_delivery(spark):
    rows = [("t", at(0)), ("t", at(4, 59)), ("t", at(10)), ("u", at(0)), ("u", at(5))]
    sessions = leases.lease_sessions(spark.createDataFrame(rows, "task_id string, ts timestamp_ntz"))
    assert sorted((r.task_id, r.renewals) for r in sessions.collect()) == [("t", 1), ("t", 2), ("u", 2)]
    assert [(r.task_id, r.deliveries) for r in leases.redelivered(sessions).collect()] == [("t", 2)]


def test_intake_stream_equals_batch(spark, tmp_path):
    ok = '{"url":"u","site":"shop","result_queue":"q","response_format":"ch"}'
    schema = "msg_id bigint, body string"
    batches = [(1, ok), (2, "broken")], [(3, ok.replace('"shop"', '"nobody"')), (4, '{"url":5,"site":"shop","result_queue":"q","response_format":"ch"}')]
    stream = written(spark, tmp_path, *batches, schema=schema)
    spiders = spark.createDataFrame([("shop_products",), ("shop_products",)], "spider string")
    intake.run_intake(stream, spiders, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state"))
    assert [r.msg_id for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [1]
    assert {r.msg_id: r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {2: "not_json", 3: "unknown_spider", 4: "url"}
    batch = messages.checked(messages.routed(spark.createDataFrame(batches[0] + batches[1], schema)))
    assert messages.split_valid(batch)[0].count() == 2
    tasks = messages.tasks(messages.split_valid(batch)[0])
    assert [r.msg_id for r in messages.unknown_sites(tasks, spiders).collect()] == [3]


def test_drained_run_stops_and_continues(spark, tmp_path):
    stream = lambda: runs.file_stream(spark, str(tmp_path), "[0-9]*.parquet", spark.createDataFrame([], "id bigint").schema, max_files=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(str(tmp_path / f"tmp{i}"))
        next((tmp_path / f"tmp{i}").glob("part-*.parquet")).rename(tmp_path / f"{i}.parquet")
        runs.drain_to_table(stream(), out, state)
        assert spark.read.parquet(out).agg(F.countDistinct("id")).first()[0] == (i + 1) * 10
        assert spark.read.parquet(out).count() == (i + 1) * 10


def test_fragment_merge_calls_python_for_buckets_not_for_items(spark, tmp_path):
    """Many items share the state of few buckets; those that end, wait or fall silent do not disturb each other."""
    empty = (None, None, None)
    asked = [(f"g{i}", at(i % 5), "request", "f", True, *empty, None) for i in range(300)] + [(None, at(1), "request", "f", True, *empty, None)]
    answers = [(g, at(8), "response", "f", True, True, None if i % 2 else i, f"t {g}", None) for i, (g, *_) in enumerate(asked) if i % 3]
    late = [("late", at(40), "request", "f", True, *empty, None)]
    end = [("z", at(900), "request", "f", True, *empty, None), ("z", at(900), "response", "f", True, True, 1, None, None)]
    stream = written(spark, tmp_path, asked, answers, late, end, schema=FRAGMENT)
    merged = fragments.merged_stream(stream, ["title", "price"], silence=1800, buckets=3)
    assert "_bucket" in merged._jdf.queryExecution().logical().toString()
    runs.drain_to_table(merged, str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.guid: (r.complete, r.outstanding, r.title) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {g: (bool(i % 3), 0 if i % 3 else 1, f"t {g}" if i % 3 and g else None) for i, (g, *_) in enumerate(asked)}
    assert got.pop("late") == (False, 1, None) and got.pop("z") == (True, 0, None)
    assert got.pop(None) == want.pop(None) and got == want
    assert spark.read.parquet(str(tmp_path / "out")).count() == 303
