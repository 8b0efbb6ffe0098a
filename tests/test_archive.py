"""Archive layout: what a look-up reads, last writes without sorting bodies, appends that meet what is stored."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import archive, joblog, merge
from shelfspark.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Rows that the scans of a finished query gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if "AdaptiveSparkPlan" in plan.toString() else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("archive") / "rows")
    rows = spark.range(24000).select(
        F.sha1(F.col("id").cast("string").cast("binary")).alias("fingerprint"), F.when(F.col("id") % 2 == 0, "s").otherwise("t").alias("site"),
        F.lit("2024-05-01").cast("date").alias("crawl_date"), F.lit(200).alias("status"), F.lit(False).alias("cached"),
        F.repeat(F.lit("body "), 40).alias("body"), F.col("id"))
    tables.append_archive(rows, path)
    return path, rows


def test_point_lookup_reads_pages_not_partitions(spark, stored):
    path, rows = stored
    wanted = rows.where("id IN (40, 4000, 77)").select("fingerprint")
    found = tables.read_archive(spark, path, ["s"], ["2024-05-01"], wanted)
    assert sorted(r.id for r in found.collect()) == [40, 4000] and "bucket" not in found.columns
    assert 0 < rows_read(found) < 24000 / 2 / 10
    whole = tables.read_archive(spark, path, ["s"], ["2024-05-01"])
    assert len(whole.collect()) == rows_read(whole) == 12000


def test_lookup_of_nothing_and_of_many(spark, stored):
    path, rows = stored
    none = rows.where("id < 0").select("fingerprint")
    assert tables.read_archive(spark, path, ["s"], ["2024-05-01"], none).count() == 0
    many = rows.where("id < 1000").select("fingerprint")
    assert tables.read_archive(spark, path, ["s", "t"], ["2024-05-01"], many).count() == 1000
    assert tables.read_archive(spark, path, ["s"], ["2024-05-02"], many).count() == 0


def test_append_checks_a_few_keys_at_the_scan(spark, stored):
    path, rows = stored
    new = rows.where("id < 5").union(rows.where("id = 5").withColumn("fingerprint", F.lit("new")))
    kept = archive.not_stored(new, spark.read.parquet(path))
    assert [r.fingerprint for r in kept.collect()] == ["new"]
    checked = archive.with_keys(spark.read.parquet(path), new).select("fingerprint")
    assert len(checked.collect()) == 5 and rows_read(checked) < 24000 / 3


def test_append_without_put_time_keeps_one_row(spark, tmp_path):
    row = ("a", "s", dt.date(2024, 5, 1), 200, False, "x")
    rows = spark.createDataFrame([row, row, ("b", *row[1:])], "fingerprint string, site string, crawl_date date, status int, cached boolean, body string")
    path = str(tmp_path / "a")
    tables.append_archive(rows, path)
    tables.append_archive(rows, path, spark.read.parquet(path))
    assert sorted(r.fingerprint for r in tables.read_archive(spark, path, ["s"], ["2024-05-01"]).collect()) == ["a", "b"]


def test_bodies_are_neither_sorted_nor_aggregated(spark):
    at = dt.datetime(2024, 5, 1)
    puts = spark.createDataFrame([("a", at, "old"), ("a", at + dt.timedelta(1), "new"), ("b", None, "only"), (None, at, "no key")], "fingerprint string, put_ts timestamp, body string")
    last = archive.last_writes(puts)
    assert {(r.fingerprint, r.body) for r in last.collect()} == {("a", "new"), ("b", "only"), (None, "no key")}
    events = spark.createDataFrame([(1, 1, at, "bucket_uploaded", "p", 1.0)], "job_id int, ord int, ts timestamp, event string, value string, latency double")
    received = spark.createDataFrame([("g", "f", True, 1, "t")], "guid string, fingerprint string, ok boolean, seq int, title string")
    items = merge.merged_items(received.select("guid", "fingerprint", F.lit(True).alias("initial")), received, ["title"])
    for df in (last, joblog.job_log(events), items):
        assert "SortAggregate" not in plan_of(df)
