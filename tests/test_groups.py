import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import groups


def test_numbered_counts_each_key_without_gaps_even_for_a_hot_one(spark, small_slices):
    rnd = random.Random(1)
    rows = [("hot", rnd.random(), i) for i in range(3000)] + [(f"k{i % 40}", rnd.random(), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, order double, id int").repartition(7)
    got = groups.numbered(df, ["key"], ["order", "id"]).collect()
    want = {}
    for key in {r[0] for r in rows}:
        for pos, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))):
            want[r] = pos
    assert {(r.key, r.order, r.id): r.pos for r in got} == want


def test_hot_key_is_spread_over_slices(spark, small_slices):
    df = spark.range(20000).select(F.lit("hot").alias("key"), "id")
    sliced = df.repartitionByRange("key", "id").withColumn("slice", F.spark_partition_id())
    assert sliced.select("slice").distinct().count() > 1


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (10, [10]), (11, [10, 1]), (100, [10] * 10)])
def test_chunks_have_the_batch_size(spark, n, sizes):
    df = spark.range(n).select(F.lit(1).alias("key"), "id")
    rows = groups.chunked_lists(df, ["key"], ["id"], "id", 10, "ids").orderBy("chunk").collect()
    assert [len(r.ids) for r in rows] == sizes
    assert [i for r in rows for i in r.ids] == list(range(n))


def test_prefix_crosses_blocks(spark):
    df = spark.createDataFrame([("a", i, i % 3 + 1) for i in range(50)] + [("b", 7, 5)], "key string, page bigint, n int")
    got = {(r.key, r.page): r.before for r in groups.with_prefix(df, ["key"], "page", "n", "before", base=8).collect()}
    assert got[("b", 7)] == 0
    assert all(got[("a", i)] == sum(j % 3 + 1 for j in range(i)) for i in range(50))


def test_first_by_skips_nulls_and_keeps_zero(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 0, 2), (1, 5, 3)], "k int, v int, o int")
    assert df.groupBy("k").agg(groups.first_by(F.col("v"), F.col("o")).alias("v")).first().v == 0


def test_where_once_filters_like_where(spark):
    df = spark.range(10).withColumn("half", F.col("id") / 2)
    assert sorted(r.id for r in groups.where_once(df, F.col("half") > 3).collect()) == [7, 8, 9]


def test_numbered_shuffles_rows_once(spark, small_slices):
    """What follows the stored slices is a broadcast of one row per slice; no exchange carries the rows' own column again."""
    df = spark.range(5000).select((F.col("id") % 3).alias("key"), "id", F.col("id").cast("string").alias("payload"))
    got = groups.numbered(df, ["key"], ["id"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The rows come straight from the stored scan through one broadcast join; the only shuffles are below the broadcast.
    above, below = plan.split("BroadcastExchange", 1)[0], plan.split("BroadcastExchange", 1)[1]
    assert "Exchange hashpartitioning" not in above and "Exchange rangepartitioning" not in plan.split("== Initial Plan ==")[0]
    assert "payload" not in "".join(line for line in below.splitlines() if "Exchange hashpartitioning" in line)


def test_shifts_have_at_most_a_row_per_slice(spark, small_slices):
    df = spark.range(9000).select(F.when(F.col("id") < 6000, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id").repartition(5)
    rows = groups.sliced(df, ["key"], ["id"])
    per_slice = rows.where("_at = _rn AND _shift > 0").groupBy("_slice").agg(F.countDistinct("_shift").alias("n")).collect()
    assert rows.select("_slice").distinct().count() > 2 and per_slice and all(r.n == 1 for r in per_slice)


def test_numbering_tells_odd_keys_apart(spark, small_slices):
    nan = float("nan")
    rows = [(k, n, i) for i in range(200) for k in (None, "", "a", "a ") for n in (None, nan, 0.0, 1.5)]
    df = spark.createDataFrame(rows, "key string, num double, id int").repartition(6)
    got = groups.numbered(df, ["key", "num"], ["id"]).collect()
    assert len(got) == len(rows) and all(r.pos == r.id for r in got)


def test_numbering_by_nested_and_timed_keys(spark, small_slices):
    df = spark.range(600).select(F.struct((F.col("id") % 2).alias("a")).alias("key"), F.timestamp_seconds(F.col("id") % 3).alias("at"), "id")
    got = groups.numbered(df, ["key", "at"], ["id"]).collect()
    assert all(r.pos == r.id // 6 for r in got)


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
def test_chunks_across_slices_and_batches(spark, small_slices, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rnd = random.Random(size)
        rows = [("hot", i) for i in range(2500)] + [(f"k{rnd.randrange(300)}", 10000 + i) for i in range(900)] + [(None, 20000 + i) for i in range(70)]
        df = spark.createDataFrame(rows, "key string, id int").withColumn("pair", F.struct("id", F.lit("x").alias("x"))).repartition(5)
        got = groups.chunked_lists(df, ["key"], ["id"], "pair", size, "pairs").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for key in {k for k, _ in rows}:
        ids = sorted(i for k, i in rows if k == key)
        want |= {(key, c): ids[c * size : (c + 1) * size] for c in range(-(-len(ids) // size))}
    assert {(r.key, r.chunk): [p.id for p in r.pairs] for r in got} == want and len(got) == len(want)


def test_only_cut_lists_are_grouped(spark, small_slices):
    df = spark.range(4000).select((F.col("id") % 40).alias("key"), "id")
    got = groups.chunked_lists(df, ["key"], ["id"], "id", 10, "ids")
    pieces = [f for f in got.inputFiles()]
    stored = spark.read.parquet(*pieces)
    cut = stored.where("NOT _whole").count()
    assert stored.count() - cut >= 380 and cut <= 2 * (len(pieces) + 8)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_late_rows_match_and_are_never_sorted(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None, f"k{i % 50}"]), rnd.choice([None, -5, 0, i % 9, 2**63 - 1, -(2**63)]), f"body {i}") for i in range(800)]
    df = spark.createDataFrame(rows, "key string, seq bigint, body string").coalesce(1)
    last = {r.key: r for r in groups.extreme_rows(df, ["key"], "seq", last=True).collect()}
    first = {r.key: r for r in groups.extreme_rows(df, ["key"], "seq").collect()}
    for key in {r[0] for r in rows}:
        own = [(i, r) for i, r in enumerate(rows) if r[0] == key]
        top = max(own, key=lambda p: (p[1][1] if p[1][1] is not None else -(2**63), p[0]))[1]
        low = min(own, key=lambda p: (p[1][1] if p[1][1] is not None else 2**63 - 1, p[0]))[1]
        assert tuple(last[key]) == top and tuple(first[key]) == low
    for made in (groups.extreme_rows(df, ["key"], "seq"), groups.first_values(df, ["key"], {"b": F.col("body")}, "seq", {"n": F.count("*")})):
        assert "SortAggregate" not in plan_of(made) and "Sort [body" not in plan_of(made)


@pytest.mark.parametrize("most", [0, 200_000])
def test_first_values_against_a_fold(spark, monkeypatch, most):
    small = groups.few
    monkeypatch.setattr(groups, "few", lambda df: small(df, most))
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", None, f"k{i % 30}"]), i, rnd.choice([None, "", f"t{i}"]), rnd.choice([None, 0.0, i / 7])) for i in range(600)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, seq int, title string, price double").repartition(5)
    got = groups.first_values(df, ["key"], {"title": F.col("title"), "price": F.col("price"), "never": F.when(F.col("seq") < 0, F.col("title"))}, "seq", {"n": F.count("*")})
    want = {}
    for key, _, title, price in sorted(rows, key=lambda r: r[1]):
        old = want.setdefault(key, [None, None, 0])
        old[0] = title if old[0] is None else old[0]
        old[1] = price if old[1] is None else old[1]
        old[2] += 1
    assert {r.key: [r.title, r.price, r.n] for r in got.collect()} == want and all(r.never is None for r in got.collect())


def test_order_must_be_a_number_or_a_time(spark):
    with pytest.raises(TypeError, match="seq"):
        groups.extreme_rows(spark.createDataFrame([("a", "1")], "key string, seq string"), ["key"], "seq")
