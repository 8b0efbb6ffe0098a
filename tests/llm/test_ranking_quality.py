import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import queries
from shelfspark.llm import ranking_quality as R
from tests.llm.conftest import EDGE


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op5_quality_classifier(spark, sf_dir)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = rows.collect()
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    unseen = [(r.predicted, quality[r.doc_id]) for r in found if r.held_out and r.doc_id in quality]
    for kind in (0, 1):
        mine = [p == q for p, q in unseen if q == kind]
        assert mine and np.mean(mine) >= 0.95


def test_order_of_scores_is_learnt():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, len(R.FEATURES)))
    good = x[:, 0] - x[:, 3] ** 2 + 0.1 * r.normal(size=4000) > -1
    model = R.fit(x, good)
    s = model.score(x, 0.3)
    assert ((s >= 0.3) == good).mean() > 0.9
    assert (s < 0.3).mean() == pytest.approx((~good).mean(), abs=0.01)


def test_held_out_rows_and_other_columns_do_not_matter(spark, edge):
    labels = [(1, 1), (2, 0), (3, 0), (5, 1), (6, 1), (7, 1), (9, 0), (10, 1), (11, 0), (13, 0), (99, 1), (None, 0), (8, None)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    turned = frame.withColumn("quality", F.when(R.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one = sorted(map(repr, R.quality_scores(edge, frame).collect()))
    two = sorted(map(repr, R.quality_scores(edge.drop("score").withColumn("lang", F.lit("xx")), turned).collect()))
    assert one == two and len(one) == len(EDGE)


def test_nothing_to_learn(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    rows = R.quality_scores(edge, labels).collect()
    assert len({r.score for r in rows}) == 1 and all(r.predicted == 1 for r in rows)
    assert R.quality_scores(empty, labels.limit(0)).collect() == []


def test_every_labelled_row_trains(spark, monkeypatch):
    """The pairs that Newton steps sum over hold each labelled row, however many there are, and the model is that of all rows in memory."""
    r = np.random.default_rng(3)
    n = 41_000
    x = np.round(r.normal(size=(n, len(R.FEATURES))), 3)
    # The last feature tells rows apart by a number of their own.
    x[:, -1] = np.arange(n)
    good = x[:, 0] - x[:, 3] + 0.5 * r.normal(size=n) > -1.0
    described = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "doc_id bigint, features array<double>")
    labels = spark.createDataFrame(list(enumerate(good.astype(int).tolist())), "doc_id bigint, quality int")
    # All rows train here, so that the number of rows is that of the table.
    monkeypatch.setattr(R, "held_out", lambda doc_id: F.lit(False))
    seen = []
    summed = R._summed
    monkeypatch.setattr(R, "_summed", lambda pairs, w, bins: seen.append(pairs) or summed(pairs, w, bins))
    model = R.train(described, labels, pairs=1)
    pairs = seen[0].collect()
    assert len(pairs) == good.sum() == max(good.sum(), (~good).sum())
    found = np.array([list(p.better) for p in pairs], dtype=np.uint8)
    assert sorted(map(bytes, found)) == sorted(map(bytes, R.bin_numbers(x[good], model.cuts)))
    met = {bytes(p.worse) for p in pairs}
    assert met == set(map(bytes, R.bin_numbers(x[~good], model.cuts)))
    assert (model.raw(x) < model.threshold).mean() == pytest.approx((~good).mean(), abs=0.001)
    # Pairs differ from those in memory only in who meets whom.
    whole = R.fit(x, good, pairs=1)
    assert np.abs(whole.cuts[:-1] - model.cuts[:-1]).max() < 0.02
    assert np.corrcoef(whole.raw(x), model.raw(x))[0, 1] > 0.99
