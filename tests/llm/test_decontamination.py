import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import decontamination as D
from shelfspark.llm import queries
from tests.llm.conftest import EDGE, SF_DIR, prose, same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    wanted = []
    for item, text in items:
        w = words(text)
        wanted += [(str(item), tuple(w[i : i + size])) for i in range(max(1, len(w) - size + 1))] if w else []
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, run in wanted:
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i : i + len(run)]) == run:
                    hit.update(range(i, i + len(run)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return out


ITEMS = [
    (1, " ".join(prose(1, 300).split()[40:75])), (2, "ONE two"), (3, None), (4, ""), (10, " ".join(prose(5, 120).split()[:12])),
    (10, " ".join(prose(5, 120).split()[:12])), (11, "not, anywhere; to be found in any of all these texts really"), (12, "the0"),
    (13, " ".join(prose(10, 9000).split()[-11:])), (14, "漢字"),
]


@pytest.mark.parametrize("most", [D.VOCABULARY_BYTES, 0])
@pytest.mark.parametrize("segment", [262_144, 50])
def test_same_as_brute_force(spark, edge, most, segment):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("term", F.lit(1))
    got = D.matches(edge, benchmark, segment_words=segment, vocabulary_bytes=most)
    same([(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got.collect()], brute(EDGE, ITEMS))


def test_query_on_driver_tables(spark, small):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = [
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(small[1], items)]
    same(queries.op1_decontamination(spark, SF_DIR).collect(), want)
    assert any(w[-1] for w in want)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "a b x y z c d"), (4, "d c b a")], "doc_id bigint, text string")
    items = spark.createDataFrame([("q", "a b c d")], "item_id string, text string")
    got = {r.doc_id: [(s.first, s.exact) for s in r.spans or []] for r in D.matches(docs, items, near=1).collect()}
    assert [e for _, e in got[2]] == [True]
    assert got[1] and not any(e for _, e in got[1])
    assert got[3] == [] and got[4] == []


def test_empty_tables(spark, empty, edge):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert D.matches(empty, items).collect() == []
    assert all(r.n_hit == 0 and r.item_ids == [] for r in D.matches(edge, items).collect())


def test_passages_with_words_put_in_are_found(spark, tmp_path):
    import corpus_pipeline as P

    passage = [f"{w}{i}" for i, w in enumerate(prose(77, 60).split())]
    every = lambda n: " ".join(w + (" so" if i % n == n - 1 else "") for i, w in enumerate(passage))
    rows = [(1, prose(1, 80) + " " + every(9) + " " + prose(2, 80)), (2, every(5)), (3, " ".join(passage)), (4, prose(3, 200)), (5, None), (6, "two odd one")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(passage)), (8, "one two")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in queries.op1_proximity_matches(spark, str(tmp_path)).collect()}
    assert {d: r.contaminated for d, r in found.items()} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False}
    assert [(found[d].n_hit, found[d].n_near > 0, found[d].near_items) for d in (1, 2, 3, 4)] == [(0, True, "7"), (0, True, "7"), (60, False, ""), (0, False, "")]
    assert found[1].spans.endswith(":near") and found[3].spans.endswith(":exact")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.doc_id for r in P.decontaminate(spark, docs, str(tmp_path)).collect()) == [4, 5, 6]
