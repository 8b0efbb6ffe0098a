import corpus_pipeline as P
from shelfspark.llm import queries, ranking_quality
from shelfspark.llm import secrets as S
from shelfspark.llm.common import stored
from tests.llm.conftest import EDGE, SF_DIR, prose, same
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_tokens import check_packing


def test_pipeline_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = stored(P.quality(spark, docs, SF_DIR), "q")
    assert kept.columns == docs.columns
    scored = ranking_quality.quality_scores(docs, queries.table(spark, SF_DIR, "labels")).collect()
    good = {r.doc_id for r in scored if r.predicted == 1}
    rows = [r for r in small[1] if r[0] in good]
    same([(r.doc_id, r.text) for r in kept.collect()], rows)
    assert 0 < len(rows) < len(small[1])

    firsts = {d for d, _, c in components(rows, 5, 80, 100) if d == c}
    rows = [r for r in rows if r[0] in firsts]
    unique = stored(P.near_duplicates(spark, kept, SF_DIR), "n")
    same([(r.doc_id, r.text) for r in unique.collect()], rows)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    dirty = {d for d, _, n, _ in contaminated(rows, items) if n}
    rows = [r for r in rows if r[0] not in dirty]
    clean = stored(P.decontaminate(spark, unique, SF_DIR), "d")
    same([(r.doc_id, r.text) for r in clean.collect()], rows)

    scanner = S.SecretScanner()
    rows = [(d, S.without(t, scanner.spans(t), "[secret]")) for d, t in rows]
    safe = stored(P.redact(spark, clean, SF_DIR), "r")
    same([(r.doc_id, r.text, r.n_chars) for r in safe.collect()], [(d, t, len(t)) for d, t in rows])
    assert safe.columns == docs.columns

    check_packing(rows, P.pack(spark, safe, SF_DIR).collect())
    check_packing(rows, P.run(spark, SF_DIR).collect())


def test_stages_on_awkward_rows(spark, edge):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, edge, SF_DIR)
        assert out.columns == edge.columns and out.schema["text"].dataType.simpleString() == "string", name
        assert stage(spark, edge.limit(0), SF_DIR).collect() == []
    assert P.pack(spark, edge.limit(0), SF_DIR).collect() == []


def test_one_of_each_group_stays(spark, edge):
    kept = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in P.near_duplicates(spark, edge, SF_DIR).collect())
    ids = [d for has, d, _ in kept if has]
    # 6 and a row without id repeat 5, which is there twice; 12 is 1 with a word more; the two rows of 7 are no copies.
    assert ids == [1, 2, 3, 4, 5, 7, 7, 8, 9, 10, 11, 13]
    assert sorted(t for has, d, t in kept if d == 7) == sorted(t for d, t in EDGE if d == 7)
    assert [t for has, _, t in kept if not has] == [""]  # without words, hence no copy of anything


def test_a_null_text_and_extra_columns_survive(spark):
    rows = spark.createDataFrame([(1, prose(1, 50), "a"), (1, prose(1, 50), "b"), (2, None, "c")], "doc_id bigint, text string, `odd name` string")
    out = {(r[0], r[1]) for r in P.near_duplicates(spark, rows, SF_DIR).collect()}
    assert out == {(1, prose(1, 50)), (2, None)}


def test_only_near_copies_go(spark):
    """Rows that share an id, rows without one, empty rows and map columns."""
    rows = [(1, prose(1, 90), {"a": 1}), (1, prose(2, 90), {"a": 2}), (1, prose(1, 90), {"a": 1}), (None, "", {}), (None, None, None), (None, None, {"b": 1}),
            (2, "", None), (2, "", {}), (None, prose(4, 90), {}), (None, prose(4, 90), {"c": 2}), (3, prose(4, 90) + " end", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, facts map<string,int>")
    out = [(r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF_DIR).collect()]
    same(out, [(1, prose(1, 90)), (1, prose(2, 90)), (None, ""), (None, None), (None, None), (2, ""), (2, ""), (3, prose(4, 90) + " end")])


def test_rows_without_an_id_are_judged_one_by_one(spark, tmp_path):
    passage = prose(77, 40)
    rows = [(None, prose(1, 100)), (None, prose(2, 100)), (None, prose(1, 100)), (None, prose(3, 100)), (4, prose(3, 100)), (None, passage + " x"), (4, prose(9, 100))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    same(P.decontaminate(spark, docs, str(tmp_path)).collect(), [r for r in rows if not (r[1] or "").startswith(passage)])
    # One of the copies without id stays, and of a text with and without id the row with it; both texts of the id 4 stay.
    want = [(None, prose(1, 100)), (None, prose(2, 100)), (None, passage + " x"), (4, prose(3, 100)), (4, prose(9, 100))]
    same(P.near_duplicates(spark, docs, SF_DIR).collect(), want)
    scored = [r.predicted for r in ranking_quality.quality_scores(docs, queries.table(spark, SF_DIR, "labels")).select("predicted").collect()]
    junk = [(None, "spam " * 300), (None, prose(2, 100))]
    labels = [(i, 0 if i % 2 else 1) for i in range(60)]
    known = [(i, "spam " * (200 + i) if q == 0 else prose(i, 120)) for i, q in labels]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = P.quality(spark, spark.createDataFrame(junk + known, "doc_id bigint, text string"), str(tmp_path)).collect()
    assert len(scored) == len(rows) and [r.text for r in kept if r.doc_id is None] == [prose(2, 100)]
