"""Reviews, variants, ranking, pages and export on small frames."""

import datetime as dt
import gzip
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import deepsearch, export, pages, ranking, reviews, variants
from shelfspark.plans import exports
from shelfspark.plans.registry import Tables
from shelfspark.session import pinned
from shelfspark.sources import schemas, tables


def histogram(spark, rows):
    return spark.createDataFrame(rows, "product_id int, star int, votes bigint")


def test_review_summary_edges(spark):
    rows = [(1, 1, 0), (1, 5, 0), (2, 4, 1), (2, 5, 2), (3, 5, 1)]
    given = spark.createDataFrame([(2, 0, None), (3, 10, 4.126)], "product_id int, given_count bigint, given_average double")
    got = {r.product_id: r for r in reviews.summary(histogram(spark, rows), given).collect()}
    assert (got[1].review_count, got[1].average, got[1].min_star, got[1].max_star) == (0, None, 1, 5)
    assert (got[2].review_count, float(got[2].average)) == (3, 4.67)
    assert (got[3].review_count, float(got[3].average)) == (10, 4.13)


def test_key_range_and_voted_range_differ(spark):
    wide = spark.createDataFrame([(1, 0, 3, 0, 1, 0), (2, 0, 0, 0, 0, 0)], "product_id int, star_1 bigint, star_2 bigint, star_3 bigint, star_4 bigint, star_5 bigint")
    summary = {r.product_id: (r.min_star, r.max_star) for r in reviews.summary(reviews.star_rows(wide)).collect()}
    block = {r.product_id: r for r in reviews.export_block(wide).collect()}
    assert summary[1] == (1, 5)
    assert (block[1].min_review, block[1].max_review, [s.star for s in block[1].reviews]) == (2, 4, [5, 4, 3, 2, 1])
    assert (block[2].min_review, block[2].reviews) == (None, None)


def test_vendor_layouts(spark):
    stats = {"RatingDistribution": [{"RatingValue": 5, "Count": 2}, {"RatingValue": 5, "Count": 3}], "TotalReviewCount": 0, "AverageOverallRating": None,
             "LastSubmissionTime": "2018-05-07T01:02:03.000+00:00"}
    roll = {"rating_histogram": [1, 0, 0, 0, 4], "review_count": 5, "average_rating": 4.2}
    rows = [
        (1, "distribution", json.dumps({"BatchedResults": {"q0": {"Results": [{"ReviewStatistics": stats}]}}})),
        (2, "distribution", json.dumps({"BatchedResults": {"q0": {"Results": []}}})), (3, "distribution", "broken"),
        (4, "histogram", json.dumps({"results": [{"rollup": roll}]})), (5, "histogram", json.dumps({"results": [{"rollup": roll, "metrics": {"review_count": 9, "average_rating": 1.0}}]})),
        (6, "histogram_descending", json.dumps({"results": [{"rollup": roll}]})),
        (7, "cells", '<div class="TTreviewCount">1,005 Reviews</div><span id="TTreviewSummaryAverageRating">4.5</span><div id="TTreviewSummaryBreakdown-2">7</div>'),
        (8, "cells", '<div class="TTreviewCount">3 Reviews</div>'), (9, "nobody", "x"),
    ]
    feed = spark.createDataFrame(rows, "product_id int, vendor string, payload string")
    got = {r.product_id: r for r in reviews.unified_feed(feed).collect()}
    assert set(got) == {1, 4, 5, 6, 7}
    assert (got[1].star_5, got[1].review_count, got[1].average, got[1].last_review_date) == (3, 3, None, dt.date(2018, 5, 7))
    assert (got[4].star_1, got[4].star_5, got[4].review_count) == (1, 4, 5)
    assert (got[5].review_count, got[5].average) == (9, 1.0)
    assert (got[6].star_1, got[6].star_5) == (4, 1)
    assert (got[7].star_2, got[7].review_count, got[7].average) == (7, 1005, 4.5)


def test_feed_choice(spark):
    day = dt.date(2018, 5, 7)
    rows = [(1, 1, None, 5), (1, 2, day, 6), (1, 3, day, 7), (2, 1, None, 5), (2, 3, None, 7)]
    df = spark.createDataFrame(rows, "product_id int, priority int, last_review_date date, review_count bigint")
    assert {r.product_id: r.priority for r in reviews.choose_feed(df).collect()} == {1: 2, 2: 1}


def test_zip_needs_equal_sizes(spark):
    df = spark.createDataFrame([(["a", "b"], ["x"]), (["a"], ["x"]), ([], [])], "n array<string>, v array<string>")
    strict = [r.z for r in df.select(variants.zipped(F.col("n"), F.col("v")).alias("z")).collect()]
    loose = [r.z for r in df.select(variants.zipped(F.col("n"), F.col("v"), same_size=False).alias("z")).collect()]
    assert [None if z is None else [tuple(p) for p in z] for z in strict] == [None, [("a", "x")], None]
    assert [tuple(p) for p in loose[0]] == [("a", "x")]


def test_upc_of_the_first_matching_variant(spark):
    products = spark.createDataFrame([(1, "55", "123"), (2, "7", "123"), (3, "9", "x1")], "product_id int, site_id string, code string")
    rows = spark.createDataFrame([(1, "/ip/955", None, 1), (1, "/ip/55", "u55", 2), (2, "/ip/7", "u7", 1), (3, "/ip/8", "u8", 1)], "product_id int, url string, upc string, pos int")
    got = {r.product_id: (r.upc, r.gtin) for r in variants.upc_of_page(products, rows).collect()}
    assert got == {1: ("000000000123", "00000000000123"), 2: ("u7", None), 3: (None, None)}


def test_rendition_flags_treat_two_missing_sizes_as_equal(spark):
    df = spark.createDataFrame([(1, 0, "raw", 5), (1, 0, "x500", 5), (1, 0, "x1500", 4), (1, 1, "raw", None), (1, 1, "x500", None), (1, 1, "x1500", 3)],
                               "product_id int, image_no int, rendition string, bytes bigint")
    assert {r.image_no: (r.image_dimension, r.zoom_dimension) for r in variants.rendition_flags(df).collect()} == {0: (0, 1), 1: (0, 1)}


def test_option_combinations_expand_rows(spark):
    df = spark.createDataFrame([(1, ["r", "g"], ["s", "m", "l"]), (2, [], ["s"])], "id int, c array<string>, s array<string>")
    rows = variants.option_combinations(df, {"color": F.col("c"), "size": F.col("s")}, ["id"]).collect()
    assert len(rows) == 6 and {r.id for r in rows} == {1}


def test_leaf_counts_on_an_uneven_tree(spark):
    nodes = [("r", None), ("a", "r"), ("b", "r"), ("c", "a"), ("d", "c"), ("e", "c"), ("lonely", None)]
    got = variants.leaf_counts(spark.createDataFrame(nodes, "id string, parent_id string"), pinned)
    assert {r.id: r.leaves for r in got.collect()} == {"r": 3, "lonely": 1}


def test_leaf_counts_with_orphans_and_cycles(spark):
    nodes = [("r", None), ("a", "r"), ("x", "gone"), ("y", "x"), ("z", "x"), ("p", "q"), ("q", "p"), ("s", "q")]
    frame = spark.createDataFrame(nodes, "id string, parent_id string")
    assert {r.id: r.leaves for r in variants.leaf_counts(frame, pinned).collect()} == {"r": 1, "x": 2}
    assert {r.id for r in variants.rootless(frame, pinned).collect()} == {"p", "q", "s"}


def test_repeated_details_do_not_multiply_variants(spark):
    rows = spark.createDataFrame([("p", "s", 1.0, False)], "product_id string, sku string, price double, in_stock boolean")
    details = spark.createDataFrame([("s", 2.0, True, 1), ("s", 3.0, False, 2)], "sku string, price double, add_to_cart boolean, ord int")
    assert [(r.price, r.in_stock) for r in variants.with_details(rows, details).collect()] == [(3.0, False)]


def test_deep_search_survives_deep_and_escaped_documents(spark):
    docs = ["[" * 60_000 + '"k"' + "]" * 60_000, '{"\\u006b":1}']
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert {r.d: r.v for r in deepsearch.with_deep_values(df, "d", "k", "v").collect()} == dict(zip(docs, [[], ["1"]]))


def test_capped_results_drop_late_pages_before_the_window(spark):
    hits = spark.range(3000).select(F.lit("t").alias("term"), F.floor(F.col("id") / 24).cast("int").alias("page"), (F.col("id") % 24).cast("int").alias("pos"), "id")
    got = ranking.search_results(hits)
    assert [r.id for r in got.orderBy("ranking").collect()] == list(range(100))
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ranks = next(i for i, line in enumerate(lines) if "row_number()" in line)
    cut = next(i for i, line in enumerate(lines) if "< 100)" in line)  # the pages' limit, below the ranking window
    assert ranks < cut
    few = ranking.search_results(hits, spark.createDataFrame([("t", 30)], "term string, quantity int"))
    assert few.count() == 30


def test_unplaced_hits_and_page_facts(spark):
    hits = spark.createDataFrame([("t", 1, 1), ("t", None, 2), (None, 1, 3), ("t", 2, 4)], "term string, page int, pos int")
    assert ranking.unplaced_hits(hits).count() == 2
    pages_ = spark.createDataFrame([("t", 1, 9, 24)], "term string, page int, total_matches int, scraped_results_per_page int")
    got = {r.page: (r.ranking, r.results_per_page, r.scraped_results_per_page) for r in ranking.with_page_facts(ranking.ranked_hits(hits), pages_).collect()}
    assert got == {1: (1, 1, 24), 2: (2, 1, None)}


def test_archive_stores_one_answer_per_fingerprint(spark, tmp_path):
    day = dt.date(2018, 5, 7)
    rows = spark.createDataFrame([("a", day, "f1", 200, False, 1, "old"), ("a", day, "f1", 200, False, 2, "new"), ("a", day, "f2", 200, False, 1, "x")],
                                 "site string, crawl_date date, fingerprint string, status int, cached boolean, put_ts int, body string")
    tables.append_archive(rows, str(tmp_path / "a"))
    assert {(r.fingerprint, r.body) for r in spark.read.parquet(str(tmp_path / "a")).collect()} == {("f1", "new"), ("f2", "x")}


def test_spec_map_last_wins_and_sku_removal_takes_one(spark):
    specs = spark.createDataFrame([(1, "model", "a", 1), (1, "model", "b", 2)], "product_id int, name string, value string, ord int")
    assert variants.spec_rows(specs).first().value == "b"
    skus = spark.createDataFrame([(1, "s"), (1, "s"), (1, "t")], "product_id int, sku string")
    base = spark.createDataFrame([(1, "s")], "product_id int, sku string")
    assert sorted(r.sku for r in variants.other_skus(skus, base).collect()) == ["s", "t"]


@pytest.mark.parametrize("quantity", [1, 7, 100])
def test_ranking_counts_through_pages_up_to_the_quantity(spark, quantity):
    rnd = random.Random(quantity)
    data, want = [], {}
    for term in "abc":
        listing, n = [], 0
        for page in range(rnd.randint(1, 30)):
            hits = [f"{term}{n + i}" for i in range(rnd.randint(1, 6))]
            n += len(hits)
            listing.append(hits)
            data += [(term, page, pos * 3, h) for pos, h in enumerate(hits)]
        want.update({hit: i for i, hit in enumerate(itertools.chain(*listing), 1) if i <= quantity})
    rows = ranking.search_results(spark.createDataFrame(data, "term string, page bigint, pos int, hit string").repartition(5), quantity=quantity)
    assert {r.hit: r.ranking for r in rows.collect()} == want


def test_null_ids_are_featured_together(spark):
    hits = spark.createDataFrame([("t", None, "", "new"), ("t", 1, "ad", "bestseller"), ("u", 2, None, None)], "term string, hit_id int, ad string, badge string")
    featured = spark.createDataFrame([("t", None), ("u", 2)], "term string, featured_id int")
    got = sorted((r.term, r.hit_id or 0, r.is_featured, r.is_sponsored, r.is_best_seller, r.is_new) for r in ranking.hit_flags(hits, featured).collect())
    assert got == [("t", 0, True, False, None, True), ("t", 1, False, True, True, None), ("u", 2, True, False, None, None)]


def page_frame(spark, *markup):
    return spark.createDataFrame([(i, "https://www.shop.example/a/b", m) for i, m in enumerate(markup)], "page_id int, url string, html string")


def test_page_meta_and_headings(spark):
    html = ("<html><head><META  charset='utf-8'\n><link href=/c rel=\"canonical\"><title>A &amp; B</title><meta content='k1' name=keywords>"
            '<meta name="Description" content="say &quot;hi&quot;"><meta itemprop="model" content=""><meta itemprop="model" content="X1"></head><h2>one <b>two</b></h2><h1 class="x">T</h1>')
    df = page_frame(spark, html, "")
    meta = {r.page_id: r for r in pages.meta_table(df).collect()}
    assert (meta[0].charset, meta[0].canonical_url, meta[0].browser_title, meta[0].keywords, meta[0].description) == ("utf-8", "/c", "A & B", "k1", 'say "hi"')
    assert meta[0].meta_tags[0] == "<META charset='utf-8' >"
    assert (meta[1].browser_title, meta[1].meta_tags) == (None, [])
    assert [(r.level, r.pos, r.text) for r in pages.heading_rows(df).orderBy("level", "pos").collect()] == [(1, 0, "T"), (2, 0, "one "), (2, 1, "two")]
    assert [r.model_meta for r in pages.meta_model(df).orderBy("page_id").collect()] == ["X1", None]


def test_inline_json_survives_broken_scripts(spark):
    df = page_frame(spark, '<script>window.state = {"a": {"b": 1}};</script>', "<script>window.state = {oops};</script>", "")
    got = df.select("page_id", F.try_variant_get(pages.inline_json(F.col("html"), r"window\.state"), "$.a.b", "int").alias("b"))
    assert [r.b for r in got.orderBy("page_id").collect()] == [1, None, None]


def test_rich_content(spark):
    tour = '<div class="wc-json-data">{"tourViews": [1]}</div>'
    empty_tour = '<div class="wc-json-data">{"tourViews": []}</div>'
    video = '<div itemprop="video"><meta itemprop="contentUrl" content="v.mp4"></div>'
    df = page_frame(spark, tour, empty_tour, video, '<img wcobj-type="application/pdf" wcobj="x">', "plain")
    rows = pages.rich_content(df).orderBy("page_id").collect()
    assert [(r.wc_prodtour, r.wc_video, r.wc_pdf, r.videos_count) for r in rows] == [
        (True, False, False, 0), (False, False, False, 0), (False, True, False, 1), (False, False, True, 0), (False, False, False, 0)]
    assert [r.webcollage for r in pages.rich_content_flag(pages.rich_content(df)).orderBy("page_id").collect()] == [1, 0, 1, 1, 0]


def test_profiles_take_the_first_candidate(spark):
    df = page_frame(spark, "<h1></h1><h2>second</h2>", "<h1>first</h1>")
    chain = [pages.Candidate("shop.example", "title", "regex", "<h2>([^<]*)", 2), pages.Candidate("shop.example", "title", "regex", "<h1>([^<]*)", 1),
             pages.Candidate("*", "note", "constant", "x")]
    assert [(r.title, r.note) for r in pages.extract_fields(df, chain).orderBy("page_id").collect()] == [("second", "x"), ("first", "x")]


def test_sixty_sites_of_thirty_fields_are_compiled_and_read_once(spark, tmp_path):
    """Every site has its own candidate for every field; nothing may fall back to interpreted expressions."""
    sites, fields = [f"shop{i}.example" for i in range(60)], [f"f{i:02}" for i in range(30)]
    rows = [(100 * i + k, f"https://{s}/p", "".join(f"<{f}-{i}>{f} of {i}.{k}</x>" for f in fields[k:])) for i, s in enumerate(sites) for k in range(3)]
    path = str(tmp_path / "pages")
    spark.createDataFrame([*rows, (9000, "https://other.example/", "<f00-1>x</x>")], "page_id int, url string, html string").coalesce(2).write.parquet(path)
    profiles = [(s, f, "regex", f"<{f}-{i}>([^<]*)<", 0) for i, s in enumerate(sites) for f in fields] + [("*", f, "constant", "none", 9) for f in fields]
    table = spark.createDataFrame(profiles, pages.PROFILE_SCHEMA)
    old = spark.conf.get("spark.sql.codegen.factoryMode")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        got = pages.extract_fields(spark.read.parquet(path), table)
        found = {r.page_id: r for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.codegen.factoryMode", old)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    for page_id, url, _ in rows:
        i, k = divmod(page_id, 100)
        assert [found[page_id][f] for f in fields] == [f"{f} of {i}.{k}" if n >= k else None for n, f in enumerate(fields)]
    assert {found[9000][f] for f in fields} == {"none"} and len(found) == len(rows) + 1


def test_profile_tables_are_checked(spark):
    df = page_frame(spark, "<h1>a</h1>")
    for row in (("*", "x", "xpath", "//h1", 0), ("*", None, "regex", "a", 0)):
        with pytest.raises(ValueError, match="profile"):
            pages.extract_fields(df, spark.createDataFrame([row], pages.PROFILE_SCHEMA))
    same = [(s, "t", "regex", "<h1>([^<]*)", None) for s in ("a.example", "b.example", "shop.example")]
    assert len(pages._families(pages.read_profiles(spark.createDataFrame(same, pages.PROFILE_SCHEMA)))) == 1


def test_site_hooks_leave_pages_where_they_are(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(1, "https://a.example/x?y", "<p>"), (2, "https://b.example/", "abc"), (3, "https://c.example/", ""), (4, None, "x")]
    spark.createDataFrame(rows, "page_id int, url string, html string").write.parquet(path)
    size = lambda: {"size": F.length("html"), "kind": F.lit("sized")}
    hooks = {"a.example": size, "b.example": size, "c.example": lambda: {"kind": F.upper("url")}}
    got = pages.apply_site_hooks(spark.read.parquet(path), hooks)
    assert {r.page_id: (r.size, r.kind) for r in got.collect()} == {1: (3, "sized"), 2: (3, "sized"), 3: (None, "HTTPS://C.EXAMPLE/")}
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert pages.apply_site_hooks(spark.read.parquet(path), hooks, default=dict).count() == 4


def test_deep_search_stops_at_a_hit(spark):
    docs = ['{"a":{"k":{"k":1},"x":{"k":2}},"b":[{"k":3},[{"k":null}]]}', '{"k":"é","c":{"k":9}}', "broken \"k\"", None, '{"z":1}']
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert {r.d: r.v for r in deepsearch.with_deep_values(df, "d", "k", "v").collect()} == dict(zip([r.d for r in df.collect()], [['{"k":1}', "3", "null"], ['"é"'], [], [], []]))


def test_deep_search_at_any_depth_and_as_written(spark):
    deep = lambda n, inner: '{"a":[' * n + inner + "]}" * n
    docs = {
        deep(15_000, '{"k": 1E5}'): ["1E5"], deep(15_000, '{"k":[1.10, {"k":2}]}'): ["[1.10, {\"k\":2}]"], deep(15_000, '{"k":1') : [],
        '{"k" : 1.10 , "b":{"k":2}}': ["1.10"], '{"a":{"k":1},"k":-0.0e-7}': ["-0.0e-7"], '[{"k":1},{"k":"x, ]}"},{"b":[{"k":true}]}]': ["1", '"x, ]}"', "true"],
        '{"k":1,"k":{"z": 2}}': ['{"z": 2}'], '{"b":"\\"k\\": 5","c":"{\\"k\\":1}"}': [], '{"\\u006b":[ ],"x":{"k":3}}': ["[ ]"], '{"k":1} x': [], '{"k":1}}': [], '{"k":"': [],
        '{"a":"k","b":["k",{"k":null}]}': ["null"], "\n[ ]": [], '"k"': [], '{"k":12345678901234567890123.450}': ["12345678901234567890123.450"],
        '{"kk":1,"k ":2,"K":3}': [], '{"a":' + json.dumps("q\\" * 30_000) + ',"k":' + json.dumps("\n" * 20_000) + "}": [json.dumps("\n" * 20_000)]}
    df = spark.createDataFrame([(d, i) for i, d in enumerate([*docs, None])], "d string, _i int").repartition(3)
    got = deepsearch.with_deep_values(df, "d", "k", "v")
    assert {r.d: r.v for r in got.collect()} == {**docs, None: []} and got.columns == ["d", "_i", "v"]
    assert not any(w in got._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "InArrow"))


@pytest.mark.parametrize("key", ["a.b", "$x|y", 'q"t', "back\\slash", "", "é(", "\\E"])
def test_deep_search_for_odd_keys(spark, key):
    docs = [json.dumps({"z": [{key: 1.5}], "y": {"n": {key: "v"}}}), json.dumps({key + "x": 1}), json.dumps([{key: {key: 2}}], ensure_ascii=False)]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert {r.d: r.v for r in deepsearch.with_deep_values(df, "d", key, "v").collect()} == dict(
        zip(docs, [["1.5", '"v"'], [], [json.dumps({key: 2}, ensure_ascii=False)]]))


def test_deep_search_against_a_walk(spark):
    rnd = random.Random(6)

    def node(depth):
        kind = rnd.random()
        if depth > 5 or kind < 0.3:
            return rnd.choice([1, -2.5, "k", 'a"k":b', "{[", None, True, "", [], {}])
        if kind < 0.6:
            return [node(depth + 1) for _ in range(rnd.randrange(4))]
        return {rnd.choice(["k", "a", "b", 'k"', "c"]): node(depth + 1) for _ in range(rnd.randrange(4))}

    def walk(n):
        if isinstance(n, dict):
            return [n["k"]] if "k" in n else [v for c in n.values() for v in walk(c)]
        return [v for c in n for v in walk(c)] if isinstance(n, list) else []

    trees = [node(0) for _ in range(400)]
    df = spark.createDataFrame([(i, json.dumps(t, indent=rnd.choice([None, 1]))) for i, t in enumerate(trees)], "i int, d string")
    got = {r.i: [json.loads(v) for v in r.v] for r in deepsearch.with_deep_values(df, "d", "k", "v").collect()}
    assert got == {i: walk(t) for i, t in enumerate(trees)}


def items_frame(spark):
    rows = [
        ("1", "Red ring!", "ring red", None, "$1,200.00", None, None, None, None, None),
        ("2", None, None, 0.0, None, True, False, True, True, 5.0),
        ("3", "x", "y", 7.5, "$8.00", None, True, False, None, None),
    ]
    return spark.createDataFrame(rows, "product_id string, title string, search_term string, price_amount double, price string, no_longer_available boolean, "
                                       "shipping boolean, site_online boolean, in_stores boolean, was_price double")


def test_export_record_rules(spark):
    got = {r.product_id: r for r in export.export_records(items_frame(spark)).collect()}
    assert (got["1"].price_amount, got["1"].sellers.price_amount, got["1"].sellers.price) == (1200.0, 1200.0, "$1,200.00")
    assert (got["3"].price_amount, got["3"].sellers.price_amount) == (7.5, 8.0)
    assert (got["2"].sellers.price, got["2"].price_currency) == ("$0.00", "USD")
    assert (got["1"].search_term_in_title_partial, got["1"].search_term_in_title_exactly, got["1"].search_term_in_title_interleaved) == (True, False, False)
    assert got["2"].search_term_in_title_partial is None
    # Gone means out of stock; not shippable means out of stock in one field only.
    assert (got["2"].is_out_of_stock, got["2"].sellers.in_stock) == (True, 0)
    assert (got["1"].is_out_of_stock, got["1"].sellers.in_stock, got["1"].sellers.online_only, got["1"].sellers.owned) == (None, 1, None, 0)
    assert got["2"].sellers.owned == 1 and got["2"].sellers.in_stores == 1
    assert (got["1"].product_info.bullet_feature_count, got["1"].page_attributes.image_count, got["1"].reviews.review_count) == (0, 0, 0)


def test_in_stores_only_needs_marketplace_rows(spark):
    ddl = "product_id string, site_online boolean, in_stores boolean, marketplace array<struct<name:string,price:double,currency:string,in_stock:boolean>>"
    rows = [("rows", False, True, [("s", 0.0, "USD", False), ("", 3.0, "USD", None)]), ("empty", False, True, []), ("null", False, True, None)]
    got = {r.product_id: r.sellers for r in export.export_records(spark.createDataFrame(rows, ddl)).collect()}
    assert [got[k].in_stores_only for k in ("rows", "empty", "null")] == [1, 0, None]
    assert [got[k].marketplace for k in ("rows", "empty", "null")] == [1, 0, 0]
    assert (got["rows"].marketplace_prices, got["rows"].marketplace_sellers, got["rows"].marketplace_lowest_price) == ([3.0], ["s"], 0.0)


def test_long_marketplace_lists_leave_the_facts_alone(spark):
    items = spark.createDataFrame([("1", "a", True), ("2", "b", True)], "product_id string, title string, in_stores boolean")
    rows = spark.range(1500).select(
        F.lit("1").alias("product_id"), F.col("id").cast("string").alias("name"), (F.lit(2000.0) - F.col("id")).alias("price"),
        F.lit("USD").alias("currency"), (F.col("id") == 1499).alias("in_stock"), "id")
    main, parts = export.with_marketplace(items, rows, ["id"])
    got = {r.product_id: r for r in export.export_records(main).collect()}
    assert len(got) == 2 and got["1"].title == "a"
    sellers = got["1"].sellers
    assert (sellers.marketplace_lowest_price, sellers.marketplace_in_stock, sellers.marketplace_out_of_stock, sellers.marketplace) == (501.0, 1, 0, 1)
    rest = parts.orderBy("part").collect()
    assert [(r.product_id, r.part, len(r.marketplace)) for r in rest] == [("1", 1, 500)]
    assert sellers.marketplace_sellers + [m.name for r in rest for m in r.marketplace] == [str(i) for i in range(1500)]
    assert (got["2"].sellers.marketplace, got["2"].sellers.marketplace_prices, got["2"].sellers.marketplace_lowest_price) == (0, [], None)
    short, none = export.with_marketplace(items, rows.limit(0), ["id"])
    assert none.count() == 0 and short.count() == 2
    facts = [export.export_records(export.with_marketplace(items, rows, ["id"], chunk=c)[0]).where("product_id = 1").select("sellers.marketplace_lowest_price", "sellers.marketplace_in_stock").first() for c in (7, 5000)]
    assert facts[0] == facts[1]


def test_export_files_keep_every_key(spark, tmp_path):
    ddl = "product_id string, title string, buyer_reviews struct<min:int,max:int,stars:map<int,bigint>,count:bigint,average:double,last_review_date:date>, upc string"
    items = spark.createDataFrame([("1", "a", (1, 5, {1: 2, 5: 3, 3: 0}, 5, 3.4, None), "7"), ("2", None, None, None)], ddl)
    records = export.export_records(items)
    tables.write_export(records, str(tmp_path / "out"), F.lit("2018-05-07").cast("date"))
    files = list((tmp_path / "out").glob("runs/*/*/table=records/y=2018/m=05/d=07/part-*"))
    one, two = sorted((json.loads(line) for f in files for line in f.read_text().splitlines()), key=lambda r: r["product_id"])
    assert set(export.RECORD_KEYS) <= set(one) & set(two)
    # Null item fields are left out, keys of the record are not.
    assert one["upc"] == "7" and "upc" not in two and "title" not in two and two["failure_type"] is None and two["proxy_service"] is None
    assert one["reviews"]["reviews"] == [[5, 3], [3, 0], [1, 2]] and two["reviews"]["reviews"] is None
    assert (one["reviews"]["min_review"], one["reviews"]["max_review"], two["reviews"]["review_count"]) == (1, 5, 0)
    page = two["page_attributes"]
    for name in ("image_colors", "image_dimensions", "image_res", "swatches", "variants", "zoom_image_dimensions", "image_urls", "pdf_urls", "video_urls"):
        assert page[name] == [], name
    assert page["htags"] == {} and page["canonical_link"] is None and page["collection_count"] == 0
    assert two["sellers"]["marketplace_prices"] == [] and two["sellers"]["marketplace_sellers"] == [] and two["sellers"]["marketplace_lowest_price"] is None
    assert two["product_info"]["product_name"] is None and two["product_info"]["features"] == []
    tables.write_export(records.limit(0), str(tmp_path / "none"), F.lit("2018-05-07").cast("date"))
    assert not list((tmp_path / "none").glob("**/part-*"))


def test_an_export_run_counts_once(spark, tmp_path):
    path, day = str(tmp_path / "out"), F.lit("2018-05-07").cast("date")
    records = export.export_records(spark.createDataFrame([("1", "a"), ("2", "b")], "product_id string, title string"))
    more = spark.createDataFrame([("1", 1, [("s",)])], "product_id string, part bigint, marketplace array<struct<name:string>>")
    read = lambda: sorted((r.product_id, r.y, r.m, r.d) for r in tables.read_export(spark, path, "product_id string, y string, m string, d string").collect())
    assert read() == []
    broken = records.where(F.raise_error(F.lit("half-way")).isNull() | (F.col("product_id") == "1"))
    with pytest.raises(Exception, match="half-way"):
        tables.write_export(broken, path, day, run="r1")
    assert read() == []

    def half(folder):
        spark.range(3).write.json(f"{folder}/table=records")
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        tables.commit_run(spark, path, "r1", half)
    assert list((tmp_path / "out").glob("runs/run=r1/*/table=records/part-*")) and read() == []
    assert tables.write_export(records, path, day, run="r1", marketplace=more)
    assert not tables.write_export(records, path, day, run="r1", marketplace=more)
    once = [("1", "2018", "05", "07"), ("2", "2018", "05", "07")]
    assert read() == once
    assert tables.write_export(records.limit(0), path, day, run="empty", marketplace=more.limit(0)) and read() == once
    assert tables.write_export(records.where("product_id = 2"), path, day, run="r2", marketplace=more.limit(0)) and read() == [*once, once[1]]
    assert tables.read_export(spark, path, "product_id string, part bigint", part="marketplace").count() == 1


def test_export_files_can_be_compressed(spark, tmp_path):
    """The queries write far fewer bytes than the plain lines have, and nothing of a line is lost."""
    records = export.export_records(spark.range(500).select(F.col("id").cast("string").alias("product_id"), F.lit("tītle").alias("title")))
    more = spark.createDataFrame([("1", 1, [("s",)])], "product_id string, part bigint, marketplace array<struct<name:string>>")
    lines, sizes = {}, {}
    for kind in ("none", "gzip"):
        path = str(tmp_path / kind)
        assert tables.write_export(records, path, F.lit("2018-05-07").cast("date"), run="r", marketplace=more, compression=kind)
        files = list((tmp_path / kind).glob("runs/run=r/*/table=records/y=2018/m=05/d=07/part-*"))
        lines[kind] = sorted(line for f in files for line in (gzip.decompress(f.read_bytes()) if kind == "gzip" else f.read_bytes()).splitlines())
        sizes[kind] = sum(f.stat().st_size for f in files)
        assert tables.read_export(spark, path, "product_id string, part bigint", part="marketplace").count() == 1
        assert {(r.product_id, r.title) for r in tables.read_export(spark, path, "product_id string, title string").collect()} == {(str(i), "tītle") for i in range(500)}
    assert lines["gzip"] == lines["none"] and len(lines["gzip"]) == 500 and sizes["gzip"] * 8 < sizes["none"]
    written = exports.write_export_files(Tables(spark, "/root/testdata/sf0.001"))
    found = [f.path for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{written}/runs").select("path").collect()]
    assert found and all(f.endswith(".gz") for f in found)


def test_chains_take_few_rounds_and_cycles_end(spark):
    rounds = []

    def counted(df):
        rounds.append(1)
        return pinned(df)

    chain = spark.range(100_000).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    loops = spark.createDataFrame([(200_000, 200_001), (200_001, 200_000), (200_002, 200_000), (200_003, 200_003), (200_004, 200_002)], "id bigint, parent_id bigint")
    nodes = chain.union(loops).repartition(4)
    assert {r.id: r.leaves for r in variants.leaf_counts(nodes, counted).collect()} == {0: 1}
    assert len(rounds) < 20
    assert {r.id for r in variants.rootless(nodes, pinned).collect()} == {200_000, 200_001, 200_002, 200_003, 200_004}


def test_schema_has_all_declared_columns(spark):
    df = schemas.conform(spark.createDataFrame([("t", 5)], "title string, ranking int"))
    assert len(df.columns) >= 109 and df.schema["ranking"].dataType.simpleString() == "bigint"


def test_summary_scan_reads_few_columns(spark, tmp_path):
    items_frame(spark).write.parquet(str(tmp_path / "items"))
    plan = export.summary_items(spark.read.parquet(str(tmp_path / "items")))._jdf.queryExecution().executedPlan().toString()
    assert "search_term" not in plan.split("ReadSchema")[1]


def test_archive_scan_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.date(2018, 5, 7), "f1", 200, False), ("b", dt.date(2018, 5, 7), "f2", 200, False), ("a", dt.date(2018, 5, 8), "f3", 500, False)],
                                 "site string, crawl_date date, fingerprint string, status int, cached boolean")
    path = str(tmp_path / "archive")
    tables.append_archive(rows, path)
    tables.append_archive(rows, path, spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 2
    found = tables.read_archive(spark, path, ["a"], ["2018-05-07"], rows.where("fingerprint = 'f1'"))
    assert [r.fingerprint for r in found.collect()] == ["f1"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "site" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_export_files_hold_all_marketplace_rows(spark):
    from shelfspark.plans import exports
    from shelfspark.plans.registry import Tables
    from shelfspark.session import prepare

    t = Tables(prepare(spark), "/root/testdata/sf0.001")
    want = {str(r.l_partkey): r["count"] for r in t.lineitem.groupBy("l_partkey").count().collect()}
    got = {}
    for r in exports.exported_marketplace(t, chunk=7).collect():
        assert r.n <= 7
        got.setdefault(r.product_id, {})[r.part] = r.n
    assert {k: sum(v.values()) for k, v in got.items()} == want and any(len(v) > 1 for v in got.values())
    rows = exports.export_record_rows(t, chunk=7).select("product_id", "marketplace_rows").collect()
    assert {r.product_id: r.marketplace_rows for r in rows if r.marketplace_rows} == want
