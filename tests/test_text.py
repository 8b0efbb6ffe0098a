import html
import random
import re
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import codes, dates, flags, prices, select, text


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_slug_folds_like_unicode(spark):
    values = ["Café Crème – 50 %", "ﬁne ½ cup…", "ßtraße", "  a--b  c ", "日本", "Ångström №5 ™", "x" * 10, ""]
    want = []
    for v in values:
        s = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode()
        want.append(re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", s, flags=re.A).strip()))
    assert column(spark, values, text.slug) == want


def test_unescape_is_one_pass(spark):
    values = ["a &amp;lt; b", "&eacute;&#233;&#xE9; &copy;", "&unknown; & &#8364;", "plain", "&#128512;", "R&D;"]
    want = [html.unescape(v) for v in values[:2]] + ["&unknown; & €", "plain", "😀", "R&D;"]
    assert column(spark, values, text.unescape) == want


def test_between(spark):
    got = column(spark, ["x<a>in</a>y</a>", "<a>open", "none", "</a><a>z</a>"], lambda c: text.between(c, "<a>", "</a>"))
    assert got == ["in", "", "", "z"]


def expected_end(description, title):
    """Where the long part starts, from the places of all marks."""
    name = title.split(",")[0]
    places = lambda *marks: [m.start() for mark in marks for m in re.finditer(re.escape(mark), description)]
    named = places("<b>" + name, "<strong>" + name)
    block = [m.start() for m in re.finditer(r'(?s)(<b>|<strong>)[^<]*(</b>|</strong>)[(<br>)\s":]*(</p>)?(<br>)*(<ul>|<li>)', description)]
    lists = [] if named or block else places("<dl>", "<ul>", "<li>")
    end = min(places("<h3>", '<section class="product-about') + (named or block) + lists, default=None)
    length = len(description) if end is None else end
    paragraphs = [p for p in places("<p>") if p + 3 <= length]
    if length <= 1000 or not paragraphs:
        return end
    return max([p for p in paragraphs if p <= 1000], default=paragraphs[0])


def test_description_split_matches_the_marks(spark):
    rnd = random.Random(4)
    pieces = ["<p>", "</p>", "<b>Tool", "<b>Other</b><ul>", "<strong>Tool", "<h3>", "<dl>", "<li>", '<section class="product-about">', "word " * 60, "x" * 300, "<br>"]
    rows = [("".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 14))), "Tool, red") for _ in range(400)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, t string")
    end = text.shortened_end(F.col("d"), text.split_point(F.col("d"), F.col("t")))
    got = [r.e for r in df.select("i", end.alias("e")).orderBy("i").collect()]
    assert got == [expected_end(*r) for r in rows]


@pytest.mark.parametrize("description, end", [
    ("plain", None), ("a<ul>b", 1), ("a<b>Tool</b>b<ul>", 1), ("a<ul>b<b>Other</b><ul>", 6), ("a<h3>b<b>Tool", 1), ("x" * 900 + "<p>" + "y" * 50 + "<p>" + "z" * 200, 953),
    ("x" * 1100 + "<p>" + "y" * 50 + "<p>z", 1100), ("x" * 1200, None), ("<p>" + "x" * 1100 + "<ul>", 0),
])
def test_description_split_cases(spark, description, end):
    df = spark.createDataFrame([(description, "Tool, red")], "d string, t string")
    assert df.select(text.shortened_end(F.col("d"), text.split_point(F.col("d"), F.col("t"))).alias("e")).first().e == end


def test_description_choice(spark):
    rows = [
        (1, "<p>short</p>", None, "<p>Name</p>", None, "<p>Name</p>"),
        (2, "ends...", None, "Long description is not available", None, "t"),
        (3, "<p></p>", "second", "long", None, "t"),
        (4, None, None, "only long", None, "t"),
    ]
    df = spark.createDataFrame(rows, "id int, s1 string, s2 string, l1 string, l2 string, title string")
    got = {r.id: (r.short_description, r.long_description) for r in text.choose_descriptions(df, ["s1", "s2"], ["l1", "l2"]).collect()}
    assert got[1] == ("<p>short</p> <p>Name</p>", None)
    assert got[2] == (None, None)
    assert got[3] == ("second", "long")
    assert got[4] == ("only long", None)


def test_absolute_urls_follow_urljoin(spark):
    base = "https://shop.example/a/b/c.html?x=1#top"
    refs = ["d.html", "/root", "//cdn.example/i.jpg", "?p=2", "#f", "../up", "./here", "../../../far", "http://other.example/z", "d/../e", "mailto:a@b.c", "x?y=/../z", ".."]
    got = column(spark, refs, lambda c: codes.absolute_url(F.lit(base), c))
    assert got == [urljoin(base, r) for r in refs]


def test_codes(spark):
    assert column(spark, ["123", "00012345678901234", "abc", None, "1" * 16], codes.gtin14) == ["0" * 11 + "123", "00012345678901234", None, None, "1" * 16]
    assert column(spark, ["00000000000123", "00123456789012"], codes.upc12) == ["000000000123", "123456789012"]
    urls = ["https://x.example/ip/name/27280854?a=/99999", "https://x.example/ip/ab", "https://x.example/12/name?x"]
    assert column(spark, urls, codes.product_id) == ["99999", "ab", "name"]
    assert column(spark, ["http://www.a.example:80/x", "ftp://b.example"], codes.domain) == ["a.example:80", "b.example"]


def test_query_values_keep_repeats_and_drop_blanks(spark):
    got = column(spark, ["http://a.example/?a=1&b=&a=2&c=x%20y#a=3", "http://a.example/"], codes.query_values)
    assert got == [{"a": ["1", "2"], "c": ["x y"]}, {}]


def test_fingerprint_ignores_body_order_and_drops_the_date_for_lasting_ones(spark):
    df = spark.createDataFrame([("ab", "2018-05-07"), ("ba", "2018-05-07"), ("ab", "2018-05-08")], "body string, d string")
    parts = (F.lit("u"), F.lit("GET"), F.lit("utf-8"), F.col("body"))
    dated = [r.x for r in df.select(codes.fingerprint(*parts, F.col("d").cast("date")).alias("x")).collect()]
    assert dated[0] == dated[1] != dated[2]
    assert len({r.x for r in df.select(codes.fingerprint(*parts).alias("x")).collect()}) == 1


def test_prices(spark):
    assert column(spark, ["$1,234.50 each", "call", None, "1.2.3", "from 5 to 6"], prices.price_amount) == [1234.5, None, None, None, 5.0]
    assert column(spark, [1234.5, 0.125, 0.135, -1.0, None], prices.price_text, "double") == ["$1,234.50", "$0.12", "$0.14", "$-1.00", None]
    assert column(spark, ["Now $2.50 Per Fl Oz", "none"], lambda c: prices.unit_price(c)[0]) == ["2.50", None]
    assert column(spark, ["Now $2.50 Per Fl Oz", "none"], lambda c: prices.unit_price(c)[1]) == ["fl oz", None]
    assert column(spark, ["12.50"], lambda c: prices.subscribe_price(c.cast("decimal(12,2)"), F.lit(5).cast("decimal(5,0)")).cast("double")) == [11.88]
    assert column(spark, [1999, 5], lambda c: prices.minor_units(c).cast("double"), "bigint") == [19.99, 0.05]


def test_currency_list_is_complete():
    assert len(prices.CURRENCY_CODES) == len(set(prices.CURRENCY_CODES)) == 181


def test_crawl_date_text_and_arrival_days(spark):
    assert column(spark, ["2018-05-07"], lambda c: dates.crawl_date_text(c.cast("date"))) == ["2018-05-07"]
    assert column(spark, ["2018-05-07"], lambda c: dates.crawl_date_text(c.cast("timestamp_ntz"))) == ["2018-05-07"]
    today = F.lit("2018-05-01").cast("date")
    got = column(spark, ["Arrives by Sat, Jun 9", "Available Mon, June 9", "Free pickup Mon, Foo 9", "soon"], lambda c: dates.days_to_arrival(c, today))
    assert got == [39, 39, None, None]


def test_tri_state_and_truthy(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "b boolean")
    assert [(r.f, r.t, r.n) for r in df.select(select.flag(F.col("b")).alias("f"), select.tri_state(F.col("b")).alias("t"), select.negated_tri_state(F.col("b")).alias("n")).collect()] == [(0, None, None), (1, 1, 0), (0, 0, 1)]
    assert column(spark, [None, 0, 5], lambda c: select.first_truthy("number", c, F.lit(7)), "int") == [7, 7, 5]
    assert column(spark, [None, 0, 5], lambda c: select.first_set(c, F.lit(7)), "int") == [7, 0, 5]


def test_large_image_rules_differ(spark):
    df = spark.createDataFrame([(500, 10), (500, 500), (499, 499)], "w int, h int")
    rows = df.select(flags.large_either(F.col("w"), F.col("h")).alias("a"), flags.large_both(F.col("w"), F.col("h")).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(1, 0), (1, 1), (0, 0)]


def test_ingredients(spark):
    assert column(spark, ["a, b (c, d), e"], text.ingredients_outside_parens) == [["a", "b (c, d)", "e"]]
    assert column(spark, ["a, b (c, d), ,e"], text.ingredients_flat) == [["a", "b", "c", "d", "e"]]
    assert column(spark, ["No", "x , y", "", None], text.ingredients_unless_no) == [None, ["x", "y"], None, None]


def test_folds_and_entities_beyond_the_first_plane(spark):
    df = spark.createDataFrame([("\U0001d400\U0001d401c Caf\u00e9 \U0001f130 \u2460", "&#0000039;&#x00000041;&#55357;&#56832;&#xD83D;&#xDE00;&#55357;x&#9999999;&#128512;")], "a string, b string")
    row = df.select(text.slug(F.col("a")).alias("a"), text.unescape(F.col("b")).alias("b")).first()
    assert row.a == "ABc-Cafe-A-1"
    assert row.b == "'A\U0001f600\U0001f600&#55357;x&#9999999;\U0001f600"
