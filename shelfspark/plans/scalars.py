"""Column-expression queries over the driver tables (FN*, PRJ1, PRJ6-PRJ8, PRJ10, PRJ11, SET4, FIL10, FIL11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import codes, dates, flags, prices, select, text
from shelfspark.plans.registry import query

CENTS = "decimal(12,2)"


def _money(name: str):
    return F.col(name).cast(CENTS)


# ---- prices ---------------------------------------------------------------

@query("fn1_price_text_to_amount", """
SELECT l_orderkey, l_linenumber, l_suppkey,
       TRY_CAST(replace(regexp_extract(
         'Now $' || format('{:,.2f}', l_extendedprice) || ' each', '[0-9.,]+'), ',', '') AS DOUBLE) AS amount
FROM lineitem
""")
def _(t):
    label = F.concat(F.lit("Now $"), F.format_number("l_extendedprice", 2), F.lit(" each"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", prices.price_amount(label).alias("amount"))


@query("fn2_amount_to_price_text", """
SELECT l_orderkey, l_linenumber, l_suppkey, format('${:,.2f}', l_extendedprice) AS price FROM lineitem
""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             prices.price_text(F.col("l_extendedprice")).alias("price"))


@query("fn3_currency_validity", """
WITH c AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'usd'
         WHEN 3 THEN upper(substr(o_orderpriority, 3, 3)) END AS code FROM orders)
SELECT o_orderkey, coalesce(code, 'USD') AS currency, code IN ('USD', 'EUR') AS valid FROM c
""")
def _(t):
    k = F.col("o_orderkey") % 5
    code = (F.when(k == 0, "USD").when(k == 1, "EUR").when(k == 2, "usd")
            .when(k == 3, F.upper(F.substring("o_orderpriority", 3, 3))))
    return t.orders.select("o_orderkey", prices.currency_or_default(code).alias("currency"),
                           prices.is_currency(code).alias("valid"))


@query("fn4_was_now_text", """
WITH p AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS was,
         CASE WHEN l_discount > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - 0.5 AS DECIMAL(12,2)) END AS now FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(now AS VARCHAR) || ', ' || CAST(was AS VARCHAR) AS was_now FROM p
""")
def _(t):
    now = F.when(F.col("l_discount") > 0, (_money("l_extendedprice") - F.lit("0.5").cast(CENTS)).cast(CENTS))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             prices.was_now(now, _money("l_extendedprice")).alias("was_now"))


@query("fn5_price_precedence", """
WITH p AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 0.0 ELSE l_extendedprice END AS declared,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'R' THEN 'call us'
              ELSE format('${:,.2f}', l_quantity) END AS label FROM lineitem),
q AS (SELECT *, TRY_CAST(replace(regexp_extract(label, '[0-9.,]+'), ',', '') AS DOUBLE) AS parsed FROM p)
SELECT l_orderkey, l_linenumber, l_suppkey,
       coalesce(nullif(declared, 0), parsed) AS flat_price,
       coalesce(nullif(parsed, 0), declared) AS seller_price FROM q
""")
def _(t):
    n = F.col("l_linenumber") % 3
    declared = F.when(n == 1, F.lit(0.0)).when(n == 2, F.col("l_extendedprice"))
    label = (F.when(F.col("l_returnflag") == "R", "call us")
             .when(F.col("l_returnflag") == "A", prices.price_text(F.col("l_quantity"))))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             prices.flat_price(declared, label).alias("flat_price"),
                             prices.seller_price(declared, label).alias("seller_price"))


@query("fn6_subscribe_price", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                  CAST(round(l_discount * 100) AS DECIMAL(5,0)) AS pct FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey,
       CASE WHEN price <> 0 AND pct <> 0
            THEN CAST(CAST(price * (100 - pct) * 0.01 AS DECIMAL(18,2)) AS DOUBLE) END AS subscribe_price FROM p
""")
def _(t):
    percent = F.round(F.col("l_discount") * 100).cast("decimal(5,0)")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             prices.subscribe_price(_money("l_extendedprice"), percent).cast("double").alias("subscribe_price"))


@query("fn7_unit_price_text", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'Price on request'
                  ELSE 'Now $' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || ' Per ' || p_type END AS label FROM part),
q AS (SELECT p_partkey, lower(regexp_extract(label, '\\$[0-9]{1,3}[,0-9{}]*\\.?[0-9]* Per .+')) AS f FROM p)
SELECT p_partkey, CASE WHEN f <> '' THEN trim(replace(split_part(f, ' per ', 1), '$', '')) END AS amount,
       CASE WHEN f <> '' THEN trim(split_part(f, ' per ', 2)) END AS unit FROM q
""")
def _(t):
    label = F.when(F.col("p_size") % 4 == 0, "Price on request").otherwise(
        F.concat(F.lit("Now $"), _money("p_retailprice").cast("string"), F.lit(" Per "), F.col("p_type")))
    amount, unit = prices.unit_price(label)
    return t.part.select("p_partkey", amount.alias("amount"), unit.alias("unit"))


@query("fn8_price_cut_flags", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_discount > 0 AS price_cut,
       coalesce(CASE l_returnflag WHEN 'A' THEN 'OnSale' WHEN 'R' THEN 'Regular' END = 'OnSale', false) AS sale_label
FROM lineitem
""")
def _(t):
    was = F.when(F.col("l_discount") > 0, _money("l_extendedprice"))
    label = F.when(F.col("l_returnflag") == "A", "OnSale").when(F.col("l_returnflag") == "R", "Regular")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", prices.price_cut(was).alias("price_cut"),
                             prices.sale_label(label).alias("sale_label"))


@query("fn31_promotion_text", """
SELECT p_partkey,
       CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) END AS buy_quantity,
       CASE WHEN p_size % 3 = 1 THEN CAST(p_size AS VARCHAR) END AS percent,
       CASE WHEN p_size % 3 = 1 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
       CASE WHEN p_size % 3 = 2 THEN CAST(p_size AS VARCHAR) || ',' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END
         AS volume_discount
FROM part
""")
def _(t):
    size, price = F.col("p_size").cast("string"), _money("p_retailprice").cast("string")
    kind = F.col("p_size") % 3
    label = (F.when(kind == 0, F.concat(F.lit("Buy "), size, F.lit(" Get 1 Free")))
             .when(kind == 1, F.concat(F.lit("Save $"), price, F.lit(" ("), size, F.lit("% off)")))
             .otherwise(F.concat(F.lit("each "), price)))
    quantity = F.when(kind == 2, size)
    return t.part.select(
        "p_partkey", prices.buy_get_free(label).alias("buy_quantity"), prices.percent_saved(label).alias("percent"),
        prices.amount_saved(label).alias("amount"), prices.volume_discount(quantity, label).alias("volume_discount"))


@query("fn32_minor_units", """
SELECT l_orderkey, l_linenumber, l_suppkey,
       CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 0.01 AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM lineitem
""")
def _(t):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", prices.minor_units(cents).cast("double").alias("amount"))


# ---- codes and urls -------------------------------------------------------

@query("fn9_gtin_and_upc", """
WITH c AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN CAST(p_partkey AS VARCHAR)
                  WHEN 1 THEN '00' || CAST(p_partkey + 600000000000 AS VARCHAR)
                  WHEN 2 THEN CAST(p_partkey + 1234567890000000 AS VARCHAR) ELSE 'SKU' || CAST(p_partkey AS VARCHAR) END AS code FROM part),
g AS (SELECT p_partkey, CASE WHEN regexp_full_match(code, '[0-9]+')
        THEN CASE WHEN length(code) < 14 THEN lpad(code, 14, '0') ELSE code END END AS gtin FROM c),
u AS (SELECT *, right(ltrim(gtin, '0'), 12) AS bare FROM g)
SELECT p_partkey, gtin, CASE WHEN length(bare) < 12 THEN lpad(bare, 12, '0') ELSE bare END AS upc FROM u
""")
def _(t):
    key = F.col("p_partkey")
    kind = F.col("p_size") % 4
    code = (F.when(kind == 0, key.cast("string"))
            .when(kind == 1, F.concat(F.lit("00"), (key + 600000000000).cast("string")))
            .when(kind == 2, (key + 1234567890000000).cast("string"))
            .otherwise(F.concat(F.lit("SKU"), key.cast("string"))))
    gtin = codes.gtin14(code)
    return t.part.select("p_partkey", gtin.alias("gtin"), codes.upc12(gtin).alias("upc"))


@query("fn10_product_id_from_url", """
WITH u AS (SELECT page_id, url, regexp_extract_all(url, '/([0-9]{3,20})', 1) AS ids FROM pages)
SELECT page_id, CASE WHEN len(ids) > 0 THEN ids[-1] ELSE split_part(split_part(url, '?', 1), '/', -1) END AS product_id,
       CASE WHEN regexp_matches(url, '/([0-9]+)\\.html') THEN regexp_extract(url, '/([0-9]+)\\.html', 1) END AS html_id
FROM u
""")
def _(t):
    return t.pages.select("page_id", codes.product_id(F.col("url")).alias("product_id"),
                          codes.id_by_pattern(F.col("url"), r"/(\d+)\.html").alias("html_id"))


@query("fn11_url_forms", """
SELECT page_id, regexp_replace(url, '^http://', 'https://') AS secure, split_part(url, '?', 1) AS bare,
       replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '') AS domain,
       nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS q_page,
       nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS q_ref,
       nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS q_source
FROM pages
""")
def _(t):
    df = t.pages.select("page_id", "url", codes.query_values(F.col("url")).alias("q"))
    value = lambda k: F.array_join(F.try_element_at("q", F.lit(k)), ",")
    return df.select("page_id", codes.https(F.col("url")).alias("secure"), codes.without_query(F.col("url")).alias("bare"),
                     codes.domain(F.col("url")).alias("domain"), value("page").alias("q_page"),
                     value("ref").alias("q_ref"), value("utm_source").alias("q_source"))


@query("fn23_request_fingerprint", """
WITH b AS (SELECT event_id, user_id, ts, event_type, props,
           array_to_string(list_sort(string_split(props, '')), '') AS body,
           'https://example.com/u/' || CAST(user_id AS VARCHAR) AS url,
           CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method FROM events)
SELECT event_id, sha1(url || method || 'utf-8' || body || strftime(ts, '%Y-%m-%d')) AS dated,
       sha1(url || method || 'utf-8' || body) AS lasting FROM b
""")
def _(t):
    url = F.concat(F.lit("https://example.com/u/"), F.col("user_id").cast("string"))
    method = F.when(F.col("event_type") == "purchase", "POST").otherwise("GET")
    parts = (url, method, F.lit("utf-8"), F.col("props"))
    return t.events.select("event_id", codes.fingerprint(*parts, F.col("ts")).alias("dated"),
                           codes.fingerprint(*parts).alias("lasting"))


# ---- dates ----------------------------------------------------------------

@query("fn21_days_to_arrival", """
WITH a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 AS k FROM orders),
b AS (SELECT o_orderkey, k, make_date(1998, month(d), day(d)) AS arrival FROM a WHERE NOT (month(d) = 2 AND day(d) = 29)
      UNION ALL SELECT o_orderkey, k, NULL FROM a WHERE month(d) = 2 AND day(d) = 29)
SELECT o_orderkey, CASE WHEN k <> 3 THEN CAST(date_diff('day', DATE '1998-06-15', arrival) AS BIGINT) END AS days FROM b
""")
def _(t):
    day = F.date_format("o_orderdate", "MMM d")
    long_day = F.date_format("o_orderdate", "MMMM d")
    kind = F.col("o_orderkey") % 4
    label = (F.when(kind == 0, F.concat(F.lit("Arrives by Mon, "), day))
             .when(kind == 1, F.concat(F.lit("Available Tue, "), long_day))
             .when(kind == 2, F.concat(F.lit("Free pickup Wed, "), day))
             .otherwise("Out of reach"))
    today = F.lit("1998-06-15").cast("date")
    return t.orders.select("o_orderkey", dates.days_to_arrival(label, today).cast("bigint").alias("days"))


@query("fn22_timestamp_formats", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END AS iso,
       strftime(ts, '%Y-%m-%d') AS from_us, strftime(ts, '%Y-%m-%d') AS from_text,
       strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S') AS from_millis
FROM events
""")
def _(t):
    ts = F.col("ts")
    millis = F.unix_millis(ts.cast("timestamp"))
    us = dates.any_date(F.date_format(ts, "MM/dd/yyyy"), "MM/dd/yyyy")
    spelled = dates.any_date(F.date_format(ts, "MMM d, yyyy"), "MM/dd/yyyy", "MMM d, yyyy")
    return t.events.select(
        "event_id", dates.stamp_text(ts).alias("stamp"), dates.iso_text(ts).alias("iso"),
        dates.crawl_date_text(us).alias("from_us"), dates.crawl_date_text(spelled).alias("from_text"),
        dates.stamp_text(dates.from_epoch_millis(millis)).alias("from_millis"))


# ---- text -----------------------------------------------------------------

@query("fn12_slug", r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[^0-9A-Za-z_\s-]', '', 'g'), '^\s+|\s+$', '', 'g'),
       '[-\s]+', '-', 'g') AS slug FROM documents
""")
def _(t):
    return t.documents.select("doc_id", text.slug(F.col("text")).alias("slug"))


@query("fn13_normal_term", r"""
SELECT doc_id, regexp_replace(lower(regexp_replace(regexp_replace(text, '[^\x00-\x7F]+', '', 'g'), '\p{P}', '', 'g')),
       '^\s+|\s+$', '', 'g') AS term FROM documents
""")
def _(t):
    return t.documents.select("doc_id", text.normal_term(F.col("text")).alias("term"))


@query("fn14_term_in_title", r"""
WITH p AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Ring, small!' WHEN 1 THEN p_name WHEN 2 THEN '¡Red!' ELSE 'rod  HOT' END AS term,
                  '«' || upper(p_name) || '» by ' || p_brand AS title FROM part),
n AS (SELECT p_partkey,
        regexp_replace(lower(regexp_replace(regexp_replace(term, '[^\x00-\x7F]+', '', 'g'), '\p{P}', '', 'g')), '^\s+|\s+$', '', 'g') AS term,
        regexp_replace(lower(regexp_replace(regexp_replace(title, '[^\x00-\x7F]+', '', 'g'), '\p{P}', '', 'g')), '^\s+|\s+$', '', 'g') AS title FROM p)
SELECT p_partkey, contains(title, term) AS exactly,
       list_has_all(regexp_split_to_array(title, '\s+'), regexp_split_to_array(term, '\s+')) AS partial, false AS interleaved FROM n
""")
def _(t):
    kind = F.col("p_size") % 4
    term = (F.when(kind == 0, "Ring, small!").when(kind == 1, F.col("p_name")).when(kind == 2, "¡Red!").otherwise("rod  HOT"))
    title = F.concat(F.lit("«"), F.upper("p_name"), F.lit("» by "), F.col("p_brand"))
    return t.part.select("p_partkey", *[c.alias(n) for n, c in text.term_in_title(term, title).items()])


@query("set4_word_subset", r"""
WITH m AS (SELECT doc_id, regexp_split_to_array(lower(text), '\s+') AS w FROM documents)
SELECT doc_id, list_has_all(w, ['the', 'of']) AS has_terms FROM m
""")
def _(t):
    return t.documents.select("doc_id", text.words_within(F.lit("of the"), F.lower("text")).alias("has_terms"))


@query("fn15_text_between", """
SELECT page_id, CASE WHEN strpos(html, '<title>') > 0 AND strpos(split_part(html, '<title>', 2), '</title>') > 0
         THEN split_part(split_part(html, '<title>', 2), '</title>', 1) ELSE '' END AS title, '' AS missing FROM pages
""")
def _(t):
    return t.pages.select("page_id", text.between(F.col("html"), "<title>", "</title>").alias("title"),
                          text.between(F.col("html"), "<h2>", "</h2>").alias("missing"))


_UNESCAPE_SQL = ("replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), "
                 "'&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')")


@query("fn16_clean_markup", r"""
WITH a AS (SELECT page_id, regexp_replace(html, '<a href.*?>(.*?)</a>', '\1', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(h, '(<[0-9A-Za-z_]+)[^>]*?(/?>)', '\1\2', 'g') AS h FROM a),
c AS (SELECT page_id, replace(replace(regexp_replace(h, '</?div>|</?span>', '', 'g'), chr(65533), ''), '&nbsp;', ' ') AS h FROM b)
SELECT page_id, regexp_replace(%s, '^\s+|\s+$', '', 'g') AS cleaned, regexp_replace(h, '<[^>]*>', '', 'g') <> '' AS has_text FROM c
""" % _UNESCAPE_SQL.format("h"))
def _(t):
    return t.pages.select("page_id", text.clean_markup(F.col("html")).alias("cleaned"), text.has_text(F.col("html")).alias("has_text"))


@query("fn17_whitespace", r"""
SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS collapsed,
       regexp_replace(regexp_replace(text, '[\n\t\r]', '', 'g'), '^\s+|\s+$', '', 'g') AS one_line FROM documents
""")
def _(t):
    return t.documents.select("doc_id", text.collapse_spaces(F.col("text")).alias("collapsed"),
                              text.drop_line_controls(F.col("text")).alias("one_line"))


@query("fn18_descriptions", r"""
WITH src AS (
  SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
a AS (SELECT page_id, title, regexp_replace(regexp_replace(body, '<a href.*?>(.*?)</a>', '\1', 'g'),
        '(<[0-9A-Za-z_]+)[^>]*?(/?>)', '\1\2', 'g') AS h FROM src),
b AS (SELECT page_id, title, regexp_replace(regexp_replace(replace(replace(%s, chr(65533), ''), '&nbsp;', ' '),
        '</?div>|</?span>', '', 'g'), '^\s+|\s+$', '', 'g') AS d FROM a),
c AS (SELECT page_id, d, split_part(title, ',', 1) AS nm,
        regexp_extract(d, '(?s)(<b>|<strong>)[^<]*(</b>|</strong>)[(<br>)\s":]*(</p>)?(<br>)*(<ul>|<li>)') AS block FROM b
      WHERE d <> '' AND NOT ends_with(d, '...')),
e AS (SELECT page_id, d, block, strpos(d, '<b>' || nm) - 1 AS pb, strpos(d, '<strong>' || nm) - 1 AS ps FROM c),
f AS (SELECT page_id, d, pb, ps, (pb >= 0 OR ps >= 0 OR block <> '') AS named,
        CASE WHEN pb < 0 AND ps < 0 AND block <> '' THEN strpos(d, block) - 1 END AS pn FROM e),
g AS (SELECT page_id, d, least(CASE WHEN pb >= 0 THEN pb END, CASE WHEN ps >= 0 THEN ps END, pn,
        CASE WHEN strpos(d, '<h3>') > 0 THEN strpos(d, '<h3>') - 1 END,
        CASE WHEN NOT named AND strpos(d, '<dl>') > 0 THEN strpos(d, '<dl>') - 1 END,
        CASE WHEN NOT named AND strpos(d, '<ul>') > 0 THEN strpos(d, '<ul>') - 1 END,
        CASE WHEN NOT named AND strpos(d, '<li>') > 0 THEN strpos(d, '<li>') - 1 END) AS ep FROM f),
h AS (SELECT *, coalesce(ep, length(d)) AS kept FROM g),
ps AS (SELECT page_id, max(CASE WHEN p <= 1000 THEN p END) AS near, min(p) AS first_p FROM (
        SELECT page_id, kept, CAST(length(list_aggregate(list_slice(string_split(d, '<p>'), 1, i), 'string_agg', '<p>')) AS BIGINT) AS p
        FROM h, unnest(range(1, len(string_split(d, '<p>')))) AS r(i)) WHERE p + 3 <= kept GROUP BY page_id),
z AS (SELECT h.page_id, d, CASE WHEN kept > 1000 AND first_p IS NOT NULL THEN coalesce(near, first_p) ELSE ep END AS cut
      FROM h LEFT JOIN ps USING (page_id)),
y AS (SELECT page_id, CASE WHEN cut > 0 THEN substr(d, 1, cut) ELSE d END AS short_description,
        CASE WHEN cut > 0 THEN substr(d, cut + 1) END AS long_description FROM z)
SELECT page_id, short_description, long_description FROM src LEFT JOIN y USING (page_id)
""" % _UNESCAPE_SQL.format("h"))
def _(t):
    df = t.pages.select("page_id", text.between(F.col("html"), "<title>", "</title>").alias("title"),
                        F.regexp_extract("html", r"(?s)<article>(.*)</article>", 1).alias("body"),
                        F.lit(None).cast("string").alias("none"))
    return text.choose_descriptions(df, short=["none", "body"], long=["none"]).select(
        "page_id", "short_description", "long_description")


@query("fn19_ingredient_lists", r"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'No' ELSE text END AS txt FROM documents)
SELECT doc_id,
       array_to_string(list_transform(regexp_extract_all(txt, '(?:[^,(]+|\([^)]*\))+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), ' | ') AS kept_parens,
       array_to_string(list_filter(list_transform(string_split(regexp_replace(txt, '[()]', ',', 'g'), ','),
         lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), ' | ') AS flat,
       CASE WHEN lower(txt) <> 'no' AND txt <> '' THEN
         array_to_string(list_transform(string_split(txt, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), ' | ') END AS unless_no
FROM d
""")
def _(t):
    txt = F.when(F.col("doc_id") % 7 == 0, "No").otherwise(F.col("text"))
    show = lambda c: F.array_join(c, " | ")
    return t.documents.select("doc_id", show(text.ingredients_outside_parens(txt)).alias("kept_parens"),
                              show(text.ingredients_flat(txt)).alias("flat"),
                              show(text.ingredients_unless_no(txt)).alias("unless_no"))


@query("fn20_department_path", """
SELECT p_partkey, p_brand || '>' || p_type || '>' || CAST(p_size AS VARCHAR) AS trail,
       CAST(p_size AS VARCHAR) AS leaf FROM part
""")
def _(t):
    raw = F.concat_ws("|", F.lit("Home"), "p_brand", "p_type", F.col("p_size").cast("string"))
    path = text.department_path(raw)
    return t.part.select("p_partkey", F.array_join(path, ">").alias("trail"), F.element_at(path, -1).alias("leaf"))


@query("fn30_plain_text", r"""
SELECT page_id, regexp_replace(%s, '<[^>]*>', '', 'g') AS plain FROM pages
""" % _UNESCAPE_SQL.format("html"))
def _(t):
    return t.pages.select("page_id", text.plain_text(F.col("html")).alias("plain"))


@query("fil11_low_stock", r"""
SELECT doc_id, regexp_matches(text || CASE WHEN doc_id % 3 = 0 THEN ' Only ' || CAST(doc_id AS VARCHAR) || ' left!' ELSE '' END,
       'Only\s*[0-9]+\s*left!') AS low_stock FROM documents
""")
def _(t):
    note = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" Only "), F.col("doc_id").cast("string"), F.lit(" left!"))).otherwise("")
    return t.documents.select("doc_id", flags.low_stock(F.concat("text", note)).alias("low_stock"))


# ---- flags ----------------------------------------------------------------

@query("fn25_large_image_flags", """
SELECT p_partkey, CAST(p_size * 20 >= 500 OR (51 - p_size) * 20 >= 500 AS INTEGER) AS either_side,
       CAST(p_size * 20 >= 500 AND (51 - p_size) * 20 >= 500 AS INTEGER) AS both_sides FROM part
""")
def _(t):
    w, h = F.col("p_size") * 20, (F.lit(51) - F.col("p_size")) * 20
    return t.part.select("p_partkey", flags.large_either(w, h).alias("either_side"), flags.large_both(w, h).alias("both_sides"))


@query("fn26_boolean_text", """
WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
v AS (SELECT event_id, CASE k % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'False' WHEN 4 THEN CAST(k AS VARCHAR) END AS v FROM e)
SELECT event_id, coalesce(v IN ('True', 'true', '1'), false) AS flag,
       CASE WHEN v IN ('True', 'true') THEN 'true' WHEN v = 'False' THEN 'false' ELSE v END AS folded FROM v
""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("bigint")
    v = (F.when(k % 6 == 0, "True").when(k % 6 == 1, "true").when(k % 6 == 2, "1").when(k % 6 == 3, "False")
         .when(k % 6 == 4, k.cast("string")))
    folded = flags.option_values(F.create_map(F.lit("summary"), v))
    return t.events.select("event_id", flags.text_flag(v).alias("flag"), F.element_at(folded, "summary").alias("folded"))


@query("fn29_availability_codes", """
WITH o AS (
  SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n,
         count(*) AS c, max(l_linestatus) AS top_status, min(l_linestatus) AS low_status FROM lineitem GROUP BY 1)
SELECT l_orderkey, a > 0 AS site_online, CASE WHEN a > 0 THEN n = 0 END AS site_online_out_of_stock,
       a > 0 AND n > 0 AS in_stock, top_status = 'O' AS in_stores,
       CASE WHEN top_status = 'O' THEN a + n = 0 END AS in_stores_out_of_stock,
       (c > 6) OR (low_status = 'F' AND a = 0 AND n = 0) AS basket_out_of_stock
FROM o
""")
def _(t):
    o = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.col("l_returnflag") == "N").alias("n"),
        F.count("*").alias("c"), F.max("l_linestatus").alias("top"), F.min("l_linestatus").alias("low"))
    network = flags.network_availability(
        F.when(F.col("a") > 0, "AVAILABLE").otherwise("UNAVAILABLE"),
        F.when(F.col("n") > 0, "IN_STOCK").otherwise("OUT_OF_STOCK"))
    spots = F.array(F.when(F.col("a") > 0, "IN_STOCK").otherwise("NOT_SOLD_IN_STORE"),
                    F.when(F.col("n") > 0, "LIMITED").otherwise("OUT_OF_STOCK"))
    store = flags.store_availability(F.when(F.col("top") == "O", "IN_STOCK").otherwise("OUT_OF_STOCK"), spots)
    closed = (F.col("a") == 0) & (F.col("n") == 0)
    code = F.when(closed, "NO").otherwise("YES")
    basket = flags.basket_out_of_stock(F.col("c") > 6, F.when(F.col("low") == "F", "onlineOnly"), code,
                                       F.when(closed, "NA").otherwise("YES"), code)
    return o.select("l_orderkey", *[v.alias(k) for k, v in {**network, **store}.items()], basket.alias("basket_out_of_stock"))


@query("fil10_in_stock", """
SELECT l_orderkey, l_linenumber, l_suppkey,
       NOT coalesce(CASE l_returnflag WHEN 'N' THEN 'OUT_OF_STOCK' WHEN 'R' THEN 'RETIRED' END, '') IN ('OUT_OF_STOCK', 'RETIRED') AS in_stock
FROM lineitem
""")
def _(t):
    status = F.when(F.col("l_returnflag") == "N", "OUT_OF_STOCK").when(F.col("l_returnflag") == "R", "RETIRED")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", flags.in_stock(status).alias("in_stock"))


# ---- projections ----------------------------------------------------------

@query("prj1_conditional_set", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN p_brand END AS old,
                  CASE WHEN p_size % 2 = 0 THEN p_name END AS new FROM part)
SELECT p_partkey, coalesce(old, upper(new), upper(p_partkey::VARCHAR)) AS kept FROM p
""")
def _(t):
    old = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.col("p_brand"))
    new = F.when(F.col("p_size") % 2 == 0, F.col("p_name"))
    kept = select.first_set(old, new, F.col("p_partkey").cast("string"), conv=F.upper)
    return t.part.select("p_partkey", kept.alias("kept"))


@query("prj6_leaf_department", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_type WHEN p_size % 5 = 1 THEN p_brand ELSE split_part(p_name, ' ', 2) END AS department
FROM part
""")
def _(t):
    explicit = F.when(F.col("p_size") % 5 == 0, F.col("p_type"))
    path = F.when(F.col("p_size") % 5 == 1, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return t.part.select("p_partkey", select.leaf_department(explicit, path, F.col("p_brand")).alias("department"))


@query("prj7_bullet_columns", "SELECT doc_id, " + ", ".join(
    f"string_split(text, chr(10))[{i}] AS bullet_feature_{i}" for i in range(1, 21)) + """,
    len(string_split(text, chr(10))) AS bullet_feature_count FROM documents""")
def _(t):
    columns = text.bullet_columns(F.col("text"))
    columns["bullet_feature_count"] = columns["bullet_feature_count"].cast("bigint")
    return t.documents.select("doc_id", *[c.alias(n) for n, c in columns.items()])


@query("prj8_first_image", """
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS urls FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'main.jpg' ELSE urls[1] END AS image_url FROM l
""")
def _(t):
    urls = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    given = F.when(F.col("page_id") % 3 == 0, "main.jpg").when(F.col("page_id") % 3 == 1, "")
    return t.pages.select("page_id", select.main_image(given, urls).alias("image_url"))


_TASK_TYPE_SQL = "CASE o_orderkey % 3 WHEN 0 THEN 'url' WHEN 1 THEN 'shelf' ELSE 'search' END"


def _task_type():
    k = F.col("o_orderkey") % 3
    return F.when(k == 0, "url").when(k == 1, "shelf").otherwise("search")


@query("prj10_secondary_id", f"""
SELECT o_orderkey, CASE WHEN {_TASK_TYPE_SQL} = 'shelf' THEN
  coalesce(CASE WHEN o_orderstatus = 'F' THEN 'sku-' || o_custkey::VARCHAR END, o_orderkey::VARCHAR) END AS secondary_id FROM orders
""")
def _(t):
    sku = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("sku-"), F.col("o_custkey").cast("string")))
    return t.orders.select("o_orderkey", select.secondary_id(_task_type(), sku, F.col("o_orderkey").cast("string")).alias("secondary_id"))


@query("prj11_result_kind", f"SELECT o_orderkey, {_TASK_TYPE_SQL} = 'url' AS is_single_result FROM orders")
def _(t):
    return t.orders.select("o_orderkey", select.is_single_result(_task_type()).alias("is_single_result"))
