"""Message, archive, merge, question and job queries (SRC1, FIL2, FN27, UDF4, JN1, JN14-JN18, SNK2, SRC2, SRC3, FIL7, WIN9, AGG13-AGG15, AGG22, FIL1, FIL6)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from shelfspark.functions import codes
from shelfspark.operators import archive, joblog, merge, messages, questions
from shelfspark.operators.stores import store_choice
from shelfspark.plans.registry import query

# ---- task messages --------------------------------------------------------

# Orders as task messages: the key decides dialect, fields and faults.
_MSG_SQL = """k AS (SELECT o_orderkey AS msg_id, o_orderkey AS k, o_orderpriority FROM orders),
f AS (SELECT *, CASE k % 4 WHEN 0 THEN 'ch' WHEN 1 THEN 'sc' WHEN 3 THEN 'xx' END AS fmt,
  CASE WHEN k % 3 <> 0 THEN 'https://shop.example/ip/' || k END AS url, CASE WHEN k % 3 = 0 OR k % 2 = 0 THEN o_orderpriority END AS term,
  CASE WHEN k % 5 = 0 THEN 'shop_shelf_urls' ELSE 'shop' || k % 3 END AS site, CASE WHEN k % 13 <> 0 THEN 'q' || k % 4 END AS queue,
  CASE WHEN k % 17 = 0 THEN 'number' WHEN k % 2 = 0 THEN 'text' END AS qty, CASE WHEN k % 19 = 0 THEN 'text' WHEN k % 3 = 1 THEN 'object' END AS args,
  CASE WHEN k % 6 = 0 THEN '2018-05-07' END AS crawl_date, k % 23 = 0 AS broken FROM k),
d AS (SELECT *, CASE WHEN broken THEN NULL WHEN fmt IN ('ch', 'sc') THEN fmt WHEN url IS NULL THEN 'sc' END AS dialect FROM f),
r AS (SELECT *, CASE WHEN broken THEN 'not_json' WHEN dialect IS NULL THEN 'unknown_dialect'
  WHEN dialect = 'ch' THEN CASE WHEN url IS NULL THEN 'url' WHEN queue IS NULL THEN 'result_queue' WHEN args = 'text' THEN 'cmd_args' END
  ELSE CASE WHEN (url IS NULL AND term IS NULL) OR (k % 5 = 0 AND url IS NULL) THEN 'url' WHEN qty = 'number' THEN 'quantity' WHEN queue IS NULL THEN 'result_queue'
    WHEN fmt IS NULL THEN 'response_format' WHEN args = 'text' THEN 'cmd_args' END END AS reject_reason FROM d)"""


def raw_messages(orders):
    k = F.col("o_orderkey")
    text = k.cast("string")
    fields = F.struct(
        F.when(k % 4 == 0, "ch").when(k % 4 == 1, "sc").when(k % 4 == 3, "xx").alias("response_format"),
        F.when(k % 3 != 0, F.concat(F.lit("https://shop.example/ip/"), text)).alias("url"),
        F.when((k % 3 == 0) | (k % 2 == 0), F.col("o_orderpriority")).alias("searchterms_str"),
        F.when(k % 5 == 0, "shop_shelf_urls").otherwise(F.concat(F.lit("shop"), (k % 3).cast("string"))).alias("site"),
        F.when(k % 13 != 0, F.concat(F.lit("q"), (k % 4).cast("string"))).alias("result_queue"),
        F.when((k % 17 != 0) & (k % 2 == 0), "20").alias("quantity"),
        F.when(k % 6 == 0, "2018-05-07").alias("crawl_date"),
        F.concat(F.lit("t"), text).alias("task_id"))
    head = F.regexp_replace(F.to_json(fields), r"\}$", "")
    number = F.when(k % 17 == 0, ',"quantity":20').otherwise("")
    args = F.when(k % 19 == 0, ',"cmd_args":"oops"').when(k % 3 == 1, ',"cmd_args":{"quantity":"7","summary":true}').otherwise("")
    body = F.when(k % 23 == 0, "not json {").otherwise(F.concat(head, number, args, F.lit("}")))
    return orders.select(k.alias("msg_id"), F.col("o_orderdate").alias("ts"), body.alias("body"))


def _checked(t):
    return messages.checked(messages.routed(raw_messages(t.orders)))


@query("src1_message_routing", f"WITH {_MSG_SQL} SELECT msg_id, dialect, NOT broken AS readable FROM r")
def _(t):
    return messages.routed(raw_messages(t.orders)).select("msg_id", "dialect", "readable")


@query("fil2_message_validity", f"WITH {_MSG_SQL} SELECT msg_id, reject_reason FROM r")
def _(t):
    return _checked(t).select("msg_id", "reject_reason")


_TASKS_SQL = f"""{_MSG_SQL}, v AS (SELECT *, dialect = 'sc' AND k % 5 = 0 AS shelf FROM r WHERE reject_reason IS NULL),
tasks AS (SELECT msg_id, dialect, site, queue, 't' || k AS task_id, CASE WHEN NOT shelf THEN url END AS url, CASE WHEN shelf THEN url END AS shelf_url,
  CASE WHEN dialect = 'sc' THEN term END AS search_term, CASE WHEN dialect = 'sc' THEN CASE WHEN args = 'object' THEN '7' WHEN qty = 'text' THEN '20' END END AS quantity,
  CASE WHEN dialect = 'sc' AND k % 5 = 0 THEN 'shop' ELSE site END || '_products' AS spider,
  CASE WHEN args = 'object' THEN 'true' END AS opt_summary, CASE WHEN dialect = 'sc' THEN crawl_date END AS opt_date FROM v)"""


def _tasks(t):
    valid, _ = messages.split_valid(_checked(t))
    return messages.tasks(valid)


@query("fn27_message_rewrite", f"""WITH {_TASKS_SQL} SELECT msg_id, dialect, site, url, shelf_url, search_term, quantity, spider, opt_summary, opt_date,
  CASE WHEN shelf_url IS NOT NULL THEN 'shelf' WHEN search_term IS NOT NULL THEN 'search' ELSE 'url' END AS task_type FROM tasks""")
def _(t):
    opt = lambda n: F.try_element_at("options", F.lit(n))
    return _tasks(t).select("msg_id", "dialect", "site", "url", "shelf_url", "search_term", "quantity", "spider",
                            opt("summary").alias("opt_summary"), opt("crawl_date").alias("opt_date"), "task_type")


@query("udf4_extra_dialect", f"WITH {_MSG_SQL} SELECT msg_id, CASE WHEN NOT broken AND fmt = 'xx' THEN 'xx' ELSE dialect END AS dialect, coalesce(NOT broken AND fmt = 'xx' AND queue IS NULL, false) AS missing_queue FROM r")
def _(t):
    extra = replace(messages.DIALECTS["ch"], rules=lambda: {"result_queue": F.col("m.result_queue").isNotNull()})
    dialects = {**messages.DIALECTS, "xx": extra}
    rows = messages.checked(messages.routed(raw_messages(t.orders), dialects), dialects)
    missing = (F.col("dialect") == "xx") & (F.col("reject_reason") == "result_queue")
    return rows.select("msg_id", "dialect", F.coalesce(missing, F.lit(False)).alias("missing_queue"))


_RESULTS_SQL = f"""{_TASKS_SQL}, res AS (SELECT l_orderkey AS msg_id, CASE WHEN max(l_linenumber) > 3 THEN 'out/' || l_orderkey || '.jl' END AS key FROM lineitem GROUP BY 1),
j AS (SELECT t.*, CASE WHEN spider IN ('shop_products', 'shop0_products', 'shop1_products') THEN key END AS okey FROM tasks t LEFT JOIN res USING (msg_id))"""


def results_of(lineitem):
    top = F.max("l_linenumber")
    key = F.concat(F.lit("out/"), F.col("msg_id").cast("string"), F.lit(".jl"))
    return lineitem.groupBy(F.col("l_orderkey").alias("msg_id")).agg(top.alias("_top")).select("msg_id", F.when(F.col("_top") > 3, key).alias("bucket_key"))


def known_spiders(t):
    return t.region.where("r_regionkey < 3").select(F.when(F.col("r_regionkey") == 2, "shop_products").otherwise(
        F.concat(F.lit("shop"), F.col("r_regionkey").cast("string"), F.lit("_products"))).alias("spider"))


def result_messages_of(t):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    return messages.result_messages(_tasks(t), results_of(t.lineitem), known_spiders(t), "results", now)


ORACLE_INTAKE = f"""WITH {_TASKS_SQL} SELECT msg_id, CASE WHEN spider IN ('shop_products', 'shop0_products', 'shop1_products') THEN
  CASE WHEN shelf_url IS NOT NULL THEN 'shelf' WHEN search_term IS NOT NULL THEN 'search' ELSE 'url' END END AS task_type,
  CASE WHEN spider NOT IN ('shop_products', 'shop0_products', 'shop1_products') THEN 'unknown_spider' END AS reason FROM tasks
  UNION ALL SELECT msg_id, NULL, reject_reason FROM r WHERE reject_reason IS NOT NULL"""
ORACLE_SNK2_FILES = f"""WITH {_RESULTS_SQL} SELECT queue, count(*) AS n, count(*) FILTER (WHERE dialect = 'sc' AND okey IS NOT NULL) AS successes FROM j GROUP BY 1"""


@query("jn18_task_results", f"WITH {_RESULTS_SQL} SELECT msg_id, queue, okey IS NOT NULL AS delivered FROM j")
def _(t):
    return result_messages_of(t).select("msg_id", "queue", "delivered")


@query("snk2_result_message_rows", f"""WITH {_RESULTS_SQL} SELECT msg_id, CAST(CASE
  WHEN dialect = 'sc' AND okey IS NOT NULL THEN json_object('msg_id', task_id, 'utc_datetime', '2024-01-01T12:00:00', 'status', 'success', 'site', site, 'url', coalesce(url, shelf_url), 'searchterms_str', search_term, 'bucket_name', 'results', 's3_key_data', okey)
  WHEN dialect = 'sc' THEN json_object('msg_id', task_id, 'utc_datetime', '2024-01-01T12:00:00', 'status', 'failure', 'site', site, 'url', coalesce(url, shelf_url), 'searchterms_str', search_term)
  WHEN okey IS NOT NULL THEN json_object('url', url, 'date', '2024-01-01 12:00:00', 'status', 'failure', 's3_filepath', okey, 'bucket_name', 'results', 'failure_type', 'Response too large')
  ELSE json_object('url', url, 'date', '2024-01-01 12:00:00', 'status', 'failure') END AS VARCHAR) AS value FROM j""")
def _(t):
    return result_messages_of(t).select("msg_id", "value")


# ---- fragments ------------------------------------------------------------

@query("jn1_fragment_merge", """WITH q AS (SELECT o_custkey AS guid, o_orderkey AS fp, o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) AS initial FROM orders),
a AS (SELECT o_custkey AS guid, l_orderkey AS fp, l_returnflag <> 'R' AS ok, l_orderkey * 1000000000 + l_linenumber * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) % 100000000 AS seq,
  CASE WHEN l_linestatus = 'F' THEN 'part ' || l_partkey END AS title, CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS price
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
s AS (SELECT guid, fp, bool_or(ok) AS any_ok FROM a GROUP BY 1, 2),
o AS (SELECT q.guid, count(*) AS requests, CAST(sum(CASE WHEN s.fp IS NULL OR (initial AND NOT any_ok) THEN 1 ELSE 0 END) AS BIGINT) AS outstanding FROM q LEFT JOIN s USING (guid, fp) GROUP BY 1),
m AS (SELECT guid, arg_min(title, seq) FILTER (WHERE title IS NOT NULL) AS title, CAST(arg_min(price, seq) FILTER (WHERE price IS NOT NULL) AS DOUBLE) AS price FROM a WHERE ok GROUP BY 1)
SELECT guid, requests, outstanding, title, price, outstanding = 0 AS complete FROM o LEFT JOIN m USING (guid)""")
def _(t):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    requested = t.orders.join(first, "o_custkey").select(F.col("o_custkey").alias("guid"), F.col("o_orderkey").alias("fingerprint"), (F.col("o_orderkey") == F.col("first")).alias("initial"))
    seq = F.col("l_orderkey") * 1000000000 + F.col("l_linenumber") * 100000000 + F.round(F.col("l_extendedprice") * 100).cast("bigint") % 100000000
    received = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("guid"), F.col("l_orderkey").alias("fingerprint"), (F.col("l_returnflag") != "R").alias("ok"), seq.alias("seq"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("title"),
        F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"))
    return merge.merged_items(requested, received, ["title", "price"]).withColumn("price", F.col("price").cast("double"))


# ---- archive --------------------------------------------------------------

_SITE_SQL = "replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', '')"


def _responses(t):
    k = F.col("page_id")
    return t.pages.select(
        "page_id", codes.domain(F.col("url")).alias("site"), F.sha1(F.col("url").cast("binary")).alias("fingerprint"), "url", F.col("html").alias("body"),
        F.when(k % 8 == 0, 404).when(k % 8 == 1, 500).when(k % 8 == 2, 201).otherwise(200).alias("status"),
        (k % 5 == 0).alias("cached"), (k % 7 == 0).alias("summary"))


_RESP_SQL = f"""resp AS (SELECT page_id, {_SITE_SQL} AS site, sha1(url) AS fingerprint, url, html, CASE page_id % 8 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN 201 ELSE 200 END AS status,
  page_id % 5 = 0 AS cached, page_id % 7 = 0 AS summary FROM pages)"""


@query("src2_archive_set_name", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN s_name WHEN 1 THEN s_name || '_products' END AS set_name FROM supplier""")
def _(t):
    name = F.col("s_name")
    spider = F.when(F.col("s_suppkey") % 3 == 0, F.concat(name, F.lit("_products"))).when(F.col("s_suppkey") % 3 == 1, F.concat(name, F.lit("_products_products"))).otherwise(name)
    return t.supplier.select("s_suppkey", archive.set_name(spider).alias("set_name"))


@query("src3_storable_responses", f"""WITH {_RESP_SQL}, old AS (SELECT fingerprint FROM resp WHERE page_id % 3 = 0)
SELECT page_id, fingerprint FROM resp WHERE status = 200 AND NOT cached AND fingerprint NOT IN (SELECT fingerprint FROM old)""")
def _(t):
    rows = _responses(t)
    return archive.not_stored(archive.storable(rows), rows.where("page_id % 3 = 0")).select("page_id", "fingerprint")


@query("fil7_archive_eligibility", f"WITH {_RESP_SQL} SELECT page_id, site FROM resp WHERE site IN ('blog.ththan.example.net', 'therha.example.com', 'therer.example.com') AND NOT summary")
def _(t):
    return archive.eligible(_responses(t), ["blog.ththan.example.net", "therha.example.com", "therer.example.com"]).select("page_id", "site")


@query("win9_last_writes", """WITH r AS (SELECT user_id::VARCHAR || '-' || event_type AS fingerprint, ts, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT fingerprint, event_id, value FROM r WHERE rn = 1""")
def _(t):
    puts = t.events.select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("fingerprint"), "event_id", "value", F.col("ts").alias("put_ts"))
    return archive.last_writes(puts, tie="event_id").select("fingerprint", "event_id", "value")


@query("jn14_archive_as_of", """WITH p AS (SELECT user_id, ts AS put_ts, CASE WHEN event_id % 4 <> 0 THEN 3600 * (1 + event_id % 90) END AS ttl_s FROM events WHERE event_type = 'signup'),
l AS (SELECT event_id AS lookup_id, user_id, ts, event_id % 6 = 0 AS never_expire FROM events WHERE event_type <> 'signup'),
j AS (SELECT l.*, put_ts, ttl_s FROM l ASOF LEFT JOIN p ON l.user_id = p.user_id AND l.ts >= p.put_ts)
SELECT lookup_id, strftime(put_ts, '%Y-%m-%d %H:%M:%S') AS put_at, CASE WHEN put_ts IS NOT NULL AND (ttl_s IS NULL OR ts < put_ts + to_seconds(ttl_s)) THEN 'hit'
  WHEN CAST(ts AS DATE) = DATE '2024-01-30' OR never_expire THEN 'fetch' ELSE 'expired' END AS outcome FROM j""")
def _(t):
    key = F.sha1(F.col("user_id").cast("string").cast("binary")).alias("fingerprint")
    ttl = F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 90 + 1) * 3600)
    puts = t.events.where("event_type = 'signup'").select(key, F.col("ts").alias("put_ts"), ttl.alias("ttl_s"))
    lookups = t.events.where("event_type <> 'signup'").select(F.col("event_id").alias("lookup_id"), key, "ts")
    found = archive.as_of(lookups, puts).withColumns({"crawl_date": F.col("ts").cast("date"), "never_expire": F.col("lookup_id") % 6 == 0})
    out = archive.lookup_outcome(found, F.lit("2024-01-30").cast("date"))
    return out.select("lookup_id", F.date_format("put_ts", "yyyy-MM-dd HH:mm:ss").alias("put_at"), "outcome")


@query("agg14_archive_statistics", f"""WITH {_RESP_SQL}, a AS (SELECT site, CASE WHEN cached THEN 'get' WHEN status = 200 THEN 'put' END AS op, strlen(url) + strlen(html) + 8 AS n FROM resp)
SELECT site, count(*) FILTER (WHERE op = 'get') AS get_count, CAST(coalesce(sum(n) FILTER (WHERE op = 'get'), 0) AS BIGINT) AS get_bytes,
  count(*) FILTER (WHERE op = 'put') AS put_count, CAST(coalesce(sum(n) FILTER (WHERE op = 'put'), 0) AS BIGINT) AS put_bytes FROM a GROUP BY 1""")
def _(t):
    op = F.when(F.col("cached"), "get").when(F.col("status") == 200, "put")
    rows = _responses(t).select("site", op.alias("op"), archive.stored_bytes(F.col("url"), F.col("body")).alias("n_bytes"), F.lit(1).alias("n_numbers"))
    return archive.statistics(rows)


# ---- questions ------------------------------------------------------------

_QA_SQL = """q AS (SELECT conv_id AS product_id, conv_id || '-' || turn AS question_id, turn // 2 AS page, turn % 2 AS pos FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id || '-' || (turn - 1) AS question_id, CASE WHEN turn % 4 = 1 THEN '  AgenT ' WHEN turn % 4 = 3 THEN 'other' END AS nickname FROM conversations WHERE role = 'assistant')"""


def _questions(t):
    c = t.conversations
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    turn = F.col("turn")
    q = c.where("role = 'user'").select(F.col("conv_id").alias("product_id"), name(turn).alias("question_id"), F.floor(turn / 2).alias("page"), (turn % 2).alias("pos"))
    a = c.where("role = 'assistant'").select(name(turn - 1).alias("question_id"), F.when(turn % 4 == 1, "  AgenT ").when(turn % 4 == 3, "other").alias("nickname"))
    return q, a


@query("jn16_unanswered_questions", f"WITH {_QA_SQL} SELECT product_id, count(*) AS questions_total, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.question_id = q.question_id)) AS questions_unanswered FROM q GROUP BY 1")
def _(t):
    return questions.unanswered_counts(*_questions(t))


@query("jn17_answered_by_user", f"WITH {_QA_SQL} SELECT question_id, EXISTS (SELECT 1 FROM a WHERE a.question_id = q.question_id AND lower(trim(nickname)) = 'agent') AS answered_by_username FROM q")
def _(t):
    return questions.with_answered_flag(*_questions(t), " Agent ").select("question_id", "answered_by_username")


@query("agg22_question_pages", f"WITH {_QA_SQL} SELECT product_id, question_id, row_number() OVER (PARTITION BY product_id ORDER BY page, pos) AS place FROM q")
def _(t):
    return questions.accumulated(_questions(t)[0]).select("product_id", "question_id", "place")


@query("jn15_store_by_postal_code", """WITH s AS (SELECT n_nationkey, n_regionkey, n_regionkey * 100 + n_nationkey AS pos, 'M' || n_nationkey || 'A ' || n_regionkey || 'b' AS postal, n_nationkey % 7 <> 6 AS is_store FROM nation),
z AS (SELECT n_regionkey, CASE WHEN s0.is_store THEN s0.n_nationkey END AS first_store FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY pos) AS rn FROM s) s0 WHERE rn = 1)
SELECT c_custkey, coalesce(CASE WHEN s.is_store THEN s.n_nationkey END, z.first_store) AS store_id FROM customer
LEFT JOIN z ON z.n_regionkey = c_custkey % 5 LEFT JOIN s ON s.n_regionkey = c_custkey % 5 AND s.is_store AND lower(replace(s.postal, ' ', '')) = 'm' || c_nationkey || 'a' || c_custkey % 5 || 'b'""")
def _(t):
    area, place = F.col("n_regionkey"), F.col("n_nationkey")
    stores = t.nation.select(
        area.alias("area"), (area * 100 + place).alias("pos"), place.alias("store_id"), (place % 7 != 6).alias("is_store"),
        F.concat(F.lit("M"), place.cast("string"), F.lit("A "), area.cast("string"), F.lit("b")).alias("postal_code"))
    wanted = t.customer.select(
        "c_custkey", (F.col("c_custkey") % 5).alias("area"),
        F.concat(F.lit("m"), F.col("c_nationkey").cast("string"), F.lit("a "), (F.col("c_custkey") % 5).cast("string"), F.lit("B")).alias("postal_code"))
    return store_choice(wanted, stores).select("c_custkey", "store_id")


# ---- jobs -----------------------------------------------------------------

# Events of one user and day as one job.
_EVENTS_SQL = """ev AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS job_id, event_id AS ord, ts, CASE event_type WHEN 'click' THEN 'request_scheduled' WHEN 'view' THEN 'response_received'
  WHEN 'purchase' THEN 'item_scraped' WHEN 'signup' THEN 'bucket_uploaded' ELSE CASE event_id % 4 WHEN 0 THEN 'request_dropped' WHEN 1 THEN 'item_dropped' WHEN 2 THEN 'bucket_failed' ELSE 'spider_error' END END AS event,
  CASE WHEN event_type <> 'click' OR event_id % 2 = 0 THEN event_type || '-' || event_id END AS value, value AS latency FROM events)"""


def job_events(events):
    kind, k = F.col("event_type"), F.col("event_id")
    error = F.when(k % 4 == 0, "request_dropped").when(k % 4 == 1, "item_dropped").when(k % 4 == 2, "bucket_failed").otherwise("spider_error")
    event = (F.when(kind == "click", "request_scheduled").when(kind == "view", "response_received").when(kind == "purchase", "item_scraped")
             .when(kind == "signup", "bucket_uploaded").otherwise(error))
    return events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("job_id"), k.alias("ord"), "ts", event.alias("event"),
        F.when((kind != "click") | (k % 2 == 0), F.concat_ws("-", kind, k.cast("string"))).alias("value"), F.col("value").alias("latency"))


JOB_LOG_SQL = f"""WITH {_EVENTS_SQL}, g AS (SELECT job_id, arg_min(coalesce(value, 'none'), ord) FILTER (WHERE event = 'request_scheduled') AS proxy_service,
  arg_min(latency, ord) FILTER (WHERE event = 'response_received') AS response_time, arg_min(value, ord) FILTER (WHERE event = 'response_received') AS status_code,
  arg_min(value, ord) FILTER (WHERE event = 'spider_error') AS errors_traceback,
  arg_min(CASE WHEN event = 'request_dropped' THEN 'Request dropped' ELSE value END, ord) FILTER (WHERE event IN ('request_dropped', 'item_dropped', 'bucket_failed', 'spider_error')) AS cause,
  arg_min(value, ord) FILTER (WHERE event = 'bucket_uploaded') AS path, bool_or(event = 'item_scraped') AS scraped, count(*) FILTER (WHERE event = 'item_dropped') AS validation_failures,
  epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM ev GROUP BY 1),
h AS (SELECT *, coalesce(cause, CASE WHEN NOT scraped THEN 'Item not scraped' END) AS failure_cause FROM g)
SELECT job_id, proxy_service, response_time, status_code, errors_traceback, scraped, validation_failures, failure_cause,
  CASE WHEN failure_cause IS NULL THEN 'ok' ELSE 'failed' END AS status, CASE WHEN failure_cause IS NULL THEN path END AS s3_filepath, us / 1000000.0::DOUBLE AS duration FROM h"""


@query("agg15_job_log", JOB_LOG_SQL)
def _(t):
    return joblog.job_log(job_events(t.events))


@query("agg13_load_seconds", "SELECT user_id AS item_id, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS loaded_in_seconds FROM events GROUP BY 1")
def _(t):
    rows = t.events.select(F.col("user_id").alias("item_id"), F.col("value").cast("decimal(12,2)").alias("latency"))
    return joblog.load_seconds(rows).withColumn("loaded_in_seconds", F.col("loaded_in_seconds").cast("double"))


@query("fil6_job_outcome", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'failure' ELSE 'success' END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Invalid url' WHEN o_orderkey % 7 = 0 THEN '404' WHEN o_orderkey % 11 = 0 THEN 'Redirect' WHEN o_orderkey % 3 = 0 THEN 'Temporary unavailable' END AS failure_type FROM orders""")
def _(t):
    k = F.col("o_orderkey")
    yes = lambda n: F.when(k % n == 0, True)
    items = t.orders.select("o_orderkey", yes(5).alias("invalid_url"), yes(7).alias("not_found"), yes(11).alias("redirect"), yes(3).alias("temporary_unavailable"))
    return joblog.with_outcome(items).select("o_orderkey", "status", "failure_type")


def validation_items(t):
    k = F.col("doc_id")
    docs = t.documents.join(t.labels, "doc_id", "left")
    return docs.select(
        k, F.when(F.col("quality") == 1, F.col("lang")).when(k % 2 == 0, "").alias("title"), F.when(F.col("toxic") == 1, F.col("source")).alias("image_url"),
        F.when(k % 6 == 0, "shelf").when(k % 6 == 1, "search").otherwise("url").alias("task_type"),
        *[F.when(k % n == 0, True).alias(name) for n, name in zip((13, 17, 19, 23, 29), joblog.EXEMPT_FLAGS)])


_VALID_SQL = """i AS (SELECT doc_id, coalesce(quality, 0) = 1 OR coalesce(toxic, 0) = 1 OR doc_id % 6 IN (0, 1) OR doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 OR doc_id % 29 = 0 AS ok
  FROM documents LEFT JOIN labels USING (doc_id))"""


@query("fil1_valid_items", f"WITH {_VALID_SQL} SELECT doc_id FROM i WHERE ok")
def _(t):
    return joblog.validated(validation_items(t))[0].select("doc_id")


@query("fil1_rejected_items", f"WITH {_VALID_SQL} SELECT doc_id FROM i WHERE NOT ok")
def _(t):
    return joblog.validated(validation_items(t))[1].select("doc_id")
