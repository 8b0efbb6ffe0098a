"""Streaming queries (ST1-ST5) over the driver tables read as file streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfspark.operators import merge
from shelfspark.plans import intake
from shelfspark.plans.registry import query
from shelfspark.session import work_path
from shelfspark.streaming import fragments, jobs, leases, runs
from shelfspark.streaming import intake as stream_intake

FIELDS = ["title", "price"]
_END = "end"


def _stream(t, name):
    return runs.file_stream(t.spark, t.sf_dir, f"{name}.parquet", getattr(t, name).schema)


def fragment_rows(events):
    """Each event asks for one response; all but errors get one, sign-ups a failed one."""
    kind, k = F.col("event_type"), F.col("event_id")
    base = events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("guid"), "ts", k.cast("string").alias("fingerprint"),
        (k % 3 == 0).alias("initial"), (kind != "signup").alias("ok"), k.alias("seq"),
        F.when(kind == "click", F.concat(F.lit("title "), k.cast("string"))).alias("title"), F.when(F.col("value") > 20, F.col("value").cast("string")).alias("price"),
        F.when(kind == "error", F.array(F.lit("request"))).otherwise(F.array(F.lit("request"), F.lit("response"))).alias("kinds"))
    return base.select("*", F.explode("kinds").alias("kind")).drop("kinds")


_FRAGMENT_SQL = """f AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS guid, event_id, event_type, event_id % 3 = 0 AS initial,
  CASE WHEN event_type = 'click' THEN 'title ' || event_id END AS title, CASE WHEN value > 20 THEN value::VARCHAR END AS price FROM events),
g AS (SELECT guid, count(*) FILTER (WHERE event_type = 'error' OR (event_type = 'signup' AND initial)) AS outstanding,
  arg_min(title, event_id) FILTER (WHERE event_type NOT IN ('error', 'signup') AND title IS NOT NULL) AS title,
  arg_min(price, event_id) FILTER (WHERE event_type NOT IN ('error', 'signup') AND price IS NOT NULL) AS price FROM f GROUP BY 1)"""


@query("st1_stateful_fragment_merge", f"WITH {_FRAGMENT_SQL} SELECT guid, title, price FROM g WHERE outstanding = 0")
def _(t):
    out, state = work_path(t.spark, "fragments"), work_path(t.spark, "fragments-state")
    runs.drain_to_table(fragments.merged_stream(fragment_rows(_stream(t, "events")), FIELDS), out, state)
    return t.spark.read.parquet(out).where("complete").select("guid", *FIELDS)


@query("st1_leftovers", f"""WITH {_FRAGMENT_SQL}
SELECT guid, outstanding = 0 AS complete, outstanding::BIGINT AS outstanding, title, price FROM g""")
def _(t):
    """Requests, two shares of the answers and an end mark as separate runs of one stream; items without all answers leave incomplete."""
    rows = fragment_rows(t.events)
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return t.spark.createDataFrame([], f"guid string, complete boolean, outstanding bigint, {', '.join(f'{n} string' for n in FIELDS)}")
    span = int((last - first).total_seconds()) + 60
    answer = F.col("kind") == "response"
    end = t.spark.range(1).select(*[F.lit(v).cast(rows.schema[n].dataType).alias(n) for n, v in {
        "guid": _END, "ts": last + dt.timedelta(seconds=2 * span + 7200), "fingerprint": _END, "initial": False, "ok": True, "seq": 0, "kind": "request"}.items()])
    source, out, state = (work_path(t.spark, n) for n in ("fragments-in", "fragments", "fragments-state"))
    shares = [rows.where(~answer), rows.where(answer & F.col("initial")), rows.where(answer & ~F.col("initial")), end]
    for share in shares:
        rows.limit(0).unionByName(share, allowMissingColumns=True).write.mode("append").parquet(source)
        stream = runs.file_stream(t.spark, source, "*.parquet", rows.schema)
        # Answers may come as late as the whole table is long, and nobody is silent for longer.
        runs.drain_to_table(fragments.merged_stream(stream, FIELDS, silence=3600, delay=f"{span} seconds"), out, state)
    return t.spark.read.parquet(out).where(F.col("guid") != _END)


@query("st1_batch_twin", f"WITH {_FRAGMENT_SQL} SELECT guid, title, price FROM g WHERE outstanding = 0")
def _(t):
    rows = fragment_rows(t.events)
    items = merge.merged_items(rows.where("kind = 'request'"), rows.where("kind = 'response'"), FIELDS)
    return items.where("complete").select("guid", *FIELDS)


@query("st2_bounded_run", "SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1")
def _(t):
    out, state = work_path(t.spark, "drained"), work_path(t.spark, "drained-state")
    runs.drain_to_table(_stream(t, "events").select("event_id", "event_type"), out, state)
    return t.spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query("st3_streaming_job_log", intake.JOB_LOG_SQL)
def _(t):
    out, state = work_path(t.spark, "jobs"), work_path(t.spark, "jobs-state")
    jobs.run_job_log(intake.job_events(_stream(t, "events")), out, state)
    return jobs.settled_log(t.spark, out)


# Events of one user as renewals of one task, with a lease that fits their spacing.
_GAP_S = 36000
_SESSION_SQL = f"""r AS (SELECT user_id AS task_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= {_GAP_S}::BIGINT * 1000000 THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY task_id ORDER BY ts) AS n FROM r),
h AS (SELECT task_id, n, min(ts) AS a, max(ts) + to_seconds({_GAP_S}) AS b, count(*) AS renewals FROM s GROUP BY 1, 2)"""


def _renewals(events):
    return events.select(F.col("user_id").alias("task_id"), "ts")


@query("st4_lease_sessions", f"WITH {_SESSION_SQL} SELECT task_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS held_from, strftime(b, '%Y-%m-%d %H:%M:%S') AS held_until, renewals FROM h")
def _(t):
    text = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return leases.lease_sessions(_renewals(t.events), _GAP_S).select("task_id", text("held_from"), text("held_until"), "renewals")


@query("st4_redelivered_tasks", f"WITH {_SESSION_SQL} SELECT task_id, count(*) AS deliveries FROM h GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return leases.redelivered(leases.lease_sessions(_renewals(t.events), _GAP_S))


@query("st4_lease_sessions_stream", f"""WITH {_SESSION_SQL} SELECT task_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS held_from, renewals FROM h
WHERE epoch_us(b) <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 600000000 FROM events)""")
def _(t):
    out, state = work_path(t.spark, "leases"), work_path(t.spark, "leases-state")
    runs.drain_to_table(leases.lease_sessions(_renewals(_stream(t, "events")), _GAP_S, "10 minutes"), out, state)
    return t.spark.read.parquet(out).select("task_id", F.date_format("held_from", "yyyy-MM-dd HH:mm:ss").alias("held_from"), "renewals")


@query("st5_streaming_intake", intake.ORACLE_INTAKE)
def _(t):
    good, bad, state = (work_path(t.spark, n) for n in ("tasks", "rejects", "intake-state"))
    stream_intake.run_intake(intake.raw_messages(_stream(t, "orders")), intake.known_spiders(t), good, bad, state)
    accepted = t.spark.read.parquet(good).select("msg_id", "task_type", F.lit(None).cast("string").alias("reason"))
    return accepted.unionByName(t.spark.read.parquet(bad).select("msg_id", F.lit(None).cast("string").alias("task_type"), "reason"))
