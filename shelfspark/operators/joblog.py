"""Job outcomes and the first-value-wins job log (AGG13, AGG15, FIL1, FIL6).

Job events: job_id, ord, ts, event, value, latency; ``ord`` is the arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfspark.functions.flags import job_outcome
from shelfspark.functions.select import truthy
from shelfspark.operators.groups import first_by, first_values

# Causes and states in the job log.
REQUEST_DROPPED = "Request dropped"
NOT_SCRAPED = "Item not scraped"
FAILED, SUCCEEDED = "failed", "ok"

STARTED, FINISHED = "spider_opened", "spider_closed"
CAUSES = ("request_dropped", "item_dropped", "bucket_failed", "spider_error")


def fold_values() -> dict[str, Column]:
    """What the log keeps the first non-null value of."""
    event, value = F.col("event"), F.col("value")
    cause = F.when(event == "request_dropped", REQUEST_DROPPED).when(event.isin(*CAUSES), value)
    return {
        "proxy_service": F.when(event == "request_scheduled", F.coalesce(value, F.lit("none"))),
        "response_time": F.when(event == "response_received", F.col("latency")),
        "status_code": F.when(event == "response_received", value),
        "errors_traceback": F.when(event == "spider_error", value),
        "first_cause": cause,
        "uploaded_path": F.when(event == "bucket_uploaded", value),
    }


def fold_facts() -> dict[str, Column]:
    """Aggregates over all events of a job."""
    event = F.col("event")
    return {
        "scraped": F.coalesce(F.bool_or(event == "item_scraped"), F.lit(False)),
        "validation_failures": F.count_if(event == "item_dropped"),
        "started": F.min("ts"),
        "finished": F.max("ts"),
    }


def fold_columns(order: Column) -> dict[str, Column]:
    """Aggregates that fold the events of one job, for streams; ``job_log`` fetches its texts late."""
    return {n: first_by(v, order) for n, v in fold_values().items()} | fold_facts()


def settle(folded: DataFrame) -> DataFrame:
    """Status, cause, path and duration from folded columns."""
    cause = F.coalesce("first_cause", F.when(~F.col("scraped"), NOT_SCRAPED))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return folded.withColumns({
        "failure_cause": cause,
        "status": F.when(cause.isNotNull(), FAILED).otherwise(SUCCEEDED),
        "s3_filepath": F.when(cause.isNull(), F.col("uploaded_path")),
        "duration": (micros("finished") - micros("started")) / 1000000.0,
    }).drop("first_cause", "uploaded_path", "started", "finished")


def job_log(events: DataFrame) -> DataFrame:
    """One log record per job (AGG15)."""
    return settle(first_values(events, ["job_id"], fold_values(), "ord", fold_facts()))


def load_seconds(responses: DataFrame) -> DataFrame:
    """Total load time per item over all its responses (AGG13). ``responses``: item_id, latency (decimal)."""
    return responses.groupBy("item_id").agg(F.coalesce(F.sum("latency"), F.lit(0)).alias("loaded_in_seconds"))


def with_outcome(items: DataFrame) -> DataFrame:
    """Export status and failure type (FIL6)."""
    status, kind = job_outcome(F.col("invalid_url"), F.col("not_found"), F.col("redirect"), F.col("temporary_unavailable"))
    return items.withColumns({"status": status, "failure_type": kind})


EXEMPT_FLAGS = ("temporary_unavailable", "not_found", "no_longer_available", "redirect", "invalid_url")


def is_valid_item() -> Column:
    """False for a plain product run whose item has neither title nor image."""
    exempt = F.coalesce(F.col("task_type").isin("search", "shelf"), F.lit(False))
    for name in EXEMPT_FLAGS:
        exempt = exempt | F.coalesce(F.col(name), F.lit(False))
    return exempt | truthy(F.col("title"), "string").isNotNull() | truthy(F.col("image_url"), "string").isNotNull()


def validated(items: DataFrame, observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) items (FIL1). ``observation`` receives ``validation_failures_count``."""
    marked = items.withColumn("_valid", is_valid_item())
    if observation is not None:
        marked = marked.observe(observation, F.count_if(~F.col("_valid")).alias("validation_failures_count"))
    return marked.where("_valid").drop("_valid"), marked.where("NOT _valid").drop("_valid")
