"""Run bookkeeping over an append-only table of run events.

An event has ``job_id``, ``event_ts``, ``event_id`` (unique, breaks ties of
time), ``status``, ``message``, ``progress``, ``processed``, ``total`` and
``current_batch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.times import batch_count, older_than, processed_after, progress_percent
from lumenframe.operators.lookups import latest_by

EVENT_SCHEMA = (
    "job_id string, event_ts timestamp, event_id long, status string, message string, "
    "progress double, processed long, total long, current_batch long"
)
# Messages, and the words in a log line that call for them.
NOT_FOUND = "Job not found."
PROGRESS_MARK = "PROGRESS:"
START_MARK, START_MESSAGE = "Starting pipeline", "Initializing Spark pipeline..."
SUCCESS_MARK, SUCCESS_MESSAGE = "Pipeline completed successfully", "Pipeline completed successfully!"
# End states, and seconds they are kept.
FINISHED = ("completed", "error")
TTL_S = 3600


def run_latest(events: DataFrame, *columns: str) -> DataFrame:
    """Newest event of each job, with all its fields or only ``columns`` and the time and id."""
    kept = events.select("job_id", "event_ts", "event_id", *columns) if columns else events
    return latest_by(kept, "job_id", ["event_ts", "event_id"])


def run_status(events: DataFrame, jobs: DataFrame) -> DataFrame:
    """State of each asked-for job; one without events is ``idle``."""
    state = jobs.select("job_id").join(run_latest(events, "status", "message").select("job_id", "status", "message"), "job_id", "left")
    return state.select(
        "job_id",
        F.coalesce("status", F.lit("idle")).alias("status"),
        F.when(F.col("status").isNull(), F.lit(NOT_FOUND)).otherwise(F.col("message")).alias("message"),
    )


def is_expired(as_of: Column, status: Column, last_update: Column, ttl_s: int = TTL_S) -> Column:
    return status.isin(*FINISHED) & older_than(as_of, last_update, ttl_s)


def run_expired(events: DataFrame, as_of: Column, ttl_s: int = TTL_S) -> DataFrame:
    """Finished jobs without an update for longer than ``ttl_s`` seconds."""
    return run_latest(events).where(is_expired(as_of, F.col("status"), F.col("event_ts"), ttl_s))


def run_retained(events: DataFrame, as_of: Column, ttl_s: int = TTL_S) -> DataFrame:
    return run_latest(events).where(~is_expired(as_of, F.col("status"), F.col("event_ts"), ttl_s))


def run_listing(events: DataFrame) -> DataFrame:
    """Status, progress, first and last event time of each job."""
    last = F.max_by(F.struct("status", "progress"), F.struct("event_ts", "event_id")).alias("_s")
    return events.groupBy("job_id").agg(
        last, F.min("event_ts").alias("start_time"), F.max("event_ts").alias("last_update")
    ).select(
        "job_id", "_s.status", F.coalesce("_s.progress", F.lit(0.0)).alias("progress"), "start_time", "last_update"
    )


def run_summary(events: DataFrame) -> DataFrame:
    """How many jobs there are, by their newest state."""
    status = F.col("status")
    return run_latest(events, "status").agg(
        F.count("*").alias("total_jobs"),
        F.count_if(status == "running").alias("running"),
        F.count_if(status == "completed").alias("completed"),
        F.count_if(status == "error").alias("failed"),
    )


def run_may_start(events: DataFrame, jobs: DataFrame) -> DataFrame:
    """Whether a job may start: only if its newest state is not ``running``."""
    return run_status(events, jobs).select("job_id", (F.col("status") != "running").alias("may_start"))


def run_progress(events: DataFrame, batch_size: Column) -> DataFrame:
    """Batch totals, processed images and percentage from ``current_batch`` and ``total``."""
    batch, total = F.col("current_batch"), F.col("total")
    done = processed_after(batch, batch_size, total)
    batches = batch_count(total, batch_size)
    message = F.concat(
        F.lit("Processing batch "), batch.cast("string"), F.lit(" of "), batches.cast("string"),
        F.lit(" ("), done.cast("string"), F.lit("/"), total.cast("string"), F.lit(" images)"),
    )
    return events.select(
        "job_id", "event_id", "current_batch", "total",
        batches.alias("batches"),
        done.alias("processed"),
        progress_percent(batch, batch_size, total).alias("progress"),
        message.alias("message"),
    )


def parse_run_log(lines: DataFrame) -> DataFrame:
    """Log lines → event updates; lines that say nothing new only touch the update time."""
    line = F.regexp_replace("line", r"^\s+|\s+$", "")
    progress = F.contains(line, F.lit(PROGRESS_MARK))
    starting = F.contains(line, F.lit(START_MARK))
    finished = F.contains(line, F.lit(SUCCESS_MARK))
    stripped = F.regexp_replace(F.replace(line, F.lit(PROGRESS_MARK), F.lit("")), r"^\s+|\s+$", "")
    kind = (
        F.when(progress, F.lit("progress")).when(starting, F.lit("start")).when(finished, F.lit("success"))
    ).otherwise(F.lit("touch"))
    return lines.withColumns(
        {
            "kind": kind,
            "message": F.when(progress, stripped)
            .when(starting, F.lit(START_MESSAGE))
            .when(finished, F.lit(SUCCESS_MESSAGE)),
            "progress": F.when(~progress & ~starting & finished, F.lit(100.0)),
        }
    )
