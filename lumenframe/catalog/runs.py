"""Run bookkeeping queries: users stand for jobs, event types for states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.registry import query, table
from lumenframe.operators import runs
from lumenframe.session import work_dir
from lumenframe.streaming.incremental import run_available
from lumenframe.streaming.run_state import expired_stream, latest_stream

AS_OF = "2024-01-30 23:00:00"


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run events; ``k`` of the properties is the current batch."""
    status = (
        F.when(F.col("event_type") == "purchase", F.lit("completed")).when(F.col("event_type") == "error", F.lit("error"))
    ).otherwise(F.lit("running"))
    batch = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        "event_id",
        status.alias("status"),
        F.concat(F.lit("event "), F.col("event_type")).alias("message"),
        F.col("value").alias("progress"),
        F.lit(None).cast("long").alias("processed"),
        (F.col("event_id") % 500).alias("total"),
        batch.alias("current_batch"),
    )


def as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz").cast("timestamp")


EVENTS = """
ev AS (SELECT user_id::VARCHAR AS job_id, ts AS event_ts, event_id,
       CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'error' ELSE 'running' END AS status,
       'event ' || event_type AS message, value AS progress, event_id % 500 AS total,
       json_extract_string(props, '$.k')::BIGINT AS current_batch FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY event_ts DESC, event_id DESC) AS rn
           FROM ev) WHERE rn = 1)"""


@query(f"WITH {EVENTS} SELECT job_id, event_id, status, message, progress, total, current_batch FROM latest")
def run_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_latest(run_events(spark, sf_dir)).select(
        "job_id", "event_id", "status", "message", "progress", "total", "current_batch"
    )


def jobs_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("job_id"))


@query(f"""WITH {EVENTS} SELECT c_custkey::VARCHAR AS job_id, coalesce(status, 'idle') AS status,
CASE WHEN status IS NULL THEN 'Job not found.' ELSE message END AS message
FROM customer LEFT JOIN latest ON job_id = c_custkey::VARCHAR""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_status(run_events(spark, sf_dir), jobs_asked(spark, sf_dir))


@query(f"""WITH {EVENTS} SELECT c_custkey::VARCHAR AS job_id, coalesce(status, 'idle') <> 'running' AS may_start
FROM customer LEFT JOIN latest ON job_id = c_custkey::VARCHAR""")
def run_may_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_may_start(run_events(spark, sf_dir), jobs_asked(spark, sf_dir))


OLD = f"status IN ('completed', 'error') AND date_diff('microsecond', event_ts, TIMESTAMP '{AS_OF}') > 3600000000"


@query(f"WITH {EVENTS} SELECT job_id, event_id, status FROM latest WHERE {OLD}")
def run_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_expired(run_events(spark, sf_dir), as_of()).select("job_id", "event_id", "status")


@query(f"WITH {EVENTS} SELECT job_id, event_id, status FROM latest WHERE NOT ({OLD})")
def run_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_retained(run_events(spark, sf_dir), as_of()).select("job_id", "event_id", "status")


@query(f"""WITH {EVENTS}, span AS (SELECT job_id, min(event_ts) AS s, max(event_ts) AS e FROM ev GROUP BY job_id)
SELECT job_id, status, progress, epoch_us(s) AS start_us, epoch_us(e) AS last_us FROM latest JOIN span USING (job_id)""")
def run_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_listing(run_events(spark, sf_dir)).select(
        "job_id", "status", "progress",
        F.unix_micros("start_time").alias("start_us"), F.unix_micros("last_update").alias("last_us"),
    )


@query(f"""WITH {EVENTS} SELECT count(*) AS total_jobs, count(*) FILTER (status = 'running') AS running,
count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'error') AS failed FROM latest""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_summary(run_events(spark, sf_dir))


@query(f"""WITH {EVENTS}, p AS (SELECT *, ceil(total / 7::DOUBLE)::BIGINT AS batches, least(current_batch * 7, total) AS processed FROM ev)
SELECT job_id, event_id, current_batch, total, batches, processed,
round(CASE WHEN total = 0 THEN NULL ELSE processed::DOUBLE / total * 100 END, 6) AS progress,
'Processing batch ' || current_batch || ' of ' || batches || ' (' || processed || '/' || total || ' images)' AS message FROM p""")
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = runs.run_progress(run_events(spark, sf_dir), F.lit(7))
    return done.withColumn("progress", F.round("progress", 6))


@query("""WITH l AS (SELECT event_id, CASE event_type WHEN 'view' THEN '  PROGRESS: batch ' || value || '  '
    WHEN 'signup' THEN 'INFO Starting pipeline for ' || user_id WHEN 'purchase' THEN 'Pipeline completed successfully'
    ELSE 'WARN ' || props END AS line, event_type FROM events)
SELECT event_id, CASE event_type WHEN 'view' THEN 'progress' WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'success' ELSE 'touch' END AS kind,
  CASE event_type WHEN 'view' THEN trim(replace(line, 'PROGRESS:', '')) WHEN 'signup' THEN 'Initializing Spark pipeline...'
    WHEN 'purchase' THEN 'Pipeline completed successfully!' END AS message,
  CASE WHEN event_type = 'purchase' THEN 100.0::DOUBLE END AS progress FROM l""")
def run_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(F.lit("  PROGRESS: batch "), F.col("value").cast("string"), F.lit("  ")))
        .when(kind == "signup", F.concat(F.lit("INFO Starting pipeline for "), F.col("user_id").cast("string")))
        .when(kind == "purchase", F.lit("Pipeline completed successfully"))
        .otherwise(F.concat(F.lit("WARN "), F.col("props")))
    )
    logged = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    return runs.parse_run_log(logged).select("event_id", "kind", "message", "progress")


#: Files that a slice of events has, if it has enough rows.
SLICE_FILES = 16


def _event_files(spark: SparkSession, sf_dir: str, label: str, slices: int = 3) -> tuple[DataFrame, str, str]:
    """Run events as a stream of files that arrive in time order, a slice a batch, with an output and a checkpoint folder.

    Every slice has the same number of files, or a batch would take files of several slices,
    or some of a slice whose others then come later than the watermark allows.
    """
    folder = work_dir(spark, label)
    source = f"{folder}/in"
    events = run_events(spark, sf_dir)
    first, last = events.agg(F.unix_micros(F.min("event_ts")), F.unix_micros(F.max("event_ts"))).first()
    width = (last - first) // slices + 1
    number = F.floor((F.unix_micros("event_ts") - first) / width)
    sizes = events.where(number.between(0, slices - 1)).groupBy(number.alias("n")).count().collect()
    least = min(r["count"] for r in sizes) if len(sizes) == slices else 0
    # a task deals its rows out in turn, so one with as many rows as there are files leaves none without rows
    files = max(1, min(SLICE_FILES, least // events.rdd.getNumPartitions()))
    for n in range(slices):
        events.where(number == n).repartition(files).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(source)
    return stream, f"{folder}/out", f"{folder}/checkpoint"


def _save_to(out: str):
    return lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}")


@query(f"WITH {EVENTS} SELECT job_id, event_id, status FROM latest")
def run_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest state per job from a stream of event files; the last update of each job counts."""
    stream, out, checkpoint = _event_files(spark, sf_dir, "run-latest")
    run_available(latest_stream(stream), _save_to(out), checkpoint, "update")
    return runs.run_latest(spark.read.parquet(out)).select("job_id", "event_id", "status")


RAN_OUT = f"""WITH {EVENTS}, top AS (SELECT max(event_ts) AS newest FROM ev),
following AS (SELECT *, lead(event_ts) OVER (PARTITION BY job_id ORDER BY event_ts, event_id) AS next_ts FROM ev)
SELECT job_id, status, epoch_us(event_ts) AS last_us FROM following, top WHERE status IN ('completed', 'error')
  AND CASE WHEN next_ts IS NULL THEN date_diff('millisecond', event_ts, newest) > 7200000
      ELSE date_diff('microsecond', event_ts, next_ts) > 3600000000 END"""


def _ran_out(spark: SparkSession, sf_dir: str, slices: int) -> DataFrame:
    stream, out, checkpoint = _event_files(spark, sf_dir, f"run-expired-{slices}", slices)
    run_available(expired_stream(stream), _save_to(out), checkpoint)
    return spark.read.parquet(out).select("job_id", "status", F.unix_micros("last_update").alias("last_us"))


@query(RAN_OUT)
def run_expired_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time that a finished job ran out: it said nothing for an hour, and a watermark of one hour has passed or it reports again."""
    return _ran_out(spark, sf_dir, 3)


@query(RAN_OUT)
def run_expired_stream_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from twelve slices of events instead of three."""
    return _ran_out(spark, sf_dir, 12)
