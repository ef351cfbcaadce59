"""The four stages over a folder of images, each written once and read back by the next."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.operators.images import preprocess_images, thumbnails
from lumenframe.operators.quality import require_columns, require_positive, require_rows
from lumenframe.operators.reports import REQUIRED, build_reports
from lumenframe.operators.runs import EVENT_SCHEMA, SUCCESS_MESSAGE
from lumenframe.operators.scoring import LinearHead, Model, score
from lumenframe.operators.summaries import good_reports
from lumenframe.sources.dicom import decode_table, image_files, preprocess_files, score_files
from lumenframe.sources.files import carried
from lumenframe.sources.snapshots import BATCH, RUN, read_latest, read_run, write_batches, write_snapshot

STAGES = ("dicom", "preprocessed", "inference", "reports")
NEEDED = {
    "preprocessed": ["path", "image_data_bytes", "image_shape", "image_dtype"],
    "inference": ["path", "tensor", "tensor_shape"],
    "reports": REQUIRED,
}
# Stages without pixels or tensors, cheap to even out before they are written.
SMALL_ROWS = ("inference", "reports")
ERROR_OF = {
    "dicom": "decode_error",
    "preprocessed": "preprocess_error",
    "inference": "inference_error",
    "reports": "report_path",
}


@dataclass(frozen=True)
class Settings:
    """What a run does; ``keep`` names the stages whose snapshots are written.

    Leaving out ``dicom`` and ``preprocessed`` saves writing pixels and tensors,
    and runs decode, preprocessing and scoring as one pass over the files. For
    ``through_spark`` see ``image_files``. With ``thumbnails`` (``max``, ``minmax`` or
    ``depth``) reports carry the image for display, at most ``thumbnail_side`` wide and
    high; that needs the ``dicom`` snapshot, from which they are made.
    """

    model: LinearHead | Model
    size: tuple[int, int] = (224, 224)
    scale: str = "minmax"
    layout: str = "full"
    naming: str = "path"
    keep: tuple[str, ...] = STAGES
    through_spark: bool = False
    thumbnails: str | None = None
    thumbnail_side: int = 256
    clock: Callable[[], datetime] = field(default=lambda: datetime.now(timezone.utc))


def generated_at(run_ts: str) -> Column:
    """Time of a run, from its ``yyyyMMddHHmmss`` name."""
    return F.to_timestamp(F.lit(run_ts), "yyyyMMddHHmmss")


def stage_plans(settings: Settings, run_ts: str) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Each stage as a function of the one before; the first takes files.

    What is not kept is not handed on either: without the ``dicom`` snapshot the
    pixels, and without the ``preprocessed`` one the tensors, never leave the
    task that made them.
    """
    image = (settings.size, settings.scale)
    plans: dict[str, Callable[[DataFrame], DataFrame]] = {}
    if "dicom" in settings.keep:
        plans["dicom"] = decode_table
        plans["preprocessed"] = lambda df: preprocess_images(df, *image)
    elif "preprocessed" in settings.keep:
        plans["preprocessed"] = lambda df: preprocess_files(df, *image)
    if "preprocessed" in plans:
        plans["inference"] = lambda df: score(df, settings.model)
    else:
        plans["inference"] = lambda df: score_files(df, settings.model, *image)
    plans["reports"] = lambda df: build_reports(df, generated_at(run_ts), settings.layout, settings.naming, keep=tuple(carried(df)))
    return plans


def _counts(written: DataFrame, stage: str) -> dict[str, int]:
    """Rows and failures of a written stage, from one column of it.

    Counting the stored rows stays exact when a lost executor makes Spark run
    tasks of the stage again, which an observed metric would count twice.
    """
    error = F.col(ERROR_OF[stage])
    bad = error.isNull() if stage == "reports" else error.isNotNull()
    return written.agg(F.count("*").alias("total"), F.count_if(bad).alias("failed")).first().asDict()


def with_thumbnails(reports: DataFrame, images: DataFrame, settings: Settings) -> DataFrame:
    """Reports with ``thumbnail`` (``rows``, ``cols``, ``pixels``), null where there is no image."""
    small = thumbnails(images, settings.thumbnails, settings.thumbnail_side)
    return reports.join(small.select("path", F.struct("rows", "cols", "pixels").alias("thumbnail")), "path", "left")


def check_settings(settings: Settings) -> None:
    unknown = set(settings.keep) - set(STAGES)
    if unknown or "reports" not in settings.keep:
        raise ValueError(f"keep must hold 'reports' and only names of {STAGES}")
    if settings.thumbnails and "dicom" not in settings.keep:
        raise ValueError("thumbnails are made from the 'dicom' snapshot, which keep must name")


def run_stages(
    spark: SparkSession, files: DataFrame, out: str, settings: Settings, run_ts: str, batch: int | None = None
) -> dict[str, dict[str, int]]:
    """Take files, listed or with their content, through all stages; returns the counts of the written ones."""
    check_settings(settings)
    counts: dict[str, dict[str, int]] = {}
    current, images = files, None
    for stage, plan in stage_plans(settings, run_ts).items():
        current = plan(current)
        if stage not in settings.keep:
            continue
        if stage == "reports" and settings.thumbnails:
            current = with_thumbnails(current, images, settings)
        if stage in SMALL_ROWS:
            # a task turns many megabytes of images into a few kilobytes of results:
            # without this the stage would be one tiny file per input split
            current = current.hint("rebalance")
        target = write_snapshot(current, f"{out.rstrip('/')}/{stage}", run_ts, batch)
        current = spark.read.schema(current.schema).parquet(target)
        images = current if stage == "dicom" else images
        counts[stage] = _counts(current, stage)
    return counts


def run_slices_stages(spark: SparkSession, files: DataFrame, out: str, settings: Settings, run_ts: str, numbers: range) -> dict[int, int]:
    """Take the listed files of several slices (``batch``) through all stages at once; each slice has its own snapshots.

    Returns the stored reports of each slice.
    """
    check_settings(settings)
    current, done = files, {}
    for stage, plan in stage_plans(settings, run_ts).items():
        current = plan(current)
        if stage not in settings.keep:
            continue
        if stage in SMALL_ROWS:
            current = current.hint("rebalance", F.col(BATCH))
        folders = write_batches(current, f"{out.rstrip('/')}/{stage}", run_ts, numbers)
        current = spark.read.option("basePath", f"{out.rstrip('/')}/{stage}/{RUN}={run_ts}").schema(current.schema).parquet(*folders)
        done = current.groupBy(BATCH).count()
    sizes = {r[BATCH]: r["count"] for r in done.collect()}  # one row a slice
    return {n: sizes.get(n, 0) for n in numbers}


def run_stage(spark: SparkSession, out: str, stage: str, settings: Settings, run_ts: str) -> DataFrame:
    """Run one stage on the newest snapshot of the stage before it, as a job of its own.

    Fails on a missing or empty snapshot, and names every missing column of one
    written by something else.
    """
    if stage not in STAGES[1:]:
        raise ValueError(f"stage must be one of {STAGES[1:]}, not {stage!r}")
    source = f"{out.rstrip('/')}/{STAGES[STAGES.index(stage) - 1]}"
    newest = read_latest(spark, source)
    require_columns(newest, NEEDED[stage])
    require_rows(newest, source)
    result = stage_plans(replace(settings, keep=STAGES), run_ts)[stage](newest.drop(RUN, "batch"))
    if stage in SMALL_ROWS:
        result = result.hint("rebalance")
    write_snapshot(result, f"{out.rstrip('/')}/{stage}", run_ts)
    return read_run(spark, f"{out.rstrip('/')}/{stage}", run_ts)


def run_reports(spark: SparkSession, out: str, settings: Settings, run_ts: str) -> DataFrame:
    """Reports of the newest scored run; returns those that have a usable path."""
    return good_reports(run_stage(spark, out, "reports", settings, run_ts))


def event(
    run_ts: str, event_id: int, now: datetime, status: str, message: str, processed: int = 0, total: int = 0, batch: int = 0
) -> tuple:
    """One row of the run event table."""
    progress = 100.0 * processed / total if total else 0.0
    return run_ts, now, event_id, status, message, progress, processed, total, batch


def append_events(spark: SparkSession, out: str, *rows: tuple) -> None:
    """Rows of the run event table, in one file."""
    spark.createDataFrame(list(rows), EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/run_events")


def append_event(
    spark: SparkSession, out: str, run_ts: str, event_id: int, now: datetime, status: str, message: str,
    processed: int = 0, total: int = 0, batch: int = 0,
) -> None:
    append_events(spark, out, event(run_ts, event_id, now, status, message, processed, total, batch))


def run_pipeline(
    spark: SparkSession,
    src: str,
    out: str,
    settings: Settings,
    run_ts: str,
    max_images: int | None = None,
    batch_size: int | None = None,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Run all stages over the image files below ``src`` and return the reports of the run.

    ``listing`` (``path``, ``length``) names the files instead of ``src``;
    ``max_images`` takes the first so many by path. With ``batch_size`` they are
    cut into slices of that many, with an event for each slice, and a stopped run
    goes on behind its last whole slice.
    """
    require_positive(max_images=max_images, batch_size=batch_size)
    if not re.fullmatch("[0-9]{14}", run_ts):
        raise ValueError(f"run_ts must be yyyyMMddHHmmss, not {run_ts!r}")
    steps = 1
    append_event(spark, out, run_ts, 0, settings.clock(), "running", "Pipeline started")
    try:
        if batch_size is None:
            files = image_files(spark, src, max_images, listing, settings.through_spark)
            counts = {**run_stages(spark, files, out, settings, run_ts)["reports"], "slices": 1}
        else:
            from lumenframe.streaming.incremental import run_incremental

            def progress(slices: list[tuple[int, int, int]]) -> None:
                nonlocal steps
                rows = [
                    event(run_ts, steps + k, settings.clock(), "running", f"Processed batch {batch}", done, total, batch)
                    for k, (done, total, batch) in enumerate(slices)
                ]
                append_events(spark, out, *rows)
                steps += len(rows)

            files = image_files(spark, src, max_images, listing)
            counts = run_incremental(spark, files, out, settings, run_ts, batch_size, progress)
    except Exception as e:
        append_event(spark, out, run_ts, steps, settings.clock(), "error", f"Pipeline failed: {e}")
        raise
    done = counts["total"]
    append_event(
        spark, out, run_ts, steps, settings.clock(), "completed", SUCCESS_MESSAGE, done, done, counts["slices"]
    )
    return read_run(spark, f"{out.rstrip('/')}/reports", run_ts)
