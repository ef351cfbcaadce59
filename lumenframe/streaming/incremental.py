"""Image files in slices of fixed size through all stages, and streams that run until done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.plans.stages import Settings, run_slices_stages, run_stages
from lumenframe.sources.files import spark_content
from lumenframe.sources.snapshots import complete_batches, mark_complete
from lumenframe.streaming.slices import add_slices, planned_files, run_slices_together, slice_files, slices_files

# Files of waiting slices that go through the stages together; a slice of more goes alone.
TOGETHER_FILES = 16_000


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Hand every waiting micro-batch to ``handle`` and stop; a restart goes on after the last one."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_incremental(
    spark: SparkSession,
    listing: DataFrame,
    out: str,
    settings: Settings,
    run_ts: str,
    batch_size: int,
    progress: Callable[[list[tuple[int, int, int]]], None] = lambda done: None,
) -> dict[str, int]:
    """All stages over the files of a listing (``path``, ``length``), in slices by path.

    The listing is stored with the run and read as a stream of slices, whose
    checkpoint lies beside it: a stopped run goes on behind its last whole slice,
    and files that its plan lacks form further slices. A slice whose reports
    are not whole, though it was done once, is done again. Waiting slices go through
    the stages together, up to ``TOGETHER_FILES`` files at a time, and are stored each for
    itself. ``progress`` then gets for each of them the files done, the files in all and the number of slices so far.
    """
    reports, plan = f"{out.rstrip('/')}/reports", f"{out.rstrip('/')}/_slices/run_ts={run_ts}"
    slices = add_slices(spark, plan, listing, batch_size)
    if not slices:
        run_stages(spark, listing.select("path", "length"), out, settings, run_ts, 0)
    sizes = planned_files(spark, plan).groupBy("batch").count()
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    whole = complete_batches(spark, reports, run_ts)
    done = sizes.where(F.col("batch").isin(whole)).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]

    # Spark's file source has the paths of a slice on the driver, and thumbnails are joined by path within a slice
    alone = settings.through_spark or settings.thumbnails
    together = 1 if alone else max(1, TOGETHER_FILES // batch_size)

    def handle(numbers: range) -> None:
        nonlocal done
        if alone:
            files = slice_files(spark, plan, numbers[0])
            chosen = spark_content(files) if settings.through_spark else files
            sizes = {numbers[0]: run_stages(spark, chosen, out, settings, run_ts, numbers[0])["reports"]["total"]}
        else:
            sizes = run_slices_stages(spark, slices_files(spark, plan, numbers), out, settings, run_ts, numbers)
        steps = []
        for n in numbers:
            done += sizes[n]
            steps.append((done, total, n + 1))
        progress(steps)

    run_slices_together(spark, plan, handle, f"{plan}/checkpoint", together)
    left = sorted(set(range(slices)) - set(complete_batches(spark, reports, run_ts)))
    while left:  # runs of neighbours
        n = next((k for k in range(1, min(together, len(left))) if left[k] != left[0] + k), min(together, len(left)))
        handle(range(left[0], left[0] + n))
        left = left[n:]
    for stage in settings.keep:
        mark_complete(spark, f"{out.rstrip('/')}/{stage}", run_ts)
    rows = spark.read.parquet(f"{reports}/run_ts={run_ts}")
    counts = rows.agg(F.count("*").alias("total"), F.count_if(F.col("report_path").isNull()).alias("failed")).first().asDict()
    return {**counts, "slices": slices}
