"""Consecutive slices of a sorted listing, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.operators.quality import require_positive
from lumenframe.session import ensure_checkpoint_dir

# Row ids made by Spark hold the partition above this many bits.
ROW_BITS = 33


def global_rank(df: DataFrame, *order: str) -> DataFrame:
    """Append ``rank`` (from 1) in the order of ``order``, which must be unique per row.

    The rows are range-sorted once and checkpointed, so that the partition each
    row landed in stays fixed. Only the row count of each partition is then
    summed up front to back: one small row per partition, whatever the data size.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", ROW_BITS)
    local = F.col("_id") - F.shiftleft(part, ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumns({"_part": part, "_local": local})
        .join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_start") + F.col("_local") + 1)
        .drop("_id", "_part", "_local", "_start")
    )


def file_batches(df: DataFrame, batch_size: int, *order: str) -> DataFrame:
    """Append ``batch`` (from 1): consecutive slices of ``batch_size`` rows, the last one shorter."""
    require_positive(batch_size=batch_size)
    ranked = global_rank(df, *order)
    return ranked.withColumn("batch", F.floor((F.col("rank") - 1) / batch_size) + 1).drop("rank")
