"""Places of rows within their key, without one task for a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B


def placed(rows: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    """``rows`` with ``name``: how many rows of the same ``key`` come before in ``order`` (nulls first).

    One range sort deals the rows out, so that a key with many rows lies in
    several partitions in a row, and fixes that by a checkpoint. Rows are counted
    within their partition; only keys at the border of a partition, two of each,
    need the counts of the partitions before. Rows alike in key and order get
    places in any order.
    """
    dealt = rows.repartitionByRange(B.partitions(rows), *key, *order).withColumn("_part", F.spark_partition_id())
    dealt = B.checkpoint(dealt)
    whole = F.struct(*key)
    borders = dealt.groupBy("_part").agg(F.min(whole).alias("_lo"), F.max(whole).alias("_hi"))
    at_border = dealt.join(F.broadcast(borders), "_part").where(whole.eqNullSafe(F.col("_lo")) | whole.eqNullSafe(F.col("_hi")))
    before = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = at_border.groupBy("_part", *key).agg(F.count("*").alias("_n")).withColumn("_start", F.sum("_n").over(before)).where("_start > 0")
    starts = starts.select(F.col("_part").alias("_p"), F.struct(*key).alias("_k"), "_start")
    local = F.row_number().over(W.partitionBy("_part", *key).orderBy(*order)) - 1
    on = (F.col("_part") == F.col("_p")) & F.struct(*key).eqNullSafe(F.col("_k"))
    numbered = dealt.withColumn("_local", local).join(F.broadcast(starts), on, "left")
    return numbered.withColumn(name, F.col("_local") + F.coalesce("_start", F.lit(0))).drop("_part", "_local", "_start", "_p", "_k")
