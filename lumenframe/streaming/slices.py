"""Slices of a stored listing as a stream: ``spark.readStream.format("listing_slices")``.

A plan is an append-only listing, cut into numbered slices of files. The stream
hands out one slice a micro-batch, or a run of slices that are waiting; its offset
is the number of the next one, so a restarted query goes on where its checkpoint
says, and slices that were added to the plan meanwhile follow. What passes
through the driver are numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from lumenframe.operators.quality import require_positive
from lumenframe.operators.ranks import file_batches
from lumenframe.sources.files import locate

FORMAT = "listing_slices"
LISTED = "path string, length long"


def _numbers(plan: str) -> list[int]:
    """Slices that a plan had after each addition: the names of its log."""
    fs, inner, _ = locate(f"{plan}/log")
    found = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return sorted(int(f.base_name) for f in found if f.base_name.isdigit())


def planned_slices(plan: str) -> int:
    """Number of slices of a plan; those of an addition that broke off do not count."""
    return max(_numbers(plan), default=0)


def slice_files(spark: SparkSession, plan: str, n: int) -> DataFrame:
    """``path``, ``length`` of a slice, counted from 0."""
    return spark.read.schema(LISTED).parquet(f"{plan}/listing/batch={n}")


def slices_files(spark: SparkSession, plan: str, numbers: range) -> DataFrame:
    """``path``, ``length``, ``batch`` of a run of slices; the folders of others are not listed."""
    folders = [f"{plan}/listing/batch={n}" for n in numbers]
    return spark.read.option("basePath", f"{plan}/listing").schema(f"{LISTED}, batch long").parquet(*folders)


def planned_files(spark: SparkSession, plan: str) -> DataFrame:
    """``path``, ``length``, ``batch`` of all slices of a plan."""
    n = planned_slices(plan)
    if not n:
        return spark.createDataFrame([], f"{LISTED}, batch long")
    return spark.read.schema(f"{LISTED}, batch long").parquet(f"{plan}/listing").where(F.col("batch") < n)


def add_slices(spark: SparkSession, plan: str, listing: DataFrame, batch_size: int) -> int:
    """Append the files of a listing that the plan lacks, in slices by path; returns the number of slices of the plan.

    Slices of an addition that broke off are written over. A slice is one file.
    """
    require_positive(batch_size=batch_size)
    first = planned_slices(plan)
    files = listing.select("path", "length")
    if first:
        files = files.join(planned_files(spark, plan).select("path"), "path", "left_anti")
    cut = file_batches(files, batch_size, "path").withColumn("batch", F.col("batch") - 1 + first)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartitionById(parts, (F.col("batch") % parts).cast("int"))
    dealt.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("batch").parquet(f"{plan}/listing")
    last = cut.agg(F.max("batch")).first()[0]
    added = first if last is None else last + 1
    fs, inner, _ = locate(f"{plan}/log")
    fs.create_dir(inner, recursive=True)
    fs.open_output_stream(f"{inner}/{added}").close()
    return added


class SliceReader(SimpleDataSourceStreamReader):
    def __init__(self, plan: str, most: int = 1):
        self.plan, self.most = plan, most

    def initialOffset(self) -> dict:
        return {"slice": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"slice": min(start["slice"] + self.most, planned_slices(self.plan))}
        if end["slice"] <= start["slice"]:
            return iter(()), start
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(n, f"{self.plan}/listing/batch={n}") for n in range(start["slice"], end["slice"])])


class ListingSlices(DataSource):
    """Option ``path``: the plan; ``most``: how many slices a micro-batch may have (1)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "slice long, listing string"

    def simpleStreamReader(self, schema: StructType) -> SliceReader:
        return SliceReader(self.options["path"], int(self.options.get("most", "1")))


def run_slices(spark: SparkSession, plan: str, handle: Callable[[int, DataFrame], None], checkpoint: str) -> None:
    """Hand every slice that the checkpoint does not have yet to ``handle``, one after the other, and stop.

    A slice is handed over again if the query broke off before it was done; what ``handle`` writes must replace itself.
    """
    run_slices_together(spark, plan, lambda numbers: handle(numbers[0], slice_files(spark, plan, numbers[0])), checkpoint, 1)


def run_slices_together(spark: SparkSession, plan: str, handle: Callable[[range], None], checkpoint: str, most: int) -> None:
    """The same with the numbers of up to ``most`` waiting slices at a time."""
    spark.dataSource.register(ListingSlices)

    def each(batch: DataFrame, _: int) -> None:
        numbers = sorted(row["slice"] for row in batch.select("slice").collect())  # ``most`` at most
        if numbers:
            handle(range(numbers[0], numbers[-1] + 1))

    stream = spark.readStream.format(FORMAT).option("most", most).load(plan)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
