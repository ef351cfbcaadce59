"""Image files as a Spark data source: ``spark.read.format("image_files")``.

A plan names the files of each task; it is made by Spark, in shares of equal
bytes, and stored. The reader looks at one small row a task when it plans, and
each task streams its own part of the listing. Filters on path and length are
taken over by the source: tasks without a matching file are not started, and
files that do not match are not opened.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from lumenframe.session import work_dir
from lumenframe.sources.files import OPEN_BYTES, TASK_BYTES, folder_entries, list_images, locate, read_file, task_numbers

FORMAT = "image_files"
LISTED = "path string, length long, modificationTime timestamp"
READ = f"{LISTED}, content binary, fetch_error string"
_LISTED = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])
_READ = pa.schema([*_LISTED, ("content", pa.binary()), ("fetch_error", pa.string())])

#: What a filter asks of a value.
TESTS: dict[type, Callable] = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v,
}


@dataclass(frozen=True)
class Condition:
    """A filter on one column, as the tasks get it."""

    column: str
    kind: type
    value: object

    def holds(self, path: str, length: int | None) -> bool:
        found = path if self.column == "path" else length
        return found is not None and TESTS[self.kind](found, self.value)

    def may_hold(self, first: str, last: str) -> bool:
        """Whether a path from ``first`` to ``last`` can pass."""
        if self.column != "path":
            return True
        if self.kind is EqualTo:
            return first <= self.value <= last
        if self.kind is In:
            return any(first <= v <= last for v in self.value if v is not None)
        if self.kind is StringStartsWith:
            return first[: len(self.value)] <= self.value <= last[: len(self.value)]
        if self.kind in (GreaterThan, GreaterThanOrEqual):
            return TESTS[self.kind](last, self.value)
        if self.kind in (LessThan, LessThanOrEqual):
            return TESTS[self.kind](first, self.value)
        return True


@dataclass
class Task(InputPartition):
    """Files of one task: a file of the stored plan, or the files themselves."""

    listing: str | None
    files: list[tuple[str, int | None, int | None]]


def plan_images(spark: SparkSession, listing: DataFrame, task_bytes: int = TASK_BYTES, least: int | None = None) -> str:
    """Store a plan for a listing (``path``, ``length``, ``modificationTime``); returns its folder."""
    folder = work_dir(spark, "plan")
    numbered, n = task_numbers(listing.select("path", "length", "modificationTime"), task_bytes, least)
    ordered = numbered.repartitionById(n, "task").sortWithinPartitions("path").select("path", "length", "modificationTime")
    ordered.write.option("parquet.block.size", 8 << 20).parquet(f"{folder}/files")
    stored = spark.read.parquet(f"{folder}/files").withColumn("listing", F.col("_metadata.file_path"))
    tasks = stored.groupBy("listing").agg(F.min("path").alias("first"), F.max("path").alias("last"), F.sum("length").alias("bytes"), F.count("*").alias("files"))
    tasks.coalesce(1).write.parquet(f"{folder}/tasks")  # one row a task
    return folder


def _parquet(path: str) -> Iterator[pa.RecordBatch]:
    fs, inner, _ = locate(path)
    with fs.open_input_file(inner) as source:
        yield from pq.ParquetFile(source).iter_batches(10_000)


class ImageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], content: bool):
        self.options, self.content = dict(options), content
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in TESTS and f.attribute in (("path",), ("length",)) and f.value is not None:
                self.conditions.append(Condition(f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Task]:
        plan = self.options.get("plan")
        tasks = list(self._stored(plan)) if plan else list(self._walked(self.options["path"]))
        return tasks or [Task(None, [])]

    def _stored(self, plan: str) -> Iterator[Task]:
        fs, inner, prefix = locate(f"{plan}/tasks")
        names = [f.path for f in fs.get_file_info(_selector(inner)) if f.path.endswith(".parquet")]
        for name in names:
            for batch in _parquet(prefix + name):
                for row in batch.to_pylist():
                    if all(c.may_hold(row["first"], row["last"]) for c in self.conditions):
                        yield Task(row["listing"], [])

    def _walked(self, base: str) -> Iterator[Task]:
        """Without a plan: one process lists the folder and cuts it into tasks."""
        suffix, most = self.options.get("suffix", ".dcm").lower(), int(self.options.get("task_bytes", TASK_BYTES))
        found, folders = [], [base]
        while folders:
            for path, length, time, is_folder in folder_entries(folders.pop()):
                if is_folder:
                    folders.append(path)
                elif path.lower().endswith(suffix) and all(c.holds(path, length) for c in self.conditions):
                    found.append((path, length, time))
        part, size = [], 0
        for row in sorted(found):
            weight = (row[1] or 0) + OPEN_BYTES
            if part and size + weight / 2 > most:
                yield Task(None, part)
                part, size = [], 0
            part.append(row)
            size += weight
        if part:
            yield Task(None, part)

    def _files(self, task: Task) -> Iterator[tuple]:
        if task.listing is None:
            yield from task.files
            return
        for batch in _parquet(task.listing):
            times = batch.column("modificationTime").cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_pylist()
            yield from zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), times, strict=True)

    def read(self, task: Task) -> Iterator[pa.RecordBatch]:
        chosen = (f for f in self._files(task) if all(c.holds(f[0], f[1]) for c in self.conditions))
        # one image at a time, so that memory holds one image and not a batch of them
        while rows := list(islice(chosen, 1 if self.content else 10_000)):
            if self.content:
                rows = [(*row, *_content(row[0])) for row in rows]
            schema = _READ if self.content else _LISTED
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _content(path: str) -> tuple[bytes | None, str | None]:
    try:
        return read_file(path), None
    except Exception as e:
        return None, str(e)


def _selector(folder: str):
    from pyarrow.fs import FileSelector

    return FileSelector(folder)


class ImageFiles(DataSource):
    """Options: ``path`` or ``plan``; ``content`` (true: read the files, false: list them); ``suffix``, ``task_bytes`` without a plan."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _content(self) -> bool:
        return self.options.get("content", "true").lower() == "true"

    def schema(self) -> str:
        return READ if self._content() else LISTED

    def reader(self, schema: StructType) -> ImageReader:
        return ImageReader(self.options, self._content())


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ImageFiles)


def image_source(spark: SparkSession, base: str | None = None, listing: DataFrame | None = None, content: bool = True, task_bytes: int = TASK_BYTES, least: int | None = None) -> DataFrame:
    """The image files below ``base``, or those of a listing, through the data source and a plan made by Spark."""
    register(spark)
    files = list_images(spark, base) if listing is None else listing
    if "modificationTime" not in files.columns:
        files = files.withColumn("modificationTime", F.lit(None).cast("timestamp"))
    plan = plan_images(spark, files, task_bytes, least)
    return spark.read.format(FORMAT).options(plan=plan, content=str(content).lower()).load()
