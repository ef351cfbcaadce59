"""File listings and whole-file reads and writes."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Collection, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.functions.text import base_name, has_suffix
from lumenframe.operators.quality import require_positive
from lumenframe.operators.ranks import global_rank
from lumenframe.session import ensure_checkpoint_dir, work_dir

DICOM_GLOB = "*.[dD][cC][mM]"
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Names that Hadoop has for a store, and the usual one.
STORES = {"s3a": "s3", "s3n": "s3"}
# Bytes of image files one task fetches.
TASK_BYTES = 256 << 20
# Bytes that could be read in the time it takes to open a file.
OPEN_BYTES = 64 << 10
# Names of one folder that one task lists.
FOLDER_NAMES = 20_000


def binary_files(spark: SparkSession, paths: str | list[str], pattern: str = DICOM_GLOB) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(paths)
    )


def list_images(spark: SparkSession, base: str, suffix: str = ".dcm", max_images: int | None = None) -> DataFrame:
    """Path, size and time of the image files below ``base``, the first ``max_images`` by path.

    Zero-byte files are listed too. ``None`` and 0 mean no cap; no file is opened.
    """
    files = walk_files(spark, base).where(has_suffix(F.col("path"), suffix))
    if not max_images:
        return files
    return first_files(files, max_images)


def spark_listing(spark: SparkSession, base: str, suffix: str = ".dcm") -> DataFrame:
    """The same through Spark's file source, for stores that only its connectors reach; no content is read.

    Spark keeps the names on the driver, and skips empty files and those with hidden names.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return found.where(has_suffix(F.col("path"), suffix)).select("path", "length", "modificationTime")


def reached_by_tasks(path: str) -> bool:
    """Whether tasks can open a path themselves, by its scheme."""
    try:
        locate(path)
    except (pa.ArrowInvalid, OSError, ValueError):
        return False
    return True


def first_files(listing: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files of a listing by path; no task merges them."""
    require_positive(max_images=n)
    return global_rank(listing, "path").where(F.col("rank") <= n).drop("rank")


def task_numbers(listing: DataFrame, task_bytes: int = TASK_BYTES, least: int | None = None) -> tuple[DataFrame, int]:
    """A listing (``path``, ``length``) with ``task``, and the number of tasks: files in order of path, cut at equal shares of all bytes.

    A task has at most its share and half a file at either end. Bytes are summed
    up within the partitions of a range sort; only one sum a partition is added
    up beyond that. Opening a file counts as ``OPEN_BYTES``, so that many small
    files are dealt out by number. There are at least ``least`` tasks, unless the
    files are fewer (default: as many as run at a time).
    """
    spark = listing.sparkSession
    ensure_checkpoint_dir(spark)
    weight = (F.coalesce("length", F.lit(0)) + OPEN_BYTES).alias("_weight")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = listing.select("*", weight).repartitionByRange(parts, "path").withColumn("_part", F.spark_partition_id()).checkpoint()
    sums = dealt.groupBy("_part").agg(F.sum("_weight").alias("_bytes"), F.count("*").alias("_files")).orderBy("_part").collect()
    total, files = sum(r["_bytes"] for r in sums), sum(r["_files"] for r in sums)
    wanted = max(least or spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    n = max(1, min(wanted, files))
    starts, at = [], 0
    for r in sums:  # one row a partition
        starts.append((r["_part"], at))
        at += r["_bytes"]
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _start long"))
    before = F.sum("_weight").over(W.partitionBy("_part").orderBy("path").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_weight")
    middle = F.col("_start") + F.col("_before") + F.col("_weight") / 2
    number = F.least(F.floor(middle * n / max(1, total)), F.lit(n - 1)).cast("int")
    numbered = dealt.withColumn("_before", before).join(offsets, "_part").withColumn("task", number)
    return numbered.drop("_part", "_weight", "_before", "_start"), n


def spread_listing(listing: DataFrame) -> DataFrame:
    """Paths of a listing (``path``, ``length``), with their ``batch`` if they have one, dealt out so that tasks get about equal bytes."""
    kept = ["path", *carried(listing)]
    numbered, n = task_numbers(listing.select("length", *kept))
    return numbered.repartitionById(n, "task").select(*kept)


def carried(files: DataFrame) -> list[str]:
    """The column that goes with a file through all stages, where there is one: the slice it belongs to."""
    return [c for c in ("batch",) if c in files.columns]


def read_file(path: str, attempts: int = 3) -> bytes:
    """Content of one file, read in the task that needs it; a read that breaks is tried again."""
    try:
        fs, inner, _ = locate(path)
        for left in reversed(range(attempts)):
            try:
                with fs.open_input_stream(inner) as source:
                    return source.read()
            except FileNotFoundError:
                raise
            except OSError:
                if not left:
                    raise
    except Exception as e:
        raise OSError(f"Worker processing error for {path}: {e}") from e


def fetch_files(listing: DataFrame) -> DataFrame:
    """Content of the listed files; one that cannot be read is a row with ``fetch_error``."""
    return spread_listing(listing).mapInArrow(_fetch, "path string, content binary, fetch_error string")


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            content = error = None
            try:
                content = read_file(path)
            except Exception as e:
                error = str(e)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path], pa.string()), pa.array([content], pa.binary()), pa.array([error], pa.string())],
                ["path", "content", "fetch_error"],
            )


def spark_content(listing: DataFrame) -> DataFrame:
    """``path``, ``content``, ``fetch_error`` of a slice (``path``, ``length``), read by Spark's file source.

    The paths of the slice go through the driver, where that source keeps them
    anyway: it is for slices of a size that the caller sets. Files that Spark
    skips or would take for a pattern, by their names, are read by the tasks.
    """
    odd = F.rlike(base_name(F.col("path")), F.lit(r"^[_.]")) | F.rlike("path", F.lit(r"[\[\]{}*?\\]"))
    empty = F.col("length") == 0
    no_error = F.lit(None).cast("string").alias("fetch_error")
    found = listing.where(empty).select("path", F.lit(b"").alias("content"), no_error)
    found = found.unionByName(fetch_files(listing.where(~empty & odd)))
    paths = [r["path"] for r in listing.where(~empty & ~odd).select("path").collect()]
    if paths:
        read = listing.sparkSession.read.format("binaryFile").load(paths)
        found = found.unionByName(read.select("path", "content", no_error))
    return found


@lru_cache(maxsize=64)
def _remote(scheme: str, authority: str) -> tuple[pafs.FileSystem, str]:
    """One client per store and Python worker, not one per file."""
    return pafs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{authority}/")


def locate(path: str) -> tuple[pafs.FileSystem, str, str]:
    """File system of a path, its path there, and the prefix that turns such paths into Spark's.

    Paths are taken as they are, without URI escapes, the way Spark lists them.
    """
    scheme, mark, rest = path.partition("://")
    if not mark or scheme == "file":
        local = rest if mark else path.removeprefix("file:")
        return pafs.LocalFileSystem(), os.path.abspath(local), "file:"
    authority, _, key = rest.partition("/")
    fs, root = _remote(scheme, authority)
    prefix = f"{scheme}://" if root.startswith(authority) else f"{scheme}://{authority}"
    return fs, f"{root.rstrip('/')}/{key}".rstrip("/"), prefix


_LISTING = pa.schema(
    [
        ("path", pa.string()),
        ("length", pa.int64()),
        ("modificationTime", pa.timestamp("us", "UTC")),
        ("is_folder", pa.bool_()),
        ("share", pa.int64()),
        ("shares", pa.int64()),
    ]
)
_LISTED = "path string, length long, modificationTime timestamp, is_folder boolean, share long, shares long"

Found = tuple[str, int | None, int | None, bool, int, int]


def _local_share(folder: str, prefix: str, own: Collection[int], shares: int) -> Iterator[Found]:
    """Entries of a local folder whose name belongs to one of a task's own shares; names are streamed once, only those are looked at."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if shares > 1 and zlib.crc32(os.fsencode(entry.name)) % shares not in own:
                continue
            try:
                is_folder, found = entry.is_dir(), entry.stat()
            except OSError:  # gone meanwhile, or a link to nothing: reading it will say so
                yield f"{prefix}{entry.path}", None, None, False, 0, 0
                continue
            yield f"{prefix}{entry.path}", None if is_folder else found.st_size, found.st_mtime_ns // 1000, is_folder, 0, 0


def _local_entries(folder: str, prefix: str, share: int, shares: int, most: int) -> Iterator[Found]:
    """Entries of a local folder; of one with more than ``most`` names, the shares that tasks of the next round take."""
    if not shares:
        with os.scandir(folder) as entries:
            names = sum(1 for _ in entries)
        shares = -(-names // most)
        if shares > 1:
            yield from ((f"{prefix}{folder}", None, None, True, k, shares) for k in range(shares))
            return
    yield from _local_share(folder, prefix, {share}, shares)


def _store_entries(fs: pafs.FileSystem, folder: str, prefix: str) -> Iterator[Found]:
    for f in fs.get_file_info(pafs.FileSelector(folder)):
        micros = None if f.mtime_ns is None else f.mtime_ns // 1000
        yield prefix + f.path, f.size, micros, f.type == pafs.FileType.Directory, 0, 0


def folder_entries(path: str) -> Iterator[tuple[str, int | None, int | None, bool]]:
    """(path, length, time in microseconds, is a folder) of what is in one folder."""
    fs, inner, prefix = locate(path)
    local = isinstance(fs, pafs.LocalFileSystem)
    for found in _local_share(inner, prefix, {0}, 1) if local else _store_entries(fs, inner, prefix):
        yield found[:4]


def _listed(found: Iterator[Found]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(found, 10_000)):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTING, strict=True)], schema=_LISTING)


def _lister(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shares of a folder that this task has: their names are streamed once for all of them, not once a share
        own: dict[tuple[str, int], set[int]] = {}
        for batch in batches:
            for folder, share, shares in zip(*(batch.column(c).to_pylist() for c in ("path", "share", "shares")), strict=True):
                fs, inner, prefix = locate(folder)
                if not isinstance(fs, pafs.LocalFileSystem):
                    yield from _listed(_store_entries(fs, inner, prefix))
                elif shares:
                    own.setdefault((folder, shares), set()).add(share)
                else:
                    yield from _listed(_local_entries(inner, prefix, share, shares, most))
        for (folder, shares), some in own.items():
            _, inner, prefix = locate(folder)
            yield from _listed(_local_share(inner, prefix, some, shares))

    return run


def walk_files(spark: SparkSession, base: str, most: int = FOLDER_NAMES) -> DataFrame:
    """Every file below ``base`` with its size, zero-byte files included.

    Spark's file sources skip empty files, so this lists folder by folder: one
    job per level of the tree, its folders spread over the executors, each level
    written to the shared folder. No listing passes through the driver. A local
    folder of more than ``most`` names is listed by several tasks, each of which
    streams all names once and looks at those of its shares; the client of a store gives
    the names of one folder at once, to one task.
    """
    out = work_dir(spark, "walk")
    level = 0
    frontier = spark.createDataFrame([(base, 0, 0)], "path string, share long, shares long")
    while not frontier.isEmpty():
        # a number of partitions of its own, or adaptive execution merges small levels into one task
        spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        listed = frontier.repartition(spread, "path", "share").mapInArrow(_lister(most), _LISTED)
        listed.write.mode("overwrite").parquet(f"{out}/level={level}")
        seen = spark.read.parquet(f"{out}/level={level}")
        frontier = seen.where("is_folder").select("path", "share", "shares")
        level += 1
    return spark.read.parquet(out).where("NOT is_folder").select("path", "length", "modificationTime")


def write_files(df: DataFrame, out_dir: str) -> DataFrame:
    """Write one file per row (``name``, ``content``) and return the manifest (``path``, ``length``).

    A file is written beside its target and moved over it, so a lost or repeated
    task leaves whole files only. The manifest is stored under ``_manifest``.
    Two rows of one name are an error, found in the manifest.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner, prefix = locate(out_dir)
        fs.create_dir(inner, recursive=True)
        for batch in batches:
            names, contents = batch.column("name").to_pylist(), batch.column("content")
            for name, content in zip(names, contents):
                target = f"{inner}/{name}"
                part = f"{inner}/_{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as sink:
                    sink.write(content.as_buffer())
                fs.move(part, target)
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [f"{prefix}{inner}/{name}" for name in names],
                    "length": pa.array([len(c.as_buffer()) for c in contents], pa.int64()),
                }
            )

    manifest = f"{out_dir.rstrip('/')}/_manifest"
    df.select("name", "content").mapInArrow(put, "path string, length long").write.mode("overwrite").parquet(manifest)
    written = df.sparkSession.read.parquet(manifest)
    twice = written.groupBy("path").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice['count']} rows have the name of {twice['path']}")
    return written
