"""Stage snapshots: one Parquet folder per run, the newest complete one readable.

Beside the runs lies a log with an empty file for each complete one, so that all
of them are known from one listing, however many there are.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN, BATCH = "run_ts", "batch"
LOG = "_runs"
# An image row may hold tens of megabytes: look at the size after every row, not
# after the first hundred, or a row group would buffer gigabytes.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


def _folder(base: str, run_ts: str) -> str:
    return f"{base.rstrip('/')}/{RUN}={run_ts}"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_snapshot(df: DataFrame, base: str, run_ts: str, batch: int | None = None) -> str:
    """Write a run's folder, or one batch of it; repeating the call replaces what it wrote."""
    target = _folder(base, run_ts) + ("" if batch is None else f"/batch={batch}")
    _strike(df.sparkSession, base, run_ts)  # not complete while it is written again
    df.write.mode("overwrite").options(**LARGE_ROWS).parquet(target)
    if batch is None:
        _enter(df.sparkSession, base, run_ts)
    return target


def write_batches(df: DataFrame, base: str, run_ts: str, numbers: range) -> list[str]:
    """Write several batches of a run by ``batch``, replacing what they had; returns their folders, each marked as whole."""
    target = _folder(base, run_ts)
    spark = df.sparkSession
    _strike(spark, base, run_ts)
    folders = [f"{target}/{BATCH}={n}" for n in numbers]
    for folder in folders:  # not whole while they are written again
        _, path, fs = _filesystem(spark, f"{folder}/_SUCCESS")
        fs.delete(path, False)
    # the marker of the whole run is not this write's to set
    options = {**LARGE_ROWS, "partitionOverwriteMode": "dynamic", "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    df.write.mode("overwrite").options(**options).partitionBy(BATCH).parquet(target)
    for folder in folders:
        _, path, fs = _filesystem(spark, f"{folder}/_SUCCESS")
        fs.create(path, True).close()
    return folders


def _entry(base: str, run_ts: str) -> str:
    return f"{base.rstrip('/')}/{LOG}/{run_ts}"


def _enter(spark: SparkSession, base: str, *runs: str) -> None:
    for run_ts in runs:
        _, path, fs = _filesystem(spark, _entry(base, run_ts))
        fs.create(path, True).close()


def _strike(spark: SparkSession, base: str, run_ts: str) -> None:
    _, path, fs = _filesystem(spark, _entry(base, run_ts))
    fs.delete(path, False)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder: one listing."""
    jvm, path, fs = _filesystem(spark, folder)
    try:
        return [s.getPath().getName() for s in fs.listStatus(path)]
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):
            return []
        raise


def mark_complete(spark: SparkSession, base: str, run_ts: str) -> None:
    """Mark a run written in batches as readable."""
    _, path, fs = _filesystem(spark, _folder(base, run_ts) + "/_SUCCESS")
    fs.create(path, True).close()
    _enter(spark, base, run_ts)


def complete_batches(spark: SparkSession, base: str, run_ts: str) -> list[int]:
    """Numbers of a run's batches that are wholly written."""
    jvm, path, fs = _filesystem(spark, _folder(base, run_ts))
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    done = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{_folder(base, run_ts)}/{n}/_SUCCESS"))
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and done(n))


def list_runs(spark: SparkSession, base: str) -> list[str]:
    """Complete runs below ``base``, oldest first: two folder listings, no file is opened.

    A folder that the log lacks was written by something else, or its writer was
    lost before the entry: its marker is looked for, and found ones are entered.
    """
    logged = set(_names(spark, f"{base.rstrip('/')}/{LOG}"))
    runs = {n.removeprefix(f"{RUN}=") for n in _names(spark, base) if n.startswith(f"{RUN}=")}
    found = []
    for run_ts in sorted(runs - logged):
        _, path, fs = _filesystem(spark, _folder(base, run_ts) + "/_SUCCESS")
        if fs.exists(path):
            found.append(run_ts)
    _enter(spark, base, *found)
    return sorted((runs & logged) | set(found))


def read_run(spark: SparkSession, base: str, run_ts: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    if schema:
        reader = reader.schema(f"{schema}, {RUN} string")
    return reader.parquet(_folder(base, run_ts)).withColumn(RUN, F.col(RUN).cast("string"))


def latest_run(spark: SparkSession, base: str) -> str:
    """Name of the newest complete run; an error when there is none."""
    runs = list_runs(spark, base)
    if not runs:
        raise FileNotFoundError(f"No complete run found below {base}")
    return runs[-1]


def read_latest(spark: SparkSession, base: str, schema: str | None = None) -> DataFrame:
    """The newest complete run; older runs are not even listed file by file."""
    return read_run(spark, base, latest_run(spark, base), schema)
