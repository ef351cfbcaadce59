"""One document a report: ``df.write.format("report_files").save(folder)``.

Tasks write documents beside the folder's own files and move them over when all of
theirs are whole, so an attempt that is lost leaves none in part. What a task has
written goes back as one message; with the messages of all tasks the commit
stores the manifest and marks the folder, and an abort clears what lies aside.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lumenframe.operators.quality import require_columns
from lumenframe.sources.files import locate

FORMAT = "report_files"
#: A row of what is written; ``name`` must tell reports apart.
NEEDED = ["name", "content"]
_MANIFEST = pa.schema([("name", pa.string()), ("length", pa.int64())])


@dataclass
class Written(WriterCommitMessage):
    manifest: str
    documents: int
    size: int


class ReportWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.job = folder, uuid.uuid4().hex
        fs, inner, _ = locate(folder)
        if overwrite and fs.get_file_info(inner).type == pafs.FileType.Directory:
            fs.delete_dir_contents(inner)
        fs.create_dir(f"{inner}/_manifest", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, inner, _ = locate(self.folder)
        context = TaskContext.get()
        task = f"{self.job}-{context.partitionId():06d}-{context.taskAttemptId()}"
        aside, names, sizes = f"{inner}/_aside/{self.job}/{task}", [], []
        fs.create_dir(aside, recursive=True)
        for batch in iterator:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").cast(pa.binary()), strict=True):
                data = content.as_buffer() or pa.py_buffer(b"")
                with fs.open_output_stream(f"{aside}/{name}") as sink:
                    sink.write(data)
                names.append(name)
                sizes.append(data.size)
        if len(set(names)) < len(names):
            raise ValueError(f"a name stands for several reports: {next(n for k, n in enumerate(names) if n in names[:k])}")
        for name in names:
            fs.move(f"{aside}/{name}", f"{inner}/{name}")
        manifest = f"{inner}/_manifest/{task}.parquet"
        if names:
            with fs.open_output_stream(manifest) as sink:
                pq.write_table(pa.table([names, sizes], schema=_MANIFEST), sink)
        return Written(manifest if names else "", len(names), sum(sizes))

    def _clear(self, kept: set[str]) -> None:
        """Remove what is left aside, and manifests of this job's attempts that do not count."""
        fs, inner, _ = locate(self.folder)
        for f in fs.get_file_info(pafs.FileSelector(f"{inner}/_manifest", allow_not_found=True)):
            if f.base_name.startswith(self.job) and f.base_name not in kept:
                fs.delete_file(f.path)
        if fs.get_file_info(f"{inner}/_aside/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{inner}/_aside/{self.job}")

    def commit(self, messages: list[Written | None]) -> None:
        fs, inner, _ = locate(self.folder)
        self._clear({m.manifest.rsplit("/", 1)[-1] for m in messages if m})
        fs.open_output_stream(f"{inner}/_SUCCESS").close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(set())


class ReportFiles(DataSource):
    """Option ``path``: the folder of a run's documents."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> ReportWriter:
        require = [c for c in NEEDED if c not in schema.names]
        if require:
            raise ValueError(f"missing columns: {require}")
        return ReportWriter(self.options["path"], overwrite)


def write_documents(documents: DataFrame, folder: str) -> DataFrame:
    """Write one file per row of ``name``, ``content`` (text or bytes); returns the manifest (``path``, ``length``).

    A repeated run replaces all that the folder holds. Two rows of one name stop the
    job: names are dealt out so that one task sees both.
    """
    require_columns(documents, NEEDED)
    spark = documents.sparkSession
    spark.dataSource.register(ReportFiles)
    rows = documents.select("name", F.col("content").cast("binary").alias("content"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(parts, "name").write.format(FORMAT).mode("overwrite").save(folder)
    return read_manifest(spark, folder)


def is_complete(folder: str) -> bool:
    """Whether the documents of a folder were committed."""
    fs, inner, _ = locate(folder)
    return fs.get_file_info(f"{inner}/_SUCCESS").type == pafs.FileType.File


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``length`` of the documents of a folder whose writing was committed."""
    if not is_complete(folder):
        raise FileNotFoundError(f"no complete run of documents in {folder}")
    _, inner, prefix = locate(folder)
    stored = spark.read.schema("name string, length long").parquet(f"{prefix}{inner}/_manifest")
    return stored.select(F.concat(F.lit(f"{prefix}{inner}/"), "name").alias("path"), "length")
