"""Token ids in ORC files: one row a document, in ascending order of ids.

The integers are run-length encoded by ORC, row indexes and Bloom filters on
``doc_id`` let a reader skip stripes, and Spark's readers take stripes side by
side. A row holds its range of ids (``part``) and where its tokens start in
that; where the ranges start follows from one total a range, however many files
it was written to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.vocabularies import ByteTokenizer, in_worker, public_path

END = 0
VOCABULARY = "byte_bpe_50k.json"
STORED = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
_STORED = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
#: Bytes of text whose ids a task holds at a time.
SLICE = 4_000_000
ORC = {
    "compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000", "orc.stripe.size": str(32 << 20), "orc.create.index": "true",
}


def encode(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, at, number = in_worker(ByteTokenizer, path), 0, TaskContext.get().partitionId()
        for part in batches:
            doc_ids, texts = (c.to_pylist() for c in part.columns)
            lo = 0
            while lo < len(texts):
                hi, held = lo, 0
                while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= SLICE):
                    held += len(texts[hi])
                    hi += 1
                ids = tokenizer.encode(texts[lo:hi], [end])
                sizes = ids.value_lengths().to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[lo:hi], pa.int64()), pa.array([number] * (hi - lo), pa.int32()), pa.array(at + ends - sizes), pa.array(sizes), ids], schema=_STORED)
                at += int(ends[-1])
                lo = hi

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the ids of every whole text, ``end`` appended, to ORC files in ``folder``.

    Documents are in ascending order of id, null first; rows of one id in that
    of a hash of their texts; rows alike in both, in any order, have the same ids.
    A null text is empty and has the end only. Long texts are cut at spaces and
    encoded whole. An empty table gives files without rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), B.row_key(text, doc_id).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(B.partitions(docs), "doc_id", "key").sortWithinPartitions("doc_id", "key")
    stored = dealt.select("doc_id", "text").mapInArrow(B.released(encode(vocabulary or public_path(VOCABULARY), end)), STORED)
    stored.write.options(**ORC).mode("overwrite").orc(folder)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(STORED).orc(folder)


def lookup(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """Rows of a few documents; stripes without them are skipped by their statistics and Bloom filters."""
    return stored(spark, folder).where(F.col("doc_id").isin(ids))


def bases(rows: DataFrame) -> DataFrame:
    """(part, base): the number of ids in the ranges before. One row a range."""
    totals = rows.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids): ``start`` counts the ids of all documents before."""
    rows = stored(spark, folder)
    return rows.join(bases(rows), "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "ids")


_SUMS = "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long"


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, start_in_part, ids) to the number of ids and the CRC-32 of their little-endian 32-bit form."""
    for rows in batches:
        doc_id, part, start, ids = rows.columns
        values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([doc_id, part, start, pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])


def checked_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, all from the files."""
    rows = stored(spark, folder)
    sums = rows.select("doc_id", "part", "start_in_part", "ids").mapInArrow(B.released(checksums), _SUMS)
    return sums.join(bases(rows), "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
