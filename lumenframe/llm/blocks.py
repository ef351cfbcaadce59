"""Exchange of packed arrays between tasks.

An operator over every word or byte of a corpus would shuffle billions of tiny
rows. Here a task works through its rows in chunks, deals what each chunk has
found to buckets, and hands Spark one row for each chunk and bucket with the
arrays packed in it. Spark shuffles those rows by bucket, another task joins
what all chunks say of a bucket, and answers go back by the chunk they are for.

A chunk is named by a hash of the keys of its rows, so a task that runs again
names it alike; if its rows came out otherwise, its answers would find no
directory, which stops the job instead of losing them.
"""

from __future__ import annotations

import ctypes
import gc
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import words as W
from lumenframe.session import ensure_checkpoint_dir

#: Bytes of text in a chunk; bounds what a task holds at a time.
CHUNK_BYTES = 8_000_000
#: Rows of an Arrow batch that become Python objects at a time.
SLICE_ROWS = 256

#: Stands for a null id.
NO_ID = -(1 << 63)

BLOCK = "bucket long, chunk long, body binary"
_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary())])


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker process gives back what it no longer uses: it idles beside other stages' tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            W.forget_tables()
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
                trim(0)

    return whole


def pack(*arrays: np.ndarray) -> bytes:
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)), a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(body: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    while at < len(data):
        kind, n = struct.unpack_from("<2sq", data, at)
        at += 10
        out.append(np.frombuffer(data, dtype=f"<{kind.decode()}", count=n, offset=at))
        at += out[-1].nbytes
    return out


def steps(sorted_numbers: np.ndarray) -> np.ndarray:
    """Ascending numbers as their differences, which pack small."""
    d = np.diff(sorted_numbers, prepend=0).astype(np.int64)
    return d.astype(np.uint16) if not len(d) or d.max() < 1 << 16 else d.astype(np.uint32 if d.max() < 1 << 32 else np.int64)


def back(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences, dtype=np.int64)


def deal(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each bucket's share of the arrays, in the order they have."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(sorted_bucket, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(sorted_bucket[lo]), [a[order[lo:hi]] for a in arrays]


def batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    rows = list(rows)
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def block(rows: Iterable[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return batch(rows, _ARROW)


def table(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([block(rows)])


def chunks(batches: Iterable[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows of (id, key, text) again, in runs of about ``size`` bytes of text."""
    ids, keys, texts, held = [], [], [], 0
    for part in batches:
        for lo in range(0, part.num_rows, SLICE_ROWS):  # not all texts of a batch a second time at once
            for i, k, t in zip(*(c.to_pylist() for c in part.slice(lo, SLICE_ROWS).columns), strict=True):
                ids.append(i)
                keys.append(k)
                texts.append(t)
                held += len(t) + 64
                if held >= size:
                    yield np.array(ids, dtype=np.int64), np.array(keys, dtype=np.int64), texts
                    ids, keys, texts, held = [], [], [], 0
    if ids:
        yield np.array(ids, dtype=np.int64), np.array(keys, dtype=np.int64), texts


def chunk_name(ids: np.ndarray, keys: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(ids.tobytes() + keys.tobytes()) >> 1


def text_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, key, text): the id (null: below all others), a hash of id and text that tells rows of one id apart, UTF-8 bytes (null: empty).

    Rows alike in both are copies in every respect that an operator sees, and get the same answer.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(row_id(doc_id).alias("id"), row_key(text, doc_id).alias("key"), body.cast("binary").alias("text"))


def row_id(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    return F.xxhash64(F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")))


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that ``docs`` does not have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def named(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the names of their rows that ``text_rows`` uses, and the two columns they are in."""
    own_id, own_key = free_name(docs, "__lumenframe_row_id"), free_name(docs, "__lumenframe_row_key")
    return docs.withColumns({own_id: row_id(), own_key: row_key()}), own_id, own_key


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def checkpoint(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder, without the plan that made them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
