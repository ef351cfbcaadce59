"""Removal of word windows that occur more than once in a corpus.

Every window of ``size`` consecutive words gets two Rabin-Karp hashes, rolled
over the words' own hashes. One, whole, is a window's name; the other deals
windows to buckets, so that two different windows are only confused where both
agree. Buckets are counted in Spark, and what is repeated comes back to its
document, where touching windows merge into maximal removal intervals.

A chunk of documents says each window at most once, with a mark where it has
the window more often, so a window that a third of all rows repeat costs one
entry a chunk. The number of buckets follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.words import TOKENS, TOKENS_2, Words

SIZE = 35
_BUCKETS_A_PARTITION = 2

HITS = "id long, key long, at binary"
_HITS = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("at", pa.binary())])


def window_blocks(size: int, buckets: int):
    """Rows of text to blocks: for each bucket the windows of a chunk, and in buckets of their own the
    chunk's directory and the windows it has more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in B.chunks(batches):
            words = Words(texts)
            at, name = words.windows(size)
            chunk = B.chunk_name(ids, keys)
            if not len(at):
                continue
            _, other = words.windows(size, TOKENS_2)
            order = np.lexsort((at, name))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (name[order][1:] != name[order][:-1]) | (other[order][1:] != other[order][:-1])
            group = np.cumsum(new) - 1
            more = np.bincount(group) > 1
            own = chunk % buckets + buckets
            rows = [(own, chunk, B.pack(np.zeros(1, np.int8), ids, keys, words.counts))]
            if more.any():
                rows.append((own, chunk, B.pack(np.ones(1, np.int8), B.steps(np.sort(at[order[more[group]]])))))
            first = order[new]
            first_at, first_more = at[first], more
            by_place = np.argsort(first_at)
            first, first_at, first_more = first[by_place], first_at[by_place], first_more[by_place]
            dealt = B.deal((other[first] % np.uint64(buckets)).astype(np.int64), name[first], first_at, first_more)
            for bucket, (n, a, m) in dealt:
                rows.append((bucket, chunk, B.pack(n, B.steps(a), np.packbits(m))))
            yield B.block(rows)

    return run


def repeated_in_bucket(buckets: int):
    """Blocks of a bucket to blocks for the chunks: which of their windows other chunks have too, or they twice."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        rows = list(zip(group.column("chunk").to_pylist(), group.column("body").to_pylist(), strict=True))
        if bucket >= buckets:
            return B.table((0, chunk, body) for chunk, body in rows)
        names, places, marks, sizes = [], [], [], []
        for _, body in rows:
            n, a, m = B.unpack(body)
            names.append(n)
            places.append(B.back(a))
            marks.append(np.unpackbits(m, count=len(n)).astype(bool))
            sizes.append(len(n))
        name = np.concatenate(names)
        order = np.argsort(name, kind="stable")
        new = np.diff(name[order], prepend=~name[order[:1]]) != 0
        group_of = np.cumsum(new) - 1
        repeated = np.empty(len(name), dtype=bool)
        repeated[order] = (np.bincount(group_of) > 1)[group_of]
        repeated &= ~np.concatenate(marks)  # the chunk itself knows of those
        out, at = [], 0
        for (chunk, _), places_here, n in zip(rows, places, sizes, strict=True):
            found = places_here[repeated[at : at + n]]
            at += n
            if len(found):
                out.append((0, chunk, B.pack(np.ones(1, np.int8), B.steps(found))))
        return B.table(out)

    return run


def to_documents(group: pa.Table) -> pa.Table:
    """Blocks of a chunk to a row for each document with a repeated window: the words that start one."""
    directory, found = None, []
    for body in group.column("body").to_pylist():
        kind, *arrays = B.unpack(body)
        if kind[0] == 0:
            directory = arrays
        else:
            found.append(B.back(arrays[0]))
    if directory is None:
        raise RuntimeError("windows of a chunk came back, but not its directory: its rows came in another order")
    if not found:
        return _HITS.empty_table()
    ids, keys, counts = directory
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.unique(np.concatenate(found))
    doc = np.searchsorted(first, at, side="right") - 1
    rows = [(int(ids[d]), int(keys[d]), (a - first[d]).astype(np.uint32).tobytes()) for d, (a,) in B.deal(doc, at)]
    return pa.Table.from_batches([B.batch(rows, _HITS)])


def repeated_windows(docs: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, key, at): for each document with windows that also start elsewhere, the numbers of the words
    they start at, as packed 32-bit integers; ``id`` and ``key`` are those of ``blocks.text_rows``."""
    buckets = _BUCKETS_A_PARTITION * B.partitions(docs)
    blocks = B.text_rows(docs, text, doc_id).mapInArrow(window_blocks(size, buckets), B.BLOCK)
    answers = blocks.groupBy("bucket").applyInArrow(repeated_in_bucket(buckets), B.BLOCK)
    return answers.groupBy("chunk").applyInArrow(to_documents, HITS)


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``size`` from one of ``starts``."""
    change = np.zeros(n + size + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    return np.cumsum(change)[:n] > 0


def intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


CUT = "doc_id long, n_words long, n_removed long, kept binary, span_start array<long>, span_end array<long>"
_CUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
    ("span_start", pa.list_(pa.int64())), ("span_end", pa.list_(pa.int64())),
])


def cut_words(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.split()
                removed = np.zeros(len(words), dtype=bool)
                if parts is not None:
                    removed = covered(len(words), np.unique(np.frombuffer(b"".join(parts), dtype=np.uint32)).astype(np.int64), size)
                    words = [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone]
                start, end = intervals(removed)
                rows.append((doc_id, len(removed), int(removed.sum()), b" ".join(words), start.tolist(), end.tolist()))
            yield B.batch(rows, _CUT)

    return run


def remove_repeated_windows(docs: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words left, joined by one space,
    UTF-8), ``span_start`` and ``span_end`` (the maximal removal intervals, in words).

    A word goes if a window that covers it also starts anywhere else, in the
    same document too; windows are judged on the input. Null texts have no
    words; a document of fewer than ``size`` words loses none. Rows are counted
    as they come: two rows of one text repeat each other, whatever their ids,
    null ids included. Other columns are not read. An empty table gives none.
    """
    hits = repeated_windows(docs, size, text, doc_id)
    hits = hits.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("at").alias("at"))  # rows alike share them
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), B.row_id(doc_id).alias("id"), B.row_key(text, doc_id).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    on = (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key"))
    return rows.join(hits, on, "left").select("doc_id", "text", "at").mapInArrow(cut_words(size), CUT)

