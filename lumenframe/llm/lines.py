"""Removal of lines in three-line windows that a corpus already has earlier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm import blocks as B
from lumenframe.llm.substrings import covered

SIZE = 3

CUT = "doc_id long, n_lines long, n_removed long, kept string"
_CUT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def windows(docs: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, key, at, h, g): every run of ``size`` lines as two 64-bit hashes, which name it together."""
    rows = docs.select(B.row_id(doc_id).alias("id"), B.row_key(text, doc_id).alias("key"), F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n").alias("lines"))
    rows = rows.where(F.size("lines") >= size)

    def run(i: Column) -> Column:
        of = [F.get("lines", i + k) for k in range(size)]
        return F.struct(i.alias("at"), F.xxhash64(*of).alias("h"), F.xxhash64(F.lit("g"), *of).alias("g"))

    runs = F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - size), run)).alias("run")
    return rows.select("id", "key", runs).select("id", "key", "run.at", "run.h", "run.g")


def cut_lines(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for doc_id, text, at in zip(*(c.to_pylist() for c in part.columns), strict=True):
                lines = text.split("\n")
                gone = covered(len(lines), np.array(at or [], dtype=np.int64), size)
                kept = [x for x, g in zip(lines, gone.tolist(), strict=True) if not g]
                rows.append((doc_id, len(lines), int(gone.sum()), "\n".join(kept)))
            yield B.batch(rows, _CUT)

    return run


def remove_earlier_lines(docs: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_removed``, ``kept`` (lines left, joined again).

    Lines end at a line feed and are compared as they are, blank ones too. A
    window of ``size`` lines that also stands earlier (smaller id, or before it
    in the document) is a repeat; every line that a repeat covers goes. Windows
    are judged on the input. A text of fewer lines loses none; null is one empty
    line. Null ids come first; rows of one id count as one document, so equal
    places in them do not remove each other. Other columns are not read.
    """
    runs = windows(docs, size, text, doc_id)
    first = runs.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("first")).where("n > 1").drop("n")
    later = runs.join(first, ["h", "g"]).where(F.struct("id", "at") > F.col("first"))
    per_doc = later.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("at").alias("at"))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), B.row_id(doc_id).alias("id"), B.row_key(text, doc_id).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    on = (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key"))
    return rows.join(per_doc, on, "left").select("doc_id", "text", "at").mapInArrow(cut_lines(size), CUT)
