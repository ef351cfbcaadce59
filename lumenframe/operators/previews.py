"""What a table looks like: its schema and its first rows, as tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.quality import require_positive

#: Characters of a value that are shown.
WIDTH = 20


def schema_rows(df: DataFrame) -> DataFrame:
    """``position`` (from 1), ``column``, ``type`` of each column; no row of ``df`` is read."""
    rows = [(n, f.name, f.dataType.simpleString()) for n, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the order of ``order``: each task keeps that many, nothing else is moved."""
    require_positive(n=n)
    return df.orderBy(*order).limit(n)


def shown_text(value: Column, width: int = WIDTH) -> Column:
    """A value as it is shown: ``NULL`` for null, text cut to ``width`` with dots at its end."""
    text = value.cast("string")
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(F.coalesce(text, F.lit("NULL")))


def shown_rows(df: DataFrame, n: int, *order: str, width: int = WIDTH) -> DataFrame:
    """``first_rows`` with every value as it is shown."""
    return first_rows(df, n, *order).select(*[shown_text(F.col(f"`{c}`"), width).alias(c) for c in df.columns])
