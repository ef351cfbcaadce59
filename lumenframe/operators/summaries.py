"""Counts and summaries by class and by stage; every aggregate combines before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.text import is_error


def prediction_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("prediction").agg(F.count("*").alias("count"))


def describe_confidence(df: DataFrame) -> DataFrame:
    """One row per statistic with the columns ``prediction`` and ``confidence``.

    Label columns have no mean or deviation; the deviation is that of a sample.
    """
    c, p = F.col("confidence"), F.col("prediction")
    stats = df.agg(
        F.count(p).alias("pc"), F.min(p).alias("pl"), F.max(p).alias("ph"),
        F.count(c).alias("cc"), F.avg(c).alias("cm"), F.stddev_samp(c).alias("cs"),
        F.min(c).alias("cl"), F.max(c).alias("ch"),
    )
    none = F.lit(None).cast("string")
    row = lambda name, left, right: F.struct(
        F.lit(name).alias("summary"), left.alias("prediction"), right.cast("double").alias("confidence")
    )
    return stats.select(
        F.inline(
            F.array(
                row("count", F.col("pc").cast("string"), F.col("cc")),
                row("mean", none, F.col("cm")),
                row("stddev", none, F.col("cs")),
                row("min", F.col("pl"), F.col("cl")),
                row("max", F.col("ph"), F.col("ch")),
            )
        )
    )


def stage_summary(df: DataFrame, error_column: str) -> DataFrame:
    """Rows in, rows that succeeded and rows that failed."""
    bad = F.col(error_column).isNotNull()
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(~bad).alias("processed"),
        F.count_if(bad).alias("failed"),
    )


def report_success(reports: DataFrame) -> DataFrame:
    """Reports that have a usable path, out of all."""
    path = F.col("report_path")
    ok = path.isNotNull() & (path != "") & ~is_error(path)
    return reports.agg(F.count("*").alias("total"), F.count_if(ok).alias("successful"))


def good_reports(reports: DataFrame) -> DataFrame:
    """Reports whose path is present and not an ``ERROR_`` marker."""
    path = F.col("report_path")
    return reports.where(path.isNotNull() & (path != "") & ~is_error(path))


def predictions_table(scored: DataFrame, path: str = "path") -> DataFrame:
    """The per-image predictions of a run, as rows rather than one collected list."""
    return scored.select(F.col(path).alias("image_path"), "prediction", "confidence")
