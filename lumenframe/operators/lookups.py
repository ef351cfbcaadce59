"""Joins of results with metadata, listings and labels, and the latest report per patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.times import older_than


def merge_metadata(results: DataFrame, metadata: DataFrame, key: str, fill: list[str]) -> DataFrame:
    """Results with their saved metadata; columns of ``fill`` become ``N/A`` where there is none.

    A plain equi join: Spark broadcasts the metadata only when its size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise splits hot keys of
    the results side through adaptive skew handling.
    """
    joined = results.join(metadata, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("N/A")) for c in fill})


def attach_labels(df: DataFrame, labels: DataFrame, index: str) -> DataFrame:
    """Class index → label through a ``(idx, label)`` table; an unknown index is ``UNKNOWN``."""
    joined = df.join(labels.withColumnRenamed("idx", index), index, "left")
    return joined.withColumn("label", F.coalesce(F.col("label"), F.lit("UNKNOWN")))


def unprocessed(listing: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Listed files without a result.

    The results are made distinct first: that keeps one row per key and task
    before the shuffle the join needs anyway, so a path with many results does
    not pile up in one task.
    """
    return listing.join(done.select(key).distinct(), key, "left_anti")


def latest_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key.

    ``max_by`` keeps one candidate per key and task before the shuffle, so a key
    that holds most of the rows costs no more than any other; a ranking window
    would sort all of them in one task.
    """
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(key).agg(newest).select(key, "_r.*")


def latest_report(
    reports: DataFrame,
    patients: DataFrame,
    as_of: Column,
    ttl_s: int,
    patient: str = "patient_id",
    created: str = "created_at",
    tie: str = "report_path",
) -> DataFrame:
    """Newest report of each asked-for patient with the status ``ok``, ``expired`` or ``missing``."""
    newest = latest_by(reports.select(patient, created, tie), patient, [created, tie])
    status = (
        F.when(F.col(created).isNull(), F.lit("missing"))
        .when(older_than(as_of, F.col(created), ttl_s), F.lit("expired"))
        .otherwise(F.lit("ok"))
    )
    return patients.select(patient).join(newest, patient, "left").withColumn("status", status)
