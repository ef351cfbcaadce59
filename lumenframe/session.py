"""Session helpers: a tuned builder and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "lumenframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings image jobs want; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # an image row is large, so batches are bounded by rows as well as by bytes
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    A temporary folder is made only where the setting is absent and the master
    is local; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster is a cluster
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = tempfile.mkdtemp(prefix="lumenframe-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/lumenframe/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
