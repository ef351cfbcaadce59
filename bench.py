"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads. Every query
is run once to warm up and then timed while its whole result is produced.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog import QUERIES
from lumenframe.catalog.images import tiles
from lumenframe.operators import images
from lumenframe.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "flagship image_chain image_chain_max pixels_equalize pixels_blur5 pixels_resize pixels_minmax_scale "
    "score_linear_head score_batch_callable confidence_describe verification dicom_roundtrip staged_run one_pass_run "
    "report_lines_full report_json merge_metadata latest_report_lookup unprocessed_files file_batches "
    "run_latest run_listing run_progress safe_id uri_parse latest_snapshot incremental_batches"
).split()
SIDE = 512


def produce(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def full_size_rate(spark: SparkSession) -> float:
    """Images per second through the whole preprocessing chain, 512x512 16-bit → 224x224."""
    folder = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"bench-{os.getpid()}-{time.time_ns()}")
    wide = tiles(spark, SF_DIR).where("vec_id < 800").repartition(int(CPUS)).select(
        images.resize(F.col("px8"), F.col("shape"), SIDE, SIDE).alias("px")
    )
    wide.select(
        images.pack_pixels(F.col("px"), "uint16").alias("image_data_bytes"),
        F.array(F.lit(SIDE), F.lit(SIDE)).alias("image_shape"),
        F.lit("uint16").alias("image_dtype"),
    ).write.parquet(folder)
    stored = spark.read.parquet(folder)
    n = stored.count()
    return round(n / timed(lambda: produce(images.preprocess_images(stored))), 1)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{
            "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run = lambda name=name: produce(QUERIES[name](spark, SF_DIR))
        run()
        seconds[name] = timed(run)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "images_per_sec_512_to_224": full_size_rate(spark),
    }))


if __name__ == "__main__":
    main()
