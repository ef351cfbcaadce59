"""Physical plans: what runs in Python, what is read, what is shuffled."""

import pytest
from pyspark.sql import functions as F

from lumenframe.catalog import QUERIES
from lumenframe.catalog.images import image_table
from lumenframe.catalog.scoring import HEAD
from lumenframe.operators import images
from lumenframe.operators.scoring import score
from lumenframe.plans.stages import Settings, stage_plans
from lumenframe.sources import files

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "python_nodes"),
    [("image_chain", 2), ("pixels_equalize", 1), ("flagship", 1), ("score_linear_head", 1), ("verification", 2),
     ("pixels_minmax_scale", 0), ("report_lines_full", 1), ("safe_id", 0), ("run_progress", 0)],
)
def test_python_runs_once(spark, name, python_nodes):
    assert plan(QUERIES[name](spark, SF_DIR)).count("ArrowEvalPython") == python_nodes


def test_per_image_work_never_shuffles(spark):
    done = score(images.preprocess_images(image_table(spark, SF_DIR), size=(8, 8)), HEAD)
    assert "Exchange" not in plan(done)


def test_counts_do_not_compute_tensors(spark):
    done = images.preprocess_images(image_table(spark, SF_DIR), size=(8, 8))
    counted = plan(done.groupBy().agg(F.count_if(F.col("preprocess_error").isNull())))
    assert counted.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("column", ["content", "length"])
@pytest.mark.parametrize(("keep", "python_nodes"), [(("reports",), 1), (("preprocessed", "reports"), 1), (("dicom", "reports"), 2)])
def test_pixels_go_to_python_once_per_step(spark, keep, python_nodes, column):
    df = spark.createDataFrame([], f"path string, {column} {'binary' if column == 'content' else 'long'}")
    for stage in stage_plans(Settings(model=HEAD, size=(8, 8), keep=keep), "20240101000000").values():
        df = stage(df)
    text = plan(df)
    assert text.count("ArrowEvalPython") + text.count("MapInArrow") == python_nodes


def test_listing_does_not_open_files(spark, tmp_path):
    (tmp_path / "a.dcm").write_bytes(b"x")
    assert "binaryFile" not in plan(files.list_images(spark, str(tmp_path)))
    assert "ReadSchema: struct<path:string>" in plan(files.binary_files(spark, str(tmp_path)).select("path"))


def test_columns_are_pruned(spark):
    assert "struct<c_custkey:bigint" in plan(QUERIES["latest_report_lookup"](spark, SF_DIR))
    assert "o_totalprice" not in plan(QUERIES["merge_metadata"](spark, SF_DIR))
    assert "struct<embedding:array<float>>" in plan(QUERIES["flagship"](spark, SF_DIR))


def test_large_sides_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        for name in ("merge_metadata", "unprocessed_files", "latest_report_lookup"):
            assert "BroadcastExchange" not in plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranking_has_no_single_task_sort(spark):
    text = plan(QUERIES["file_batches"](spark, SF_DIR))
    above_counts = text[: text.index("Window")]
    assert "SinglePartition" not in above_counts and text.count("SinglePartition") == 1
