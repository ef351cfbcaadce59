"""Report layouts on the fixture row, and the report sinks."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lumenframe.operators import reports, summaries
from lumenframe.operators.quality import require_columns, require_positive, require_rows
from lumenframe.sources import report_files

META = {"patient_id": "ReportTest001", "patient_name": "Reporter One", "study_description": "Chest X-Ray", "error": None}
SCHEMA = (
    "path string, patient_id string, metadata map<string,string>, prediction string, confidence double, "
    "preprocess_error string, inference_error string"
)


def generated():
    return F.to_timestamp(F.lit("20240305060708"), "yyyyMMddHHmmss")


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [
            ("gs://mock-bucket/final_report_test1.dcm", "ReportTest001", META, "PNEUMONIA", 95.5, None, None),
            ("gs://mock-bucket/bad.dcm", None, None, None, None, "no pixels", "Missing tensor"),
        ],
        SCHEMA,
    )


def bodies(df, layout):
    return {r["path"]: r for r in reports.build_reports(df, generated(), layout, naming="patient").collect()}


def test_key_layout_of_the_fixture(scored):
    rows = bodies(scored, "keys")
    good = rows["gs://mock-bucket/final_report_test1.dcm"]
    assert good["report_path"] == "reports/report_ReportTest001_final_report_test1.pdf"
    assert good["body"].split("\n") == [
        "X-Ray Analysis Report", "Patient Id: ReportTest001", "Patient Name: Reporter One",
        "Study Description: Chest X-Ray", "Inference Prediction: PNEUMONIA", "Inference Confidence: 95.50%",
    ]
    assert good["highlight"] == "red"
    bad = rows["gs://mock-bucket/bad.dcm"]
    assert bad["report_path"] is None and "Missing metadata" in bad["report_status"] and bad["lines"] is None
    assert (bad["preprocess_error"], bad["inference_error"]) == ("no pixels", "Missing tensor")


def test_full_layout_without_values(scored):
    bad = bodies(scored, "full")["gs://mock-bucket/bad.dcm"]["body"].split("\n")
    assert bad[1] == "Report Generated: 2024-03-05 06:07:08"
    assert bad[3:7] == [
        "Patient ID: N/A", "Original Image Path: gs://mock-bucket/bad.dcm",
        "Patient Name: N/A (metadata issue)", "Observation/Series: N/A (metadata issue)",
    ]
    assert bad[8:10] == ["Prediction: N/A", "N/A"]


def test_compact_layout_truncates(spark):
    meta = {"patient_id": "p", "patient_name": "n" * 200, "StudyDescription": "study"}
    df = spark.createDataFrame([("gs://b/x/file.dcm", "p", meta, "NORMAL", 66.66, None, None)], SCHEMA)
    lines = bodies(df, "compact")["gs://b/x/file.dcm"]["body"].split("\n")
    assert lines[2] == "Patient Name: " + "n" * 63 + "..." and len(lines[2]) == 80
    assert lines[3:5] == ["Study Desc: study", "File: file.dcm"]
    assert lines[-2:] == ["Prediction: NORMAL", "Confidence: 66.7%"]


def test_metadata_layout_has_all_entries(spark):
    meta = {f"k{i:02d}": str(i) for i in range(22)}
    df = spark.createDataFrame([("gs://b/f.dcm", "p", meta, "NORMAL", 1.0, None, None)], SCHEMA)
    lines = bodies(df, "metadata")["gs://b/f.dcm"]["body"].split("\n")
    assert len(lines) == 2 + 22 and lines[1] == "Patient ID: "


def test_sinks(spark, scored, tmp_path):
    built = reports.build_reports(scored, generated(), "keys")
    for fmt in ("json", "parquet", "text"):
        base = str(tmp_path / fmt)
        for _ in range(2):
            folder = reports.write_reports(built, base, "20240305060708", fmt)
        assert folder.endswith("run_ts=20240305060708")
        read = spark.read.text(folder, lineSep=reports.REPORT_END) if fmt == "text" else spark.read.format(fmt).load(folder)
        assert read.count() == 2
    with pytest.raises(ValueError):
        reports.write_reports(built, str(tmp_path / "x"), "1", "pdf")


def test_json_keeps_nulls(spark, scored, tmp_path):
    folder = reports.write_json_reports(scored, str(tmp_path), "20240305060708")
    assert spark.read.text(folder).count() == 2
    documents = [json.loads(r["value"]) for r in reports.report_json(scored).collect()]
    assert documents[0]["metadata"]["patient_name"] == "Reporter One" and documents[0]["confidence"] == 95.5
    assert documents[1] == {"metadata": None, "prediction": None, "confidence": None, "path": "gs://mock-bucket/bad.dcm"}


def test_success_counts_and_good_paths(spark):
    df = spark.createDataFrame([("reports/a.pdf",), ("ERROR_PDF",), ("",), (None,)], "report_path string")
    assert tuple(summaries.report_success(df).first()) == (4, 1)
    assert [r[0] for r in summaries.good_reports(df).collect()] == ["reports/a.pdf"]


def test_checks(spark, scored):
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        require_columns(scored, ["path", "x", "y"])
    assert require_columns(scored, ["path"]) is scored
    with pytest.raises(ValueError, match="No data found in here"):
        require_rows(scored.limit(0), "here")
    require_positive(max_images=None, batch_size=1_000_000)
    for bad in (0, -1, 1.5, True, "3"):
        with pytest.raises(ValueError):
            require_positive(batch_size=bad)
    with pytest.raises(ValueError):
        reports.build_reports(scored, generated(), "fancy")
    with pytest.raises(ValueError):
        reports.build_reports(scored, generated(), naming="random")


def test_thumbnails(spark):
    df = spark.createDataFrame([([0, 256, 65535, 300, 1, 2, 3, 4],)], "px array<int>")
    shape = F.array(F.lit(2), F.lit(2), F.lit(2))
    row = df.select(
        *[reports.thumbnail_pixels(F.col("px"), shape, F.lit("uint16"), how).alias(how) for how in ("depth", "max", "minmax")]
    ).first()
    assert row["depth"] == [0, 1, 255, 1]
    assert row["max"] == row["minmax"] == [0, 0, 255, 1]


def test_documents_are_whole_or_not_there(spark, tmp_path):
    folder = str(tmp_path / "docs")
    rows = spark.range(200).select(F.format_string("r%03d.txt", "id").alias("name"), F.repeat(F.lit("é"), F.col("id").cast("int")).alias("content"), "id")
    lost = rows.withColumn("content", F.when(F.col("id") % 90 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    with pytest.raises(PySparkException):
        report_files.write_documents(lost, folder)
    assert not report_files.is_complete(folder)
    with pytest.raises(FileNotFoundError):
        report_files.read_manifest(spark, folder)
    assert not list((tmp_path / "docs").glob("_aside/*")) and not list((tmp_path / "docs").glob("_manifest/*.parquet"))
    for _ in range(2):
        manifest = report_files.write_documents(rows, folder)
    assert sorted((r["path"].rsplit("/", 1)[-1], r["length"]) for r in manifest.collect()) == [(f"r{i:03d}.txt", 2 * i) for i in range(200)]
    assert {p.name: p.read_text() for p in (tmp_path / "docs").glob("*.txt")} == {f"r{i:03d}.txt": "é" * i for i in range(200)}
    with pytest.raises(PySparkException):
        report_files.write_documents(rows.union(rows.where("id = 5")), folder)
    empty = report_files.write_documents(rows.limit(0), folder)
    assert empty.count() == 0 and not list((tmp_path / "docs").glob("*.txt"))


def test_names_of_paths_that_look_alike(spark, scored):
    paths = ["gs://b/a/x.dcm", "gs://b/a_x.dcm", "gs://b/a/x.DCM", "s3://b/a/x.dcm", "gs://b/a/x"]
    rows = spark.createDataFrame([(p, "p", META, "NORMAL", 1.0, None, None) for p in paths], SCHEMA)
    names = [r["report_path"] for r in reports.build_reports(rows, generated(), naming="unique").collect()]
    assert len(set(names)) == len(paths) and all(n.startswith("reports/") and n.endswith(".pdf") and n.count("/") == 1 for n in names)
