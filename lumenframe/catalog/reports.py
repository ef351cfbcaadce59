"""Report queries: scored tiles with patients taken from the customer table."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.registry import query, table
from lumenframe.catalog.scoring import HEAD, SCORES, scored_table
from lumenframe.operators import reports, summaries
from lumenframe.plans.stages import Settings, run_reports
from lumenframe.session import work_dir
from lumenframe.sources import report_files
from lumenframe.sources.snapshots import write_snapshot

RUN_TS = "2024-03-05 06:07:08"


def _generated() -> F.Column:
    return F.lit(RUN_TS).cast("timestamp_ntz").cast("timestamp")


def report_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored images of a patient each; some have no metadata, some no score."""
    kind = F.col("vec_id") % 7
    metadata = F.create_map(
        F.lit("patient_id"), F.col("c_name"),
        F.lit("patient_name"), F.concat(F.lit("Name of "), F.col("c_mktsegment")),
        F.lit("obs"), F.repeat(F.concat(F.col("c_mktsegment"), F.lit(" ")), 1 + F.col("vec_id").cast("int") % 12),
    )
    patients = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "vec_id")
    return (
        scored_table(spark, sf_dir)
        .join(patients, "vec_id", "left")
        .select(
            "vec_id",
            F.concat(F.lit("gs://bucket/"), F.repeat(F.lit("deep/"), F.col("vec_id").cast("int") % 20),
                     F.col("vec_id").cast("string"), F.lit(".dcm")).alias("path"),
            F.coalesce("c_name", F.lit("")).alias("patient_id"),
            F.when((kind != 2) & F.col("c_name").isNotNull(), metadata).alias("metadata"),
            F.when(kind != 4, F.col("prediction")).alias("prediction"),
            F.when(kind != 4, F.round("confidence", 4)).alias("confidence"),
            "inference_error",
        )
    )


INPUT = f"""{SCORES},
inp AS (SELECT s.vec_id, 'gs://bucket/' || repeat('deep/', (s.vec_id % 20)::INT) || s.vec_id || '.dcm' AS path,
  s.vec_id || '.dcm' AS base, coalesce(c_name, '') AS patient_id, s.vec_id % 7 <> 2 AND c_name IS NOT NULL AS has_meta,
  c_name AS m_id, 'Name of ' || c_mktsegment AS m_name,
  repeat(c_mktsegment || ' ', (1 + s.vec_id % 12)::INT) AS m_obs,
  CASE WHEN s.vec_id % 7 <> 4 THEN prediction END AS prediction,
  CASE WHEN s.vec_id % 7 <> 4 THEN round(confidence, 4) END AS confidence
  FROM scored s LEFT JOIN customer c ON c.c_custkey = s.vec_id)"""


def _sql_lines(rows: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT path, {i} AS ord, '{section}' AS section, {text} AS text FROM inp"
        for i, (section, text) in enumerate(rows, start=1)
    ]
    return f"WITH {INPUT} " + " UNION ALL ".join(parts)


def _lines(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), layout)
    return reports.report_lines(built)


def _or_na(value: str) -> str:
    return f"coalesce(nullif({value}, ''), 'N/A')"


@query(_sql_lines([
    ("title", "'X-Ray Inference Report'"),
    ("note", f"'Report Generated: {RUN_TS}'"),
    ("heading", "'Patient & Image Information'"),
    ("info", f"'Patient ID: ' || {_or_na('patient_id')}"),
    ("info", "'Original Image Path: ' || CASE WHEN length(path) > 70 THEN left(path, 35) || '...' || right(path, 30) ELSE path END"),
    ("info", "'Patient Name: ' || CASE WHEN has_meta THEN m_name ELSE 'N/A (metadata issue)' END"),
    ("info", "'Observation/Series: ' || CASE WHEN has_meta THEN m_obs ELSE 'N/A (metadata issue)' END"),
    ("heading", "'Inference Results'"),
    ("result", "'Prediction: ' || coalesce(prediction, 'N/A')"),
    ("result", "CASE WHEN confidence IS NULL THEN 'N/A' ELSE 'Confidence: ' || printf('%.2f%%', confidence) END"),
    ("note", "'" + reports.DISCLAIMER + "'"),
]))
def report_lines_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "full")


def _sql_truncate(value: str) -> str:
    return f"CASE WHEN length({value}) > 80 THEN left({value}, 77) || '...' ELSE {value} END"


@query(_sql_lines([
    ("title", "'DICOM Report'"),
    ("info", "'Patient ID: ' || CASE WHEN has_meta THEN m_id ELSE 'N/A' END"),
    ("info", "'Patient Name: ' || CASE WHEN has_meta THEN m_name ELSE 'N/A' END"),
    ("info", _sql_truncate("('Study Desc: ' || CASE WHEN has_meta THEN m_obs ELSE 'N/A' END)")),
    ("info", "'File: ' || base"),
    ("heading", "'Inference Results:'"),
    ("result", "'Prediction: ' || coalesce(prediction, 'None')"),
    ("result", "'Confidence: ' || CASE WHEN confidence IS NULL THEN 'N/A' ELSE printf('%.1f%%', confidence) END"),
]))
def report_lines_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "compact")


@query("SELECT * FROM (" + _sql_lines([
    ("title", "'X-Ray Analysis Report'"),
    ("info", "'Patient Id: ' || m_id"),
    ("info", "'Patient Name: ' || m_name"),
    ("info", "'Study Description: N/A'"),
    ("info", "'Inference Prediction: ' || coalesce(prediction, 'N/A')"),
    ("info", "'Inference Confidence: ' || CASE WHEN confidence IS NULL THEN 'N/A' ELSE printf('%.2f%%', confidence) END"),
]).replace("FROM inp", "FROM inp WHERE has_meta") + ")")
def report_lines_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports without metadata are refused in this layout and have no lines."""
    return _lines(spark, sf_dir, "keys")


@query("SELECT * FROM (" + _sql_lines([
    ("title", "'DICOM Report'"),
    ("info", "'Patient ID: ' || CASE WHEN has_meta THEN m_id ELSE '' END"),
]) + f") UNION ALL SELECT * FROM (WITH {INPUT}"
    + " UNION ALL ".join(
        f" SELECT path, {i} AS ord, 'info' AS section, {value} AS text FROM inp WHERE has_meta"
        for i, value in ((3, "'patient_id: ' || m_id"), (4, "'patient_name: ' || m_name"), (5, "'obs: ' || m_obs"))
    ) + ")")
def report_lines_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "metadata")


@query(f"""WITH {INPUT} SELECT path, patient_id, prediction, confidence,
  CASE WHEN prediction = 'PNEUMONIA' THEN 'red' ELSE 'green' END AS highlight,
  CASE WHEN has_meta THEN 'reports/report_' || patient_id || '_' || vec_id || '.pdf' END AS report_path,
  CASE WHEN has_meta THEN 'Report generated successfully.' ELSE 'Missing metadata for report generation' END AS report_status,
  NULL::VARCHAR AS inference_error FROM inp""")
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), "keys", naming="patient")
    return built.drop("lines", "body")


@query(f"""WITH {INPUT} SELECT count(*) AS total, count(*) FILTER (has_meta) AS successful FROM inp""")
def report_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), "keys")
    return summaries.report_success(built)


@query(f"""WITH {INPUT} SELECT 'reports/' || replace(substr(path, 6), '/', '_') || '.pdf' AS report_path FROM inp WHERE has_meta""")
def good_report_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), "keys")
    return summaries.good_reports(built).select("report_path")


@query(f"""WITH {INPUT} SELECT path, prediction, confidence, CASE WHEN has_meta THEN m_obs END AS obs FROM inp""")
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON reports, read back field by field."""
    documents = reports.report_json(report_input(spark, sf_dir))
    schema = "struct<metadata:map<string,string>,prediction:string,confidence:double,path:string>"
    return documents.select(F.from_json("value", schema).alias("_j")).select(
        "_j.path", "_j.prediction", "_j.confidence", F.col("_j.metadata")["obs"].alias("obs")
    )


@query(f"""WITH {INPUT} SELECT path, prediction, confidence, patient_id, CASE WHEN has_meta THEN
  'X-Ray Analysis Report' || chr(10) || 'Patient Id: ' || m_id || chr(10) || 'Patient Name: ' || m_name || chr(10) || 'Study Description: N/A'
  || chr(10) || 'Inference Prediction: ' || coalesce(prediction, 'N/A') || chr(10)
  || 'Inference Confidence: ' || CASE WHEN confidence IS NULL THEN 'N/A' ELSE printf('%.2f%%', confidence) END END AS text FROM inp""")
def stored_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report documents written as JSON files and read back."""
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), "keys")
    folder = reports.write_reports(built, work_dir(spark, "reports"), "20240305060708")
    schema = "path string, prediction string, confidence double, patient_id string, lines array<struct<text:string>>"
    stored = spark.read.schema(schema).json(folder)
    text = F.array_join(F.transform("lines", lambda line: line["text"]), "\n")
    return stored.select("path", "prediction", "confidence", "patient_id", text.alias("text"))


@query(f"""WITH {INPUT} SELECT 'reports/' || replace(substr(path, 6), '/', '_') || '.pdf' AS report_path, confidence FROM inp
WHERE path IS NOT NULL""")
def report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of the newest of two stored scored runs; the older one has no rows of its own."""
    out = work_dir(spark, "report-run")
    scored = report_input(spark, sf_dir)
    write_snapshot(scored.withColumn("path", F.lit("gs://old/x.dcm")), f"{out}/inference", "20230101000000")
    write_snapshot(scored, f"{out}/inference", "20240305060708")
    done = run_reports(spark, out, Settings(model=HEAD), "20240305060709")
    return done.select("report_path", "confidence")


BODY_SQL = """'X-Ray Inference Report' || chr(10) || 'Report Generated: {stamp}' || chr(10) || 'Patient & Image Information' || chr(10)
  || 'Patient ID: ' || coalesce(nullif(patient_id, ''), 'N/A') || chr(10)
  || 'Original Image Path: ' || CASE WHEN length(path) > 70 THEN left(path, 35) || '...' || right(path, 30) ELSE path END || chr(10)
  || 'Patient Name: ' || CASE WHEN has_meta THEN m_name ELSE 'N/A (metadata issue)' END || chr(10)
  || 'Observation/Series: ' || CASE WHEN has_meta THEN m_obs ELSE 'N/A (metadata issue)' END || chr(10)
  || 'Inference Results' || chr(10) || 'Prediction: ' || coalesce(prediction, 'N/A') || chr(10)
  || CASE WHEN confidence IS NULL THEN 'N/A' ELSE 'Confidence: ' || printf('%.2f%%', confidence) END || chr(10) || '{end}'""".format(
    stamp=RUN_TS, end=reports.DISCLAIMER
)


@query(f"""WITH {INPUT} SELECT md5(path)[1:20] AS hash, {BODY_SQL} AS text FROM (SELECT * REPLACE (
  CASE WHEN vec_id % 2 = 0 THEN 'gs://bucket/a/' ELSE 'gs://bucket/a_' END || (vec_id // 2) || '.dcm' AS path) FROM inp)""")
def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document a report, of paths that only differ in a slash; the first run breaks off in the middle."""
    half = F.floor(F.col("vec_id") / 2).cast("string")
    start = F.when(F.col("vec_id") % 2 == 0, F.lit("gs://bucket/a/")).otherwise(F.lit("gs://bucket/a_"))
    built = reports.build_reports(report_input(spark, sf_dir).withColumn("path", F.concat(start, half, F.lit(".dcm"))), _generated(), "full", naming="unique")
    folder = work_dir(spark, "documents")
    lost = F.when(F.crc32(F.col("path").cast("binary")) % 50 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("body"))
    try:
        reports.write_reports(built.withColumn("body", lost), folder, "20240305060708", "documents")
    except PySparkException:
        if report_files.is_complete(f"{folder}/run_ts=20240305060708"):
            raise
    out = reports.write_reports(built, folder, "20240305060708", "documents")
    stored = spark.read.option("pathGlobFilter", "*.txt").text(out, wholetext=True)
    manifest = report_files.read_manifest(spark, out)
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)[.]txt$", 1)
    found = stored.select(F.element_at(F.split(name, "-"), -1).alias("hash"), F.col("value").alias("text"))
    listed = manifest.select(F.element_at(F.split(F.regexp_extract("path", "([^/]+)[.]txt$", 1), "-"), -1).alias("hash"))
    return found.join(listed, "hash")


@query(f"""WITH {INPUT} SELECT path, prediction, confidence, CASE WHEN has_meta THEN m_id END AS patient_id,
  CASE WHEN has_meta THEN m_name END AS patient_name, CASE WHEN has_meta THEN m_obs END AS obs FROM inp""")
def report_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON reports written as files and read back, all fields of them."""
    folder = reports.write_json_reports(report_input(spark, sf_dir), work_dir(spark, "json-reports"), "20240305060708")
    schema = "metadata map<string,string>, prediction string, confidence double, path string"
    stored = spark.read.schema(schema).json(folder)
    return stored.select("path", "prediction", "confidence", *[F.col("metadata")[k].alias(k) for k in ("patient_id", "patient_name", "obs")])


@query(f"WITH {INPUT} SELECT path, {BODY_SQL} AS text FROM inp")
def report_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written to files of many and taken apart again; the path is that in the reports' table."""
    built = reports.build_reports(report_input(spark, sf_dir), _generated(), "full")
    folder = reports.write_reports(built, work_dir(spark, "text-reports"), "20240305060708", "text")
    stored = spark.read.option("lineSep", reports.REPORT_END).text(folder)
    bodies = stored.groupBy(F.col("value").alias("text")).agg(F.count("*").alias("n"))
    paths = built.select("path", F.col("body").alias("text"))
    counted = paths.groupBy("text").agg(F.count("*").alias("m"))
    return paths.join(bodies.join(counted, "text").where("n = m"), "text").select("path", "text")
