"""File queries: the tiles written as DICOM files, read back and run through all stages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.images import TILES, sql_blur, sql_equalize, sql_scale, tiles
from lumenframe.catalog.registry import query, table
from lumenframe.catalog.scoring import HEAD, WEIGHT_SQL
from lumenframe.functions.maps import EXTENDED_KEYS
from lumenframe.functions.text import base_name
from lumenframe.operators import ranks
from lumenframe.operators.images import explode_pixels, unpack_pixels
from lumenframe.operators.reports import DISCLAIMER
from lumenframe.plans.stages import Settings, run_pipeline
from lumenframe.session import work_dir
from lumenframe.sources import dicom, elements, files, image_source
from lumenframe.streaming import slices

RUN_TS = "20240305060708"


def written(spark: SparkSession, sf_dir: str) -> str:
    """Write every tile as a file and return the folder."""
    out = work_dir(spark, "dicom")
    name = F.concat(F.lit("tile-"), F.col("vec_id").cast("string"), F.lit(".dcm"))
    metadata = F.create_map(
        F.lit("patient_id"), F.concat(F.lit("P"), F.col("vec_id").cast("string")),
        F.lit("patient_name"), F.concat(F.lit("Tile^"), F.col("label").cast("string")),
        F.lit("inference_result"), F.col("label").cast("string"),
        F.lit("obs"), F.concat(F.lit("série "), F.col("label").cast("string")),
    )
    df = tiles(spark, sf_dir).select(
        name.alias("name"), F.col("px8").alias("pixels"), F.lit(8).alias("rows"), F.lit(8).alias("cols"),
        metadata.alias("metadata"),
    )
    dicom.write_dicom(df, out)
    return out


STORED = f"""{TILES}, e16 AS (SELECT vec_id, min(px8) AS lo, max(px8) AS hi FROM tile GROUP BY vec_id),
stored AS (SELECT vec_id, label, y, x, CASE WHEN hi = lo THEN 0
           ELSE round_even((px8 - lo)::DOUBLE * 65535 / (hi - lo), 0) END::INT AS px16 FROM tile JOIN e16 USING (vec_id))"""


@query(f"""WITH {STORED} SELECT 'tile-' || vec_id || '.dcm' AS name, 'P' || vec_id AS patient_id, 'Tile^' || label AS patient_name,
label::VARCHAR AS infer_results, '' AS infer_confidence, 'série ' || label AS obs, 'uint16' AS image_dtype, 8 AS rows, 8 AS cols,
y * 8 + x AS pos, px16 AS px FROM stored""")
def dicom_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dicom.read_dicom(spark, written(spark, sf_dir), keys=EXTENDED_KEYS)
    flat = df.select(
        base_name(F.col("path")).alias("name"),
        *[F.col("metadata")[k].alias(k) for k in EXTENDED_KEYS.values()],
        "image_dtype",
        F.get("image_shape", 0).alias("rows"),
        F.get("image_shape", 1).alias("cols"),
        unpack_pixels(F.col("image_data_bytes"), F.col("image_dtype")).alias("pixels"),
    )
    return explode_pixels(flat, "pixels", *[c for c in flat.columns if c != "pixels"])


#: Unique id of a file, and the bytes of its header behind the length.
UID_SQL = "'2.25.' || ('0x' || md5(name))::UHUGEINT::VARCHAR"
HEADER_SQL = "({0} + {0} % 2 + 24 + 26 + length(syntax) + length(syntax) % 2)::VARCHAR".format(f"length({UID_SQL})")
ELEMENTS_SQL = f"""SELECT name, t.keyword, t.vr, t.value FROM file, LATERAL (VALUES
  ('FileMetaInformationGroupLength', 'UL', {HEADER_SQL}), ('MediaStorageSOPClassUID', 'UI', '{dicom.CR_IMAGE}'),
  ('MediaStorageSOPInstanceUID', 'UI', {UID_SQL}), ('TransferSyntaxUID', 'UI', syntax), ('SpecificCharacterSet', 'CS', charset),
  ('SOPClassUID', 'UI', '{dicom.CR_IMAGE}'), ('SOPInstanceUID', 'UI', {UID_SQL}), ('Modality', 'CS', 'CR'), ('StudyDescription', 'LO', ''),
  ('SeriesDescription', 'LO', obs), ('PatientName', 'PN', patient), ('PatientID', 'LO', 'P' || vec_id), ('ImageComments', 'LT', label::VARCHAR),
  ('SamplesPerPixel', 'US', '1'), ('PhotometricInterpretation', 'CS', 'MONOCHROME2'), ('Rows', 'US', '8'), ('Columns', 'US', '8'),
  ('BitsAllocated', 'US', '16'), ('BitsStored', 'US', '16'), ('HighBit', 'US', '15'), ('PixelRepresentation', 'US', '0'), ('PixelData', 'OW', NULL)
) t(keyword, vr, value)"""


@query(f"""WITH file AS (SELECT vec_id, label, 'tile-' || vec_id || '.dcm' AS name, '{elements.EXPLICIT}' AS syntax, 'ISO_IR 192' AS charset,
  'Tile^' || label AS patient, 'série ' || label AS obs FROM embeddings) {ELEMENTS_SQL}""")
def dicom_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag table of the files."""
    tags = dicom.drop_sequences(dicom.dicom_tags(spark, written(spark, sf_dir)))
    return tags.select(base_name(F.col("path")).alias("name"), "keyword", "vr", "value")


#: Byte orders, and character sets with a name in each, dealt out by number.
SYNTAX_OF = (elements.EXPLICIT, elements.IMPLICIT, elements.BIG_ENDIAN)
NAME_OF = {
    "ISO_IR 100": "Müller^Jörg",
    "ISO_IR 144": "Иванов^Пётр",
    "\\ISO 2022 IR 87": "Yamada^Tarou=山田^太郎",
    "\\ISO 2022 IR 149": "Hong^Gildong=洪^吉洞=홍^길동",
    "ISO_IR 192": "Wang^XiaoDong=王^小東",
}


def pick_sql(values: Iterable[str]) -> str:
    listed = [f"$${v}$$" for v in values]
    return f"[{', '.join(listed)}][vec_id % {len(listed)} + 1]"


def shown(charset: str) -> str:
    """Defined terms as a tag's value has them."""
    return str(charset.split("\\")) if "\\" in charset else charset


MIXED = f"""file AS (SELECT vec_id, label, 'tile-' || vec_id || '.dcm' AS name, {pick_sql(SYNTAX_OF)} AS syntax, {pick_sql(map(shown, NAME_OF))} AS charset,
  {pick_sql(NAME_OF.values())} || label AS patient, 'obs ' || {pick_sql(NAME_OF.values())} AS obs FROM embeddings)"""


def written_mixed(spark: SparkSession, sf_dir: str) -> str:
    """Write every tile in one of three syntaxes and one of five character sets, each with a sequence; return the folder."""
    out = work_dir(spark, "dicom-mixed")
    number = F.col("vec_id").cast("string")

    def pick(values: Iterable[str]) -> Column:
        listed = [F.lit(v) for v in values]
        return F.get(F.array(*listed), (F.col("vec_id") % len(listed)).cast("int"))

    patient = pick(NAME_OF.values())
    metadata = F.create_map(
        F.lit("patient_id"), F.concat(F.lit("P"), number), F.lit("patient_name"), F.concat(patient, F.col("label").cast("string")),
        F.lit("inference_result"), F.col("label").cast("string"), F.lit("obs"), F.concat(F.lit("obs "), patient),
    )
    df = tiles(spark, sf_dir).select(
        F.concat(F.lit("tile-"), number, F.lit(".dcm")).alias("name"), F.col("px8").alias("pixels"), F.lit(8).alias("rows"), F.lit(8).alias("cols"),
        metadata.alias("metadata"), pick(SYNTAX_OF).alias("syntax"), pick(NAME_OF).alias("charset"), F.array(F.lit("1.2.3"), F.concat(F.lit("1.2."), number)).alias("references"),
    )
    dicom.write_dicom(df, out)
    return out


@query(f"WITH {MIXED} {ELEMENTS_SQL}")
def dicom_syntaxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag table of files in three byte orders and five character sets, whose sequences are dropped."""
    tags = dicom.drop_sequences(dicom.dicom_tags(spark, written_mixed(spark, sf_dir)))
    return tags.select(base_name(F.col("path")).alias("name"), "keyword", "vr", "value")


@query(f"""WITH {STORED} SELECT 'tile-' || vec_id || '.dcm' AS name, {pick_sql(NAME_OF.values())} || label AS patient_name, 'uint16' AS image_dtype,
  y * 8 + x AS pos, px16 AS px FROM stored""")
def dicom_byte_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels and names of the same files."""
    df = dicom.read_dicom(spark, written_mixed(spark, sf_dir))
    flat = df.select(
        base_name(F.col("path")).alias("name"), F.col("metadata")["patient_name"].alias("patient_name"), "image_dtype",
        unpack_pixels(F.col("image_data_bytes"), F.col("image_dtype")).alias("pixels"),
    )
    return explode_pixels(flat, "pixels", *[c for c in flat.columns if c != "pixels"])


@query("""SELECT 'tile-' || vec_id || '.dcm' AS name, CASE vec_id % 3 WHEN 1 THEN 'empty file' WHEN 2 THEN 'file ends inside element (7fe0,0010)' END AS decode_error,
  CASE vec_id % 3 WHEN 0 THEN 'P' || vec_id ELSE '' END AS patient_id FROM embeddings""")
def dicom_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole, empty and cut-off files: every one gives a row."""
    source = files.binary_files(spark, written(spark, sf_dir)).select(base_name(F.col("path")).alias("name"), "content")
    number = F.regexp_extract("name", "([0-9]+)", 1).cast("long")
    content = (
        F.when(number % 3 == 0, F.col("content")).when(number % 3 == 1, F.lit(b""))
    ).otherwise(F.substring("content", 1, F.octet_length("content") - 20))
    out = work_dir(spark, "dicom-damaged")
    files.write_files(source.withColumn("content", content), out)
    df = dicom.read_dicom(spark, out)
    return df.select(base_name(F.col("path")).alias("name"), "decode_error", "patient_id")


@query("SELECT 'tile-' || vec_id || '.dcm' AS name, true AS has_size FROM embeddings")
def list_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = files.list_images(spark, written(spark, sf_dir))
    return listed.select(base_name(F.col("path")).alias("name"), (F.col("length") > 128).alias("has_size"))


@query(f"""WITH {STORED}, image AS (SELECT 'tile-' || vec_id || '.dcm' AS name, 'P' || vec_id AS patient_id, sum(px16) AS px_sum
  FROM stored GROUP BY vec_id)
SELECT 'all' AS asked, * FROM image UNION ALL SELECT 'of 1', * FROM image WHERE name LIKE 'tile-1%'""")
def image_files_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All images through the data source, and those that a filter leaves, which the source takes over."""
    out = written(spark, sf_dir)
    some = image_source.image_source(spark, out).where(F.contains("path", F.lit("/tile-1")))
    tables = {"all": dicom.read_dicom(spark, out, through_source=True), "of 1": dicom.decode_table(some)}
    total = F.aggregate(unpack_pixels(F.col("image_data_bytes"), F.col("image_dtype")), F.lit(0.0), lambda a, p: a + p).cast("long")
    parts = [t.select(F.lit(asked).alias("asked"), base_name(F.col("path")).alias("name"), "patient_id", total.alias("px_sum")) for asked, t in tables.items()]
    return parts[0].unionByName(parts[1])


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, content): every document as a file."""
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".dcm"))
    return table(spark, sf_dir, "documents").select(name.alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))


DOCUMENT_FILES = "SELECT 'doc-' || doc_id || '.dcm' AS name, octet_length(encode(coalesce(text, ''))) AS length FROM documents"


@query(DOCUMENT_FILES)
def listing_by_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat folder, listed by tasks of at most a hundred names each."""
    out = work_dir(spark, "flat")
    files.write_files(document_files(spark, sf_dir), out)
    listed = files.walk_files(spark, out, most=100).where(F.endswith("path", F.lit(".dcm")))
    return listed.select(base_name(F.col("path")).alias("name"), "length")


@query(f"""WITH f AS (SELECT name, length, length + {files.OPEN_BYTES} AS w FROM ({DOCUMENT_FILES})),
t AS (SELECT sum(w) AS total, least(greatest(12, ceil(sum(w) / {1 << 20}.0)), count(*))::BIGINT AS n FROM f),
b AS (SELECT name, length, w, sum(w) OVER (ORDER BY name) - w AS before FROM f)
SELECT name, length, least(floor((before + w / 2.0::DOUBLE) * n / total), n - 1)::INT AS task FROM b, t""")
def tasks_of_equal_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a listing by the task that reads them, a megabyte to a task."""
    sized = document_files(spark, sf_dir).select(F.col("name").alias("path"), F.octet_length("content").cast("long").alias("length"))
    tasks, _ = files.task_numbers(sized, 1 << 20, 12)
    return tasks.select(F.col("path").alias("name"), "length", "task")


@query(f"""WITH f AS (SELECT name, length, row_number() OVER (ORDER BY name) - 1 AS r, greatest(1, count(*) OVER () // 8) AS size FROM ({DOCUMENT_FILES}))
SELECT name, length, r // size AS slice, 1 AS n_times FROM f""")
def slices_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored listing as a stream of some eight slices: the first run breaks off in its third slice, half the files come later."""
    folder = work_dir(spark, "restarted")
    listed = document_files(spark, sf_dir).select(F.col("name").alias("path"), F.octet_length("content").cast("long").alias("length"))
    calls = []

    def handle(n: int, files: DataFrame) -> None:
        files.withColumn("slice", F.lit(n)).write.mode("overwrite").parquet(f"{folder}/out/batch={n}")
        calls.append(n)
        if calls == [0, 1, 2]:
            raise InterruptedError("lost while the third slice is being done")

    ranked = ranks.global_rank(listed, "path")
    size = max(1, ranked.count() // 8)
    for part in (ranked.where(F.col("rank") <= 4 * size), ranked):
        slices.add_slices(spark, f"{folder}/plan", part, size)
        for _ in range(2):  # the second time goes on where the first one was lost
            try:
                slices.run_slices(spark, f"{folder}/plan", handle, f"{folder}/checkpoint")
                break
            except StreamingQueryException:
                continue
    rows = spark.read.parquet(f"{folder}/out").groupBy(F.col("path").alias("name"), "length", F.col("slice").cast("long").alias("slice"))
    return rows.agg(F.count("*").alias("n_times"))


STAGED = f"""WITH {STORED}, {sql_scale('stored', 'px16', 'minmax', 's')}, {sql_blur('s', 8, 'b')}, {sql_equalize('b', 'e')},
feat AS (SELECT vec_id, y * 8 + x AS pos, (((px::FLOAT / 255::FLOAT) - 0.5::FLOAT) / 0.5::FLOAT)::DOUBLE AS f FROM e),
logit AS (SELECT vec_id, sum(f * ({WEIGHT_SQL[0]}) ORDER BY pos) + 0.25::DOUBLE AS z0,
                 sum(f * ({WEIGHT_SQL[1]}) ORDER BY pos) - 0.25::DOUBLE AS z1 FROM feat GROUP BY vec_id),
prob AS (SELECT vec_id, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM logit)
SELECT 'P' || vec_id AS patient_id, CASE WHEN e0 >= e1 THEN 'NORMAL' ELSE 'PNEUMONIA' END AS prediction,
  round(greatest(e0, e1) / (e0 + e1) * 100, 6) AS confidence, 'Report generated successfully.' AS report_status,
  'X-Ray Inference Report' || chr(10) || 'Report Generated: 2024-03-05 06:07:08' || chr(10) || 'Patient & Image Information' || chr(10)
  || 'Patient ID: P' || vec_id || chr(10) || 'Original Image Path: ' || chr(10) || 'Patient Name: Tile^' || label || chr(10)
  || 'Observation/Series: série ' || label || chr(10) || 'Inference Results' || chr(10)
  || 'Prediction: ' || CASE WHEN e0 >= e1 THEN 'NORMAL' ELSE 'PNEUMONIA' END || chr(10)
  || 'Confidence: ' || printf('%.2f%%', greatest(e0, e1) / (e0 + e1) * 100) || chr(10) || '{DISCLAIMER}' AS body
FROM prob JOIN embeddings USING (vec_id)"""


def _staged(spark: SparkSession, sf_dir: str, keep: tuple[str, ...], batch_size: int | None) -> DataFrame:
    out = work_dir(spark, "staged")
    settings = Settings(model=HEAD, size=(8, 8), keep=keep)
    reports = run_pipeline(spark, written(spark, sf_dir), out, settings, RUN_TS, batch_size=batch_size)
    # the folder has another name each time
    body = F.regexp_replace("body", "Original Image Path: [^\n]*", "Original Image Path: ")
    return reports.select("patient_id", "prediction", F.round("confidence", 6).alias("confidence"), "report_status", body.alias("body"))


@query(STAGED)
def staged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files → dicom → preprocessed → inference → reports, every stage stored."""
    return _staged(spark, sf_dir, ("dicom", "preprocessed", "inference", "reports"), None)


@query(STAGED)
def one_pass_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one pass over the files: only the results are stored."""
    return _staged(spark, sf_dir, ("reports",), None)


@query(STAGED)
def sliced_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in slices of 250 files."""
    return _staged(spark, sf_dir, ("inference", "reports"), 250)


@query(f"""WITH {STORED}, top AS (SELECT vec_id, max(px16) AS hi FROM stored GROUP BY vec_id)
SELECT 'P' || vec_id AS patient_id, 8 AS rows, 8 AS cols, y * 8 + x AS pos, CASE WHEN hi = 0 THEN 0 ELSE floor(px16::DOUBLE / hi * 255) END::INT AS level
FROM stored JOIN top USING (vec_id)""")
def report_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images that the reports of a staged run show."""
    settings = Settings(model=HEAD, size=(8, 8), keep=("dicom", "reports"), thumbnails="max")
    reports = run_pipeline(spark, written(spark, sf_dir), work_dir(spark, "shown"), settings, RUN_TS)
    levels = unpack_pixels(F.col("thumbnail.pixels"), F.lit("uint8"))
    shown = reports.select("patient_id", F.col("thumbnail.rows").alias("rows"), F.col("thumbnail.cols").alias("cols"), levels.alias("level"))
    return explode_pixels(shown, "level", "patient_id", "rows", "cols").withColumnRenamed("px", "level")
