"""Report tables: one report row per image, its lines, and its sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions import text, times
from lumenframe.functions.maps import entry_lines, get_or, or_empty, with_entries
from lumenframe.functions.pixels import display_depth, first_frame, scale_max, scale_minmax
from lumenframe.operators.quality import require_columns
from lumenframe.sources.report_files import write_documents

REQUIRED = ["path", "patient_id", "metadata", "prediction", "confidence"]

# Report wording.
DISCLAIMER = (
    "Disclaimer: This report is auto-generated and for informational purposes only. "
    "Consult a qualified medical professional for diagnosis."
)
# What ends a report in a file of many.
REPORT_END = "\f\n"
KEY_ORDER = ("patient_id", "patient_name", "study_description", "Inference_Prediction", "Inference_Confidence")


def _line(section: str, value: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), value.alias("text"))


def _labelled(section: str, label: str, value: Column) -> Column:
    return _line(section, F.concat(F.lit(f"{label}: "), value))


def _full(generated: Column) -> Column:
    metadata = F.col("metadata")
    present = F.size(or_empty(metadata)) > 0
    from_metadata = lambda key: F.when(present, get_or(metadata, [key])).otherwise(
        F.lit("N/A (metadata issue)")
    )
    confidence = F.col("confidence")
    return F.array(
        _line("title", F.lit("X-Ray Inference Report")),
        _labelled("note", "Report Generated", times.display_time(generated)),
        _line("heading", F.lit("Patient & Image Information")),
        _labelled("info", "Patient ID", text.or_default(F.col("patient_id"))),
        _labelled("info", "Original Image Path", text.or_default(text.elide_path(F.col("path")))),
        _labelled("info", "Patient Name", from_metadata("patient_name")),
        _labelled("info", "Observation/Series", from_metadata("obs")),
        _line("heading", F.lit("Inference Results")),
        _labelled("result", "Prediction", text.or_default(F.col("prediction"))),
        _line(
            "result",
            F.when(confidence.isNull(), F.lit("N/A")).otherwise(
                F.concat(F.lit("Confidence: "), text.percent_text(confidence))
            ),
        ),
        _line("note", F.lit(DISCLAIMER)),
    )


def _compact() -> Column:
    metadata = or_empty(F.col("metadata"))
    info = [
        ("Patient ID", get_or(metadata, ["patient_id"])),
        ("Patient Name", get_or(metadata, ["patient_name"])),
        ("Study Desc", get_or(metadata, ["StudyDescription", "obs"])),
        ("File", text.base_name(F.col("path"))),
    ]
    return F.array(
        _line("title", F.lit("DICOM Report")),
        *[_line("info", text.truncate_line(F.concat(F.lit(f"{label}: "), value))) for label, value in info],
        _line("heading", F.lit("Inference Results:")),
        _labelled("result", "Prediction", F.coalesce(F.col("prediction"), F.lit("None"))),
        _labelled("result", "Confidence", text.percent_text(F.col("confidence"), 1)),
    )


def report_data(metadata: Column, prediction: Column, confidence: Column) -> Column:
    """Metadata with the result entries added."""
    return with_entries(
        metadata,
        {
            "Inference_Prediction": text.or_default(prediction),
            "Inference_Confidence": text.percent_text(confidence),
        },
    )


def _keys() -> Column:
    data = report_data(F.col("metadata"), F.col("prediction"), F.col("confidence"))
    return F.array(
        _line("title", F.lit("X-Ray Analysis Report")),
        *[
            _line("info", F.concat(text.title_key(F.lit(key)), F.lit(": "), get_or(data, [key])))
            for key in KEY_ORDER
        ],
    )


def _metadata() -> Column:
    metadata = F.col("metadata")
    entries = F.transform(entry_lines(metadata), lambda t: _line("info", t))
    head = F.array(
        _line("title", F.lit("DICOM Report")),
        _labelled("info", "Patient ID", get_or(or_empty(metadata), ["patient_id"], "")),
    )
    return F.concat(head, entries)


def report_body(generated: Column, layout: str) -> Column:
    """Lines of a report as ``array<struct<section,text>>``."""
    layouts = {"full": lambda: _full(generated), "compact": _compact, "keys": _keys, "metadata": _metadata}
    if layout not in layouts:
        raise ValueError(f"layout must be one of {sorted(layouts)}, not {layout!r}")
    return layouts[layout]()


def build_reports(
    df: DataFrame,
    generated: Column,
    layout: str = "full",
    naming: str = "path",
    prefix: str = "reports",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Report summary per image: name, status, lines and text, with earlier errors carried along.

    ``naming`` is ``path`` (from the image path), ``patient`` (patient and file
    name), ``stamped`` (patient and ``generated``) or ``unique`` (file name and a
    hash of the whole path, the only one that tells any two paths apart). All are the same on a retry.
    ``keep`` names further columns to carry along, such as ``metadata``, whose
    texts a layout may cut.
    """
    require_columns(df, REQUIRED)
    names = {
        "path": text.report_name_from_path(F.col("path")),
        "patient": text.report_name_for_patient(F.col("patient_id"), F.col("path")),
        "stamped": text.report_name_stamped(prefix, F.col("patient_id"), times.micro_stamp(generated)),
        "unique": text.report_name_unique(F.col("path")),
    }
    if naming not in names:
        raise ValueError(f"naming must be one of {sorted(names)}, not {naming!r}")
    problem = F.when(F.col("path").isNull(), F.lit("Missing path for report generation"))
    if layout == "keys":
        problem = problem.when(F.col("metadata").isNull(), F.lit("Missing metadata for report generation"))
    errors = [c for c in ("decode_error", "preprocess_error", "inference_error") if c in df.columns]
    lines = F.when(F.col("report_status").isNull(), report_body(generated, layout))
    return (
        df.withColumn("report_status", problem)
        .withColumn("lines", lines)
        .select(
            "path",
            "patient_id",
            "prediction",
            "confidence",
            text.highlight(F.col("prediction")).alias("highlight"),
            F.when(F.col("report_status").isNull(), names[naming]).alias("report_path"),
            F.coalesce("report_status", F.lit("Report generated successfully.")).alias("report_status"),
            "lines",
            F.array_join(F.transform("lines", lambda x: x["text"]), "\n").alias("body"),
            *errors,
            *keep,
        )
    )


def report_lines(reports: DataFrame) -> DataFrame:
    """One row per report line, numbered from 1."""
    return reports.select("path", F.posexplode("lines").alias("_pos", "_line")).select(
        "path", (F.col("_pos") + 1).alias("ord"), "_line.section", "_line.text"
    )


def report_json(df: DataFrame) -> DataFrame:
    """One JSON document per image: metadata, prediction, confidence and path."""
    require_columns(df, ["path", "metadata", "prediction", "confidence"])
    document = F.to_json(F.struct("metadata", "prediction", "confidence", "path"), {"ignoreNullFields": "false"})
    return df.select("path", document.alias("value"))


def write_reports(reports: DataFrame, base: str, run_ts: str, fmt: str = "json") -> str:
    """Write the reports of a run once, into a folder a retry overwrites.

    ``documents`` writes one text file a report, under the last part of its
    name; it needs names that differ (``unique``). ``text`` puts a form feed and
    a line feed (``REPORT_END``) behind each report, by which it can be read back.
    """
    folder = f"{base.rstrip('/')}/run_ts={run_ts}"
    if fmt == "documents":
        named = reports.where(F.col("report_path").isNotNull())
        write_documents(named.select(text.base_name(F.regexp_replace("report_path", "[.]pdf$", ".txt")).alias("name"), F.col("body").alias("content")), folder)
    elif fmt == "text":
        reports.select(F.col("body").alias("value")).write.mode("overwrite").option("lineSep", REPORT_END).text(folder)
    elif fmt in ("json", "parquet"):
        reports.write.mode("overwrite").format(fmt).save(folder)
    else:
        raise ValueError(f"fmt must be 'json', 'parquet', 'text' or 'documents', not {fmt!r}")
    return folder


def write_json_reports(df: DataFrame, base: str, run_ts: str) -> str:
    """Write the JSON documents of a run, one per line, into a folder a retry overwrites."""
    folder = f"{base.rstrip('/')}/run_ts={run_ts}"
    report_json(df).select("value").write.mode("overwrite").text(folder)
    return folder


def thumbnail_pixels(px: Column, shape: Column, dtype: Column, how: str = "depth") -> Column:
    """8-bit pixels of the first frame, for display, by ``max``, ``minmax`` or bit ``depth``."""
    frame = first_frame(px, shape)
    if how == "max":
        return scale_max(frame)
    if how == "minmax":
        return F.when(dtype == "uint8", frame.cast("array<int>")).otherwise(scale_minmax(frame))
    if how == "depth":
        return display_depth(frame, dtype)
    raise ValueError(f"how must be 'max', 'minmax' or 'depth', not {how!r}")
