"""DICOM files ↔ tables: uncompressed images, one per row."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.maps import CANONICAL_KEYS, canonical_metadata, error_metadata
from lumenframe.operators import kernels
from lumenframe.operators.images import (
    SUPPORTED_DTYPES,
    check_options,
    preprocess_problem,
    tensor_shape,
)
from lumenframe.operators.scoring import LABELS, LinearHead, Model, label_logits, loaded_model, planned_problem, row_logits, ship_model, width_of
from lumenframe.sources.elements import (
    ELEMENTS,
    EXPLICIT,
    SYNTAXES,
    TAG_OF,
    Dictionary,
    Element,
    as_text,
    encode_element,
    encode_sequence,
    encode_text,
    lookup,
    parse,
    terms_of,
)
from lumenframe.sources.files import (
    binary_files,
    carried,
    fetch_files,
    first_files,
    list_images,
    locate,
    reached_by_tasks,
    read_file,
    spark_listing,
    spark_content,
    spread_listing,
    write_files,
)
from lumenframe.sources.image_source import image_source

CR_IMAGE = "1.2.840.10008.5.1.4.1.1.1"
UTF_8 = "ISO_IR 192"
#: Bound of a dictionary, which goes to every task.
MOST_ELEMENTS = 20_000


def decode_pixels(values: dict[tuple[int, int], Element]) -> tuple[bytes, list[int], str]:
    """Pixel bytes in little-endian order, shape and dtype name."""

    def number(keyword: str, default: int | None = None) -> int:
        element = values.get(TAG_OF[keyword])
        text = as_text(element) if element else None
        if not text and default is None:
            raise ValueError(f"missing {keyword}")
        return int(text) if text else default

    kinds = {"PixelData": None, "FloatPixelData": "float32", "DoubleFloatPixelData": "float64"}
    source = next((k for k in kinds if TAG_OF[k] in values), None)
    if source is None:
        raise ValueError("no pixel data in the file")
    frames, samples = number("NumberOfFrames", 1), number("SamplesPerPixel", 1)
    rows, columns, bits = number("Rows"), number("Columns"), number("BitsAllocated")
    if source == "PixelData" and bits not in (8, 16, 32):
        raise ValueError(f"unsupported pixel width: {bits} bits")
    dtype = kinds[source] or f"{'int' if number('PixelRepresentation', 0) else 'uint'}{bits}"
    count = frames * rows * columns * samples
    size = count * np.dtype(dtype).itemsize
    _, vr, raw, big = values[TAG_OF[source]]
    if len(raw) < size:
        raise ValueError(f"pixel data has {len(raw)} bytes, {size} expected")
    if big:
        # words are swapped as they are wide; two pixels of a byte share one where they were written as words
        wide = max(np.dtype(dtype).itemsize, 2 if vr == "OW" else 1)
        raw = np.frombuffer(raw, "u1", len(raw) // wide * wide).reshape(-1, wide)[:, ::-1].tobytes()
    pixels = bytes(raw[:size])
    if samples > 1 and number("PlanarConfiguration", 0) == 1:
        planes = np.frombuffer(pixels, dtype).reshape(frames, samples, rows, columns)
        pixels = np.ascontiguousarray(planes.transpose(0, 2, 3, 1)).tobytes()
    shape = ([frames] if frames > 1 else []) + [rows, columns] + ([samples] if samples > 1 else [])
    return pixels, shape, dtype


TAG_TYPE = "array<struct<group:int,element:int,keyword:string,vr:string,value:string>>"
DECODED = f"struct<tags:{TAG_TYPE},pixels:binary,shape:array<int>,dtype:string,error:string>"
_ARROW_TAG = pa.struct([("group", pa.int32()), ("element", pa.int32()), ("keyword", pa.string()),
                        ("vr", pa.string()), ("value", pa.string())])
_ARROW_DECODED = pa.struct([("tags", pa.list_(_ARROW_TAG)), ("pixels", pa.binary()),
                            ("shape", pa.list_(pa.int32())), ("dtype", pa.string()),
                            ("error", pa.string())])

PREPARED = f"struct<tags:{TAG_TYPE},shape:array<int>,dtype:string,n_bytes:bigint,tensor:array<float>,error:string>"
_ARROW_PREPARED = pa.struct([("tags", pa.list_(_ARROW_TAG)), ("shape", pa.list_(pa.int32())), ("dtype", pa.string()),
                             ("n_bytes", pa.int64()), ("tensor", pa.list_(pa.float32())),
                             ("error", pa.string())])

SCORED = PREPARED.replace("tensor:array<float>", "logits:array<double>,logits_error:string")
_ARROW_SCORED = pa.struct([f for g in _ARROW_PREPARED for f in (
    (pa.field("logits", pa.list_(pa.float64())), pa.field("logits_error", pa.string())) if g.name == "tensor" else (g,)
)])


def _tag_row(element: Element, terms: tuple[str, ...], dictionary: Dictionary) -> dict:
    try:
        shown = as_text(element, terms)
    except Exception:
        shown = "Error reading value"
    tag = element.tag
    return {"group": tag[0], "element": tag[1], "keyword": lookup(tag, dictionary)[0], "vr": element.vr, "value": shown}


def decode_file(data: bytes, pixels: bool, dictionary: Dictionary = ELEMENTS) -> dict:
    """Tags and pixels of one file; anything that goes wrong becomes its ``error``."""
    row: dict = {"tags": None, "pixels": None, "shape": None, "dtype": None, "error": None}
    try:
        found = parse(data, dictionary)
        terms = terms_of(found)
        row["tags"] = [_tag_row(e, terms, dictionary) for e in found]
        if pixels:
            row["pixels"], row["shape"], row["dtype"] = decode_pixels({e.tag: e for e in found})
    except Exception as e:
        row["error"] = str(e)
    return row


def _prepare(data: bytes, height: int, width: int, how: str) -> dict:
    """Decode one file and preprocess its pixels, which do not leave the task."""
    row = decode_file(data, True)
    pixels, shape, dtype = row.pop("pixels"), row["shape"], row["dtype"]
    row["n_bytes"] = None if pixels is None else len(pixels)
    usable = row["error"] is None and len(shape) in (2, 3) and np.prod(shape) > 0 and dtype in SUPPORTED_DTYPES
    if usable:
        image = np.frombuffer(pixels, np.dtype(dtype).newbyteorder("<")).reshape(1, *shape)
        row["tensor"] = kernels.preprocess(image, dtype, height, width, how)[0]
    return row


@dataclass(frozen=True)
class _Step:
    """What a task makes of one file, and how many such rows are handed back together."""

    run: Callable[[bytes], dict]
    spark_type: str
    arrow_type: pa.StructType
    rows_per_yield: int
    # makes, once per task, what finishes the rows of one yield
    finisher: Callable[[], Callable[[list[dict]], None]] = lambda: lambda rows: None

    def over_listing(self, listing: DataFrame) -> DataFrame:
        """``path``, ``_d``: every file is read by the task that works on it."""
        kept = ["path", *carried(listing)]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finish = self.finisher()
            for batch in batches:
                paths = batch.column("path")
                for start in range(0, len(paths), self.rows_per_yield):
                    part = paths[start : start + self.rows_per_yield]
                    rows = [self.of_path(path) for path in part.to_pylist()]
                    finish(rows)
                    own = [batch.column(c)[start : start + len(part)] for c in kept]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(rows, self.arrow_type)], [*kept, "_d"])

        spread = spread_listing(listing)
        columns = ", ".join(f"{c} {t}" for c, t in spread.dtypes)
        return spread.mapInArrow(work, f"{columns}, _d {self.spark_type}")

    def of_path(self, path: str) -> dict:
        try:
            data = read_file(path)
        except Exception as e:
            return {"error": str(e)}
        return self.run(data)

    def over_content(self, files: DataFrame) -> DataFrame:
        """``path``, ``_d`` of files whose ``content`` Spark has read."""

        @F.arrow_udf(self.spark_type)
        def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            finish = self.finisher()
            for contents in batches:
                for start in range(0, len(contents), self.rows_per_yield):
                    part = contents[start : start + self.rows_per_yield]
                    rows = [self.run(item.as_buffer()) if item.is_valid else {"error": "no content"} for item in part]
                    finish(rows)
                    yield pa.array(rows, self.arrow_type)

        return files.withColumn("_d", work("content"))

    def over(self, files: DataFrame) -> DataFrame:
        return self.over_content(files) if "content" in files.columns else self.over_listing(files)


def _decode_step(pixels: bool, dictionary: Dictionary = ELEMENTS) -> _Step:
    # one image at a time, so that memory holds one image and not a batch of them
    return _Step(lambda data: decode_file(data, pixels, dictionary), DECODED, _ARROW_DECODED, 1 if pixels else 256)


def _prepare_step(size: tuple[int, int], how: str) -> _Step:
    return _Step(lambda data: _prepare(data, *size, how), PREPARED, _ARROW_PREPARED, 32)


def _score_step(size: tuple[int, int], how: str, model: Broadcast) -> _Step:
    def finisher() -> Callable[[list[dict]], None]:
        score_rows = loaded_model(model)

        def finish(rows: list[dict]) -> None:
            tensors = [(row, row.pop("tensor")) for row in rows if "tensor" in row]
            if tensors:
                found = row_logits(score_rows, np.stack([t for _, t in tensors]))
                for (row, _), (logits, error) in zip(tensors, found, strict=True):
                    row["logits"], row["logits_error"] = logits, error

        return finish

    return _Step(lambda data: _prepare(data, *size, how), SCORED, _ARROW_SCORED, 32, finisher)


def _keyword(keyword: str) -> Column:
    """Value of a keyword among the decoded tags."""
    return F.try_element_at(F.filter("_d.tags", lambda t: t["keyword"] == keyword), F.lit(-1))["value"]


def _failure(files: DataFrame) -> Column:
    """Why a file has no image: it could not be fetched, or it could not be decoded."""
    fetched = [F.col("fetch_error")] if "fetch_error" in files.columns else []
    return F.coalesce(*fetched, F.col("_d.error"))


def _with_metadata(decoded: DataFrame, keys: dict[str, str], *rest: Column) -> DataFrame:
    """``path``, ``metadata``, ``rest``, ``decode_error``, ``patient_id`` of a decoded file ``_d``."""
    error = F.col("decode_error")
    metadata = F.when(error.isNull(), canonical_metadata(_keyword, keys)).otherwise(error_metadata(error))
    table = decoded.select("path", metadata.alias("metadata"), *rest, "decode_error", *carried(decoded))
    return table.withColumn("patient_id", F.col("metadata")["patient_id"])


def decode_table(files: DataFrame, keys: dict[str, str] = CANONICAL_KEYS) -> DataFrame:
    """Files → the ``dicom`` table: metadata, pixels, shape, dtype, patient and error.

    ``files`` is a listing (``path``, ``length``), read inside the tasks, or holds
    the ``content`` that Spark has read.
    """
    decoded = _decode_step(True).over(files).withColumn("decode_error", _failure(files))
    return _with_metadata(
        decoded,
        keys,
        F.col("_d.pixels").alias("image_data_bytes"),
        F.col("_d.shape").alias("image_shape"),
        F.col("_d.dtype").alias("image_dtype"),
    )


def preprocess_files(
    files: DataFrame,
    size: tuple[int, int] = (224, 224),
    scale: str = "minmax",
    keys: dict[str, str] = CANONICAL_KEYS,
) -> DataFrame:
    """``preprocess_images(decode_table(files))`` in a single task step.

    The pixels, by far the largest part of the data, never come back from
    Python; over a listing they do not pass through the JVM at all.
    """
    check_options(size, scale)
    checked = _checked(_prepare_step(size, scale).over(files), files)
    good = F.col("preprocess_error").isNull()
    return _with_metadata(
        checked,
        keys,
        F.col("preprocess_error"),
        F.col("_d.tensor").alias("tensor"),
        tensor_shape(good, size).alias("tensor_shape"),
    )


def _checked(decoded: DataFrame, files: DataFrame) -> DataFrame:
    problem = preprocess_problem(F.col("_d.n_bytes"), F.col("_d.shape"), F.col("_d.dtype"))
    return decoded.withColumns({"decode_error": _failure(files), "preprocess_error": problem})


def score_files(
    files: DataFrame,
    model: LinearHead | Model,
    size: tuple[int, int] = (224, 224),
    scale: str = "minmax",
    keys: dict[str, str] = CANONICAL_KEYS,
    labels: tuple[str, ...] = LABELS,
    compat_sentinels: bool = False,
) -> DataFrame:
    """``score(preprocess_files(files), model)`` in a single task step: only tags and logits leave it."""
    check_options(size, scale)
    if model is None:
        raise ValueError("a model must be given")
    shared = ship_model(files.sparkSession, model)
    elements = size[0] * size[1]
    fits = width_of(model) in (None, elements)
    step = _score_step(size, scale, shared) if fits else _prepare_step(size, scale)
    checked = _checked(step.over(files), files)
    missing = F.col("preprocess_error").isNotNull()
    logits = F.col("_d.logits") if fits else F.lit(None).cast("array<double>")
    failed = F.col("_d.logits_error") if fits else F.lit(None).cast("string")
    problem = F.coalesce(planned_problem(missing, elements, model), failed).alias("inference_error")
    table = _with_metadata(checked, keys, F.col("preprocess_error"), problem, logits.alias("_logits"))
    return label_logits(table, missing, labels, compat_sentinels)


def image_files(
    spark: SparkSession,
    base: str,
    max_images: int | None = None,
    listing: DataFrame | None = None,
    through_spark: bool = False,
    through_source: bool = False,
) -> DataFrame:
    """The image files below ``base``, empty ones included, for the steps above.

    By default a listing, whose files the tasks read themselves: measured at
    twice the speed, because pixels do not cross from the JVM to Python.
    ``through_spark`` reads them with Spark's binary file source instead, all but
    those whose names or folders that source skips, which the tasks read.
    ``through_source`` reads them with the data source of ``image_source``, which
    takes over filters on ``path`` and ``length``. A store that only Spark's
    connectors reach is listed by Spark too.
    """
    if listing is None and through_spark and not reached_by_tasks(base):
        found = spark_listing(spark, base)
        if max_images:
            found = found.join(first_files(found, max_images).select("path"), "path", "left_semi")
        content = binary_files(spark, base).select("path", "content", F.lit(None).cast("string").alias("fetch_error"))
        return content.join(found.select("path"), "path", "left_semi") if max_images else content
    if listing is not None:
        listed = listing.select("path", "length")
        listed = first_files(listed, max_images) if max_images else listed
    else:
        listed = list_images(spark, base, max_images=max_images).select("path", "length")
    if through_source:
        return image_source(spark, listing=listed)
    if not through_spark:
        return listed
    if max_images:
        return spark_content(listed)
    if listing is not None:
        raise ValueError("an uncapped listing is read through Spark in slices only: give batch_size")
    _, inner, prefix = locate(base)
    hidden = F.rlike(F.substring("path", len(prefix + inner) + 1, 1 << 20), F.lit("/[_.]"))
    empty = listed.where("length = 0").select("path", F.lit(b"").alias("content"), F.lit(None).cast("string").alias("fetch_error"))
    seen = binary_files(spark, base).where(~hidden).select("path", "content", F.lit(None).cast("string").alias("fetch_error"))
    return seen.unionByName(empty).unionByName(fetch_files(listed.where((F.col("length") > 0) & hidden)))


def read_dicom(
    spark: SparkSession,
    base: str,
    max_images: int | None = None,
    keys: dict[str, str] = CANONICAL_KEYS,
    listing: DataFrame | None = None,
    through_spark: bool = False,
    through_source: bool = False,
) -> DataFrame:
    """The ``dicom`` table of the files below ``base``; unreadable and empty files are error rows."""
    return decode_table(image_files(spark, base, max_images, listing, through_spark, through_source), keys)


def read_dictionary(table: DataFrame) -> Dictionary:
    """Names and types of elements from a table (``group``, ``element``, ``keyword``, ``vr``), beside those built in.

    For vendors' elements and those of the standard that are not built in; the
    whole standard has some five thousand.
    """
    rows = table.select("group", "element", "keyword", "vr").limit(MOST_ELEMENTS + 1).collect()
    if len(rows) > MOST_ELEMENTS:
        raise ValueError(f"a dictionary has at most {MOST_ELEMENTS} elements")
    return {**ELEMENTS, **{(r["group"], r["element"]): (r["keyword"], r["vr"]) for r in rows}}


def dicom_tags(spark: SparkSession, base: str, dictionary: Dictionary = ELEMENTS) -> DataFrame:
    """One row per element of each file: path, group, element, keyword, vr, value."""
    decoded = _decode_step(False, dictionary).over(image_files(spark, base))
    return decoded.select("path", F.inline_outer("_d.tags")).where(F.col("group").isNotNull())


def drop_sequences(tags: DataFrame) -> DataFrame:
    return tags.where(F.col("vr") != "SQ")


def encode_file(
    name: str, pixels: np.ndarray, texts: dict[str, str], syntax: str = EXPLICIT, charset: str = UTF_8, references: Sequence[str] = ()
) -> bytes:
    """A computed-radiography file with 16-bit unsigned ``pixels`` (rows, columns); the same bytes for the same input.

    ``syntax`` is one of the uncompressed ones, ``charset`` the defined terms of the
    character sets that ``texts`` are written in, ``references`` the unique ids of images it refers to.
    """
    uid = "2.25." + str(int(hashlib.md5(name.encode()).hexdigest(), 16))
    how, terms = SYNTAXES[syntax], tuple(charset.split("\\"))
    numbers = {
        "SamplesPerPixel": 1, "Rows": pixels.shape[0], "Columns": pixels.shape[1], "BitsAllocated": 16, "BitsStored": 16,
        "HighBit": 15, "PixelRepresentation": 0,
    }
    raw = {k: struct.pack(f"{how.order}H", v) for k, v in numbers.items()}
    raw |= {k: encode_text(v, terms, ELEMENTS[TAG_OF[k]][1]) for k, v in texts.items()}
    fixed = {"SpecificCharacterSet": charset, "Modality": "CR", "SOPClassUID": CR_IMAGE, "SOPInstanceUID": uid, "PhotometricInterpretation": "MONOCHROME2"}
    raw |= {k: v.encode() for k, v in fixed.items()}
    raw["PixelData"] = pixels.astype(f"{how.order}u2").tobytes()
    parts = {TAG_OF[k]: encode_element(TAG_OF[k], ELEMENTS[TAG_OF[k]][1], v, how) for k, v in raw.items()}
    if references:
        tag, inner = TAG_OF["ReferencedImageSequence"], ("ReferencedSOPClassUID", "ReferencedSOPInstanceUID")
        items = [b"".join(encode_element(TAG_OF[k], "UI", v.encode(), how) for k, v in zip(inner, (CR_IMAGE, r), strict=True)) for r in references]
        parts[tag] = encode_sequence(tag, items, how)
    body = b"".join(parts[tag] for tag in sorted(parts))
    first = {"MediaStorageSOPClassUID": CR_IMAGE, "MediaStorageSOPInstanceUID": uid, "TransferSyntaxUID": syntax}
    meta = b"".join(encode_element(TAG_OF[k], "UI", v.encode()) for k, v in first.items())
    length = encode_element((0x0002, 0x0000), "UL", struct.pack("<I", len(meta)))
    return b"\0" * 128 + b"DICM" + length + meta + body


@cache
def _encode_udf(keywords: tuple[str, ...]):
    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for names, pixels, rows, columns, syntaxes, charsets, references, *texts in batches:
            for i, name in enumerate(names.to_pylist()):
                image = kernels.stretch_16(pixels[i].values.to_numpy(zero_copy_only=False))
                image = image.reshape(rows[i].as_py(), columns[i].as_py())
                named = {k: t[i].as_py() for k, t in zip(keywords, texts)}
                data = encode_file(name, image, named, syntaxes[i].as_py(), charsets[i].as_py(), references[i].as_py())
                yield pa.array([data], pa.binary())

    return run


# Image metadata key → keyword it is stored under.
WRITE_KEYS = {
    "patient_id": "PatientID",
    "patient_name": "PatientName",
    "inference_result": "ImageComments",
    "inference_confidence": "StudyDescription",
    "obs": "SeriesDescription",
}


def write_dicom(df: DataFrame, out_dir: str) -> DataFrame:
    """One file per row of ``name``, ``pixels`` (8-bit), ``rows``, ``cols``, ``metadata``.

    Pixels are stretched to 16 bit. Columns ``syntax``, ``charset`` and
    ``references`` say how, where the table has them (see ``encode_file``);
    otherwise files are explicit little-endian with texts in UTF-8. Returns the manifest of the written files.
    """
    texts = [F.coalesce(F.element_at("metadata", F.lit(k)), F.lit("")) for k in WRITE_KEYS]
    usual = {"syntax": F.lit(EXPLICIT), "charset": F.lit(UTF_8), "references": F.array().cast("array<string>")}
    how = [F.coalesce(F.col(k), v) if k in df.columns else v for k, v in usual.items()]
    content = _encode_udf(tuple(WRITE_KEYS.values()))(
        F.col("name"), F.col("pixels"), F.col("rows").cast("int"), F.col("cols").cast("int"), *how, *texts
    )
    return write_files(df.select("name", content.alias("content")), out_dir)
