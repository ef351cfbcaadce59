"""Schema checks, argument checks and the image verification table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.pixels import element_count
from lumenframe.operators.images import SUPPORTED_DTYPES, dtype_width, resolve_dtype


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` itself, or an error that names every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Input DataFrame is missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, where: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"No data found in {where}.")
    return df


def require_positive(**values: int | None) -> None:
    """Sizes and limits must be whole numbers above zero; ``None`` means no limit."""
    for name, value in values.items():
        if value is not None and (not isinstance(value, int) or isinstance(value, bool) or value < 1):
            raise ValueError(f"{name} must be a positive integer, not {value!r}")


def with_pixels(df: DataFrame) -> DataFrame:
    """Decoded images that have pixel bytes and a shape."""
    return df.where(F.col("image_data_bytes").isNotNull() & F.col("image_shape").isNotNull())


@cache
def _range_udf():
    @F.arrow_udf("struct<px_min:double,px_max:double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for data, shapes, dtypes in batches:
            out = []
            for item, shape, name in zip(data, shapes.to_pylist(), dtypes.to_pylist()):
                if not item.is_valid:
                    out.append(None)
                    continue
                image = np.frombuffer(item.as_buffer(), np.dtype(name).newbyteorder("<")).reshape(shape)
                frame = image[0] if image.ndim == 3 else image
                out.append({"px_min": float(frame.min()), "px_max": float(frame.max())})
            yield pa.array(out, pa.struct([("px_min", pa.float64()), ("px_max", pa.float64())]))

    return run


def verify_images(df: DataFrame) -> DataFrame:
    """One verification row per decoded image.

    ``status`` is ``prior_error``, ``no_image``, ``bad_dtype``, ``bad_ndim``,
    ``empty``, ``bad_size`` or ``ok``; the pixel range is that of the first frame.
    """
    data, shape = F.col("image_data_bytes"), F.col("image_shape")
    name = resolve_dtype(F.col("image_dtype"))
    expected = element_count(shape) * dtype_width(name)
    facts = df.select(
        "path",
        F.col("image_shape").alias("shape"),
        F.size(shape).alias("ndim"),
        F.octet_length(data).alias("n_bytes"),
        expected.alias("expected_bytes"),
        F.when(F.col("decode_error").isNotNull(), F.lit("prior_error"))
        .when(data.isNull() | shape.isNull(), F.lit("no_image"))
        .when(~F.coalesce(name, F.lit("")).isin(*SUPPORTED_DTYPES), F.lit("bad_dtype"))
        .when(~F.size(shape).isin(2, 3), F.lit("bad_ndim"))
        .when(element_count(shape) == 0, F.lit("empty"))
        .when(F.octet_length(data) != expected, F.lit("bad_size"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        data.alias("_data"),
        name.alias("_dtype"),
    )
    pixels = F.when(F.col("status") == "ok", F.col("_data"))
    return (
        facts.withColumn("_range", _range_udf()(pixels, F.col("shape"), F.col("_dtype")))
        .withColumn("bytes_ok", F.coalesce(F.col("n_bytes") == F.col("expected_bytes"), F.lit(False)))
        .select("path", "shape", "ndim", "n_bytes", "expected_bytes", "bytes_ok", "_range.px_min", "_range.px_max", "status")
    )
