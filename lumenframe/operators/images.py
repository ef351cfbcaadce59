"""Image column operators that look at a whole image, as Arrow UDFs.

Spark partitions the images; a task sees Arrow batches and handles all images of
one shape in a batch together. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenframe.functions.pixels import element_count
from lumenframe.operators import kernels

# Pixel dtypes that can be scaled to 8 bit.
SUPPORTED_DTYPES = ("uint8", "uint16", "int16", "int32", "uint32", "float32", "float64")
# Why an image cannot be preprocessed.
NO_INPUT = "Missing image data, shape, or dtype for preprocessing"
UNKNOWN_DTYPE = "Preprocessing error: Unsupported or unknown dtype string: "
NOT_2D = "Image after initial processing is not 2D, shape: "
UNSUPPORTED_DTYPE = "Unsupported numpy dtype for PIL conversion: "
# Pixels one kernel call works on, small enough for the processor cache.
CHUNK_PIXELS = 1_000_000


def _lists(values: np.ndarray, lengths: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Arrow list array from values laid end to end."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~valid))


def _flat(px: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, lengths and validity of a list array."""
    valid = px.is_valid().to_numpy(zero_copy_only=False)
    lengths = px.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return px.flatten().to_numpy(zero_copy_only=False), lengths, valid


def _as_levels(values: np.ndarray) -> np.ndarray:
    """Values as 8-bit levels; anything outside 0..255 is a caller's mistake, not to be wrapped."""
    if values.size and (values.min() < 0 or values.max() > 255):
        raise ValueError("pixels must be 8-bit levels; scale the image first")
    return values.astype(np.uint8)


def _by_shape(shapes: pa.Array, usable: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Row positions of each distinct shape, in pieces of bounded size."""
    rows: dict[tuple[int, ...], list[int]] = {}
    for i, shape in enumerate(shapes.to_pylist()):
        if usable[i]:
            rows.setdefault(tuple(shape), []).append(i)
    for shape, members in rows.items():
        step = max(1, CHUNK_PIXELS // max(1, int(np.prod(shape))))
        for start in range(0, len(members), step):
            yield shape, np.array(members[start : start + step])


def _map_images(fn: Callable[[np.ndarray], np.ndarray]):
    """Arrow UDF over (pixels, shape) that applies ``fn`` to stacks of 8-bit images."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for px, shapes in batches:
            values, lengths, valid = _flat(px)
            valid = valid & shapes.is_valid().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            out: list[np.ndarray] = [np.empty(0, np.int32)] * len(px)
            for (h, w), rows in _by_shape(shapes, valid):
                at = starts[rows][:, None] + np.arange(h * w)
                result = fn(_as_levels(values[at]).reshape(len(rows), h, w))
                for row, image in zip(rows, result):
                    out[row] = image.ravel()
            sizes = np.array([len(o) for o in out])
            yield _lists(np.concatenate([*out, np.empty(0, np.int32)]).astype(np.int32), sizes, valid)

    return run


@cache
def _resize_udf(height: int, width: int):
    return _map_images(lambda images: kernels.resize(images, height, width))


@cache
def _blur_udf():
    return _map_images(kernels.blur5)


@cache
def _equalize_udf():
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for px in batches:
            values, lengths, valid = _flat(px)
            yield _lists(kernels.equalize(_as_levels(values), lengths).astype(np.int32), lengths, valid)

    return run


def resize(px: Column, shape: Column, height: int, width: int) -> Column:
    """Resize 2-D 8-bit images; the aspect ratio is not kept."""
    return _resize_udf(height, width)(px, shape)


def blur5(px: Column, shape: Column) -> Column:
    return _blur_udf()(px, shape)


def equalize(px: Column) -> Column:
    return _equalize_udf()(px)


@cache
def _pack_udf(dtype: str):
    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for px in batches:
            values, lengths, valid = _flat(px)
            data = values.astype(np.dtype(dtype).newbyteorder("<"))
            ends = np.cumsum(lengths)
            yield pa.array(
                [data[e - n : e].tobytes() if ok else None for e, n, ok in zip(ends, lengths, valid)], pa.binary()
            )

    return run


@cache
def _unpack_udf(spark_type: str):
    @F.arrow_udf(f"array<{spark_type}>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        target = {"int": np.int32, "bigint": np.int64, "float": np.float32, "double": np.float64}[spark_type]
        for data, dtypes in batches:
            pairs = zip(data, dtypes.to_pylist())
            out = [
                np.frombuffer(b.as_buffer(), np.dtype(d).newbyteorder("<")).astype(target) if b.is_valid and d else None
                for b, d in pairs
            ]
            valid = np.array([o is not None for o in out])
            sizes = np.array([0 if o is None else len(o) for o in out])
            yield _lists(np.concatenate([np.empty(0, target), *[o for o in out if o is not None]]), sizes, valid)

    return run


def pack_pixels(px: Column, dtype: str) -> Column:
    """Array → little-endian bytes."""
    return _pack_udf(dtype)(px)


def unpack_pixels(data: Column, dtype: Column, element: str = "int") -> Column:
    """Little-endian bytes → array; the dtype is given per row and must be supported."""
    return _unpack_udf(element)(data, dtype)


def resolve_dtype(dtype: Column) -> Column:
    """Canonical dtype name; a longer spelling that contains an integer dtype name is accepted."""
    known = [*SUPPORTED_DTYPES, "int8", "int64", "uint64", "bool"]
    within = F.nullif(F.regexp_extract(dtype, "(uint16|int16|uint8|int8)", 1), F.lit(""))
    return F.when(dtype.isin(*known), dtype).otherwise(within)


def dtype_width(dtype: Column) -> Column:
    """Bytes per pixel of a canonical dtype name."""
    bits = F.regexp_extract(dtype, "([0-9]+)$", 1).try_cast("int")
    return F.when(dtype == "bool", F.lit(1)).otherwise(F.shiftright(bits, 3))


@cache
def _preprocess_udf(height: int, width: int, how: str):
    @F.arrow_udf("array<float>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        size = height * width
        rows_out = max(1, CHUNK_PIXELS // size)
        for data, shapes, dtypes in batches:
            for start in range(0, len(data), rows_out):
                part = slice(start, start + rows_out)
                yield _preprocess_part(data[part], shapes[part], dtypes[part], height, width, how)

    return run


def _preprocess_part(
    data: pa.Array, shapes: pa.Array, dtypes: pa.Array, height: int, width: int, how: str
) -> pa.Array:
    usable = data.is_valid().to_numpy(zero_copy_only=False)
    names = np.array(dtypes.to_pylist(), dtype=object)
    tensors = np.zeros((len(data), height * width), np.float32)
    for shape, members in _by_shape(shapes, usable):
        for name in set(names[members]):
            rows = members[names[members] == name]
            dtype = np.dtype(name).newbyteorder("<")
            stack = np.stack([np.frombuffer(data[int(i)].as_buffer(), dtype).reshape(shape) for i in rows])
            tensors[rows] = kernels.preprocess(stack, name, height, width, how)
    lengths = np.where(usable, height * width, 0)
    return _lists(tensors[usable].ravel(), lengths, usable)


def preprocess_problem(n_bytes: Column, shape: Column, dtype: Column) -> Column:
    """Why an image of ``n_bytes`` pixel bytes cannot be preprocessed, or null."""
    name = resolve_dtype(dtype)
    width = dtype_width(name)
    dims = F.array_join(shape.cast("array<string>"), ", ")
    return (
        F.when(
            n_bytes.isNull() | shape.isNull() | (F.size(shape) == 0) | dtype.isNull() | (dtype == ""),
            F.lit(NO_INPUT),
        )
        .when(name.isNull(), F.concat(F.lit(UNKNOWN_DTYPE), dtype))
        .when(
            n_bytes != element_count(shape) * width,
            F.concat(
                F.lit("Preprocessing error: cannot reshape array of "),
                n_bytes.cast("string"),
                F.lit(" bytes into shape ("),
                dims,
                F.lit(")"),
            ),
        )
        .when(
            ~F.size(shape).isin(2, 3),
            F.concat(F.lit(NOT_2D + "("), dims, F.lit(")")),
        )
        .when(element_count(shape) == 0, F.lit("Preprocessing error: image has no pixels"))
        .when(
            ~name.isin(*SUPPORTED_DTYPES),
            F.concat(F.lit(UNSUPPORTED_DTYPE), name),
        )
    )


def check_options(size: tuple[int, int], scale: str) -> None:
    if scale not in ("minmax", "max"):
        raise ValueError(f"scale must be 'minmax' or 'max', not {scale!r}")
    if min(size) < 1:
        raise ValueError(f"size must be positive, not {size!r}")


def tensor_shape(good: Column, size: tuple[int, int]) -> Column:
    return F.when(good, F.array(F.lit(1), F.lit(size[0]), F.lit(size[1])))


def preprocess_images(
    df: DataFrame,
    size: tuple[int, int] = (224, 224),
    scale: str = "minmax",
    keep_pixels: bool = False,
) -> DataFrame:
    """Scale → one gray frame → resize → blur → equalise → normalise, in one pass without a shuffle.

    Needs ``image_data_bytes``, ``image_shape`` and ``image_dtype``. Appends
    ``tensor``, ``tensor_shape`` and ``preprocess_error``; rows that fail are kept
    with their reason and a null tensor. Pixel columns are dropped unless asked for.
    """
    check_options(size, scale)
    data, shape, dtype = F.col("image_data_bytes"), F.col("image_shape"), F.col("image_dtype")
    checked = df.withColumn("preprocess_error", preprocess_problem(F.octet_length(data), shape, dtype))
    good = F.col("preprocess_error").isNull()
    tensor = _preprocess_udf(*size, scale)(F.when(good, data), shape, resolve_dtype(dtype))
    out = checked.withColumns({"tensor": tensor, "tensor_shape": tensor_shape(good, size)})
    return out if keep_pixels else out.drop("image_data_bytes", "image_shape", "image_dtype")


def split_errors(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Good and failed rows of a **written** stage; on a lazy one the UDF would run twice."""
    return df.where(F.col(column).isNull()), df.where(F.col(column).isNotNull())


def explode_pixels(df: DataFrame, px: str | Column, *keys: str) -> DataFrame:
    """One row per array element: ``keys``, ``pos``, ``px``. For tiles, not for full-size images.

    The outer form keeps Spark from adding a not-empty filter below the explode,
    which would run the UDF behind ``px`` a second time.
    """
    return df.select(*keys, F.posexplode_outer(px).alias("pos", "px")).where(F.col("pos").isNotNull())


def pixel_rows(df: DataFrame, px: str, width: Column, *keys: str) -> DataFrame:
    """One row per pixel: ``keys``, ``y``, ``x``, ``px``."""
    rows = explode_pixels(df.withColumn("_w", width), px, "_w", *keys)
    return rows.select(
        *keys, (F.col("pos") / F.col("_w")).cast("int").alias("y"), (F.col("pos") % F.col("_w")).alias("x"), "px"
    )


def pixel_histogram(rows: DataFrame, *keys: str) -> DataFrame:
    """Pixels per level of each image; combined before the shuffle."""
    return rows.groupBy(*keys, "px").agg(F.count("*").alias("n"))


def equalize_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Histogram equalisation of ``pixel_rows``: histogram, running sum, look-up join.

    The window sees one row per occupied level, 256 per image at most, however
    large the image is. For whole images in one row ``equalize`` needs no shuffle.
    """
    by_level = W.partitionBy(*keys).orderBy("px")
    counts = pixel_histogram(rows, *keys).select(
        *keys,
        "px",
        F.sum("n").over(by_level).alias("cdf"),
        F.first("n").over(by_level).alias("base"),
        F.sum("n").over(W.partitionBy(*keys)).alias("total"),
    )
    spread = (F.col("total") - F.col("base")).cast("float")
    step = (F.lit(255.0) / F.nullif(spread, F.lit(0).cast("float"))).cast("float")
    level = F.rint(((F.col("cdf") - F.col("base")).cast("float") * step).cast("double")).cast("int")
    table = counts.select(*keys, "px", F.coalesce(level, F.col("px")).alias("level"))
    return rows.join(table, [*keys, "px"]).select(*keys, "y", "x", F.col("level").alias("px"))


@cache
def _denormalize_udf():
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scale = np.float32(127.5)
        for tensors in batches:
            values, lengths, valid = _flat(tensors)
            yield _lists(np.floor(values.astype(np.float32) * scale + scale).astype(np.int32), lengths, valid)

    return run


def processed_images(df: DataFrame, *keys: str) -> DataFrame:
    """Preprocessed tensors as storable 8-bit images: ``keys``, ``rows``, ``cols``, ``pixels``.

    Failed rows are told by their error, which needs no tensor to be computed.
    The levels are those of ``pixels.denormalize``, made from whole Arrow batches.
    """
    return df.where(F.col("preprocess_error").isNull()).select(
        *keys,
        F.get("tensor_shape", 1).alias("rows"),
        F.get("tensor_shape", 2).alias("cols"),
        _denormalize_udf()("tensor").alias("pixels"),
    )


#: How pixels are spread for display.
DISPLAY = ("max", "minmax", "depth")


@cache
def _thumbnail_udf(how: str, side: int | None):
    schema = pa.struct([("rows", pa.int32()), ("cols", pa.int32()), ("pixels", pa.binary())])

    @F.arrow_udf("struct<rows:int,cols:int,pixels:binary>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for data, shapes, dtypes in batches:
            out = []
            for item, shape, name in zip(data, shapes.to_pylist(), dtypes.to_pylist(), strict=True):
                shown = None
                if item.is_valid and name and shape and len(shape) in (2, 3) and np.prod(shape):
                    image = np.frombuffer(item.as_buffer(), np.dtype(name).newbyteorder("<")).reshape(shape)
                    shown = kernels.thumbnail(image[0] if image.ndim == 3 else image, name, how, side)
                out.append(None if shown is None else {"rows": shown.shape[0], "cols": shown.shape[1], "pixels": shown.tobytes()})
            yield pa.array(out, schema)

    return run


def thumbnails(df: DataFrame, how: str = "max", side: int | None = None, key: str = "path") -> DataFrame:
    """``key``, ``rows``, ``cols``, ``pixels`` (bytes, one a pixel) of the first frame of each decoded image, for display.

    Spread by ``max``, ``minmax`` or bit ``depth`` as ``reports.thumbnail_pixels``
    does, from the stored bytes; an image whose longer side is above ``side`` is
    made smaller, aspect kept. Images that were not decoded have no row.
    """
    if how not in DISPLAY:
        raise ValueError(f"how must be one of {DISPLAY}, not {how!r}")
    known = df.where(F.col("image_data_bytes").isNotNull() & resolve_dtype(F.col("image_dtype")).isNotNull())
    shown = _thumbnail_udf(how, side)("image_data_bytes", "image_shape", resolve_dtype(F.col("image_dtype")))
    return known.select(key, shown.alias("_t")).where("_t IS NOT NULL").select(key, "_t.*")
