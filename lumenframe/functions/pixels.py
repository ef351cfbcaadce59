"""Pixel expressions: one image per row, pixels as one flat array in row-major order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15-bit luma weights of red, green and blue (0.299, 0.587, 0.114).
LUMA = (9798, 19235, 3735)


def map_with(px: Column, fn: Callable[[Column, Column], Column], **values: Column) -> Column:
    """``fn(element, values)`` for every element, the ``values`` computed once per row.

    An ``array_max`` inside a plain lambda would be evaluated per element and
    make the expression quadratic. Binding it through an outer lambda does not
    plan under an Arrow UDF in Spark 4.1, so the values ride along as an array
    that repeats one struct.
    """
    once = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.zip_with(px, F.array_repeat(once, F.size(px)), fn)


def _spread(px: Column, low: Column, to_level: Callable[[Column, Column], Column]) -> Column:
    """Map pixels by (distance from ``low``, distance of the maximum from ``low``).

    An image without any such distance gives zeros.
    """
    return map_with(
        px,
        lambda x, s: F.when(s["span"] <= 0, F.lit(0)).otherwise(
            to_level(x.cast("double") - s["low"], s["span"]).cast("int")
        ),
        low=low,
        span=F.array_max(px).cast("double") - low,
    )


def scale_max(px: Column) -> Column:
    """``trunc(x / max * 255)``; an all-zero image stays zero."""
    return _spread(px, F.lit(0.0), lambda d, span: F.floor(d / span * 255.0))


def _from_min(px: Column, to_level: Callable[[Column, Column], Column]) -> Column:
    return _spread(px, F.array_min(px).cast("double"), to_level)


def scale_minmax(px: Column) -> Column:
    """``trunc((x - min) / (max - min) * 255)``; a constant image gives zeros."""
    return _from_min(px, lambda d, span: F.floor(d / span * 255.0))


def stretch_16(px: Column) -> Column:
    """Spread over 0..65535, rounded half to even."""
    return _from_min(px, lambda d, span: F.rint(d * 65535.0 / span))


def scale_to_8bit(px: Column, dtype: Column) -> Column:
    """Min-max scaling for every dtype but ``uint8``, which passes through."""
    return F.when(dtype == "uint8", px.cast("array<int>")).otherwise(scale_minmax(px))


def display_depth(px: Column, dtype: Column) -> Column:
    """8-bit pixels for display: high byte of ``uint16``, else min-max above 255, else as is."""
    ranged = _from_min(px, lambda d, span: F.floor(d * 255.0 / span))
    high_byte = F.transform(px, lambda x: F.shiftright(x.cast("int"), 8))
    return (
        F.when(dtype == "uint16", high_byte)
        .when(F.array_max(px) > 255, ranged)
        .otherwise(px.cast("array<int>"))
    )


def _channel(px: Column, c: int) -> Column:
    """Low byte of every third value, from the ``c``-th on."""
    return F.transform(F.filter(px, lambda _, i: i % 3 == c), lambda x: x.cast("int").bitwiseAND(255))


def rgb_to_gray(px: Column) -> Column:
    """Interleaved RGB → gray, on values reduced to 8 bit first."""
    low_byte = [_channel(px, c).alias(name) for c, name in enumerate("rgb")]
    r, g, b = LUMA
    return F.transform(
        F.arrays_zip(*low_byte), lambda t: F.shiftright(t["r"] * r + t["g"] * g + t["b"] * b + 16384, 15)
    )


def element_count(shape: Column) -> Column:
    """Product of the dimensions."""
    return F.aggregate(shape, F.lit(1).cast("long"), lambda a, d: a * d)


def frame_shape(shape: Column) -> Column:
    """Shape of the single 2-D frame taken from ``shape``; null when there is none."""
    d = [F.get(shape, i) for i in range(3)]
    return (
        F.when(F.size(shape) == 2, shape)
        .when((F.size(shape) == 3) & (d[0] >= 5) & (d[2] < 5), F.array(d[0], d[1]))
        .when(F.size(shape) == 3, F.array(d[1], d[2]))
    )


def first_frame(px: Column, shape: Column) -> Column:
    """First frame of a 3-D image; a 2-D image is its own frame."""
    frame = F.slice(px, 1, F.get(shape, 1) * F.get(shape, 2))
    return F.when(F.size(shape) == 2, px).when(F.size(shape) == 3, frame)


def select_frame(px: Column, shape: Column) -> Column:
    """One 2-D frame of an image.

    Few leading planes: the first. Few trailing channels: gray of three, else
    the first channel. Any other 3-D image: the first slice.
    """
    channels = F.get(shape, 2)
    first_channel = F.filter(px, lambda _, i: i % channels == 0)
    interleaved = (F.size(shape) == 3) & (F.get(shape, 0) >= 5) & (channels < 5)
    return (
        F.when(interleaved & (channels == 3), rgb_to_gray(px))
        .when(interleaved, first_channel.cast("array<int>"))
        .otherwise(first_frame(px, shape).cast("array<int>"))
    )


def to_unit(px: Column) -> Column:
    """8-bit levels → 0..1 as float."""
    return F.transform(px, lambda x: (x.cast("float") / 255.0).cast("float"))


def normalize(unit: Column) -> Column:
    """0..1 → -1..1 as float."""
    half = F.lit(0.5).cast("float")
    return F.transform(unit, lambda x: ((x.cast("float") - half) / half).cast("float"))


def denormalize(tensor: Column) -> Column:
    """-1..1 → 8-bit levels, truncated."""
    scale = F.lit(127.5).cast("float")
    return F.transform(tensor, lambda x: F.floor((x.cast("float") * scale).cast("float") + scale).cast("int"))
