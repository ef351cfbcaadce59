"""Whole-image neighbourhood kernels on stacks of equally sized 8-bit images.

These run inside Arrow UDF tasks, one Arrow batch at a time. All arithmetic is
integer (or float32 where the published algorithm is), so results do not depend
on the order of summation or on how Spark cut the batches.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from lumenframe.functions.pixels import LUMA

# Fixed value: fraction bits of the resampling weights.
WEIGHT_BITS = 22


@lru_cache(maxsize=256)
def triangle_taps(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Source positions and fixed-point weights, both ``(n_out, taps)``.

    Triangle filter centred on the output pixel, widened by the factor when
    shrinking; weights sum to one before they are rounded.
    """
    factor = n_in / n_out
    reach = max(factor, 1.0)
    centre = (np.arange(n_out) + 0.5) * factor
    taps = min(2 * int(np.ceil(reach)) + 1, n_in)
    first = np.clip(np.floor(centre - reach + 0.5).astype(np.int64), 0, n_in - taps)
    pos = first[:, None] + np.arange(taps)
    weight = np.clip(1.0 - np.abs(pos + 0.5 - centre[:, None]) / reach, 0.0, None)
    weight /= weight.sum(axis=1, keepdims=True)
    return pos, np.floor(weight * (1 << WEIGHT_BITS) + 0.5).astype(np.int32)


def _resample(images: np.ndarray, n_out: int, axis: int) -> np.ndarray:
    n_in = images.shape[axis]
    if n_in == n_out:
        return images
    pos, weight = triangle_taps(n_in, n_out)
    align = [1] * images.ndim
    align[axis] = n_out
    size = list(images.shape)
    size[axis] = n_out
    total = np.full(size, 1 << (WEIGHT_BITS - 1), np.int32)
    for t in range(pos.shape[1]):
        part = np.take(images, pos[:, t], axis=axis, mode="clip").astype(np.int32)
        part *= weight[:, t].reshape(align)
        total += part
    total >>= WEIGHT_BITS
    return np.clip(total, 0, 255, out=total).astype(np.uint8)


def resize(images: np.ndarray, height: int, width: int) -> np.ndarray:
    """Antialiased bilinear resize: horizontal pass, then vertical, 8 bit after each."""
    return _resample(_resample(images, width, 2), height, 1)


def blur5(images: np.ndarray) -> np.ndarray:
    """5x5 binomial blur, border mirrored without repeating the edge pixel."""
    wide = images.astype(np.uint16)
    for axis in (2, 1):
        n = wide.shape[axis]
        pad = [(0, 0)] * 3
        pad[axis] = (2, 2)
        p = np.pad(wide, pad, mode="reflect")
        a, b, c, d, e = (p[(slice(None),) * axis + (slice(k, k + n),)] for k in range(5))
        wide = a + e + 4 * (b + d) + 6 * c
    return ((wide.astype(np.uint32) + 128) >> 8).astype(np.uint8)


def equalize(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Histogram equalisation of images laid end to end in ``values``.

    The lowest occupied level maps to 0 and the highest to 255; an image of a
    single level is unchanged.
    """
    n = len(lengths)
    owner = np.repeat(np.arange(n), lengths)
    hist = np.bincount(owner * 256 + values, minlength=n * 256).reshape(n, 256)
    cdf = hist.cumsum(axis=1)
    base = np.take_along_axis(hist, (hist > 0).argmax(axis=1)[:, None], axis=1)
    spread = cdf[:, -1:] - base
    step = np.float32(255.0) / np.maximum(spread, 1).astype(np.float32)
    level = np.rint((cdf - base).astype(np.float32) * step)
    table = np.where(spread > 0, np.clip(level, 0, 255), np.arange(256)).astype(np.uint8)
    return table[owner, values]


def to_tensor(images: np.ndarray) -> np.ndarray:
    """8-bit levels → float32 in -1..1."""
    half = np.float32(0.5)
    return (images.astype(np.float32) / np.float32(255.0) - half) / half


def _levels(distance: np.ndarray, span: np.ndarray) -> np.ndarray:
    """``trunc(distance / span * 255)``, zero where there is no span."""
    safe = np.where(span > 0, span, 1.0)
    return np.where(span > 0, np.clip(np.floor(distance / safe * 255.0), 0, 255), 0).astype(np.uint8)


def scale_to_8bit(images: np.ndarray, how: str) -> np.ndarray:
    """``max`` or ``minmax`` scaling of each image in a stack, truncated to 8 bit."""
    top = images.max(axis=(1, 2), keepdims=True).astype(np.float64)
    low = np.zeros_like(top) if how == "max" else images.min(axis=(1, 2), keepdims=True).astype(np.float64)
    if images.dtype == np.uint16 and images[0].size > 1 << 16:
        # fewer levels than pixels: scale the levels and look the pixels up
        span, base = (top - low).ravel(), low.ravel()
        tables = [_levels(np.arange(int(t) + 1) - b, s) for t, b, s in zip(top.ravel(), base, span)]
        return np.stack([np.take(table, image, mode="clip") for table, image in zip(tables, images)])
    return _levels(images.astype(np.float64) - low, top - low)


def stretch_16(values: np.ndarray) -> np.ndarray:
    """One image spread over 0..65535, rounded half to even; a constant image gives zeros."""
    x = values.astype(np.float64)
    low, top = (x.min(), x.max()) if x.size else (0.0, 0.0)
    if top == low:
        return np.zeros(len(x), np.uint16)
    return np.rint((x - low) * 65535.0 / (top - low)).astype(np.uint16)


def select_frame(stack: np.ndarray) -> np.ndarray:
    """One 2-D frame per image of a stack ``(n, *shape)``; see ``functions.pixels.select_frame``."""
    if stack.ndim == 3:
        return stack
    if stack.shape[1] >= 5 and stack.shape[3] < 5:
        if stack.shape[3] != 3:
            return stack[..., 0]
        rgb = stack.astype(np.int64) & 255
        return (rgb @ np.array(LUMA) + 16384) >> 15
    return stack[:, 0]


def preprocess(stack: np.ndarray, dtype: str, height: int, width: int, how: str) -> np.ndarray:
    """Frame, scale, resize, blur, equalise and normalise a stack ``(n, *shape)``: ``(n, height * width)`` floats."""
    frame = select_frame(stack)
    # under "minmax" an 8-bit image is already on the target scale
    gray = frame.astype(np.uint8) if dtype == "uint8" and how == "minmax" else scale_to_8bit(frame, how)
    smooth = blur5(resize(gray, height, width))
    flat = equalize(smooth.ravel(), np.full(len(stack), height * width))
    return to_tensor(flat).reshape(len(stack), -1)


def thumbnail(image: np.ndarray, dtype: str, how: str, side: int | None) -> np.ndarray:
    """A 2-D image as 8-bit levels for display, its longer side at most ``side``."""
    values, top, low = image.astype(np.float64), float(image.max()), float(image.min())
    if how == "max":
        levels = np.floor(values / top * 255.0) if top else values
    elif how == "minmax":
        levels = values if dtype == "uint8" else np.floor((values - low) / (top - low) * 255.0) if top > low else values * 0
    elif dtype == "uint16":
        levels = image >> 8
    else:
        levels = values if top <= 255 else np.floor((values - low) * 255.0 / (top - low)) if top > low else values * 0
    levels = levels.astype(np.int64).astype(np.uint8)
    longest = max(levels.shape)
    if side is None or longest <= side:
        return levels
    rows, cols = (max(1, round(n * side / longest)) for n in levels.shape)
    return _resample(_resample(levels[None], cols, 2), rows, 1)[0]
