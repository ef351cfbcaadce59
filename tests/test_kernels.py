"""Kernels against plain loops, and against the column expressions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays
from pyspark.sql import functions as F

from lumenframe.functions import pixels
from lumenframe.operators import images, kernels
from lumenframe.operators.reports import thumbnail_pixels

sides = st.integers(1, 12)
uint8_stack = st.tuples(st.integers(1, 3), sides, sides).flatmap(lambda s: arrays(np.uint8, s))


@given(uint8_stack)
@settings(max_examples=60, deadline=None)
def test_blur_is_the_mirrored_binomial_sum(stack):
    n, h, w = stack.shape
    k = [1, 4, 6, 4, 1]

    def mirror(i, size):
        while size > 1 and not 0 <= i < size:
            i = -i if i < 0 else 2 * (size - 1) - i
        return i if size > 1 else 0

    got = kernels.blur5(stack)
    for a in range(n):
        for y in range(h):
            for x in range(w):
                total = sum(
                    k[i] * k[j] * int(stack[a, mirror(y + i - 2, h), mirror(x + j - 2, w)])
                    for i in range(5)
                    for j in range(5)
                )
                assert got[a, y, x] == (total + 128) // 256


@given(uint8_stack)
@settings(max_examples=60, deadline=None)
def test_equalize_by_counting(stack):
    n, h, w = stack.shape
    got = kernels.equalize(stack.ravel(), np.full(n, h * w)).reshape(stack.shape)
    for image, out in zip(stack, got):
        lowest = (image == image.min()).sum()
        if lowest == image.size:
            assert (out == image).all()
            continue
        step = np.float32(255) / np.float32(image.size - lowest)
        for value in np.unique(image):
            level = np.rint(np.float32((image <= value).sum() - lowest) * step)
            assert (out[image == value] == level).all()


@given(st.integers(1, 40), st.integers(1, 40))
def test_resize_weights(n_in, n_out):
    pos, weight = kernels.triangle_taps(n_in, n_out)
    assert pos.min() >= 0 and pos.max() < n_in
    assert np.abs(weight.sum(axis=1) - (1 << kernels.WEIGHT_BITS)).max() <= pos.shape[1]
    assert (weight >= 0).all()


@given(uint8_stack, sides, sides)
@settings(max_examples=40, deadline=None)
def test_resize_keeps_range_and_constants(stack, h, w):
    out = kernels.resize(stack, h, w)
    assert out.shape == (len(stack), h, w)
    assert int(out.min()) >= int(stack.min()) - 1 and int(out.max()) <= int(stack.max()) + 1
    assert (kernels.resize(np.full_like(stack, 77), h, w) == 77).all()


@pytest.mark.parametrize("how", ["max", "minmax"])
def test_lookup_scaling_equals_direct_scaling(how):
    rng = np.random.default_rng(5)
    wide = rng.integers(3, 4000, (2, 300, 300)).astype(np.uint16)
    wide[1] = 9
    small = wide.astype(np.int32)
    assert (kernels.scale_to_8bit(wide, how) == kernels.scale_to_8bit(small, how)).all()


CASES = [
    ("uint16", (6, 7)),
    ("uint16", (3, 6, 7)),
    ("uint16", (6, 7, 3)),
    ("uint16", (6, 7, 4)),
    ("uint16", (6, 7, 5)),
    ("uint8", (9, 8)),
    ("uint8", (9, 8, 3)),
    ("int16", (9, 8)),
    ("int32", (5, 5)),
    ("uint32", (5, 5)),
    ("float32", (5, 5)),
    ("float64", (5, 5)),
]


def test_stage_equals_column_expressions(spark):
    """The one-pass stage gives what frame, scale, resize, blur, equalise and normalise give one by one."""
    rng = np.random.default_rng(11)
    rows = []
    for i, (dtype, shape) in enumerate(CASES * 3):
        image = (rng.normal(0, 1000, shape) if dtype.startswith("f") else rng.integers(0, 250, shape)).astype(dtype)
        if i % 5 == 4:
            image[...] = 7
        rows.append((i, image.tobytes(), list(shape), dtype))
    df = spark.createDataFrame(rows, "id int, image_data_bytes binary, image_shape array<int>, image_dtype string")
    stage = images.preprocess_images(df, size=(10, 11)).select("id", "tensor", "preprocess_error")
    px = images.unpack_pixels(F.col("image_data_bytes"), F.col("image_dtype"), "double")
    step = df.select("id", "image_dtype", "image_shape", px.alias("px"))
    whole = F.col("image_dtype").startswith("float")
    frame = F.when(whole, F.col("px")).otherwise(
        pixels.select_frame(F.col("px").cast("array<int>"), F.col("image_shape")).cast("array<double>")
    )
    framed = step.select(
        "id",
        pixels.scale_to_8bit(frame, F.col("image_dtype")).alias("px"),
        pixels.frame_shape(F.col("image_shape")).alias("shape"),
    )
    small = framed.select("id", images.resize(F.col("px"), F.col("shape"), 10, 11).alias("px"))
    soft = small.select("id", images.blur5(F.col("px"), F.array(F.lit(10), F.lit(11))).alias("px"))
    flat = soft.select("id", pixels.normalize(pixels.to_unit(images.equalize(F.col("px")))).alias("wanted"))
    both = stage.join(flat, "id").collect()
    assert len(both) == len(rows)
    for row in both:
        assert row["preprocess_error"] is None
        assert row["tensor"] == row["wanted"], CASES[row["id"] % len(CASES)]


def test_default_size_and_kept_pixels(spark):
    image = (np.arange(32 * 32) % 2000).astype("uint16")
    rows = [("a", image.tobytes(), [32, 32], "uint16"), ("b", image.tobytes(), [32, 32], "invalid_dtype")]
    df = spark.createDataFrame(rows, "path string, image_data_bytes binary, image_shape array<int>, image_dtype string")
    done = {r["path"]: r for r in images.preprocess_images(df, keep_pixels=True).collect()}
    assert done["a"]["tensor_shape"] == [1, 224, 224] and len(done["a"]["tensor"]) == 224 * 224
    assert -1 <= min(done["a"]["tensor"]) and max(done["a"]["tensor"]) == 1
    assert done["a"]["preprocess_error"] is None and done["a"]["image_dtype"] == "uint16"
    assert done["b"]["tensor"] is None and done["b"]["tensor_shape"] is None
    assert "invalid_dtype" in done["b"]["preprocess_error"]
    good, bad = images.split_errors(images.preprocess_images(df), "preprocess_error")
    assert [r["path"] for r in good.select("path").collect()] == ["a"]
    assert [r["path"] for r in bad.select("path").collect()] == ["b"]
    assert "image_data_bytes" not in good.columns


def test_bad_arguments(spark):
    df = spark.createDataFrame([], "image_data_bytes binary, image_shape array<int>, image_dtype string")
    with pytest.raises(ValueError):
        images.preprocess_images(df, scale="log")
    with pytest.raises(ValueError):
        images.preprocess_images(df, size=(0, 4))


def test_zero_and_constant_images(spark):
    df = spark.createDataFrame([([0, 0, 0],), ([9, 9, 9],), ([],), (None,)], "px array<int>")
    rows = df.select(
        pixels.scale_max(F.col("px")).alias("m"),
        pixels.scale_minmax(F.col("px")).alias("mm"),
        pixels.stretch_16(F.col("px")).alias("s"),
        images.equalize(F.col("px")).alias("e"),
    ).collect()
    assert [r["m"] for r in rows] == [[0, 0, 0], [255, 255, 255], [], None]
    assert [r["mm"] for r in rows] == [[0, 0, 0], [0, 0, 0], [], None]
    assert [r["s"] for r in rows] == [[0, 0, 0], [0, 0, 0], [], None]
    assert [r["e"] for r in rows] == [[0, 0, 0], [9, 9, 9], [], None]


def test_stretch_kernel_equals_expression(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.integers(0, 256, n).tolist(),) for n in (1, 2, 64, 500)] + [([7] * 9,), ([],)]
    df = spark.createDataFrame(rows, "px array<int>")
    for row in df.select("px", pixels.stretch_16(F.col("px")).alias("wide")).collect():
        assert kernels.stretch_16(np.array(row["px"], np.int32)).tolist() == row["wide"]


def test_images_must_be_scaled_first(spark):
    df = spark.createDataFrame([([0, 300, 5, 6],)], "px array<int>")
    with pytest.raises(Exception, match="8-bit levels"):
        df.select(images.equalize(F.col("px"))).collect()
    with pytest.raises(Exception, match="8-bit levels"):
        df.select(images.blur5(F.col("px"), F.array(F.lit(2), F.lit(2)))).collect()


@pytest.mark.parametrize("dtype", ["uint8", "uint16", "int16", "uint32"])
@pytest.mark.parametrize("how", ["max", "minmax", "depth"])
def test_thumbnails_from_bytes_are_those_of_the_expressions(spark, dtype, how):
    rng = np.random.default_rng(4)
    stacks = [rng.integers(0, high, size) for high, size in ((200, (4, 6)), (60000 if dtype in ("uint16", "uint32") else 120, (3, 5)), (1, (2, 2)), (90, (3, 4, 5)))]
    rows = [(f"p{k}", x.astype(dtype).tobytes(), list(x.shape), dtype, x.ravel().tolist()) for k, x in enumerate(stacks)]
    rows += [("none", None, [2, 2], dtype, None), ("odd", b"", [], dtype, None)]
    df = spark.createDataFrame(rows, "path string, image_data_bytes binary, image_shape array<int>, image_dtype string, px array<int>")
    shown = {r["path"]: (r["rows"], r["cols"], list(r["pixels"])) for r in images.thumbnails(df, how).collect()}
    plain = df.where("px IS NOT NULL").select("path", thumbnail_pixels(F.col("px"), F.col("image_shape"), F.lit(dtype), how).alias("t")).collect()
    assert {p: v[2] for p, v in shown.items()} == {r["path"]: r["t"] for r in plain}
    assert [shown[f"p{k}"][:2] for k in range(4)] == [x.shape[-2:] for x in stacks]
    small = {r["path"]: (r["rows"], r["cols"], len(r["pixels"])) for r in images.thumbnails(df, how, 3).collect()}
    assert small == {"p0": (2, 3, 6), "p1": (2, 3, 6), "p2": (2, 2, 4), "p3": (2, 3, 6)}
