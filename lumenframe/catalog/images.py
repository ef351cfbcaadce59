"""Image queries: every embedding is an 8x8 tile, value ``i`` at row ``i div 8``, column ``i mod 8``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.registry import query, table
from lumenframe.functions import pixels
from lumenframe.operators import images
from lumenframe.operators.quality import verify_images, with_pixels
from lumenframe.operators.reports import thumbnail_pixels

SIDE = 8


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, 16-bit tile ``px16``, 8-bit tile ``px8``, shape."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        pixels.stretch_16(F.col("embedding")).alias("px16"),
        pixels.scale_minmax(F.col("embedding")).alias("px8"),
        F.array(F.lit(SIDE), F.lit(SIDE)).alias("shape"),
    )


def by_position(df: DataFrame, px: Column) -> DataFrame:
    return images.explode_pixels(df, px, "vec_id")


# --- SQL building blocks: long form, one row per pixel -----------------------

TILES = """
raw AS (SELECT vec_id, label, unnest(range(len(embedding)))::INT AS pos, unnest(embedding)::DOUBLE AS v
        FROM embeddings),
ext AS (SELECT vec_id, min(v) AS mn, max(v) AS mx FROM raw GROUP BY vec_id),
tile AS (SELECT vec_id, label, pos, pos // 8 AS y, pos % 8 AS x,
                CASE WHEN mx = mn THEN 0 ELSE floor((v - mn) / (mx - mn) * 255.0::DOUBLE) END::INT AS px8,
                CASE WHEN mx = mn THEN 0 ELSE round_even((v - mn) * 65535.0::DOUBLE / (mx - mn), 0) END::INT AS px16
         FROM raw JOIN ext USING (vec_id))"""


def sql_scale(source: str, px: str, how: str, out: str) -> str:
    low = "0" if how == "max" else f"min({px})"
    return f"""
{out}_e AS (SELECT vec_id, {low}::DOUBLE AS mn, max({px})::DOUBLE AS mx FROM {source} GROUP BY vec_id),
{out} AS (SELECT vec_id, y, x,
                 CASE WHEN mx = mn THEN 0 ELSE floor(({px} - mn) / (mx - mn) * 255.0::DOUBLE) END::INT AS px
          FROM {source} JOIN {out}_e USING (vec_id))"""


def _sql_weights(n_in: int, n_out: int, name: str) -> str:
    factor = n_in / n_out
    reach = max(factor, 1.0)
    return f"""
{name}_w AS (SELECT o, s, greatest(0, 1 - abs(s + 0.5::DOUBLE - (o + 0.5::DOUBLE) * {factor!r}::DOUBLE)
                    / {reach!r}::DOUBLE) AS w
             FROM (SELECT unnest(range({n_out})) AS o), (SELECT unnest(range({n_in})) AS s)),
{name} AS (SELECT o, s, floor(w / (sum(w) OVER (PARTITION BY o)) * 4194304 + 0.5::DOUBLE)::BIGINT AS k
           FROM {name}_w)"""


def sql_resize(source: str, n_in: int, n_out: int, out: str) -> str:
    return f"""{_sql_weights(n_in, n_out, out + "_k")},
{out}_h AS (SELECT vec_id, y, o AS x, least(255, ((sum(px * k) + 2097152)::BIGINT >> 22))::INT AS px
            FROM {source} JOIN {out}_k ON s = x GROUP BY vec_id, y, o),
{out} AS (SELECT vec_id, o AS y, x, least(255, ((sum(px * k) + 2097152)::BIGINT >> 22))::INT AS px
          FROM {out}_h JOIN {out}_k ON s = y GROUP BY vec_id, o, x)"""


def sql_blur(source: str, side: int, out: str) -> str:
    return f"""
{out}_k AS (SELECT * FROM (VALUES (-2, 1), (-1, 4), (0, 6), (1, 4), (2, 1)) t(d, k)),
{out}_p AS (SELECT i, d, k, CASE WHEN i + d < 0 THEN -(i + d) WHEN i + d > {side - 1}
                                 THEN {2 * side - 2} - (i + d) ELSE i + d END AS j
            FROM (SELECT unnest(range({side})) AS i), {out}_k),
{out} AS (SELECT vec_id, r.i AS y, c.i AS x, (sum(px * r.k * c.k) + 128)::BIGINT // 256 AS px
          FROM {source} JOIN {out}_p r ON r.j = y JOIN {out}_p c ON c.j = x GROUP BY vec_id, r.i, c.i)"""


def sql_equalize(source: str, out: str) -> str:
    return f"""
{out}_h AS (SELECT vec_id, px, count(*) AS n FROM {source} GROUP BY vec_id, px),
{out}_c AS (SELECT vec_id, px, sum(n) OVER (PARTITION BY vec_id ORDER BY px) AS cdf,
                   first_value(n) OVER (PARTITION BY vec_id ORDER BY px) AS c0,
                   sum(n) OVER (PARTITION BY vec_id) AS total
            FROM {out}_h),
{out}_l AS (SELECT vec_id, px, CASE WHEN total = c0 THEN px
                   ELSE round_even(((cdf - c0)::FLOAT * (255::FLOAT / (total - c0)::FLOAT))::DOUBLE, 0) END::INT AS level
            FROM {out}_c),
{out} AS (SELECT vec_id, y, x, level AS px FROM {source} JOIN {out}_l USING (vec_id, px))"""


NORMAL = "((px::FLOAT / 255::FLOAT) - 0.5::FLOAT) / 0.5::FLOAT"
PX8 = "t8 AS (SELECT vec_id, y, x, px8 AS px FROM tile)"


# --- point operations --------------------------------------------------------


@query(f"WITH {TILES} SELECT vec_id, pos, px8 AS px FROM tile")
def pixels_minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(table(spark, sf_dir, "embeddings"), pixels.scale_minmax(F.col("embedding")))


@query(f"WITH {TILES}, {sql_scale('tile', 'px16', 'max', 's')} SELECT vec_id, y * 8 + x AS pos, px FROM s")
def pixels_max_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), pixels.scale_max(F.col("px16")))


@query(f"""WITH {TILES}, e AS (SELECT vec_id, min(px8) AS lo, max(px8) AS hi FROM tile GROUP BY vec_id)
SELECT vec_id, pos, CASE WHEN hi = lo THEN 0
       ELSE round_even((px8 - lo)::DOUBLE * 65535 / (hi - lo), 0) END::INT AS px
FROM tile JOIN e USING (vec_id)""")
def pixels_8_to_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), pixels.stretch_16(F.col("px8")))


@query(f"""WITH {TILES}, e AS (SELECT vec_id, min(px16) AS lo, max(px16) AS hi FROM tile GROUP BY vec_id)
SELECT vec_id, pos, CASE vec_id % 3 WHEN 0 THEN px16 // 256
       WHEN 1 THEN CASE WHEN hi = lo THEN 0 ELSE floor((px16 - lo)::DOUBLE * 255 / (hi - lo)) END
       ELSE px8 END::INT AS px
FROM tile JOIN e USING (vec_id)""")
def pixels_depth_16_to_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High byte of ``uint16``, min-max of wider values, and 8-bit values as they are."""
    kind = F.col("vec_id") % 3
    px = F.when(kind == 2, F.col("px8")).otherwise(F.col("px16"))
    dtype = F.when(kind == 0, F.lit("uint16")).when(kind == 1, F.lit("int32")).otherwise(F.lit("uint8"))
    staged = tiles(spark, sf_dir).select("vec_id", px.alias("px"), dtype.alias("dtype"))
    return by_position(staged, pixels.display_depth(F.col("px"), F.col("dtype")))


@query(f"WITH {TILES} SELECT vec_id, pos, round(({NORMAL.replace('px', 'px8')})::DOUBLE, 6) AS px FROM tile")
def pixels_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = by_position(tiles(spark, sf_dir), pixels.normalize(pixels.to_unit(F.col("px8"))))
    return rows.withColumn("px", F.round(F.col("px").cast("double"), 6))


@query(f"""WITH {TILES}
SELECT vec_id, pos, floor(({NORMAL.replace('px', 'px8')}) * 127.5::FLOAT + 127.5::FLOAT)::INT AS px FROM tile""")
def pixels_denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), pixels.denormalize(pixels.normalize(pixels.to_unit(F.col("px8")))))


# --- shape operations --------------------------------------------------------


@query(f"WITH {TILES} SELECT vec_id, y, x, px16 AS px, 64 AS n_pixels FROM tile")
def image_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tiles(spark, sf_dir).withColumn("n_pixels", pixels.element_count(F.col("shape")))
    return images.pixel_rows(df, "px16", F.get("shape", 1), "vec_id", "n_pixels")


@query(f"""WITH {TILES}
SELECT vec_id, CASE vec_id % 4 WHEN 2 THEN pos // 4 ELSE pos END AS pos, px16 AS px FROM tile
WHERE CASE vec_id % 4 WHEN 0 THEN true WHEN 1 THEN pos < 16 WHEN 2 THEN pos % 4 = 0 ELSE pos < 8 END""")
def image_frame_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles read as 2-D, as four planes, as four channels, and as a stack of slices."""
    kind = F.col("vec_id") % 4
    dims = lambda *d: F.array(*[F.lit(v) for v in d])
    shape = (
        F.when(kind == 0, dims(8, 8)).when(kind == 1, dims(4, 4, 4)).when(kind == 2, dims(16, 1, 4))
    ).otherwise(dims(8, 1, 8))
    staged = tiles(spark, sf_dir).withColumn("shape", shape)
    return by_position(staged, pixels.select_frame(F.col("px16"), F.col("shape")))


@query(f"""WITH {TILES}
SELECT vec_id, pos, ((px8 & 255) * 9798 + (px16 & 255) * 19235 + (255 - px8) * 3735 + 16384) >> 15 AS px FROM tile""")
def image_rgb_to_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles as colour images: scaled, 16-bit (reduced to its low byte) and inverted values."""
    rgb = F.flatten(F.zip_with("px8", "px16", lambda v, w: F.array(v, w, F.lit(255) - v)))
    staged = tiles(spark, sf_dir).select("vec_id", rgb.alias("rgb"))
    shape = F.array(F.lit(SIDE), F.lit(SIDE), F.lit(3))
    return by_position(staged, pixels.select_frame(F.col("rgb"), shape))


@query(f"WITH {TILES} SELECT vec_id, pos, px16 AS px FROM tile")
def image_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array → little-endian bytes → array."""
    packed = tiles(spark, sf_dir).select("vec_id", images.pack_pixels(F.col("px16"), "uint16").alias("data"))
    return by_position(packed, images.unpack_pixels(F.col("data"), F.lit("uint16")))


# --- neighbourhood operations ------------------------------------------------


@query(f"WITH {TILES} SELECT vec_id, px8 AS px, count(*) AS n FROM tile GROUP BY vec_id, px8")
def pixels_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = images.pixel_rows(tiles(spark, sf_dir), "px8", F.lit(SIDE), "vec_id")
    return images.pixel_histogram(rows, "vec_id")


@query(f"WITH {TILES} SELECT vec_id, min(px16) AS px_min, max(px16) AS px_max FROM tile GROUP BY vec_id")
def pixels_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles(spark, sf_dir).select(
        "vec_id", F.array_min("px16").alias("px_min"), F.array_max("px16").alias("px_max")
    )


@query(f"WITH {TILES}, {PX8}, {sql_equalize('t8', 'e')} SELECT vec_id, y * 8 + x AS pos, px FROM e")
def pixels_equalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), images.equalize(F.col("px8")))


@query(f"WITH {TILES}, {PX8}, {sql_equalize('t8', 'e')} SELECT vec_id, y, x, px FROM e")
def pixels_equalize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational form: histogram, running sum per image, look-up join."""
    rows = images.pixel_rows(tiles(spark, sf_dir), "px8", F.lit(SIDE), "vec_id")
    return images.equalize_rows(rows, "vec_id")


@query(f"WITH {TILES}, {PX8}, {sql_blur('t8', 8, 'b')} SELECT vec_id, y * 8 + x AS pos, px FROM b")
def pixels_blur5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), images.blur5(F.col("px8"), F.col("shape")))


@query(f"WITH {TILES}, {PX8}, {sql_resize('t8', 8, 3, 'r')} SELECT vec_id, y * 3 + x AS pos, px FROM r")
def pixels_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), images.resize(F.col("px8"), F.col("shape"), 3, 3))


@query(f"WITH {TILES}, {PX8}, {sql_resize('t8', 8, 12, 'r')} SELECT vec_id, y * 12 + x AS pos, px FROM r")
def pixels_enlarge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_position(tiles(spark, sf_dir), images.resize(F.col("px8"), F.col("shape"), 12, 12))


# --- the whole chain ---------------------------------------------------------


def image_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles as rows of the ``dicom`` table."""
    return tiles(spark, sf_dir).select(
        "vec_id",
        F.concat(F.lit("gs://tiles/"), F.col("vec_id").cast("string"), F.lit(".dcm")).alias("path"),
        images.pack_pixels(F.col("px16"), "uint16").alias("image_data_bytes"),
        F.col("shape").alias("image_shape"),
        F.lit("uint16").alias("image_dtype"),
        F.lit(None).cast("string").alias("decode_error"),
    )


def sql_chain(how: str, side: int) -> str:
    parts = [TILES, sql_scale("tile", "px16", how, "s")]
    last = "s"
    if side != SIDE:
        parts.append(sql_resize("s", SIDE, side, "r"))
        last = "r"
    return ", ".join([*parts, sql_blur(last, side, "b"), sql_equalize("b", "e")])


@query(f"""WITH {sql_chain('minmax', 6)}
SELECT vec_id, y * 6 + x AS pos, round(({NORMAL})::DOUBLE, 6) AS px FROM e""")
def image_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-max scale → resize → blur → equalise → normalise, as the preprocessing stage runs it."""
    done = images.preprocess_images(image_table(spark, sf_dir), size=(6, 6))
    return by_position(done, F.col("tensor")).withColumn("px", F.round(F.col("px").cast("double"), 6))


@query(f"""WITH {sql_chain('max', 8)}
SELECT vec_id, y * 8 + x AS pos, round(({NORMAL})::DOUBLE, 6) AS px FROM e""")
def image_chain_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = images.preprocess_images(image_table(spark, sf_dir), size=(8, 8), scale="max")
    return by_position(done, F.col("tensor")).withColumn("px", F.round(F.col("px").cast("double"), 6))


@query(f"""WITH {sql_chain('minmax', 8)}
SELECT vec_id, 8 AS rows, 8 AS cols, y * 8 + x AS pos, floor(({NORMAL}) * 127.5::FLOAT + 127.5::FLOAT)::INT AS px FROM e""")
def processed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocessed tensors turned back into storable 8-bit pixels."""
    done = images.processed_images(images.preprocess_images(image_table(spark, sf_dir), size=(8, 8)), "vec_id")
    return images.explode_pixels(done, "pixels", "vec_id", "rows", "cols")


def damaged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image table with one of eight faults in every image, whole images among them."""
    kind = F.col("vec_id") % 8
    dims = lambda *d: F.array(*[F.lit(v) for v in d])
    return (
        image_table(spark, sf_dir)
        .withColumn("image_data_bytes", F.when(kind != 1, F.col("image_data_bytes")))
        .withColumn(
            "image_dtype",
            F.when(kind == 2, F.lit("invalid_dtype")).when(kind == 5, F.lit("int8")).otherwise(F.col("image_dtype")),
        )
        .withColumn(
            "image_shape",
            F.when(kind == 3, dims(8, 9)).when(kind == 4, dims(2, 2, 2, 8)).when(kind == 5, dims(16, 8))
            .when(kind == 6, dims(4, 4, 4)).otherwise(F.col("image_shape")),
        )
        .withColumn("decode_error", F.when(kind == 1, F.lit("file ends early")))
    )


@query("""SELECT vec_id, CASE vec_id % 8
    WHEN 1 THEN 'Missing image data, shape, or dtype for preprocessing'
    WHEN 2 THEN 'Preprocessing error: Unsupported or unknown dtype string: invalid_dtype'
    WHEN 3 THEN 'Preprocessing error: cannot reshape array of 128 bytes into shape (8, 9)'
    WHEN 4 THEN 'Image after initial processing is not 2D, shape: (2, 2, 2, 8)'
    WHEN 5 THEN 'Unsupported numpy dtype for PIL conversion: int8' END AS preprocess_error,
    CASE WHEN vec_id % 8 IN (0, 6, 7) THEN 64 END AS n_elements
FROM embeddings""")
def preprocess_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = images.preprocess_images(damaged_table(spark, sf_dir), size=(8, 8))
    return done.select("vec_id", "preprocess_error", F.size("tensor").alias("n_elements"))


@query(f"""WITH {TILES},
e AS (SELECT vec_id, min(px16) AS lo, max(px16) AS hi, min(px16) FILTER (pos < 16) AS lo0,
             max(px16) FILTER (pos < 16) AS hi0 FROM tile GROUP BY vec_id),
s AS (SELECT *, CASE vec_id % 8 WHEN 1 THEN 'prior_error' WHEN 2 THEN 'bad_dtype' WHEN 3 THEN 'bad_size'
             WHEN 4 THEN 'bad_ndim' WHEN 5 THEN 'bad_dtype' ELSE 'ok' END AS status,
             CASE WHEN vec_id % 8 <> 1 THEN 128 END AS n_bytes,
             CASE vec_id % 8 WHEN 2 THEN NULL WHEN 3 THEN 144 ELSE 128 END AS expected_bytes
      FROM e)
SELECT 'gs://tiles/' || vec_id || '.dcm' AS path,
       CASE vec_id % 8 WHEN 3 THEN '8x9' WHEN 4 THEN '2x2x2x8' WHEN 5 THEN '16x8' WHEN 6 THEN '4x4x4' ELSE '8x8' END AS shape,
       CASE vec_id % 8 WHEN 4 THEN 4 WHEN 6 THEN 3 ELSE 2 END AS ndim,
       n_bytes, expected_bytes, coalesce(n_bytes = expected_bytes, false) AS bytes_ok,
       CASE WHEN status = 'ok' THEN CASE WHEN vec_id % 8 = 6 THEN lo0 ELSE lo END END::DOUBLE AS px_min,
       CASE WHEN status = 'ok' THEN CASE WHEN vec_id % 8 = 6 THEN hi0 ELSE hi END END::DOUBLE AS px_max,
       status
FROM s""")
def verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = verify_images(damaged_table(spark, sf_dir))
    return done.withColumn("shape", F.array_join(F.col("shape").cast("array<string>"), "x"))


@query("SELECT vec_id, 64 AS n_pixels FROM embeddings WHERE vec_id % 8 <> 1")
def images_with_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have pixel bytes and a shape."""
    kept = with_pixels(damaged_table(spark, sf_dir))
    return kept.select("vec_id", (F.octet_length("image_data_bytes") / 2).cast("int").alias("n_pixels"))


@query(f"""WITH {TILES}, f AS (SELECT * FROM tile WHERE vec_id % 2 = 0 OR pos < 16),
e AS (SELECT vec_id, min(px16) AS lo, max(px16) AS hi FROM f GROUP BY vec_id)
SELECT vec_id, pos, px16 // 256 AS by_depth,
       CASE WHEN hi = 0 THEN 0 ELSE floor(px16::DOUBLE / hi * 255) END::INT AS by_max,
       CASE WHEN hi = lo THEN 0 ELSE floor((px16 - lo)::DOUBLE / (hi - lo) * 255) END::INT AS by_minmax
FROM f JOIN e USING (vec_id)""")
def report_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display pixels of 2-D tiles and of the first of four planes, scaled in three ways."""
    planes = F.array(F.lit(4), F.lit(4), F.lit(4))
    shape = F.when(F.col("vec_id") % 2 == 0, F.col("shape")).otherwise(planes)
    staged = tiles(spark, sf_dir).withColumn("shape", shape)
    args = (F.col("px16"), F.col("shape"), F.lit("uint16"))
    scaled = staged.select(
        "vec_id",
        F.arrays_zip(
            *[thumbnail_pixels(*args, how=how).alias(f"by_{how}") for how in ("depth", "max", "minmax")]
        ).alias("_t"),
    )
    return scaled.select("vec_id", F.posexplode("_t").alias("pos", "_p")).select("vec_id", "pos", "_p.*")
