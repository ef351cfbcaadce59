"""Checks of arguments, columns and models, caps, previews, and rows split by their errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.images import TILES, damaged_table, image_table, tiles
from lumenframe.catalog.registry import query, table
from lumenframe.catalog.scoring import HEAD, feature_table
from lumenframe.functions import maps
from lumenframe.operators import images, previews, quality, scoring
from lumenframe.session import work_dir
from lumenframe.sources import files

#: Columns that a step asks for, by what it is called here.
WANTED = {"scoring": ["path", "tensor", "tensor_shape"], "decoding": ["path", "image_data_bytes"], "reports": ["metadata"]}


def _refusal(check) -> str:
    """Why a check fails; empty if it does not."""
    try:
        check()
    except ValueError as e:
        return str(e)
    return ""


@query("""SELECT 'gs://tiles/' || vec_id || '.dcm' AS path, step, refusal FROM embeddings, (VALUES
  ('scoring', 'Input DataFrame is missing required columns: [''tensor'', ''tensor_shape'']'), ('decoding', ''),
  ('reports', 'Input DataFrame is missing required columns: [''metadata'']')) t(step, refusal)""")
def columns_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image rows beside what each step says to their columns."""
    df = image_table(spark, sf_dir)
    said = [(step, _refusal(lambda columns=columns: quality.require_columns(df, columns))) for step, columns in WANTED.items()]
    return df.select("path").crossJoin(F.broadcast(spark.createDataFrame(said, "step string, refusal string")))


@query("""WITH v AS (SELECT min(n_chars) - max(n_chars) AS below, count(*) - count(DISTINCT doc_id) AS none, max(n_chars) AS most FROM documents)
SELECT name, value, CASE WHEN value < 1 THEN name || ' must be a positive integer, not ' || value ELSE '' END AS refusal
FROM (SELECT 'below' AS name, below AS value FROM v UNION ALL SELECT 'none', none FROM v UNION ALL SELECT 'most', most FROM v)""")
def parameter_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes taken from a table, as limits of a run: those below one are refused."""
    values = table(spark, sf_dir, "documents").agg(
        (F.min("n_chars") - F.max("n_chars")).alias("below"), (F.count("*") - F.countDistinct("doc_id")).alias("none"), F.max("n_chars").alias("most")
    )
    rows = [(n, v, _refusal(lambda n=n, v=v: quality.require_positive(**{n: v}))) for n, v in values.first().asDict().items()]
    return spark.createDataFrame(rows, "name string, value long, refusal string")


@query("""WITH ranked AS (SELECT url AS path, page_id AS length, row_number() OVER (ORDER BY url) AS r, count(*) OVER () AS n FROM pages)
SELECT path, length FROM ranked WHERE r <= n // 3 + 1""")
def listing_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first third of a listing by path: the cap is the feature."""
    pages = table(spark, sf_dir, "pages")
    listing = pages.select(F.col("url").alias("path"), F.col("page_id").alias("length"))
    return files.first_files(listing, pages.count() // 3 + 1)


@query("SELECT url AS path FROM pages ORDER BY url LIMIT 3")
def first_three_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three paths: three is the feature."""
    return previews.first_rows(table(spark, sf_dir, "pages").select(F.col("url").alias("path")), 3, "path")


@query("""SELECT page_id::VARCHAR AS page_id, CASE WHEN length(url) > 20 THEN left(url, 17) || '...' ELSE coalesce(url, 'NULL') END AS url,
  coalesce(nullif(left(url, 0), ''), 'NULL') AS nothing FROM (SELECT * FROM pages ORDER BY page_id LIMIT 20)""")
def rows_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rows as they are shown: twenty is the feature."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.lit(None).cast("string").alias("nothing"))
    return previews.shown_rows(pages.select("page_id", "url", "nothing"), 20, "page_id")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'obs: ' || event_type || chr(10) || 'user: ' || user_id
  ELSE 'k: ' || json_extract_string(props, '$.k') || chr(10) || 'obs: ' || event_type END AS lines FROM events""")
def metadata_entries_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two entries of metadata that has two or three."""
    props = F.when(F.col("event_id") % 5 != 0, F.from_json("props", "map<string,string>"))
    more = F.create_map(F.lit("obs"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    metadata = F.map_concat(maps.or_empty(props), more)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(maps.entry_lines(metadata, 2), "\n").alias("lines"))


def _split(df: DataFrame, spark: SparkSession, column: str) -> DataFrame:
    """Rows of a stage, stored and read again, with the side that they are put on."""
    folder = work_dir(spark, "split")
    df.write.parquet(folder)
    sides = images.split_errors(spark.read.parquet(folder), column)
    parts = [side.select("vec_id", F.lit(name).alias("side"), column) for name, side in zip(("good", "failed"), sides, strict=True)]
    return parts[0].unionByName(parts[1])


@query("SELECT vec_id, CASE WHEN vec_id % 8 IN (0, 6, 7) THEN 'good' ELSE 'failed' END AS side FROM embeddings")
def preprocessed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and failed rows of the preprocessing stage."""
    done = images.preprocess_images(damaged_table(spark, sf_dir), size=(8, 8))
    return _split(done, spark, "preprocess_error").select("vec_id", "side")


@query("""SELECT vec_id, CASE WHEN vec_id % 4 = 1 OR vec_id % 4 = 2 THEN 'failed' ELSE 'good' END AS side,
  CASE vec_id % 4 WHEN 1 THEN 'Missing tensor' WHEN 2 THEN 'Expected 64 elements, got 63' END AS inference_error FROM embeddings""")
def scored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and failed rows of the scoring stage: some tensors are missing, some too short."""
    kind, tensor = F.col("vec_id") % 4, F.col("tensor")
    features = feature_table(spark, sf_dir).withColumn("tensor", F.when(kind == 1, F.lit(None)).when(kind == 2, F.slice(tensor, 1, 63)).otherwise(tensor))
    return _split(scoring.score(features, HEAD), spark, "inference_error")


@query("""WITH m AS (SELECT label % 2 AS c, count(*)::DOUBLE AS a, sum(vec_id)::DOUBLE AS b, min(vec_id)::DOUBLE AS z FROM embeddings GROUP BY 1)
SELECT 'whole' AS model, 'loaded' AS outcome, c AS class, a AS first_weight, b AS second_weight, z AS bias FROM m
UNION ALL SELECT 'no path', 'a model path must be given', NULL, NULL, NULL, NULL
UNION ALL SELECT 'no bias', 'must hold classifier.weight and classifier.bias once each', NULL, NULL, NULL, NULL
UNION ALL SELECT 'odd shape', 'parameter shapes do not fit together', NULL, NULL, NULL, NULL""")
def model_loading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A head made of sums over a table, loaded whole; without a path, a bias or the right shape loading fails."""
    sums = table(spark, sf_dir, "embeddings").groupBy((F.col("label") % 2).alias("c"))
    rows = F.sort_array(F.collect_list(F.struct("c", F.array("a", "b").alias("w"), "z")))  # two classes
    one = sums.agg(F.count("*").cast("double").alias("a"), F.sum("vec_id").cast("double").alias("b"), F.min("vec_id").cast("double").alias("z")).agg(rows.alias("r"))
    weight = one.select(F.lit("module.classifier.1.weight").alias("name"), F.array(F.lit(2), F.lit(2)).alias("shape"), F.flatten(F.transform("r", lambda x: x["w"])).alias("values"))
    bias = one.select(F.lit("module.classifier.1.bias").alias("name"), F.array(F.lit(2)).alias("shape"), F.transform("r", lambda x: x["z"]).alias("values"))
    wide = weight.withColumn("shape", F.array(F.lit(2), F.lit(3)))
    out = []
    for model, parts in {"no path": None, "no bias": weight, "odd shape": wide.union(bias), "whole": weight.union(bias)}.items():
        folder = parts and work_dir(spark, "head")
        if parts is not None:
            parts.write.parquet(folder)
        try:
            head = scoring.load_linear_head(spark, folder)
            out += [(model, "loaded", c, *w, b) for c, (w, b) in enumerate(zip(head.weights, head.bias, strict=True))]
        except ValueError as e:
            out.append((model, str(e).removeprefix(f"{folder} ").removeprefix(f"{folder}: "), None, None, None, None))
    return spark.createDataFrame(out, "model string, outcome string, class long, first_weight double, second_weight double, bias double")


@query(f"""WITH {TILES} SELECT vec_id, 256 AS n_bytes, pos, ((px8::FLOAT / 255::FLOAT) - 0.5::FLOAT)::DOUBLE AS px
FROM (SELECT vec_id, y * 8 + x AS pos, px8 FROM tile)""")
def tensor_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensors as 32-bit floats in bytes and back."""
    unit = F.transform("px8", lambda p: ((p.cast("float") / F.lit(255.0).cast("float")).cast("float") - F.lit(0.5).cast("float")).cast("float"))
    packed = tiles(spark, sf_dir).select("vec_id", images.pack_pixels(unit, "float32").alias("data"))
    read = packed.select("vec_id", F.octet_length("data").alias("n_bytes"), images.unpack_pixels(F.col("data"), F.lit("float32"), "float").alias("px"))
    return images.explode_pixels(read, "px", "vec_id", "n_bytes").withColumn("px", F.col("px").cast("double"))
