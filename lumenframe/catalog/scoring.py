"""Scoring queries: a fixed two-class head over the tiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.catalog.images import PX8, SIDE, TILES, image_table, sql_equalize, tiles
from lumenframe.catalog.registry import query, table
from lumenframe.functions import pixels
from lumenframe.operators import images, lookups, model_files, scoring, summaries
from lumenframe.operators.scoring import LABELS, LinearHead, score
from lumenframe.session import work_dir

# Weight i of class 0 and 1, written the same way in SQL.
HEAD = LinearHead(
    weights=(
        tuple((i * 37 % 11 - 5) / 5 for i in range(SIDE * SIDE)),
        tuple((i * 29 % 13 - 6) / 6 for i in range(SIDE * SIDE)),
    ),
    bias=(0.25, -0.25),
)
WEIGHT_SQL = ("((pos * 37 % 11) - 5)::DOUBLE / 5", "((pos * 29 % 13) - 6)::DOUBLE / 6")


class ShiftedHead:
    """A model that is not a linear head: any callable from tensors to logits will do."""

    def __init__(self, head: LinearHead) -> None:
        self.head = head

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        return self.head(batch + 1.0)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled, equalised and normalised tiles as tensors."""
    equal = tiles(spark, sf_dir).withColumn("eq", images.equalize(F.col("px8")))
    return equal.select(
        "vec_id",
        "label",
        F.concat(F.lit("gs://tiles/"), F.col("vec_id").cast("string"), F.lit(".dcm")).alias("path"),
        pixels.normalize(pixels.to_unit(F.col("eq"))).alias("tensor"),
        F.array(F.lit(1), F.lit(SIDE), F.lit(SIDE)).alias("tensor_shape"),
    )


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(feature_table(spark, sf_dir), HEAD)


def sql_scores(feature: str = "f") -> str:
    """CTEs up to ``scored(vec_id, label, prediction, confidence)``."""
    return f"""{TILES}, {PX8}, {sql_equalize('t8', 'e')},
feat AS (SELECT vec_id, y * 8 + x AS pos, (((px::FLOAT / 255::FLOAT) - 0.5::FLOAT) / 0.5::FLOAT)::DOUBLE AS f FROM e),
logit AS (SELECT vec_id, sum({feature} * ({WEIGHT_SQL[0]}) ORDER BY pos) + 0.25::DOUBLE AS z0,
                 sum({feature} * ({WEIGHT_SQL[1]}) ORDER BY pos) - 0.25::DOUBLE AS z1
          FROM feat GROUP BY vec_id),
prob AS (SELECT vec_id, z0, z1, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM logit),
scored AS (SELECT vec_id, label, 'gs://tiles/' || vec_id || '.dcm' AS path,
                  CASE WHEN e0 >= e1 THEN 'NORMAL' ELSE 'PNEUMONIA' END AS prediction,
                  greatest(e0, e1) / (e0 + e1) * 100 AS confidence
           FROM prob JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id))"""


SCORES = sql_scores()


@query(f"WITH {SCORES} SELECT vec_id, prediction, round(confidence, 6) AS confidence FROM scored")
def score_linear_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_table(spark, sf_dir).select("vec_id", "prediction", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {sql_scores('(f + 1)')} SELECT vec_id, prediction, round(confidence, 6) AS confidence FROM scored")
def score_batch_callable(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = score(feature_table(spark, sf_dir), ShiftedHead(HEAD))
    return done.select("vec_id", "prediction", F.round("confidence", 6).alias("confidence"))


def faulty_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensors of which some are missing and some have the wrong number of elements."""
    kind = F.col("vec_id") % 5
    return feature_table(spark, sf_dir).withColumn(
        "tensor", F.when(kind == 3, F.concat("tensor", F.array(F.lit(0.0).cast("float")))).when(kind != 1, F.col("tensor"))
    )


@query("""SELECT vec_id, CASE vec_id % 5 WHEN 1 THEN 'Missing tensor'
    WHEN 3 THEN 'Expected 64 elements, got 65' END AS inference_error FROM embeddings""")
def tensor_size_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faulty_tensors(spark, sf_dir).select(
        "vec_id", scoring.tensor_problem(F.col("tensor"), F.col("tensor_shape")).alias("inference_error")
    )


@query(f"""WITH {SCORES}
SELECT vec_id, CASE vec_id % 5 WHEN 1 THEN 'ERROR_NULL_INPUT' WHEN 3 THEN 'ERROR_INFERENCE_WORKER'
       ELSE prediction END AS prediction,
       CASE WHEN vec_id % 5 IN (1, 3) THEN 0 ELSE round(confidence, 6) END AS confidence FROM scored""")
def score_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = score(faulty_tensors(spark, sf_dir), HEAD, compat_sentinels=True)
    return done.select("vec_id", "prediction", F.round("confidence", 6).alias("confidence"))


@query("""SELECT count(*) AS total, count(*) FILTER (vec_id % 5 NOT IN (1, 3)) AS processed,
       count(*) FILTER (vec_id % 5 IN (1, 3)) AS failed FROM embeddings""")
def score_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a scoring stage failed on, told from its error column."""
    return summaries.stage_summary(score(faulty_tensors(spark, sf_dir), HEAD), "inference_error")


@query("""SELECT p_partkey, 'classifier.' || CASE WHEN p_size % 2 = 0 THEN 'weight' ELSE 'bias' END || '.' || p_name AS name
FROM part""")
def model_param_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter names with and without the prefixes that checkpoints carry."""
    part = table(spark, sf_dir, "part")
    raw = F.concat(
        F.when(F.col("p_partkey") % 3 == 0, F.lit("module.")).otherwise(F.lit("")),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("classifier.1.")).otherwise(F.lit("classifier.")),
        F.when(F.col("p_size") % 2 == 0, F.lit("weight.")).otherwise(F.lit("bias.")),
        F.col("p_name"),
    )
    return scoring.rename_params(part.select("p_partkey", raw.alias("name")))


@query(f"""WITH {SCORES} SELECT vec_id, prediction, round(confidence, 6) AS confidence FROM scored""")
def score_mapped_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same head in a file that the workers map, written from parameter rows of a few values each."""
    folder = work_dir(spark, "mapped")
    flat = [w for row in HEAD.weights for w in row]
    rows = [("module.classifier.1.weight", [2, HEAD.width], at, flat[at : at + 23]) for at in range(0, len(flat), 23)] + [("classifier.bias", [2], 0, list(HEAD.bias))]
    params = spark.createDataFrame(rows, "name string, shape array<int>, offset long, values array<double>")
    params.write.parquet(f"{folder}/params")
    head = model_files.write_mapped_head(spark, spark.read.parquet(f"{folder}/params"), f"{folder}/head-{folder[-12:]}.npy")
    scored = score(feature_table(spark, sf_dir), head)
    return scored.select("vec_id", "prediction", F.round("confidence", 6).alias("confidence"))


@query("""SELECT vec_id, label % 3 AS class, CASE label % 3 WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'PNEUMONIA' ELSE 'UNKNOWN' END AS label
FROM embeddings""")
def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index → label through a label table; index 2 is not in it."""
    names = spark.createDataFrame(list(enumerate(LABELS)), "idx int, label string")
    indexed = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % 3).alias("class"))
    return lookups.attach_labels(indexed, names, "class")


@query(f"WITH {SCORES} SELECT prediction, count(*) AS count FROM scored GROUP BY prediction")
def prediction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.prediction_counts(scored_table(spark, sf_dir))


@query(f"""WITH {SCORES}
SELECT 'count' AS summary, count(prediction)::VARCHAR AS prediction, count(confidence)::DOUBLE AS confidence FROM scored
UNION ALL SELECT 'mean', NULL, round(avg(confidence), 6) FROM scored
UNION ALL SELECT 'stddev', NULL, round(stddev_samp(confidence), 6) FROM scored
UNION ALL SELECT 'min', min(prediction), round(min(confidence), 6) FROM scored
UNION ALL SELECT 'max', max(prediction), round(max(confidence), 6) FROM scored""")
def confidence_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = summaries.describe_confidence(scored_table(spark, sf_dir))
    return done.withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {SCORES}
SELECT prediction, count(*) AS count, round(avg(confidence), 6) AS mean_confidence FROM scored GROUP BY prediction""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale → equalise → normalise → score → count and mean confidence by class."""
    scored = scored_table(spark, sf_dir)
    return scored.groupBy("prediction").agg(
        F.count("*").alias("count"), F.round(F.avg("confidence"), 6).alias("mean_confidence")
    )


@query("""SELECT count(*) AS total, count(*) FILTER (vec_id % 8 IN (0, 6, 7)) AS processed,
       count(*) FILTER (vec_id % 8 NOT IN (0, 6, 7)) AS failed FROM embeddings""")
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lumenframe.catalog.images import damaged_table

    done = images.preprocess_images(damaged_table(spark, sf_dir), size=(8, 8))
    return summaries.stage_summary(done, "preprocess_error")


@query(f"""WITH {SCORES} SELECT path AS image_path, prediction, round(confidence, 6) AS confidence FROM scored""")
def predictions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = summaries.predictions_table(scored_table(spark, sf_dir))
    return done.withColumn("confidence", F.round("confidence", 6))


@query("""SELECT path, missing FROM (SELECT 'gs://tiles/' || vec_id || '.dcm' AS path, 'tensor' AS missing FROM embeddings)""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image rows with the names of the columns a scoring step would miss on them."""
    df = image_table(spark, sf_dir)
    missing = [c for c in ("path", "tensor") if c not in df.columns]
    return df.select("path", F.lit(",".join(missing)).alias("missing"))
