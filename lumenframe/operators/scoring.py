"""Two-class scoring: tensors in, label and confidence out, errors in their own column."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.pixels import element_count
from lumenframe.functions.vectors import argmax, dot, label_of, softmax

# Class index → label.
LABELS = ("NORMAL", "PNEUMONIA")
# Heads up to this width are plain expressions; wider ones go through Arrow, with the same result to the last bit.
NATIVE_WIDTH = 1024
# Most parameter values a head may have; they are broadcast to every task.
MAX_PARAMETERS = 5_000_000

# Largest pickled model that is sent to every executor.
MAX_MODEL_BYTES = 1 << 30
NOT_FINITE = "Inference failed: scores that are not finite"
MISSING_TENSOR = "Missing tensor"

Model = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class LinearHead:
    """One weight row and one bias per class."""

    weights: tuple[tuple[float, ...], ...]
    bias: tuple[float, ...]

    def __post_init__(self) -> None:
        if len(self.weights) != len(self.bias) or not self.weights:
            raise ValueError("a head needs one bias per weight row")
        if len({len(row) for row in self.weights}) != 1:
            raise ValueError("all weight rows of a head must have one length")

    @property
    def width(self) -> int:
        return len(self.weights[0])

    @cached_property
    def _arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.weights, dtype=np.float64), np.array(self.bias, dtype=np.float64)

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        """Logits, each summed in element order as the column expression does, whatever the width and the batch."""
        weights, bias = self._arrays
        if not weights.shape[1]:
            return np.tile(bias, (len(batch), 1))
        sums = [np.cumsum(row.astype(np.float64) * weights, axis=1)[:, -1] for row in batch]
        return np.array(sums).reshape(len(batch), len(bias)) + bias


def rename_parameter(name: Column) -> Column:
    """Drop a leading ``module.`` and turn a leading ``classifier.1.`` into ``classifier.``."""
    return F.regexp_replace(F.regexp_replace(name, r"^module\.", ""), r"^classifier\.1\.", "classifier.")


def rename_params(params: DataFrame) -> DataFrame:
    return params.withColumn("name", rename_parameter(F.col("name")))


def load_linear_head(spark: SparkSession, path: str | None) -> LinearHead:
    """Read ``(name, shape, values)`` rows and build the head; any gap fails the job."""
    if not path:
        raise ValueError("a model path must be given")
    params = rename_params(spark.read.parquet(path)).where(
        F.col("name").isin("classifier.weight", "classifier.bias")
    )
    total, rows = params.agg(F.sum(F.size("values")), F.count("*")).first()
    if rows != 2:
        raise ValueError(f"{path} must hold classifier.weight and classifier.bias once each")
    if total > MAX_PARAMETERS:
        raise ValueError(f"{path} holds {total} head parameters, more than {MAX_PARAMETERS}; write_mapped_head makes a file of them")
    found = {r["name"]: r for r in params.collect()}
    weight, bias = found["classifier.weight"], found["classifier.bias"]
    if weight["shape"][0] != len(bias["values"]) or int(np.prod(weight["shape"])) != len(weight["values"]):
        raise ValueError(f"{path}: parameter shapes do not fit together")
    matrix = np.array(weight["values"], dtype=np.float64).reshape(weight["shape"])
    return LinearHead(tuple(map(tuple, matrix.tolist())), tuple(map(float, bias["values"])))


def _wrong_size(wanted: Column, got: Column) -> Column:
    text = F.concat(F.lit("Expected "), wanted.cast("string"), F.lit(" elements, got "), got.cast("string"))
    return F.when(got != wanted, text)


def width_of(model: LinearHead | Model) -> int | None:
    """Elements that a model asks for, if it says so."""
    width = getattr(model, "width", None)
    return width if isinstance(width, int) else None


def tensor_problem(tensor: Column, shape: Column, expected: int | None = None) -> Column:
    """Why a tensor cannot be scored, or null."""
    wanted = element_count(shape) if expected is None else F.lit(expected).cast("long")
    return F.when(tensor.isNull(), F.lit(MISSING_TENSOR)).otherwise(_wrong_size(wanted, F.size(tensor)))


def planned_problem(missing: Column, elements: int, model: LinearHead | Model) -> Column:
    """The same for tensors of a known size that are not at hand as a column."""
    width = width_of(model) or elements
    return F.when(missing, F.lit(MISSING_TENSOR)).otherwise(_wrong_size(F.lit(width), F.lit(elements)))


def ship_model(spark: SparkSession, model: Model) -> Broadcast:
    """The pickled model as a broadcast, unpickled once per worker; its size is checked first.

    A model with a method ``ship``, such as a ``ModelFile``, goes to the nodes in its own way, and what that gives is broadcast.
    """
    data = cloudpickle.dumps(model.ship(spark) if hasattr(model, "ship") else model)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"the model takes {len(data)} bytes, more than {MAX_MODEL_BYTES}; give it as a ModelFile")
    return spark.sparkContext.broadcast(data)


def loaded_model(shared: Broadcast) -> Model:
    """The model of a broadcast; a worker's later tasks find it on the broadcast, which the worker keeps."""
    if not hasattr(shared, "_loaded_model"):
        model = cloudpickle.loads(shared.value)
        shared._loaded_model = model.opened() if hasattr(model, "opened") else model
    return shared._loaded_model


def row_logits(score_rows: Model, matrix: np.ndarray) -> list[tuple[np.ndarray | None, str | None]]:
    """Logits or a failure for each row of ``matrix``.

    A batch that raises, or comes back with another number of rows, is tried row
    by row, so that one bad image does not take others with it.
    """
    try:
        logits = np.asarray(score_rows(matrix), dtype=np.float64)
        if logits.ndim != 2 or len(logits) != len(matrix):
            raise ValueError(f"the model gave {logits.shape} for {len(matrix)} rows")
    except Exception as e:  # noqa: BLE001  a failing model is a result, not the end of the job
        if len(matrix) == 1:
            return [(None, f"Inference failed: {e}")]
        return [row_logits(score_rows, matrix[k : k + 1])[0] for k in range(len(matrix))]
    return [(row, None) if np.isfinite(row).all() else (None, NOT_FINITE) for row in logits]


def _batch_logits(spark: SparkSession, model: Model) -> Callable[..., Column]:
    """Arrow UDF that applies ``model`` to ``(n, elements)`` matrices."""
    shared = ship_model(spark, model)

    @F.arrow_udf("logits array<double>, error string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score_rows = loaded_model(shared)
        for tensors in batches:
            lengths = tensors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            values = tensors.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
            logits: list[np.ndarray | None] = [None] * len(tensors)
            errors: list[str | None] = [None] * len(tensors)
            present = [n for n in np.unique(lengths) if n >= 0]
            for length in present:
                rows = np.flatnonzero(lengths == length)
                if len(present) == 1:
                    # null rows take no space, so the values already are the matrix
                    matrix = values.reshape(len(rows), length)
                else:
                    matrix = values[starts[rows][:, None] + np.arange(length)]
                for row, (scores, error) in zip(rows, row_logits(score_rows, matrix), strict=True):
                    logits[row], errors[row] = scores, error
            yield pa.StructArray.from_arrays([pa.array(logits, pa.list_(pa.float64())), pa.array(errors, pa.string())], names=["logits", "error"])

    return run


def logits_of(spark: SparkSession, tensor: Column, model: LinearHead | Model) -> Column:
    """Struct of ``logits`` and ``error``."""
    if isinstance(model, LinearHead) and model.width <= NATIVE_WIDTH:
        logits = F.array(*[dot(tensor, row, b) for row, b in zip(model.weights, model.bias)])
        odd = F.exists(logits, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
        error = F.when(tensor.isNotNull() & odd, F.lit(NOT_FINITE))
        return F.struct(F.when(error.isNull(), logits).alias("logits"), error.alias("error"))
    return _batch_logits(spark, model)(tensor)


def score(
    df: DataFrame,
    model: LinearHead | Model | None,
    features: str = "tensor",
    shape: str | None = "tensor_shape",
    labels: tuple[str, ...] = LABELS,
    compat_sentinels: bool = False,
) -> DataFrame:
    """Append ``prediction``, ``confidence`` (percent) and ``inference_error``; drop the tensor.

    ``model`` is a linear head, or any callable from an ``(n, elements)`` matrix
    to ``(n, classes)`` logits. With ``compat_sentinels`` failed rows carry the
    labels ``ERROR_NULL_INPUT`` / ``ERROR_INFERENCE_WORKER`` and confidence 0.
    """
    if model is None:
        raise ValueError("a model must be given")
    tensor = F.col(features)
    expected = width_of(model)
    if expected is None and shape is None:
        raise ValueError("a callable model needs the shape column to check tensors against")
    problem = tensor_problem(tensor, F.col(shape) if shape else F.lit(None), expected)
    checked = df.withColumn("inference_error", problem)
    usable = F.when(F.col("inference_error").isNull(), tensor)
    scored = checked.withColumn("_scored", logits_of(df.sparkSession, usable, model))
    failed = F.coalesce("inference_error", "_scored.error")
    scored = scored.withColumns({"_logits": F.col("_scored.logits"), "inference_error": failed}).drop("_scored")
    drop = [features] + ([shape] if shape else [])
    return label_logits(scored, tensor.isNull(), labels, compat_sentinels).drop(*drop)


def label_logits(
    df: DataFrame, missing: Column, labels: tuple[str, ...] = LABELS, compat_sentinels: bool = False
) -> DataFrame:
    """``_logits`` and ``inference_error`` → ``prediction`` and ``confidence``."""
    failed = F.col("inference_error").isNotNull()
    prediction = label_of(argmax(F.col("_p")), labels)
    confidence = F.array_max("_p") * 100
    if compat_sentinels:
        sentinel = F.when(missing, F.lit("ERROR_NULL_INPUT")).otherwise(F.lit("ERROR_INFERENCE_WORKER"))
        prediction = F.when(failed, sentinel).otherwise(prediction)
        confidence = F.when(failed, F.lit(0.0)).otherwise(confidence)
    else:
        prediction = F.when(~failed, prediction)
        confidence = F.when(~failed, confidence)
    shares = df.withColumn("_p", softmax(F.col("_logits")))
    return shares.withColumns({"prediction": prediction, "confidence": confidence}).drop("_logits", "_p")
