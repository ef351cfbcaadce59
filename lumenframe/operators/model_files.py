"""Models too large to broadcast: a file that Spark ships once to each node, mapped into memory by its workers.

Workers of a node share the pages of a mapped file, so a model takes its size
once a node however many tasks score with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.operators.scoring import rename_params
from lumenframe.sources.files import locate

#: Values that are multiplied and added up at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class ModelFile:
    """A model in a file that Spark can fetch; ``load`` makes the callable from the path that it has on a node.

    ``width`` is the number of elements that its tensors must have, if it asks for one.
    """

    path: str
    load: Callable[[str], Callable[[np.ndarray], np.ndarray]]
    width: int | None = None

    def ship(self, spark: SparkSession) -> ShippedModel:
        spark.sparkContext.addFile(self.path)
        return ShippedModel(self.path.rstrip("/").rsplit("/", 1)[-1], self.load)


@dataclass(frozen=True)
class ShippedModel:
    """What tasks get of a model file: its name among the files of the session."""

    name: str
    load: Callable[[str], Callable[[np.ndarray], np.ndarray]]

    def opened(self) -> Callable[[np.ndarray], np.ndarray]:
        return self.load(SparkFiles.get(self.name))


class MappedHead:
    """A linear head whose weights stay in their file; sums are added in element order, as everywhere."""

    def __init__(self, path: str):
        stored = np.load(path, mmap_mode="r")  # classes × (elements, bias)
        self.weights, self.bias = stored[:, :-1], np.array(stored[:, -1])

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        out = np.empty((len(batch), len(self.bias)))
        for c, weights in enumerate(self.weights):
            for n, row in enumerate(batch):
                total = None
                for at in range(0, len(weights), BLOCK):
                    terms = row[at : at + BLOCK].astype(np.float64) * weights[at : at + BLOCK]
                    if total is not None:
                        terms[0] += total  # goes on where the block before ended
                    total = np.cumsum(terms)[-1]
                out[n, c] = (0.0 if total is None else total) + self.bias[c]
        return out


def mapped_head(path: str, width: int) -> ModelFile:
    return ModelFile(path, MappedHead, width)


_VALUES = pa.schema([("written", pa.int64())])


def write_mapped_head(spark: SparkSession, params: DataFrame, out: str) -> ModelFile:
    """Write the head among ``params`` (``name``, ``shape``, ``values``, and ``offset`` where a parameter takes several rows) as a file to map.

    One task streams the values, in order, a row at a time; no process holds
    them all. Any gap fails the job.
    """
    rows = rename_params(params).where(F.col("name").isin("classifier.weight", "classifier.bias"))
    if "offset" not in rows.columns:
        rows = rows.withColumn("offset", F.lit(0).cast("long"))
    shapes = {r["name"]: (list(r["shape"]), r["n"]) for r in rows.groupBy("name").agg(F.first("shape").alias("shape"), F.sum(F.size("values").cast("long")).alias("n")).collect()}
    if set(shapes) != {"classifier.weight", "classifier.bias"}:
        raise ValueError("the parameters must hold classifier.weight and classifier.bias")
    (classes, width), n_weights = shapes["classifier.weight"]
    if n_weights != classes * width or shapes["classifier.bias"][1] != classes:
        raise ValueError("parameter shapes do not fit together")
    bias = [float(v) for r in rows.where("name = 'classifier.bias'").orderBy("offset").collect() for v in r["values"]]
    # bounded: one number a class
    header = np.lib.format.magic(1, 0)
    text = f"{{'descr': '<f8', 'fortran_order': False, 'shape': ({classes}, {width + 1}), }}"
    text += " " * (-(len(header) + 2 + len(text) + 1) % 64) + "\n"
    start = header + len(text).to_bytes(2, "little") + text.encode("latin-1")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner, _ = locate(out)
        done = 0
        with fs.open_output_stream(inner) as sink:
            sink.write(start)
            for batch in batches:
                for offset, values in zip(batch.column("offset").to_pylist(), batch.column("values"), strict=True):
                    if offset != done:
                        raise ValueError(f"weights from {done} on are missing")
                    data = values.values.to_numpy(zero_copy_only=False).astype("<f8")
                    while len(data):
                        part, data = np.split(data, [min(len(data), width - done % width)])
                        sink.write(part.tobytes())
                        done += len(part)
                        if done % width == 0:  # a row of weights ends with its bias
                            sink.write(np.array([bias[done // width - 1]], dtype="<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], schema=_VALUES)

    ordered = rows.where("name = 'classifier.weight'").select("offset", F.col("values").cast("array<double>").alias("values")).repartition(1).sortWithinPartitions("offset")
    written = ordered.mapInArrow(put, T.StructType([T.StructField("written", T.LongType())])).first()[0]
    if written != classes * width:
        raise ValueError(f"{written} weights were written, not {classes * width}")
    return mapped_head(out, width)
