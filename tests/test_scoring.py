"""Heads, callables, tensor checks and parameter tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.text import percent_text
from lumenframe.functions.vectors import argmax, label_of, softmax
from lumenframe.operators import model_files, scoring
from lumenframe.operators.scoring import LinearHead, load_linear_head, logits_of, row_logits, score


class Doubling:
    def __call__(self, batch):
        return np.stack([batch.sum(axis=1), -batch.sum(axis=1)], axis=1)


def tensors(spark, rows):
    return spark.createDataFrame(rows, "path string, tensor array<float>, tensor_shape array<int>")


def test_head_prediction_and_errors(spark):
    head = LinearHead(((1.0, 0.0), (0.0, 1.0)), (0.0, 0.0))
    df = tensors(spark, [("a", [2.0, 0.0], [1, 2]), ("b", [0.0, 3.0], [1, 2]), ("c", None, None), ("d", [1.0], [1, 1])])
    rows = {r["path"]: r for r in score(df, head).collect()}
    assert rows["a"]["prediction"] == "NORMAL" and rows["b"]["prediction"] == "PNEUMONIA"
    assert rows["a"]["confidence"] == pytest.approx(100 / (1 + np.exp(-2)), abs=1e-9)
    assert rows["c"]["prediction"] is None and rows["c"]["inference_error"] == "Missing tensor"
    assert rows["d"]["confidence"] is None and "Expected 2 elements" in rows["d"]["inference_error"]
    marked = {r["path"]: (r["prediction"], r["confidence"]) for r in score(df, head, compat_sentinels=True).collect()}
    assert marked["c"] == ("ERROR_NULL_INPUT", 0.0) and marked["d"] == ("ERROR_INFERENCE_WORKER", 0.0)


def test_ties_take_the_first_class(spark):
    head = LinearHead(((1.0,), (1.0,)), (0.0, 0.0))
    row = score(tensors(spark, [("a", [5.0], [1, 1])]), head).first()
    assert (row["prediction"], row["confidence"]) == ("NORMAL", 50.0)


def test_any_callable_is_a_model(spark):
    df = tensors(spark, [("a", [1.0, 1.0], [1, 2]), ("b", [-1.0, 0.0, 0.0], [1, 3]), ("c", None, None)])
    rows = {r["path"]: r for r in score(df, Doubling()).collect()}
    assert rows["a"]["prediction"] == "NORMAL" and rows["b"]["prediction"] == "PNEUMONIA"
    assert rows["c"]["inference_error"] == "Missing tensor"


def test_wide_head_equals_plain_expression(spark, monkeypatch):
    rng = np.random.default_rng(3)
    head = LinearHead(tuple(map(tuple, rng.normal(size=(2, 50)).tolist())), (0.1, -0.1))
    data = [(str(i), rng.normal(size=50).astype("float32").tolist(), [1, 50]) for i in range(40)]
    df = tensors(spark, data)
    native = {r["path"]: r for r in score(df, head).collect()}
    monkeypatch.setattr(scoring, "NATIVE_WIDTH", 10)
    for row in score(df, head).collect():
        assert row["prediction"] == native[row["path"]]["prediction"]
        assert row["confidence"] == pytest.approx(native[row["path"]]["confidence"], abs=1e-9)


def test_element_count_of_the_full_tensor(spark):
    sizes = {"ok": 50176, "short": 50175, "none": 0}
    df = spark.createDataFrame(list(sizes.items()), "path string, n int").select(
        "path", F.array_repeat(F.lit(0.5).cast("float"), F.col("n")).alias("tensor")
    )
    found = df.select("path", scoring.tensor_problem(F.col("tensor"), F.lit(None), 50176).alias("e")).collect()
    assert {r["path"]: r["e"] for r in found} == {
        "ok": None, "short": "Expected 50176 elements, got 50175", "none": "Expected 50176 elements, got 0",
    }


def test_softmax_argmax_labels(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],), ([0.0, 5.0],), ([-1e9, 0.0],)], "z array<double>")
    rows = df.select(softmax(F.col("z")).alias("p"), argmax(F.col("z")).alias("i")).collect()
    assert rows[0]["p"] == [0.5, 0.5] and [r["i"] for r in rows] == [0, 1, 1]
    assert rows[1]["p"][1] == pytest.approx(1 / (1 + np.exp(-5)))
    assert rows[2]["p"] == [0.0, 1.0]
    labels = spark.range(4).select(label_of(F.col("id").cast("int"), scoring.LABELS)).collect()
    assert [r[0] for r in labels] == ["NORMAL", "PNEUMONIA", "UNKNOWN", "UNKNOWN"]


def params(spark, path, rows):
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").write.mode("overwrite").parquet(path)
    return path


def test_load_head(spark, tmp_path):
    path = str(tmp_path / "model")
    weight = ("module.classifier.1.weight", [2, 3], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    other = ("module.features.conv.weight", [1], [9.0])
    params(spark, path, [weight, ("module.classifier.1.bias", [2], [0.5, 0.25]), other])
    head = load_linear_head(spark, path)
    assert head.weights == ((1.0, 2.0, 3.0), (4.0, 5.0, 6.0)) and head.bias == (0.5, 0.25)
    with pytest.raises(ValueError, match="once each"):
        load_linear_head(spark, params(spark, path, [weight]))
    with pytest.raises(ValueError, match="do not fit"):
        load_linear_head(spark, params(spark, path, [weight, ("classifier.bias", [3], [0.0, 0.0, 0.0])]))
    with pytest.raises(ValueError, match="model path"):
        load_linear_head(spark, "")


def test_rename_only_touches_prefixes(spark):
    names = ["module.classifier.1.weight", "features.module.x", "classifier.1.bias", "a.classifier.1.b"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r["name"] for r in scoring.rename_params(df).collect()] == [
        "classifier.weight", "features.module.x", "classifier.bias", "a.classifier.1.b",
    ]


def test_large_models_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="give it as a ModelFile"):
        score(tensors(spark, [("a", [1.0], [1, 1])]), Doubling())


def test_bad_models(spark):
    df = tensors(spark, [("a", [1.0], [1, 1])])
    with pytest.raises(ValueError):
        score(df, None)
    with pytest.raises(ValueError):
        score(df, Doubling(), shape=None)
    with pytest.raises(ValueError):
        LinearHead(((1.0,), (1.0, 2.0)), (0.0, 0.0))
    with pytest.raises(ValueError):
        LinearHead(((1.0,),), (0.0, 0.0))


class Unsteady:
    """Raises on some rows, is not finite on others, and loses one of every batch of several."""

    def __call__(self, batch):
        if (batch[:, 0] == 1).any():
            raise ValueError("no ones")
        out = np.stack([batch[:, 0], np.where(batch[:, 0] == 2, np.nan, 1.0)], axis=1)
        return out if len(out) == 1 else out[1:]


def test_failures_are_rows(spark):
    rows = [(n, [float(n % 4), 0.0]) for n in range(12)]
    df = spark.createDataFrame(rows, "id long, tensor array<double>").coalesce(1).withColumn("tensor_shape", F.array(F.lit(2)))
    got = {r["id"]: r for r in score(df, Unsteady()).collect()}
    assert len(got) == 12
    for n, r in got.items():
        wanted = {1: "Inference failed: no ones", 2: "Inference failed: scores that are not finite"}.get(n % 4)
        assert r["inference_error"] == wanted
        assert (r["prediction"] is None) == (r["confidence"] is None) == (wanted is not None)


def test_batch_failures_stay_with_their_rows():
    found = row_logits(Unsteady(), np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [3.0, 0.0]]))
    assert [logits is None for logits, _ in found] == [False, True, True, False]


def test_percent_of_no_number(spark):
    df = spark.createDataFrame([(95.5,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(percent_text(F.col("v"))).collect()] == ["95.50%", "N/A", "N/A", "N/A"]


def test_head_is_the_same_to_the_last_bit_on_both_ways(spark):
    """As a column expression, and as the callable that wide heads and ``score_files`` use."""
    rng = np.random.default_rng(5)
    head = LinearHead(tuple(map(tuple, rng.normal(size=(2, 64)).tolist())), (0.1, -0.3))
    tensors = rng.normal(size=(200, 64)).astype(np.float32)
    rows = [(k, t.tolist()) for k, t in enumerate(tensors)]
    df = spark.createDataFrame(rows, "id int, tensor array<float>")
    scored = df.select("id", logits_of(spark, F.col("tensor"), head)["logits"].alias("z")).collect()
    expected = head(tensors)
    assert all(r["z"] == expected[r["id"]].tolist() for r in scored)
    assert (head(tensors[:1]) == expected[:1]).all()


@pytest.mark.parametrize("width", [1, 7, model_files.BLOCK + 5])
def test_mapped_head_is_the_head_to_the_last_bit(tmp_path, width):
    rng = np.random.default_rng(2)
    weights, bias = rng.normal(size=(2, width)), rng.normal(size=2)
    np.save(tmp_path / "h.npy", np.concatenate([weights, bias[:, None]], axis=1))
    batch = rng.normal(size=(3, width)).astype(np.float32)
    head = LinearHead(tuple(map(tuple, weights.tolist())), tuple(bias.tolist()))
    mapped = model_files.MappedHead(str(tmp_path / "h.npy"))
    assert isinstance(mapped.weights, np.memmap)
    assert (mapped(batch) == head(batch)).all()


def test_model_files(spark, tmp_path):
    rows = [("classifier.weight", [2, 3], 4, [5.0, 6.0]), ("module.classifier.1.weight", [2, 3], 0, [1.0, 2.0, 3.0, 4.0]), ("classifier.bias", [2], 0, [0.5, -0.5]), ("other", [1], 0, [9.0])]
    params = spark.createDataFrame(rows, "name string, shape array<int>, offset long, values array<double>")
    head = model_files.write_mapped_head(spark, params, str(tmp_path / "mapped.npy"))
    assert np.load(tmp_path / "mapped.npy").tolist() == [[1, 2, 3, 0.5], [4, 5, 6, -0.5]]
    tensors = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, -2.0]), (3, [1.0]), (4, None)], "id int, tensor array<float>")
    plain = LinearHead(((1.0, 2.0, 3.0), (4.0, 5.0, 6.0)), (0.5, -0.5))
    found, wanted = (sorted(map(str, score(tensors, m, shape=None).collect())) for m in (head, plain))
    assert found == wanted
    for broken in (params.where("offset = 0"), params.where("name <> 'classifier.bias'"), params.where("name LIKE 'module%' OR name = 'classifier.bias'")):
        with pytest.raises(Exception, match="must hold|do not fit|missing"):
            model_files.write_mapped_head(spark, broken, str(tmp_path / "broken.npy"))
    twice = model_files.ModelFile(str(tmp_path / "mapped.npy"), lambda path: lambda batch: 2 * model_files.MappedHead(path)(batch))
    shaped = tensors.where("id < 3").withColumn("tensor_shape", F.array(F.lit(1), F.lit(1), F.lit(3)))
    assert score(shaped, twice).where("inference_error IS NULL").count() == 2
