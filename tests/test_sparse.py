"""Identifier levels as sparse vectors in every model kind, and the tensor sketch."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stratiform.operators import sparse
from stratiform.operators.base import Fitted
from stratiform.operators.models import Classifier, Discriminant, GaussianNB
from stratiform.operators.sketch import tensor_sketch
from stratiform.session import scratch_path

N, LEVELS = 600, 40


def _data():
    rng = np.random.RandomState(3)
    y = rng.randint(0, 3, N)
    level = (rng.randint(0, LEVELS // 3, N) * 3 + np.where(rng.uniform(size=N) < 0.8, y, rng.randint(0, 3, N))) % LEVELS
    return y, level, rng.normal(size=(N, 2)) + 0.1 * y[:, None]


@pytest.fixture(scope="module")
def frame(spark):
    """Two numbers that say little and a level that says most; dense, sparse and null vectors."""
    y, level, x = _data()
    rows = []
    for i in range(N):
        v = None if i % 97 == 5 else Vectors.sparse(LEVELS + 1, {int(level[i]): 1.0})
        rows.append((i, float(x[i, 0]), float(x[i, 1]), Vectors.dense(v.toArray()) if v is not None and i % 2 else v, int(y[i])))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    schema = StructType([StructField("row_id", IntegerType()), StructField("a", DoubleType()), StructField("b", DoubleType()),
                         StructField("lv", VectorUDT()), StructField("label", IntegerType())])
    return spark.createDataFrame(rows, schema).repartition(4).persist()


def _matrix(frame):
    rows = frame.orderBy("row_id").collect()
    x = np.array([[r.a, r.b, *(np.zeros(LEVELS + 1) if r.lv is None else r.lv.toArray())] for r in rows])
    return x, np.array([r.label for r in rows])


def _log_scores(x, y, smoothing):
    eps = smoothing * x.var(axis=0).max()
    out = []
    for c in range(3):
        m, v = x[y == c].mean(axis=0), x[y == c].var(axis=0) + eps
        out.append(np.log((y == c).mean()) + (-0.5 * np.log(2 * np.pi * v) - (x - m) ** 2 / (2 * v)).sum(axis=1))
    return np.stack(out, axis=1)


@pytest.mark.parametrize("shipped", [sparse.SHIPPED_BYTES, 0])
def test_naive_bayes_reads_every_slot(spark, frame, monkeypatch, shipped):
    monkeypatch.setattr(sparse, "SHIPPED_BYTES", shipped)
    x, y = _matrix(frame)
    model = GaussianNB(["a", "lv", "b"], "label", 1e-2).fit(frame)
    got = model.staged(frame).select("row_id", *[s.alias(f"s{c}") for c, s in enumerate(model.scores())]).orderBy("row_id").collect()
    assert np.allclose(np.array([r[1:] for r in got]), _log_scores(x, y, 1e-2), atol=1e-8)
    path = scratch_path(spark, "slot-bayes")
    model.save(path)
    again = Fitted.load(spark, path).transform(frame).select("row_id", "prediction").orderBy("row_id").collect()
    assert [r[1] for r in again] == _log_scores(x, y, 1e-2).argmax(axis=1).tolist()


def test_slots_no_training_row_has_set(spark, frame):
    x, y = _matrix(frame)
    train = frame.where("row_id % 2 = 0")           # some levels are not among these
    model = GaussianNB(["a", "b", "lv"], "label", 1e-2).fit(train)
    got = model.staged(frame).select("row_id", *[s.alias(f"s{c}") for c, s in enumerate(model.scores())]).orderBy("row_id").collect()
    half, eps = x[::2], 1e-2 * x[::2].var(axis=0).max()
    for c in range(3):
        mine = half[y[::2] == c]
        m, v = mine.mean(axis=0), mine.var(axis=0) + eps
        want = np.log(len(mine) / len(half)) + (-0.5 * np.log(2 * np.pi * v) - (x - m) ** 2 / (2 * v)).sum(axis=1)
        assert np.allclose([r[1 + c] for r in got], want, atol=1e-7)


@pytest.mark.parametrize("kind", ["lda", "qda", "rda"])
def test_discriminants_equal_those_of_single_columns(spark, frame, kind):
    flat = frame.withColumn("d", sparse.dense_features([], ["lv"], [LEVELS + 1]))
    names = [f"l{i}" for i in range(LEVELS + 1)]
    flat = flat.select("*", *[F.col("d")[i].alias(n) for i, n in enumerate(names)])
    a = Discriminant(["a", "b", "lv"], "label", kind, 0.3, 0.2).fit(frame)
    b = Discriminant(["a", "b", *names], "label", kind, 0.3, 0.2).fit(flat)
    assert np.allclose(a.params["const"], b.params["const"]) and np.allclose(a.params["linear"], b.params["linear"], atol=1e-6)
    one = a.transform(frame).orderBy("row_id").select("prob_0", "prob_1").collect()
    two = b.transform(flat).orderBy("row_id").select("prob_0", "prob_1").collect()
    assert np.allclose(np.array(one), np.array(two), atol=1e-6)


def test_discriminant_refuses_what_it_cannot_read(frame, monkeypatch):
    monkeypatch.setattr(sparse, "MAX_WIDTH", 20)
    with pytest.raises(ValueError, match="at most 20 features"):
        Discriminant(["a", "lv"], "label").fit(frame)


@pytest.mark.parametrize("kind,params", [
    ("logistic", {}), ("svm", {"maxIter": 30}), ("svm_poly", {"maxIter": 30, "n_features": 512}), ("svm_rff", {"maxIter": 30, "n_features": 256, "sigma": 0.2}),
    ("forest", {"featureSubsetStrategy": "all", "maxDepth": 8}), ("gbt", {"maxIter": 15, "stepSize": 0.5}), ("naive_bayes", {"var_smoothing": 1e-3}), ("lda", {})])
def test_every_kind_learns_from_the_levels(spark, frame, kind, params):
    # The assembler of the others takes no null vector and wants the size, which the encoder tells it.
    frame = VectorSizeHint(inputCol="lv", size=LEVELS + 1, handleInvalid="optimistic").transform(frame.where("lv IS NOT NULL"))

    def accuracy(features):
        model = Classifier(kind, features, "label", params).fit(frame.where("row_id % 3 > 0"))
        return model, model.transform(frame.where("row_id % 3 = 0")).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    model, with_levels = accuracy(["a", "b", "lv"])
    assert with_levels > 0.5 and with_levels > accuracy(["a", "b"])[1] + 0.1
    if kind in ("svm_poly", "svm_rff", "gbt", "lda"):
        path = scratch_path(spark, f"levels-{kind}")
        model.save(path)
        again = Fitted.load(spark, path).transform(frame).select("row_id", "prediction")
        assert sorted(again.collect()) == sorted(model.transform(frame).select("row_id", "prediction").collect())


def test_kernel_bayes_refuses_a_vector(frame):
    with pytest.raises(ValueError, match="cannot read the vectors"):
        Classifier("kernel_bayes", ["a", "lv"], "label").fit(frame)


@pytest.mark.parametrize("degree,scale", [(1, 1.0), (2, 0.5), (3, 0.1)])
def test_sketch_has_the_kernel_as_inner_product(degree, scale):
    rng = np.random.RandomState(1)
    x = rng.normal(size=(30, 50)) * (rng.uniform(size=(30, 50)) < 0.3)
    row, ids = np.nonzero(x)
    kernel = (scale * x @ x.T + 1) ** degree
    errors = []
    for seed in range(20):
        z = tensor_sketch(row, ids, x[row, ids], 30, 1024, degree, scale, seed)
        errors.append(z @ z.T - kernel)
    e = np.array(errors)
    size = np.sqrt(np.outer(np.diag(kernel), np.diag(kernel)))
    # The stated error over all pairs: mean squared (2 + 3^degree) / width, in units of the norms; no bias.
    assert (e ** 2).mean(axis=0).sum() <= (2 + 3 ** degree) / 1024 * (size ** 2).sum()
    assert (np.abs(e.mean(axis=0)) <= 4 * np.sqrt((2 + 3 ** degree) / 1024 / 20) * size).all()


def test_sketch_of_absent_and_empty_rows(spark):
    from stratiform.operators.sketch import TensorSketch
    df = spark.createDataFrame([(0, Vectors.sparse(3, {})), (1, Vectors.dense([float("nan"), 1.0, 0.0])), (2, Vectors.dense([0.0, 0.0, 0.0]))],
                               ["i", "features"])
    out = {r.i: r.poly.toArray() for r in TensorSketch(width=64).fit(df).transform(df).collect()}
    assert np.isnan(out[1]).all() and np.allclose(out[0], out[2]) and out[0] @ out[0] == pytest.approx(1.0)
