"""Calibrated probabilities and kernel naive Bayes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import calibration
from stratiform.operators import metrics as M
from stratiform.operators.base import Fitted
from stratiform.operators.kernel_bayes import KernelBayes
from stratiform.operators.models import Classifier
from stratiform.session import scratch_path


def test_coupling_returns_consistent_probabilities():
    rng = np.random.RandomState(0)
    p = rng.dirichlet([1.0, 2.0, 3.0, 0.5], 300) * 0.98 + 0.005
    p /= p.sum(axis=1, keepdims=True)
    r = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    assert np.allclose(calibration.couple(r), p, atol=1e-6)
    odd = np.full((1, 3, 3), 0.5)
    odd[0, 0, 1], odd[0, 1, 0] = 0.9, 0.1
    got = calibration.couple(odd)
    assert got.sum() == pytest.approx(1.0) and (got > 0).all()
    # No other probabilities cost less.
    cost = lambda x: sum((odd[0, j, i] * x[i] - odd[0, i, j] * x[j]) ** 2 for i in range(3) for j in range(i + 1, 3))
    best = min((cost(x / x.sum()) for x in rng.uniform(0.01, 1, (20_000, 3))))
    assert cost(got[0]) <= best + 1e-9


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(6)
    x = rng.normal(size=(3000, 2))
    logits = np.stack([1.5 * x[:, 0], 1.5 * x[:, 1], -0.5 * x.sum(axis=1)], axis=1)
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, label int").repartition(4)


def test_svm_probabilities_are_calibrated(spark, frame):
    train, test = frame.where("row_id < 2000"), frame.where("row_id >= 2000")
    probs = ["prob_0", "prob_1", "prob_2"]
    # What the generating model itself loses on these rows: no probabilities do much better.
    x = np.array([[r.a, r.b] for r in test.orderBy("row_id").collect()])
    y = np.array([r.label for r in test.orderBy("row_id").collect()])
    logits = np.stack([1.5 * x[:, 0], 1.5 * x[:, 1], -0.5 * x.sum(axis=1)], axis=1)
    best = -np.log((np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True))[np.arange(len(y)), y]).mean()
    # Strong regularisation shrinks the margins, which a softmax takes for doubt; sigmoids undo it.
    for reg in (0.01, 1.0):
        plain, fitted = (Classifier("svm", ["a", "b"], "label", {"regParam": reg, "maxIter": 30, "calibrate": f}).fit(train) for f in (0, 3))
        out = fitted.transform(test).persist()
        assert out.where("abs(prob_0 + prob_1 + prob_2 - 1) > 1e-9").count() == 0
        assert M.log_loss(out, probs) < best + 0.03, reg
    assert M.log_loss(out, probs) < M.log_loss(plain.transform(test), probs) - 0.02
    assert M.hand_till_auc(out, probs, "label") > 0.75
    # Reliability: in every tenth of the scores the share of the class is near the mean probability.
    for c in range(3):
        table = out.groupBy(F.floor(F.col(f"prob_{c}") * 10).alias("bin")).agg(
            F.count("*").alias("n"), F.avg(f"prob_{c}").alias("p"), F.avg((F.col("label") == c).cast("double")).alias("share")).collect()
        gap = sum(r["n"] * abs(r["p"] - r["share"]) for r in table) / 1000
        assert gap < 0.06, (c, gap)
    path = scratch_path(spark, "calibrated")
    fitted.save(path)
    again = Fitted.load(spark, path).transform(test).select("row_id", *probs)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.select("row_id", *probs).collect()))


def test_kernel_bayes_handles_absent_and_unseen_values(spark, frame):
    df = frame.withColumn("lv", F.when(F.col("row_id") % 7 == 0, None).otherwise(F.concat(F.lit("l"), (F.col("label") + F.col("row_id") % 2).cast("string"))))
    df = df.withColumn("a", F.when(F.col("row_id") % 11 == 0, None).otherwise(F.col("a"))).withColumn("flat", F.lit(2.0))
    model = Classifier("kernel_bayes", ["a", "b", "flat", "lv"], "label", {"smoothness": 1.2, "laplace": 1.0}).fit(df)
    out = model.transform(df)
    assert out.where("abs(prob_0 + prob_1 + prob_2 - 1) > 1e-9").count() == 0
    assert out.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.7
    new = spark.createDataFrame([(1, 99.0, -99.0, 2.0, "never"), (2, None, float("nan"), None, None)], "row_id long, a double, b double, flat double, lv string")
    rows = {r["row_id"]: r for r in model.transform(new).collect()}
    prior = [r[0] / 3000 for r in df.groupBy("label").count().orderBy("label").select("count").collect()]
    assert [rows[2][f"prob_{c}"] for c in range(3)] == pytest.approx(prior)
    path = scratch_path(spark, "kernel-bayes")
    model.save(path)
    assert sorted(map(str, Fitted.load(spark, path).transform(new).collect())) == sorted(map(str, model.transform(new).collect()))
    # On a wide grid the density is the kernel estimate itself.
    fitted = KernelBayes(["b"], [], "label", 1.0, 0.0, 401).fit(df)
    v = np.array([r[0] for r in df.where("label = 1").select("b").collect()])
    at = fitted.params["lo"][0] + fitted.params["step"][0] * np.arange(401)
    h = v.std(ddof=1) * len(v) ** -0.2
    exact = np.exp(-0.5 * ((at[:, None] - v[None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi)) * fitted.params["step"][0]
    assert np.abs(np.array(fitted.params["density"])[0, 1] - exact).max() < 1e-4 * exact.max() + 1e-5
