"""Model sanity: better than the majority class, deterministic, and the
save / load round trip scores identically."""

import pytest
from pyspark.sql import functions as F

from stratiform.operators.models import Classifier
from stratiform.operators.resample import stratified_split
from stratiform.operators.score import load_trained, save_trained, score
from stratiform.plans.queries_models import _recipe
from stratiform.session import scratch_path
from stratiform.sources.tables import VEC_FEATURES, vec

from conftest import MEDIUM


@pytest.fixture(scope="module")
def split(spark):
    s = stratified_split(vec(spark, MEDIUM), "row_id", "label", 0.8, seed=9208).persist()
    return s.where("is_train"), s.where("NOT is_train")


@pytest.mark.parametrize("kind,params", [
    ("logistic", {"regParam": 0.01}), ("naive_bayes", {}), ("lda", {}), ("qda", {"gamma": 0.1}),
    ("forest", {"numTrees": 30, "maxDepth": 5}), ("tree", {"maxDepth": 4}),
])
def test_beats_majority(spark, split, kind, params):
    train, test = split
    rec = _recipe().fit(train)
    model = Classifier(kind, VEC_FEATURES, "label", params).fit(rec.transform(train))
    out = model.transform(rec.transform(test))
    acc = out.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority


def test_same_seed_same_forest(spark, split):
    train, test = split
    a = Classifier("forest", VEC_FEATURES, "label", {"numTrees": 10}).fit(train).transform(test)
    b = Classifier("forest", VEC_FEATURES, "label", {"numTrees": 10}).fit(train).transform(test)
    assert [r[0] for r in a.select("prediction").collect()] == [r[0] for r in b.select("prediction").collect()]


@pytest.mark.parametrize("kind", ["logistic", "naive_bayes", "svm_rff"])
def test_save_load_round_trip(spark, split, kind):
    train, test = split
    rec = _recipe().fit(train)
    params = {"regParam": 0.01, "maxIter": 20, "n_features": 16} if kind != "naive_bayes" else {}
    model = Classifier(kind, VEC_FEATURES, "label", params).fit(rec.transform(train))
    before = score(test, rec, model).orderBy("row_id").collect()
    path = scratch_path(spark, f"rt-{kind}")
    save_trained(path, rec, model)
    rec2, model2 = load_trained(spark, path)
    after = score(test, rec2, model2).orderBy("row_id").collect()
    assert [tuple(r) for r in before] == [tuple(r) for r in after]


def test_partitions_are_bounded_by_bytes(spark):
    from stratiform.operators.base import PARTITION_BYTES, partitions_for, right_size
    assert partitions_for(1000, 65) == 1 and partitions_for(500_001, 2) == 2
    assert partitions_for(576_000, 1025) >= 576_000 * 8 * 1025 / PARTITION_BYTES      # rows of a tensor sketch
    df = spark.range(0, 40_000, 1, 16)
    assert right_size(df, 40_000).rdd.getNumPartitions() == 1
    assert right_size(df, 40_000, width=1025).rdd.getNumPartitions() == 5


def test_wide_sketches_are_trained_on_bounded_partitions(spark, monkeypatch):
    from stratiform.operators import base, models
    seen = []
    monkeypatch.setattr(base, "PARTITION_BYTES", 64 * 8 * 1025)
    keep = models.right_size
    monkeypatch.setattr(models, "right_size", lambda *a, **k: seen.append(keep(*a, **k)) or seen[-1])
    df = spark.createDataFrame([(i, i % 2, float(i % 2), float(i % 7)) for i in range(400)],
                               "row_id long, label int, a double, b double").coalesce(1)
    model = models.Classifier("svm_poly", ["a", "b"], "label", {"regParam": 0.01, "maxIter": 5, "degree": 2}).fit(df)
    assert seen[0].rdd.getNumPartitions() == 7
    assert model.transform(df).where("prediction = label").count() == 400
