"""Searches lose no fit in silence, and entry point A leaves nothing cached."""

import pytest
from pyspark.sql import functions as F

from stratiform.operators import search as S
from stratiform.operators.resample import stratified_folds
from stratiform.plans.queries_models import _recipe
from stratiform.sources.tables import VEC_FEATURES, vec

from conftest import SMALL


@pytest.fixture(scope="module")
def folded(spark):
    return stratified_folds(vec(spark, SMALL), "row_id", "label", k=3, seed=1)


def test_failed_fits_are_reported(spark, folded):
    cands = [("nb", "naive_bayes", {}), ("odd", "no such kind", {})]
    long, records = S.cross_validate(folded, "fold", VEC_FEATURES, "label", cands, _recipe)
    assert [bool(r["error"]) for r in records] == [False] * 3 + [True] * 3
    assert {r["model"] for r in long.select("model").distinct().collect()} == {"nb"}
    with pytest.raises(RuntimeError, match="3 of 6 fits failed"):
        S.cross_validate(folded, "fold", VEC_FEATURES, "label", cands, _recipe, strict=True)


def test_only_whole_configurations_are_ranked(spark):
    rows = [("a", 0, f, "f1", 0.5, 1.0) for f in range(3)] + [("b", 0, f, "f1", 0.9, 1.0) for f in range(2)]
    long = spark.createDataFrame(rows, S.LONG)
    assert S.summarise(long).count() == 2
    assert [tuple(r) for r in S.summarise(long, 3).select("model", "n").collect()] == [("a", 3)]


def test_train_and_save_leaves_nothing_cached(spark):
    from stratiform.plans.entrypoints import train_and_save
    from stratiform.session import scratch_path
    spark.catalog.clearCache()
    df = spark.range(240).select(
        F.col("id"), (F.col("id") % 60).cast("string").alias("hospital_number"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.sin(F.col("id") * 1.0) + F.col("id") % 3).alias("pulse"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.cos(F.col("id") * 1.0)).alias("rectal_temp"),
        F.element_at(F.array(F.lit("mild"), F.lit("severe"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("pain"),
        F.element_at(F.array(F.lit("died"), F.lit("lived"), F.lit("euthanized")), (F.col("id") % 3 + 1).cast("int")).alias("outcome"))
    got = train_and_save(df, scratch_path(spark, "left"), key="id", folds=2, parallelism=2,
                         candidates=[("nb", "naive_bayes", {}), ("odd", "no such kind", {})])
    assert got["best"][0] == "nb" and got["held_out"]["f1"] > 0.3
    assert sum(bool(r["error"]) for r in got["durations"]) == 2
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
