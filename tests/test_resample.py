from pyspark.sql import functions as F

from stratiform.operators import resample as RS
from stratiform.sources.tables import obs

from conftest import MEDIUM


def _lab(spark):
    return obs(spark, MEDIUM).where(F.col("outcome").isNotNull()).select("row_id", "outcome")


def test_folds_partition_rows_and_balance_classes(spark):
    f = RS.stratified_folds(_lab(spark), "row_id", "outcome", k=4).toPandas()
    assert f["row_id"].is_unique
    counts = f.groupby(["outcome", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1)).max() <= 1


def test_split_independent_of_partitioning(spark):
    a = RS.stratified_split(_lab(spark).repartition(3), "row_id", "outcome", 0.8)
    b = RS.stratified_split(_lab(spark).repartition(11), "row_id", "outcome", 0.8)
    sa = {r["row_id"] for r in a.where("is_train").select("row_id").collect()}
    sb = {r["row_id"] for r in b.where("is_train").select("row_id").collect()}
    assert sa == sb


def test_split_shares_per_class(spark):
    s = RS.stratified_split(_lab(spark), "row_id", "outcome", 0.8).toPandas()
    for _, g in s.groupby("outcome"):
        assert g["is_train"].sum() == int(0.8 * len(g))


def test_undersample_equalises(spark):
    u = RS.random_undersample(_lab(spark), "row_id", "outcome").toPandas()
    assert u.groupby("outcome").size().nunique() == 1
