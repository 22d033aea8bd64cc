"""Two-means splits and imputation within clusters."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from stratiform.operators.base import Fitted
from stratiform.operators.clusters import ClusterKNNImputer, two_means
from stratiform.plans.queries_neighbours import IMPUTED, KNN_COLS, _knn_obs_sql
from stratiform.session import scratch_path
from stratiform.sources.tables import obs

from conftest import SMALL


def _sizes(split):
    return sorted(r["n"] for r in split.groupBy("cluster").agg(F.count("*").alias("n")).collect())


def test_split_parts_far_groups_and_holds_the_bound(spark):
    rng = np.random.RandomState(5)
    centre = np.repeat([[0.0, 0.0], [50.0, 0.0], [0.0, 80.0]], [120, 90, 100], axis=0)
    x = centre + rng.normal(size=centre.shape)
    rows = [(i, float(a), None if i % 13 == 0 else float(b)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double")
    split = {r["row_id"]: r["cluster"] for r in two_means(df.repartition(5), ["a", "b"], "row_id", 130).collect()}
    assert len(split) == 310
    whole = [i for i in range(310) if i % 13]                       # rows without b may be anywhere along a
    for a, b in ((0, 120), (120, 210), (210, 310)):
        assert len({split[i] for i in whole if a <= i < b}) == 1
    assert len({split[i] for i in (1, 121, 211)}) == 3
    # Another layout gives the same clusters.
    assert split == {r["row_id"]: r["cluster"] for r in two_means(df.coalesce(1), ["a", "b"], "row_id", 130).collect()}


def test_equal_rows_outliers_and_nulls_are_split_too(spark):
    rows = [(i, 1.0) for i in range(300)] + [(300, 1e9), (301, float("nan")), (302, None)] + [(i, None) for i in range(303, 400)]
    df = spark.createDataFrame(rows, "row_id long, a double")
    split = two_means(df, ["a"], "row_id", 40).persist()
    assert split.count() == 400 and split.select("row_id").distinct().count() == 400
    sizes = _sizes(split)
    assert sizes[-1] <= 40 and len(sizes) <= 60                     # no chain of splits that take off a row each
    assert split.where("row_id < cluster").count() == 0
    assert two_means(df.where("false"), ["a"], "row_id", 40).count() == 0


def test_imputation_equals_sql_given_the_split(spark):
    o = obs(spark, SMALL).select("row_id", *KNN_COLS)
    o = o.withColumn("total_protein", F.when(F.col("row_id") % 87 == 0, None).otherwise(F.col("total_protein")))
    o = o.withColumn("const_col", F.when(F.col("row_id") % 51 == 0, None).otherwise(F.col("const_col"))).persist()
    absent = sum(F.col(c).isNull().cast("int") for c in KNN_COLS)
    usable = o.where(absent <= 0.4 * len(KNN_COLS))
    split = two_means(usable, KNN_COLS, "row_id", 200)
    assert 200 >= _sizes(split)[-1] and len(_sizes(split)) >= 5
    step = ClusterKNNImputer(KNN_COLS, 10, "row_id", 0.4, 200).fit(o)
    got = step.transform(o).orderBy("row_id").toPandas()
    con = duckdb.connect()
    con.register("src", o.join(split, "row_id", "left").toPandas().astype({"cluster": "Int64"}))
    clean = ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in KNN_COLS)
    con.execute(f"CREATE TABLE obs AS SELECT row_id, cluster, {clean} FROM src")
    text = _knn_obs_sql(0.4, KNN_COLS)
    text = "WITH " + text[text.index("q AS (SELECT * FROM obs"):].replace("CROSS JOIN obs d WHERE", "JOIN obs d ON d.cluster = q.cluster WHERE")
    want = con.sql(text + " ORDER BY row_id").df()
    assert o.where(absent > 0.4 * len(KNN_COLS)).count() > 0
    for c in IMPUTED:
        assert np.allclose(got[c].round(6), want[c], atol=2e-6), c
    assert not got[KNN_COLS].isna().any().any()
    path = scratch_path(spark, "clusters")
    step.save(path)
    again = Fitted.load(spark, path).transform(o).orderBy("row_id").toPandas()
    assert again.equals(got)


def test_splits_in_one_task_are_those_of_the_table(spark):
    """Small clusters are split further without another pass over the table, by the same rules."""
    rng = np.random.RandomState(8)
    x = np.round(rng.exponential(5.0, size=(900, 2)), 1)
    rows = [(i, None if i % 11 == 0 else float(a), float("nan") if i % 17 == 0 else float(b), 1.0) for i, (a, b) in enumerate(x)]
    rows += [(900 + i, 7.0, 7.0, 1.0) for i in range(200)] + [(1100, 1e6, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double")
    passes = {r["row_id"]: r["cluster"] for r in two_means(df, ["a", "b", "c"], "row_id", 60, group_rows=60).collect()}
    one = {r["row_id"]: r["cluster"] for r in two_means(df, ["a", "b", "c"], "row_id", 60).collect()}
    some = {r["row_id"]: r["cluster"] for r in two_means(df, ["a", "b", "c"], "row_id", 60, group_rows=300).collect()}
    assert len(one) == 1101 and one == passes == some
