import numpy as np
import pandas as pd
import pytest

from stratiform.operators.ranks import average_ranks, exact_quantiles, row_numbers


def test_average_ranks_match_pandas(spark):
    rng = np.random.RandomState(0)
    v = rng.randint(0, 50, size=500).astype(float)
    pdf = pd.DataFrame({"v": v})
    df = spark.createDataFrame(pdf)
    got = average_ranks(df, "v").toPandas().set_index("v")["rank_avg"]
    want = pdf["v"].rank(method="average")
    for value, r in zip(pdf["v"], want):
        assert got.loc[value] == pytest.approx(r)


def test_average_ranks_many_buckets(spark):
    from stratiform.operators import ranks
    rng = np.random.RandomState(1)
    pdf = pd.DataFrame({"v": rng.normal(size=2000).round(2)})
    vc = spark.createDataFrame(pdf).groupBy("v").count().withColumnRenamed("count", "n")
    ps = ranks.prefix_sums(vc, [], "v", ["n"], rows_per_bucket=37).toPandas().sort_values("v")
    assert (ps["n_before"].to_numpy() == np.concatenate([[0], ps["n"].cumsum().to_numpy()[:-1]])).all()


def test_exact_quantiles_type7(spark):
    rng = np.random.RandomState(2)
    a = rng.exponential(size=1001)
    b = np.where(rng.uniform(size=1001) < 0.2, np.nan, rng.normal(size=1001))
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75])
    for c in ["a", "b"]:
        for p in [0.25, 0.5, 0.75]:
            assert got[c][p] == pytest.approx(np.nanpercentile(pdf[c], p * 100))


def test_row_numbers_dense(spark):
    df = spark.createDataFrame([(int(x),) for x in np.random.RandomState(3).permutation(1000) * 7],
                               "k long")
    got = row_numbers(df, "k", rows_per_bucket=50).toPandas().sort_values("k")
    assert got["row_number"].tolist() == list(range(1, 1001))
