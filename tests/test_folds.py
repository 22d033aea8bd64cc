"""Leave-one-fold-out statistics against statistics of the training rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import search as S
from stratiform.operators.base import Recipe
from stratiform.operators.folds import fold_modes, fold_sums
from stratiform.operators.impute import column_modes
from stratiform.operators.models import GaussianNB
from stratiform.operators.normalize import ZScore
from stratiform.operators.select import correlation_matrix

COLS = ["a", "b", "c", "flat", "none"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(2)
    rows = []
    for i in range(500):
        a, b = rng.normal(1e6, 1.0), rng.normal()
        rows.append((i, i % 3, None if i % 50 == 7 else int(rng.randint(0, 3)), float(a), None if i % 9 == 0 else float("nan") if i % 11 == 0 else float(b),
                     float(b + 0.3 * rng.normal()), 4.5, None, rng.choice(["x", "y", "z"]), None if i % 4 else "only"))
    return spark.createDataFrame(rows, "row_id long, fold int, label int, a double, b double, c double, flat double, none double, s string, t string") \
        .repartition(4)


def test_moments_and_correlations_of_each_training_fold(frame):
    for pairs in (False, True):
        sums = fold_sums(frame, "fold", "label", COLS, pairs)
        assert sums.folds == [0, 1, 2]
        for f in sums.folds:
            train = frame.where(F.col("fold") != f).withColumn("b", F.nanvl("b", F.lit(None).cast("double")))
            want = ZScore(COLS).fit(train).params["stats"]
            got = sums.zscore(f).params["stats"]
            assert sums.train(f)[0] == train.count()
            for c in COLS:
                assert got[c] == pytest.approx(want[c], rel=1e-9, abs=1e-12) if want[c][0] is not None else got[c] == (None, None)
            if pairs:
                known = correlation_matrix(train, COLS)
                for pair, r in sums.correlations(f).items():
                    assert r == (None if known[pair] is None else pytest.approx(known[pair], abs=1e-9)), pair


def test_naive_bayes_and_modes_of_each_training_fold(frame):
    sums = fold_sums(frame, "fold", "label", ["a", "c", "flat"])
    modes = {}
    for r in fold_modes(frame, "fold", ["s", "t"]).collect():
        modes.setdefault(r["fold"], {})[r["variable"]] = r["level"]
    for f in sums.folds:
        train = frame.where(F.col("fold") != f)
        scaled = sums.zscore(f).transform(train.where("label is not null"))
        got = sums.naive_bayes(f, ["a", "c"], 1e-4, scaled=True).params
        want = GaussianNB(["a", "c"], "label", 1e-4).fit(scaled).params
        assert got["classes"] == want["classes"]
        assert np.allclose(got["log_prior"], want["log_prior"]) and np.allclose(got["mean"], want["mean"], atol=1e-7)
        assert np.allclose(got["var"], want["var"], rtol=1e-3)        # eps is of all rows, unlabelled ones too
        assert modes[f] == column_modes(train, ["s", "t"])


def test_search_from_sums_equals_search_from_copies(spark, frame):
    df = frame.where("label is not null").drop("none", "b", "s", "t")
    cands = [("nb", "naive_bayes", {"var_smoothing": 1e-6}), ("lda", "lda", {})]

    class Copied(ZScore):          # not taken for a plain z-score
        pass
    a, b = (S.cross_validate(df, "fold", ["a", "c"], "label", cands, lambda k=k: Recipe([k(["a", "c"])], persist_input=False), strict=True)[0]
            for k in (ZScore, Copied))
    one, two = ({(r.model, r.fold, r.metric): r.value for r in x.collect()} for x in (a, b))
    assert set(one) == set(two) and len(one) == 2 * 3 * len({m for _, _, m in one})
    for k in one:
        assert one[k] == pytest.approx(two[k], rel=1e-7, abs=1e-9), k
