import math

import numpy as np
import pytest

from stratiform.operators import metrics as M


def _cells(matrix, classes=(0, 1, 2)):
    return [(a, b, int(matrix[i][j])) for i, a in enumerate(classes) for j, b in enumerate(classes)]


def test_macro_metrics_hand_made():
    cm = np.array([[5, 1, 0], [2, 3, 1], [0, 1, 7]])
    m = M.metrics_from_confusion(_cells(cm))
    tp = np.diag(cm)
    fp = cm.sum(0) - tp
    fn = cm.sum(1) - tp
    tn = cm.sum() - tp - fp - fn
    spec = np.mean(tn / (tn + fp))
    sens = np.mean(tp / (tp + fn))
    prec = np.mean(tp / (tp + fp))
    assert m["specificity"] == pytest.approx(spec)
    assert m["sensitivity"] == pytest.approx(sens)
    assert m["precision"] == pytest.approx(prec)
    assert m["accuracy"] == pytest.approx(15 / 20)
    # R's balanced accuracy is the mean of (sensitivity + specificity) / 2
    assert m["bal_accuracy"] == pytest.approx((sens + spec) / 2)
    s, c = cm.sum(), tp.sum()
    p, t = cm.sum(0), cm.sum(1)
    mcc = (c * s - (p * t).sum()) / math.sqrt((s * s - (p * p).sum()) * (s * s - (t * t).sum()))
    assert m["mcc"] == pytest.approx(mcc)


def test_class_never_predicted_and_never_true():
    cells = [(0, 0, 4), (0, 1, 1), (1, 0, 2), (1, 1, 3), (2, 1, 1), (1, 3, 1)]
    m = M.metrics_from_confusion(cells)
    assert 0.0 <= m["precision"] <= 1.0 and 0.0 <= m["f1"] <= 1.0
    assert not math.isnan(m["mcc"])


def test_confusion_has_full_grid(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 2)], "label int, prediction int")
    rows = {(r["label"], r["prediction"]): r["n"] for r in M.confusion(df).collect()}
    assert len(rows) == 9 and rows[(1, 1)] == 0 and rows[(0, 1)] == 1


def test_hand_till_auc_perfect_and_random(spark):
    perfect = spark.createDataFrame(
        [(0, 0.8, 0.1, 0.1), (1, 0.1, 0.8, 0.1), (2, 0.1, 0.1, 0.8)] * 5,
        "label int, p0 double, p1 double, p2 double")
    assert M.hand_till_auc(perfect, ["p0", "p1", "p2"]) == pytest.approx(1.0)
    tied = spark.createDataFrame([(0, 0.3, 0.3, 0.4), (1, 0.3, 0.3, 0.4), (2, 0.3, 0.3, 0.4)],
                                 "label int, p0 double, p1 double, p2 double")
    assert M.hand_till_auc(tied, ["p0", "p1", "p2"]) == pytest.approx(0.5)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (1, 1.0, 0.0)], "label int, p0 double, p1 double")
    v = M.log_loss(df, ["p0", "p1"])
    assert v == pytest.approx((0.0 - math.log(1e-15)) / 2, rel=1e-6)


def test_smooth_density_integrates_to_one(spark):
    import numpy as np
    from stratiform.operators.metrics import smooth_density
    rng = np.random.RandomState(1)
    rows = [(float(v), float("nan") if i % 5 == 0 else 0.25, i % 2) for i, v in enumerate(rng.beta(4, 6, 4000))]
    rows += [(None, 0.25, 1), (0.5, 0.25, None), (-3.0, 0.25, 1)]
    df = spark.createDataFrame(rows, "p double, flat double, label int")
    out = smooth_density(df, ["p", "flat"]).collect()
    for cls in (0, 1):
        d = [r.density for r in out if r.score == "p" and r.label == cls]
        v = np.array([min(max(x, 0.0), 1.0) for x, _, c in rows if c == cls and x is not None])
        h = v.std(ddof=1) * len(v) ** -0.2
        at = np.arange(101) / 100
        exact = np.exp(-0.5 * ((at[:, None] - v[None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert len(d) == 101 and abs(sum(d) / 100 - 1) < 0.02 and np.abs(np.array(d) - exact).max() < 0.02
        assert {r.density for r in out if r.score == "flat" and r.label == cls} == {None}
    assert smooth_density(df.where("false"), ["p"]).count() == 0
