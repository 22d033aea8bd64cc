"""Softmax boosting, boosting by reweighting and cost-complexity pruning against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stratiform.operators import boosting, pruning, reweighting
from stratiform.operators.models import Classifier
from stratiform.operators.resample import stratified_split
from stratiform.operators.score import load_trained, save_trained
from stratiform.plans.queries_models import _recipe
from stratiform.session import scratch_path
from stratiform.sources.tables import VEC_FEATURES, vec

from conftest import MEDIUM


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(4)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.4).astype(int) + (x[:, 2] > 0.8)
    x[rng.uniform(size=x.shape) < 0.1] = np.nan
    ids = rng.randint(0, 6, 400)
    y = np.where(ids == 5, 2, y)
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x[i]], Vectors.sparse(9, [int(ids[i])], [1.0]), int(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, ["id", "a", "b", "c", "v", "label"]).withColumn("label", F.col("label").cast("int"))
    df = VectorSizeHint(inputCol="v", size=9, handleInvalid="skip").transform(df)
    return df, x, ids, y, None


def _one_tree(bins, slots, g, h, depth, penalty, least):
    """Greedy tree of plain loops over sets of rows: {rows: value} of its leaves."""
    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + penalty)

    def grow(rows, d):
        best = (1e-9, None)
        if d < depth:
            options = []
            for j in range(bins.shape[1]):
                b = bins[rows, j]
                for cut in range(1, b.max(initial=-1) + 2):
                    for null_left in (False, True):
                        options.append(((j, cut, null_left), np.where(b < 0, null_left, b < cut)))
            for s in range(slots.shape[1]):
                options.append(((bins.shape[1] + s, 0, False), slots[rows, s] == 0))
            for name, left in options:
                a, b = rows[left], rows[~left]
                if len(a) >= least and len(b) >= least:
                    gain = round((score(a) + score(b) - score(rows)) / 2, 9)
                    if gain > best[0]:
                        best = (gain, (a, b))
        if best[1] is None:
            return {tuple(rows.tolist()): -0.3 * g[rows].sum() / (h[rows].sum() + penalty)}
        return {**grow(best[1][0], d + 1), **grow(best[1][1], d + 1)}
    return grow(np.arange(len(g)), 0)


def test_round_of_boosting_equals_brute_force(spark, frame):
    df, x, ids, y, _ = frame
    params = {"maxIter": 2, "maxDepth": 2, "stepSize": 0.3, "maxBins": 8, "minInstancesPerNode": 5}
    fitted = boosting.SoftmaxBoosting(["a", "b", "c", "v"], "label", params, seed=1).fit(df.repartition(3))
    p = fitted.params
    bins = boosting._bins(x, [np.array(e) for e in p["edges"]])
    slots = np.eye(9)[ids]
    f = np.tile(np.array(p["base"]), (400, 1))
    for _ in range(2):
        prob = boosting.softmax(f)
        for c in range(3):
            for rows, value in _one_tree(bins, slots, prob[:, c] - (y == c), prob[:, c] * (1 - prob[:, c]), 2, 1.0, 5).items():
                f[list(rows), c] += value
    want = boosting.softmax(f)
    got = fitted.transform(df).select("id", "prediction", "prob_0", "prob_1", "prob_2").orderBy("id").collect()
    assert np.allclose([[r.prob_0, r.prob_1, r.prob_2] for r in got], want, atol=1e-9)
    assert all(abs(r.prob_0 + r.prob_1 + r.prob_2 - 1) < 1e-12 for r in got)
    assert [int(r.prediction) for r in got] == want.argmax(axis=1).tolist()


def _log_loss(out, k=3):
    p = F.element_at(F.array(*[f"prob_{i}" for i in range(k)]), F.col("label").cast("int") + 1)
    return out.agg(F.avg(-F.ln(F.greatest(p, F.lit(1e-15))))).first()[0]


def test_boosting_learns_stops_early_and_reloads(spark):
    s = stratified_split(vec(spark, MEDIUM), "row_id", "label", 0.8, seed=9208).persist()
    train, test = s.where("is_train"), s.where("NOT is_train")
    model = Classifier("gbt", VEC_FEATURES, "label", {"maxIter": 13, "maxDepth": 2, "stepSize": 0.2}).fit(train)
    shares = [r["count"] / train.count() for r in train.groupBy("label").count().collect()]
    assert _log_loss(model.transform(train)) < 0.8 * -sum(x * math.log(x) for x in shares)
    path = scratch_path(spark, "gbt")
    rec = _recipe().fit(train)
    save_trained(path, rec, model)
    again = load_trained(spark, path)[1]
    cols = ["row_id", "prediction", "prob_0", "prob_1", "prob_2"]
    assert sorted(map(tuple, again.transform(test).select(*cols).collect())) == sorted(map(tuple, model.transform(test).select(*cols).collect()))
    early = Classifier("gbt", VEC_FEATURES, "label", {"maxIter": 40, "maxDepth": 4, "stepSize": 0.9, "validation": 0.3, "patience": 2}).fit(train)
    q = early.inner.params
    assert len(q["trees"]) == int(np.argmin(q["losses"])) and len(q["losses"]) < 41
    empty = boosting.SoftmaxBoosting(["x0"], "label", {}, n_classes=3).fit(train.where("false"))
    assert empty.transform(test).count() == test.count()


def test_reweighting_follows_its_rule(spark, frame):
    df, *_ = frame
    model = Classifier("c50", ["c", "v"], "label", {"maxIter": 6, "maxDepth": 2}).fit(df.na.fill(0.0))
    inner, k = model.inner, 3
    assert len(inner.trees) == len(inner.params["votes"]) >= 2
    # Round one by hand: every weight is 1.
    from stratiform.operators.models import assembler
    rows = assembler(["c", "v"]).transform(df.na.fill(0.0)).select("id", "features", F.col("label").cast("double").alias("label"))
    first = inner.trees[0].transform(rows).withColumn("__w", F.lit(1.0))
    first.select("id", "label", "prediction", "__w").createOrReplaceTempView("scored_once")
    wrong, n = spark.sql("SELECT sum(CASE WHEN prediction <> label THEN 1 ELSE 0 END), count(*) FROM scored_once").first()
    assert inner.params["votes"][0] == pytest.approx(math.log((n - wrong) / wrong) + math.log(k - 1))
    got = reweighting.reweighted(first, "label", inner.params["votes"][0], float(n), float(wrong), float(n))
    want = spark.sql(f"""SELECT id, {n} * e / sum(e) OVER () AS w FROM
        (SELECT id, CASE WHEN prediction <> label THEN exp({inner.params['votes'][0]}) ELSE 1.0 END AS e FROM scored_once)""")
    a, b = ({r[0]: r[1] for r in x.collect()} for x in (got.select("id", "__w"), want))
    assert all(a[i] == pytest.approx(b[i]) for i in b)
    # Votes decide.
    out = model.transform(df.na.fill(0.0))
    votes = {r.id: np.zeros(k) for r in df.select("id").collect()}
    for tree, v in zip(inner.trees, inner.params["votes"]):
        for r in tree.transform(rows).select("id", "prediction").collect():
            votes[r.id][int(r.prediction)] += v
    for r in out.select("id", "prediction", "prob_0", "prob_1", "prob_2").collect():
        assert r.prediction == votes[r.id].argmax()
        assert [r.prob_0, r.prob_1, r.prob_2] == pytest.approx((votes[r.id] / sum(inner.params["votes"])).tolist())
    path = scratch_path(spark, "c50")
    model.save(path)
    from stratiform.operators.base import Fitted
    assert Fitted.load(spark, path).transform(df.na.fill(0.0)).where("prediction = 0").count() == out.where("prediction = 0").count()


def _all_prunings(tree, at=0):
    node = tree[at]
    yield {at}
    if node["left"] >= 0:
        for a in _all_prunings(tree, node["left"]):
            for b in _all_prunings(tree, node["right"]):
                yield a | b


def _cost(tree, leaves, alpha):
    return sum(pruning._errors(tree[i]) for i in leaves) + alpha * len(leaves)


def _leaves(tree, at=0):
    return {at} if tree[at]["left"] < 0 else _leaves(tree, tree[at]["left"]) | _leaves(tree, tree[at]["right"])


def test_pruned_sequence_equals_brute_force():
    rng = np.random.RandomState(8)
    for _ in range(30):
        tree = {}

        def make(depth):
            i = len(tree)
            tree[i] = None
            if depth == 0 or (depth < 3 and rng.uniform() < 0.25):
                tree[i] = {"counts": rng.randint(0, 9, 3).astype(float).tolist(), "left": -1, "right": -1, "feature": -1, "threshold": 0.0}
            else:
                a, b = make(depth - 1), make(depth - 1)
                tree[i] = {"counts": (np.array(tree[a]["counts"]) + tree[b]["counts"]).tolist(), "left": a, "right": b,
                           "feature": 0, "threshold": 0.0}
            return i
        make(3)
        every = list(_all_prunings(tree))
        for alpha in (0.0, 0.3, 0.5, 1.0, 1.5, 2.0, 3.0, 7.5):
            best = min(_cost(tree, s, alpha) for s in every)
            smallest = min((s for s in every if _cost(tree, s, alpha) <= best + 1e-9), key=len)
            got = [t for g, t in pruning.sequence(tree) if g <= alpha + 1e-12][-1]
            assert _leaves(got) == smallest, alpha


def test_cost_complexity_is_a_parameter(spark, frame):
    df, *_ = frame
    clean = df.na.fill(0.0)
    leaves = {}
    for kind in ("tree", "bagged"):
        plain = Classifier(kind, ["a", "b", "c", "v"], "label", {"maxDepth": 5, "numTrees": 5}).fit(clean)
        for cp in (1e-9, 0.05, 1.0):
            model = Classifier(kind, ["a", "b", "c", "v"], "label", {"maxDepth": 5, "numTrees": 5, "cost_complexity": cp}).fit(clean)
            leaves[kind, cp] = sum(f < 0 for t in model.inner.params["trees"] for f in t["feature"])
            out = model.transform(clean)
            assert out.where("abs(prob_0 + prob_1 + prob_2 - 1) > 1e-9").count() == 0
            assert "features" not in out.columns
        assert leaves[kind, 1e-9] > leaves[kind, 0.05] > leaves[kind, 1.0]
        assert leaves[kind, 1.0] == (1 if kind == "tree" else 5)
        if kind == "tree":      # links of no worth are cut without a change of predictions
            kept = Classifier(kind, ["a", "b", "c", "v"], "label", {"maxDepth": 5, "cost_complexity": 1e-9}).fit(clean)
            both = plain.transform(clean).select("id", F.col("prediction").alias("p")).join(kept.transform(clean).select("id", "prediction"), "id")
            assert both.where("p <> prediction").count() == 0
            path = scratch_path(spark, "pruned")
            from stratiform.operators.base import Fitted
            kept.save(path)
            assert Fitted.load(spark, path).transform(clean).count() == 400
