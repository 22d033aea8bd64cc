"""Boosting by reweighting (M9): multiclass AdaBoost over Spark trees.

Each round fits a tree to the weighted rows (``weightCol``); rows it gets wrong
gain weight by exp(vote), where the tree's vote is ln((1 - err) / err) + ln(K - 1)
of its weighted error. Rounds end when a tree is no better than guessing, when
nothing is wrong any more, or after ``maxIter`` trees. A class's probability is
its share of the votes. The reweighted rows are written every ``STORE_ROUNDS``
rounds, so that a round never replays more trees than that.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .base import Fitted, Step, register

STORE_ROUNDS = 5
#: Errors below this count as it, so that votes stay finite.
LEAST_ERROR = 1e-10
_WEIGHT = "__w"


def vote(error: float, n_classes: int) -> float:
    error = max(error, LEAST_ERROR)
    return math.log((1.0 - error) / error) + math.log(max(n_classes - 1, 1))


def weigh(scored: DataFrame, label: str) -> tuple[float, float]:
    """Weight of all rows and of the wrong ones."""
    row = scored.agg(F.sum(_WEIGHT).alias("all"), F.sum(F.when(F.col("prediction") != F.col(label), F.col(_WEIGHT)).otherwise(0.0))
                     .alias("wrong")).first()
    return row["all"] or 0.0, row["wrong"] or 0.0


def reweighted(scored: DataFrame, label: str, strength: float, total: float, wrong: float, rows: float) -> DataFrame:
    """Rows with the wrong ones' weights raised, the mean weight kept at 1."""
    scale = rows / (total - wrong + wrong * math.exp(strength))
    return scored.withColumn(_WEIGHT, F.col(_WEIGHT) * scale * F.when(F.col("prediction") != F.col(label), math.exp(strength)).otherwise(1.0))


@register
class FittedReweightedTrees(Fitted):
    """Trees over an assembled ``features`` column and their votes."""

    def __init__(self, params=None, tables=None, trees=None):
        super().__init__(params, tables)
        self.trees = trees or []

    def transform(self, df):
        k, votes = self.params["n_classes"], self.params["votes"]
        out, names = df, []
        for i, tree in enumerate(self.trees):
            name = f"__tree{i}"
            out = tree.copy().setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("").transform(out)
            names.append(name)
        total = sum(votes) or 1.0
        shares = [sum((F.when(F.col(n) == c, v).otherwise(0.0) for n, v in zip(names, votes)), F.lit(0.0)) / total for c in range(k)]
        out = out.withColumns({f"prob_{c}": s for c, s in enumerate(shares)}).drop(*names)
        best = F.greatest(*[F.col(f"prob_{c}") for c in range(k)]) if k > 1 else F.col("prob_0")
        first = F.lit(0)
        for c in reversed(range(k)):
            first = F.when(F.col(f"prob_{c}") == best, F.lit(c)).otherwise(first)
        return out.withColumn("prediction", first.cast("double"))

    def save(self, path):
        super().save(path)
        for i, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/tree_{i:03d}")

    def _after_load(self, spark, path):
        self.trees = [DecisionTreeClassificationModel.load(f"{path}/tree_{i:03d}") for i in range(len(self.params["votes"]))]


class ReweightedTrees(Step):
    """M9 on rows with an assembled ``features`` column."""

    def __init__(self, label: str, n_classes: int, params: dict | None = None, features: str = "features", seed: int = 11):
        self.label, self.n_classes, self.params = label, n_classes, dict(params or {})
        self.features, self.seed = features, seed

    def fit(self, df):
        q, k, rate = self.params, self.n_classes, float(self.params.get("subsamplingRate", 1.0))
        rows = stored = materialise(df.select(self.features, self.label).withColumn(_WEIGHT, F.lit(1.0)), "reweighting")
        n = float(stored.count())
        trees, votes = [], []
        for t in range(int(q.get("maxIter", 10))):
            tree = DecisionTreeClassifier(
                labelCol=self.label, featuresCol=self.features, weightCol=_WEIGHT, maxDepth=int(q.get("maxDepth", 5)),
                minInstancesPerNode=int(q.get("minInstancesPerNode", 1)), minInfoGain=q.get("minInfoGain", 0.0),
                seed=self.seed + t).fit(rows if rate >= 1.0 else rows.sample(False, rate, self.seed + t))
            scored = tree.transform(rows).select(self.features, self.label, _WEIGHT, "prediction")
            total, wrong = weigh(scored, self.label)
            error = wrong / total if total else 0.0
            if error >= 1.0 - 1.0 / k and trees:
                break
            trees.append(tree)
            votes.append(max(vote(error, k), 1e-6))
            if error <= LEAST_ERROR or error >= 1.0 - 1.0 / k:
                break
            rows = reweighted(scored, self.label, votes[-1], total, wrong, n).select(self.features, self.label, _WEIGHT)
            if (t + 1) % STORE_ROUNDS == 0:
                rows, old = materialise(rows, "reweighting"), stored
                discard(old)
                stored = rows
        discard(stored)
        return FittedReweightedTrees({"n_classes": k, "votes": votes}, trees=trees)
