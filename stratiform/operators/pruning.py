"""Cost-complexity pruning (M6, M7) of trees fitted by Spark.

A fitted tree is read from its own stored form: a table of nodes with class
counts. Weakest-link pruning repeatedly turns the inner node with the smallest
g = (errors as a leaf - errors of its subtree) / (leaves - 1) into a leaf, all
of one g at a time, which gives the nested sequence of best subtrees. With
``cost_complexity`` cp the links with g <= cp * errors of the root are cut.
Trees are small (nodes, not rows), so the sequence is worked on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import active_session, scratch_path
from .base import Fitted, register


def read_trees(model, forest: bool) -> list[dict[int, dict]]:
    """Nodes of a fitted Spark tree, or of each tree of a forest, by id."""
    spark = active_session()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if forest:
        data = data.select("treeID", "nodeData.*")
    trees: dict[int, dict[int, dict]] = {}
    for r in data.collect():          # a row a node
        trees.setdefault(r["treeID"] if forest else 0, {})[r["id"]] = {
            "counts": list(r["impurityStats"]), "left": r["leftChild"], "right": r["rightChild"],
            "feature": r["split"]["featureIndex"], "threshold": (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0]}
    return [trees[i] for i in sorted(trees)]


def _errors(node: dict) -> float:
    return sum(node["counts"]) - max(node["counts"], default=0.0)


def _below(tree: dict[int, dict], at: int) -> tuple[float, int]:
    """Errors and leaves of the subtree."""
    node = tree[at]
    if node["left"] < 0:
        return _errors(node), 1
    a, b = _below(tree, node["left"]), _below(tree, node["right"])
    return a[0] + b[0], a[1] + b[1]


def links(tree: dict[int, dict], at: int = 0) -> dict[int, float]:
    """g of every inner node that the root still reaches."""
    node = tree[at]
    if node["left"] < 0:
        return {}
    errors, leaves = _below(tree, at)
    return {at: (_errors(node) - errors) / (leaves - 1), **links(tree, node["left"]), **links(tree, node["right"])}


def sequence(tree: dict[int, dict]) -> list[tuple[float, dict[int, dict]]]:
    """(g, tree) from the whole tree down to its root; g never falls."""
    tree = {i: dict(n) for i, n in tree.items()}
    out, level = [(0.0, {i: dict(n) for i, n in tree.items()})], 0.0
    while g := links(tree):
        level = max(level, min(g.values()))
        for i, x in g.items():
            if x <= level + 1e-12:
                tree[i].update(left=-1, right=-1)
        out.append((level, {i: dict(n) for i, n in tree.items()}))
    return out


def prune(tree: dict[int, dict], cp: float) -> dict[int, dict]:
    """The smallest subtree of the sequence whose links all exceed ``cp`` root errors."""
    limit = cp * _errors(tree[0])
    return [t for g, t in sequence(tree) if g <= limit + 1e-12][-1]


def flat(tree: dict[int, dict]) -> dict:
    """Arrays of the nodes that the root reaches, in preorder; leaf values are class shares."""
    out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}

    def put(at: int) -> int:
        node, i = tree[at], len(out["feature"])
        total = sum(node["counts"]) or 1.0
        for name, x in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", [c / total for c in node["counts"]])):
            out[name].append(x)
        if node["left"] >= 0:
            out["feature"][i], out["threshold"][i] = node["feature"], node["threshold"]
            out["left"][i] = put(node["left"])
            out["right"][i] = put(node["right"])
        return i
    put(0)
    return out


@register
class FittedPrunedTrees(Fitted):
    """Mean class shares of pruned trees over an assembled ``features`` column; only the
    features that the trees ask for leave the vector."""

    def transform(self, df: DataFrame) -> DataFrame:
        trees, k = self.params["trees"], self.params["n_classes"]
        used = sorted({f for t in trees for f in t["feature"] if f >= 0})
        at = {f: i for i, f in enumerate(used)}
        arrays = [[np.array([at.get(f, -1) for f in t["feature"]]), np.array(t["threshold"]), np.array(t["left"]),
                   np.array(t["right"]), np.array(t["value"], dtype=float).reshape(len(t["feature"]), -1)] for t in trees]

        @F.arrow_udf("array<double>")
        def shares(x: pa.Array) -> pa.Array:
            n = len(x)
            values = x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            total = np.zeros((n, k))
            for feature, threshold, left, right, value in arrays:
                node = np.zeros(n, dtype=np.int64)
                while True:
                    go = np.flatnonzero(feature[node] >= 0)
                    if not len(go):
                        break
                    here = node[go]
                    node[go] = np.where(values[go, feature[here]] <= threshold[here], left[here], right[here])
                total[:, :value.shape[1]] += value[node]
            total /= len(arrays)
            return pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(total.ravel()))
        picked = VectorSlicer(inputCol="features", outputCol="__used", indices=used or [0]).transform(df)
        out = picked.withColumn("__p", shares(vector_to_array("__used")))
        probs = {f"prob_{c}": F.col("__p")[c] for c in range(k)}
        out = out.withColumns(probs).drop("__p", "__used")
        best, first = F.greatest(*[F.col(c) for c in probs]) if k > 1 else F.col("prob_0"), F.lit(0)
        for c in reversed(range(k)):
            first = F.when(F.col(f"prob_{c}") == best, F.lit(c)).otherwise(first)
        return out.withColumn("prediction", first.cast("double"))
