"""Multiclass boosting (M8): gradient-boosted trees on the softmax objective.

Every round grows one tree a class on the gradients p_k - [y = k] and Hessians
p_k (1 - p_k) of one shared log loss, so the class probabilities are those of one
model and sum to 1. A level of all the round's trees is one Spark aggregate:

* each task walks its rows down the trees so far and adds up (class, node,
  feature, bin) histograms, which Spark sums. The numeric ones, of a size that the
  rows do not change, are fetched and give the best split of each node;
* numeric features are cut into at most ``maxBins`` bins by sampled quantiles; a null
  (or NaN) has a bin of its own, and each split learns the side that nulls take;
* a vector feature (the levels of an identifier) is read through its non-zero
  slots only; its splits ask whether a slot is set, and Spark ranks them;
* the margins of finished trees are written with the binned rows every
  ``STORE_ROUNDS`` rounds, so a round walks only the trees since then;
* with ``validation`` a fixed share of the rows, by hash, teaches nothing; growth
  ends when their log loss has not improved for ``patience`` rounds, and the
  model keeps the rounds up to the best one.

The driver holds bin edges, trees and the numeric histograms of one level.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import bound_arrow, discard, materialise
from .base import Fitted, Step, register
from .sparse import split_features, starts, vector_sizes

STORE_ROUNDS = 10
#: Rows of a histogram that are no feature: node totals, and the loss of the validation rows.
TOTAL, LOSS = -1, -2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Ascending inner edges of each feature; a value's bin is the number of edges at most it."""
    if not features:
        return []
    probs = [i / bins for i in range(1, bins)]
    number = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    row = df.agg(*[F.percentile_approx(x, probs, 10_000).alias(f"e{i}") for i, x in enumerate(number)]).first()
    low = df.agg(*[F.min(x).alias(f"e{i}") for i, x in enumerate(number)]).first()
    return [sorted({v for v in (q or []) if v > m}) for q, m in zip(row, low)]


def _numbers(features: list[str]):
    """The numeric features as one array, null where absent."""
    return F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]).cast("array<double>")


def _slots(vectors: list[str], offsets: list[int]):
    """Set slots of the vector columns of a row, as one list of feature numbers."""
    parts = []
    for v, first in zip(vectors, offsets):
        u = F.unwrap_udt(F.col(v))
        sparse = F.arrays_zip(u["indices"].alias("i"), u["values"].alias("x"))
        dense = F.transform(u["values"], lambda x, i: F.struct(i.alias("i"), x.alias("x")))
        found = F.filter(F.when(u["type"] == 0, sparse).otherwise(dense), lambda z: z["x"] != 0)
        parts.append(F.coalesce(F.transform(found, lambda z: z["i"] + first), F.array().cast("array<int>")))
    return F.concat(*parts) if parts else F.array().cast("array<int>")


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value, -1 for an absent one."""
    out = np.full(x.shape, -1, dtype=np.int32)
    for j, e in enumerate(edges):
        have = ~np.isnan(x[:, j])
        out[have, j] = np.searchsorted(e, x[have, j], side="right")
    return out


class Tree:
    """Flat arrays of one tree. ``feature`` is -1 at leaves; numeric features go left when
    their bin is below ``cut``, absent values where ``null_left`` says; slots go left when unset."""

    def __init__(self):
        self.feature, self.cut, self.null_left, self.left, self.right, self.value = [], [], [], [], [], []

    def add(self, value: float = 0.0) -> int:
        for name, x in (("feature", -1), ("cut", 0), ("null_left", True), ("left", -1), ("right", -1), ("value", value)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, null_left: bool) -> tuple[int, int]:
        a, b = self.add(), self.add()
        self.feature[node], self.cut[node], self.null_left[node], self.left[node], self.right[node] = feature, cut, null_left, a, b
        return a, b

    def rows(self) -> list[list]:
        return [self.feature, self.cut, [int(x) for x in self.null_left], self.left, self.right, self.value]


def walk(tree: list[list], bins: np.ndarray, slots: "Slots", depth: int) -> np.ndarray:
    """Leaf of each row."""
    feature, cut, null_left, left, right = (np.array(x) for x in tree[:5])
    at = np.zeros(len(bins), dtype=np.int64)
    p = bins.shape[1]
    for _ in range(depth):
        f = feature[at]
        go = np.flatnonzero(f >= 0)
        if not len(go):
            break
        node, f = at[go], f[go]
        is_left = np.zeros(len(go), dtype=bool)
        number = f < p
        if number.any():
            b = bins[go[number], f[number]]
            is_left[number] = np.where(b < 0, null_left[node[number]], b < cut[node[number]])
        for s in np.unique(f[~number]):
            which = np.flatnonzero(f == s)
            is_left[which] = ~slots.has(go[which], int(s))
        at[go] = np.where(is_left, left[node], right[node])
    return at


class Slots:
    """Set slots of a batch's rows."""

    def __init__(self, column: pa.Array | None, n: int):
        if column is None or len(column) == 0:
            self.row, self.slot = np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            self.slot = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(column.offsets.to_numpy())
            self.row = np.repeat(np.arange(n), sizes)
        self.n = n

    def has(self, rows: np.ndarray, slot: int) -> np.ndarray:
        mark = np.zeros(self.n, dtype=bool)
        mark[self.row[self.slot == slot]] = True
        return mark[rows]


def softmax(f: np.ndarray) -> np.ndarray:
    e = np.exp(f - f.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def drawn(row: np.ndarray, seed: int, rate: float) -> np.ndarray:
    """A share of the rows, by a hash of their numbers."""
    x = (row.astype(np.uint64) + np.uint64(seed * 2654435761 % (1 << 63))) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < rate


def _histograms(trees_done, growing, nodes, k, p, depth, wanted, rate, seed, last_round):
    """One level: per (class, node, feature, bin) the sums of gradients, Hessians and rows."""
    def run(batches):
        names = ["k", "node", "feature", "bin", "g", "h", "n"]
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype="<i4").reshape(n, p)
            slots = Slots(batch.column("slots"), n)
            y = batch.column("y").to_numpy().astype(np.int64)
            f = batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(n, k).copy()
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for trees in trees_done:
                for c, tree in enumerate(trees):
                    f[:, c] += np.array(tree[5])[walk(tree, bins, slots, depth)]
            prob = softmax(f)
            if last_round and held.any():
                loss = -np.log(np.maximum(prob[held, y[held]], 1e-15)).sum()
                total[(0, 0, LOSS)] = total.get((0, 0, LOSS), 0) + np.array([[loss, 0.0, float(held.sum())]])
            use = ~held
            if rate < 1.0:
                use &= drawn(batch.column("row").to_numpy(), seed, rate)
            for c in range(k):
                g = prob[:, c] - (y == c)
                h = np.maximum(prob[:, c] * (1 - prob[:, c]), 1e-16)
                at = walk(growing[c], bins, slots, depth) if growing is not None else np.zeros(n, np.int64)
                for node in nodes[c]:
                    rows = np.flatnonzero(use & (at == node))
                    if not len(rows):
                        continue
                    key = (c, node, TOTAL)
                    total[key] = total.get(key, 0) + np.array([[g[rows].sum(), h[rows].sum(), float(len(rows))]])
                    for j in wanted[c]:
                        b = bins[rows, j] + 1
                        w = np.stack([np.bincount(b, g[rows]), np.bincount(b, h[rows]), np.bincount(b).astype(float)], axis=1)
                        old = total.get((c, node, j))
                        if old is not None and len(old) != len(w):
                            size = max(len(old), len(w))
                            old, w = (np.pad(x, ((0, size - len(x)), (0, 0))) for x in (old, w))
                        total[(c, node, j)] = w if old is None else old + w
                    mine = np.zeros(n, dtype=bool)
                    mine[rows] = True
                    on = mine[slots.row]
                    if on.any():
                        ids, which = np.unique(slots.slot[on], return_inverse=True)
                        r = slots.row[on]
                        sums = np.stack([np.bincount(which, g[r]), np.bincount(which, h[r]), np.bincount(which).astype(float)], axis=1)
                        for s, v in zip(ids.tolist(), sums):
                            total[(c, node, s)] = total.get((c, node, s), 0) + v[None, :]
                    if len(total) > 200_000:
                        yield _batch(total, names)
                        total = {}
        if total:
            yield _batch(total, names)
    return run


def _batch(total: dict, names: list[str]) -> pa.RecordBatch:
    keys = np.array([k for k, v in total.items() for _ in range(len(v))], dtype=np.int64)
    bins = np.concatenate([np.arange(len(v)) for v in total.values()])
    sums = np.concatenate(list(total.values()))
    return pa.record_batch([pa.array(keys[:, 0], pa.int32()), pa.array(keys[:, 1], pa.int32()), pa.array(keys[:, 2], pa.int32()),
                            pa.array(bins, pa.int32()), *[pa.array(sums[:, i]) for i in range(3)]], names=names)


_SUMS = "k int, node int, feature int, bin int, g double, h double, n double"


def _dense(found: pa.Table, p: int) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, tuple]:
    """Nodes, their totals and numeric histograms (node, feature, bin, sum), and the validation loss."""
    k, node, feature, at = (found[c].to_numpy() for c in ("k", "node", "feature", "bin"))
    sums = np.stack([found[c].to_numpy() for c in "ghn"], axis=1)
    hit = np.flatnonzero(feature == LOSS)
    loss = (float(sums[hit[0], 0]), float(sums[hit[0], 2])) if len(hit) else (0.0, 0.0)
    of = {(int(a), int(b)): i for i, (a, b) in enumerate(sorted({*zip(k[feature == TOTAL].tolist(), node[feature == TOTAL].tolist())}))}
    place = np.array([of.get((int(a), int(b)), -1) for a, b in zip(k, node)], dtype=np.int64)
    totals = np.zeros((len(of), 3))
    whole = feature == TOTAL
    totals[place[whole]] = sums[whole]
    number = feature >= 0
    cells = np.zeros((len(of), p, int(at[number].max(initial=0)) + 1, 3))
    cells[place[number], feature[number], at[number]] = sums[number]
    return list(of), totals, cells, loss


def _gain(left: np.ndarray, total: np.ndarray, penalty: float, least_rows: float) -> np.ndarray:
    """Gain of splits by the sums of their left sides, below any where a side has too few rows."""
    right = total - left
    score = lambda x: x[..., 0] ** 2 / (x[..., 1] + penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.round((score(left) + score(right) - score(total)) / 2, 9)
    return np.where((left[..., 2] >= least_rows) & (right[..., 2] >= least_rows), gain, -np.inf)


def best_splits(sums: DataFrame, p: int, penalty: float, least_rows: float, least_gain: float, slots: bool) -> tuple[dict, dict, tuple]:
    """From summed histograms the best split (feature, cut, side of absent values, gain) and the
    totals of every (class, node), and the validation loss as (sum, rows). Bin 0 holds absent
    values, 1 .. the numbered bins; a slot feature has one bin, its set rows.

    The numeric histograms have (classes x nodes x features x bins) cells, whatever the
    rows, and are fetched; the slots', as many as there are levels, are ranked by Spark."""
    least_rows, least_gain = max(least_rows, 1.0), max(least_gain, 1e-9)
    if slots:
        sums = materialise(sums, "boosting-sums")
    nodes, totals, cells, loss = _dense(sums.where(F.col("feature") < p).toArrow(), p)
    best: dict = {}
    if nodes and p:
        upto = np.cumsum(cells[:, :, 1:], axis=2)
        sides = np.stack([upto, upto + cells[:, :, :1]], axis=3)              # absent values right, left
        gain = _gain(sides, totals[:, None, None, None, :], penalty, least_rows)
        gain = gain.reshape(len(nodes), -1)
        if gain.shape[1]:
            top = gain.argmax(axis=1)                                         # first of equals: feature, cut, right
            for i, at in enumerate(top):
                if gain[i, at] > least_gain:
                    j, b, side = np.unravel_index(at, sides.shape[1:4])
                    best[nodes[i]] = (int(j), int(b) + 1, bool(side), float(gain[i, at]))
    if slots and nodes:
        known = sums.sparkSession.createDataFrame([(*n, *t) for n, t in zip(nodes, totals.tolist())],
                                                  "k int, node int, tg double, th double, tn double")
        rows = sums.where(F.col("feature") >= p).join(F.broadcast(known), ["k", "node"])
        score = lambda g, h: g * g / (h + F.lit(penalty))
        lg, lh, ln = (F.col(f"t{c}") - F.col(c) for c in "ghn")
        gain = F.round((score(lg, lh) + score(F.col("g"), F.col("h")) - score(F.col("tg"), F.col("th"))) / 2, 9)
        rows = rows.where((ln >= least_rows) & (F.col("n") >= least_rows)).withColumn("gain", gain).where(F.col("gain") > least_gain)
        first = Window.partitionBy("k", "node").orderBy(F.col("gain").desc(), "feature")
        for r in rows.withColumn("r", F.row_number().over(first)).where("r = 1").collect():       # a row a node
            if r["gain"] > best.get((r["k"], r["node"]), (0, 0, 0, -np.inf))[3]:
                best[r["k"], r["node"]] = (r["feature"], 0, False, r["gain"])
        discard(sums)
    return best, {n: tuple(t) for n, t in zip(nodes, totals.tolist())}, loss


@register
class FittedSoftmaxBoosting(Fitted):
    def transform(self, df):
        from .models import _scored
        p = self.params
        model = df.sparkSession.sparkContext.broadcast(
            ([np.array(e) for e in p["edges"]], p["trees"], np.array(p["base"]), p["depth"]))
        vectors, k = p["vectors"], len(p["base"])

        @F.arrow_udf("array<double>")
        def margins(x: pa.Array, s: pa.Array) -> pa.Array:
            edges, trees, base, depth = model.value
            n = len(x)
            values = x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(edges))
            f = np.tile(base, (n, 1))
            bins, slots = _bins(values, edges), Slots(s, n)
            for group in trees:
                for c, tree in enumerate(group):
                    f[:, c] += np.array(tree[5])[walk(tree, bins, slots, depth)]
            return pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(f.ravel()))
        out = df.withColumn("__f", margins(_numbers(p["numbers"]), _slots(vectors, p["offsets"])))
        return _scored(out, [F.col("__f")[i] for i in range(k)], list(range(k))).drop("__f")


class SoftmaxBoosting(Step):
    """M8. ``params`` under the names of the other tree models: maxIter, maxDepth, stepSize,
    minInstancesPerNode, minInfoGain, subsamplingRate, featureSubsetStrategy ('all' or a number of
    numeric features a tree), maxBins, lambda, validation, patience."""

    def __init__(self, features: list[str], label: str = "label", params: dict | None = None, n_classes: int | None = None,
                 seed: int = 11):
        self.features, self.label, self.params = features, label, dict(params or {})
        self.n_classes, self.seed = n_classes, seed

    def fit(self, df):
        q, seed = self.params, self.seed
        bound_arrow(df.sparkSession)
        df = df.where(F.col(self.label).isNotNull())
        numbers, vectors = split_features(df, self.features)
        p, rounds, depth = len(numbers), int(q.get("maxIter", 20)), int(q.get("maxDepth", 3))
        rate, eta, penalty = float(q.get("subsamplingRate", 1.0)), float(q.get("stepSize", 0.1)), float(q.get("lambda", 1.0))
        counts = {int(r[0]): r[1] for r in df.groupBy(self.label).count().collect()}       # one row a class
        k = self.n_classes or max(counts, default=0) + 1
        n = sum(counts.values())
        base = [math.log((counts.get(c, 0) + 1.0) / (n + k)) for c in range(k)]
        edges = bin_edges(df, numbers, int(q.get("maxBins", 32)))
        sizes = vector_sizes(df, vectors)
        offsets = starts(sizes, p)
        model = {"numbers": numbers, "vectors": vectors, "offsets": offsets, "edges": edges, "base": base, "depth": depth, "trees": []}
        if not n or p + sum(sizes) == 0:
            return FittedSoftmaxBoosting(model)
        rows = self._binned(df, numbers, vectors, offsets, edges, base, float(q.get("validation", 0.0)))
        rng, losses, pending = np.random.RandomState(seed), [], []
        patience = int(q.get("patience", 3))
        for t in range(rounds + 1):
            wanted = [self._subset(rng, p) for _ in range(k)]
            grown = [Tree() for _ in range(k)]
            for tree in grown:
                tree.add()
            nodes = [[0] for _ in range(k)]
            last = t == rounds                      # only measures the last round's loss
            if last and not q.get("validation"):
                break
            for level in range(depth):
                sums = rows.mapInArrow(_histograms(
                    pending, [g.rows() for g in grown] if level else None, nodes, k, p, depth, [[]] * k if last else wanted,
                    rate, seed + t, level == 0), _SUMS).groupBy("k", "node", "feature", "bin") \
                    .agg(*[F.sum(c).alias(c) for c in "ghn"])
                best, totals, loss = best_splits(sums, p, penalty, float(q.get("minInstancesPerNode", 1)),
                                                 float(q.get("minInfoGain", 0.0)), bool(sum(sizes)))
                if level == 0 and loss[1]:
                    losses.append(loss[0] / loss[1])
                if last:
                    break
                for (c, node), (g, h, _) in totals.items():
                    grown[c].value[node] = -eta * g / (h + penalty)
                nodes = [[] for _ in range(k)]
                for (c, node), (feature, cut, null_left, _) in sorted(best.items()):
                    nodes[c] += grown[c].split(node, feature, cut, null_left)
                if not any(nodes):
                    break
            if losses and len(losses) - 1 - int(np.argmin(losses)) >= patience:
                break
            if last:
                break
            if any(nodes):                          # leaves of the last level have no totals yet
                self._leaf_values(rows, pending, grown, nodes, k, p, depth, rate, seed + t, eta, penalty)
            model["trees"].append([g.rows() for g in grown])
            pending.append(model["trees"][-1])
            if len(pending) == STORE_ROUNDS:
                rows, pending = self._advance(rows, pending, k, p, depth), []
        discard(rows)
        if losses:
            model["trees"] = model["trees"][:int(np.argmin(losses))]
            model["losses"] = losses
        return FittedSoftmaxBoosting(model)

    def _subset(self, rng, p):
        m = str(self.params.get("featureSubsetStrategy", "all"))
        return list(range(p)) if not m.isdigit() or int(m) >= p else sorted(rng.choice(p, int(m), replace=False).tolist())

    def _binned(self, df, numbers, vectors, offsets, edges, base, share):
        inner = [np.array(e) for e in edges]

        def run(batches):
            for b in batches:
                n = b.num_rows
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(inner))
                bins = _bins(x, inner)
                f = pa.ListArray.from_arrays(np.arange(0, n * len(base) + 1, len(base), dtype=np.int32), pa.array(np.tile(base, n)))
                yield pa.record_batch([b.column("row"), b.column("y"), b.column("held"),
                                       pa.array([r.tobytes() for r in bins.astype("<i4")], pa.binary()), b.column("slots"), f],
                                      names=["row", "y", "held", "bins", "slots", "f"])
        held = F.pmod(F.xxhash64(F.lit(29), "x"), F.lit(10_000)) < int(share * 10_000)
        slim = df.select(F.monotonically_increasing_id().alias("row"), F.col(self.label).cast("int").alias("y"),
                         _numbers(numbers).alias("x"), _slots(vectors, offsets).alias("slots")).withColumn("held", held)
        return materialise(slim.mapInArrow(run, "row bigint, y int, held boolean, bins binary, slots array<int>, f array<double>"),
                           "boosting-rows")

    def _leaf_values(self, rows, pending, grown, nodes, k, p, depth, rate, seed, eta, penalty):
        sums = rows.mapInArrow(_histograms(pending, [g.rows() for g in grown], nodes, k, p, depth, [[]] * k, rate, seed, False), _SUMS) \
            .where(F.col("feature") == TOTAL).groupBy("k", "node").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        for r in sums.collect():
            grown[r["k"]].value[r["node"]] = -eta * r["g"] / (r["h"] + penalty)

    def _advance(self, rows, pending, k, p, depth):
        """The rows with the margins of all trees so far."""
        def run(batches):
            for b in batches:
                n = b.num_rows
                if not n:
                    continue
                bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), dtype="<i4").reshape(n, p)
                slots = Slots(b.column("slots"), n)
                f = b.column("f").flatten().to_numpy(zero_copy_only=False).reshape(n, k).copy()
                for trees in pending:
                    for c, tree in enumerate(trees):
                        f[:, c] += np.array(tree[5])[walk(tree, bins, slots, depth)]
                column = pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(f.ravel()))
                yield b.set_column(b.schema.get_field_index("f"), "f", column)
        new = materialise(rows.mapInArrow(run, rows.schema), "boosting-rows")
        discard(rows)
        return new
