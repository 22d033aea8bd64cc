"""Neighbour imputation of large inputs by recursive two-means.

A table is its own donor: rows are split in two by two-means until no cluster has
more than ``max_rows`` rows, and each missing value is filled from the nearest rows
of its cluster. All clusters of a level are split at once: centres are a table,
joined by cluster, and a round is one aggregate, so neither the number of clusters
nor the rows of one reach the driver. A cluster of at most ``GROUP_BYTES`` is one
bounded group, whose splits, by the same rules, need no further pass over the table.

Rows may have nulls (a NaN is one): distances are mean squares over the columns
present in both. The split starts at the mean, one deviation to either side along
the widest column, and does not depend on the partitioning beyond rounding. A side
with less than ``LEAST`` of its cluster's rows, as with an outlier or with equal
rows, is not accepted; the cluster is then cut at the median of the difference of
both distances, ties by a hash of the key, so every split makes progress.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .base import Fitted, Step, register

MAX_ROWS = 1500
ROUNDS = 6
LEAST = 1 / 16
#: A split leaves at most 15/16 of a cluster, so this many levels are enough for any table.
LEVELS = 400
QUERIES = 256
#: Numbers of a cluster whose further splits one task makes.
GROUP_BYTES = 8 << 20


def _number(c: str):
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _nearer(p: int):
    """Squared distance to centre a less that to centre b, over the columns present."""
    return sum(F.coalesce((F.col(f"x{j}") - F.col(f"a{j}")) * (F.col(f"x{j}") - F.col(f"a{j}"))
                          - (F.col(f"x{j}") - F.col(f"b{j}")) * (F.col(f"x{j}") - F.col(f"b{j}")), F.lit(0.0)) for j in range(p))


def _start(rows: DataFrame, p: int, max_rows: int) -> DataFrame:
    """First centres of every cluster that is too large."""
    stats = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{j}").alias(f"m{j}") for j in range(p)],
                                     *[F.coalesce(F.stddev_pop(f"x{j}"), F.lit(0.0)).alias(f"s{j}") for j in range(p)])
    widest = F.greatest(*[F.col(f"s{j}") for j in range(p)]) if p > 1 else F.col("s0")
    axis = F.coalesce(*[F.when(F.col(f"s{j}") == widest, F.lit(j)) for j in range(p)])
    move = [F.when(axis == j, F.col(f"s{j}")).otherwise(0.0) for j in range(p)]
    return stats.where(F.col("n") > max_rows).select("node", *[(F.col(f"m{j}") - move[j]).alias(f"a{j}") for j in range(p)],
                                                     *[(F.col(f"m{j}") + move[j]).alias(f"b{j}") for j in range(p)])


def _coin(h: np.ndarray, level: int) -> np.ndarray:
    """The last bit of ``xxhash64(key, level)``, ``h`` being ``xxhash64(key)``."""
    one, two, three = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    x = h.astype(np.int64).view(np.uint64) + np.uint64(0x27D4EB2F165667C5 + 4)
    x = x ^ (np.array([level], np.uint64) * one)
    x = (x << np.uint64(23) | x >> np.uint64(41)) * two + three
    x = (x ^ x >> np.uint64(33)) * two
    x = (x ^ x >> np.uint64(29)) * three
    return ((x ^ x >> np.uint64(32)) & np.uint64(1)) == 1


def _means(x: np.ndarray, instead: np.ndarray) -> np.ndarray:
    n = (~np.isnan(x)).sum(axis=0)
    return np.where(n > 0, np.nansum(x, axis=0) / np.maximum(n, 1), instead)


def _gap(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_nearer`` of the rows of one cluster."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = (x[:, j] - a[j]) * (x[:, j] - a[j]) - (x[:, j] - b[j]) * (x[:, j] - b[j])
        out += np.where(np.isnan(x[:, j]) | np.isnan(a[j]) | np.isnan(b[j]), 0.0, d)
    return out


def _halves(x: np.ndarray, h: np.ndarray, level: int, rounds: int) -> np.ndarray:
    """Which rows of a cluster go to its second half, as in a level of ``two_means``."""
    mean = _means(x, np.full(x.shape[1], np.nan))
    sd = np.sqrt(_means((x - mean) ** 2, np.zeros(x.shape[1])))
    move = np.where(np.arange(len(sd)) == sd.argmax(), sd, 0.0)
    a, b = mean - move, mean + move
    for _ in range(rounds):
        left = _gap(x, a, b) <= 0
        a, b = _means(x[left], a), _means(x[~left], b)
    t = _gap(x, a, b)
    n, right = len(t), int((~(t <= 0)).sum())
    if min(right, n - right) >= LEAST * n:
        return ~(t <= 0)
    cut = np.partition(t, (n + 1) // 2 - 1)[(n + 1) // 2 - 1]
    return ~(t <= cut) | ((t == cut) & _coin(h, level))


def _finish(p: int, max_rows: int, rounds: int, level: int):
    """All further splits of one cluster that came out of ``level``; a row that no split could
    place has no cluster."""
    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = np.stack([table[f"x{j}"].to_numpy().astype(float) for j in range(p)], axis=1)
        h, key = table["h"].to_numpy(), table["key"].combine_chunks()
        todo, done = [(np.arange(len(x)), level)], []
        while todo:
            rows, at = todo.pop()
            if len(rows) <= max_rows or at >= LEVELS:
                done.append(rows)
                continue
            to = _halves(x[rows], h[rows], at, rounds)
            todo += [(half, at + 1) for half in (rows[to], rows[~to]) if len(half)]
        names = [key.take(pa.array(rows)) for rows in done]
        least = [pc.min(k) if len(k) <= max_rows else pa.scalar(None, key.type) for k in names]
        return pa.table({"key": pa.concat_arrays(names), "cluster": pa.concat_arrays([pa.array([v.as_py()] * len(k), key.type)
                                                                                     for v, k in zip(least, names)]),
                         "placed": pa.array(np.repeat([len(k) <= max_rows for k in names], [len(k) for k in names]))})
    return work


def two_means(df: DataFrame, cols: list[str], key: str, max_rows: int = MAX_ROWS, rounds: int = ROUNDS,
              group_rows: int | None = None) -> DataFrame:
    """``key, cluster`` of every row; a cluster has at most ``max_rows`` rows and is named by
    its smallest key. ``key`` is unique; an empty table has no clusters. Clusters of at most
    ``group_rows`` rows (default: by ``GROUP_BYTES``) are split further in one task each."""
    if max_rows < 1 or not cols:
        raise ValueError("two-means needs columns and room for one row a cluster")
    p = len(cols)
    group = max(max_rows, GROUP_BYTES // (8 * (p + 2)) if group_rows is None else group_rows)
    names = [f"x{j}" for j in range(p)]
    rows = materialise(df.select(F.col(key).alias("key"), F.lit(0).cast("long").alias("node"),
                                 *[_number(c).alias(n) for c, n in zip(cols, names)]), "two-means")
    done, found = [], f"key {rows.schema['key'].dataType.simpleString()}, cluster {rows.schema['key'].dataType.simpleString()}, placed boolean"

    def finish(some: DataFrame, level: int) -> DataFrame:
        ready = some.select("key", "node", F.xxhash64("key").alias("h"), *names)
        return materialise(ready.groupBy("node").applyInArrow(_finish(p, max_rows, rounds, level), found), "two-means-done")
    for level in range(LEVELS):
        centres = materialise(_start(rows, p, group), "two-means-centres")
        if centres.isEmpty():
            done.append(finish(rows, level))
            break
        done.append(finish(rows.join(centres.select("node"), "node", "left_anti"), level))
        for _ in range(rounds):
            far = rows.join(centres, "node").withColumn("t", _nearer(p))
            side = [F.col("t") <= 0, F.col("t") > 0]
            moved = far.groupBy("node").agg(*[
                F.coalesce(F.avg(F.when(side[i], F.col(f"x{j}"))), F.first(f"{c}{j}")).alias(f"{c}{j}")
                for i, c in enumerate("ab") for j in range(p)])
            new = materialise(moved, "two-means-centres")
            discard(centres)
            centres = new
        far = rows.join(centres, "node").withColumn("t", _nearer(p))
        cut = far.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t") > 0).alias("right"),
                                      F.percentile_approx("t", 0.5, 10_000).alias("median"))
        uneven = F.least("right", F.col("n") - F.col("right")) < F.lit(LEAST) * F.col("n")
        cut = cut.select("node", uneven.alias("uneven"), F.when(uneven, F.col("median")).otherwise(0.0).alias("cut"))
        coin = F.col("uneven") & (F.col("t") == F.col("cut")) & (F.pmod(F.xxhash64("key", F.lit(level)), F.lit(2)) == 1)
        to = ((F.col("t") > F.col("cut")) | coin).cast("int")
        halves = materialise(far.join(cut, "node").select("key", F.xxhash64("node", to, F.lit(level)).alias("node"), *names), "two-means")
        discard(rows)
        discard(centres)
        rows = halves
    else:
        raise RuntimeError(f"clusters of over {group} rows are left after {LEVELS} levels: is {key} unique?")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    if not out.where(~F.col("placed")).isEmpty():
        raise RuntimeError(f"clusters of over {max_rows} rows are left after {LEVELS} levels: is {key} unique?")
    return out.select(F.col("key").alias(key), "cluster")


def _fill(p: int, k: int):
    """The missing values of one cluster's rows: means over the k nearest rows that have them."""
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        x = np.stack([table[f"x{j}"].to_numpy().astype(float) for j in range(p)], axis=1)
        here = ~np.isnan(x)
        todo = np.flatnonzero(~here.all(axis=1))
        filled = np.full((len(todo), p), np.nan)
        for first in range(0, len(todo), QUERIES):
            q = todo[first:first + QUERIES]
            both, total = np.zeros((len(q), len(x))), np.zeros((len(q), len(x)))
            for j in range(p):
                common = here[q, j][:, None] & here[None, :, j]
                gap = np.where(common, x[q, j][:, None] - x[None, :, j], 0.0)
                both += common
                total += gap * gap
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(both > 0, np.round(np.sqrt(p / both * total), 9), np.inf)
            order = np.argsort(d, axis=1, kind="stable")             # rows are in key order: ties by key
            for i, at in enumerate(order):
                for j in np.flatnonzero(~here[q[i]]):
                    donors = at[here[at, j] & np.isfinite(d[i, at])][:k]
                    if len(donors):
                        filled[first + i, j] = x[donors, j].mean()
        return pa.table({"key": table["key"].take(pa.array(todo)),
                         **{f"x{j}": pa.array(filled[:, j], pa.float64(), from_pandas=True) for j in range(p)}})
    return work


@register
class FittedClusterKNN(Fitted):
    def transform(self, df):
        q = self.params
        cols, key, p = q["cols"], q["key"], len(q["cols"])
        row = df.agg(*[F.avg(_number(c)).alias(f"x{j}") for j, c in enumerate(cols)]).first()
        means = {c: row[f"x{j}"] for j, c in enumerate(cols)}
        absent = sum(_number(c).isNull().cast("int") for c in cols)
        sparse = absent > F.lit(q["row_max_missing"] * p)
        usable = df.where(~sparse).select(F.col(key).alias("key"), *[_number(c).alias(f"x{j}") for j, c in enumerate(cols)])
        names = [f"x{j}" for j in range(p)]
        clusters = two_means(usable, names, "key", q["max_rows"], q["rounds"])
        schema = f"key {df.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names)
        found = materialise(usable.join(clusters, "key").groupBy("cluster").applyInArrow(_fill(p, q["k"]), schema), "cluster-knn")
        found = found.select(F.col("key").alias("__key"), *[F.col(n).alias(f"__{n}") for n in names])
        gaps = df.where(absent > 0)
        out = gaps.join(found, F.col(key) == F.col("__key"), "left").withColumns(
            {c: F.coalesce(_number(c), F.col(f"__x{j}"), F.lit(means[c]).cast("double")) for j, c in enumerate(cols)})
        whole = df.where(absent == 0).withColumns({c: _number(c) for c in cols})
        return whole.unionByName(out.select(*df.columns))


class ClusterKNNImputer(Step):
    """Nearest neighbours without memory. Whatever table is transformed gives the donors;
    rows that miss more than ``row_max_missing`` of the columns take the table's column means
    and are no donors, the others are split into clusters of at most ``max_rows`` rows and
    filled within theirs. A value without any neighbour takes the column mean. ``key`` is
    unique and not null; columns come back as doubles."""

    cut_lineage = True

    def __init__(self, cols: list[str], k: int = 10, key: str = "row_id", row_max_missing: float = 0.5,
                 max_rows: int = MAX_ROWS, rounds: int = ROUNDS):
        self.params = {"cols": list(cols), "k": int(k), "key": key, "row_max_missing": float(row_max_missing),
                       "max_rows": int(max_rows), "rounds": int(rounds)}

    def fit(self, df):
        return FittedClusterKNN(dict(self.params))
