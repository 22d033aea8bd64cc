"""Statistics of every training fold from one pass.

A training fold is all rows but one fold's, so its sums are the sums of all rows
less those of the fold left out. One pass adds up, per (fold, class), counts, sums,
squares and, if asked for, products of the numeric columns around a common
centre; from these come each training fold's means and deviations, correlations
and naive Bayes model, without k prepared copies of the data. Level counts per
fold give each training fold's modes in the same way. NaN counts as absent.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .normalize import FittedZScore


class FoldSums:
    """``parts[fold, class]`` = (rows, sums): sums are 3 x p (count, sum, square) or, with pairs, 4 x p x p
    (rows with both columns, sum of the first, of its square, of the product)."""

    def __init__(self, cols: list[str], centre: np.ndarray, parts: dict, pairs: bool):
        self.cols, self.centre, self.parts, self.pairs = cols, centre, parts, pairs
        self.folds = sorted({f for f, _ in parts})
        self.classes = sorted({c for _, c in parts if c is not None})

    def train(self, fold, label=...) -> tuple[int, np.ndarray]:
        """Rows and sums of all folds but one, of one class or (default) of all rows."""
        wanted = [(f, n, s) for (f, c), (n, s) in self.parts.items() if label is ... or c == label]
        rows = sum(n for _, n, _ in wanted) - sum(n for f, n, _ in wanted if f == fold)
        shape = (4, len(self.cols), len(self.cols)) if self.pairs else (3, len(self.cols))
        total = sum((s for _, _, s in wanted), np.zeros(shape))
        return rows, total - sum((s for f, _, s in wanted if f == fold), np.zeros(shape))

    def moments(self, fold, label=...) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, and the columns' counts, means and population variances (NaN without values)."""
        rows, s = self.train(fold, label)
        n, x, q = (s[i].diagonal() for i in range(3)) if self.pairs else s
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = np.where(n > 0, x / n, np.nan)
            var = np.where(n > 0, np.maximum(q / n - mean * mean, 0.0), np.nan)
        # What subtraction leaves of a constant column is round-off.
        var[var < 1e-13 * np.maximum(1.0, np.nan_to_num(q / np.maximum(n, 1)))] = 0.0
        return rows, n, mean + self.centre, var

    def zscore(self, fold) -> FittedZScore:
        _, n, mean, var = self.moments(fold)
        return FittedZScore({"stats": {c: (float(m), math.sqrt(v)) if k else (None, None) for c, k, m, v in zip(self.cols, n, mean, var)}})

    def correlations(self, fold) -> dict[tuple[str, str], float | None]:
        """Pearson correlations over the rows that have both columns; None where one does not vary."""
        _, s = self.train(fold)
        out = {}
        for i, a in enumerate(self.cols):
            for j in range(i + 1, len(self.cols)):
                n, si, qi, xy = s[:, i, j]
                sj, qj = s[1, j, i], s[2, j, i]
                vi, vj = (qi - si * si / n, qj - sj * sj / n) if n > 0 else (0.0, 0.0)
                flat = vi <= 1e-13 * max(1.0, qi) or vj <= 1e-13 * max(1.0, qj)
                out[a, self.cols[j]] = None if flat else float(max(-1.0, min(1.0, (xy - si * sj / n) / math.sqrt(vi * vj))))
        return out

    def naive_bayes(self, fold, features: list[str], var_smoothing: float = 1e-9, scaled: bool = False):
        """The Gaussian model of a training fold; with ``scaled`` that of its z-scored rows."""
        from .models import FittedGaussianNB
        at = [self.cols.index(f) for f in features]
        shift, scale = np.zeros(len(at)), np.ones(len(at))
        _, _, mean, var = (x[at] if isinstance(x, np.ndarray) else x for x in self.moments(fold))
        if scaled:
            shift, scale = mean, np.where(np.sqrt(var) > 0, np.sqrt(var), 1.0)
        eps = var_smoothing * float(np.nan_to_num(var / scale ** 2).max(initial=0.0))
        found = [(c, *(x[at] if isinstance(x, np.ndarray) else x for x in self.moments(fold, c))) for c in self.classes]
        found = [f for f in found if f[1]]
        rows = float(sum(f[1] for f in found))
        return FittedGaussianNB({"features": features, "classes": [f[0] for f in found],
                                 "log_prior": [math.log(f[1] / rows) for f in found],
                                 "mean": [((f[3] - shift) / scale).tolist() for f in found],
                                 "var": [(np.nan_to_num(f[4] / scale ** 2) + eps).tolist() for f in found]})


def fold_sums(df: DataFrame, fold: str, label: str | None, cols: list[str], pairs: bool = False) -> FoldSums:
    """The sums of every (fold, class) in one pass; numbers a column and pair reach the driver."""
    p = len(cols)
    number = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]
    rows = df.select(F.col(fold).cast("long").alias("f"), (F.col(label).cast("long") if label else F.lit(0).cast("long")).alias("c"), *number)
    # Any centre gives the same moments; one near the values loses no digits.
    near = rows.limit(1000).agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(p)]).first()
    centre = np.array([near[f"x{i}"] or 0.0 for i in range(p)])

    def partial(batches):
        total: dict[tuple, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(batch.column("f").to_pylist(), batch.column("c").to_pylist()))
            x = np.stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(p)], axis=1) - centre
            here = ~np.isnan(x)
            x, m = np.where(here, x, 0.0), here.astype(float)
            order: dict[tuple, list] = {}
            for i, key in enumerate(keys):
                order.setdefault(key, []).append(i)
            for key, at in order.items():
                a, b = x[at], m[at]
                s = np.stack([b.T @ b, a.T @ b, (a * a).T @ b, a.T @ a]) if pairs else np.stack([b.sum(0), a.sum(0), (a * a).sum(0)])
                old = total.get(key)
                total[key] = [len(at), s] if old is None else [old[0] + len(at), old[1] + s]
        for (f, c), (n, s) in total.items():
            lines = s.transpose(1, 0, 2).reshape(p, -1) if pairs else s.reshape(1, -1)
            yield pa.record_batch([pa.array([f] * len(lines), pa.int64()), pa.array([c] * len(lines), pa.int64()),
                                   pa.array(range(len(lines)), pa.int32()), pa.array([n] * len(lines), pa.int64()),
                                   pa.array(list(lines), pa.list_(pa.float64()))], names=["f", "c", "i", "n", "v"])

    def add(table):
        total = sum(np.asarray(v.values) for v in table["v"].combine_chunks())
        head = table.slice(0, 1)
        return pa.table({"f": head["f"], "c": head["c"], "i": head["i"], "n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                         "v": pa.array([total], pa.list_(pa.float64()))})
    schema = "f bigint, c bigint, i int, n bigint, v array<double>"
    parts = rows.mapInArrow(partial, schema).withColumn("part", F.spark_partition_id() % 64)
    some = parts.groupBy("f", "c", "i", "part").applyInArrow(add, schema)
    found: dict = {}
    for r in some.groupBy("f", "c", "i").applyInArrow(add, schema).collect():      # folds x classes x (p or 1) rows
        n, lines = found.setdefault((r["f"], r["c"]), [r["n"], {}])
        lines[r["i"]] = np.array(r["v"])
    whole = {key: (n, np.stack([lines[i].reshape(4, p) for i in range(p)], axis=1) if pairs else lines[0].reshape(3, p))
             for key, (n, lines) in found.items()}
    return FoldSums(cols, centre, whole, pairs)


def fold_modes(df: DataFrame, fold: str, cols: list[str]) -> DataFrame:
    """``fold, variable, level, n``: each training fold's most frequent level (ties: the smallest),
    from level counts per fold; levels never reach the driver."""
    long = df.select(F.col(fold).cast("long").alias("fold"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in cols])).alias("kv")) \
        .select("fold", "kv.*").where(F.col("level").isNotNull())
    counts = long.groupBy("fold", "variable", "level").agg(F.count(F.lit(1)).alias("n"))
    folds = sorted(r[0] for r in df.select(F.col(fold).cast("long")).distinct().collect())          # k values
    own = F.map_from_entries(F.collect_list(F.struct("fold", "n")))
    levels = counts.groupBy("variable", "level").agg(F.sum("n").alias("total"), own.alias("own"))
    left = levels.select("variable", "level", F.explode(F.transform(F.array(*[F.lit(f).cast("long") for f in folds]), lambda f: F.struct(
        f.alias("fold"), (F.col("total") - F.coalesce(F.element_at("own", f), F.lit(0))).alias("n")))).alias("t"))
    rows = left.select(F.col("t.fold").alias("fold"), "variable", "level", F.col("t.n").alias("n")).where("n > 0")
    w = Window.partitionBy("fold", "variable").orderBy(F.col("n").desc(), "level")
    return rows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
