"""Naive Bayes with kernel densities and smoothed levels (M10: smoothness, Laplace).

A number's density in a class is a normal kernel estimate on a fixed grid of
``points`` over the training range, bandwidth ``smoothness`` * sample deviation *
n^(-1/5): rows are binned linearly in one aggregate over all columns and
classes, and (columns x classes x points) cells are convolved. Between grid
points the density is linear, beyond the grid it is that of its end, and never
below ``FLOOR``. A category's probability is (n + laplace) / (n of the class +
laplace * levels); level tables are stored and joined, whatever their size.
An absent value, and a level never seen when ``laplace`` is 0, say nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .base import Fitted, Step, register

FLOOR = 1e-12


def _number(c: str):
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


@register
class FittedKernelBayes(Fitted):
    """Adds prediction and class probabilities; the tables are one a categorical column."""

    def transform(self, df: DataFrame) -> DataFrame:
        from .models import _scored
        out = self.scores(df)
        names = [f"__k{c}" for c in range(len(self.params["classes"]))]
        return _scored(out, [F.col(n) for n in names], self.params["classes"]).drop(*names)

    def scores(self, df: DataFrame) -> DataFrame:
        """``df`` with the log score of each class, ``__k0``, ``__k1``, ..."""
        p = self.params
        k, numbers = len(p["classes"]), p["numbers"]
        grids = np.array(p["density"], dtype=float).reshape(len(numbers), k, -1)
        lo, step = np.array(p["lo"]), np.array(p["step"])

        @F.arrow_udf("array<double>")
        def number_scores(x: pa.Array) -> pa.Array:
            n = len(x)
            values = x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, len(numbers))
            total = np.zeros((n, k))
            for j in range(len(numbers)):
                have = np.flatnonzero(~np.isnan(values[:, j]))
                if not step[j] or not len(have):
                    continue
                at = np.clip((values[have, j] - lo[j]) / step[j], 0.0, grids.shape[2] - 1.0)
                g = np.minimum(np.floor(at).astype(int), grids.shape[2] - 2)
                part = at - g
                for c in range(k):
                    d = grids[j, c]
                    total[have, c] += np.log(np.maximum(d[g] * (1 - part) + d[g + 1] * part, FLOOR))
            return pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(total.ravel()))
        base = [F.lit(x) for x in p["log_prior"]]
        out = df
        if numbers:
            out = out.withColumn("__n", number_scores(F.array(*[_number(c) for c in numbers])))
            base = [b + F.col("__n")[c] for c, b in enumerate(base)]
        for i, col in enumerate(p["categories"]):
            table = self.tables[f"levels_{i}"].select(F.col("level").alias(f"__l{i}"), F.col("logs").alias(f"__c{i}"))
            out = out.join(table, out[col].cast("string") == table[f"__l{i}"], "left").drop(f"__l{i}")
            unseen = p["unseen"][i]
            for c in range(k):
                told = F.when(F.col(col).isNull(), 0.0).otherwise(F.coalesce(F.col(f"__c{i}")[c], F.lit(unseen[c])))
                base[c] = base[c] + told
        out = out.withColumns({f"__k{c}": b for c, b in enumerate(base)})
        return out.drop("__n", *[f"__c{i}" for i in range(len(p["categories"]))])


class KernelBayes(Step):
    def __init__(self, numbers: list[str], categories: list[str] = (), label: str = "label", smoothness: float = 1.0,
                 laplace: float = 0.0, points: int = 101):
        self.numbers, self.categories, self.label = list(numbers), list(categories), label
        self.smoothness, self.laplace, self.points = smoothness, laplace, points

    def fit(self, df):
        df = df.where(F.col(self.label).isNotNull())
        counts = sorted((int(r[0]), r[1]) for r in df.groupBy(self.label).count().collect())       # one row a class
        classes, total = [c for c, _ in counts], sum(n for _, n in counts)
        ends = df.agg(F.lit(0).alias("z"), *[F.min(_number(c)).alias(f"a{j}") for j, c in enumerate(self.numbers)],
                      *[F.max(_number(c)).alias(f"b{j}") for j, c in enumerate(self.numbers)]).first()
        lo = [ends[f"a{j}"] for j in range(len(self.numbers))]
        step = [0.0 if a is None else (ends[f"b{j}"] - a) / (self.points - 1) for j, a in enumerate(lo)]
        density = self._densities(df, classes, lo, step) if self.numbers and total else np.zeros((0, len(classes), self.points))
        tables, unseen = {}, []
        for i, col in enumerate(self.categories):
            tables[f"levels_{i}"], none = self._levels(df, col, classes)
            unseen.append(none)
        return FittedKernelBayes({"numbers": self.numbers, "categories": self.categories, "classes": classes,
                                  "log_prior": [math.log(n / total) for _, n in counts], "lo": [x or 0.0 for x in lo], "step": step,
                                  "density": density.tolist(), "unseen": unseen}, tables)

    def _densities(self, df, classes, lo, step):
        g = self.points
        places = [F.struct(F.lit(j).alias("j"), ((_number(c) - F.lit(lo[j] or 0.0)) / F.lit(step[j])).alias("u"))
                  for j, c in enumerate(self.numbers) if step[j]]
        out = np.zeros((len(self.numbers), len(classes), g))
        if not places:
            return out
        long = df.select(F.col(self.label).cast("int").alias("c"), F.explode(F.array(*places)).alias("s")).select("c", "s.j", "s.u") \
            .where(F.col("u").isNotNull())
        cell = F.least(F.floor("u"), F.lit(g - 2)).cast("int")
        found = long.withColumn("cell", cell).groupBy("j", "c", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("u") - F.col("cell")).alias("above"), F.sum("u").alias("s"),
            F.sum(F.col("u") * F.col("u")).alias("q")).collect()                 # columns x classes x points at most
        weight, sums = np.zeros(out.shape), np.zeros((*out.shape[:2], 3))
        at = {c: i for i, c in enumerate(classes)}
        for r in found:
            weight[r["j"], at[r["c"]], r["cell"]] += r["n"] - r["above"]
            weight[r["j"], at[r["c"]], r["cell"] + 1] += r["above"]
            sums[r["j"], at[r["c"]]] += [r["n"], r["s"], r["q"]]
        grid = np.arange(g)
        for j in range(len(self.numbers)):
            for c in range(len(classes)):
                n, s, q = sums[j, c]
                var = (q - s * s / n) / (n - 1) if n > 1 else 0.0
                if not n:
                    continue
                # A class without spread is as narrow as the grid can tell.
                h = max(self.smoothness * math.sqrt(max(var, 0.0)) * n ** -0.2, 0.5)
                kernel = np.exp(-0.5 * ((grid[:, None] - grid[None, :]) / h) ** 2)
                out[j, c] = kernel @ weight[j, c] / (n * h * math.sqrt(2 * math.pi))
        return out

    def _levels(self, df, col, classes):
        counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("level")).agg(*[
            F.sum(F.when(F.col(self.label) == c, 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(classes)])
        counts = materialise(counts, "levels")
        whole = counts.agg(F.count(F.lit(1)).alias("levels"), *[F.sum(f"n{i}").alias(f"t{i}") for i in range(len(classes))]).first()
        total = [float(whole[f"t{i}"] or 0) + self.laplace * whole["levels"] for i in range(len(classes))]
        share = [F.ln(F.greatest((F.col(f"n{i}") + self.laplace) / F.lit(total[i] or 1.0), F.lit(FLOOR))) for i in range(len(classes))]
        none = [math.log(max(self.laplace / t, FLOOR)) if self.laplace and t else 0.0 for t in total]
        return materialise(counts.select("level", F.array(*share).alias("logs")), "levels"), none
