"""Calibrated class probabilities (K2): cross-fitted sigmoids with pairwise coupling.

The model is fitted ``folds`` times on all rows but one fold's and scores that fold, so every
row has scores of a model that has not seen it. For each pair of classes a
sigmoid of the difference of their scores is fitted to the pair's rows by
logistic regression. Of a new row the pairwise probabilities r_ij are coupled
into class probabilities that sum to 1: those that minimise the sum of
(r_ji p_i - r_ij p_j)^2, by the fixed-point iteration of Wu, Lin and Weng.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Probabilities of a pair are kept off 0 and 1.
LEAST = 1e-6


def couple(r: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Class probabilities of rows from their pairwise ones: r[n, i, j] = P(i | i or j)."""
    n, k, _ = r.shape
    if k == 1:
        return np.ones((n, 1))
    q = -np.swapaxes(r, 1, 2) * r
    for i in range(k):
        q[:, i, i] = sum(r[:, j, i] ** 2 for j in range(k) if j != i)
    p = np.full((n, k), 1.0 / k)
    for _ in range(rounds):
        before = p.copy()
        for i in range(k):
            qp = np.einsum("nij,nj->ni", q, p)
            total = np.einsum("ni,ni->n", p, qp)
            step = (total - qp[:, i]) / q[:, i, i]
            p[:, i] += step
            p /= (1.0 + step)[:, None]
        if np.abs(p - before).max(initial=0.0) < 1e-12:
            break
    return p


def probabilities(scores: np.ndarray, sigmoids: list) -> np.ndarray:
    """Coupled probabilities of rows of class scores; ``sigmoids`` are [i, j, slope, shift]."""
    n, k = scores.shape
    r = np.full((n, k, k), 0.5)
    for i, j, slope, shift in sigmoids:
        x = 1.0 / (1.0 + np.exp(-np.clip(slope * (scores[:, i] - scores[:, j]) + shift, -40, 40)))
        r[:, i, j] = np.clip(x, LEAST, 1 - LEAST)
        r[:, j, i] = 1 - r[:, i, j]
    return couple(r)


def fit_sigmoids(scored: DataFrame, label: str, scores: list[str]) -> list[list[float]]:
    """The sigmoid of each pair of classes that has rows of both."""
    k, out = len(scores), []
    for i in range(k):
        for j in range(i + 1, k):
            pair = scored.where(F.col(label).isin(i, j)).select(
                (F.col(scores[i]) - F.col(scores[j])).alias("d"), F.when(F.col(label) == i, 1.0).otherwise(0.0).alias("y"))
            if pair.select("y").distinct().count() < 2:
                continue
            model = LogisticRegression(labelCol="y", featuresCol="f", regParam=1e-6, standardization=True) \
                .fit(VectorAssembler(inputCols=["d"], outputCol="f").transform(pair))
            out.append([i, j, float(model.coefficients[0]), float(model.intercept)])
    return out


def cross_fitted(df: DataFrame, label: str, folds: int, fit_and_score) -> DataFrame:
    """Stored out-of-fold scores: ``fit_and_score(train, rest)`` returns ``rest`` scored. Folds go
    by a hash of all columns that can be hashed, so equal rows stay together."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("vectorudt", "map")]
    named = df.withColumn("__fold", F.pmod(F.xxhash64(F.lit(41), *plain), F.lit(folds)).cast("int"))
    out = None
    for f in range(folds):
        part = fit_and_score(named.where(F.col("__fold") != f).drop("__fold"), named.where(F.col("__fold") == f).drop("__fold"))
        out = part if out is None else out.unionByName(part)
    return materialise(out.where(F.col(label).isNotNull()), "calibration")


def probability_columns(df: DataFrame, scores: F.Column, sigmoids: list, k: int) -> DataFrame:
    """``df`` with calibrated ``prob_<k>`` columns from an array of class scores."""
    @F.arrow_udf("array<double>")
    def calibrated(column: pa.Array) -> pa.Array:
        s = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), k)
        p = probabilities(s, sigmoids)
        return pa.ListArray.from_arrays(np.arange(0, len(s) * k + 1, k, dtype=np.int32), pa.array(p.ravel()))
    out = df.withColumn("__c", calibrated(scores))
    return out.withColumns({f"prob_{c}": F.col("__c")[c] for c in range(k)}).drop("__c")
