"""Feature selection by constancy and by correlation.

Statistics run on the cluster in one aggregate pass (p min/max pairs, or
p(p-1)/2 correlations); only the p x p decision is made on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Fitted, Step, register
from ..session import active_session


WIDE_STATS = 24


def wide_stats(df: DataFrame, cols: list[str]) -> dict:
    """count, mean, population deviation, min and max of numeric columns.

    Many columns are summarised as one assembled vector (``Summarizer``, one
    vectorised aggregate); a column with nulls comes back as NaN there and is
    recomputed with plain aggregates over its non-null values, so results are
    the same either way."""
    import math

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Summarizer

    out, redo = {}, list(cols)
    if len(cols) > WIDE_STATS:
        vec = VectorAssembler(inputCols=cols, outputCol="__v", handleInvalid="keep") \
            .transform(df.select(*[F.col(c).cast("double") for c in cols]))
        s = vec.select(Summarizer.metrics("count", "mean", "variance", "min", "max")
                       .summary(F.col("__v")).alias("s")).first()["s"]
        n = s["count"]
        redo = []
        for i, c in enumerate(cols):
            mean = s["mean"][i] if n else None
            if mean is not None and math.isnan(mean):
                redo.append(c)
                continue
            var = s["variance"][i] * (n - 1) / n if n else None
            out[c] = {"n": n, "mean": mean, "std": None if var is None else math.sqrt(max(var, 0.0)),
                      "min": s["min"][i] if n else None, "max": s["max"][i] if n else None}
    if redo:
        row = df.agg(*[F.count(c).alias(f"{c}__n") for c in redo],
                     *[F.avg(c).alias(f"{c}__m") for c in redo],
                     *[F.stddev_pop(c).alias(f"{c}__s") for c in redo],
                     *[F.min(c).alias(f"{c}__lo") for c in redo],
                     *[F.max(c).alias(f"{c}__hi") for c in redo]).first()
        for c in redo:
            out[c] = {"n": row[f"{c}__n"], "mean": row[f"{c}__m"], "std": row[f"{c}__s"],
                      "min": row[f"{c}__lo"], "max": row[f"{c}__hi"]}
    return out


def constant_columns(df: DataFrame, cols: list[str]) -> list[tuple[str, bool]]:
    """A column is constant when all its non-null values are equal (min = max,
    compared in the column's own type)."""
    row = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols],
                 *[F.max(c).alias(f"{c}__hi") for c in cols]).first()
    return [(c, row[f"{c}__lo"] is None or row[f"{c}__lo"] == row[f"{c}__hi"]) for c in cols]


@register
class FittedDropColumns(Fitted):
    def transform(self, df):
        return df.drop(*self.params["drop"])


class DropConstant(Step):
    """Drop zero-variance columns."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df):
        drop = [c for c, const in constant_columns(df, self.cols) if const]
        return FittedDropColumns({"drop": drop})


WIDE = 24


def pair_correlation_aggs(pairs, prefix: str = "") -> list:
    """Aggregates for pairwise-complete Pearson correlations that never
    divide: covariance and both deviations over the rows where both values
    are present. ``pair_correlation_value`` turns them into r (None when a
    deviation is zero; ANSI ``corr`` would raise there)."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.covar_pop(a, b).alias(f"{prefix}cv{i}"),
                 F.stddev_pop(F.when(both, F.col(a))).alias(f"{prefix}sa{i}"),
                 F.stddev_pop(F.when(both, F.col(b))).alias(f"{prefix}sb{i}")]
    return aggs


def pair_correlation_value(row, i: int, prefix: str = ""):
    cv, sa, sb = row[f"{prefix}cv{i}"], row[f"{prefix}sa{i}"], row[f"{prefix}sb{i}"]
    if cv is None or not sa or not sb or math.isnan(cv / (sa * sb)):
        return None
    return max(-1.0, min(1.0, cv / (sa * sb)))


def gram_sums(df: DataFrame, cols: list[str], centre: list[float]):
    """Pairwise sums over rows where both columns are present, as p x p arrays:
    count, sum of the first, sum of its square, and of the product.

    Each task multiplies its batches with numpy and sends one row per column;
    those are added per column in two steps, so no task and not the driver
    gets more than p numbers a column from a bounded number of senders."""
    import numpy as np
    import pyarrow as pa

    p, mid = len(cols), np.array(centre)

    def partial(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols], axis=1) - mid
            here = ~np.isnan(x)
            x, m = np.where(here, x, 0.0), here.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pa.record_batch([pa.array(range(p), pa.int32()),
                               pa.array(list(total.transpose(1, 0, 2).reshape(p, -1)), pa.list_(pa.float64()))],
                              names=["i", "v"])

    def add(table):
        total = sum(np.asarray(v.values) for v in table["v"].combine_chunks())
        return pa.table({"i": table["i"].slice(0, 1), "v": pa.array([total], pa.list_(pa.float64()))})
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .mapInArrow(partial, "i int, v array<double>").withColumn("part", F.spark_partition_id() % 64)
    some = parts.groupBy("i", "part").applyInArrow(add, "i int, v array<double>")
    rows = some.groupBy("i").applyInArrow(add, "i int, v array<double>").collect()   # p rows
    out = np.zeros((4, p, p))
    for r in rows:
        out[:, r["i"], :] = np.array(r["v"]).reshape(4, p)
    return out


def correlation_matrix(df: DataFrame, cols: list[str]) -> dict:
    """Pearson correlations over the rows where both columns are present, at
    every width; None where one of them does not vary. A NaN counts as absent.

    Few columns use plain aggregates, one set a pair. Many columns use Gram
    sums of values and presence masks around the column means (matrix products
    in each task); only p x p numbers reach the driver either way."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return {}
    named = [(cols[i], cols[j]) for i, j in pairs]
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    if len(cols) <= WIDE:
        row = df.agg(*pair_correlation_aggs(named)).first()
        return {named[n]: pair_correlation_value(row, n) for n in range(len(named))}
    import numpy as np
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    n, s, q, xy = gram_sums(df, cols, [m or 0.0 for m in means])
    with np.errstate(divide="ignore", invalid="ignore"):
        var = q - s * s / n                       # of the row's column over the pair's rows
        r = (xy - s * s.T / n) / np.sqrt(var * var.T)
        flat = (var <= 1e-12 * np.maximum(q, 1e-300)) | (n < 1)
    r[flat | flat.T] = np.nan
    return {(cols[i], cols[j]): None if np.isnan(r[i, j]) else float(np.clip(r[i, j], -1, 1)) for i, j in pairs}


def correlated_to_drop(cols: list[str], corr: dict, threshold: float = 0.75,
                       rule: str = "upper") -> list[str]:
    """``upper``: drop column j if any earlier column i has |r| > threshold
    (even when i is dropped itself). ``greedy``: walk columns in order; each
    column not yet dropped drops every later column correlated with it."""
    def r(a, b):
        v = corr.get((a, b), corr.get((b, a)))
        return 0.0 if v is None or v != v else abs(v)

    if rule == "upper":
        return [cols[j] for j in range(len(cols))
                if any(r(cols[i], cols[j]) > threshold for i in range(j))]
    dropped: list[str] = []
    for i, a in enumerate(cols):
        if a in dropped:
            continue
        for b in cols[i + 1:]:
            if b not in dropped and r(a, b) > threshold:
                dropped.append(b)
    return dropped


class DropCorrelated(Step):
    """Drop correlated columns (rule ``upper`` canonical, ``greedy`` optional)."""

    def __init__(self, cols: list[str], threshold: float = 0.75, rule: str = "upper"):
        self.cols, self.threshold, self.rule = cols, threshold, rule

    def fit(self, df):
        corr = correlation_matrix(df, self.cols)
        return FittedDropColumns(
            {"drop": correlated_to_drop(self.cols, corr, self.threshold, self.rule)})


def correlation_decisions(df: DataFrame, cols: list[str], threshold: float = 0.75) -> DataFrame:
    """Decision table of X2's upper rule: (column, max_abs_r_earlier, keep)."""
    spark = active_session()
    corr = correlation_matrix(df, cols)
    rows = []
    for j, c in enumerate(cols):
        vals = [abs(corr[(cols[i], c)]) for i in range(j)
                if corr.get((cols[i], c)) is not None]
        m = max(vals) if vals else None
        rows.append((c, None if m is None else round(m, 6), not (m is not None and m > threshold)))
    return spark.createDataFrame(rows, "column string, max_abs_r_earlier double, keep boolean")
