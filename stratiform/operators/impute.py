"""Statistical imputers (I3-I7): mean, median, mode. KNN lives in knn.py.

Fitting computes the statistic of every column in one pass (median: exact,
bucketed prefix counts); the transform is a narrow ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted, Step, register
from .ranks import exact_quantiles


@register
class FittedFill(Fitted):
    def transform(self, df):
        fills = self.params["fills"]
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                               for c, v in fills.items() if v is not None and c in df.columns})


class MeanImputer(Step):
    """I4 (and I7 on code columns): null -> training mean."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df):
        row = df.agg(*[F.avg(c).alias(c) for c in self.cols]).first()
        return FittedFill({"fills": {c: row[c] for c in self.cols}})


class MedianImputer(Step):
    """I3 (and I6 on code columns): null -> exact training median."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df):
        qs = exact_quantiles(df, self.cols, [0.5])
        return FittedFill({"fills": {c: qs[c][0.5] for c in self.cols}})


class ModeImputer(Step):
    """Null -> most frequent training level (ties: smallest level).

    All columns are counted in one aggregate over (column, level); the top
    level per column is picked by a per-partition group limit.
    """

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df):
        return FittedFill({"fills": column_modes(df, self.cols)})


def column_modes(df: DataFrame, cols: list[str]) -> dict:
    from pyspark.sql import Window
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"))
        for c in cols])).alias("kv")).select("kv.*").where(F.col("level").isNotNull())
    counts = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("level").asc())
    top = counts.withColumn("r", F.row_number().over(w)).where("r = 1").collect()
    found = {r["variable"]: r["level"] for r in top}
    return {c: found.get(c) for c in cols}


@register
class FittedKNNImputer(Fitted):
    """Replays KNN imputation with the stored blocks of the donors.

    Complete rows pass through untouched; only incomplete rows are searched,
    and the results are unioned back (no join of the full table). The neighbours
    are stored, so that the plan of the result is a scan and one join."""

    def transform(self, df):
        from .knn import exact_knn
        cols, key, k = self.params["cols"], self.params["key"], self.params["k"]
        means = self.params["means"]
        any_null = None
        for c in cols:
            cond = F.col(c).isNull()
            any_null = cond if any_null is None else any_null | cond
        complete = df.where(~any_null)
        incomplete = df.where(any_null)
        limit = self.params.get("row_max_missing")
        if limit is not None:
            share = sum(F.col(c).isNull().cast("int") for c in cols) / float(len(cols))
            too_sparse = incomplete.where(share > limit)
            incomplete = incomplete.where(share <= limit)
            complete = complete.unionByName(FittedFill({"fills": means}).transform(too_sparse))
        near = exact_knn(incomplete, None, cols, k, key, key, targets=cols,
                         index=(self.params["index"], self.tables.get("blocks")))
        filled = near.groupBy("qid", "target").agg(F.avg("value").alias("v"))
        wide = filled.groupBy("qid").agg(*[
            F.max(F.when(F.col("target") == c, F.col("v"))).alias(f"__imp_{c}") for c in cols])
        joined = incomplete.join(wide, incomplete[key] == wide["qid"], "left").drop("qid")
        out = joined.withColumns({
            c: F.coalesce(F.col(c), F.col(f"__imp_{c}"), F.lit(means.get(c)).cast("double"))
            for c in cols}).drop(*[f"__imp_{c}" for c in cols])
        return complete.unionByName(out.select(*df.columns))


class KNNImputer(Step):
    """Each missing value is the mean of that column over the k nearest
    training rows that have it (nan-Euclidean distance); no neighbour gives
    the training mean. ``row_max_missing`` (I2) sends rows with a larger share
    of missing values straight to the column means."""

    cut_lineage = True

    def __init__(self, cols: list[str], k: int = 10, key: str = "row_id",
                 row_max_missing: float | None = None, rows_per_bucket: int = 256):
        self.cols, self.k, self.key, self.row_max_missing = cols, k, key, row_max_missing
        self.rows_per_bucket = rows_per_bucket

    def fit(self, df):
        from .knn import knn_index
        row = df.agg(*[F.avg(c).alias(c) for c in self.cols]).first()
        # the donors' cells and blocks are the fitted state: built once, reused by
        # every transform (and every micro-batch of a stream)
        meta, blocks = knn_index(df, self.cols, self.k, self.key, targets=self.cols,
                                 rows_per_bucket=self.rows_per_bucket)
        return FittedKNNImputer({"cols": self.cols, "key": self.key, "k": self.k,
                                 "means": {c: row[c] for c in self.cols},
                                 "row_max_missing": self.row_max_missing, "index": meta},
                                {} if blocks is None else {"blocks": blocks})
