"""NearMiss under-sampling (B1, design D3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted, Step, register
from .knn import exact_knn
from .ranks import prefix_sums


def nearmiss(df: DataFrame, features: list[str], label: str, key: str, k: int = 3) -> DataFrame:
    """Keep the minority class whole and, in every larger class, the n_min
    rows whose mean distance to their k nearest minority rows is smallest
    (ties: smaller key). Rows without any neighbour (no coordinate in common)
    come last, so every larger class keeps n_min rows. Classes of size n_min
    are kept whole."""
    counts = {r[label]: r["n"] for r in
              df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    n_min = min(counts.values())
    minority = min(c for c, n in counts.items() if n == n_min)
    keep_whole = [c for c, n in counts.items() if n == n_min]
    larger = df.where(~F.col(label).isin(keep_whole))
    refs = df.where(F.col(label) == minority)
    near = exact_knn(larger, refs, features, k, key, key)
    score = near.groupBy(F.col("qid").alias(key)).agg(F.round(F.avg("dist"), 9).alias("__m"))
    # the scores feed both the cut search and the final filter: checkpoint
    # once (shared folder) instead of running the neighbour search twice
    scored = larger.join(score, key, "left") \
        .withColumn("__m", F.coalesce("__m", F.lit(float("inf")))).checkpoint(eager=True)
    # the cut per class: the n_min-th smallest mean distance, from bucketed
    # prefix counts over distinct scores (no window over a whole class)
    vc = scored.groupBy(label, "__m").agg(F.count(F.lit(1)).alias("n"))
    ps = prefix_sums(vc, [label], "__m", ["n"])
    cuts = {r[label]: (r["__m"], r["n_before"]) for r in
            ps.where((F.col("n_before") < n_min) & (F.col("n_upto") >= n_min)).collect()}
    kept = None
    for c, (m, before) in cuts.items():
        cls = scored.where(F.col(label) == c)
        below = cls.where(F.col("__m") < m)
        # rows tied at the cut: only they are ordered by key, in buckets
        tied = cls.where(F.col("__m") == m).withColumn("__one", F.lit(1))
        ties = prefix_sums(tied, [label], key, ["__one"]).where(F.col("__one_upto") <= n_min - before) \
            .select(*cls.columns)
        part = below.unionByName(ties)
        kept = part if kept is None else kept.unionByName(part)
    whole = df.where(F.col(label).isin(keep_whole))
    out = whole if kept is None else whole.unionByName(kept.drop("__m"))
    return out


@register
class FittedPassThrough(Fitted):
    def transform(self, df):
        return df


class NearMiss(Step):
    """B1 as a train-only recipe step: applied while fitting, skipped on new data."""

    train_only = True
    cut_lineage = True

    def __init__(self, features: list[str], label: str = "label", key: str = "row_id", k: int = 3):
        self.features, self.label, self.key, self.k = features, label, key, k

    def fit(self, df):
        f = FittedPassThrough({})
        f.training_output = nearmiss(df, self.features, self.label, self.key, self.k)
        return f
