"""Splits and folds (R1-R5) and random under-sampling (B2).

Every assignment is a function of (key, seed) through an md5 hash, never of
``rand()`` or partition layout, so it is reproducible and independent of the
number of partitions. Stratified variants rank rows inside each class by the
hash with bucketed row numbers (no window over a whole class in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_u32
from .ranks import hash_rank


def _ranked(df, key, strata, seed, buckets):
    h = df.withColumn("__h", hash_u32(key, seed))
    return hash_rank(h, [strata], "__h", key, rank_col="__rank", total_col="__n",
                     buckets=buckets)


def stratified_split(df: DataFrame, key: str, strata: str, train_fraction: float = 0.8,
                     seed: int = 9208, out: str = "is_train", buckets: int | None = None) -> DataFrame:
    """Within each class the first floor(p * n_class) rows by hash are training."""
    r = _ranked(df, key, strata, seed, buckets)
    return r.withColumn(out, F.col("__rank") <= F.floor(F.lit(train_fraction) * F.col("__n"))) \
        .drop("__h", "__rank", "__n")


def random_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 42,
                 out: str = "is_train") -> DataFrame:
    """R2: unstratified; training when hash mod 10^6 < p * 10^6."""
    return df.withColumn(out, F.pmod(hash_u32(key, seed), F.lit(1000000))
                         < F.lit(train_fraction * 1e6))


def stratified_folds(df: DataFrame, key: str, strata: str, k: int = 4, seed: int = 4000,
                     out: str = "fold", buckets: int | None = None) -> DataFrame:
    """fold = (rank in class - 1) mod k, so class shares per fold differ
    by at most one row."""
    r = _ranked(df, key, strata, seed, buckets)
    return r.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")) \
        .drop("__h", "__rank", "__n")


def repeated_folds(df: DataFrame, key: str, strata: str, k: int = 10, repeats: int = 4,
                   seed: int = 9208, buckets: int | None = None) -> DataFrame:
    """R3 repeated with seed + repeat; one row per (row, repeat)."""
    rep = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    txt = F.concat(F.lit(f"{seed}+"), F.col("repeat").cast("string"), F.lit(":"),
                   F.col(key).cast("string"))
    h = rep.withColumn("__h", F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("long"))
    r = hash_rank(h, ["repeat", strata], "__h", key, rank_col="__rank", total_col=None,
                  buckets=buckets)
    return r.withColumn("fold", ((F.col("__rank") - 1) % k).cast("int")).drop("__h", "__rank")


def random_folds(df: DataFrame, key: str, k: int = 4, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """fold = hash mod k."""
    return df.withColumn(out, F.pmod(hash_u32(key, seed), F.lit(k)).cast("int"))


def random_undersample(df: DataFrame, key: str, label: str, seed: int = 42,
                       buckets: int | None = None) -> DataFrame:
    """B2: keep, in every class, the first n_min rows by hash (n_min = size of
    the smallest class); classes of size n_min are kept whole."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    if not counts:
        return df
    n_min = min(r["n"] for r in counts)
    r = _ranked(df, key, label, seed, buckets)
    return r.where(F.col("__rank") <= n_min).drop("__h", "__rank", "__n")
