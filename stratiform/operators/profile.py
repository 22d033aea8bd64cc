"""Column profiling and descriptive aggregates.

Every statistic is computed in as few aggregate passes as possible; only
per-column or per-level summaries (bounded by columns x levels) reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import bucket_equal_width
from .ranks import exact_quantiles
from ..session import active_session, cached


def class_balance(df: DataFrame, col: str = "outcome", extra_keys: list[str] | None = None,
                  extra_aggs: list | None = None) -> DataFrame:
    """A2: n and share per class (null labels excluded), plus optional extra
    per-class aggregates in the same pass. The class table is persisted, and
    the total is summed from it (one row per class), so the input is read once;
    no cross join and no global window."""
    keys = [col] + list(extra_keys or [])
    per_class = (df.where(F.col(col).isNotNull()).groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("n"), *(extra_aggs or [])))
    per_class = cached(per_class)
    total = per_class.agg(F.sum("n")).first()[0] or 0
    out = per_class.withColumn("share", F.round(F.col("n") / F.lit(float(max(total, 1))), 6))
    return out.select(*keys, "n", "share", *[c for c in per_class.columns if c not in keys + ["n"]])


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3 (numeric): min, quartiles (exact, type 7), mean, max and null count."""
    spark = active_session()
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                 F.avg(c).alias(f"{c}__mean"),
                 F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__nulls")]
    stats = df.agg(*aggs).first()
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    def num(v):
        return None if v is None else float(v)

    rows = [(c, num(stats[f"{c}__min"]), num(qs[c][0.25]), num(qs[c][0.5]), num(stats[f"{c}__mean"]),
             num(qs[c][0.75]), num(stats[f"{c}__max"]), int(stats[f"{c}__nulls"] or 0)) for c in cols]
    return spark.createDataFrame(
        rows, "column string, min double, q1 double, median double, mean double, "
              "q3 double, max double, nulls long")


def _long_levels(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"))
        for c in cols])).alias("kv")).select("kv.*")


def level_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """A4: counts per (variable, level) for many categorical columns in one
    aggregate; null is its own level (null)."""
    return _long_levels(df, cols).groupBy("variable", "level") \
        .agg(F.count(F.lit(1)).alias("n"))


def top_levels(df: DataFrame, cols: list[str], k: int = 6, other: str = "(Other)",
               missing: str = "NA") -> DataFrame:
    """A3 (categorical): the k most frequent levels per column, the rest as
    ``(Other)``, and nulls as ``NA``. The levels are counted once; the top k use
    a per-partition group limit, so no task ranks all levels of a column, and
    the rest is the column's total without them."""
    counts = level_counts(df, cols).checkpoint(eager=True)
    known = counts.where(F.col("level").isNotNull())
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("level").asc())
    top = known.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    totals = known.groupBy("variable").agg(F.sum("n").alias("total"))
    rest = (totals.join(top.groupBy("variable").agg(F.sum("n").alias("kept")), "variable")
            .where("total > kept")
            .select("variable", F.lit(other).alias("level"), (F.col("total") - F.col("kept")).alias("n"),
                    F.lit(k + 1).alias("rank")))
    nulls = (counts.where(F.col("level").isNull())
             .select("variable", F.lit(missing).alias("level"), "n",
                     F.lit(k + 2).alias("rank")))
    return top.unionByName(rest).unionByName(nulls)


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """A5: equal-width bins over [min, max] of each column (one min/max pass,
    one counting pass)."""
    mm = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols],
                *[F.max(c).alias(f"{c}__hi") for c in cols]).first()
    parts = []
    for c in cols:
        lo, hi = mm[f"{c}__lo"], mm[f"{c}__hi"]
        if lo is None:
            continue
        parts.append(F.struct(F.lit(c).alias("variable"),
                              bucket_equal_width(c, float(lo), float(hi), bins).alias("bin"),
                              F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")))
    long = df.select(F.explode(F.array(*parts)).alias("kv")).select("kv.*") \
        .where(F.col("bin").isNotNull())
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (long.groupBy("variable", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
            .select("variable", "bin",
                    F.round(F.col("lo") + (F.col("bin") - 1) * width, 6).alias("bin_lo"),
                    F.round(F.col("lo") + F.col("bin") * width, 6).alias("bin_hi"), "n"))


def correlation_long(df: DataFrame, cols: list[str], complete_rows: bool = True) -> DataFrame:
    """Pearson correlations of all column pairs in one aggregate pass,
    melted to (var1, var2, r, abs_r, upper) with upper = strict upper triangle."""
    spark = active_session()
    base = df.dropna(subset=cols) if complete_rows else df
    from .select import pair_correlation_aggs, pair_correlation_value
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if i < j]
    row = base.agg(*pair_correlation_aggs([(cols[i], cols[j]) for i, j in pairs])).first()
    index = {pair: n for n, pair in enumerate(pairs)}
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = 1.0
            else:
                r = pair_correlation_value(row, index[(min(i, j), max(i, j))])
            out.append((a, b, None if r is None else round(float(r), 6),
                        None if r is None else round(abs(float(r)), 6), i < j))
    return spark.createDataFrame(out, "var1 string, var2 string, r double, abs_r double, "
                                      "upper boolean")
