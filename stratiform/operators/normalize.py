"""Normalising transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import probit
from ..session import active_session
from .base import Fitted, Step, register
from .ranks import DEFAULT_ROWS_PER_BUCKET, _bucket_count, average_ranks, bucketize, value_cut_points


@register
class FittedLogShift(Fitted):
    def transform(self, df):
        shifts = self.params["shift"]
        return df.withColumns({c: F.ln(F.col(c) + F.lit(s)) for c, s in shifts.items()
                               if c in df.columns and s is not None})


class LogShift(Step):
    """log(x + C); by default C = |min(x)| + 1 learned per column."""

    def __init__(self, cols: list[str], shift: float | None = None):
        self.cols, self.shift = cols, shift

    def fit(self, df):
        cols = [c for c in self.cols if c in df.columns]
        if self.shift is not None:
            return FittedLogShift({"shift": {c: self.shift for c in cols}})
        row = df.agg(*[F.min(c).alias(c) for c in cols]).first()
        return FittedLogShift({"shift": {c: (None if row[c] is None else abs(row[c]) + 1.0)
                                         for c in cols}})


def log1p_safe(c: str):
    """ln(1 + x) for x > -1, null otherwise."""
    return F.when(F.col(c) > -1, F.log1p(F.col(c)))


@register
class FittedLog1p(Fitted):
    def transform(self, df):
        return df.withColumns({c: log1p_safe(c) for c in self.params["cols"] if c in df.columns})


class Log1p(Step):
    """N2 (canonical skew transform); columns missing from the frame are skipped."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df):
        return FittedLog1p({"cols": [c for c in self.cols if c in df.columns]})


@register
class FittedZScore(Fitted):
    def transform(self, df):
        out = {}
        for c, (mu, sd) in self.params["stats"].items():
            if c in df.columns and mu is not None:
                scale = sd if sd else 1.0
                out[c] = (F.col(c) - F.lit(mu)) / F.lit(scale)
        return df.withColumns(out)


class ZScore(Step):
    """(x - mean) / deviation; population deviation by default (ddof=1
    gives the sample deviation); a zero deviation scales by 1."""

    def __init__(self, cols: list[str], ddof: int = 0):
        self.cols, self.ddof = cols, ddof

    def fit(self, df):
        from .select import WIDE_STATS, wide_stats
        cols = [c for c in self.cols if c in df.columns]
        if self.ddof == 0 and len(cols) > WIDE_STATS:
            st = wide_stats(df, cols)
            return FittedZScore({"stats": {c: (st[c]["mean"], st[c]["std"]) for c in cols}})
        sd = F.stddev_pop if self.ddof == 0 else F.stddev_samp
        row = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols],
                     *[sd(c).alias(f"{c}__s") for c in cols]).first()
        return FittedZScore({"stats": {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}})


def _attach(df: DataFrame, table: DataFrame, col: str, out: str) -> DataFrame:
    """``out`` of the table row with the same value (``v``); null for null. The
    null rows go round the join, so they never share one join key."""
    known = df.where(F.col(col).isNotNull()).join(table, F.col(col).cast("double") == F.col("v"), "left").drop("v")
    nulls = df.where(F.col(col).isNull()).withColumn(out, F.lit(None).cast("double"))
    return known.unionByName(nulls)


def score_points(df: DataFrame, col: str) -> DataFrame:
    """(v, z): every distinct non-null value with Φ⁻¹((average rank - 0.5) / n)."""
    ranks = average_ranks(df.select(F.col(col).cast("double").alias("v")), "v")
    n = df.where(F.col(col).isNotNull()).count()
    return ranks.select("v", ((F.col("rank_avg") - 0.5) / F.lit(float(max(n, 1)))).alias("p")) \
        .select("v", probit("p").alias("z"))


def ordered_quantile_scores(df: DataFrame, col: str, out: str | None = None,
                            key: str | None = None) -> DataFrame:
    """N3 on training data: z = Φ⁻¹((average rank - 0.5) / n).

    Ranks come from bucketed prefix counts over distinct values (no
    single-partition window); the distinct-value scores are joined back
    on the value (AQE splits a hot value's partition)."""
    out = out or f"{col}_orq"
    return _attach(df, score_points(df, col).withColumnRenamed("z", out), col, out)


def interpolate(values: DataFrame, points: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """(v, z) for distinct values ``v`` by linear interpolation between the points
    next to them; beyond the points the end scores.

    Values and points are cut into buckets of the points' value range and each
    bucket is ordered by itself; the points next to its borders come from a
    table with one row a bucket."""
    n = points.count()
    cuts = value_cut_points(points, "v", _bucket_count(n, rows_per_bucket or DEFAULT_ROWS_PER_BUCKET))
    point = F.struct(F.col("v").alias("v"), F.col("z").alias("z"))
    marks = bucketize(points, "v", cuts, "__b").select("__b", "v", point.alias("pt"))
    asked = bucketize(values.select("v"), "v", cuts, "__b").select("__b", "v", F.lit(None).cast(marks.schema["pt"].dataType).alias("pt"))
    active = active_session()
    buckets = active.range(len(cuts) + 1).select(F.col("id").cast("int").alias("__b"))
    ends = marks.groupBy("__b").agg(F.min_by("pt", "v").alias("lo"), F.max_by("pt", "v").alias("hi"))
    order = Window.orderBy("__b")             # at most MAX_BUCKETS rows
    border = buckets.join(ends, "__b", "left").select(
        "__b", F.last("hi", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("left"),
        F.first("lo", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("right"))
    inside = Window.partitionBy("__b").orderBy("v")
    both = marks.unionByName(asked).withColumns({
        "a": F.last("pt", ignorenulls=True).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "b": F.first("pt", ignorenulls=True).over(inside.rangeBetween(Window.currentRow, Window.unboundedFollowing))})
    both = both.where(F.col("pt").isNull())
    both = both.join(F.broadcast(border), "__b") if cuts else \
        both.withColumns({"left": F.lit(None).cast(marks.schema["pt"].dataType), "right": F.lit(None).cast(marks.schema["pt"].dataType)})
    a, b = F.coalesce("a", "left"), F.coalesce("b", "right")
    z = (F.when(a.isNull(), b["z"]).when(b.isNull() | (a["v"] == b["v"]), a["z"])
         .otherwise(a["z"] + (b["z"] - a["z"]) * (F.col("v") - a["v"]) / (b["v"] - a["v"])))
    return both.select("v", z.alias("z"))


@register
class FittedOrderedQuantile(Fitted):
    """Replays N3 on new data: every training value has its exact score, others
    are interpolated between their neighbours, values outside the fitted range
    get the end scores. The state of a column is the table of its distinct
    values and scores."""

    def transform(self, df):
        for c in self.params["cols"]:
            if c not in df.columns:
                continue
            values = df.where(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("v")).distinct()
            scores = interpolate(values, self.tables[f"points_{c}"], self.params.get("rows_per_bucket"))
            order = df.columns
            df = _attach(df, scores, c, "z").drop(c).withColumnRenamed("z", c).select(*order)
        return df


class OrderedQuantile(Step):
    """N3 as a fit/transform pair."""

    cut_lineage = True

    def __init__(self, cols: list[str], rows_per_bucket: int | None = None):
        self.cols, self.rows_per_bucket = cols, rows_per_bucket

    def fit(self, df):
        tables = {f"points_{c}": score_points(df, c).checkpoint(eager=True) for c in self.cols}
        return FittedOrderedQuantile({"cols": self.cols, "rows_per_bucket": self.rows_per_bucket}, tables)
