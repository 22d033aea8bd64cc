"""Global ranks and prefix counts without a single-partition window (design D2).

A window ordered over a whole table runs in one task. Instead the ordered key
is cut into buckets; each bucket is ordered by a window partitioned by the
bucket, and a small table of bucket totals supplies the offsets. Equal values
always fall into one bucket, so ranks (and average ranks for ties) are exact.
Hot values are collapsed first by aggregating counts per distinct value, so a
value held by a third of all rows is one row here.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cached

HASH_RANGE = 2 ** 32
DEFAULT_ROWS_PER_BUCKET = 2_000
#: Cut points are literals of the plan, so their number is bounded; buckets grow beyond it.
MAX_BUCKETS = 4096
BROADCAST_ROW_LIMIT = 2_000_000


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its row count is checked to be small.

    The table is persisted first, so the count and the join read it once.
    """
    df = cached(df)
    return F.broadcast(df) if df.count() <= max_rows else df


def _bucket_count(n_rows: int, rows_per_bucket: int, most: int = MAX_BUCKETS) -> int:
    return max(1, min(most, int(math.ceil(n_rows / float(rows_per_bucket)))))


def _same(left: DataFrame, right: DataFrame, cols: list[str], prefix: str):
    """Null-safe equality of ``cols`` with their renamed copies in ``right``."""
    return [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in cols]


HASH_ROWS_PER_BUCKET = 2_000
MAX_HASH_BUCKETS = 65_536


def hash_rank(df: DataFrame, partition_cols: list[str], hash_col: str, tie_col: str,
              rank_col: str = "rank", total_col: str | None = "stratum_n",
              buckets: int | None = None) -> DataFrame:
    """1-based row number within ``partition_cols`` ordered by (hash, tie).

    ``hash_col`` is uniform on [0, 2^32), so bucket bounds are arithmetic and
    every stratum is split evenly, however large it is. By default the bucket
    count follows the largest stratum (one small count per stratum): windows
    hold about ``HASH_ROWS_PER_BUCKET`` rows, or a ``MAX_HASH_BUCKETS``-th of it.
    """
    if buckets is None:
        largest = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n")) \
            .agg(F.max("n")).first()[0] or 0
        buckets = _bucket_count(largest, HASH_ROWS_PER_BUCKET, MAX_HASH_BUCKETS)
    b = F.floor(F.col(hash_col) * F.lit(buckets) / F.lit(HASH_RANGE)).cast("int")
    keyed = df.withColumn("__bucket", b)
    part = [F.col(c) for c in partition_cols]
    counts = keyed.groupBy(*partition_cols, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w_before = Window.partitionBy(*part).orderBy("__bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*part)
    offsets = counts.select(
        *partition_cols, "__bucket",
        F.coalesce(F.sum("__n").over(w_before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(w_all).alias("__total"))
    off = sized_broadcast(offsets.select(*[F.col(c).alias(f"__k_{c}") for c in partition_cols],
                                         "__bucket", "__offset", "__total"))
    cond = [keyed[c].eqNullSafe(off[f"__k_{c}"]) for c in partition_cols]
    joined = keyed.join(off, cond + [keyed["__bucket"] == off["__bucket"]]) \
        .drop(off["__bucket"]).drop(*[f"__k_{c}" for c in partition_cols])
    w_in = Window.partitionBy(*part, F.col("__bucket")).orderBy(hash_col, tie_col)
    out = joined.withColumn(rank_col, F.col("__offset") + F.row_number().over(w_in))
    if total_col:
        out = out.withColumn(total_col, F.col("__total"))
    return out.drop("__bucket", "__offset", "__total")


def value_cut_points(df: DataFrame, order_col: str, buckets: int,
                     accuracy: int | None = None) -> list[float]:
    """Approximate equal-count cut points of ``order_col`` (one aggregate job)."""
    if buckets <= 1:
        return []
    accuracy = accuracy or max(10_000, 25 * buckets)
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs,
                                     accuracy).alias("q")).first()
    cuts = sorted(set(v for v in (row["q"] or []) if v is not None))
    return cuts


def bucketize(df: DataFrame, order_col: str, cuts: list[float], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-float("inf")] + cuts + [float("inf")]
    tmp = "__bk_in"
    bz = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    res = bz.transform(df.withColumn(tmp, F.col(order_col).cast("double")))
    return res.withColumn(out, F.col(out).cast("int")).drop(tmp)


def prefix_sums(table: DataFrame, partition_cols: list[str], order_col: str,
                count_cols: list[str], descending: bool = False,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """For a table with one row per (partition, distinct order value), add
    ``<c>_before`` (sum over strictly smaller order values) and ``<c>_upto``
    (sum up to and including this value) for each count column.

    ``order_col`` must be unique within a partition (aggregate first).
    """
    table = cached(table)
    n = table.count()
    buckets = _bucket_count(n, rows_per_bucket)
    sign = -1.0 if descending else 1.0
    keyed = table.withColumn("__ord", F.col(order_col).cast("double") * F.lit(sign))
    cuts = value_cut_points(keyed, "__ord", buckets)
    keyed = bucketize(keyed, "__ord", cuts, "__bucket")
    part = [F.col(c) for c in partition_cols]
    if not cuts:
        # one bucket, at most rows_per_bucket rows in all: no offsets
        w_one = Window.partitionBy(*part).orderBy("__ord") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = keyed.withColumns({f"{c}_upto": F.sum(c).over(w_one) for c in count_cols})
        out = out.withColumns({f"{c}_before": F.col(f"{c}_upto") - F.col(c) for c in count_cols})
        return out.drop("__ord", "__bucket")
    totals = keyed.groupBy(*partition_cols, "__bucket").agg(
        *[F.sum(c).alias(f"__t_{c}") for c in count_cols])
    w_before = Window.partitionBy(*part).orderBy("__bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__k_{c}") for c in partition_cols], F.col("__bucket").alias("__k_bucket"),
        *[F.coalesce(F.sum(f"__t_{c}").over(w_before), F.lit(0)).alias(f"__o_{c}")
          for c in count_cols])
    off = sized_broadcast(offsets)
    joined = keyed.join(off, [*_same(keyed, off, partition_cols, "__k_"),
                              keyed["__bucket"].eqNullSafe(off["__k_bucket"])]) \
        .drop("__k_bucket", *[f"__k_{c}" for c in partition_cols])
    w_in = Window.partitionBy(*part, F.col("__bucket")).orderBy("__ord") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    for c in count_cols:
        upto = F.col(f"__o_{c}") + F.sum(c).over(w_in)
        cols[f"{c}_upto"] = upto
    out = joined.withColumns(cols)
    out = out.withColumns({f"{c}_before": F.col(f"{c}_upto") - F.col(c) for c in count_cols})
    return out.drop("__ord", "__bucket", *[f"__o_{c}" for c in count_cols])


def average_ranks(df: DataFrame, value_col: str, partition_cols: list[str] | None = None,
                  descending: bool = False) -> DataFrame:
    """Distinct (partition, value) table with n, min rank, max rank and average rank."""
    partition_cols = partition_cols or []
    vc = (df.where(F.col(value_col).isNotNull())
          .groupBy(*partition_cols, value_col).agg(F.count(F.lit(1)).alias("n")))
    ps = prefix_sums(vc, partition_cols, value_col, ["n"], descending=descending)
    return ps.select(*partition_cols, value_col, "n",
                     (F.col("n_before") + 1).alias("rank_min"),
                     F.col("n_upto").alias("rank_max"),
                     ((F.col("n_before") + 1 + F.col("n_upto")) / 2.0).alias("rank_avg"))


def row_numbers(df: DataFrame, order_col: str, out: str = "row_number",
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Dense 1-based numbering of rows by a unique numeric ``order_col``."""
    df = cached(df)
    n = df.count()
    buckets = _bucket_count(n, rows_per_bucket)
    cuts = value_cut_points(df, order_col, buckets)
    if not cuts:      # at most rows_per_bucket rows
        return df.withColumn(out, F.row_number().over(Window.orderBy(order_col)))
    keyed = bucketize(df, order_col, cuts, "__bucket")
    totals = keyed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w_before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # the totals table has one row per bucket (at most MAX_BUCKETS)
    offsets = totals.select("__bucket",
                            F.coalesce(F.sum("__n").over(w_before), F.lit(0)).alias("__off"))
    joined = keyed.join(sized_broadcast(offsets), "__bucket")
    w_in = Window.partitionBy("__bucket").orderBy(order_col)
    return joined.withColumn(out, F.col("__off") + F.row_number().over(w_in)) \
        .drop("__bucket", "__off")


def string_positions(table: DataFrame, group: str, value: str, parts: int | None = None) -> DataFrame:
    """``group, value, position``: 1-based place of each distinct value among its
    group's, in byte order. Values are range-partitioned, numbered inside their
    partition, and shifted by the group's rows in the partitions before."""
    spark = table.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = (table.select(group, value).distinct().repartitionByRange(n, group, value)
             .withColumn("__p", F.spark_partition_id())).checkpoint(eager=True)
    totals = keyed.groupBy(group, "__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy(group, "__p").orderBy(value)
    return keyed.join(offsets, [group, "__p"]).select(
        group, value, (F.col("__o") + F.row_number().over(inside)).alias("position"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict:
    """Exact linear-interpolation quantiles (R type 7) of numeric columns.

    Returns {column: {p: value}}. Work: one count per distinct value per
    column, prefix sums by bucket, and a filter that keeps the rows holding
    the target positions; only those rows reach the driver.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ps = cached(prefix_sums(vc, ["column"], "value", ["n"]))
    totals = {r["column"]: r["t"] for r in
              ps.groupBy("column").agg(F.max("n_upto").alias("t")).collect()}
    targets = {}
    for c in columns:
        t = totals.get(c)
        if not t:
            continue
        for p in probs:
            h = (t - 1) * p + 1.0
            lo = int(math.floor(h))
            targets[(c, p)] = (lo, min(lo + 1, t), h - lo)
    if not targets:
        return {c: {p: None for p in probs} for c in columns}
    conds = None
    for (c, _), (lo, hi, _) in targets.items():
        for pos in {lo, hi}:
            cond = (F.col("column") == c) & (F.col("n_before") < pos) & (F.col("n_upto") >= pos)
            conds = cond if conds is None else conds | cond
    rows = ps.where(conds).select("column", "value", "n_before", "n_upto").collect()

    def at(c, pos):
        for r in rows:
            if r["column"] == c and r["n_before"] < pos <= r["n_upto"]:
                return r["value"]
        return None

    out = {c: {p: None for p in probs} for c in columns}
    for (c, p), (lo, hi, frac) in targets.items():
        a, b = at(c, lo), at(c, hi)
        out[c][p] = a + frac * (b - a)
    ps.unpersist()
    return out
