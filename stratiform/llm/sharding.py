"""Byte-balanced sharding by sampled splitters.

1. Keys (a hash of the text, so equal texts are neighbours) are sampled with a
   probability in proportion to their row's bytes; quantiles of the sample are
   the splitters of ``shards * RANGES_PER_SHARD`` ranges.
2. Every row goes to its range; the ranges' exact bytes are summed. A range
   over twice its share (a hot key, or an unlucky sample) is subdivided by a
   second hash into as many equal parts as its bytes call for, so no task gets
   an unbounded range, not even when one text holds a third of all rows.
3. Rows are ordered inside their part, and running bytes plus the parts'
   offsets give each row's place in the whole order. Shard boundaries lie at
   equal bytes of that order, slots count the rows of a shard from 0.

Bytes differ between shards by no more than the two rows at a boundary.
Nothing but the bounded sample and the parts' totals (whose number is bounded
by the shard count) reaches the driver.

Defined results: a null text has no bytes, so a size of 16, and the CRC of no
bytes (0); null and repeated ids are rows like any other; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, utf8_bytes

SHARDS = 40
#: Ranges for each shard, and sampled keys for each range.
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 32
ROW_BYTES = 16
#: More ranges are taken where a range would hold more rows.
ROWS_PER_RANGE = 1_000_000


def sample_splitters(rows: DataFrame, ranges: int, per_range: int) -> np.ndarray:
    """Boundaries of ``ranges`` ranges of ``k``, from a sample weighted by ``size``."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return np.zeros(0, dtype=np.int64)
    rate = ranges * per_range / total
    # Heavier rows are drawn more often; one that is drawn for sure counts for its bytes.
    draw = (F.pmod(F.xxhash64("tie", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < F.col("size") * F.lit(rate)
    weight = F.greatest(F.col("size") * F.lit(rate), F.lit(1.0))
    got = rows.where(draw).select("k", weight.alias("w")).toArrow()
    if got.num_rows == 0:
        return np.zeros(0, dtype=np.int64)
    key, w = got["k"].to_numpy(), got["w"].to_numpy()
    order = np.argsort(key, kind="stable")
    run = np.cumsum(w[order])
    cut = np.searchsorted(run, run[-1] * np.arange(1, ranges) / ranges)
    return np.unique(key[order][np.minimum(cut, len(key) - 1)])


def in_ranges(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``r``: 2 i for keys between splitters, 2 i + 1 for keys equal to splitter i,
    so that a hot key has a range of its own."""
    bounds = rows.sparkSession.sparkContext.broadcast(splitters)

    @F.arrow_udf("int")
    def place(key: pa.Array) -> pa.Array:
        k = key.to_numpy(zero_copy_only=False)
        left = np.searchsorted(bounds.value, k, side="left")
        right = np.searchsorted(bounds.value, k, side="right")
        return pa.array((left + right).astype(np.int32))
    return rows.withColumn("r", place("k"))


def shard_rows(rows: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """``rows`` needs ``size`` (long), ``k`` (long key) and ``tie`` (long hash that
    tells rows of one key apart); adds ``shard`` and ``slot``."""
    spark = rows.sparkSession
    ranges = max(shards * ranges_per_shard, -(-rows.count() // ROWS_PER_RANGE))
    # A stored row number tells even wholly repeated rows apart.
    rows = in_ranges(rows, sample_splitters(rows, ranges, SAMPLES_PER_RANGE))
    rows = stored(rows.withColumn("tie", F.xxhash64("tie", F.monotonically_increasing_id())), "shard-ranges")
    totals = rows.groupBy("r").agg(F.sum("size").alias("b")).collect()      # at most 2 * ranges rows
    share = max(1, sum(t["b"] for t in totals) // ranges)
    parts = {t["r"]: max(1, -(-t["b"] // share)) for t in totals if t["b"] > 2 * share}
    split = spark.createDataFrame(list(parts.items()), "r int, parts long")
    part = F.pmod("tie", F.coalesce("parts", F.lit(1)))
    rows = rows.join(F.broadcast(split), "r", "left").withColumn("p", part).drop("parts")
    # Part totals: at most 2 * ranges + 2 * ranges rows, since parts follow the bytes.
    per = sorted(tuple(x) for x in rows.groupBy("r", "p").agg(F.sum("size"), F.count("*")).collect())
    bytes_before = np.cumsum([0, *[x[2] for x in per]]).tolist()
    rows_before = np.cumsum([0, *[x[3] for x in per]]).tolist()
    offsets = spark.createDataFrame(
        [(x[0], x[1], bytes_before[i], rows_before[i]) for i, x in enumerate(per)],
        "r int, p long, b0 long, n0 long")
    order = Window.partitionBy("r", "p").orderBy("k", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("b0") + F.sum("size").over(order) - F.col("size") / 2
    placed = (rows.join(F.broadcast(offsets), ["r", "p"])
              .withColumn("at", F.col("n0") + F.count(F.lit(1)).over(order) - 1)
              .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(1, bytes_before[-1])))).cast("int")))
    placed = stored(placed.drop("r", "p", "b0", "n0"), "shard-placed")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))          # one row a shard
    return (placed.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("at") - F.col("first")).drop("at", "first"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The contract's row for each document."""
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select("doc_id", (utf8_bytes(F.col("text")) + ROW_BYTES).alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.xxhash64("text").alias("k"))
    rows = rows.withColumn("tie", F.xxhash64("doc_id", "text_crc32"))
    return shard_rows(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
