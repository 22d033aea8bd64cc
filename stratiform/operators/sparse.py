"""Sparse vector features (the levels of an identifier) for models fitted from sums.

A vector column is read through its non-zero slots only. Per-class sums of a slot
and of its squares are one Spark aggregate, so that naive Bayes reads any number
of levels; discriminants need a square matrix and read up to ``MAX_WIDTH``
features; random features draw a slot's direction from its number and keep no
table. A null vector is one of zeros.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_arrow, materialise

#: Widest square matrix of a discriminant, numbers and slots together.
MAX_WIDTH = 2048
#: Largest table of slot weights that is broadcast; a larger one is joined.
SHIPPED_BYTES = 64 << 20
SALTS = 16


def is_vector(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "vectorudt"


def split_features(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """Plain and vector columns among the features."""
    vectors = [f for f in features if is_vector(df, f)]
    return [f for f in features if f not in vectors], vectors


def vector_sizes(df: DataFrame, vectors: list[str]) -> list[int]:
    """Slots of each vector column."""
    if not vectors:
        return []
    parts = [F.unwrap_udt(F.col(v)) for v in vectors]
    row = df.agg(*[F.max(F.when(u["type"] == 0, u["size"]).otherwise(F.size(u["values"]))).alias(f"v{i}")
                   for i, u in enumerate(parts)]).first()
    return [row[i] or 0 for i in range(len(vectors))]


def starts(sizes: list[int], first: int = 0) -> list[int]:
    """Number of each vector's first slot, where plain columns take the first ``first``."""
    return [first + sum(sizes[:i]) for i in range(len(sizes))]


def nonzero(vectors: list[str], offsets: list[int]):
    """The non-zero slots of a row's vectors as one list of (i, x)."""
    parts = []
    for v, first in zip(vectors, offsets):
        u = F.unwrap_udt(F.col(v))
        sparse = F.arrays_zip(u["indices"].alias("i"), u["values"].alias("x"))
        dense = F.transform(u["values"], lambda x, i: F.struct(i.alias("i"), x.alias("x")))
        found = F.filter(F.when(u["type"] == 0, sparse).otherwise(dense), lambda z: z["x"] != 0)
        moved = F.transform(found, lambda z: F.struct((z["i"] + first).alias("i"), z["x"].alias("x")))
        parts.append(F.coalesce(moved, F.array().cast("array<struct<i:int,x:double>>")))
    return F.concat(*parts) if parts else F.array().cast("array<struct<i:int,x:double>>")


def cells_of(cells: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature number and value of every cell of a batch's ``nonzero`` lists."""
    flat = cells.flatten()
    sizes = np.diff(cells.offsets.to_numpy()) if len(cells) else np.zeros(0, np.int64)
    return (np.repeat(np.arange(len(cells)), sizes), flat.field("i").to_numpy(zero_copy_only=False),
            flat.field("x").to_numpy(zero_copy_only=False))


def lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, k = values.shape
    return pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), pa.array(values.ravel()))


def slot_sums(df: DataFrame, label: str, vectors: list[str], offsets: list[int]) -> DataFrame:
    """(label, slot, s, q): sums of the values and of their squares, non-zero slots only."""
    return df.select(F.col(label).alias("label"), F.explode(nonzero(vectors, offsets)).alias("z")) \
        .groupBy("label", F.col("z.i").alias("slot")).agg(F.sum("z.x").alias("s"), F.sum(F.col("z.x") * F.col("z.x")).alias("q"))


def slot_moments(sums: DataFrame, classes: list, counts: list[int], smoothing: float, largest: float):
    """Normal densities of every slot in every class: (table, eps).

    The table has, for each slot that is set anywhere, ``a`` and ``b`` by class, the
    weights of x^2 and x in the log density, and ``c``, its log density at 0. ``eps`` is
    ``smoothing`` times the largest variance of a feature over all rows (``largest``
    is that of the plain ones), as ``GaussianNB`` defines it."""
    n = float(sum(counts))
    wide = sums.groupBy("slot").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == c, F.col("s"))), F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(classes)],
        *[F.coalesce(F.sum(F.when(F.col("label") == c, F.col("q"))), F.lit(0.0)).alias(f"q{i}") for i, c in enumerate(classes)],
        F.sum("s").alias("s"), F.sum("q").alias("q"))
    wide = materialise(wide, "slot-sums")
    spread = F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)
    eps = smoothing * max(largest, wide.agg(F.max(spread)).first()[0] or 0.0)
    a, b, c = [], [], []
    for i, m in enumerate(counts):
        mu = F.col(f"s{i}") / float(m)
        var = F.greatest(F.col(f"q{i}") / float(m) - mu * mu, F.lit(0.0)) + F.lit(eps)
        a.append(F.lit(-0.5) / var)
        b.append(mu / var)
        c.append(F.lit(-0.5) * F.log(F.lit(2 * math.pi) * var) - mu * mu / (F.lit(2.0) * var))
    return wide.select("slot", F.array(*a).alias("a"), F.array(*b).alias("b"), F.array(*c).alias("c")), eps


def slot_scores(df: DataFrame, table: DataFrame, n_rows: int, k: int, vectors: list[str], offsets: list[int],
                unset: float, name: str) -> DataFrame:
    """``df`` with ``name``, by class the sum of a x^2 + b x over a row's non-zero slots.

    A slot that no training row has set weighs ``unset`` x^2. A table of up to
    ``SHIPPED_BYTES`` is broadcast as arrays; a larger one is joined with the slots,
    salted, since a level may be that of a third of the rows."""
    z = nonzero(vectors, offsets)
    if n_rows * (2 * k + 1) * 8 <= SHIPPED_BYTES:
        rows = table.select("slot", "a", "b").toArrow()
        order = np.argsort(rows["slot"].to_numpy(), kind="stable")
        both = [np.array(rows[c].combine_chunks().flatten()).reshape(-1, k)[order] for c in "ab"]
        shipped = df.sparkSession.sparkContext.broadcast((rows["slot"].to_numpy()[order], *both))

        @F.arrow_udf("array<double>")
        def score(cells: pa.Array) -> pa.Array:
            slots, a, b = shipped.value
            row, i, x = cells_of(cells)
            at = np.minimum(np.searchsorted(slots, i), max(len(slots) - 1, 0))
            known = slots[at] == i if len(slots) else np.zeros(len(i), bool)
            part = np.repeat((unset * x * x)[:, None], k, axis=1)
            part[known] = a[at[known]] * (x * x)[known, None] + b[at[known]] * x[known, None]
            return lists(np.stack([np.bincount(row, part[:, c], len(cells)) for c in range(k)], axis=1))
        return df.withColumn(name, score(z))
    whole = materialise(df.withColumn("__row", F.monotonically_increasing_id()), "slot-rows")
    salted = table.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    cells = whole.select("__row", F.explode(z).alias("z")).select(
        "__row", F.col("z.i").alias("slot"), F.col("z.x").alias("x"), F.pmod("__row", F.lit(SALTS)).cast("int").alias("__salt"))
    x = F.col("x")
    terms = [F.sum(F.coalesce(F.col("a")[c] * x * x + F.col("b")[c] * x, F.lit(unset) * x * x)).alias(f"t{c}") for c in range(k)]
    sums = cells.join(salted, ["slot", "__salt"], "left").groupBy("__row").agg(*terms)
    out = whole.join(sums, "__row", "left")
    return out.withColumn(name, F.array(*[F.coalesce(F.col(f"t{c}"), F.lit(0.0)) for c in range(k)])) \
        .select(*df.columns, name)


def dense_features(numbers: list[str], vectors: list[str], sizes: list[int]):
    """All features of a row as one array, vectors written out."""
    from pyspark.ml.functions import vector_to_array
    parts = [F.array(*[F.col(f).cast("double") for f in numbers]).cast("array<double>")]
    for v, size in zip(vectors, sizes):
        parts.append(F.when(F.col(v).isNull(), F.array_repeat(F.lit(0.0), size)).otherwise(vector_to_array(v)))
    return F.concat(*parts)


def class_grams(df: DataFrame, label: str, numbers: list[str], vectors: list[str], sizes: list[int]):
    """Per class, in label order: (class, rows, means, p x p sums of products around the means).

    Each task multiplies its rows and sends a line of the matrix per class and feature, which
    Spark adds up in two steps. A row without one of its numbers is left out."""
    p = len(numbers) + sum(sizes)
    if p > MAX_WIDTH:
        raise ValueError(f"a discriminant reads at most {MAX_WIDTH} features, the vectors {vectors} make it {p}: "
                         "use another kind of model, or leave them out")
    bound_arrow(df.sparkSession)
    flat = df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("k"), dense_features(numbers, vectors, sizes).alias("x")) \
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))

    def lines(mid):
        def run(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
                y = batch.column("k").to_numpy()
                for c in np.unique(y).tolist():
                    mine = x[y == c]
                    new = np.vstack([np.append(len(mine), mine.sum(axis=0))]) if mid is None else (mine - mid[c]).T @ (mine - mid[c])
                    total[c] = total[c] + new if c in total else new
            for c, m in total.items():
                yield pa.record_batch([pa.array([c] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()),
                                       pa.array(list(m), pa.list_(pa.float64()))], names=["k", "i", "v"])
        return run

    def add(table):
        return pa.table({"k": table["k"].slice(0, 1), "i": table["i"].slice(0, 1),
                         "v": pa.array([sum(np.asarray(v.values) for v in table["v"].combine_chunks())], pa.list_(pa.float64()))})

    def summed(mid):
        schema = "k int, i int, v array<double>"
        parts = flat.mapInArrow(lines(mid), schema).withColumn("part", F.spark_partition_id() % 64)
        return parts.groupBy("k", "i", "part").applyInArrow(add, schema).groupBy("k", "i").applyInArrow(add, schema) \
            .orderBy("k", "i").collect()                  # p rows a class at most, p bounded
    first = {r["k"]: np.array(r["v"]) for r in summed(None)}
    means = {c: v[1:] / v[0] for c, v in first.items()}
    grams = {c: np.zeros((p, p)) for c in first}
    for r in summed(means):
        grams[r["k"]][r["i"]] = r["v"]
    return [(c, float(first[c][0]), means[c], grams[c]) for c in sorted(first)]


def directions(seed: int, ids: np.ndarray, n: int, sd: float) -> np.ndarray:
    """Normal directions of the features ``ids``, each drawn from (seed, id) alone."""
    return np.stack([np.random.Generator(np.random.Philox(key=[seed, int(i)])).normal(0.0, sd, n) for i in ids]) \
        if len(ids) else np.zeros((0, n))


def slot_phases(vectors: list[str], offsets: list[int], n: int, seed: int, sd: float):
    """Projections of a row's vectors on ``n`` random directions."""
    @F.arrow_udf("array<double>")
    def phases(cells: pa.Array) -> pa.Array:
        row, i, x = cells_of(cells)
        ids, which = np.unique(i, return_inverse=True)
        total = np.zeros((len(cells), n))
        np.add.at(total, row, directions(seed, ids, n, sd)[which] * x[:, None])
        return lists(total)
    return phases(nonzero(vectors, offsets))
