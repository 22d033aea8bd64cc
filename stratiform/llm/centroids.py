"""Centroid clustering of integer vectors with ns-bounds.

A vector keeps, for every centroid, a lower bound of its distance and the round
in which that distance was last evaluated. The centroids of all rounds are kept
as well, so a bound is loosened by the norm of the centroid's total displacement
since that round, not by the sum of the norms of its single moves, which is
never smaller. Each round evaluates the distance to the vector's own centroid
exactly; only centroids whose loosened bound is not safely above it are
evaluated again, in integers, so assignments and ties are those of a full search.

Vectors and bounds lie in stored tables, one a round; the driver holds nothing
but centroids. Tasks add up their batches' vectors per cluster and component
before Spark sums them, so no cluster is gathered, however many rows it has.

A component x becomes floor(64 x). Rows are kept if their vector has exactly
``dims`` components, none null or not finite. Defined results: components
beyond 2^21 count as 2^21 (and so below), which keeps squared distances within
a long; repeated rows are vectors of their own; rows with equal hashes of their
ids (repeated ids) start as centroids in the order of their components; a null
id is hashed as an empty text; with fewer kept rows than ``k`` each is a
centroid; ties go to the smaller number; an empty centroid stays; an empty table
stays empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, drop_stored, stored

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Largest component in size; (2 LIMIT)^2 times 64 components is below 2^63.
LIMIT = 1 << 27
#: Centroid sets a bound may reach back to; older bounds are evaluated anew.
HISTORY = 32
LONG_MAX = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, key: str, vector: str, dims: int, scale: int = SCALE) -> DataFrame:
    """``key, v`` of the kept rows."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return vectors.where(v.isNotNull() & (F.size(v) == dims)).where(~bad) \
        .select(F.col(f"`{key}`").alias("key"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int, dims: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes, a top-k of Spark."""
    text = F.concat(F.lit("1:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    top = rows.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in top], dtype=np.int64).reshape(-1, dims)


@dataclass
class History:
    """Centroids of the last rounds, oldest first; ``base`` is the round of the first."""
    sets: list[np.ndarray]
    base: int = 0

    def now(self) -> int:
        return self.base + len(self.sets) - 1

    def add(self, centroids: np.ndarray) -> "History":
        sets = [*self.sets, centroids]
        return History(sets[-HISTORY:], self.base + max(0, len(sets) - HISTORY))

    def displacements(self) -> np.ndarray:
        """Norm of each centroid's move from every kept round to now, rounded up."""
        last = self.sets[-1]
        return np.array([np.sqrt(((last - s).astype(float) ** 2).sum(axis=1)) for s in self.sets]) * (1 + 1e-12)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def assign(v: np.ndarray, own: np.ndarray, bound: np.ndarray, seen: np.ndarray,
           history: History) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector and its squared distance; ``bound`` and
    ``seen`` are brought up to date. Also the number of distances evaluated."""
    c, now = history.sets[-1], history.now()
    rows = np.arange(len(v))
    best, near = own.copy(), squared(v, c[own])
    bound[rows, own], seen[rows, own] = np.sqrt(near.astype(float)), now
    reach = np.sqrt(near.astype(float)) * (1 + 1e-12)
    age = seen - history.base
    move = np.where(age >= 0, history.displacements()[np.maximum(age, 0), np.arange(len(c))], np.inf)
    fails = bound * (1 - 1e-12) - move <= reach[:, None]
    fails[rows, own] = False
    for j in range(len(c)):
        at = np.flatnonzero(fails[:, j])
        if len(at):
            d = squared(v[at], c[j])
            bound[at, j], seen[at, j] = np.sqrt(d.astype(float)), now
            closer = (d < near[at]) | ((d == near[at]) & (j < best[at]))
            near[at[closer]], best[at[closer]] = d[closer], j
    return best, near, len(v) + int(fails.sum())


def _matrix(column: pa.Array, n: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, n)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel(), kind))


def _step(rows: DataFrame, history: History, dims: int, kind: str) -> DataFrame:
    k = len(history.sets[-1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = _matrix(batch.column("v"), dims, np.int64)
        if "own" in batch.schema.names:
            own = batch.column("own").to_numpy().astype(np.int64)
            bound, seen = _matrix(batch.column("bound"), k, float), _matrix(batch.column("seen"), k, np.int64)
        else:
            own = np.zeros(len(v), dtype=np.int64)
            bound, seen = np.zeros((len(v), k)), np.full((len(v), k), -1)
        best, near, work = assign(v, own, bound, seen, history)
        counts = np.zeros(len(v), dtype=np.int64)
        counts[:1] = work
        return pa.record_batch([batch.column("key"), batch.column("v"), pa.array(best, pa.int32()), pa.array(near),
                                _lists(bound, pa.float64()), _lists(seen, pa.int32()), pa.array(counts)],
                               names=["key", "v", "own", "near", "bound", "seen", "work"])
    return arrow_map(rows, run, f"key {kind}, v array<int>, own int, near bigint, bound array<double>, seen array<int>, work bigint")


def _sums(rows: DataFrame, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact component sums of every cluster."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v, own = _matrix(batch.column("v"), dims, np.int64), batch.column("own").to_numpy()
        used = np.unique(own)
        sums = np.array([v[own == j].sum(axis=0) for j in used])
        return pa.record_batch([pa.array(np.repeat(used, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(used)), pa.int32()),
                                pa.array(np.column_stack((sums, [(own == j).sum() for j in used])).ravel(), pa.int64())],
                               names=["own", "dim", "x"])
    parts = arrow_map(rows.select("v", "own"), run, "own int, dim int, x bigint")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("own").pivot("dim", list(range(dims + 1))).agg(F.sum(F.col("x").cast("decimal(38,0)"))).collect():
        out[r["own"]] = (int(r[str(dims)]), [int(r[str(d)]) for d in range(dims)])
    return out


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Stored ``key, v, own, near`` of every kept vector after ``rounds`` replacements
    of the centroids, the final centroids, and the distances evaluated a round."""
    rows = stored(integer_vectors(vectors, key, vector, dims, scale), "centroids-rows")
    kind = rows.schema["key"].dataType.simpleString()
    first = first_centroids(rows, k, dims)
    if not len(first):
        return rows.select("key", "v", F.lit(0).alias("own"), F.lit(0).cast("long").alias("near")), first, []
    history, work = History([first]), []
    for turn in range(rounds + 1):
        new = stored(_step(rows, history, dims, kind), "centroids-bounds")
        drop_stored(rows)
        rows = new
        work.append(rows.agg(F.sum("work")).first()[0])
        if turn < rounds:
            c = history.sets[-1].copy()
            for j, (n, sums) in _sums(rows, dims).items():
                c[j] = [s // n for s in sums]
            history = history.add(c)
    return rows.select("key", "v", "own", "near"), history.sets[-1], work


def centroid_digest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The contract's row for each kept vector."""
    rows, centroids, _ = cluster(vectors, key, vector)
    spark = vectors.sparkSession
    sums = {r["own"]: int(r["s"]) for r in rows.groupBy("own").agg(F.sum(F.col("near").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    of = [(j, min(s, LONG_MAX), min(total, LONG_MAX), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
          for j, s in sums.items()]                                      # one row a centroid
    facts = spark.createDataFrame(of, "own int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "own").select(
        F.col("key").alias(key), F.col("own").alias("cluster"), F.col("near").alias("distance"),
        "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The same rounds by a full search, written out one after another."""
    square = "list_sum(list_transform(list_zip(r.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    part = [f"""x AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS e FROM embeddings),
r AS (SELECT vec_id, list_transform(e, lambda y: CAST(floor(greatest(least({SCALE} * y, {LIMIT}.0), -{LIMIT}.0)) AS BIGINT)) AS v
      FROM x WHERE len(e) = {DIMS} AND len(list_filter(e, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
r1 AS (SELECT *, row_number() OVER () AS i FROM r),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS j, v FROM r
       QUALIFY j < {K})"""]
    for t in range(ROUNDS + 1):
        part.append(f"""a{t} AS (SELECT r.i, r.vec_id, r.v, c.j, CAST({square} AS BIGINT) AS d FROM r1 r, c{t} c
       QUALIFY row_number() OVER (PARTITION BY r.i ORDER BY d, c.j) = 1)""")
        if t < ROUNDS:
            part.append(f"""s{t} AS (SELECT j, p, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM
       (SELECT j, unnest(v) AS x, unnest(range({DIMS})) AS p FROM a{t}) GROUP BY j, p),
m{t} AS (SELECT j, list(x ORDER BY p) AS v FROM s{t} GROUP BY j),
c{t + 1} AS (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m ON m.j = c.j)""")
    last = ROUNDS
    return f"""WITH {", ".join(part)}
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.j = a.j"""


ORACLE = _oracle()
