"""Exact k-nearest neighbours over pivot cells.

Distance is the nan-Euclidean distance: over the coordinates C present in
both rows, d = sqrt(p / |C| * sum_{j in C} (x_j - y_j)^2); rows with no common
coordinate are not neighbours. A NaN counts as absent.

* References are grouped by presence pattern (the frequent ones; all others
  share a group) and inside a group put into the cell of the nearest pivot, a
  sampled row: a Voronoi partition. A cell knows its centre, its radius, its
  bounding box, which coordinates all and which some of its rows have, and how
  many rows have each target. Its rows are packed into blocks of about
  ``BLOCK_BYTES``, in the order of their distance to the pivot.
* Of references equal in every coordinate only the k smallest ids can be
  neighbours, so a value held by a third of the rows is k rows.
* A query sees only its own coordinates, and of references that look equal to it only the k
  smallest ids that have a target can be neighbours. Where that leaves few rows of a group (the
  coordinate that tells them apart is absent on one side), the presence pattern of the query has
  a view: these rows, in cells over its coordinates alone, take the place of the group's cells.
* The distance to any row of a cell is bounded from below by the triangle
  inequality over the coordinates A that the query and all rows of the cell have,
  sqrt(p / |U|) * (|x - centre|_A - radius), and by the box over A, where U are
  the coordinates that the query and some row have. Both hold for every pattern.
* Queries are dealt by presence pattern and by place along a space-filling curve and cut
  into packs of neighbours. Pass 1 sends a pack the blocks of the ``NEAR`` cells with k eligible
  rows a target that are nearest to each query, compares each query with its own cells only and
  takes the k-th distances as radii. Pass 2 sends the pack all
  cells whose bound does not exceed the radius of some query. Blocks come nearest first
  and a pack keeps the k nearest so far, so that its radii shrink on the way; a pair of
  a block and those queries of the pack that it can serve is one matrix product in bounded
  chunks, and only what it leaves near enough is computed exactly.
* A pack looks at the cells in runs of ``RUN`` queries: a box around a run rules most out
  before any bound of a single query is taken. Rows find their pivot over some of the
  pivots first, since any cell is right for a row.

Nothing but the cells, of a bounded size, reaches the driver and is broadcast:
their number follows the references up to ``CELL_BYTES`` and cells grow beyond.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import active_session, bound_arrow, discard, materialise

ANY_TARGET = "*"
#: Presence patterns with cells of their own.
MAX_PATTERNS = 256
#: Frequent patterns that may have views, of as many groups; sets of coordinates looked at for it; and a
#: view holds at most one row in ``VIEW_SHARE`` of a group.
MAX_VIEWS, MAX_LOOKS, VIEW_SHARE = 16, 32, 8
#: Bytes of rows that a task thins out together for the views.
THIN_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
#: Bytes of all cells together, a bound on what is broadcast.
CELL_BYTES = 48 << 20
MAX_CELLS = 65_536
#: Entries of a (query, cell) or (query, reference) matrix a task holds at a time.
BOUND_CELLS = 1_000_000
#: Queries of a pack, at most and by their bytes, and of a run that looks at the cells together.
PACK_ROWS, PACK_BYTES, RUN = 2048, 4 << 20, 256
#: Pairs near in one coordinate are listed where they are at most one in ``BAND`` of all.
BAND = 8
#: Cells of pass 1 of each (query, target).
NEAR = 3
#: Nearest cells with enough rows among which a run's first cells are chosen, a target.
LIKELY = 256
#: Patterns of a run that get boxes of their own.
KINDS = 16


def _present(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """``id, x``: the key and all coordinates, null where absent."""
    x = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    return df.select(F.col(key).alias("id"), F.array(*x).alias("x"))


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    """Rows of a list column as a matrix, NaN where absent."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, p)


def _unpack(raw: bytes, p: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<f8").reshape(-1, p)


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, dtype="<f8").tobytes()


def _mask_text(x: F.Column) -> F.Column:
    return F.array_join(F.transform(x, lambda v: F.when(v.isNull(), F.lit("0")).otherwise(F.lit("1"))), "")


def _bits(mask: str) -> np.ndarray:
    return np.array([c == "1" for c in mask])


def _has(views: np.ndarray, j: int) -> F.Column:
    """Whether a row's view has a coordinate."""
    return F.get(F.array(*[F.lit(bool(v[j])) for v in views]), F.col("view"))


def _seen(views: np.ndarray) -> F.Column:
    """The coordinates of ``x`` that a row's view has, null for the others."""
    return F.array(*[F.when(_has(views, j), F.col("x")[j]) for j in range(views.shape[1])])


@dataclass
class Cells:
    """What the driver and every task know of the cells; rows are cells."""
    center: np.ndarray
    radius: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    every: np.ndarray       # coordinates all rows have
    some: np.ndarray        # coordinates some row has
    count: np.ndarray       # rows that have each target, up to k
    number: np.ndarray

    def bounds(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each (query, cell of ``at``) a lower bound of the distance to any row, the distance to
        the centre, and an upper bound of the distance to every row; infinite where no coordinate
        can be common, the upper bound also where the cell's rows have different ones."""
        p = x.shape[1]
        have, every, some = ~np.isnan(x), self.every[at], self.some[at]
        center, lo, hi = self.center[at], self.lo[at], self.hi[at]
        tri = np.zeros((len(x), len(at)))
        box = np.zeros_like(tri)
        for j in range(p):
            if not every[:, j].any() or not have[:, j].any():
                continue
            if every[:, j].all() and have[:, j].all():
                away = x[:, j, None] - center[None, :, j]
                tri += away * away
                away = np.maximum(lo[None, :, j] - x[:, j, None], x[:, j, None] - hi[None, :, j])
                np.maximum(away, 0.0, out=away)
                box += away * away
                continue
            both = have[:, j, None] & every[None, :, j]
            xj = np.where(have[:, j], x[:, j], 0.0)[:, None]
            tri += np.where(both, (xj - center[None, :, j]) ** 2, 0.0)
            box += np.where(both, np.maximum(np.maximum(lo[None, :, j] - xj, xj - hi[None, :, j]), 0.0) ** 2, 0.0)
        shared = have.astype(float) @ some.T.astype(float)
        scale = np.sqrt(p / np.maximum(shared, 1.0))
        tri = np.sqrt(tri)
        least = scale * np.maximum(np.maximum(tri - self.radius[at], 0.0), np.sqrt(box))
        most = np.where((every == some).all(axis=1), scale * (tri + self.radius[at]), np.inf)
        return tuple(np.where(shared > 0, v, np.inf) for v in (least, scale * tri, most))

    def runs(self, x: np.ndarray):
        """(rows, coordinates that all of them have) of one pattern, or of all if there are many."""
        have = ~np.isnan(x)
        kinds, which = np.unique(have, axis=0, return_inverse=True)
        if len(kinds) > KINDS:
            return [(np.arange(len(x)), np.flatnonzero(have.all(axis=0)))]
        return [(np.flatnonzero(which.ravel() == i), np.flatnonzero(kind)) for i, kind in enumerate(kinds)]

    def likely(self, x: np.ndarray, k: int) -> np.ndarray:
        """Cells near a run of queries, for each target ``LIKELY`` with k rows that have it."""
        if len(self.radius) <= LIKELY:
            return np.arange(len(self.radius))
        out = np.zeros(len(self.radius), dtype=bool)
        for rows, has in self.runs(x):
            far = np.zeros(len(self.radius))
            for j in has:
                far += np.where(self.every[:, j], (self.center[:, j] - x[rows, j].mean()) ** 2, 0.0)
            far /= np.maximum(self.some[:, has].sum(axis=1), 0.5)
            for t in range(self.count.shape[1]):
                full = np.flatnonzero(self.count[:, t] >= k)
                out[full if len(full) <= LIKELY else full[np.argpartition(far[full], LIKELY)[:LIKELY]]] = True
        return np.flatnonzero(out)

    def within(self, x: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Cells that a box around the queries of a run does not rule out."""
        out = np.zeros(len(self.radius), dtype=bool)
        for rows, has in self.runs(x):
            gap = np.zeros(len(self.radius))
            for j in has:
                apart = np.maximum(np.maximum(self.lo[:, j] - x[rows, j].max(), x[rows, j].min() - self.hi[:, j]), 0.0)
                gap += np.where(self.every[:, j], apart ** 2, 0.0)
            out |= np.sqrt(gap) <= limit[rows].max()
        return np.flatnonzero(out)

    def first(self, x: np.ndarray, need: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least bound of each cell that pass 1 gives a run (infinite: not visited), for each needed
        target of a query the ``NEAR`` nearest with k rows that have it; the radii known before; and
        the numbers of these cells for each (query, target), -1 for none."""
        out, reach, at = np.full(len(self.radius), np.inf), np.full(need.shape, np.inf), self.likely(x, k)
        goes_to = np.full((*need.shape, NEAR), -1, dtype="<i4")
        if not len(at):
            return out, reach, goes_to
        step = max(1, BOUND_CELLS // len(at))
        for lo in range(0, len(x), step):
            least, near, most = self.bounds(x[lo:lo + step], at)
            for t in range(need.shape[1]):
                rows = np.flatnonzero(need[lo:lo + step, t])
                if not len(rows):
                    continue
                full = self.count[at, t] >= k
                reach[lo + rows, t] = np.where(full, most[rows], np.inf).min(axis=1)
                goes = np.where(full, near[rows], np.inf)
                best = np.argpartition(goes, NEAR - 1, axis=1)[:, :NEAR] if len(at) > NEAR else np.tile(np.arange(len(at)), (len(rows), 1))
                i, j = np.nonzero(np.isfinite(np.take_along_axis(goes, best, axis=1)))
                best = best[i, j]
                np.minimum.at(out, at[best], least[rows[i], best])
                goes_to[lo + rows[i], t, j] = self.number[at[best]]
        return out, reach, goes_to

    def second(self, x: np.ndarray, need: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Least bound of each cell that may hold a neighbour of a run's queries, infinite for the others."""
        out, limit = np.full(len(self.radius), np.inf), _limits(need, reach)
        at = self.within(x, limit.max(axis=1))
        step = max(1, BOUND_CELLS // max(1, len(at)))
        for lo in range(0, len(x) if len(at) else 0, step):
            least = self.bounds(x[lo:lo + step], at)[0]
            goes = np.zeros(least.shape, dtype=bool)
            for t in range(need.shape[1]):
                goes |= (least <= limit[lo:lo + step, t, None]) & (self.count[None, at, t] > 0)
            out[at] = np.minimum(out[at], np.where(goes, least, np.inf).min(axis=0))
        return out


class Views:
    """All cells; those of the whole, and of each view for the queries of its pattern."""

    def __init__(self, every: Cells, meta: dict):
        self.every, self.meta, self.cut = every, meta, {}
        self.have = [_bits(m) for m, _, _ in meta["views"]]

    def of(self, x: np.ndarray) -> np.ndarray:
        """The view of each query; 0, the whole, for a pattern that has none."""
        has, out = ~np.isnan(x), np.zeros(len(x), np.int64)
        for v, have in enumerate(self.have):
            out[(has == have).all(axis=1)] = v + 1
        return out

    def cells(self, view: int) -> Cells:
        if view not in self.cut:
            number = self.every.number
            keep = number >= self.meta["whole"]
            if view:
                _, (lo, hi), without = self.meta["views"][view - 1]
                for a, b in without:
                    keep &= (number < a) | (number >= b)
                keep |= (number >= lo) & (number < hi)
            self.cut[view] = Cells(*[getattr(self.every, f.name)[keep] for f in fields(Cells)])
        return self.cut[view]


def _limits(need: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The farthest that a row can be of use to a query's target; negative where it asks for none."""
    return np.where(need, reach * (1 + 1e-9) + 1e-6, -1.0)


def _best(rows: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each row by (rounded distance, id)."""
    order = np.lexsort((ids, np.round(dist, 9), rows))
    rank = np.arange(len(order)) - np.searchsorted(rows[order], rows[order], side="left")
    return order[rank < k]


def _crowded(rows: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Places left when rows of more than k are cut to the k first."""
    many = np.bincount(rows)[rows] > k
    if not many.any():
        return np.arange(len(rows))
    at = np.flatnonzero(many)
    return np.concatenate((np.flatnonzero(~many), at[_best(rows[at], ids[at], dist[at], k)]))


def near_pairs(q: np.ndarray, need: np.ndarray, reach: np.ndarray, r: np.ndarray, rank: np.ndarray,
               targets: list[int], k: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each target (query rows, reference rows, distances) of the k nearest in a pair of
    blocks, none farther than ``reach``. ``rank`` orders the references by id; a target of
    -1 stands for any reference. A chunk of queries at a time meets the references."""
    step = max(1, min(BOUND_CELLS, max(8, q.shape[1]) << 14) // max(1, len(r)))
    out = []
    for lo in range(0, len(q), step):
        some = slice(lo, lo + step)
        out += [(t, i + lo, j, d) for t, i, j, d in _near_pairs(q[some], need[some], reach[some], r, rank, targets, k)]
    return out


def _in_band(q, limit, r, scale):
    """Pairs whose widest coordinate alone does not put them farther apart than ``limit``; None if these are many."""
    j = int(np.argmax(r.max(axis=0) - r.min(axis=0)))
    order = np.argsort(r[:, j])
    side, width = r[order, j], limit / scale + 4 * np.spacing(np.abs(q[:, j]) + np.abs(r[:, j]).max())
    lo, hi = np.searchsorted(side, q[:, j] - width), np.searchsorted(side, q[:, j] + width, side="right")
    n = np.maximum(hi - lo, 0)
    total = int(n.sum())
    if total * BAND > len(q) * len(r):
        return None
    i = np.repeat(np.arange(len(q)), n)
    return i, order[np.arange(total) - np.repeat(np.cumsum(n) - n, n) + lo[i]]


def _few_pairs(q, need, reach, r, rank, wanted, k, scale, i, j):
    """``_near_pairs`` of one pattern a side, where few pairs are left."""
    d = q[i] - r[j]
    dist = np.sqrt(scale * np.sum(d * d, axis=1))
    out, limits = [], _limits(need, reach)
    for t in wanted:
        fit = np.flatnonzero(dist <= limits[i, t])
        if not len(fit):
            continue
        at, to, far = i[fit], j[fit], dist[fit]
        best = _crowded(at, rank[to], far, k)
        out.append((int(t), at[best], to[best], far[best]))
    return out


def _near_pairs(q, need, reach, r, rank, targets, k):
    p = q.shape[1]
    mq, mr = ~np.isnan(q), ~np.isnan(r)
    alike = (mq == mq[0]).all() and (mr == mr[0]).all()        # one pattern a side: no masks
    if alike:
        on = mq[0] & mr[0]
        common = np.count_nonzero(on)
        if not common:
            return []
        q, r = (q, r) if common == p else (np.where(on, q, 0.0), np.where(on, r, 0.0))
        band = _in_band(q, _limits(need, reach).max(axis=1), r, math.sqrt(p / common)) if len(r) > 4 * k else None
        if band is not None:
            wanted = [t for t in np.flatnonzero(need.any(axis=0)) if targets[t] < 0 or mr[0, targets[t]]]
            return _few_pairs(q, need, reach, r, rank, wanted, k, p / common, *band)
        mid = r.mean(axis=0)
        a, b = (q - mid) * math.sqrt(p / common), (r - mid) * math.sqrt(p / common)
        rough = a @ (-2 * b.T)
        rough += (a * a).sum(1)[:, None]
        rough += (b * b).sum(1)[None, :]
    else:
        mid = np.nan_to_num(r).mean(axis=0)
        a, b = np.nan_to_num(q - mid), np.nan_to_num(r - mid)
        ma, mb = mq.astype(float), mr.astype(float)
        sq = (a * a) @ mb.T + ma @ (b * b).T - 2 * (a @ b.T)
        common = ma @ mb.T
        with np.errstate(divide="ignore", invalid="ignore"):
            rough = np.where(common > 0, p / common * np.maximum(sq, 0.0), np.inf)
    # What cancellation may have taken from a squared distance.
    slack = 1e-11 * p * ((a * a).sum(1).max() + (b * b).sum(1).max()) + 1e-12
    out = []
    for t in np.flatnonzero(need.any(axis=0)):
        column = targets[t]
        rows = np.flatnonzero(need[:, t])
        cols = np.arange(len(r)) if column < 0 else np.flatnonzero(mr[:, column])
        if not len(cols):
            continue
        part = rough if len(rows) == len(q) and len(cols) == len(r) else rough[np.ix_(rows, cols)]
        fits = part <= ((reach[rows, t] * (1 + 1e-9) + 1e-6) ** 2 + slack)[:, None]
        at = np.flatnonzero(fits if alike else fits & np.isfinite(part))
        i, j = np.divmod(at, len(cols))
        counts = np.bincount(i, minlength=len(rows))
        many = np.flatnonzero(counts > 2 * k) if len(cols) > k else ()
        if len(many):
            kth = np.sqrt(np.maximum(np.partition(part[many], k - 1, axis=1)[:, k - 1], 0.0) + slack) + 1e-8
            most = np.full(len(rows), np.inf)
            most[many] = kth ** 2 + slack                                              # ties after rounding stay
            fit = part.ravel()[at] <= most[i]
            i, j = i[fit], j[fit]
            counts = np.bincount(i, minlength=len(rows))
        if not len(i):
            continue
        i, j = rows[i], cols[j]
        exact = []
        for lo in range(0, len(i), 1 << 16):
            d = q[i[lo:lo + (1 << 16)]] - r[j[lo:lo + (1 << 16)]]
            n = common if alike else (~np.isnan(d)).sum(axis=1)
            exact.append(np.sqrt(p / n * (np.sum if alike else np.nansum)(d * d, axis=1)))
        dist = np.concatenate(exact)
        best = _crowded(i, rank[j], dist, k)
        out.append((int(t), i[best], j[best], dist[best]))
    return out


# ---------------------------------------------------------------- references

def _masks(rows: DataFrame, views: np.ndarray) -> tuple[list, dict[int, int]]:
    """The most frequent (view, presence pattern) with their rows, and the rows of each view."""
    counts = rows.groupBy("view", _mask_text(_seen(views)).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), "view", "mask").limit(MAX_PATTERNS).collect()
    totals = {}
    for x in rows.groupBy("view").agg(F.count(F.lit(1)).alias("n")).collect() if len(top) == MAX_PATTERNS else top:
        totals[x["view"]] = totals.get(x["view"], 0) + x["n"]
    return top, totals


def _patterns(top: list, totals: dict[int, int], rows_per_cell: int) -> tuple[dict[tuple, int], dict[int, int]]:
    """Group of each frequent (view, pattern) and rows of each group; None stands for all other
    patterns of a view. Groups of a view follow each other, those of the whole (view 0) come last."""
    groups, sizes = {}, {}
    for view in sorted(totals, key=lambda v: (v == 0, v)):
        here = [x for x in top if x["view"] == view]
        own = [x for x in here if "1" in x["mask"] and (x["n"] * 4 >= rows_per_cell or len(here) < 32)]
        rest = groups[view, None] = len(groups)
        for x in own:
            g = groups[view, x["mask"]] = len(groups)
            sizes[g] = x["n"]
        sizes[rest] = totals[view] - sum(x["n"] for x in own)
    return groups, sizes


def _common(a: str, b: str) -> str:
    return "".join("1" if x == y == "1" else "0" for x, y in zip(a, b))


def _pairs(masks: list[str], columns: list[int]) -> list[tuple[str, str]]:
    """Patterns of queries, each with those of references that it sees a part of and that have something it asks for."""
    asking = [m for m in masks if "0" in m and "1" in m][:MAX_VIEWS]
    return [(m, r) for m in asking for r in masks[:MAX_VIEWS] if "1" in _common(m, r) and _common(m, r) != r
            and any(t < 0 or m[t] == "0" and r[t] == "1" for t in columns)]


def _looks(pairs: list[tuple[str, str]]) -> list[str]:
    """Sets of coordinates whose different values are counted, the smallest of all if there are many."""
    return sorted({_common(m, r) for m, r in pairs}, key=lambda c: (c.count("1"), c))[:MAX_LOOKS]


def _worth(pairs: list[tuple[str, str]], rows: dict[str, int], different: dict[tuple[str, str], int], columns: list[int],
           k: int) -> dict[str, list[str]]:
    """Patterns with a view and the groups it stands for, those that have few different rows for it."""
    out: dict[str, list[str]] = {}
    for m, r in pairs:
        n = different.get((r, _common(m, r)))
        asks = sum(t < 0 or m[t] == "0" and r[t] == "1" for t in columns)
        if n is not None and VIEW_SHARE * k * asks * n <= rows[r]:
            out.setdefault(m, []).append(r)
    return out


def _thin(views: np.ndarray, stands: list[list[str]], columns: list[int], k: int, p: int):
    """Rows -> for each view those that are among the k smallest ids of what looks equal and has some
    asked target, as far as the rows held together tell."""
    most = max(1, THIN_BYTES // (8 * p))

    def thinned(ids: pa.Array, x: np.ndarray):
        rank, bits, has = _ranks(ids), x.view(np.int64), ~np.isnan(x)
        kinds, which = np.unique(has, axis=0, return_inverse=True)
        kinds, which = ["".join("1" if h else "0" for h in kind) for kind in kinds], which.ravel()
        for v in range(1, len(views)):
            rows = np.flatnonzero(np.array([kind in stands[v - 1] for kind in kinds])[which])
            if not len(rows):
                continue
            on = np.flatnonzero(views[v])
            order = rows[np.lexsort((rank[rows], *(bits[rows, j] for j in on)))]
            sort = bits[np.ix_(order, on)]
            begins = np.append(True, (sort[1:] != sort[:-1]).any(axis=1))
            keep, used = np.zeros(len(order), bool), views[v].copy()
            for t in columns:
                if t >= 0 and views[v, t]:
                    continue
                have = np.ones(len(order), bool) if t < 0 else has[order, t]
                n = np.cumsum(have)
                before = np.maximum.accumulate(np.where(begins, n - have, 0))
                keep |= have & (n - before <= k)
                if t >= 0:
                    used[t] = True
            rows = np.sort(order[keep])
            if len(rows):
                kept = np.where(used, x[rows], np.nan).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * p), pa.array(kept, mask=np.isnan(kept)))
                yield pa.record_batch([pa.array(np.full(len(rows), v, np.int32)), ids.take(pa.array(rows)), lists], names=["view", "id", "x"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append((batch.column("id"), _matrix(batch.column("x"), p)))
            n += batch.num_rows
            if n >= most:
                yield from thinned(pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                held, n = [], 0
        if n:
            yield from thinned(pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]))
    return run


def _viewed(r: DataFrame, views: np.ndarray, stands: list[list[str]], columns: list[int], k: int, p: int) -> DataFrame:
    """``view, id, x``: the rows of all views but the whole; ``x`` has the view's coordinates and the targets."""
    kind = r.schema["id"].dataType.simpleString()
    rows = r.select("id", "x").mapInArrow(_thin(views, stands, columns, k, p), f"view int, id {kind}, x array<double>").withColumn("_seen", _seen(views))
    so_far = Window.partitionBy("view", "_seen").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep, counts = F.lit(False), {}
    for t in dict.fromkeys(columns):
        has = F.lit(True) if t < 0 else F.col("x")[t].isNotNull() & ~_has(views, t)
        counts[f"_n{t}"] = F.count(F.when(has, F.lit(1))).over(so_far)
        keep = keep | has & (F.col(f"`_n{t}`") <= k)
    return rows.withColumns(counts).where(keep).select("view", "id", "x")


def _pivots(r: DataFrame, groups: dict[tuple, int], sizes: dict[int, int], views: np.ndarray, rows_per_cell: int,
            fill: np.ndarray) -> dict[int, np.ndarray]:
    """Sampled rows of each group, absent coordinates filled."""
    p = views.shape[1]
    most = max(len(sizes), min(MAX_CELLS, CELL_BYTES // (26 * p + 64)))
    want = {g: max(1, -(-n // rows_per_cell)) for g, n in sizes.items() if n}
    over = max(1.0, sum(want.values()) / most)
    want = {g: max(1, int(w / over)) for g, w in want.items()}
    total, drawn = sum(sizes.values()), sum(want.values())
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30))
    rate = min(1.0, 2.0 * drawn / max(1, total) + 64.0 / max(1, total))
    got = r.where(draw < int(rate * (1 << 30))).withColumn("h", draw).limit(4 * most + 1024).toArrow()
    out: dict[int, list[np.ndarray]] = {g: [] for g in want}
    if got.num_rows:
        view = got["view"].to_numpy()
        x = np.where(views[view], _matrix(got["x"].combine_chunks(), p), np.nan)
        text = ["".join("0" if n else "1" for n in row) for row in np.isnan(x)]
        for i in np.argsort(got["h"].to_numpy(), kind="stable"):
            g = groups.get((view[i], text[i]), groups[view[i], None])
            if g in out and len(out[g]) < want[g]:
                out[g].append(np.where(np.isnan(x[i]), fill, x[i]))
    return {g: np.array(v or [fill]) for g, v in out.items()}


_CELL = "cell int, d double, id {id}, x array<double>"
_BLOCK = ("cell int, ids array<{id}>, x binary, center binary, radius double, lo binary, hi binary, every binary, some binary, "
          "counts binary")


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The row of ``c`` nearest to each row of ``x``."""
    out, step = np.zeros(len(x), np.int64), max(1, BOUND_CELLS // len(c))
    for lo in range(0, len(x), step):
        out[lo:lo + step] = ((c ** 2).sum(1)[None, :] - 2 * x[lo:lo + step] @ c.T).argmin(axis=1)
    return out


def _by_heads(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pivots sorted by the nearest of some of them, these heads, and where each head's begin."""
    heads = c[:max(1, math.isqrt(len(c)))]
    head = _nearest(c, heads)
    order = np.argsort(head, kind="stable")
    return c[order], heads, np.searchsorted(head[order], np.arange(len(heads) + 1))


def _spans(groups, pivots) -> dict[tuple, tuple[int, int]]:
    """First cell of each group, and the cell after its last."""
    out, first = {}, 0
    for key, g in sorted(groups.items(), key=lambda x: x[1]):
        out[key], first = (first, first + len(pivots.get(g, ()))), first + len(pivots.get(g, ()))
    return out


def _to_cells(groups, pivots, views, fill, p):
    sorted_by = {g: _by_heads(c) for g, c in pivots.items()}
    start = {groups[key]: lo for key, (lo, _) in _spans(groups, pivots).items()}
    home = {}                                                               # a group of each view that has pivots
    for (view, _), g in sorted(groups.items(), key=lambda x: x[1]):
        if g in pivots:
            home.setdefault(view, g)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            view = batch.column("view").to_numpy()
            x = np.where(views[view], _matrix(batch.column("x"), p), np.nan)
            absent = np.isnan(x)
            full = np.where(absent, fill, x)
            group = np.zeros(len(x), dtype=np.int64)
            kinds, which = np.unique(np.column_stack((view, absent)), axis=0, return_inverse=True)
            for i, (v, *kind) in enumerate(kinds):
                g = groups.get((v, "".join("0" if a else "1" for a in kind)), groups[v, None])
                group[which.ravel() == i] = g if g in pivots else home[v]
            cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
            for g in np.unique(group):
                c, heads, begin = sorted_by[g]
                rows = np.flatnonzero(group == g)
                head = _nearest(full[rows], heads)
                for h in np.unique(head):
                    at, own = rows[head == h], c[begin[h]:begin[h + 1]]
                    own, shift = (own, begin[h]) if len(own) else (c, 0)       # heads that are equal share the first's
                    best = _nearest(full[at], own)
                    cell[at] = start[g] + shift + best
                    dist[at] = np.sqrt(((full[at] - own[best]) ** 2).sum(1))
            yield pa.record_batch([pa.array(cell), pa.array(dist), batch.column("id"), batch.column("x")],
                                  names=["cell", "d", "id", "x"])
    return run, np.concatenate([sorted_by[g][0] for g in sorted(pivots)])


def _pack_cells(centers, of, columns, k, p, id_type):
    """Rows sorted by cell -> its blocks, and after them a row without ids that describes the cell by
    the coordinates ``of`` it."""
    rows_a_block = max(64, BLOCK_BYTES // (8 * p))

    def run(batches):
        schema = None
        cell, held_id, held_x, n, stats = None, [], [], 0, None

        def block():
            nonlocal held_id, held_x, n
            ids, x = pa.concat_arrays(held_id), np.concatenate(held_x)
            held_id, held_x, n = [], [], 0
            return ids, x

        def learn(x):
            nonlocal stats
            has, c = ~np.isnan(x), centers[cell]
            have = has & of[cell]
            every, some = have.all(axis=0), have.any(axis=0)
            radius = float(np.sqrt(((np.where(every, x, 0.0) - np.where(every, c, 0.0)) ** 2).sum(axis=1)).max())
            lo = np.where(have, x, np.inf).min(axis=0)
            hi = np.where(have, x, -np.inf).max(axis=0)
            count = np.array([len(x) if t < 0 else int(has[:, t].sum()) for t in columns])
            if stats is None:
                stats = [radius, lo, hi, every, some, count]
            else:
                stats = [max(stats[0], radius), np.minimum(stats[1], lo), np.maximum(stats[2], hi), stats[3] & every,
                         stats[4] | some, stats[5] + count]

        def out(rows):
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], pa.int32()), _lists(cols[1], id_type), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary()),
                      pa.array(cols[4], pa.float64()), *[pa.array(c, pa.binary()) for c in cols[5:]]]
            return pa.record_batch(arrays, names=names)
        names = [c.split()[0] for c in _BLOCK.split(", ")]

        def flush():
            ids, x = block()
            learn(x)
            return (cell, ids, _pack(x), None, None, None, None, None, None, None)

        def close():
            radius, lo, hi, every, some, count = stats
            return (cell, None, None, _pack(centers[cell]), radius * (1 + 1e-9) + 1e-12, _pack(lo), _pack(hi), every.tobytes(),
                    some.tobytes(), np.minimum(count, k).astype("<i8").tobytes())
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, x = batch.column("cell").to_numpy(), _matrix(batch.column("x"), p)
            edge = np.flatnonzero(np.diff(cells)) + 1
            for lo, hi in zip([0, *edge], [*edge, len(cells)]):
                if cells[lo] != cell:
                    if cell is not None:
                        rows = ([flush()] if n else []) + [close()]
                        yield out(rows)
                    cell, stats = int(cells[lo]), None
                while lo < hi:
                    take = min(hi - lo, rows_a_block - n)
                    held_id.append(batch.column("id").slice(lo, take))
                    held_x.append(x[lo:lo + take])
                    n, lo = n + take, lo + take
                    if n == rows_a_block:
                        yield out([flush()])
        if cell is not None:
            yield out(([flush()] if n else []) + [close()])
    return run


def _lists(parts, kind: pa.DataType) -> pa.Array:
    """A list array of arrays, null for None."""
    sizes = [0 if a is None else len(a) for a in parts]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = [a.cast(kind) for a in parts if a is not None and len(a)]
    flat = pa.concat_arrays(values) if values else pa.array([], kind)
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array([a is None for a in parts]))


def knn_index(refs: DataFrame, features: list[str], k: int, rid: str, targets: list[str] | None = None,
              rows_per_bucket: int = 256) -> tuple[dict, DataFrame | None]:
    """The reference side of ``exact_knn``: JSON-able facts and the stored table of blocks
    and cells; no table without references. ``rows_per_bucket`` is the rows a cell aims at."""
    from pyspark.sql.pandas.types import to_arrow_type
    bound_arrow(refs.sparkSession)
    p, tlist = len(features), targets or [ANY_TARGET]
    columns = [-1 if t == ANY_TARGET else features.index(t) for t in tlist]
    r = _present(refs, features, rid)
    id_type = r.schema["id"].dataType
    meta = {"features": features, "k": k, "targets": tlist, "id": id_type.simpleString()}
    # Equal rows: only the k smallest ids can be neighbours.
    first = Window.partitionBy("x").orderBy("id")
    r = materialise(r.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n"), "knn-rows")
    whole = np.ones((1, p), bool)
    r = r.select(F.lit(0).alias("view"), "id", "x")
    top, totals = _masks(r, whole)
    own = {m for _, m in _patterns(top, totals, rows_per_bucket)[0]}
    pairs = [(m, g) for m, g in _pairs([x["mask"] for x in top], columns) if g in own]
    looks, seen_in = _looks(pairs), {m for pair in pairs for m in pair[1:]}
    mask = _mask_text(F.col("x"))
    facts = r.groupBy(F.when(mask.isin(*seen_in), mask).alias("mask") if seen_in else F.lit(None).cast("string").alias("mask")).agg(
        *[f(F.col("x")[j]).alias(f"{n}{j}") for j in range(p) for n, f in (("s", F.sum), ("n", F.count))],
        *[F.approx_count_distinct(F.xxhash64(*[F.col("x")[j] for j in range(p) if c[j] == "1"])).alias(f"d{c}") for c in looks]).collect()
    counts = [sum(f[f"n{j}"] for f in facts) for j in range(p)]
    if not totals or not any(counts):
        discard(r)
        return meta, None
    fill = np.array([sum(f[f"s{j}"] or 0.0 for f in facts) / n if n else 0.0 for j, n in enumerate(counts)])
    stands = _worth(pairs, {x["mask"]: x["n"] for x in top}, {(f["mask"], c): f[f"d{c}"] for f in facts for c in looks}, columns, k)
    views, rows, thin = np.vstack([whole, *map(_bits, stands)]), r, None
    if stands:
        thin = materialise(_viewed(r, views, list(stands.values()), columns, k, p), "knn-views")
        more, sums = _masks(thin, views)
        top, totals, rows = top + more, dict.fromkeys(range(len(views)), 0) | totals | sums, r.unionByName(thin)
    groups, sizes = _patterns(top, totals, rows_per_bucket)
    pivots = _pivots(rows, groups, sizes, views, rows_per_bucket, fill)
    assign, centers = _to_cells(groups, pivots, views, fill, p)
    spans, of = _spans(groups, pivots), np.ones((len(centers), p), bool)
    for (view, _), (lo, hi) in spans.items():
        of[lo:hi] = views[view]
    # a view: its pattern, its cells, and the cells of the whole that it does without
    meta["views"] = [[m, [spans[v + 1, None][0], max(hi for (view, _), (_, hi) in spans.items() if view == v + 1)],
                      [list(spans[0, g]) for g in gone]] for v, (m, gone) in enumerate(stands.items())]
    meta["whole"] = spans[0, None][0]
    named = rows.mapInArrow(assign, _CELL.format(id=meta["id"]))
    packed = named.repartition("cell").sortWithinPartitions("cell", "d").mapInArrow(
        _pack_cells(centers, of, columns, k, p, to_arrow_type(id_type)), _BLOCK.format(id=meta["id"]))
    blocks = materialise(packed, "knn-blocks")
    for used in (r, thin):
        if used is not None:
            discard(used)
    return meta, blocks


def _cells(blocks: DataFrame, meta: dict) -> Views:
    """The cells of a table of blocks, at most ``CELL_BYTES`` of them."""
    p, n_targets = len(meta["features"]), len(meta["targets"])
    t = blocks.where(F.col("ids").isNull()).drop("ids", "x").toArrow().sort_by("cell")
    wide = lambda c, kind, w: np.frombuffer(b"".join(t[c].to_pylist()), dtype=kind).reshape(-1, w)
    return Views(Cells(wide("center", "<f8", p), t["radius"].to_numpy(), wide("lo", "<f8", p), wide("hi", "<f8", p), wide("every", bool, p),
                       wide("some", bool, p), wide("counts", "<i8", n_targets), t["cell"].to_numpy()), meta)


# ---------------------------------------------------------------- queries

_SENT = "pack long, cell int, least double, qids array<{id}>, q binary, need binary, reach binary, goes binary"
_FOUND = "qid {id}, target string, rid {rid}, dist double, value double"


def _placed(told, p):
    """Queries with their pattern and their place on a curve through the space of the cells."""
    def run(batches):
        c = told.value.cells(0).center
        low, high = np.quantile(c, 0.01, axis=0), np.quantile(c, 0.99, axis=0)
        axes = [j for j in np.argsort(low - high, kind="stable")[:6] if high[j] > low[j]]
        width = max((high[j] - low[j] for j in axes), default=1.0) / 1023
        for batch in batches:
            x = _matrix(batch.column("x"), p)
            kinds, which = np.unique(np.isnan(x), axis=0, return_inverse=True)
            kind = np.array([zlib.crc32(k.tobytes()) for k in kinds], dtype=np.int64)[which.ravel()]
            steps = [np.clip(np.nan_to_num((x[:, j] - low[j]) / width), 0, 1023).astype(np.int64) for j in axes]
            place = np.zeros(len(x), dtype=np.int64)
            for bit in range(9, -1, -1):
                for s in steps:
                    place = place << 1 | (s >> bit) & 1
            yield pa.record_batch([batch.column("id"), batch.column("x"), pa.array(kind), pa.array(place)],
                                  names=["id", "x", "kind", "place"])
    return run


def _pack_row(pack, cells, least, kind, queries=None):
    """A pack's queries as one row, or one row for each cell it visits."""
    n = len(cells) if queries is None else 1
    ids, *raw = (None, None, None, None, None) if queries is None else queries
    return pa.record_batch(
        [pa.array([pack] * n, pa.int64()), pa.array(cells, pa.int32()), pa.array(least, pa.float64()), _lists([ids] * n, kind),
         *[pa.array([v] * n, pa.binary()) for v in raw]], names=["pack", "cell", "least", "qids", "q", "need", "reach", "goes"])


def _sent(cells: Cells, k, pack, ids, x, need, reach):
    """A pack and the cells it must visit: those of pass 1 when no ``reach`` is given."""
    least, known, goes = np.full(len(cells.radius), np.inf), [], []
    for lo in range(0, len(x), RUN):
        run = slice(lo, lo + RUN)
        if reach is None:
            now, far, to = cells.first(x[run], need[run], k)
            known.append(far)
            goes.append(to)
        else:
            now = cells.second(x[run], need[run], reach[run])
        least = np.minimum(least, now)
    at = np.flatnonzero(np.isfinite(least))
    if reach is None and 2 * len(at) > len(least):       # pass 2 will hardly visit more: it does the work alone
        at = at[:0]
    reach = np.concatenate(known) if reach is None else reach
    yield _pack_row(pack, [None], [None], ids.type, (ids, _pack(x), need.tobytes(), _pack(reach), np.concatenate(goes).tobytes() if goes else None))
    if len(at):
        yield _pack_row(pack, cells.number[at], least[at], ids.type)


def _send(told, columns, k, p):
    """Queries in order -> packs and the cells that pass 1 gives them."""
    most = max(RUN, min(PACK_ROWS, PACK_BYTES // (8 * p)))

    def run(batches):
        views, part = told.value, TaskContext.get().partitionId()
        held, n, packs, view = [], 0, 0, 0

        def pack():
            x = np.concatenate([h[1] for h in held])
            need = np.stack([np.ones(len(x), bool) if t < 0 else np.isnan(x[:, t]) for t in columns], axis=1)
            return _sent(views.cells(view), k, (part << 32) + packs, pa.concat_arrays([h[0] for h in held]), x, need, None)
        for batch in batches:
            x, lo = _matrix(batch.column("x"), p), 0
            of = views.of(x)
            ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(x))
            while lo < len(x):
                if n == most or n and of[lo] != view:              # queries of a pack share a view
                    yield from pack()
                    held, n, packs = [], 0, packs + 1
                view = of[lo]
                take = min(ends[np.searchsorted(ends, lo, side="right")] - lo, most - n)
                held.append((batch.column("id").slice(lo, take), x[lo:lo + take]))
                n, lo = n + take, lo + take
        if n:
            yield from pack()
    return run


def _ranks(ids: pa.Array) -> np.ndarray:
    """Places of ids in their order, nulls first, equal ones alike."""
    return pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


class _Nearest:
    """The k nearest so far of each (query, target) of a pack."""

    def __init__(self, cells: Cells, ids, x, need, reach, goes, columns, k):
        self.cells, self.ids, self.x, self.need, self.reach, self.columns, self.k = cells, ids, x, need, reach.copy(), columns, k
        self.held = [[] for _ in columns]
        self.n, self.most = 0, k * np.count_nonzero(need)
        self.kinds = [(rows, has, np.ascontiguousarray(x[np.ix_(rows, has)].T)) for rows, has in cells.runs(x)]
        self.mixed = len(self.kinds) == 1 and np.isnan(x).sum() != len(x) * (x.shape[1] - len(self.kinds[0][1]))
        self.own = None
        if goes is not None:                                # pass 1: the queries of each cell
            order = np.argsort(goes, kind="stable")
            self.own = goes[order], order // (len(goes) // len(x))
        self.limit()

    def limit(self):
        self.limits = _limits(self.need, self.reach)
        self.widest = self.limits.max(axis=1)
        self.lost = np.flatnonzero(np.isinf(self.widest))

    def near(self, at: int) -> np.ndarray:
        """Queries to which a cell may be of use."""
        cells, has = self.cells, self.cells.count[at] > 0
        limit = self.widest if has.all() else np.where(has, self.limits, -1.0).max(axis=1)
        if self.mixed:
            least = cells.bounds(self.x, np.array([at]))[0][:, 0]
            return np.flatnonzero((least <= limit) & np.isfinite(least))
        out = []
        for rows, on, x in self.kinds:
            shared = np.count_nonzero(cells.some[at, on])
            if not shared:
                continue
            every = cells.every[at, on]
            x, on = (x, on) if every.all() else (x[every], on[every])
            gap = np.maximum(np.maximum(cells.lo[at, on, None] - x, x - cells.hi[at, on, None]), 0.0)
            scale = self.x.shape[1] / shared
            some = np.flatnonzero(scale * (gap * gap).sum(axis=0) <= np.where(limit[rows] < 0, -1.0, limit[rows] ** 2))
            apart = x[:, some] - cells.center[at, on, None]
            some = some[np.sqrt(scale) * (np.sqrt((apart * apart).sum(axis=0)) - cells.radius[at]) <= limit[rows[some]]]
            out.append(rows[some])
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)

    def visit(self, cell: int, ids: pa.Array, r: np.ndarray):
        if self.own is None:
            rows = self.near(int(np.searchsorted(self.cells.number, cell)))
        else:                                               # its own queries, and those without any radius
            lo, hi = np.searchsorted(self.own[0], [cell, cell + 1])
            rows = np.union1d(self.own[1][lo:hi], self.lost)
        if not len(rows):
            return
        for t, i, j, dist in near_pairs(self.x[rows], self.need[rows], self.reach[rows], r, _ranks(ids), self.columns, self.k):
            value = np.full(len(j), np.nan) if self.columns[t] < 0 else r[j, self.columns[t]]
            self.held[t].append((rows[i], dist, value, ids.take(pa.array(j))))
            self.n += len(j)
        if self.n > self.most:
            self.settle()

    def settle(self):
        """Keep the k nearest only; their last is the new radius."""
        self.n = 0
        for t, parts in enumerate(self.held):
            if not parts:
                continue
            rows, dist, value = (np.concatenate([p[c] for p in parts]) for c in range(3))
            ids = pa.concat_arrays([p[3] for p in parts])
            at = _best(rows, _ranks(ids), dist, self.k)
            rows, dist = rows[at], dist[at]
            self.held[t] = [(rows, dist, value[at], ids.take(pa.array(at)))]
            self.n += len(at)
            last = np.flatnonzero(np.append(np.diff(rows) != 0, True))
            full = last[np.diff(np.append(-1, last)) == self.k]
            np.minimum.at(self.reach[:, t], rows[full], np.round(dist[full], 9) + 1e-9)
        self.most = max(self.most, 2 * self.n)
        self.limit()

    def found(self, names):
        self.settle()
        for t, parts in enumerate(self.held):
            for rows, dist, value, ids in parts:
                yield pa.record_batch([self.ids.take(pa.array(rows)), pa.array([names[t]] * len(rows), pa.string()), ids, pa.array(dist),
                                       pa.array(value, pa.float64(), mask=np.isnan(value))],
                                      names=["qid", "target", "rid", "dist", "value"])


def _search(told, columns, names, k, p, last):
    """Packs, each followed by the blocks it visits, nearest first -> the k nearest of each (query,
    target), or after pass 1 the packs again with their radii and the cells of pass 2."""
    def run(batches):
        views, pack, near = told.value, None, None

        def done():
            if last:
                yield from near.found(names)
            else:
                near.settle()
                yield from _sent(near.cells, k, pack, near.ids, near.x, near.need, near.reach)
        for batch in batches:
            packs, at = batch.column("pack").to_pylist(), batch.column("cell").to_pylist()
            for n in range(batch.num_rows):
                if at[n] is None:
                    if near is not None:
                        yield from done()
                    x, need, reach = (batch.column(c)[n].as_buffer() for c in ("q", "need", "reach"))
                    x, goes = _unpack(x, p), None if last else np.frombuffer(batch.column("goes")[n].as_buffer(), "<i4")
                    cells = views.cells(views.of(x[:1])[0])
                    pack, near = packs[n], _Nearest(cells, batch.column("qids")[n].values, x, np.frombuffer(need, bool).reshape(len(x), -1),
                                                    _unpack(reach, len(columns)), goes, columns, k)
                else:
                    near.visit(at[n], batch.column("ids")[n].values, _unpack(batch.column("x")[n].as_buffer(), p))
        if near is not None:
            yield from done()
    return run


def _k_best(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid", "target").orderBy(F.round("dist", 9), "rid")
    return pairs.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def exact_knn(queries: DataFrame, refs: DataFrame | None, features: list[str], k: int,
              qid: str, rid: str, targets: list[str] | None = None,
              rows_per_bucket: int = 256, index: tuple | None = None) -> DataFrame:
    """k nearest references per query (per (query, target) when ``targets``
    is given: only queries missing the target and references having it).

    ``index`` is a prebuilt ``knn_index`` of the same references (fitted
    state); without it the index is built here.

    Returns stored (qid, target, rid, dist, value) where ``value`` is the reference's
    target value (null for the any-target case), at most k rows per
    (qid, target), ordered by (round(dist, 9), rid).
    """
    spark = active_session()
    bound_arrow(spark)
    meta, blocks = index or knn_index(refs, features, k, rid, targets, rows_per_bucket)
    features, k, names, p = meta["features"], meta["k"], meta["targets"], len(meta["features"])
    columns = [-1 if t == ANY_TARGET else features.index(t) for t in names]
    q = _present(queries, features, qid)
    id_type = q.schema["id"].dataType.simpleString()
    found = _FOUND.format(id=id_type, rid=meta["id"])
    if blocks is None:
        return spark.createDataFrame([], found)
    if columns != [-1]:
        missing = None
        for c in columns:
            missing = F.col("x")[c].isNull() if missing is None else missing | F.col("x")[c].isNull()
        q = q.where(missing)
    q = materialise(q, "knn-queries")
    told = spark.sparkContext.broadcast(_cells(blocks, meta))
    rows = blocks.where(F.col("ids").isNotNull()).select("cell", "ids", "x")
    sent = _SENT.format(id=id_type)
    ordered = q.mapInArrow(_placed(told, p), f"id {id_type}, x array<double>, kind long, place long") \
        .repartitionByRange("kind", "place", "id").sortWithinPartitions("kind", "place", "id")
    first = materialise(ordered.select("id", "x").mapInArrow(_send(told, columns, k, p), sent), "knn-first")
    # Much work in few bytes: partitions follow the packs, not their size.
    tasks = max(1, 2 * first.where(F.col("cell").isNull()).count())

    def visit(packs: DataFrame, last: bool) -> DataFrame:
        visits = packs.where(F.col("cell").isNotNull()).select("pack", "cell", "least").join(rows, "cell")
        met = packs.where(F.col("cell").isNull()).unionByName(visits, allowMissingColumns=True).repartition(tasks, "pack") \
            .sortWithinPartitions("pack", F.col("cell").isNotNull(), "least", "cell")
        return met.mapInArrow(_search(told, columns, names, k, p, last), found if last else sent)
    second = materialise(visit(first, False), "knn-second")
    best = materialise(_k_best(visit(second, True), k), "knn-best")
    for used in (first, second, q):
        discard(used)
    return best
