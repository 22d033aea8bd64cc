"""Exact KNN against brute force on a small frame with nulls."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratiform.operators.impute import KNNImputer
from stratiform.operators.knn import exact_knn


def _frame(seed=3, n=300, p=4):
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, p)) * np.array([1.0, 5.0, 0.5, 2.0])[:p]
    mask = rng.uniform(size=(n, p)) < 0.15
    mask[:, 0] &= rng.uniform(size=n) < 0.3  # first column rarely missing
    x[mask] = np.nan
    df = pd.DataFrame(x, columns=[f"c{i}" for i in range(p)])
    df.insert(0, "row_id", np.arange(n))
    return df


def _brute(df, cols, k):
    p = len(cols)
    X = df[cols].to_numpy()
    out = {}
    for i in range(len(X)):
        miss = [j for j in range(p) if np.isnan(X[i, j])]
        if not miss:
            continue
        for j in miss:
            cands = []
            for d in range(len(X)):
                if np.isnan(X[d, j]):
                    continue
                common = ~np.isnan(X[i]) & ~np.isnan(X[d])
                if not common.any():
                    continue
                dist = np.sqrt(p / common.sum() * ((X[i, common] - X[d, common]) ** 2).sum())
                cands.append((round(dist, 9), d, X[d, j]))
            cands.sort()
            vals = [v for _, _, v in cands[:k]]
            out[(i, cols[j])] = np.mean(vals) if vals else np.nanmean(X[:, j])
    return out


@pytest.mark.parametrize("seed", [3, 7])
def test_knn_imputer_equals_brute_force(spark, seed):
    pdf = _frame(seed)
    cols = [c for c in pdf.columns if c != "row_id"]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "row_id long, " + ", ".join(f"{c} double" for c in cols))
    got = KNNImputer(cols, k=5, rows_per_bucket=16).fit(df).transform(df).toPandas()
    got = got.set_index("row_id")
    want = _brute(pdf, cols, 5)
    assert not got[cols].isna().any().any()
    for (i, c), v in want.items():
        assert got.loc[i, c] == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_exact_knn_complete_data_small_buckets(spark):
    rng = np.random.RandomState(1)
    q = pd.DataFrame(rng.normal(size=(60, 3)), columns=["a", "b", "c"])
    r = pd.DataFrame(rng.normal(size=(200, 3)) * 3, columns=["a", "b", "c"])
    q.insert(0, "id", np.arange(60))
    r.insert(0, "id", np.arange(200))
    got = exact_knn(spark.createDataFrame(q), spark.createDataFrame(r), ["a", "b", "c"], 3,
                    "id", "id", rows_per_bucket=8).toPandas()
    for i in range(60):
        d = np.sqrt(((r[["a", "b", "c"]].to_numpy() - q.loc[i, ["a", "b", "c"]].to_numpy().astype(float)) ** 2).sum(1))
        want = sorted(np.argsort(d, kind="stable")[:3].tolist())
        assert sorted(got[got.qid == i].rid.tolist()) == want


def test_few_blocks_travel_to_packs_of_near_queries(spark, monkeypatch):
    """A pack of neighbouring queries meets the cells around it, not a cell a query."""
    from stratiform.operators import knn
    rng, stored = np.random.RandomState(5), {}
    x = pd.DataFrame(rng.uniform(0, 100, size=(6000, 3)), columns=["a", "b", "c"])
    x.insert(0, "id", np.arange(6000))
    q = x.copy()
    q.loc[q.id % 5 == 0, "a"] = np.nan
    keep = knn.materialise

    def note(df, name):
        out = keep(df, name)
        if name == "knn-second":
            stored[name] = out.where("cell IS NOT NULL").count()
        return out
    monkeypatch.setattr(knn, "materialise", note)
    q = q.astype(object).where(q.notna(), None)
    frame = spark.createDataFrame(q, "id long, a double, b double, c double")
    got = exact_knn(frame, frame, ["a", "b", "c"], 5, "id", "id", ["a"], rows_per_bucket=16).toPandas()
    assert len(got) == 1200 * 5
    assert stored["knn-second"] < 2 * 1200            # cells sent, though every query needs several


def test_block_pairs_are_compared_in_bounded_chunks():
    import tracemalloc

    from stratiform.operators.knn import near_pairs
    rng = np.random.RandomState(2)
    q, r = rng.normal(size=(8192, 64)), rng.normal(size=(2048, 64))
    tracemalloc.start()
    (t, i, j, d), *more = near_pairs(q, np.ones((8192, 1), bool), np.full((8192, 1), np.inf), r, np.arange(2048), [-1], 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert t == 0 and peak < 200 << 20                # one matrix of all pairs has 128 MB
    want = np.sort(np.sqrt(((q[7] - r) ** 2).sum(axis=1)))[:3]
    every = [(i, d)] + [(a, b) for _, a, _, b in more]
    assert np.concatenate([b[a == 7] for a, b in every]) == pytest.approx(want)


def test_rows_find_pivots_over_heads():
    """Every pivot stays in the list of exactly one head, equal pivots included."""
    from stratiform.operators.knn import _by_heads
    c = np.concatenate([np.zeros((30, 2)), np.random.RandomState(1).normal(size=(70, 2))])
    pivots, heads, begin = _by_heads(c)
    assert len(heads) == 10 and begin[0] == 0 and begin[-1] == 100
    assert sorted(map(tuple, pivots)) == sorted(map(tuple, c))


def test_first_pass_compares_a_query_with_its_own_cells_only(monkeypatch):
    """every query of a pack used to meet every cell that the pack visits."""
    import pyarrow as pa

    from stratiform.operators import knn
    rng = np.random.RandomState(4)
    x = rng.uniform(0, 100, size=(2000, 3))
    x = x[np.lexsort((x[:, 1] // 20, x[:, 0] // 10))].reshape(40, 50, 3)         # 40 cells of 50 rows
    ones = np.ones((40, 3), bool)
    radius = np.sqrt(((x - x.mean(axis=1)[:, None]) ** 2).sum(axis=2)).max(axis=1)
    cells = knn.Cells(x.mean(axis=1), radius, x.min(axis=1), x.max(axis=1), ones, ones, np.full((40, 1), 5), np.arange(40))
    q = rng.uniform(0, 100, size=(300, 3))
    q[:, 2] = np.nan
    need, meets = np.ones((300, 1), bool), []
    near_pairs = knn.near_pairs
    monkeypatch.setattr(knn, "near_pairs", lambda q, *a: meets.append(len(q)) or near_pairs(q, *a))

    def search(goes, reach, visited):
        near = knn._Nearest(cells, pa.array(np.arange(300)), q, need, reach, goes, [2], 5)
        for c in visited:
            near.visit(int(c), pa.array(np.arange(50) + 50 * int(c)), x[c])
        return near
    least, reach, goes = cells.first(q, need, 5)
    first = search(goes.ravel(), reach, np.flatnonzero(np.isfinite(least)))
    first.settle()
    assert sum(meets) <= knn.NEAR * 300
    d = np.sqrt(1.5 * ((q[:, None, :2] - x.reshape(-1, 3)[None, :, :2]) ** 2).sum(axis=2))
    kth = np.sort(d, axis=1)[:, 4]
    assert (first.reach[:, 0] >= kth - 1e-8).all() and np.isfinite(first.reach).all()
    second = search(None, first.reach, np.flatnonzero(np.isfinite(cells.second(q, need, first.reach))))
    (batch,) = second.found(["c"])
    got = batch.to_pandas().sort_values(["qid", "dist"]).dist.to_numpy().reshape(300, 5)
    assert got == pytest.approx(np.sort(d, axis=1)[:, :5])


def test_packs_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """packs are much work in few bytes; adaptive execution put them into a handful of tasks."""
    from stratiform.operators import knn
    rng, tasks = np.random.RandomState(6), {}
    x = pd.DataFrame(rng.uniform(0, 100, size=(6000, 2)), columns=["a", "b"]).assign(id=np.arange(6000))
    x.loc[x.id % 2 == 0, "a"] = np.nan
    keep = knn.materialise

    def note(df, name):
        out = keep(df, name)
        if name == "knn-second":
            rows = out.where("cell IS NULL").select(F.input_file_name().alias("f"), "pack").collect()
            tasks["packs"], tasks["files"] = len(rows), len({r["f"] for r in rows})
        return out
    monkeypatch.setattr(knn, "materialise", note)
    monkeypatch.setattr(knn, "PACK_ROWS", 256)
    frame = spark.createDataFrame(x.astype(object).where(x.notna(), None), "a double, b double, id long")
    got = exact_knn(frame, frame, ["a", "b"], 5, "id", "id", ["a"], rows_per_bucket=16)
    assert got.count() == 3000 * 5
    assert tasks["packs"] >= 12 and tasks["files"] >= tasks["packs"] // 2


def _low_card(n=12000, seed=8):
    """One coordinate tells rows apart; the others have few values, and any may be absent."""
    rng = np.random.RandomState(seed)
    x = pd.DataFrame({"id": np.arange(n), "a": rng.uniform(0, 500, n), "b": rng.randint(0, 5, n) * 1.0, "c": rng.randint(0, 3, n) * 1.0})
    x.loc[rng.uniform(size=n) < 0.1, "a"] = np.nan
    x.loc[rng.uniform(size=n) < 0.02, "b"] = np.nan
    return x


def test_queries_without_the_coordinate_that_tells_rows_apart_meet_a_view(spark, monkeypatch):
    """they met every cell of the table, a slab that grows with it; queries with it met every
    row without it, as all of these are equally near."""
    from stratiform.operators import knn
    x, stored = _low_card(), {}
    keep = knn.materialise

    def note(df, name):
        out = stored[name] = keep(df, name)
        if name == "knn-second":
            stored["sent"] = out.where("cell IS NOT NULL").count()
        return out
    monkeypatch.setattr(knn, "materialise", note)
    q = x[x.a.isna() | x.b.isna()]
    to_spark = lambda x: spark.createDataFrame(x.astype(object).where(x.notna(), None), "id long, a double, b double, c double")
    got = exact_knn(to_spark(q), to_spark(x), ["a", "b", "c"], 3, "id", "id", ["a", "b"], rows_per_bucket=16).toPandas()
    assert stored["sent"] < 450                                   # 677 cells before
    got = {k: v.sort_values(["dist", "rid"]).rid.tolist() for k, v in got.groupby(["qid", "target"])}
    X = x[["a", "b", "c"]].to_numpy()
    for kind in (q.a.isna() & q.b.notna(), q.a.notna(), q.a.isna() & q.b.isna()):
        for i in q.id[kind][:30]:
            for j, t in enumerate("ab"):
                if not np.isnan(X[i, j]):
                    continue
                d = X - X[i]
                n = (~np.isnan(d)).sum(axis=1)
                dist = np.where((n > 0) & ~np.isnan(X[:, j]), np.sqrt(3 / np.maximum(n, 1) * np.nansum(d * d, axis=1)), np.inf)
                want = sorted(np.flatnonzero(np.isfinite(dist)), key=lambda r: (round(dist[r], 9), r))[:3]
                assert got[i, t] == want


def test_a_group_gives_way_to_a_view_where_few_of_its_rows_differ():
    """by pairs of patterns, since what a query sees of a row depends on both."""
    from stratiform.operators.knn import _looks, _pairs, _worth
    masks, columns = ["111", "011", "101"], [0, 1]
    pairs = _pairs(masks, columns)
    assert pairs == [("011", "111"), ("011", "101"), ("101", "111"), ("101", "011")]
    assert _looks(pairs) == ["001", "011", "101"]
    different = {(r, c): n for r in masks for c, n in (("001", 3), ("011", 15), ("101", 9000))}
    assert _worth(pairs, {"111": 10000, "011": 1000, "101": 60}, different, columns, 3) == {"011": ["111"], "101": ["011"]}


def test_pairs_near_in_one_coordinate_are_all_that_is_compared(monkeypatch):
    """a block met each of its queries as a whole, however small their radii."""
    from stratiform.operators import knn
    rng, listed = np.random.RandomState(9), []
    q, r = rng.uniform(0, 100, size=(400, 3)) * [1, 1, 0.01], rng.uniform(0, 100, size=(300, 3)) * [1, 1, 0.01]
    q[:, 1], reach = np.nan, rng.uniform(0, 3, size=(400, 2))
    need = np.column_stack((rng.uniform(size=400) < 0.5, np.ones(400, bool)))
    few = knn._few_pairs
    monkeypatch.setattr(knn, "_few_pairs", lambda *a: listed.append(len(a[-1])) or few(*a))
    got = knn.near_pairs(q, need, reach, r, np.arange(300), [-1, 1], 4)
    assert sum(listed) <= 400 * 300 / knn.BAND and listed
    dist = np.sqrt(1.5 * np.nansum((q[:, None] - r[None]) ** 2, axis=2))
    found = {t: sorted((a, b) for u, i, j, _ in got if u == t for a, b in zip(i, j)) for t in (0, 1)}
    for t in (0, 1):
        assert found[t] == sorted((i, j) for i in np.flatnonzero(need[:, t]) for j in np.argsort(dist[i], kind="stable")[:4] if dist[i, j] <= reach[i, t])
