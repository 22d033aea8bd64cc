"""Slice 4: nearest-neighbour imputation and NearMiss under-sampling."""

from __future__ import annotations

from ..operators.balance import nearmiss
from ..operators.clusters import ClusterKNNImputer
from ..operators.impute import KNNImputer
from ..sources.tables import VEC_FEATURES, obs, vec
from .common import oracle, rounded

KNN_COLS = ["pulse", "rectal_temp", "respiratory_rate", "total_protein", "const_col"]
IMPUTED = ["pulse", "rectal_temp", "respiratory_rate"]


def q_impute_knn(spark, sf):
    o = obs(spark, sf).select("row_id", *KNN_COLS)
    out = KNNImputer(KNN_COLS, k=10, key="row_id").fit(o).transform(o)
    return out.select("row_id", *rounded(*IMPUTED))


def q_impute_knn_sparse_rows(spark, sf):
    """Rows with more than 30 % of the columns missing take the column
    means; the others are imputed from their nearest neighbours."""
    o = obs(spark, sf).select("row_id", *KNN_COLS)
    out = KNNImputer(KNN_COLS, k=10, key="row_id", row_max_missing=0.3).fit(o).transform(o)
    return out.select("row_id", *rounded(*IMPUTED))


def q_impute_knn_clusters(spark, sf):
    """The table is its own donor, split by two-means into clusters of at most
    1500 rows; rows with more than half of the columns missing take the means."""
    o = obs(spark, sf).select("row_id", *KNN_COLS)
    out = ClusterKNNImputer(KNN_COLS, k=10, key="row_id").fit(o).transform(o)
    return out.select("row_id", *rounded(*IMPUTED))


# the only column without nulls has four values, as in the studied schema
LOW_CARD = ["pulse", "rectal_temp", "respiratory_rate", "n_sites"]
_LOW_CARD = "SELECT row_id, pulse, rectal_temp, respiratory_rate, CAST(row_id * 31 % 4 AS DOUBLE) AS n_sites FROM "


def q_impute_knn_low_card(spark, sf):
    o = spark.sql(_LOW_CARD + "{obs}", obs=obs(spark, sf))
    out = KNNImputer(LOW_CARD, k=10, key="row_id").fit(o).transform(o)
    return out.select("row_id", *rounded(*IMPUTED))


def _knn_sql(max_missing=None, cols=KNN_COLS, source=None):
    sql = _knn_obs_sql(max_missing, cols)
    return sql if source is None else sql.replace("FROM obs", "FROM src").replace("JOIN obs d", "JOIN src d") \
        .replace("obs.", "src.").replace(", q AS (", f", src AS ({source} obs), q AS (", 1)


def _knn_obs_sql(max_missing, cols):
    p = len(cols)
    present = [f"(q.{c} IS NOT NULL AND d.{c} IS NOT NULL)" for c in cols]
    cnt = " + ".join(f"{x}::INT" for x in present)
    sq = " + ".join(f"CASE WHEN {x} THEN (q.{c} - d.{c}) * (q.{c} - d.{c}) ELSE 0 END"
                    for x, c in zip(present, cols))
    any_null = " OR ".join(f"{c} IS NULL" for c in IMPUTED)
    share = "(" + " + ".join(f"({c} IS NULL)::INT" for c in cols) + f") / {float(p)}"
    if max_missing is not None:
        any_null = f"({any_null}) AND {share} <= {max_missing}"
    targets = " UNION ALL ".join(
        f"SELECT qid, '{c}' AS target, rid, dist, d_{c} AS v FROM pairs "
        f"WHERE q_{c} IS NULL AND d_{c} IS NOT NULL" for c in IMPUTED)
    ctes = (f"q AS (SELECT * FROM obs WHERE {any_null}), "
            f"pairs AS (SELECT q.row_id AS qid, d.row_id AS rid, sqrt({p}.0 / ({cnt}) * ({sq})) AS dist, "
            + ", ".join(f"q.{c} AS q_{c}, d.{c} AS d_{c}" for c in IMPUTED)
            + f" FROM q CROSS JOIN obs d WHERE ({cnt}) > 0), "
            f"t AS ({targets}), "
            "top AS (SELECT qid, target, v FROM (SELECT *, row_number() OVER (PARTITION BY qid, target "
            "ORDER BY round(dist, 9), rid) AS rn FROM t) WHERE rn <= 10), "
            "imp AS (SELECT qid, target, avg(v) AS v FROM top GROUP BY qid, target)")
    sel = ", ".join(
        f"round(coalesce(obs.{c}, (SELECT v FROM imp WHERE imp.qid = obs.row_id AND target = '{c}'), "
        f"(SELECT avg({c}) FROM obs)), 6) AS {c}" for c in IMPUTED)
    if max_missing is not None:
        sel = ", ".join(
            f"round(coalesce(obs.{c}, CASE WHEN {share} <= {max_missing} THEN "
            f"(SELECT v FROM imp WHERE imp.qid = obs.row_id AND target = '{c}') END, "
            f"(SELECT avg({c}) FROM obs)), 6) AS {c}" for c in IMPUTED)
    return oracle(f"SELECT obs.row_id, {sel} FROM obs", ctes)


def q_nearmiss(spark, sf):
    v = vec(spark, sf)
    return nearmiss(v, VEC_FEATURES, "label", "row_id", k=3).select("row_id", "label")


def _nearmiss_sql():
    dist = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in VEC_FEATURES) + ")"
    ctes = ("cc AS (SELECT label, count(*) AS n FROM vec GROUP BY label), "
            "mn AS (SELECT min(n) AS n_min FROM cc), "
            "minc AS (SELECT min(label) AS c FROM cc WHERE n = (SELECT n_min FROM mn)), "
            "big AS (SELECT * FROM vec WHERE label IN (SELECT label FROM cc WHERE n > (SELECT n_min FROM mn))), "
            f"pr AS (SELECT a.row_id, a.label, b.row_id AS rid, {dist} AS dist FROM big a "
            "CROSS JOIN (SELECT * FROM vec WHERE label = (SELECT c FROM minc)) b), "
            "k3 AS (SELECT row_id, label, round(avg(dist), 9) AS m FROM (SELECT *, row_number() OVER "
            "(PARTITION BY row_id ORDER BY round(dist, 9), rid) AS rn FROM pr) WHERE rn <= 3 "
            "GROUP BY row_id, label), "
            "kept AS (SELECT row_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label "
            "ORDER BY m, row_id) AS r FROM k3) WHERE r <= (SELECT n_min FROM mn))")
    return oracle("SELECT row_id, label FROM vec WHERE label IN (SELECT label FROM cc WHERE n = "
                  "(SELECT n_min FROM mn)) UNION ALL SELECT row_id, label FROM kept", ctes)


# two coordinates; a ninth of the rows of the larger classes has neither, another part only one
_SPARSE = ("SELECT row_id, label, CASE WHEN label <> 1 AND (row_id % 9 = 0 OR row_id % 5 = 1) THEN NULL ELSE x0 END AS x0, "
           "CASE WHEN label <> 1 AND row_id % 9 = 0 THEN NULL ELSE x1 END AS x1 FROM ")


def q_nearmiss_nulls(spark, sf):
    """Rows without a coordinate in common with any minority row come last, so that
    every larger class still keeps as many rows as the smallest has."""
    v = spark.sql(_SPARSE + "{vec}", vec=vec(spark, sf))
    return nearmiss(v, ["x0", "x1"], "label", "row_id", k=3).select("row_id", "label")


def _nearmiss_nulls_sql():
    n = "((a.x0 IS NOT NULL AND b.x0 IS NOT NULL)::INT + (a.x1 IS NOT NULL AND b.x1 IS NOT NULL)::INT)"
    sq = "(coalesce((a.x0 - b.x0) * (a.x0 - b.x0), 0) + coalesce((a.x1 - b.x1) * (a.x1 - b.x1), 0))"
    ctes = ("sp AS (" + _SPARSE + "vec), cc AS (SELECT label, count(*) AS n FROM sp GROUP BY label), "
            "mn AS (SELECT min(n) AS n_min FROM cc), minc AS (SELECT min(label) AS c FROM cc WHERE n = (SELECT n_min FROM mn)), "
            "big AS (SELECT * FROM sp WHERE label IN (SELECT label FROM cc WHERE n > (SELECT n_min FROM mn))), "
            f"pr AS (SELECT a.row_id, b.row_id AS rid, sqrt(2.0 / {n} * {sq}) AS dist FROM big a "
            f"CROSS JOIN (SELECT * FROM sp WHERE label = (SELECT c FROM minc)) b WHERE {n} > 0), "
            "k3 AS (SELECT row_id, round(avg(dist), 9) AS m FROM (SELECT *, row_number() OVER "
            "(PARTITION BY row_id ORDER BY round(dist, 9), rid) AS rn FROM pr) WHERE rn <= 3 GROUP BY row_id), "
            "kept AS (SELECT row_id, label FROM (SELECT big.row_id, big.label, row_number() OVER (PARTITION BY big.label "
            "ORDER BY k3.m NULLS LAST, big.row_id) AS r FROM big LEFT JOIN k3 ON big.row_id = k3.row_id) WHERE r <= (SELECT n_min FROM mn))")
    return oracle("SELECT row_id, label FROM sp WHERE label IN (SELECT label FROM cc WHERE n = "
                  "(SELECT n_min FROM mn)) UNION ALL SELECT row_id, label FROM kept", ctes)


QUERIES = {
    "nearmiss_nulls": (q_nearmiss_nulls, _nearmiss_nulls_sql()),
    "impute_knn": (q_impute_knn, _knn_sql()),
    "impute_knn_low_card_axis": (q_impute_knn_low_card, _knn_sql(None, LOW_CARD, _LOW_CARD)),
    "impute_knn_sparse_rows": (q_impute_knn_sparse_rows, _knn_sql(0.3)),
    "impute_knn_clusters": (q_impute_knn_clusters, None),
    "nearmiss": (q_nearmiss, _nearmiss_sql()),
}
