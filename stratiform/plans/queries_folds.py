"""Statistics of all training folds from one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.folds import fold_modes, fold_sums
from ..sources.tables import OBS_CATEGORICAL, OBS_NUMERIC, VEC_FEATURES, obs, vec
from .common import oracle

FOLDS = 4
FEW = VEC_FEATURES[:6]


def _folded(df):
    return df.withColumn("fold", F.col("row_id") % FOLDS)


def q_fold_zscore(spark, sf):
    sums = fold_sums(_folded(obs(spark, sf)), "fold", None, OBS_NUMERIC)
    rows = [(int(f), c, round(m, 6), round(s, 6)) for f in sums.folds for c, (m, s) in sums.zscore(f).params["stats"].items()]
    return spark.createDataFrame(rows, "fold long, variable string, mean double, sd double")


def q_fold_correlations(spark, sf):
    sums = fold_sums(_folded(vec(spark, sf)), "fold", "label", FEW, pairs=True)
    rows = [(int(f), a, b, round(r, 6)) for f in sums.folds for (a, b), r in sums.correlations(f).items()]
    return spark.createDataFrame(rows, "fold long, var1 string, var2 string, r double")


def q_fold_modes(spark, sf):
    return fold_modes(_folded(obs(spark, sf)), "fold", OBS_CATEGORICAL)


def q_fold_naive_bayes(spark, sf):
    """Class means and variances of the naive Bayes model of each training fold."""
    sums = fold_sums(_folded(vec(spark, sf)), "fold", "label", FEW)
    rows = []
    for f in sums.folds:
        p = sums.naive_bayes(f, FEW, 0.0).params
        rows += [(int(f), int(c), x, round(p["log_prior"][k], 6), round(p["mean"][k][j], 6), round(p["var"][k][j], 6))
                 for k, c in enumerate(p["classes"]) for j, x in enumerate(FEW)]
    return spark.createDataFrame(rows, "fold long, label int, variable string, log_prior double, mean double, var double")


def _each(select: str) -> str:
    return " UNION ALL ".join(select.format(f=f) for f in range(FOLDS))


SQL_ZSCORE = oracle(_each(" UNION ALL ".join(
    f"SELECT CAST({{f}} AS BIGINT) AS fold, '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS sd "
    "FROM obs WHERE row_id % 4 <> {f}" for c in OBS_NUMERIC)))
SQL_CORRELATIONS = oracle(_each(" UNION ALL ".join(
    f"SELECT CAST({{f}} AS BIGINT) AS fold, '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM vec WHERE row_id % 4 <> {{f}}"
    for i, a in enumerate(FEW) for b in FEW[i + 1:])))
SQL_MODES = oracle(
    "SELECT fold, variable, level, n FROM (SELECT *, row_number() OVER (PARTITION BY fold, variable ORDER BY n DESC, level) AS r FROM ("
    + _each(" UNION ALL ".join(f"SELECT CAST({{f}} AS BIGINT) AS fold, '{c}' AS variable, {c} AS level, count(*) AS n FROM obs "
                               f"WHERE row_id % 4 <> {{f}} AND {c} IS NOT NULL GROUP BY {c}" for c in OBS_CATEGORICAL)) + ")) WHERE r = 1")
SQL_NAIVE_BAYES = oracle(_each(" UNION ALL ".join(
    f"SELECT CAST({{f}} AS BIGINT) AS fold, CAST(label AS INTEGER) AS label, '{c}' AS variable, "
    "round(ln(count(*) / (SELECT count(*) FROM vec WHERE row_id % 4 <> {f})), 6) AS log_prior, "
    f"round(avg({c}), 6) AS mean, round(var_pop({c}), 6) AS var FROM vec WHERE row_id % 4 <> {{f}} GROUP BY label" for c in FEW)))

QUERIES = {
    "fold_zscore": (q_fold_zscore, SQL_ZSCORE),
    "fold_correlations": (q_fold_correlations, SQL_CORRELATIONS),
    "fold_modes": (q_fold_modes, SQL_MODES),
    "fold_naive_bayes": (q_fold_naive_bayes, SQL_NAIVE_BAYES),
}
