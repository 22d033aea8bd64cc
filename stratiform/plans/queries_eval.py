"""Slices 3 and 5, plus the resample summary: splits, folds, under-sampling,
confusion tables, macro metrics, AUC, log loss, densities, CV summary and
best configuration per model."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import hash_u32_sql
from ..operators import metrics as M
from ..operators import resample as RS
from ..sources.tables import obs, pred
from .common import oracle

PROBS = ["p0", "p1", "p2"]


def _labelled(spark, sf):
    return obs(spark, sf).where(F.col("outcome").isNotNull()).select("row_id", "outcome")


_LAB = "lab AS (SELECT row_id, outcome FROM obs WHERE outcome IS NOT NULL)"


def _rank_cte(seed, part="outcome"):
    h = hash_u32_sql("row_id", seed)
    return (f"rk AS (SELECT row_id, outcome, row_number() OVER (PARTITION BY {part} ORDER BY {h}, row_id) "
            f"AS rnk, count(*) OVER (PARTITION BY {part}) AS n FROM lab)")


# ---- R1-R5, B2
def q_stratified_split(spark, sf):
    return RS.stratified_split(_labelled(spark, sf), "row_id", "outcome", 0.8, seed=9208)


SQL_STRAT_SPLIT = oracle("SELECT row_id, outcome, rnk <= floor(0.8e0 * n) AS is_train FROM rk",
                         _LAB + ", " + _rank_cte(9208))


def q_random_split(spark, sf):
    return RS.random_split(_labelled(spark, sf), "row_id", 0.8, seed=42)


SQL_RANDOM_SPLIT = oracle(f"SELECT row_id, outcome, {hash_u32_sql('row_id', 42)} % 1000000 < 800000.0e0 "
                          "AS is_train FROM lab", _LAB)


def q_stratified_folds(spark, sf):
    return RS.stratified_folds(_labelled(spark, sf), "row_id", "outcome", k=4, seed=4000)


SQL_STRAT_FOLDS = oracle("SELECT row_id, outcome, CAST((rnk - 1) % 4 AS INTEGER) AS fold FROM rk",
                         _LAB + ", " + _rank_cte(4000))


def q_repeated_folds(spark, sf):
    return RS.repeated_folds(_labelled(spark, sf), "row_id", "outcome", k=10, repeats=4, seed=9208)


SQL_REPEATED = oracle(
    "SELECT row_id, outcome, \"repeat\", CAST((row_number() OVER (PARTITION BY \"repeat\", outcome ORDER BY "
    "('0x' || substr(md5('9208+' || CAST(\"repeat\" AS VARCHAR) || ':' || CAST(row_id AS VARCHAR)), 1, 8))::BIGINT, "
    "row_id) - 1) % 10 AS INTEGER) AS fold FROM lab, (SELECT CAST(range AS INTEGER) AS \"repeat\" "
    "FROM range(1, 5)) r", _LAB)


def q_random_folds(spark, sf):
    return RS.random_folds(_labelled(spark, sf), "row_id", k=4, seed=42)


SQL_RANDOM_FOLDS = oracle(f"SELECT row_id, outcome, CAST({hash_u32_sql('row_id', 42)} % 4 AS INTEGER) "
                          "AS fold FROM lab", _LAB)


def q_random_undersample(spark, sf):
    return RS.random_undersample(_labelled(spark, sf), "row_id", "outcome", seed=42)


SQL_UNDERSAMPLE = oracle("SELECT row_id, outcome FROM rk WHERE rnk <= (SELECT min(c) FROM "
                         "(SELECT count(*) AS c FROM lab GROUP BY outcome))",
                         _LAB + ", " + _rank_cte(42))


# ---- A10, A11
def q_confusion(spark, sf):
    return M.confusion(pred(spark, sf))


_CM = ("cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred), "
       "cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction), "
       "cm AS (SELECT a.c AS label, b.c AS prediction, coalesce(cnt.n, 0) AS n FROM cls a CROSS JOIN cls b "
       "LEFT JOIN cnt ON cnt.label = a.c AND cnt.prediction = b.c)")
SQL_CONFUSION = oracle("SELECT * FROM cm", _CM)


def q_confusion_pct(spark, sf):
    return M.confusion_percentages(M.confusion(pred(spark, sf)))


SQL_CONFUSION_PCT = oracle(
    "SELECT label, prediction, n, round(n / (SELECT sum(n) FROM cm), 6) AS pct_total, "
    "round(n / sum(n) OVER (PARTITION BY label), 6) AS pct_row, "
    "round(n / sum(n) OVER (PARTITION BY prediction), 6) AS pct_col FROM cm", _CM)


# ---- V1-V5, V7, V8 (SQL form shared by the grouped summary)
def metrics_sql(src: str, groups: list[str]) -> str:
    """CTE chain ending in ``agg``: one row of macro metrics per group."""
    g = "".join(f"{c}, " for c in groups)
    kg = "".join(f"k.{c}, " for c in groups)
    on = " AND ".join(f"k.{c} = cnt.{c}" for c in groups)
    join = f"JOIN cnt ON {on}" if groups else "CROSS JOIN cnt"
    using = f"JOIN tot USING ({', '.join(groups)})" if groups else "CROSS JOIN tot"
    gb = f"GROUP BY {', '.join(groups)}" if groups else ""
    return (
        f"cls2 AS (SELECT DISTINCT {g}c FROM (SELECT {g}label AS c FROM {src} UNION ALL "
        f"SELECT {g}prediction AS c FROM {src})), "
        f"cnt AS (SELECT {g}label, prediction, count(*) AS n FROM {src} GROUP BY {g}label, prediction), "
        f"st AS (SELECT {kg}k.c, sum(CASE WHEN cnt.label = k.c AND cnt.prediction = k.c THEN n ELSE 0 END)::DOUBLE AS tp, "
        f"sum(CASE WHEN cnt.label = k.c THEN n ELSE 0 END)::DOUBLE AS t, "
        f"sum(CASE WHEN cnt.prediction = k.c THEN n ELSE 0 END)::DOUBLE AS p FROM cls2 k {join} "
        f"GROUP BY {kg}k.c), "
        f"tot AS (SELECT {g}sum(n)::DOUBLE AS s FROM cnt {gb}), "
        f"pc AS (SELECT *, CASE WHEN t > 0 THEN tp / t ELSE 0 END AS sens, "
        f"CASE WHEN s - t > 0 THEN (s - t - p + tp) / (s - t) ELSE 0 END AS spec, "
        f"CASE WHEN p > 0 THEN tp / p ELSE 0 END AS prec FROM st {using}), "
        f"pf AS (SELECT *, CASE WHEN prec + sens > 0 THEN 2 * prec * sens / (prec + sens) ELSE 0 END AS f1 FROM pc), "
        f"agg AS (SELECT {g}sum(tp) / max(s) AS accuracy, avg(sens) AS sensitivity, avg(spec) AS specificity, "
        f"avg(prec) AS precision, avg(f1) AS f1, avg((sens + spec) / 2) AS bal_accuracy, "
        f"avg(sens) AS bal_accuracy_recall, CASE WHEN (max(s) * max(s) - sum(p * p)) * (max(s) * max(s) - sum(t * t)) > 0 "
        f"THEN (sum(tp) * max(s) - sum(p * t)) / sqrt((max(s) * max(s) - sum(p * p)) * "
        f"(max(s) * max(s) - sum(t * t))) ELSE 0 END AS mcc FROM pf {gb})")


def q_macro_metrics(spark, sf):
    return M.macro_metrics(pred(spark, sf))


SQL_MACRO = oracle("SELECT " + ", ".join(f"round({m}, 6) AS {m}" for m in M.METRIC_NAMES) + " FROM agg",
                   metrics_sql("pred", []))


def q_mcc(spark, sf):
    return M.macro_metrics(pred(spark, sf)).select("mcc")


SQL_MCC = oracle("SELECT round(mcc, 6) AS mcc FROM agg", metrics_sql("pred", []))


# ---- V6, V9, A14
def q_hand_till_auc(spark, sf):
    auc = M.hand_till_auc(pred(spark, sf), PROBS)
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


SQL_AUC = oracle(
    "SELECT round(avg((x.a + y.a) / 2), 6) AS auc FROM a x JOIN a y ON x.pi = y.pj AND x.pj = y.pi "
    "WHERE x.pi < x.pj",
    "e AS (SELECT i AS pi, j AS pj, CASE i WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS score, "
    "(label = i)::BIGINT AS pos, (label = j)::BIGINT AS neg FROM pred, "
    "(VALUES (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)) t(i, j) WHERE label IN (i, j)), "
    "g AS (SELECT pi, pj, score, sum(pos) AS pos, sum(neg) AS neg FROM e GROUP BY pi, pj, score), "
    "c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY pi, pj ORDER BY score ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM g), "
    "a AS (SELECT pi, pj, sum(pos * (neg_before + 0.5 * neg)) / (sum(pos) * sum(neg)) AS a FROM c "
    "GROUP BY pi, pj)")


def q_log_loss(spark, sf):
    v = M.log_loss(pred(spark, sf), PROBS)
    return spark.createDataFrame([(round(v, 6),)], "log_loss double")


SQL_LOG_LOSS = oracle(
    "SELECT round(avg(-ln(least(greatest(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-15), "
    "1 - 1e-15))), 6) AS log_loss FROM pred")


def q_score_density(spark, sf):
    p = pred(spark, sf)
    parts = [M.score_density(p, c).withColumn("score_class", F.lit(i)) for i, c in enumerate(PROBS)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_smooth_density(spark, sf):
    return M.smooth_density(pred(spark, sf), PROBS)


SQL_SMOOTH = oracle(
    "SELECT w.score, w.label, w.g / 100.0 AS x, m.n, round(sum(b.w * exp(-0.5 * ((w.g - b.g) / 100.0 / m.h) * ((w.g - b.g) / 100.0 / m.h))) "
    "/ (m.n * m.h * sqrt(2 * pi())), 6) AS density FROM bins w JOIN bins b ON b.score = w.score AND b.label = w.label "
    "JOIN m ON m.score = w.score AND m.label = w.label GROUP BY w.score, w.label, w.g, m.n, m.h",
    "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS score, label, {c} AS v FROM pred" for c in PROBS) + "), "
    "m AS (SELECT score, label, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h FROM long GROUP BY score, label), "
    "bins AS (SELECT score, label, g, sum(greatest(0.0, 1.0 - abs(v * 100.0 - g))) AS w FROM long, "
    "(SELECT unnest(range(101)) AS g) GROUP BY score, label, g)")


SQL_DENSITY = oracle(" UNION ALL ".join(
    f"SELECT label, bin, n, round(n / (sum(n) OVER (PARTITION BY label) * (1.0 / 20)), 6) AS density, "
    f"{i} AS score_class FROM (SELECT label, CAST(least(floor({c} * 20) + 1, 20) AS INTEGER) AS bin, "
    f"count(*) AS n FROM pred GROUP BY label, bin)" for i, c in enumerate(PROBS)))


# ---- A12, A13, H6 on a metric table from pred
def metric_table(spark, sf):
    p = pred(spark, sf).select((F.col("row_id") % 3).alias("model"), (F.col("row_id") % 5).alias("config"),
                               (F.col("row_id") % 4).alias("fold"), "label", "prediction")
    return M.grouped_metrics(p, ["model", "config", "fold"])


def cv_summary(metrics_long):
    """A12 + A13: mean, n, standard error (sample deviation / sqrt n),
    population deviation and the 95 % band mean +- 1.96 deviation."""
    s = metrics_long.groupBy("model", "config", "metric").agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"),
        (F.stddev_samp("value") / F.sqrt(F.count(F.lit(1)))).alias("std_err"),
        F.stddev_pop("value").alias("std"))
    return s.withColumns({"ci_lo": F.col("mean") - 1.96 * F.col("std"),
                          "ci_hi": F.col("mean") + 1.96 * F.col("std")})


def best_per_model(summary, metric: str = "f1"):
    """H6: per model the configuration with the best mean ``metric`` (ties:
    smaller config), then every metric of the winners (semi join)."""
    w = Window.partitionBy("model").orderBy(F.col("mean").desc(), F.col("config").asc())
    winners = summary.where(F.col("metric") == metric) \
        .withColumn("r", F.row_number().over(w)).where("r = 1").select("model", "config")
    return summary.join(winners, ["model", "config"], "left_semi")


def _round_summary(df):
    return df.select("model", "config", "metric", *[F.round(c, 6).alias(c) for c in
                                                    ["mean", "std_err", "std", "ci_lo", "ci_hi"]], "n")


def q_cv_summary(spark, sf):
    return _round_summary(cv_summary(metric_table(spark, sf)))


def q_best_per_model(spark, sf):
    best = best_per_model(cv_summary(metric_table(spark, sf)))
    return best.select("model", "config", "metric", F.round("mean", 6).alias("mean"))


_METRIC_TABLE = ("src AS (SELECT row_id % 3 AS model, row_id % 5 AS config, row_id % 4 AS fold, label, "
                 "prediction FROM pred), " + metrics_sql("src", ["model", "config", "fold"])
                 + ", ml AS (UNPIVOT agg ON " + ", ".join(M.METRIC_NAMES)
                 + " INTO NAME metric VALUE value), "
                 "sm AS (SELECT model, config, metric, avg(value) AS mean, count(*) AS n, "
                 "stddev_samp(value) / sqrt(count(*)) AS std_err, stddev_pop(value) AS std "
                 "FROM ml GROUP BY model, config, metric)")
SQL_CV_SUMMARY = oracle(
    "SELECT model, config, metric, round(mean, 6) AS mean, round(std_err, 6) AS std_err, "
    "round(std, 6) AS std, round(mean - 1.96 * std, 6) AS ci_lo, round(mean + 1.96 * std, 6) AS ci_hi, n "
    "FROM sm", _METRIC_TABLE)
SQL_BEST = oracle(
    "SELECT sm.model, sm.config, sm.metric, round(sm.mean, 6) AS mean FROM sm SEMI JOIN "
    "(SELECT model, config FROM (SELECT model, config, row_number() OVER (PARTITION BY model "
    "ORDER BY mean DESC, config ASC) AS r FROM sm WHERE metric = 'f1') WHERE r = 1) w "
    "ON sm.model = w.model AND sm.config = w.config", _METRIC_TABLE)


QUERIES = {
    "stratified_split": (q_stratified_split, SQL_STRAT_SPLIT),
    "random_split": (q_random_split, SQL_RANDOM_SPLIT),
    "stratified_folds": (q_stratified_folds, SQL_STRAT_FOLDS),
    "repeated_folds": (q_repeated_folds, SQL_REPEATED),
    "random_folds": (q_random_folds, SQL_RANDOM_FOLDS),
    "random_undersample": (q_random_undersample, SQL_UNDERSAMPLE),
    "confusion": (q_confusion, SQL_CONFUSION),
    "confusion_pct": (q_confusion_pct, SQL_CONFUSION_PCT),
    "macro_metrics": (q_macro_metrics, SQL_MACRO),
    "mcc": (q_mcc, SQL_MCC),
    "hand_till_auc": (q_hand_till_auc, SQL_AUC),
    "log_loss": (q_log_loss, SQL_LOG_LOSS),
    "score_density": (q_score_density, SQL_DENSITY),
    "smooth_density": (q_smooth_density, SQL_SMOOTH),
    "cv_summary": (q_cv_summary, SQL_CV_SUMMARY),
    "best_per_model": (q_best_per_model, SQL_BEST),
}
