"""Classification metrics from a prediction table.

All counting happens in Spark aggregates; what reaches the driver is the
K x K confusion table (K = number of classes) or one number.
"""

from __future__ import annotations

import math

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ranks import prefix_sums
from ..session import active_session

#: Classes of a confusion table, whose cells (the square) are built on the driver.
MAX_CLASSES = 1_000


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A10: (label, prediction, n) over the full class grid, zeros included.
    Classes are the union of true and predicted classes; rows with a null label
    or prediction are in no cell. The number of classes is checked before any
    cell is read."""
    spark = active_session()
    k = df.select(F.explode(F.array(F.col(label), F.col(prediction))).alias("c")).distinct().count()
    if k > MAX_CLASSES + 1:
        raise ValueError(f"{k} classes exceed the confusion-table bound")
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n")).persist()
    cells = counts.collect()  # at most K x K rows
    classes = sorted({r["label"] for r in cells} | {r["prediction"] for r in cells}
                     - {None})
    seen = {(r["label"], r["prediction"]): r["n"] for r in cells}
    dtype = df.schema[label].dataType.simpleString()
    rows = [(a, b, int(seen.get((a, b), 0))) for a in classes for b in classes]
    counts.unpersist()
    return spark.createDataFrame(rows, f"label {dtype}, prediction {dtype}, n long")


def confusion_percentages(conf: DataFrame) -> DataFrame:
    """Share of each cell in the total, its true class (row) and its
    predicted class (column). Windows run over the K x K table only."""
    total = conf.agg(F.sum("n")).first()[0] or 0
    by_row = Window.partitionBy("label")
    by_col = Window.partitionBy("prediction")
    return conf.select(
        "label", "prediction", "n",
        F.round(F.col("n") / F.lit(float(max(total, 1))), 6).alias("pct_total"),
        F.round(F.try_divide(F.col("n").cast("double"), F.sum("n").over(by_row)), 6)
        .alias("pct_row"),
        F.round(F.try_divide(F.col("n").cast("double"), F.sum("n").over(by_col)), 6)
        .alias("pct_col"))


def class_stats(conf_rows) -> dict:
    classes = sorted({r[0] for r in conf_rows} | {r[1] for r in conf_rows})
    s = sum(r[2] for r in conf_rows)
    stats = {}
    for k in classes:
        tp = sum(n for a, b, n in conf_rows if a == k and b == k)
        t = sum(n for a, b, n in conf_rows if a == k)
        p = sum(n for a, b, n in conf_rows if b == k)
        stats[k] = {"tp": tp, "fn": t - tp, "fp": p - tp, "tn": s - t - p + tp, "t": t, "p": p}
    return {"classes": classes, "s": s, "stats": stats}


def _div(a, b):
    return a / b if b else 0.0


def metrics_from_confusion(conf_rows) -> dict:
    """V1-V5, V7, V8 from (label, prediction, n) triples; macro averages over
    the classes present as truth or prediction; empty denominators give 0."""
    cs = class_stats(conf_rows)
    st, classes, s = cs["stats"], cs["classes"], cs["s"]
    if not classes:
        return {}
    k = float(len(classes))
    sens = [_div(st[c]["tp"], st[c]["tp"] + st[c]["fn"]) for c in classes]
    spec = [_div(st[c]["tn"], st[c]["tn"] + st[c]["fp"]) for c in classes]
    prec = [_div(st[c]["tp"], st[c]["tp"] + st[c]["fp"]) for c in classes]
    f1 = [_div(2 * p * r, p + r) for p, r in zip(prec, sens)]
    correct = sum(st[c]["tp"] for c in classes)
    cov = correct * s - sum(st[c]["p"] * st[c]["t"] for c in classes)
    den = math.sqrt((s * s - sum(st[c]["p"] ** 2 for c in classes))
                    * (s * s - sum(st[c]["t"] ** 2 for c in classes)))
    return {
        "accuracy": _div(correct, s),
        "sensitivity": sum(sens) / k,
        "specificity": sum(spec) / k,
        "precision": sum(prec) / k,
        "f1": sum(f1) / k,
        "bal_accuracy": sum((a + b) / 2.0 for a, b in zip(sens, spec)) / k,
        "bal_accuracy_recall": sum(sens) / k,
        "mcc": _div(cov, den),
    }


METRIC_NAMES = ["accuracy", "sensitivity", "specificity", "precision", "f1",
                "bal_accuracy", "bal_accuracy_recall", "mcc"]


def macro_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    spark = active_session()
    rows = [(r["label"], r["prediction"], r["n"]) for r in confusion(df, label, prediction).collect()]
    m = metrics_from_confusion(rows)
    return spark.createDataFrame([tuple(round(m[k], 6) for k in METRIC_NAMES)],
                                 ", ".join(f"{k} double" for k in METRIC_NAMES))


def grouped_metrics(df: DataFrame, group_cols: list[str], label: str = "label",
                    prediction: str = "prediction", empty: float | None = 0.0) -> DataFrame:
    """Metrics per group (e.g. model, config, fold) in long form
    (group..., metric, value), by aggregates of (group, label, prediction) counts.

    Rows with a null label or prediction count nowhere. ``empty`` is the rate of
    a class with an empty denominator: 0, or None to leave it out of the mean."""
    return metrics_of_counts(
        df.groupBy(*group_cols, F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n")), group_cols, empty)


def metrics_of_counts(counts: DataFrame, group_cols: list[str], empty: float | None = 0.0) -> DataFrame:
    """``grouped_metrics`` from (group..., label, prediction, n) counts."""
    known = counts.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    zero = F.lit(0).cast("long")
    side = lambda k, t, p, tp: F.struct(k.alias("k"), t.alias("t"), p.alias("p"), tp.alias("tp"))
    n = F.col("n").cast("long")
    per = (known.select(*group_cols, F.explode(F.array(
        side(F.col("label"), n, zero, F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)),
        side(F.col("prediction"), zero, n, zero))).alias("x"))
        .groupBy(*group_cols, "x.k").agg(*[F.sum(f"x.{c}").cast("double").alias(c) for c in ("t", "p", "tp")]))
    per = per.withColumn("s", F.sum("t").over(Window.partitionBy(*group_cols)))      # one row a class
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(empty).cast("double"))
    tp, t, p, s_ = (F.col(c) for c in ("tp", "t", "p", "s"))
    per = per.withColumns({"sens": rate(tp, t), "prec": rate(tp, p), "spec": rate(s_ - t - p + tp, s_ - t)})
    per = per.withColumns({"f1": rate(2 * F.col("prec") * F.col("sens"), F.col("prec") + F.col("sens")),
                           "bal": (F.col("sens") + F.col("spec")) / 2})
    wide = per.groupBy(*group_cols).agg(
        F.coalesce(F.try_divide(F.sum("tp"), F.max("s")), F.lit(0.0)).alias("accuracy"), F.avg("sens").alias("sensitivity"),
        F.avg("spec").alias("specificity"), F.avg("prec").alias("precision"), F.avg("f1").alias("f1"),
        F.avg("bal").alias("bal_accuracy"), F.avg("sens").alias("bal_accuracy_recall"),
        F.coalesce(F.try_divide(
            F.sum("tp") * F.max("s") - F.sum(p * t),
            F.sqrt((F.max("s") * F.max("s") - F.sum(p * p)) * (F.max("s") * F.max("s") - F.sum(t * t)))), F.lit(0.0)).alias("mcc"))
    return wide.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRIC_NAMES])).alias("m")) \
        .select(*group_cols, "m.metric", "m.value")


def hand_till_auc(df: DataFrame, prob_cols: list[str], label: str = "label") -> float:
    """V6: multiclass AUC of Hand and Till: the mean over class pairs of
    (A(i|j) + A(j|i)) / 2, where A(i|j) is the probability that a class-i row
    scores higher on p_i than a class-j row (ties count one half).

    Each row is expanded into the ordered pairs it belongs to, counted per
    distinct score, and A is read off bucketed prefix sums.
    """
    k = len(prob_cols)
    parts = []
    for i in range(k):
        for j in range(k):
            if i == j:
                continue
            parts.append(F.when(F.col(label).isin(i, j), F.struct(
                F.lit(i).alias("pi"), F.lit(j).alias("pj"),
                F.col(prob_cols[i]).alias("score"),
                (F.col(label) == i).cast("long").alias("pos"),
                (F.col(label) == j).cast("long").alias("neg"))))
    long = df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("e")) \
        .select("e.*")
    table = long.groupBy("pi", "pj", "score").agg(F.sum("pos").alias("pos"),
                                                  F.sum("neg").alias("neg"))
    ps = prefix_sums(table, ["pi", "pj"], "score", ["neg"])
    per_pair = ps.groupBy("pi", "pj").agg(
        (F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
         / (F.sum("pos") * F.sum("neg"))).alias("a")).collect()
    a = {(r["pi"], r["pj"]): r["a"] for r in per_pair}
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)
             if a.get((i, j)) is not None and a.get((j, i)) is not None]
    if not pairs:
        return float("nan")
    return sum((a[(i, j)] + a[(j, i)]) / 2.0 for i, j in pairs) / len(pairs)


def log_loss(df: DataFrame, prob_cols: list[str], label: str = "label",
             eps: float = 1e-15) -> float:
    """V9: -mean ln p(true class), probabilities clipped to [eps, 1 - eps]."""
    p = F.element_at(F.array(*[F.col(c) for c in prob_cols]), F.col(label).cast("int") + 1)
    clipped = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return df.agg(F.avg(-F.ln(clipped)).alias("v")).first()["v"]


def score_density(df: DataFrame, score: str, label: str = "label", bins: int = 20) -> DataFrame:
    """Density of a class probability by true class on [0, 1]."""
    b = F.least(F.floor(F.col(score) * bins) + 1, F.lit(bins)).cast("int")
    counts = df.groupBy(F.col(label).alias("label"), b.alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    per_class = Window.partitionBy("label")
    return counts.select("label", "bin", "n", F.round(
        F.col("n") / (F.sum("n").over(per_class) * F.lit(1.0 / bins)), 6).alias("density"))


class MacroF1Evaluator(Evaluator):
    """Macro-averaged metric usable wherever a Spark ML evaluator is."""

    def __init__(self, metric: str = "f1", labelCol: str = "label",
                 predictionCol: str = "prediction"):
        super().__init__()
        self.metric, self.labelCol, self.predictionCol = metric, labelCol, predictionCol

    def _evaluate(self, dataset):
        rows = [(r["label"], r["prediction"], r["n"])
                for r in confusion(dataset, self.labelCol, self.predictionCol).collect()]
        return metrics_from_confusion(rows)[self.metric]

    def isLargerBetter(self):
        return True


def smooth_density(df: DataFrame, scores: list[str], label: str = "label", points: int = 101) -> DataFrame:
    """A14, smooth: kernel density of each class probability by true class on a fixed
    grid over [0, 1] (``score, label, x, n, density``).

    One aggregate bins all columns and classes linearly, each score between its two
    grid points, and keeps the sums that give the rule-of-thumb bandwidth, sample
    deviation * n^(-1/5); (columns x classes x points) cells are then convolved with the
    normal kernel. Scores outside [0, 1] count at its ends; null and NaN scores and null labels
    are left out; a group without spread has its mass at its grid points and no density."""
    import numpy as np
    step = points - 1
    long = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("score"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v"))
        for c in scores])).alias("s")).where(F.col("s.v").isNotNull()) \
        .select("label", "s.score", F.least(F.greatest("s.v", F.lit(0.0)), F.lit(1.0)).alias("v"))
    cell = F.least(F.floor(F.col("v") * step), F.lit(step - 1)).cast("int")
    cells = long.withColumn("cell", cell).groupBy("score", "label", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v") * step - F.col("cell")).alias("above"), F.sum("v").alias("s"),
        F.sum(F.col("v") * F.col("v")).alias("q")).collect()
    groups: dict = {}
    for r in cells:
        weight, sums = groups.setdefault((r["score"], r["label"]), (np.zeros(points), np.zeros(3)))
        weight[r["cell"]] += r["n"] - r["above"]
        weight[r["cell"] + 1] += r["above"]
        sums += [r["n"], r["s"], r["q"]]
    grid, rows = np.arange(points) / step, []
    for (name, cls), (weight, (n, s, q)) in sorted(groups.items()):
        var = (q - s * s / n) / (n - 1) if n > 1 else 0.0
        h = np.sqrt(var) * n ** -0.2 if var > 1e-15 else 0.0
        density = [None] * points if h == 0.0 else \
            (np.exp(-0.5 * ((grid[:, None] - grid[None, :]) / h) ** 2) @ weight / (n * h * np.sqrt(2 * np.pi))).tolist()
        rows += [(name, cls, float(x), int(n), None if d is None else round(float(d), 6)) for x, d in zip(grid, density)]
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"score string, label {kind}, x double, n long, density double")
