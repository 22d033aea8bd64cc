"""Hyper-parameter search and resampled evaluation (H1-H9).

The driver only generates parameter points (a few hundred at most) and
submits fits; all data work runs on the cluster. Per fold the recipe is
fitted on the training part only (no leakage) and both parts are stored
once for all configurations; a recipe that only scales is fitted for all folds
from one pass over one stored copy. Fits of different (configuration, fold) pairs run
concurrently from ``parallelism`` driver threads, as ``CrossValidator`` does.
Each fit reduces its predictions to K x K counts and a loss sum in one
aggregate and frees its model, so the table of results is as small for 17 400
fits as for 17; a fit that fails is recorded and the others go on.
"""

from __future__ import annotations

import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as M
from ..session import materialise
from .base import right_size
from .folds import fold_sums
from .models import Classifier
from .normalize import ZScore

# Parameter ranges per model kind (ours; bounded so every point is valid).
# kinds: log (log-uniform float), float, int, choice
SPACES = {
    "logistic": {"regParam": ("log", 1e-4, 1.0), "elasticNetParam": ("float", 0.0, 1.0)},
    "svm": {"regParam": ("log", 1e-4, 1.0)},
    "svm_poly": {"regParam": ("log", 1e-4, 1.0), "degree": ("int", 1, 3), "scale": ("log", 1e-3, 1.0)},
    "svm_rff": {"regParam": ("log", 1e-4, 1.0), "sigma": ("log", 0.05, 2.0)},
    "forest": {"numTrees": ("int", 10, 60), "maxDepth": ("int", 2, 8),
               "minInstancesPerNode": ("int", 1, 20), "mtry": ("int", 1, 8)},
    "bagged": {"maxDepth": ("int", 2, 8), "minInstancesPerNode": ("int", 1, 20),
               "minInfoGain": ("log", 1e-6, 0.1), "cost_complexity": ("log", 1e-5, 0.1)},
    "tree": {"maxDepth": ("int", 2, 10), "minInstancesPerNode": ("int", 1, 20),
             "minInfoGain": ("log", 1e-6, 0.1), "cost_complexity": ("log", 1e-5, 0.1)},
    "gbt": {"maxIter": ("int", 5, 30), "maxDepth": ("int", 2, 6), "stepSize": ("log", 0.01, 0.5),
            "minInstancesPerNode": ("int", 1, 20), "subsamplingRate": ("float", 0.5, 1.0),
            "minInfoGain": ("log", 1e-6, 0.1), "mtry": ("int", 1, 8)},
    "c50": {"maxIter": ("int", 5, 30), "minInstancesPerNode": ("int", 1, 20), "maxDepth": ("int", 2, 8),
            "subsamplingRate": ("float", 0.5, 1.0)},
    "naive_bayes": {"var_smoothing": ("log", 1e-12, 1e-3)},
    "kernel_bayes": {"smoothness": ("float", 0.5, 1.5), "laplace": ("float", 0.0, 3.0)},
    "lda": {},
    "qda": {"gamma": ("float", 0.0, 0.5)},
    "rda": {"reg": ("float", 0.0, 1.0), "gamma": ("float", 0.0, 0.5)},
}


def _draw(spec, u: float):
    kind, lo, hi = spec
    if kind == "log":
        return float(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))))
    if kind == "float":
        return float(lo + u * (hi - lo))
    if kind == "int":
        return int(min(hi, lo + math.floor(u * (hi - lo + 1))))
    if kind == "choice":
        return lo[min(len(lo) - 1, int(u * len(lo)))]
    raise ValueError(kind)


def random_search(space: dict, n: int, seed: int = 0) -> list[dict]:
    """H1: n independent uniform draws."""
    rng = np.random.RandomState(seed)
    names = sorted(space)
    return [{k: _draw(space[k], rng.uniform()) for k in names} for _ in range(n)]


def latin_hypercube(space: dict, n: int | None = None, seed: int = 0) -> list[dict]:
    """H2: Latin hypercube of size n (default 20 x number of parameters):
    each parameter's range is cut into n strata, each stratum used once."""
    names = sorted(space)
    n = n or max(1, 20 * len(names))
    rng = np.random.RandomState(seed)
    cols = {k: (rng.permutation(n) + rng.uniform(size=n)) / n for k in names}
    return [{k: _draw(space[k], cols[k][i]) for k in names} for i in range(n)]


def grid(values: dict[str, list]) -> list[dict]:
    """H3: exhaustive grid over explicit value lists."""
    names = sorted(values)
    return [dict(zip(names, combo)) for combo in itertools.product(*[values[k] for k in names])]


def bound_by_features(params: dict, n_features: int) -> dict:
    """H9: parameters bounded by the data (mtry <= number of features)."""
    out = dict(params)
    if "mtry" in out:
        m = max(1, min(int(out.pop("mtry")), n_features))
        out["featureSubsetStrategy"] = str(m) if m < n_features else "all"
    return out


def _only_scales(recipe_factory, df: DataFrame) -> list[str] | None:
    """The columns of a recipe that is one z-score step and nothing else."""
    steps = getattr(recipe_factory(), "steps", []) if recipe_factory is not None else []
    if len(steps) == 1 and type(steps[0]) is ZScore and steps[0].ddof == 0:
        return [c for c in steps[0].cols if c in df.columns] or None
    return None


LONG = "model string, config int, fold int, metric string, value double, duration_s double"


def evaluate(scored: DataFrame, label: str, n_classes: int, auc: bool = False,
             custom: dict | None = None) -> dict:
    """Metrics of a scored frame: the confusion metrics, ``log_loss`` where there are
    probabilities, ``roc_auc`` (Hand and Till; further jobs) if asked for, and
    ``custom`` ones, functions of the (label, prediction, n) rows."""
    probs = [f"prob_{i}" for i in range(n_classes)]
    probs = probs if all(c in scored.columns for c in probs) else []
    truth = F.col(label).cast("int")
    loss = F.lit(None).cast("double")
    if probs:
        p = F.element_at(F.array(*probs), truth + 1)
        loss = F.sum(-F.ln(F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))))
    cells = scored.where(truth.isNotNull() & F.col("prediction").isNotNull()) \
        .groupBy(truth.alias("label"), F.col("prediction").cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"), loss.alias("loss")).collect()          # at most K x K rows
    rows = [(r["label"], r["prediction"], r["n"]) for r in cells]
    out = M.metrics_from_confusion(rows)
    if probs and rows:
        out["log_loss"] = sum(r["loss"] for r in cells) / sum(r["n"] for r in cells)
        if auc:
            out["roc_auc"] = M.hand_till_auc(scored.select(truth.alias("label"), *probs), probs, "label")
    for name, fn in (custom or {}).items():
        out[name] = fn(rows)
    return out


def cross_validate(df: DataFrame, fold_col: str, features: list[str] | None, label: str,
                   candidates: list[tuple[str, str, dict]], recipe_factory=None,
                   parallelism: int = 4, key: str = "row_id", auc: bool = False,
                   custom: dict | None = None, strict: bool = False) -> tuple[DataFrame, list[dict]]:
    """H4/H5: evaluate (model name, model kind, params) candidates on every
    fold. Returns the long table (model, config, fold, metric, value,
    duration_s) and one record per fit with its duration (H8) and, for a fit
    that failed, the error; failed fits have no metric rows, and with ``strict``
    a failed fit raises at the end. ``auc`` and ``custom`` (Z4) are passed to
    ``evaluate``."""
    prepared, fold_features, fold_rows, fold_top = {}, {}, {}, {}
    scaled = _only_scales(recipe_factory, df)
    if scaled:      # one stored copy and one pass; a training fold is all sums less the fold's
        df = materialise(df, "folds")
        sums = fold_sums(df, fold_col, label, scaled)
        folds = sums.folds
    else:
        sums, folds = None, sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k values

    def share(f):
        """A fold that needs nothing but scaling."""
        step, n = sums.zscore(f), sums.train(f)[0]
        parts = [step.transform(df.where(w).drop(fold_col)) for w in (F.col(fold_col) != f, F.col(fold_col) == f)]
        prepared[f] = (right_size(parts[0], n), right_size(parts[1], n))
        fold_rows[f], fold_top[f] = n, max((c for c in sums.classes if sums.train(f, c)[0]), default=None)
        fold_features[f] = features or [c for c in parts[0].columns if c not in (key, label)]

    def prepare(f):
        train = df.where(F.col(fold_col) != f).drop(fold_col)
        valid = df.where(F.col(fold_col) == f).drop(fold_col)
        if recipe_factory is not None:
            fitted = recipe_factory().fit(train)
            out = getattr(fitted, "training_output", None)
            train = out if out is not None else fitted.transform(train)
            valid = fitted.transform(valid)
        # checkpoint to the shared folder: cuts the lineage once for all
        # configurations and survives the loss of executors
        train, valid = train.checkpoint(eager=True), valid.checkpoint(eager=True)
        # rows and largest class code of the prepared (coded) data in one job
        row = train.agg(F.count(F.lit(1)).alias("n"), F.max(label).alias("m")).first()
        prepared[f] = (right_size(train, row["n"]), right_size(valid))
        fold_rows[f], fold_top[f] = row["n"], row["m"]
        # without an explicit list, features are what this fold's recipe produced
        fold_features[f] = features or [c for c in train.columns if c not in (key, label)]

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        list(pool.map(share if sums else prepare, folds))  # folds are prepared concurrently
    n_classes = int(max(v for v in fold_top.values() if v is not None)) + 1

    configs = {}
    for name, kind, params in candidates:
        configs.setdefault(name, [])
        configs[name].append((kind, params))

    tasks = [(name, ci, kind, params, f) for name, plist in configs.items()
             for ci, (kind, params) in enumerate(plist) for f in folds]
    durations = []

    def run(task):
        name, ci, kind, params, f = task
        train, valid = prepared[f]
        t0, record = time.time(), {"model": name, "config": ci, "fold": f, "error": None}
        feats = fold_features[f]
        try:
            if sums and kind == "naive_bayes" and set(feats) <= set(sums.cols):      # no pass at all
                model = sums.naive_bayes(f, feats, params.get("var_smoothing", 1e-9), scaled=True)
            else:
                model = Classifier(kind, feats, label, bound_by_features(params, len(feats)),
                                   n_classes=n_classes, rows=fold_rows[f]).fit(train)
            found = evaluate(model.transform(valid), label, n_classes, auc, custom)
        except Exception as e:      # one configuration must not end a search of thousands
            found, record["error"] = {}, f"{type(e).__name__}: {e}"[:500]
        record["duration_s"] = time.time() - t0
        return record, [(name, ci, int(f), m, None if v is None else float(v), record["duration_s"]) for m, v in found.items()]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(run, tasks))
    records = [r for r, _ in done]
    if all(r["error"] for r in records):
        raise RuntimeError(f"every fit failed, the first with {records[0]['error']}")
    lost = [r for r in records if r["error"]]
    if strict and lost:
        raise RuntimeError(f"{len(lost)} of {len(records)} fits failed, the first, {lost[0]['model']} {lost[0]['config']} "
                           f"on fold {lost[0]['fold']}, with {lost[0]['error']}")
    spark = df.sparkSession
    return spark.createDataFrame([row for _, rows in done for row in rows], LONG), records


def summarise(long: DataFrame, folds: int | None = None) -> DataFrame:
    """A12 over the long metric table: mean, n and standard error per
    (model, config, metric). With ``folds`` only configurations that every fold
    has judged, as a ranking needs."""
    whole = long if folds is None else long.join(
        long.select("model", "config", "fold").distinct().groupBy("model", "config").count().where(F.col("count") == folds)
        .drop("count"), ["model", "config"])
    return whole.groupBy("model", "config", "metric").agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"),
        (F.stddev_samp("value") / F.sqrt(F.count(F.lit(1)))).alias("std_err"))


def finalize(train: DataFrame, test: DataFrame, features: list[str] | None, label: str, kind: str,
             params: dict, recipe_factory=None, key: str = "row_id"):
    """H7: refit the chosen configuration on all training rows and evaluate
    once on the held-out rows. Returns (fitted recipe or None, model, metrics dict)."""
    fitted = None
    if recipe_factory is not None:
        fitted = recipe_factory().fit(train)
        out = getattr(fitted, "training_output", None)
        train = out if out is not None else fitted.transform(train)
        test = fitted.transform(test)
    features = features or [c for c in train.columns if c not in (key, label)]
    model = Classifier(kind, features, label, bound_by_features(params, len(features))).fit(train)
    n_classes = int(model.params["n_classes"])
    return fitted, model, evaluate(model.transform(test), label, n_classes, auc=True)
