"""Classifiers (M1-M11) as Spark ML estimators or aggregate-fitted models.

Spark ML models train distributed (tree histograms and gradient sums are
aggregated across executors). The Gaussian naive Bayes and discriminant
models are fitted from class sufficient statistics in one aggregate; only a
K x p (or K x p x p) summary reaches the driver, and scoring is a column
expression with the fitted numbers as literals. Vector columns (the levels of an
identifier) reach every kind but ``kernel_bayes``, which takes the levels
themselves and refuses a vector.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC,
                                       LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Fitted, Step, partitions_for, register, right_size
from .sketch import WIDTH, TensorSketch
from .sparse import class_grams, dense_features, slot_moments, slot_phases, slot_scores, slot_sums, split_features, starts, vector_sizes

FEATURES = "features"


def assembler(cols: list[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def _argmax(scores: list) -> F.Column:
    """Index of the largest score (first on ties)."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    out = None
    for i in reversed(range(len(scores))):
        out = F.when(scores[i] == best, F.lit(i)) if out is None else \
            F.when(scores[i] == best, F.lit(i)).otherwise(out)
    return out


def _scored(df, scores: list, classes: list):
    """Prediction and class probabilities from per-class scores. The scores
    are materialised as columns first, so argmax and softmax refer to them
    instead of repeating each score expression."""
    names = [f"__s{i}" for i in range(len(scores))]
    out = df.withColumns(dict(zip(names, scores)))
    cols = [F.col(n) for n in names]
    idx = _argmax(cols)
    pred = F.element_at(F.array(*[F.lit(c) for c in classes]), idx + 1)
    probs = _softmax(cols)
    return out.withColumns({"prediction": pred.cast("double"),
                            **{f"prob_{i}": p for i, p in enumerate(probs)}}).drop(*names)


def _softmax(scores: list) -> list:
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    ex = [F.exp(s - m) for s in scores]
    total = ex[0]
    for e in ex[1:]:
        total = total + e
    return [e / total for e in ex]


# ---------------------------------------------------------------- M10
@register
class FittedGaussianNB(Fitted):
    def scores(self):
        p = self.params
        out = []
        for c in range(len(p["classes"])):
            s = F.lit(p["log_prior"][c])
            for j, f in enumerate(p["features"]):
                var = p["var"][c][j]
                mu = p["mean"][c][j]
                s = s - F.lit(0.5 * math.log(2 * math.pi * var)) \
                    - (F.col(f) - F.lit(mu)) * (F.col(f) - F.lit(mu)) / F.lit(2.0 * var)
            if p.get("vectors"):
                s = s + F.lit(p["slot_base"][c]) + F.col("__slots")[c]
            out.append(s)
        return out

    def staged(self, df):
        """``df`` with what ``scores`` refers to."""
        p = self.params
        return df if not p.get("vectors") else slot_scores(
            df, self.tables["slots"], p["slots_set"], len(p["classes"]), p["vectors"], p["offsets"], p["unset"], "__slots")

    def transform(self, df):
        return _scored(self.staged(df), self.scores(), self.params["classes"]).drop("__slots")


class GaussianNB(Step):
    """Per-class mean and population variance in one aggregate; every
    variance is increased by var_smoothing times the largest feature variance.
    Every slot of a vector column is a feature of its own: sums of the slots that
    are set are state, the others follow from the class sizes."""

    def __init__(self, features: list[str], label: str = "label", var_smoothing: float = 1e-9):
        self.features, self.label, self.var_smoothing = features, label, var_smoothing

    def fit(self, df):
        numbers, vectors = split_features(df, self.features)
        if vectors:
            df = df.where(F.col(self.label).isNotNull())
        stats = df.groupBy(self.label).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.count(f).alias(f"n_{f}") for f in numbers],
            *[F.avg(f).alias(f"m_{f}") for f in numbers],
            *[F.var_pop(f).alias(f"v_{f}") for f in numbers]).orderBy(self.label).collect()

        def overall(f):       # the variance of all rows from the classes' own
            parts = [(r[f"n_{f}"], r[f"m_{f}"], r[f"v_{f}"]) for r in stats if r[f"n_{f}"]]
            total = sum(k for k, _, _ in parts)
            mean = sum(k * m for k, m, _ in parts) / total if total else 0.0
            return sum(k * (v + (m - mean) ** 2) for k, m, v in parts) / total if total else 0.0
        largest = max((overall(f) for f in numbers), default=0.0)
        eps, more, tables = self.var_smoothing * largest, {}, {}
        if vectors:
            eps, more, tables = self._slots(df, vectors, stats, largest)
        n = float(sum(r["__n"] for r in stats))
        return FittedGaussianNB({
            "features": numbers,
            "classes": [r[self.label] for r in stats],
            "log_prior": [math.log(r["__n"] / n) for r in stats],
            "mean": [[r[f"m_{f}"] for f in numbers] for r in stats],
            "var": [[(r[f"v_{f}"] or 0.0) + eps for f in numbers] for r in stats], **more}, tables)

    def _slots(self, df, vectors, stats, largest):
        sizes, classes = vector_sizes(df, vectors), [r[self.label] for r in stats]
        offsets = starts(sizes)
        table, eps = slot_moments(slot_sums(df, self.label, vectors, offsets), classes, [r["__n"] for r in stats],
                                  self.var_smoothing, largest)
        row = table.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(len(classes))]).first()
        never = sum(sizes) - row["n"]                     # slots that no row has set
        base = [(row[f"c{i}"] or 0.0) - (never * 0.5 * math.log(2 * math.pi * eps) if never else 0.0) for i in range(len(classes))]
        more = {"vectors": vectors, "offsets": offsets, "slots_set": row["n"], "slot_base": base,
                "unset": -0.5 / eps if eps else 0.0}
        return eps, more, {"slots": table}


# ---------------------------------------------------------------- M11
@register
class FittedDiscriminant(Fitted):
    def transform(self, df):
        p = self.params
        const, linear = np.array(p["const"]), np.array(p["linear"])
        quad = None if p["quad"][0] is None else np.array(p["quad"])

        @F.arrow_udf("array<double>")
        def discriminant(x: pa.Array) -> pa.Array:
            values = np.asarray(x.flatten().to_numpy(zero_copy_only=False)).reshape(len(x), -1)
            s = const + values @ linear.T
            if quad is not None:
                s += np.stack([((values @ q) * values).sum(axis=1) for q in quad], axis=1)
            return pa.array(list(s), pa.list_(pa.float64()))
        out = df.withColumn("__d", discriminant(dense_features(p["features"], p.get("vectors", []), p.get("sizes", []))))
        return _scored(out, [F.col("__d")[i] for i in range(len(const))], p["classes"]).drop("__d")


class Discriminant(Step):
    """Linear (``lda``), quadratic (``qda``) or regularised (``rda``:
    class covariances shrunk by ``reg`` toward the pooled one, then by
    ``gamma`` toward a scaled identity) discriminant analysis.

    Class covariances are Gram sums around the class means, so large means
    cancel nothing; the p x p algebra runs on the driver. A singular matrix is
    inverted, and its log-determinant taken, over its non-zero eigenvalues. Vectors
    are read slot by slot, up to ``sparse.MAX_WIDTH`` features; more is an error."""

    def __init__(self, features: list[str], label: str = "label", kind: str = "lda",
                 reg: float = 0.0, gamma: float = 0.0):
        self.features, self.label, self.kind, self.reg, self.gamma = features, label, kind, reg, gamma

    def fit(self, df):
        from .select import gram_sums
        fs, vectors = split_features(df, self.features)
        if vectors:
            sizes = vector_sizes(df, vectors)
            found = class_grams(df, self.label, fs, vectors, sizes)
            return self._solve(fs, [c for c, *_ in found], [n for _, n, _, _ in found], [m for _, _, m, _ in found],
                               [xx / max(n - 1.0, 1.0) for _, n, _, xx in found], {"vectors": vectors, "sizes": sizes})
        p = len(fs)
        rows = df.groupBy(self.label).agg(F.count(F.lit(1)).alias("__n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(fs)]) \
            .orderBy(self.label).collect()
        classes, ns, means, covs = [], [], [], []
        for r in rows:      # one pass a class
            n, mu = float(r["__n"]), np.array([r[f"m{i}"] for i in range(p)])
            xx = gram_sums(df.where(F.col(self.label) == r[self.label]), fs, mu.tolist())[3]
            classes.append(r[self.label])
            ns.append(n)
            means.append(mu)
            covs.append(xx / max(n - 1.0, 1.0))
        return self._solve(fs, classes, ns, means, covs, {})

    def _solve(self, fs, classes, ns, means, covs, more):
        total, p = sum(ns), len(means[0])
        pooled = sum((n - 1.0) * c for n, c in zip(ns, covs)) / max(total - len(ns), 1.0)
        const, linear, quad = [], [], []
        for n, mu, cov in zip(ns, means, covs):
            prior = math.log(n / total)
            if self.kind == "lda":
                inv, _ = _inverse(pooled)
                linear.append((inv @ mu).tolist())
                const.append(float(-0.5 * mu @ inv @ mu + prior))
                quad.append(None)
                continue
            sig = cov if self.kind == "qda" else (1 - self.reg) * cov + self.reg * pooled
            if self.gamma:
                sig = (1 - self.gamma) * sig + self.gamma * np.trace(sig) / p * np.eye(p)
            inv, logdet = _inverse(sig)
            quad.append((-0.5 * inv).tolist())
            linear.append((inv @ mu).tolist())
            const.append(float(-0.5 * mu @ inv @ mu - 0.5 * logdet + prior))
        return FittedDiscriminant({"features": fs, "classes": classes, "const": const,
                                   "linear": linear, "quad": quad, **more})


def _inverse(m: np.ndarray) -> tuple[np.ndarray, float]:
    """Pseudo-inverse and log-determinant over the non-zero eigenvalues."""
    w, v = np.linalg.eigh(m)
    keep = w > max(w.max(), 0.0) * len(w) * 1e-12
    return (v[:, keep] / w[keep]) @ v[:, keep].T, float(np.log(w[keep]).sum())


# ---------------------------------------------------------------- M4 features
@register
class FittedFourier(Fitted):
    def transform(self, df):
        p = self.params
        cols = {}
        if p.get("vectors"):
            df = df.withColumn("__phases", slot_phases(p["vectors"], p["offsets"], len(p["b"]), p["seed"], p["sd"]))
        scale = math.sqrt(2.0 / len(p["b"]))
        for m, (w, b) in enumerate(zip(p["w"], p["b"])):
            s = F.lit(b)
            for j, f in enumerate(p["features"]):
                s = s + F.lit(w[j]) * F.col(f)
            if p.get("vectors"):
                s = s + F.col("__phases")[m]
            cols[f"rff_{m}"] = F.lit(scale) * F.cos(s)
        return df.withColumns(cols).drop("__phases")


class RandomFourier(Step):
    """Random Fourier features for the radial kernel exp(-sigma ||x - y||^2)
    (Rahimi and Recht): w ~ N(0, 2 sigma I), b ~ U(0, 2 pi). The directions of a
    vector's slots come from (seed, slot), so that none are stored."""

    def __init__(self, features: list[str], n_features: int = 64, sigma: float = 0.5, seed: int = 7):
        self.features, self.n, self.sigma, self.seed = features, n_features, sigma, seed

    def fit(self, df):
        numbers, vectors = split_features(df, self.features)
        rng, sd = np.random.RandomState(self.seed), math.sqrt(2.0 * self.sigma)
        w = rng.normal(0.0, sd, size=(self.n, len(numbers)))
        b = rng.uniform(0.0, 2 * math.pi, size=self.n)
        more = {"vectors": vectors, "offsets": starts(vector_sizes(df, vectors)), "seed": self.seed, "sd": sd} if vectors else {}
        return FittedFourier({"features": numbers, "w": w.tolist(), "b": b.tolist(), **more})

    def columns(self):
        return [f"rff_{m}" for m in range(self.n)]


# ---------------------------------------------------------------- Spark ML zoo
def spark_estimator(kind: str, params: dict, label: str = "label", seed: int = 11):
    """Spark ML stages for the model ``kind`` with tuned ``params``; the
    stages read the assembled ``features`` vector."""
    if kind == "logistic":                                  # M1
        return [LogisticRegression(labelCol=label, family="multinomial",
                                   regParam=params.get("regParam", 0.0),
                                   elasticNetParam=params.get("elasticNetParam", 0.0),
                                   maxIter=int(params.get("maxIter", 100)))]
    if kind in ("svm", "svm_poly", "svm_rff"):              # M2, M3, M4
        svc = LinearSVC(regParam=params.get("regParam", 0.01), maxIter=int(params.get("maxIter", 100)),
                        tol=params.get("tol", 1e-4))
        feats = FEATURES
        if kind == "svm_poly":
            feats = "poly"                                  # the tensor sketch, made before
        return [OneVsRest(classifier=svc, labelCol=label, featuresCol=feats,
                                   parallelism=int(params.get("parallelism", 4)))]
    if kind == "forest":                                    # M5
        return [RandomForestClassifier(labelCol=label, numTrees=int(params.get("numTrees", 50)),
                                       maxDepth=int(params.get("maxDepth", 5)),
                                       minInstancesPerNode=int(params.get("minInstancesPerNode", 1)),
                                       featureSubsetStrategy=str(params.get("featureSubsetStrategy", "sqrt")),
                                       seed=seed)]
    if kind == "bagged":                                    # M6
        return [RandomForestClassifier(labelCol=label, numTrees=int(params.get("numTrees", 25)),
                                       maxDepth=int(params.get("maxDepth", 5)),
                                       minInstancesPerNode=int(params.get("minInstancesPerNode", 1)),
                                       minInfoGain=params.get("minInfoGain", 0.0),
                                       featureSubsetStrategy="all", bootstrap=True, seed=seed)]
    if kind == "tree":                                      # M7
        return [DecisionTreeClassifier(labelCol=label, maxDepth=int(params.get("maxDepth", 5)),
                                       minInstancesPerNode=int(params.get("minInstancesPerNode", 1)),
                                       minInfoGain=params.get("minInfoGain", 0.0), seed=seed)]
    raise ValueError(f"unknown model kind {kind}")


CUSTOM_KINDS = {"naive_bayes", "kernel_bayes", "lda", "qda", "rda", "gbt"}
#: Kinds whose estimator reads features made by an inner step.
MAPPED_KINDS = {"svm_poly", "svm_rff"}
SPARK_KINDS = {"logistic", "svm", "svm_poly", "svm_rff", "forest", "bagged", "tree"}


@register
class FittedClassifier(Fitted):
    """A fitted model of any kind: adds ``prediction`` (double) and, where
    the model gives them, class probabilities ``prob_<k>``."""

    def __init__(self, params=None, tables=None, model=None, inner=None):
        super().__init__(params, tables)
        self.model, self.inner = model, inner

    def transform(self, df):
        p = self.params
        feats = p["features"]
        if p["kind"] in CUSTOM_KINDS:
            return self.inner.transform(df)
        staged = df
        if p["kind"] in MAPPED_KINDS:
            staged = self._mapped(staged)
        else:
            staged = assembler(feats).transform(staged)
        if self.model is None:                              # votes or pruned trees
            return self.inner.transform(staged).drop(FEATURES)
        out = self.model.transform(staged)
        k = p["n_classes"]
        from pyspark.ml.functions import vector_to_array
        if "probability" in out.columns:
            out = out.withColumn("__p", vector_to_array("probability"))  # converted once
            out = out.withColumns({f"prob_{i}": F.col("__p")[i] for i in range(k)}).drop("__p")
        elif "rawPrediction" in out.columns:
            out = out.withColumn("__p", vector_to_array("rawPrediction"))
            if p.get("sigmoids"):
                from .calibration import probability_columns
                out = probability_columns(out, F.col("__p"), p["sigmoids"], k).drop("__p")
                return out.drop(*[c for c in ("features", "poly", "rawPrediction") if c in out.columns],
                                *[c for c in out.columns if c.startswith("rff_")])
            # one-vs-rest scores -> softmax (a relative score, not calibrated)
            probs = _softmax([F.col("__p")[i] for i in range(k)])
            out = out.withColumns({f"prob_{i}": probs[i] for i in range(k)}).drop("__p")
        drop = [c for c in ("features", "poly", "rawPrediction", "probability") if c in out.columns]
        drop += [c for c in out.columns if c.startswith("rff_")]
        return out.drop(*drop)

    def _mapped(self, df):
        """The random Fourier features or the tensor sketch of the features."""
        if self.params["kind"] == "svm_poly":
            return self.inner.transform(assembler(self.params["features"]).transform(df))
        staged = self.inner.transform(df)
        return assembler([c for c in staged.columns if c.startswith("rff_")]).transform(staged)

    def raw_scores(self, df, names: list[str]):
        """``df`` with the one-vs-rest scores of the classes."""
        from pyspark.ml.functions import vector_to_array
        staged = self._mapped(df) if self.inner is not None else assembler(self.params["features"]).transform(df)
        out = self.model.transform(staged).withColumn("__r", vector_to_array("rawPrediction"))
        return out.withColumns({n: F.col("__r")[i] for i, n in enumerate(names)}).select(*df.columns, *names)

    def save(self, path):
        super().save(path)
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        if self.inner is not None:
            self.inner.save(f"{path}/inner")

    def _after_load(self, spark, path):
        from pyspark.ml import PipelineModel
        self.model, self.inner = None, None
        if self.params["kind"] in SPARK_KINDS and not self.params.get("pruned"):
            self.model = PipelineModel.load(f"{path}/model")
        if self.params["kind"] in CUSTOM_KINDS | MAPPED_KINDS | {"c50"} or self.params.get("pruned"):
            self.inner = Fitted.load(spark, f"{path}/inner")


class Classifier(Step):
    """Any model of the zoo behind one fit/transform interface."""

    def __init__(self, kind: str, features: list[str], label: str = "label",
                 params: dict | None = None, seed: int = 11, n_classes: int | None = None,
                 rows: int | None = None):
        self.kind, self.features, self.label = kind, features, label
        self.params, self.seed = dict(params or {}), seed
        self.n_classes, self.rows = n_classes, rows  # known by callers: saves two jobs per fit

    def _calibrated(self, df: DataFrame, folds: int, n_classes: int):
        """K2: the model of all rows, its probabilities from sigmoids of out-of-fold scores."""
        from .calibration import cross_fitted, fit_sigmoids
        names = [f"s{c}" for c in range(n_classes)]

        def plain(rows):
            return Classifier(self.kind, self.features, self.label, {**self.params, "calibrate": 0}, self.seed, n_classes).fit(rows)

        def score(train, rest):
            return plain(train).raw_scores(rest, names).select(F.col(self.label).cast("int").alias(self.label), *names)
        model = plain(df)
        model.params["sigmoids"] = fit_sigmoids(cross_fitted(df, self.label, folds, score), self.label, names)
        return model

    def fit(self, df: DataFrame):
        vectors = split_features(df, self.features)[1]
        if self.kind == "kernel_bayes" and vectors:
            raise ValueError(f"kernel_bayes cannot read the vectors {vectors}: give it the columns of the levels")
        n_classes = int(self.n_classes or df.agg(F.max(self.label)).first()[0] + 1)
        folds = int(self.params.get("calibrate", 0))
        if folds > 1 and self.kind.startswith("svm"):
            return self._calibrated(df, folds, n_classes)
        meta = {"kind": self.kind, "features": self.features, "label": self.label,
                "n_classes": int(n_classes), "params": self.params}
        if self.kind == "naive_bayes":
            inner = GaussianNB(self.features, self.label,
                               self.params.get("var_smoothing", 1e-9)).fit(df)
            return FittedClassifier(meta, inner=inner)
        if self.kind == "kernel_bayes":                         # M10
            from .kernel_bayes import KernelBayes
            numbers = [f for f in self.features if df.schema[f].dataType.typeName() != "string"]
            inner = KernelBayes(numbers, [f for f in self.features if f not in numbers], self.label,
                                float(self.params.get("smoothness", 1.0)), float(self.params.get("laplace", 0.0))).fit(df)
            return FittedClassifier(meta, inner=inner)
        if self.kind == "gbt":                                  # M8
            from .boosting import SoftmaxBoosting
            return FittedClassifier(meta, inner=SoftmaxBoosting(self.features, self.label, self.params, int(n_classes), self.seed).fit(df))
        if self.kind in ("lda", "qda", "rda"):
            inner = Discriminant(self.features, self.label, self.kind,
                                 self.params.get("reg", 0.0), self.params.get("gamma", 0.0)).fit(df)
            return FittedClassifier(meta, inner=inner)
        staged, feats, inner, rows = df, self.features, None, self.rows
        width = len(self.features) + 1
        if self.kind == "svm_poly":     # rows widen to the sketch: dealt out before, while they are narrow
            width, rows = int(self.params.get("n_features", WIDTH)) + 1, df.count() if rows is None else rows
            want = partitions_for(rows, width)
            if want > df.rdd.getNumPartitions():
                staged = df = df.repartition(want)
        if self.kind == "svm_rff":
            rff = RandomFourier(self.features, int(self.params.get("n_features", 64)),
                                self.params.get("sigma", 0.5), self.seed)
            inner = rff.fit(df)
            staged = inner.transform(df)
            feats = rff.columns()
            width = len(feats) + 1
        staged = assembler(feats).transform(staged)
        made = FEATURES
        if self.kind == "svm_poly":
            inner = TensorSketch(FEATURES, int(self.params.get("degree", 2)), float(self.params.get("scale", 1.0)),
                                 int(self.params.get("n_features", WIDTH)), self.seed).fit(staged)
            staged, made = inner.transform(staged), "poly"
        staged = staged.select(made, F.col(self.label).cast("double").alias(self.label))
        staged = right_size(staged, rows, width=width)  # iterative trainers pass over it once per iteration
        if self.kind == "c50":                                  # M9
            from .reweighting import ReweightedTrees
            return FittedClassifier(meta, inner=ReweightedTrees(self.label, int(n_classes), self.params, FEATURES, self.seed).fit(staged))
        model = Pipeline(stages=spark_estimator(self.kind, self.params, self.label, self.seed)).fit(staged)
        if self.kind in ("tree", "bagged") and self.params.get("cost_complexity"):
            from .pruning import FittedPrunedTrees, flat, prune, read_trees
            trees = read_trees(model.stages[-1], self.kind == "bagged")
            pruned = [flat(prune(t, float(self.params["cost_complexity"]))) for t in trees]
            return FittedClassifier({**meta, "pruned": True}, inner=FittedPrunedTrees({"trees": pruned, "n_classes": int(n_classes)}))
        return FittedClassifier(meta, model=model, inner=inner)
