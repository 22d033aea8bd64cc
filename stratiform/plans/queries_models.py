"""Slices 6-8: models, search and scoring on the vec frame.

Only Gaussian naive Bayes is deterministic enough for an SQL oracle; model
fits, searches and scoring are rows-only checks (their own tests check
quality against the majority class and the save / load round trip)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.balance import NearMiss
from ..operators.base import Recipe
from ..operators.encode import SparseOneHot
from ..operators.kernel_bayes import KernelBayes
from ..operators.models import Classifier, GaussianNB
from ..operators.normalize import ZScore
from ..operators.resample import stratified_folds, stratified_split
from ..operators.score import load_trained, save_trained, score
from ..operators import search as S
from ..session import scratch_path
from ..sources.tables import VEC_FEATURES, obs, vec
from .common import oracle

CLASS_NAMES = {0: "class_a", 1: "class_b", 2: "class_c"}


def _split(spark, sf):
    v = vec(spark, sf)
    return stratified_split(v, "row_id", "label", 0.8, seed=9208).persist()


def _recipe():
    return Recipe([ZScore(VEC_FEATURES)], persist_input=False)


def _model_query(kind, params):
    def run(spark, sf):
        s = _split(spark, sf)
        train, test = s.where("is_train"), s.where("NOT is_train")
        prep = _recipe().fit(train)
        model = Classifier(kind, VEC_FEATURES, "label", params).fit(prep.transform(train))
        out = model.transform(prep.transform(s))
        return out.select("row_id", "label", F.col("prediction").cast("int").alias("prediction"),
                          "is_train")
    run.__name__ = f"q_model_{kind}"
    return run


def q_gaussian_nb(spark, sf):
    v = vec(spark, sf)
    model = Classifier("naive_bayes", VEC_FEATURES, "label").fit(v)
    return model.transform(v).select("row_id", "label",
                                     F.col("prediction").cast("int").alias("prediction"))


def _nb_sql():
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in VEC_FEATURES)
    eps = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in VEC_FEATURES) + ")"
    terms = " + ".join(
        f"(-0.5 * ln(2 * pi() * (s.v_{c} + e.e)) - (v.{c} - s.m_{c}) * (v.{c} - s.m_{c}) "
        f"/ (2 * (s.v_{c} + e.e)))" for c in VEC_FEATURES)
    ctes = (f"st AS (SELECT label, count(*) AS n, {stats} FROM vec GROUP BY label), "
            f"e AS (SELECT {eps} AS e FROM vec), tot AS (SELECT count(*) AS t FROM vec), "
            f"sc AS (SELECT v.row_id, v.label AS truth, s.label AS cls, ln(s.n / tot.t) + {terms} AS score "
            "FROM vec v CROSS JOIN st s CROSS JOIN e CROSS JOIN tot)")
    return oracle("SELECT row_id, truth AS label, cls AS prediction FROM (SELECT *, row_number() OVER "
                  "(PARTITION BY row_id ORDER BY score DESC, cls ASC) AS r FROM sc) WHERE r = 1", ctes)


KERNEL_NUMBERS, KERNEL_LEVELS = ["pulse", "rectal_temp", "respiratory_rate"], ["pain", "abdomen"]
SMOOTHNESS, LAPLACE, GRID = 0.8, 1.0, 101


def q_kernel_bayes(spark, sf):
    """Class scores of the kernel naive Bayes model on every row."""
    o = obs(spark, sf).withColumn("label", F.expr("CASE outcome WHEN 'died' THEN 0 WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 2 END"))
    model = KernelBayes(KERNEL_NUMBERS, KERNEL_LEVELS, "label", SMOOTHNESS, LAPLACE, GRID).fit(o)
    return model.scores(o).select("row_id", *[F.round(f"__k{c}", 5).alias(f"score_{c}") for c in range(3)])


def _kernel_sql():
    last = GRID - 1
    ctes = ["lab AS (SELECT *, CASE outcome WHEN 'died' THEN 0 WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 2 END AS label FROM obs)",
            "known AS (SELECT * FROM lab WHERE label IS NOT NULL)", f"grid AS (SELECT unnest(range({GRID})) AS g)",
            "prior AS (SELECT label, ln(count(*) / (SELECT count(*) FROM known)) AS s FROM known GROUP BY label)"]
    terms = ["SELECT row_id, p.label, p.s FROM lab CROSS JOIN prior p"]
    for c in KERNEL_NUMBERS:
        ctes += [f"e_{c} AS (SELECT min({c}) AS lo, (max({c}) - min({c})) / {last}.0 AS st FROM known)",
                 f"u_{c} AS (SELECT label, ({c} - lo) / st AS u FROM known, e_{c} WHERE {c} IS NOT NULL)",
                 f"m_{c} AS (SELECT label, count(*) AS n, greatest({SMOOTHNESS} * stddev_samp(u) * pow(count(*), -0.2), 0.5) AS h FROM u_{c} GROUP BY label)",
                 f"w_{c} AS (SELECT label, g, sum(greatest(0.0, 1.0 - abs(u - g))) AS w FROM u_{c}, grid GROUP BY label, g)",
                 f"d_{c} AS (SELECT a.label, a.g, sum(b.w * exp(-0.5 * ((a.g - b.g) / h) * ((a.g - b.g) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS d "
                 f"FROM w_{c} a JOIN w_{c} b ON a.label = b.label JOIN m_{c} m ON m.label = a.label GROUP BY a.label, a.g)",
                 f"x_{c} AS (SELECT row_id, least(greatest(({c} - lo) / st, 0.0), {last}.0) AS u FROM lab, e_{c} WHERE {c} IS NOT NULL)"]
        g = f"CAST(least(floor(x.u), {last - 1}) AS BIGINT)"
        terms.append(f"SELECT x.row_id, a.label, ln(greatest(a.d * (1 - (x.u - {g})) + b.d * (x.u - {g}), 1e-12)) FROM x_{c} x "
                     f"JOIN d_{c} a ON a.g = {g} JOIN d_{c} b ON b.g = {g} + 1 AND b.label = a.label")
    for c in KERNEL_LEVELS:
        ctes += [f"l_{c} AS (SELECT lv, label, (SELECT count(*) FROM known k WHERE k.{c} = lv AND k.label = p.label) AS n FROM "
                 f"(SELECT DISTINCT {c} AS lv FROM known WHERE {c} IS NOT NULL), prior p)",
                 f"s_{c} AS (SELECT lv, label, ln((n + {LAPLACE}) / (sum(n) OVER (PARTITION BY label) + {LAPLACE} * count(*) OVER (PARTITION BY label))) AS s, "
                 f"ln({LAPLACE} / (sum(n) OVER (PARTITION BY label) + {LAPLACE} * count(*) OVER (PARTITION BY label))) AS none FROM l_{c})"]
        terms.append(f"SELECT row_id, p.label, coalesce(s.s, (SELECT any_value(none) FROM s_{c} z WHERE z.label = p.label)) FROM lab CROSS JOIN prior p "
                     f"LEFT JOIN s_{c} s ON s.lv = lab.{c} AND s.label = p.label WHERE lab.{c} IS NOT NULL")
    return oracle("SELECT row_id, " + ", ".join(f"round(sum(CASE WHEN label = {k} THEN s END), 5) AS score_{k}" for k in range(3))
                  + " FROM (" + " UNION ALL ".join(terms) + ") GROUP BY row_id", ", ".join(ctes))


LEVEL_NUMBERS, SMOOTHING = ["total_protein", "resp"], 1e-3


def q_bayes_identifier_levels(spark, sf):
    """M10 on identifier levels: log scores of the normal naive Bayes model over two
    numbers and every level of the hospital number, read from a sparse vector."""
    o = obs(spark, sf).selectExpr("row_id", "hospital_number", "total_protein", "coalesce(respiratory_rate, 0e0) AS resp",
                                  "CASE outcome WHEN 'died' THEN 0 WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 2 END AS label")
    known = o.where("label IS NOT NULL")
    encoder = SparseOneHot(["hospital_number"]).fit(known)
    model = GaussianNB([*LEVEL_NUMBERS, "hospital_number_vec"], "label", SMOOTHING).fit(encoder.transform(known))
    return model.staged(encoder.transform(o)).select("row_id", *[F.round(s, 5).alias(f"score_{c}") for c, s in enumerate(model.scores())])


def _bayes_levels_sql():
    var = ", ".join(f"var_pop({c})" for c in LEVEL_NUMBERS)
    numbers = " + ".join(f"(-0.5 * ln(2 * pi() * (s.v_{c} + e)) - (x.{c} - s.m_{c}) * (x.{c} - s.m_{c}) / (2 * (s.v_{c} + e)))" for c in LEVEL_NUMBERS)
    ctes = ("lab AS (SELECT row_id, hospital_number AS lv, total_protein, coalesce(respiratory_rate, 0) AS resp, CASE outcome WHEN 'died' THEN 0 "
            "WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 2 END AS label FROM obs), known AS (SELECT * FROM lab WHERE label IS NOT NULL), "
            "st AS (SELECT label, count(*) AS n, " + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in LEVEL_NUMBERS) + " FROM known GROUP BY label), "
            "share AS (SELECT lv, count(*) / (SELECT count(*) FROM known) AS p FROM known WHERE lv IS NOT NULL GROUP BY lv), "
            f"eps AS (SELECT {SMOOTHING} * greatest({var}, (SELECT max(p * (1 - p)) FROM share)) AS e FROM known), "
            "cell AS (SELECT s.lv, t.label, (SELECT count(*) FROM known k WHERE k.lv = s.lv AND k.label = t.label) / t.n AS mu FROM share s CROSS JOIN st t), "
            "mom AS (SELECT lv, label, mu, mu * (1 - mu) + e AS v FROM cell CROSS JOIN eps), "
            "base AS (SELECT label, sum(-0.5 * ln(2 * pi() * v) - mu * mu / (2 * v)) AS b FROM mom GROUP BY label), "
            f"sc AS (SELECT x.row_id, s.label, ln(s.n / (SELECT count(*) FROM known)) + {numbers} + b.b + coalesce((2 * m.mu - 1) / (2 * m.v), 0) AS score "
            "FROM lab x CROSS JOIN st s CROSS JOIN eps JOIN base b ON b.label = s.label LEFT JOIN mom m ON m.lv = x.lv AND m.label = s.label)")
    return oracle("SELECT row_id, " + ", ".join(f"round(max(CASE WHEN label = {k} THEN score END), 5) AS score_{k}" for k in range(3))
                  + " FROM sc GROUP BY row_id", ctes)


def _folded(spark, sf, k=3):
    s = _split(spark, sf).where("is_train")
    return stratified_folds(s, "row_id", "label", k=k, seed=4000).persist()


def _summary(long):
    return S.summarise(long).select("model", "config", "metric", F.round("mean", 6).alias("mean"), "n",
                                    F.round("std_err", 6).alias("std_err"))


def q_search_random(spark, sf):
    points = S.random_search(S.SPACES["forest"], n=3, seed=1)
    long, _ = S.cross_validate(_folded(spark, sf), "fold", VEC_FEATURES, "label",
                               [("forest", "forest", p) for p in points], _recipe, strict=True)
    return _summary(long)


def q_search_lhs(spark, sf):
    points = S.latin_hypercube(S.SPACES["logistic"], n=4, seed=2)
    long, _ = S.cross_validate(_folded(spark, sf), "fold", VEC_FEATURES, "label",
                               [("logistic", "logistic", p) for p in points], _recipe, strict=True)
    return _summary(long)


def q_search_grid(spark, sf):
    cands = [("naive_bayes", "naive_bayes", p) for p in S.grid({"var_smoothing": [1e-9, 1e-5]})]
    cands += [("rda", "rda", p) for p in S.grid({"reg": [0.0, 0.5], "gamma": [0.0, 0.2]})]
    long, _ = S.cross_validate(_folded(spark, sf), "fold", VEC_FEATURES, "label", cands, _recipe, strict=True)
    return _summary(long)


def q_workflow_set(spark, sf):
    """H5: recipes x models, each pair with its own grid."""
    recipes = {"scaled": _recipe,
               "scaled_nearmiss": lambda: Recipe([ZScore(VEC_FEATURES),
                                                  NearMiss(VEC_FEATURES, "label", "row_id", 3)],
                                                 persist_input=False)}
    models = {"logistic": [{"regParam": 0.01}], "naive_bayes": [{}]}
    folded = _folded(spark, sf)
    out = None
    for rname, factory in recipes.items():
        cands = [(f"{rname}:{m}", m, p) for m, plist in models.items() for p in plist]
        long, _ = S.cross_validate(folded, "fold", VEC_FEATURES, "label", cands, factory, strict=True)
        out = long if out is None else out.unionByName(long)
    return _summary(out)


def q_finalize(spark, sf):
    """H6 + H7: best configuration by macro F1, refit on all training rows,
    one evaluation on the held-out rows."""
    points = S.grid({"regParam": [0.001, 0.1]})
    folded = _folded(spark, sf)
    long, _ = S.cross_validate(folded, "fold", VEC_FEATURES, "label",
                               [("logistic", "logistic", p) for p in points], _recipe, strict=True)
    summ = S.summarise(long).where("metric = 'f1'").orderBy(F.col("mean").desc(), "config").first()
    best = points[summ["config"]]
    s = _split(spark, sf)
    _, _, m = S.finalize(s.where("is_train"), s.where("NOT is_train"), VEC_FEATURES, "label",
                         "logistic", best, _recipe)
    return spark.createDataFrame([("logistic", int(summ["config"]), k, round(float(v), 6))
                                  for k, v in m.items()],
                                 "model string, config int, metric string, value double")


def q_batch_score(spark, sf):
    s = _split(spark, sf)
    train, test = s.where("is_train"), s.where("NOT is_train")
    recipe = _recipe().fit(train)
    model = Classifier("logistic", VEC_FEATURES, "label", {"regParam": 0.01}).fit(recipe.transform(train))
    path = scratch_path(spark, "trained")
    save_trained(path, recipe, model)
    recipe2, model2 = load_trained(spark, path)
    return score(test.drop("label", "is_train"), recipe2, model2, "row_id", CLASS_NAMES)


def q_stream_score(spark, sf):
    from ..streaming.scoring import start_scoring_stream
    s = _split(spark, sf)
    train, test = s.where("is_train"), s.where("NOT is_train")
    recipe = _recipe().fit(train)
    model = Classifier("naive_bayes", VEC_FEATURES, "label").fit(recipe.transform(train))
    path = scratch_path(spark, "trained-stream")
    save_trained(path, recipe, model)
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    incoming = test.drop("label", "is_train")
    incoming.write.parquet(src)
    q = start_scoring_stream(spark, path, src, incoming.schema, sink, class_names=CLASS_NAMES)
    q.awaitTermination()
    return spark.read.parquet(sink).drop("batch")


QUERIES = {
    "gaussian_nb": (q_gaussian_nb, _nb_sql()),
    "kernel_bayes": (q_kernel_bayes, _kernel_sql()),
    "bayes_identifier_levels": (q_bayes_identifier_levels, _bayes_levels_sql()),
    "model_svm_calibrated": (_model_query("svm", {"regParam": 0.01, "maxIter": 50, "calibrate": 3}), None),
    "model_logistic": (_model_query("logistic", {"regParam": 0.01}), None),
    "model_svm": (_model_query("svm", {"regParam": 0.01, "maxIter": 50}), None),
    "model_svm_poly": (_model_query("svm_poly", {"regParam": 0.01, "maxIter": 50, "degree": 2}), None),
    "model_svm_rff": (_model_query("svm_rff", {"regParam": 0.01, "maxIter": 50, "n_features": 32}), None),
    "model_forest": (_model_query("forest", {"numTrees": 30, "maxDepth": 5}), None),
    "model_bagged": (_model_query("bagged", {"numTrees": 20, "maxDepth": 5}), None),
    "model_tree": (_model_query("tree", {"maxDepth": 5}), None),
    "model_gbt": (_model_query("gbt", {"maxIter": 10, "maxDepth": 3}), None),
    "model_c50": (_model_query("c50", {"maxIter": 10, "maxDepth": 2, "subsamplingRate": 0.8}), None),
    "model_lda_qda": (_model_query("qda", {"gamma": 0.1}), None),
    "model_lda": (_model_query("lda", {}), None),
    "search_random": (q_search_random, None),
    "search_lhs": (q_search_lhs, None),
    "search_grid": (q_search_grid, None),
    "workflow_set": (q_workflow_set, None),
    "finalize": (q_finalize, None),
    "batch_score": (q_batch_score, None),
    "stream_score": (q_stream_score, None),
}
