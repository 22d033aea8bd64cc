"""The three entry points of the studied pipeline as single calls.

A ``train_and_save``: sources -> union with new keys -> drop null labels ->
  distinct rows -> stratified split -> clinical recipe -> model search with
  leak-free folds -> refit of the best configuration -> evaluation on the
  held-out rows -> saved recipe and model.
B ``classify_csv``: CSV of new rows -> saved recipe and model -> (id, outcome)
  CSV written by the executors.
C ``explore``: the exploratory profile tables (numeric summary, top levels,
  bar counts, histograms, correlations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import vocab
from ..operators import search as S
from ..operators.models import Classifier
from ..operators.profile import (correlation_long, histogram, level_counts, numeric_summary,
                                 top_levels)
from ..operators.recode import decode_outcome, distinct_rows, encode_outcome
from ..operators.resample import stratified_folds, stratified_split
from ..operators.score import load_trained, save_trained, score
from ..session import caches_released, materialise
from ..sources.files import append_with_new_keys, read_csv, write_csv
from .training import clinical_recipe, roles


def combine_sources(first: DataFrame, second: DataFrame | None, key: str = "id",
                    order_col: str | None = None) -> DataFrame:
    """U1 + S2: the second (keyless) source gets keys after the first's."""
    if second is None:
        return first
    if key in second.columns:
        return first.unionByName(second)
    return append_with_new_keys(first, second, key, order_col)


def train_and_save(train_df: DataFrame, model_dir: str, key: str = "id",
                   label: str = "outcome", candidates: list[tuple[str, str, dict]] | None = None,
                   folds: int = 4, train_fraction: float = 0.8, seed: int = 9208,
                   metric: str = "f1", parallelism: int = 4, drop: tuple = ("cp_data",)) -> dict:
    """Entry point A. Returns the search summary, the chosen configuration
    and the held-out metrics; the fitted recipe and model are saved. Only
    configurations fitted on every fold are ranked; ``durations`` has the
    errors of the others. Nothing stays cached."""
    with caches_released():
        return _train_and_save(train_df, model_dir, key, label, candidates, folds, train_fraction, seed, metric, parallelism, drop)


def _train_and_save(train_df, model_dir, key, label, candidates, folds, train_fraction, seed, metric, parallelism, drop):
    df = train_df.drop(*[c for c in drop if c in train_df.columns])
    df = distinct_rows(df.where(F.col(label).isNotNull()), key)
    split = materialise(stratified_split(df, key, label, train_fraction, seed=seed), "split")
    train = split.where("is_train").drop("is_train")
    test = split.where("NOT is_train").drop("is_train")
    num, cat = roles(train, label=label, key=key)

    def recipe():
        return clinical_recipe(num, cat, label=label, key=key)

    folded = stratified_folds(train, key, label, k=folds, seed=seed)
    candidates = candidates or (
        [("logistic", "logistic", p) for p in S.latin_hypercube(S.SPACES["logistic"], 4, seed)]
        + [("naive_bayes", "naive_bayes", p) for p in S.latin_hypercube(S.SPACES["naive_bayes"], 2, seed)])
    # each fold fits its own recipe; features are what that recipe produced
    long, durations = S.cross_validate(folded, "fold", None, label, candidates, recipe,
                                       parallelism=parallelism, key=key)
    summary = S.summarise(long)
    best = S.summarise(long, folds).where(F.col("metric") == metric) \
        .orderBy(F.col("mean").desc(), F.col("model"), F.col("config")).first()
    if best is None:
        raise RuntimeError("no configuration was fitted on every fold: "
                           + "; ".join(sorted({r["error"] for r in durations if r["error"]}))[:2000])
    configs = {}
    for name, kind, params in candidates:
        configs.setdefault(name, []).append((kind, params))
    kind, params = configs[best["model"]][best["config"]]
    fitted, model, held_out = S.finalize(train, test, None, label, kind, params, recipe, key=key)
    save_trained(model_dir, fitted, model)
    return {"summary": summary, "best": (best["model"], best["config"], kind, params),
            "held_out": held_out, "durations": durations}


def classify_csv(spark: SparkSession, model_dir: str, in_path: str, schema: StructType,
                 out_path: str, key: str = "id", label: str = "outcome") -> DataFrame:
    """Entry point B: score a CSV with saved state and write (id, outcome)."""
    new = read_csv(spark, in_path, schema)
    new = new.drop(*[c for c in ("cp_data", label) if c in new.columns])
    recipe, model = load_trained(spark, model_dir)
    scored = score(new, recipe, model, key=key, keep_probabilities=False)
    out = decode_outcome(scored, "prediction", label).select(key, label)
    write_csv(out, out_path)
    return out


def explore(df: DataFrame, label: str = "outcome", key: str = "id") -> dict:
    """Entry point C: the exploratory profile tables of a frame."""
    num, cat = roles(df, label=label, key=key)
    coded = encode_outcome(df, label, "outcome_num") if label in df.columns else df
    level_num = {lv: float(i + 1) for i, lv in enumerate(vocab.OUTCOME_LEVELS)}
    from ..functions.columns import map_lookup
    if label in df.columns:
        coded = coded.withColumn("outcome_num", map_lookup(label, level_num).cast("double"))
    corr_cols = num + (["outcome_num"] if label in df.columns else [])
    return {
        "numeric_summary": numeric_summary(df, num),
        "top_levels": top_levels(df, cat + ([label] if label in df.columns else []), k=6),
        "bar_counts": level_counts(df, cat + ([label] if label in df.columns else [])),
        "histograms": histogram(df, num, bins=30),
        "correlations": correlation_long(coded, corr_cols, complete_rows=True),
    }
