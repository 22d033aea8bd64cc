"""Saved state and batch scoring.

Training writes the fitted recipe and the model under one directory; scoring
loads both, applies the recipe (train-only steps skipped) and the model in one
plan, keeps the row key as a pass-through column and decodes the class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import map_lookup
from .base import Fitted


def save_trained(path: str, recipe: Fitted | None, model: Fitted) -> None:
    """S4 + S5: one directory holding ``recipe/`` (if any) and ``model/``."""
    if recipe is not None:
        recipe.save(f"{path}/recipe")
    model.save(f"{path}/model")


def load_trained(spark: SparkSession, path: str, with_recipe: bool = True):
    recipe = Fitted.load(spark, f"{path}/recipe") if with_recipe else None
    return recipe, Fitted.load(spark, f"{path}/model")


def score(df: DataFrame, recipe: Fitted | None, model: Fitted, key: str = "row_id",
          class_names: dict | None = None, keep_probabilities: bool = True) -> DataFrame:
    """K1-K3: predicted class (and names and probabilities) per key."""
    prepared = recipe.transform(df) if recipe is not None else df
    out = model.transform(prepared)
    cols = [key, F.col("prediction").cast("int").alias("prediction")]
    if class_names:
        cols.append(map_lookup(F.col("prediction").cast("int"), class_names).alias("outcome"))
    if keep_probabilities:
        cols += sorted(c for c in out.columns if c.startswith("prob_"))
    return out.select(*cols)
