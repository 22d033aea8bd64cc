"""Entry point A end to end: the clinical recipe fitted on the training
split and replayed on the held-out split (rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.resample import stratified_split
from ..sources.tables import codes, obs
from .training import clinical_recipe, roles


def clinical_frame(spark, sf):
    """obs with lesion codes attached by key (rows without codes keep nulls)."""
    o = obs(spark, sf).drop("const_col")
    c = codes(spark, sf)
    return o.join(c, "row_id", "left")


def q_scrub_fit(spark, sf):
    df = clinical_frame(spark, sf).where(F.col("outcome").isNotNull())
    split = stratified_split(df, "row_id", "outcome", 0.8, seed=9208).persist()  # read by both parts
    train = split.where("is_train").drop("is_train")
    test = split.where("NOT is_train").drop("is_train")
    num, cat = roles(train)
    fitted = clinical_recipe(num, cat).fit(train)
    return fitted.transform(test)


QUERIES = {"scrub_fit": (q_scrub_fit, None)}
