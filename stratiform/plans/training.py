"""The canonical clinical preparation recipe (training entry point A).

Order: harmonise levels -> lesion features -> unseen-level fallback -> KNN
imputation of numeric columns -> distinct rows (train only) -> mode
imputation of categorical columns -> distinct rows (train only) -> one-hot ->
drop constant -> drop correlated -> log1p on skewed columns -> z-score ->
outcome codes last. Every step is fitted on the training rows only.

No level is cut off: columns named in ``identifiers`` (by default the hospital
number, whose levels grow with the data) become one sparse vector with a slot
for every training level, the others one column per level. The imputers and the
skew transform are options, as the studied variants differ in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import vocab
from ..operators.base import Recipe
from ..operators.encode import OneHot, SparseOneHot
from ..operators.impute import KNNImputer, MeanImputer, MedianImputer, ModeImputer
from ..operators.normalize import Log1p, LogShift, OrderedQuantile, ZScore
from ..operators.recode import (DropDuplicates, Harmonise, LesionFeatures, OutcomeCodes,
                                UnseenFallback)
from ..operators.select import DropConstant, DropCorrelated


def roles(df: DataFrame, label: str = "outcome", key: str = "row_id",
          drop: tuple = ("cp_data",), force_categorical: tuple = ("hospital_number",)):
    """(numeric, categorical) columns from the schema plus overrides."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in (label, key) or f.name in drop:
            continue
        t = f.dataType.simpleString()
        if f.name in force_categorical or t == "string":
            cat.append(f.name)
        elif t in ("double", "float", "int", "bigint", "smallint"):
            num.append(f.name)
    return num, cat


class _Indicators(OneHot):
    """One-hot over the categorical columns known at fit time."""

    def __init__(self, cats_fn):
        super().__init__([])
        self.cats_fn = cats_fn

    def fit(self, df):
        self.cols = [c for c in self.cats_fn(df) if c in df.columns]
        return super().fit(df)


class _Later:
    """A step whose column list is decided on the data it is fitted on."""

    def __init__(self, make):
        self.make = make
        self.train_only = False

    def fit(self, df):
        return self.make(df).fit(df)


#: Numeric imputers: exact neighbours, medians or means of numbers and category codes.
IMPUTERS = ("knn", "median", "mean")
#: Skew transforms: ln(1 + x), ln(x + C), ordered quantiles, or none.
SKEW = ("log1p", "log_shift", "ordered_quantile", "none")


def clinical_recipe(num_cols: list[str], cat_cols: list[str], label: str = "outcome",
                    key: str = "row_id", k: int = 10, corr_threshold: float = 0.75,
                    impute: str = "knn", skew: str = "log1p",
                    identifiers: tuple = ("hospital_number",)) -> Recipe:
    if impute not in IMPUTERS or skew not in SKEW:
        raise ValueError(f"impute must be one of {IMPUTERS}, skew one of {SKEW}")
    lesion_cols = [c for c in ("lesion_1", "lesion_2", "lesion_3") if c in num_cols + cat_cols]
    num = [c for c in num_cols if c not in lesion_cols] + (["num_lesions"] if lesion_cols else [])
    cats = [c for c in cat_cols if c not in lesion_cols] + \
        (["lesion_site", "lesion_type", "lesion_subtype", "lesion_code"] if lesion_cols else [])
    steps = [Harmonise()]
    if lesion_cols:
        steps.append(LesionFeatures(lesion_cols))
    if "hospital_number" in cats:
        steps.append(UnseenFallback("hospital_number"))
    imputer = KNNImputer(num, k=k, key=key) if impute == "knn" else \
        MedianImputer(num) if impute == "median" else MeanImputer(num)
    ids = [c for c in cats if c in identifiers]
    steps += [imputer, DropDuplicates(key), ModeImputer(cats), DropDuplicates(key),
              _Indicators(lambda df: [c for c in cats if c not in ids])]
    if ids:
        steps.append(SparseOneHot(ids))

    def features_now(df):
        return [c for c in df.columns if c not in (key, label) and c not in [f"{i}_vec" for i in ids]]

    steps.append(_Later(lambda df: DropConstant(features_now(df))))
    steps.append(_Later(lambda df: DropCorrelated(features_now(df), corr_threshold, "upper")))
    skewed = [c for c in vocab.SKEWED_COLUMNS if c in num]
    if skew != "none":
        steps.append(_Later(lambda df: {"log1p": Log1p, "log_shift": LogShift, "ordered_quantile": OrderedQuantile}[skew](
            [c for c in skewed if c in df.columns])))
    steps.append(_Later(lambda df: ZScore(features_now(df))))
    steps.append(OutcomeCodes(label))
    return Recipe(steps)
