"""Level harmonisation, level codes, outcome codes, masked overwrite and the
unseen-level fallback (P5, P6, P7, P10, J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.columns import map_lookup
from ..session import materialise
from .base import Fitted, Step, register


def harmonise(df: DataFrame, rules=vocab.HARMONISE_RULES) -> DataFrame:
    """P5: apply ordered exact-match replace rules once, as one lookup per column."""
    cols = {}
    for c in dict.fromkeys(r[0] for r in rules):
        if c in df.columns:
            cols[c] = map_lookup(c, vocab.collapse_rules(rules, c), keep_unmapped=True)
    return df.withColumns(cols)


def encode_levels(df: DataFrame, dictionaries=vocab.LEVEL_CODES, suffix: str = "") -> DataFrame:
    """Category level -> integer code; unmapped levels and null give null."""
    cols = {f"{c}{suffix}": map_lookup(c, m).cast("int")
            for c, m in dictionaries.items() if c in df.columns}
    return df.withColumns(cols)


def encode_outcome(df: DataFrame, col: str = "outcome", out: str | None = None) -> DataFrame:
    """Died 2, euthanized 1, lived 0."""
    return df.withColumn(out or col, map_lookup(col, vocab.OUTCOME_CODES).cast("int"))


def decode_outcome(df: DataFrame, col: str = "prediction", out: str = "outcome") -> DataFrame:
    inverse = {v: k for k, v in vocab.OUTCOME_CODES.items()}
    return df.withColumn(out, map_lookup(F.col(col).cast("int"), inverse))


def overwrite_where(df: DataFrame, col: str, condition, value) -> DataFrame:
    """P10: replace ``col`` by ``value`` where ``condition`` holds."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    val = value if hasattr(value, "alias") else F.lit(value)
    return df.withColumn(col, F.when(cond, val).otherwise(F.col(col)))


def move_last(df: DataFrame, col: str) -> DataFrame:
    """Move one column to the end."""
    return df.select(*[c for c in df.columns if c != col], col)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns by position."""
    return df.toDF(*names)


def frequency_table(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """A1: value counts of ``col`` (nulls excluded), most frequent first,
    ties broken by the smaller value. The order is a distributed sort."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), F.col(col).asc()))


def mode_of(df: DataFrame, col: str):
    """Most frequent non-null value (ties: smallest); top-1 of a sorted
    aggregate, planned as a per-partition top-k, never a global collect."""
    row = frequency_table(df, col).limit(1).first()
    return None if row is None else row[col]


@register
class FittedUnseenFallback(Fitted):
    def transform(self, df):
        col = self.params["col"]
        levels = self.tables["levels"].select(F.col(col).alias("__lvl"),
                                              F.lit(True).alias("__known"))
        # AQE turns this into a broadcast join when the level table is small
        joined = df.join(levels, df[col] == levels["__lvl"], "left")
        fallback = F.lit(self.params["most_frequent"])
        return (joined.withColumn(col, F.when(F.col("__known") | F.col(col).isNull(), F.col(col))
                                  .otherwise(fallback))
                .drop("__lvl", "__known"))


class UnseenFallback(Step):
    """Levels not seen in training are replaced by the training mode."""

    def __init__(self, col: str):
        self.col = col

    def fit(self, df):
        freq = (df.where(F.col(self.col).isNotNull())
                .groupBy(self.col).agg(F.count(F.lit(1)).alias("freq")))
        freq = materialise(freq, "levels")      # read by every later transform
        top = freq.orderBy(F.col("freq").desc(), F.col(self.col).asc()).limit(1).first()
        return FittedUnseenFallback(
            {"col": self.col, "most_frequent": None if top is None else top[self.col]},
            {"levels": freq})


@register
class FittedHarmonise(Fitted):
    def transform(self, df):
        return harmonise(df, [tuple(r) for r in self.params["rules"]])


class Harmonise(Step):
    def __init__(self, rules=vocab.HARMONISE_RULES):
        self.rules = [list(r) for r in rules]

    def fit(self, df):
        return FittedHarmonise({"rules": self.rules})


@register
class FittedLevelCodes(Fitted):
    def transform(self, df):
        return encode_levels(df, self.params["dictionaries"])


class LevelCodes(Step):
    def __init__(self, dictionaries=vocab.LEVEL_CODES):
        self.dictionaries = dictionaries

    def fit(self, df):
        return FittedLevelCodes({"dictionaries": self.dictionaries})


class DropDuplicates(Step):
    """U2 as a train-only recipe step (distinct rows ignoring the key)."""

    train_only = True
    cut_lineage = True

    def __init__(self, key: str = "row_id"):
        self.key = key

    def fit(self, df):
        return FittedDistinct({"key": self.key})


@register
class FittedDistinct(Fitted):
    def transform(self, df):
        return distinct_rows(df, self.params["key"])


def distinct_rows(df: DataFrame, key: str = "row_id") -> DataFrame:
    """One row per distinct value tuple (nulls equal), keeping the smallest
    key. A hash aggregate with map-side partial aggregation."""
    others = [c for c in df.columns if c != key]
    if key not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*others).agg(F.min(key).alias(key)).select(*df.columns)


@register
class FittedOutcomeCodes(Fitted):
    def transform(self, df):
        col = self.params["col"]
        if col not in df.columns:
            return df
        return move_last(encode_outcome(df, col), col)


class OutcomeCodes(Step):
    """P7 + P8 as a recipe step: outcome -> code, moved to the last column."""

    def __init__(self, col: str = "outcome"):
        self.col = col

    def fit(self, df):
        return FittedOutcomeCodes({"col": self.col})


@register
class FittedLesionFeatures(Fitted):
    def transform(self, df):
        from ..functions import lesion as L
        cols = [c for c in self.params["cols"] if c in df.columns]
        if not cols:
            return df
        decoded = L.lesion_first(cols[0]) if self.params["policy"] == "first" \
            else L.lesion_max_site(cols)
        out = df.withColumn("num_lesions", L.lesion_count(cols)).withColumn("__lesion", decoded)
        out = out.withColumns({n: F.col("__lesion").getField(f).cast("string") for n, f in
                               zip(L.DECODED, ["site", "type", "subtype", "code"])})
        if self.params["labels"]:
            lab = L.lesion_labels(F.col("__lesion"))
            out = out.withColumns({n: lab.getField(f) for n, f in
                                   zip(L.DECODED, ["site", "type", "subtype", "code"])})
        return out.drop("__lesion", *cols)


class LesionFeatures(Step):
    """L1-L4 as a recipe step: lesion count plus the four decoded parts as
    categorical columns; the raw code columns are dropped."""

    def __init__(self, cols=("lesion_1", "lesion_2", "lesion_3"), policy: str = "max_site",
                 labels: bool = True):
        self.cols, self.policy, self.labels = list(cols), policy, labels

    def fit(self, df):
        return FittedLesionFeatures({"cols": self.cols, "policy": self.policy, "labels": self.labels})
