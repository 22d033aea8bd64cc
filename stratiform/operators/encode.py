"""Level state, factor indexing and indicator encodings.

No level is cut off by default. Indicator columns come from a level list,
which a caller may bound with ``max_levels``; the levels beyond it then share a
real ``<col>_other`` column. Identifier-like columns, whose levels grow with
the data, are encoded as one sparse vector from a level table that is joined
(``SparseOneHot``), and factor codes come from such a table as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import active_session
from .base import Fitted, Step, register


def _level_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"))
        for c in cols])).alias("kv")).select("kv.*").where(F.col("level").isNotNull())
    return long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))


def learn_levels(df: DataFrame, cols: list[str], max_levels: int | None = None,
                 min_count: int = 1) -> dict[str, list[str]]:
    """Sorted levels of each column; with ``max_levels`` the most frequent ones.
    They become output columns, so they are wanted on the driver."""
    if not cols:
        return {}
    kept = _level_counts(df, cols).where(F.col("n") >= min_count)
    if max_levels is not None:
        w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("level").asc())
        kept = kept.withColumn("r", F.row_number().over(w)).where(F.col("r") <= max_levels)
    levels = {c: [] for c in cols}
    for r in kept.select("variable", "level").collect():
        levels[r["variable"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def level_codes(df: DataFrame, cols: list[str], order: dict[str, list[str]] | None = None) -> DataFrame:
    """(variable, level, code): position of each level in its column's sorted
    levels, or in the given order. Codes come from bucketed ranks, so a column
    may have any number of levels."""
    from .ranks import string_positions
    order = order or {}
    learned = [c for c in cols if c not in order]
    given = active_session().createDataFrame(
        [(c, lv, i) for c in cols if c in order for i, lv in enumerate(order[c])],
        "variable string, level string, code int")
    if not learned:
        return given
    found = string_positions(_level_counts(df, learned).select("variable", "level"), "variable", "level")
    return found.select("variable", "level", (F.col("position") - 1).cast("int").alias("code")).unionByName(given)


def with_codes(df: DataFrame, codes: DataFrame, cols: list[str], suffix: str) -> DataFrame:
    """Adds ``<col><suffix>`` by a left join with each column's level table (a
    plain join: broadcast by Spark when the table is small)."""
    for c in cols:
        one = codes.where(F.col("variable") == c).select(F.col("level").alias("__level"), F.col("code").alias(f"{c}{suffix}"))
        df = df.join(one, F.col(c).cast("string") == F.col("__level"), "left").drop("__level")
    return df


def _safe(level: str) -> str:
    return "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in str(level))


@register
class FittedIndicators(Fitted):
    def transform(self, df):
        levels, drop_first = self.params["levels"], self.params["drop_first"]
        cols = {}
        for c, lv in levels.items():
            use = lv[1:] if drop_first else lv
            for level in use:
                cols[f"{c}_{_safe(level)}"] = F.coalesce(
                    (F.col(c).cast("string") == F.lit(level)).cast("int"), F.lit(0))
            if c in self.params.get("other", []):
                cols[f"{c}_other"] = F.coalesce((~F.col(c).cast("string").isin(lv)).cast("int"), F.lit(0))
        out = df.withColumns(cols)
        return out.drop(*levels.keys()) if self.params["drop_input"] else out


class OneHot(Step):
    """One 0/1 column per training level, named ``<col>_<level>``; unseen
    levels and null give all zeros. With ``max_levels`` or ``min_count``, every
    level that has no column of its own, seen or not, is ``<col>_other``."""

    def __init__(self, cols: list[str], max_levels: int | None = None, min_count: int = 1,
                 drop_input: bool = True):
        self.cols, self.max_levels, self.min_count = cols, max_levels, min_count
        self.drop_input = drop_input
        self.drop_first = False

    def fit(self, df):
        bounded = self.max_levels is not None or self.min_count > 1
        return FittedIndicators({"levels": learn_levels(df, self.cols, self.max_levels,
                                                        self.min_count),
                                 "other": list(self.cols) if bounded else [],
                                 "drop_first": self.drop_first,
                                 "drop_input": self.drop_input})


class Dummy(OneHot):
    """K-1 indicator columns; the alphabetically first level is the reference."""

    def __init__(self, cols, max_levels=None, min_count=1, drop_input=True):
        super().__init__(cols, max_levels, min_count, drop_input)
        self.drop_first = True


@register
class FittedSparseOneHot(Fitted):
    def transform(self, df):
        from pyspark.ml.feature import OneHotEncoder
        cols = self.params["cols"]
        names = [f"{c}__code" for c in cols]
        coded = with_codes(df, self.tables["codes"], cols, "__code")
        for c, n in zip(cols, names):      # null and unseen levels: one past the last, which has no slot
            coded = coded.withColumn(n, F.coalesce(n, F.lit(self.params["sizes"][c])).cast("double"))
        spark = active_session()
        sizes = spark.createDataFrame([tuple(float(self.params["sizes"][c]) for c in cols)],
                                      ", ".join(f"`{n}` double" for n in names))
        encoder = OneHotEncoder(inputCols=names, outputCols=[f"{c}_vec" for c in cols], dropLast=True).fit(sizes)
        out = encoder.transform(coded).drop(*names)
        return out.drop(*cols) if self.params["drop_input"] else out


class SparseOneHot(Step):
    """E1 for columns with very many levels: one sparse vector ``<col>_vec`` with a
    slot for every training level in sorted order; unseen and null give zeros.
    The level table is state and is joined, so nothing is cut off and no plan or
    driver grows with the levels."""

    def __init__(self, cols: list[str], drop_input: bool = True):
        self.cols, self.drop_input = cols, drop_input

    def fit(self, df):
        codes = level_codes(df, self.cols).checkpoint(eager=True)
        n = {r["variable"]: r["n"] for r in codes.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
        return FittedSparseOneHot({"cols": self.cols, "sizes": {c: n.get(c, 0) for c in self.cols},
                                   "drop_input": self.drop_input}, {"codes": codes})


@register
class FittedFactor(Fitted):
    def transform(self, df):
        return with_codes(df, self.tables["codes"], self.params["cols"], self.params["suffix"])


class Factor(Step):
    """Factor conversion; code = position in the sorted level list
    (alphabetical unless ``order`` is given), null and unseen give null. The
    level table is joined and has every training level."""

    def __init__(self, cols: list[str], order: dict[str, list[str]] | None = None,
                 suffix: str = "_index"):
        self.cols, self.order, self.suffix = cols, order or {}, suffix

    def fit(self, df):
        codes = level_codes(df, self.cols, self.order).checkpoint(eager=True)
        return FittedFactor({"cols": self.cols, "suffix": self.suffix}, {"codes": codes})
