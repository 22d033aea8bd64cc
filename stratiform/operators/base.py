"""Fit / transform base classes with Parquet-stored state.

A ``Step`` learns from a DataFrame and returns a ``Fitted`` step, which
replays the learned state on new data. State is a small JSON parameter record
plus optional state tables; both are written with Spark writers, so saving
and loading work on any shared filesystem the cluster can read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from ..session import active_session, cached, caches_released

_REGISTRY: dict[str, type] = {}


def register(cls):
    _REGISTRY[cls.__name__] = cls
    return cls


class Fitted:
    """A fitted step: ``params`` (JSON-able) and ``tables`` (name -> DataFrame)."""

    def __init__(self, params: dict | None = None, tables: dict | None = None):
        self.params = params or {}
        self.tables = tables or {}

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def save(self, path: str) -> None:
        spark = active_session()
        record = json.dumps({"kind": type(self).__name__, "params": self.params,
                             "tables": sorted(self.tables)})
        (spark.createDataFrame([(record,)], "record string")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/_params"))
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Fitted":
        record = json.loads(spark.read.parquet(f"{path}/_params").first()["record"])
        cls = _REGISTRY[record["kind"]]
        obj = cls.__new__(cls)
        Fitted.__init__(obj, record["params"],
                        {n: spark.read.parquet(f"{path}/{n}") for n in record["tables"]})
        obj._after_load(spark, path)
        return obj

    def _after_load(self, spark, path):
        return None


class Step:
    """An estimator: ``fit(df) -> Fitted``.

    ``cut_lineage`` marks steps whose output plan is large (joins, shuffles);
    a recipe checkpoints their training output to the shared checkpoint
    folder so later steps plan and run against a short lineage."""

    train_only = False
    cut_lineage = False

    def fit(self, df: DataFrame) -> Fitted:  # pragma: no cover - abstract
        raise NotImplementedError


@register
class FittedExpressions(Fitted):
    """Stateless step: SQL expressions added or replacing columns."""

    def transform(self, df):
        return df.withColumns({k: F.expr(v) for k, v in self.params["exprs"].items()})


class Expressions(Step):
    """Z3: a stateless function as a pipeline step, given as SQL expressions."""

    def __init__(self, exprs: dict[str, str]):
        self.exprs = dict(exprs)

    def fit(self, df):
        return FittedExpressions({"exprs": self.exprs})


@register
class FittedRecipe(Fitted):
    """An ordered list of fitted steps; train-only steps are skipped on new data."""

    def __init__(self, steps: list[Fitted] | None = None, train_only: list[bool] | None = None):
        super().__init__({"train_only": train_only or []})
        self.steps = steps or []

    def transform(self, df):
        for step, train_only in zip(self.steps, self.params["train_only"]):
            if not train_only:
                df = step.transform(df)
        return df

    def save(self, path):
        spark = active_session()
        record = json.dumps({"kind": "FittedRecipe", "params": self.params, "tables": []})
        (spark.createDataFrame([(record,)], "record string")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/_params"))
        for i, step in enumerate(self.steps):
            step.save(f"{path}/step_{i:03d}")

    def _after_load(self, spark, path):
        self.steps = [Fitted.load(spark, f"{path}/step_{i:03d}")
                      for i in range(len(self.params["train_only"]))]


class Recipe(Step):
    """Ordered steps, each fitted on the output of the previous ones.

    ``persist_input`` caches the training input while fitting, so that each step's
    fitting job re-reads the cache instead of the source.
    """

    def __init__(self, steps: list, persist_input: bool = True):
        self.steps = steps
        self.persist_input = persist_input

    def fit(self, df):
        # Frames that a step's fit caches are of no use after it.
        with caches_released():
            return self._fit(df)

    def _fit(self, df):
        fitted, flags = [], []
        cur = cached(df) if self.persist_input else df
        for step in self.steps:
            f = step.fit(cur)
            out_df = getattr(f, "training_output", None)
            cur = out_df if out_df is not None else f.transform(cur)
            if getattr(step, "cut_lineage", False):
                cur = cur.checkpoint(eager=True)
            fitted.append(f)
            flags.append(bool(getattr(step, "train_only", False)))
        out = FittedRecipe(fitted, flags)
        out.training_output = cur
        return out


def fit_transform(step: Step, df: DataFrame) -> DataFrame:
    fitted = step.fit(df)
    out = getattr(fitted, "training_output", None)
    return out if out is not None else fitted.transform(df)


ROWS_PER_PARTITION = 500_000
#: Of a partition that an iterative trainer holds and reads once a pass.
PARTITION_BYTES = 64 << 20


def partitions_for(rows: int, width: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partitions for ``rows`` of ``width`` numbers: bounded by rows and by bytes."""
    return max(1, -(-rows // max(1, min(rows_per_partition, PARTITION_BYTES // (8 * max(1, width))))))


def right_size(df: DataFrame, rows: int | None = None,
               rows_per_partition: int = ROWS_PER_PARTITION, width: int | None = None) -> DataFrame:
    """Narrow ``coalesce`` to about one partition per ``rows_per_partition``
    rows or ``PARTITION_BYTES``, never more partitions than now; ``width`` is
    the numbers a row, by default its columns. Iterative trainers run one job per
    iteration, so tiny partitions cost scheduling time on every pass; at
    large sizes this leaves the partitioning unchanged."""
    n = df.count() if rows is None else rows
    want = partitions_for(n, width or len(df.columns), rows_per_partition)
    have = df.rdd.getNumPartitions()
    return df.coalesce(want) if want < have else df
