"""Helpers shared by the operators: table access, stored intermediates, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read by Spark (any file system it knows)."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors and makes row ids made by
    ``monotonically_increasing_id`` stable."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a ``stored`` table that nothing needs any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


#: Largest batch that goes to a Python worker. Rows are whole texts, so rows alone bound nothing.
BATCH_BYTES = 6 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_BYTES``; a smaller setting stays."""
    held = spark.conf.get(_BATCH_KEY, None)
    if held is None or not held.isdigit() or int(held) > BATCH_BYTES or int(held) <= 0:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty results are skipped."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def utf8_bytes(text):
    """Number of UTF-8 bytes of a text column, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
