"""CSV / Parquet sources and sinks, and source union with new keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.ranks import row_numbers


def read_csv(spark: SparkSession, path: str, schema: StructType,
             null_value: str = "NA") -> DataFrame:
    """CSV with header and an explicit schema. ``NA`` is null, the text
    ``None`` stays a level, and empty strings become null."""
    df = (spark.read.schema(schema).option("header", True)
          .option("nullValue", null_value).option("mode", "FAILFAST").csv(path))
    fixes = {f.name: F.when(F.col(f.name) == "", F.lit(None)).otherwise(F.col(f.name))
             for f in schema.fields if isinstance(f.dataType, StringType)}
    return df.withColumns(fixes)


def write_csv(df: DataFrame, path: str, null_value: str = "NA") -> None:
    """S3: header, unquoted text, nulls written as ``NA``; written by executors."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", null_value)
     .option("quoteAll", False).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def union_sources(first: DataFrame, second: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (strict unless ``allow_missing``)."""
    return first.unionByName(second, allowMissingColumns=allow_missing)


def append_with_new_keys(first: DataFrame, second: DataFrame, key: str,
                         order_col: str) -> DataFrame:
    """Give the keyless second source keys ``max(first.key) + position``,
    position being the 1-based order of ``order_col`` (unique) in the second
    source; numbering is bucketed (no single-partition window)."""
    top = first.agg(F.max(key).alias("m")).first()["m"]
    base = -1 if top is None else int(top)
    numbered = row_numbers(second, order_col, out="__pos")
    keyed = numbered.withColumn(key, F.lit(base) + F.col("__pos")).drop("__pos")
    return first.unionByName(keyed.select(*first.columns))


def set_partitions(df: DataFrame, n: int | None = None, *cols: str) -> DataFrame:
    """Explicit partition count (by key when given); None leaves it to AQE."""
    if n is None:
        return df
    return df.repartition(n, *cols) if cols else df.repartition(n)
