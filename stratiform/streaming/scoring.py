"""Scoring a stream of new rows with saved state (K1 on Structured Streaming).

The fitted recipe may contain steps that aggregate or join (KNN imputation,
fallback tables), so each micro-batch is scored as a static DataFrame inside
``foreachBatch``; output paths carry the batch id, so a replayed batch after
a failure overwrites its own output (idempotent sink). The checkpoint lives
under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..operators.score import load_trained, score
from ..session import scratch_path


def start_scoring_stream(spark: SparkSession, model_dir: str, source_dir: str,
                         schema: StructType, sink_dir: str, key: str = "row_id",
                         class_names: dict | None = None, with_recipe: bool = True,
                         checkpoint: str | None = None, once: bool = True):
    recipe, model = load_trained(spark, model_dir, with_recipe)
    checkpoint = checkpoint or scratch_path(spark, "scoring-stream")

    def write_batch(batch_df, batch_id):
        scored = score(batch_df, recipe, model, key, class_names)
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()
