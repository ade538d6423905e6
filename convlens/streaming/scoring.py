"""Continuous scoring of arriving visit records with Structured Streaming.

JSON-lines files land in a folder; each micro-batch is validated against the
input contract, scored by the fitted ``PipelineModel`` (a stateless
transform), and appended to a Parquet sink; rejected records go to their own
sink with reasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from convlens.operators.cleaning import validate_contract
from convlens.operators.modeling import score_batch


def score_stream(spark: SparkSession, in_path: str, model, threshold: float, version: str,
                 out_path: str, rejects_path: str, checkpoint: str, max_files: int | None = None) -> None:
    """``max_files`` bounds a micro-batch; by default all new files are one."""
    reader = spark.readStream.format("text")
    raw = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(in_path)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        # one folder per epoch, overwritten: a replayed epoch after a failure
        # rewrites the same files instead of appending duplicates
        if batch.isEmpty():
            return
        accepted, rejected = validate_contract(batch, "value")
        score_batch(model, accepted, threshold, version).write.mode("overwrite") \
            .parquet(f"{out_path}/epoch={epoch}")
        rejected.write.mode("overwrite").parquet(f"{rejects_path}/epoch={epoch}")

    (raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
