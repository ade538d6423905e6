"""Sinks: phase tables as Parquet, statistics as JSON DataFrames, model artifacts
through Spark ML persistence."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_phase_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a phase table. ``dataset`` is partitioned by visit month so date
    slices prune files."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "session_id", buckets: int = 64,
                   partition_by: list[str] | None = None) -> DataFrame:
    """A phase table hashed into sorted buckets by ``key``, at ``path`` and under ``name``. Joins and aggregates of such tables by the key
    need no exchange (and full-row de-duplication none, as equal rows share a bucket). The rows are dealt out once here, so there is one file per
    bucket (and partition)."""
    w = df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def with_visit_month(df: DataFrame, date_col: str = "visit_date") -> DataFrame:
    return df.withColumn("visit_ym", F.date_format(F.col(date_col), "yyyy-MM"))


def write_stats(df: DataFrame, path: str) -> None:
    """A statistics DataFrame as JSON lines (one small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def stats_row(spark: SparkSession, payload: dict) -> DataFrame:
    """One-row DataFrame holding a metadata dict as JSON text (model metadata)."""
    return spark.createDataFrame([(json.dumps(payload, ensure_ascii=False, sort_keys=True),)], "meta string")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
