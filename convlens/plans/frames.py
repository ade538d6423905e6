"""Shared logical plans over the test tables: raw sessions -> labelled,
cleaned ``dataset`` -> EDA frame. Each is lazy; Catalyst prunes the columns a
query does not touch (including the visit-number windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.operators import cleaning, labeling, slices
from convlens.sources import testdata as td

CFG = td.testdata_config()


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return td.raw_sessions(spark, sf)


def hits(spark: SparkSession, sf: str) -> DataFrame:
    return td.raw_hits(spark, sf)


def status_hits(spark: SparkSession, sf: str) -> DataFrame:
    return td.raw_status_hits(spark, sf)


def target(spark: SparkSession, sf: str) -> DataFrame:
    return labeling.target_table(sessions(spark, sf), hits(spark, sf), CFG)


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned, labelled visit table."""
    positives = labeling.target_sessions(hits(spark, sf), CFG).withColumn("target", F.lit(1))
    return cleaning.clean(sessions(spark, sf), positives, CFG)


def eda(spark: SparkSession, sf: str) -> DataFrame:
    return slices.eda_frame(dataset(spark, sf), CFG)
