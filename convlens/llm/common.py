"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the lineage ends there and lost
    executors cost a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, as a URI that Arrow's file systems accept."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name one that no column of ``df`` has (case-insensitively), so helper columns never clash."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def marked(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, out: str, bits: int = 25) -> DataFrame:
    """``df`` with ``out``: false if ``key`` cannot be among ``wanted``, true for all that are and a few by chance (see ``thinned``)."""
    page, spot, bitmap = fresh(df, "page", "spot", "bitmap")
    place = lambda k: F.xxhash64(k).bitwiseAND(F.lit((1 << bits) - 1))
    pages = (wanted.select(place(wanted_key).alias(spot))
             .groupBy(F.shiftright(spot, 15).alias(page)).agg(F.bitmap_construct_agg(F.col(spot).bitwiseAND(F.lit(32767))).alias(bitmap)))
    at = df.withColumn(spot, place(key)).withColumn(page, F.shiftright(spot, 15)).withColumn(spot, F.col(spot).bitwiseAND(F.lit(32767)))
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(spot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, F.col(spot).bitwiseAND(F.lit(7)).cast("int"))
    return at.join(F.broadcast(pages), page, "left").select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias(out))


def thinned(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, bits: int = 25) -> DataFrame:
    """``df`` without rows whose ``key`` cannot be among ``wanted``: a filter before a join that would shuffle all of ``df``.

    The wanted keys are hashed into a bitmap of 2 ** ``bits`` bits, which is all that is broadcast, whatever the tables'
    sizes; what passes by chance is left to the join. The more keys, the less it filters; it never drops a wanted row.
    """
    page, spot, bitmap = fresh(df, "page", "spot", "bitmap")
    place = lambda k: F.xxhash64(k).bitwiseAND(F.lit((1 << bits) - 1))
    pages = (wanted.select(place(wanted_key).alias(spot))
             .groupBy(F.shiftright(spot, 15).alias(page)).agg(F.bitmap_construct_agg(F.col(spot).bitwiseAND(F.lit(32767))).alias(bitmap)))
    at = df.withColumn(spot, place(key)).withColumn(page, F.shiftright(spot, 15)).withColumn(spot, F.col(spot).bitwiseAND(F.lit(32767)))
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(spot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, F.col(spot).bitwiseAND(F.lit(7)).cast("int"))
    return at.join(F.broadcast(pages), page).where(bit == 1).select(*df.columns)
