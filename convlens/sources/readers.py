"""Scans: schema'd CSV (no inference, ids stay strings), pruned Parquet, JSON
records under the 15-field contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.contracts import CONTRACT_SCHEMA, HITS_SCHEMA, MODEL_INPUT_COLUMNS, RAW_SESSIONS_SCHEMA


def read_sessions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw sessions CSV. The explicit schema keeps ids as strings (they look
    numeric) and avoids an inference pass over the whole file."""
    return (spark.read.schema(RAW_SESSIONS_SCHEMA).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def read_hits_csv(spark: SparkSession, path: str,
                  columns: tuple[str, ...] = ("session_id", "event_action")) -> DataFrame:
    """Hits CSV, reading only the label columns: the CSV reader prunes to the
    requested fields; file splits replace the chunk loop."""
    return (spark.read.schema(HITS_SCHEMA).option("header", True).csv(path)
            .select(*columns))


def read_parquet_projected(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet with projection: only ``columns`` appear in ``ReadSchema``."""
    return spark.read.parquet(path).select(*columns)


def records_to_contract(records: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON objects -> the contract frame: missing keys become NULL, extra keys
    are ignored, column order is fixed (session_id first, then the 15 inputs)."""
    parsed = records.select(F.from_json(F.col(json_col), CONTRACT_SCHEMA).alias("r"))
    return parsed.select(*[F.col(f"r.{c}").alias(c) for c in ("session_id", *MODEL_INPUT_COLUMNS)])


def read_records_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines visit records straight into the contract schema."""
    return spark.read.schema(CONTRACT_SCHEMA).json(path).select("session_id", *MODEL_INPUT_COLUMNS)
