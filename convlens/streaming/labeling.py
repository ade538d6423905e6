"""Incremental labelling with Structured Streaming.

Hits arrive as files; each micro-batch keeps target actions only. ``converted_once`` holds the ids that it has given out as keyed
state, so an id is given out once, in whichever batch and however late its first conversion arrives: there is no watermark,
and nothing is dropped for its age. ``retention`` bounds the state: an id not seen for that long (of processing time) is forgotten,
and given out again if it comes back later; readers that take distinct ids lose nothing by it. Each batch is written to a
folder of its own, overwritten when the batch is replayed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from convlens.contracts import DEFAULT_CONFIG, ConversionConfig


def hits_stream(spark: SparkSession, path: str, schema, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Hit files of a folder as a stream; ``max_files`` bounds a micro-batch, by default all new files are one."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def converted_sessions_stream(hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG, key: str = "session_id",
                              action: str = "event_action") -> DataFrame:
    """Streaming DataFrame of session ids with a target action, one row per hit."""
    return hits.where(F.col(action).isin(list(cfg.target_actions)) & F.col(key).isNotNull()).select(key)


def converted_once(hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG, key: str = "session_id", action: str = "event_action",
                   retention: int | None = None) -> DataFrame:
    """Streaming DataFrame that gives out every converted session id once. ``retention``: for how many milliseconds after
    its last conversion an id is remembered; None: for ever. Age is counted from the arrival of a batch, not from a hit's own
    time, so no hit is late."""
    def apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # a hot session leaves a task a few times, not with all its hits
            yield batch.drop_duplicates()

    ids = converted_sessions_stream(hits, cfg, key, action).select(F.col(key).cast("string").alias(key))
    if retention is None:  # nothing times out: Spark's own state, no Python call per id
        return ids.mapInPandas(apart, f"`{key}` string").dropDuplicates([key])

    def once(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        for _ in batches:
            pass
        if not state.exists:
            yield pd.DataFrame({key: [k[0]]})
        state.update((True,))
        state.setTimeoutTimestamp(max(state.getCurrentProcessingTimeMs(), state.getCurrentWatermarkMs()) + retention)

    ids = ids.select(key, F.current_timestamp().alias("arrival")).mapInPandas(apart, f"`{key}` string, arrival timestamp").withWatermark("arrival", "0 seconds")
    return ids.groupBy(key).applyInPandasWithState(once, f"`{key}` string", "given boolean", "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(stream_df: DataFrame, out_path: str, checkpoint: str, query_name: str | None = None) -> None:
    """Process everything available now and stop; a failed batch raises."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    w = stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    w.start().awaitTermination()


def read_converted(spark: SparkSession, out_path: str, key: str = "session_id") -> DataFrame:
    return spark.read.schema(f"`{key}` string").parquet(out_path).select(key)
