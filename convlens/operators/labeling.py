"""Session labels and key-existence joins (sessions <-> hits).

Every join side that can repeat a key is reduced to distinct keys first: the
partial aggregate runs map-side, so a session with a third of all hits
collapses to one row before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.contracts import DEFAULT_CONFIG, ConversionConfig


def target_sessions(hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                    key: str = "session_id", action: str = "event_action") -> DataFrame:
    """Distinct sessions with at least one target action (NULL ids ignored).
    The ``isin`` filter is pushed to the scan."""
    return (hits.where(F.col(action).isin(list(cfg.target_actions)) & F.col(key).isNotNull())
            .select(key).distinct())


def hit_sessions(hits: DataFrame, key: str = "session_id") -> DataFrame:
    return hits.where(F.col(key).isNotNull()).select(key).distinct()


def label_sessions(sessions: DataFrame, hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                   key: str = "session_id", action: str = "event_action") -> DataFrame:
    """``target = 1`` iff the session has a hit whose action is in the target set.
    Every session gets a row; AQE picks broadcast vs sort-merge from the runtime
    size of the distinct-id side."""
    pos = target_sessions(hits, cfg, key, action).withColumn("_hit", F.lit(1))
    return (sessions.join(pos, on=key, how="left")
            .withColumn("target", F.coalesce(F.col("_hit"), F.lit(0)).cast("int"))
            .drop("_hit"))


def target_table(sessions: DataFrame, hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                 key: str = "session_id") -> DataFrame:
    """``target_by_session``: one (session_id, target) row for every session."""
    return label_sessions(sessions.select(key), hits, cfg, key)


def left_join_fill(df: DataFrame, labels: DataFrame, key: str = "session_id",
                   col: str = "target", fill: int = 0) -> DataFrame:
    """Left join a label table, missing -> ``fill``."""
    lab = labels.select(key, F.col(col).alias("_lab"))
    return (df.drop(col).join(lab, on=key, how="left")
            .withColumn(col, F.coalesce(F.col("_lab"), F.lit(fill)).cast("int")).drop("_lab"))


def sessions_without_hits(sessions: DataFrame, hits: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions with no hit at all (anti join)."""
    return sessions.join(hit_sessions(hits, key), on=key, how="left_anti")


def sessions_with_hits(sessions: DataFrame, hits: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions with at least one hit (semi join against distinct hit ids)."""
    return sessions.join(hit_sessions(hits, key), on=key, how="left_semi")


def orphan_hit_sessions(sessions: DataFrame, hits: DataFrame, key: str = "session_id") -> DataFrame:
    """Distinct hit session ids that have no session row."""
    return hit_sessions(hits, key).join(sessions.select(key), on=key, how="left_anti")


def no_hits_share(sessions: DataFrame, hits: DataFrame, key: str = "session_id") -> DataFrame:
    """Count and percentage of sessions without hits, in one row."""
    flagged = sessions.select(key).join(hit_sessions(hits, key).withColumn("_h", F.lit(1)), key, "left")
    return flagged.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_sessions"),
        F.count_if(F.col("_h").isNull()).cast("bigint").alias("n_without_hits"),
        F.round(F.count_if(F.col("_h").isNull()) * 100.0 / F.count(F.lit(1)), 6).alias("pct_without_hits"),
    )


def distinct_session_counts(hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                            key: str = "session_id", action: str = "event_action") -> DataFrame:
    """Distinct target sessions and distinct hit sessions in one pass."""
    is_t = F.col(action).isin(list(cfg.target_actions))
    return hits.agg(
        F.count_distinct(F.when(is_t, F.col(key))).cast("bigint").alias("n_target_sessions"),
        F.count_distinct(F.col(key)).cast("bigint").alias("n_hit_sessions"),
    )


def union_distinct_ids(*frames: DataFrame, key: str = "session_id") -> DataFrame:
    """Set union of ids across batches/chunks."""
    out = None
    for f in frames:
        ids = f.select(key)
        out = ids if out is None else out.unionByName(ids)
    return out.where(F.col(key).isNotNull()).distinct()
