"""Streaming queries."""

from __future__ import annotations

from convlens.plans import frames
from convlens.plans.oracle import CFG, HITS, TARGET_SET, with_
from convlens.plans.registry import register
from convlens.session import scratch_path
from convlens.streaming import labeling as SL
from convlens.streaming import scoring as SS


@register("stream_label", with_(HITS) + f"""
SELECT DISTINCT session_id FROM hits WHERE event_action IN ({TARGET_SET}) AND session_id IS NOT NULL""")
def stream_label(spark, sf):
    """Line items replayed as a hit stream -> converted session ids, each given out once; equals the
    batch label (C1) once the stream has caught up."""
    base = scratch_path(spark, "stream-label")
    hits = frames.hits(spark, sf)
    # the hits replayed as shuffled files in four micro-batches: ids recur over batches, old hits come late; files enough that all cores
    # write and read them
    quarter = max(2, spark.sparkContext.defaultParallelism)
    hits.repartition(4 * quarter).write.parquet(base + "/in")
    src = SL.hits_stream(spark, base + "/in", hits.schema, max_files=quarter)
    SL.run_to_table(SL.converted_once(src, CFG), base + "/out", base + "/ckpt")
    return SL.read_converted(spark, base + "/out")


@register("stream_score")
def stream_score(spark, sf):
    """Contract records land as JSON-lines files and are scored micro-batch by
    micro-batch with the persisted final model."""
    from convlens.plans import q_models
    from convlens.plans.q_ingest import _records

    model = q_models._pipeline(spark, sf, "boosted_final")
    thr = q_models.threshold(spark, sf, "boosted_final")
    base = scratch_path(spark, "stream-score")
    _records(spark, sf).repartition(max(4, spark.sparkContext.defaultParallelism)).write.mode("overwrite").text(base + "/in")
    SS.score_stream(spark, base + "/in", model, thr, q_models.MODEL_VERSION, base + "/out",
                    base + "/rejects", base + "/ckpt")
    return spark.read.parquet(base + "/out").select("session_id", "prediction", "probability", "model_version")
