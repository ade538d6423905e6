"""Stream = batch for incremental labelling."""

from pyspark.sql import functions as F

from convlens.operators import labeling
from convlens.plans import frames
from convlens.plans.q_stream import stream_label
from convlens.streaming import labeling as SL


def test_stream_label_equals_batch(spark, sf):
    streamed = {r.session_id for r in stream_label(spark, sf).collect()}
    batch = {r.session_id for r in labeling.target_sessions(frames.hits(spark, sf), frames.CFG).collect()}
    assert streamed == batch and streamed


def _hits(spark):
    rows = [(str(i % 40), "R" if i % 3 == 0 else "NO", f"{2030 - i % 20}-01-01") for i in range(600)]
    return rows, spark.createDataFrame(rows, "session_id string, event_action string, hit_date string")


def _run(spark, path, out, ckpt, schema, **options):
    hits = SL.hits_stream(spark, path, schema, max_files=2)
    SL.run_to_table(SL.converted_once(hits, frames.CFG, **options), out, ckpt)
    return [r.session_id for r in SL.read_converted(spark, out).collect()]


def test_each_id_once_over_batches_and_restarts(spark, tmp_path):
    """Old hits after new ones, a session over several files, a second run with new files."""
    rows, df = _hits(spark)
    path, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df.where("hit_date > '2020'").orderBy(F.desc("hit_date")).repartition(4).write.parquet(path)
    _run(spark, path, out, ckpt, df.schema)
    df.where("hit_date <= '2020'").repartition(3).write.mode("append").parquet(path)
    got = _run(spark, path, out, ckpt, df.schema)
    assert len(got) == len(set(got)) and set(got) == {s for s, a, _ in rows if a == "R"}


def test_a_replayed_batch_gives_the_same_ids(spark, tmp_path):
    import shutil
    rows, df = _hits(spark)
    path, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df.repartition(4).write.parquet(path)
    first = sorted(_run(spark, path, out, ckpt, df.schema))
    shutil.rmtree(ckpt)  # everything is processed again into the same folders
    assert sorted(_run(spark, path, out, ckpt, df.schema)) == first


def test_retention_forgets_ids(spark, tmp_path):
    rows, df = _hits(spark)
    path, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df.repartition(2).write.parquet(path)
    ids = sorted(_run(spark, path, out, ckpt, df.schema, retention=1))
    assert ids == sorted({s for s, a, _ in rows if a == "R"})
    for some in ("int(session_id) < 20", "int(session_id) >= 20"):  # the others' state is dropped after the first of these runs
        df.where(some).repartition(1).write.mode("append").parquet(path)
        more = _run(spark, path, out, ckpt, df.schema, retention=1)
    assert len(more) > len(ids) and set(more) == set(ids)
