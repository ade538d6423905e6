"""Scoring a record gives the same in a batch, by itself, in another order and as a stream; the saved model scores like the fitted one."""

import pytest
from pyspark.sql import functions as F

from convlens.contracts import MODEL_INPUT_COLUMNS
from convlens.operators import modeling as M
from convlens.operators.cleaning import validate_contract
from convlens.plans import frames
from convlens.plans.q_ingest import _records
from convlens.sources import sinks
from convlens.sources import testdata as td
from convlens.streaming import scoring as SS


@pytest.fixture(scope="module")
def model(spark, sf):
    visits = td.learnable_target(frames.dataset(spark, sf)).select("session_id", "target", *MODEL_INPUT_COLUMNS)
    return M.fit_logistic(visits, frames.CFG, cats=["utm_medium", "device_category", "geo_city"], nums=["visit_hour", "is_first_visit"])


@pytest.fixture(scope="module")
def records(spark, sf):
    return _records(spark, sf).limit(300).cache()


def _scores(model, records):
    accepted, _ = validate_contract(records)
    return {r.session_id: (r.prediction, r.probability, r.model_version) for r in M.score_batch(model, accepted, 0.5, "v").collect()}


def test_single_rows_equal_the_batch(model, records):
    batch = _scores(model, records)
    assert len({p for _, p, _ in batch.values()}) > 10
    for r in records.limit(5).collect():
        one = _scores(model, records.where(F.col("value") == r.value))
        assert all(batch[k] == v for k, v in one.items())


def test_order_and_partitions_do_not_matter(model, records):
    assert _scores(model, records) == _scores(model, records.orderBy(F.desc("value")).repartition(9)) == _scores(model, records.coalesce(1))


def test_saved_model_scores_like_the_fitted_one(spark, model, records, tmp_path):
    sinks.save_model(model, str(tmp_path / "m"))
    assert _scores(sinks.load_pipeline_model(str(tmp_path / "m")), records) == _scores(model, records)


def test_stream_equals_batch(spark, model, records, tmp_path):
    records.repartition(5).write.text(str(tmp_path / "in"))
    SS.score_stream(spark, str(tmp_path / "in"), model, 0.5, "v", str(tmp_path / "out"), str(tmp_path / "rejects"), str(tmp_path / "ckpt"), max_files=2)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.session_id: (r.prediction, r.probability, r.model_version) for r in rows} == _scores(model, records)
    _, rejected = validate_contract(records)
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == rejected.count() > 0
