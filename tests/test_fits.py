"""What is fitted on what: own rows, judged by the fits that run."""

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from convlens.contracts import CATEGORICAL_FEATURES, MODEL_INPUT_COLUMNS, NUMERIC_FEATURES
from convlens.operators import features as FE
from convlens.operators import modeling as M
from convlens.plans import frames
from convlens.plans import q_models as Q


@pytest.fixture(scope="module")
def visits(spark):
    rows = [(str(i), int(i % 3 == 0), *(f"v{(i + j) % 4}" if (i + j) % 5 else None for j in range(len(MODEL_INPUT_COLUMNS)))) for i in range(400)]
    df = spark.createDataFrame(rows, "session_id string, target int, " + ", ".join(f"{c} string" for c in MODEL_INPUT_COLUMNS))
    k = F.col("session_id").cast("int")
    return df.withColumns({"visit_date": F.date_format(F.date_add(F.lit("2021-01-01").cast("date"), k), "yyyy-MM-dd"),
                           "visit_time": F.concat((k % 24).cast("string"), F.lit(":05:09")), "visit_number": (k % 9).cast("string"),
                           "device_screen_resolution": F.when(k % 3 > 0, "360x640").otherwise("400x800")}).coalesce(2)


def test_forest_keeps_the_rows_nodes_and_its_trees(visits, monkeypatch):
    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append((self.copy(), df)) or fit(self, df))
    forest = M.fit_forest(visits, frames.CFG, num_trees=4, max_depth=5, min_leaf=5).stages[-1]
    (learner, rows), = seen
    assert learner.getCacheNodeIds()
    plain = fit(learner.setCacheNodeIds(False), rows)
    assert forest.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:] and forest.totalNumNodes > 12


def test_medians_of_boosting_are_learned_before_the_joins(visits, monkeypatch):
    plans, fit = [], FE.MedianImputer._fit
    monkeypatch.setattr(FE.MedianImputer, "_fit", lambda self, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or fit(self, df))
    data, _ = M._boosting_frame(visits, frames.CFG, 1.0)
    assert len(plans) == 1 and "Join" not in plans[0]
    got = {(r.target, r.weight, r.n) for r in data.groupBy("target", "weight").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, 400 / (2 * 134), 134), (0, 400 / (2 * 266), 266)}


def test_encoder_is_fitted_once_and_without_a_learner(spark, visits, monkeypatch):
    monkeypatch.setattr(Q, "parts", lambda spark, sf: (visits.where("session_id < 300"), None, visits.where("session_id >= 300"), None))
    encoders, fitted = [], M.fit_encoder
    monkeypatch.setattr(M, "fit_encoder", lambda *a, **k: encoders.append(1) or fitted(*a, **k))
    learners, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: learners.append(1) or fit(self, df))
    rows = Q.feature_encoding(spark, "own rows").collect()
    assert not learners and len(rows) == visits.where("session_id >= 300").count()
    model = Q.model(spark, "own rows", "logreg_full")
    assert len(learners) == 10 and len(encoders) == 1  # three folds of three C, then the best C on all
    assert {r.width for r in rows} == {model.stages[-1].numFeatures} and model.stages[:-1] == Q.encoder(spark, "own rows").stages
    assert min(r.active for r in rows) >= len(CATEGORICAL_FEATURES) and max(r.active for r in rows) <= len(CATEGORICAL_FEATURES) + len(NUMERIC_FEATURES)
