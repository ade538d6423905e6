"""Model queries: rows-only checks --
learners are iterative, so there is no SQL oracle; the fitted encoder's slots
have one."""

from __future__ import annotations

from pyspark.sql import functions as F

from convlens.contracts import CATEGORICAL_FEATURES, MODEL_INPUT_COLUMNS, NUMERIC_FEATURES
from convlens.operators import evaluation as EV
from convlens.operators import modeling as M
from convlens.operators import splits as SP
from convlens.operators import trees
from convlens.plans import frames
from convlens.plans.oracle import CFG, FEATURE_BASE, grouped_top, hash_unit_sql, rank_sql, with_
from convlens.plans.registry import register
from convlens.session import cut_lineage, even, scratch_path, stored
from convlens.sources import sinks
from convlens.sources import testdata as td

_CACHE: dict = {}
MODEL_VERSION = "convlens-gbt-2"
MAX_TREES = 1500  # the analysed workflow's own limit; fewer are fitted once its patience of 60 rounds has run out


def parts(spark, sf):
    """fit / val / test parts of the labelled visits (raw input fields kept).
    The split table is checkpointed once into the shared checkpoint folder:
    every estimator stage then reads it instead of re-running the cleaning
    lineage, and a lost executor recomputes from the checkpoint."""
    def build():
        d = cut_lineage(td.learnable_target(frames.dataset(spark, sf)).select("session_id", "target", *MODEL_INPUT_COLUMNS))
        return cut_lineage(even(SP.split_stratified(d, "session_id", "target", CFG.test_size, CFG.val_size, CFG.seed), "session_id"))
    s = _memo((sf, "split"), build)
    return (s.where(F.col("split") == "fit").drop("split"), s.where(F.col("split") == "val").drop("split"),
            s.where(F.col("split") == "test").drop("split"), s.where(F.col("split") != "test").drop("split"))


def _memo(key, fn):
    """Per-process cache of fitted models / checkpointed splits, keyed by the
    running Spark application too (a new session never sees stale frames)."""
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    key = (active.sparkContext.applicationId if active else None, *key)
    if key not in _CACHE:
        _CACHE[key] = fn()
    return _CACHE[key]


def model(spark, sf, name: str):
    fit, val, test, train = parts(spark, sf)
    if name == "logreg_base":
        return _memo((sf, name), lambda: M.fit_logistic(fit, CFG, 1.0, cats=["utm_medium", "device_category"],
                                                        nums=[]))
    if name == "logreg_full":
        return _memo((sf, name), lambda: M.fit_logistic(fit, CFG, tuned_c(spark, sf), encoder=encoder(spark, sf), encoded=encoded(spark, sf)))
    if name == "forest":
        return _memo((sf, name), lambda: M.fit_forest(fit, CFG))
    if name == "boosted":
        return _memo((sf, name), lambda: M.fit_boosted(fit, CFG, val, max_iter=MAX_TREES))
    if name == "boosted_final":
        _, trees = model(spark, sf, "boosted")
        return _memo((sf, name), lambda: M.refit_boosted(train, CFG, trees))
    raise KeyError(name)


def _pipeline(spark, sf, name):
    m = model(spark, sf, name)
    return m[0] if isinstance(m, tuple) else m


def test_scores(spark, sf, name):
    """Unrounded scores of the test part."""
    _, _, test, _ = parts(spark, sf)
    return M.positive_probability(_pipeline(spark, sf, name).transform(test)).select("session_id", "target", "score")


def stored_scores(spark, sf, name):
    """The same, written once: the metrics pass over them several times."""
    return _memo((sf, "scores", name), lambda: stored(test_scores(spark, sf, name), "scores"))


def encoder(spark, sf):
    """The encoder of all features, fitted once on the fit part: for the cross-validation, the full logistic model and its slots."""
    return _memo((sf, "encoder"), lambda: M.fit_encoder(parts(spark, sf)[0], CFG))


def encoded(spark, sf):
    """The fit part as the logistic learners read it."""
    return _memo((sf, "encoded"), lambda: M.encode(encoder(spark, sf), parts(spark, sf)[0], CFG))


def cv_rows(spark, sf) -> list:
    return _memo((sf, "cv"), lambda: M.cv_logistic(parts(spark, sf)[0], CFG, encoded=encoded(spark, sf)).collect())


def tuned_c(spark, sf) -> float:
    """The C with the best mean AUC over the folds, the smallest on ties."""
    rows = cv_rows(spark, sf)
    return min(rows, key=lambda r: (-r["mean_roc_auc"], r["C"]))["C"]


for _q, _m in (("train_logreg_base", "logreg_base"), ("train_logreg_full", "logreg_full"),
               ("train_forest", "forest"), ("train_boosted", "boosted"), ("refit_final", "boosted_final")):
    register(_q)((lambda mm: lambda spark, sf: test_scores(spark, sf, mm).withColumn("score", F.round("score", 6)))(_m))


@register("cv_logistic")
def cv_logistic(spark, sf):
    return spark.createDataFrame(cv_rows(spark, sf), "C double, mean_roc_auc double")


def threshold(spark, sf, name) -> float:
    """Best-F1 threshold on the validation part (the final model reuses the
    boosted model's)."""
    def best():
        src = "boosted" if name == "boosted_final" else name
        _, val, _, _ = parts(spark, sf)
        sc = M.positive_probability(_pipeline(spark, sf, src).transform(val)).select("score", F.col("target").alias("label"))
        return float(EV.best_f1_threshold(stored(sc, "scores")).first()["threshold"])
    return _memo((sf, "thr", name), best)


@register("model_comparison")
def model_comparison(spark, sf):
    """One metrics row per model on the test part + acceptance (AUC > .65)."""
    fit, _, test, _ = parts(spark, sf)
    prior = fit.agg(F.avg(F.col("target").cast("double"))).first()[0]
    rows = None
    for name in ("dummy", "logreg_base", "logreg_full", "forest", "boosted", "boosted_final"):
        if name == "dummy":
            sc, t = test.select(F.lit(prior).alias("score"), F.col("target").alias("label")), 0.5
        else:
            sc = stored_scores(spark, sf, name).select("score", F.col("target").alias("label"))
            # only the final model has a tuned threshold
            t = threshold(spark, sf, name) if name == "boosted_final" else 0.5
        m = EV.evaluate_scores(sc).first()  # AUC and AP from one cumulative table
        prf = EV.prf_at_threshold(sc, t)
        row = prf.select(F.lit(name).alias("model"), F.lit(m["roc_auc"]).alias("roc_auc"),
                         F.lit(m["average_precision"]).alias("pr_auc"), "f1", "precision",
                         "recall", "threshold", "tn", "fp", "fn", "tp",
                         F.lit(int(m["roc_auc"] > 0.65)).alias("accepted"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


@register("feature_importance")
def feature_importance(spark, sf):
    _, _, test, _ = parts(spark, sf)
    return M.feature_importance(_pipeline(spark, sf, "boosted_final"), test)


@register("permutation_importance")
def permutation_importance(spark, sf):
    _, _, test, _ = parts(spark, sf)
    return M.permutation_importance(_pipeline(spark, sf, "boosted_final"), test, list(MODEL_INPUT_COLUMNS), repeats=5, seed=CFG.seed)


@register("boosted_contributions")
def boosted_contributions(spark, sf):
    """Per visit and feature, how far the final model's margin moves by it."""
    from pyspark.ml import PipelineModel

    m = _pipeline(spark, sf, "boosted_final")
    _, _, test, _ = parts(spark, sf)
    data = PipelineModel(stages=m.stages[:-1]).transform(test)
    return trees.contributions(m.stages[-1], data.select("session_id", "features"), M.feature_names(data), ["session_id"]).withColumn(
        "contribution", F.round("contribution", 6))


@register("linear_contributions")
def linear_contributions(spark, sf):
    _, _, test, _ = parts(spark, sf)
    return M.linear_contributions(_pipeline(spark, sf, "logreg_full"), test)


def _encoding_sql() -> str:
    """The encoder's slots in SQL: split, grouping, medians and means are learned on the fit part."""
    chance = ("300 + CASE WHEN device_category = 'F' THEN 2500 ELSE 0 END + CASE WHEN utm_medium IN ('1-urgent', '(none)') THEN 2000 ELSE 0 END"
              " + CASE WHEN geo_city IN ('NATION_3', 'NATION_8') THEN 1500 ELSE 0 END + CASE WHEN visit_number = 1 THEN 1000 ELSE 0 END")
    ctes = [*FEATURE_BASE,
            f"labelled AS (SELECT session_id, CAST({hash_unit_sql('session_id', 7, 'learnable')} < {chance} AS INTEGER) AS target FROM dataset)",
            f"a AS ({rank_sql('labelled')})",
            f"b AS ({rank_sql(f'(SELECT session_id, target FROM a WHERE r > floor(n * {CFG.test_size} + 0.5)) x', 'val')})",
            f"fitted AS (SELECT * FROM features WHERE session_id IN (SELECT session_id FROM b WHERE r > floor(n * {CFG.val_size} + 0.5)))",
            f"tested AS (SELECT * FROM features WHERE session_id IN (SELECT session_id FROM a WHERE r <= floor(n * {CFG.test_size} + 0.5)))",
            grouped_top("fitted", "fitted_grouped", CFG.top_n_by_column, CFG.other),
            grouped_top("fitted", "tested_grouped", CFG.top_n_by_column, CFG.other, "tested"),
            "medians AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in NUMERIC_FEATURES) + " FROM fitted)",
            "means AS (SELECT " + ", ".join(f"avg(coalesce(CAST(f.{c} AS DOUBLE), m.{c})) AS {c}" for c in NUMERIC_FEATURES) + " FROM fitted f, medians m)",
            "labels_ AS (SELECT " + ", ".join(f"list(DISTINCT {c}) AS {c}" for c in CATEGORICAL_FEATURES) + " FROM fitted_grouped)"]
    # every column has one slot more than labels: that of values not seen in the fit part
    width = " + ".join([str(len(NUMERIC_FEATURES)), *(f"len(l.{c}) + 1" for c in CATEGORICAL_FEATURES)])
    active = " + ".join([str(len(CATEGORICAL_FEATURES)),
                         *(f"CAST(coalesce(CAST(t.{c} AS DOUBLE), m.{c}) <> v.{c} AS INTEGER)" for c in NUMERIC_FEATURES)])
    return with_(*ctes) + (f"SELECT session_id, CAST({width} AS INTEGER) AS width, CAST({active} AS INTEGER) AS active "
                           "FROM tested_grouped t, medians m, means v, labels_ l")


@register("feature_encoding", _encoding_sql())
def feature_encoding(spark, sf):
    """The fitted encoder (builder -> grouping -> one-hot + impute/scale ->
    vector) applied to the test part: vector width and active slots. It is
    the full logistic model's own encoder, which no learner changes."""
    from pyspark.ml.functions import vector_to_array

    _, _, test, _ = parts(spark, sf)
    arr = vector_to_array("features")
    return encoder(spark, sf).transform(test).select("session_id", F.size(arr).alias("width"),
                                      F.size(F.filter(arr, lambda x: x != 0)).alias("active"))


def metadata(spark, sf) -> dict:
    """What is stored beside the final model."""
    import platform

    import pyspark

    _, _, test, train = parts(spark, sf)
    t = threshold(spark, sf, "boosted_final")
    sc = stored_scores(spark, sf, "boosted_final").select("score", F.col("target").alias("label"))
    m, prf = EV.evaluate_scores(sc).first(), EV.prf_at_threshold(sc, t).first()
    return {"model_version": MODEL_VERSION, "threshold": t, "target_actions": list(CFG.target_actions),
            "input_columns": list(MODEL_INPUT_COLUMNS), "numeric_features": list(NUMERIC_FEATURES),
            "categorical_features": list(CATEGORICAL_FEATURES), "feature_order": [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES],
            "best_iteration": model(spark, sf, "boosted")[1], "split": "md5 of the session id", "test_size": CFG.test_size,
            "n_train": train.count(), "n_test": test.count(),
            "test_metrics": {"roc_auc": m["roc_auc"], "pr_auc": m["average_precision"], "f1": prf["f1"], "precision": prf["precision"], "recall": prf["recall"]},
            "versions": {"spark": pyspark.__version__, "python": platform.python_version()}}


@register("score_batch")
def score_batch(spark, sf):
    """Save the final model + metadata, load them back, score the accepted
    contract records (batch = the serving path)."""
    from convlens.plans.q_ingest import _records
    from convlens.operators.cleaning import reject_empty, validate_contract

    m = _pipeline(spark, sf, "boosted_final")
    path = scratch_path(spark, "model")
    sinks.save_model(m, path + "/pipeline")
    meta = metadata(spark, sf)
    sinks.stats_row(spark, meta).write.mode("overwrite").json(path + "/metadata")
    loaded = sinks.load_pipeline_model(path + "/pipeline")
    meta2 = __import__("json").loads(spark.read.json(path + "/metadata").first()["meta"])
    accepted, _ = validate_contract(reject_empty(_records(spark, sf)))
    return M.score_batch(loaded, accepted, meta2["threshold"], meta2["model_version"])
