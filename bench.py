"""Headline benchmark: the five offline stages of the visit-conversion workflow
plus evaluation and scoring, timed at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages mirror the analysed project's pipeline (load+label -> clean -> EDA ->
feature diagnostics -> training -> evaluation -> scoring); phase tables are
written as Parquet under the session's checkpoint folder, as a cluster job
would. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import functions as F

    from convlens.contracts import MODEL_INPUT_COLUMNS, NUMERIC_FEATURES
    from convlens.operators import association as A
    from convlens.operators import cleaning, labeling, slices
    from convlens.operators import evaluation as EV
    from convlens.operators import features as FE
    from convlens.operators import modeling as M
    from convlens.operators import splits as SP
    from convlens.plans import frames
    from convlens.plans.q_association import _CATS, vif_table
    from convlens.plans.q_ingest import _records
    from convlens.plans.q_models import MAX_TREES
    from convlens.session import build_session, drop_scratch, scratch_path
    from convlens.sources import sinks
    from convlens.sources import testdata as td

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    cfg = frames.CFG
    out = scratch_path(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        r = fn()
        times[name] = round(time.time() - t0, 3)
        return r

    sessions = frames.sessions(spark, sf)
    hits = frames.hits(spark, sf)

    # 01 load + label: sessions and target_by_session phase tables
    def load_label():
        # both in sorted buckets by session: cleaning needs no exchange
        bucketed = sinks.write_bucketed(sessions, "bench_sessions", f"{out}/sessions", buckets=2 * cpus)
        sinks.write_bucketed(labeling.target_table(bucketed, hits, cfg), "bench_target", f"{out}/target", buckets=2 * cpus)
    timed("load_label", load_label)

    # 02 clean -> dataset (partitioned by visit month)
    def clean():
        s, t = spark.table("bench_sessions"), spark.table("bench_target")
        d = sinks.with_visit_month(cleaning.clean(s, t, cfg))
        sinks.write_phase_table(d, f"{out}/dataset", partition_by=["visit_ym"])
    timed("clean", clean)
    dataset = spark.read.parquet(f"{out}/dataset").drop("visit_ym")

    # 03 EDA: slices, business splits, hypotheses, V matrix, coverage
    def eda():
        e = slices.eda_frame(dataset, cfg)
        slices.cr_by_many(e, ["utm_medium", "device_category", "is_organic", "is_social", "is_first_visit",
                              "visit_bucket", "visit_hour", "visit_dow", "geo_region", "visit_daypart"]).collect()
        slices.business_splits(e).collect()
        A.hypothesis_battery(e).collect()
        g = FE.RareCategoryGrouper(topNJson=json.dumps({"utm_medium": 15, "device_os": 10,
                                                         "device_browser": 10})).fit(e).transform(e)
        A.association_matrix(g, ["utm_medium", "device_category", "device_os", "device_browser", "geo_region",
                                 "is_organic", "is_social", "is_first_visit", "visit_daypart", "target"]).collect()
        slices.topn_coverage(e, cfg.top_n_by_column).collect()
    timed("eda", eda)

    # 04 feature diagnostics on the whole table: VIF, MI, chi2 scores
    def feature_analysis():
        f = FE.build_features(dataset, cfg)
        sinks.write_phase_table(f, f"{out}/features")
        f = spark.read.parquet(f"{out}/features")
        vif_table(f, list(NUMERIC_FEATURES)).collect()
        g = FE.RareCategoryGrouper(topNJson=json.dumps(cfg.top_n_by_column)).fit(f).transform(f)
        A.onehot_mi(g, list(_CATS)).collect()
        A.chi2_onehot(g, list(_CATS)).collect()
    timed("feature_analysis", feature_analysis)

    # 05 training, all models: split, logistic (full), C tuning by 3-fold CV,
    # random forest, boosted trees with early stopping
    parts = SP.split_stratified(td.learnable_target(dataset).select("session_id", "target", *MODEL_INPUT_COLUMNS),
                                "session_id", "target", cfg.test_size, cfg.val_size, cfg.seed)
    sinks.write_phase_table(parts, f"{out}/split")
    parts = spark.read.parquet(f"{out}/split")
    fit = parts.where(F.col("split") == "fit")
    val = parts.where(F.col("split") == "val")
    test = parts.where(F.col("split") == "test")
    models = {}
    models["logreg_full"] = timed("train_logreg", lambda: M.fit_logistic(fit, cfg, 1.0))
    timed("cv_logistic", lambda: M.cv_logistic(fit, cfg).collect())
    models["forest"] = timed("train_forest", lambda: M.fit_forest(fit, cfg))
    models["boosted"] = timed("train_boosted", lambda: M.fit_boosted(fit, cfg, val, max_iter=MAX_TREES)[0])

    # evaluation on the test part (exact AUC, AP, best-F1, calibration)
    def evaluate():
        for m in models.values():
            sc = M.positive_probability(m.transform(test)).select("score", F.col("target").alias("label"))
            sinks.write_phase_table(sc, f"{out}/scores")
            sc = spark.read.parquet(f"{out}/scores")
            EV.evaluate_scores(sc).collect()
            EV.calibration_table(sc).collect()
    timed("evaluate", evaluate)

    # batch scoring of contract records with the boosted model
    def score():
        accepted, _ = cleaning.validate_contract(_records(spark, sf))
        M.score_batch(models["boosted"], accepted, 0.5, "bench").write.mode("overwrite").parquet(f"{out}/scored")
    timed("score_batch", score)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf).replace("sf", ""), "cpus": cpus}))
    for name in ("bench_sessions", "bench_target"):
        spark.sql(f"DROP TABLE {name}")
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
