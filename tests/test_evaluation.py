"""Exact metrics against brute force on a small fixture."""

import math

import numpy as np
from pyspark.sql import functions as F

from convlens.operators import evaluation as EV
from convlens.operators.ordered import ordered_prefix, sequence_within_group
from convlens.sources import testdata as td


def _pairs(spark, sf):
    df = td.scored_lines(spark, sf)
    rows = df.select("score", "label").collect()
    return df, np.array([r.score for r in rows]), np.array([r.label for r in rows])


def test_auc_and_ap_brute_force(spark, sf):
    df, s, y = _pairs(spark, sf)
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    want_auc = gt / (len(pos) * len(neg))
    assert abs(EV.roc_auc_exact(df).first().roc_auc - want_auc) < 1e-6
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        ap += ((s == t) & (y == 1)).sum() / len(pos) * tp / (tp + fp)
    assert abs(EV.average_precision(df).first().average_precision - ap) < 1e-6


def test_best_f1_first_max(spark, sf):
    df, s, y = _pairs(spark, sf)
    best, thr = -1.0, None
    for t in sorted(set(s)):
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        f1 = 2 * tp / (tp + fp + (y == 1).sum())
        if f1 > best + 1e-15:
            best, thr = f1, t
    r = EV.best_f1_threshold(df).first()
    assert math.isclose(r.threshold, thr) and abs(r.f1 - best) < 1e-6


def test_confusion_golden(spark):
    df = spark.createDataFrame([(335430, 26516, 7607, 2456)], "tn long, fp long, fn long, tp long")
    r = df.select(*EV.prf_columns("tp", "fp", "fn")).first()
    assert (r.precision, r.recall, r.f1) == (0.08477, 0.24406, 0.12584)


def test_exact_quantiles_match_numpy(spark, sf):
    df, s, _ = _pairs(spark, sf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = EV.exact_quantiles(df, "score", probs)
    assert np.allclose(got, np.percentile(s, [p * 100 for p in probs]))


def test_calibration_bins_match_numpy(spark, sf):
    df, s, y = _pairs(spark, sf)
    edges = np.percentile(s, np.linspace(0, 100, 11))
    ids = np.searchsorted(edges[1:-1], s)
    got = {r.bin: r for r in EV.calibration_table(df).collect()}
    for b in np.unique(ids):
        assert got[int(b)].n == int((ids == b).sum())
        assert abs(got[int(b)].prob_true - y[ids == b].mean()) < 1e-6


def test_ordered_prefix_equals_single_window(spark):
    from pyspark.sql import Window

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 4999 / 10.0).alias("k"), F.lit(1).alias("c")) \
              .groupBy("k").agg(F.sum("c").alias("c"))
    got = {r.k: r.cum_c for r in ordered_prefix(df, "k", ["c"], range_rows=20).collect()}
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.cum for r in df.select("k", F.sum("c").over(w).alias("cum")).collect()}
    assert got == want


def test_sequence_within_group_equals_row_number(spark):
    from pyspark.sql import Window

    rows = [(i % 7, (i * 13) % 5, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, day int, k int")
    got = {r.k: r.seq for r in sequence_within_group(df, ["g"], "day", ["k"], "seq").collect()}
    w = Window.partitionBy("g").orderBy("day", "k")
    want = {r.k: r.rn for r in df.select("k", F.row_number().over(w).alias("rn")).collect()}
    assert got == want


def test_repartition_invariance(spark, sf):
    df = td.scored_lines(spark, sf)
    a = EV.roc_auc_exact(df).first().roc_auc
    b = EV.roc_auc_exact(df.repartition(13)).first().roc_auc
    assert a == b


def test_sequence_splits_hot_groups_exactly(spark):
    from pyspark.sql import Window

    # one group holds most rows, ties on the order key included
    rows = [(0, i % 2, i // 3) for i in range(900)] + [(g, 0, g * 10 + i) for g in range(1, 5) for i in range(7)]
    df = spark.createDataFrame(rows, "g int, day int, k long").withColumn("rid", F.monotonically_increasing_id())
    got = sequence_within_group(df, ["g"], "day", ["k", "rid"], "seq", max_group_rows=20, n_cuts=16)
    w = Window.partitionBy("g").orderBy("day", "k", "rid")
    want = df.select("rid", F.row_number().over(w).alias("rn"))
    bad = got.join(want, "rid").where(F.col("seq") != F.col("rn")).count()
    assert bad == 0 and got.count() == len(rows)


def test_roc_thinning_drops_collinear_points(spark):
    # descending thresholds 0.9..0.1: three negatives in a row make a straight run
    rows = [(0.9, 1), (0.8, 0), (0.7, 0), (0.6, 0), (0.5, 1), (0.4, 1), (0.3, 0), (0.2, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = sorted((r.threshold for r in EV.roc_curve_thinned(df).collect()), reverse=True)
    s = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows])
    order = np.argsort(-s)
    tps, fps = np.cumsum(y[order]), np.cumsum(1 - y[order])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    want = [float("inf")] + list(s[order][keep])
    assert got == want and len(want) < len(rows) + 1
