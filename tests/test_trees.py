"""Staged evaluation, shorter ensembles, contributions, permutation importance, stratified splits."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from convlens.operators import evaluation as EV
from convlens.operators import modeling as M
from convlens.operators import splits as SP
from convlens.operators import trees


@pytest.fixture(scope="module")
def planted(spark):
    """A label that follows two features for a while, and then noise."""
    rng = np.random.default_rng(7)
    x = rng.random((1500, 3))
    y = (x[:, 0] + 0.6 * (x[:, 1] > 0.5) + rng.normal(0, 0.35, 1500) > 0.9).astype(int)
    df = spark.createDataFrame([(f"s{i}", *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "session_id string, a double, b double, c double, target int")
    asm = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    data = asm.transform(df).cache()
    fit, val = data.where("int(substr(session_id, 2)) % 3 > 0"), data.where("int(substr(session_id, 2)) % 3 = 0")
    return asm, fit, val, GBTClassifier(labelCol="target", maxIter=40, maxDepth=3, stepSize=0.3, seed=1).fit(fit)


def _auc(spark, scored):
    return M.positive_probability(scored).select("score", F.col("target").alias("label"))


def test_keyed_auc_equals_one_by_one(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(rng.integers(0, 30)) / 30, int(rng.random() < 0.3)) for k in "abc" for _ in range(200)] + [("only", 0.5, 1)]
    df = spark.createDataFrame(rows, "k string, score double, label int")
    got = {r.k: r.auc for r in EV.keyed_auc(df, ["k"]).collect()}
    assert got.pop("only") is None
    for k, auc in got.items():
        s, y = (np.array([r[i] for r in rows if r[0] == k]) for i in (1, 2))
        pos, neg = s[y == 1], s[y == 0]
        assert abs(auc - ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))) < 1e-12


def test_rounds_are_those_of_shorter_ensembles(spark, planted):
    _, _, val, gbt = planted
    aucs = trees.staged_auc(gbt, val)
    assert len(aucs) == 40
    for n in (1, 7, 40):
        short = trees.truncated(gbt, n, spark)
        assert len(short.trees) == n and short.treeWeights == gbt.treeWeights[:n]
        assert abs(EV.keyed_auc(_auc(spark, short.transform(val)).withColumn("k", F.lit(1)), ["k"]).first().auc - aucs[n - 1]) < 1e-9
    best = M.best_round(aucs, 10)
    assert 1 < best < 40 and max(aucs[:best + 10]) == aucs[best - 1]  # the signal is learned, the noise is not followed


def test_boosting_stops_where_the_whole_ensemble_would(spark, planted):
    _, fit, val, whole = planted
    asked = []

    def boost(n):
        asked.append(n)
        return GBTClassifier(labelCol="target", maxIter=n, maxDepth=3, stepSize=0.3, seed=1).fit(fit)

    aucs = trees.staged_auc(whole, val)
    assert trees.staged_auc(whole, val, first=30) == pytest.approx(aucs[30:], abs=1e-12)
    for patience in (3, 12):
        asked.clear()
        gbt, best = M.boost_until(boost, val, 40, patience)
        assert best == M.best_round(aucs, patience) and asked[-1] <= (16 if patience == 3 else 40)
        assert np.allclose(trees.node_tables(trees.truncated(gbt, best, spark), spark, 3)[0],
                           trees.node_tables(trees.truncated(whole, best, spark), spark, 3)[0])


def test_boosting_may_grow_to_the_surveyed_number_of_trees():
    import inspect

    from convlens.plans import q_models

    assert q_models.MAX_TREES == inspect.signature(M.fit_boosted).parameters["max_iter"].default == 1500


def test_best_round_looks_no_further_than_its_patience():
    assert M.best_round([0.5, 0.6, 0.6, 0.59, 0.7], 2) == 2
    assert M.best_round([0.5, 0.6, 0.6, 0.59, 0.7], 3) == 5
    assert M.best_round([0.5], 60) == 1


def test_contributions_add_up_to_the_margin(spark, planted):
    _, _, val, gbt = planted
    rows = trees.contributions(gbt, val, ["a", "b", "c"], ["session_id"]).collect()
    total = Counter()
    for r in rows:
        total[r.session_id] += r.contribution
    raw = {r.session_id: r.rawPrediction[1] for r in gbt.transform(val).collect()}
    assert len(rows) == 4 * len(raw) and all(abs(total[k] - v) < 1e-9 for k, v in raw.items())
    by = Counter()
    for r in trees.contributions(trees.truncated(gbt, 5, spark), val, ["a", "b", "c"], ["session_id"]).collect():
        by[r.feature] += abs(r.contribution)
    assert 5 * by["c"] < min(by["a"], by["b"])


def test_contributions_follow_the_paths(spark, planted):
    """Walked by hand through each saved tree."""
    _, _, val, gbt = planted
    short = trees.truncated(gbt, 3, spark)
    path = trees._saved(short, spark)
    nodes = {(r.treeID, r.nodeData.id): r.nodeData for r in spark.read.parquet(f"{path}/data").collect()}
    got = {(r.session_id, r.feature): r.contribution for r in trees.contributions(short, val.limit(30), ["a", "b", "c"], ["session_id"]).collect()}
    for row in val.limit(30).collect():
        want = Counter({"bias": 0.0, "a": 0.0, "b": 0.0, "c": 0.0})
        for t, w in enumerate(short.treeWeights):
            node = nodes[t, 0]
            want["bias"] += w * node.prediction
            while node.leftChild >= 0:
                f = node.split.featureIndex
                child = nodes[t, node.leftChild if row.features[f] <= node.split.leftCategoriesOrThreshold[0] else node.rightChild]
                want["abc"[f]] += w * (child.prediction - node.prediction)
                node = child
        assert all(abs(got[row.session_id, f] - v) < 1e-9 for f, v in want.items())


def test_permutation_importance(spark, planted):
    asm, _, val, gbt = planted
    model = PipelineModel(stages=[asm, gbt])
    data = val.drop("features")
    got = {r.feature: r for r in M.permutation_importance(model, data, ["a", "b", "c"], repeats=3, seed=5).collect()}
    assert set(got) == {"a", "b", "c"} and min(got["a"].importance, got["b"].importance) > 0.05 > abs(got["c"].importance)
    # one by one, with the same permutations
    pairs = M.shuffled_pairs(data, "session_id", 3, 5).collect()
    ids = sorted(r.session_id for r in data.collect())
    for r in (1, 2, 3):
        assert sorted(p.session_id for p in pairs if p.repeat == r) == sorted(p.donor for p in pairs if p.repeat == r) == ids
        assert sum(p.session_id == p.donor for p in pairs if p.repeat == r) < 10
    rows = {r.session_id: r.asDict() for r in data.collect()}
    auc = lambda some: EV.keyed_auc(_auc(spark, model.transform(spark.createDataFrame(some, data.schema))).withColumn("k", F.lit(1)), ["k"]).first().auc
    base = auc([tuple(r.values()) for r in rows.values()])
    drops = [base - auc([tuple((rows[p.session_id] | {"b": rows[p.donor]["b"]}).values()) for p in pairs if p.repeat == r]) for r in (1, 2, 3)]
    assert abs(got["b"].importance - sum(drops) / 3) < 1e-6


def test_importance_from_vectors_equals_whole_models(spark, planted, monkeypatch):
    from convlens.operators import features as FE

    asm, _, val, gbt = planted
    model, data = PipelineModel(stages=[asm, gbt]), val.drop("features")
    assert M.slots_by_column(model, data, ["c", "a", "b"]) == ({"c": [2], "a": [0], "b": [1]}, 3)
    skipping = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="skip")
    assert M.slots_by_column(PipelineModel(stages=[skipping, gbt]), data, ["a"]) is None
    assert all(len(v) == 1 for v in FE.columns_by_feature().values())
    # a column that nothing is made of moves nothing
    got = {tuple(r) for r in M.permutation_importance(model, data, ["a", "b", "c", "session_id"], repeats=2, seed=9).collect()}
    assert ("session_id", 0.0, 0.0) in got
    monkeypatch.setattr(M, "slots_by_column", lambda *_: None)
    assert got == {tuple(r) for r in M.permutation_importance(model, data, ["a", "b", "c"], repeats=2, seed=9).collect()} | {("session_id", 0.0, 0.0)}


def test_parts_are_even(spark):
    from convlens.session import even, part_count

    cores = spark.sparkContext.defaultParallelism
    assert [part_count(spark, n) for n in (0, 25_000, 25_001)] == [1, 1, 2 if cores > 1 else 1]
    assert part_count(spark, 25_000 * cores + 1) == cores and part_count(spark, 1_000_000 * cores + 1) == 2 * cores
    sizes = [len(p) for p in even(spark.range(60_000).coalesce(1), "id").rdd.glom().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 1.1 * 60_000 / len(sizes)


@pytest.mark.parametrize("few", [1, 5, 100_000])
def test_least_hashes(spark, few):
    import hashlib
    df = spark.createDataFrame([(f"k{i}", i % 3 if i % 10 else None) for i in range(500)], "k string, t int")
    of = {}
    for r in df.collect():
        of.setdefault(r.t, []).append(hashlib.md5(f"{r.k}:9:x".encode()).hexdigest())
    ranks = {0: [1, 5, 77], 1: [2, len(of[1])], None: [10], 2: [0]}
    got = SP.least_hashes(df, "k", "t", ranks, 9, "x", few=few)
    assert got == {(c, k): sorted(of[c])[k - 1] for c, ks in ranks.items() for k in ks if k}


def test_stratified_parts_are_exact(spark):
    df = spark.createDataFrame([(f"k{i}", int(i % 7 == 0)) for i in range(1003)], "session_id string, target int")
    split = SP.split_stratified(df, test_size=0.2, val_size=0.1, seed=3)
    got = Counter((r.split, r.target) for r in split.collect())
    n = Counter(r.target for r in df.collect())
    for c in (0, 1):
        test = int(n[c] * 0.2 + 0.5)
        assert got["test", c] == test and got["val", c] == int((n[c] - test) * 0.1 + 0.5) and sum(got[s, c] for s in ("test", "val", "fit")) == n[c]
    again = SP.split_stratified(df.repartition(7), test_size=0.2, val_size=0.1, seed=3)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))
    folds = Counter((r.fold, r.target) for r in SP.stratified_folds(df, folds=3).collect())
    assert all(abs(folds[f, c] - n[c] / 3) <= 1 for f in range(3) for c in (0, 1))
    few = spark.createDataFrame([("a", 1), ("b", 0)], "session_id string, target int")
    assert SP.split_stratified(few).count() == 2 and SP.split_stratified(few.limit(0)).count() == 0
