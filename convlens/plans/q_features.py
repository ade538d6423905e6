"""Feature, encoding and split queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from convlens.contracts import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from convlens.functions import columns as C
from convlens.operators import features as FE
from convlens.operators import splits as SP
from convlens.plans import frames
from convlens.plans.oracle import CFG, FEATURE_BASE, SPLIT_BASE, grouped_top, hash_unit_sql, rank_sql, with_
from convlens.plans.registry import register
from convlens.session import cut_lineage

WF = with_(*FEATURE_BASE)
WS = with_(*SPLIT_BASE)
TOPN = CFG.top_n_by_column
CATS = list(CATEGORICAL_FEATURES)


def features(spark, sf):
    return FE.build_features(frames.dataset(spark, sf), CFG)


def split_features(spark, sf):
    return SP.split_hash(features(spark, sf), "session_id", CFG.test_size, CFG.seed)


def train_test(spark, sf, *columns):
    """Train and test part; with ``columns``, of these only, cut from the cleaning lineage: for what reads them more than once."""
    s = split_features(spark, sf)
    if columns:
        s = cut_lineage(s.select("session_id", *columns, "split"))
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


@register("build_features", WF + "SELECT * FROM features")
def build_features(spark, sf):
    return features(spark, sf)


@register("features_from_raw", WF + "SELECT * FROM features")
def features_from_raw(spark, sf):
    """Train = serve: the builder on *raw* visits equals the builder on the
    cleaned table (labels joined back for comparison)."""
    raw = frames.sessions(spark, sf).dropDuplicates()
    lab = frames.dataset(spark, sf).select("session_id", "target")
    return FE.SessionFeatureBuilder(cfgJson=FE.cfg_json(CFG)).transform(raw.drop("client_id", "device_model")) \
        .join(lab, "session_id").select("session_id", "target", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


@register("split_hash", WS + "SELECT session_id, split FROM sp")
def split_hash(spark, sf):
    return split_features(spark, sf).select("session_id", "split")


_VCUT = int(round(CFG.val_size * 10000))


@register("split_nested", WS + f"""
SELECT session_id, CASE WHEN split = 'train' AND {hash_unit_sql('session_id', CFG.seed, 'val')} < {_VCUT} THEN 'val'
                        WHEN split = 'train' THEN 'fit' ELSE split END AS split FROM sp""")
def split_nested(spark, sf):
    return SP.split_nested(features(spark, sf), "session_id", CFG.test_size, CFG.val_size, CFG.seed) \
             .select("session_id", "split")


@register("split_stratified", with_(*FEATURE_BASE[:-1]) + f"""
, a AS ({rank_sql('dataset')}),
b AS ({rank_sql(f"(SELECT session_id, target FROM a WHERE r > floor(n * {CFG.test_size} + 0.5)) x", 'val')})
SELECT session_id, target, 'test' AS split FROM a WHERE r <= floor(n * {CFG.test_size} + 0.5)
UNION ALL SELECT session_id, target, CASE WHEN r <= floor(n * {CFG.val_size} + 0.5) THEN 'val' ELSE 'fit' END FROM b""")
def split_stratified(spark, sf):
    """test / val / fit with exact counts per class."""
    d = cut_lineage(frames.dataset(spark, sf).select("session_id", "target"))  # read by several passes
    return SP.split_stratified(d, "session_id", "target", CFG.test_size, CFG.val_size, CFG.seed)


@register("stratified_folds", with_(*FEATURE_BASE[:-1]) + f"""
, a AS ({rank_sql('dataset', 'cv')})
SELECT session_id, target, CAST(r > floor(n * (1 / 3) + 0.5) AS INTEGER) + CAST(r > floor(n * (2 / 3) + 0.5) AS INTEGER) AS fold FROM a""")
def stratified_folds(spark, sf):
    d = cut_lineage(frames.dataset(spark, sf).select("session_id", "target"))  # read by several passes
    return SP.stratified_folds(d, folds=3, seed=CFG.seed)


@register("split_summary", WS + """
SELECT split, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(target AS DOUBLE)), 6) AS cr FROM sp GROUP BY split""")
def split_summary(spark, sf):
    return SP.split_summary(split_features(spark, sf))


@register("split_by_time", with_(*FEATURE_BASE[:-1]) + f"""
, days AS (SELECT visit_date, count(*) AS n FROM dataset WHERE visit_date IS NOT NULL GROUP BY 1),
cum AS (SELECT visit_date, sum(n) OVER (ORDER BY visit_date) / sum(n) OVER () AS share FROM days),
cut AS (SELECT min(visit_date) AS d FROM cum WHERE share >= {1 - CFG.test_size})
SELECT session_id, CASE WHEN visit_date > (SELECT d FROM cut) THEN 'test' ELSE 'train' END AS split FROM dataset""")
def split_by_time(spark, sf):
    return SP.split_by_time(frames.dataset(spark, sf), "visit_date", CFG.test_size).select("session_id", "split")


@register("sample_n", with_(*FEATURE_BASE[:-1]) + f"""
SELECT session_id, target FROM dataset ORDER BY md5(session_id || ':{CFG.seed}'), session_id LIMIT 1000""")
def sample_n(spark, sf):
    return SP.sample_n(frames.dataset(spark, sf).select("session_id", "target"), 1000, seed=CFG.seed)


@register("class_weights", with_(*FEATURE_BASE[:-1]) + """
, per AS (SELECT target, count(*) AS n FROM dataset GROUP BY target)
SELECT target, CAST(n AS BIGINT) AS n,
       round((SELECT sum(n) FROM per) / ((SELECT count(*) FROM per) * n), 6) AS weight_balanced,
       round((SELECT max(n) FROM per) / n, 6) AS weight_max_ratio FROM per""")
def class_weights(spark, sf):
    return SP.class_weights(frames.dataset(spark, sf))


# --- H1-H5, H8 --------------------------------------------------------------------
@register("rare_topn_fit", WS + """
, long AS (UNPIVOT (SELECT """ + ", ".join(TOPN) + """ FROM train) ON """ + ", ".join(TOPN) + """
           INTO NAME "column" VALUE value),
cnt AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM cnt),
lim AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {n})" for c, n in TOPN.items()) + """) t("column", top_n))
SELECT rk."column", rk.value, CAST(rk.n AS BIGINT) AS n, CAST(rk.rank AS INTEGER) AS rank
FROM rk JOIN lim ON rk."column" = lim."column" WHERE rk.rank <= lim.top_n""")
def rare_topn_fit(spark, sf):
    train, _ = train_test(spark, sf)
    return FE.top_n_values(train, TOPN).select("column", "value", "n", F.col("rank").cast("int"))


def grouper(spark, sf):
    train, test = train_test(spark, sf, *CATS)
    model = FE.RareCategoryGrouper(topNJson=json.dumps(TOPN)).fit(train)
    return model, train, test


@register("group_rare", WS + ", " + grouped_top("train", "gt", TOPN, apply_to="test")
          + " SELECT session_id, " + ", ".join(TOPN) + " FROM gt")
def group_rare(spark, sf):
    model, _, test = grouper(spark, sf)
    return model.transform(test).select("session_id", *TOPN)


_IMP = list(NUMERIC_FEATURES)


@register("impute_median", WS + """
, m AS (SELECT """ + ", ".join(f"median({c}) AS m_{c}" for c in _IMP) + """ FROM train)
SELECT session_id, """ + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _IMP) + " FROM test, m")
def impute_median(spark, sf):
    train, test = train_test(spark, sf, *_IMP)
    return FE.MedianImputer(inputCols=_IMP).fit(train).transform(test).select("session_id", *_IMP)


_STD = list(NUMERIC_FEATURES)


@register("standardize", WS + """
, s AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _STD) + """ FROM train)
SELECT session_id, """ + ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}" for c in _STD)
    + " FROM train, s")
def standardize(spark, sf):
    train, _ = train_test(spark, sf)
    out = FE.PopulationScaler(inputCols=_STD).fit(train).transform(train)
    return out.select("session_id", *[C.round6(c).alias(c) for c in _STD])


@register("one_hot_long", WS + ", " + grouped_top("train", "gtr", TOPN) + ", "
          + grouped_top("train", "gte", TOPN, apply_to="test").replace("gte_", "gtx_") + """
, vocab AS (SELECT DISTINCT feature, value FROM (UNPIVOT (SELECT """ + ", ".join(CATS) + """ FROM gtr)
            ON """ + ", ".join(CATS) + """ INTO NAME feature VALUE value))
SELECT l.session_id, l.feature, l.value FROM (UNPIVOT (SELECT session_id, """ + ", ".join(CATS) + """ FROM gte)
     ON """ + ", ".join(CATS) + """ INTO NAME feature VALUE value) l
JOIN vocab v ON l.feature = v.feature AND l.value = v.value""")
def one_hot_long(spark, sf):
    model, train, test = grouper(spark, sf)
    vocab = FE.vocabulary(model.transform(train), CATS)
    return FE.one_hot_long(model.transform(test), vocab, CATS).select("session_id", "feature", "value")


_TE = list(CATS)


@register("target_encode", WS + ", prior AS (SELECT avg(CAST(target AS DOUBLE)) AS p FROM train), " + ", ".join(
    f"st_{c} AS (SELECT {c} AS v, (sum(CAST(target AS DOUBLE)) + 1.0 * (SELECT p FROM prior)) / (count(*) + 1.0) AS e "
    f"FROM train GROUP BY {c})" for c in _TE) + " SELECT t.session_id, " + ", ".join(
    f"round(coalesce(st_{c}.e, (SELECT p FROM prior)), 6) AS {c}_te" for c in _TE) + " FROM test t " + " ".join(
    f"LEFT JOIN st_{c} ON t.{c} = st_{c}.v" for c in _TE))
def target_encode(spark, sf):
    train, test = train_test(spark, sf, "target", *_TE)
    out = FE.target_encode(train, test, _TE, smoothing=1.0)
    return out.select("session_id", *[C.round6(f"{c}_te").alias(f"{c}_te") for c in _TE])


_FOLD = f"({hash_unit_sql('session_id', CFG.seed, 'fold')} % 5)"


@register("target_encode_oof", WS + f"""
, tf AS (SELECT *, {_FOLD} AS fold FROM train),
fp AS (SELECT fold, (SELECT sum(CAST(target AS DOUBLE)) FROM tf) - sum(CAST(target AS DOUBLE)) AS op,
              (SELECT count(*) FROM tf) - count(*) AS oc FROM tf GROUP BY fold), """ + ", ".join(
    f"""st_{c} AS (SELECT {c} AS v, fold, count(*) AS cnt, sum(CAST(target AS DOUBLE)) AS pos FROM tf GROUP BY 1, 2),
ot_{c} AS (SELECT v, fold, sum(cnt) OVER (PARTITION BY v) - cnt AS oc, sum(pos) OVER (PARTITION BY v) - pos AS op
           FROM st_{c})""" for c in _TE) + " SELECT t.session_id, " + ", ".join(
    f"round(coalesce((ot_{c}.op + 1.0 * fp.op / fp.oc) / (ot_{c}.oc + 1.0), fp.op / fp.oc), 6) AS {c}_te"
    for c in _TE) + " FROM tf t JOIN fp ON t.fold = fp.fold " + " ".join(
    f"LEFT JOIN ot_{c} ON t.{c} IS NOT DISTINCT FROM ot_{c}.v AND t.fold = ot_{c}.fold" for c in _TE))
def target_encode_oof(spark, sf):
    train, _ = train_test(spark, sf, "target", *_TE)
    out = FE.target_encode_oof(train, _TE, seed=CFG.seed, folds=5, smoothing=1.0)
    return out.select("session_id", *[C.round6(f"{c}_te").alias(f"{c}_te") for c in _TE])


# --- J1: constant prior model ----------------------------------------------------------
@register("model_dummy", WS + f"""
, fit AS (SELECT * FROM train WHERE {hash_unit_sql('session_id', CFG.seed, 'val')} >= {_VCUT})
SELECT session_id, round((SELECT avg(CAST(target AS DOUBLE)) FROM fit), 6) AS score FROM test""")
def model_dummy(spark, sf):
    s = SP.split_nested(features(spark, sf), "session_id", CFG.test_size, CFG.val_size, CFG.seed)
    prior = s.where(F.col("split") == "fit").agg(F.avg(F.col("target").cast("double"))).scalar()
    return s.where(F.col("split") == "test").select("session_id", C.round6(prior).alias("score"))
