"""Model training, comparison, importance and scoring with Spark ML.

Every learner is a ``pyspark.ml`` estimator trained distributedly; class
weights travel as a ``weightCol``; the final artefact is a ``PipelineModel``
(raw visit fields in, probability out) saved with Spark ML persistence.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, TargetEncoder, TargetEncoderModel,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.contracts import CATEGORICAL_FEATURES, NUMERIC_FEATURES, ConversionConfig
from convlens.functions import columns as C
from convlens.operators import features as FE
from convlens.operators.evaluation import keyed_auc
from convlens.operators.ordered import ordered_prefix
from convlens.operators.splits import stratified_folds, with_class_weight
from convlens.operators.trees import staged_auc, truncated
from convlens.session import cut_lineage, part_count, stored


def encoder_stages(cfg: ConversionConfig, cats=CATEGORICAL_FEATURES, nums=NUMERIC_FEATURES,
                   out: str = "features") -> list:
    """builder -> rare grouping -> one-hot (unseen -> zeros) + median/scale -> vector."""
    cats, nums = list(cats), list(nums)
    idx = [f"{c}__idx" for c in cats]
    vec = [f"{c}__oh" for c in cats]
    return [
        FE.SessionFeatureBuilder(cfgJson=FE.cfg_json(cfg)),
        FE.RareCategoryGrouper(topNJson=json.dumps(cfg.top_n_by_column), otherToken=cfg.other),
        StringIndexer(inputCols=cats, outputCols=idx, handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True, handleInvalid="keep"),
        FE.MedianImputer(inputCols=nums),
        FE.PopulationScaler(inputCols=nums),
        VectorAssembler(inputCols=nums + vec, outputCol=out, handleInvalid="keep"),
    ]


def logistic(reg_param: float, max_iter: int = 1000) -> LogisticRegression:
    """L2 logistic regression; sklearn's C maps to regParam = 1 / (C * sum(w))."""
    return LogisticRegression(featuresCol="features", labelCol="target", weightCol="weight", maxIter=max_iter,
                              regParam=reg_param, elasticNetParam=0.0, standardization=False, tol=1e-6)


def fit_featurized(train: DataFrame, stages: list) -> PipelineModel:
    """Fit a pipeline whose first stage is the (stateless, regex-heavy) feature
    builder: its output is stored once in columns, so the later estimators (grouper,
    indexer, imputer, scaler) each read only theirs instead of
    re-running the builder. The returned model still starts from raw fields."""
    return _featurized(train, stages)[0]


def _featurized(train: DataFrame, stages: list) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline, and the rows as it transforms them, from the stored output of the builder, which ran once."""
    builder, rest = stages[0], stages[1:]
    feats = stored(builder.transform(train), "features")
    fitted = Pipeline(stages=rest).fit(feats)
    return PipelineModel(stages=[builder, *fitted.stages]), fitted.transform(feats)


def fit_encoder(train: DataFrame, cfg: ConversionConfig, **columns) -> PipelineModel:
    """Raw fields to vectors: all that is learned before a learner, which it does not depend on."""
    return fit_featurized(train, encoder_stages(cfg, **columns))


def encode(encoder: PipelineModel, train: DataFrame, cfg: ConversionConfig, folds: int = 3) -> DataFrame:
    """What learners read (vector, target, class weight) and the fold of cross-validation, checkpointed."""
    w = stratified_folds(with_class_weight(train, "target"), "session_id", "target", folds, cfg.seed)
    return cut_lineage(encoder.transform(w).select("features", "target", "weight", "fold"))


def fit_logistic(train: DataFrame, cfg: ConversionConfig, C_: float = 1.0, cats=CATEGORICAL_FEATURES,
                 nums=NUMERIC_FEATURES, encoder: PipelineModel | None = None, encoded: DataFrame | None = None) -> PipelineModel:
    """``encoder`` and ``encoded`` are fitted and made here unless given."""
    encoder = encoder or fit_encoder(train, cfg, cats=cats, nums=nums)
    if encoded is None:
        encoded = cut_lineage(encoder.transform(with_class_weight(train, "target")).select("features", "target", "weight"))
    return PipelineModel(stages=[*encoder.stages, logistic(1.0 / (C_ * encoded.count())).fit(encoded)])


def fit_forest(train: DataFrame, cfg: ConversionConfig, num_trees: int = 120, max_depth: int = 14,
               min_leaf: int = 100, sample: float = 0.3) -> PipelineModel:
    """Each row's node of every tree is kept, so that no level of the trees walks all rows down from the roots again."""
    rf = RandomForestClassifier(featuresCol="features", labelCol="target", weightCol="weight", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_leaf, subsamplingRate=sample,
                                featureSubsetStrategy="sqrt", seed=cfg.seed, cacheNodeIds=True)
    encoder = fit_encoder(train, cfg)
    encoded = cut_lineage(encoder.transform(with_class_weight(train, "target")).select("features", "target", "weight"))
    return PipelineModel(stages=[*encoder.stages, rf.fit(encoded)])


def _te_stages(cfg: ConversionConfig) -> tuple[list, list[str]]:
    cats = list(CATEGORICAL_FEATURES)
    idx = [f"{c}__idx" for c in cats]
    te = [f"{c}__te" for c in cats]
    pre = [FE.SessionFeatureBuilder(cfgJson=FE.cfg_json(cfg)),
           FE.RareCategoryGrouper(topNJson=json.dumps(cfg.top_n_by_column), otherToken=cfg.other),
           StringIndexer(inputCols=cats, outputCols=idx, handleInvalid="keep")]
    return pre, te


def _boosting_frame(train: DataFrame, cfg: ConversionConfig, smoothing: float) -> tuple[DataFrame, list]:
    """Training rows with *out-of-fold* target encodings (a row's own label never enters its feature) and the stages
    that turn raw rows into the same columns at scoring, where the encoder is fitted on all training rows."""
    pre, te = _te_stages(cfg)
    pre_model, base = _featurized(train, pre)
    base = stored(base, "base")
    idx = [f"{c}__idx" for c in CATEGORICAL_FEATURES]
    enc_model = TargetEncoder(inputCols=idx, outputCols=te, labelCol="target", targetType="binary",
                              handleInvalid="keep", smoothing=smoothing).fit(base)
    oof = FE.target_encode_oof(base, idx, key="session_id", target="target", folds=5, smoothing=smoothing,
                               seed=cfg.seed, suffix="__te")
    oof = oof.withColumnsRenamed({f"{c}__idx__te": f"{c}__te" for c in CATEGORICAL_FEATURES})
    nums = list(NUMERIC_FEATURES)
    # medians and class weights do not read the encodings: from the rows before the joins, which keep every row once
    imp = FE.MedianImputer(inputCols=nums).fit(base)
    asm = VectorAssembler(inputCols=nums + te, outputCol="features", handleInvalid="keep")
    data = asm.transform(imp.transform(with_class_weight(oof, "target", per=base)))
    # boosting runs jobs per tree: read a checkpoint, not the encoding lineage
    return cut_lineage(data.select("features", "target", "weight")), [*pre_model.stages, enc_model, imp, asm]


def _boost(data: DataFrame, cfg: ConversionConfig, trees: int, depth: int, lr: float):
    return GBTClassifier(featuresCol="features", labelCol="target", weightCol="weight", maxIter=trees, maxDepth=depth,
                         stepSize=lr, seed=cfg.seed, featureSubsetStrategy="all").fit(data)


def best_round(aucs: list[float], patience: int) -> int:
    """Rounds up to the first best AUC after which ``patience`` rounds bring no better; what comes later is not looked at."""
    best = 0
    for i, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_boosted(train: DataFrame, cfg: ConversionConfig, val: DataFrame | None = None, max_iter: int = 1500, depth: int = 6,
                lr: float = 0.05, patience: int = 60, smoothing: float = 1.0) -> tuple[PipelineModel, int]:
    """Gradient-boosted trees on target-encoded categories + numeric features. Returns (model, trees used).

    With ``val``, the exact ROC-AUC on ``val`` after every round is read off the ensemble (``operators/trees.py``), and the trees after the best
    round (the first one that ``patience`` rounds do not beat) are cut off. No later round is looked at, so an ensemble of a quarter more
    trees than ``patience`` is fitted first, and twice as many as long as patience has not run out. Without ``val`` the model has ``max_iter`` trees."""
    data, stages = _boosting_frame(train, cfg, smoothing)
    if val is None:
        return PipelineModel(stages=[*stages, _boost(data, cfg, max_iter, depth, lr)]), max_iter
    held = cut_lineage(PipelineModel(stages=stages).transform(val).select("features", "target"))
    gbt, best = boost_until(lambda n: _boost(data, cfg, n, depth, lr), held, max_iter, patience)
    return PipelineModel(stages=[*stages, truncated(gbt, best, held.sparkSession)]), best


def boost_until(boost: Callable[[int], GBTClassificationModel], held: DataFrame, max_iter: int, patience: int) -> tuple[GBTClassificationModel, int]:
    """(ensemble, its best round): what one of ``max_iter`` trees gives, without fitting those that nothing looks at. ``boost`` fits as many
    trees as it is told, the first ones the same whatever their number."""
    n, aucs = min(max_iter, patience + patience // 4 + 1), []
    while True:
        gbt = boost(n)
        aucs += staged_auc(gbt, held, first=len(aucs))
        best = best_round(aucs, patience)
        if n - best >= patience or n >= max_iter:
            return gbt, best
        n = min(max_iter, 2 * n)


def refit_boosted(train: DataFrame, cfg: ConversionConfig, n_trees: int, **kw) -> PipelineModel:
    """Refit on all of train at the early-stopped size (no validation hold-out)."""
    model, _ = fit_boosted(train, cfg, max_iter=max(1, n_trees), **kw)
    return model


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])


def cv_logistic(fit: DataFrame, cfg: ConversionConfig, grid=(0.3, 1.0, 3.0), folds: int = 3,
                encoded: DataFrame | None = None) -> DataFrame:
    """Tune C by stratified k-fold CV (exact counts per class) with exact-rank ROC-AUC
    (``numBins=0``). As in the analysed workflow, the feature encoder is fitted
    once on the fit part and only the learner is cross-validated; the encoded
    matrix (``encoded``, made by ``encode`` for as many folds, or here) is checkpointed, and folds x C fits run ``len(grid)`` at a time."""
    if encoded is None:
        encoded = encode(fit_encoder(fit, cfg), fit, cfg, folds)
    n = encoded.count()
    lr = logistic(1.0)
    params = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in grid]).build()
    ev = BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    # not CrossValidator: its fold column runs a Python function on every row of every fold, and it fits the best C once more on all rows
    aucs = []
    with ThreadPool(len(grid)) as pool:
        for k in range(folds):
            train, held = (encoded.where(part).persist() for part in (F.col("fold") != k, F.col("fold") == k))
            if train.isEmpty() or held.isEmpty():
                raise ValueError(f"fold {k} holds no rows to learn from or to judge by")
            one = inheritable_thread_target(fit.sparkSession)(lambda p: ev.evaluate(lr.fit(train, p).transform(held)))
            aucs.append(pool.map(one, params, chunksize=1))
            train.unpersist()
            held.unpersist()
    rows = [(float(c), float(round(sum(m) / folds, 6))) for c, m in zip(grid, zip(*aucs))]
    return fit.sparkSession.createDataFrame(rows, "C double, mean_roc_auc double")


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names of an assembled vector from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    return [names.get(i, f"f{i}") for i in range(meta.get("num_attrs", len(names)))]


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Impurity-based importances of the tree stage mapped to slot names."""
    prepared = PipelineModel(stages=model.stages[:-1]).transform(sample.limit(1))
    names = feature_names(prepared)
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted(((n, float(round(v, 4))) for n, v in zip(names, imp)), key=lambda r: (-r[1], r[0]))
    return sample.sparkSession.createDataFrame(rows, "feature string, importance double")


def shuffled_pairs(data: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """(repeat, key, donor key): for each repeat a random permutation of all rows.

    The rows are ordered by ``repeats + 1`` keyed hashes, all ranked in one keyed pass (no task holds more than a range of rows); equal
    ranks in the first order and another one make a pair. ``key`` is unique in ``data``."""
    h = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), F.lit(str(seed)), F.col("_order")), 11).cast("double")
    orders = (data.select(key, F.explode(F.sequence(F.lit(0), F.lit(repeats))).alias("_order"))
              .withColumn("_h", h).withColumn("_one", F.lit(1)))
    ranks = cut_lineage(ordered_prefix(orders, "_h", ["_one"], keys=["_order"]).select(key, "_order", F.col("cum__one").alias("_rank")))
    own = ranks.where(F.col("_order") == 0).drop("_order")
    donors = ranks.where(F.col("_order") > 0).select("_rank", F.col("_order").alias("repeat"), F.col(key).alias("donor"))
    return own.join(donors, "_rank").select("repeat", key, "donor")


#: stages that make each column from one of their input columns, and the vector from all
_COLUMNWISE = (FE.SessionFeatureBuilder, FE.RareCategoryGrouperModel, FE.MedianImputerModel, FE.PopulationScalerModel, StringIndexerModel,
               OneHotEncoderModel, TargetEncoderModel, VectorAssembler)


def slots_by_column(model: PipelineModel, data: DataFrame, columns: list[str]) -> tuple[dict[str, list[int]], int] | None:
    """(of every raw column the slots of the vector that are made of it, number of slots), or None if a slot is not told to be made of
    one column alone: a stage of another kind, one that may skip rows, or a feature that reads several columns."""
    head = model.stages[:-1]
    if not all(isinstance(s, _COLUMNWISE) and not (s.hasParam("handleInvalid") and s.getOrDefault("handleInvalid") == "skip") for s in head):
        return None
    reads = {c: [c] for c in data.columns}
    for i, stage in enumerate(head):
        if isinstance(stage, FE.SessionFeatureBuilder):
            if i > 0:
                return None
            reads |= FE.columns_by_feature(stage._cfg())
    names = feature_names(PipelineModel(stages=head).transform(data.limit(1)), model.stages[-1].getFeaturesCol())
    slots = {c: [] for c in columns}
    for i, name in enumerate(names):
        made = {c for f, read in reads.items() if name == f or name.startswith(f"{f}__") for c in read}
        if len(made) != 1:
            return None
        slots.setdefault(made.pop(), []).append(i)
    return {c: slots[c] for c in columns}, len(names)


def permutation_importance(model: PipelineModel, data: DataFrame, columns: list[str], repeats: int = 5,
                           seed: int = 42, key: str = "session_id") -> DataFrame:
    """Mean exact ROC-AUC drop when one raw input column is shuffled over all rows, ``repeats`` times.

    A repeat has one permutation of the rows for all columns. Each row is scored once as it is and, per repeat, once per column with that column
    taken from its donor: one scoring pass over rows * (1 + repeats * columns), then one AUC per (repeat, column), all
    from one keyed running sum. Where every slot of the model's vector is made of one column (``slots_by_column``), the vectors are made once a
    row and a variant takes the column's slots from the donor's vector; else every variant goes through the whole model."""
    data = cut_lineage(data)
    slots = slots_by_column(model, data, columns)
    if slots is None:
        donors = data.select(F.col(key).alias("donor"), F.struct(*columns).alias("_donor"))
        rows = data.join(shuffled_pairs(data, key, repeats, seed), key).join(donors, "donor").drop("donor")
        rows = rows.withColumn("column", F.explode(F.array(*map(F.lit, columns))))
        variants = rows.select("repeat", "column", *[
            F.when(F.col("column") == c, F.col("_donor")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in data.columns])
        whole = data.select(F.lit(0).alias("repeat"), F.lit("").alias("column"), *data.columns)
    else:
        features = model.stages[-1].getFeaturesCol()
        vectors = stored(PipelineModel(stages=model.stages[:-1]).transform(data).select(key, "target", vector_to_array(features).alias("_x")), "vectors")
        donors = vectors.select(F.col(key).alias("donor"), F.col("_x").alias("_donor"))
        # one variant per column comes of each row: dealt by number, as their size tells little of the work
        n = part_count(data.sparkSession, vectors.count() * repeats, least=5_000, most=100_000)
        rows = vectors.join(shuffled_pairs(vectors, key, repeats, seed), key).repartition(n, "donor").join(donors.repartition(n, "donor"), "donor")
        taken = [F.struct(F.lit(c).alias("c"), F.array(*(F.lit(i in at) for i in range(slots[1]))).alias("from_donor")) for c, at in slots[0].items()]
        rows = rows.withColumn("_taken", F.explode(F.array(*taken)))
        swapped = F.transform("_x", lambda v, i: F.when(F.get("_taken.from_donor", i), F.get("_donor", i)).otherwise(v))
        variants = rows.select("repeat", F.col("_taken.c").alias("column"), "target", array_to_vector(swapped).alias(features))
        whole = vectors.select(F.lit(0).alias("repeat"), F.lit("").alias("column"), "target", array_to_vector("_x").alias(features))
        model = model.stages[-1]
    scored = positive_probability(model.transform(whole.unionByName(variants)))
    auc = cut_lineage(keyed_auc(scored.select("repeat", "column", "score", F.col("target").alias("label")), ["repeat", "column"]))
    base = auc.where(F.col("repeat") == 0).select("auc").scalar()
    return (auc.where(F.col("repeat") > 0).groupBy(F.col("column").alias("feature"))
            .agg(F.round(F.avg(base - F.col("auc")), 6).alias("importance"), F.round(F.stddev_pop("auc"), 6).alias("spread")))


def linear_contributions(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Per feature slot: mean |beta_j * (x_j - mean_j)| of the logistic model."""
    lr = model.stages[-1]
    beta = lr.coefficients.toArray().tolist()
    prepared = PipelineModel(stages=model.stages[:-1]).transform(data)
    names = feature_names(prepared)
    mu = prepared.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray().tolist()
    # one aggregate per slot over the dense array; as many numbers as slots reach the driver
    x = vector_to_array("features")
    slots = [F.avg(F.abs(F.lit(float(b)) * (F.get(F.col("x"), F.lit(j)) - F.lit(float(m))))).alias(f"s{j}") for j, (b, m) in enumerate(zip(beta, mu))]
    row = prepared.select(x.alias("x")).agg(*slots).first()
    return data.sparkSession.createDataFrame(
        [(names[j] if j < len(names) else f"f{j}", round(float(v), 6)) for j, v in enumerate(row)], "feature string, mean_abs_contribution double")


def score_batch(model: PipelineModel, records: DataFrame, threshold: float, version: str,
                key: str = "session_id") -> DataFrame:
    """probability (6 d), prediction = unrounded p >= threshold, model_version."""
    s = positive_probability(model.transform(records), "_p")
    return s.select(key, (F.col("_p") >= threshold).cast("int").alias("prediction"),
                    F.round("_p", 6).alias("probability"), F.lit(version).alias("model_version"))
