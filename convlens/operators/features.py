"""Feature engineering as Spark ML stages.

* :func:`feature_columns` -- the 29 engineered features as one ``select`` of
  column expressions (stateless; re-applies the cleaning rules, so raw and
  cleaned input give equal output).
* :class:`SessionFeatureBuilder` -- that select as a ``Transformer``.
* :class:`RareCategoryGrouper` -- top-N per column learned on train; the fitted
  model keeps at most N values per column and applies them as an ``InSet``.
* :class:`MedianImputer`, :class:`PopulationScaler` -- exact median
  imputation and (x - mean) / population sd (sd = 0 -> divide by 1).
"""

from __future__ import annotations

import json
import re

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.contracts import CATEGORICAL_FEATURES, DEFAULT_CONFIG, MODEL_INPUT_COLUMNS, NUMERIC_FEATURES, ConversionConfig, assert_no_leak
from convlens.functions import columns as C
from convlens.operators.cleaning import normalize_column
from convlens.operators.evaluation import keyed_quantiles


_NORMALIZED = ("utm_medium", "utm_source", "utm_campaign", "utm_adcontent", "utm_keyword", "device_category",
               "device_os", "device_brand", "device_browser", "device_screen_resolution", "geo_country", "geo_city")


def feature_columns(cfg: ConversionConfig = DEFAULT_CONFIG) -> list:
    """Raw or cleaned visit fields -> 16 numeric + 13 categorical features, as one expression each."""
    nz = {c: normalize_column(c, cfg) for c in _NORMALIZED}
    secs = C.time_to_seconds("visit_time")
    w, h = C.screen_dims(nz["device_screen_resolution"])
    return _features(cfg, nz, C.parse_date_lenient("visit_date"), C.visit_hour(secs), C.numeric_lenient("visit_number", "int"), w, h)


def _features(cfg: ConversionConfig, nz: dict, date, hour, vn, w, h) -> list:
    """The features from normalised fields, date, hour, visit number and screen size."""
    dow = C.weekday_mon0(date)
    unk = cfg.unknown
    num = {
        "visit_hour": hour.cast("double"),
        "visit_day": F.dayofmonth(date).cast("double"),
        "visit_number_log": F.log1p(F.when(vn > cfg.visit_number_clip, F.lit(cfg.visit_number_clip))
                                    .otherwise(vn).cast("double")),
        "is_weekend": C.isin_false(dow, [5, 6]).cast("int"),
        "is_organic": C.isin_false(nz["utm_medium"], cfg.organic_mediums).cast("int"),
        "is_social": C.isin_false(nz["utm_source"], cfg.social_sources).cast("int"),
        "is_first_visit": C.eq_false(vn, 1).cast("int"),
        "has_utm_campaign": (nz["utm_campaign"] != unk).cast("int"),
        "has_utm_keyword": (nz["utm_keyword"] != unk).cast("int"),
        "has_utm_adcontent": (nz["utm_adcontent"] != unk).cast("int"),
        "is_russia": C.eq_false(nz["geo_country"], cfg.home_country).cast("int"),
        "is_moscow": C.eq_false(nz["geo_city"], cfg.capital_city).cast("int"),
        "is_spb": C.eq_false(nz["geo_city"], cfg.second_city).cast("int"),
        "screen_w": w,
        "screen_h": h,
        "screen_is_valid": w.isNotNull().cast("int"),
    }
    cat = {
        "utm_medium": nz["utm_medium"], "utm_source": nz["utm_source"], "utm_campaign": nz["utm_campaign"],
        "utm_adcontent": nz["utm_adcontent"], "utm_keyword": nz["utm_keyword"],
        "device_category": nz["device_category"], "device_os": nz["device_os"],
        "device_brand": nz["device_brand"], "device_browser": nz["device_browser"], "geo_city": nz["geo_city"],
        "visit_dow": F.coalesce(dow.cast("string"), F.lit(unk)),
        "visit_month": F.coalesce(F.month(date).cast("string"), F.lit(unk)),
        "visit_daypart": C.daypart(hour, unk),
    }
    return [num[c].alias(c) for c in NUMERIC_FEATURES] + [cat[c].alias(c) for c in CATEGORICAL_FEATURES]


def build_features(df: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                   keep: tuple[str, ...] = ("session_id", "target")) -> DataFrame:
    """29 features in fixed order, plus pass-through ``keep`` columns present.

    The expressions of ``feature_columns`` in four selects (trim and parse; judge; size; features): each field is
    parsed once, and no generated method gets so large that the JVM does not compile it."""
    passthrough = [c for c in keep if c in df.columns]
    f = lambda c: f"_f_{c}"
    trimmed = df.select(*passthrough, *[C.stripped(c, c in cfg.lowercase_columns).alias(f(c)) for c in _NORMALIZED],
                        C.parse_date_lenient("visit_date").alias(f("date")), C.time_to_seconds("visit_time").alias(f("secs")),
                        C.numeric_lenient("visit_number", "int").alias(f("vn")))
    parsed = trimmed.select(
        *passthrough, *[C.normalize_stripped(f(c), cfg.junk_tokens, cfg.unknown, cfg.preserve_by_column.get(c, ())).alias(f(c)) for c in _NORMALIZED],
        f("date"), f("vn"), C.visit_hour(f("secs")).alias(f("hour")))
    w, h = C.screen_dims(f("device_screen_resolution"))
    sized = parsed.select(*passthrough, *[f(c) for c in _NORMALIZED], f("date"), f("vn"), f("hour"),
                          w.alias(f("w")), h.alias(f("h")))
    out = sized.select(*passthrough, *_features(cfg, {c: F.col(f(c)) for c in _NORMALIZED}, *(F.col(f(c)) for c in ("date", "hour", "vn", "w", "h"))))
    assert_no_leak([c for c in out.columns if c not in passthrough])
    return out


class _CfgParams(Params):
    cfgJson = Param(Params._dummy(), "cfgJson", "ConversionConfig as JSON", TypeConverters.toString)

    def _cfg(self) -> ConversionConfig:
        raw = self.getOrDefault(self.cfgJson)
        if not raw:
            return DEFAULT_CONFIG
        d = json.loads(raw)
        for k, v in list(d.items()):
            if isinstance(v, list):
                d[k] = tuple(v)
            if k == "preserve_by_column":
                d[k] = {kk: tuple(vv) for kk, vv in v.items()}
        return ConversionConfig(**d)


def cfg_json(cfg: ConversionConfig) -> str:
    from dataclasses import asdict

    return json.dumps(asdict(cfg))


class SessionFeatureBuilder(Transformer, _CfgParams, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless raw-visit -> feature transformer (train = serve)."""

    @keyword_only
    def __init__(self, cfgJson: str = ""):
        super().__init__()
        self._setDefault(cfgJson="")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        keep = tuple(c for c in df.columns if c not in CATEGORICAL_FEATURES and c not in NUMERIC_FEATURES
                     and c not in self._cfg().model_input_columns)
        return build_features(df, self._cfg(), keep=keep)


class _GrouperParams(Params):
    topNJson = Param(Params._dummy(), "topNJson", "{column: N} as JSON", TypeConverters.toString)
    otherToken = Param(Params._dummy(), "otherToken", "replacement token", TypeConverters.toString)


def top_n_values(df: DataFrame, top_n: dict) -> DataFrame:
    """(column, value, n, rank) with rank <= N per column. The literal bound lets
    Spark insert a WindowGroupLimit before the shuffle, so each task ships at
    most N values per column."""
    cols = [c for c in top_n if c in df.columns]
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value") \
                 .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    max_n = max(int(top_n[c]) for c in cols)
    ranked = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_n)
    limit = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(top_n[c])))])
    return ranked.where(F.col("rank") <= limit[F.col("column")])


class RareCategoryGrouper(Estimator, _GrouperParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, topNJson: str = "{}", otherToken: str = "other"):
        super().__init__()
        self._setDefault(topNJson="{}", otherToken="other")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RareCategoryGrouperModel":
        top_n = json.loads(self.getOrDefault(self.topNJson))
        keep: dict[str, list[str]] = {c: [] for c in top_n if c in df.columns}
        if keep:
            # at most sum(N) rows reach the driver
            for r in top_n_values(df, top_n).orderBy("column", "rank").collect():
                keep[r["column"]].append(r["value"])
        return RareCategoryGrouperModel(keepJson=json.dumps(keep), otherToken=self.getOrDefault(self.otherToken))


class RareCategoryGrouperModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    keepJson = Param(Params._dummy(), "keepJson", "{column: [kept values]}", TypeConverters.toString)
    otherToken = Param(Params._dummy(), "otherToken", "replacement token", TypeConverters.toString)

    @keyword_only
    def __init__(self, keepJson: str = "{}", otherToken: str = "other"):
        super().__init__()
        self._setDefault(keepJson="{}", otherToken="other")
        self._set(**self._input_kwargs)

    def keep(self) -> dict:
        return json.loads(self.getOrDefault(self.keepJson))

    def _transform(self, df: DataFrame) -> DataFrame:
        other = self.getOrDefault(self.otherToken)
        repl = {c: F.when(C.isin_false(c, vals), F.col(c)).otherwise(F.lit(other))
                for c, vals in self.keep().items() if c in df.columns}
        return df.withColumns({c: e.alias(c) for c, e in repl.items()}) if repl else df


class _ColsParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)


class MedianImputer(Estimator, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median learned on train. ``relativeError = 0`` (default) is the exact
    median with linear interpolation, as numpy, of all columns from one keyed
    running sum over their distinct values (no aggregation buffer holds a column).
    A positive ``relativeError`` switches to ``percentile_approx``."""

    relativeError = Param(Params._dummy(), "relativeError", "0 = exact median", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols: list | None = None, relativeError: float = 0.0):
        super().__init__()
        self._setDefault(relativeError=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getOrDefault(self.inputCols) if self.isDefined(self.inputCols) else []
        if not cols:
            return MedianImputerModel(inputCols=[], mediansJson="{}")
        err = self.getOrDefault(self.relativeError)
        if err > 0:
            acc = int(max(1, round(1.0 / err)))
            row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, acc).alias(c) for c in cols]).first()
            return MedianImputerModel(inputCols=cols, mediansJson=json.dumps({c: row[c] for c in cols}))
        return MedianImputerModel(inputCols=cols, mediansJson=json.dumps(exact_medians(df, cols)))


class MedianImputerModel(Model, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    mediansJson = Param(Params._dummy(), "mediansJson", "{column: median}", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols: list | None = None, mediansJson: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        med = json.loads(self.getOrDefault(self.mediansJson))
        if not med:
            return df
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double"))
                               for c in self.getOrDefault(self.inputCols)})


class PopulationScaler(Estimator, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population sd; sd = 0 -> divide by 1."""

    @keyword_only
    def __init__(self, inputCols: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getOrDefault(self.inputCols) if self.isDefined(self.inputCols) else []
        if not cols:
            return PopulationScalerModel(inputCols=[], statsJson="{}")
        aggs = []
        for c in cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                     F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        stats = {c: [row[f"m_{c}"], row[f"s_{c}"]] for c in cols}
        return PopulationScalerModel(inputCols=cols, statsJson=json.dumps(stats))


class PopulationScalerModel(Model, _ColsParams, DefaultParamsReadable, DefaultParamsWritable):
    statsJson = Param(Params._dummy(), "statsJson", "{column: [mean, sd]}", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols: list | None = None, statsJson: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.statsJson))
        if not st:
            return df
        out = {}
        for c in self.getOrDefault(self.inputCols):
            m, s = st[c]
            s = 1.0 if (s is None or s == 0) else s
            out[c] = (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(s)
        return df.withColumns(out)


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in keyed_quantiles(df, list(cols), [0.5]).items()}


def median_impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians (len(cols) numbers reach the driver), applied as literals."""
    row = exact_medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(row[c]).cast("double")) for c in cols})


def one_hot_long(df: DataFrame, vocab: DataFrame, cats: list[str], key: str = "session_id") -> DataFrame:
    """One-hot in long (sparse) form: one (key, feature, value) row per active
    indicator; values outside the fitted vocabulary (unseen) give no row, i.e.
    an all-zero block. ``vocab`` is (feature, value) -- a few values per column
    after rare grouping; AQE broadcasts it by its runtime size."""
    long = df.select(key, *[F.col(c).cast("string").alias(c) for c in cats]).unpivot([key], cats, "feature", "value")
    return long.join(vocab.select("feature", "value").distinct(), ["feature", "value"], "inner")


def vocabulary(df: DataFrame, cats: list[str]) -> DataFrame:
    """Distinct (feature, value) pairs of the categorical columns."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cats]).unpivot([], cats, "feature", "value")
    return long.where(F.col("value").isNotNull()).distinct()


def _long_stats(df: DataFrame, cols: list[str], target: str, by: list[str]) -> DataFrame:
    """(feature, value, *by, cnt, pos) of all columns from one aggregate, cut from its lineage: the joins below read it as a
    small table instead of repeating the aggregate per column."""
    from convlens.session import cut_lineage

    long = df.select(*by, F.col(target).cast("double").alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols])
    stats = long.unpivot([*by, "_y"], cols, "_feature", "_value").groupBy("_feature", "_value", *by).agg(
        F.count(F.lit(1)).cast("double").alias("_cnt"), F.sum("_y").alias("_pos"))
    return cut_lineage(stats)


def target_encode(train: DataFrame, apply_to: DataFrame, cols: list[str], target: str = "target",
                  smoothing: float = 1.0, suffix: str = "_te") -> DataFrame:
    """Smoothed target mean per category, fitted on ``train``:
    (pos + smoothing * prior) / (n + smoothing); unseen and NULL -> prior.
    The per-category table grows with cardinality, so it is joined normally: AQE broadcasts it when its runtime
    size is small, which also spares the hot categories a shuffle, and splits hot ones otherwise."""
    stats = _long_stats(train, cols, target, [])
    total = stats.where(F.col("_feature") == cols[0]).agg(F.sum("_pos"), F.sum("_cnt")).first()
    prior = F.lit(total[0] / total[1] if total[1] else None).cast("double")
    out = apply_to
    for c in cols:
        st = stats.where(F.col("_feature") == c).select(
            F.col("_value").alias(f"_v_{c}"),
            ((F.col("_pos") + smoothing * prior) / (F.col("_cnt") + smoothing)).alias(f"_e_{c}"))
        out = out.join(st, F.col(c).cast("string") == F.col(f"_v_{c}"), "left") \
                 .withColumn(c + suffix, F.coalesce(F.col(f"_e_{c}"), prior)).drop(f"_v_{c}", f"_e_{c}")
    return out


def target_encode_oof(df: DataFrame, cols: list[str], key: str = "session_id", target: str = "target",
                      folds: int = 5, smoothing: float = 1.0, seed: int = 42, suffix: str = "_te") -> DataFrame:
    """Out-of-fold encoding for training rows: a row in fold f is encoded with
    statistics of the other folds (category total minus its own fold), so its
    own label never enters its feature. Folds are key hashes; all columns' (category, fold) counts come from one
    aggregate and are differenced by a window bounded by ``folds`` rows per category."""
    from convlens.operators.splits import hash_unit

    d = df.withColumn("_fold", hash_unit(key, seed, "fold") % folds)
    stats = _long_stats(d, cols, target, ["_fold"])
    per_fold = {r[0]: (r[1], r[2]) for r in stats.where(F.col("_feature") == cols[0]).groupBy("_fold").agg(
        F.sum("_pos"), F.sum("_cnt")).collect()}  # one row per fold
    pos, cnt = (sum(v[i] for v in per_fold.values()) for i in (0, 1))
    prior = F.lit(None).cast("double")
    for f, (p, n) in per_fold.items():
        prior = F.when(F.col("_fold") == f, F.lit((pos - p) / (cnt - n) if cnt > n else None).cast("double")).otherwise(prior)
    w = Window.partitionBy("_feature", "_value")
    others = stats.select("_feature", "_value", F.col("_fold").alias("_f"), (F.sum("_cnt").over(w) - F.col("_cnt")).alias("_oc"),
                          (F.sum("_pos").over(w) - F.col("_pos")).alias("_op"))
    out = d
    for c in cols:
        st = others.where(F.col("_feature") == c).select("_value", "_f", "_oc", "_op")
        out = out.join(st, F.col(c).cast("string").eqNullSafe(F.col("_value")) & (F.col("_fold") == F.col("_f")), "left")
        enc = (F.col("_op") + smoothing * prior) / (F.col("_oc") + smoothing)
        out = out.withColumn(c + suffix, F.coalesce(enc, prior)).drop("_value", "_f", "_oc", "_op")
    return out.drop("_fold")


# Where each engineered feature comes from and how the model sees it
# (documentation rows; joined to data-derived statistics, never used alone).


def _columns_read(column) -> list[str]:
    """The visit fields that a feature's expression names, most used first."""
    text = str(column)
    return sorted((c for c in MODEL_INPUT_COLUMNS if re.search(rf"\b{c}\b", text)), key=lambda c: -len(re.findall(rf"\b{c}\b", text)))


def columns_by_feature(cfg: ConversionConfig = DEFAULT_CONFIG) -> dict[str, list[str]]:
    """Of every feature the visit fields that its expression names."""
    return {f: _columns_read(c) for f, c in zip([*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], feature_columns(cfg))}


def feature_sources(cfg: ConversionConfig = DEFAULT_CONFIG) -> dict[str, tuple[str, str]]:
    """Of every feature the visit field that it is made of and its kind, read off the builder's own expressions: a category, a
    number, or a flag (cast to a whole number)."""
    out = {}
    for name, column in zip([*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], feature_columns(cfg)):
        kind = "category" if name in CATEGORICAL_FEATURES else "flag" if name.startswith(("is_", "has_")) or name.endswith("_is_valid") else "numeric"
        out[name] = _columns_read(column)[0], kind
    return out


def feature_dictionary(spark, mi_by_feature: DataFrame) -> DataFrame:
    """(feature, source, kind, encoding, mi): the 29 feature specs joined to
    the mutual information measured on the data (one row per feature)."""
    spec = spark.createDataFrame(
        [(f, src, kind, "one-hot after top-N grouping" if kind == "category" else "median impute + scale")
         for f, (src, kind) in feature_sources().items()],
        "feature string, source string, kind string, encoding string")
    return spec.join(mi_by_feature.select("feature", "mi"), "feature", "left")
