"""Features of a visit, unseen categories, leak guard, persistence round trip."""

import json

import pytest
from pyspark.ml import Pipeline, PipelineModel

from convlens.contracts import CATEGORICAL_FEATURES, DEFAULT_CONFIG, NUMERIC_FEATURES, assert_no_leak
from convlens.operators import features as FE
from convlens.operators.modeling import encoder_stages

VISIT = {"visit_date": "2022-12-04", "visit_time": "23:10:00", "visit_number": "4", "utm_source": "radio", "utm_medium": "Organic",
         "utm_campaign": "winter", "utm_adcontent": " ", "utm_keyword": "boots", "device_category": "desktop", "device_os": "BSD",
         "device_brand": "nan", "device_screen_resolution": "1024x0768", "device_browser": "Lynx", "geo_country": "Iceland", "geo_city": "Hella"}


def _frame(spark, rows):
    cols = list(VISIT)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


def test_features_of_a_visit(spark):
    home = {"geo_country": DEFAULT_CONFIG.home_country, "geo_city": DEFAULT_CONFIG.second_city, "visit_number": "1", "device_screen_resolution": "?"}
    r, h = (FE.build_features(_frame(spark, [x]), DEFAULT_CONFIG).first() for x in (VISIT, VISIT | home))
    assert (r.visit_hour, r.visit_day, r.is_weekend, r.visit_dow, r.visit_month, r.visit_daypart) == (23.0, 4.0, 1, "6", "12", "evening")
    assert (r.is_organic, r.is_first_visit, r.has_utm_campaign, r.has_utm_adcontent, r.has_utm_keyword) == (1, 0, 1, 0, 1)
    assert (r.screen_w, r.screen_h, r.screen_is_valid, r.device_brand) == (1024.0, 768.0, 1, "unknown")
    assert (r.is_russia, r.is_moscow, r.is_spb) == (0, 0, 0) and (h.is_russia, h.is_moscow, h.is_spb, h.is_first_visit) == (1, 0, 1, 1)
    assert (h.screen_w, h.screen_is_valid) == (None, 0)


def test_fixed_feature_order(spark):
    out = FE.build_features(_frame(spark, [VISIT]), DEFAULT_CONFIG, keep=())
    assert out.columns == list(NUMERIC_FEATURES) + list(CATEGORICAL_FEATURES)


def test_unseen_categories_same_width(spark):
    train = _frame(spark, [VISIT | {"utm_source": f"s{i % 3}", "geo_city": f"c{i % 4}"} for i in range(30)]) \
        .withColumn("session_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    model = Pipeline(stages=encoder_stages(DEFAULT_CONFIG)).fit(train)
    odd = _frame(spark, [VISIT | {"utm_source": "NEVER_SEEN_SOURCE", "geo_city": "Atlantis",
                                   "device_category": "hologram"}])
    a = model.transform(train).first().features
    b = model.transform(odd).first().features
    assert a.size == b.size
    assert all(v == v and abs(v) != float("inf") for v in b.toArray())


def test_leak_guard():
    with pytest.raises(ValueError):
        assert_no_leak(["visit_hour", "event_action"])
    with pytest.raises(ValueError):
        assert_no_leak(["session_id", "visit_hour"])
    assert_no_leak(list(NUMERIC_FEATURES) + list(CATEGORICAL_FEATURES))


def test_stages_persist(spark, tmp_path):
    train = _frame(spark, [VISIT | {"utm_source": f"s{i % 5}"} for i in range(40)])
    pipe = Pipeline(stages=[FE.SessionFeatureBuilder(cfgJson=FE.cfg_json(DEFAULT_CONFIG)),
                            FE.RareCategoryGrouper(topNJson=json.dumps({"utm_source": 2})),
                            FE.MedianImputer(inputCols=["screen_w"]),
                            FE.PopulationScaler(inputCols=["visit_hour"])])
    model = pipe.fit(train)
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = sorted(map(tuple, model.transform(train).collect()))
    b = sorted(map(tuple, loaded.transform(train).collect()))
    assert a == b
    kept = json.loads(loaded.stages[1].getOrDefault("keepJson"))["utm_source"]
    assert kept == ["s0", "s1"]
