"""Input contract: required fields, types, defaults only for absent keys, extra keys ignored."""

import json

import pytest

from convlens.contracts import MODEL_INPUT_COLUMNS
from convlens.operators.cleaning import reject_empty, validate_contract
from convlens.sources.readers import records_to_contract

VISIT = {"session_id": "v7", "utm_source": "newsletter_9", "utm_medium": "email", "device_category": "tablet", "visit_number": 12,
         "visit_date": "2023-02-03", "visit_time": "08:15:42", "geo_country": "Norway", "geo_city": "Bergen", "device_os": "Linux"}


def _run(spark, recs):
    df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in recs], "value string")
    acc, rej = validate_contract(df)
    return {r.session_id: r for r in acc.collect()}, {r.record: list(r.reasons) for r in rej.collect()}


def test_defaults_and_extra_keys(spark):
    small = {"utm_source": "x", "utm_medium": "organic", "device_category": "desktop", "session_id": "m"}
    acc, rej = _run(spark, [VISIT, small, small | {"geo_country": None, "session_id": "n", "other": [1]}])
    assert set(acc) == {"v7", "m", "n"} and not rej
    assert acc["m"].geo_country == "Russia" and acc["m"].visit_number == 1
    assert acc["n"].geo_country is None and acc["v7"].visit_number == 12 and acc["v7"].geo_city == "Bergen"


@pytest.mark.parametrize("value, number", [(2, 2), ("2", 2), (2.0, 2), (None, None)])
def test_accepted_visit_numbers(spark, value, number):
    acc, rej = _run(spark, [VISIT | {"visit_number": value}])
    assert not rej and acc["v7"].visit_number == number


def test_rejected(spark):
    cases = [(VISIT | {"visit_number": v}, ["invalid:visit_number"]) for v in (0, -1, 2.5, "two", "2.0", True, [2], 1e12)]
    cases += [(VISIT | {f: v}, [f"invalid:{f}"]) for f, v in (("utm_source", 5), ("utm_medium", ["a"]), ("geo_city", True), ("device_os", {"a": 1}))]
    cases += [(VISIT | {"utm_source": None}, ["missing:utm_source"]), ({k: v for k, v in VISIT.items() if k != "utm_medium"}, ["missing:utm_medium"]),
              ("no json", ["invalid:json"]), ("[1, 2]", ["invalid:json"])]
    _, rej = _run(spark, [c for c, _ in cases])
    assert rej == {c if isinstance(c, str) else json.dumps(c): r for c, r in cases}


def test_empty_batch_is_rejected(spark):
    with pytest.raises(ValueError):
        reject_empty(spark.createDataFrame([], "value string"))


def test_records_to_contract_order(spark):
    df = spark.createDataFrame([(json.dumps(VISIT | {"hit_page_path": "/x"}),)], "value string")
    out = records_to_contract(df)
    assert out.columns == ["session_id", *MODEL_INPUT_COLUMNS]
