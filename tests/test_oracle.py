"""Registered queries against their DuckDB SQL on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FAST = ["label_sessions", "clean_dataset", "ingestion_summary", "cr_by_category", "business_splits",
        "topn_coverage", "hist_clipped", "chi2_independence", "cramers_v_matrix", "hypothesis_battery",
        "mutual_information", "build_features", "group_rare", "target_encode_oof", "roc_auc_exact",
        "calibration_table", "gains_table", "validate_contract", "split_by_time", "findings_long"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_callable_and_most_have_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(s) >= 0.75 * len(q)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["utm_medium", "n", "cr"]
    assert df.count() > 0
