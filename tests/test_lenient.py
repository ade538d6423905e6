"""Lenient parsing never fails a job, and tails of the chi-square distribution."""

import datetime

import pytest
from pyspark.sql import functions as F

from convlens.functions import columns as C
from convlens.functions.stats import chi2_sf
from convlens.operators import profiling


def test_times(spark):
    cases = {"10:00:00": 36000, "30:00:01": 108001, " 90.4 ": 90, "nan": None, "NaN": None, "Infinity": None, "-inf": None, "1e12": None,
             "99999999999:00:00": None, "99999999999999999999999:00:00": None, "": None, "x": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.s for r in df.select("t", C.time_to_seconds("t").alias("s")).collect()} == cases


def test_numbers(spark):
    cases = {"3": 3, "3.0": 3, "1e2": 100, " -7 ": -7, "3.5": None, "nan": None, "1e12": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.n for r in df.select("t", C.numeric_lenient("t").alias("n")).collect()} == cases
    assert df.where("t = '1e12'").select(C.numeric_lenient("t", "bigint")).first()[0] == 10 ** 12


def test_dates(spark):
    day = datetime.date(2021, 3, 4)
    df = spark.createDataFrame([("2021-03-04", day, datetime.datetime(2021, 3, 4, 5, 6, 7, 800000))], "s string, d date, t timestamp")
    assert list(df.select(*[C.parse_date_lenient(c) for c in ("s", "d", "t", F.lit("2021-02-30"), F.lit("04.03.2021"))]).first()) == [day] * 3 + [None] * 2


@pytest.mark.parametrize("x, dof, p", [(60, 40, 0.0219), (3.841459, 1, 0.05), (5.991465, 2, 0.05), (124.342113, 100, 0.05), (1074.679449, 1000, 0.05),
                                       (5165.613, 5000, 0.05), (4000, 800, 0.0), (3000, 801, 0.0), (50000, 2000, 0.0), (0, 5, 1.0), (700, 800, 0.9953)])
def test_chi2_tail(x, dof, p):
    assert chi2_sf(x, dof) == pytest.approx(p, abs=6e-4)


def test_summary_counts_a_repeated_session_once(spark):
    sessions = spark.createDataFrame([("a", "2021-01-01"), ("a", "2021-01-01"), ("b", "2021-01-02")], "session_id string, visit_date string")
    hits = spark.createDataFrame([("a", "R"), ("z", "R")], "session_id string, event_action string")
    from convlens.plans.frames import CFG
    r = profiling.ingestion_summary(sessions, hits, CFG).first()
    assert (r.n_sessions, r.n_unique_ids, r.n_target, r.n_hit_sessions, r.n_matched_hit_sessions, r.key_unique) == (3, 2, 1, 2, 1, 0)



def test_ordered_prefix_over_many_ranges(spark):
    from convlens.operators.ordered import ordered_prefix
    df = spark.range(5000).selectExpr("cast((id * 7919) % 5000 as double) / 7 AS k", "1 AS one")
    for range_rows in (2, 37, 100_000):
        got = ordered_prefix(df, "k", ["one"], range_rows=range_rows).collect()
        assert [r.cum_one for r in sorted(got, key=lambda r: r.k)] == list(range(1, 5001))
    assert ordered_prefix(df.limit(0), "k", ["one"]).collect() == []
