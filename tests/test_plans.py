"""Physical-plan properties: pushdown, pruning, no single-partition windows."""

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_pushdown_and_pruning(spark, sf):
    txt = _formatted(E.queries()["scan_projected"](spark, sf))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in txt
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string>" in txt


def test_label_filter_pushed_and_visit_number_pruned(spark, sf):
    txt = _formatted(E.queries()["label_sessions"](spark, sf))
    assert "EqualTo(l_returnflag,R)" in txt  # the filter on the action reaches the scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in txt
    assert "Window" not in txt  # the unused visit-number branch is removed


def test_evaluation_has_no_unpartitioned_window_over_rows(spark, sf):
    from convlens.operators import evaluation as EV
    from convlens.sources import testdata as td

    txt = _formatted(EV.roc_curve(td.scored_lines(spark, sf)))
    # the only single-partition window runs over the per-range totals
    for line in txt.splitlines():
        if line.strip().startswith("Arguments:") and "specifiedwindowframe" in line and "[]" in line.split(",")[0]:
            raise AssertionError(line)
    assert "BroadcastHashJoin" in txt or "BroadcastExchange" in txt


def test_slices_one_shuffle(spark, sf):
    txt = _plan(E.queries()["cr_slices"](spark, sf))
    assert "Expand" in txt


def test_record_is_parsed_once(spark, sf):
    from convlens.operators.cleaning import validate_contract
    from convlens.plans.q_ingest import _records

    for part in validate_contract(_records(spark, sf)):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_no_exchange_between_bucketed_phases(spark, tmp_path):
    from convlens.operators import cleaning, labeling
    from convlens.sources import sinks

    rows = [(f"s{i % 50}", f"2021-0{1 + i % 3}-01", i % 4) for i in range(200)]
    sessions = sinks.write_bucketed(sinks.with_visit_month(spark.createDataFrame(rows, "session_id string, visit_date string, x int")), "ph_sessions",
                                    str(tmp_path / "sessions"), buckets=4, partition_by=["visit_ym"])
    positives = spark.createDataFrame([(f"s{i}", 1) for i in range(0, 50, 3)], "session_id string, target int")
    target = sinks.write_bucketed(positives, "ph_target", str(tmp_path / "target"), buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = labeling.left_join_fill(cleaning.dedup_rows(sessions), target)
        assert "Exchange" not in _plan(joined) and joined.where("target = 1").select("session_id").distinct().count() == 17
        features = joined.groupBy("session_id").count().join(target, "session_id")
        assert "Exchange" not in _plan(features)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = [f for f in (tmp_path / "sessions").rglob("*.parquet")]
    assert len(files) <= 4 * 3  # one per bucket and month


def test_profile_has_no_expand(spark):
    from convlens.operators import profiling

    df = spark.range(100).selectExpr("id", "id % 7 AS a", "cast(null AS string) AS b")
    plan = _plan(profiling.column_profile(df))
    assert "Expand" not in plan
    got = {r.column: (r.null_pct, r.n_distinct) for r in profiling.column_profile(df).collect()}
    assert got == {"id": (0.0, 100), "a": (0.0, 7), "b": (100.0, 0)}


def test_sketches_merge_within_their_bound(spark):
    from convlens.operators import profiling

    df = spark.range(60_000).selectExpr("id % 5 AS month", "id", "id % 9000 AS a")
    parts = profiling.profile_sketches(df, by=["month"])
    got = {r.column: r for r in profiling.merged_profile(parts).collect()}
    assert abs(got["id"].n_distinct_estimate - 60_000) < 60_000 * 0.065 and abs(got["a"].n_distinct_estimate - 9000) < 9000 * 0.065
    assert got["a"].n_rows == 60_000 and (got["a"].least, got["a"].greatest) == ("0", "999")


def test_medians_without_a_buffer(spark):
    import numpy as np

    from convlens.operators import evaluation as EV
    from convlens.operators import features as FE

    rng = np.random.default_rng(2)
    rows = [(float(rng.integers(0, 90)), None if i % 4 else float(rng.normal()), None) for i in range(301)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = FE.exact_medians(df, ["a", "b", "c"])
    assert got["c"] is None and got["a"] == np.median([r[0] for r in rows]) and got["b"] == np.median([r[1] for r in rows if r[1] is not None])
    q = EV.keyed_quantiles(df, ["a", "b"], [0.0, 0.1, 0.77, 1.0])
    assert np.allclose(q["a"], np.percentile([r[0] for r in rows], [0, 10, 77, 100]))
    assert np.allclose(q["b"], np.percentile([r[1] for r in rows if r[1] is not None], [0, 10, 77, 100]))
    assert FE.MedianImputer(inputCols=["a", "b"]).fit(df).transform(df).where("b IS NULL").count() == 0


def test_tails_of_distributions(spark):
    from pyspark.sql import functions as F

    from convlens.functions import stats

    zs = [0.0, 0.3, -1.96, 5.0, 30.0]
    df = spark.createDataFrame([(z,) for z in zs] + [(None,), (float("nan"),)], "z double")
    got = [r.p for r in df.select(stats.normal_p(F.col("z")).alias("p")).collect()]
    assert got[-2:] == [None, None] and all(abs(p / stats.normal_two_sided_p(z) - 1) < 1e-6 for p, z in zip(got, zs))
    cases = [(x, k) for x in (0.0, 0.01, 2.5, 40.0, 331.98, 1200.0) for k in (1, 2, 3, 4, 7, 90, 301)]
    df = spark.createDataFrame(cases + [(None, 2), (3.0, 0)], "x double, k int")
    got = [r.p for r in df.select(stats.chi2_p(F.col("x"), F.col("k")).alias("p")).collect()]
    assert got[-2:] == [None, None]
    for p, (x, k) in zip(got, cases):
        want = stats.chi2_sf(x, k)
        assert abs(p - want) <= 1e-6 * want + 1e-300, (x, k, p, want)


def test_scratch_is_removed(spark):
    import os

    from convlens import session

    session._MADE.clear()
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.scratch_path(spark, "never-written")
    assert session.drop_scratch(spark) == 1 and session._MADE == []
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
