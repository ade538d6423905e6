"""Steps that every query over visits shares: method sizes, one wide shuffle, equal results on own rows."""

import contextlib
import io
import re

import numpy as np
from pyspark.sql import functions as F

from convlens.contracts import MODEL_INPUT_COLUMNS, NUMERIC_FEATURES
from convlens.functions import columns as C
from convlens.operators import association as A
from convlens.operators import features as FE
from convlens.operators.ordered import sequence_within_group
from convlens.session import cut_lineage


def _visits(spark, n=60):
    rows = [(str(i), i % 2, *([f" V{i % 5} ", "(none)", None, " nan "][(i + j) % 4] for j in range(len(MODEL_INPUT_COLUMNS)))) for i in range(n)]
    df = spark.createDataFrame(rows, "session_id string, target int, " + ", ".join(f"{c} string" for c in MODEL_INPUT_COLUMNS))
    k = F.col("session_id").cast("int")
    return df.withColumns({"visit_date": F.when(k % 7 != 0, F.date_format(F.date_add(F.lit("2021-01-01").cast("date"), k), "yyyy-MM-dd")),
                           "visit_time": F.when(k % 5 != 0, F.concat((k % 24).cast("string"), F.lit(":05:09"))).otherwise("x"),
                           "visit_number": (k % 60).cast("string"), "device_screen_resolution": F.when(k % 3 > 0, "360x640").otherwise("a")})


def test_features_equal_their_expressions_and_compile(spark):
    visits = cut_lineage(_visits(spark))
    built = FE.build_features(visits)
    assert sorted(built.collect(), key=str) == sorted(visits.select("session_id", "target", *FE.feature_columns()).collect(), key=str)
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(out := io.StringIO()):
            built.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000  # larger ones are interpreted by the JVM


def test_trim_equals_the_unicode_pattern(spark):
    odd = [chr(c) for c in (*range(0x30), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    df = spark.createDataFrame([(t,) for c in odd for t in (c, f"{c}a{c}b{c}", f" {c}\na b\n{c} ")] + [(None,), ("",)], "t string")
    assert df.where(~C.strip_ws("t").eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).count() == 0


def test_sequence_shuffles_rows_once_and_cuts_hot_slices(spark):
    rows = [(None if i % 11 == 0 else i % 3, None if i % 13 == 0 else i % 2, (i * 37) % 500, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, day int, k int, wide int")
    got = {r.wide: r.seq for r in sequence_within_group(df, ["g"], "day", ["k"], "seq", max_group_rows=20, n_cuts=8).collect()}
    for g, day, k, i in rows:
        if g is not None and day is not None:
            assert got[i] == sum(1 for h, d, o, _ in rows if h == g and d is not None and (d, o) <= (day, k)) + sum(1 for h, d, *_ in rows if h == g and d is None)
    plan = sequence_within_group(df, ["g"], "day", ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    exchanged = re.findall(r"Exchange hashpartitioning\((.*?), \d+\).*\n.*?Project \[(.*?)\]|", plan)
    assert "_sub" not in "".join(a for a, _ in exchanged)  # rows are not dealt again by their sub-slice


def test_pearson_equals_numpy_over_pairs(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(1e6, 1, 300), rng.normal(0, 1, 300)
    rows = [(None if i % 7 == 0 else float(a[i]), float(a[i] + b[i]), None if i % 3 else 4.0, float(i) if i % 3 else None, float("nan") if i == 5 else 1.0 * i)
            for i in range(300)]
    cols = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.feature_a, r.feature_b): r.r for r in A.pearson_long(df, cols).collect()}
    keep = [r for r in rows if r[0] is not None]
    assert abs(got["a", "b"] - np.corrcoef([r[0] for r in keep], [r[1] for r in keep])[0, 1]) < 1e-6
    assert got["a", "c"] is None and got["c", "d"] is None and np.isnan(got["b", "e"]) and len(got) == 10
    assert got["d", "e"] is not None and np.isnan(got["d", "e"]) and got["c", "e"] is None
    plan = A.pearson_long(df, list(cols))._jdf.queryExecution().executedPlan().toString()
    assert "covar" not in plan and len(NUMERIC_FEATURES) == 16
