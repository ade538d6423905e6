"""Formula goldens from published counts; Cramer's V on fixed 2x2 tables."""

import math

from pyspark.sql import functions as F

from convlens.functions.stats import chi2_sf, normal_two_sided_p
from convlens.operators import association as A


def _counts(spark, cells):
    rows = [("t", str(a), str(b), n) for (a, b), n in cells.items()]
    return spark.createDataFrame(rows, "pair string, a_val string, b_val string, n long")


def test_cramers_v_extremes(spark):
    strong = A.chi2_from_counts(_counts(spark, {(0, 0): 100, (1, 1): 100}), ["pair"]).first()
    flat = A.chi2_from_counts(_counts(spark, {(0, 0): 50, (0, 1): 50, (1, 0): 50, (1, 1): 50}), ["pair"]).first()
    assert strong.cramers_v > 0.95
    assert flat.cramers_v is None or flat.cramers_v < 0.05


def test_chi2_matches_full_table(spark):
    cells = {(0, 0): 30, (0, 1): 10, (1, 0): 5, (1, 2): 25, (2, 1): 12}
    got = A.chi2_from_counts(_counts(spark, cells), ["pair"]).first().chi2_raw
    rows = {a for a, _ in cells}
    cols = {b for _, b in cells}
    n = sum(cells.values())
    ra = {a: sum(v for (x, _), v in cells.items() if x == a) for a in rows}
    cb = {b: sum(v for (_, y), v in cells.items() if y == b) for b in cols}
    want = sum((cells.get((a, b), 0) - ra[a] * cb[b] / n) ** 2 / (ra[a] * cb[b] / n) for a in rows for b in cols)
    assert math.isclose(got, want, rel_tol=1e-9)


def test_yates_2x2(spark):
    cells = {(0, 0): 20, (0, 1): 5, (1, 0): 7, (1, 1): 18}
    got = A.chi2_from_counts(_counts(spark, cells), ["pair"], yates_2x2=True).first().chi2
    n = 50
    ra, cb = {0: 25, 1: 25}, {0: 27, 1: 23}
    want = 0.0
    for (a, b), o in cells.items():
        e = ra[a] * cb[b] / n
        d = abs(e - o)
        want += (d - min(0.5, d)) ** 2 / e
    assert math.isclose(got, want, rel_tol=1e-9)


def test_published_z_statistics(spark):
    cases = [((515659, 20812, 1344383, 29502), 69.30003645949785),
             ((1376349, 32366, 483693, 17948), -50.11755859662078),
             ((274227, 4021, 1585815, 46293), -43.30362505796128)]
    rows = [(n1, float(x1), n2, float(x2)) for (n1, x1, n2, x2), _ in cases]
    df = spark.createDataFrame(rows, "n_group long, x_group double, n_rest long, x_rest double")
    got = [r.z for r in df.select(*A._z_columns()).collect()]
    for g, (_, want) in zip(got, cases):
        assert abs(g - want) < 1e-5


def test_published_cramers_v_from_chi2(spark):
    df = spark.createDataFrame([(331.98589948992753, 1860042.0, 3.0, 2.0)], "chi2 double, n double, r double, k double")
    v = df.select(A.cramers_v_expr("chi2", "n", "r", "k").alias("v")).first().v
    assert round(v, 4) == 0.0133


def test_pvalues_closed_form():
    assert math.isclose(chi2_sf(331.98589948992753, 2), math.exp(-331.98589948992753 / 2), rel_tol=1e-12)
    assert abs(normal_two_sided_p(1.959963984540054) - 0.05) < 1e-9
    assert abs(chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf(7.814727903251178, 3) - 0.05) < 1e-9
    assert abs(chi2_sf(11.070497693516351, 5) - 0.05) < 1e-9


def test_z_squared_equals_2x2_chi2(spark):
    rows = [(1, 1)] * 30 + [(1, 0)] * 70 + [(0, 1)] * 15 + [(0, 0)] * 85
    df = spark.createDataFrame(rows, "g int, target int")
    z = A.two_proportion_z(df, "g").first().z
    chi = A.chi2_from_counts(A.crosstab_long(df, "g", "target").select(
        F.lit("p").alias("pair"), F.col("g").cast("string").alias("a_val"),
        F.col("target").cast("string").alias("b_val"), "n"), ["pair"]).first().chi2_raw
    assert math.isclose(z * z, chi, rel_tol=1e-5)


def test_matrix_equals_separate_crosstabs(spark):
    rows = [(a % 3, (a * 7) % 4, (a * 5) % 2) for a in range(200)]
    df = spark.createDataFrame(rows, "x int, y int, z int")
    m = {(r.feature_a, r.feature_b): r.cramers_v for r in A.association_matrix(df, ["x", "y", "z"]).collect()}
    for a, b in (("x", "y"), ("x", "z"), ("y", "z")):
        single = A.chi2_from_counts(A.crosstab_long(df, a, b).select(
            F.lit("p").alias("pair"), F.col(a).cast("string").alias("a_val"),
            F.col(b).cast("string").alias("b_val"), "n"), ["pair"]).first().cramers_v
        want = None if single is None else round(single, 6)
        assert m[(a, b)] == want and m[(b, a)] == want
    assert m[("x", "x")] == 1.0


def test_vif_matches_numpy(spark, sf):
    import numpy as np

    from convlens.contracts import NUMERIC_FEATURES
    from convlens.operators import features as FE
    from convlens.plans import frames
    from convlens.plans.q_association import vif_table

    f = FE.build_features(frames.dataset(spark, sf), frames.CFG)
    cols = list(NUMERIC_FEATURES)
    got = {r.feature: r.vif for r in vif_table(f, cols).collect()}
    pdf = f.select(cols).toPandas().astype(float)
    pdf = pdf.fillna(pdf.median())
    live = [c for c in cols if pdf[c].std(ddof=0) > 0]
    inv = np.linalg.inv(np.corrcoef(pdf[live].to_numpy(), rowvar=False))
    for k, c in enumerate(live):
        assert abs(got[c] - inv[k, k]) < 1e-3 * max(1.0, inv[k, k]), c
