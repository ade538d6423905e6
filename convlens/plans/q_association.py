"""Association, hypothesis and feature-diagnostic queries."""

from __future__ import annotations

import itertools
import json

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from convlens.contracts import NUMERIC_FEATURES
from convlens.functions import columns as C
from convlens.operators import association as A
from convlens.operators import features as FE
from convlens.plans import frames
from convlens.plans.oracle import CFG, EDA_BASE, FEATURE_BASE, grouped_top, with_
from convlens.plans.registry import register
from convlens.session import cut_lineage

W = with_(*EDA_BASE)


def _v_sql(chi2: str, n: str, r: str, k: str) -> str:
    phi2c = f"greatest(0.0, ({chi2}) / {n} - ({k} - 1) * ({r} - 1) / ({n} - 1.0))"
    rc = f"({r} - ({r} - 1) * ({r} - 1) / ({n} - 1.0))"
    kc = f"({k} - ({k} - 1) * ({k} - 1) / ({n} - 1.0))"
    denom = f"least({kc} - 1, {rc} - 1)"
    return f"CASE WHEN {n} > 1 AND {denom} > 0 THEN sqrt({phi2c} / {denom}) END"


def _chi_sql(pairs_cte: str, by: str) -> str:
    """SQL: per table stats from a long count CTE (by..., a_val, b_val, n)."""
    return f""", cells AS (SELECT *, CAST(sum(n) OVER (PARTITION BY {by}, a_val) AS DOUBLE) AS ra,
                      CAST(sum(n) OVER (PARTITION BY {by}, b_val) AS DOUBLE) AS cb FROM {pairs_cte}),
per AS (SELECT {by}, CAST(sum(n) AS DOUBLE) AS nn, count(DISTINCT a_val) AS r, count(DISTINCT b_val) AS k,
               sum(CAST(n AS DOUBLE) * n / (ra * cb)) AS s FROM cells GROUP BY {by}),
st AS (SELECT *, nn * s - nn AS chi2_raw FROM per)
"""


@register("crosstab_long", W + """
SELECT device_category, utm_medium, CAST(count(*) AS BIGINT) AS n FROM eda
WHERE device_category IS NOT NULL AND utm_medium IS NOT NULL GROUP BY 1, 2""")
def crosstab_long(spark, sf):
    return A.crosstab_long(frames.eda(spark, sf), "device_category", "utm_medium")


def _chi_query(a: str, b: str):
    yates = f"""
, grid AS (SELECT x.pair, x.a_val, y.b_val, x.ra, y.cb FROM (SELECT DISTINCT pair, a_val, ra FROM cells) x
           JOIN (SELECT DISTINCT pair, b_val, cb FROM cells) y ON x.pair = y.pair),
full_ AS (SELECT g.*, coalesce(CAST(c.n AS DOUBLE), 0.0) AS o, p.nn FROM grid g
          LEFT JOIN cells c ON c.pair = g.pair AND c.a_val = g.a_val AND c.b_val = g.b_val
          JOIN per p ON p.pair = g.pair),
yt AS (SELECT pair, sum((abs(ra * cb / nn - o) - least(0.5, abs(ra * cb / nn - o))) ^ 2 / (ra * cb / nn)) AS chi2_y
       FROM full_ GROUP BY pair)"""
    sql = (W + f", pairs AS (SELECT '{a}|{b}' AS pair, CAST({a} AS VARCHAR) AS a_val, CAST({b} AS VARCHAR) AS b_val,"
           f" count(*) AS n FROM eda WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 2, 3)"
           + _chi_sql("pairs", "pair") + yates + f"""
SELECT st.pair, CAST(nn AS BIGINT) AS n, CAST(r AS BIGINT) AS r, CAST(k AS BIGINT) AS k,
       CAST((r - 1) * (k - 1) AS INTEGER) AS dof,
       round(CASE WHEN (r - 1) * (k - 1) = 1 THEN yt.chi2_y ELSE chi2_raw END, 6) AS chi2,
       round({_v_sql('chi2_raw', 'nn', 'r', 'k')}, 6) AS cramers_v
FROM st LEFT JOIN yt ON st.pair = yt.pair""")

    def run(spark, sf):
        s = A.chi2_independence(frames.eda(spark, sf), a, b)
        return s.select("pair", F.col("N").cast("bigint").alias("n"), F.col("r").cast("bigint").alias("r"),
                        F.col("k").cast("bigint").alias("k"), "dof", C.round6("chi2").alias("chi2"),
                        C.round6("cramers_v").alias("cramers_v"))
    return sql, run


for _name, (_a, _b) in (("chi2_independence", ("device_category", "target")),
                        ("chi2_yates_2x2", ("is_organic", "target")),
                        ("cramers_v", ("utm_source", "target"))):
    _sql, _run = _chi_query(_a, _b)
    register(_name, _sql)(_run)


# --- D22 / D23: pairwise V over grouped features ---------------------------------
_MATRIX_TOP = {"utm_medium": 15, "device_os": 10, "device_browser": 10}
_MATRIX_COLS = ["utm_medium", "device_category", "device_os", "device_browser", "geo_region", "is_organic",
                "is_social", "is_first_visit", "visit_daypart", "target"]


def _matrix_frame(eda):
    grouper = FE.RareCategoryGrouper(topNJson=json.dumps(_MATRIX_TOP)).fit(eda)
    return grouper.transform(eda)


_FX = (W + ", " + grouped_top("eda", "g", _MATRIX_TOP) + ",\nfx AS (SELECT "
       + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _MATRIX_COLS) + " FROM g)")
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {a} AS a_val, {b} AS b_val, count(*) AS n FROM fx "
    f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 3, 4"
    for a, b in itertools.combinations(_MATRIX_COLS, 2))
_MATRIX_SQL = (_FX + f", pairs AS ({_PAIRS})" + _chi_sql("pairs", "feature_a, feature_b")
               + f", v AS (SELECT feature_a, feature_b, round({_v_sql('chi2_raw', 'nn', 'r', 'k')}, 6) AS cramers_v"
               " FROM st)")


@register("cramers_v_matrix", _MATRIX_SQL + """
SELECT feature_a, feature_b, cramers_v FROM v
UNION ALL SELECT feature_b, feature_a, cramers_v FROM v
UNION ALL SELECT c, c, 1.0 FROM (VALUES """ + ", ".join(f"('{c}')" for c in _MATRIX_COLS) + ") t(c)")
def cramers_v_matrix(spark, sf):
    return A.association_matrix(_matrix_frame(frames.eda(spark, sf)), _MATRIX_COLS)


@register("target_association", _MATRIX_SQL + """
SELECT feature_a AS feature, round(cramers_v, 4) AS cramers_v FROM v WHERE feature_b = 'target'""")
def target_association(spark, sf):
    return _target_association(cut_lineage(frames.eda(spark, sf).select(*_MATRIX_COLS)))  # read to fit the grouping and to apply it


def _target_association(eda):
    m = A.association_matrix(_matrix_frame(eda), _MATRIX_COLS)
    return m.where((F.col("feature_b") == "target") & (F.col("feature_a") != "target")) \
            .select(F.col("feature_a").alias("feature"), F.round("cramers_v", 4).alias("cramers_v"))


# --- D24 / D25: z-tests and the hypothesis battery --------------------------------
def _z_sql(mask: str) -> str:
    return f"""SELECT CAST(count(*) FILTER (WHERE {mask} = 1) AS BIGINT) AS n_group,
       CAST(sum(target) FILTER (WHERE {mask} = 1) AS DOUBLE) AS x_group,
       CAST(count(*) FILTER (WHERE {mask} <> 1) AS BIGINT) AS n_rest,
       CAST(sum(target) FILTER (WHERE {mask} <> 1) AS DOUBLE) AS x_rest FROM eda"""


def _z_cols() -> str:
    return ("round(x_group / n_group, 6) AS cr_group, round(x_rest / n_rest, 6) AS cr_rest, "
            "round((x_group / n_group - x_rest / n_rest) / sqrt(((x_group + x_rest) / (n_group + n_rest)) * "
            "(1 - (x_group + x_rest) / (n_group + n_rest)) * (1.0 / n_group + 1.0 / n_rest)), 6) AS z")


@register("two_proportion_z", W + f"SELECT *, {_z_cols()} FROM ({_z_sql('is_organic')}) t")
def two_proportion_z(spark, sf):
    return A.two_proportion_z(frames.eda(spark, sf), "is_organic")


_dev_sql, _ = _chi_query("device_category", "target")
_BATTERY_SQL = (_dev_sql.split("\nSELECT st.pair")[0] + "\n" + " UNION ALL ".join(
    f"SELECT '{hid}' AS id, '{mask}' AS factor, 'z' AS test, z AS statistic, CAST(NULL AS INTEGER) AS dof, "
    f"n_group, n_rest, cr_group, cr_rest, CAST(NULL AS DOUBLE) AS cramers_v "
    f"FROM (SELECT *, {_z_cols()} FROM ({_z_sql(mask)}) t0) t"
    for hid, mask in (("H1", "is_organic"), ("H3", "is_first_visit"), ("H4", "is_social")))
    + f""" UNION ALL SELECT 'H2', 'device_category', 'chi2',
       round(CASE WHEN (r - 1) * (k - 1) = 1 THEN yt.chi2_y ELSE chi2_raw END, 6),
       CAST((r - 1) * (k - 1) AS INTEGER), CAST(nn AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE),
       CAST(NULL AS DOUBLE), round({_v_sql('chi2_raw', 'nn', 'r', 'k')}, 4)
FROM st LEFT JOIN yt ON st.pair = yt.pair""")


@register("hypothesis_battery", _BATTERY_SQL)
def hypothesis_battery(spark, sf):
    return A.hypothesis_battery(frames.eda(spark, sf))


def _p_sql() -> str:
    """The p-value of a row: the same fit of erfc, and the chi-square series in closed terms."""
    from convlens.functions.stats import ERFC_FIT

    def erfc(x: str) -> str:
        t, power = f"(1.0 / (1.0 + 0.5 * {x}))", str(ERFC_FIT[-1])
        for c in reversed(ERFC_FIT[:-1]):
            power = f"({power} * {t} + ({c}))"
        return f"({t} * exp({power} - {x} * {x}))"

    term = "exp((i + dof % 2 / 2.0) * ln(raw / 2) - lgamma(i + dof % 2 / 2.0 + 1) - raw / 2)"
    chi = f"least(1.0, CASE WHEN dof % 2 = 1 THEN {erfc('sqrt(raw / 2)')} ELSE 0.0 END + list_sum(list_transform(range(0, dof // 2), lambda i: {term})))"
    return f"CASE WHEN test = 'z' THEN {erfc('(abs(raw) / sqrt(2.0))')} ELSE {chi} END"


_RAW_BATTERY_SQL = (_BATTERY_SQL.replace("z AS statistic", "zr AS raw").replace(_z_cols(), _z_cols() + ", " + _z_cols().split("cr_rest, ")[1][6:].rsplit(", 6)", 1)[0] + " AS zr")
                    .replace("round(CASE WHEN (r - 1) * (k - 1) = 1 THEN yt.chi2_y ELSE chi2_raw END, 6),\n       CAST((r", "CASE WHEN (r - 1) * (k - 1) = 1 THEN yt.chi2_y ELSE chi2_raw END,\n       CAST((r"))
_VERDICTS_SQL = f"""SELECT id, factor, test, round(raw, 6) AS statistic, dof, n_group, n_rest, cr_group, cr_rest, cramers_v,
       round(p, 6) AS pvalue, CAST({CFG.alpha} AS DOUBLE) AS alpha, CAST({CFG.alpha / 4} AS DOUBLE) AS bonferroni_alpha, CAST(p < {CFG.alpha / 4} AS INTEGER) AS reject_h0
FROM (SELECT *, {_p_sql()} AS p FROM ({_RAW_BATTERY_SQL}) b0) b1"""


@register("hypothesis_verdicts", _VERDICTS_SQL)
def hypothesis_verdicts(spark, sf):
    """Battery + p-values of the unrounded statistics + Bonferroni."""
    return A.with_pvalues(A.raw_battery(frames.eda(spark, sf)), CFG.alpha, 4)


# --- D26-D30: correlation, VIF, MI, chi2 scores over engineered features -----------
def features(spark, sf):
    return FE.build_features(frames.dataset(spark, sf), CFG)


def kept_features(spark, sf, *columns):
    """``columns`` of the features, cut from the cleaning lineage: for what reads them more than once."""
    return cut_lineage(features(spark, sf).select("target", *columns))


WF = with_(*FEATURE_BASE)
_PEARSON = list(NUMERIC_FEATURES)


@register("pearson_matrix", WF + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(CASE WHEN isnan(r) OR isinf(r) THEN NULL ELSE r END, 6) AS r "
    f"FROM (SELECT corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM features) t"
    for a, b in itertools.combinations(_PEARSON, 2)))
def pearson_matrix(spark, sf):
    return A.pearson_long(features(spark, sf), _PEARSON)


@register("vif_pair", WF + """
, m AS (SELECT median(visit_hour) AS mh, median(visit_number_log) AS mv FROM features),
imp AS (SELECT coalesce(visit_hour, mh) AS a, coalesce(visit_number_log, mv) AS b FROM features, m)
SELECT round(1.0 / (1.0 - corr(a, b) * corr(a, b)), 6) AS vif FROM imp""")
def vif_pair(spark, sf):
    f = FE.median_impute(kept_features(spark, sf, "visit_hour", "visit_number_log"), ["visit_hour", "visit_number_log"])
    r = F.corr("visit_hour", "visit_number_log")
    return f.agg(C.round6(F.lit(1.0) / (F.lit(1.0) - r * r)).alias("vif"))


def vif_table(df, cols: list[str]):
    """VIF = diag(inv(R)) of the correlation matrix of median-imputed columns.

    One aggregate pass collects count, sums and cross-products (p + p(p+1)/2
    numbers for p columns reach the driver); R and its inverse are p x p
    driver-side arithmetic. Zero-variance columns get NULL."""
    imp = FE.median_impute(df, cols)
    p = len(cols)
    idx = [(i, j) for i in range(p) for j in range(i, p)]
    x = [F.col(c).cast("double") for c in cols]
    row = imp.agg(F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(p)],
                  *[F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i, j in idx]).first()
    n = float(row["n"])
    mean = np.array([row[f"s{i}"] / n for i in range(p)])
    cov = np.zeros((p, p))
    for i, j in idx:
        cov[i, j] = cov[j, i] = row[f"q{i}_{j}"] / n - mean[i] * mean[j]
    sd = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    live = [i for i in range(p) if sd[i] > 1e-12 * max(1.0, abs(mean[i]))]
    R = cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
    try:
        inv = np.linalg.inv(R)
    except np.linalg.LinAlgError:
        inv = np.linalg.pinv(R)
    vif = {cols[i]: float(inv[k, k]) for k, i in enumerate(live)}
    rows = [(c, round(vif[c], 4) if c in vif else None, int(c in vif and vif[c] > 10)) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double, above_10 int")


def _vif_sql(cols: list[str]) -> str:
    """The diagonal of the inverse correlation matrix by Gauss-Jordan elimination, a column a step."""
    n = len(cols)
    corr = lambda a, b: "1.0" if a == b else f"corr({min(a, b)}, {max(a, b)})"
    rows = ", ".join("[" + ", ".join([*(corr(a, b) for b in cols), *("1.0" if i == j else "0.0" for j in range(n))]) + "]" for i, a in enumerate(cols))
    names = ", ".join(f"'{c}'" for c in cols)
    return WF.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, med AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in cols)} FROM features),
imp AS (SELECT {', '.join(f'coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}' for c in cols)} FROM features, med),
start AS (SELECT [{rows}] AS m FROM imp),
gj AS (SELECT 1 AS k, m FROM start UNION ALL
       SELECT k + 1, list_transform(range(1, {n + 1}), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda x: x / m[k][k])
              ELSE list_transform(range(1, {2 * n + 1}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END) FROM gj WHERE k <= {n}),
v AS (SELECT unnest([{names}]) AS feature, unnest(list_transform(range(1, {n + 1}), lambda i: m[i][{n} + i])) AS vif FROM gj WHERE k = {n + 1})
SELECT feature, round(vif, 4) AS vif, CAST(vif > 10 AS INTEGER) AS above_10 FROM v"""


@register("vif", _vif_sql(list(NUMERIC_FEATURES)))
def vif(spark, sf):
    return vif_table(kept_features(spark, sf, *NUMERIC_FEATURES), list(NUMERIC_FEATURES))


_CATS = ("utm_medium", "utm_source", "utm_campaign", "utm_adcontent", "utm_keyword", "device_category",
         "device_os", "device_brand", "device_browser", "geo_city", "visit_dow", "visit_month", "visit_daypart")


def grouped_features(spark, sf, kept=None):
    f = kept_features(spark, sf, *_CATS) if kept is None else kept
    return FE.RareCategoryGrouper(topNJson=json.dumps(CFG.top_n_by_column)).fit(f).transform(f)


_GF = WF + ", " + grouped_top("features", "gf", CFG.top_n_by_column)
_IND = (_GF + ", ind AS (UNPIVOT (SELECT target, " + ", ".join(_CATS) + " FROM gf) ON " + ", ".join(_CATS)
        + " INTO NAME feature VALUE value),\n"
        "ic AS (SELECT feature, value, CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) AS n1, "
        "CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) AS n0 FROM ind GROUP BY 1, 2),\n"
        "tt AS (SELECT CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) AS tot1, "
        "CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) AS tot0 FROM gf)")


def _mi_cell(o: str, nx: str, ny: str) -> str:
    return f"CASE WHEN {o} > 0 THEN ({o}) / (tot1 + tot0) * ln(({o}) * (tot1 + tot0) / (({nx}) * ({ny}))) ELSE 0.0 END"


_MI_EXPR = " + ".join([
    _mi_cell("n1", "n1 + n0", "tot1"), _mi_cell("n0", "n1 + n0", "tot0"),
    _mi_cell("tot1 - n1", "tot1 + tot0 - n1 - n0", "tot1"), _mi_cell("tot0 - n0", "tot1 + tot0 - n1 - n0", "tot0")])
_MI_CTE = _IND + f", mi AS (SELECT feature, value, feature || '_' || value AS \"column\", {_MI_EXPR} AS mi FROM ic, tt)"


@register("mutual_information", _MI_CTE + """
SELECT "column", round(mi, 6) AS mi FROM mi ORDER BY round(mi, 6) DESC, "column" LIMIT 30""")
def mutual_information(spark, sf):
    mi = A.onehot_mi(grouped_features(spark, sf), list(_CATS))
    return mi.select("column", C.round6("mi").alias("mi")).orderBy(F.desc("mi"), "column").limit(30)


@register("mi_by_feature", _MI_CTE + """
SELECT feature, round(sum(mi), 6) AS mi FROM mi GROUP BY feature""")
def mi_by_feature(spark, sf, kept=None):
    mi = A.onehot_mi(grouped_features(spark, sf, kept), list(_CATS))
    return mi.groupBy("feature").agg(C.round6(F.sum("mi")).alias("mi"))


@register("mi_numeric", WF + ", long AS (SELECT target, feature, value FROM (SELECT target, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in NUMERIC_FEATURES) + " FROM features) UNPIVOT INCLUDE NULLS (value FOR feature IN ("
    + ", ".join(NUMERIC_FEATURES) + """))),
cnt AS (SELECT feature, value, target AS y, count(*) AS n FROM long GROUP BY 1, 2, 3),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS nn,
             CAST(sum(n) OVER (PARTITION BY feature, value) AS DOUBLE) AS nx,
             CAST(sum(n) OVER (PARTITION BY feature, y) AS DOUBLE) AS ny FROM cnt)
SELECT feature, round(sum(n / nn * ln(n * nn / (nx * ny))), 6) AS mi FROM c GROUP BY feature""")
def mi_numeric(spark, sf, kept=None):
    """Plug-in MI of each numeric feature (its distinct values) with the target;
    NULL is one of the values."""
    f = features(spark, sf) if kept is None else kept
    cols = list(NUMERIC_FEATURES)
    long = f.select(F.col("target").alias("y"), *[F.col(c).cast("string").alias(c) for c in cols]) \
            .unpivot(["y"], cols, "feature", "value")
    counts = long.groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("n"))
    return A.mi_terms(counts).select("feature", C.round6("mi").alias("mi"))


_BINS = 16
_NUM_MI = (", nl AS (SELECT target, feature, value FROM (SELECT target, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES)
           + " FROM features) UNPIVOT INCLUDE NULLS (value FOR feature IN (" + ", ".join(NUMERIC_FEATURES) + """))),
ne AS (SELECT feature, list_distinct(quantile_cont(value, [""" + ", ".join(repr(i / _BINS) for i in range(1, _BINS)) + """])) AS e FROM nl GROUP BY feature),
nb AS (SELECT nl.feature AS feature, target AS y, CASE WHEN value IS NULL THEN 'none' ELSE CAST(len(list_filter(e, lambda q: q < value)) AS VARCHAR) END AS bin
       FROM nl JOIN ne ON nl.feature = ne.feature),
ncnt AS (SELECT feature, bin, y, count(*) AS n FROM nb GROUP BY 1, 2, 3),
nc AS (SELECT *, CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS nn, CAST(sum(n) OVER (PARTITION BY feature, bin) AS DOUBLE) AS nx,
              CAST(sum(n) OVER (PARTITION BY feature, y) AS DOUBLE) AS ny FROM ncnt),
nmi AS (SELECT feature, sum(n / nn * ln(n * nn / (nx * ny))) AS mi FROM nc GROUP BY feature)""")


@register("mi_ranked_columns", _MI_CTE + _NUM_MI + """
SELECT "column", round(mi, 6) AS mi FROM (SELECT "column", mi FROM mi UNION ALL SELECT feature, mi FROM nmi) u""")
def mi_ranked_columns(spark, sf):
    """Every encoded column, one-hot and numeric (in bins of equal frequency), by its MI with the target, most informative first."""
    f = kept_features(spark, sf, *NUMERIC_FEATURES, *_CATS)
    onehot = A.onehot_mi(grouped_features(spark, sf, f), list(_CATS)).select("column", "mi")
    numeric = A.numeric_mi(f, list(NUMERIC_FEATURES), _BINS).select(F.col("feature").alias("column"), "mi")
    return onehot.unionByName(numeric).select("column", C.round6("mi").alias("mi")).orderBy(F.desc("mi"), "column")


@register("mi_ranked_features", _MI_CTE + _NUM_MI + """
SELECT feature, round(mi, 6) AS mi, CAST(rank() OVER (ORDER BY round(mi, 6) DESC) AS INTEGER) AS rank
FROM (SELECT feature, sum(mi) AS mi FROM mi GROUP BY feature UNION ALL SELECT feature, mi FROM nmi) u""")
def mi_ranked_features(spark, sf):
    """All 29 source features ranked by MI: a category's one-hot columns summed, a numeric feature in bins of equal frequency."""
    f = kept_features(spark, sf, *NUMERIC_FEATURES, *_CATS)
    onehot = A.onehot_mi(grouped_features(spark, sf, f), list(_CATS)).groupBy("feature").agg(F.sum("mi").alias("mi"))
    numeric = A.numeric_mi(f, list(NUMERIC_FEATURES), _BINS)
    both = onehot.unionByName(numeric.select("feature", "mi")).select("feature", C.round6("mi").alias("mi"))
    return both.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mi"))))  # one row per feature


@register("chi2_feature_scores", _IND + """
, sc AS (SELECT feature || '_' || value AS "column",
        (n1 - (n1 + n0) * tot1 / (tot1 + tot0)) ^ 2 / ((n1 + n0) * tot1 / (tot1 + tot0))
      + (n0 - (n1 + n0) * tot0 / (tot1 + tot0)) ^ 2 / ((n1 + n0) * tot0 / (tot1 + tot0)) AS chi2 FROM ic, tt)
SELECT "column", round(chi2, 6) AS chi2 FROM sc ORDER BY round(chi2, 6) DESC, "column" LIMIT 30""")
def chi2_feature_scores(spark, sf):
    s = A.chi2_onehot(grouped_features(spark, sf), list(_CATS))
    return s.select("column", C.round6("chi2").alias("chi2")).orderBy(F.desc("chi2"), "column").limit(30)


# --- A6: long-format findings behind the report ------------------------------------
def _sub(sql: str) -> str:
    return f"({sql})"


_BIZ_COLS = ("n_organic", "cr_organic", "n_paid", "cr_paid", "n_social", "cr_social", "cr_other", "cr_new",
             "cr_returning")


def _findings_sql() -> str:
    from convlens.plans.oracle import EDA_BASE as EB
    from convlens.plans.q_eda import W as WE
    from convlens.plans.registry import ORACLE

    biz = ORACLE["business_splits"]
    parts = [
        f"SELECT 'business' AS section, 'all' AS name, metric, CAST(value AS DOUBLE) AS value FROM "
        f"(UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _BIZ_COLS)} FROM {_sub(biz)} b) "
        f"ON {', '.join(_BIZ_COLS)} INTO NAME metric VALUE value)",
        f"SELECT 'association' AS section, feature AS name, 'cramers_v' AS metric, cramers_v AS value FROM "
        f"{_sub(ORACLE['target_association'])} a",
        f"SELECT 'hypothesis' AS section, id AS name, 'statistic' AS metric, statistic AS value FROM "
        f"{_sub(ORACLE['hypothesis_battery'])} h",
        f"SELECT 'coverage' AS section, \"column\" AS name, 'coverage_pct' AS metric, coverage_pct AS value FROM "
        f"{_sub(ORACLE['topn_coverage'])} c",
    ]
    del EB, WE
    return " UNION ALL ".join(parts)


@register("findings_long", _findings_sql())
def findings_long(spark, sf):
    """(section, name, metric, value) rows behind the findings report, one
    ``unionByName`` of the business splits, target associations, hypothesis
    statistics and top-N coverage."""
    from convlens.operators import slices

    eda = cut_lineage(frames.eda(spark, sf))  # read by all four parts
    biz = slices.business_splits(eda)
    biz_long = biz.select([F.col(c).cast("double").alias(c) for c in _BIZ_COLS]) \
                  .unpivot([], list(_BIZ_COLS), "metric", "value") \
                  .select(F.lit("business").alias("section"), F.lit("all").alias("name"), "metric", "value")
    assoc = _target_association(eda).select(F.lit("association").alias("section"), F.col("feature").alias("name"),
                                                 F.lit("cramers_v").alias("metric"), F.col("cramers_v").alias("value"))
    hyp = A.hypothesis_battery(eda).select(F.lit("hypothesis").alias("section"), F.col("id").alias("name"),
                                               F.lit("statistic").alias("metric"), F.col("statistic").alias("value"))
    cov = slices.topn_coverage(eda, CFG.top_n_by_column).select(F.lit("coverage").alias("section"), F.col("column").alias("name"),
                                                F.lit("coverage_pct").alias("metric"),
                                                F.col("coverage_pct").cast("double").alias("value"))
    return biz_long.unionByName(assoc).unionByName(hyp).unionByName(cov)


def _dictionary_sql() -> str:
    from convlens.plans.registry import ORACLE

    # what each feature is made of, said by itself: a name of a field is that field; the others by what they are about
    about = (("visit_hour|visit_daypart", "visit_time"), ("visit_day|visit_dow|visit_month|is_weekend", "visit_date"), ("visit_number.*|is_first_visit", "visit_number"),
             ("screen_.*", "device_screen_resolution"), ("is_organic", "utm_medium"), ("is_social", "utm_source"), ("is_russia", "geo_country"),
             ("is_moscow|is_spb", "geo_city"), ("has_.*", "<field>"))
    case = " ".join(f"WHEN regexp_full_match(feature, '{p}') THEN " + ("substr(feature, 5)" if src == "<field>" else f"'{src}'") for p, src in about)
    return (f"SELECT feature, CASE {case} ELSE feature END AS source, CASE WHEN cat THEN 'category' WHEN regexp_full_match(feature, '(is|has)_.*|.*_is_valid') THEN 'flag' "
            f"ELSE 'numeric' END AS kind, CASE WHEN cat THEN 'one-hot after top-N grouping' ELSE 'median impute + scale' END AS encoding, mi "
            f"FROM (SELECT *, true AS cat FROM ({ORACLE['mi_by_feature']}) a UNION ALL SELECT *, false FROM ({ORACLE['mi_numeric']}) b) m")


@register("feature_dictionary", _dictionary_sql())
def feature_dictionary(spark, sf):
    """Feature specs with the measured MI of each feature (one-hot MI summed
    for categories, plug-in MI for numeric features)."""
    f = kept_features(spark, sf, *NUMERIC_FEATURES, *_CATS)
    mi = mi_by_feature(spark, sf, f).unionByName(mi_numeric(spark, sf, f))
    return FE.feature_dictionary(spark, mi)
