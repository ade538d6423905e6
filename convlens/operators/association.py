"""Association measures and hypothesis tests, computed from aggregated counts.

The data is scanned once into a count table; every statistic is arithmetic on
that (small) table. Zero cells never need materialising for the plain
chi-square: sum((O-E)^2/E) over all cells = N * (sum over observed cells of
O^2 / (row * col)) - N. Only the 2x2 Yates correction enumerates cells, and
then exactly four per table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions import columns as C
from convlens.functions.stats import chi2_p, normal_p
from convlens.operators.evaluation import keyed_quantiles
from convlens.session import cut_lineage


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form (a, b, n); NULL keys excluded."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def chi2_from_counts(counts: DataFrame, by: list[str], a: str = "a_val", b: str = "b_val",
                     n: str = "n", yates_2x2: bool = False) -> DataFrame:
    """Per table (``by``): N, r, k, chi2 (no correction unless ``yates_2x2``
    and dof = 1), dof and bias-corrected Cramer's V (always uncorrected chi2).

    Marginals come from windows over the count table, whose partitions are
    bounded by the table width, not by the data.
    """
    w_a = Window.partitionBy(*by, a)
    w_b = Window.partitionBy(*by, b)
    cells = counts.select(*by, a, b, F.col(n).cast("double").alias("_o"),
                          F.sum(n).over(w_a).cast("double").alias("_ra"),
                          F.sum(n).over(w_b).cast("double").alias("_cb"),
                          F.count(F.lit(1)).over(w_a).alias("_ca"),
                          F.count(F.lit(1)).over(w_b).alias("_cc"))
    # r = number of row values = sum over cells of 1 / (cells in that row);
    # avoids a distinct-count (Expand) aggregate
    per = cells.groupBy(*by).agg(
        F.sum(F.col("_o") * F.col("_o") / (F.col("_ra") * F.col("_cb"))).alias("_s"),
        F.sum("_o").alias("N"),
        F.round(F.sum(F.lit(1.0) / F.col("_ca"))).cast("bigint").alias("r"),
        F.round(F.sum(F.lit(1.0) / F.col("_cc"))).cast("bigint").alias("k"),
    )
    per = per.withColumn("chi2_raw", F.col("N") * F.col("_s") - F.col("N")) \
             .withColumn("dof", ((F.col("r") - 1) * (F.col("k") - 1)).cast("int"))
    per = per.withColumn("cramers_v", cramers_v_expr("chi2_raw", "N", "r", "k"))
    if yates_2x2:
        y = _yates_2x2(cells, by, a, b)
        per = per.join(y, on=by, how="left") \
                 .withColumn("chi2", F.when(F.col("dof") == 1, F.col("_chi2_yates")).otherwise(F.col("chi2_raw"))) \
                 .drop("_chi2_yates")
    else:
        per = per.withColumn("chi2", F.col("chi2_raw"))
    return per.drop("_s")


def _yates_2x2(cells: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Yates-corrected chi2 for 2x2 tables: all four cells, missing ones O=0."""
    ra = cells.select(*by, a, "_ra").distinct()
    cb = cells.select(*by, b, "_cb").distinct()
    two = cells.groupBy(*by).agg(F.count_distinct(a).alias("_r"), F.count_distinct(b).alias("_k")) \
               .where((F.col("_r") == 2) & (F.col("_k") == 2)).select(*by)
    # 2 row values x 2 column values per table: exactly four cells
    grid = ra.join(two, by).join(cb, by)
    full = grid.join(cells.select(*by, a, b, "_o"), on=[*by, a, b], how="left") \
               .withColumn("_o", F.coalesce("_o", F.lit(0.0)))
    tot = cells.groupBy(*by).agg(F.sum("_o").alias("_N"))
    full = full.join(tot, by)
    e = F.col("_ra") * F.col("_cb") / F.col("_N")
    diff = e - F.col("_o")
    corr = F.least(F.lit(0.5), F.abs(diff))
    term = (F.abs(diff) - corr) * (F.abs(diff) - corr) / e
    return full.groupBy(*by).agg(F.sum(term).alias("_chi2_yates"))


def cramers_v_expr(chi2, n, r, k):
    """Bias-corrected Cramer's V (NULL when the corrected denominator <= 0)."""
    chi2, n, r, k = (C.col_(x) for x in (chi2, n, r, k))
    phi2 = chi2 / n
    phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) * (r - 1) / (n - 1)
    kc = k - (k - 1) * (k - 1) / (n - 1)
    denom = F.least(kc - 1, rc - 1)
    return F.when((n > 1) & (denom > 0), F.sqrt(phi2c / denom))


def chi2_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """chi2 test of independence of two columns (Yates when dof = 1)."""
    counts = crosstab_long(df, a, b).select(F.lit(f"{a}|{b}").alias("pair"),
                                            F.col(a).cast("string").alias("a_val"),
                                            F.col(b).cast("string").alias("b_val"), "n")
    return chi2_from_counts(counts, ["pair"], yates_2x2=True)


def association_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cramer's V for every pair of ``cols`` (plus the diagonal = 1).

    One pre-aggregation over all columns (map-side combined), then every pair's
    crosstab is generated from the *counts* by one ``explode`` and summed: the
    same data flow as GROUPING SETS of the pairs, i.e. one shuffle of small
    data instead of one scan per pair, without a 45-projection ``Expand``
    whose code generation dominates at small scale.
    """
    pre = df.select([F.col(c).cast("string").alias(c) for c in cols]) \
            .groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    pairs = list(itertools.combinations(cols, 2))
    cells = F.explode(F.array(*[
        F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(x).alias("a_val"),
                 F.col(y).alias("b_val"), F.col("_n").alias("n"))
        for x, y in pairs])).alias("s")
    long = (pre.select(cells).select("s.*")
            .where(F.col("a_val").isNotNull() & F.col("b_val").isNotNull())
            .groupBy("feature_a", "feature_b", "a_val", "b_val").agg(F.sum("n").cast("bigint").alias("n")))
    stats = chi2_from_counts(long, ["feature_a", "feature_b"])
    v = C.round6("cramers_v")
    # both triangles from one evaluation of the statistics (no self-union)
    both = stats.select(F.explode(F.array(
        F.struct(F.col("feature_a").alias("feature_a"), F.col("feature_b").alias("feature_b"), v.alias("cramers_v")),
        F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), v.alias("cramers_v")),
    )).alias("s")).select("s.*")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols],
                                           "feature_a string, feature_b string, cramers_v double")
    return both.unionByName(diag)


def two_proportion_z(df: DataFrame, mask: str, target: str = "target") -> DataFrame:
    """Pooled two-proportion z-test of ``target`` between ``mask`` = 1 and the
    rest, from one conditional aggregate."""
    g = F.col(mask) == 1
    t = F.col(target).cast("double")
    agg = df.agg(
        F.count_if(g).cast("bigint").alias("n_group"),
        F.sum(F.when(g, t)).alias("x_group"),
        F.count_if(~g).cast("bigint").alias("n_rest"),
        F.sum(F.when(~g, t)).alias("x_rest"),
    )
    return agg.select("*", *_z_columns()).drop("z_raw")


def _z_columns():
    n1, x1, n2, x2 = (F.col(c) for c in ("n_group", "x_group", "n_rest", "x_rest"))
    p1, p2 = x1 / n1, x2 / n2
    p = (x1 + x2) / (n1 + n2)
    z = (p1 - p2) / F.sqrt(p * (1 - p) * (F.lit(1.0) / n1 + F.lit(1.0) / n2))
    return [C.round6(p1).alias("cr_group"), C.round6(p2).alias("cr_rest"), C.round6(z).alias("z"), z.alias("z_raw")]


def hypothesis_battery(eda: DataFrame, target: str = "target",
                       masks=(("H1", "is_organic"), ("H3", "is_first_visit"), ("H4", "is_social")),
                       chi_factor: tuple[str, str] = ("H2", "device_category")) -> DataFrame:
    """The battery with statistics rounded to 6 digits."""
    return raw_battery(eda, target, masks, chi_factor).withColumn("statistic", C.round6("statistic"))


def raw_battery(eda: DataFrame, target: str = "target",
                masks=(("H1", "is_organic"), ("H3", "is_first_visit"), ("H4", "is_social")),
                chi_factor: tuple[str, str] = ("H2", "device_category")) -> DataFrame:
    """H1 organic vs paid (z), H2 device category (chi2), H3 new vs returning
    (z), H4 social vs other (z); one row each, one schema. All z-tests come
    from one conditional-aggregate pass; the chi2 test from the crosstab."""
    t = F.col(target).cast("double")
    aggs = []
    for _, m in masks:
        g = F.col(m) == 1
        aggs += [F.count_if(g).cast("bigint").alias(f"{m}__n_group"), F.sum(F.when(g, t)).alias(f"{m}__x_group"),
                 F.count_if(~g).cast("bigint").alias(f"{m}__n_rest"), F.sum(F.when(~g, t)).alias(f"{m}__x_rest")]
    row = eda.agg(*aggs)
    z_rows = row.select(F.explode(F.array(*[
        F.struct(F.lit(hid).alias("id"), F.lit(m).alias("factor"),
                 *[F.col(f"{m}__{k}").alias(k) for k in ("n_group", "x_group", "n_rest", "x_rest")])
        for hid, m in masks])).alias("s")).select("s.*")
    z_rows = z_rows.select("id", "factor", F.lit("z").alias("test"), "n_group", "n_rest", *_z_columns()) \
                   .select("id", "factor", "test", F.col("z_raw").alias("statistic"), F.lit(None).cast("int").alias("dof"),
                           "n_group", "n_rest", "cr_group", "cr_rest", F.lit(None).cast("double").alias("cramers_v"))
    hid, factor = chi_factor
    chi = chi2_independence(eda, factor, target)
    chi_row = chi.select(F.lit(hid).alias("id"), F.lit(factor).alias("factor"),
                         F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), "dof",
                         F.col("N").cast("bigint").alias("n_group"), F.lit(None).cast("bigint").alias("n_rest"),
                         F.lit(None).cast("double").alias("cr_group"),
                         F.lit(None).cast("double").alias("cr_rest"),
                         F.round("cramers_v", 4).alias("cramers_v"))
    return z_rows.unionByName(chi_row)


def with_pvalues(battery: DataFrame, alpha: float = 0.05, n_tests: int = 4) -> DataFrame:
    """p-values from the unrounded statistics (``raw_battery``) and Bonferroni verdicts; statistics and p-values are rounded last."""
    p = F.when(F.col("test") == "z", normal_p(F.col("statistic"))).otherwise(chi2_p(F.col("statistic"), F.col("dof")))
    bonf = alpha / n_tests
    return battery.withColumn("_p", p).withColumns({
        "statistic": C.round6("statistic"), "pvalue": C.round6("_p"), "alpha": F.lit(alpha), "bonferroni_alpha": F.lit(bonf),
        "reject_h0": (F.col("_p") < bonf).cast("int")}).drop("_p")


def pearson_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise Pearson correlations (pairwise NULL deletion), long form (feature_a, feature_b, r); a column that is constant
    within the pair -> NULL, one that is not finite -> NaN.

    Every task adds up the matrices of counts, sums, squares and products of its rows, moved by the columns' means, so the
    aggregate over tasks has a few rows per pair instead of some hundred buffers a row."""
    p, pairs = len(cols), [*itertools.combinations(range(len(cols)), 2)]
    x = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    means = x.agg(*[F.avg(F.when(F.abs(F.col(f"c{i}")) < float("inf"), F.col(f"c{i}"))) for i in range(p)]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    names = ["n", "odd", "sa", "sb", "qa", "qb", "ab", "la", "ha", "lb", "hb"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, p, p))  # rows of both; of both, not both finite; first column's sum, squares; products
        ends = np.array([np.full((p, p), np.inf), np.full((p, p), -np.inf)])  # of the first column, where the second is given
        for batch in batches:
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            v = np.column_stack([c.fill_null(0.0).to_numpy() for c in batch.columns]) - shift
            odd = there & ~np.isfinite(v)
            v[~there | odd] = 0.0
            m, fine = there.astype(float), (there & ~odd).astype(float)
            both, ok = m.T @ m, fine.T @ fine
            total += [both, both - ok, v.T @ fine, (v * v).T @ fine, v.T @ v]
            for j in range(p):
                at = there[:, j]
                for i in range(p):
                    some = v[at & there[:, i], i]
                    if len(some):
                        ends[0, i, j], ends[1, i, j] = min(ends[0, i, j], some.min()), max(ends[1, i, j], some.max())
        n, odd, s, q, ab = total
        a, b = np.array(pairs).T
        table = [n[a, b], odd[a, b], s[a, b], s[b, a], q[a, b], q[b, a], ab[a, b], ends[0, a, b], ends[1, a, b], ends[0, b, a], ends[1, b, a]]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pairs)), pa.int32()), *map(pa.array, table)], names=["pair", *names])

    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, r double")
    parts = x.mapInArrow(sums, "pair int, " + ", ".join(f"{c} double" for c in names))
    of = {"la": F.min, "lb": F.min, "ha": F.max, "hb": F.max}
    t = parts.groupBy("pair").agg(*[of.get(c, F.sum)(c).alias(c) for c in names])
    _, odd, sa, sb, qa, qb, ab = (F.col(c) for c in names[:7])
    n = F.nullif(F.col("n"), F.lit(0.0))
    var = F.greatest(F.lit(0.0), qa - sa * sa / n) * F.greatest(F.lit(0.0), qb - sb * sb / n)
    r = F.when(odd > 0, F.lit(float("nan"))).when((n > 0) & (F.col("la") < F.col("ha")) & (F.col("lb") < F.col("hb")), F.try_divide(ab - sa * sb / n, F.sqrt(var)))
    spec = df.sparkSession.createDataFrame([(k, cols[a], cols[b]) for k, (a, b) in enumerate(pairs)], "pair int, feature_a string, feature_b string")
    return spec.join(t.select("pair", r.alias("r")), "pair", "left").select("feature_a", "feature_b", C.round6("r").alias("r"))


def pearson_expr(a: str, b: str):
    """Pearson r over rows where both are present; NULL for a constant column
    (plain ``corr`` divides by zero under ANSI)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_pop(F.when(both, x))
    sy = F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)


def mi_terms(counts: DataFrame, feature: str = "feature", value: str = "value", y: str = "y",
             n: str = "n") -> DataFrame:
    """Plug-in MI sum(p ln(p / (px py))) per feature from (feature, value, y, n).

    A numeric feature may have as many values as rows, so nothing is windowed
    by feature: per-feature and per-(feature, class) totals are aggregates
    with one row per feature / class (broadcast, bounded by the feature list),
    and the per-value total is a window over the classes of one value."""
    tot = counts.groupBy(feature).agg(F.sum(n).cast("double").alias("_tot"))
    ny = counts.groupBy(feature, y).agg(F.sum(n).cast("double").alias("_ny"))
    w_fv = Window.partitionBy(feature, value)
    c = (counts.select(feature, value, y, F.col(n).cast("double").alias("_cnt"),
                       F.sum(n).over(w_fv).cast("double").alias("_nx"))
         .join(F.broadcast(tot), feature).join(F.broadcast(ny), [feature, y]))
    term = (F.col("_cnt") / F.col("_tot")) * F.log(F.col("_cnt") * F.col("_tot") / (F.col("_nx") * F.col("_ny")))
    return c.groupBy(feature).agg(F.sum(term).alias("mi"))


def numeric_bins(df: DataFrame, cols: list[str], n_bins: int = 16, target: str = "target") -> DataFrame:
    """(feature, value, y) rows of numeric columns cut into bins of equal frequency at their exact quantiles: ``value`` is the number
    of inner edges below the value, so a column of few values keeps them apart; NULL is a bin of its own."""
    edges = keyed_quantiles(df, cols, [i / n_bins for i in range(1, n_bins)])
    bins = []
    for c in cols:
        x, inner = F.col(c).cast("double"), sorted({e for e in edges[c] if e is not None})
        number = F.size(F.filter(F.array(*map(F.lit, inner)), lambda e: e < x)) if inner else F.lit(0)
        bins.append(F.struct(F.lit(c).alias("feature"), F.when(x.isNotNull(), number).cast("string").alias("value")))
    return df.select(F.col(target).alias("y"), F.explode(F.array(*bins)).alias("b")).select("b.feature", "b.value", "y")


def numeric_mi(df: DataFrame, cols: list[str], n_bins: int = 16, target: str = "target") -> DataFrame:
    """MI of each numeric column, in bins of equal frequency, with the target (feature, mi)."""
    return mi_terms(numeric_bins(df, cols, n_bins, target).groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("n")))


def indicator_counts(df: DataFrame, cats: list[str], target: str = "target") -> DataFrame:
    """(feature, value, n1, n0) for every category value: the column sums of a
    one-hot matrix split by class, without building the matrix."""
    long = df.select(F.col(target).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cats]) \
             .unpivot(["_y"], cats, "feature", "value")
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("_y") == 1).cast("double").alias("n1"),
        F.count_if(F.col("_y") == 0).cast("double").alias("n0"))


def onehot_mi(df: DataFrame, cats: list[str], target: str = "target") -> DataFrame:
    """Plug-in MI between each one-hot column (feature == value) and the target."""
    ic = indicator_counts(df, cats, target)
    tot = df.agg(F.count_if(F.col(target) == 1).cast("double").alias("N1"),
                 F.count_if(F.col(target) == 0).cast("double").alias("N0"))
    N1, N0 = tot.select("N1").scalar(), tot.select("N0").scalar()
    N = N1 + N0
    n1, n0 = F.col("n1"), F.col("n0")
    cells = [(n1, n1 + n0, N1), (n0, n1 + n0, N0), (N1 - n1, N - n1 - n0, N1), (N0 - n0, N - n1 - n0, N0)]
    mi = None
    for o, nx, ny in cells:
        t = F.when(o > 0, (o / N) * F.log(o * N / (nx * ny))).otherwise(F.lit(0.0))
        mi = t if mi is None else mi + t
    return ic.select("feature", "value", F.concat_ws("_", "feature", "value").alias("column"), mi.alias("mi"))


def chi2_onehot(df: DataFrame, cats: list[str], target: str = "target") -> DataFrame:
    """Per one-hot column: sum over classes (O-E)^2/E with E = class share x
    column sum (the feature-selection score, not the independence test)."""
    ic = indicator_counts(df, cats, target)
    tot = df.agg(F.count_if(F.col(target) == 1).cast("double").alias("N1"),
                 F.count(F.lit(1)).cast("double").alias("N"))
    N1, N = tot.select("N1").scalar(), tot.select("N").scalar()
    col_sum = F.col("n1") + F.col("n0")
    e1 = col_sum * N1 / N
    e0 = col_sum * (N - N1) / N
    score = (F.col("n1") - e1) * (F.col("n1") - e1) / e1 + (F.col("n0") - e0) * (F.col("n0") - e0) / e0
    return ic.select("feature", "value", F.concat_ws("_", "feature", "value").alias("column"),
                     score.alias("chi2"))
