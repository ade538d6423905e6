"""Exact classifier evaluation on a (score, label) DataFrame.

Everything ordered by score starts from the distinct-score table
(score, pos, neg) and uses :func:`ordered_prefix` for running totals, so no
task ever holds more than one score range. Quantiles are exact too: they are
read off the cumulative counts, not from a single-buffer ``percentile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.functions import columns as C
from convlens.operators.ordered import ordered_prefix


def score_table(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    return (df.where(F.col(score).isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(label) == 1).cast("bigint").alias("pos"),
                 F.count_if(F.col(label) != 1).cast("bigint").alias("neg")))


def _totals(st: DataFrame):
    t = st.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return t.select("P").scalar(), t.select("N").scalar()


def cumulative(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score s: tp/fp = positives/negatives with score >= s."""
    st = score_table(df, score, label)
    P, N = _totals(st)
    cum = ordered_prefix(st, "score", ["pos", "neg"])
    # inclusive ascending prefix -> counts at or above s
    return cum.select("score", "pos", "neg",
                      (P - F.col("cum_pos") + F.col("pos")).alias("tp"),
                      (N - F.col("cum_neg") + F.col("neg")).alias("fp"),
                      (F.col("cum_neg") - F.col("neg")).alias("neg_below"),
                      P.alias("P"), N.alias("N"))


def confusion_at_threshold(df: DataFrame, t: float, score: str = "score", label: str = "label") -> DataFrame:
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return df.agg(F.count_if(~pred & ~y).cast("bigint").alias("tn"),
                  F.count_if(pred & ~y).cast("bigint").alias("fp"),
                  F.count_if(~pred & y).cast("bigint").alias("fn"),
                  F.count_if(pred & y).cast("bigint").alias("tp"))


def prf_columns(tp, fp, fn):
    """precision, recall, F1 (0 when undefined), rounded to 5 places."""
    tp, fp, fn = (C.col_(x).cast("double") for x in (tp, fp, fn))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    return [F.round(prec, 5).alias("precision"), F.round(rec, 5).alias("recall"), F.round(f1, 5).alias("f1")]


def prf_at_threshold(df: DataFrame, t: float, score: str = "score", label: str = "label") -> DataFrame:
    cm = confusion_at_threshold(df, t, score, label)
    return cm.select("*", *prf_columns("tp", "fp", "fn"), F.lit(float(t)).alias("threshold"))


def roc_auc_exact(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mann-Whitney AUC with mid-rank ties, one row."""
    cum = cumulative(df, score, label)
    return cum.agg(C.round6(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg")))
                            / (F.first("P") * F.first("N"))).alias("roc_auc"))


def keyed_auc(df: DataFrame, keys: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """The unrounded AUC of every key (a model variant, a boosting round) in one pass: one row per distinct (key, score) and
    one running sum per key. Keys without both classes have a NULL AUC. The rows of scores are stored: cutting the ranges, summing
    them and the running sums read them, and none scores ``df`` again."""
    from convlens.session import stored

    st = (df.groupBy(*keys, F.col(score).cast("double").alias("score"))
          .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    st = stored(st, "scores").where(F.col("score").isNotNull())  # a filter before would be pushed down and score a second time
    cum = ordered_prefix(st, "score", ["neg"], keys=list(keys))
    pairs = F.sum(F.col("pos").cast("double")) * F.sum(F.col("neg").cast("double"))
    won = F.sum(F.col("pos") * (F.col("cum_neg") - 0.5 * F.col("neg")))
    return cum.groupBy(*keys).agg(F.when(pairs > 0, won / pairs).alias("auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Step-wise AP: sum over thresholds of (recall gain) x precision."""
    cum = cumulative(df, score, label)
    return cum.agg(C.round6(F.sum(F.col("pos") / F.col("P") * F.col("tp") / (F.col("tp") + F.col("fp"))))
                   .alias("average_precision"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (no point dropping)."""
    cum = cumulative(df, score, label)
    return cum.select(F.col("score").alias("threshold"),
                      C.round6(F.col("fp") / F.col("N")).alias("fpr"),
                      C.round6(F.col("tp") / F.col("P")).alias("tpr"))


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    cum = cumulative(df, score, label)
    return cum.select(F.col("score").alias("threshold"),
                      C.round6(F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                      C.round6(F.col("tp") / F.col("P")).alias("recall"))


def best_f1_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Threshold with the highest F1 = 2TP / (TP + FP + P); ties -> lowest
    threshold; 0.5 with F1 0 when there is no positive."""
    cum = cumulative(df, score, label)
    f1 = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("P"))
    best = cum.where(F.col("P") > 0).select(F.col("score").alias("threshold"), f1.alias("f1")) \
              .orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
    fallback = df.sparkSession.range(1).select(F.lit(0.5).alias("threshold"), F.lit(0.0).alias("f1"))
    return best.unionByName(fallback).orderBy(F.desc("f1"), F.desc("threshold")).limit(1) \
               .select("threshold", C.round6("f1").alias("f1"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float]:
    """Linear-interpolation quantiles (numpy default) from cumulative counts of
    distinct values; only len(probs) numbers come back to the driver."""
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")) \
          .agg(F.count(F.lit(1)).alias("c"))
    cum = ordered_prefix(g, "v", ["c"]).select("v", (F.col("cum_c") - F.col("c")).alias("lo"),
                                                F.col("cum_c").alias("hi"))
    n = g.agg(F.sum("c")).first()[0]
    if not n:
        return [None] * len(probs)
    ranks = sorted({int(r) for p in probs for r in _rank_pair(p, n)})
    # value at 0-based rank r: lo <= r < hi -- an IN-list filter on a range
    # condition; len(ranks) <= 2 * len(probs) rows come back
    cond = None
    for r in ranks:
        c = (F.col("lo") <= r) & (F.col("hi") > r)
        cond = c if cond is None else cond | c
    rows = cum.where(cond).collect()
    at = {}
    for r in ranks:
        for row in rows:
            if row["lo"] <= r < row["hi"]:
                at[r] = row["v"]
    out = []
    for p in probs:
        lo, hi = _rank_pair(p, n)
        frac = p * (n - 1) - lo
        out.append(at[lo] + frac * (at[hi] - at[lo]))
    return out


def keyed_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of many numeric columns, NULLs left out, from one keyed running sum over
    (column, value) counts: no buffer holds a column. Per column, as many values as it has wanted ranks reach the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")
    counts = (df.select(pairs).select("x.*").where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("column", "v").agg(F.count(F.lit(1)).alias("c")))
    cum = ordered_prefix(counts, "v", ["c"], keys=["column"]).select("column", "v", (F.col("cum_c") - F.col("c")).alias("lo"), F.col("cum_c").alias("hi"))
    sizes = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.sum("c").alias("n")).collect()}
    wanted = {c: sorted({r for p in probs for r in _rank_pair(p, n)}) for c, n in sizes.items()}
    hit = F.lit(False)
    for c, ranks in wanted.items():
        inside = F.exists(F.array(*map(F.lit, ranks)), lambda r: (F.col("lo") <= r) & (F.col("hi") > r))
        hit = F.when(F.col("column") == c, inside).otherwise(hit)
    rows = cum.where(hit).collect() if wanted else []
    out: dict[str, list[float | None]] = {}
    for c in cols:
        at = {r: row["v"] for row in rows if row["column"] == c for r in wanted[c] if row["lo"] <= r < row["hi"]}
        out[c] = [None] * len(probs)
        for i, p in enumerate(probs if c in sizes else ()):
            lo, hi = _rank_pair(p, sizes[c])
            out[c][i] = at[lo] + (p * (sizes[c] - 1) - lo) * (at[hi] - at[lo])
    return out


def _rank_pair(p: float, n: int):
    import math

    pos = p * (n - 1)
    lo = int(math.floor(pos))
    return lo, min(lo + 1, n - 1)


def calibration_table(df: DataFrame, n_bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """Quantile-strategy calibration: bin = number of inner edges < p; empty
    bins are absent."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = exact_quantiles(df, score, probs)
    inner = edges[1:-1]
    b = None
    for e in inner:
        t = (F.col(score) > F.lit(e)).cast("int")
        b = t if b is None else b + t
    b = b if b is not None else F.lit(0)
    return (df.where(F.col(score).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 C.round6(F.avg(F.col(label).cast("double"))).alias("prob_true"),
                 C.round6(F.avg(F.col(score).cast("double"))).alias("prob_pred")))


def gains_table(df: DataFrame, n_groups: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """Decile 1 = highest scores: n, positives, CR, lift vs overall CR."""
    probs = [i / n_groups for i in range(1, n_groups)]
    edges = exact_quantiles(df, score, probs)
    above = None
    for e in edges:
        t = (F.col(score) > F.lit(e)).cast("int")
        above = t if above is None else above + t
    decile = F.lit(n_groups) - above
    base = df.where(F.col(score).isNotNull())
    overall = base.agg(F.avg(F.col(label).cast("double"))).scalar()
    return (base.groupBy(decile.alias("decile"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.count_if(F.col(label) == 1).cast("bigint").alias("n_pos"),
                 F.avg(F.col(label).cast("double")).alias("_cr"))
            .select("decile", "n", "n_pos", C.round6("_cr").alias("cr"), C.round6(F.col("_cr") / overall).alias("lift")))


def score_quantiles(df: DataFrame, probs=(0.1, 0.5, 0.9), score: str = "score") -> DataFrame:
    qs = exact_quantiles(df, score, list(probs))
    return df.sparkSession.createDataFrame(
        [(f"p{int(round(p * 100))}", round(float(v), 6)) for p, v in zip(probs, qs)], "quantile string, value double")


def threshold_sweep(df: DataFrame, thresholds, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion counts and P/R/F1 at each threshold of a grid, from ONE
    conditional-aggregate pass (no join with the grid)."""
    y = F.col(label) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(score) >= t
        aggs += [F.count_if(pred & y).alias(f"tp{i}"), F.count_if(pred & ~y).alias(f"fp{i}"),
                 F.count_if(~pred & y).alias(f"fn{i}")]
    row = df.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").cast("bigint").alias("tp"),
                 F.col(f"fp{i}").cast("bigint").alias("fp"), F.col(f"fn{i}").cast("bigint").alias("fn"))
        for i, t in enumerate(thresholds)])).alias("s")).select("s.*")
    return stacked.select("*", *prf_columns("tp", "fp", "fn"))


def rank_leads(df: DataFrame, k: int, score: str = "score", key: str = "row_id") -> DataFrame:
    """Highest propensity first (top-k is a ``TakeOrderedAndProject``)."""
    return df.orderBy(F.desc(score), F.asc(key)).limit(k)


def evaluate_scores(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC-AUC, AP and the best-F1 threshold from ONE cumulative table
    (checkpointed: three aggregates read it instead of recomputing it)."""
    from convlens.session import cut_lineage

    cum = cut_lineage(cumulative(df, score, label))
    f1 = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("P"))
    best = cum.select(F.col("score").alias("threshold"), f1.alias("f1")) \
              .orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
    return cum.agg(
        C.round6(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))) / (F.first("P") * F.first("N")))
        .alias("roc_auc"),
        C.round6(F.sum(F.col("pos") / F.col("P") * F.col("tp") / (F.col("tp") + F.col("fp")))).alias("average_precision"),
        F.lit(best.select("threshold").scalar()).alias("best_threshold"),
        C.round6(best.select("f1").scalar()).alias("best_f1"))


def roc_curve_thinned(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC points with collinear intermediate points dropped (a point is kept
    when the second difference of fp or tp at it is non-zero, or it is the
    first / last threshold), preceded by the (inf, 0, 0) start point.

    Neighbours come from a global rank of the distinct scores (the ordered
    prefix of a column of ones) and equi-joins on rank +- 1 -- no lag/lead
    over a single window partition."""
    cum = cumulative(df, score, label)
    ranked = ordered_prefix(cum.withColumn("_one", F.lit(1)), "score", ["_one"]).withColumnRenamed("cum__one", "_rk")
    base = ranked.select("score", "tp", "fp", "P", "N", "_rk")
    nxt = base.select((F.col("_rk") - 1).alias("_rk"), F.col("tp").alias("_tp_up"), F.col("fp").alias("_fp_up"))
    prv = base.select((F.col("_rk") + 1).alias("_rk"), F.col("tp").alias("_tp_dn"), F.col("fp").alias("_fp_dn"))
    j = base.join(nxt, "_rk", "left").join(prv, "_rk", "left")
    # ascending rank: the "up" neighbour (higher score) comes before in the
    # descending-threshold sequence, the "dn" neighbour after it
    d2fp = F.col("_fp_up") - 2 * F.col("fp") + F.col("_fp_dn")
    d2tp = F.col("_tp_up") - 2 * F.col("tp") + F.col("_tp_dn")
    keep = F.col("_tp_up").isNull() | F.col("_tp_dn").isNull() | (d2fp != 0) | (d2tp != 0)
    pts = j.where(keep).select(F.col("score").alias("threshold"), C.round6(F.col("fp") / F.col("N")).alias("fpr"),
                               C.round6(F.col("tp") / F.col("P")).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                            F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)
