"""Evaluation queries on a deterministic (score, label) pair (SURVEY 2.8 F1-F10,
L3, L4): the score is made of price and label, tens of thousands of distinct ones."""

from __future__ import annotations

from convlens.operators import evaluation as EV
from convlens.plans.registry import register
from convlens.sources import testdata as td

SCORED = """WITH scored AS (
  SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS row_id,
         ((l_extendedprice % 1000.0) / 1000.0 + CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0.0 END) / 1.25 AS score, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem),
st AS (SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score),
cum AS (SELECT *, CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) AS tp,
               CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) AS fp,
               CAST(sum(neg) OVER (ORDER BY score) - neg AS DOUBLE) AS neg_below,
               CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N FROM st)
"""
T = 0.6
GRID = [round(i / 10, 1) for i in range(1, 10)]


def scored(spark, sf):
    return td.scored_lines(spark, sf)


@register("confusion_at_threshold", SCORED + f"""
SELECT CAST(count(*) FILTER (WHERE score < {T} AND label <> 1) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE score >= {T} AND label <> 1) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE score < {T} AND label = 1) AS BIGINT) AS fn,
       CAST(count(*) FILTER (WHERE score >= {T} AND label = 1) AS BIGINT) AS tp FROM scored""")
def confusion_at_threshold(spark, sf):
    return EV.confusion_at_threshold(scored(spark, sf), T)


def _prf_sql(tp="tp", fp="fp", fn="fn") -> str:
    return (f"round(CASE WHEN {tp} + {fp} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fp}) ELSE 0.0 END, 5) AS precision, "
            f"round(CASE WHEN {tp} + {fn} > 0 THEN CAST({tp} AS DOUBLE) / ({tp} + {fn}) ELSE 0.0 END, 5) AS recall, "
            f"round(CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2.0 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0.0 END, 5)"
            " AS f1")


@register("prf_at_threshold", SCORED + f"""
SELECT *, {_prf_sql()}, CAST({T} AS DOUBLE) AS threshold FROM (
SELECT CAST(count(*) FILTER (WHERE score < {T} AND label <> 1) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE score >= {T} AND label <> 1) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE score < {T} AND label = 1) AS BIGINT) AS fn,
       CAST(count(*) FILTER (WHERE score >= {T} AND label = 1) AS BIGINT) AS tp FROM scored) c""")
def prf_at_threshold(spark, sf):
    return EV.prf_at_threshold(scored(spark, sf), T)


@register("roc_auc_exact", SCORED + """
SELECT round(sum(pos * (neg_below + 0.5 * neg)) / (max(P) * max(N)), 6) AS roc_auc FROM cum""")
def roc_auc_exact(spark, sf):
    return EV.roc_auc_exact(scored(spark, sf))


@register("average_precision", SCORED + """
SELECT round(sum(pos / P * tp / (tp + fp)), 6) AS average_precision FROM cum""")
def average_precision(spark, sf):
    return EV.average_precision(scored(spark, sf))


@register("roc_curve", SCORED + """
SELECT score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM cum""")
def roc_curve(spark, sf):
    return EV.roc_curve(scored(spark, sf))


@register("pr_curve", SCORED + """
SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM cum""")
def pr_curve(spark, sf):
    return EV.pr_curve(scored(spark, sf))


@register("best_f1_threshold", SCORED + """
SELECT threshold, round(f1, 6) AS f1 FROM (
  SELECT score AS threshold, 2.0 * tp / (tp + fp + P) AS f1 FROM cum WHERE P > 0
  UNION ALL SELECT 0.5, 0.0) t
ORDER BY f1 DESC, CASE WHEN threshold = 0.5 AND f1 = 0.0 THEN 1 ELSE 0 END, threshold LIMIT 1""")
def best_f1_threshold(spark, sf):
    return EV.best_f1_threshold(scored(spark, sf))


def _q_list(probs) -> str:
    return "[" + ", ".join(repr(float(p)) for p in probs) + "]"


_CAL_P = [i / 10 for i in range(11)]


@register("calibration_table", SCORED + f"""
, q AS (SELECT quantile_cont(score, {_q_list(_CAL_P)}) AS e FROM scored)
SELECT CAST(bin AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(CAST(label AS DOUBLE)), 6) AS prob_true,
       round(avg(score), 6) AS prob_pred
FROM (SELECT score, label, """ + " + ".join(f"CAST(score > e[{i}] AS INTEGER)" for i in range(2, 11))
    + """ AS bin FROM scored, q) t GROUP BY bin""")
def calibration_table(spark, sf):
    return EV.calibration_table(scored(spark, sf), 10)


_GAIN_P = [i / 10 for i in range(1, 10)]


@register("gains_table", SCORED + f"""
, q AS (SELECT quantile_cont(score, {_q_list(_GAIN_P)}) AS e, avg(CAST(label AS DOUBLE)) AS overall FROM scored),
d AS (SELECT 10 - (""" + " + ".join(f"CAST(score > e[{i}] AS INTEGER)" for i in range(1, 10))
    + """) AS decile, label, overall FROM scored, q)
SELECT CAST(decile AS INTEGER) AS decile, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n_pos,
       round(avg(CAST(label AS DOUBLE)), 6) AS cr, round(avg(CAST(label AS DOUBLE)) / max(overall), 6) AS lift
FROM d GROUP BY decile""")
def gains_table(spark, sf):
    return EV.gains_table(scored(spark, sf), 10)


@register("score_quantiles", SCORED + """
SELECT 'p10' AS quantile, round(quantile_cont(score, 0.1), 6) AS value FROM scored
UNION ALL SELECT 'p50', round(quantile_cont(score, 0.5), 6) FROM scored
UNION ALL SELECT 'p90', round(quantile_cont(score, 0.9), 6) FROM scored""")
def score_quantiles(spark, sf):
    return EV.score_quantiles(scored(spark, sf))


@register("threshold_sweep", SCORED + " UNION ALL ".join(
    f"SELECT CAST({t} AS DOUBLE) AS threshold, tp, fp, fn, {_prf_sql()} FROM ("
    f"SELECT CAST(count(*) FILTER (WHERE score >= {t} AND label = 1) AS BIGINT) AS tp, "
    f"CAST(count(*) FILTER (WHERE score >= {t} AND label <> 1) AS BIGINT) AS fp, "
    f"CAST(count(*) FILTER (WHERE score < {t} AND label = 1) AS BIGINT) AS fn FROM scored) c{i}"
    for i, t in enumerate(GRID)))
def threshold_sweep(spark, sf):
    return EV.threshold_sweep(scored(spark, sf), GRID)


@register("rank_leads", SCORED + """
SELECT row_id, score, label FROM scored ORDER BY score DESC, row_id LIMIT 20""")
def rank_leads(spark, sf):
    return EV.rank_leads(scored(spark, sf), 20)


@register("roc_curve_thinned", SCORED + """
, nb AS (SELECT *, lag(tp) OVER (ORDER BY score DESC) AS tp_up, lead(tp) OVER (ORDER BY score DESC) AS tp_dn,
                lag(fp) OVER (ORDER BY score DESC) AS fp_up, lead(fp) OVER (ORDER BY score DESC) AS fp_dn FROM cum)
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score, round(fp / N, 6), round(tp / P, 6) FROM nb
WHERE tp_up IS NULL OR tp_dn IS NULL OR fp_up - 2 * fp + fp_dn <> 0 OR tp_up - 2 * tp + tp_dn <> 0""")
def roc_curve_thinned(spark, sf):
    """ROC points as plotted (intermediate collinear points dropped)."""
    return EV.roc_curve_thinned(scored(spark, sf))
