"""Conversion-rate slices and top-k queries."""

from __future__ import annotations


from convlens.operators import slices
from convlens.plans import frames
from convlens.plans.oracle import CFG, EDA_BASE, with_
from convlens.plans.registry import register

W = with_(*EDA_BASE)


def _cr_sql(key: str, min_count: int = 0, limit: int | None = None) -> str:
    sql = (W + f"SELECT {key}, CAST(count(target) AS BIGINT) AS n, round(avg(target), 6) AS cr FROM eda "
           f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(target) >= {min_count}")
    if limit:
        sql += f" ORDER BY cr DESC, {key} LIMIT {limit}"
    return sql


@register("cr_by_category", _cr_sql("utm_medium"))
def cr_by_category(spark, sf):
    """Flagship: label -> clean -> CR by traffic medium."""
    return slices.cr_by(frames.eda(spark, sf), "utm_medium")


@register("cr_by_medium_top", _cr_sql("utm_medium", 1000, 15))
def cr_by_medium_top(spark, sf):
    return slices.cr_by(frames.eda(spark, sf), "utm_medium", min_count=1000).limit(15)


for _name, _key in (("cr_by_device", "device_category"), ("cr_organic_vs_paid", "is_organic"),
                    ("cr_social_vs_other", "is_social"), ("cr_new_vs_returning", "is_first_visit"),
                    ("cr_by_visit_bucket", "visit_bucket"), ("cr_by_hour", "visit_hour"),
                    ("cr_by_dow", "visit_dow"), ("cr_by_region", "geo_region"),
                    ("cr_by_daypart", "visit_daypart"), ("cr_by_weekend", "is_weekend")):
    register(_name, _cr_sql(_key))(
        (lambda key: lambda spark, sf: slices.cr_by(frames.eda(spark, sf), key))(_key))


@register("overall_cr", W + """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(target) AS BIGINT) AS n_target, round(avg(target), 6) AS cr FROM eda""")
def overall_cr(spark, sf):
    return slices.overall_cr(frames.eda(spark, sf))


@register("class_balance", W + "SELECT target, CAST(count(*) AS BIGINT) AS n FROM eda GROUP BY target")
def class_balance(spark, sf):
    return slices.class_balance(frames.eda(spark, sf))


@register("business_splits", W + """
SELECT CAST(count(*) FILTER (WHERE is_organic = 1) AS BIGINT) AS n_organic,
       round(avg(target) FILTER (WHERE is_organic = 1), 6) AS cr_organic,
       CAST(count(*) FILTER (WHERE is_organic <> 1) AS BIGINT) AS n_paid,
       round(avg(target) FILTER (WHERE is_organic <> 1), 6) AS cr_paid,
       CAST(count(*) FILTER (WHERE is_social = 1) AS BIGINT) AS n_social,
       round(avg(target) FILTER (WHERE is_social = 1), 6) AS cr_social,
       round(avg(target) FILTER (WHERE is_social <> 1), 6) AS cr_other,
       round(avg(target) FILTER (WHERE is_first_visit = 1), 6) AS cr_new,
       round(avg(target) FILTER (WHERE is_first_visit <> 1), 6) AS cr_returning
FROM eda""")
def business_splits(spark, sf):
    return slices.business_splits(frames.eda(spark, sf))


def _hist_sql(expr: str, bins: int) -> str:
    return W + f"""
, v AS (SELECT {expr} AS v FROM eda WHERE visit_number IS NOT NULL),
r AS (SELECT min(v) AS mn, max(v) AS mx FROM v),
c AS (SELECT CAST(CASE WHEN r.mx - r.mn = 0 THEN 0
                  ELSE least(floor((v.v - r.mn) / (r.mx - r.mn) * {bins}), {bins - 1}) END AS INTEGER) AS bin,
             count(*) AS n
      FROM v, r GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, round(r.mn + b.bin * (r.mx - r.mn) / {bins}, 6) AS bin_lo,
       round(r.mn + (b.bin + 1) * (r.mx - r.mn) / {bins}, 6) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(0, {bins}) b(bin) CROSS JOIN r LEFT JOIN c ON c.bin = b.bin"""


@register("hist_clipped", _hist_sql("CASE WHEN CAST(visit_number AS DOUBLE) > 30 THEN 30.0 "
                                    "ELSE CAST(visit_number AS DOUBLE) END", 30))
def hist_clipped(spark, sf):
    return slices.histogram(frames.eda(spark, sf), "visit_number", 30, clip_upper=30)


@register("hist_log1p", _hist_sql("ln(1 + CAST(visit_number AS DOUBLE))", 40))
def hist_log1p(spark, sf):
    return slices.histogram(frames.eda(spark, sf), "visit_number", 40, log1p=True)


@register("top_sources", W + """
SELECT utm_source, CAST(count(*) AS BIGINT) AS n FROM eda WHERE utm_source IS NOT NULL
GROUP BY utm_source ORDER BY n DESC, utm_source LIMIT 20""")
def top_sources(spark, sf):
    return slices.top_values(frames.eda(spark, sf), "utm_source", 20)


@register("top_k", W + """
SELECT geo_city, CAST(count(target) AS BIGINT) AS n, round(avg(target), 6) AS cr FROM eda
WHERE geo_city IS NOT NULL GROUP BY geo_city HAVING count(target) >= 100
ORDER BY cr DESC, geo_city LIMIT 8""")
def top_k(spark, sf):
    """Top-8 cities by conversion rate among cities with >= 100 visits."""
    return slices.cr_by(frames.eda(spark, sf), "geo_city", min_count=100).limit(8)


_TOPN = CFG.top_n_by_column


@register("topn_coverage", W + """
, long AS (UNPIVOT (SELECT """ + ", ".join(_TOPN) + """ FROM eda) ON """ + ", ".join(_TOPN) + """
           INTO NAME "column" VALUE value),
cnt AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rnk FROM cnt),
lim AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {n})" for c, n in _TOPN.items()) + """) t("column", top_n))
SELECT rk."column", CAST(lim.top_n AS INTEGER) AS top_n, CAST(count(*) AS BIGINT) AS cardinality,
       round(sum(CASE WHEN rnk <= lim.top_n THEN n END) * 100.0 / sum(n), 2) AS coverage_pct
FROM rk JOIN lim ON rk."column" = lim."column" GROUP BY rk."column", lim.top_n""")
def topn_coverage(spark, sf):
    return slices.topn_coverage(frames.eda(spark, sf), CFG.top_n_by_column)


_SLICE_COLS = ["utm_medium", "device_category", "is_organic", "is_social", "is_first_visit", "visit_bucket",
               "visit_hour", "visit_dow", "geo_region", "visit_daypart"]


@register("cr_slices", W + " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, CAST(count(target) AS BIGINT) AS n, "
    f"round(avg(CAST(target AS DOUBLE)), 6) AS cr FROM eda WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _SLICE_COLS))
def cr_slices(spark, sf):
    """Every CR slice of the report from one GROUPING SETS aggregate."""
    return slices.cr_by_many(frames.eda(spark, sf), _SLICE_COLS)
