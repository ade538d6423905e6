"""Conversion-rate slices, histograms, top-N coverage.

Everything here is a partial-then-final hash aggregate (map-side combine), so
a hot key costs one row per map task in the shuffle, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.contracts import DEFAULT_CONFIG, ConversionConfig
from convlens.functions import columns as C


def eda_frame(df: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Derived session-only columns used by every slice (clipped, NULL-safe
    hour rule)."""
    hour = C.visit_hour("visit_time")
    return df.select(
        "*",
        hour.alias("visit_hour"),
        C.weekday_mon0("visit_date").alias("visit_dow"),
        C.isin_false(C.weekday_mon0("visit_date"), [5, 6]).cast("int").alias("is_weekend"),
        C.daypart(hour, cfg.unknown).alias("visit_daypart"),
        C.isin_false("utm_medium", cfg.organic_mediums).cast("int").alias("is_organic"),
        (~C.isin_false("utm_medium", cfg.organic_mediums)).cast("int").alias("is_paid"),
        C.isin_false("utm_source", cfg.social_sources).cast("int").alias("is_social"),
        C.eq_false("visit_number", 1).cast("int").alias("is_first_visit"),
        geo_region(cfg).alias("geo_region"),
        C.visit_bucket("visit_number").alias("visit_bucket"),
    )


def geo_region(cfg: ConversionConfig = DEFAULT_CONFIG, labels=("other", "capital", "second_city", "home_other")):
    """Not home country / capital / second city / rest of home country."""
    not_home, cap, second, rest = labels
    return (F.when(~C.eq_false("geo_country", cfg.home_country), F.lit(not_home))
            .when(C.eq_false("geo_city", cfg.capital_city), F.lit(cap))
            .when(C.eq_false("geo_city", cfg.second_city), F.lit(second))
            .otherwise(F.lit(rest)))


def cr_by(df: DataFrame, col: str, min_count: int = 0, target: str = "target") -> DataFrame:
    """Count and CR per value of ``col``; NULL keys dropped; ``n >= min_count``;
    highest CR first (value breaks ties)."""
    g = (df.where(F.col(col).isNotNull())
         .groupBy(col)
         .agg(F.count(target).cast("bigint").alias("n"), F.avg(target).alias("cr")))
    return (g.where(F.col("n") >= min_count)
            .select(col, "n", C.round6("cr").alias("cr"))
            .orderBy(F.desc("cr"), F.asc(col)))


def overall_cr(df: DataFrame, target: str = "target") -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                  F.sum(target).cast("bigint").alias("n_target"),
                  C.round6(F.avg(target)).alias("cr"))


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).cast("bigint").alias("n")).orderBy(target)


def business_splits(df: DataFrame, target: str = "target") -> DataFrame:
    """Nine business numbers in one conditional-aggregate pass (expects the
    flags of :func:`eda_frame`)."""
    t = F.col(target).cast("double")

    def cr_where(cond):
        return C.round6(F.avg(F.when(cond, t)))

    org, soc, new = (F.col("is_organic") == 1), (F.col("is_social") == 1), (F.col("is_first_visit") == 1)
    return df.agg(
        F.count_if(org).cast("bigint").alias("n_organic"),
        cr_where(org).alias("cr_organic"),
        F.count_if(~org).cast("bigint").alias("n_paid"),
        cr_where(~org).alias("cr_paid"),
        F.count_if(soc).cast("bigint").alias("n_social"),
        cr_where(soc).alias("cr_social"),
        cr_where(~soc).alias("cr_other"),
        cr_where(new).alias("cr_new"),
        cr_where(~new).alias("cr_returning"),
    )


def histogram(df: DataFrame, col: str, bins: int, clip_upper: float | None = None,
              log1p: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max] of the (clipped / log1p) values,
    the last bin closed on the right; every bin is returned, empty ones with 0."""
    v = F.col(col).cast("double")
    if clip_upper is not None:
        v = F.when(v > clip_upper, F.lit(float(clip_upper))).otherwise(v)
    if log1p:
        v = F.log1p(v)
    vals = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    # range as scalar subqueries: one tiny aggregate job each, no join
    mn = vals.agg(F.min("_v")).scalar()
    mx = vals.agg(F.max("_v")).scalar()
    width = mx - mn
    raw_bin = F.floor((F.col("_v") - mn) / width * bins)
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw_bin, F.lit(bins - 1))).cast("int")
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    edges = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .select("bin",
                     C.round6(mn + F.col("bin") * width / bins).alias("bin_lo"),
                     C.round6(mn + (F.col("bin") + 1) * width / bins).alias("bin_hi")))
    return (edges.join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """Top-k values by volume (ties by value) -> ``TakeOrderedAndProject``."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


def value_counts_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) for several columns from one scan: unpivot, then a
    hash aggregate with map-side combine."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return (long.where(F.col("value").isNotNull()).groupBy("column", "value")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def topn_coverage(df: DataFrame, top_n_by_column: dict) -> DataFrame:
    """Per column: cardinality, N, % of rows covered by the top-N values.
    Values are counted once; totals come from a plain aggregate of the counts, and the ranked part keeps only rank <= N
    (``WindowGroupLimit`` trims each task before the shuffle)."""
    cols = [c for c in top_n_by_column if c in df.columns]
    counts = value_counts_long(df, cols)
    totals = counts.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("cardinality"),
                                          F.sum("n").alias("_total"))
    limit = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(top_n_by_column[c])))])
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    top = (counts.withColumn("_rank", rank).where(F.col("_rank") <= max((int(top_n_by_column[c]) for c in cols), default=0))
           .where(F.col("_rank") <= limit[F.col("column")]).groupBy("column").agg(F.sum("n").alias("_top")))
    return (totals.join(top, "column", "left")
            .select("column", limit[F.col("column")].alias("top_n"), "cardinality",
                    F.round(F.coalesce("_top", F.lit(0)) * 100.0 / F.col("_total"), 2).alias("coverage_pct")))


def cr_by_many(df: DataFrame, cols: list[str], target: str = "target") -> DataFrame:
    """CR slices for several columns from ONE scan and ONE shuffle:
    GROUPING SETS of single columns (partial aggregation map-side), long
    output (dimension, value, n, cr). Slices are told apart by
    ``grouping_id``; NULL keys are dropped as in :func:`cr_by`."""
    m = len(cols)
    base = df.select(*[F.col(c).cast("string").alias(c) for c in cols], F.col(target).cast("double").alias("_t"))
    g = base.groupingSets([[F.col(c)] for c in cols], *cols).agg(
        F.count("_t").cast("bigint").alias("n"), F.avg("_t").alias("_cr"), F.grouping_id().alias("_gid"))
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for i, c in enumerate(cols):
        gid = (1 << m) - 1 - (1 << (m - 1 - i))  # every column but c aggregated away
        dim = F.when(F.col("_gid") == gid, F.lit(c)).otherwise(dim)
        val = F.when(F.col("_gid") == gid, F.col(c)).otherwise(val)
    return (g.select(dim.alias("dimension"), val.alias("value"), "n", C.round6("_cr").alias("cr"))
            .where(F.col("value").isNotNull()))
