"""Data profiles and quality rules. Every profile is one aggregate pass over
the table (all columns in a single ``agg``) followed by an ``unpivot`` of the
one-row result -- never a loop of per-column jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.contracts import DEFAULT_CONFIG, ConversionConfig, categorical_columns
from convlens.operators.labeling import hit_sessions, target_sessions


def _unpivot_one_row(row_df: DataFrame, names: list[str], prefix: str, value_name: str) -> DataFrame:
    return row_df.unpivot([], [f"{prefix}{n}" for n in names], "column", value_name) \
        .withColumn("column", F.substring(F.col("column"), len(prefix) + 1, 10_000))


def missing_share(df: DataFrame) -> DataFrame:
    """(column, missing_pct) for every column, one pass."""
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"m__{c}") for c in df.columns])
    return _unpivot_one_row(row, df.columns, "m__", "missing_pct")


def missing_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing % per column before vs after cleaning; a dropped column has a
    NULL ``after`` and ``dropped = 1``."""
    b = missing_share(before).select("column", F.round("missing_pct", 2).alias("missing_before_pct"))
    a = missing_share(after).select("column", F.round("missing_pct", 2).alias("missing_after_pct"))
    return (b.join(a, "column", "full")
            .withColumn("dropped", F.col("missing_after_pct").isNull().cast("int")))


def _long(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, column, value) with a row per cell, as text: one generated array a row, whatever the number of columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns if c not in by]
    return df.select(*by, F.explode(F.array(*cells)).alias("x")).select(*by, "x.column", "x.value")


def _types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, dtype, null_pct, n_distinct) of all columns. Exact counts come from two aggregates: (column, value) first,
    combined before the shuffle, so a frequent value is a row, then column. ``approx`` merges sketches instead."""
    if approx:
        counts = merged_profile(profile_sketches(df)).withColumnsRenamed({"n_distinct_estimate": "n_distinct"})
    else:
        counts = (_long(df).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("column")
                  .agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
                       F.count("value").alias("n_distinct")))
    return (_types(df).join(counts, "column")
            .select("column", "dtype", F.round(F.col("n_null") * 100.0 / F.col("n_rows"), 6).alias("null_pct"), "n_distinct"))


def profile_sketches(df: DataFrame, by: list[str] = (), lg_k: int = 12) -> DataFrame:
    """Per (``by``, column): n_rows, n_null, least and greatest value as text, and an HLL sketch of the distinct values. Rows
    of new partitions are made by themselves and kept beside the old ones; ``merged_profile`` puts any of them together
    without reading the data again."""
    names = [c for c in df.columns if c not in by]
    text = {c: F.col(c).cast("string") for c in names}
    # all columns in one aggregate: a buffer of 2 ** lg_k bytes at most per column and group
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"z__{c}") for c in names],
                              *[F.min(text[c]).alias(f"a__{c}") for c in names], *[F.max(text[c]).alias(f"b__{c}") for c in names],
                              *[F.hll_sketch_agg(text[c], lg_k).alias(f"s__{c}") for c in names])
    cells = [F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"z__{c}").alias("n_null"), F.col(f"a__{c}").alias("least"),
                      F.col(f"b__{c}").alias("greatest"), F.col(f"s__{c}").alias("sketch")) for c in names]
    return row.select(*by, F.explode(F.array(*cells)).alias("x")).select(*by, "x.*")


def merged_profile(sketches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sketch rows of any partitions put together: (``by``, column, n_rows, n_null, least, greatest, n_distinct_estimate)."""
    return (sketches.groupBy(*by, "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct_estimate")))


def combine_rows(*rows: DataFrame) -> DataFrame:
    """Side-by-side merge of one-row aggregates with disjoint columns
    (union + max; no cartesian join)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    cols = []
    for r in rows:
        cols.extend(r.columns)
    return out.agg(*[F.max(c).alias(c) for c in cols])


def ingestion_summary(sessions: DataFrame, hits: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG,
                      key: str = "session_id", date_col: str = "visit_date") -> DataFrame:
    """Rows, columns, key uniqueness, target sessions, CR, hit sessions,
    matched hit sessions, share without hits, date range -- one row from one
    full outer join of sessions with distinct hit ids."""
    pos = target_sessions(hits, cfg, key).withColumn("_t", F.lit(1))
    hs = hit_sessions(hits, key).withColumn("_h", F.lit(1))
    s = sessions.select(key, date_col).withColumn("_s", F.lit(1))
    flagged = s.join(hs, key, "full").join(pos, key, "left")
    is_s = F.col("_s").isNotNull()
    n_s = F.count_if(is_s)
    return flagged.agg(
        n_s.cast("bigint").alias("n_sessions"),
        F.count_distinct(F.when(is_s, F.col(key))).cast("bigint").alias("n_unique_ids"),
        # distinct ids: a session row that occurs twice is one session
        F.count_distinct(F.when(is_s & F.col("_t").isNotNull(), F.col(key))).cast("bigint").alias("n_target"),
        F.round(F.count_if(is_s & F.col("_t").isNotNull()) / n_s, 6).alias("cr"),
        F.count_distinct(F.when(F.col("_h").isNotNull(), F.col(key))).cast("bigint").alias("n_hit_sessions"),
        F.count_distinct(F.when(is_s & F.col("_h").isNotNull(), F.col(key))).cast("bigint").alias("n_matched_hit_sessions"),
        F.round(F.count_if(is_s & F.col("_h").isNull()) * 100.0 / n_s, 6).alias("pct_without_hits"),
        F.min(date_col).alias("date_min"),
        F.max(date_col).alias("date_max"),
    ).withColumn("n_columns", F.lit(len(sessions.columns))) \
     .withColumn("key_unique", (F.col("n_unique_ids") == F.col("n_sessions")).cast("int"))


def cleaning_summary(raw: DataFrame, cleaned: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rows before/after, duplicates removed, target distribution, NULL dates /
    times / numbers, date and visit_number range, invalid resolutions (values
    other than ``unknown`` that are not ``WxH``)."""
    before = raw.agg(F.count(F.lit(1)).cast("bigint").alias("n_raw"))
    res = F.col("device_screen_resolution")
    after = cleaned.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col("target") == 1).cast("bigint").alias("n_target_1"),
        F.count_if(F.col("target") == 0).cast("bigint").alias("n_target_0"),
        F.count_if(F.col("visit_date").isNull()).cast("bigint").alias("n_bad_date"),
        F.count_if(F.col("visit_time").isNull()).cast("bigint").alias("n_bad_time"),
        F.count_if(F.col("visit_number").isNull()).cast("bigint").alias("n_bad_number"),
        F.min("visit_date").cast("string").alias("date_min"),
        F.max("visit_date").cast("string").alias("date_max"),
        F.min("visit_number").alias("visit_number_min"),
        F.max("visit_number").alias("visit_number_max"),
        F.count_if((res != cfg.unknown) & ~res.rlike(r"^\d+x\d+$")).cast("bigint").alias("n_invalid_resolution"),
    )
    return combine_rows(before, after).withColumn("n_duplicates", F.col("n_raw") - F.col("n_rows"))


def quality_checks(df: DataFrame, n_expected: int | None = None, key: str = "session_id",
                   cr_range: tuple[float, float] = (0.0, 1.0),
                   cfg: ConversionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rule table (rule, value, passed) from one aggregate pass: key unique,
    target in {0,1} and non-null, CR within range, no NULL category, no leak
    column, row count kept."""
    cats = categorical_columns(df.columns)
    aggs = [
        F.count(F.lit(1)).cast("double").alias("n_rows"),
        (F.count(F.lit(1)) - F.count_distinct(key)).cast("double").alias("duplicate_keys"),
        F.count_if(F.col("target").isNull() | ~F.col("target").isin(0, 1)).cast("double").alias("bad_target"),
        F.avg("target").cast("double").alias("cr"),
    ]
    null_cat = None
    for c in cats:
        e = F.count_if(F.col(c).isNull())
        null_cat = e if null_cat is None else null_cat + e
    aggs.append((null_cat if null_cat is not None else F.lit(0)).cast("double").alias("null_categories"))
    row = df.agg(*aggs)
    leak = float(sum(c.startswith(("hit_", "event_")) for c in df.columns))
    lo, hi = cr_range
    checks = row.select(
        F.stack(F.lit(6),
                F.lit("row_count_kept"), F.col("n_rows"),
                (F.lit(True) if n_expected is None else (F.col("n_rows") == F.lit(float(n_expected)))),
                F.lit("key_unique"), F.col("duplicate_keys"), F.col("duplicate_keys") == 0,
                F.lit("target_binary"), F.col("bad_target"), F.col("bad_target") == 0,
                F.lit("cr_in_range"), F.round("cr", 6), F.col("cr").between(lo, hi),
                F.lit("no_null_category"), F.col("null_categories"), F.col("null_categories") == 0,
                F.lit("no_leak_columns"), F.lit(leak), F.lit(leak == 0.0),
                ).alias("rule", "value", "passed"))
    return checks.withColumn("passed", F.col("passed").cast("int"))
