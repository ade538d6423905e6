"""Adapters from the star-schema test tables to the visit / hit data model.

Mapping: one ``orders`` row is a visit (customer = client, priority = medium,
status = device category, market segment = source, nation = city, region =
country); one ``lineitem`` row is a hit (action = return flag).
Junk tokens, NULLs, broken dates / times / resolutions are injected by a
deterministic rule on the order key so that the cleaning operators have work to
do. The SQL twin of every frame lives in ``convlens.plans.oracle``; the two
must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.contracts import ConversionConfig
from convlens.operators.ordered import sequence_within_group

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def testdata_config() -> ConversionConfig:
    """Domain parameters for the test tables (the defaults are the original
    web-analytics constants)."""
    return ConversionConfig(
        target_actions=("R",),
        organic_mediums=("1-urgent", "2-high", "(none)"),
        social_sources=("BUILDING", "MACHINERY"),
        home_country="EUROPE",
        capital_city="NATION_3",
        second_city="NATION_8",
        top_n_by_column={
            "utm_medium": 4, "utm_source": 4, "utm_campaign": 10, "utm_adcontent": 10,
            "utm_keyword": 12, "geo_city": 10, "device_brand": 6, "device_browser": 5,
            "device_os": 4,
        },
    )


def _k() -> F.Column:
    return F.col("o_orderkey")


def _lit_or(cases: list[tuple[int, int, object]], default: F.Column) -> F.Column:
    """CASE on ``o_orderkey % m = r`` -> literal (None = NULL)."""
    expr = None
    for m, r, value in cases:
        cond = (_k() % m) == r
        v = F.lit(value).cast("string")
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return default if expr is None else expr.otherwise(default)


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits in the raw (CSV-like) form: everything a string except
    ``visit_number``; junk injected deterministically."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # dimension tables are tiny (25 nations, 5 regions) -> broadcast is bounded
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    base = (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey, "left")
            .withColumn("_day", F.to_date("o_orderdate")))
    base = sequence_within_group(base, ["o_custkey"], "_day", ["o_orderkey"], "_vn")
    secs = (_k() * 7919) % 86400
    hms = F.concat_ws(":", F.lpad((secs / 3600).cast("bigint").cast("string"), 2, "0"),
                      F.lpad(((secs % 3600) / 60).cast("bigint").cast("string"), 2, "0"),
                      F.lpad((secs % 60).cast("string"), 2, "0"))
    k = _k()
    res = F.concat(_s(F.lit(360) + (k % 5) * 120), F.lit("x"), _s(F.lit(640) + (k % 4) * 160))
    return base.select(
        _s("o_orderkey").alias("session_id"),
        _s("o_custkey").alias("client_id"),
        F.when(k % 97 == 5, F.lit("not-a-date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("visit_date"),
        F.when(k % 89 == 3, F.lit("bad")).otherwise(hms).alias("visit_time"),
        F.col("_vn").cast("int").alias("visit_number"),
        _lit_or([(7, 0, None), (7, 1, "(not set)")],
                F.when(k % 11 == 4, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))).alias("utm_source"),
        _lit_or([(7, 2, "(none)"), (7, 3, " Nan "), (7, 5, "(Not Set)")],
                F.when(k % 3 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))).alias("utm_medium"),
        _lit_or([(5, 0, None)], F.concat(F.lit("camp_"), _s(F.col("o_custkey") % 30))).alias("utm_campaign"),
        _lit_or([(4, 0, "(not provided)")], F.concat(F.lit("ad_"), _s(k % 25))).alias("utm_adcontent"),
        _lit_or([(3, 0, None)], F.concat(F.lit("kw_"), _s(F.col("o_custkey") % 40))).alias("utm_keyword"),
        F.col("o_orderstatus").alias("device_category"),
        _lit_or([(2, 0, None)], F.concat(F.lit("os_"), _s(k % 6))).alias("device_os"),
        _lit_or([(6, 0, "")], F.concat(F.lit("brand_"), _s(F.col("o_custkey") % 12))).alias("device_brand"),
        _lit_or([(50, 0, "model_x")], F.lit(None).cast("string")).alias("device_model"),
        _lit_or([(13, 0, "broken"), (17, 0, "(not set)")], res).alias("device_screen_resolution"),
        _lit_or([(9, 0, "nan")], F.concat(F.lit("browser_"), _s(k % 8))).alias("device_browser"),
        F.col("r_name").alias("geo_country"),
        F.concat(F.lit(" "), F.col("n_name")).alias("geo_city"),
    )


def raw_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits: one per line item; only the columns the label needs, plus value."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s("l_orderkey").alias("session_id"),
        F.col("l_returnflag").alias("event_action"),
        F.col("l_extendedprice").alias("event_value"),
    )


def raw_status_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits whose action is the line item's return flag and status."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s("l_orderkey").alias("session_id"),
        F.concat("l_returnflag", "l_linestatus").alias("event_action"),
        F.col("l_extendedprice").alias("event_value"),
    )


def learnable_target(visits: DataFrame, key: str = "session_id") -> DataFrame:
    """``visits`` with ``target`` replaced by one that the visit's fields tell: each row converts with a chance that grows with its
    device, medium, city and first visit, by a hash of its key. (The label from the line items is unrelated to the fields.)"""
    from convlens.operators.splits import hash_unit

    chance = F.lit(300)
    for cond, more in ((F.col("device_category") == "F", 2500), (F.col("utm_medium").isin("1-urgent", "(none)"), 2000),
                       (F.col("geo_city").isin("NATION_3", "NATION_8"), 1500), (F.col("visit_number") == 1, 1000)):
        chance = chance + F.when(cond, more).otherwise(0)
    return visits.withColumn("target", (hash_unit(key, 7, "learnable") < chance).cast("int"))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score/label pair for the evaluation operators."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws(":", _s("l_orderkey"), _s("l_linenumber")).alias("row_id"),
        # cents of the price within a thousand, moved up for returned lines: tens of thousands of distinct scores that tell the label
        (((F.col("l_extendedprice") % F.lit(1000.0)) / F.lit(1000.0) + F.when(F.col("l_returnflag") == "R", F.lit(0.25)).otherwise(F.lit(0.0)))
         / F.lit(1.25)).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
