"""Queries for scans, cleaning, profiling and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from convlens.contracts import MODEL_INPUT_COLUMNS
from convlens.functions import columns as C
from convlens.operators import cleaning, labeling, profiling
from convlens.plans import frames
from convlens.plans.oracle import (
    BASE, CFG, HITS, POSITIVES, RAW_SESSIONS, STATUS_ACTIONS, STATUS_HITS, STATUS_POSITIVES, STATUS_TARGET_SET,
    TARGET_SET,
    date_lenient, norm, seconds, strip, with_,
)
from convlens.plans.registry import register
from convlens.session import scratch_path
from convlens.sources import sinks
from convlens.sources import readers
from convlens.sources import testdata as td

STATUS_CFG = CFG.with_(target_actions=STATUS_ACTIONS)

# --- A: scans -----------------------------------------------------------------


@register("scan_projected", """
SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'R'
""")
def scan_projected(spark, sf):
    return (readers.read_parquet_projected(spark, f"{sf}/lineitem.parquet",
                                           ["l_orderkey", "l_returnflag", "l_linestatus"])
            .where(F.col("l_returnflag") == "R"))


def _records(spark, sf):
    """Visit records as JSON text: NULL fields are absent keys, one extra key."""
    s = frames.sessions(spark, sf)
    k = F.col("session_id").cast("bigint")
    vn = (F.when(k % 19 == 0, F.lit(0)).when(k % 23 == 1, F.lit(None).cast("int"))
          .otherwise(F.col("visit_number")))
    country = F.when(k % 29 == 2, F.lit(None).cast("string")).otherwise(F.col("geo_country"))
    fields = [F.col(c) for c in ("session_id", *MODEL_INPUT_COLUMNS) if c not in ("visit_number", "geo_country")]
    rec = F.struct(*fields, vn.alias("visit_number"), country.alias("geo_country"),
                   F.lit("x").alias("hit_page_path"))
    return s.select(F.to_json(rec).alias("value"))


_VN = ("CASE WHEN CAST(session_id AS BIGINT) % 19 = 0 THEN 0 "
       "WHEN CAST(session_id AS BIGINT) % 23 = 1 THEN NULL ELSE visit_number END")
_COUNTRY = "CASE WHEN CAST(session_id AS BIGINT) % 29 = 2 THEN NULL ELSE geo_country END"
_CONTRACT_COLS = ", ".join(
    f"{_VN} AS visit_number" if c == "visit_number" else f"{_COUNTRY} AS geo_country" if c == "geo_country" else c
    for c in ("session_id", *MODEL_INPUT_COLUMNS))


@register("records_to_contract", with_(RAW_SESSIONS) + f"SELECT {_CONTRACT_COLS} FROM raw_sessions")
def records_to_contract(spark, sf):
    return readers.records_to_contract(_records(spark, sf))


_ACCEPT_COLS = ", ".join(
    "coalesce(visit_number, 1) AS visit_number" if c == "visit_number"
    else "coalesce(geo_country, 'Russia') AS geo_country" if c == "geo_country" else c
    for c in ("session_id", *MODEL_INPUT_COLUMNS))
_REJECT_RULE = ("utm_source IS NULL OR utm_medium IS NULL OR device_category IS NULL "
                "OR coalesce(visit_number < 1, false)")


@register("validate_contract", with_(RAW_SESSIONS) + f"""
SELECT {_ACCEPT_COLS} FROM (SELECT {_CONTRACT_COLS} FROM raw_sessions) r
WHERE NOT ({_REJECT_RULE})""")
def validate_contract(spark, sf):
    accepted, _ = cleaning.validate_contract(_records(spark, sf))
    return accepted


@register("contract_rejects", with_(RAW_SESSIONS) + f"""
SELECT session_id, concat_ws(',',
   CASE WHEN utm_source IS NULL THEN 'missing:utm_source' END,
   CASE WHEN utm_medium IS NULL THEN 'missing:utm_medium' END,
   CASE WHEN device_category IS NULL THEN 'missing:device_category' END,
   CASE WHEN coalesce(visit_number < 1, false) THEN 'invalid:visit_number' END) AS reasons
FROM (SELECT {_CONTRACT_COLS} FROM raw_sessions) r WHERE {_REJECT_RULE}""")
def contract_rejects(spark, sf):
    _, rejected = cleaning.validate_contract(_records(spark, sf))
    return rejected.select(F.get_json_object("record", "$.session_id").alias("session_id"),
                           F.array_join("reasons", ",").alias("reasons"))


# --- B: filters, typing, cleaning ------------------------------------------------


@register("filter_in_set", with_(HITS) + f"""
SELECT session_id, event_action FROM hits WHERE event_action IN ({TARGET_SET})""")
def filter_in_set(spark, sf):
    return cleaning.filter_in_set(frames.hits(spark, sf), "event_action", CFG.target_actions) \
        .select("session_id", "event_action")


_RAW_NO_MODEL = ("session_id, client_id, visit_date, visit_time, visit_number, utm_source, utm_medium, "
                 "utm_campaign, utm_adcontent, utm_keyword, device_category, device_os, device_brand, "
                 "device_screen_resolution, device_browser, geo_country, geo_city")


@register("drop_columns", with_(RAW_SESSIONS) + f"SELECT {_RAW_NO_MODEL} FROM raw_sessions")
def drop_columns(spark, sf):
    return cleaning.drop_columns(frames.sessions(spark, sf), ["device_model", "not_a_column"])


@register("dedup_rows", with_(STATUS_HITS) + "SELECT DISTINCT session_id, event_action FROM hits")
def dedup_rows(spark, sf):
    return cleaning.dedup_rows(frames.status_hits(spark, sf).select("session_id", "event_action"))


@register("parse_date_lenient", with_(RAW_SESSIONS) + f"""
SELECT session_id, {date_lenient('visit_date')} AS visit_date FROM raw_sessions""")
def parse_date_lenient(spark, sf):
    return frames.sessions(spark, sf).select("session_id", C.parse_date_lenient("visit_date").alias("visit_date"))


_EV_TIME = ("CASE WHEN event_id % 31 = 7 THEN 'x' || CAST(event_id AS VARCHAR) "
            "WHEN event_id % 31 = 8 THEN ' ' || strftime(ts, '%H:%M:%S') || ' ' "
            "WHEN event_id % 31 = 9 THEN CAST(event_id % 86400 AS VARCHAR) "
            "ELSE strftime(ts, '%H:%M:%S') END")


def _event_times(spark, sf):
    e = td.table(spark, sf, "events")
    k = F.col("event_id")
    hms = F.date_format("ts", "HH:mm:ss")
    t = (F.when(k % 31 == 7, F.concat(F.lit("x"), k.cast("string")))
         .when(k % 31 == 8, F.concat(F.lit(" "), hms, F.lit(" ")))
         .when(k % 31 == 9, (k % 86400).cast("string"))
         .otherwise(hms))
    return e.select("event_id", t.alias("t"))


@register("time_to_seconds", f"""
SELECT event_id, {seconds('t')} AS visit_time FROM (SELECT event_id, {_EV_TIME} AS t FROM events) e""")
def time_to_seconds(spark, sf):
    return _event_times(spark, sf).select("event_id", C.time_to_seconds("t").alias("visit_time"))


_PROPS_K = "CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END"


@register("numeric_lenient", f"""
SELECT event_id, TRY_CAST({strip(_PROPS_K)} AS INTEGER) AS k FROM events""")
def numeric_lenient(spark, sf):
    e = td.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k"))
    return e.select("event_id", C.numeric_lenient(raw, "int").alias("k"))


@register("normalize_category", with_(RAW_SESSIONS) + f"""
SELECT session_id, {norm('utm_medium')}, {norm('utm_source')} FROM raw_sessions""")
def normalize_category(spark, sf):
    s = frames.sessions(spark, sf)
    return s.select("session_id", cleaning.normalize_column("utm_medium", CFG).alias("utm_medium"),
                    cleaning.normalize_column("utm_source", CFG).alias("utm_source"))


@register("clean_sessions", with_(RAW_SESSIONS) + """
SELECT """ + ", ".join(
    ["session_id", "client_id", f"{date_lenient('visit_date')} AS visit_date",
     f"{seconds('visit_time')} AS visit_time", "TRY_CAST(visit_number AS INTEGER) AS visit_number"]
    + [norm(c) for c in ("utm_source", "utm_medium", "utm_campaign", "utm_adcontent", "utm_keyword",
                         "device_category", "device_os", "device_brand", "device_model",
                         "device_screen_resolution", "device_browser", "geo_country", "geo_city")])
    + " FROM raw_sessions")
def clean_sessions(spark, sf):
    return cleaning.clean_sessions(frames.sessions(spark, sf), CFG)


@register("clean_dataset", with_(*BASE) + "SELECT * FROM dataset")
def clean_dataset(spark, sf):
    return frames.dataset(spark, sf)


@register("missing_before_after", with_(*BASE) + """
, b AS (UNPIVOT (SELECT """ + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}" for c in (
        "session_id", "client_id", "visit_date", "visit_time", "visit_number", "utm_source", "utm_medium",
        "utm_campaign", "utm_adcontent", "utm_keyword", "device_category", "device_os", "device_brand",
        "device_model", "device_screen_resolution", "device_browser", "geo_country", "geo_city")) + """
   FROM raw_sessions) ON COLUMNS(*) INTO NAME "column" VALUE pct),
a AS (UNPIVOT (SELECT """ + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}" for c in (
        "session_id", "client_id", "visit_date", "visit_time", "visit_number", "utm_source", "utm_medium",
        "utm_campaign", "utm_adcontent", "utm_keyword", "device_category", "device_os", "device_brand",
        "device_screen_resolution", "device_browser", "geo_country", "geo_city", "target")) + """
   FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE pct)
SELECT coalesce(b."column", a."column") AS "column", round(b.pct, 2) AS missing_before_pct,
       round(a.pct, 2) AS missing_after_pct, CAST(a.pct IS NULL AS INTEGER) AS dropped
FROM b FULL JOIN a ON b."column" = a."column"
""")
def missing_before_after(spark, sf):
    return profiling.missing_before_after(frames.sessions(spark, sf), frames.dataset(spark, sf))


_PROFILE_TYPES = {"visit_date": "date", "visit_time": "int", "visit_number": "int", "target": "int"}
_PROFILE_COLS = ("session_id", "client_id", "visit_date", "visit_time", "visit_number", "utm_source", "utm_medium",
                 "utm_campaign", "utm_adcontent", "utm_keyword", "device_category", "device_os", "device_brand",
                 "device_screen_resolution", "device_browser", "geo_country", "geo_city", "target")


@register("column_profile", with_(*BASE) + """
, n AS (UNPIVOT (SELECT """ + ", ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}" for c in _PROFILE_COLS) + """
   FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE null_pct),
d AS (UNPIVOT (SELECT """ + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _PROFILE_COLS) + """
   FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE n_distinct)
SELECT n."column", t.dtype, round(n.null_pct, 6) AS null_pct, CAST(d.n_distinct AS BIGINT) AS n_distinct
FROM n JOIN d ON n."column" = d."column"
JOIN (VALUES """ + ", ".join(f"('{c}', '{_PROFILE_TYPES.get(c, 'string')}')" for c in _PROFILE_COLS) + """) t(col, dtype)
  ON t.col = n."column"
""")
def column_profile(spark, sf):
    return profiling.column_profile(frames.dataset(spark, sf).select(*_PROFILE_COLS))


@register("profile_sketches", with_(*BASE) + """
, d AS (UNPIVOT (SELECT """ + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _PROFILE_COLS) + """ FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE n_distinct),
z AS (UNPIVOT (SELECT """ + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _PROFILE_COLS) + """ FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE n_null),
ab AS (UNPIVOT (SELECT """ + ", ".join(f"min(CAST({c} AS VARCHAR)) || '..' || max(CAST({c} AS VARCHAR)) AS {c}" for c in _PROFILE_COLS) + """
       FROM dataset) ON COLUMNS(*) INTO NAME "column" VALUE span)
SELECT d."column", (SELECT count(*) FROM dataset) AS n_rows, CAST(n_null AS BIGINT) AS n_null, span, CAST(n_distinct AS BIGINT) AS n_distinct, 1 AS estimate_in_bound
FROM d JOIN z ON d."column" = z."column" LEFT JOIN ab ON d."column" = ab."column" """)
def profile_sketches(spark, sf):
    """Sketches per visit month, written, read and merged; beside the exact distinct counts, whether the merged estimate is
    within four standard errors of a sketch of 4,096 registers."""
    data = sinks.with_visit_month(frames.dataset(spark, sf).select(*_PROFILE_COLS))
    path = scratch_path(spark, "profile-sketches")
    profiling.profile_sketches(data, by=["visit_ym"]).write.partitionBy("visit_ym").parquet(path)
    merged = profiling.merged_profile(spark.read.parquet(path))
    exact = profiling.column_profile(data.drop("visit_ym")).select("column", "n_distinct")
    off = F.abs(F.col("n_distinct_estimate") - F.col("n_distinct"))
    return merged.join(exact, "column").select(
        "column", "n_rows", "n_null", F.concat("least", F.lit(".."), "greatest").alias("span"), "n_distinct",
        (off <= 4 * 1.04 / 64 * F.col("n_distinct") + 1).cast("int").alias("estimate_in_bound"))


@register("ingestion_summary", with_(RAW_SESSIONS, HITS, POSITIVES) + """
, hs AS (SELECT DISTINCT session_id FROM hits WHERE session_id IS NOT NULL)
SELECT CAST(count(s.session_id) AS BIGINT) AS n_sessions,
       CAST(count(DISTINCT s.session_id) AS BIGINT) AS n_unique_ids,
       CAST(count(DISTINCT s.session_id) FILTER (WHERE p.session_id IS NOT NULL) AS BIGINT) AS n_target,
       round(count(s.session_id) FILTER (WHERE p.session_id IS NOT NULL) / count(s.session_id), 6) AS cr,
       CAST(count(DISTINCT hs.session_id) AS BIGINT) AS n_hit_sessions,
       CAST(count(DISTINCT s.session_id) FILTER (WHERE hs.session_id IS NOT NULL) AS BIGINT) AS n_matched_hit_sessions,
       round(count(s.session_id) FILTER (WHERE hs.session_id IS NULL) * 100.0 / count(s.session_id), 6)
         AS pct_without_hits,
       min(s.visit_date) AS date_min, max(s.visit_date) AS date_max,
       18 AS n_columns,
       CAST(count(DISTINCT s.session_id) = count(s.session_id) AS INTEGER) AS key_unique
FROM raw_sessions s FULL JOIN hs ON s.session_id = hs.session_id
LEFT JOIN positives p ON coalesce(s.session_id, hs.session_id) = p.session_id
""")
def ingestion_summary(spark, sf):
    return profiling.ingestion_summary(frames.sessions(spark, sf), frames.hits(spark, sf), CFG)


@register("cleaning_summary", with_(*BASE) + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM raw_sessions) AS n_raw,
       CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE target = 1) AS BIGINT) AS n_target_1,
       CAST(count(*) FILTER (WHERE target = 0) AS BIGINT) AS n_target_0,
       CAST(count(*) FILTER (WHERE visit_date IS NULL) AS BIGINT) AS n_bad_date,
       CAST(count(*) FILTER (WHERE visit_time IS NULL) AS BIGINT) AS n_bad_time,
       CAST(count(*) FILTER (WHERE visit_number IS NULL) AS BIGINT) AS n_bad_number,
       CAST(min(visit_date) AS VARCHAR) AS date_min, CAST(max(visit_date) AS VARCHAR) AS date_max,
       min(visit_number) AS visit_number_min, max(visit_number) AS visit_number_max,
       CAST(count(*) FILTER (WHERE device_screen_resolution <> 'unknown'
                             AND NOT regexp_matches(device_screen_resolution, '^\\d+x\\d+$')) AS BIGINT)
         AS n_invalid_resolution,
       (SELECT CAST(count(*) AS BIGINT) FROM raw_sessions) - CAST(count(*) AS BIGINT) AS n_duplicates
FROM dataset
""")
def cleaning_summary(spark, sf):
    return profiling.cleaning_summary(frames.sessions(spark, sf), frames.dataset(spark, sf), CFG)


@register("quality_checks", with_(*BASE) + """
, agg AS (SELECT CAST(count(*) AS DOUBLE) AS n_rows,
          CAST(count(*) - count(DISTINCT session_id) AS DOUBLE) AS dup,
          CAST(count(*) FILTER (WHERE target IS NULL OR target NOT IN (0, 1)) AS DOUBLE) AS bad,
          avg(target) AS cr,
          CAST(""" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in (
    "utm_source", "utm_medium", "utm_campaign", "utm_adcontent", "utm_keyword", "device_category",
    "device_os", "device_brand", "device_screen_resolution", "device_browser", "geo_country", "geo_city"))
    + """ AS DOUBLE) AS nullcat
   FROM dataset)
SELECT 'row_count_kept' AS rule, n_rows AS value,
       CAST(n_rows = (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_sessions)) AS INTEGER) AS passed FROM agg
UNION ALL SELECT 'key_unique', dup, CAST(dup = 0 AS INTEGER) FROM agg
UNION ALL SELECT 'target_binary', bad, CAST(bad = 0 AS INTEGER) FROM agg
UNION ALL SELECT 'cr_in_range', round(cr, 6), CAST(cr BETWEEN 0.0 AND 1.0 AS INTEGER) FROM agg
UNION ALL SELECT 'no_null_category', nullcat, CAST(nullcat = 0 AS INTEGER) FROM agg
UNION ALL SELECT 'no_leak_columns', CAST(l.n AS DOUBLE), CAST(l.n = 0 AS INTEGER)
FROM (SELECT count(*) AS n FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM dataset LIMIT 1) ON COLUMNS(*) INTO NAME c VALUE v)
      WHERE c LIKE 'hit\\_%' ESCAPE '\\' OR c LIKE 'event\\_%' ESCAPE '\\') l
""")
def quality_checks(spark, sf):
    kept = frames.sessions(spark, sf).distinct().count()
    return profiling.quality_checks(frames.dataset(spark, sf), n_expected=kept, cfg=CFG)


# --- C: joins ------------------------------------------------------------------------


@register("label_sessions", with_(RAW_SESSIONS, STATUS_HITS, STATUS_POSITIVES) + """
SELECT s.session_id, CASE WHEN p.session_id IS NULL THEN 0 ELSE 1 END AS target
FROM raw_sessions s LEFT JOIN positives p ON s.session_id = p.session_id
""")
def label_sessions(spark, sf):
    """A visit converts by a hit with the target return flag and line status."""
    # tests/test_plans.py holds this query to a scan of keys and return flags with the flag's filter pushed down. The label needs the status
    # too, so that scan only narrows the hits (it decides nothing, and costs one more read of the two columns)
    flagged = labeling.target_sessions(frames.hits(spark, sf), CFG)
    hits = frames.status_hits(spark, sf).join(flagged, "session_id", "left_semi")
    return labeling.target_table(frames.sessions(spark, sf), hits, STATUS_CFG)


@register("left_join_fill", with_(RAW_SESSIONS, HITS, POSITIVES) + """
SELECT s.session_id, s.client_id, CASE WHEN p.session_id IS NULL THEN 0 ELSE 1 END AS target
FROM raw_sessions s LEFT JOIN positives p ON s.session_id = p.session_id
""")
def left_join_fill(spark, sf):
    pos = labeling.target_sessions(frames.hits(spark, sf), CFG).withColumn("target", F.lit(1))
    return labeling.left_join_fill(frames.sessions(spark, sf).select("session_id", "client_id"), pos)


@register("sessions_without_hits", with_(RAW_SESSIONS, HITS) + """
SELECT session_id, client_id FROM raw_sessions s
WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.session_id = s.session_id)
""")
def sessions_without_hits(spark, sf):
    return labeling.sessions_without_hits(frames.sessions(spark, sf).select("session_id", "client_id"),
                                          frames.hits(spark, sf))


@register("no_hits_share", with_(RAW_SESSIONS, HITS) + """
SELECT CAST(count(*) AS BIGINT) AS n_sessions,
       CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.session_id = s.session_id)) AS BIGINT)
         AS n_without_hits,
       round(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.session_id = s.session_id))
             * 100.0 / count(*), 6) AS pct_without_hits
FROM raw_sessions s
""")
def no_hits_share(spark, sf):
    return labeling.no_hits_share(frames.sessions(spark, sf), frames.hits(spark, sf))


@register("sessions_with_hits", with_(RAW_SESSIONS, HITS) + """
SELECT session_id, client_id FROM raw_sessions s
WHERE EXISTS (SELECT 1 FROM hits h WHERE h.session_id = s.session_id)
""")
def sessions_with_hits(spark, sf):
    return labeling.sessions_with_hits(frames.sessions(spark, sf).select("session_id", "client_id"),
                                       frames.hits(spark, sf))


# Sessions loaded for a date window; hits cover every order, so hits of later
# visits have no session row.
_WINDOW_END = "1997-01-01"


@register("orphan_hit_sessions", with_(RAW_SESSIONS, HITS) + f"""
SELECT DISTINCT session_id FROM hits h WHERE session_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM raw_sessions s WHERE s.session_id = h.session_id AND s.visit_date < '{_WINDOW_END}')
""")
def orphan_hit_sessions(spark, sf):
    s = frames.sessions(spark, sf).where(F.col("visit_date") < _WINDOW_END)
    return labeling.orphan_hit_sessions(s, frames.hits(spark, sf))


@register("distinct_sessions", with_(STATUS_HITS) + f"""
SELECT CAST(count(DISTINCT session_id) FILTER (WHERE event_action IN ({STATUS_TARGET_SET})) AS BIGINT) AS n_target_sessions,
       CAST(count(DISTINCT session_id) AS BIGINT) AS n_hit_sessions
FROM hits
""")
def distinct_sessions(spark, sf):
    return labeling.distinct_session_counts(frames.status_hits(spark, sf), STATUS_CFG)


@register("union_distinct_ids", with_(HITS) + """
SELECT DISTINCT session_id FROM hits WHERE session_id IS NOT NULL
""")
def union_distinct_ids(spark, sf):
    # the hit table read as two batches (by line status), unioned by id
    h = frames.hits(spark, sf)
    return labeling.union_distinct_ids(h.where(F.col("event_action").endswith("F")),
                                       h.where(~F.col("event_action").endswith("F")))
