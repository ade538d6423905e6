"""Independent SQL (DuckDB dialect) for every query that has one.

The CTEs below restate the test-table adapters and the cleaning rules in plain
SQL; each oracle query is ``WITH <needed CTEs> SELECT ...``. Keep them in step
with ``convlens.sources.testdata`` and ``convlens.operators.cleaning``.
"""

from __future__ import annotations

from convlens.sources.testdata import testdata_config

CFG = testdata_config()


def q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


K = "o.o_orderkey"
SECS = f"(({K} * 7919) % 86400)"
HMS = (f"lpad(CAST({SECS} // 3600 AS VARCHAR), 2, '0') || ':' || "
       f"lpad(CAST(({SECS} % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
       f"lpad(CAST({SECS} % 60 AS VARCHAR), 2, '0')")

RAW_SESSIONS = f"""raw_sessions AS (
  SELECT CAST({K} AS VARCHAR) AS session_id,
         CAST(o.o_custkey AS VARCHAR) AS client_id,
         CASE WHEN {K} % 97 = 5 THEN 'not-a-date' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS visit_date,
         CASE WHEN {K} % 89 = 3 THEN 'bad' ELSE {HMS} END AS visit_time,
         CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY CAST(o.o_orderdate AS DATE), {K}) AS INTEGER) AS visit_number,
         CASE WHEN {K} % 7 = 0 THEN NULL WHEN {K} % 7 = 1 THEN '(not set)'
              WHEN {K} % 11 = 4 THEN lower(c.c_mktsegment) ELSE c.c_mktsegment END AS utm_source,
         CASE WHEN {K} % 7 = 2 THEN '(none)' WHEN {K} % 7 = 3 THEN ' Nan ' WHEN {K} % 7 = 5 THEN '(Not Set)'
              WHEN {K} % 3 = 0 THEN lower(o.o_orderpriority) ELSE o.o_orderpriority END AS utm_medium,
         CASE WHEN {K} % 5 = 0 THEN NULL ELSE 'camp_' || CAST(o.o_custkey % 30 AS VARCHAR) END AS utm_campaign,
         CASE WHEN {K} % 4 = 0 THEN '(not provided)' ELSE 'ad_' || CAST({K} % 25 AS VARCHAR) END AS utm_adcontent,
         CASE WHEN {K} % 3 = 0 THEN NULL ELSE 'kw_' || CAST(o.o_custkey % 40 AS VARCHAR) END AS utm_keyword,
         o.o_orderstatus AS device_category,
         CASE WHEN {K} % 2 = 0 THEN NULL ELSE 'os_' || CAST({K} % 6 AS VARCHAR) END AS device_os,
         CASE WHEN {K} % 6 = 0 THEN '' ELSE 'brand_' || CAST(o.o_custkey % 12 AS VARCHAR) END AS device_brand,
         CASE WHEN {K} % 50 = 0 THEN 'model_x' ELSE NULL END AS device_model,
         CASE WHEN {K} % 13 = 0 THEN 'broken' WHEN {K} % 17 = 0 THEN '(not set)'
              ELSE CAST(360 + ({K} % 5) * 120 AS VARCHAR) || 'x' || CAST(640 + ({K} % 4) * 160 AS VARCHAR) END
              AS device_screen_resolution,
         CASE WHEN {K} % 9 = 0 THEN 'nan' ELSE 'browser_' || CAST({K} % 8 AS VARCHAR) END AS device_browser,
         g.r_name AS geo_country,
         ' ' || g.n_name AS geo_city
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
         ON c.c_nationkey = g.n_nationkey
)"""

HITS = """hits AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS session_id,
         l_returnflag AS event_action,
         l_extendedprice AS event_value
  FROM lineitem
)"""

TARGET_SET = q(CFG.target_actions)
POSITIVES = f"""positives AS (
  SELECT DISTINCT session_id FROM hits WHERE event_action IN ({TARGET_SET}) AND session_id IS NOT NULL
)"""

# the hits' action as return flag and line status: what de-duplication and distinct counts of hits are about
STATUS_ACTIONS = tuple(f"{a}F" for a in CFG.target_actions)
STATUS_HITS = HITS.replace("l_returnflag AS", "l_returnflag || l_linestatus AS")
STATUS_TARGET_SET = q(STATUS_ACTIONS)
STATUS_POSITIVES = POSITIVES.replace(f"IN ({TARGET_SET})", f"IN ({STATUS_TARGET_SET})")


def strip(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def norm(c: str, alias: str | None = None) -> str:
    t = strip(c)
    if c in CFG.lowercase_columns:
        t = f"lower({t})"
    junk = q([j.lower() for j in CFG.junk_tokens])
    pres = CFG.preserve_by_column.get(c, ())
    cond = f"lower({t}) IN ({junk})"
    if pres:
        cond += f" AND lower({t}) NOT IN ({q([p.lower() for p in pres])})"
    return f"CASE WHEN {t} IS NULL OR ({cond}) THEN '{CFG.unknown}' ELSE {t} END AS {alias or c}"


TIME_RE = r"^(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)$"


def seconds(c: str) -> str:
    s = strip(c)
    h = f"regexp_extract({s}, '{TIME_RE}', 1)"
    m = f"regexp_extract({s}, '{TIME_RE}', 2)"
    x = f"regexp_extract({s}, '{TIME_RE}', 3)"
    return (f"CAST(round(CASE WHEN {h} <> '' THEN TRY_CAST({h} AS BIGINT) * 3600 + TRY_CAST({m} AS BIGINT) * 60 "
            f"+ TRY_CAST({x} AS DOUBLE) ELSE TRY_CAST({s} AS DOUBLE) END) AS INTEGER)")


def date_lenient(c: str) -> str:
    return f"CAST(TRY_STRPTIME(CAST({c} AS VARCHAR), '%Y-%m-%d') AS DATE)"


CATS = ("utm_source", "utm_medium", "utm_campaign", "utm_adcontent", "utm_keyword", "device_category",
        "device_os", "device_brand", "device_screen_resolution", "device_browser", "geo_country", "geo_city")

CLEAN_COLS = ",\n         ".join(
    ["session_id", "client_id", f"{date_lenient('visit_date')} AS visit_date",
     f"{seconds('visit_time')} AS visit_time", "TRY_CAST(visit_number AS INTEGER) AS visit_number"]
    + [norm(c) for c in CATS])

DATASET = f"""cleaned AS (
  SELECT {CLEAN_COLS}
  FROM (SELECT DISTINCT * FROM raw_sessions) d
),
dataset AS (
  SELECT cl.*, CASE WHEN p.session_id IS NULL THEN 0 ELSE 1 END AS target
  FROM cleaned cl LEFT JOIN positives p ON cl.session_id = p.session_id
)"""


def in_false(c: str, values) -> str:
    return f"coalesce({c} IN ({q(values)}), false)"


def eq_false(c: str, v) -> str:
    lit = f"'{v}'" if isinstance(v, str) else str(v)
    return f"coalesce({c} = {lit}, false)"


HOUR = "CASE WHEN visit_time IS NULL THEN NULL ELSE CAST(greatest(0, least(23, floor(visit_time / 3600))) AS INTEGER) END"
DAYPART = ("CASE WHEN h IS NULL THEN 'unknown' WHEN h < 6 THEN 'night' WHEN h < 12 THEN 'morning' "
           "WHEN h < 18 THEN 'day' ELSE 'evening' END")
GEO_REGION = (f"CASE WHEN NOT {eq_false('geo_country', CFG.home_country)} THEN 'other' "
              f"WHEN {eq_false('geo_city', CFG.capital_city)} THEN 'capital' "
              f"WHEN {eq_false('geo_city', CFG.second_city)} THEN 'second_city' ELSE 'home_other' END")
VBUCKET = ("CASE WHEN visit_number IS NULL OR visit_number <= 0 THEN NULL WHEN visit_number <= 1 THEN '1' "
           "WHEN visit_number <= 2 THEN '2' WHEN visit_number <= 5 THEN '3-5' WHEN visit_number <= 10 THEN '6-10' "
           "ELSE '11+' END")

EDA = f"""eda0 AS (SELECT *, {HOUR} AS h FROM dataset),
eda AS (
  SELECT * EXCLUDE (h), h AS visit_hour,
         CAST(isodow(visit_date) - 1 AS INTEGER) AS visit_dow,
         CAST(coalesce(isodow(visit_date) - 1 IN (5, 6), false) AS INTEGER) AS is_weekend,
         {DAYPART.replace('h ', 'h ')} AS visit_daypart,
         CAST({in_false('utm_medium', CFG.organic_mediums)} AS INTEGER) AS is_organic,
         CAST(NOT {in_false('utm_medium', CFG.organic_mediums)} AS INTEGER) AS is_paid,
         CAST({in_false('utm_source', CFG.social_sources)} AS INTEGER) AS is_social,
         CAST({eq_false('visit_number', 1)} AS INTEGER) AS is_first_visit,
         {GEO_REGION} AS geo_region,
         {VBUCKET} AS visit_bucket
  FROM eda0
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (RAW_SESSIONS, HITS, POSITIVES, DATASET)
EDA_BASE = (*BASE, EDA)

# --- engineered features (from the cleaned dataset) -------------------------
_RES_RE = r"^(\d+)x(\d+)$"
FEATURES = f"""feat0 AS (SELECT *, {HOUR} AS h,
       TRY_CAST(regexp_extract(device_screen_resolution, '{_RES_RE}', 1) AS DOUBLE) AS sw,
       TRY_CAST(regexp_extract(device_screen_resolution, '{_RES_RE}', 2) AS DOUBLE) AS sh
  FROM dataset),
features AS (
  SELECT session_id, target,
         CAST(h AS DOUBLE) AS visit_hour,
         CAST(day(visit_date) AS DOUBLE) AS visit_day,
         ln(1 + CAST(CASE WHEN visit_number > {CFG.visit_number_clip} THEN {CFG.visit_number_clip}
                          ELSE visit_number END AS DOUBLE)) AS visit_number_log,
         CAST(coalesce(isodow(visit_date) - 1 IN (5, 6), false) AS INTEGER) AS is_weekend,
         CAST({in_false('utm_medium', CFG.organic_mediums)} AS INTEGER) AS is_organic,
         CAST({in_false('utm_source', CFG.social_sources)} AS INTEGER) AS is_social,
         CAST({eq_false('visit_number', 1)} AS INTEGER) AS is_first_visit,
         CAST(utm_campaign <> '{CFG.unknown}' AS INTEGER) AS has_utm_campaign,
         CAST(utm_keyword <> '{CFG.unknown}' AS INTEGER) AS has_utm_keyword,
         CAST(utm_adcontent <> '{CFG.unknown}' AS INTEGER) AS has_utm_adcontent,
         CAST({eq_false('geo_country', CFG.home_country)} AS INTEGER) AS is_russia,
         CAST({eq_false('geo_city', CFG.capital_city)} AS INTEGER) AS is_moscow,
         CAST({eq_false('geo_city', CFG.second_city)} AS INTEGER) AS is_spb,
         sw AS screen_w, sh AS screen_h, CAST(sw IS NOT NULL AS INTEGER) AS screen_is_valid,
         utm_medium, utm_source, utm_campaign, utm_adcontent, utm_keyword, device_category, device_os,
         device_brand, device_browser, geo_city,
         coalesce(CAST(isodow(visit_date) - 1 AS VARCHAR), '{CFG.unknown}') AS visit_dow,
         coalesce(CAST(month(visit_date) AS VARCHAR), '{CFG.unknown}') AS visit_month,
         {DAYPART} AS visit_daypart
  FROM feat0
)"""
FEATURE_BASE = (*BASE, FEATURES)


def grouped_top(src: str, name: str, top_n: dict, other: str = "other", apply_to: str | None = None) -> str:
    """CTE ``name``: ``apply_to`` (default ``src``) with every column of
    ``top_n`` outside its top-N in ``src`` (by count desc, value asc) replaced
    by ``other``."""
    parts = []
    for c, n in top_n.items():
        parts.append(f"""{name}_{c} AS (SELECT {c} AS v FROM (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rk
                FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) t WHERE rk <= {n})""")
    repl = ", ".join(f"CASE WHEN {c} IN (SELECT v FROM {name}_{c}) THEN {c} ELSE '{other}' END AS {c}"
                     for c in top_n)
    parts.append(f"{name} AS (SELECT * REPLACE ({repl}) FROM {apply_to or src})")
    return ",\n".join(parts)


def hash_unit_sql(key: str, seed, salt: str = "") -> str:
    s = f"{key} || ':{seed}'" + (f" || ':{salt}'" if salt else "")
    return f"((('0x' || substr(md5({s}), 1, 8))::BIGINT) % 10000)"


def rank_sql(src: str, salt: str = "") -> str:
    tail = f" || ':{CFG.seed}'" + (f" || ':{salt}'" if salt else "")
    return (f"SELECT session_id, target, row_number() OVER (PARTITION BY target ORDER BY md5(session_id{tail})) AS r, "
            f"count(*) OVER (PARTITION BY target) AS n FROM {src}")


SPLIT = f"""sp AS (SELECT *, CASE WHEN {hash_unit_sql('session_id', CFG.seed)} < {int(round(CFG.test_size * 10000))}
                         THEN 'test' ELSE 'train' END AS split FROM features),
train AS (SELECT * FROM sp WHERE split = 'train'),
test AS (SELECT * FROM sp WHERE split = 'test')"""
SPLIT_BASE = (*FEATURE_BASE, SPLIT)
