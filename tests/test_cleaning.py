"""Normalisation, lenient types and the clean step on invented visits."""

from pyspark.sql import functions as F

from convlens.contracts import DEFAULT_CONFIG, RAW_SESSIONS_SCHEMA
from convlens.functions import columns as C
from convlens.operators import cleaning, labeling, profiling


def _norm(spark, values, col):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {col} string")
    out = df.select("i", cleaning.normalize_column(col, DEFAULT_CONFIG).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def test_only_configured_columns_are_lowered(spark):
    values = ["Firefox ESR", "NULL", "  (Not Provided)", "none", "N/A x", None]
    assert _norm(spark, values, "device_browser") == [
        "unknown" if v is None or v.strip().lower() in DEFAULT_CONFIG.junk_tokens else v.strip() for v in values]
    assert _norm(spark, ["E-Mail", "Referral "], "utm_medium") == ["e-mail", "referral"]


def test_a_token_kept_in_one_column_is_junk_in_others(spark):
    assert _norm(spark, ["(None)"], "utm_medium") == ["(none)"] and _norm(spark, ["(None)"], "utm_campaign") == ["unknown"]


def test_strip_removes_all_whitespace(spark):
    assert _norm(spark, ["\t Apple \n", " NaN "], "device_brand") == ["Apple", "unknown"]


BASE = {"client_id": "owner", "visit_date": "2022-11-30", "visit_time": "06:05:04", "visit_number": "3", "utm_source": "Partner-7",
        "utm_medium": "Referral", "utm_campaign": "autumn", "utm_adcontent": "banner 2", "utm_keyword": "shoes", "device_category": "tablet",
        "device_os": "Linux", "device_brand": "Fairphone", "device_model": None, "device_screen_resolution": "800x1280",
        "device_browser": "Firefox", "geo_country": "Norway", "geo_city": "Bergen"}


def _visits(spark, **changes):
    """One visit a keyword, the base with the fields given."""
    rows = [tuple(({"session_id": k} | BASE | v)[f.name] for f in RAW_SESSIONS_SCHEMA.fields) for k, v in changes.items()]
    return spark.createDataFrame(rows, RAW_SESSIONS_SCHEMA)


def _some(spark):
    return _visits(spark, plain={}, junk={"utm_source": " nan", "utm_keyword": "(not set)", "device_os": None, "visit_time": "0:00:01"},
                   odd={"device_screen_resolution": "wide", "visit_date": "30/11/2022", "utm_medium": "(NONE)", "visit_time": "later"})


def test_clean_step(spark):
    sessions = _some(spark)
    target = spark.createDataFrame([("junk", 1), ("nobody", 1)], "session_id string, target int")
    out = cleaning.clean(sessions, target, DEFAULT_CONFIG)
    assert set(out.columns) == {f.name for f in RAW_SESSIONS_SCHEMA.fields} - {"device_model"} | {"target"}
    rows = {r.session_id: r for r in out.collect()}
    assert {k: r.target for k, r in rows.items()} == {"plain": 0, "junk": 1, "odd": 0}
    assert rows["plain"].visit_time == 6 * 3600 + 5 * 60 + 4 and rows["junk"].visit_time == 1 and rows["odd"].visit_time is None
    assert (rows["plain"].utm_medium, rows["odd"].utm_medium) == ("referral", "(none)")
    assert (rows["plain"].utm_source, rows["junk"].utm_source, rows["junk"].utm_keyword, rows["junk"].device_os) == ("Partner-7", *["unknown"] * 3)
    assert str(rows["plain"].visit_date) == "2022-11-30" and rows["odd"].visit_date is None and rows["plain"].visit_number == 3
    summary = profiling.cleaning_summary(sessions, out).first()
    assert summary.n_invalid_resolution == 1 and summary.n_duplicates == 0


def test_clean_dedups_full_rows(spark):
    s = _some(spark)
    out = cleaning.clean(s.unionByName(s), None)
    assert out.count() == 3


def test_lenient_parsers(spark):
    df = spark.createDataFrame([("2021-06-01", "25:00:00", "12"), ("bad", "x", "n/a"), (None, "36000", " 7 ")],
                               "d string, t string, n string")
    r = df.select(C.parse_date_lenient("d").alias("d"), C.time_to_seconds("t").alias("t"),
                  C.numeric_lenient("n").alias("n")).collect()
    assert str(r[0].d) == "2021-06-01" and r[0].t == 90000 and r[0].n == 12
    assert r[1].d is None and r[1].t is None and r[1].n is None
    assert r[2].d is None and r[2].t == 36000 and r[2].n == 7


def test_label_every_session_and_null_ids_ignored(spark):
    sessions = spark.createDataFrame([("a",), ("b",), ("c",)], "session_id string")
    hits = spark.createDataFrame([("a", "sub_submit_success"), ("a", "view"), (None, "sub_submit_success"),
                                  ("b", "view"), ("z", "sub_submit_success")], "session_id string, event_action string")
    lab = {r.session_id: r.target for r in labeling.target_table(sessions, hits).collect()}
    assert lab == {"a": 1, "b": 0, "c": 0}
    assert [r.session_id for r in labeling.orphan_hit_sessions(sessions, hits).collect()] == ["z"]
    assert [r.session_id for r in labeling.sessions_without_hits(sessions, hits).collect()] == ["c"]


def test_quality_rules_pass_on_clean_data(spark):
    s = _some(spark)
    out = cleaning.clean(s, spark.createDataFrame([("plain", 1)], "session_id string, target int"))
    rules = {r.rule: r.passed for r in profiling.quality_checks(out, n_expected=3).collect()}
    assert all(rules.values()), rules


def test_missing_before_after_marks_dropped(spark):
    s = _some(spark)
    out = cleaning.clean(s, None)
    rows = {r.column: r for r in profiling.missing_before_after(s, out).collect()}
    assert rows["device_model"].dropped == 1 and rows["device_model"].missing_before_pct == 100.0
    assert rows["utm_keyword"].missing_after_pct == 0.0


def test_isin_null_is_false(spark):
    df = spark.createDataFrame([(None,), ("organic",)], "m string")
    assert [r[0] for r in df.select(C.isin_false("m", ["organic"])).collect()] == [False, True]
    assert df.select(F.col("m").isin("organic")).collect()[0][0] is None


def test_csv_readers_keep_ids_as_strings_and_prune(spark, tmp_path):
    from convlens.sources import readers

    p = tmp_path / "sessions.csv"
    p.write_text("session_id,client_id,visit_date,visit_time,visit_number,utm_source,utm_medium,utm_campaign,"
                 "utm_adcontent,utm_keyword,device_category,device_os,device_brand,device_model,"
                 "device_screen_resolution,device_browser,geo_country,geo_city\n"
                 "0012,0007,2021-06-01,10:00:00,1,src,organic,,,,mobile,,,,360x800,Chrome,Russia,Moscow\n")
    s = readers.read_sessions_csv(spark, str(p)).first()
    assert s.session_id == "0012" and s.client_id == "0007"
    h = tmp_path / "hits.csv"
    h.write_text("session_id,hit_date,hit_time,hit_number,hit_type,hit_referer,hit_page_path,event_category,"
                 "event_action,event_label,event_value\n0012,2021-06-01,1,1,event,,/,cat,sub_submit_success,,\n")
    hits = readers.read_hits_csv(spark, str(h))
    assert hits.columns == ["session_id", "event_action"]
    assert hits.first().event_action == "sub_submit_success"
