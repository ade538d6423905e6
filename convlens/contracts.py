"""Schemas, domain constants and the configuration object every operator reads.

Operators take column names and a :class:`ConversionConfig`; nothing below is
hard-wired into an operator, so the same code runs on the original web-analytics
tables and on the star-schema test tables (see ``convlens.sources.testdata``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the analysed project's definitions for the
# results to agree. Stated in natural order.
# ---------------------------------------------------------------------------
TARGET_ACTIONS = (
    "sub_car_claim_click",
    "sub_car_claim_submit_click",
    "sub_open_dialog_click",
    "sub_custom_question_submit_click",
    "sub_call_number_click",
    "sub_callback_submit_click",
    "sub_submit_success",
    "sub_car_request_submit_click",
)
DROP_COLUMNS = ("device_model",)
UNKNOWN = "unknown"
OTHER = "other"
JUNK_TOKENS = ("(not set)", "(none)", "(not provided)", "", "nan")
ORGANIC_MEDIUMS = ("organic", "referral", "(none)")
SOCIAL_SOURCES = (
    "QxAxdyPLuQMEcrdZWdWb",
    "MvfHsxITijuriZxsqZqt",
    "ISrKoXQCxqqYvAZICvjs",
    "IZEXUFLARCUMynmHNBGo",
    "PlbkrSYoHuZBWfYjYnfw",
    "gVRrcxiDQubJiljoTbGm",
)
TOP_N_BY_COLUMN = {
    "utm_medium": 15,
    "utm_source": 20,
    "utm_campaign": 20,
    "utm_adcontent": 20,
    "utm_keyword": 25,
    "geo_city": 20,
    "device_brand": 15,
    "device_browser": 15,
    "device_os": 12,
}
MODEL_INPUT_COLUMNS = (
    "visit_date", "visit_time", "visit_number",
    "utm_source", "utm_medium", "utm_campaign", "utm_adcontent", "utm_keyword",
    "device_category", "device_os", "device_brand",
    "device_screen_resolution", "device_browser",
    "geo_country", "geo_city",
)
REQUIRED_INPUT_FIELDS = ("utm_source", "utm_medium", "device_category")
INPUT_DEFAULTS = {"geo_country": "Russia", "visit_number": 1}
VISIT_NUMBER_CLIP = 50
SEED = 42
TEST_SIZE = 0.20
VAL_SIZE = 0.10
ALPHA = 0.05
HOME_COUNTRY = "Russia"
CAPITAL_CITY = "Moscow"
SECOND_CITY = "Saint Petersburg"
VISIT_BUCKETS = ((1, "1"), (2, "2"), (5, "3-5"), (10, "6-10"))  # right-closed upper edges
VISIT_BUCKET_TOP = "11+"
DAYPARTS = ((6, "night"), (12, "morning"), (18, "day"))  # hour < edge -> label
DAYPART_LAST = "evening"
NUMERIC_FEATURES = (
    "visit_hour", "visit_day", "visit_number_log",
    "is_weekend", "is_organic", "is_social", "is_first_visit",
    "has_utm_campaign", "has_utm_keyword", "has_utm_adcontent",
    "is_russia", "is_moscow", "is_spb",
    "screen_w", "screen_h", "screen_is_valid",
)
CATEGORICAL_FEATURES = (
    "utm_medium", "utm_source", "utm_campaign", "utm_adcontent", "utm_keyword",
    "device_category", "device_os", "device_brand", "device_browser",
    "geo_city", "visit_dow", "visit_month", "visit_daypart",
)
# ---------------------------------------------------------------------------

CATEGORY_PREFIXES = ("utm_", "device_", "geo_")
LEAK_PREFIXES = ("hit_", "event_")
ID_COLUMNS = ("session_id", "client_id")


@dataclass(frozen=True)
class ConversionConfig:
    """Everything an operator may need to know about the domain."""

    target_actions: tuple[str, ...] = TARGET_ACTIONS
    drop_columns: tuple[str, ...] = DROP_COLUMNS
    unknown: str = UNKNOWN
    other: str = OTHER
    junk_tokens: tuple[str, ...] = JUNK_TOKENS
    organic_mediums: tuple[str, ...] = ORGANIC_MEDIUMS
    social_sources: tuple[str, ...] = SOCIAL_SOURCES
    top_n_by_column: dict = field(default_factory=lambda: dict(TOP_N_BY_COLUMN))
    model_input_columns: tuple[str, ...] = MODEL_INPUT_COLUMNS
    visit_number_clip: int = VISIT_NUMBER_CLIP
    seed: int = SEED
    test_size: float = TEST_SIZE
    val_size: float = VAL_SIZE
    alpha: float = ALPHA
    home_country: str = HOME_COUNTRY
    capital_city: str = CAPITAL_CITY
    second_city: str = SECOND_CITY
    lowercase_columns: tuple[str, ...] = ("utm_medium",)
    # junk tokens that keep their meaning in a given column
    preserve_by_column: dict = field(default_factory=lambda: {"utm_medium": ("(none)",)})

    def with_(self, **kw) -> "ConversionConfig":
        return replace(self, **kw)


DEFAULT_CONFIG = ConversionConfig()

# Raw sessions as they arrive (CSV): ids forced to string, nothing inferred.
RAW_SESSIONS_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("visit_date", T.StringType()),
    T.StructField("visit_time", T.StringType()),
    T.StructField("visit_number", T.StringType()),
    T.StructField("utm_source", T.StringType()),
    T.StructField("utm_medium", T.StringType()),
    T.StructField("utm_campaign", T.StringType()),
    T.StructField("utm_adcontent", T.StringType()),
    T.StructField("utm_keyword", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("device_os", T.StringType()),
    T.StructField("device_brand", T.StringType()),
    T.StructField("device_model", T.StringType()),
    T.StructField("device_screen_resolution", T.StringType()),
    T.StructField("device_browser", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("geo_city", T.StringType()),
])

HITS_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("hit_date", T.StringType()),
    T.StructField("hit_time", T.StringType()),
    T.StructField("hit_number", T.StringType()),
    T.StructField("hit_type", T.StringType()),
    T.StructField("hit_referer", T.StringType()),
    T.StructField("hit_page_path", T.StringType()),
    T.StructField("event_category", T.StringType()),
    T.StructField("event_action", T.StringType()),
    T.StructField("event_label", T.StringType()),
    T.StructField("event_value", T.StringType()),
])

# The 15-field model/API input contract (all strings except visit_number).
CONTRACT_SCHEMA = T.StructType(
    [T.StructField("session_id", T.StringType())]
    + [
        T.StructField(c, T.IntegerType() if c == "visit_number" else T.StringType())
        for c in MODEL_INPUT_COLUMNS
    ]
)

SCORE_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
])


def categorical_columns(columns) -> list[str]:
    """Visit attributes that are categories: every utm_/device_/geo_ column."""
    return [c for c in columns if c.startswith(CATEGORY_PREFIXES)]


def assert_no_leak(columns, allow_target: bool = False) -> None:
    """Raise at plan time if hit fields, ids or the label reach a feature set."""
    bad = [c for c in columns if c.startswith(LEAK_PREFIXES) or c in ID_COLUMNS]
    if not allow_target and "target" in columns:
        bad.append("target")
    if bad:
        raise ValueError(f"leak guard: columns not allowed in features: {bad}")
