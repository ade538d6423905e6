"""Cleaning: de-duplication, lenient typing, column drop, category
normalisation, label attach; plus the input-contract validator.

``clean`` is one lazy plan: the dedup aggregate is the only shuffle besides the
label join, and all per-column work happens in a single ``select``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.contracts import (
    CONTRACT_SCHEMA, DEFAULT_CONFIG, INPUT_DEFAULTS, REQUIRED_INPUT_FIELDS, ConversionConfig,
    categorical_columns,
)
from convlens.functions import columns as C
from convlens.operators.labeling import left_join_fill


def filter_in_set(df: DataFrame, col: str, values) -> DataFrame:
    """Rows whose ``col`` is in ``values`` (pushed to Parquet as ``In``)."""
    return df.where(F.col(col).isin(list(values)))


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop columns if present (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication (partial aggregate map-side, so a hot group of
    copies collapses before the shuffle)."""
    return df.dropDuplicates()


def normalize_column(c: str, cfg: ConversionConfig = DEFAULT_CONFIG):
    """The per-column normalisation rule: only configured columns lowercase,
    only configured tokens survive as themselves."""
    return C.normalize_category(
        c, cfg.junk_tokens, cfg.unknown,
        lowercase=c in cfg.lowercase_columns,
        preserve=cfg.preserve_by_column.get(c, ()),
    )


def type_columns(df: DataFrame) -> list:
    """Lenient typing of the three non-category visit fields."""
    out = []
    for c in df.columns:
        if c == "visit_date":
            out.append(C.parse_date_lenient(c).alias(c))
        elif c == "visit_time":
            out.append(C.time_to_seconds(c).alias(c))
        elif c == "visit_number":
            out.append(C.numeric_lenient(c, "int").alias(c))
        else:
            out.append(F.col(c))
    return out


def clean_sessions(df: DataFrame, cfg: ConversionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Types + normalisation of every utm_/device_/geo_ column: one select types and trims, the next one judges."""
    cats = set(categorical_columns(df.columns))
    trimmed = df.select(*[C.stripped(c, c in cfg.lowercase_columns).alias(c) if c in cats else e for c, e in zip(df.columns, type_columns(df))])
    return trimmed.select(*[C.normalize_stripped(c, cfg.junk_tokens, cfg.unknown, cfg.preserve_by_column.get(c, ())).alias(c) if c in cats else F.col(c)
                            for c in df.columns])


def clean(sessions: DataFrame, target: DataFrame | None, cfg: ConversionConfig = DEFAULT_CONFIG,
          key: str = "session_id") -> DataFrame:
    """dedup -> types -> drop -> normalise -> left-join target (missing -> 0)."""
    df = dedup_rows(sessions)
    df = drop_columns(df, cfg.drop_columns)
    df = clean_sessions(df, cfg)
    if target is not None:
        df = left_join_fill(df, target, key)
    return df


def reject_empty(records: DataFrame) -> DataFrame:
    """The records; an empty batch is an error, as scoring nothing is a caller's mistake."""
    if records.isEmpty():
        raise ValueError("the batch holds no records")
    return records


def validate_contract(records: DataFrame, json_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split JSON visit records into (accepted, rejected).

    Text fields must be JSON strings (or null, if not required): numbers, booleans, arrays and objects are rejected.
    ``visit_number`` must be a whole number >= 1, as an integer, an integral float or integer text (``2``, ``2.0``, ``"2"``).
    Defaults apply only when a key is *absent* (an explicit null stays null). Extra keys are ignored.
    Rejected rows carry the raw JSON and an array of reasons.
    """
    # variant keeps each value's JSON type; what is no JSON object gives NULL. The parsed record is a generated row, so that
    # no later filter or projection repeats the parse
    is_object = F.col(json_col).rlike(r"^\s*\{")
    df = records.select(F.col(json_col), F.explode(F.array(F.when(is_object, F.try_parse_json(F.col(json_col))))).alias("_v"))
    missing, invalid, fields = [], [], []
    object_ = F.col("_v").isNotNull()
    for fld in CONTRACT_SCHEMA.fields:
        name = fld.name
        value = F.try_variant_get(F.col("_v"), f"$.{name}", "variant")
        present = value.isNotNull()
        given = present & ~F.is_variant_null(value)
        text = F.try_variant_get(F.col("_v"), f"$.{name}", "string")
        is_text = F.schema_of_variant(value) == "STRING"
        if name == "visit_number":
            # integer text must be plain digits; JSON numbers may carry a zero fraction
            whole = C.numeric_lenient(text, "int")
            fine = whole.isNotNull() & (whole >= 1) & (~is_text | text.rlike(r"^\s*[+-]?\d+\s*$"))
            invalid.append(F.when(given & ~F.coalesce(fine, F.lit(False)), F.lit("invalid:visit_number")))
            c = whole
        else:
            if name in REQUIRED_INPUT_FIELDS:
                missing.append(F.when(object_ & ~F.coalesce(given, F.lit(False)), F.lit(f"missing:{name}")))
            invalid.append(F.when(given & ~F.coalesce(is_text, F.lit(False)), F.lit(f"invalid:{name}")))
            c = text.cast(fld.dataType)
        if name in INPUT_DEFAULTS:
            c = F.when(present, c).otherwise(F.lit(INPUT_DEFAULTS[name]).cast(fld.dataType))
        fields.append(c.alias(name))
    broken = F.when(~object_, F.lit("invalid:json"))
    df = df.withColumn("_reasons", F.filter(F.array(*missing, *invalid, broken), lambda x: x.isNotNull()))
    accepted = df.where(F.size("_reasons") == 0).select(*fields)
    rejected = df.where(F.size("_reasons") > 0).select(F.col(json_col).alias("record"),
                                                        F.col("_reasons").alias("reasons"))
    return accepted, rejected
