"""Column-expression builders. All JVM-side, all codegen-able; no Python UDFs.

Each function returns a ``Column`` so callers can place it in one ``select``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from convlens.contracts import DAYPART_LAST, DAYPARTS, VISIT_BUCKET_TOP, VISIT_BUCKETS

# every Unicode white-space character (Python's \\s and Java's (?U)\\s, without the separators U+001C to U+001F)
_WS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip``: removes every leading/trailing whitespace char
    (plain ``trim`` removes spaces only)."""
    return F.btrim(col_(c).cast("string"), F.lit(_WS))


def isin_false(c, values: Iterable) -> Column:
    """Membership where NULL yields False (pandas ``isin``), not NULL."""
    return F.coalesce(col_(c).isin(list(values)), F.lit(False))


def eq_false(c, value) -> Column:
    """Equality where NULL yields False."""
    return F.coalesce(col_(c) == F.lit(value), F.lit(False))


def normalize_category(c, junk: Iterable[str], unknown: str = "unknown",
                       lowercase: bool = False, preserve: Iterable[str] = ()) -> Column:
    """Trim; optionally lowercase; NULL or a junk token (case-insensitive) that is
    not preserved becomes ``unknown``; everything else keeps its case."""
    return normalize_stripped(stripped(c, lowercase), junk, unknown, preserve)


def stripped(c, lowercase: bool = False) -> Column:
    return F.lower(strip_ws(c)) if lowercase else strip_ws(c)


def normalize_stripped(s, junk: Iterable[str], unknown: str = "unknown", preserve: Iterable[str] = ()) -> Column:
    """The second half of ``normalize_category``, for text that is trimmed (and lowercased) already. The function over an array of one binds
    the text to a name, and as such functions stay out of whole-stage code, a select of many columns is compiled in small methods (the
    JVM interprets those above 8,000 bytes)."""
    junk_l = sorted({j.lower() for j in junk} - {p.lower() for p in preserve})

    def judged(x: Column) -> Column:
        is_junk = F.array_contains(F.array(*map(F.lit, junk_l)), F.lower(x)) if junk_l else F.lit(False)
        return F.when(x.isNull() | is_junk, F.lit(unknown)).otherwise(x)

    return F.get(F.transform(F.array(col_(s)), judged), F.lit(0))


def parse_date_lenient(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String ``yyyy-MM-dd`` -> DATE, bad values -> NULL; the text of a date or timestamp is one too (its time is
    dropped), so columns of those types pass through."""
    s = strip_ws(c)
    stamp = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?$", 1)
    return F.coalesce(F.try_to_date(s, fmt), F.try_to_date(F.when(stamp != "", stamp), "yyyy-MM-dd"))


def time_to_seconds(c) -> Column:
    """``H:MM:SS`` (hours may exceed 23, like a timedelta) or a number of
    seconds -> rounded integer seconds; anything else, NaN, infinities and
    values beyond an integer -> NULL."""
    s = strip_ws(c)
    m = F.regexp_extract(s, r"^(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)$", 1)
    mi = F.regexp_extract(s, r"^(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)$", 2)
    se = F.regexp_extract(s, r"^(\d+):(\d{1,2}):(\d{1,2}(?:\.\d+)?)$", 3)
    hms = m.try_cast("double") * 3600 + mi.try_cast("double") * 60 + se.try_cast("double")
    num = s.try_cast("double")
    total = F.round(F.when(m != "", hms).otherwise(num))
    return F.when(F.abs(total) <= 2 ** 31 - 1, total).cast("int")  # false for NaN: it is greater than any number


def numeric_lenient(c, to: str = "int") -> Column:
    """``to_numeric(errors='coerce')``: bad text -> NULL. For whole-number types, text such as ``3.0`` and ``1e2`` counts;
    numbers with a fraction, NaN and values out of range give NULL."""
    s = strip_ws(c)
    if to in ("int", "bigint"):
        d = s.try_cast("double")
        most = 2 ** 31 - 1 if to == "int" else 2 ** 53
        return F.coalesce(s.try_cast(to), F.when((F.abs(d) <= most) & (d == F.round(d)), d).cast(to))
    return s.try_cast(to)


def visit_hour(seconds) -> Column:
    """floor(seconds / 3600) clipped to 0..23; NULL stays NULL
    (``least``/``greatest`` would skip the NULL, so guard it)."""
    h = F.floor(col_(seconds) / F.lit(3600))
    return F.when(h.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(0), F.least(F.lit(23), h))).cast("int")


def daypart(hour, unknown: str = "unknown") -> Column:
    h = col_(hour)
    expr = F.when(h.isNull(), F.lit(unknown))
    for edge, label in DAYPARTS:
        expr = expr.when(h < edge, F.lit(label))
    return expr.otherwise(F.lit(DAYPART_LAST))


def visit_bucket(n) -> Column:
    """Right-closed buckets (0,1], (1,2], (2,5], (5,10], (10, inf); NULL or <= 0 -> NULL."""
    v = col_(n)
    expr = F.when(v.isNull() | (v <= 0), F.lit(None).cast("string"))
    for upper, label in VISIT_BUCKETS:
        expr = expr.when(v <= upper, F.lit(label))
    return expr.otherwise(F.lit(VISIT_BUCKET_TOP))


def weekday_mon0(d) -> Column:
    """Day of week, Monday = 0 (Spark ``dayofweek`` is Sunday = 1)."""
    return F.weekday(col_(d))


def screen_dims(c) -> tuple[Column, Column]:
    """``WxH`` -> (W, H) as doubles; anything else -> NULLs."""
    pat = r"^(\d+)x(\d+)$"
    s = col_(c).cast("string")
    w = F.regexp_extract(s, pat, 1).try_cast("double")
    h = F.regexp_extract(s, pat, 2).try_cast("double")
    return w, h


def round6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def safe_div(a, b) -> Column:
    """a / b with NULL when b is 0 (ANSI division by zero would throw)."""
    return F.try_divide(col_(a), col_(b))
