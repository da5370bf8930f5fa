"""Scalar helpers as ``Column -> Column`` functions built from native expressions.

Nothing here is a Python UDF: every helper expands to Catalyst expressions, so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CAST_TYPES = {
    "int": "bigint", "int64": "bigint", "integer": "bigint", "bigint": "bigint",
    "bool": "boolean", "boolean": "boolean",
    "string": "string", "text": "string", "varchar": "string",
    "float": "double", "float64": "double", "double": "double",
    "numeric": "decimal(18,2)", "decimal": "decimal(18,2)",
    "date": "date",
    "timestamp": "timestamp_ntz", "datetime": "timestamp_ntz", "timestamptz": "timestamp_ntz",
}


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' -> null, after a cast to text (X1's first half)."""
    s = col_of(c).cast("string")
    return F.when(s == F.lit(""), F.lit(None).cast("string")).otherwise(s)


def safe_cast(c: Column | str, type_name: str) -> Column:
    """Blank text becomes null, malformed text becomes null (try_cast)."""
    target = _CAST_TYPES.get(type_name.lower(), type_name)
    return blank_to_null(c).try_cast(target)


def safe_divide(num: Column, den: Column) -> Column:
    """Null when the denominator is zero or null; double result."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def seconds_between(end: Column, start: Column) -> Column:
    """Fractional seconds from ``start`` to ``end`` (both timestamps)."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1_000_000.0)


def regex_group(c: Column, pattern: str) -> Column:
    """First capture group, null when there is no match."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


EMAIL_DOMAIN_PATTERN = "@([^@]+)$"


def email_domain(c: Column) -> Column:
    return regex_group(F.lower(c), EMAIL_DOMAIN_PATTERN)


def json_value(c: Column, key: str) -> Column:
    """Scalar of a top-level JSON key as text."""
    return F.get_json_object(c, f"$['{key}']")


def null_string() -> Column:
    """Typed null text."""
    return F.lit(None).cast("string")


def property_col(prefix: str, name: str | None) -> Column:
    """A configurable ``<prefix>_<name>`` column, or typed null when unset."""
    if not name:
        return null_string()
    return F.col(f"{prefix}_{name}")


def seconds_to_hours(c: Column) -> Column:
    return c / F.lit(3600.0)


def seconds_to_days(c: Column) -> Column:
    return c / F.lit(86400.0)


def trimmed_or_null(c: Column) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(c), F.lit(""))


def name_key(c: Column) -> Column:
    """Partner names always match on ``lower(trim(name))``."""
    return F.lower(F.trim(c))


def starts_with_ci(c: Column, prefix: str) -> Column:
    """Case-folded prefix match with no wildcard surprises."""
    return F.startswith(F.lower(c), F.lit(prefix.lower()))


def month_start(c: Column) -> Column:
    return F.date_trunc("month", c).cast("date")


def quarter_start(c: Column) -> Column:
    return F.date_trunc("quarter", c).cast("date")


def year_start(c: Column) -> Column:
    return F.date_trunc("year", c).cast("date")


def days_between_nonneg(end: Column, start: Column) -> Column:
    """Days from start to end; null when either is missing or the gap is negative."""
    d = seconds_to_days(seconds_between(end, start))
    return F.when(d >= 0, d)


def ts_literal(value) -> Column:
    """A timestamp-without-zone literal."""
    return F.lit(value).cast("timestamp_ntz")


def parse_loose_timestamp(c: Column) -> Column:
    """Epoch milliseconds (number or digit text) or ISO text, whose offset counts (UTC without one); else null.

    The result is in UTC, which ``prepare_session`` makes the session's zone.
    """
    s = F.trim(c.cast("string"))
    millis = F.timestamp_millis(s.try_cast("bigint")).cast("timestamp_ntz")
    iso = F.when(s.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), s.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(s.rlike("^[0-9]+$"), millis).otherwise(iso)


def text_cut(c: Column, n: int) -> Column:
    """Text kinds are cut to ``n`` characters."""
    return F.substring(c.cast("string"), 1, n)
