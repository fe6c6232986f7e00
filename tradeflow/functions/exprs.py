"""Column expressions for the null, blank, default and date rules of the
source SQL (ISNULL/COALESCE/NULLIF/TRIM/CONCAT/CAST and the sell-out date
cleaner). All of them are plain Catalyst expressions: they stay inside
whole-stage codegen and need no Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the source SQL uses.
SENTINEL_DATE = "1900-01-01"          # stands in for a missing milestone date
STRICT_DATE_PATTERN = r"^\d{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"
STRICT_DATE_FORMAT = "yyyy-M-d"       # digits of '%Y-%m-%d' with 1- or 2-digit month/day


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """``TRIM(ISNULL(c, '')) = ''``: null, empty and all-space are blank."""
    return F.trim(F.coalesce(col(c).cast("string"), F.lit(""))) == F.lit("")


def eq_blank(c) -> Column:
    """Bare ``c = ''`` of the source dialect: trailing blanks are ignored and
    a null stays unknown (so it is rejected by a filter)."""
    return F.rtrim(col(c).cast("string")) == F.lit("")


def ne_blank(c) -> Column:
    """Bare ``c <> ''`` with trailing blanks ignored; null stays unknown."""
    return F.rtrim(col(c).cast("string")) != F.lit("")


def or_default(c, default) -> Column:
    """``ISNULL(c, default)``; the default literal is cast to ``c``'s type by
    the caller passing a typed value."""
    return F.coalesce(col(c), default if isinstance(default, Column) else F.lit(default))


def or_blank(c) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def or_zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def sentinel_ts(c) -> Column:
    """``ISNULL(ts, '1900-01-01')`` for a timestamp without zone."""
    return F.coalesce(col(c), F.lit(SENTINEL_DATE + " 00:00:00").cast("timestamp_ntz"))


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: null instead of a divide-by-zero error."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def concat_key(*parts, sep: str = "-") -> Column:
    """``CONCAT(a, '-', b)`` of the source dialect, where a null part counts
    as ''. Spark's ``concat`` would return null instead."""
    return F.concat_ws(sep, *[or_blank(p) for p in parts])


def flag(c) -> Column:
    """Null-tolerant bit: ``ISNULL(c, 0) = 1`` as a boolean."""
    return F.coalesce(col(c).cast("boolean"), F.lit(False))


def bit_to_tiny(c) -> Column:
    """``CONVERT(tinyint, bit)``."""
    return col(c).cast("tinyint")


def parse_strict_date(c) -> Column:
    """Text date in ``YYYY-M-D`` form to DATE, anything else to null.

    Matches a Python ``strptime(s, '%Y-%m-%d')`` cleaner: four-digit year,
    month and day with one or two digits (day may be space-padded), the
    calendar must exist (``2024-11-31`` is null) and nothing may follow
    (``2024-11-07T10`` is null).
    """
    s = col(c).cast("string")
    cleaned = F.regexp_replace(s, "- ", "-")
    return F.when(s.rlike(STRICT_DATE_PATTERN), F.try_to_date(cleaned, STRICT_DATE_FORMAT))


def object_id_text(c) -> Column:
    """Document id to text; extended-JSON ``{"$oid": ...}`` is unwrapped."""
    s = col(c).cast("string")
    return F.coalesce(F.get_json_object(s, "$.$oid"), s)


def date_text(c) -> Column:
    """Date or timestamp to ``yyyy-MM-dd`` text (null stays null)."""
    return F.date_format(col(c), "yyyy-MM-dd")


def ts_text(c) -> Column:
    """Timestamp to text with microseconds, fixed width."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def closed_range(c, start, end) -> Column:
    """``c >= start AND c <= end``."""
    return (col(c) >= F.lit(start)) & (col(c) <= F.lit(end))


def fixed_units(term, scale: int) -> Column:
    """A money term as a whole number of ``10**-scale`` units (ties to even),
    as ``decimal(38,0)``: no term or sum up to 1e38 units is cut."""
    return F.rint(col(term) * F.lit(float(10 ** scale))).cast("decimal(38,0)")


def units_value(units, scale: int) -> Column:
    """Whole units back to a double."""
    return col(units).cast("double") / F.lit(float(10 ** scale))


#: A whole number is summed as two longs, in units of this and what is left.
LIMB = float(1 << 20)


def exact_sum(term, scale: int = 2) -> Column:
    """Sum a money term in whole units and return a double.

    A double ``sum`` depends on the order rows arrive in, so two runs with
    different partitioning (or two engines) disagree in the last digit. Each
    term is rounded to ``10**-scale`` units, and the units are summed as whole
    numbers: order independent, and still a partial aggregate. A number is
    split into two longs, whose sums Spark keeps in a hash table without making
    an object a row; they become one decimal when the group is done. A term
    over 2**53 units keeps a double's 53 bits; sums over 2**83 units (1e25) are an
    error and not cut. The low parts of 1e13 rows fit a long.
    """
    units = F.rint(col(term) * F.lit(float(10 ** scale)))
    high = F.rint(units / F.lit(LIMB))
    low = (units - high * F.lit(LIMB)).cast("long")
    whole = F.sum(high.cast("long")).cast("decimal(20,0)") * F.lit(1 << 20).cast("decimal(10,0)") + F.sum(low).cast("decimal(20,0)")
    return units_value(whole, scale)
