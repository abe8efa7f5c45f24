"""Differences and texts of times.  Times with and without zone compare as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000


def micros(t: Column) -> Column:
    """Microseconds since 1970 in UTC (the session's zone must be UTC)."""
    return F.unix_micros(t.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(3_600_000_000.0)


def seconds_between(a: Column, b: Column) -> Column:
    """Absolute difference in seconds."""
    return F.abs(micros(a) - micros(b)) / F.lit(1_000_000.0)


def utc_text(t: Column) -> Column:
    """2026-01-05 14:22:33+00:00, with six decimals only where they are not zero."""
    t = t.cast("timestamp")
    return F.when(F.unix_micros(t) % 1_000_000 == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ssxxx")).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))


def iso_z(t: Column) -> Column:
    """2026-01-05T14:22:33Z"""
    return F.date_format(t.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def span_text(us: Column) -> Column:
    """2 days 03:00:00, from microseconds (not negative), with six decimals only where they are not zero."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    rest = us % DAY
    clock = F.concat(two(F.floor(rest / 3_600_000_000)), F.lit(":"), two(F.floor(rest / 60_000_000) % 60), F.lit(":"), two(F.floor(rest / 1_000_000) % 60))
    part = us % 1_000_000
    return F.concat(F.floor(us / DAY).cast("string"), F.lit(" days "), clock, F.when(part != 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise(F.lit("")))


def one_decimal(x: Column) -> Column:
    """Rounded half to even on the binary value, as C's and Python's `.1f`."""
    return F.call_function("format_number", x, F.lit("0.0"))


def int_list(a: Column) -> Column:
    """[12, 13]"""
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ", "), F.lit("]"))


def str_list(a: Column) -> Column:
    """['a', 'b']"""
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def bins(t: Column, width_us: int) -> Column:
    """Number of the bin of `width_us` that holds a time."""
    return F.floor(micros(t) / F.lit(width_us)).cast("long")
