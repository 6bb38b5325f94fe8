"""Time helpers that don't depend on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(c: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone (one with a zone is taken in the session's)."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c.cast("timestamp_ntz"))


def from_micros(c: Column) -> Column:
    """The timestamp without zone of microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", c, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def with_halo(t: Column, block: int, before: int = 0, after: int = 0) -> Column:
    """The blocks of `block` microseconds that a row at t belongs to or is copied into.

    before/after: how far in front of/behind its own rows a block needs to see. A row is a block's own where
    floor(t / block) is that block.
    """
    lo, hi = F.floor((t - F.lit(after)) / F.lit(block)), F.floor((t + F.lit(before)) / F.lit(block))
    return F.explode(F.sequence(lo, hi))


def water_year(c: Column) -> Column:
    """The year that a water year (October to September) ends in."""
    return (F.year(c) + (F.month(c) >= 10).cast("int")).cast("bigint")


def floor_to(c: Column, seconds: int) -> Column:
    """The start of the step of so many seconds since 1970 that holds the time."""
    n = seconds * 1_000_000
    return from_micros((F.floor(micros(c) / F.lit(n)) * n).cast("bigint"))


def ceil_to(c: Column, seconds: int) -> Column:
    n = seconds * 1_000_000
    return from_micros((F.ceil(micros(c) / F.lit(n)) * n).cast("bigint"))


def from_parts(yearmonth: Column, day: Column, hhmm: Column) -> Column:
    """YYYYMM, DD and HHMM numbers to a time; hours and minutes are held to 0-23 and 0-59, impossible dates are null."""
    hold = lambda c, top: F.least(F.greatest(c, F.lit(0)), F.lit(top))
    return F.call_function(
        "try_make_timestamp_ntz", F.floor(yearmonth / 100).cast("int"), (yearmonth % 100).cast("int"), day.cast("int"), hold(F.floor(hhmm / 100).cast("int"), 23), hold((hhmm % 100).cast("int"), 59), F.lit(0).cast("decimal(8,6)")
    )


def midpoint(a: Column, b: Column) -> Column:
    return from_micros(F.floor((micros(a) + micros(b)) / 2).cast("bigint"))
