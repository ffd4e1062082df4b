"""Time semantics.

All functions return Columns built from built-in expressions so they stay
inside whole-stage codegen.  The session time zone must be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardline.params import FINALIZATION_DAYS, LOCAL_CUTOFF_HOUR

__all__ = [
    "col_", "add_hours", "add_days", "add_weeks", "diff_hours", "diff_weeks",
    "trunc_hour", "ceil_hour", "day_of_week", "local_to_instant", "date_to_timestamp",
    "parse_timestamp", "date_to_text", "alignment_ts", "finalization_ts", "hour_seq",
    "to_wall_clock",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_hours(ts, n) -> Column:
    """F1 DATEADD('HOUR', n, ts); a DATE is taken as midnight (zone-less)."""
    n = F.lit(n) if isinstance(n, int) else col_(n)
    return F.timestamp_add("HOUR", n, col_(ts).cast("timestamp"))


def add_days(d, n) -> Column:
    """F2 DATEADD('DAY', n, date)."""
    return F.date_add(col_(d), n)


def add_weeks(d, n) -> Column:
    """F3 DATEADD('week', n, date)."""
    return F.date_add(col_(d), n * 7 if isinstance(n, int) else col_(n) * 7)


def trunc_hour(ts) -> Column:
    """F6 DATE_TRUNC('HOUR', ts)."""
    return F.date_trunc("hour", col_(ts))


def ceil_hour(ts) -> Column:
    """Smallest whole hour >= ts (first hourly checkpoint that sees ts)."""
    t = trunc_hour(ts)
    return F.when(t == col_(ts), t).otherwise(F.timestamp_add("HOUR", F.lit(1), t))


def diff_hours(a, b) -> Column:
    """F4 DATEDIFF('HOUR', a, b): hour boundaries crossed from a to b."""
    secs = F.unix_seconds(trunc_hour(b)) - F.unix_seconds(trunc_hour(a))
    return (secs / F.lit(3600)).cast("long")


def diff_weeks(a, b) -> Column:
    """F5 DATEDIFF('WEEK', a, b): Monday boundaries crossed from a to b."""
    wa = F.date_trunc("week", col_(a).cast("timestamp")).cast("date")
    wb = F.date_trunc("week", col_(b).cast("timestamp")).cast("date")
    return (F.datediff(wb, wa) / F.lit(7)).cast("int")


def day_of_week(d) -> Column:
    """F7 DATE_PART('DOW', d): 0 = Sunday."""
    return F.dayofweek(col_(d)) - F.lit(1)


def local_to_instant(wall, zone) -> Column:
    """F8 local wall clock in ``zone`` -> UTC instant (session zone UTC)."""
    return F.to_utc_timestamp(col_(wall), col_(zone))


def date_to_timestamp(d) -> Column:
    """F11 TO_TIMESTAMP_NTZ(date): midnight, compared as UTC."""
    return col_(d).cast("timestamp")


def parse_timestamp(text) -> Column:
    """F10 TO_TIMESTAMP_TZ(text): ISO text with optional offset."""
    return col_(text).cast("timestamp")


def date_to_text(d) -> Column:
    """F13 date::TEXT -> yyyy-MM-dd."""
    return col_(d).cast("string")


def alignment_ts(ship_date, zone) -> Column:
    """Ship date at 17:00 facility-local, as an instant."""
    return local_to_instant(add_hours(ship_date, LOCAL_CUTOFF_HOUR), zone)


def finalization_ts(ship_date, zone) -> Column:
    """Ship date minus 3 days at 17:00 facility-local, as an instant."""
    return local_to_instant(add_hours(add_days(ship_date, -FINALIZATION_DAYS), LOCAL_CUTOFF_HOUR), zone)


def hour_seq(lo, hi) -> Column:
    """Hourly timestamps lo..hi inclusive; NULL (not an error) when lo > hi."""
    return F.when(col_(lo) <= col_(hi), F.sequence(col_(lo), col_(hi), F.expr("INTERVAL 1 HOUR")))


def to_wall_clock(ts) -> Column:
    """UTC instant -> zone-less UTC wall clock (TIMESTAMP_NTZ) for reports."""
    return col_(ts).cast("timestamp_ntz")
