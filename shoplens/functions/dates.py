"""Date arithmetic with pandas ``Timedelta.days`` semantics.

Spark's ``datediff`` counts calendar midnights (23:00 -> 01:00 next day is 1);
a pandas timedelta's ``.days`` floors the elapsed time (that span is 0 days and
minus one hour is -1).  ``floor_days`` reproduces the latter exactly on the
microsecond epoch, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_utc_ts(c: Column | str) -> Column:
    """Cast ``timestamp_ntz`` / date / string to a session (UTC) timestamp."""
    return _col(c).cast("timestamp")


def floor_days(later: Column | str, earlier: Column | str) -> Column:
    """floor((later - earlier) / 1 day) as a long; null if either side is null."""
    delta = F.unix_micros(as_utc_ts(later)) - F.unix_micros(as_utc_ts(earlier))
    return F.floor(delta / F.lit(float(MICROS_PER_DAY))).cast("long")


def shift_days(c: Column | str, days: int) -> Column:
    """Timestamp plus a whole number of days (negative moves back)."""
    return as_utc_ts(c) + F.make_dt_interval(F.lit(days))
