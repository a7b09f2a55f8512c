"""Time-zone and day-bucketing expressions.

Fact timestamps are UTC wall-clock values (``timestamp_ntz``). Local time
is ``convert_timezone('UTC', tz, ts)``: it follows the zone's rules
(including daylight saving) and does not depend on the session zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone every report of the reference uses for local days.
DEFAULT_TZ = "Asia/Colombo"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_ts(c: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """UTC wall-clock timestamp -> wall-clock timestamp in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _as_col(c))


def local_date(c: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.to_date(local_ts(c, tz))


def local_hour(c: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.hour(local_ts(c, tz))


def utc_date(c: Column | str) -> Column:
    """Calendar day of a UTC timestamp (the reference's session-zone day)."""
    return F.to_date(_as_col(c))


def parse_ts(value: str | dt.datetime) -> dt.datetime:
    """Parameter -> naive UTC datetime (aware values are converted to UTC)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def ts_literal(value: str | dt.datetime) -> Column:
    """A UTC instant parameter as a ``timestamp_ntz`` literal (pushes down to parquet).

    Passed as text: a Python datetime would be read in the driver's own time zone.
    """
    return F.lit(parse_ts(value).isoformat(sep=" ")).cast("timestamp_ntz")


def date_bounds(from_ts: str | dt.datetime, to_ts: str | dt.datetime) -> tuple[dt.date, dt.date]:
    """Summary-date range for a timestamp range: ``[from_ts.date(), to_ts.date()]``.

    The original splices the bounds into its SQL as untyped literals, which
    are read as dates when compared with a date column, dropping the time
    of day. Computing the dates up front keeps the predicate on the raw
    column, so it reaches the parquet reader.
    """
    return parse_ts(from_ts).date(), parse_ts(to_ts).date()
