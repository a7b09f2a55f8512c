"""Hour spine: one row per local hour of a report range (gap filling)."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialtone.functions.timefx import DEFAULT_TZ, local_ts, parse_ts, ts_literal

# hours per spine partition. The spine is the streamed side of the report's
# join, so its partitions carry the output: a ten-year range (~88k hours) x
# dozens of skills is spread over ~9 tasks instead of one.
_ROWS_PER_PARTITION = 10_000


# an offset from UTC is a multiple of a quarter of an hour in every present zone
_STEP_MINUTES = 15


def local_wall_clock(value: str | dt.datetime, tz: str = DEFAULT_TZ) -> dt.datetime:
    """UTC instant parameter -> naive wall-clock time in ``tz``."""
    utc = parse_ts(value).replace(tzinfo=dt.timezone.utc)
    return utc.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def spine_bounds(from_ts, to_ts, tz: str = DEFAULT_TZ) -> tuple[dt.datetime, int]:
    """First local hour and number of hours on the local clock, both ends inclusive.

    Both ends are truncated to the hour, so a range that does not start on
    the hour still covers the hour its last call falls in. Where clocks change
    within the range the hours that exist are fewer, or some come twice.
    """
    first = local_wall_clock(from_ts, tz).replace(minute=0, second=0, microsecond=0)
    last = local_wall_clock(to_ts, tz).replace(minute=0, second=0, microsecond=0)
    n = int((last - first).total_seconds() // 3600) + 1 if last >= first else 0
    return first, n


def clock_changes(from_ts, to_ts, tz: str = DEFAULT_TZ) -> bool:
    """Whether the zone's offset from UTC differs between days of the range."""
    start, end = parse_ts(from_ts), parse_ts(to_ts)
    moments = [start + dt.timedelta(days=d) for d in range(max(0, (end - start).days) + 1)] + [max(start, end)]
    return len({local_wall_clock(m, tz) - m for m in moments}) > 1


def hour_spine(spark: SparkSession, from_ts, to_ts, tz: str = DEFAULT_TZ,
               from_hour: int | None = None, to_hour: int | None = None) -> DataFrame:
    """``(s_date, s_hour)`` for every local hour from ``from_ts`` to ``to_ts``, each once.

    Generated with ``spark.range`` (distributed, no driver-side list), then
    optionally limited to an hour-of-day band, inclusive at both ends. Where
    clocks change within the range, quarters of an hour of UTC are mapped to
    local hours: an hour that is skipped has no row, one that comes twice has one,
    as the calls of both are counted together.
    """
    if clock_changes(from_ts, to_ts, tz):
        wall = _quarters(spark, from_ts, to_ts, tz)
    else:
        first, n = spine_bounds(from_ts, to_ts, tz)
        hours = spark.range(0, n, numPartitions=max(1, -(-n // _ROWS_PER_PARTITION)))
        wall = hours.select((F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")
                             + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("wall"))
    df = wall.select(F.to_date("wall").alias("s_date"), F.hour("wall").alias("s_hour"))
    if clock_changes(from_ts, to_ts, tz):
        df = df.distinct()
    if from_hour is not None:
        df = df.filter(F.col("s_hour") >= from_hour)
    if to_hour is not None:
        df = df.filter(F.col("s_hour") <= to_hour)
    return df


def _quarters(spark: SparkSession, from_ts, to_ts, tz: str) -> DataFrame:
    """Local times of the instants from ``from_ts`` to ``to_ts``, a quarter of an hour apart, and of both ends."""
    start, end = parse_ts(from_ts), parse_ts(to_ts)
    n = -(-(end - start) // dt.timedelta(minutes=_STEP_MINUTES)) + 1 if end >= start else 0
    steps = spark.range(0, n, numPartitions=max(1, -(-n // _ROWS_PER_PARTITION)))
    instant = F.least(ts_literal(end), ts_literal(start) + F.make_dt_interval(mins=(F.col("id") * _STEP_MINUTES).cast("int")))
    return steps.select(local_ts(instant, tz).alias("wall"))
