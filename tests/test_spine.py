import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from dialtone.operators import spine
from dialtone.operators.spine import clock_changes, hour_spine, spine_bounds
from dialtone.plans.hourly import hourly_call_summary
from helpers import cdr, cdr_row


def test_spine_counts_every_hour_inclusive(spark):
    df = hour_spine(spark, "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    rows = df.collect()
    assert len(rows) == 25 == spine_bounds("2024-01-05 00:00:00", "2024-01-06 00:00:00")[1]
    assert len({(r.s_date, r.s_hour) for r in rows}) == 25


def test_spine_range_not_on_the_hour_keeps_last_hour(spark):
    # 08:30-10:15 local: hours 8, 9 and 10 (both ends truncated to the hour)
    df = hour_spine(spark, "2024-01-05 03:00:00", "2024-01-05 04:45:00")
    assert sorted(r.s_hour for r in df.collect()) == [8, 9, 10]


def test_spine_hour_band(spark):
    df = hour_spine(spark, "2024-01-05 00:00:00", "2024-01-07 00:00:00", from_hour=8, to_hour=18)
    hours = [r.s_hour for r in df.collect()]
    assert set(hours) == set(range(8, 19)) and len(hours) == 22


def _minute_by_minute(from_ts, to_ts, tz):
    start, end = (dt.datetime.fromisoformat(x).replace(tzinfo=dt.timezone.utc) for x in (from_ts, to_ts))
    n = int((end - start).total_seconds() // 60)
    moments = [start + dt.timedelta(minutes=k) for k in range(n + 1)] + [end]
    return sorted({(x.date(), x.hour) for x in (m.astimezone(ZoneInfo(tz)) for m in moments)})


RANGES = [
    ("America/New_York", "2024-03-09 20:10:00", "2024-03-11 05:00:00"),  # 02:00 is skipped
    ("America/New_York", "2024-11-02 20:00:00", "2024-11-04 03:05:00"),  # 01:00 comes twice
    ("Europe/Berlin", "2024-03-30 12:30:00", "2024-04-01 00:00:00"),
    ("Europe/Berlin", "2024-10-26 12:00:00", "2024-10-28 11:59:59"),
    ("Australia/Lord_Howe", "2024-04-05 12:00:00", "2024-04-07 13:00:00"),  # half an hour
    ("Antarctica/Troll", "2024-10-26 12:00:00", "2024-10-27 12:00:00"),  # two hours
    ("Pacific/Apia", "2011-12-29 00:00:00", "2011-12-31 23:00:00"),  # a day is skipped
]


@pytest.mark.parametrize("tz,from_ts,to_ts", RANGES)
def test_clock_changes(spark, tz, from_ts, to_ts):
    assert clock_changes(from_ts, to_ts, tz)
    rows = [(r.s_date, r.s_hour) for r in hour_spine(spark, from_ts, to_ts, tz).collect()]
    assert sorted(rows) == _minute_by_minute(from_ts, to_ts, tz)


@pytest.mark.parametrize("tz", ["Asia/Colombo", "Asia/Kathmandu", "UTC", "America/New_York"])
@pytest.mark.parametrize("from_ts,to_ts", [("2024-01-05 00:00:00", "2024-01-06 00:00:00"), ("2024-01-05 03:07:00", "2024-01-05 03:50:00"),
                                           ("2024-01-05 03:50:00", "2024-01-05 04:01:01"), ("2024-01-06 00:00:00", "2024-01-05 00:00:00")])
def test_both_ways_agree_where_clocks_stay(spark, monkeypatch, tz, from_ts, to_ts):
    assert not clock_changes(from_ts, to_ts, tz)
    direct = sorted(hour_spine(spark, from_ts, to_ts, tz).collect())
    monkeypatch.setattr(spine, "clock_changes", lambda *a: True)
    assert sorted(hour_spine(spark, from_ts, to_ts, tz).collect()) == direct


def test_hourly_report_over_clock_changes(spark):
    legs = cdr(spark, [cdr_row(uuid=str(k), created_time=t, agent_skill="skill0") for k, t in enumerate([
        dt.datetime(2024, 3, 10, 6, 30), dt.datetime(2024, 3, 10, 7, 30),    # 01:30 and 03:30, an hour apart
        dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30)])])  # 01:30 twice
    spring = hourly_call_summary(spark, legs, "2024-03-10 05:00:00", "2024-03-10 09:00:00", "skill0", "America/New_York").collect()
    assert [(r.s_hour, r.ivrcount) for r in spring] == [(0, None), (1, 1), (3, 1), (4, None), (5, None)]
    autumn = hourly_call_summary(spark, legs, "2024-11-03 04:00:00", "2024-11-03 08:00:00", "skill0", "America/New_York").collect()
    assert [(r.s_hour, r.ivrcount) for r in autumn] == [(0, None), (1, 2), (2, None), (3, None)]
