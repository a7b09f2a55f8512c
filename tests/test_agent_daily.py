import datetime as dt

from dialtone.plans.agent_daily import (agent_productivity, agent_productivity_all,
                                        agent_productivity_bu)
from helpers import daily, daily_row, status, status_row

D = dt.date(2024, 1, 5)
FROM, TO = "2024-01-05 00:00:00", "2024-01-06 00:00:00"


def test_zero_count_negative_idle_and_long_totals(spark):
    rows = [
        daily_row(D, "LOGIN", "Register", 1, 90000),
        daily_row(D, "INBOUND", "Inbound", 2, 100),
        daily_row(D, "CONNECTED", "CALLinbound", 0, 70),        # count 0: divides by 1
        daily_row(D, "AGENTHOLD", "inbound", 1, 90),            # hold > talk
        daily_row(D, "AFTERWORK", "AfterWorkCALLinbound", 1, 60),
    ]
    st = status(spark, [status_row(6, dt.datetime(2024, 1, 5, 3), "Register")])
    r = agent_productivity(daily(spark, rows), st, FROM, TO, company=1, tenant=1).collect()
    assert len(r) == 1
    r = r[0]
    assert r.login_total_time == "25:00:00"
    assert r.avg_inbound_talk_time == "00:01:10"          # 70 div coalesce(nullif(0,0),1)
    assert r.inbound_talk_total_time == "00:00:-20"       # 70 - 90
    assert r.idle_time_inbound == "00:00:-30"             # 100 - (60 + 70)
    assert r.total_hold_total_time == 90                  # inbound + outbound (0)
    assert r.login_time == dt.datetime(2024, 1, 5, 3)
    assert r.full_total_login_time == "25:00:00"


def test_login_fallback_and_first_register_of_day(spark):
    rows = [daily_row(D, "LOGIN", "Register", 1, 100)]
    st = status(spark, [
        status_row(6, dt.datetime(2024, 1, 3, 9), "Register"),
        status_row(6, dt.datetime(2024, 1, 4, 9), "Register"),
        status_row(6, dt.datetime(2024, 1, 6, 9), "Register"),
    ])
    r = agent_productivity(daily(spark, rows), st, FROM, TO).collect()[0]
    assert r.login_time == dt.datetime(2024, 1, 4, 9)      # latest before from_ts
    st2 = status(spark, [status_row(6, dt.datetime(2024, 1, 5, 9), "Register"),
                         status_row(6, dt.datetime(2024, 1, 5, 7), "Register")])
    r2 = agent_productivity(daily(spark, rows), st2, FROM, TO).collect()[0]
    assert r2.login_time == dt.datetime(2024, 1, 5, 7)     # two Registers: the first


def test_all_tenants_logout_default_and_day_totals(spark):
    rows = [
        daily_row(D, "LOGIN", "Register", 1, 100, agent="6"),
        daily_row(D, "LOGIN", "Register", 1, 100, agent="8"),
        daily_row(D, "CONNECTED", "CALLinbound", 3, 30, agent="6"),
        daily_row(D, "CONNECTED", "CALLinbound", 4, 40, agent="9"),   # no LOGIN row: not a report row
        daily_row(D, "DIALED", "DialedOutbound", 2, 50, agent="6"),
    ]
    st = status(spark, [status_row(6, dt.datetime(2024, 1, 5, 12), "UnRegister")])
    out = {r.agent: r for r in agent_productivity_all(daily(spark, rows), st, FROM, TO).collect()}
    assert set(out) == {6, 8}
    assert out[6].bu == "ALL" and out[6].full_total_connected_inbound_calls == 7
    assert out[6].logout_time == dt.datetime(2024, 1, 5, 12)
    assert out[8].logout_time == dt.datetime(2024, 1, 5, 18, 29, 59)
    assert out[6].avg_outbound_dialed_time == "00:00:25"


def test_by_unit_null_unit_row_keeps_only_its_login(spark):
    rows = [
        daily_row(D, "LOGIN", "Register", 1, 100, unit=None),
        daily_row(D, "INBOUND", "Inbound", 1, 50, unit=None),
        daily_row(D, "LOGIN", "Register", 1, 200, unit="BU1"),
        daily_row(D, "INBOUND", "Inbound", 1, 60, unit="BU1"),
    ]
    st = status(spark, [])
    out = {r.bu: r for r in agent_productivity_bu(daily(spark, rows), st, FROM, TO).collect()}
    assert out[None].login_total_time == "00:01:40"
    assert out[None].inbound_total_count == 0              # a NULL key never joins
    assert out["BU1"].inbound_total_time == "00:01:00"
