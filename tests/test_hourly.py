import datetime as dt

from dialtone.plans.hourly import hourly_call_summary, hourly_call_summary_w_hour
from helpers import T0, cdr, cdr_row

FROM, TO = "2024-01-05 00:00:00", "2024-01-05 06:00:00"


def _by_hour(rows):
    out = {}
    for r in rows:
        out.setdefault((r.s_date, r.s_hour), []).append(r)
    return out


def test_empty_hours_are_present_with_null_measures(spark):
    legs = cdr(spark, [cdr_row(uuid="a"), cdr_row(uuid="b", agent_answered=False, queue_sec=7)])
    rows = hourly_call_summary(spark, legs, FROM, TO, "skill0,skill1").collect()
    hours = _by_hour(rows)
    assert len(hours) == 7  # 05:30 .. 11:30 local, both ends
    busy = hours[(dt.date(2024, 1, 5), 8)]  # 03:05 UTC = 08:35 local
    assert len(busy) == 1 and busy[0].ivrcount == 2 and busy[0].queuedcount == 2
    assert busy[0].abandonedcount == 1 and busy[0].droppedcount is None
    assert busy[0].abandonedpercent == 50 and busy[0].answeredpercent == 50
    empty = hours[(dt.date(2024, 1, 5), 6)][0]
    assert empty.ivrcount is None and empty.agentskill is None and empty.holdsec_avg is None


def test_abandoned_dropped_threshold_and_hold_average(spark):
    legs = cdr(spark, [
        cdr_row(uuid="a", agent_answered=False, queue_sec=5),   # dropped (<= 5 s)
        cdr_row(uuid="b", agent_answered=False, queue_sec=6),   # abandoned (> 5 s)
        cdr_row(uuid="c", hold_sec=0),                          # not in hold average
        cdr_row(uuid="d", hold_sec=30),
        cdr_row(uuid="e", hold_sec=45),
    ])
    r = hourly_call_summary(spark, legs, FROM, TO, "skill0").filter("ivrcount is not null").collect()[0]
    assert (r.droppedcount, r.abandonedcount) == (1, 1)
    assert r.holdsec_avg == "00:00:37"  # (30 + 45) / 2 = 37.5, cut to whole seconds


def test_scope_filters_tenant_unit_and_spaced_skill(spark):
    legs = cdr(spark, [
        cdr_row(uuid="a"), cdr_row(uuid="b", tenant_id=2), cdr_row(uuid="c", business_unit=None),
        cdr_row(uuid="d", agent_skill="skill2"), cdr_row(uuid="e", direction="outbound"),
    ])
    all_units = hourly_call_summary(spark, legs, FROM, TO, "skill0, skill2").filter(
        "ivrcount is not null").collect()
    assert [(r.agentskill, r.ivrcount) for r in all_units] == [("skill0", 2)]  # ' skill2' never matches
    one_unit = hourly_call_summary(spark, legs, FROM, TO, "skill0", b_unit="BU1").filter(
        "ivrcount is not null").collect()
    assert one_unit[0].ivrcount == 1  # NULL unit excluded


def test_w_hour_band_inclusive_end_and_outbound_fanout(spark):
    t_in = T0 + dt.timedelta(hours=3)
    legs = cdr(spark, [
        cdr_row(uuid="a", created_time=t_in, agent_skill="skill0"),
        cdr_row(uuid="b", created_time=t_in, agent_skill="skill1"),
        cdr_row(uuid="c", created_time=t_in, direction="outbound", obj_type="GATEWAY", hold_sec=20),
        cdr_row(uuid="d", created_time=T0 + dt.timedelta(hours=6), agent_skill="skill0"),  # == to_ts
    ])
    rows = hourly_call_summary_w_hour(spark, legs, FROM, TO, 8, 11, "skill0,skill1").collect()
    assert {r.s_hour for r in rows} == {8, 9, 10, 11}
    at8 = [r for r in rows if r.s_hour == 8]
    assert sorted(r.agentskill for r in at8) == ["skill0", "skill1"]
    assert all(r.outboundcallcount == 1 and r.holdsec_avg_outbound == "00:00:20" for r in at8)
    assert [r.ivrcount for r in rows if r.s_hour == 11] == [1]  # upper end inclusive
