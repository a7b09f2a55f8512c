"""Tables stored by day, boundaries of earlier logins, legs in buckets."""

import datetime as dt
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialtone import schemas
from dialtone.operators import cdr as co
from dialtone.operators.sessions import last_before
from dialtone.plans.agent_daily import agent_productivity_all
from dialtone.plans.agent_events import agent_events_all
from dialtone.plans.call_performance import call_performance
from dialtone.sources import facts
from dialtone.sources.days import DayTable
from dialtone.sources.fixtures import tables
from dialtone.sources.snapshots import LastEvents
from dialtone.sources.tables import with_added_columns
from conftest import SMOKE_DIR
from helpers import cdr, cdr_row, status, status_row
from plan_nodes import count, executed, scans

D = [dt.date(2024, 1, k) for k in range(1, 15)]


def _table(spark, path):
    return DayTable(spark, str(path), schemas._schema("day date, k int"), "day")


def _rows(table, *range_):
    return sorted((r.day, r.k) for r in table.read(*range_).collect())


def _frame(spark, rows):
    return spark.createDataFrame(rows, schemas._schema("day date, k int"))


def test_range_is_replaced_at_once(spark, tmp_path):
    table = _table(spark, tmp_path)
    assert _rows(table) == [] and table.days() == [] and table.note() == {}
    assert table.replace(_frame(spark, [(D[0], 1), (D[1], 2), (D[2], 3), (None, 9), (D[9], 9)]), D[0], D[2]) == D[:3]
    seen = table.read()
    # one day gets other rows, one has none any more, one lies beyond the range
    assert table.replace(_frame(spark, [(D[1], 20), (D[1], 21)]), D[0], D[1], note={"run": 2}) == [D[1]]
    assert _rows(table) == [(D[1], 20), (D[1], 21), (D[2], 3)] and table.note() == {"run": 2}
    assert sorted((r.day, r.k) for r in seen.collect()) == [(D[0], 1), (D[1], 2), (D[2], 3)]  # an older reader goes on
    assert _rows(table, D[2], None) == _rows(table, D[2], D[5]) == [(D[2], 3)]
    table.replace_days(_frame(spark, [(D[2], 30), (D[1], 99)]), [D[2], D[4]])
    assert _rows(table) == [(D[1], 20), (D[1], 21), (D[2], 30)] and table.note() == {"run": 2}
    before = _rows(table)
    assert table.clean(keep=1) == 3 and _rows(table) == before


def test_failure_halfway_leaves_the_old_range(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.replace(_frame(spark, [(D[0], 1), (D[1], 2)]), D[0], D[1])
    broken = _frame(spark, [(D[0], 5), (D[1], 6)]).repartition(2, "day").withColumn(
        "k", F.when(F.col("k") == 6, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("k")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken, D[0], D[1])
    assert _rows(table) == [(D[0], 1), (D[1], 2)]
    # all rows written, then the writer dies while it commits
    commit = os.path.join(str(tmp_path), "commits", "000000000001.json")
    with open(commit, "w") as f:
        f.write('{"days": {"2024-01-0')
    assert _rows(table) == [(D[0], 1), (D[1], 2)]
    table.replace(_frame(spark, [(D[0], 7)]), D[0], D[1])
    assert _rows(table) == [(D[0], 7)]


def test_two_writers_conflict(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path)
    table.replace(_frame(spark, [(D[0], 1)]), D[0], D[0])
    monkeypatch.setattr(DayTable, "_commits", lambda self: [])  # a writer that has not seen the other's commit
    with pytest.raises(Exception, match="(?i)exist"):
        table.replace(_frame(spark, [(D[0], 2)]), D[0], D[0])
    monkeypatch.undo()
    assert _rows(table) == [(D[0], 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10 ** 6))
def test_boundaries_equal_the_whole_history(spark, tmp_path_factory, seed):
    r = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [status_row(r.choice([None, 1, 2, 3, 4]), base + dt.timedelta(hours=r.randrange(0, 24 * 13)),
                       r.choice(["Register", "UnRegister"]), tenant=r.choice([1, 2]), unit=r.choice([None, "BU1", "BU2"]))
            for _ in range(r.randrange(0, 60))]
    events = status(spark, rows)
    logins = LastEvents(spark, str(tmp_path_factory.mktemp("logins")))
    for day in sorted(r.sample(D, r.randrange(0, 4))):
        logins.advance(events, day)
        assert logins.check(events, day).count() == 0
    for _ in range(2):
        at = base + dt.timedelta(minutes=r.randrange(0, 14 * 24 * 60))
        scope = r.choice([None, F.col("tenant_id") == 1, F.col("business_unit") == "BU2"])
        want = last_before(events, "Register", at, extra=scope)
        got = logins.last_before(events, at, extra=scope)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lookup_reads_one_boundary_and_a_bounded_range(spark, tmp_path):
    events = tables(spark, SMOKE_DIR).status
    logins = LastEvents(spark, str(tmp_path / "logins"))
    logins.advance(events, D[3])
    logins.advance(events, D[7])
    df = logins.last_before(events, "2024-01-10 00:00:00")
    found = scans(executed(df))
    pushed = [s for s in found if "GreaterThanOrEqual(ts,2024-01-08" in s and "LessThan(ts,2024-01-10" in s]
    pruned = [s for s in found if "PartitionFilters" in s and "as_of" in s.split("PartitionFilters")[1].split("]")[0]]
    assert len(found) == 2 and len(pushed) == 1 and len(pruned) == 1, found
    late = status(spark, [status_row(1, dt.datetime(2024, 1, 2), "Register")])
    assert [r.resource_id for r in logins.check(events.unionByName(late), D[3]).collect()] in ([1], [])


def test_reports_with_boundaries_and_buckets_are_the_same(spark, tmp_path):
    t = tables(spark, SMOKE_DIR)
    span = ("2024-01-10 00:00:00", "2024-01-20 12:00:00")
    logins = LastEvents(spark, str(tmp_path / "logins"))
    logins.advance(t.status, D[8])
    want = sorted(map(str, agent_productivity_all(t.daily, t.status, *span).collect()))
    assert sorted(map(str, agent_productivity_all(t.daily, t.status, *span, logins=logins).collect())) == want
    facts.write_legs_by_uuid(t.cdr.filter("tenant_id = 1"), "legs_in_buckets", str(tmp_path / "legs"), buckets=4)
    facts.write_legs_by_uuid(t.cdr.filter("tenant_id <> 1"), "legs_in_buckets", str(tmp_path / "legs"), buckets=4)
    try:
        legs = spark.table("legs_in_buckets")
        args = (t.status, t.cdr, t.resources, t.acw, t.breaks, *span)
        got = agent_events_all(*args, legs_by_uuid=legs, logins=logins)
        assert sorted(map(str, got.collect())) == sorted(map(str, agent_events_all(*args).collect()))
    finally:
        spark.sql("drop table legs_in_buckets")


def _under(node):
    kids = node.children()
    out = [node]
    for i in range(kids.size()):
        out += _under(kids.apply(i))
    return out


def test_bucketed_legs_are_not_shuffled(spark, tmp_path):
    t = tables(spark, SMOKE_DIR)
    facts.write_legs_by_uuid(t.cdr, "legs_no_exchange", str(tmp_path / "legs"), buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = co.acw_by_direction(t.acw, spark.table("legs_no_exchange"), "2024-01-01 00:00:00", "2024-01-31 00:00:00")
        want = co.acw_by_direction(t.acw, t.cdr, "2024-01-01 00:00:00", "2024-01-31 00:00:00")
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
        found = executed(df)
        for kind, node in found:
            if kind == "ShuffleExchangeExec":  # none has the legs alone under it
                texts = [x.toString() for x in _under(node)]
                assert not ("legs" in texts[-1] and "Join" not in texts[0] and not any("Join" in x for x in texts))
        leg_scan = [s for s in scans(found) if "Bucketed: true" in s]
        assert len(leg_scan) == 1 and count(found, "SortMergeJoin") == 1
        # without buckets there is one exchange more
        assert count(executed(want), "ShuffleExchange") == count(found, "ShuffleExchange") + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table legs_no_exchange")


def test_week_of_day_tables_opens_the_days_of_the_week(spark, tmp_path):
    t = tables(spark, SMOKE_DIR)
    week = ("2024-01-08 00:00:00", "2024-01-14 12:00:00")
    for name in ("cdr", "daily"):
        written = facts.write_fact(getattr(t, name), str(tmp_path), name, D[0], dt.date(2024, 1, 31))
        assert len(written) > 20
    stored = {n: facts.read_fact(spark, str(tmp_path), n) for n in ("cdr", "daily")}
    df = call_performance(stored["cdr"], stored["daily"], *week)
    assert sorted(map(str, df.collect())) == sorted(map(str, call_performance(t.cdr, t.daily, *week).collect()))
    found = scans(executed(df))
    assert len(found) == 2
    for s in found:
        filters = s.split("PartitionFilters: [")[1].split("]")[0]
        assert ">=" in filters and "<=" in filters and ("created_time_day" in filters or "summary_date" in filters)


def test_daily_fact_of_the_test_rows(spark, tmp_path):
    legs = cdr(spark, [cdr_row(uuid="a"), cdr_row(uuid="b", created_time=dt.datetime(2024, 1, 6, 1))])
    facts.write_fact(legs, str(tmp_path), "cdr", D[4], D[4])
    assert [r.uuid for r in facts.read_fact(spark, str(tmp_path), "cdr").collect()] == ["a"]


def test_columns_that_came_later(spark):
    old = spark.createDataFrame([(1,)], "campaign_id int")
    got = with_added_columns(old, "campaign_configurations")
    assert got.dtypes == [("campaign_id", "int"), ("number_loading_method", "string"), ("duplicate_num_timeout", "int")]
    assert got.first().number_loading_method is None
    new = spark.createDataFrame([(1, "BATCH", 30)], "campaign_id int, number_loading_method string, duplicate_num_timeout long")
    assert tuple(with_added_columns(new, "campaign_configurations").first()) == (1, "BATCH", 30)
