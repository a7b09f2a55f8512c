import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import Window
from pyspark.sql import functions as F

from dialtone.catalog.op_queries import _last_login
from dialtone.operators.sessions import last_before, lead_in_time, running_count, span_totals, spans
from helpers import status, status_row

BASE = dt.datetime(2024, 1, 5)


def _random_events(spark, n=400, agents=4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = BASE + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400), microseconds=i)
        rows.append(status_row(rnd.choice([None, *range(agents)]), at, rnd.choice(["Register", "UnRegister"])))
    return status(spark, rows)


def _skewed_events(spark, n=2500, seed=3):
    """A hot agent owns most events, many at one instant; other agents, one of them NULL, are spread over days."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rnd.random() < 0.7
        seconds = rnd.randrange(0, 5400) if hot else rnd.randrange(0, 20 * 86400)
        at = BASE + dt.timedelta(seconds=seconds // 60 * 60 if rnd.random() < 0.3 else seconds)
        rows.append(status_row(7 if hot else rnd.choice([None, 1, 2]), at, f"r{rnd.randrange(10 ** 6)}"))
    return status(spark, rows)


def test_two_level_operators_with_a_hot_agent_and_ties(spark):
    ev = _skewed_events(spark)
    w = Window.partitionBy("resource_id").orderBy("created_at", "reason")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    keys = ["resource_id", "created_at", "reason"]
    for bucket in ("1 minute", "1 hour", "1 day"):
        want = ev.select(*keys, F.lead("created_at").over(w).alias("next_at"), F.lead("reason").over(w).alias("next_reason"))
        got = lead_in_time(ev, ["resource_id"], bucket=bucket).select(*keys, "next_at", "next_reason")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        want = ev.select(*keys, F.count(F.lit(1)).over(upto).alias("n"))
        got = running_count(ev, ["resource_id"], F.lit(True), "n", bucket=bucket).select(*keys, "n")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_last_before_has_no_row_for_a_null_agent(spark):
    ev = status(spark, [status_row(None, BASE, "Register"), status_row(1, BASE, "Register"), status_row(1, BASE + dt.timedelta(1), "Register")])
    assert [tuple(r) for r in last_before(ev, "Register", BASE + dt.timedelta(1)).collect()] == [(1, BASE)]


def test_every_agent_that_logged_in_has_a_row_in_last_login_before(spark):
    ev = status(spark, [status_row(None, BASE, "Register"), status_row(None, BASE, "Register"), status_row(1, BASE, "Register"),
                        status_row(2, BASE, "UnRegister"), status_row(3, BASE + dt.timedelta(30), "Register")])
    got = _last_login(spark, SimpleNamespace(status=ev)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, BASE), (None, None)]


def test_two_level_lead_equals_window_lead(spark):
    ev = _random_events(spark)
    w = Window.partitionBy("resource_id").orderBy("created_at", "reason")
    expected = ev.select("resource_id", "created_at", F.lead("created_at").over(w).alias("next_at"),
                         F.lead("reason").over(w).alias("next_reason"))
    got = lead_in_time(ev, ["resource_id"]).select("resource_id", "created_at", "next_at", "next_reason")
    assert sorted(map(str, expected.collect())) == sorted(map(str, got.collect()))


def test_two_level_running_count_equals_window_sum(spark):
    ev = _random_events(spark, seed=11)
    w = Window.partitionBy("resource_id").orderBy("created_at", "reason").rowsBetween(
        Window.unboundedPreceding, 0)
    expected = ev.select("resource_id", "created_at",
                         F.sum(F.when(F.col("reason") == "UnRegister", 1).otherwise(0)).over(w)
                         .cast("bigint").alias("n"))
    got = running_count(ev, ["resource_id"], F.col("reason") == "UnRegister", "n") \
        .select("resource_id", "created_at", "n")
    assert sorted(map(str, expected.collect())) == sorted(map(str, got.collect()))


def test_login_sessions_need_immediate_unregister(spark):
    ev = status(spark, [
        status_row(1, BASE + dt.timedelta(hours=1), "Register"),
        status_row(1, BASE + dt.timedelta(hours=2), "Register"),     # Register twice: first has no session
        status_row(1, BASE + dt.timedelta(hours=27), "UnRegister"),  # session of 25 h, across buckets
        status_row(1, BASE + dt.timedelta(hours=30), "Register"),    # never closed
    ])
    s = spans(ev, "Register", "UnRegister", "2024-01-01 00:00:00", "2024-01-31 00:00:00",
              require_next="UnRegister").collect()
    assert [(r.start_at.hour, r.span_us) for r in s] == [(2, 25 * 3600 * 10**6)]
    totals = span_totals(ev, "2024-01-01 00:00:00", "2024-01-31 00:00:00").collect()[0]
    assert totals.login_us == 25 * 3600 * 10**6 and totals.inbound_us is None


def test_open_last_inbound_span_adds_nothing(spark):
    ev = status(spark, [
        status_row(2, BASE, "Inbound"),
        status_row(2, BASE + dt.timedelta(minutes=10), "endInbound"),
        status_row(2, BASE + dt.timedelta(minutes=20), "Inbound"),
    ])
    t = span_totals(ev, "2024-01-01 00:00:00", "2024-01-31 00:00:00").collect()[0]
    assert t.inbound_us == 600 * 10**6
