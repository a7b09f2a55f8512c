"""Scale properties of the report plans, checked on the plans that Spark executed.

* no cartesian products or nested-loop joins;
* no window without a partition key;
* each report reads its facts as often as it must, and no more;
* time ranges reach every scan of facts that has one.
"""

import re

import pytest

from dialtone.catalog.queries import queries
from conftest import SMOKE_DIR
from plan_nodes import count, executed, scans

# How often each report reads: hourly reports the legs; daily agent reports the summaries, the status rows of the
# days, and earlier logins; reports from events the status rows (days, spans, earlier logins), the legs (range, by
# uuid), work, breaks and agents; call performance legs and summaries. All derived tables are scans of the test data.
SCANS = {"hourly_call_summary": 1, "hourly_call_summary_w_hour": 1, "agent_productivity_mid_bu": 3, "agent_productivity_all_mid": 3,
         "agent_productivity_bu_mid": 3, "agent_events_all_mid": 8, "agent_events_bu_mid": 8, "call_performance": 2}
# scans that have no lower bound in time: earlier logins, legs by uuid and agents
UNBOUNDED = {"agent_productivity_mid_bu": 1, "agent_productivity_all_mid": 1, "agent_productivity_bu_mid": 1,
             "agent_events_all_mid": 3, "agent_events_bu_mid": 3}
REUSING = set(SCANS) - {"hourly_call_summary", "hourly_call_summary_w_hour"}


@pytest.fixture(scope="module")
def ran(spark):
    found = {}

    def get(name):
        if name not in found:
            found[name] = executed(queries()[name](spark, SMOKE_DIR))
        return found[name]
    return get


@pytest.mark.parametrize("name", sorted(SCANS))
def test_no_cartesian_or_nested_loop_join(ran, name):
    assert not count(ran(name), "CartesianProduct") and not count(ran(name), "NestedLoopJoin")


@pytest.mark.parametrize("name", sorted(SCANS))
def test_no_window_without_partition(ran, name):
    for kind, node in ran(name):
        if kind == "WindowExec":
            assert node.partitionSpec().size() > 0


@pytest.mark.parametrize("name", sorted(SCANS))
def test_scans(ran, name):
    found = scans(ran(name))
    assert len(found) == SCANS[name]
    bounded = [s for s in found if re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", s)]
    assert len(bounded) == len(found) - UNBOUNDED.get(name, 0)
    assert bool(count(ran(name), "ReusedExchange")) == (name in REUSING)


@pytest.mark.parametrize("name", ["login_sessions", "inbound_spans", "session_totals", "event_lead", "event_rank",
                                  "running_close_count", "grand_totals"])
def test_two_level_operators_read_once(spark, name):
    found = executed(queries()[name](spark, SMOKE_DIR))
    assert len(scans(found)) == 1 and count(found, "ReusedExchange") >= 1


@pytest.mark.parametrize("name", ["active_agents", "call_performance"])
def test_distinct_agents_need_no_sets(ran, spark, name):
    found = executed(queries()[name](spark, SMOKE_DIR))
    assert not count(found, "Expand")
    assert not any("collect_set" in node.toString() for kind, node in found if "Aggregate" in kind)
