"""Oracle SQL (DuckDB) for each registered query."""

from __future__ import annotations

from dialtone.catalog import params as P
from dialtone.catalog.oracle_agent import agent_sql
from dialtone.catalog.oracle_events import agent_events_sql
from dialtone.catalog.oracle_hourly import hourly_sql
from dialtone.catalog.oracle_perf import call_performance_sql


def oracle_sql() -> dict[str, str]:
    from dialtone.catalog.op_queries import oracle_sql as op_sql
    return {**_reports(), **op_sql()}


def _reports() -> dict[str, str]:
    return {
        "hourly_call_summary": hourly_sql(P.FROM_TS, P.TO_TS, P.SKILLS, None, P.COMPANY,
                                          P.TENANT),
        "hourly_call_summary_bu": hourly_sql(P.FROM_TS, P.TO_TS, P.SKILLS, P.B_UNIT, P.COMPANY,
                                             P.TENANT),
        "hourly_call_summary_w_hour": hourly_sql(P.FROM_TS, P.TO_TS, P.SKILLS, None, P.COMPANY,
                                                 P.TENANT, band=(P.FROM_HOUR, P.TO_HOUR),
                                                 with_outbound=True),
        "hourly_call_summary_w_hour_bu": hourly_sql(P.FROM_TS, P.TO_TS, P.SKILLS, P.B_UNIT,
                                                    P.COMPANY, P.TENANT,
                                                    band=(P.FROM_HOUR, P.TO_HOUR),
                                                    with_outbound=True),
        "call_performance": call_performance_sql(P.FROM_TS, P.TO_TS),
        "call_performance_mid": call_performance_sql(P.MID_FROM_TS, P.MID_TO_TS),
        "agent_productivity": agent_sql(P.FROM_TS, P.TO_TS, variant="base", company=P.COMPANY,
                                        tenant=P.TENANT),
        "agent_productivity_mid_bu": agent_sql(P.MID_FROM_TS, P.MID_TO_TS, variant="base",
                                               b_unit=P.B_UNIT, company=P.COMPANY,
                                               tenant=P.TENANT),
        "agent_productivity_agent": agent_sql(P.FROM_TS, P.TO_TS, variant="base", resource_id=P.AGENT,
                                              company=P.COMPANY, tenant=P.TENANT),
        "agent_productivity_all": agent_sql(P.FROM_TS, P.TO_TS, variant="all"),
        "agent_productivity_all_mid": agent_sql(P.MID_FROM_TS, P.MID_TO_TS, variant="all"),
        "agent_productivity_bu": agent_sql(P.FROM_TS, P.TO_TS, variant="bu"),
        "agent_productivity_bu_mid": agent_sql(P.MID_FROM_TS, P.MID_TO_TS, variant="bu"),
        "agent_events_all": agent_events_sql(P.FROM_TS, P.TO_TS, by_unit=False),
        "agent_events_all_mid": agent_events_sql(P.MID_FROM_TS, P.MID_TO_TS, by_unit=False),
        "agent_events_bu": agent_events_sql(P.FROM_TS, P.TO_TS, by_unit=True),
        "agent_events_bu_mid": agent_events_sql(P.MID_FROM_TS, P.MID_TO_TS, by_unit=True),
    }
